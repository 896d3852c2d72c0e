"""The operators as registered queries: whole tables, production parameters, full results."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import language_id, quality
from .ann import nearest
from .bpe import encode_digest
from .common import documents, held_out
from .fingerprints import compare_with_edits
from .lexical import search
from .near_dedup import near_duplicates
from .oracle import ORACLE
from .packing import pack
from .pieces import pieces_digest
from .pii import find
from .similar import similar
from .substring_dedup import repeated_words_digest
from .suffix_dedup import repeated_bytes_digest
from .whitening import whiten


def op1_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = language_id.predict(docs, language_id.train(docs))
    return found.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_near_dedup(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir), words=4, percent=80)


def op3_substring_dedup(spark, sf_dir):
    return repeated_words_digest(documents(spark, sf_dir), length=50)


def op4_suffix_dedup(spark, sf_dir):
    return repeated_bytes_digest(documents(spark, sf_dir), length=400)


def op5_fingerprints(spark, sf_dir):
    return compare_with_edits(documents(spark, sf_dir))


def op6_nearest_neighbours(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op7_pii(spark, sf_dir):
    return find(documents(spark, sf_dir))


def op8_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0,
                rank_path=public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op9_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, threshold=0.7)


def op10_bpe(spark, sf_dir):
    return encode_digest(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op11_lexical(spark, sf_dir):
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), top=10)


def op12_pieces(spark, sf_dir):
    return pieces_digest(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op13_whitening(spark, sf_dir):
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=4)


def queries():
    return {f.__name__: f for f in (op1_language_id, op2_near_dedup, op3_substring_dedup, op4_suffix_dedup,
                                    op5_fingerprints, op6_nearest_neighbours, op7_pii, op8_packing, op9_quality,
                                    op10_bpe, op11_lexical, op12_pieces, op13_whitening)}


def similar_fingerprints(spark, sf_dir):
    return similar(documents(spark, sf_dir), percent=80)


def beside():
    """Queries beside the numbered ones: the other half of operator 5, the join of its signatures."""
    return {"similar_fingerprints": similar_fingerprints}


def oracle_sql():
    return dict(ORACLE)
