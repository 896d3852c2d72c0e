"""A training corpus from raw documents: five stages over the whole table.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; all but the last return the
columns of documents. Between stages the rows are written as Parquet and read again, so a lost
executor costs at most the stage it was in.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm import language_id
from strata.llm.common import documents, stored
from strata.llm.near_dedup import near_duplicates
from strata.llm.packing import pack
from strata.llm.pii import sanitise
from strata.llm.suffix_dedup import remove_repeated_bytes

#: A document goes if no language reaches this mean probability (or it has no letters).
MIN_LANGUAGE_SCORE = 0.4
#: Length of a repeated string that is removed: at 5 bytes a word, a passage of 50 words.
REPEATED_BYTES = 250


def with_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of `df`, with n_chars counted anew (null for a null text)."""
    return df.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; a null lang becomes the recognised one. Where no
    language could be learnt (no labels), every document with a letter stays as it is."""
    network = language_id.train(docs)
    if network is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_id.predict(docs, network, keep=docs.columns, out=("__lang", "__score"))
    sure = found.where((F.col("__lang") != "und") & (F.col("__score") >= MIN_LANGUAGE_SCORE))
    return sure.select(*[F.coalesce("lang", "__lang").alias(c) if c == "lang" else F.col(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, Jaccard 0.8): the smallest id.
    Of rows that share that id the first by a hash of the text; rows without an id stay."""
    found = near_duplicates(docs.select("doc_id", "text"), words=5, percent=80)
    heads = stored(found.where("kept and doc_id is not null").groupBy(F.col("doc_id").alias("__id"))
                   .agg(F.count("*").alias("n")).select("__id", "n"), "pipeline-heads")
    joined = docs.join(heads, F.col("doc_id") == F.col("__id"))
    if heads.where("n > 1").limit(1).count():
        nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
        joined = joined.where("n = 1").unionByName(joined.where("n > 1").withColumn("__nth", nth)
                                                   .where("__nth = 1").drop("__nth"))
    return joined.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings of REPEATED_BYTES that occur again anywhere."""
    keep = [c for c in docs.columns if c not in ("text", "n_chars")]
    clean = remove_repeated_bytes(docs, REPEATED_BYTES, keep=keep)
    return with_text(clean.withColumnRenamed("kept_text", "text"), docs.columns)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data and the terms that give it away replaced."""
    return with_text(sanitise(docs), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0,
                rank_path=public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeated_passages),
    ("pii", remove_personal_data),
    ("packing", pack_sequences),
]

#: None of the stages' decisions can be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over `documents`."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
