"""Registration, result shapes, and parity with the SQL where there is some."""
import duckdb
import pytest

import __spark_entry__ as E
from strata.llm import queries as Q

SF = "/root/testdata/sf0.01"
COLUMNS = {
    1: "doc_id bigint, held_out boolean, lang_pred string, score double",
    2: "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    3: "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    4: "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    5: "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double",
    6: "query_id bigint, rank int, vec_id bigint, score double",
    7: "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    8: "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    9: "doc_id bigint, held_out boolean, score double, predicted int",
    10: "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    11: "item_id bigint, rank int, doc_id bigint, score bigint",
    12: "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    13: "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
        "identity_error double",
}


def test_one_query_per_operator_is_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and set(Q.oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_columns_and_rows(spark, name):
    got = E.queries()[name](spark, "/root/testdata/sf0.001")
    assert ", ".join(f"{c} {t}" for c, t in got.dtypes) == COLUMNS[int(name[2:].split("_")[0])]
    n = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    if name.startswith("op6"):
        assert got.count() == 25 * 20
    elif name.startswith("op8"):
        assert got.where("piece = 0").count() == n
    elif name.startswith("op11"):
        assert got.count() == 40 * 10 and got.where("rank = 1").count() == 40
    elif name.startswith("op13"):
        assert got.count() == 500 * 4
    else:
        assert got.count() == n


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    rel = con.sql(Q.oracle_sql()[name])
    got = E.queries()[name](spark, SF).select(*rel.columns)
    assert sorted(map(tuple, got.collect())) == sorted(rel.fetchall())
