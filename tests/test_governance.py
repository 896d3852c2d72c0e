from conftest import rows
from strata.functions.expressions import mask_hash, mask_prefix
from strata.operators import governance as G

ENT = "principal string, scope_value string"


def _data(spark):
    return spark.createDataFrame([(1, "NA"), (2, "EU"), (3, "EU")], "id int, fac string")


def test_mapped_admin_unmapped(spark):
    ent = spark.createDataFrame([("ana", "EU"), ("root", G.ALL)], ENT)
    df = _data(spark)
    assert rows(G.row_scope(df, "fac", ent, "ana"), "id") == [(2,), (3,)]
    assert G.row_scope(df, "fac", ent, "root").count() == 3
    assert G.row_scope(df, "fac", ent, "stranger").count() == 0    # default deny


def test_mask_null_and_short(spark):
    df = spark.createDataFrame([("TECH-123",), ("ab",), (None,)], "t string")
    m = df.select(mask_prefix("t", 5).alias("m"), mask_hash("t", "k").alias("h"))
    got = rows(m)
    assert ("TECH-***" in [g[0] for g in got]) and ("ab***" in [g[0] for g in got])
    assert (None, None) in got
    hs = [g[1] for g in got if g[1]]
    assert len(set(hs)) == 2


def test_scope_function_is_sql(spark):
    user = spark.sql("select current_user() as u").first().u
    G.register_scope_function(spark, "user_scope", {user: "EU"})
    _data(spark).createOrReplaceTempView("facts_t")
    got = spark.sql("select id from facts_t where fac = user_scope()").collect()
    assert sorted(r.id for r in got) == [2, 3]
    G.register_scope_function(spark, "user_scope_none", {"someone_else": "EU"})
    assert spark.sql("select id from facts_t where fac = user_scope_none()").count() == 0


def test_revocation_takes_effect_in_a_published_view(spark, tmp_path):
    grants = tmp_path / "grants.csv"
    grants.write_text("root,ALL\n")
    G.publish_view(spark, "scoped_facts", G.row_scope(_data(spark), "fac", spark.read.schema(ENT).csv(str(grants)), "root"))
    assert spark.table("scoped_facts").count() == 3
    grants.write_text("root,EU\n\n")                    # same size: the plan holds the file's length
    assert sorted(r.id for r in spark.sql("select id from scoped_facts").collect()) == [2, 3]


def test_scope_that_is_no_number_grants_nothing(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "id int, fac int")
    assert G.row_scope(df, "fac", spark.createDataFrame([("ana", "five")], ENT), "ana").count() == 0
    assert G.row_scope(df, "fac", spark.createDataFrame([("ana", G.ALL)], ENT), "ana").count() == 2
