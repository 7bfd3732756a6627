"""Stored SQL and graph nodes."""

import pytest
from pyspark.sql import functions as F

import tablecheck as tc

TEMPLATES = "domain_cd string, domain_value string"
REFERENCE = "table_cd string, table_path string, stage_table_path string"


def templates(spark, *rows):
    return spark.createDataFrame(list(rows), TEMPLATES)


@pytest.fixture
def reference(spark):
    return spark.createDataFrame([("ord", "lake.orders", "stage.orders"), ("cust", "lake.$c\\1", None)], REFERENCE)


def rendered(frame):
    return {r["domain_cd"]: r["rendered_sql"] for r in frame.collect()}


def test_keys_are_whole_words_named_once(spark):
    rows = templates(
        spark,
        ("q", "SELECT tbl_a, {{ tbl_b }}, {{tbl_b}} FROM xtbl_c, tbl_, my.tbl_d9_e, tbl_a.x, tbl_é"),
        ("none", "SELECT 1"),
    )
    found = sorted(map(tuple, tc.template_table_keys(rows).collect()))
    assert found == [("q", "a"), ("q", "b"), ("q", "d9_e"), ("q", "é")]


@pytest.mark.parametrize("bad", ["", None])
def test_empty_template_fails(spark, reference, bad):
    rows = templates(spark, ("q", "SELECT 1"), ("bad", bad))
    for frame in (tc.template_table_keys(rows), tc.render_templates(rows, reference)):
        with pytest.raises(Exception, match="Invalid SQL Expression"):
            frame.collect()
    with pytest.raises(ValueError, match="Invalid SQL Expression"):
        tc.run_reference_query(spark, rows, reference, "bad")


def test_missing_key_list_fails(reference):
    with pytest.raises(ValueError, match="Table list was not initialized."):
        tc.resolve_table_keys(None, reference)


def test_render(spark, reference):
    rows = templates(
        spark,
        ("q", "{{ tbl_ord }} {{tbl_ord}}{{  tbl_cust}} {{ tbl_zzz }} {{ env }} {{ other }} { tbl_ord } é"),
        ("plain", "SELECT 1"),
        ("ends", "{{tbl_ord}}"),
    )
    assert rendered(tc.render_templates(rows, reference, variables={"env": "dev {{ tbl_ord }}"})) == {
        "q": "lake.orders lake.orderslake.$c\\1 {{ tbl_zzz }} dev {{ tbl_ord }} {{ other }} { tbl_ord } é",
        "plain": "SELECT 1",
        "ends": "lake.orders",
    }
    staged = rendered(tc.render_templates(rows, reference, use_stage=True))
    assert staged["ends"] == "stage.orders"
    assert "{{  tbl_cust}}" in staged["q"]  # no stage path: left as it is


def test_unresolved_keys_are_reported(spark, reference):
    rows = templates(spark, ("q", "{{ tbl_ord }} {{ tbl_zzz }}"), ("r", "{{ tbl_cust }}"))
    assert list(map(tuple, tc.unresolved_keys(rows, reference).collect())) == [("q", "zzz")]
    assert sorted(map(tuple, tc.unresolved_keys(rows, reference, use_stage=True).collect())) == [("q", "zzz"), ("r", "cust")]


def test_a_key_listed_twice_resolves_once(spark):
    """A NULL beside a path is no path; two different paths are an error."""
    keys = spark.createDataFrame([("q", "a")], "domain_cd string, table_cd string")
    split = spark.createDataFrame([("a", None, "s"), ("a", "p", None), ("a", "p", "s")], REFERENCE)
    assert [tuple(r) for r in tc.resolve_table_keys(keys, split).collect()] == [("q", "a", "p")]
    assert [tuple(r) for r in tc.resolve_table_keys(keys, split, True).collect()] == [("q", "a", "s")]
    unlike = spark.createDataFrame([("a", "p2", "s"), ("a", "p1", "s")], REFERENCE)
    with pytest.raises(Exception, match="more than one table_path for table key a"):
        tc.resolve_table_keys(keys, unlike).collect()
    assert [tuple(r) for r in tc.resolve_table_keys(keys, unlike, True).collect()] == [("q", "a", "s")]


def test_two_statements_under_one_name_are_an_error(spark):
    stored = spark.createDataFrame([("q", "SELECT 1"), ("q", "SELECT 2")], "domain_cd string, domain_value string")
    with pytest.raises(ValueError, match="more than one template stored under 'q'"):
        tc.run_reference_query(spark, stored, spark.createDataFrame([], REFERENCE), "q")


def test_a_template_every_row_shares(spark, reference):
    """Half of the templates have one code and one text; none is lost."""
    same = spark.range(300).select(F.lit("hot").alias("domain_cd"), F.lit("{{ tbl_ord }}").alias("domain_value"))
    rest = spark.range(300).select(F.concat(F.lit("q"), "id").alias("domain_cd"), F.lit("{{tbl_ord}}").alias("domain_value"))
    out = tc.render_templates(same.unionAll(rest), reference)
    assert out.count() == 600 and out.where("rendered_sql = 'lake.orders'").count() == 600


def test_run_reference_query(spark, reference):
    spark.range(4).createOrReplaceTempView("four_rows")
    reference = spark.createDataFrame([("four", "four_rows", None)], REFERENCE)
    rows = templates(spark, ("q", "SELECT sum(id) AS s FROM {{ tbl_four }} WHERE id > {{ low }}"),
                     ("u", "SELECT * FROM {{ tbl_no }}"))
    assert tc.run_reference_query(spark, rows, reference, "q", variables={"low": "1"}).first()["s"] == 5
    with pytest.raises(ValueError, match="unresolved table keys in 'u': no"):
        tc.run_reference_query(spark, rows, reference, "u")
    with pytest.raises(ValueError, match="no template stored"):
        tc.run_reference_query(spark, rows, reference, "q' OR '1'='1")


# -- graph nodes ------------------------------------------------------------------------------


def test_nodes_collapse_by_key(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "c", None), (2, None, None)], "customer_id int, v string, t int")
    nodes = tc.graph_nodes(rows, ":Customer", "customer_id", order_by=["t"])
    assert sorted(map(tuple, nodes.select("label", "customer_id", "v").collect())) == [(":Customer", 1, "b"), (":Customer", 2, None)]
    assert nodes.columns == ["label", "customer_id", "v", "t"]
    assert tc.graph_nodes(rows.select("customer_id"), "x", "customer_id").count() == 2


def test_a_hot_key_is_one_node(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    nodes = tc.graph_nodes(rows, "N", "k")
    assert nodes.count() == 2001
    assert nodes.where("k = 0").first()["id"] == 2997


def test_null_node_key_fails(spark):
    rows = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="node key k is NULL"):
        tc.graph_nodes(rows, "N", "k").collect()
    with pytest.raises(Exception, match="node key k is NULL"):
        tc.upsert_nodes(rows.where("k = 1"), rows, "k").collect()


def test_upsert_replaces_by_key(spark):
    existing = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([("B", 2), ("c", 3)], "v string, k int")
    assert sorted(map(tuple, tc.upsert_nodes(existing, new, "k").collect())) == [(1, "a"), (2, "B"), (3, "c")]


def test_nodes_with_maps_and_variants(spark):
    rows = spark.range(6).select(
        (F.col("id") % 2).alias("k"), F.create_map(F.lit("n"), "id").alias("m"),
        F.parse_json(F.format_string('{"n": %d}', "id")).alias("v"), F.struct(F.create_map("id", F.lit(1)).alias("x")).alias("s"),
    )
    nodes = tc.graph_nodes(rows, "N", "k").select("k", F.col("m")["n"].alias("n"), F.to_json("v").alias("v")).collect()
    assert sorted(map(tuple, nodes)) == [(0, 4, '{"n":4}'), (1, 5, '{"n":5}')]


def test_upsert_carries_properties_and_collapses_keys(spark):
    existing = spark.createDataFrame([("N", 1, "a"), ("N", 2, "b")], "label string, k int, old string")
    new = spark.createDataFrame([("N", 2, "x", 1), ("N", 2, "y", 3), ("N", 3, "z", 2)], "label string, k int, old string, added int")
    found = tc.upsert_nodes(existing, new, "k", order_by=["added"])
    assert sorted(map(tuple, found.collect())) == [("N", 1, "a", None), ("N", 2, "y", 3), ("N", 3, "z", 2)]
