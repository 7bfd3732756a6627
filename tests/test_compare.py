"""Row comparison: semantics, edge values, repeated keys, plans."""

import random
from collections import Counter, defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import tablecheck as tc
from tablecheck.functions.names import compared_columns
from tablecheck.operators import compare
from tablecheck.sources.scratch import shared_dir
from workload import fixtures as fx

SF_DIR = "/root/testdata/sf0.01"


def dicts(frame):
    return [r.asDict(recursive=True) for r in frame.collect()]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def counts(comparison):
    return {r["column_name"]: r["unmatched_count"] for r in tc.unmatched_counts(comparison).collect()}


def by_columns(values):
    return dict(zip(fx.ORDERS, values))


@pytest.mark.parametrize("options, expected", [
    ({}, [295, 295, 462, 448, 295, 660]),
    ({"on_duplicate": "pair"}, [295, 295, 462, 448, 295, 660]),
    # Two one-sided rows hold a NULL priority; a missing row never matches.
    ({"null_equal": True}, [295, 295, 462, 448, 295, 472]),
    ({"null_equal": True, "on_duplicate": "pair"}, [295, 295, 462, 448, 295, 472]),
])
def test_known_counts_by_key(spark, options, expected):
    comparison = tc.compare_by_key(*fx.orders_pair(spark, SF_DIR), ["o_orderkey"], **options)
    assert counts(comparison) == by_columns(expected)
    assert comparison.count() == 15146


def test_known_counts_all_columns(spark):
    comparison = tc.compare_all_columns(*fx.orders_pair(spark, SF_DIR))
    assert counts(comparison) == by_columns([1651] * 6)
    assert comparison.count() == 15824


def test_known_counts_multiset(spark):
    extra = tc.compare_multiset(*fx.orders_pair(spark, SF_DIR))
    assert extra.where("copies_a > copies_b").count() == 642
    assert extra.where("copies_a < copies_b").count() == 639


EDGE_A = [(1, "x"), (1, "x"), (2, "y"), (3, None)]
EDGE_B = [(1, "x"), (2, "z"), (3, None)]


def test_all_columns_on_the_edge_table(spark):
    result = dicts(tc.compare_all_columns(frame(spark, EDGE_A, "k int, v string"), frame(spark, EDGE_B, "k int, v string")))
    matched = [r for r in result if r["validation_result"] == "match"]
    assert [(r["k_a"], r["copies_a"], r["copies_b"]) for r in matched] == [(1, 2, 1)]
    one_sided = sorted((r["k_a"] or 0, r["k_b"] or 0) for r in result if r["validation_result"] == "unmatch")
    assert one_sided == [(0, 2), (0, 3), (2, 0), (3, 0)]


def test_all_columns_stands_for_every_joined_row(spark):
    rng = random.Random(7)
    rows = lambda n: [(rng.choice([1, 2, None]), rng.choice(["x", None])) for _ in range(n)]
    a, b = rows(30), rows(40)
    joined = [(x, y) for x in a for y in b if None not in x and x == y]
    lone_a = [x for x in a if None in x or x not in b]
    lone_b = [y for y in b if None in y or y not in a]
    expected = Counter(joined) + Counter((x, (None, None)) for x in lone_a) + Counter(((None, None), y) for y in lone_b)
    got = Counter()
    for r in dicts(tc.compare_all_columns(frame(spark, a, "k int, v string"), frame(spark, b, "k int, v string"))):
        weight = max(r["copies_a"], 1) * max(r["copies_b"], 1)
        got[((r["k_a"], r["v_a"]), (r["k_b"], r["v_b"]))] += weight
    assert got == expected


def test_null_keys_stay_one_sided(spark):
    a = frame(spark, [(None, "x"), (None, "x"), (1, "x")], "k int, v string")
    b = frame(spark, [(None, "x"), (1, "x")], "k int, v string")
    result = dicts(tc.compare_by_key(a, b, ["k"]))
    assert Counter(r["validation_result"] for r in result) == {"unmatch": 3, "match": 1}
    paired = dicts(tc.compare_by_key(a, b, ["k"], on_duplicate="pair"))
    assert sum(max(r["copies_a"], r["copies_b"]) for r in paired if r["validation_result"] == "unmatch") == 3


def test_null_equal_joins_null_keys(spark):
    a = frame(spark, [(None, 1, None), (2, 2, "x")], "k int, j int, v string")
    b = frame(spark, [(None, 1, None), (2, 2, "x")], "k int, j int, v string")
    result = dicts(tc.compare_by_key(a, b, ["k", "j"], null_equal=True))
    assert [r["validation_result"] for r in result] == ["match", "match"]


def test_null_equal_missing_row_is_unmatched_even_where_all_is_null(spark):
    a = frame(spark, [(1, None)], "k int, v string")
    b = frame(spark, [], "k int, v string")
    [row] = dicts(tc.compare_by_key(a, b, ["k"], null_equal=True))
    assert (row["k_result"], row["v_result"]) == ("unmatch", "unmatch")


def test_empty_sides(spark):
    a = frame(spark, [(1, "x")], "k int, v string")
    none = a.limit(0)
    assert tc.compare_by_key(none, none, ["k"]).count() == 0
    assert [r["v_result"] for r in dicts(tc.compare_by_key(none, a, ["k"]))] == ["unmatch"]
    assert counts(tc.compare_by_key(none, none, ["k"])) == {"k": 0, "v": 0}


def test_floating_point_edges(spark):
    a = frame(spark, [(1, float("nan")), (2, 0.0), (3, 1.5)], "k int, v double")
    b = frame(spark, [(1, float("nan")), (2, -0.0), (3, 1.25)], "k int, v double")
    result = {r["k_a"]: r["v_result"] for r in dicts(tc.compare_by_key(a, b, ["k"]))}
    assert result == {1: "match", 2: "match", 3: "unmatch"}
    assert tc.compare_multiset(a, b).count() == 2


def test_nested_values(spark):
    ddl = "k int, m map<string,int>, l array<int>, s struct<x:int,y:string>"
    a = frame(spark, [(1, {"p": 1, "q": 2}, [1, None], (1, None)), (2, {"p": 1}, [1], (1, "y"))], ddl)
    b = frame(spark, [(1, {"q": 2, "p": 1}, [1, None], (1, None)), (2, {"p": 2}, [2], (1, "z"))], ddl)
    for mode in ("error", "pair"):
        result = {r["k_a"]: r for r in dicts(tc.compare_by_key(a, b, ["k"], on_duplicate=mode))}
        assert result[1]["validation_result"] == "match"
        assert [result[2][f"{c}_result"] for c in "mls"] == ["unmatch"] * 3


def test_names_that_hold_the_suffix(spark):
    a = frame(spark, [(1, 10, 5)], "k int, order_amount int, x_a int")
    b = frame(spark, [(1, 11, 5)], "k int, order_amount int, x_a int")
    comparison = tc.compare_by_key(a, b, ["k"])
    [row] = dicts(comparison)
    assert (row["order_amount_a"], row["order_amount_b"], row["order_amount_result"]) == (10, 11, "unmatch")
    assert (row["x_a_a"], row["x_a_b"], row["x_a_result"]) == (5, 5, "match")
    assert counts(comparison) == {"order_amount": 1, "k": 0, "x_a": 0}


def test_odd_column_names(spark):
    a = frame(spark, [(1, 2)], "`the key` int, `a.b` int")
    [row] = dicts(tc.compare_by_key(a, a, ["the key"]))
    assert row["a.b_result"] == "match"
    assert counts(tc.compare_all_columns(a, a)) == {"the key": 0, "a.b": 0}


def test_a_wide_table(spark):
    """A few hundred columns: expressions stay shallow and one aggregate counts them all."""
    wide = spark.range(20).select("id", *[(F.col("id") * i).alias(f"c{i}") for i in range(300)])
    other = wide.withColumn("c7", F.lit(-1).cast("bigint"))
    for comparison in (tc.compare_by_key(wide, other, ["id"]), tc.compare_by_key(wide, other, ["id"], True)):
        assert {c: n for c, n in counts(comparison).items() if n} == {"c7": 20}
    assert tc.compare_all_columns(wide, other).count() == 40


def test_columns_of_one_side_are_carried_not_compared(spark):
    a = frame(spark, [(1, "p", "q")], "key_column1 int, key_column2 string, column_a string")
    b = frame(spark, [(1, "p", "r")], "key_column1 int, key_column2 string, column_b string")
    comparison = tc.compare_by_key(a, b, ["key_column1", "key_column2"])
    [row] = dicts(comparison)
    assert (row["column_a_a"], row["column_b_b"], row["validation_result"]) == ("q", "r", "match")


def test_type_rules(spark):
    a = frame(spark, [(1, 5, "7")], "k int, n int, t string")
    b = frame(spark, [(1, 5.0, 7)], "k bigint, n double, t int")
    comparison = tc.compare_by_key(a, b, ["k"])
    [row] = dicts(comparison)
    assert row["n_result"] == "match" and row["t_result"] == row["validation_result"] == "uncompared"
    assert compared_columns(comparison) == ["k", "n"] and tc.unmatched_rows(comparison).count() == 1
    with pytest.raises(ValueError, match="incomparable"):
        tc.compare_by_key(a, b, ["t"])
    with pytest.raises(ValueError, match="incomparable"):
        tc.compare_by_key(a, b, ["n"])
    with pytest.raises(ValueError, match="different type"):
        tc.compare_multiset(a, b)


def test_whole_numbers_are_not_rounded_to_compare(spark):
    a = frame(spark, [(i, n) for i, n in enumerate([9007199254740993, 9007199254740992, 2, None, 2**63 - 1, 0])], "k int, n bigint")
    b = frame(spark, [(i, n) for i, n in enumerate([9007199254740992.0, 9007199254740992.0, 2.5, None, 2.0**63, float("nan")])],
              "k int, n double")
    for x, y in ((a, b), (b, a)):
        flags = [r["n_result"] for r in sorted(tc.compare_by_key(x, y, ["k"], null_equal=True).collect(), key=lambda r: r["k_a"])]
        assert flags == ["unmatch", "match", "unmatch", "match", "unmatch", "unmatch"]


def test_names_that_differ_in_case_follow_the_session(spark):
    a = frame(spark, [(1, 5)], "k int, Amt int")
    b = frame(spark, [(1, 6)], "K int, amt int")
    comparison = tc.compare_by_key(a, b, ["k"])
    assert comparison.columns[:4] == ["k_a", "Amt_a", "k_b", "Amt_b"] and counts(comparison) == {"k": 0, "Amt": 1}
    assert tc.compare_multiset(a, b).count() == 2
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="missing in B: k"):
            tc.compare_by_key(a, b, ["k"])
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_nested_values_by_type(spark):
    """Maps at any depth, microseconds, signed zeros; the checksum agrees with the flags."""
    ddl = "k int, v struct<m:map<string,double>,t:timestamp,l:array<struct<d:double>>>"
    one = [(1, ({"a": 1.0, "b": 0.0}, datetime(2024, 1, 1, 0, 0, 0, 1), [(0.0,)]))]
    same = [(1, ({"b": -0.0, "a": 1.0}, datetime(2024, 1, 1, 0, 0, 0, 1), [(-0.0,)]))]
    later = [(1, ({"a": 1.0, "b": 0.0}, datetime(2024, 1, 1, 0, 0, 0, 2), [(0.0,)]))]
    for rows, verdict in ((same, "match"), (later, "unmatch")):
        x, y = frame(spark, one, ddl), frame(spark, rows, ddl)
        assert dicts(tc.compare_by_key(x, y, ["k"]))[0]["v_result"] == verdict
        assert dicts(tc.checksum_equal(x, y, algo="md5"))[0]["checksums_equal"] == (verdict == "match")


def test_variants_are_carried(spark):
    rows = spark.range(3).select("id", F.parse_json(F.format_string('{"a": %d}', "id")).alias("v"))
    row = tc.compare_by_key(rows, rows, ["id"]).select("v_result", "validation_result").first()
    assert tuple(row) == ("uncompared", "uncompared")
    with pytest.raises(ValueError, match="different type"):
        tc.compare_multiset(rows, rows)


def test_lanes_give_the_order_of_one_sort(spark, monkeypatch):
    """A key numbered in lanes is paired as if it had been sorted in one piece."""
    rng = random.Random(11)
    a = frame(spark, [(rng.choice([1, 1, 1, 2]), rng.randrange(400)) for _ in range(600)], "k int, v int")
    b = frame(spark, [(rng.choice([1, 1, 1, 2]), rng.randrange(400)) for _ in range(600)], "k int, v int")
    plain = sorted(map(repr, tc.compare_by_key(a, b, ["k"], on_duplicate="pair").collect()))
    monkeypatch.setattr("tablecheck.operators.compare.LANE_ROWS", 300)
    assert sorted(map(repr, tc.compare_by_key(a, b, ["k"], on_duplicate="pair").collect())) == plain


def test_wrong_arguments(spark):
    a = frame(spark, [(1, 1)], "k int, v int")
    with pytest.raises(ValueError, match="key columns missing in A: z"):
        tc.compare_by_key(a, a, ["z"])
    with pytest.raises(ValueError, match="at least one key"):
        tc.compare_by_key(a, a, [])
    with pytest.raises(ValueError, match="on_duplicate"):
        tc.compare_by_key(a, a, ["k"], on_duplicate="first")
    with pytest.raises(ValueError, match="clashes"):
        tc.compare_by_key(*[frame(spark, [(1, 1)], "k int, validation int")] * 2, ["k"])
    with pytest.raises(ValueError, match="clashes"):
        tc.compare_multiset(*[frame(spark, [(1, 1)], "k int, copies_a int")] * 2)
    with pytest.raises(ValueError, match="no comparable"):
        tc.compare_all_columns(a, frame(spark, [("x",)], "other string"))


@pytest.mark.parametrize("null_equal", [False, True])
def test_repeated_key_fails(spark, null_equal):
    a = frame(spark, [(1, "x"), (1, "y")], "k int, v string")
    b = frame(spark, [(1, "x")], "k int, v string")
    for left, right, side in ((a, b, "A"), (b, a, "B")):
        with pytest.raises(Exception, match=f"duplicate key in {side}"):
            tc.compare_by_key(left, right, ["k"], null_equal).collect()
    assert dicts(tc.duplicate_keys(a, ["k"])) == [{"k": 1, "row_count": 2}]


def brute_pair(a, b):
    """Joined rows of the pair form, as a multiset of (row in A, row in B)."""
    in_key = lambda rows: {k: Counter(r for r in rows if r[0] == k) for k in {r[0] for r in rows}}
    per_a, per_b = in_key(a), in_key(b)
    sizes = Counter()
    matched = Counter()
    for k in set(per_a) | set(per_b):
        x, y = per_a.get(k, Counter()), per_b.get(k, Counter())
        same = x & y
        matched.update({(r, r): n for r, n in same.items()})
        left, right = x - same, y - same
        sizes[k] = (sum(left.values()), sum(right.values()), len(left), len(right))
    return matched, sizes


@pytest.mark.parametrize("digits", [1, 4])
def test_pair_against_brute_force(spark, monkeypatch, digits):
    """A third of all rows share one key, and a third of those are one repeated row."""
    monkeypatch.setattr(compare, "_LANE_DIGITS", digits)
    rng = random.Random(11)

    def rows(n, shift):
        hot = [(0, rng.randrange(200) + shift, "h") for _ in range(n // 3)]
        copies = [(0, -1, "same")] * (n // 9)
        return hot + copies + [(rng.randrange(1, 60), rng.randrange(4), rng.choice("ab")) for _ in range(n // 2)]

    a, b = rows(900, 0), rows(1000, 30)
    ddl = "k int, v int, t string"
    comparison = tc.compare_by_key(
        frame(spark, a, ddl).repartition(7), frame(spark, b, ddl).repartition(5), ["k"], on_duplicate="pair"
    )
    result = dicts(comparison)
    side = lambda r, s: tuple(r[f"{c}_{s}"] for c in ("k", "v", "t"))
    held = {s: Counter() for s in "ab"}
    matched = Counter()
    paired = defaultdict(lambda: [0, 0])
    for r in result:
        assert r["copies_a"] == r["copies_b"] or 0 in (r["copies_a"], r["copies_b"])
        for s in "ab":
            if r[f"copies_{s}"]:
                held[s][side(r, s)] += r[f"copies_{s}"]
        if r["copies_a"] and r["copies_b"]:
            assert r["k_a"] == r["k_b"]
            if r["validation_result"] == "match":
                matched[(side(r, "a"), side(r, "b"))] += r["copies_a"]
            else:
                paired[r["k_a"]][0] += 1
    assert held == {"a": Counter(a), "b": Counter(b)}  # nothing lost, nothing added
    expected, sizes = brute_pair(a, b)
    assert matched == expected
    for k, (_, _, distinct_a, distinct_b) in sizes.items():
        assert paired[k][0] == min(distinct_a, distinct_b)


def test_pair_is_the_plain_join_where_keys_are_unique(spark):
    a, b = fx.orders_pair(spark, SF_DIR)
    plain = tc.compare_by_key(a, b, ["o_orderkey"])
    paired = tc.compare_by_key(a, b, ["o_orderkey"], on_duplicate="pair").drop("copies_a", "copies_b")
    assert tc.compare_multiset(plain, paired).isEmpty()


def test_multiset_against_counter(spark):
    rng = random.Random(3)
    rows = lambda n: [(rng.choice([None, 1, 2]), rng.choice(["x", None])) for _ in range(n)]
    a, b = rows(50), rows(60)
    got = {(r["k"], r["v"]): (r["copies_a"], r["copies_b"]) for r in dicts(
        tc.compare_multiset(frame(spark, a, "k int, v string"), frame(spark, b, "k int, v string")))}
    ca, cb = Counter(a), Counter(b)
    assert got == {r: (ca[r], cb[r]) for r in set(a) | set(b) if ca[r] != cb[r]}


def test_unmatched_rows_of_chosen_columns(spark):
    a = frame(spark, [(1, "x", 1), (2, "y", 2)], "k int, v string, n int")
    b = frame(spark, [(1, "x", 9), (2, "z", 2)], "k int, v string, n int")
    comparison = tc.compare_by_key(a, b, ["k"])
    assert tc.unmatched_rows(comparison).count() == 2
    [row] = dicts(tc.unmatched_rows(comparison, ["k", "v"]))
    assert (row["k_a"], row["validation_result"]) == (2, "unmatched")
    [row] = dicts(tc.drill_down(comparison, "n"))
    assert (row["n_a"], row["n_b"]) == (1, 9)
    with pytest.raises(ValueError, match="not part"):
        tc.drill_down(comparison, "validation")


# -- plans ---------------------------------------------------------------------------------


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def initial(frame):
    """The plan before adaptive execution, one operator per line."""
    return [line.strip(" :+-*") for line in plan_of(frame).splitlines()]


def ops(frame, name):
    return [line for line in initial(frame) if line.startswith(name)]


@pytest.mark.parametrize("null_equal", [False, True])
def test_keyed_plan_is_one_join_with_one_shuffle_per_side(spark, null_equal):
    orders = fx.table(spark, SF_DIR, "orders")
    comparison = tc.compare_by_key(orders, orders, ["o_orderkey"], null_equal)
    assert len(ops(comparison, "SortMergeJoin")) == 1 and len(ops(comparison, "Sort [")) == 2
    # the keys were counted before, so the plan is the join alone
    assert len(ops(comparison, "Exchange")) == 2
    assert not ops(comparison, "HashAggregate") and not ops(comparison, "Window")


@pytest.mark.parametrize("null_equal", [False, True])
def test_null_keys_go_round_the_join(spark, null_equal):
    orders = fx.table(spark, SF_DIR, "orders")
    path = f"{shared_dir(spark)}/orders-with-a-null-key"
    without = orders.limit(1).withColumn("o_orderkey", F.lit(None).cast("bigint"))
    orders.limit(100).unionByName(without).write.mode("overwrite").parquet(path)
    lone = spark.read.parquet(path)
    comparison = tc.compare_by_key(lone, lone, ["o_orderkey"], null_equal)
    # with NULL equal, the NULL keys have a join of their own, found by row-group statistics
    assert len(ops(comparison, "SortMergeJoin")) == (2 if null_equal else 1)
    assert sum("PushedFilters: [IsNull(o_orderkey)]" in line for line in initial(comparison)) >= 2
    assert comparison.count() == (101 if null_equal else 102)


def test_a_hot_repeated_key_fails_before_any_join(spark):
    """A key on a third of both sides: the job that counts keys ends the comparison."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    hot = spark.range(0, 30_000, 1, 4).select(key.alias("k"), "id")
    planned = []
    join = type(hot).join
    try:
        type(hot).join = lambda self, *args, **options: planned.append(args) or join(self, *args, **options)
        with pytest.raises(ValueError, match="duplicate key in A: {\"k_a\":0}"):
            tc.compare_by_key(hot, hot, ["k"])
    finally:
        type(hot).join = join
    assert not planned


def test_bucketed_tables_with_null_equal_compare_without_a_shuffle(spark, schema):
    orders = fx.table(spark, SF_DIR, "orders")
    for name in "ab":
        orders.write.bucketBy(8, "o_orderkey").sortBy("o_orderkey").saveAsTable(f"{schema}.{name}")
    comparison = tc.compare_by_key(spark.table(f"{schema}.a"), spark.table(f"{schema}.b"), ["o_orderkey"], null_equal=True)
    assert not ops(comparison, "Exchange")
    assert counts(comparison) == by_columns([0] * 6)


@pytest.mark.parametrize("null_equal", [False, True])
def test_a_widened_key_adds_no_shuffle(spark, null_equal):
    orders = fx.table(spark, SF_DIR, "orders")
    narrow = orders.withColumn("o_orderkey", F.col("o_orderkey").cast("int"))
    comparison = tc.compare_by_key(narrow, orders, ["o_orderkey"], null_equal)
    assert len(ops(comparison, "Exchange")) == 2
    assert not [c for c in comparison.columns if c.startswith("__")]
    assert counts(comparison) == by_columns([0] * 6)


def test_bucketed_tables_compare_without_a_shuffle(spark, schema):
    orders = fx.table(spark, SF_DIR, "orders")
    for name in "ab":
        orders.write.bucketBy(8, "o_orderkey").sortBy("o_orderkey").saveAsTable(f"{schema}.{name}")
    comparison = tc.compare_by_key(spark.table(f"{schema}.a"), spark.table(f"{schema}.b"), ["o_orderkey"])
    assert not ops(comparison, "Exchange")


def test_audit_plan_is_one_join_and_one_aggregate(spark):
    comparison = tc.compare_by_key(*fx.orders_pair(spark, SF_DIR), ["o_orderkey"])
    audit = tc.column_mismatch_audit(comparison, "a", "b", "2024-01-01")
    assert len(ops(audit, "SortMergeJoin")) == 1
    assert len(ops(audit, "HashAggregate")) == 2  # partial and final


def test_multiset_plan_is_one_combined_shuffle(spark):
    extra = tc.compare_multiset(*fx.lineitem_pair(spark, SF_DIR))
    assert len(ops(extra, "Exchange")) == 1
    assert len(ops(extra, "HashAggregate")) == 2
    assert not ops(extra, "SortMergeJoin")


def test_all_columns_plan_has_no_join(spark):
    comparison = tc.compare_all_columns(*fx.orders_pair(spark, SF_DIR))
    assert len(ops(comparison, "Exchange")) == 1
    assert "Join" not in plan_of(comparison)


def test_drill_down_reads_only_what_it_needs(spark):
    orders = fx.table(spark, SF_DIR, "orders").select("o_orderkey", "o_totalprice")
    comparison = tc.compare_by_key(orders, orders, ["o_orderkey"])
    assert "o_orderpriority" not in plan_of(tc.drill_down(comparison, "o_totalprice"))
