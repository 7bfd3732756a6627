"""Checksums, logs, file statistics, samples, clones, equality checks, schema diffs."""

import json
import os
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tablecheck as tc
from tablecheck.operators import order as order_module
from tablecheck.operators import sample as sample_module
from tablecheck.operators.clone import spec_from_rows
from tablecheck.sources import scratch, sinks
from tablecheck.sources.tables import replace_table
from workload import fixtures as fx

SF_DIR = "/root/testdata/sf0.01"


def dicts(frame):
    return [r.asDict(recursive=True) for r in frame.collect()]


# -- checksums ---------------------------------------------------------------------------


def test_crc32_against_zlib(spark):
    customer = fx.table(spark, SF_DIR, "customer").select("c_custkey", "c_name", "c_mktsegment")
    texts = [",".join(map(str, r)) for r in customer.collect()]
    [row] = dicts(tc.table_checksum(customer, "crc32", "plain"))
    assert row["checksum"] == sum(zlib.crc32(t.encode()) for t in texts)
    assert row["row_count"] == len(texts)


def test_row_text_forms(spark):
    ddl = "a string, b string, c string"
    rows = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a,b", "c", None), ("a", "b,c", None),
                                  ("\\N", "x", "y"), (None, "x", "y"), ("a\\", "b", "c"), ("a", "\\b", "c")], ddl)
    plain = [r["checksum"] for r in dicts(tc.row_checksum(rows, form="plain"))]
    assert plain[0] == plain[1] and plain[2] == plain[3]
    canonical = [r["checksum"] for r in dicts(tc.row_checksum(rows))]
    assert len(set(canonical)) == len(canonical)


def test_canonical_text_is_one_to_one(spark):
    """Random rows over the characters the text treats specially: as many texts as rows."""
    rng = random.Random(17)
    word = lambda: rng.choice([None, "", *["".join(rng.choices(",\\\\N\n\u00e9", k=rng.randrange(1, 4))) for _ in range(3)]])
    rows = {(word(), word(), word()) for _ in range(3000)}
    frame = spark.createDataFrame(sorted(rows, key=repr), "a string, b string, c string")
    sums = tc.row_checksum(frame).agg(F.count_distinct("checksum").alias("n")).first()["n"]
    assert sums == len(rows)


def test_equal_values_have_equal_text(spark):
    ddl = "d double, m map<string,int>, l array<string>, s struct<x:int,y:int>, b binary, t timestamp"
    when = __import__("datetime").datetime(2024, 1, 1)
    one = spark.createDataFrame([(0.0, {"p": 1, "q": 2}, ["a,b", None], (1, None), b"\x01", when)], ddl)
    two = spark.createDataFrame([(-0.0, {"q": 2, "p": 1}, ["a,b", None], (1, None), b"\x01", when)], ddl)
    other = spark.createDataFrame([(0.0, {"p": 1, "q": 2}, ["a", "b", None], (1, None), b"\x01", when)], ddl)
    [same] = dicts(tc.checksum_equal(one, two))
    assert same["checksums_equal"]
    [differs] = dicts(tc.checksum_equal(one, other))
    assert not differs["checksums_equal"]


def test_checksum_ignores_row_order_and_sees_copies(spark):
    lines = fx.table(spark, SF_DIR, "lineitem")
    [row] = dicts(tc.checksum_equal(lines, lines.repartition(5)))
    assert row["checksums_equal"] and row["rows_a"] == row["rows_b"] == 60000
    [row] = dicts(tc.checksum_equal(lines, lines.unionAll(lines.limit(1))))
    assert not row["checksums_equal"]


def test_checksum_of_nothing_and_of_unknown_kind(spark):
    none = spark.createDataFrame([], "x int")
    [row] = dicts(tc.table_checksum(none))
    assert (row["row_count"], row["checksum"]) == (0, 0)
    with pytest.raises(ValueError, match="algorithm"):
        tc.table_checksum(none, "sha9")
    with pytest.raises(ValueError, match="form"):
        tc.table_checksum(none, form="odd")


# -- transaction logs and files -------------------------------------------------------------


def write_commit(folder, version, *actions):
    with open(os.path.join(folder, f"{version:020d}.json"), "w") as out:
        out.writelines(json.dumps(a) + "\n" for a in actions)


def add(path, size=1):
    return {"add": {"path": path, "size": size, "dataChange": True}}


def remove(path):
    return {"remove": {"path": path, "deletionTimestamp": 5}}


def paths(frame):
    return sorted(r["file_path"] for r in frame.select("file_path").collect())


@pytest.fixture
def log_folder(tmp_path):
    folder = tmp_path / "_delta_log"
    folder.mkdir()
    return str(folder)


def test_log_replay(spark, tmp_path, log_folder):
    write_commit(log_folder, 0, {"protocol": {"minReaderVersion": 1}}, add("f1"), add("f2"))
    write_commit(log_folder, 1, {"commitInfo": {}}, remove("f1"), add("f3", 9))
    log = tc.read_log(spark, str(tmp_path))
    assert paths(tc.manifest_added(log)) == ["f1", "f2", "f3"]
    assert {r["file_path"]: r["size"] for r in dicts(tc.manifest_live(log))} == {"f2": 1, "f3": 9}


def put_parquet(spark, tmp_path, target, rows, ddl):
    staging = tmp_path / f"staging-{len(os.listdir(tmp_path))}"
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(str(staging))
    [part] = [n for n in os.listdir(staging) if n.endswith(".parquet")]
    os.makedirs(os.path.dirname(target), exist_ok=True)
    with open(staging / part, "rb") as data, open(target, "wb") as out:
        out.write(data.read())


ACTIONS = "add struct<path:string,size:bigint>, remove struct<path:string>"


def test_log_with_side_files(spark, tmp_path, log_folder):
    put_parquet(spark, tmp_path, f"{log_folder}/_sidecars/one.parquet", [(("f1", 1), None), (("f9", 2), None)], ACTIONS)
    put_parquet(spark, tmp_path, f"{log_folder}/{1:020d}.checkpoint.0f-a.parquet", [(None, None, ("one.parquet",)), (("f7", 3), None, None)],
                f"{ACTIONS}, sidecar struct<path:string>")
    write_commit(log_folder, 2, add("f2", 5), remove("f9"))
    log = tc.read_log(spark, str(tmp_path))
    assert {r["file_path"]: r["size"] for r in dicts(tc.manifest_live(log))} == {"f1": 1, "f2": 5, "f7": 3}


def test_log_with_parts(spark, tmp_path, log_folder):
    write_commit(log_folder, 4, add("f4", 4))
    put_parquet(spark, tmp_path, f"{log_folder}/{3:020d}.checkpoint.{1:010d}.{2:010d}.parquet", [(("f1", 1), None)], ACTIONS)
    with pytest.raises(ValueError, match="checkpoint 3 .* lacks parts"):
        tc.read_log(spark, str(tmp_path))
    put_parquet(spark, tmp_path, f"{log_folder}/{3:020d}.checkpoint.{2:010d}.{2:010d}.parquet", [(("f2", 2), None)], ACTIONS)
    assert paths(tc.manifest_live(tc.read_log(spark, str(tmp_path)))) == ["f1", "f2", "f4"]


def put_pointer(log_folder, text):
    with open(os.path.join(log_folder, "_last_checkpoint"), "w") as out:
        out.write(text)


@pytest.mark.parametrize("parts", [None, 2])
def test_pointer_names_the_checkpoint(spark, tmp_path, log_folder, parts):
    """A later checkpoint that was never finished is not looked at; a pointer that cannot be
    followed is no pointer."""
    names = [f"{3:020d}.checkpoint.{i:010d}.{parts:010d}.parquet" for i in (1, 2)] if parts else [f"{3:020d}.checkpoint.parquet"]
    for name in names:
        put_parquet(spark, tmp_path, f"{log_folder}/{name}", [((f"of {name}", 1), None)], ACTIONS)
    put_parquet(spark, tmp_path, f"{log_folder}/{5:020d}.checkpoint.{1:010d}.{2:010d}.parquet", [(("no", 1), None)], ACTIONS)
    write_commit(log_folder, 4, add("f4"))
    held = sorted([*(f"of {n}" for n in names), "f4"])
    put_pointer(log_folder, json.dumps({"version": 3, "size": 1} | ({"parts": parts} if parts else {})))
    assert paths(tc.read_log(spark, str(tmp_path))) == held
    for text in ("", "{", json.dumps({"version": 2})):
        put_pointer(log_folder, text)
        with pytest.raises(ValueError, match="checkpoint 5 .* lacks parts"):
            tc.read_log(spark, str(tmp_path))


@pytest.mark.parametrize("pointed", [True, False])
def test_json_checkpoint(spark, tmp_path, log_folder, pointed):
    name = f"{2:020d}.checkpoint.80a0-1.json"
    put_parquet(spark, tmp_path, f"{log_folder}/_sidecars/a%20b.parquet".replace("%20", "-"), [(("side%20file", 4), None)], ACTIONS)
    with open(os.path.join(log_folder, name), "w") as out:
        out.writelines(json.dumps(a) + "\n" for a in (
            {"checkpointMetadata": {"version": 2}}, {"sidecar": {"path": "a-b.parquet"}}, add("own"), remove("gone")))
    if pointed:
        put_pointer(log_folder, json.dumps({"version": 2, "v2Checkpoint": {"path": name, "sidecarFiles": []}}))
    write_commit(log_folder, 3, add("f3"), remove("own"))
    assert paths(tc.manifest_live(tc.read_log(spark, str(tmp_path)))) == ["f3", "side file"]


def test_log_paths_are_uris(spark, tmp_path, log_folder):
    write_commit(log_folder, 0, add("a%20b+c%25.parquet"), add("100%.parquet"), add("%C3%A4%2Fx"), add("plain"))
    assert paths(tc.read_log(spark, str(tmp_path))) == ["100%.parquet", "a b+c%.parquet", "plain", "ä/x"]


def test_log_replay_with_a_checkpoint(spark, tmp_path, log_folder):
    """Commits 0 and 1 were cleaned up; the checkpoint holds their outcome."""
    checkpoint = spark.createDataFrame(
        [(("f2", 1), None), (("f3", 9), None), (None, ("f1",))],
        "add struct<path:string,size:bigint>, remove struct<path:string>",
    )
    staging = str(tmp_path / "staging")
    checkpoint.coalesce(1).write.parquet(staging)
    [part] = [n for n in os.listdir(staging) if n.endswith(".parquet")]
    with open(os.path.join(staging, part), "rb") as data:
        content = data.read()
    with open(os.path.join(log_folder, f"{1:020d}.checkpoint.parquet"), "wb") as out:
        out.write(content)
    write_commit(log_folder, 1, remove("f1"), add("f3", 9))
    write_commit(log_folder, 2, remove("f2"), add("f4"))
    write_commit(log_folder, 3, add("f1"))
    log = tc.read_log(spark, str(tmp_path))
    assert paths(tc.manifest_live(log)) == ["f1", "f3", "f4"]
    assert paths(tc.manifest_added(log)) == ["f1", "f2", "f3", "f4"]


def test_manifest_diff_sides(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",)], "file_path string")
    b = spark.createDataFrame([("y",), ("z",)], "file_path string")
    assert sorted(map(tuple, tc.manifest_diff(a, b).collect())) == [("x", "a"), ("z", "b")]


def test_file_stats_against_the_file_system(spark):
    sizes = [os.path.getsize(os.path.join(SF_DIR, n)) for n in os.listdir(SF_DIR)]
    [row] = dicts(tc.file_stats(spark, SF_DIR))
    assert row == {"num_files": len(sizes), "size_in_bytes": sum(sizes), "partition_columns": []}
    [row] = dicts(tc.files_equal(spark, SF_DIR, SF_DIR))
    assert row["files_equal"]
    [row] = dicts(tc.files_equal(spark, SF_DIR, "/root/testdata/sf0.001"))
    assert not row["files_equal"]


def test_partition_columns_are_part_of_the_statistics(spark, tmp_path):
    path = str(tmp_path / "env=prod" / "nation")  # folders above the table do not count
    nation = fx.table(spark, SF_DIR, "nation").withColumn("half", F.col("n_nationkey") % 2)
    nation.repartition(1).write.partitionBy("n_regionkey", "half").parquet(path)
    [row] = dicts(tc.file_stats(spark, path))
    assert row["partition_columns"] == ["n_regionkey", "half"]
    assert row["num_files"] == nation.select("n_regionkey", "half").distinct().count()


# -- samples -----------------------------------------------------------------------------------


def test_contents_of_files(spark, tmp_path):
    """Names and order of rows do not count, copies of files do, and one value is enough to differ."""
    def put(name, parts):
        for i, rows in enumerate(parts):
            spark.createDataFrame(rows, "a int, b string").coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        return str(tmp_path / name)

    one = put("one", [[(1, "x"), (2, None)], [(3, "z")], [(3, "z")]])
    same = put("same", [[(3, "z")], [(2, None), (1, "x")], [(3, "z")]])
    fewer = put("fewer", [[(3, "z")], [(2, None), (1, "x")]])
    other = put("other", [[(1, "x"), (2, "")], [(3, "z")], [(3, "z")]])
    found = {n: dicts(tc.file_contents_equal(spark, one, p))[0] for n, p in (("same", same), ("fewer", fewer), ("other", other))}
    assert found["same"] == {"files_a": 3, "files_b": 3, "only_in_a": 0, "only_in_b": 0, "contents_equal": True}
    assert found["fewer"] == {"files_a": 3, "files_b": 2, "only_in_a": 1, "only_in_b": 0, "contents_equal": False}
    assert found["other"] == {"files_a": 3, "files_b": 3, "only_in_a": 1, "only_in_b": 1, "contents_equal": False}
    assert sorted(r["row_count"] for r in tc.file_checksums(spark, one).collect()) == [1, 1, 2]


def test_a_checkpoint_fixture_is_written_by_several_tasks(spark):
    log = tc.read_log(spark, fx.written_log(spark, SF_DIR))
    folder = f"{fx.written_log(spark, SF_DIR)}/_delta_log"
    parts = [n for n in os.listdir(folder) if ".checkpoint." in n and n.endswith(".parquet")]
    assert len(parts) == fx.CHECKPOINT_FILES and log.count() > 0


# -- order ---------------------------------------------------------------------------------------


def rows_per_task(spark, frame):
    """Rows that each task of the last stage gives out."""
    return [r[0] for r in frame.groupBy(F.spark_partition_id().alias("p")).count().select("count").collect()]


def test_copies_of_one_row_are_dealt_out(spark, monkeypatch):
    """A third of the rows are one row; the limit falls among them."""
    monkeypatch.setattr(order_module, "CHUNK", 500)
    row = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    table = spark.range(0, 300_000, 1, 8).select(row.alias("k"), F.lit("same").alias("v"))
    limit = 60_000
    cut = tc.sample_pair(table, table, ["k"], 1_000, row_limit=limit).a
    smaller = sum(1 for i in range(7) if i % 3)
    assert {r["k"]: r["n"] for r in cut.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}[7] == limit - smaller
    tasks = rows_per_task(spark, cut)
    assert sum(tasks) == limit and max(tasks) < limit / 2


def test_ten_million_copies(spark):
    table = spark.range(0, 10_000_000, 1, 8).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    cut = tc.sample_pair(table, table, ["k"], 5, row_limit=9_000_000).a
    tasks = rows_per_task(spark, cut)
    assert sum(tasks) == 9_000_000 and max(tasks) < 3_000_000


@pytest.mark.parametrize("chunk", [2, 65_536])
def test_positions(spark, monkeypatch, chunk):
    monkeypatch.setattr(order_module, "CHUNK", chunk)
    rows = [(i % 7, None if i % 5 == 0 else f"v{i % 3}") for i in range(500)]
    table = spark.createDataFrame(rows, "k int, v string").repartition(4)
    placed = sorted((r["position"], r["k"], r["v"]) for r in tc.with_position(table, [F.desc("k"), "v"]).collect())
    expected = sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1] or ""))
    assert placed == [(i, *r) for i, r in enumerate(expected, 1)]
    assert tc.with_position(table.limit(0), ["k"]).count() == 0
    with pytest.raises(ValueError, match="already"):
        tc.with_position(table, ["k"], name="v")


# -- samples and clones ----------------------------------------------------------------------------


def test_sampled_sides_hold_the_same_keys(spark):
    a, b = fx.orders_pair(spark, SF_DIR)
    pair = tc.sample_pair(a, b, ["o_custkey"], 25)
    keys = sorted(r[0] for r in pair.keys.collect())
    assert keys == sorted(r[0] for r in a.select("o_custkey").distinct().collect())[:25]
    for full, cut in ((a, pair.a), (b, pair.b)):
        assert tc.compare_multiset(cut, full.where(F.col("o_custkey").isin(keys))).isEmpty()
    capped = tc.sample_pair(a, b, ["o_custkey"], 25, row_limit=10)
    assert capped.a.count() == capped.b.count() == 10


@pytest.mark.parametrize("limit", [1, 37, 500, 100_000])
def test_a_large_sample_is_cut_without_one_big_task(spark, monkeypatch, limit):
    monkeypatch.setattr(sample_module, "RANGE_ROWS", 20)
    lines = fx.table(spark, SF_DIR, "lineitem")
    keys = ["l_suppkey", "l_linenumber"]
    expected = sorted(map(tuple, lines.select(*keys).distinct().collect()))[:limit]
    cut = sample_module.sample_keys(lines, keys, limit)
    assert sorted(map(tuple, cut.collect())) == expected
    assert "TakeOrdered" not in cut._jdf.queryExecution().executedPlan().toString()


def test_a_row_limit_is_no_top_k_of_one_task(spark):
    """Repeated rows and NULLs sort like any other; equal rows may stand in for each other."""
    rows = [(1, None), (2, "x"), (2, "x"), (2, None), (1, "b"), (3, "c")] * 20
    a = spark.createDataFrame(rows, "k int, v string")
    for limit in (1, 45, 80, 120, 500):
        cut = tc.sample_pair(a, a, ["k"], 3, row_limit=limit).a
        plan = cut._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrdered" not in plan and "GlobalLimit" not in plan
        expected = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or ""))[:limit]
        assert sorted(map(tuple, cut.collect()), key=repr) == sorted(expected, key=repr)


def test_sample_skips_null_keys(spark):
    a = spark.createDataFrame([(None, 1), (1, 2), (2, 3)], "k int, v int")
    pair = tc.sample_pair(a, a, [" k ".strip()], 5)
    assert sorted(r["k"] for r in dicts(pair.a)) == [1, 2]


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], "` col1 ` int, ` col2 ` int")
    assert tc.normalize_columns(df).columns == ["col1", "col2"]
    with pytest.raises(ValueError, match="collide after trimming: x"):
        tc.normalize_columns(spark.createDataFrame([(1, 2)], "`x` int, ` x` int"))


def test_prepare_pair_recreates_only_a_stale_clone(spark, schema):
    orders = fx.table(spark, SF_DIR, "orders")
    main, clone = f"{schema}.main", f"{schema}.main_clone"
    orders.write.saveAsTable(main)
    first = tc.prepare_pair(spark, main, clone, ["o_custkey"], 10)
    assert first.recreated and tc.data_files_equal(spark, main, clone)
    again = tc.prepare_pair(spark, main, clone, ["o_custkey"], 20, bucket_by=(4, ["o_custkey"]))
    assert not again.recreated
    left, right = spark.table(again.main), spark.table(again.clone)
    assert left.select("o_custkey").distinct().count() == 20
    assert tc.assert_tables_equal(left, right)
    assert not spark.catalog.tableExists(f"{schema}.key_main")
    stale = tc.prepare_pair(spark, main, clone, ["o_custkey"], 5, recreate=False, row_limit=3)
    assert not stale.recreated and spark.table(stale.main).count() == 3


# -- clones --------------------------------------------------------------------------------------


def test_clone_keeps_partitioning_and_pushes_its_filter(spark, schema):
    orders = fx.table(spark, SF_DIR, "orders")
    orders.write.partitionBy("o_orderstatus").saveAsTable(f"{schema}.src")
    assert tc.clone_full(spark, f"{schema}.src", f"{schema}.full") == 15000
    assert [c.name for c in spark.catalog.listColumns(f"{schema}.full") if c.isPartition] == ["o_orderstatus"]
    assert tc.assert_tables_equal(spark.table(f"{schema}.full"), spark.table(f"{schema}.src"))
    rows = tc.clone_filtered(spark, f"{schema}.src", f"{schema}.some", "o_orderstatus = 'F' AND o_orderkey < 100")
    kept = orders.where("o_orderstatus = 'F' AND o_orderkey < 100")
    assert rows == kept.count() == spark.table(f"{schema}.some").count()
    assert tc.clone_filtered(spark, f"{schema}.src", f"{schema}.all") == 15000


def test_clone_tables_from_a_spec(spark, schema, tmp_path):
    fx.table(spark, SF_DIR, "nation").write.saveAsTable(f"{schema}.nation")
    fx.table(spark, SF_DIR, "region").write.saveAsTable(f"{schema}.region")
    spec = {"tables": [
        {"table": "nation", "options": [{"key": "copy_method", "value": "select_into"},
                                        {"key": "filter_condition", "value": "n_regionkey = 1"}]},
        {"table": "region", "options": [{"key": "copy_method", "value": "Deep clone"}]},
    ]}
    file = tmp_path / "spec.yml"
    file.write_text(json.dumps(spec))  # JSON is YAML too
    assert tc.read_clone_spec(spark, str(file)) == spec
    rows = spark.createDataFrame(
        [(t["table"], [(o["key"], o["value"]) for o in t["options"]]) for t in spec["tables"]],
        "table string, options array<struct<key:string,value:string>>",
    )
    assert spec_from_rows(rows) == spec
    report = dicts(tc.clone_tables(spark, spec, schema, target_schema=schema))
    assert report == [
        {"source": f"{schema}.nation", "target": f"{schema}.{schema}_nation", "method": "select_into", "rows": 5},
        {"source": f"{schema}.region", "target": f"{schema}.{schema}_region", "method": "Deep clone", "rows": 5},
    ]
    assert dicts(tc.clone_tables(spark, {"tables": []}, schema)) == []


@pytest.mark.parametrize("options", [[], [{"key": "copy_method", "value": "shallow"}]])
def test_unknown_copy_method_fails_before_any_copy(spark, schema, options):
    fx.table(spark, SF_DIR, "nation").write.saveAsTable(f"{schema}.nation")
    good = {"table": "nation", "options": [{"key": "copy_method", "value": "Deep clone"}]}
    with pytest.raises(ValueError, match="unsupported copy method"):
        tc.clone_tables(spark, {"tables": [good, {"table": "other", "options": options}]}, schema, schema)
    assert not spark.catalog.tableExists(f"{schema}.{schema}_nation")


def test_a_failed_replacement_leaves_the_table(spark, schema):
    table = f"{schema}.t"
    assert replace_table(spark.range(5), table) == 5
    broken = spark.range(3).select(F.when(F.col("id") > 1, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        replace_table(broken, table)
    assert spark.table(table).count() == 5
    assert replace_table(spark.table(table).where("id > 2"), table) == 2  # may read what it replaces
    assert sorted(r["id"] for r in spark.table(table).collect()) == [3, 4]
    with pytest.raises(ValueError, match="onto itself"):
        tc.clone_full(spark, table, table)
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        tc.clone_full(spark, f"{schema}.missing", f"{schema}.copy")


# -- equality ---------------------------------------------------------------------------------------


def test_assert_tables_equal(spark):
    region = fx.table(spark, SF_DIR, "region")
    backwards = region.orderBy(F.desc("r_regionkey"))
    assert tc.assert_tables_equal(region, backwards)
    renamed = region.withColumn("r_name", F.when(F.col("r_regionkey") == 3, "MOON").otherwise(F.col("r_name")))
    one_row_twice = region.unionAll(region.where("r_regionkey = 0"))
    for other in (renamed, one_row_twice, region.where("r_regionkey <> 1"), region.limit(0)):
        with pytest.raises(ValueError, match="Data in dataframe and after_table are different."):
            tc.assert_tables_equal(region, other)
    with pytest.raises(ValueError, match="Missing expected column: r_name"):
        tc.assert_tables_equal(region, region.drop("r_name"))
    with pytest.raises(ValueError, match="Dataframe is empty"):
        tc.assert_tables_equal(region.limit(0), region)
    for pair in ((region, None), (None, region)):
        with pytest.raises(ValueError, match="Dataframe cannot be None"):
            tc.assert_tables_equal(*pair)


def test_a_failed_rename_brings_the_old_table_back(spark, schema, monkeypatch):
    from tablecheck.sources import tables

    name = f"{schema}.kept"
    replace_table(spark.range(4), name)
    rename = tables._rename

    def failing(session, old, new):
        if new == name and "_new_" in old:
            raise RuntimeError("no rename today")
        rename(session, old, new)

    monkeypatch.setattr(tables, "_rename", failing)
    with pytest.raises(RuntimeError, match="no rename today"):
        replace_table(spark.range(9), name)
    assert spark.table(name).count() == 4


def test_a_spec_that_is_no_json_names_the_missing_library(spark, tmp_path):
    (tmp_path / "spec.yml").write_text("tables:\n- table: t\n")
    try:
        import yaml  # noqa: F401
    except ImportError:
        with pytest.raises(ImportError, match="yaml"):
            tc.read_clone_spec(spark, str(tmp_path / "spec.yml"))


def test_equality_counts_copies(spark):
    rng = random.Random(5)
    a = [(rng.randrange(3),) for _ in range(40)]
    b = [(rng.randrange(3),) for _ in range(35)]
    [row] = dicts(tc.tables_equal(spark.createDataFrame(a, "x int"), spark.createDataFrame(b, "x int")))
    assert row["only_in_a"] == sum((Counter(a) - Counter(b)).values())
    assert row["only_in_b"] == sum((Counter(b) - Counter(a)).values())


# -- schemas -----------------------------------------------------------------------------------------


def test_schema_diff_kinds(spark):
    field = T.StructField
    a = T.StructType([field("same", T.LongType()), field("kind", T.LongType()), field("null", T.LongType()),
                      field("meta", T.LongType()), field("left", T.LongType())])
    b = T.StructType([field("meta", T.LongType(), True, {"x": 1}), field("same", T.LongType()),
                      field("null", T.LongType(), False), field("kind", T.StringType(), False),
                      field("right", T.ArrayType(T.LongType()))])
    diff = dicts(tc.schema_diff(spark.createDataFrame([], a), spark.createDataFrame([], b)))
    assert [(r["column_name"], r["side"], r["kind"]) for r in diff] == [
        ("kind", "both", "type"), ("kind", "both", "nullable"), ("null", "both", "nullable"),
        ("meta", "both", "metadata"), ("left", "a", "only_a"), ("right", "b", "only_b"),
    ]
    assert diff[0]["type_a"] == "bigint" and diff[0]["type_b"] == "string"
    assert diff[-1]["type_b"] == "array<bigint>" and diff[-1]["nullable_a"] is None


def test_schema_diff_of_equal_tables_is_empty(spark):
    a = spark.createDataFrame([("value1", "value2")], "key_column1 string, key_column2 string")
    assert tc.schema_diff(a, a).isEmpty()
    assert tc.schema_diff(a, a.select("key_column2", "key_column1")).isEmpty()


def test_schema_diffs_of_many_pairs(spark):
    orders, customer = fx.table(spark, SF_DIR, "orders"), fx.table(spark, SF_DIR, "customer")
    diff = tc.schema_diffs([("same", orders, orders), ("cut", customer, customer.drop("c_name"))])
    assert [(r["pair"], r["column_name"], r["kind"]) for r in dicts(diff)] == [("cut", "c_name", "only_a")]


# -- scratch space and sinks ----------------------------------------------------------------------------


def test_scratch_space_is_the_configured_folder(spark):
    assert scratch.fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    held = scratch.staged(spark.range(10).repartition(3), "numbers")
    assert held.count() == 10 and "range" not in held._jdf.queryExecution().executedPlan().toString().lower()


class Session:
    """As much of a session as the scratch folder looks at."""

    def __init__(self, **conf):
        self.conf = conf


def test_scratch_folder_choice():
    warehouse = {"spark.sql.warehouse.dir": "hdfs://x/warehouse/"}
    chosen = {"spark.checkpoint.dir": "hdfs://x/shared/"}
    assert scratch.shared_dir(Session(**warehouse, **chosen)) == "hdfs://x/shared"
    assert scratch.shared_dir(Session(**warehouse)) == "hdfs://x/warehouse/_scratch"


class Recorder:
    """Stands in for a DataFrame writer: remembers the calls made on it."""

    def __init__(self):
        self.calls = {}

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls[name] = self.calls.get(name, []) + [(args, kwargs)]
            return self
        return call

    @property
    def write(self):
        return self


def test_graph_writer_options():
    frame = Recorder()
    sinks.write_graph_nodes(frame, "bolt://host", ":Customer", "customer_id", {"authentication.basic.username": "u"})
    assert frame.calls["mode"] == [(("overwrite",), {})]
    assert [a for a, _ in frame.calls["option"]] == [("url", "bolt://host"), ("labels", ":Customer"), ("node.keys", "customer_id")]
    assert frame.calls["options"] == [((), {"authentication.basic.username": "u"})]


def test_jdbc_writer_options():
    frame = Recorder()
    sinks.write_jdbc(frame, "jdbc:x", "audit", {"user": "u"}, max_connections=2)
    assert frame.calls["repartition"] == [((2,), {})]
    assert frame.calls["jdbc"] == [(("jdbc:x", "audit"), {"mode": "append", "properties": {"user": "u"}})]


def test_odd_key_names_survive_sampling(spark):
    rows = spark.createDataFrame([(1, "x", 5), (2, "y", 6)], "`the key` int, `a.b` string, v int")
    pair = tc.sample_pair(rows, rows, ["the key", "a.b"], 1)
    assert [tuple(r) for r in pair.b.collect()] == [(1, "x", 5)]


def test_nothing_staged_is_still_a_table(spark):
    none = scratch.staged(spark.createDataFrame([], "x int, y array<string>"), "nothing")
    assert none.columns == ["x", "y"] and none.count() == 0
    templates = spark.createDataFrame([("q", "{{ tbl_a }}")], "domain_cd string, domain_value string")
    reference = spark.createDataFrame([], "table_cd string, table_path string, stage_table_path string")
    assert tc.render_templates(templates, reference).first()["rendered_sql"] == "{{ tbl_a }}"
    assert tc.render_templates(templates.limit(0), reference).count() == 0
