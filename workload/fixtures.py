"""Table versions, audit rows, logs and templates derived from the given tables.

Each fixture is written once as SQL expressions, used by Spark (``selectExpr``) and by the
checking SQL alike, so both sides start from the same rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.sources.scratch import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def select_sql(expressions: list[str], source: str, where: str | None = None) -> str:
    sql = f"SELECT {', '.join(expressions)} FROM {source}"
    return f"{sql} WHERE {where}" if where else sql


# -- orders: version A and version B, unique key o_orderkey ---------------------------

ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDERS_A = [
    *ORDERS[:5],
    "CASE WHEN o_orderkey % 79 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority",
]
ORDERS_B = [
    "o_orderkey",
    "o_custkey",
    "CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus",
    "CASE WHEN o_orderkey % 97 = 0 THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice",
    "o_orderdate",
    "CASE WHEN o_orderkey % 79 = 0 THEN NULL WHEN o_orderkey % 83 = 0 THEN 'CHANGED' "
    "ELSE o_orderpriority END AS o_orderpriority",
]
ORDERS_B_NEW = ["o_orderkey + 100000000 AS o_orderkey", *ORDERS[1:]]
KEPT, COPIED = "o_orderkey % 101 <> 0", "o_orderkey % 103 = 0"


def orders_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    changed = orders.where(KEPT).selectExpr(*ORDERS_B)
    added = orders.where(COPIED).selectExpr(*ORDERS_B_NEW)
    return orders.selectExpr(*ORDERS_A), changed.unionAll(added)


ORDERS_PAIR_SQL = f"""
a AS ({select_sql(ORDERS_A, "orders")}),
b AS ({select_sql(ORDERS_B, "orders", KEPT)} UNION ALL {select_sql(ORDERS_B_NEW, "orders", COPIED)})"""


# -- lineitem: repeated keys and repeated rows ----------------------------------------

LINEITEM = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    "CAST(l_quantity AS DECIMAL(12,2)) AS l_quantity",
    "CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice",
    "l_returnflag", "l_linestatus", "CAST(l_shipdate AS DATE) AS l_shipdate",
    "CAST(l_discount AS DECIMAL(12,2)) AS l_discount", "CAST(l_tax AS DECIMAL(12,2)) AS l_tax",
]
LINEITEM_NAMES = [e.split(" AS ")[-1] for e in LINEITEM]
LINEITEM_B = [
    *LINEITEM[:4],
    "CAST(CASE WHEN l_partkey % 31 = 0 THEN l_quantity + 1 ELSE l_quantity END AS DECIMAL(12,2)) AS l_quantity",
    LINEITEM[5],
    "CASE WHEN l_suppkey % 13 = 0 THEN 'X' ELSE l_returnflag END AS l_returnflag",
    *LINEITEM[7:10],
    "CAST(CASE WHEN l_partkey % 37 = 0 THEN l_tax + 0.01 ELSE l_tax END AS DECIMAL(12,2)) AS l_tax",
]
LINE_KEPT, LINE_COPIED = "l_orderkey % 97 <> 0", "l_suppkey % 50 = 7"


def lineitem_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf_dir, "lineitem")
    changed = lines.where(LINE_KEPT).selectExpr(*LINEITEM_B)
    copied = lines.where(LINE_COPIED).selectExpr(*LINEITEM)
    return lines.selectExpr(*LINEITEM), changed.unionAll(copied)


LINEITEM_PAIR_SQL = f"""
a AS ({select_sql(LINEITEM, "lineitem")}),
b AS ({select_sql(LINEITEM_B, "lineitem", LINE_KEPT)} UNION ALL {select_sql(LINEITEM, "lineitem", LINE_COPIED)})"""


# -- orders with a nested column: a struct of a map, a time and a list ---------------------

NESTED_B = {
    "status": "CASE WHEN o_orderkey % 89 = 0 THEN 'X' ELSE o_orderstatus END",
    "moment": "CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END",
    "price": "CASE WHEN o_orderkey % 83 = 0 THEN o_totalprice + 1 ELSE o_totalprice END",
}


def nested_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders twice; B lists map entries the other way round and differs as ``NESTED_B`` says,
    in one case by a microsecond."""
    orders = table(spark, sf_dir, "orders")

    def nested(status: str, extra_micros: str, price: str, backwards: bool) -> DataFrame:
        entries = ["'status'", status, "'priority'", "o_orderpriority"]
        if backwards:
            entries = entries[2:] + entries[:2]
        return orders.selectExpr("o_orderkey", f"""named_struct('m', map({', '.join(entries)}),
            't', timestamp_micros(unix_micros(CAST(o_orderdate AS TIMESTAMP)) + {extra_micros}),
            'l', array(named_struct('p', {price}, 'z', CASE WHEN {'true' if backwards else 'false'} THEN -0.0D ELSE 0.0D END)))
            AS detail""")

    return (
        nested("o_orderstatus", "0", "o_totalprice", False),
        nested(NESTED_B["status"], NESTED_B["moment"], NESTED_B["price"], True),
    )


# -- audit rows, one per order ---------------------------------------------------------

AUDIT = [
    "CASE o_orderkey % 6 WHEN 0 THEN 'dev_' || o_orderstatus WHEN 1 THEN 'test_' || o_orderstatus "
    "WHEN 2 THEN 'prod_' || o_orderstatus WHEN 3 THEN 'nightly' WHEN 4 THEN 'test_dev' END AS test_name",
    "'t' || CAST(o_custkey % 7 AS STRING) AS table_a",
    "CASE WHEN o_custkey % 11 <> 0 THEN 't' || CAST(o_custkey % 7 AS STRING) || '_b' END AS table_b",
    "o_orderpriority AS column_name",
    "o_orderkey % 5 = 0 AS schema_mismatch",
    "CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey % 3 = 0 END AS data_mismatch",
    "CASE WHEN o_orderkey % 17 <> 0 THEN o_orderkey % 4 END AS mismatch_count",
    "CASE o_orderkey % 3 WHEN 0 THEN 'No errors' WHEN 2 THEN 'bad rows' END AS validation_errors",
    "CAST(o_orderdate AS TIMESTAMP) AS run_date",
    "CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS run_label",
]
AUDIT_SQL = f"audit AS ({select_sql(AUDIT, 'orders')})"
EXPECTED_SQL = "expected AS (SELECT DISTINCT o_orderpriority AS column_name FROM orders WHERE o_orderpriority <> '5-LOW')"


def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*AUDIT)


def expected_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderpriority <> '5-LOW'")
    return orders.selectExpr("o_orderpriority AS column_name").distinct()


# -- experiment exposures, one per event ------------------------------------------------

EXPOSURES = [
    "'exp_' || CAST(user_id % 3 AS STRING) AS experiment_id",
    "CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS variation",
    "CAST(ts AS DATE) AS date",
    "user_id",
    "CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS conversion",
    "value AS time_on_site",
]
EXPOSURES_SQL = f"exposures AS ({select_sql(EXPOSURES, 'events')})"


def exposures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*EXPOSURES)


# -- a transaction log, one action per order --------------------------------------------

LOG_VERSION = "YEAR(o_orderdate) * 12 + MONTH(o_orderdate)"
LOG_PATH = "'part-' || CAST(o_custkey AS STRING) || '.parquet'"
LOG_IS_ADD = "o_orderstatus <> 'F'"
LOG_B = "o_orderkey % 7 <> 0"
ODD_PATH = "'part ' || CAST(o_custkey AS STRING) || '+50%.parquet'"
#: Files of a checkpoint, written by as many tasks.
CHECKPOINT_FILES = 4


def log_sql(path: str = LOG_PATH) -> str:
    return f"""
log AS (SELECT {LOG_VERSION} AS version, {LOG_IS_ADD} AS is_add, {path} AS file_path,
  CASE WHEN {LOG_IS_ADD} THEN o_orderkey END AS size, {LOG_B} AS in_b FROM orders)"""


LOG_SQL = log_sql()


def log_records(spark: SparkSession, sf_dir: str, where: str = "true", path: str = LOG_PATH) -> DataFrame:
    """Log records as the JSON commits hold them: ``version, add, remove``, paths as URIs."""
    orders = table(spark, sf_dir, "orders").where(where)
    is_add = F.expr(LOG_IS_ADD)
    uri = F.replace(F.replace(F.expr(path), F.lit("%"), F.lit("%25")), F.lit(" "), F.lit("%20"))
    return orders.select(
        F.expr(LOG_VERSION).alias("version"),
        F.when(is_add, F.struct(uri.alias("path"), F.col("o_orderkey").alias("size"))).alias("add"),
        F.when(~is_add, F.struct(uri.alias("path"))).alias("remove"),
    )


def _moved(spark: SparkSession, folder: str, target: str, name: Callable[[int, int], str]) -> list[str]:
    """Give the data files of a written folder their names in the log, by number and count."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(
        (f.getPath() for f in files.listStatus(path(folder)) if f.getPath().getName().startswith("part-")),
        key=lambda part: part.getName(),
    )
    files.mkdirs(path(target))
    names = [name(i, len(parts)) for i in range(1, len(parts) + 1)]
    for part, own in zip(parts, names):
        if not files.rename(part, path(f"{target}/{own}")):
            raise OSError(f"{part.toString()} cannot be renamed")
    return names


_LOGS: dict[tuple[str, str, str, bool], str] = {}


def written_log(spark: SparkSession, sf_dir: str, where: str = "true", pointed: bool = False) -> str:
    """A table folder with the same records as commit files, and a checkpoint half way.

    The checkpoint holds what its version's replay leaves. It is written by several tasks, as
    numbered parts, and the commits before it are kept. A ``pointed`` log has odd file names, a
    JSON checkpoint with side files that a pointer file names, no commits before it, and a
    part of a later checkpoint that was never finished. A session writes each log once.
    """
    known = (spark.sparkContext.applicationId, sf_dir, where, pointed)
    if known not in _LOGS:
        _LOGS[known] = _write_log(spark, sf_dir, where, pointed)
    return _LOGS[known]


def _write_log(spark: SparkSession, sf_dir: str, where: str, pointed: bool) -> str:
    table_path = fresh_path(spark, "logged-table")
    log = f"{table_path}/_delta_log"
    records = log_records(spark, sf_dir, where, ODD_PATH if pointed else LOG_PATH)
    versions = [r[0] for r in records.select("version").distinct().orderBy("version").collect()]
    half = versions[len(versions) // 2]
    kept = records.where(F.col("version") > half) if pointed else records
    lines = kept.select("version", F.to_json(F.struct("add", "remove")).alias("value"))
    staging = fresh_path(spark, "commits")
    # a version's records are one file, as in any such log
    lines.repartition("version").write.partitionBy("version").text(staging)
    for version in versions:
        if not pointed or version > half:
            _moved(spark, f"{staging}/version={version}", log, lambda i, n: f"{version:020d}.json")
    last = F.max_by(F.struct("add", "remove"), F.struct("version", F.col("add").isNotNull(), "add.size"))
    own_path = F.coalesce("add.path", "remove.path").alias("path")
    state = records.where(F.col("version") <= half).groupBy(own_path).agg(last.alias("r"))
    checkpoint = fresh_path(spark, "checkpoint")
    state.repartition(CHECKPOINT_FILES, "path").select("r.add", "r.remove").write.parquet(checkpoint)
    if not pointed:
        _moved(spark, checkpoint, log, lambda i, n: f"{half:020d}.checkpoint.{i:010d}.{n:010d}.parquet")
        return table_path
    sides = _moved(spark, checkpoint, f"{log}/_sidecars", lambda i, n: f"side-{i}.parquet")
    named = f"{half:020d}.checkpoint.{uuid.uuid4()}.json"
    _put_lines(spark, log, named, [json.dumps({"sidecar": {"path": side}}) for side in sides])
    _put_lines(spark, log, "_last_checkpoint", [json.dumps({"version": half, "v2Checkpoint": {"path": named}})])
    _put_lines(spark, log, f"{half + 1:020d}.checkpoint.{1:010d}.{2:010d}.parquet", ["not finished"])
    return table_path


def _put_lines(spark: SparkSession, folder: str, name: str, lines: list[str]) -> None:
    staging = fresh_path(spark, "lines")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(staging)
    _moved(spark, staging, folder, lambda i, n: name)


# -- SQL templates, one per document; the whole text is part of the template -------------

TEMPLATES = [
    "'doc_' || CAST(doc_id AS STRING) AS domain_cd",
    "'SELECT * FROM {{ tbl_' || lang || ' }} x JOIN {{tbl_' || source || '}} y ON x.id = y.id "
    "JOIN {{  tbl_' || lang || '}} z WHERE env = {{ run_env }} AND note = {{ other }} /* ' || text || ' */' "
    "AS domain_value",
]
REFERENCE = [
    "lang AS table_cd",
    "'lake.' || lang AS table_path",
    "'stage.' || lang AS stage_table_path",
]
REFERENCE_SOURCES = [
    "source AS table_cd",
    "'lake.s_' || source AS table_path",
    "'stage.s_' || source AS stage_table_path",
]
KNOWN_SOURCES = "source <> 'src3'"
TEMPLATES_SQL = f"""
templates AS ({select_sql(TEMPLATES, "documents")}),
reference AS ({select_sql(REFERENCE, "documents")}
  UNION {select_sql(REFERENCE_SOURCES, "documents", KNOWN_SOURCES)})"""


def templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(*TEMPLATES)


def table_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    sources = documents.where(KNOWN_SOURCES).selectExpr(*REFERENCE_SOURCES)
    return documents.selectExpr(*REFERENCE).unionAll(sources).distinct()


# -- documents as text rows, orders as rounded rows: equal text in any engine -------------

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]
CUSTOMER_TEXT = [
    "c_custkey", "c_name", "CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey END AS c_nationkey",
    "CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal", "c_mktsegment",
]
ORDERS_TEXT = [
    "o_orderkey", "o_custkey", "o_orderstatus",
    "CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice",
    "CAST(o_orderdate AS DATE) AS o_orderdate", "o_orderpriority",
]


# -- places to write ---------------------------------------------------------------------


def scratch_schema(spark: SparkSession) -> str:
    """A fresh schema for the tables of one query, kept in the shared folder."""
    name = f"scratch_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{fresh_path(spark, name)}'")
    return name


def presentable(df: DataFrame) -> DataFrame:
    """Dates, timestamps and decimals as text, so that engines print them alike."""
    wide = {"date", "timestamp", "timestamp_ntz"}
    return df.select(*[
        F.col(name).cast("string").alias(name) if kind in wide or kind.startswith("decimal") else F.col(name)
        for name, kind in df.dtypes
    ])
