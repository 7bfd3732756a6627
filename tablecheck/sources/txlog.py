"""Transaction log reader: JSON commits and Parquet checkpoints of one table.

Output columns: ``version``, ``is_add``, ``file_path``, ``size``. One row per file action.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# File action fields and file names of the public log protocol.
ACTION_SCHEMA = T.StructType([
    T.StructField("add", T.StructType([
        T.StructField("path", T.StringType()),
        T.StructField("size", T.LongType()),
    ])),
    T.StructField("remove", T.StructType([T.StructField("path", T.StringType())])),
])
CHECKPOINT_SCHEMA = T.StructType([
    *ACTION_SCHEMA.fields, T.StructField("sidecar", T.StructType([T.StructField("path", T.StringType())])),
])
LOG_FOLDER = "_delta_log"
SIDE_FOLDER = "_sidecars"
POINTER_FILE = "_last_checkpoint"
COMMIT_FILES = "[0-9]*[0-9].json"
CHECKPOINT_FILES = "*.checkpoint*"
_VERSION = r"(\d{20})\.[^/]*$"
_COMMIT = r"/\d{20}\.json$"
_PART = r"\.checkpoint\.(\d{10})\.(\d{10})\.parquet$"


def file_actions(actions: DataFrame) -> DataFrame:
    """Flatten ``(version, add, remove)`` log records to one row per file action.

    The log writes paths as URIs; here they are the names the files have.
    """
    is_add = F.col("add").isNotNull()
    return actions.where(is_add | F.col("remove").isNotNull()).select(
        F.col("version").cast("bigint").alias("version"),
        is_add.alias("is_add"),
        _decoded(F.coalesce("add.path", "remove.path")).alias("file_path"),
        F.col("add.size").alias("size"),
    )


def _decoded(path: Column) -> Column:
    """A URI path as a file name: ``%20`` is a blank, ``+`` is itself. What is no URI stays."""
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def read_log(spark: SparkSession, table_path: str) -> DataFrame:
    """File actions of the latest checkpoint and of every JSON commit still there.

    The log keeps JSON commits for a while after a checkpoint, so a commit may repeat
    what the checkpoint holds; replay by version takes care of that. The pointer file names
    the checkpoint; only where there is none, or what it names is not there, are checkpoint
    files listed. A checkpoint may be one file, Parquet or JSON, or several numbered
    parts, and may name side files that hold its actions.
    """
    folder = f"{table_path.rstrip('/')}/{LOG_FOLDER}"
    commits = _versioned(_reader(spark, COMMIT_FILES, ACTION_SCHEMA).json(folder))
    latest = _pointed_checkpoint(spark, folder) or _latest_checkpoint(spark, folder)
    if latest is None:
        return file_actions(commits)
    return file_actions(commits.unionByName(_checkpoint(spark, folder, *latest)))


def _reader(spark: SparkSession, pattern: str, schema: T.StructType):
    return spark.read.schema(schema).option("pathGlobFilter", pattern)


def _version_of(path: Column) -> Column:
    return F.regexp_extract(path, _VERSION, 1).cast("bigint")


def _versioned(records: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    # the name pattern also takes in JSON checkpoints that have a digit before their ending
    return records.where(path.rlike(_COMMIT)).select(_version_of(path).alias("version"), "add", "remove")


def _files(spark: SparkSession, path: str):
    """A path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _there(spark: SparkSession, pattern: str) -> int:
    """How many files have a name of this pattern."""
    path, files = _files(spark, pattern)
    return len(files.globStatus(path) or [])


def _pointer(spark: SparkSession, folder: str) -> dict:
    """What the pointer file says; a few bytes that Spark's readers, to whom its name is a
    hidden one, leave out."""
    path, files = _files(spark, f"{folder}/{POINTER_FILE}")
    if not files.exists(path):
        return {}
    stream = files.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    except ValueError:  # cut off while it was written: the folder is listed instead
        return {}
    finally:
        stream.close()


def _pointed_checkpoint(spark: SparkSession, folder: str) -> tuple[int, str] | None:
    """Version and name pattern of the checkpoint that the pointer file names, if all of it is there."""
    pointer = _pointer(spark, folder)
    if "version" not in pointer:
        return None
    version, parts, own = int(pointer["version"]), pointer.get("parts"), pointer.get("v2Checkpoint") or {}
    if own.get("path"):
        pattern, wanted = own["path"].rsplit("/", 1)[-1], 1
    elif parts:
        pattern, wanted = f"{version:020d}.checkpoint.*.{parts:010d}.parquet", parts
    else:
        pattern, wanted = f"{version:020d}.checkpoint.parquet", 1
    return (version, pattern) if _there(spark, f"{folder}/{pattern}") == wanted else None


def _latest_checkpoint(spark: SparkSession, folder: str) -> tuple[int, str] | None:
    """Version and name pattern of the newest whole checkpoint.

    One row per checkpoint file reaches the driver, of the newest version only.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", CHECKPOINT_FILES).load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), _version_of(F.col("path")).alias("version"),
        F.regexp_extract("path", _PART, 1).alias("part"), F.regexp_extract("path", _PART, 2).alias("parts"),
    )
    newest = listed.agg(F.max("version")).first()[0]
    if newest is None:
        return None
    files = listed.where(F.col("version") == newest).collect()
    single = [f["name"] for f in files if f["name"].endswith((".parquet", ".json")) and not f["part"]]
    if single:
        return newest, max(single)
    for parts in sorted({f["parts"] for f in files if f["part"]}):
        held = {f["part"] for f in files if f["parts"] == parts}
        if len(held) == int(parts):
            return newest, f"{newest:020d}.checkpoint.*.{parts}.parquet"
    raise ValueError(f"checkpoint {newest} of {folder} lacks parts or is in no form that can be read")


def _checkpoint(spark: SparkSession, folder: str, version: int, pattern: str) -> DataFrame:
    reader = _reader(spark, pattern, CHECKPOINT_SCHEMA)
    kept = reader.json(folder) if pattern.endswith(".json") else reader.parquet(folder)
    own = kept.select(F.lit(version).cast("bigint").alias("version"), "add", "remove")
    sides = [r[0] for r in kept.where("sidecar IS NOT NULL").select("sidecar.path").distinct().collect()]
    if not sides:
        return own
    # a path may be the file's name alone or spelled out
    paths = [p if "/" in p else f"{folder}/{SIDE_FOLDER}/{p}" for p in sides]
    held = spark.read.schema(ACTION_SCHEMA).parquet(*paths)
    return own.unionByName(held.select(F.lit(version).cast("bigint").alias("version"), "add", "remove"))
