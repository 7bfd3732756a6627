"""Substring dedup: runs of words that occur elsewhere are cut out, found by anchors.

A window is ``WINDOW`` consecutive words. Every word covered by a window that also starts
anywhere else, in the same document or another one, is removed; windows are judged on the
input.

1. One pass hashes short anchors of ``WINDOW - PERIOD + 1`` words, only at the places whose
   number modulo ``PERIOD`` lies in a difference cover. Whatever two places the equal
   windows start at, some shift below the period puts both on cover places, so equal windows
   always share an anchor. About a quarter of the places are hashed.
2. Anchors are counted, combined before the shuffle; those seen twice are joined back to
   their places. Nothing is kept but places around shared anchors.
3. From each shared anchor the match is extended to the windows that contain it: these are
   hashed with 128 bits, from two hashes of every word, and counted; windows seen at two places are the repeated ones.
4. The texts of the documents concerned are cut and hashed again; all others pass as they
   were read.

Texts that occur more than once as a whole are decided by their count and take part as one
text, so copies cost no anchors of their own after step 2. Groups are only ever counted,
never gathered; a list is never longer than its document. What several jobs read is
written to the shared folder.

Defined cases: a null or empty text has no words; a text shorter than a window is never cut;
repeated rows are copies of each other, also where they repeat the id; a null id is carried;
other columns are not read; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.shingles import list_array, window_hashes, word_hashes
from tablecheck.llm.upkeep import Workspace, release

WINDOW = 35
#: Any two numbers differ, modulo the period, by the difference of two members of the cover.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)

#: Anchors and windows are counted in this many rounds, each a share of the hashes, so that
#: only a share of them lies on the disks at once.
ROUNDS = 2

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def cover_places(n: int, size: int) -> np.ndarray:
    """The places below ``n - size + 1`` at which anchors of ``size`` words are hashed."""
    rounds = np.arange(0, max(0, n - size + 1), PERIOD)[:, None]
    places = (rounds + np.array(COVER)[None, :]).ravel()
    return places[places <= n - size]


def _split(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def _read(text: Column, window: int) -> Column:
    """Words, hash of the text as it stands, and anchors in the order of their places."""
    size = window - PERIOD + 1

    @F.arrow_udf("n_words long, sha256 string, anchors array<long>")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            counts, digests, anchors = [], [], []
            for content in batch:
                words = _split(content.as_py())
                counts.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                if len(words) >= window:
                    places = cover_places(len(words), size)
                    anchors.append(window_hashes(word_hashes(words), size, places).view(np.int64))
                else:
                    anchors.append(None)
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), list_array(anchors, pa.int64())],
                names=["n_words", "sha256", "anchors"],
            )

    return read(text)


def _extended(text: Column, ordinals: Column, window: int) -> Column:
    """Start and 128-bit hash of every window around the shared anchors of a text."""
    size = window - PERIOD + 1
    kind = pa.struct([("start", pa.int64()), ("h", pa.int64()), ("g", pa.int64())])

    @F.arrow_udf("array<struct<start:long,h:long,g:long>>")
    def extend(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, shared in batches:
            sizes, columns = [], []
            for content, listed in zip(texts, shared):
                words = _split(content.as_py())
                hashes = word_hashes(words)
                at = cover_places(len(words), size)[np.sort(listed.values.to_numpy())]
                near = np.zeros(len(words) + 1, np.int64)
                np.add.at(near, np.maximum(at - PERIOD + 1, 0), 1)
                np.add.at(near, at + 1, -1)
                starts = np.flatnonzero(np.cumsum(near)[: len(words) - window + 1] > 0)
                sizes.append(len(starts))
                columns.append((
                    starts, window_hashes(hashes, window, starts).view(np.int64),
                    window_hashes(word_hashes(words, 1), window, starts, 0xA0761D6478BD642F).view(np.int64),
                ))
            values = [np.concatenate(c) if columns else np.zeros(0, np.int64) for c in zip(*columns)] or [[]] * 3
            flat = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in values], fields=list(kind))
            offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), flat)

    return extend(text, ordinals)


def _cut(text: Column, starts: Column, window: int) -> Column:
    @F.arrow_udf("n_removed long, kept string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, listed in batches:
            removed, kept = [], []
            for content, own in zip(texts, listed):
                words = _split(content.as_py())
                edges = np.zeros(len(words) + 1, np.int64)
                at = own.values.to_numpy()
                np.add.at(edges, at, 1)
                np.add.at(edges, at + window, -1)
                stays = np.cumsum(edges)[:-1] == 0
                removed.append(int(len(words) - stays.sum()))
                kept.append(b" ".join(words[i] for i in np.flatnonzero(stays)).decode("utf-8", "replace"))
            yield pa.StructArray.from_arrays(
                [pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["n_removed", "kept"]
            )

    return cut(text, starts)


def _in_rounds(
    places: DataFrame, hashes: list[str], place: str, listed: str, space: Workspace
) -> DataFrame:
    """``row, listed``: the places of every row whose hashes occur more than once.

    Equal hashes meet in the same round. Counts are combined before the shuffle. They are
    written before they are joined back: between two plain reads adaptive execution can
    split a frequent hash, which it cannot above an aggregate.
    """
    spark = places.sparkSession
    found = []
    for turn in range(ROUNDS):
        own = places.where(F.pmod(F.col(hashes[0]), F.lit(ROUNDS)) == turn)
        counted = own.groupBy(*hashes).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*hashes)
        shared = space.staged(counted, "shared")
        held = own.join(shared, hashes).groupBy("row").agg(F.collect_set(place).alias(listed))
        found.append(space.staged(held, listed))
        space.drop("shared")
        release(spark)
    return reduce(DataFrame.unionAll, found).groupBy("row").agg(F.flatten(F.collect_list(listed)).alias(listed))


def substring_dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """``key, same, n_words, n_removed, kept_sha256, kept`` for every row of ``docs``.

    ``kept`` is the text that is left, words joined by one space, and null where nothing was
    removed; ``same`` is the md5 of the text as it was, by which ``kept`` can be joined back.
    """
    picked = docs.select(
        F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("t")
    )
    spark = docs.sparkSession
    space = Workspace(spark, "substrings")
    # one row a document, with anchors; rows get numbers that stay as they are written
    read = space.staged(
        picked.select("id", F.md5("t").alias("same"), _read(F.col("t"), window).alias("r"))
        .select(F.monotonically_increasing_id().alias("row"), "id", "same", "r.n_words", "r.sha256", "r.anchors"),
        "anchors",
    )
    rows = space.staged(read.drop("anchors"), "rows")
    classes = space.staged(
        rows.groupBy("same").agg(F.count(F.lit(1)).alias("copies"), F.min("row").alias("first")), "classes"
    )
    anchored = read.select("row", F.posexplode("anchors").alias("ordinal", "anchor"))
    flagged = _in_rounds(anchored, ["anchor"], "ordinal", "ordinals", space)
    # one row stands for all copies of a text
    concerned = space.staged(
        rows.select("row", "id", "same").join(flagged, "row")
        .join(classes.select(F.col("first").alias("row"), "copies"), "row"), "concerned",
    )
    space.drop("anchors")
    release(spark)
    texts = picked.withColumn("same", F.md5("t"))
    chosen = concerned.withColumnRenamed("id", "chosen_id").withColumnRenamed("same", "chosen")
    held = space.staged(
        chosen.join(texts, F.col("id").eqNullSafe(F.col("chosen_id")) & (F.col("same") == F.col("chosen")))
        .select("row", "copies", "ordinals", "t"), "texts",
    )
    release(spark)
    # hashed again whenever they are read: cheaper than keeping them all.
    # Rows that repeat id and text come twice here, but those texts are decided by their count.
    windows = held.select("row", F.explode(_extended(F.col("t"), F.col("ordinals"), window)).alias("w")).select(
        "row", "w.start", "w.h", "w.g"
    )
    starts = _in_rounds(windows, ["h", "g"], "start", "starts", space)
    cut = held.where("copies = 1").join(starts, "row").select(
        "row", _cut(F.col("t"), F.col("starts"), window).alias("c")
    ).select("row", "c.n_removed", "c.kept", F.sha2(F.col("c.kept").cast("binary"), 256).alias("kept_sha256"))
    cut = space.staged(cut, "cut")
    decided = rows.join(classes.select("same", "copies"), "same").join(cut, "row", "left")
    gone = (F.col("copies") > 1) & (F.col("n_words") >= window)
    return space.finished(decided.select(
        F.col("id").alias(key), "same", "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.lit(EMPTY_SHA256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        F.when(gone, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    ))
