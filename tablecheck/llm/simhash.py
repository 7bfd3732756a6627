"""SimHash near-duplicates: vantage-point trees over 64-bit fingerprints, exact pairs.

A text's fingerprint has a bit set where more than half of its four-word shingles (A-Z
lower-cased, repeats counted, all words as one where there are fewer) have it set in their
XXH64. Fingerprints link at ``near`` or fewer differing bits. Every document gets the
smallest id it can reach over links.

Distances of unrelated fingerprints all lie close to 32, where a ball of radius 4 crosses
most boundaries of a vantage-point tree. So the bits are cut into three views. Two
fingerprints that differ in at most four bits differ in at most one bit of some view, and
the distance within a view obeys the triangle inequality like the whole one. There is one
tree a view, and each is asked for radius one only.

1. One pass signs the texts; equal fingerprints become one point (combined before the shuffle).
2. A bounded sample of the points grows the upper part of each tree. Its leaves are the
   shards: as many as the points need, so that each holds about ``SHARD_POINTS``.
3. Every point goes to its own shard and, as a query, to the earlier shards whose side of
   every boundary it could reach within the radius.
4. A shard grows the tree on over its own points and asks it for all of them and for its
   visitors: whole blocks of queries go down together, and a branch is pruned where the
   triangle bounds exclude it, or where its points and the query are known to be connected
   already. Pairs found are checked on all 64 bits. Only a spanning forest leaves the task.
5. Components of these links, then the smallest id of each.

Nothing but the sample (``SAMPLE_PER_SHARD`` points for each of at most ``1 << MAX_LEVELS``
shards) reaches the driver. What several jobs read is written to the shared folder.

Defined cases: null, empty and blank texts have fingerprint zero and link like any other;
a null id gets the smallest id of its component, or null where no member has one; repeated
rows each get their row; other columns are not read; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.components import connected_components
from tablecheck.llm.upkeep import Workspace

SHINGLE_WORDS = 4
SEED = 42
NEAR = 4
#: Views of 22, 21 and 21 bits: of at most ``NEAR`` differing bits one view holds at most ``REACH``.
VIEWS = (0x3FFFFF, 0x1FFFFF << 22, 0x1FFFFF << 43)
REACH = NEAR // len(VIEWS)

SHARD_POINTS = 16_384
MAX_LEVELS = 16
SAMPLE_PER_SHARD = 16
LEAF_POINTS = 64
#: Shingles hashed, and queries compared with a leaf, at once.
BLOCK = 1 << 14


def fingerprint(text: bytes | None, size: int = SHINGLE_WORDS) -> int:
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(size, len(words))
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        runs = [joined[a:b] for a, b in zip(starts[at: at + BLOCK], ends[at: at + BLOCK])]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), "<u8", len(runs))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts), bitorder="little").tobytes(), "little")


def _fingerprints(text: Column, size: int) -> Column:
    @F.arrow_udf("long")
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            signed = np.fromiter((fingerprint(x.as_py(), size) for x in batch), np.uint64, len(batch))
            yield pa.array(signed.view(np.int64))

    return sign(text)


def _apart(points: np.ndarray, other: np.ndarray | np.uint64, view: np.uint64) -> np.ndarray:
    return np.bitwise_count((points ^ other) & view).astype(np.int16)


def vantage(points: np.ndarray, view: np.uint64, reach: int) -> tuple[np.uint64, int]:
    """A point and a radius that part ``points`` evenly with few of them near the boundary.

    Sixteen of the points are tried, each with the radius that comes closest to a half.
    """
    best = (2.0 * len(points) + 1, np.uint64(0), 0)
    for candidate in points[:: max(1, len(points) // 16)][:16]:
        at = np.bincount(_apart(points, candidate, view), minlength=65)
        inside = np.cumsum(at)
        radius = int(np.argmin(np.abs(2 * inside - len(points))))
        edge = at[max(0, radius - reach + 1): radius + reach + 1].sum()
        best = min(best, (float(abs(2 * inside[radius] - len(points)) + edge), candidate, radius))
    return best[1], best[2]


@dataclass(frozen=True)
class Upper:
    """The upper part of a tree, as a heap: node ``i`` has its near side at ``2 i + 1``."""

    points: np.ndarray
    radii: np.ndarray
    view: np.uint64
    levels: int
    reach: int = REACH


def grow_upper(sample: np.ndarray, view: int, levels: int, reach: int = REACH) -> Upper:
    points, radii = np.zeros((1 << levels) - 1, np.uint64), np.zeros((1 << levels) - 1, np.int16)
    parts = {0: sample}
    for node in range(len(points)):
        held = parts.pop(node)
        if len(held):
            points[node], radii[node] = vantage(held, np.uint64(view), reach)
        near = _apart(held, points[node], np.uint64(view)) <= radii[node]
        parts[2 * node + 1], parts[2 * node + 2] = held[near], held[~near]
    return Upper(points, radii, np.uint64(view), levels, reach)


def shards_of(points: np.ndarray, tree: Upper) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each point's own shard, and (point, shard) of the earlier shards within its reach."""
    which, node = np.arange(len(points)), np.zeros(len(points), np.int64)
    home = np.ones(len(points), bool)
    for _ in range(tree.levels):
        apart = _apart(points[which], tree.points[node], tree.view)
        radius = tree.radii[node]
        near = apart <= radius
        near_too, far_too = ~near & (apart - tree.reach <= radius), near & (apart + tree.reach > radius)
        fork = near_too | far_too
        other = np.where(near_too, 2 * node + 1, 2 * node + 2)[fork]
        node = np.concatenate([np.where(near, 2 * node + 1, 2 * node + 2), other])
        which, home = np.concatenate([which, which[fork]]), np.concatenate([home, np.zeros(len(other), bool)])
    shard = node - ((1 << tree.levels) - 1)
    own = np.zeros(len(points), np.int64)
    own[which[home]] = shard[home]
    earlier = ~home & (shard < own[which])
    return own, which[earlier], shard[earlier]


def _routed(points: DataFrame, trees: list[Upper]) -> DataFrame:
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for number, tree in enumerate(trees):
                own, who, where = shards_of(fps, tree)
                shard, fp = np.concatenate([own, where]), np.concatenate([fps, fps[who]])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(fp), number, np.int32)), pa.array(shard.astype(np.int32)),
                    pa.array(fp.view(np.int64)), pa.array(np.arange(len(fp)) < len(fps)),
                ], names=["tree", "shard", "fp", "home"])

    return points.mapInArrow(route, "tree int, shard int, fp long, home boolean")


def _merged(labels: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Labels after the points of each link are put together; a label is a group's first point."""
    while True:
        a, b = labels[one], labels[other]
        differ = a != b
        if not differ.any():
            return labels
        one, other = one[differ], other[differ]
        root = np.arange(len(labels))
        np.minimum.at(root, np.maximum(a, b)[differ], np.minimum(a, b)[differ])
        while (root[root] != root).any():
            root = root[root]
        labels = root[labels]


def linked(home: np.ndarray, visiting: np.ndarray, view: int, reach: int = REACH, near: int = NEAR) -> np.ndarray:
    """For ``home`` and then ``visiting`` points the position of the first one each is connected to.

    Connected over pairs of a home point and any point that differ in ``near`` bits at most,
    of which all those are found that differ in ``reach`` bits of the view at most.
    """
    view = np.uint64(view)
    order, nodes = np.arange(len(home)), []

    def grow(low: int, high: int) -> int:
        number = len(nodes)
        nodes.append(None)
        held = home[order[low:high]]
        cut = 0
        if high - low > LEAF_POINTS:
            point, radius = vantage(held, view, reach)
            inside = _apart(held, point, view) <= radius
            cut = int(inside.sum())
        if 0 < cut < high - low:
            order[low:high] = np.concatenate([order[low:high][inside], order[low:high][~inside]])
            nodes[number] = (low, high, point, radius, grow(low, low + cut), grow(low + cut, high))
        else:
            nodes[number] = (low, high, None, 0, 0, 0)
        return number

    grow(0, len(home))
    points = home[order]
    queries = np.concatenate([home, visiting])
    labels = np.arange(len(queries))
    done, size = 0, 64
    while done < len(queries):
        found: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = [(0, np.arange(done, min(done + size, len(queries))))]
        while waiting:
            number, asked = waiting.pop()
            low, high, point, radius, inner, outer = nodes[number]
            groups = labels[order[low:high]]
            if high > low and (groups == groups[0]).all():
                asked = asked[labels[asked] != groups[0]]
            if not len(asked) or high == low:
                continue
            if point is not None:
                apart = _apart(queries[asked], point, view)
                waiting.append((inner, asked[apart - reach <= radius]))
                waiting.append((outer, asked[apart + reach > radius]))
                continue
            width = max(1, BLOCK * LEAF_POINTS // (high - low))
            for at in range(0, len(asked), width):
                some = asked[at: at + width]
                close = np.bitwise_count(queries[some][:, None] ^ points[None, low:high]) <= near
                who, what = np.nonzero(close & (labels[some][:, None] != groups[None, :]))
                found.append((some[who], order[low + what]))
        if found:
            labels = _merged(labels, *(np.concatenate(side) for side in zip(*found)))
        done, size = done + size, min(2 * size, BLOCK)
    return labels


def _links(routed: DataFrame, near: int) -> DataFrame:
    def search(key: tuple, shard: pa.Table) -> pa.Table:
        fps = shard.column("fp").to_numpy().view(np.uint64)
        home = shard.column("home").to_numpy(zero_copy_only=False)
        queries = np.concatenate([np.sort(fps[home]), np.sort(fps[~home])])
        n = int(home.sum())
        first = linked(queries[:n], queries[n:], VIEWS[key[0].as_py()], near=near)
        follows = first != np.arange(len(first))
        one, other = queries[first[follows]], queries[follows]
        return pa.table({"a": one.view(np.int64), "b": other.view(np.int64)})

    return routed.groupBy("tree", "shard").applyInArrow(search, "a long, b long")


def simhash_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, near: int = NEAR,
    shard_points: int = SHARD_POINTS,
) -> DataFrame:
    """``key, fingerprint`` (a signed long) and ``component_id`` for every row of ``docs``."""
    if not 0 <= near < (REACH + 1) * len(VIEWS):
        raise ValueError(f"near must lie between 0 and {(REACH + 1) * len(VIEWS) - 1}")
    space = Workspace(docs.sparkSession, "simhash")
    signed = space.staged(docs.select(
        F.col(f"`{key}`").cast("long").alias("id"),
        _fingerprints(F.col(f"`{text}`").cast("string").cast("binary"), shingle_words).alias("fp"),
    ), "signed")
    points = space.staged(signed.groupBy("fp").agg(F.min("id").alias("least")), "points")
    n = points.count()
    levels = min(MAX_LEVELS, max(0, (n // shard_points)).bit_length())
    wanted = SAMPLE_PER_SHARD << levels
    picked = points.where(F.pmod(F.xxhash64("fp", F.lit("sample")), F.lit(max(1, n))) < wanted)
    sample = np.sort(picked.select("fp").toArrow().column(0).to_numpy()).view(np.uint64)
    trees = [grow_upper(sample, view, levels) for view in VIEWS]
    links = space.staged(_links(_routed(points.select("fp"), trees), near), "links")
    components = connected_components(links, space)
    placed = space.staged(points.join(components, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    ), "placed")
    smallest = space.staged(placed.groupBy("component").agg(F.min("least").alias("component_id")), "smallest")
    # both sides of both joins are plain reads, so a hot fingerprint or component can be split
    reached = space.staged(placed.join(smallest, "component").select("fp", "component_id"), "reached")
    return space.finished(signed.join(reached, "fp").select(
        F.col("id").alias(key), F.col("fp").alias("fingerprint"), F.coalesce("component_id", "id").alias("component_id")
    ))
