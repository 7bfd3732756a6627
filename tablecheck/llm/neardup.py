"""MinHash near-duplicates: circulant signatures, bands, exact verification, components.

Two texts are linked when their sets of distinct five-word shingles (A-Z lower-cased; all
words as one shingle where there are fewer) overlap in ``percent`` of their union or more.
Every document gets the smallest id it can reach over links.

1. One pass signs every text. Circulant MinHash takes two permutations only: the first
   scatters the shingles over a circle, the second, read at every shift of the circle,
   gives one coordinate a shift. Coordinates are cut into bands. Two texts at the threshold
   meet in some band but for 4 in a million such pairs (32 bands of 7, 0.85).
2. Equal texts become one node, whatever their ids. In every band bucket the other nodes are
   paired with the smallest one: as many pairs as rows, never all pairs. They are confirmed
   on full sets.
3. Buckets whose nodes fell into one component are done; that is where groups of copies
   go, however large. In the others, nodes outside the bucket's largest component are
   compared with the rest of the bucket, in blocks of bounded size: within a task a sketch
   rules out far pairs, exact sets decide the near ones, and only links come out.

So no link between different texts that share a bucket is lost, but for pairs whose sketches
lie ``SKETCH_DEVIATIONS`` deviations below the threshold (3 of 10 million at it), and no group
is collected into one task. Both sides of a join on a frequent key are plain reads, so that
adaptive execution can split it. What several jobs read is written to the shared folder.

A circle holds a text well while most of its places stay free. Texts of more than
``WIDE_SHINGLES`` shingles are signed on a circle of 2 ** 64 places instead, where the second
permutation is calculated; those near the limit are signed on both, so that any two texts
that could be linked are signed on the same one.

Defined cases: null, empty and blank texts have an empty set and are linked with nothing
(their own component); a null id gets the smallest id of its component, or null where no
member has one; rows that repeat an id with other texts are other nodes, each row with the
component of its own text; other columns are not read; an empty table gives an empty one.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.components import connected_components
from tablecheck.llm.shingles import list_array, mixed, shingle_hashes
from tablecheck.llm.upkeep import Workspace
from tablecheck.llm.vocabularies import let_go

SHINGLE_WORDS = 5
PERCENT = 85
BANDS, ROWS_PER_BAND = 32, 7
CIRCLE = 1 << 21
WIDE_SHINGLES = CIRCLE // 64
#: Blocks of a bucket hold about this many nodes and shingles at most.
BLOCK_NODES, BLOCK_SHINGLES = 256, 200_000
#: Pairs whose sketches agree in a share so many deviations below the threshold are not
#: compared in full.
SKETCH_DEVIATIONS = 5
#: The filter before the join with the texts wanted has so many bits a text, and at most so many
#: in all (16 MB). With more texts it lets more others through; the join decides all the same.
FILTER_BITS, MOST_FILTER_BITS = 16, 1 << 27


@functools.cache
def _shifted_permutation(length: int) -> np.ndarray:
    """Row ``s`` holds the second permutation at ``s``, ``s + 1``, ... around the circle."""
    order = np.random.default_rng(20_260).permutation(CIRCLE).astype(np.int32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[: length - 1]]), length)


def signature(shingles: np.ndarray, length: int) -> np.ndarray:
    """Circulant MinHash: one permutation scatters the shingles over a circle, a second one,
    read at every shift of the circle in turn, gives all coordinates."""
    table = _shifted_permutation(length)
    places = np.unique(mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(CIRCLE)).astype(np.int64)
    lowest = table[places[:2_048]].min(axis=0)
    for at in range(2_048, len(places), 2_048):
        np.minimum(lowest, table[places[at: at + 2_048]].min(axis=0), out=lowest)
    return lowest


def wide_signature(shingles: np.ndarray, length: int) -> np.ndarray:
    """The same on a circle of 2 ** 64 places, whose second permutation is calculated."""
    places = mixed(shingles ^ np.uint64(0x2545F4914F6CDD1D))
    shifts = np.arange(length, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    lowest = np.full(length, np.iinfo(np.uint64).max)
    for at in range(0, len(places), 1_024):
        part = mixed(places[at: at + 1_024, None] + shifts[None, :])
        np.minimum(lowest, part.min(axis=0), out=lowest)
    return (lowest >> np.uint64(16)).astype(np.int64)


def sketch_of(shingles: np.ndarray, length: int) -> bytes:
    """A byte of every coordinate, on the circle that a text of this size belongs to."""
    if not len(shingles):
        return b""
    sign = wide_signature if len(shingles) > WIDE_SHINGLES else signature
    return sign(shingles, length).astype(np.uint8).tobytes()


def all_bands(shingles: np.ndarray, percent: int, bands: int, rows: int) -> np.ndarray:
    """Band keys on every circle on which a text that it may be linked with is signed."""
    keys = []
    if len(shingles) * percent <= WIDE_SHINGLES * 100:
        keys.append(band_keys(signature(shingles, bands * rows), bands, rows))
    if len(shingles) * 100 > WIDE_SHINGLES * percent:
        keys.append(~band_keys(wide_signature(shingles, bands * rows), bands, rows))
    return np.concatenate(keys)


def band_keys(signed: np.ndarray, bands: int, rows: int) -> np.ndarray:
    value = np.arange(bands, dtype=np.uint64) + np.uint64(1)
    for row in signed.reshape(bands, rows).T:
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + row.astype(np.uint64))
    return value.view(np.int64)


def _words(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def _same(words: list[bytes]) -> bytes:
    return hashlib.md5(b" ".join(words), usedforsecurity=False).digest()


_SIGNED = pa.struct([("n", pa.int64()), ("same", pa.binary()), ("bands", pa.list_(pa.int64()))])


def _signed(text: Column, percent: int, size: int, bands: int, rows: int) -> Column:
    @F.arrow_udf("n long, same binary, bands array<long>")
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        let_go()
        for batch in batches:
            counts, same, keys = [], [], []
            for content in batch:
                words = _words(content.as_py())
                shingles = shingle_hashes(words, size)
                counts.append(len(shingles))
                if words:
                    same.append(_same(words))
                    keys.append(all_bands(shingles, percent, bands, rows))
                else:
                    same.append(None)
                    keys.append(None)
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(same, pa.binary()), list_array(keys, pa.int64())],
                fields=list(_SIGNED),
            )

    return sign(text)


def _sets(text: Column, size: int, bands: int, rows: int) -> Column:
    @F.arrow_udf("node binary, shingles array<long>, sketch binary")
    def collect(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        let_go()
        for batch in batches:
            nodes, sets, sketches = [], [], []
            for content in batch:
                words = _words(content.as_py())
                nodes.append(_same(words))
                sets.append(shingle_hashes(words, size))
                sketches.append(sketch_of(sets[-1], bands * rows))
            yield pa.StructArray.from_arrays(
                [pa.array(nodes, pa.binary()), list_array([s.view(np.int64) for s in sets], pa.int64()),
                 pa.array(sketches, pa.binary())],
                names=["node", "shingles", "sketch"],
            )

    return collect(text)


def _likely_in(rows: DataFrame, keys: list[str], wanted: DataFrame, wanted_keys: list[str]) -> DataFrame:
    """The rows whose keys are among those wanted, and a few others (one in ``FILTER_BITS`` or so).

    Hashes of the keys are bits of a table of bitmaps, which is of bounded size and broadcast,
    so that rows are left out where they are read and only the others take part in a shuffle.
    """
    bits = min(MOST_FILTER_BITS, max(1 << 15, 1 << (FILTER_BITS * wanted.count()).bit_length()))

    def place(names: list[str]) -> Column:
        return F.pmod(F.xxhash64(*names), F.lit(bits)) + 1

    maps = wanted.select(place(wanted_keys).alias("place")).groupBy(
        F.bitmap_bucket_number("place").alias("map")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("map_bits"))
    at = F.bitmap_bit_position(place(keys)).cast("int")
    byte = F.conv(F.hex(F.substring("map_bits", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    held = F.getbit(byte, F.pmod(at, F.lit(8))) == 1
    return rows.join(F.broadcast(maps), (F.bitmap_bucket_number(place(keys)) == F.col("map")) & held, "left_semi")


def _node_sets(block: pa.Scalar) -> tuple[list[bytes], list[bytes], list[np.ndarray], np.ndarray]:
    entries = block.values
    lists = entries.field("shingles")
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    flat = lists.flatten().to_numpy()
    sets = [flat[a:b] for a, b in zip(offsets, offsets[1:])]
    sketches = np.frombuffer(b"".join(entries.field("sketch").to_pylist()), np.uint8).reshape(len(sets), -1)
    return entries.field("node").to_pylist(), entries.field("component").to_pylist(), sets, sketches


def least_agreement(percent: int, length: int) -> float:
    """Coordinates in which the sketches of two texts at the threshold agree at least."""
    expected, spread = length * percent / 100, math.sqrt(length * percent * (100 - percent)) / 100
    return max(0.0, expected - SKETCH_DEVIATIONS * spread)


def links_between(one: tuple, other: tuple, percent: int) -> list[dict[str, bytes]]:
    """Links that join different components of two blocks; one link joins two components.

    Sketches made on different circles say nothing about each other.
    """
    nodes, components, sets, sketches = one
    nodes_b, components_b, sets_b, sketches_b = other
    parent = {c: c for c in [*components, *components_b]}

    def root(c: bytes) -> bytes:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    sizes_b = np.array([len(s) for s in sets_b])
    least = least_agreement(percent, sketches.shape[1])
    found = []
    for i, own in enumerate(sets):
        agree = (sketches_b == sketches[i]).sum(axis=1)
        close = 100 * np.minimum(sizes_b, len(own)) >= percent * np.maximum(sizes_b, len(own))
        unlike = (sizes_b > WIDE_SHINGLES) != (len(own) > WIDE_SHINGLES)
        for j in np.flatnonzero(((agree >= least) | unlike) & close):
            a, b = root(components[i]), root(components_b[j])
            if a == b:
                continue
            both = len(np.intersect1d(own, sets_b[j], assume_unique=True))
            if 100 * both >= percent * (len(own) + len(sets_b[j]) - both):
                parent[max(a, b)] = min(a, b)
                found.append({"a": nodes[i], "b": nodes_b[j]})
    return found


def _block_links(one: Column, other: Column, percent: int) -> Column:
    kind = pa.list_(pa.struct([("a", pa.binary()), ("b", pa.binary())]))

    @F.arrow_udf("array<struct<a:binary,b:binary>>")
    def compare(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ones, others in batches:
            yield pa.array(
                [links_between(_node_sets(x), _node_sets(y), percent) for x, y in zip(ones, others)], type=kind
            )

    return compare(one, other)


def _leader_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket's smallest node and another one that overlap enough."""
    pairs = members.where("node <> leader").select("leader", "leader_n", "node", "n").distinct().where(
        100 * F.least("n", "leader_n") >= percent * F.greatest("n", "leader_n")
    )
    own = sets.select("node", F.col("shingles").alias("own"))
    leading = sets.select(F.col("node").alias("leader"), F.col("shingles").alias("leading"))
    both = F.size(F.array_intersect("own", "leading"))
    compared = pairs.join(own, "node").join(leading, "leader")
    union = F.size("own") + F.size("leading") - both
    return compared.where(100 * both >= percent * union).select(F.col("leader").alias("a"), F.col("node").alias("b"))


def _rest_links(
    members: DataFrame, components: DataFrame, sets: DataFrame, percent: int, space: Workspace
) -> DataFrame:
    """Links inside buckets whose nodes are still in several components."""
    placed = space.staged(members.join(components, "node", "left").select(
        "bucket", "node", "n", F.coalesce("component", "node").alias("component")
    ), "placed")
    parts = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("shingles"))
    split = parts.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("parts"), F.max_by("component", F.struct("nodes", "component")).alias("main"),
        F.max("nodes").alias("main_nodes"), F.sum("nodes").alias("all_nodes"),
        F.max_by("shingles", F.struct("nodes", "component")).alias("main_shingles"),
        F.sum("shingles").alias("all_shingles"),
    ).where("parts > 1 AND all_nodes > 2")

    def blocks_for(nodes: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(nodes / F.lit(BLOCK_NODES)), F.ceil(shingles / F.lit(BLOCK_SHINGLES))).cast("int")

    in_main = F.col("component") == F.col("main")
    n_main = blocks_for(F.col("main_nodes"), F.col("main_shingles"))
    n_rest = blocks_for(F.col("all_nodes") - F.col("main_nodes"), F.col("all_shingles") - F.col("main_shingles"))
    slot = F.pmod(F.xxhash64("node"), F.when(in_main, n_main).otherwise(n_rest)).cast("int")
    dealt = placed.join(split, "bucket").select(
        "bucket", F.when(in_main, -1 - slot).otherwise(slot).alias("block"), "node", "component"
    )
    blocks = space.staged(dealt.join(sets, "node").groupBy("bucket", "block").agg(
        F.collect_list(F.struct("node", "component", "shingles", "sketch")).alias("held")
    ), "blocks")
    rest = blocks.where("block >= 0").select("bucket", F.col("block").alias("own_block"), F.col("held").alias("own"))
    # blocks of the main part come as -1, -2, ...; the others meet each other once
    met = rest.join(blocks, "bucket").where("block <= own_block")
    found = met.select(F.explode(_block_links(F.col("own"), F.col("held"), percent)).alias("link"))
    return found.select("link.a", "link.b")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT,
    shingle_words: int = SHINGLE_WORDS, bands: int = BANDS, rows_per_band: int = ROWS_PER_BAND,
) -> DataFrame:
    """``key, n_shingles, component_id, text_md5, stands`` for every row of ``docs``.

    ``stands`` marks the rows that stand for their component: those of its smallest id, or of
    one of its texts if it has no id; where that id has several texts of the component, of one.
    ``text_md5`` tells the texts of a repeated id.
    """
    space = Workspace(docs.sparkSession, "near-duplicates")
    picked = docs.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").cast("binary").alias("t")
    )
    text_md5 = F.md5(F.coalesce("t", F.lit(b"")))
    signs = space.staged(
        picked.select("id", text_md5.alias("text_md5"), _signed(F.col("t"), percent, shingle_words, bands, rows_per_band).alias("s"))
        .select("id", "text_md5", "s.n", "s.same", "s.bands"), "signed",
    )
    nodes = space.staged(signs.where("same IS NOT NULL").groupBy(F.col("same").alias("node")).agg(
        F.min(F.struct(F.col("id").isNull(), "id", "text_md5")).alias("held"), F.first("n").alias("n"),
        F.first("bands").alias("bands"),
    ).select("node", F.col("held.id").alias("least"), "held.text_md5", "n", "bands"), "nodes")
    keyed = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    leaders = space.staged(keyed.groupBy("bucket").agg(
        F.min(F.struct("node", "n")).alias("first"), F.max("node").alias("last")
    ).where("first.node <> last"), "leaders")
    members = space.staged(keyed.join(leaders, "bucket").select(
        "bucket", "node", "n", F.col("first.node").alias("leader"), F.col("first.n").alias("leader_n")
    ), "members")
    wanted = space.staged(nodes.join(members.select("node").distinct(), "node", "left_semi").select(
        "least", F.col("text_md5").alias("held")
    ), "wanted")
    # a text is found by the smallest id that has it and its md5, as that id may have other texts
    # too. A join on the node would be pushed below the function and have it read every text.
    texts = _likely_in(picked.withColumn("own", text_md5), ["id", "own"], wanted, ["least", "held"]).join(
        wanted, F.col("id").eqNullSafe(F.col("least")) & (F.col("own") == F.col("held")), "left_semi"
    )
    collected = texts.select(_sets(F.col("t"), shingle_words, bands, rows_per_band).alias("s")).select("s.*")
    sets = space.staged(collected.dropDuplicates(["node"]), "sets")
    links = space.staged(_leader_links(members, sets, percent), "links")
    components = connected_components(links, space)
    rest = space.staged(_rest_links(members, components, sets, percent, space), "links")
    if not rest.isEmpty():
        components = connected_components(links.unionAll(rest), space)
    placed = space.staged(nodes.select("node", "least").join(components, "node", "left").select(
        "node", "least", F.coalesce("component", "node").alias("component")
    ), "placed")
    order = F.struct(F.col("least").isNull().alias("unknown"), "least", "node")
    smallest = space.staged(placed.groupBy("component").agg(F.min(order).alias("first")), "smallest")
    reached = space.staged(placed.join(smallest, "component").select(
        F.col("node").alias("same"), F.col("first.least").alias("reached"), (F.col("node") == F.col("first.node")).alias("main")
    ), "reached")
    component = F.coalesce("reached", "id")
    return space.finished(signs.select("id", "text_md5", "n", "same").join(reached, "same", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), "text_md5",
        (F.col("same").isNull() | (F.col("main") & F.col("id").eqNullSafe(component))).alias("stands"),
    ))
