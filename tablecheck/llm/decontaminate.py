"""Benchmark decontamination: every passage of every text asks a BM25 index of test items.

The index holds the test items; the passages of the training texts are the queries, cut as
overlapping windows wide enough to hold any item whole. An item's score for a passage is
BM25 over their common words, divided by the least score with which the item can still count
as a leak: its score for itself without the best words of the shingles that may be missing
(``least_share``). So one threshold, 1, serves all items, and no leak lies below it. All items
at or above it are retrieved:

1. Each item's rarest words, together more than what may be missing of its score, have
   their own essential posting lists. A passage can reach the threshold only if what it
   finds there plus the item's whole remainder does; this is summed for all passages at once.
2. Passages that pass are run through block-max WAND over the full lists: the pivot rule
   on list maxima, then on block maxima, then the exact score.

A retrieved item counts as a leak when enough of its five-word shingles stand in the passage
and its surroundings, over all and in question and answer alone. Without an answer column
the second half of an item stands for the answer.

The index is built from parts of at most ``PART_BYTES`` of item text (one part in all but
extreme cases), each of which travels as a broadcast; document frequencies are those of all
items. Texts are scanned once a part, without a shuffle.

Defined cases: null or wordless texts leak nothing; null or wordless items are never found;
items shorter than five words are one shingle; items with equal text are all reported;
repeated rows get equal answers, once a row; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.shingles import plain_words, shingle_hashes, shingle_sequence
from tablecheck.sources.scratch import staged

#: In shares of the least score of a leak.
THRESHOLD = 1.0
#: Items that could lose nearly all their score are asked for from this share of it on.
LEAST_SHARE = 0.02
SHINGLE_WORDS = 5
OVERLAP, PART_OVERLAP = 0.8, 0.5
K1, B = 1.2, 0.75
ESSENTIAL_SHARE = 0.7
BLOCK = 64
PART_BYTES = 32_000_000
#: Words of texts scanned together; bounds a task's memory.
WORDS_AT_ONCE = 400_000


class Postings:
    """One word's items in order with their shares of score, and block maxima."""

    __slots__ = ("block_last", "block_most", "items", "most", "shares")

    def __init__(self, items: list[int], shares: list[float]):
        self.items, self.shares = items, shares
        self.most = max(shares)
        self.block_most = [max(shares[i: i + BLOCK]) for i in range(0, len(items), BLOCK)]
        self.block_last = [items[min(i + BLOCK, len(items)) - 1] for i in range(0, len(items), BLOCK)]


def block_max_wand(lists: Sequence[Postings], threshold: float) -> list[tuple[int, float]]:
    """All ``(item, score)`` with a score of at least ``threshold``, items in order."""
    least = threshold - 1e-9
    cursors = [[p.items[0], 0, p] for p in lists]  # current item, place in the list, list
    found = []
    while cursors:
        cursors.sort(key=lambda c: c[0])
        bound = 0.0
        pivot = -1
        for n, cursor in enumerate(cursors):
            bound += cursor[2].most
            if bound >= least:
                pivot = n
                break
        if pivot < 0:
            break
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        # the same bound with the maxima of the blocks that could hold the item
        bound, next_item = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else math.inf
        for _, at, postings in cursors[: pivot + 1]:
            block = at // BLOCK
            while block < len(postings.block_last) and postings.block_last[block] < item:
                block += 1
            if block < len(postings.block_last):
                bound += postings.block_most[block]
                next_item = min(next_item, postings.block_last[block] + 1)
        if bound < least:
            target = max(next_item, item + 1)
        elif cursors[0][0] == item:
            score = sum(p.shares[at] for _, at, p in cursors[: pivot + 1])
            if score >= least:
                found.append((item, score))
            target = item + 1
        else:
            target = item
        for cursor in cursors[: pivot + 1]:
            if cursor[0] < target:
                items, at = cursor[2].items, cursor[1]
                while at < len(items) and items[at] < target:
                    block_end = (at // BLOCK + 1) * BLOCK
                    at = block_end if block_end <= len(items) and items[block_end - 1] < target else at + 1
                cursor[1] = at
                cursor[0] = items[at] if at < len(items) else math.inf
        cursors = [c for c in cursors if c[0] != math.inf]
    return found


@dataclass(frozen=True)
class ItemIndex:
    ids: list[int]
    parts: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]  # shingle size; those of all, question, answer
    lists: dict[bytes, Postings]
    essential: dict[bytes, int]
    starts: np.ndarray  # of each essential word's items in ``items`` and ``shares``
    items: np.ndarray
    shares: np.ndarray
    remainder: np.ndarray
    kept: np.ndarray  # the share of its score that is 1 here
    stride: int


def least_share(words: Sequence[bytes], shares: dict[bytes, float], overlap: float, size: int = SHINGLE_WORDS) -> float:
    """A share of its score that an item keeps as long as ``overlap`` of its shingles stand.

    Whatever words go, at least as many of its shingles go with them; so no more is lost than
    the best words in as many places as shingles may be missing, a word's share being spread
    over its places.
    """
    places = max(1, len(words) - size + 1)
    distinct = len({tuple(words[i: i + size]) for i in range(places)})
    missing = places - math.ceil(overlap * distinct - 1e-9)
    often = Counter(words)
    lost = sum(sorted((shares[w] / often[w] for w in words), reverse=True)[:missing])
    return max(LEAST_SHARE, 1 - lost)


def build_index(
    items: Sequence[tuple[int, list[bytes], int]], frequency: dict[bytes, int], n_items: int, mean_words: float,
    overlap: float = OVERLAP,
) -> ItemIndex:
    """Index of ``(id, words, words in the question)`` under the statistics of all items."""
    postings: dict[bytes, list[tuple[int, float]]] = {}
    essential: dict[bytes, list[tuple[int, float]]] = {}
    remainder, kept = np.ones(len(items)), np.ones(len(items))
    parts = []
    for number, (_, words, n_question) in enumerate(items):
        damping = K1 * (1 - B + B * len(words) / mean_words)
        shares = {}
        for word, n in Counter(words).items():
            rarity = math.log(1 + (n_items - frequency[word] + 0.5) / (frequency[word] + 0.5))
            shares[word] = rarity * n * (K1 + 1) / (n + damping)
        whole = sum(shares.values())
        shares = {word: share / whole for word, share in shares.items()}
        least = kept[number] = least_share(words, shares, overlap)
        own = 0.0
        for word in sorted(shares, key=lambda w: (frequency[w], -shares[w], w)):
            share = shares[word]
            postings.setdefault(word, []).append((number, share / least))
            if own < max(ESSENTIAL_SHARE, 1 - least + 0.05):
                essential.setdefault(word, []).append((number, share / least))
                own += share
        remainder[number] = (1 - own) / least
        size = min(SHINGLE_WORDS, len(words))
        runs = shingle_sequence(words, size)
        parts.append((size, *map(np.unique, (runs, runs[:n_question], runs[max(0, n_question - size + 1):]))))
    numbers = {word: i for i, word in enumerate(sorted(essential))}
    flat = [entry for word in numbers for entry in essential[word]]
    return ItemIndex(
        ids=[i for i, _, _ in items], parts=parts,
        lists={w: Postings([i for i, _ in p], [s for _, s in p]) for w, p in postings.items()},
        essential=numbers, starts=np.cumsum([0, *(len(essential[w]) for w in numbers)]),
        items=np.array([i for i, _ in flat], np.int64), shares=np.array([s for _, s in flat]),
        remainder=remainder, kept=kept, stride=max([8, *(math.ceil(1.25 * len(w)) for _, w, _ in items)]),
    )


def _candidate_windows(index: ItemIndex, texts: list[list[bytes]], threshold: float) -> list[tuple[int, int]]:
    """``(text, window)`` pairs whose essential words and remainders may reach the threshold."""
    sizes = np.array([len(t) for t in texts], np.int64)
    windows = np.maximum(1, -(-sizes // index.stride))
    first_window = np.concatenate([[0], np.cumsum(windows)])
    get = index.essential.get
    words = np.array([n for t in texts for n in map(get, t, repeat(-1))], np.int64)
    hits = np.flatnonzero(words >= 0)
    if not len(hits):
        return []
    starts = np.concatenate([[0], np.cumsum(sizes)])
    text = np.searchsorted(starts, hits, side="right") - 1
    at = (hits - starts[text]) // index.stride
    own = first_window[text] + at
    n_words = len(index.essential)
    both = np.concatenate([own * n_words + words[hits], (own[at > 0] - 1) * n_words + words[hits][at > 0]])
    distinct = np.unique(both)
    window, word = distinct // n_words, distinct % n_words
    counts = index.starts[word + 1] - index.starts[word]
    place = np.repeat(index.starts[word] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    pairs, inverse = np.unique(np.repeat(window, counts) * len(index.ids) + index.items[place], return_inverse=True)
    reached = np.bincount(inverse, index.shares[place]) + index.remainder[pairs % len(index.ids)]
    good = np.unique(pairs[reached >= threshold - 1e-9] // len(index.ids))
    text = np.searchsorted(first_window, good, side="right") - 1
    return list(zip(text.tolist(), (good - first_window[text]).tolist(), strict=True))


def _share(part: np.ndarray, there: np.ndarray) -> float:
    return float(np.isin(part, there, assume_unique=True).mean()) if len(part) else 1.0


def find_leaks(
    index: ItemIndex, texts: list[list[bytes]], threshold: float, overlap: float, part_overlap: float
) -> list[list[dict]]:
    """For every text the items it leaks, each once, where it scores highest."""
    best: list[dict[int, dict]] = [{} for _ in texts]
    for text, window in _candidate_windows(index, texts, threshold):
        words = texts[text]
        first = window * index.stride
        lists = [index.lists[w] for w in set(words[first: first + 2 * index.stride]) if w in index.lists]
        for number, score in block_max_wand(lists, threshold):
            known = best[text].get(number)
            score *= index.kept[number]
            if known and known["score"] >= score:
                continue
            size, *own = index.parts[number]
            near = words[max(0, first - index.stride // 2): first + 2 * index.stride + index.stride // 2]
            there = shingle_hashes(near, size) if len(near) >= size else shingle_hashes([], size)
            whole, question, answer = (_share(part, there) for part in own)
            if whole >= overlap and min(question, answer) >= part_overlap:
                best[text][number] = {
                    "item_id": index.ids[number], "start": first, "score": float(score), "overlap": whole,
                    "question": question, "answer": answer,
                }
    return [[found[n] for n in sorted(found)] for found in best]


_LEAK = pa.struct([
    ("item_id", pa.int64()), ("start", pa.int64()), ("score", pa.float64()), ("overlap", pa.float64()),
    ("question", pa.float64()), ("answer", pa.float64()),
])
_LEAKS = "array<struct<item_id:long,start:long,score:double,overlap:double,question:double,answer:double>>"


def _words(text: Column) -> Column:
    @F.arrow_udf("array<binary>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([plain_words(x) for x in batch.to_pylist()], pa.list_(pa.binary()))

    return cut(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def leak_indexes(
    items: DataFrame, key: str = "item_id", text: str = "text", answer: str | None = None,
    overlap: float = OVERLAP, part_bytes: int = PART_BYTES,
) -> Iterator[ItemIndex]:
    """The index of the test items, in parts of bounded size."""
    asked = F.col(f"`{text}`")
    answered = _words(F.col(f"`{answer}`")) if answer else F.array().cast("array<binary>")
    # the filter is for what was written: pushed below the function it would have it run twice, in
    # two worker processes a task, which stay and serve later stages
    rows = staged(
        items.select(F.col(f"`{key}`").cast("long").alias("id"), _words(asked).alias("asked"), answered.alias("answered"))
        .select("id", F.concat("asked", "answered").alias("words"), F.size("asked").alias("n_asked")), "items",
    ).where(F.size("words") > 0)
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("mean"),
        F.sum(F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.octet_length(w) + 8)).alias("bytes"),
    ).first()
    if not facts["n"]:
        return
    n_parts = math.ceil(facts["bytes"] / part_bytes)
    frequency = rows.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )
    for part in range(n_parts):
        own = rows.where(F.pmod(F.xxhash64("id", "words"), F.lit(n_parts)) == part)
        # as many rows as the part's bytes allow
        held = sorted((r["id"] is None, r["id"] or 0, [bytes(w) for w in r["words"]], r["n_asked"]) for r in own.collect())
        if not held:
            continue
        wanted = own.select(F.explode("words").alias("word")).distinct()
        counts = {bytes(r["word"]): r["n"] for r in frequency.join(wanted, "word").collect()}
        yield build_index(
            [(None if gone else i, words, n if answer else (len(words) + 1) // 2) for gone, i, words, n in held],
            counts, facts["n"], facts["mean"], overlap,
        )


def leaks_column(
    index: ItemIndex, text: Column, docs: DataFrame, overlap: float = OVERLAP, part_overlap: float = PART_OVERLAP,
) -> Column:
    """The items of one index part that a text column of ``docs`` leaks, as an array."""
    shipped = docs.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf(_LEAKS)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found, held, n_held = [], [], 0
            for content in batch:
                held.append(plain_words(content.as_py()))
                n_held += len(held[-1])
                if n_held >= WORDS_AT_ONCE:
                    found += find_leaks(shipped.value, held, THRESHOLD, overlap, part_overlap)
                    held, n_held = [], 0
            found += find_leaks(shipped.value, held, THRESHOLD, overlap, part_overlap) if held else []
            yield pa.array(found, type=pa.list_(_LEAK))

    return scan(text.cast("string").cast("binary"))


def benchmark_leaks(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", item_answer: str | None = None, overlap: float = OVERLAP,
    part_overlap: float = PART_OVERLAP,
) -> DataFrame:
    """``key, item_id, start, score, overlap, question, answer``: one row for each item a row of
    ``docs`` leaks, with the word its best passage starts at."""
    picked = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    found = None
    for index in leak_indexes(items, item_key, item_text, item_answer, overlap):
        leaks = leaks_column(index, F.col("t"), docs, overlap, part_overlap)
        part = picked.select("k", F.explode(leaks).alias("leak")).select(F.col("k").alias(key), "leak.*")
        found = part if found is None else found.unionAll(part)
    if found is not None:
        return found
    empty = F.lit(None).cast(_LEAKS)
    return picked.select("k", F.explode(empty).alias("leak")).select(F.col("k").alias(key), "leak.*")


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, as they are, that leak no item."""
    clean = docs
    for index in leak_indexes(items, **options):
        clean = clean.where(F.size(F.coalesce(leaks_column(index, F.col(f"`{text}`"), docs), F.array())) == 0)
    return clean
