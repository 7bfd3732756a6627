"""Spelling variants: words one edit apart, found by Gram matrices of letter counts.

Words are maximal runs of Latin letters, A-Z lower-cased, each with its number of
occurrences ``n``. Two words are near if one inserted, deleted or replaced letter makes one
the other. A word's form is its near word of largest ``n`` (the first in code-point order on
ties), if that is ``ratio`` times its own ``n`` at least; forms are followed to a root.

A replaced letter moves two letter counts by one, an inserted one moves one. So near words
are at most 2 apart in squared distance of their letter counts, which a matrix product of a
block of count vectors with another gives for all pairs of the two blocks at once:
``|x|^2 + |y|^2 - 2 x.y``. What is left is checked letter by letter, in arrays.

Blocks are cut so that near words always meet: by length, and by how many letters fall into
each of some classes of letters, which an edit changes in a known way. The number of classes
grows with the number of words, so that a block keeps about ``BLOCK_WORDS`` of them; larger
blocks are cut into slots of at most that many. Each block meets itself and the adjacent
ones, slot by slot, as rows of their own; no task holds more than two slots at once.

Words are counted inside each task first, in bounded tables, and then by Spark.

Defined cases: null texts have no words; a null id counts as an empty one; repeated rows count
each; texts of any length are read whole; other columns are not read; an empty table gives
an empty one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.upkeep import Workspace

LEAST_LENGTH, LEAST_COUNT = 7, 2
RATIO = 10
#: One run in so many, told by its checksum, loses a letter.
SLIP_EVERY = 31
BLOCK_WORDS = 1_024
#: Words for which one class of letters will do; each further class will do for three times as many.
CLASS_WORDS = 6_000
MAX_CLASSES = 16
#: Words a task counts before it hands them over.
MAX_COUNTED = 400_000

#: Letters by falling frequency in European prose; dealt out to classes in turn.
LETTERS = "etaoinsrhldcumfpgwybvkxjqz"
_FIRST, _LAST = 0xC0, 0xFF
#: A letter's code is its place in here; codes fit a byte.
ALPHABET = np.array([*range(97, 123), *range(_FIRST, _LAST + 1)], "<u4")
#: Counted apart: the 26 plain letters, and the accented ones in six groups. An edit moves such
#: counts no further than it moves those of single letters.
DIMENSIONS = 32
_DIMENSION = np.array([*range(26), *(26 + i % 6 for i in range(_LAST - _FIRST + 1))], np.int64)


def slipped(run: str, start: int, every: int = SLIP_EVERY) -> str:
    """``run``, or ``run`` without one letter where the checksum of id and run says so."""
    h = zlib.crc32(run.encode(), start)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _counted(docs: DataFrame, least_length: int, every: int) -> DataFrame:
    runs = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def handed() -> pa.RecordBatch:
            words, counts = list(held.keys()), list(held.values())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                start = zlib.crc32(f"{key or ''}:".encode())
                for run, n in Counter(runs.findall((text.as_py() or b"").lower().decode("utf-8", "replace"))).items():
                    word = slipped(run, start, every)
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) >= MAX_COUNTED:
                    yield handed()
        if held:
            yield handed()

    return docs.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def classes_for(n_words: int) -> int:
    """More classes for more words: each multiplies the blocks by about three."""
    classes = 1
    while classes < MAX_CLASSES and n_words > CLASS_WORDS * 3 ** (classes - 1):
        classes += 1
    return classes


def _class_letters(classes: int) -> list[str]:
    accented = "".join(map(chr, range(_FIRST, _LAST + 1)))
    return [(LETTERS + accented)[i::classes] for i in range(classes)]


def block_of(word: Column, classes: int) -> Column:
    """Length, and the letters of each class but the last, as an array of numbers."""
    length = F.char_length(word)
    held = [length - F.char_length(F.translate(word, own, "")) for own in _class_letters(classes)[:-1]]
    return F.array(length, *held)


def _adjacent(classes: int) -> list[list[int]]:
    """What to add to a block's key to reach those that a word may meet, one of each two ways.

    A replaced letter moves one from a class to another, an inserted one adds one to one.
    """
    def unit(i: int) -> np.ndarray:
        return np.array([int(i == k) for k in range(classes - 1)], int)

    longer = {(1, *unit(i)) for i in range(classes)}
    same = {(0, *(unit(i) - unit(j))) for i in range(classes) for j in range(classes)}
    return [list(map(int, x)) for x in sorted(longer) + sorted(s for s in same if s >= (0,) * classes)]


def _packed(words: Column) -> Column:
    """The words of a slot, all of one length, as letter codes, and their counts: two byte strings."""
    code = np.zeros(_LAST + 1, np.uint8)
    code[ALPHABET] = np.arange(len(ALPHABET))

    @F.arrow_udf("codes binary, counts binary")
    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            codes, counts = [], []
            for slot in batch:
                text = "".join(slot.values.field("word").to_pylist())
                codes.append(code[np.frombuffer(text.encode("utf-32-le"), "<u4")].tobytes())
                counts.append(slot.values.field("n").to_numpy().astype("<i8").tobytes())
            yield pa.StructArray.from_arrays(
                [pa.array(codes, pa.binary()), pa.array(counts, pa.binary())], names=["codes", "counts"]
            )

    return pack(words)


def _counts(codes: np.ndarray) -> np.ndarray:
    """Letter counts, one row a word."""
    rows = np.arange(len(codes))[:, None] * DIMENSIONS
    counted = np.bincount((rows + _DIMENSION[codes]).ravel(), minlength=len(codes) * DIMENSIONS)
    # squares and products stay exact: below 2 ** 24 in single precision, 2 ** 53 in double
    return counted.reshape(len(codes), DIMENSIONS).astype(np.float32 if codes.shape[1] < 1_000 else np.float64)


def near_pairs(one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the near words of two blocks of letter codes, one row a word; words of
    ``other`` are as long as those of ``one`` or one letter longer."""
    x, y = _counts(one), _counts(other)
    # the product of the widened rows is |x|^2 + |y|^2 - 2 x.y; all are small whole numbers
    wide_x = np.hstack([-2 * x, (x * x).sum(axis=1)[:, None], np.ones((len(x), 1), x.dtype)])
    wide_y = np.hstack([y, np.ones((len(y), 1), y.dtype), (y * y).sum(axis=1)[:, None]])
    i, j = np.divmod(np.flatnonzero(wide_x @ wide_y.T < 2.5), len(y))
    a, b = one[i], other[j]
    if a.shape[1] == b.shape[1]:
        edited = (a != b).sum(axis=1) == 1
    else:
        # letters equal from the left without a shift, and from the right with a shift of one
        left = np.cumprod(a == b[:, :-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
        right = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
        edited = left + right >= a.shape[1]
    return i[edited], j[edited]


def _spelled(codes: np.ndarray) -> list[str]:
    text, length = ALPHABET[codes].tobytes().decode("utf-32-le"), codes.shape[1]
    return [text[at: at + length] for at in range(0, len(text), length)]


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The near words of each two slots that meet."""
    for batch in batches:
        for at in range(batch.num_rows):
            length, longer, itself, codes, counts, codes_b, counts_b = (c[at].as_py() for c in batch.columns)
            one = np.frombuffer(codes, np.uint8).reshape(-1, length)
            other = np.frombuffer(codes_b, np.uint8).reshape(-1, longer)
            i, j = near_pairs(one, other)
            if itself:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield pa.RecordBatch.from_arrays([
                    pa.array(_spelled(one[i]), pa.string()), pa.array(np.frombuffer(counts, "<i8")[i]),
                    pa.array(_spelled(other[j]), pa.string()), pa.array(np.frombuffer(counts_b, "<i8")[j]),
                ], names=["a", "na", "b", "nb"])


def _pairs(words: DataFrame, n_words: int, space: Workspace) -> DataFrame:
    classes = classes_for(n_words)
    keyed = words.withColumn("block", block_of(F.col("word"), classes))
    sizes = space.staged(keyed.groupBy("block").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_WORDS)).cast("int").alias("slots")
    ), "sizes")
    slots = space.staged(
        keyed.join(sizes, "block").withColumn("slot", F.pmod(F.xxhash64("word"), F.col("slots")).cast("int"))
        .groupBy("block", "slot").agg(F.collect_list(F.struct("word", "n")).alias("held"))
        .select("block", "slot", _packed(F.col("held")).alias("p")).select("block", "slot", "p.codes", "p.counts"),
        "slots",
    )
    steps = F.explode(F.array(*[F.array(*map(F.lit, step)) for step in _adjacent(classes)]))
    meets = (
        sizes.select("block", F.col("slots").alias("own_slots"), steps.alias("step"))
        .withColumn("other", F.zip_with("block", "step", lambda a, b: a + b))
        .join(sizes.select(F.col("block").alias("other"), F.col("slots").alias("other_slots")), "other")
        .select("block", "other", F.explode(F.sequence(F.lit(0), F.col("own_slots") - 1)).alias("slot"), "other_slots")
        .select("block", "other", "slot", F.explode(F.sequence(F.lit(0), F.col("other_slots") - 1)).alias("other_slot"))
        .where("block <> other OR slot <= other_slot")
    )
    other = slots.select(*[F.col(c).alias(f"other_{c}" if c != "block" else "other") for c in slots.columns])
    itself = (F.col("block") == F.col("other")) & (F.col("slot") == F.col("other_slot"))
    meeting = meets.join(slots, ["block", "slot"]).join(other, ["other", "other_slot"]).select(
        F.col("block")[0].alias("length"), F.col("other")[0].alias("longer"), itself.alias("itself"),
        "codes", "counts", "other_codes", "other_counts",
    )
    return meeting.mapInArrow(_met, "a string, na long, b string, nb long")


def _followed(forms: DataFrame, space: Workspace) -> DataFrame:
    """``word, root`` of all words with a form. A form is ``ratio`` times as frequent as its
    word, so there are no circles; each round doubles the steps taken."""
    roots = space.staged(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not roots.where("moved").isEmpty():
        further = roots.select(F.col("word").alias("via"), F.col("root").alias("further"))
        roots = space.staged(roots.join(further, F.col("root") == F.col("via"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        ), "roots")
    return roots.select("word", "root")


def spelling_variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT, ratio: int = RATIO, slip_every: int = SLIP_EVERY,
) -> DataFrame:
    """``word, n, form, form_n, n_near, root`` of every word of ``docs``."""
    space = Workspace(docs.sparkSession, "spelling")
    picked = docs.select(
        F.col(f"`{key}`").cast("string").alias("id"), F.col(f"`{text}`").cast("string").cast("binary").alias("t")
    )
    words = space.staged(_counted(picked, least_length, slip_every).where(F.col("n") >= least_count), "words")
    pairs = space.staged(_pairs(words, words.count(), space), "pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n")).unionAll(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("near_n"))
    )
    # the smallest of (-n, word) is the first of the most frequent
    nearest = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("first")
    )
    known = words.join(nearest, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("first.less") >= ratio * F.col("n"), F.struct(F.col("first.near"), (-F.col("first.less")).alias("n")))
        .alias("form"),
    )
    known = space.staged(known.select("word", "n", "n_near", F.col("form.near").alias("form"), F.col("form.n").alias("form_n")), "known")
    roots = _followed(known.where("form IS NOT NULL").select("word", "form"), space)
    return space.finished(known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word")))
