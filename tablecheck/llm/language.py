"""Language identification word by word with a linear-chain conditional random field.

Every word gets a score for each language from hashed features: all its character n-grams
up to four letters (with word borders marked, so the outer ones are its affixes) and the
word itself (a lexicon entry). Learned transitions tie neighbouring words together, and
forward-backward gives each word its language probabilities, so texts that switch between
languages are labelled piece by piece. A document gets the language with the largest mean
probability over all its words.

Training: ``fit_language_model`` takes a bounded sample, about ``docs_per_language``
labelled documents of each language, chosen by a hash of the id, and of each a stretch of at
most ``sample_chars`` characters, from a place chosen by that hash too. Sequences that switch language are made by joining
stretches of different documents. The model is a few MB whatever the size of the table, and
travels as a broadcast; labelling is one pass without a shuffle.

Long documents are labelled in stretches of ``STRETCH`` words side by side; each stretch
sees ``MARGIN`` words on either side, beyond which a chain forgets. All words count.

Defined cases: a null text or one without a letter is ``und`` with score 0.0; so is every
text if nothing could be learned; a run of letters over 24 is read in parts of 24; repeated
rows get equal answers; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.vocabularies import let_go

UNDETERMINED = "und"
DOCS_PER_LANGUAGE = 400
SAMPLE_CHARS = 6_000
#: Labels of more than so many kinds are no languages.
MAX_LANGUAGES = 256
N_BUCKETS = 1 << 17
LONGEST_WORD = 24
STRETCH, MARGIN = 480, 16
#: Words whose scores a task remembers, and words labelled at once; both bound its memory.
MAX_STORED, WORDS_AT_ONCE = 150_000, 100_000
#: Stretches labelled side by side.
SIDE_BY_SIDE = 512

_WORDS = re.compile(r"[^\W\d_]{1,%d}" % LONGEST_WORD)


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def feature_buckets(words: Sequence[str], n_buckets: int = N_BUCKETS) -> np.ndarray:
    """One row of bucket numbers a word; ``n_buckets`` itself stands for no feature."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    widest = int(lengths.max(initial=0))
    # every word as code points between two border marks
    points = np.zeros((len(words), widest + 2), np.uint64)
    filled = np.arange(widest)[None, :] < lengths[:, None]
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    points[:, 1: widest + 1][filled] = letters
    points[:, 0] = 1
    points[np.arange(len(words)), lengths + 1] = 2
    ends = lengths + 2
    columns = []
    rolling = np.zeros_like(points)
    for order in range(1, 5):
        n = points.shape[1] - order + 1
        if n <= 0:
            break
        rolling = rolling[:, :n] * np.uint64(1_000_003) + points[:, order - 1: order - 1 + n]
        buckets = _mixed(rolling + np.uint64(order << 56)) % np.uint64(n_buckets)
        present = np.arange(n)[None, :] + order <= ends[:, None]
        columns.append(np.where(present, buckets, np.uint64(n_buckets)))
    powers = np.uint64(0x9E3779B97F4A7C15) ** np.arange(1, widest + 3, dtype=np.uint64)
    whole = _mixed((points * powers[None, :]).sum(axis=1, dtype=np.uint64) + np.uint64(7 << 56))
    columns.append((whole % np.uint64(n_buckets))[:, None])
    return np.concatenate(columns, axis=1).astype(np.int32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def forward_backward(scores: np.ndarray, moves: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label probabilities of many sequences at once.

    ``scores`` is (time, sequence, label), longest sequence first; ``active[t]`` sequences
    reach time ``t``. Returns the probabilities, the expected number of each move summed
    over all sequences, and the scaled forward values.
    """
    steps = len(active)
    emitted = np.exp(scores - scores.max(axis=2, keepdims=True))
    weights = np.exp(moves)
    forward = np.zeros_like(emitted)
    for t in range(steps):
        n = active[t]
        value = emitted[t, :n] if t == 0 else emitted[t, :n] * (forward[t - 1, :n] @ weights)
        forward[t, :n] = value / value.sum(axis=1, keepdims=True)
    backward = np.ones(emitted.shape[1:], emitted.dtype)
    probabilities = np.zeros_like(emitted)
    expected = np.zeros_like(weights)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        if t + 1 < steps:
            m = active[t + 1]
            onward = emitted[t + 1, :m] * backward[:m]
            # joint probabilities of the labels at t and t + 1, each sequence scaled to one
            scale = np.einsum("bi,ij,bj->b", forward[t, :m], weights, onward)
            expected += weights * (forward[t, :m] / scale[:, None]).T.dot(onward)
            moved = onward @ weights.T
            backward[:m] = moved / moved.sum(axis=1, keepdims=True)
        value = forward[t, :n] * backward[:n]
        probabilities[t, :n] = value / value.sum(axis=1, keepdims=True)
    return probabilities, expected, forward


@dataclass(frozen=True)
class LanguageModel:
    labels: tuple[str, ...]
    weights: np.ndarray  # (bucket, label); the last row is zero
    moves: np.ndarray  # (label, label)
    seen: np.ndarray  # of each bucket, whether a word of the sample has it; the last has not

    def word_scores(self, words: Sequence[str]) -> np.ndarray:
        """The score of each label, and last the share of a word's features that were learned."""
        scores = np.zeros((len(words), len(self.labels) + 1), np.float32)
        for at in range(0, len(words), 8_192):
            buckets = feature_buckets(words[at: at + 8_192], len(self.weights) - 1)
            own = scores[at: at + 8_192]
            for column in range(buckets.shape[1]):
                own[:, :-1] += self.weights[buckets[:, column]]
            own[:, -1] = self.seen[buckets].sum(axis=1) / (buckets < len(self.weights) - 1).sum(axis=1)
        return scores


def train(
    texts: Sequence[tuple[str, str]], steps: int = 240, sequences: int = 160, length: int = 48, seed: int = 7
) -> LanguageModel:
    """A model of ``(text, label)`` pairs, by gradient steps on the chain's likelihood."""
    labels = tuple(sorted({label for _, label in texts}))
    number = {label: i for i, label in enumerate(labels)}
    by_label: list[list[list[str]]] = [[] for _ in labels]
    for text, label in texts:
        words = words_of(text)
        if words:
            by_label[number[label]].append(words)
    usable = [i for i, docs in enumerate(by_label) if docs]
    if not usable:
        return LanguageModel((), np.zeros((1, 0), np.float32), np.zeros((0, 0), np.float32), np.zeros(1, bool))
    n_labels = len(labels)
    vocabulary: dict[str, int] = {}
    for docs in by_label:
        for words in docs:
            for word in words:
                vocabulary.setdefault(word, len(vocabulary))
    known = list(vocabulary)
    buckets = feature_buckets(known)
    numbered = [[np.array([vocabulary[w] for w in words]) for words in docs] for docs in by_label]
    weights = np.zeros((N_BUCKETS + 1, n_labels))
    moves = np.zeros((n_labels, n_labels))
    seen, seen_moves = np.full_like(weights, 1e-6), np.full_like(moves, 1e-6)
    rng = np.random.default_rng(seed)

    def stretch(label: int, size: int) -> np.ndarray:
        words = numbered[label][rng.integers(len(numbered[label]))]
        first = int(rng.integers(len(words)))
        return np.take(words, np.arange(first, first + size), mode="wrap")

    for _ in range(steps):
        words = np.empty((length, sequences), np.int64)
        truth = np.empty((length, sequences), np.int64)
        for s in range(sequences):
            at = 0
            while at < length:
                size = min(length - at, int(rng.integers(length // 4, 2 * length)))
                label = usable[int(rng.integers(len(usable)))]
                words[at: at + size, s] = stretch(label, size)
                truth[at: at + size, s] = label
                at += size
        distinct, place = np.unique(words, return_inverse=True)
        own = buckets[distinct]
        scores = weights[own].sum(axis=1)[place.reshape(words.shape)]
        probabilities, expected, _ = forward_backward(scores, moves, np.full(length, sequences))
        slope = -probabilities
        slope[np.arange(length)[:, None], np.arange(sequences)[None, :], truth] += 1
        for label in range(n_labels):
            of_word = np.bincount(place.ravel(), slope[..., label].ravel(), len(distinct))
            step = np.bincount(own.ravel(), np.repeat(of_word, own.shape[1]), N_BUCKETS + 1)
            step = step - 1e-3 * weights[:, label]
            step[-1] = 0
            seen[:, label] += step * step
            weights[:, label] += 0.1 * step / np.sqrt(seen[:, label])
        observed = np.zeros_like(moves)
        np.add.at(observed, (truth[:-1].ravel(), truth[1:].ravel()), 1)
        step = observed - expected
        seen_moves += step * step
        moves += 0.2 * step / np.sqrt(seen_moves)
    learned = np.zeros(N_BUCKETS + 1, bool)
    learned[buckets] = True
    learned[-1] = False
    return LanguageModel(labels, weights.astype(np.float32), moves.astype(np.float32), learned)


def fit_language_model(
    docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang",
    docs_per_language: int = DOCS_PER_LANGUAGE, sample_chars: int = SAMPLE_CHARS,
) -> LanguageModel:
    """Learn from a bounded sample of the labelled rows of ``docs``.

    Languages are counted first (ids and labels only); a row joins the sample when a hash of
    its id falls below ``docs_per_language`` in the rows of its language, so the driver gets
    about that many texts of each language whatever the table holds.
    """
    rows = docs.select(
        F.col(f"`{key}`").cast("string").alias("k"), F.col(f"`{text}`").cast("string").alias("t"),
        F.col(f"`{label}`").cast("string").alias("g"),
    ).where("g IS NOT NULL AND k IS NOT NULL")
    sizes = rows.where("t IS NOT NULL").groupBy("g").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if not sizes:
        return train([])
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in column {label!r}")
    wanted = F.element_at(
        F.create_map(*[x for r in sizes for x in (F.lit(r["g"]), F.lit(min(1.0, docs_per_language / r["n"])))]), F.col("g")
    )
    chance = F.pmod(F.xxhash64(F.lit("language sample"), "k"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    starts = F.greatest(F.char_length("t") - F.lit(sample_chars), F.lit(0)) + 1
    stretch = F.substr("t", 1 + F.pmod(F.xxhash64(F.lit("language stretch"), "k"), starts).cast("int"), F.lit(sample_chars))
    sample = rows.where("t IS NOT NULL").where(chance < wanted).select("k", stretch.alias("t"), "g")
    taken = sorted(sample.toLocalIterator(), key=lambda r: (r["g"], r["k"], r["t"]))
    return train([(r["t"], r["g"]) for r in taken])


class Labeller:
    """Language probabilities of texts, remembering the scores of words already seen."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.labels) + 1), np.float32)

    def _numbers(self, words: list[str]) -> np.ndarray:
        place = self.place
        fresh = list(dict.fromkeys(w for w in words if w not in place))
        if fresh:
            start = len(place)
            place.update(zip(fresh, range(start, start + len(fresh)), strict=True))
            self.scores = np.concatenate([self.scores, self.model.word_scores(fresh)])
        return np.fromiter(map(place.__getitem__, words), np.int64, len(words))

    def shares(self, texts: Sequence[str | None]) -> np.ndarray:
        """(text, label): mean probability over the words; zeros for texts without a letter."""
        return self.described(texts)[:, :-1]

    def described(self, texts: Sequence[str | None]) -> np.ndarray:
        """The shares, and last the mean share of the words' features that were learned."""
        result = np.zeros((len(texts), len(self.model.labels) + 1))
        if not self.model.labels:
            return result
        held: list[tuple[int, list[str]]] = []
        n_held = 0
        for i, text in enumerate(texts):
            words = words_of(text) if text and has_letter(text) else []
            for at in range(0, len(words), WORDS_AT_ONCE):
                part = words[max(0, at - MARGIN): at + WORDS_AT_ONCE]
                held.append((i, part))
                n_held += len(part)
                if n_held >= WORDS_AT_ONCE:
                    self._label(held, result)
                    held, n_held = [], 0
        if held:
            self._label(held, result)
        totals = result[:, :-1].sum(axis=1, keepdims=True)
        return np.divide(result, totals, out=result, where=totals > 0)

    def _label(self, held: list[tuple[int, list[str]]], result: np.ndarray) -> None:
        if len(self.place) >= MAX_STORED:
            self._forget()
        numbers = self._numbers([w for _, words in held for w in words])
        pieces = []  # (length, first word, words before the stretch, words of the stretch, text)
        first = 0
        for i, words in held:
            for at in range(0, len(words), STRETCH):
                low, high = max(0, at - MARGIN), min(len(words), at + STRETCH + MARGIN)
                pieces.append((high - low, first + low, at - low, min(STRETCH, len(words) - at), i))
            first += len(words)
        pieces.sort(key=lambda p: -p[0])
        shape = np.array(pieces, np.int64)
        lengths = shape[:, 0]
        for group in range(0, len(pieces), SIDE_BY_SIDE):
            own = shape[group: group + SIDE_BY_SIDE]
            longest = int(own[0, 0])
            times = np.arange(longest)
            active = np.searchsorted(-own[:, 0], -times, side="left")
            places = np.minimum(own[None, :, 1] + times[:, None], len(numbers) - 1)
            scores = self.scores[numbers[places]]
            probabilities, _, _ = forward_backward(scores[..., :-1], self.model.moves, active)
            inside = (times[:, None] >= own[None, :, 2]) & (times[:, None] < own[None, :, 2] + own[None, :, 3])
            counted = inside.astype(np.float32)
            summed = np.einsum("tbl,tb->bl", probabilities, counted)
            np.add.at(result, own[:, 4], np.hstack([summed, (scores[..., -1] * counted).sum(axis=0)[:, None]]))


_ANSWER = pa.struct([
    ("language", pa.string()), ("score", pa.float64()), ("shares", pa.map_(pa.string(), pa.float64())),
    ("familiar", pa.float64()),
])


def language_column(model: LanguageModel, text: Column, docs: DataFrame) -> Column:
    """A struct ``language, score, shares, familiar`` for a text column of ``docs``.

    ``familiar`` is the mean share of a word's features that the model has learned: near 1 in
    the languages it knows, well below in others, whose labels are guesses. The function is
    not declared deterministic: a filter on its answer would be pushed below the projection and
    have every text labelled twice, in two worker processes a task.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("language string, score double, shares map<string,double>, familiar double")
    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        let_go()
        labeller = Labeller(shipped.value)
        names = shipped.value.labels
        for batch in batches:
            described = labeller.described(batch.to_pylist())
            rows = []
            for row, familiar in zip(described[:, :-1], described[:, -1].tolist(), strict=True):
                if row.any():
                    best = int(row.argmax())
                    listed = [(names[i], float(row[i])) for i in np.flatnonzero(row > 0.005)]
                    rows.append({"language": names[best], "score": min(1.0, float(row[best])), "shares": listed, "familiar": familiar})
                else:
                    rows.append({"language": UNDETERMINED, "score": 0.0, "shares": [], "familiar": 0.0})
            yield pa.array(rows, type=_ANSWER)

    return label.asNondeterministic()(text.cast("string"))


def identify_language(model: LanguageModel, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, language, score, shares, familiar`` for every row."""
    picked = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    labelled = picked.select("k", language_column(model, F.col("t"), docs).alias("a"))
    return labelled.select(F.col("k").alias(key), "a.language", "a.score", "a.shares", "a.familiar")
