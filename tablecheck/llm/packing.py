"""Packing: documents into sequences of a fixed length by the sum-of-squares rule.

Each task packs the documents of its own partition, one after another, as they are read:
full windows are cut off a long document, and what is left goes into the fill level that
makes the sum of squared counts of partly filled windows smallest (an empty window is level
0). The counts are one array over the levels. Nothing is shuffled, nothing leaves the task
but finished pieces, and a task that runs again replaces its own sequences as a whole.

When a task ends, or more than ``max_open`` windows are open, the emptiest windows are cut
up to fill the fullest ones. The last window of a task is cut into sequences whose lengths
are powers of two, so nothing is padded.

Tokens come from a public tokenizer file, found and opened where they are made. Words are
looked up in a bounded store of words already seen, which a worker process keeps from task
to task, and only new ones go through the tokenizer; the ids are those of the whole text,
because this vocabulary drops white space and never joins tokens across it.

Defined cases: a null or empty text is the end token alone; a document id may be null or
repeated, each row is packed on its own; an empty table gives no pieces; other columns are
not read.
"""

from __future__ import annotations

import string
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.vocabularies import byte_letters, halved, located, worker_store

WINDOW = 4096
END_TOKEN = 2
MAX_OPEN = 4096
#: Words, and as many chunks of words, that a worker process keeps (some 200 bytes each); of a
#: full store the older half goes.
MAX_STORED = 400_000
SEQUENCES_PER_TASK = 1 << 33

_PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])


class WordTokens(dict):
    """Ids, as little-endian bytes, of a stretch of text without white space."""

    def __init__(self, path: str, max_stored: int = MAX_STORED):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(located(path))
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.words: dict[str, bytes] = {}
        self.max_stored = max_stored

    def _encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """Letters only: one word of the vocabulary's rule, lower-cased and composed."""
        ids = self.words.get(word)
        if ids is None:
            spelled = word.encode().decode("latin-1").translate(self.letters)
            ids = np.array([token.id for token in self.model.tokenize(spelled)], "<u4").tobytes()
            if len(self.words) >= self.max_stored:
                halved(self.words)
            self.words[word] = ids
        return ids

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        letters = text.rstrip(string.punctuation)
        lowered = letters.lower()
        # letters that stay letters; a sigma's lower case depends on its place in Python alone
        simple = letters.isalpha() and (letters.isascii() or (
            lowered.isalpha() and "Σ" not in letters and unicodedata.is_normalized("NFC", letters)
        ))
        if simple:
            tail = text[len(letters):]
            ids = self._word(lowered) + (self[tail.encode()] if tail else b"")
        else:
            ids = self._encoded(text)
        if len(chunk) <= 64:
            if len(self) >= self.max_stored:
                halved(self)
            self[chunk] = ids
        return ids

    def ids(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


class SumOfSquares:
    """Open windows by fill level; ``closed`` gets finished windows as lists of pieces."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.counts = np.zeros(window + 1, np.int64)
        self.levels: dict[int, list[list[tuple]]] = {}
        self.n_open = 0
        self.closed: list[list[tuple]] = []

    def _level_for(self, size: int) -> int:
        """The level whose use leaves the smallest sum of squared counts; the fuller on ties."""
        top = self.window - size
        counts = self.counts
        after = 2 * counts[size: self.window + 1] + 1
        after[-1] = 0  # a full window is no longer counted
        change = after
        change[1:] += 1 - 2 * counts[1: top + 1]
        possible = counts[: top + 1] > 0
        possible[0] = True
        change = np.where(possible, change, np.iinfo(np.int64).max)
        return int(top - np.argmin(change[::-1]))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total = len(ids) // 4
        start = 0
        while total - start >= self.window:
            self.closed.append([(doc_id, start, ids[4 * start: 4 * (start + self.window)], total)])
            start += self.window
        if start < total:
            self._place((doc_id, start, ids[4 * start:], total))
        if self.n_open > self.max_open:
            self.merge()

    def _place(self, piece: tuple) -> None:
        size = len(piece[2]) // 4
        level = self._level_for(size)
        if level:
            pieces = self.levels[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append(piece)
        self._keep(level + size, pieces)

    def _keep(self, level: int, pieces: list[tuple]) -> None:
        if level == self.window:
            self.closed.append(pieces)
        elif level:
            self.levels.setdefault(level, []).append(pieces)
            self.counts[level] += 1
            self.n_open += 1

    def merge(self) -> None:
        """Cut the emptiest windows up to fill the fullest; at most one stays open."""
        held = [(level, pieces) for level in sorted(self.levels) for pieces in self.levels[level]]
        self.levels, self.n_open = {}, 0
        self.counts[:] = 0
        low, high = 0, len(held) - 1
        while low < high:
            level, pieces = held[high]
            gap = self.window - level
            source_level, source = held[low]
            while gap and source:
                doc_id, start, ids, total = source.pop()
                size = len(ids) // 4
                taken = min(size, gap)
                if taken < size:
                    source.append((doc_id, start, ids[: 4 * (size - taken)], total))
                pieces.append((doc_id, start + size - taken, ids[4 * (size - taken):], total))
                gap -= taken
                source_level -= taken
            held[low] = (source_level, source)
            if gap:
                held[high] = (self.window - gap, pieces)
            else:
                self.closed.append(pieces)
                high -= 1
            if not source:
                low += 1
        if low == high:
            self._keep(*held[low])

    def finish(self) -> None:
        """Close everything; the last window goes out in powers of two."""
        self.merge()
        for level, windows in self.levels.items():
            for pieces in windows:
                left = level
                while left:
                    want = 1 << (left.bit_length() - 1)
                    left -= want
                    part = []
                    while want:
                        doc_id, start, ids, total = pieces.pop(0)
                        size = len(ids) // 4
                        taken = min(size, want)
                        if taken < size:
                            pieces.insert(0, (doc_id, start + taken, ids[4 * taken:], total))
                        part.append((doc_id, start, ids[: 4 * taken], total))
                        want -= taken
                    self.closed.append(part)
        self.levels, self.n_open = {}, 0
        self.counts[:] = 0


def _rows(windows: list[list[tuple]], first: int) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in _SCHEMA]
    for number, pieces in enumerate(windows, first):
        offset = 0
        for doc_id, start, ids, total in pieces:
            size = len(ids) // 4
            for column, value in zip(columns, (doc_id, start, size, ids, total, number, offset), strict=True):
                column.append(value)
            offset += size
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", window: int = WINDOW,
    end_token: int = END_TOKEN, max_open: int = MAX_OPEN, max_stored: int = MAX_STORED,
) -> DataFrame:
    """One row per piece: where it comes from, its ids, and its place in a sequence.

    ``tokenizer`` is a path that every executor has, or the name of a public tokenizer file.
    """
    ending = np.array([end_token], "<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_store(("packing", tokenizer, max_stored), lambda: WordTokens(tokenizer, max_stored))
        packer = SumOfSquares(window, max_open)
        number = TaskContext.get().partitionId() * SEQUENCES_PER_TASK
        for batch in batches:
            for doc_id, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                packer.add(doc_id, tokens.ids(content or b"") + ending)
                if len(packer.closed) >= 512:
                    yield _rows(packer.closed, number)
                    number += len(packer.closed)
                    packer.closed = []
        packer.finish()
        if packer.closed:
            yield _rows(packer.closed, number)

    picked = docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").cast("binary").alias("text")
    )
    return picked.mapInArrow(pack, _PIECES)
