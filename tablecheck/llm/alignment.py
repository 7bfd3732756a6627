"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

A text is cut into groups at the byte offsets where tokens of both tokenizers end. Every
token of A is linked with every token of B in its group. An id pair's count is the number of
documents that hold it linked.

1. An array over A's vocabulary names the B id with the same bytes. Links of such a pair, which
   are nearly all exact one-to-one groups, are counted in an array as long as the vocabulary,
   one a task. All other pairs come from irregular groups; only they are shuffled.
2. Documents are read in blocks of about ``BLOCK_BYTES`` of text. Both tokenizers are
   independent across certain places of a text (see ``_CUT``), so the stretches between are
   tokenized once and looked up in a bounded store after that. A block is written as arrays:
   the stretches of each document, the pairs of each stretch, and how many documents of
   the block hold each pair.
3. Pair counts are added up over blocks, and an A id's highest count taken. What is
   brought to the driver is as long as A's vocabulary, whatever the corpus.
4. The distinct irregular pairs of each block fetch their counts by a join; with them the
   block's documents are summed up.

No step holds more than a block and a store of fixed size; a pair of all documents has one
row a block. What several jobs read is written to the shared folder.

Defined cases: null and empty texts have no tokens, like those whose bytes a tokenizer does
not give back; all numbers are 0 then and the digest is empty. Special tokens' strings are
plain text. A null id is carried; repeated rows are documents of their own; texts of any length
are read whole; other columns are not read; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.upkeep import Workspace
from tablecheck.llm.vocabularies import byte_letters, located, worker_store

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 3 << 18
#: Stretches a worker process keeps, some 300 bytes each; of a full store the half
#: stays that was asked for last.
MAX_STORED = 150_000
BLOCKS_PER_TASK = 1 << 32

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Places where neither tokenizer joins what stands on both sides, nor lets one side change
#: the other's tokens: before a blank, between a letter and what follows it here, and round
#: a single line end. The byte-level rule always cuts there; no piece of the other
#: vocabulary holds such a place (``Aligner`` makes sure of it).
_CUT = re.compile(
    rf"(?<=\S)(?= )|(?<=[{_LETTERS}])(?=[.,;:!?\n])|(?<=\S\n)(?=[{_LETTERS}])|(?<=[.,;:!?])(?=\n)"
)
_JOINED = re.compile(rf"[^▁]▁|[{_LETTERS}][.,;:!?\n]|\n[{_LETTERS}]|[.,;:!?]\n")
_WORD = re.compile(rf" ?[{_LETTERS}]+")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0] + 1, ...`` for each size, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Aligner(dict):
    """Numbers the stretches it knows.

    By number: how many tokens of A and B, groups and distinct pairs a stretch has (``totals``,
    -1 where the bytes do not come back), and its groups written out. ``pairs`` and ``times``,
    how often each is linked, follow one another for all stretches.
    """

    def __init__(self, byte_level: str, pieces: str, max_stored: int):
        import sentencepiece
        from tokenizers import Tokenizer

        super().__init__()
        self.max_stored = max_stored
        self.a = Tokenizer.from_file(located(byte_level))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=located(pieces))
        self.model = self.a.model
        self.letters = byte_letters()
        spelled = {letter: byte for byte, letter in self.letters.items()}
        self.bytes_a: list[bytes] = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            if all(c in spelled for c in token):
                self.bytes_a[i] = bytes(spelled[c] for c in token)
        self.bytes_b: list[bytes] = []
        by_bytes: dict[bytes, int] = {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            single = _BYTE_PIECE.fullmatch(piece)
            if self.b.is_control(i) or self.b.is_unknown(i):
                self.bytes_b.append(b"")
                continue
            self.bytes_b.append(bytes([int(single[1], 16)]) if single else piece.replace("▁", " ").encode())
            if not single:
                by_bytes.setdefault(self.bytes_b[-1], i)
            if not single and _JOINED.search(piece):
                raise ValueError(f"the vocabulary joins what is cut apart here: {piece!r}")
        if len(self.bytes_b) > 1 << 16:
            raise ValueError("pairs keep 16 bits for the second vocabulary's ids")
        self.sizes_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.identity = np.array([by_bytes.get(x, -1) if x else -1 for x in self.bytes_a], np.int64)
        # a stretch that is not a blank and more is read after a line end, which stands alone
        self.lead = self.b.encode("\n")
        self.names_a = [str(i) for i in range(len(self.bytes_a))]
        self.names_b = [str(i) for i in range(len(self.bytes_b))]
        self.turn, self.asked = 0, np.zeros(0, np.int64)
        self.totals = np.zeros((0, 4), np.int64)
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.written: list[str] = []

    def _ids_a(self, stretch: str) -> list[int]:
        if not _WORD.fullmatch(stretch):
            return self.a.encode(stretch, add_special_tokens=False).ids
        if stretch.isascii():
            spelled = "Ġ" + stretch[1:] if stretch[0] == " " else stretch
        else:
            spelled = stretch.encode().decode("latin-1").translate(self.letters)
        return [token.id for token in self.model.tokenize(spelled)]

    def _ids_b(self, stretches: list[str]) -> list[list[int]]:
        prefixed = [s[0] == " " and len(s) > 1 for s in stretches]
        found = self.b.encode([s[1:] if own else "\n" + s for s, own in zip(stretches, prefixed)], num_threads=1)
        return [ids if own else ids[len(self.lead):] for ids, own in zip(found, prefixed)]

    def numbers(self, stretches: list[str]) -> np.ndarray:
        """The numbers of distinct stretches; those that are new are tokenized all at once."""
        missing = [s for s in stretches if s not in self]
        if len(self) + len(missing) > self.max_stored:
            self._forget()
            missing = [s for s in stretches if s not in self]
        for at in range(0, len(missing), 20_000):
            self._learn(missing[at: at + 20_000])
        known = np.fromiter(map(self.__getitem__, stretches), np.int64, len(stretches))
        self.turn += 1
        self.asked[known] = self.turn
        return known

    def _forget(self) -> None:
        """Keep the half that was asked for last."""
        left = np.sort(np.argsort(-self.asked, kind="stable")[: self.max_stored // 2])
        names = list(self)
        names = [names[i] for i in left.tolist()]
        self.clear()
        self.update(zip(names, range(len(names))))
        sizes = self.totals[:, 3].clip(0)
        held = _ragged((np.cumsum(sizes) - sizes)[left], sizes[left])
        self.pairs, self.times = self.pairs[held], self.times[held]
        self.totals, self.asked = self.totals[left], self.asked[left]
        self.written = [self.written[i] for i in left.tolist()]

    def _learn(self, stretches: list[str]) -> None:
        tokens_a, tokens_b = [self._ids_a(s) for s in stretches], self._ids_b(stretches)
        whole = self._whole(stretches, tokens_a, tokens_b)
        totals = np.full((len(stretches), 4), -1, np.int64)
        written = [""] * len(stretches)
        self.update(zip(stretches, range(len(self), len(self) + len(stretches))))
        if len(whole):
            kept = whole.tolist()
            sizes_a = np.fromiter((len(tokens_a[i]) for i in kept), np.int64, len(kept))
            sizes_b = np.fromiter((len(tokens_b[i]) for i in kept), np.int64, len(kept))
            flat_a = np.fromiter(chain.from_iterable(tokens_a[i] for i in kept), np.int64, int(sizes_a.sum()))
            flat_b = np.fromiter(chain.from_iterable(tokens_b[i] for i in kept), np.int64, int(sizes_b.sum()))
            ends_a, ends_b = np.cumsum(self.sizes_a[flat_a]), np.cumsum(self.sizes_b[flat_b])
            cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
            last_a = np.searchsorted(ends_a, cuts)  # position of the last token of each group
            last_b = np.searchsorted(ends_b, cuts)
            n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
            pairs_b = np.repeat(n_b, n_a)
            first_b = last_b - n_b + 1
            pair = (np.repeat(flat_a, pairs_b) << 16) | flat_b[_ragged(np.repeat(first_b, n_a), pairs_b)]
            # stretches end where groups end
            group_ends = np.searchsorted(cuts, ends_a[np.cumsum(sizes_a) - 1]) + 1
            n_groups = np.diff(group_ends, prepend=0)
            owner = np.repeat(np.arange(len(kept)), np.add.reduceat(n_a * n_b, group_ends - n_groups))
            order = np.lexsort((pair, owner))
            owner, pair = owner[order], pair[order]
            new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])])
            at = np.flatnonzero(new)
            self.pairs = np.concatenate([self.pairs, pair[at]])
            self.times = np.concatenate([self.times, np.diff(at, append=len(pair))])
            n_pairs = np.bincount(owner[at], minlength=len(kept))
            totals[whole] = np.stack([sizes_a, sizes_b, n_groups, n_pairs], axis=1)
            names_a = list(map(self.names_a.__getitem__, flat_a.tolist()))
            names_b = list(map(self.names_b.__getitem__, flat_b.tolist()))
            groups = [
                f"{names_a[i]}|{names_b[k]}" if i == j and k == m else
                f"{','.join(names_a[i: j + 1])}|{','.join(names_b[k: m + 1])}"
                for i, j, k, m in zip((last_a - n_a + 1).tolist(), last_a.tolist(), first_b.tolist(), last_b.tolist())
            ]
            for i, end, n in zip(kept, group_ends.tolist(), n_groups.tolist()):
                written[i] = ";".join(groups[end - n: end])
        self.totals = np.concatenate([self.totals, totals])
        self.asked = np.concatenate([self.asked, np.zeros(len(stretches), np.int64)])
        self.written += written

    def _whole(self, stretches: list[str], tokens_a: list[list[int]], tokens_b: list[list[int]]) -> np.ndarray:
        """Positions of the stretches whose bytes both tokenizers give back."""
        own = [s.encode() for s in stretches]
        sides = ((tokens_a, self.bytes_a, self.sizes_a), (tokens_b, self.bytes_b, self.sizes_b))
        lengths = np.fromiter(map(len, own), np.int64, len(own))
        for tokens, held, sizes in sides:
            counts = np.fromiter(map(len, tokens), np.int64, len(tokens))
            ids = list(chain.from_iterable(tokens))
            ends = np.concatenate([[0], np.cumsum(sizes[ids])]) if ids else np.zeros(1, np.int64)
            last = np.cumsum(counts)
            # all at once: equal lengths everywhere, and equal bytes altogether
            if (ends[last] - ends[last - counts] != lengths).any() or b"".join(map(held.__getitem__, ids)) != b"".join(own):
                break
        else:
            return np.arange(len(own))
        back = [[b"".join(map(held.__getitem__, ids)) for ids in tokens] for tokens, held, _ in sides]
        return np.flatnonzero(np.fromiter((x == y == z for x, y, z in zip(own, *back)), bool, len(own)))


class Numbered(dict):
    """Numbers things in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


_LONGS = pa.list_(pa.int64())
#: Arrays of a block kept as bytes, each number in as few as the largest needs: a reader that
#: holds the rows of a file side by side, and a shuffle of blocks, then need no more than these.
_KEPT = (
    "ids", "known", "n_a", "n_b", "n_groups", "doc_sizes", "doc_stretches", "doc_times", "stretch_sizes", "stretch_pairs",
    "stretch_times",
)


def packed(values: Sequence[int] | np.ndarray) -> bytes:
    """Whole numbers as bytes, the first of which says how many one takes."""
    values = np.asarray(values, np.int64)
    least, most = int(values.min(initial=0)), int(values.max(initial=0))
    width = next((w for w in (1, 2, 4) if least >= 0 and most < 1 << 8 * w), 8)
    return bytes([width]) + values.astype(f"<u{width}" if width < 8 else "<i8").tobytes()


def unpacked(held: bytes) -> np.ndarray:
    width = held[0]
    return np.frombuffer(held[1:], f"<u{width}" if width < 8 else "<i8").astype(np.int64)


_BLOCK = pa.schema([
    ("block", pa.int64()), *((name, pa.binary()) for name in _KEPT), ("digests", pa.string()),
    ("pairs", _LONGS), ("pair_docs", _LONGS), ("identities", _LONGS),
])
_BLOCK_SQL = (
    f"block long, {', '.join(f'{name} binary' for name in _KEPT)}, digests string, pairs array<long>, "
    "pair_docs array<long>, identities array<long>"
)


def _row(values: dict) -> pa.RecordBatch:
    values = values | {name: packed(values[name]) for name in _KEPT if name in values}
    return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in _BLOCK], schema=_BLOCK)


def aligned_block(aligner: Aligner, texts: list[str | None], identities: np.ndarray) -> dict:
    """The arrays of a block of documents; its identity pairs are added to ``identities``.

    ``stretch_pairs`` number the block's irregular ``pairs``; numbers from ``len(pairs)`` on
    are identity pairs, by A id.
    """
    coarse, per_text = Numbered(), []
    for text in texts:
        if not text:
            per_text.append([])
        elif re.search(r"\s | \Z", " " + text):
            per_text.append(list(map(coarse.__getitem__, (s[1:] for s in re.split(r"(?<=\S)(?= )", " " + text)))))
        else:
            per_text.append(list(map(coarse.__getitem__, text.split(" "))))
    fine = Numbered()
    # a part of letters alone holds no place to cut
    cut = [
        [fine[" " + part]] if part.isalpha() else list(map(fine.__getitem__, _CUT.split(" " + part))) for part in coarse
    ]
    known = aligner.numbers(list(fine))
    totals = aligner.totals[known]
    broken = totals[:, 2] < 0
    totals[broken] = 0
    written = list(map(aligner.written.__getitem__, known.tolist()))
    cut_sizes = np.fromiter(map(len, cut), np.int64, len(cut))
    cut_flat = np.fromiter(chain.from_iterable(cut), np.int64, int(cut_sizes.sum()))
    cut_starts = np.cumsum(cut_sizes) - cut_sizes

    sizes = totals[:, 3]
    starts = np.cumsum(sizes) - sizes
    stored = aligner.totals[:, 3].clip(0)
    held = _ragged((np.cumsum(stored) - stored)[known], sizes)
    keys, times = aligner.pairs[held], aligner.times[held]
    plain = aligner.identity[keys >> 16] == (keys & 0xFFFF)
    pairs, number = np.unique(keys[~plain], return_inverse=True)
    numbered = np.empty(len(keys), np.int64)
    numbered[~plain] = number
    numbered[plain] = len(pairs) + (keys[plain] >> 16)

    docs, counts, digests = [], [], []
    seen = np.zeros(len(pairs) + len(aligner.identity), np.int64)
    for parts in per_text:
        parts = np.array(parts, np.int64)
        stretches = cut_flat[_ragged(cut_starts[parts], cut_sizes[parts])]
        if not len(parts) or broken[stretches].any():
            docs.append((parts[:0], parts[:0]))
            counts.append((0, 0, 0))
            digests.append("")
            continue
        own, often = np.unique(stretches, return_counts=True)
        docs.append((own, often))
        counts.append(often @ totals[own, :3])
        digests.append(hashlib.sha256(";".join([written[s] for s in stretches.tolist()]).encode()).hexdigest())
        seen[np.unique(numbered[_ragged(starts[own], sizes[own])])] += 1
    identities += seen[len(pairs):]
    n_a, n_b, n_groups = np.array(counts, np.int64).reshape(-1, 3).T

    def joined(side: int) -> np.ndarray:
        return np.concatenate([d[side] for d in docs]) if docs else np.zeros(0, np.int64)

    return {
        "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "digests": " ".join(digests), "doc_sizes": [len(d[0]) for d in docs],
        "doc_stretches": joined(0), "doc_times": joined(1), "stretch_sizes": sizes, "stretch_pairs": numbered,
        "stretch_times": times, "pairs": pairs, "pair_docs": seen[: len(pairs)],
    }


def _blocks(docs: DataFrame, byte_level: str, pieces: str, block_bytes: int, max_stored: int) -> DataFrame:
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = ("alignment", byte_level, pieces, max_stored)
        aligner = worker_store(kind, lambda: Aligner(byte_level, pieces, max_stored))
        identities = np.zeros(len(aligner.identity), np.int64)
        number = TaskContext.get().partitionId() * BLOCKS_PER_TASK
        ids: list[int | None] = []
        texts: list[str | None] = []
        held = 0

        def block() -> pa.RecordBatch:
            own = {"block": number, "ids": [i or 0 for i in ids], "known": [i is not None for i in ids]}
            return _row(own | aligned_block(aligner, texts, identities))

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids.append(doc_id.as_py())
                texts.append(text.as_py())
                held += len(texts[-1] or "")
                if held >= block_bytes:
                    yield block()
                    ids, texts, held, number = [], [], 0, number + 1
        if ids:
            yield block()
            number += 1
        if number % BLOCKS_PER_TASK:
            yield _row({"identities": identities})

    return docs.mapInArrow(align, _BLOCK_SQL)


def _summed(blocks: DataFrame, byte_level: str, pieces: str, identities: np.ndarray, best: np.ndarray) -> DataFrame:
    """One row a document, from blocks that know the counts of their pairs."""
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "digest"]

    def per_document(row: dict) -> pa.RecordBatch:
        n_pairs = len(row["pairs"])
        counts, tops = np.zeros(n_pairs, np.int64), best[row["pairs"] >> 16]
        counts[row["found"] >> 40] = row["found"] & ((1 << 40) - 1)
        counts, tops = np.concatenate([counts, identities]), np.concatenate([tops, best])
        links, sums = row["stretch_times"], row["stretch_pairs"]
        per_link = np.stack([links, links * (counts[sums] == tops[sums]), links * counts[sums]])
        edges = np.concatenate([np.zeros((3, 1), np.int64), np.cumsum(per_link, axis=1)], axis=1)
        ends = np.cumsum(row["stretch_sizes"], dtype=np.int64)
        per_stretch = edges[:, ends] - edges[:, ends - row["stretch_sizes"]]
        own = per_stretch[:, row["doc_stretches"]] * row["doc_times"]
        edges = np.concatenate([np.zeros((3, 1), np.int64), np.cumsum(own, axis=1)], axis=1)
        ends = np.cumsum(row["doc_sizes"], dtype=np.int64)
        n_links, n_best, count_sum = edges[:, ends] - edges[:, ends - row["doc_sizes"]]
        columns = [
            pa.array(row["ids"], pa.int64(), mask=row["known"] == 0),
            *(pa.array(c, pa.int64()) for c in (row["n_a"], row["n_b"], row["n_groups"], n_links, n_best, count_sum)),
            pa.array(row["digests"].split(" "), pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {}
                for name, column in zip(batch.schema.names, batch.columns):
                    if name in _KEPT:
                        row[name] = unpacked(column[at].as_py())
                    elif name == "digests":
                        row[name] = column[at].as_py()
                    elif name in ("pairs", "found"):
                        values = column[at].values
                        row[name] = np.zeros(0, np.int64) if values is None else values.to_numpy()
                yield per_document(row)

    return blocks.mapInArrow(
        sum_up, "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, digest string"
    )


def align_tokenizers(
    docs: DataFrame, key: str = "doc_id", text: str = "text", byte_level: str = BYTE_LEVEL, pieces: str = PIECES,
    block_bytes: int = BLOCK_BYTES, max_stored: int = MAX_STORED,
) -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row."""
    space = Workspace(docs.sparkSession, "alignment")
    picked = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("t"))
    blocks = space.staged(_blocks(picked, byte_level, pieces, block_bytes, max_stored), "blocks")
    counts = space.staged(
        blocks.where("block IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "pair_docs")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.pair_docs").alias("n")), "counts",
    )
    # both as long as A's vocabulary at most
    plain = blocks.where("block IS NULL").select(F.posexplode("identities").alias("a", "n")).where("n > 0")
    plain = plain.groupBy("a").agg(F.sum("n").alias("n")).toArrow()
    highest = counts.groupBy(F.shiftright("pair", 16).alias("a")).agg(F.max("n").alias("n")).toArrow()
    identities = np.zeros(blocks.agg(F.max(F.size("identities"))).first()[0] or 0, np.int64)
    identities[plain.column("a").to_numpy()] = plain.column("n").to_numpy()
    best = identities.copy()
    at = highest.column("a").to_numpy()
    best[at] = np.maximum(best[at], highest.column("n").to_numpy())

    asked = blocks.where("block IS NOT NULL").select("block", F.posexplode("pairs").alias("at", "pair"))
    found = asked.join(counts, "pair").groupBy("block").agg(
        F.collect_list(F.shiftleft(F.col("at").cast("long"), 40) + F.col("n")).alias("found")
    )
    whole = blocks.where("block IS NOT NULL").drop("pair_docs", "identities").join(found, "block", "left")
    return space.finished(_summed(whole, byte_level, pieces, identities, best).select(
        F.col("id").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        F.col("digest").alias("groups_sha256"),
    ))
