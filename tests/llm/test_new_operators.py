"""Tokenizer alignment, SimHash and spelling variants against brute force and on odd rows."""

import functools
import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import plain
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablecheck.llm import alignment, queries, simhash, spelling

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
CLASHING = ["id", "t", "n", "fp", "word", "block", "slot", "pair", "found", "ids", "near", "form", "root", "shard", "least", "component"]


@pytest.fixture(scope="module")
def docs():
    return plain.table(SF_DIR, "documents", "doc_id, text")


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


# -- alignment ----------------------------------------------------------------------------


class Plainly:
    """Whole texts through both tokenizers, groups by a walk over the byte offsets."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in letters} | {
            chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in letters)}
        self.bytes_a = {i: bytes(letters[c] for c in t) for t, i in self.a.get_vocab().items() if t[:2] != "<|"}

    def bytes_b(self, i):
        piece = self.b.id_to_piece(i)
        single = re.fullmatch("<0x(..)>", piece)
        return bytes([int(single[1], 16)]) if single else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        ids_a, ids_b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        bytes_a, bytes_b = [self.bytes_a[i] for i in ids_a], [self.bytes_b(i) for i in ids_b]
        if not b"".join(bytes_a) == (" " + text).encode() == b"".join(bytes_b):
            return []
        found, at_a, at_b, i, j = [], 0, 0, 0, 0
        own_a, own_b = [], []
        while i < len(ids_a) or j < len(ids_b):
            if at_a <= at_b:
                own_a.append(ids_a[i])
                at_a += len(bytes_a[i])
                i += 1
            else:
                own_b.append(ids_b[j])
                at_b += len(bytes_b[j])
                j += 1
            if at_a == at_b:
                found.append((own_a, own_b))
                own_a, own_b = [], []
        return found


@pytest.fixture(scope="module")
def plainly():
    return Plainly()


def expected_alignment(plainly, docs):
    grouped = [(d, plainly.groups(t)) for d, t in docs]
    links = [Counter((a, b) for x, y in groups for a in x for b in y) for _, groups in grouped]
    counts = Counter(pair for own in links for pair in own)
    best = Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    rows = []
    for (d, groups), own in zip(grouped, links, strict=True):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        rows.append((
            d, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(own.values()),
            sum(n for p, n in own.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in own.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return rows


def test_alignment_query(spark, docs, plainly):
    found = queries.QUERIES["op11_tokenizer_alignment"](spark, SF_DIR)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect())) == sorted(expected_alignment(plainly, docs))


ODD_TEXTS = [
    None, "", " ", "  ", "a ", " a", "a  b", "a\n\nb", "a\n b", "a \nb", "one.\nTwo,\n\nthree!\n", "▁", "x▁ y", "<s> </s> <|endoftext|>",
    "it's we'll 'tis", "naïve cafés", "éa", "日本語 と kanji", "\U0001f600\U0001f600 ok", "a b", "a\tb\r\nc", "1234 5,678.90", "\x00a", "a\x1c b",
    "same same same", "same same same", "word " * 3_000, "x" * 5_000, "ä" * 700,
]


def test_alignment_on_odd_rows(spark, plainly):
    rows = [*enumerate(ODD_TEXTS), (3, "an id again"), (None, "no id")]
    for block_bytes, stored in ((1 << 20, 1_000), (40, 3)):
        found = alignment.align_tokenizers(frame(spark, rows), block_bytes=block_bytes, max_stored=stored)
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected_alignment(plainly, rows), key=repr)
    assert alignment.align_tokenizers(frame(spark, [])).count() == 0


@functools.cache
def both_ways():
    return Plainly(), alignment.Aligner(alignment.BYTE_LEVEL, alignment.PIECES, 50)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t.,;:!?'-aéZb7▁ 日́<s>|", max_size=25), min_size=1, max_size=4))
def test_stretches_give_the_tokens_of_whole_texts(texts):
    plainly, aligner = both_ways()
    block = alignment.aligned_block(aligner, texts, np.zeros(len(aligner.identity), np.int64))
    groups = [plainly.groups(t) for t in texts]
    written = [";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g) for g in groups]
    assert block["digests"].split(" ") == [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written]
    assert block["n_groups"].tolist() == [len(g) for g in groups]


@given(st.lists(st.integers(-(1 << 63), (1 << 63) - 1)))
def test_numbers_come_back_from_bytes(values):
    assert alignment.unpacked(alignment.packed(values)).tolist() == values
    small = [abs(v) % 300 for v in values]
    assert alignment.unpacked(alignment.packed(small)).tolist() == small and len(alignment.packed(small)) <= 1 + 2 * len(small)


# -- simhash ------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = plain.words((text or "").encode().lower().decode())
    runs = [b" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(rows, near=4):
    """rows: list of (id, fingerprint); the smallest id each can reach, by position."""
    values = np.array([fp for _, fp in rows], np.uint64)
    left, label = set(range(len(rows))), {}
    while left:
        group, edge = set(), {left.pop()}
        while edge:
            group |= edge
            close = set()
            for i in edge:
                close |= set(np.flatnonzero(np.bitwise_count(values ^ values[i]) <= near).tolist())
            edge = close - group
        left -= group
        least = min((rows[i][0] for i in group if rows[i][0] is not None), default=None)
        label |= dict.fromkeys(group, least)
    return [label[i] for i in range(len(rows))]


def test_simhash_query(spark, docs):
    signed = [(d, plain_fingerprint(t)) for d, t in docs]
    expected = [(d, f"{fp:016x}", c) for (d, fp), c in zip(signed, plain_components(signed), strict=True)]
    found = queries.QUERIES["op12_simhash_near_dedup"](spark, SF_DIR)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_simhash_on_odd_rows(spark):
    copy = " ".join(f"w{i % 70}" for i in range(400))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, copy), (7, copy + " end"), (8, copy), (8, copy),
        (None, copy), (None, "no id at all"), (9, "x " * 50_000), (10, "Ä ä Ä b"),
    ]
    signed = [(d, plain_fingerprint(t)) for d, t in rows]
    signs = [fp if fp < 1 << 63 else fp - (1 << 64) for _, fp in signed]
    expected = [(d, fp, c) for (d, _), fp, c in zip(signed, signs, plain_components(signed), strict=True)]
    assert sorted(map(tuple, simhash.simhash_duplicates(frame(spark, rows)).collect()), key=repr) == sorted(expected, key=repr)
    assert simhash.simhash_duplicates(frame(spark, [])).count() == 0
    with pytest.raises(ValueError, match="near"):
        simhash.simhash_duplicates(frame(spark, rows), near=6)


def planted_points(seed, n=4_000, families=60):
    """Unrelated fingerprints, families that drift apart bit by bit, and one dense ball."""
    rng = np.random.default_rng(seed)
    points = [rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64)]
    for start in points[0][:families]:
        for _ in range(20):
            start = start ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, int(rng.integers(1, 6)), replace=False).astype(np.uint64))
            points.append(np.array([start]))
    loose = np.uint64(1) << rng.choice(64, 11, replace=False).astype(np.uint64)
    choice = rng.integers(0, 2, (1_500, 11)).astype(np.uint64)
    points.append(points[0][-1] ^ (choice * loose).sum(axis=1, dtype=np.uint64))
    return np.unique(np.concatenate(points))


@pytest.mark.parametrize("seed", range(3))
def test_trees_find_every_pair(seed):
    """Shards and their trees, with small shards, against all pairs."""
    points = planted_points(seed)
    rng = np.random.default_rng(seed)
    labels = np.arange(len(points))
    for view in simhash.VIEWS:
        tree = simhash.grow_upper(np.sort(rng.choice(points, 512, replace=False)), view, 5)
        own, who, where = simhash.shards_of(points, tree)
        assert len(np.unique(own)) > 16
        for shard in np.unique(own):
            home, visiting = np.flatnonzero(own == shard), who[where == shard]
            held = np.concatenate([home, visiting])
            first = simhash.linked(points[home], points[visiting], view)
            labels = simhash._merged(labels, held, held[first])
    expected = plain_components([(i, int(p)) for i, p in enumerate(points)])
    assert labels.tolist() == expected


def test_simhash_over_many_shards(spark):
    points = planted_points(9, n=1_500, families=20)
    fps = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    trees = [simhash.grow_upper(points[::5], view, 4) for view in simhash.VIEWS]
    routed = simhash._routed(fps, trees)
    home = routed.where("home").groupBy("tree").agg(F.count_distinct("fp").alias("n"), F.count_distinct("shard").alias("shards")).collect()
    assert all(r["n"] == len(points) and r["shards"] > 8 for r in home) and len(home) == 3
    links = simhash._links(routed, simhash.NEAR).distinct().collect()
    index = {int(p): i for i, p in enumerate(points.view(np.int64))}
    labels = simhash._merged(np.arange(len(points)), np.array([index[r["a"]] for r in links]), np.array([index[r["b"]] for r in links]))
    assert labels.tolist() == plain_components([(i, int(p)) for i, p in enumerate(points)])


# -- spelling -----------------------------------------------------------------------------


def edits(word, alphabet):
    """Every word one deleted, replaced or inserted letter away."""
    found = {word[:i] + word[i + 1:] for i in range(len(word))}
    found |= {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in alphabet}
    found |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in alphabet}
    return found - {word}


def expected_words(docs, ratio=10):
    counts = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    alphabet = sorted({c for w in words for c in w})
    near = {w: sorted(edits(w, alphabet) & words.keys(), key=lambda v: (-words[v], v)) for w in words}
    form = {w: v[0] for w, v in near.items() if v and words[v[0]] >= ratio * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def test_spelling_query(spark, docs):
    found = queries.QUERIES["op13_spelling_variants"](spark, SF_DIR)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == expected_words(docs)
    assert any(f for _, f, *_ in rows)


def test_spelling_on_odd_rows(spark):
    rng = random.Random(4)
    chain = ["chained" * 1] * 2 + ["chainedx"] * 90 + ["chainedxy"] * 1_500 + ["chäined"] * 25
    rows = [
        (1, None), (2, ""), (3, "12 ... 日本"), (4, " ".join(chain)), (5, "Chained CHAINED ÄHNLICHE ähnliche Ähnliche"),
        (6, "ties aaaaaaa aaaaaab aaaaaab aaaaaac aaaaaac aaaaaaa"), (6, "repeated repeated"), (6, "repeated repeated"),
        (None, "without without anid anid"), (7, "abcdefg bacdefg abcdefg bacdefg"), (8, "×÷×÷×÷× " * 3), (9, "z" * 1_000 + " " + "z" * 1_000),
        *((100 + i, " ".join("".join(rng.choices("abc", k=rng.choice((7, 8)))) for _ in range(300))) for i in range(8)),
    ]
    found = [tuple(r) for r in spelling.spelling_variants(frame(spark, rows)).select(
        "word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(found) == len(set(found)) and set(found) == expected_words(rows)
    assert ("chained", "chainedx", "chainedxy") in {r[:3] for r in found}
    assert spelling.spelling_variants(frame(spark, [])).count() == 0


@pytest.mark.parametrize("classes", [1, 2, 5, 12])
def test_near_words_meet_in_adjacent_blocks(spark, monkeypatch, classes):
    """With any number of classes, and with slots of a few words."""
    monkeypatch.setattr(spelling, "classes_for", lambda n: classes)
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 20)
    rng = random.Random(classes)
    rows = [(i, " ".join("".join(rng.choices("abté", k=rng.choice((7, 8, 9)))) for _ in range(400))) for i in range(6)]
    found = spelling.spelling_variants(frame(spark, rows), least_count=1).select("word", "n_near").collect()
    words = {r["word"] for r in found}
    assert {(r["word"], r["n_near"]) for r in found} == {(w, len(edits(w, "abté") & words)) for w in words}


@pytest.mark.parametrize("length", [7, 999, 30_000])
def test_very_long_words_are_counted_exactly(length):
    whole = np.zeros((3, length), np.uint8)
    whole[1, length // 2], whole[2, :2] = 5, 7
    longer = np.zeros((2, length + 1), np.uint8)
    longer[1, 3] = 5
    assert list(zip(*spelling.near_pairs(whole, whole))) == [(0, 1), (1, 0)]
    assert set(zip(*spelling.near_pairs(whole, longer))) == {(0, 0), (0, 1), *([(1, 1)] if length // 2 in (2, 3) else [])}
