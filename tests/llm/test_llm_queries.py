"""The registered queries on given tables, against SQL or brute force."""

import os
import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import numpy as np
import plain
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tablecheck.llm import language, neardup, queries
from tablecheck.llm.vocabularies import located

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def docs():
    return plain.table(SF_DIR, "documents", "doc_id, text")


def rows_of(spark, name):
    return queries.QUERIES[name](spark, SF_DIR).collect()


def test_all_are_registered():
    assert queries.QUERIES.items() <= entry.queries().items() and "pipeline" in entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    frame = queries.QUERIES[name](spark, SF_DIR)
    connection = duckdb.connect()
    for table in ("documents", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = connection.execute(queries.ORACLES[name])
    order = [[d[0] for d in result.description].index(c) for c in frame.columns]
    expected = sorted(tuple(r[i] for i in order) for r in result.fetchall())
    assert sorted(map(tuple, frame.collect())) == expected


def test_license_scan(spark, docs):
    import re

    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    found = {r["doc_id"]: r for r in rows_of(spark, "op3_license_scan")}
    assert len(found) == len(docs)
    for d, text in docs:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i: i + len(p.split())] == p.split()]
        starts = [i for i, _ in places]
        r = found[d]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (
            len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def check_packed(rows, texts):
    plainly = Tokenizer.from_file(located(queries.TOKENIZER))
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == {d for d, _ in texts}
    for d, text in texts:
        ids = np.array(plainly.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(pieces[d], key=lambda r: r["start"]):
            own = ids[at: at + r["length"]].tobytes()
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert (zlib.crc32(own) if "ids_crc32" in r else own) == (r["ids_crc32"] if "ids_crc32" in r else bytes(r["ids"]))
            at += r["length"]
        assert at == len(ids)
    for held in sequences.values():
        assert sum(n for _, n in held) <= 4096 and [o for o, _ in sorted(held)] == [
            sum(n for _, n in sorted(held)[:i]) for i in range(len(held))]


def test_packing(spark, docs):
    check_packed(rows_of(spark, "op4_packing"), docs)


def test_substring_dedup(spark, docs):
    split, kept = plain.without_repeats([t for _, t in docs])
    expected = {d: (len(w), len(w) - len(k), plain.sha256(k)) for (d, _), w, k in zip(docs, split, kept, strict=True)}
    assert {r["doc_id"]: tuple(r)[1:] for r in rows_of(spark, "op5_substring_dedup")} == expected


def test_near_dedup(spark, docs):
    expected = {(d, len(plain.shingles(t)), c, c == d) for (d, t), c in zip(docs, plain.components(docs), strict=True)}
    assert set(map(tuple, rows_of(spark, "op10_minhash_near_dedup"))) == expected


def test_decontamination(spark, docs):
    items = plain.table(SF_DIR, "benchmark", "item_id, text")
    found = rows_of(spark, "op7_benchmark_decontamination")
    assert {(r["doc_id"], r["item_id"]) for r in found} == plain.leaks(docs, items) and len(found) > 0


def test_language_held_out_accuracy(spark):
    truth = dict(plain.table(SF_DIR, "documents", "doc_id, lang"))
    found = rows_of(spark, "op8_language_id")
    assert {r["doc_id"] for r in found} == set(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_language_does_not_see_labels_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    spoiled = docs.withColumn("lang", F.when(queries.held_out(), "spoiled").otherwise(F.col("lang")))
    one = language.fit_language_model(docs.where(~queries.held_out()))
    other = language.fit_language_model(spoiled.where(~queries.held_out()))
    assert one.labels == other.labels and np.array_equal(one.weights, other.weights)


def test_pages(spark):
    """The generated pages hold their article between its tags."""
    import html
    import re

    found = {r["page_id"]: r for r in rows_of(spark, "op9_html_extraction")}
    for page, url, source in plain.table(SF_DIR, "pages", "page_id, url, html"):
        article = re.search("<article>(.*?)</article>", source, re.DOTALL).group(1).replace("<br>", " ")
        blocks = re.split(r"</?(?:p|h[1-6]|ul|li|div|table|tr|td|blockquote|pre)\b[^>]*>", article)
        texts = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in blocks]
        text = "\n".join(t for t in texts if t)
        assert tuple(found[page])[1:] == (url, text, len(text))


def test_sharding(spark, docs):
    found = rows_of(spark, "op2_balanced_sharding")
    texts = dict(docs)
    loads, groups, slots = Counter(), {}, {}
    for r in found:
        body = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(body) + 8, zlib.crc32(body), "bytes")
        loads[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        groups.setdefault(body, set()).add(r["shard"])
    assert len(found) == len(docs) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r["size"] for r in found)
    assert max(loads.values()) <= max(1.05 * sum(loads.values()) / 24, largest + max(loads.values()) * 0.2)
    assert sum(len(s) > 1 for s in groups.values()) <= 1


def test_pipeline(spark, docs):
    """Every stage on its own input, in plain Python where a stage is not learned."""
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language.fit_language_model(table.where(~queries.held_out()))
    told = language.Labeller(model).described([t for _, t in docs])
    left = [
        d for d, row in zip(docs, told, strict=True) if row[:-1].any() and row[-1] >= corpus_pipeline.LEAST_FAMILIAR
        and row[:-1].max() * len(model.labels) >= corpus_pipeline.LEAST_LANGUAGE_LIFT
    ]
    assert len(left) >= 0.97 * len(docs)
    left = [d for d, c in zip(left, plain.components(left, percent=corpus_pipeline.NEAR_PERCENT), strict=True) if c == d[0]]
    split, kept = plain.without_repeats([t for _, t in left])
    cut = [(d, t if len(w) == len(k) else b" ".join(k).decode())
           for (d, t), w, k in zip(left, split, kept, strict=True) if k or not w]
    leaked = {d for d, _ in plain.leaks(cut, plain.table(SF_DIR, "benchmark", "item_id, text"))}
    check_packed(corpus_pipeline.run(spark, SF_DIR).collect(), [(d, t) for d, t in cut if d not in leaked])


def test_stages_keep_columns_and_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "the of and " * 30), (3, "the of and " * 30), (None, "an odd one out"), (None, "an odd one out"),
            (4, "the thing of it " * 12 + "once"), (5, "12 !!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({
        "lang": F.lit(None).cast("string"), "kept_id": F.lit("own"), "same_text": F.lit("own"), "left_text": F.lit("own"), "same": F.lit(1), "component_id": F.lit(2), "n_chars": F.char_length("text"),
    })
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        counts.append(docs.count())
    assert counts[:2] == [5, 3]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0


def test_language_stage_rejects_what_it_cannot_read(spark):
    """Other scripts and mashed keys go, short clean texts stay, and lang is what was told."""
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = {
        -1: "Привет мир это обычный русский текст о погоде", -2: "Γεια σου κόσμε αυτό είναι κείμενο", -3: "日本語の文章です これは",
        -4: "xkcd qwrtzp vbnmq jklw zxcvp qqwx", -5: "12 !! 99", -6: "the of and", -7: "das ist ein",
    }
    rows = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in odd.items()], "doc_id long, text string, lang string, source string, n_chars long")
    table = given.unionByName(rows.select([F.col(c).cast(t) for c, t in given.dtypes]))
    out = corpus_pipeline.identify_language(spark, table, SF_DIR)
    assert out.columns == table.columns
    found = {r["doc_id"]: r["lang"] for r in out.collect()}
    assert {i: found[i] for i in odd if i in found} == {-6: "en", -7: "de"}
    truth = dict(plain.table(SF_DIR, "documents", "doc_id, lang"))
    known = [i for i in found if i >= 0]
    assert sum(found[i] == truth[i] for i in known) >= 0.98 * len(known)
    german = corpus_pipeline.identify_language(spark, table, SF_DIR, wanted=("de",))
    assert {r["lang"] for r in german.collect()} == {"de"}


def test_language_stage_labels_every_text_once(spark):
    out = corpus_pipeline.identify_language(spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"), SF_DIR)
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_near_dedup_stage_without_ids(spark):
    """Near copies without an id, and an id with two texts."""
    own = " ".join(f"a{i}" for i in range(100))
    other = " ".join(f"b{i}" for i in range(100))
    rows = [(None, own), (None, own + " end"), (1, own), (1, other), (3, other + " end"), (None, "alone " + " ".join(f"c{i}" for i in range(20)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(map(tuple, corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect()), key=repr)
    assert found == sorted([(1, own), (1, other), rows[5]], key=repr)
    lone = spark.createDataFrame(rows[:2], docs.schema)
    assert corpus_pipeline.near_dedup(spark, lone, SF_DIR).count() == 1


def test_near_dedup_stage_links_at_80_percent(spark):
    """Families whose members differ from the first by 80 to 85 percent, and by less than 80."""
    rows = []
    for family in range(20):
        own = [f"w{family}x{i}" for i in range(120)]
        rows.append((family * 10, " ".join(own)))
        for member, changed in enumerate((2, 12, 30), 1):  # 0.97, 0.82 and 0.59 of the union
            rows.append((family * 10 + member, " ".join([*own[:-changed], *(f"y{family}z{member}z{i}" for i in range(changed))])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = {d for (d, _), c in zip(rows, plain.components(rows, percent=80), strict=True) if c == d}
    assert expected != {d for (d, _), c in zip(rows, plain.components(rows), strict=True) if c == d}
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect()} == expected
    assert neardup.least_agreement(80, 240) <= 240 * 0.8 - 5 * (240 * 0.16) ** 0.5 + 1e-9
