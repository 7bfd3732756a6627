"""License scans: notice phrases and identifier tags found in one pass over a text.

The text is reduced to its words (A-Z lower-cased) and an Aho-Corasick automaton over all
phrases finds every place at once. Behind an identifier tag stands an expression; a
shunting-yard parser evaluates its ``AND``, ``OR`` and ``WITH``.

``score`` says how freely a text may be used: 1.0 where nothing restricts it, else the
smallest openness of its notices and expressions (``AND`` takes the smaller, ``OR`` the
larger, an exception after ``WITH`` at least that of weak copyleft).

Defined cases: a null or empty text has no words, no labels and score 1.0; a broken
expression has the label ``spdx-invalid`` and the openness of an unknown licence; repeated
rows get equal answers; other columns are not read. Each row is decided from itself alone,
so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The phrases every scan looks for, with their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Further notices.
NOTICE_PHRASES = {
    "apache license": "apache-2.0",
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl-2.0",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc0": "cc0",
    "public domain": "public-domain",
    "isc license": "isc",
    "unlicense": "unlicense",
}
TAG = "spdx license identifier"
TAG_LABEL = "spdx"
INVALID = "spdx-invalid"

# How freely text under a licence family may be used.
OPENNESS = {
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "mit": 0.95, "isc": 0.95, "bsd": 0.95, "0bsd": 1.0,
    "apache": 0.95, "zlib": 0.95, "cc-by": 0.9, "mpl": 0.6, "lgpl": 0.6, "epl": 0.6, "cc-by-sa": 0.5, "gpl": 0.4,
    "agpl": 0.3, "cc-by-nd": 0.2, "cc-by-nc": 0.2, "reserved": 0.0,
}
UNKNOWN_OPENNESS, EXCEPTION_OPENNESS = 0.25, 0.6

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_EXPRESSION = re.compile(r"spdx[\s\-_]*license[\s\-_]*identifier\s*:?[ \t]*([^\r\n]*)", re.IGNORECASE)
_PARTS = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:\-]*")
_STRENGTH = {"OR": 1, "AND": 2, "WITH": 3}


def openness(identifier: str) -> float:
    """That of the longest family the identifier starts with."""
    name = identifier.lower()
    known = [f for f in OPENNESS if name == f or name.startswith(f + "-")]
    return OPENNESS[max(known, key=len)] if known else UNKNOWN_OPENNESS


def evaluate(expression: str) -> tuple[float, list[str]] | None:
    """Openness and identifiers of a licence expression; None if it cannot be read.

    Shunting-yard: operands and operators are kept on two stacks, an operator waiting until
    one that binds no tighter comes. Text behind a whole expression is taken as a comment.
    """
    values: list[float] = []
    waiting: list[str] = []
    found: list[str] = []

    def apply() -> None:
        operator, right, left = waiting.pop(), values.pop(), values.pop()
        if operator == "AND":
            values.append(min(left, right))
        elif operator == "OR":
            values.append(max(left, right))
        else:
            values.append(max(left, EXCEPTION_OPENNESS))

    operand_next = True
    for part in _PARTS.findall(expression):
        operator = part.upper()
        if operand_next:
            if part == "(":
                waiting.append(part)
            elif part == ")" or operator in _STRENGTH:
                return None
            else:
                exception = bool(waiting) and waiting[-1] == "WITH"
                values.append(0.0 if exception else openness(part))
                if not exception:
                    found.append(part.lower())
                operand_next = False
        elif part == ")":
            while waiting and waiting[-1] != "(":
                apply()
            if not waiting:
                break
            waiting.pop()
        elif operator in _STRENGTH:
            while waiting and waiting[-1] != "(" and _STRENGTH[waiting[-1]] >= _STRENGTH[operator]:
                apply()
            waiting.append(operator)
            operand_next = True
        else:
            break
    if operand_next or "(" in waiting:
        return None
    while waiting:
        apply()
    return values[0], found


def automaton(phrases: dict[str, str]):
    """Aho-Corasick over whole words: phrases stand between blanks."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for phrase, label in phrases.items():
        spelled = f" {phrase} ".encode().decode("latin-1")
        machine.add_word(spelled, (label, len(spelled)))
    machine.make_automaton()
    return machine


_RESULT = pa.struct([
    ("n_words", pa.int64()),
    ("places", pa.list_(pa.struct([("phrase", pa.string()), ("label", pa.string()), ("word", pa.int64())]))),
    ("labels", pa.list_(pa.string())), ("score", pa.float64()),
])


def license_scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", base: dict[str, str] = BASE_PHRASES,
    notices: dict[str, str] = NOTICE_PHRASES,
) -> DataFrame:
    """``key, n_words, places, labels, score`` for every row.

    ``places`` lists where the phrases of ``base`` start, as ``phrase, label, word`` in order;
    ``labels`` are the distinct labels of all phrases and expressions, sorted.
    """
    phrases = {p: (p, label, True) for p, label in base.items()}
    phrases |= {p: (p, label, False) for p, label in notices.items() if p not in phrases}
    phrases[TAG] = (TAG, TAG_LABEL, False)

    @F.arrow_udf(
        "n_words long, places array<struct<phrase:string,label:string,word:long>>, labels array<string>, score double"
    )
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = automaton(phrases)
        for batch in batches:
            rows = []
            for content in batch.to_pylist():
                words = (content or b"").translate(_WORD_BYTES).split()
                line = f" {b' '.join(words).decode('latin-1')} "
                places, labels, values = [], set(), []
                for end, ((phrase, label, is_base), size) in machine.iter(line):
                    if is_base:
                        start = end + 1 - size
                        places.append((line.count(" ", 0, start), phrase, label))
                    if label == TAG_LABEL and phrase == TAG:
                        continue
                    labels.add(label)
                    values.append(openness(label))
                if TAG in line:
                    for expression in _EXPRESSION.findall(content.decode("utf-8", "replace")):
                        result = evaluate(expression)
                        labels.update(result[1] if result else [INVALID])
                        values.append(result[0] if result else UNKNOWN_OPENNESS)
                rows.append({
                    "n_words": len(words),
                    "places": [{"phrase": p, "label": g, "word": w} for w, p, g in sorted(places)],
                    "labels": sorted(labels), "score": min(values, default=1.0),
                })
            yield pa.array(rows, type=_RESULT)

    picked = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").cast("binary").alias("t"))
    scanned = picked.select("k", scan("t").alias("s"))
    return scanned.select(F.col("k").alias(key), "s.n_words", "s.places", "s.labels", "s.score")
