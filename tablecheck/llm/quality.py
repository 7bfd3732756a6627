"""Quality rules: a table of thresholds compiled into one projection.

``quality_rules`` adds metrics of a text and a verdict with DataFrame functions alone: no
user functions, no shuffle, one pass. Everything about a row is decided from that row, so
skew in any column is harmless.

Defined cases: a null text counts as an empty one, has zero in every metric and fails the
length rule; repeated rows get equal answers; an empty table gives an empty table; columns
that share a name with a metric are not read (the caller picks the text and the columns to
carry).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the be to of and that have with a in is it for on as "
    "le la les de des du et un une que qui est pour dans "
    "der die das und von zu den mit sich ein eine nicht ist "
    "el los las del en por con para su al se"
).split()


@dataclass(frozen=True)
class Rule:
    """``metric`` must lie within ``least`` and ``most`` (None: open) in texts of at least
    ``from_words`` words."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


#: The threshold table. Metrics are SQL expressions over the counts of ``_counts``; ratios
#: are compared as products of whole numbers, so that every engine decides alike. No rule has
#: a step: three lines in ten may repeat and two more, and the distinct words of a text have
#: to reach twice the root of its words, as vocabularies grow with the root of a text.
RULES = (
    Rule("too_short", "n_words", least=50),
    Rule("word_length_low", "word_chars * 10 - n_words * 20", least=0),
    Rule("word_length_high", "CASE WHEN latin THEN n_words * 150 - word_chars * 10 ELSE 0 END", least=0),
    Rule("symbols", "n_words * 10 - n_symbols * 100", least=0),
    Rule("repeated_lines", "n_lines * 30 + 200 - n_dup_lines * 100", least=0),
    Rule("repeated_words", "n_words * 50 - n_repeat_words * 100", least=0),
    Rule("shouting", "n_letters * 50 - n_capitals * 100", least=0),
    Rule("exclamations", "n_words * 20 - n_exclamations * 100", least=0),
    Rule("stop_words", "CASE WHEN latin THEN n_stop_words * 100 - n_words ELSE 0 END", least=0),
    Rule("distinct_words", "n_distinct_words * n_distinct_words - n_words * 4", least=0),
)


def _removed(text: Column, characters: str) -> Column:
    """How many of ``characters`` the text holds, in code points."""
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def _covered(words: Column, window: int) -> tuple[Column, Column]:
    """The windows of ``words`` sorted with their places, and how many there are."""
    n = F.size(words) - F.lit(window - 1)
    parts = [F.slice(words, i + 1, F.greatest(n, F.lit(0))).alias(f"w{i}") for i in range(window)]
    places = F.slice(F.sequence(F.lit(0), F.size(words)), 1, F.greatest(n, F.lit(0))).alias("at")
    return F.sort_array(F.arrays_zip(*parts, places)), n


def _beside(ordered: Column) -> Column:
    """Each entry of an array with the one before it and the one after it."""
    n = F.size(ordered)
    nothing = F.slice(ordered, 1, 0)
    before = F.when(n > 0, F.concat(F.array(F.lit(None)), F.slice(ordered, 1, F.greatest(n - 1, F.lit(0)))))
    after = F.when(n > 0, F.slice(ordered, 2, n))
    return F.arrays_zip(
        ordered.alias("own"), F.coalesce(before, nothing).alias("before"), F.coalesce(after, nothing).alias("after")
    )


def _counts(df: DataFrame, carried: Sequence[str], text: str) -> DataFrame:
    """One row per row with the counts the rules speak of, columns ``k0..`` carried."""
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(carried)]
    keys = [f"k{i}" for i in range(len(carried))]
    base = df.select(*kept, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    split = base.select(
        *keys, "t", F.filter(F.split("t", "[\\x20\\x09-\\x0D]+"), lambda w: w != "").alias("words"),
        F.filter(F.split("t", "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0).alias("lines"),
    )
    triples, _ = _covered(F.col("words"), 3)
    ordered = split.select(*keys, "t", "words", "lines", triples.alias("ordered"))

    def same(a: Column, b: Column) -> Column:
        return (a["w0"] == b["w0"]) & (a["w1"] == b["w1"]) & (a["w2"] == b["w2"])

    repeated = F.filter(
        _beside(F.col("ordered")),
        lambda e: F.coalesce(same(e["own"], e["before"]), F.lit(False))
        | F.coalesce(same(e["own"], e["after"]), F.lit(False)),
    )
    places = ordered.select(
        *keys, "t", "words", "lines", F.sort_array(F.transform(repeated, lambda e: e["own"]["at"])).alias("places")
    )
    steps = F.arrays_zip(F.col("places").alias("at"), F.slice("places", 2, F.greatest(F.size("places"), F.lit(1))).alias("next"))
    letters = F.regexp_replace("t", "[^\\p{L}]+", "")
    return places.select(
        *keys,
        F.size("words").cast("long").alias("n_words"),
        (F.char_length("t") - _removed(F.col("t"), SPACES)).cast("long").alias("word_chars"),
        _removed(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(steps, F.lit(0), lambda n, e: n + F.coalesce(F.least(e["next"] - e["at"], F.lit(3)), F.lit(3)))
        .cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.char_length(letters).cast("long").alias("n_letters"),
        (2 * F.char_length(F.regexp_replace(letters, "[^A-Za-z\u00C0-\u024F]+", "")) >= F.char_length(letters)).alias("latin"),
        (F.char_length(letters) - F.char_length(F.regexp_replace(letters, "\\p{Lu}+", ""))).cast("long").alias("n_capitals"),
        _removed(F.col("t"), "!").cast("long").alias("n_exclamations"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"),
    )


def broken_rules(rules: Sequence[Rule]) -> Column:
    """The names of the rules a row of counts breaks, as one expression."""
    broken = []
    for rule in rules:
        value = F.expr(rule.metric)
        bad = F.lit(False)
        if rule.least is not None:
            bad = bad | (value < F.lit(rule.least))
        if rule.most is not None:
            bad = bad | (value > F.lit(rule.most))
        broken.append(F.when(bad & (F.col("n_words") >= rule.from_words), F.lit(rule.name)))
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def quality_rules(
    df: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """``key``, the counts, ``broken_rules`` and ``kept`` for every row of ``df``."""
    counted = _counts(df, [key], text)
    judged = counted.select("*", broken_rules(rules).alias("broken_rules"))
    return judged.select(
        F.col("k0").alias(key), *[c for c in judged.columns if c != "k0"], (F.size("broken_rules") == 0).alias("kept")
    )
