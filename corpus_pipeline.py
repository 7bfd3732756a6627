"""From raw documents to packed token sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it to the
shared folder and reads it back as the next stage's documents. All but the last return the
columns of ``documents``, whatever further columns there are.

Defined cases, beside those of the operators: texts without a letter go in the first stage
(null and empty ones with them); where no language can be learned nothing else goes; of rows
that repeat id and text one stays; of near copies without any id one stays; of an id with
several texts each is decided by itself; a text that is cut to nothing goes; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.llm import decontaminate, language, neardup, packing, queries, substring
from tablecheck.sources.scratch import staged

#: A document stays when its language has this many times the mean probability that it would
#: have by chance. Short clean texts of few telling words reach 1.6; without any telling word,
#: as in an unknown script, the probability is that of chance.
LEAST_LANGUAGE_LIFT = 1.2
#: And when so many of its words' features are ones the model has learned: 0.8 and more in
#: clean texts, however short; half by chance in scripts it never saw, 0.65 in mashed keys.
LEAST_FAMILIAR = 0.7
#: Languages to keep; None keeps all that can be learned.
WANTED_LANGUAGES: tuple[str, ...] | None = None

#: Texts are near copies when their word shingles overlap in this percentage of their union
#: or more. Of pairs at 80 percent, 40 bands of 6 miss 5 in a million.
NEAR_PERCENT = 80
NEAR_BANDS, NEAR_ROWS_PER_BAND = 40, 6


def identify_language(
    spark: SparkSession, docs: DataFrame, sf_dir: str, wanted: tuple[str, ...] | None = WANTED_LANGUAGES
) -> DataFrame:
    """Documents whose language is told with enough confidence, and is wanted; the prediction
    becomes their ``lang``. Null, empty and letterless texts go; repeated rows fare alike; a
    null id is never held out. Where no language can be learned all texts with a letter stay
    as they are."""
    model = language.fit_language_model(docs.where(~queries.held_out()))
    if not model.labels:
        return docs.where(F.col("text").rlike("\\p{L}"))
    [own] = _unused(docs, "told")
    told = docs.withColumn(own, language.language_column(model, F.col("text"), docs))
    sure = F.col(own)["score"] * len(model.labels) >= (LEAST_LANGUAGE_LIFT if len(model.labels) > 1 else 1.0)
    right = F.col(own)["language"].isin(list(wanted)) if wanted is not None else F.lit(True)
    stays = told.where((F.col(own)["score"] > 0) & sure & right & (F.col(own)["familiar"] >= LEAST_FAMILIAR))
    return stays.withColumn("lang", F.col(own)["language"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def _same_text() -> Column:
    return F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))


def _unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until ``docs`` has no column of that name."""
    taken = {c.lower() for c in docs.columns}
    longer = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        longer.append(name)
    return longer


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies. Null, empty and blank texts are copies of
    nothing and stay, once for each id and text; of a group without any id one document stays;
    an id with several texts is decided text by text."""
    own, own_same, same = _unused(docs, "kept_id", "kept_same", "same_text")
    found = neardup.near_duplicates(
        docs.select("doc_id", "text"), percent=NEAR_PERCENT, bands=NEAR_BANDS, rows_per_band=NEAR_ROWS_PER_BAND
    )
    kept = found.where("stands").select(F.col("doc_id").alias(own), F.col("text_md5").alias(own_same)).distinct()
    stays = docs.withColumn(same, _same_text()).join(
        kept, F.col("doc_id").eqNullSafe(F.col(own)) & (F.col(same) == F.col(own_same)), "left_semi"
    )
    return stays.dropDuplicates(["doc_id", same]).drop(same)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of words that occur elsewhere, ``n_chars`` counted anew where a
    text was cut. Null and empty texts stay as they are; a text cut to nothing goes; rows that
    repeat id and text are copies of each other, so both lose their long runs."""
    cut_id, cut_same, left_text, same = _unused(docs, "cut_id", "cut_same", "left_text", "same_text")
    found = substring.substring_dedup(docs.select("doc_id", "text"))
    cut = found.where("kept IS NOT NULL").select(
        F.col("doc_id").alias(cut_id), F.col("same").alias(cut_same), F.col("kept").alias(left_text)
    ).dropDuplicates([cut_id, cut_same])
    joined = docs.withColumn(same, _same_text()).join(
        cut, F.col("doc_id").eqNullSafe(F.col(cut_id)) & (F.col(same) == F.col(cut_same)), "left"
    )
    text = F.col(left_text)
    changed = {"text": F.coalesce(text, F.col("text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(text.isNull(), F.col("n_chars")).otherwise(F.char_length(text))
    left = joined.where(text.isNull() | (text != ""))
    return left.withColumns(changed).select(*[F.col(f"`{c}`") for c in docs.columns])


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that give no benchmark item away. Null and wordless texts give none away and
    stay; repeated rows fare alike; without items all stay."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_leaks(docs, items)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 tokens, one row a piece. A null or empty text is its end token; ids may
    be null or repeat; no documents give no pieces."""
    return packing.pack_documents(docs, queries.TOKENIZER)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate_benchmark),
    ("packing", pack),
]

#: No SQL: languages, signatures and tokens are learned or looked up outside it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
