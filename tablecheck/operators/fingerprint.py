"""Row and table checksums. One pass, no sort: equal tables in any row order agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.functions.names import column
from tablecheck.functions.rowtext import digest, digest_words, row_text

CHECKSUM_TYPE = "decimal(38,0)"
# Between the sums of an md5 checksum's four words.
WORD_MARK = "-"


def row_checksum(
    df: DataFrame, algo: str = "md5", form: str = "canonical", keep: list[str] | None = None
) -> DataFrame:
    """One ``checksum`` per row over all columns, after the columns in ``keep``."""
    return df.select(
        *[column(c) for c in keep or []], digest(row_text(df, form), algo).alias("checksum")
    )


def _halves(value: Column, side: Column | None = None) -> tuple[Column, Column]:
    """Sums of the upper and lower 16 bits: long arithmetic, safe to 10^14 rows."""
    pick = (lambda v: v) if side is None else (lambda v: F.when(side, v))
    high = F.sum(pick(F.shiftright(value, 16)))
    low = F.sum(pick(value.bitwiseAND(F.lit(65535).cast("bigint"))))
    return high, low


def _whole(high: str, low: str) -> Column:
    zero = F.lit(0).cast(CHECKSUM_TYPE)
    parts = [F.coalesce(F.col(c).cast(CHECKSUM_TYPE), zero) for c in (high, low)]
    return (parts[0] * F.lit(65536) + parts[1]).cast(CHECKSUM_TYPE)


def _word_sums(n_words: int, mark: str, side: Column | None = None) -> list[Column]:
    """The aggregates behind one checksum, named after ``mark``."""
    sums = []
    for i in range(n_words):
        high, low = _halves(F.col(f"v{i}"), side)
        sums += [high.alias(f"{mark}h{i}"), low.alias(f"{mark}l{i}")]
    return sums


def _checksum(n_words: int, mark: str) -> Column:
    """One number for a digest of one word, the sums joined by a mark for one of several."""
    wholes = [_whole(f"{mark}h{i}", f"{mark}l{i}") for i in range(n_words)]
    return wholes[0] if n_words == 1 else F.concat_ws(WORD_MARK, *[w.cast("string") for w in wholes])


def _words_of(df: DataFrame, algo: str, form: str) -> list[Column]:
    return [word.alias(f"v{i}") for i, word in enumerate(digest_words(row_text(df, form), algo))]


def table_checksum(df: DataFrame, algo: str = "crc32", form: str = "canonical") -> DataFrame:
    """One row: ``algo``, ``row_count`` and the sum of the row checksums.

    Every bit of the digest counts: ``checksum`` is a number for crc32, and the sums of the
    four 32-bit words, joined by ``-``, for md5.
    """
    words = _words_of(df, algo, form)
    totals = df.select(*words).agg(F.count(F.lit(1)).alias("row_count"), *_word_sums(len(words), "t"))
    return totals.select(F.lit(algo).alias("algo"), "row_count", _checksum(len(words), "t").alias("checksum"))


def file_checksums(
    spark: SparkSession, path: str, algo: str = "md5", form: str = "canonical", fmt: str = "parquet"
) -> DataFrame:
    """``file_path, row_count, checksum`` of every data file below ``path`` that has rows.

    Spark knows the file of every row, so one combined aggregate reads each file once.
    Partition columns are part of the rows.
    """
    rows = spark.read.format(fmt).load(path)
    words = _words_of(rows, algo, form)
    marked = rows.select(F.col("_metadata.file_path").alias("file_path"), *words)
    totals = marked.groupBy("file_path").agg(F.count(F.lit(1)).alias("row_count"), *_word_sums(len(words), "t"))
    return totals.select("file_path", "row_count", _checksum(len(words), "t").alias("checksum"))


def checksum_equal(
    a: DataFrame, b: DataFrame, algo: str = "crc32", form: str = "canonical"
) -> DataFrame:
    """One row with both row counts and checksums and whether they agree.

    Agreement is strong evidence, not proof; ``compare_multiset`` is the proof.
    """
    words = _words_of(a, algo, form)
    numbers = a.select(F.lit(True).alias("in_a"), *words).unionAll(
        b.select(F.lit(False).alias("in_a"), *_words_of(b, algo, form))
    )
    in_a, n = F.col("in_a"), len(words)
    totals = numbers.agg(
        F.count_if(in_a).alias("rows_a"),
        F.count_if(~in_a).alias("rows_b"),
        *_word_sums(n, "a", in_a), *_word_sums(n, "b", ~in_a),
    ).select("rows_a", "rows_b", _checksum(n, "a").alias("checksum_a"), _checksum(n, "b").alias("checksum_b"))
    agree = (F.col("rows_a") == F.col("rows_b")) & (F.col("checksum_a") == F.col("checksum_b"))
    return totals.withColumn("checksums_equal", agree)
