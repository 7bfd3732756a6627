"""SQL kept in tables: find its table keys, resolve them, render it, run it.

``templates`` has ``domain_cd, domain_value``; ``table_reference`` has ``table_cd,
table_path, stage_table_path``. All keys of all templates are resolved in one join.

The looked-up side of each join is written to scratch space first. Its size is then known:
Spark broadcasts it while it is small, and beyond that joins it by shuffle, where adaptive
execution can split a key that most templates name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.functions.templates import (
    INVALID_SQL,
    INVALID_TABLE_LIST,
    checked_template,
    placeholder_keys,
    placeholders,
    rendered,
    table_keys,
)
from tablecheck.sources.scratch import staged

_PATHS = "map<string,string>"


def template_table_keys(templates: DataFrame) -> DataFrame:
    """``domain_cd, table_cd``: the distinct table keys each template names."""
    keys = table_keys(checked_template(F.col("domain_value")))
    return templates.select("domain_cd", F.explode(keys).alias("table_cd")).distinct()


def resolve_table_keys(
    keys: DataFrame | None, table_reference: DataFrame, use_stage: bool = False
) -> DataFrame:
    """Add ``table_path`` to every key; NULL where the reference has no such key.

    Rows of one key may leave the path NULL; two different paths are an error.
    """
    if keys is None:
        raise ValueError(INVALID_TABLE_LIST)
    chosen = "stage_table_path" if use_stage else "table_path"
    least, most = F.min(chosen), F.max(chosen)
    clash = F.concat(F.lit(f"more than one {chosen} for table key "), F.col("table_cd"))
    path = F.when(least != most, F.raise_error(clash).cast("string")).otherwise(least)
    reference = staged(
        table_reference.groupBy("table_cd").agg(path.alias("__path")), "table-reference"
    )
    return keys.join(reference, "table_cd", "left").select(*keys.columns, F.col("__path").alias("table_path"))


def unresolved_keys(
    templates: DataFrame, table_reference: DataFrame, use_stage: bool = False
) -> DataFrame:
    """``domain_cd, table_cd`` of keys without a table path."""
    resolved = resolve_table_keys(template_table_keys(templates), table_reference, use_stage)
    return resolved.where("table_path IS NULL").select("domain_cd", "table_cd")


def render_templates(
    templates: DataFrame,
    table_reference: DataFrame,
    use_stage: bool = False,
    variables: Mapping[str, str] | None = None,
) -> DataFrame:
    """``domain_cd, rendered_sql`` for a whole table of templates.

    Paths are looked up once per distinct set of keys, however many templates name that
    set, and then joined to the templates by it.
    """
    marks = placeholders(F.col("domain_value"))
    sets = templates.where("domain_value <> ''").select(placeholder_keys(marks).alias("__set")).distinct()
    named = sets.select("__set", F.explode("__set").alias("table_cd"))
    resolved = resolve_table_keys(named, table_reference, use_stage).where("table_path IS NOT NULL")
    found = F.map_from_entries(F.collect_list(F.struct("table_cd", "table_path")))
    paths = staged(
        resolved.groupBy(F.col("__set").alias("__named")).agg(found.alias("__paths")), "table-paths"
    )
    known = F.coalesce("__paths", F.create_map().cast(_PATHS))
    checked = templates.select(
        "domain_cd", checked_template(F.col("domain_value")).alias("__text"), marks.alias("__marks")
    )
    keyed = checked.withColumn("__set", placeholder_keys(F.col("__marks")))
    return keyed.join(paths, F.col("__set") == F.col("__named"), "left").select(
        "domain_cd", rendered(F.col("__text"), F.col("__marks"), known, variables).alias("rendered_sql")
    )


def rendered_query(
    templates: DataFrame,
    table_reference: DataFrame,
    domain_cd: str,
    use_stage: bool = False,
    variables: Mapping[str, str] | None = None,
) -> str:
    """The one rendered statement stored under ``domain_cd``."""
    stored = templates.where(F.col("domain_cd") == domain_cd).select("domain_value").take(2)
    if not stored:
        raise ValueError(f"no template stored under {domain_cd!r}")
    if len(stored) > 1:
        raise ValueError(f"more than one template stored under {domain_cd!r}")
    statement = stored[0][0]
    if not statement:
        raise ValueError(INVALID_SQL)
    fixed = templates.sparkSession.createDataFrame([(domain_cd, statement)], "domain_cd string, domain_value string")
    missing = [r[0] for r in unresolved_keys(fixed, table_reference, use_stage).select("table_cd").collect()]
    if missing:
        raise ValueError(f"unresolved table keys in {domain_cd!r}: {', '.join(sorted(missing))}")
    return render_templates(fixed, table_reference, use_stage, variables).first()["rendered_sql"]


def run_reference_query(
    spark: SparkSession,
    templates: DataFrame,
    table_reference: DataFrame,
    domain_cd: str,
    use_stage: bool = False,
    variables: Mapping[str, str] | None = None,
) -> DataFrame:
    """Look up, render and run a stored statement. An unresolved key fails before it runs."""
    return spark.sql(rendered_query(templates, table_reference, domain_cd, use_stage, variables))
