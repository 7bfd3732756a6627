"""Placeholders in SQL templates, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The table-key prefix and pattern, and the placeholder form {{ name }}.
# A key is a whole word that starts with the prefix. The literal stands first, and the word
# boundary before it is looked up backwards, so the search skips through long texts. (?U)
# gives \w and \b their Unicode meaning.
TABLE_PREFIX = "tbl_"
TABLE_KEY_PATTERN = r"(?U)tbl_(?<=\btbl_)\w+"
PLACEHOLDER_PATTERN = r"(?U)\{\{\s*(\w+)\s*\}\}"
INVALID_SQL = "Invalid SQL Expression"
INVALID_TABLE_LIST = "Table list was not initialized."


def table_keys(template: Column) -> Column:
    """Distinct table keys of a template, prefix removed."""
    return F.array_distinct(_keys(F.regexp_extract_all(template, F.lit(TABLE_KEY_PATTERN), 0)))


def placeholders(template: Column) -> Column:
    """The placeholders of a template, braces included, in order."""
    return F.regexp_extract_all(template, F.lit(PLACEHOLDER_PATTERN), 0)


def placeholder_keys(marks: Column) -> Column:
    """Distinct table keys among placeholders, sorted: what rendering has to look up."""
    tables = F.filter(_names(marks), lambda name: name.startswith(TABLE_PREFIX))
    return F.array_sort(F.array_distinct(_keys(tables)))


def _names(marks: Column) -> Column:
    return F.transform(marks, lambda mark: F.regexp_extract(mark, PLACEHOLDER_PATTERN, 1))


def _key(name: Column) -> Column:
    return F.substring(name, F.lit(len(TABLE_PREFIX) + 1), F.length(name))


def _keys(names: Column) -> Column:
    return F.transform(names, _key)


def checked_template(template: Column) -> Column:
    """The template; an empty or NULL one fails the query."""
    empty = template.isNull() | (template == "")
    return F.when(empty, F.raise_error(F.lit(INVALID_SQL))).otherwise(template)


def rendered(
    template: Column, marks: Column, paths: Column, variables: Mapping[str, str] | None = None
) -> Column:
    """Replace ``{{ tbl_key }}`` from the map ``paths`` and ``{{ name }}`` from ``variables``.

    The template is cut once at its placeholders ``marks`` and put together again, so
    replaced text is never scanned a second time. Placeholders without a value stay.
    """
    texts = F.split(template, PLACEHOLDER_PATTERN, -1)
    filled = F.zip_with(
        marks, _names(marks), lambda mark, name: F.coalesce(_value(name, paths, variables), mark)
    )
    pieces = F.zip_with(texts, filled, lambda text, value: F.concat(text, F.coalesce(value, F.lit(""))))
    return F.array_join(pieces, "")


def _value(name: Column, paths: Column, variables: Mapping[str, str] | None) -> Column:
    table = F.when(name.startswith(TABLE_PREFIX), F.try_element_at(paths, _key(name)))
    if not variables:
        return table
    entries = [part for k, v in variables.items() for part in (F.lit(k), F.lit(v))]
    return F.coalesce(table, F.try_element_at(F.create_map(*entries), name))
