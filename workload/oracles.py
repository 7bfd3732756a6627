"""The same queries in plain SQL, for any engine that has the tables as views."""

from __future__ import annotations

from workload import fixtures as fx
from workload.queries import LABEL, LINE_KEY, ROW_LIMIT, RUN_DATE, SAMPLE_KEYS, VERSIONS

_ORDER_TEXT_COLUMNS = {"o_orderdate"}
_LINE_TEXT_COLUMNS = {"l_quantity", "l_extendedprice", "l_shipdate", "l_discount", "l_tax"}


def _shown(expression: str, name: str, text: bool) -> str:
    return f"CAST({expression} AS VARCHAR) AS {name}" if text else f"{expression} AS {name}"


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(c.strip() for c in ctes)


# -- comparison -----------------------------------------------------------------------------


def _flag(name: str, null_equal: bool) -> str:
    if null_equal:
        return f"CASE WHEN a.here AND b.here AND a.{name} IS NOT DISTINCT FROM b.{name} THEN 'match' ELSE 'unmatch' END"
    return f"CASE WHEN a.{name} = b.{name} THEN 'match' ELSE 'unmatch' END"


def _comparison(on: str, null_equal: bool = False, copies: bool = False) -> str:
    """CTEs up to ``cmp``: the full outer comparison of orders A and B."""
    values = [f"{side}.{c} AS {c}_{side}" for side in "ab" for c in fx.ORDERS]
    flags = [f"{_flag(c, null_equal)} AS {c}_result" for c in fx.ORDERS]
    counts = [f"CASE WHEN {s}.here THEN 1 ELSE 0 END AS copies_{s}" for s in "ab"] if copies else []
    verdict = " OR ".join(f"{c}_result = 'unmatch'" for c in fx.ORDERS)
    return _with(
        fx.ORDERS_PAIR_SQL,
        f"""flagged AS (SELECT {', '.join(values + flags + counts)}
        FROM (SELECT *, true AS here FROM a) a FULL JOIN (SELECT *, true AS here FROM b) b ON {on})""",
        f"cmp AS (SELECT *, CASE WHEN {verdict} THEN 'unmatch' ELSE 'match' END AS validation_result FROM flagged)",
    )


_KEYED = _comparison("a.o_orderkey = b.o_orderkey")
_NULLSAFE = _comparison("a.o_orderkey IS NOT DISTINCT FROM b.o_orderkey", null_equal=True)
_BY_ALL = _comparison(" AND ".join(f"a.{c} = b.{c}" for c in fx.ORDERS), copies=True)

_VALUES = [_shown(f"{c}_{s}", f"{c}_{s}", c in _ORDER_TEXT_COLUMNS) for s in "ab" for c in fx.ORDERS]
_FLAGS = [f"{c}_result" for c in fx.ORDERS]
_LAYOUT = ", ".join([*_VALUES, *_FLAGS, "validation_result"])


def _paired_lines() -> str:
    """Equal rows first, then the rest of each key in md5 order, copy by copy."""
    names = fx.LINEITEM_NAMES
    listed, keys = ", ".join(names), ", ".join(LINE_KEY)
    text = "concat_ws(',', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in names) + ")"
    ctes = [
        fx.LINEITEM_PAIR_SQL,
        f"""folded AS (SELECT {listed}, CAST(sum(ca) AS BIGINT) AS ca, CAST(sum(cb) AS BIGINT) AS cb
        FROM (SELECT {listed}, 1 AS ca, 0 AS cb FROM a UNION ALL SELECT {listed}, 0, 1 FROM b) u GROUP BY {listed})""",
    ]
    for side, own, other in (("a", "ca", "cb"), ("b", "cb", "ca")):
        ctes.append(f"""rest_{side} AS (SELECT {listed}, {own} - {other} AS extra,
        row_number() OVER (PARTITION BY {keys} ORDER BY md5({text})) AS r FROM folded WHERE {own} > {other})""")
    on = " AND ".join(f"x.{k} = y.{k}" for k in [*LINE_KEY, "r"])
    both = ", ".join([f"x.{c} AS {c}_a" for c in names] + [f"y.{c} AS {c}_b" for c in names])
    from_a = ", ".join([f"{c}_a" for c in names] + [f"NULL AS {c}_b" for c in names])
    from_b = ", ".join([f"NULL AS {c}_a" for c in names] + [f"{c}_b" for c in names])
    same = ", ".join([f"{c} AS {c}_a" for c in names] + [f"{c} AS {c}_b" for c in names])
    met = ", ".join([f"{c}_a" for c in names] + [f"{c}_b" for c in names])
    ctes += [
        f"""met AS (SELECT {both}, coalesce(x.extra, 0) AS ea, coalesce(y.extra, 0) AS eb
        FROM rest_a x FULL JOIN rest_b y ON {on})""",
        f"""paired AS (SELECT {same}, least(ca, cb) AS copies_a, least(ca, cb) AS copies_b
        FROM folded WHERE least(ca, cb) > 0
        UNION ALL SELECT {met}, least(ea, eb), least(ea, eb) FROM met WHERE least(ea, eb) > 0
        UNION ALL SELECT {from_a}, ea - least(ea, eb), 0 FROM met WHERE ea > eb
        UNION ALL SELECT {from_b}, 0, eb - least(ea, eb) FROM met WHERE eb > ea)""",
    ]
    flags = [f"CASE WHEN {c}_a = {c}_b THEN 'match' ELSE 'unmatch' END AS {c}_result" for c in names]
    verdict = " AND ".join(f"coalesce({c}_a = {c}_b, false)" for c in names)
    values = [_shown(f"{c}_{s}", f"{c}_{s}", c in _LINE_TEXT_COLUMNS) for s in "ab" for c in names]
    shown = ", ".join(values + flags)
    return f"""{_with(*ctes)} SELECT {shown}, CASE WHEN {verdict} THEN 'match' ELSE 'unmatch' END AS validation_result,
    CAST(copies_a AS BIGINT) AS copies_a, CAST(copies_b AS BIGINT) AS copies_b FROM paired"""


def _multiset(pair: str, names: list[str]) -> str:
    listed = ", ".join(names)
    return f"""{_with(pair)}, folded AS (
    SELECT {listed}, CAST(sum(ca) AS BIGINT) AS copies_a, CAST(sum(cb) AS BIGINT) AS copies_b
    FROM (SELECT {listed}, 1 AS ca, 0 AS cb FROM a UNION ALL SELECT {listed}, 0, 1 FROM b) u
    GROUP BY {listed} HAVING sum(ca) <> sum(cb))"""


def _schema_diff() -> str:
    rows = [
        ("o_custkey", "both", "'bigint'", "'string'", "type"),
        ("o_orderkey", "both", "'bigint'", "'bigint'", "nullable"),
        ("o_orderstatus", "both", "'string'", "'string'", "metadata"),
        ("o_orderpriority", "a", "'string'", "NULL", "only_a"),
        ("o_priority", "b", "NULL", "'string'", "only_b"),
    ]
    parts = []
    for name, side, type_a, type_b, kind in rows:
        nullable_a = "NULL" if side == "b" else "true"
        nullable_b = "NULL" if side == "a" else ("false" if kind == "nullable" else "true")
        count_a = "NULL" if side == "b" else f"(SELECT count({name}) FROM orders)"
        count_b = {
            "only_a": "NULL",
            "only_b": "(SELECT count(o_orderpriority) FROM orders WHERE o_orderkey % 3 = 0)",
        }.get(kind, f"(SELECT count({name}) FROM orders)")
        parts.append(
            f"SELECT '{name}' AS column_name, '{side}' AS side, CAST({type_a} AS VARCHAR) AS type_a, "
            f"CAST({type_b} AS VARCHAR) AS type_b, CAST({nullable_a} AS BOOLEAN) AS nullable_a, "
            f"CAST({nullable_b} AS BOOLEAN) AS nullable_b, '{kind}' AS kind, "
            f"CAST({count_a} AS BIGINT) AS values_a, CAST({count_b} AS BIGINT) AS values_b"
        )
    return " UNION ALL ".join(parts)


# -- audit -------------------------------------------------------------------------------------


def _audit(column: str, flag: str, table_a: str, table_b: str) -> str:
    count = f"CAST(count(*) FILTER (WHERE {flag} = 'unmatch') AS BIGINT)"
    return f"""SELECT 'ABTest' AS test_name, '{table_a}' AS table_a, '{table_b}' AS table_b,
    '{column}' AS column_name, false AS schema_mismatch, {count} > 0 AS data_mismatch,
    {count} AS mismatch_count, CAST(NULL AS VARCHAR) AS validation_errors,
    '{RUN_DATE}' AS run_date, '{LABEL}' AS run_label FROM cmp"""


def _audit_all(table_a: str = "orders_a", table_b: str = "orders_b") -> str:
    return " UNION ALL ".join(_audit(c, f"{c}_result", table_a, table_b) for c in fx.ORDERS)


_AUDIT_ONE = _audit("ALL", "validation_result", "orders_a", "orders_b")

_IS_MISMATCH = """test_name IS NOT NULL AND (coalesce(schema_mismatch, false) OR coalesce(data_mismatch, false)
OR coalesce(mismatch_count > 0, false) OR validation_errors IS DISTINCT FROM 'No errors')"""


def _rollup() -> str:
    parts = []
    for kind in ("schema", "data"):
        order = "ORDER BY run_date NULLS FIRST, table_a NULLS FIRST, table_b NULLS FIRST"
        hits = f"SELECT * FROM audit WHERE test_name IS NOT NULL AND {kind}_mismatch"
        first = lambda c: (
            f"(SELECT {c} FROM ({hits}) h WHERE h.test_name = t.test_name AND {c} IS NOT NULL {order} LIMIT 1)"
        )
        parts.append(
            f"SELECT '{kind}' AS kind, test_name, {first('table_a')} AS table_a, {first('table_b')} AS table_b "
            f"FROM (SELECT DISTINCT test_name FROM ({hits}) d) t"
        )
    union = " UNION ALL ".join(parts)
    return f"{_with(fx.AUDIT_SQL)} SELECT *, table_a || ' / ' || table_b AS tables FROM ({union}) r"


def _summary() -> str:
    """One grouped pass: rows counted, and whether any of them calls for the drill-down."""
    keys = ["test_name", "table_a", "table_b", "column_name"]
    text = ("'SELECT * FROM ' || table_a || ' WHERE ' || column_name || ' IS NULL OR ' || column_name || ' IN (SELECT ' "
            "|| column_name || ' FROM ' || table_b || ' WHERE ' || column_name || ' IS NULL)'")
    listed, complete = ", ".join(keys), " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"""{_with(fx.AUDIT_SQL, fx.EXPECTED_SQL)} SELECT {listed},
    column_name NOT IN (SELECT column_name FROM expected) AS schema_mismatch,
    bool_or(coalesce(data_mismatch, false)) AS data_mismatch, count(*) AS mismatch_count, '2024-01-01' AS run_date,
    CASE WHEN {complete} AND bool_or(coalesce(schema_mismatch, false) OR coalesce(data_mismatch, false))
    THEN {text} END AS drill_down_query FROM audit GROUP BY {listed}"""


# -- experiment ----------------------------------------------------------------------------------


def _rates(prefix: str, avg: str, rate: str) -> str:
    return f"""count(user_id) AS {prefix}_users, CAST(sum(conversion) AS BIGINT) AS {prefix}_conversions,
    round(avg(time_on_site), 4) AS {avg},
    round(CAST(sum(conversion) AS DOUBLE) / nullif(count(user_id), 0), 4) AS {rate}"""


_OVERALL = _rates("total", "avg_time_on_site", "conversion_rate")
_DAILY = _rates("daily", "daily_avg_time_on_site", "daily_conversion_rate")


def _report() -> str:
    """Days first; the totals of a variation are added up from its days."""
    whole = "OVER (PARTITION BY experiment_id, variation)"
    users, conversions = f"sum(n) {whole}", f"sum(hits) {whole}"
    return f"""{_with(fx.EXPOSURES_SQL)} SELECT experiment_id, variation, CAST({users} AS BIGINT) AS total_users,
    CAST({conversions} AS BIGINT) AS total_conversions,
    round(sum(seconds) {whole} / nullif(sum(timed) {whole}, 0), 4) AS avg_time_on_site,
    round(CAST({conversions} AS DOUBLE) / nullif({users}, 0), 4) AS conversion_rate, CAST(date AS VARCHAR) AS date,
    n AS daily_users, hits AS daily_conversions, round(seconds / nullif(timed, 0), 4) AS daily_avg_time_on_site,
    round(CAST(hits AS DOUBLE) / nullif(n, 0), 4) AS daily_conversion_rate
    FROM (SELECT experiment_id, variation, date, count(user_id) AS n, CAST(sum(conversion) AS BIGINT) AS hits,
    sum(time_on_site) AS seconds, count(time_on_site) AS timed FROM exposures GROUP BY ALL) days"""


# -- fingerprints ----------------------------------------------------------------------------------


def _canonical(columns: list[str], escaped: set[str]) -> str:
    parts = []
    for c in columns:
        text = f"CAST({c} AS VARCHAR)"
        if c in escaped:
            text = f"replace(replace({text}, '\\', '\\\\'), ',', '\\,')"
        parts.append(f"coalesce({text}, '\\N')")
    return f"concat_ws(',', {', '.join(parts)})"


_DOCUMENT_TEXT = _canonical(fx.DOCUMENTS, {"text", "lang", "source"})
_ORDER_TEXT = _canonical(fx.ORDERS, {"o_orderstatus", "o_orderpriority"})
_ORDERS_TEXT = fx.select_sql(fx.ORDERS_TEXT, "orders")
_WORD_SUMS = ", ".join(
    f"CAST(coalesce(sum(CAST('0x' || substr(md5({_ORDER_TEXT}), {at}, 8) AS BIGINT)), 0) AS VARCHAR)"
    for at in (1, 9, 17, 25)
)
_SUMMED = f"concat_ws('-', {_WORD_SUMS})"


_FILE_TEXT = _canonical([*fx.ORDERS, "status"], {"o_orderstatus", "o_orderpriority", "status"})
_FILE_SUMMED = _SUMMED.replace(_ORDER_TEXT, _FILE_TEXT)


def _version(name: str, kept: str, customer: str) -> str:
    """Files are statuses here: which of them hold other rows than in the original."""
    return f"""SELECT '{name}' AS version, count(a.n) AS files_a, count(b.n) AS files_b,
    count(a.n) FILTER (WHERE NOT coalesce(same, false)) AS only_in_a,
    count(b.n) FILTER (WHERE NOT coalesce(same, false)) AS only_in_b, bool_and(coalesce(same, false)) AS contents_equal,
    bool_and(coalesce(a.n = b.n, false)) AS files_equal
    FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY ALL) a
    FULL JOIN (SELECT o_orderstatus, count(*) AS n FROM orders WHERE {kept} GROUP BY ALL) b USING (o_orderstatus)
    LEFT JOIN (SELECT o_orderstatus, bool_and(coalesce({kept}, false) AND o_custkey = {customer}) AS same
    FROM orders GROUP BY ALL) c USING (o_orderstatus)"""


def _crc32(text: str) -> str:
    """The checksum bit by bit, over the bytes of the UTF-8 text."""
    digits = f"hex(encode({text}))"
    listed = f"list_transform(range(0, length({digits}) // 2), lambda i: CAST('0x' || substr({digits}, 2 * i + 1, 2) AS BIGINT))"
    shifted = "list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {listed}), lambda crc, b: {shifted}), 4294967295)"


def _crc32_sum(text: str, rows: str) -> str:
    return f"""SELECT 'crc32' AS algo, count(*) AS row_count, CAST(coalesce(sum({_crc32('t')}), 0) AS VARCHAR) AS checksum
    FROM (SELECT {text} AS t FROM ({rows}) r) texts"""


_LINES_TEXT = _crc32_sum(
    _canonical(fx.LINEITEM_NAMES, {"l_returnflag", "l_linestatus"}), fx.select_sql(fx.LINEITEM, "lineitem")
)
_PLAIN_TEXT = _crc32_sum(
    "concat_ws(',', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment)", fx.select_sql(fx.CUSTOMER_TEXT, "customer")
)


# -- logs ---------------------------------------------------------------------------------------------


def _live(name: str, where: str) -> str:
    return f"""{name} AS (SELECT file_path, size FROM (SELECT *, row_number() OVER (
    PARTITION BY file_path ORDER BY version DESC, is_add DESC, size DESC NULLS LAST) AS r
    FROM log WHERE {where}) x WHERE r = 1 AND is_add)"""


# -- samples --------------------------------------------------------------------------------------------

_SAMPLED = f"keys AS (SELECT DISTINCT o_custkey FROM a WHERE o_custkey IS NOT NULL ORDER BY o_custkey LIMIT {SAMPLE_KEYS})"
_ORDER_COLUMNS = ", ".join(_shown(c, c, c in _ORDER_TEXT_COLUMNS) for c in fx.ORDERS)


def _sampled(labels: dict[str, str], most: int | None = None) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in ["o_custkey", *[c for c in fx.ORDERS if c != "o_custkey"]])
    cap = f" ORDER BY {order} LIMIT {most}" if most else ""
    return " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{label}' AS side, {_ORDER_COLUMNS} FROM (SELECT * FROM {source} "
        f"WHERE o_custkey IN (SELECT o_custkey FROM keys){cap}) cut) shown"
        for label, source in labels.items()
    )


# -- templates --------------------------------------------------------------------------------------------

_KEYS = """keys AS (SELECT 'doc_' || CAST(doc_id AS VARCHAR) AS domain_cd, lang AS table_cd FROM documents
UNION SELECT 'doc_' || CAST(doc_id AS VARCHAR), source FROM documents)"""
_LINE_COLUMNS = ", ".join(_shown(c, c, c in _LINE_TEXT_COLUMNS) for c in fx.LINEITEM_NAMES)

_UNMATCHED = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS unmatched_count FROM cmp WHERE {c}_result = 'unmatch'" for c in fx.ORDERS
)

ORACLES: dict[str, str] = {
    "compare_by_key": f"{_KEYED} SELECT {_LAYOUT} FROM cmp",
    "compare_by_key_nullsafe": f"{_NULLSAFE} SELECT {_LAYOUT} FROM cmp",
    "compare_by_key_pair": _paired_lines(),
    "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem "
                      "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    "compare_all_columns": f"{_BY_ALL} SELECT {_LAYOUT}, CAST(copies_a AS BIGINT) AS copies_a, "
                           "CAST(copies_b AS BIGINT) AS copies_b FROM cmp",
    "compare_multiset": f"{_multiset(fx.LINEITEM_PAIR_SQL, fx.LINEITEM_NAMES)} "
                        f"SELECT {_LINE_COLUMNS}, copies_a, copies_b FROM folded",
    "nested_values": f"""WITH b AS (SELECT *, {fx.NESTED_B['status']} AS status, {fx.NESTED_B['moment']} AS moment,
        {fx.NESTED_B['price']} AS price FROM orders), compared AS (SELECT o_orderkey,
        status = o_orderstatus AND moment = 0 AND price = o_totalprice AS same FROM b)
        SELECT o_orderkey, CASE WHEN same THEN 'match' ELSE 'unmatch' END AS detail_result, same AS checksums_equal
        FROM compared""",
    "unmatched_rows": f"{_KEYED} SELECT {', '.join([*_VALUES, *_FLAGS])}, 'unmatched' AS validation_result "
                      "FROM cmp WHERE validation_result = 'unmatch'",
    "drill_down": f"{_KEYED} SELECT {', '.join(_VALUES)}, o_totalprice_result "
                  "FROM cmp WHERE o_totalprice_result = 'unmatch'",
    "assert_tables_equal": f"""{_multiset(fx.ORDERS_PAIR_SQL, fx.ORDERS)}
        SELECT 'orders, reordered' AS pair, CAST(0 AS BIGINT) AS only_in_a, CAST(0 AS BIGINT) AS only_in_b,
        true AS tables_equal, 'True' AS answer UNION ALL SELECT 'orders A, orders B',
        CAST(coalesce(sum(greatest(copies_a - copies_b, 0)), 0) AS BIGINT),
        CAST(coalesce(sum(greatest(copies_b - copies_a, 0)), 0) AS BIGINT), count(*) = 0,
        'Data in dataframe and after_table are different.' FROM folded""",
    "schema_diff": _schema_diff(),
    "column_mismatch_audit": f"{_KEYED} {_audit_all()}",
    "table_mismatch_audit": f"{_KEYED} {_AUDIT_ONE}",
    "audit_append": f"{_KEYED} {_audit_all()} UNION ALL {_AUDIT_ONE}",
    "result_overwrite": f"{_KEYED} SELECT {_LAYOUT} FROM cmp",
    "ab_test": f"{_KEYED} {_audit_all('orders_run', 'orders_run_b')}",
    "ab_test_all_columns": f"{_BY_ALL} {_audit_all('orders_all', 'orders_all_b')}",
    "unmatched_counts": f"{_KEYED} {_UNMATCHED}",
    "audit_dashboard": f"""{_with(fx.AUDIT_SQL)} SELECT CASE WHEN test_name LIKE '%dev%' THEN 'Dev'
        WHEN test_name LIKE '%test%' THEN 'Test' WHEN test_name LIKE '%prod%' THEN 'Prod' ELSE 'Unknown' END
        AS "Workspace", table_a AS "Base_Table", table_b AS "Test_Table", schema_mismatch,
        mismatch_count AS actual_mismatch, CASE WHEN mismatch_count = 0 THEN 'No' ELSE 'Yes' END
        AS "Table_mismatch" FROM audit""",
    "audit_mismatches": f"""{_with(fx.AUDIT_SQL)} SELECT test_name, table_a, table_b, column_name, schema_mismatch,
        data_mismatch, mismatch_count, validation_errors, CAST(run_date AS VARCHAR) AS run_date, run_label
        FROM audit WHERE {_IS_MISMATCH}""",
    "mismatch_rollup": _rollup(),
    "audit_summary": _summary(),
    "conversion_summary": f"{_with(fx.EXPOSURES_SQL)} SELECT experiment_id, variation, {_OVERALL} "
                          "FROM exposures GROUP BY experiment_id, variation",
    "conversion_daily": f"{_with(fx.EXPOSURES_SQL)} SELECT experiment_id, variation, CAST(date AS VARCHAR) AS date, "
                        f"{_DAILY} FROM exposures GROUP BY experiment_id, variation, date",
    "conversion_report": _report(),
    "row_checksum": f"SELECT doc_id, md5({_DOCUMENT_TEXT}) AS checksum FROM documents",
    "row_checksum_plain": f"SELECT doc_id, md5(concat_ws(',', {', '.join(fx.DOCUMENTS)})) AS checksum FROM documents",
    "table_checksum": f"SELECT 'md5' AS algo, count(*) AS row_count, {_SUMMED} AS checksum FROM ({_ORDERS_TEXT}) t",
    "table_checksum_crc32": _LINES_TEXT,
    "table_checksum_plain": _PLAIN_TEXT,
    "checksum_equal": f"""WITH a AS ({_ORDERS_TEXT}), b AS (SELECT * FROM a WHERE o_orderkey % 101 <> 0),
        ta AS (SELECT count(*) AS n, {_SUMMED} AS s FROM a), tb AS (SELECT count(*) AS n, {_SUMMED} AS s FROM b)
        SELECT ta.n AS rows_a, tb.n AS rows_b, ta.s AS checksum_a, tb.s AS checksum_b,
        ta.n = tb.n AND ta.s = tb.s AS checksums_equal FROM ta, tb""",
    "file_stats": """SELECT 'by status' AS place, count(DISTINCT o_orderstatus) AS num_files, count(*) AS rows,
        'o_orderstatus' AS partition_columns FROM orders
        UNION ALL SELECT 'by priority', count(DISTINCT o_orderpriority), count(*), 'o_orderpriority' FROM orders""",
    "file_checksums": f"""SELECT status, count(*) AS row_count, {_FILE_SUMMED} AS checksum
        FROM (SELECT *, o_orderstatus AS status FROM ({_ORDERS_TEXT}) t) rows GROUP BY status""",
    "files_equal": " UNION ALL ".join(_version(name, *version) for name, version in VERSIONS.items()),
    "manifest_added": f"{_with(fx.LOG_SQL)} SELECT DISTINCT file_path FROM log WHERE is_add",
    "manifest_live": f"{_with(fx.LOG_SQL, _live('live', 'true'))} SELECT file_path, size FROM live",
    "manifest_diff": f"""{_with(fx.LOG_SQL, _live('la', 'true'), _live('lb', 'in_b'))}
        SELECT file_path, 'a' AS side FROM la WHERE file_path NOT IN (SELECT file_path FROM lb)
        UNION ALL SELECT file_path, 'b' FROM lb WHERE file_path NOT IN (SELECT file_path FROM la)""",
    "manifest_live_pointed": f"{_with(fx.log_sql(fx.ODD_PATH), _live('live', 'true'))} SELECT file_path, size FROM live",
    "unmatched_counts_in_order": f"{_KEYED} SELECT *, row_number() OVER (ORDER BY unmatched_count DESC, column_name) "
                                 f"AS position FROM ({_UNMATCHED}) u",
    "audit_summary_in_order": f"SELECT *, row_number() OVER (ORDER BY test_name NULLS FIRST, table_a NULLS FIRST, "
                              f"table_b NULLS FIRST, column_name NULLS FIRST) AS position FROM ({_summary()}) s",
    "conversion_report_in_order": f"SELECT *, row_number() OVER (ORDER BY experiment_id, variation, date) AS position "
                                  f"FROM ({_report()}) r",
    "lineitem_in_order": "SELECT l_partkey, l_returnflag, l_linenumber, row_number() OVER (ORDER BY l_partkey DESC, "
                         "l_returnflag, l_linenumber) AS position FROM lineitem",
    "sample_rows_capped": "SELECT l_linenumber, l_returnflag, l_linestatus FROM lineitem ORDER BY ALL "
                          "LIMIT (SELECT count(*) // 2 FROM lineitem)",
    "sample_pair": f"{_with(fx.ORDERS_PAIR_SQL, _SAMPLED)} {_sampled({'a': 'a', 'b': 'b'})}",
    "sample_pair_capped": f"{_with(fx.ORDERS_PAIR_SQL, _SAMPLED)} {_sampled({'a': 'a', 'b': 'b'}, ROW_LIMIT)}",
    "prepare_pair": f"{_with(fx.ORDERS_PAIR_SQL, _SAMPLED)} {_sampled({'main': 'a', 'clone': 'a'})}",
    "normalize_columns": "SELECT * FROM customer",
    "clone_full": f"SELECT {_ORDER_COLUMNS} FROM orders",
    "clone_filtered": f"SELECT {_ORDER_COLUMNS} FROM orders WHERE o_orderstatus = 'F'",
    "clone_tables": """SELECT 's.customer' AS source, 's.s_customer' AS target, 'Deep clone' AS method,
        count(*) AS rows FROM customer UNION ALL SELECT 's.orders', 's.s_orders', 'select_into', count(*)
        FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 's.lineitem', 's.s_lineitem', 'select_into', count(*)
        FROM lineitem""",
    "clone_from_spec_file": f"SELECT {_ORDER_COLUMNS} FROM orders WHERE o_orderstatus = 'O'",
    "schema_diffs": " UNION ALL ".join(
        f"SELECT '{pair}' AS pair, '{name}' AS column_name, '{side}' AS side, '{kind}' AS kind, "
        f"(SELECT count(*) FROM {pair}) AS rows" for pair, name, side, kind in [
            ("orders", "o_custkey", "both", "type"), ("orders", "o_orderkey", "both", "nullable"),
            ("orders", "o_orderstatus", "both", "metadata"), ("orders", "o_orderpriority", "a", "only_a"),
            ("orders", "o_priority", "b", "only_b"), ("customer", "c_acctbal", "a", "only_a"),
        ]
    ),
    "template_table_keys": f"WITH {_KEYS} SELECT domain_cd, table_cd FROM keys",
    "resolve_table_keys": f"""{_with(fx.TEMPLATES_SQL, _KEYS)} SELECT k.domain_cd, k.table_cd,
        r.stage_table_path AS table_path FROM keys k LEFT JOIN reference r ON k.table_cd = r.table_cd""",
    "unresolved_keys": f"""{_with(fx.TEMPLATES_SQL, _KEYS)} SELECT domain_cd, table_cd FROM keys
        WHERE table_cd NOT IN (SELECT table_cd FROM reference)""",
    "render_templates": f"""{_with(fx.TEMPLATES_SQL)} SELECT t.domain_cd,
        replace(replace(replace(replace(t.domain_value, '{{{{ tbl_' || d.lang || ' }}}}', 'lake.' || d.lang),
        '{{{{  tbl_' || d.lang || '}}}}', 'lake.' || d.lang),
        CASE WHEN d.{fx.KNOWN_SOURCES} THEN '{{{{tbl_' || d.source || '}}}}' ELSE '{{{{ none }}}}' END,
        'lake.s_' || d.source), '{{{{ run_env }}}}', 'dev') AS rendered_sql
        FROM templates t JOIN documents d ON t.domain_cd = 'doc_' || CAST(d.doc_id AS VARCHAR)""",
    "run_reference_query": """SELECT n_name, o_orderstatus, count(*) AS n FROM orders JOIN customer
        ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        WHERE n_regionkey = (SELECT r_regionkey FROM region WHERE r_name = 'ASIA') GROUP BY n_name, o_orderstatus""",
    "graph_nodes": """SELECT ':Customer' AS label, o_custkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderkey,
        o_totalprice, o_orderstatus, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
        ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) t WHERE r = 1""",
    "upsert_nodes": """SELECT ':Customer' AS label, c_custkey, c_name, c_nationkey, c_acctbal,
        CASE WHEN c_custkey % 10 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment FROM customer
        UNION ALL SELECT ':Customer', c_custkey + 100000000, c_name, c_nationkey, c_acctbal, c_mktsegment
        FROM customer WHERE c_custkey % 100 = 7""",
}
