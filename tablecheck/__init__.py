"""Compare versions of a table on Spark, audit the differences and report on them."""

from tablecheck.operators.audit import (
    AUDIT_SCHEMA,
    WatchedComparison,
    as_audit,
    audit_append,
    audit_jdbc_append,
    audit_records,
    column_mismatch_audit,
    table_mismatch_audit,
)
from tablecheck.operators.check import assert_tables_equal, tables_equal
from tablecheck.operators.clone import clone_filtered, clone_full, clone_tables, read_clone_spec
from tablecheck.operators.compare import (
    compare_all_columns,
    compare_by_key,
    compare_multiset,
    drill_down,
    duplicate_keys,
    unmatched_rows,
)
from tablecheck.operators.experiment import conversion_daily, conversion_report, conversion_summary
from tablecheck.operators.fingerprint import checksum_equal, file_checksums, row_checksum, table_checksum
from tablecheck.operators.graph import graph_nodes, upsert_nodes
from tablecheck.operators.manifest import (
    file_contents_equal,
    file_stats,
    files_equal,
    manifest_added,
    manifest_diff,
    manifest_live,
)
from tablecheck.operators.order import with_position
from tablecheck.operators.report import (
    audit_dashboard,
    audit_mismatches,
    audit_summary,
    mismatch_rollup,
    unmatched_counts,
)
from tablecheck.operators.sample import normalize_columns, sample_pair
from tablecheck.operators.schema import schema_diff, schema_diffs
from tablecheck.operators.sqlref import (
    render_templates,
    resolve_table_keys,
    run_reference_query,
    template_table_keys,
    unresolved_keys,
)
from tablecheck.plans.ab_test import ABTest, result_overwrite, run_ab_test
from tablecheck.plans.prepare_pair import data_files_equal, prepare_pair
from tablecheck.sources.scratch import clear_scratch
from tablecheck.sources.sinks import write_graph_nodes
from tablecheck.sources.txlog import file_actions, read_log

__all__ = [name for name in dir() if not name.startswith("_")]
