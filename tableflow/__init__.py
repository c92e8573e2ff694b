"""Moving tables in and out of a warehouse with Spark DataFrames."""

from tableflow.errors import Code, TableflowError
from tableflow.functions.jobstats import job_stats
from tableflow.functions.ndjson import ndjson_column, null_element_report, to_ndjson
from tableflow.functions.redact import redact_text, redacted
from tableflow.functions.tablenames import parse_table_names
from tableflow.functions.triage import count_by_class, triage_errors, triage_rpc
from tableflow.operators.append import append_rows
from tableflow.operators.dedup import dedup_last
from tableflow.operators.merge import merge_rows
from tableflow.schema.diff import SchemaProblem, check_write, schema_diff
from tableflow.schema.mapping import MappedColumn, canonical_type, schema_map
from tableflow.session import SETTINGS, configure, size_shuffles, staging_root
from tableflow.sinks.ndjson import load_ndjson, write_ndjson
from tableflow.sinks.staging import expire_staging
from tableflow.sinks.write import WriteResult, WriteSession, settle_batch, write_table
from tableflow.sources.cursor import cursor_condition, typed_literal
from tableflow.sources.names import TableName, parse_table_name
from tableflow.sources.ndjson import read_ndjson
from tableflow.sources.queries import ReadSession, read_query
from tableflow.sources.tables import apply_hints, describe_table, open_table, read_table

__all__ = [name for name in dir() if not name.startswith("_")]
