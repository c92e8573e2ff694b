"""The one exception the library raises for its own refusals."""

from __future__ import annotations

from enum import Enum


class Code(str, Enum):
    """Stable names for each refusal, so a caller can branch without reading text."""

    BAD_NAME = "bad_name"
    BAD_OPTION = "bad_option"
    STAGING_REQUIRED = "staging_required"
    TABLE_NOT_FOUND = "table_not_found"
    TABLE_IS_VIEW = "table_is_view"
    UNKNOWN_COLUMN = "unknown_column"
    CURSOR_COLUMN_MISSING = "cursor_column_missing"
    CURSOR_TYPE = "cursor_type"
    CURSOR_VALUE = "cursor_value"
    WRITE_MODE = "write_mode"
    SCHEMA_POLICY = "schema_policy"
    MERGE_KEY = "merge_key"
    RESERVED_COLUMN = "reserved_column"
    UNSUPPORTED_TYPE = "unsupported_type"
    SCHEMA_MISMATCH = "schema_mismatch"
    TARGET_KIND = "target_kind"
    SESSION_STATE = "session_state"
    COMMIT_IN_PROGRESS = "commit_in_progress"
    COMMIT_LOST = "commit_lost"
    BATCH_UNKNOWN = "batch_unknown"


class TableflowError(Exception):
    def __init__(self, code: Code, message: str):
        super().__init__(f"{code.value}: {message}")
        self.code = code
