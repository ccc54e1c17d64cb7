from dimkeeper.functions.columns import (
    OPEN_END,
    align_to,
    date_literal,
    free_name,
    parse_run_date,
    quoted,
    require_columns,
    require_comparable,
    require_free,
    same_values,
    text_literal,
    tracked_columns,
)
from dimkeeper.functions.guards import counted_keys, key_violations, with_unique_keys, without_null_keys
from dimkeeper.functions.text import email_org

__all__ = [
    "OPEN_END",
    "align_to",
    "counted_keys",
    "date_literal",
    "email_org",
    "free_name",
    "key_violations",
    "parse_run_date",
    "quoted",
    "require_columns",
    "require_comparable",
    "require_free",
    "same_values",
    "text_literal",
    "tracked_columns",
    "with_unique_keys",
    "without_null_keys",
]
