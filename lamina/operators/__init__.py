from lamina.operators.enrich import child_rollup, enrich, left_enrich
from lamina.operators.guards import require_columns, require_rows, require_set_key, require_unique_key
from lamina.operators.joins import lookup_join, missing_from
from lamina.operators.keys import duplicate_keys, latest_per_key
from lamina.operators.normalize import coerce_schema, positional_rename, split_rows
from lamina.operators.upsert import keyed_upsert

__all__ = [
    "child_rollup",
    "coerce_schema",
    "duplicate_keys",
    "enrich",
    "keyed_upsert",
    "latest_per_key",
    "left_enrich",
    "lookup_join",
    "missing_from",
    "positional_rename",
    "require_columns",
    "require_rows",
    "require_set_key",
    "require_unique_key",
    "split_rows",
]
