from lamina.functions.names import (
    base_name,
    classify_name,
    first_missing,
    landing_target,
    normalise_prefix,
    staging_table,
    uri_parts,
    url_basename,
)
from lamina.functions.values import any_match, code_int, decimal_comma, row_count, separator_of, target_rule

__all__ = [
    "any_match",
    "base_name",
    "classify_name",
    "code_int",
    "decimal_comma",
    "first_missing",
    "landing_target",
    "normalise_prefix",
    "row_count",
    "separator_of",
    "staging_table",
    "target_rule",
    "uri_parts",
    "url_basename",
]
