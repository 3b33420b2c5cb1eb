"""statlake: lazy PySpark operators and batch jobs for wide statistical tables.

Every public function takes and returns DataFrames (or Columns). Nothing in
the library starts or stops a session, collects rows to the driver or loops
over data in Python; sinks are the only actions.
"""

from statlake.functions.measures import (
    NUMERIC_TEXT,
    cast_by_name,
    clean_measure,
    drop_incomplete,
    is_numeric_text,
    recode,
)
from statlake.functions.names import sanitize_columns, sanitize_name
from statlake.functions.periods import parse_period
from statlake.operators.dims import conform_dim, extract_dim
from statlake.operators.joins import denormalize, join_dim
from statlake.operators.keys import (
    anti_members,
    count_by,
    duplicate_keys,
    keep_first,
    key_except,
    key_intersect,
    key_union,
    row_count,
    semi_members,
    sort_desc,
)
from statlake.operators.shape import (
    align_union,
    common_columns,
    normalize_period,
    unpivot_entities,
    unpivot_matching,
    with_literals,
)

__all__ = [
    "NUMERIC_TEXT",
    "align_union",
    "anti_members",
    "cast_by_name",
    "clean_measure",
    "common_columns",
    "conform_dim",
    "count_by",
    "denormalize",
    "drop_incomplete",
    "duplicate_keys",
    "extract_dim",
    "is_numeric_text",
    "join_dim",
    "keep_first",
    "key_except",
    "key_intersect",
    "key_union",
    "normalize_period",
    "parse_period",
    "recode",
    "row_count",
    "sanitize_columns",
    "sanitize_name",
    "semi_members",
    "sort_desc",
    "unpivot_entities",
    "unpivot_matching",
    "with_literals",
]
