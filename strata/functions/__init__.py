from strata.functions.columns import (
    file_name,
    rejected,
    snake_case,
    snake_case_columns,
    stamp,
    typed,
    utc_date,
    wall_clock_stamp,
    with_names,
    with_provenance,
)

__all__ = [
    "file_name",
    "rejected",
    "snake_case",
    "snake_case_columns",
    "stamp",
    "typed",
    "utc_date",
    "wall_clock_stamp",
    "with_names",
    "with_provenance",
]
