from clientlens.functions.columns import (  # noqa: F401
    age_group, band5, decade, fixed_point_mean, joined, month_name, month_ordinal,
    parse_double, parse_int, percent, quarter_of, replace_sentinel, upper,
    winsorized, with_event_time,
)
from clientlens.functions.sql import SQL_FUNCTIONS, register_sql_functions  # noqa: F401,E402
