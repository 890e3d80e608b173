"""The banding and month functions as SQL functions, for SQL users.

They are SQL-bodied temporary functions: Catalyst inlines the body into the
plan like any built-in expression (no Python worker, codegen intact),
unlike a registered Python UDF. Spark does not accept a SQL function
directly in ``ORDER BY``: select it as a column and sort on that column.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from clientlens.schema import MONTH_QUARTER, MONTHS

_MONTH_CASE = " ".join(f"WHEN '{m}' THEN {i + 1}" for i, m in enumerate(MONTHS))
_QUARTER_CASE = " ".join(f"WHEN '{m}' THEN '{q}'" for m, q in MONTH_QUARTER.items())

SQL_FUNCTIONS = {
    "age_group": ("age DOUBLE", "STRING",
                  "CASE WHEN age IS NULL THEN 'unknown' WHEN age < 30 THEN '<30' "
                  "WHEN age <= 60 THEN '30-60' ELSE '>60' END"),
    "age_band5": ("age DOUBLE", "STRING",
                  "CASE WHEN age IS NULL THEN 'unknown' ELSE "
                  "concat(CAST(CAST(floor(age / 5) * 5 AS BIGINT) AS STRING), '-', "
                  "CAST(CAST(floor(age / 5) * 5 AS BIGINT) + 4 AS STRING)) END"),
    "decade_band": ("age DOUBLE", "STRING",
                    "concat(CAST(CAST(floor(age / 10) * 10 AS BIGINT) AS STRING), 's')"),
    "month_quarter": ("month STRING", "STRING", f"CASE month {_QUARTER_CASE} END"),
    "month_ordinal": ("month STRING", "INT", f"COALESCE(CASE month {_MONTH_CASE} END, 99)"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary SQL functions in this session."""
    for name, (args, ret, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
    return list(SQL_FUNCTIONS)
