"""Schemas and fixed domain values of the client-contact data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Column order of the 17-column client-contact table (name, type).
CLIENT_COLUMNS = [
    ("age", T.IntegerType()),
    ("job", T.StringType()),
    ("marital", T.StringType()),
    ("education", T.StringType()),
    ("default", T.StringType()),
    ("balance", T.IntegerType()),
    ("housing", T.StringType()),
    ("loan", T.StringType()),
    ("contact", T.StringType()),
    ("day", T.IntegerType()),
    ("month", T.StringType()),
    ("duration", T.IntegerType()),
    ("campaign", T.IntegerType()),
    ("pdays", T.IntegerType()),
    ("previous", T.IntegerType()),
    ("poutcome", T.StringType()),
    ("y", T.StringType()),
]

# Month names as they appear in the data, in calendar order.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun",
          "jul", "aug", "sep", "oct", "nov", "dec"]

# Month -> quarter label.
MONTH_QUARTER = {
    "jan": "Q1", "feb": "Q1", "mar": "Q1",
    "apr": "Q2", "may": "Q2", "jun": "Q2",
    "jul": "Q3", "aug": "Q3", "sep": "Q3",
    "oct": "Q4", "nov": "Q4", "dec": "Q4",
}

# Categorical and numeric feature columns of the propensity model.
CATEGORICAL_COLS = ["job", "marital", "education", "default", "housing",
                    "loan", "contact", "month", "poutcome"]
NUMERIC_COLS = ["age", "balance", "day", "duration", "campaign", "pdays", "previous"]
TARGET_COL = "y"

# Sentinel meaning "never contacted" in pdays.
PDAYS_NEVER = -1
# Ordinal given to a month name outside MONTHS when sorting.
UNKNOWN_MONTH_ORDINAL = 99


def client_schema() -> T.StructType:
    """The typed 17-column schema (explicit: no inference pass over the data)."""
    return T.StructType([T.StructField(n, t, True) for n, t in CLIENT_COLUMNS])


def client_text_schema() -> T.StructType:
    """All-STRING variant for raw ingest where numbers may not parse."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n, _ in CLIENT_COLUMNS])


def stream_schema() -> T.StructType:
    """The 17 columns plus ``event_time`` (a new object on every call, so a
    caller adding fields never changes another stream's schema)."""
    return T.StructType(client_schema().fields + [T.StructField("event_time", T.TimestampType(), True)])
