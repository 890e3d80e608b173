"""Sources and sinks: typed CSV scans, raw-row cleaning, table ingest,
chunked and tab-separated writers."""

from __future__ import annotations

import re

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientlens.functions.columns import parse_double
from clientlens.schema import client_schema, client_text_schema

FIELD_COUNT_COL = "_n_fields"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture table (``{sf_dir}/{name}.parquet``); column pruning and
    filters reach the Parquet scan. The schema is read from the file's footer
    each time, so a table that was rewritten is read as it is now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_clients(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 fmt: str = "csv", header: bool = True,
                 renames: dict[str, str] | None = None) -> DataFrame:
    """Client-contact rows with an explicit schema (no inference pass).

    Rows whose numbers do not parse become NULL in those fields (PERMISSIVE).
    ``renames`` renames columns, e.g. ``{"default": "default_credit"}`` for
    engines where ``default`` is a keyword.
    """
    reader = spark.read.schema(schema or client_schema())
    if fmt == "csv":
        df = reader.option("header", header).option("mode", "PERMISSIVE").csv(path)
    else:
        df = reader.format(fmt).load(path)
    return df.withColumnsRenamed(renames) if renames else df


def read_raw_rows(spark: SparkSession, path: str, schema: T.StructType | None = None,
                  header: bool = True, sep: str = ",") -> DataFrame:
    """Raw delimited rows, every field as STRING, plus ``_n_fields``: the
    number of fields on the line (delimiters inside quotes do not count).

    Lines are read as text and parsed with ``from_csv``, so the field count is
    known for every line whatever columns a later step prunes.
    """
    schema = schema or client_text_schema()
    # Each line as one raw string; the CSV reader drops the first line of
    # every file when ``header`` is set (by position, whatever it says).
    lines = (spark.read.schema("value STRING").option("header", header)
             .option("sep", "\u0001").option("quote", "\u0000").option("escape", "\u0000")
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
             .csv(path).where(F.col("value").isNotNull()))
    unquoted = F.regexp_replace("value", '"[^"]*"', "")
    n_fields = F.when(F.col("value") == "", 0).otherwise(F.size(F.split(unquoted, re.escape(sep))))
    ddl = ", ".join(f"`{f.name}` STRING" for f in schema.fields)
    parsed = F.from_csv(F.col("value"), ddl, {"sep": sep, "mode": "PERMISSIVE"})
    return lines.select(n_fields.alias(FIELD_COUNT_COL), parsed.alias("r")).select(
        FIELD_COUNT_COL, "r.*")


def clean_rows(raw: DataFrame, n_fields: int | None = None) -> DataFrame:
    """Drop short rows and trim every field (the mappers' ingest rules).

    A row is short when it has fewer fields than the schema (or
    ``n_fields``); a row with extra fields is kept, as the mappers keep it.
    Numbers stay text: parse them per metric with ``metric_rows`` so a bad
    balance only removes the row from balance metrics.
    """
    fields = [c for c in raw.columns if c != FIELD_COUNT_COL]
    need = n_fields or len(fields)
    return (raw.where(F.col(FIELD_COUNT_COL) >= need)
            .select(*[F.trim(F.col(c)).alias(c) for c in fields]))


def metric_rows(clean: DataFrame, numeric: Sequence[str], keep: Sequence[str] = (),
                cast: dict[str, Column] | None = None) -> DataFrame:
    """Rows where every column in ``numeric`` parses as a number (parsed to
    DOUBLE, or by the given expressions), with ``keep`` columns alongside."""
    parsed = {c: (cast or {}).get(c, parse_double(c)) for c in numeric}
    out = clean.select(*keep, *[e.alias(c) for c, e in parsed.items()])
    cond = F.lit(True)
    for c in numeric:
        cond = cond & F.col(c).isNotNull()
    return out.where(cond)


def register_csv_table(spark: SparkSession, table: str, path: str,
                       schema: T.StructType | None = None, header: bool = True,
                       sep: str = ",") -> DataFrame:
    """A catalog table over delimited text files with the header line
    skipped (``CREATE TABLE IF NOT EXISTS ... USING csv``); the files stay
    where they are, and so does a table that has the name already."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                     for f in (schema or client_schema()).fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING csv "
              f"OPTIONS (path '{path}', header '{str(header).lower()}', sep '{sep}')")
    return spark.table(table)


def ingest_table(df: DataFrame, table: str, database: str | None = None,
                 mode: str = "append", path: str | None = None,
                 use: bool = False) -> DataFrame:
    """Create the database if needed and append ``df`` to a catalog table
    (the source files stay in place). ``use`` makes the database current.
    Returns the table as a DataFrame."""
    spark = df.sparkSession
    name = table
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        if use:
            spark.catalog.setCurrentDatabase(database)
        name = f"`{database}`.`{table}`"
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def write_chunks(df: DataFrame, path: str, rows_per_file: int,
                 stamp_col: str | None = "event_time", fmt: str = "csv",
                 mode: str = "errorifexists") -> None:
    """Write ``df`` as files of at most ``rows_per_file`` rows, stamped with
    the write time (the stream feeder's chunk files; the last file keeps the
    remainder, no row is dropped)."""
    out = df.withColumn(stamp_col, F.current_timestamp()) if stamp_col else df
    (out.write.mode(mode).option("maxRecordsPerFile", rows_per_file)
     .option("header", True).format(fmt).save(path))


def write_tsv(df: DataFrame, path: str, header: bool = False, mode: str = "errorifexists") -> None:
    """Tab-separated text output (the reducers' ``key\\tvalue`` lines)."""
    df.write.mode(mode).option("sep", "\t").option("header", header).csv(path)
