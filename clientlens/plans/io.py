"""Source/sink round trips over whole fixture tables.

Each plan writes a table through one of the library's sinks into one named
folder of the application under the shared checkpoint folder (replaced by the
next call, so calls leave no copies behind), reads it back through the
matching source, and returns what came back (plus, for the raw-text path, an
analysis over the cleaned rows).
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientlens import operators as ops
from clientlens.session import app_id, scratch_path
from clientlens.functions.columns import fixed_point_mean
from clientlens.sources import (
    append_bucketed, clean_rows, ingest_table, load_clients, metric_rows, observed_write,
    read_raw_rows, read_table, register_csv_table, table_metrics, write_chunks, write_tsv,
)

def plan_path(spark, *parts: str) -> str:
    return scratch_path(spark, "plans", app_id(spark), *parts, unique=False)


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def write_chunks_plan(spark, sf_dir):
    """Orders written as CSV files of at most 1,000 rows stamped with the
    write time, read back with a fixed schema (the stream feeder's files)."""
    od = read_table(spark, sf_dir, "orders").select(*ORDER_COLS, "o_orderdate")
    path = plan_path(spark, "chunks", "orders")
    write_chunks(od, path, 1000, "event_time", mode="overwrite")
    schema = T.StructType(od.schema.fields + [T.StructField("event_time", T.TimestampType())])
    back = load_clients(spark, path, schema)
    return back.where(F.col("event_time").isNotNull()).select(*ORDER_COLS, "o_orderdate")


def clean_rows_plan(spark, sf_dir):
    """Orders as raw delimited text with faults: every 89th line is cut
    short, every 97th price is 'abc', every field is padded with spaces.
    Short rows are dropped, fields trimmed, prices that do not parse left out
    -> mean price and count per priority (the map/reduce job shape)."""
    od, key = read_table(spark, sf_dir, "orders").select(*ORDER_COLS), F.col("o_orderkey")
    price = F.when(key % 97 == 0, "abc").otherwise(F.col("o_totalprice").cast("string"))
    fields = [price if c == "o_totalprice" else F.col(c).cast("string") for c in ORDER_COLS]
    padded = [F.concat(F.lit(" "), f, F.lit("  ")) for f in fields]
    line = F.when(key % 89 == 0, F.concat_ws(",", *padded[:3])).otherwise(F.concat_ws(",", *padded))
    path = plan_path(spark, "raw", "orders")
    od.select(line).write.mode("overwrite").text(path)
    text = T.StructType([T.StructField(c, T.StringType()) for c in ORDER_COLS])
    clean = clean_rows(read_raw_rows(spark, path, schema=text, header=False))
    rows = metric_rows(clean, ["o_totalprice"], keep=["o_orderpriority"])
    return ops.avg_by_group(rows, "o_orderpriority", "o_totalprice", "avg_totalprice", "row_count",
                            scale=2)


def ingest_table_plan(spark, sf_dir):
    """Load the orders into a catalog table of a database (created if
    missing, stored under the shared folder) in two loads, the second appended
    to the first, and read the table back. One table of the application,
    replaced by each call."""
    root = plan_path(spark, "warehouse")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS clientlens LOCATION '{root}'")
    od = read_table(spark, sf_dir, "orders").select(*ORDER_COLS)
    first = F.col("o_orderkey") % 3 != 0
    ingest_table(od.where(first), "orders_ingest", "clientlens", "overwrite", path=f"{root}/orders_ingest")
    return ingest_table(od.where(~first), "orders_ingest", "clientlens")


def bucketed_group_plan(spark, sf_dir):
    """Orders appended in two loads to a table bucketed and sorted by client,
    then mean price and count per client, which need no exchange. Each call
    has a table of its own."""
    od = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    path = scratch_path(spark, "plans", app_id(spark), "orders_bucketed")
    name = "orders_bucketed_" + path.rsplit("-", 1)[1]
    for part in (F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 3 == 0):
        table = append_bucketed(od.where(part), name, ["o_custkey"], 16, files_per_bucket=2, path=path)
    return table.groupBy("o_custkey").agg(fixed_point_mean("o_totalprice", 2, 2).alias("avg_totalprice"),
                                          F.count(F.lit(1)).alias("order_count"))


def observed_write_plan(spark, sf_dir):
    """Row count, null counts and mean price of the orders, seen while they
    are written (every 50th priority is missing)."""
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    gaps = od.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderpriority")))
    seen = observed_write(gaps, plan_path(spark, "observed", "orders"),
                          table_metrics(gaps, {"avg_totalprice": fixed_point_mean("o_totalprice", 2, 2)}), mode="overwrite")
    return spark.createDataFrame(
        [seen], "row_count long, null_o_orderkey long, null_o_totalprice long, null_o_orderpriority long, avg_totalprice double")


def shared_scan_plan(spark, sf_dir):
    """Two report groups over one persisted scan of the orders: counts by
    priority and by status."""
    od, out = read_table(spark, sf_dir, "orders"), plan_path(spark, "shared")
    keys = {"priority": "o_orderpriority", "status": "o_orderstatus"}
    with ops.shared_scan(od, list(keys.values())) as rows:
        for name, key in keys.items():
            (ops.count_by(rows, key, "row_count").select(F.lit(name).alias("report"), F.col(key).alias("key"), "row_count")
             .write.mode("overwrite").parquet(f"{out}/report={name}"))
    return spark.read.schema("key string, row_count long, report string").parquet(out)


def write_tsv_plan(spark, sf_dir):
    """Mean account balance and client count per market segment, written as
    tab-separated lines and read back."""
    agg = ops.avg_by_group(read_table(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal",
                           "avg_acctbal", "client_count", scale=2)
    path = plan_path(spark, "tsv", "segments")
    write_tsv(agg, path, mode="overwrite")
    return spark.read.schema(agg.schema).option("sep", "\t").csv(path)


def csv_table_plan(spark, sf_dir):
    """A catalog table over headed text files that stay where they are,
    queried by SQL."""
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = scratch_path(spark, "plans", app_id(spark), "csv_orders")
    od.write.option("header", True).option("sep", ";").csv(path)
    name = "csv_orders_" + path.rsplit("-", 1)[1]
    register_csv_table(spark, name, path, od.schema, sep=";")
    return spark.sql(f"SELECT o_orderstatus, count(*) AS row_count, min(o_orderkey) AS first_key FROM {name} GROUP BY o_orderstatus")


def load_renamed_plan(spark, sf_dir):
    """Customers read back from CSV under other column names."""
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    path = plan_path(spark, "csv", "renamed")
    cu.write.mode("overwrite").option("header", True).csv(path)
    return load_clients(spark, path, cu.schema, renames={"c_custkey": "client_id", "c_mktsegment": "job"})


def load_clients_plan(spark, sf_dir):
    """Customers written as headed CSV, read back with an explicit schema
    (no inference pass over the data)."""
    cu = read_table(spark, sf_dir, "customer")
    path = plan_path(spark, "csv", "customer")
    cu.write.mode("overwrite").option("header", True).csv(path)
    return load_clients(spark, path, cu.schema)


QUERIES = {
    "load_clients": load_clients_plan,
    "write_chunks": write_chunks_plan,
    "clean_rows": clean_rows_plan,
    "ingest_table": ingest_table_plan,
    "bucketed_group": bucketed_group_plan,
    "observed_write": observed_write_plan,
    "shared_scan": shared_scan_plan,
    "write_tsv": write_tsv_plan,
    "csv_table": csv_table_plan,
    "load_renamed": load_renamed_plan,
}
