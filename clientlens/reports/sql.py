"""Run a file of SQL analyses over a client-contact table registered as the
view ``client_info``. (``reports.batch`` has the standard ones.)

    python -m clientlens.reports.sql --input bank.csv --out report/ --sql my.sql

Statements are separated by ``-- name: <result>`` lines; each becomes one
lazy DataFrame (Spark parses and plans the SQL text itself).
"""

from __future__ import annotations

import argparse
import re

from pyspark.sql import DataFrame, SparkSession

from clientlens.functions.sql import register_sql_functions
from clientlens.reports.common import (
    add_io_args, session_from_args, stage, stage_root, write_report,
)
from clientlens.sources import load_clients

MARKER = "-- name:"


def named_statements(text: str) -> dict[str, str]:
    """``{name: statement}`` from a file of ``-- name:``-headed statements."""
    out: dict[str, str] = {}
    name, lines = None, []
    for line in text.splitlines() + [f"{MARKER} __end__"]:
        if line.strip().startswith(MARKER):
            if name is not None:
                body = "\n".join(lines).strip().rstrip(";").strip()
                if body:
                    out[name] = body
            name, lines = line.strip()[len(MARKER):].strip(), []
        elif name is not None and not line.strip().startswith("--"):
            # a statement-ending semicolon may carry a trailing comment
            lines.append(re.sub(r";\s*(--.*)?$", "", line))
    return out


def sql_report(spark: SparkSession, clients: DataFrame, sql_path: str,
               view: str = "client_info") -> dict[str, DataFrame]:
    clients.createOrReplaceTempView(view)
    register_sql_functions(spark)
    with open(sql_path) as f:
        statements = named_statements(f.read())
    return {name: spark.sql(stmt) for name, stmt in statements.items()}


def main(argv: list[str] | None = None) -> None:
    parser = add_io_args(argparse.ArgumentParser(description=__doc__.splitlines()[0]))
    parser.add_argument("--sql", required=True, help="SQL file with -- name: sections")
    args = parser.parse_args(argv)
    spark = session_from_args(args)
    clients = load_clients(spark, args.input)
    if not args.no_stage:
        clients = stage(clients, f"{stage_root(spark, args.stage_dir)}/typed")
    write_report(sql_report(spark, clients, args.sql), args.out, args.format,
                 args.parallel_writes)


if __name__ == "__main__":
    main()
