"""Summarise the physical plan of every batch query: shuffles, broadcasts,
Python evaluation, codegen stages, and what reaches each Parquet scan.

    python tools/plan_audit.py [sf_dir] [--markdown]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clientlens.plans import batch, io, models  # noqa: E402
from clientlens.session import local_session  # noqa: E402

SKIP = {"train_rf", "tune_rf", "score_clients", "feature_importance", "stream_score",
        "feature_vectors", "write_chunks", "clean_rows", "ingest_table", "write_tsv",
        "exact_quantiles", "load_clients", "exact_median_by_group"}


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    markdown = "--markdown" in sys.argv
    sf = args[0] if args else "/root/testdata/sf0.01"
    spark = local_session(8, extra={"spark.sql.maxMetadataStringLength": "100000"})
    qs = {**batch.QUERIES, **{k: v for k, v in {**io.QUERIES, **models.QUERIES}.items()
                              if k not in SKIP}}
    if markdown:
        print("| key | exchanges | broadcasts | python nodes | columns read | pushed filters |")
        print("| --- | --- | --- | --- | --- | --- |")
    for name, fn in qs.items():
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        shuffles = plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") \
            + plan.count("Exchange SinglePartition") + plan.count("Exchange RoundRobin")
        bcast = plan.count("BroadcastExchange")
        python = plan.count("BatchEvalPython") + plan.count("ArrowEvalPython")
        scans = [re.sub(r"#\d+L?", "", cols) for cols in
                 re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]
        pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
        pushed = [p for p in pushed if p]
        if markdown:
            cols = "; ".join(sc.replace(",", ", ") or "(metadata only)" for sc in scans)
            push = "; ".join(pushed) or "-"
            print(f"| `{name}` | {shuffles} | {bcast} | {python} | {cols} | {push} |")
        else:
            print(f"{name:26s} shuffles={shuffles} broadcast={bcast} python={python} "
                  f"scans={scans} pushed={pushed}")
    spark.stop()


if __name__ == "__main__":
    main()
