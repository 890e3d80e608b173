"""The client-contact streaming job: four concurrent queries over CSV files
arriving in a folder, scored with a saved model.

    python -m clientlens.reports.streams --input-dir incoming/ --out stream-out/ \
        [--model saved-model/] [--available-now]
"""

from __future__ import annotations

import argparse

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from clientlens.schema import stream_schema
from clientlens.session import SCALE_CONF
from clientlens.streaming import FILES_PER_TRIGGER, start_contact_streams, stream_source


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--input-dir", required=True)
    parser.add_argument("--out", required=True, help="outputs and checkpoints")
    parser.add_argument("--model", default=None, help="a pipeline saved by the model report")
    parser.add_argument("--no-header", action="store_true", help="CSV files have no header line")
    parser.add_argument("--files-per-trigger", type=int, default=FILES_PER_TRIGGER,
                        help="files of one micro-batch")
    parser.add_argument("--available-now", action="store_true",
                        help="process what is there and stop (default: every 5 s, forever)")
    parser.add_argument("--master", default=None)
    args = parser.parse_args(argv)
    builder = SparkSession.builder.appName("clientlens-streams")
    if args.master:
        builder = builder.master(args.master)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    stream = stream_source(spark, args.input_dir, stream_schema(), "csv", args.files_per_trigger,
                           header=str(not args.no_header).lower())
    model = PipelineModel.load(args.model) if args.model else None
    trigger = {"availableNow": True} if args.available_now else {"processingTime": "5 seconds"}
    queries = start_contact_streams(stream, args.out, model, trigger)
    if args.available_now:
        for q in queries.values():
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
