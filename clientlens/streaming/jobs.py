"""The client-contact streaming job: four concurrent queries on one source.

One file source (the client schema plus ``event_time``) feeds:

* ``job_aggregation``: running mean balance, mean duration and count per job
  (complete mode, versioned sink);
* ``ml_predictions``: the batch-trained model scores every row on the stream
  (append mode, file sink, exactly-once);
* ``window_analysis``: count and mean balance per 1 min / 10 s sliding
  window (update mode, watermarked so state is evicted);
* ``watermark_query``: the same per 1 min / 30 s window and job, watermark
  30 s (update mode).

Each query has its own checkpoint under ``root``; together they read the
source independently, as separate streaming queries do.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clientlens.streaming.streams import (
    event_time, start_stream, stream_group_agg, stream_sliding, stream_watermark,
    versioned_batch_writer,
)


def start_contact_streams(stream: DataFrame, root: str, model: PipelineModel | None = None,
                          trigger: dict | None = None, watermark: str = "30 seconds",
                          score_cols: tuple[str, ...] = ("age", "job", "balance"),
                          ) -> dict[str, StreamingQuery]:
    """Start the four queries; returns them by name. Outputs go to
    ``root/<name>`` and checkpoints to ``root/<name>-checkpoint``."""
    trigger = trigger or {"processingTime": "5 seconds"}
    root = root.rstrip("/")
    timed = event_time(stream, "event_time")

    def paths(name: str) -> tuple[str, str]:
        return f"{root}/{name}", f"{root}/{name}-checkpoint"

    queries: dict[str, StreamingQuery] = {}
    out, ckpt = paths("job_aggregation")
    agg = stream_group_agg(stream, "job", {
        "avg_balance": F.round(F.avg("balance"), 2),
        "avg_duration": F.round(F.avg("duration"), 2),
        "transaction_count": F.count(F.lit(1))})
    queries["job_aggregation"] = start_stream(agg, "job_aggregation", "complete",
                                              versioned_batch_writer(out), checkpoint=ckpt,
                                              trigger=trigger)
    if model is not None:
        from clientlens.ml.models import score
        out, ckpt = paths("ml_predictions")
        scored = score(model, stream, keep=list(score_cols))  # the model prepares its rows
        queries["ml_predictions"] = start_stream(scored, "ml_predictions", "append", "parquet",
                                                 path=out, checkpoint=ckpt, trigger=trigger)
    out, ckpt = paths("window_analysis")
    win = stream_sliding(timed, "event_time", "balance", "1 minute", "10 seconds", watermark)
    queries["window_analysis"] = start_stream(win, "window_analysis", "update",
                                              versioned_batch_writer(out), checkpoint=ckpt,
                                              trigger=trigger)
    out, ckpt = paths("watermark_query")
    keyed = stream_watermark(timed, "event_time", "job", "balance", "1 minute", "30 seconds",
                             watermark)
    queries["watermark_query"] = start_stream(keyed, "watermark_query", "update",
                                              versioned_batch_writer(out), checkpoint=ckpt,
                                              trigger=trigger)
    return queries
