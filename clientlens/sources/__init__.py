from clientlens.sources.bucketed import append_bucketed  # noqa: F401
from clientlens.sources.observed import (  # noqa: F401
    batch_metrics, observe_stream, observed_write, table_metrics,
)
from clientlens.sources.files import (  # noqa: F401
    FIELD_COUNT_COL, clean_rows, ingest_table, load_clients, metric_rows, read_raw_rows,
    read_table, register_csv_table, write_chunks, write_tsv,
)
