from clientlens.streaming.streams import (  # noqa: F401
    FILES_PER_TRIGGER, compact_versions, event_time, latest_versions, nonempty_batches, run_append, run_available, start_stream,
    stream_group_agg, stream_sliding, stream_source, stream_watermark,
    versioned_batch_writer, windowed_agg,
)
from clientlens.streaming.jobs import start_contact_streams  # noqa: F401,E402
from clientlens.streaming.feeder import feed, numbered, run_feed  # noqa: F401,E402
from clientlens.streaming.state import (  # noqa: F401,E402
    open_windows, rocksdb_session, state_operators, state_rows,
)
from clientlens.streaming.upsert import (  # noqa: F401,E402
    compact_upserts, newest_per_key, upsert_writer, upserted,
)
