"""Structured Streaming entry points."""

from .backfill import backfill_stream, backfilled, trim_staging  # noqa: F401
from .jobs import (  # noqa: F401
    consume_once,
    console_summary,
    dedupe_stream,
    idle_sessions,
    lag_series,
    late_rows,
    live_rows,
    latest_state,
    materialize_stream,
    progress_lag,
    tumbling_metrics,
    window_metrics,
    window_rows,
)
from .latest import held_keys, latest_stream, latest_updates  # noqa: F401
from .sessions import compact_sessions, merge_slots, session_slots, session_stream, sessions_of, stored_sessions  # noqa: F401
from .totals import StreamTotals  # noqa: F401
from .windows import compact_windows, settle_windows, settled_windows, touched_rows, window_stream  # noqa: F401
