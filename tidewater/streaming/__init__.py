"""Structured Streaming forms of ingest, Silver and sessions; exactly-once batches and supervision."""

from tidewater.streaming.exact import sessions_work, silver_work, start_exact, update_sessions
from tidewater.streaming.ingest import await_all, bronze_stream, start_append
from tidewater.streaming.silver import silver_streams, stream_sessions
from tidewater.streaming.supervise import RowsDropped, run_supervised

__all__ = ["RowsDropped", "await_all", "bronze_stream", "run_supervised", "sessions_work", "silver_streams",
           "silver_work", "start_append", "start_exact", "stream_sessions", "update_sessions"]
