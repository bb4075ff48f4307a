"""Readers: lake tables, message streams, relational snapshots."""

from tidewater.sources.jdbc import conform_types, read_incremental, read_snapshot
from tidewater.sources.lake import read_table
from tidewater.sources.stream import read_file_stream, read_messages

__all__ = ["conform_types", "read_incremental", "read_snapshot", "read_table",
           "read_file_stream", "read_messages"]
