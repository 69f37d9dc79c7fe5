from lamina.streaming.entries import drain_to_table, entry_stream
from lamina.streaming.gate import run_gate
from lamina.streaming.landing import land_archives_stream, stream_to_table, upsert_stream

__all__ = ["drain_to_table", "entry_stream", "land_archives_stream", "run_gate", "stream_to_table", "upsert_stream"]
