from millrace.streaming.sink import export_stream
from millrace.streaming.source import read_stream

__all__ = ["export_stream", "read_stream"]
