from millrace.operators.counts import counted, inventory_summary
from millrace.operators.export import Sender, export, export_routed, render, render_json, send
from millrace.operators.jobs import (
    file_exporter,
    file_reader,
    routed_sender,
    s3_exporter,
    s3_reader,
)

__all__ = [
    "Sender",
    "counted",
    "export",
    "export_routed",
    "file_exporter",
    "file_reader",
    "inventory_summary",
    "render",
    "render_json",
    "routed_sender",
    "s3_exporter",
    "s3_reader",
    "send",
]
