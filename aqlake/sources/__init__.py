"""Where rows come from: register files, document files, declared schemas."""

from aqlake.sources.documents import file_inventory, read_document_files, stage_documents
from aqlake.feeds import POLLUTION, WEATHER, Feed
from aqlake.sources.register import coordinate_pairs, peek_lines, read_register

__all__ = [
    "POLLUTION",
    "WEATHER",
    "Feed",
    "coordinate_pairs",
    "file_inventory",
    "peek_lines",
    "read_document_files",
    "read_register",
    "stage_documents",
]
