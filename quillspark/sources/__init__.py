"""Readers and writers."""

from .readers import read_chat_export, read_published, read_qa_files, read_text_documents
from .store import ingest_directory, process_chunks
from .sinks import (append_new, insert_if_absent, publish, variant_export_lines, write_day_files,
                    write_variant_exports)

__all__ = ["read_chat_export", "read_published", "read_qa_files", "read_text_documents", "append_new",
           "insert_if_absent", "publish", "ingest_directory", "process_chunks", "variant_export_lines", "write_day_files", "write_variant_exports"]
