"""File-stream variant of the incremental ingest."""
