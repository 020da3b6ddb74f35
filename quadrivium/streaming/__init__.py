"""File-stream form of the incremental feedback ingest."""
