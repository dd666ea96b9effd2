from sellthrough.streaming.ingest import ingest

__all__ = ["ingest"]
