from .incremental import incremental_ingest, read_ingested

__all__ = ["incremental_ingest", "read_ingested"]
