"""Streaming form of the daily refresh (incremental extract over new raw partitions)."""

from newsrisk.streaming.incremental import (
    read_incremental_extract,
    run_incremental_extract,
    start_incremental_extract,
)

__all__ = ["read_incremental_extract", "run_incremental_extract", "start_incremental_extract"]
