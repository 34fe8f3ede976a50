"""Structured Streaming: bronze ingest, silver cleansing, gold refresh."""

from strata.streaming.layers import (  # noqa: F401
    bronze_stream, refresh_gold, run_medallion, silver_stream, start_append,
    stream_decade_gold, ExpectationMonitor,
)
from strata.streaming.incremental import stream_artist_gold  # noqa: F401
