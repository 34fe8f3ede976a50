"""How often a stream runs."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter


def triggered(writer: DataStreamWriter, trigger: str = "availableNow", interval: str = "1 minute") -> DataStreamWriter:
    """``availableNow``: drain what is there, then stop (the triggered mode);
    ``processingTime``: every ``interval`` until stopped (continuous)."""
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "processingTime":
        return writer.trigger(processingTime=interval)
    raise ValueError(f"unknown trigger {trigger!r}")
