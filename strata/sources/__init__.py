"""Readers: Parquet/CSV/JSON scans, file inventory, literal records, and the songs projection over the driver's ``lineitem``."""

from strata.sources.files import (  # noqa: F401
    base_name, file_inventory, file_totals, preview, read_csv, read_json, read_parquet,
    read_partitioned_json, read_table, register_view, spread_rows,
)
from strata.sources.songs import songs_from_lineitem, load_songs  # noqa: F401
from strata.sources.literals import records_frame  # noqa: F401
