"""Writers: JSON extracts (plain, partitioned), materialized tables, backups."""

from strata.sinks.files import (  # noqa: F401
    backup_json_to_parquet, publish_view, save_table, write_json, write_parquet, write_partitioned_json,
    write_records_json,
)
