"""Readers and writers."""

from tidewater.sources.evolution import SchemaConflict, evolve_table, read_evolved, reconcile, refresh_table
from tidewater.sources.exports import PathPart, read_exports, read_target, write_targets
from tidewater.sources.paths import children, files_below, stored_partitions
from tidewater.sources.readers import (file_prefixes, literal_table, read_partitions, read_table, typed_ingest,
                                       with_path_columns)
from tidewater.sources.sinks import audit_row, high_water_mark, write_audited, write_table
from tidewater.sources.snapshots import Outdated, current_version, discard_unpublished, publish, read_version

__all__ = ["Outdated", "PathPart", "SchemaConflict", "audit_row", "children", "current_version", "discard_unpublished", "evolve_table",
           "file_prefixes", "files_below", "high_water_mark", "literal_table", "publish", "read_evolved", "read_exports", "read_partitions",
           "read_table", "read_target", "read_version", "reconcile", "refresh_table", "stored_partitions", "typed_ingest",
           "with_path_columns", "write_audited", "write_table", "write_targets"]
