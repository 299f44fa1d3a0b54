from edupanel.sources.cache import TableCache
from edupanel.sources.geojson import read_geojson
from edupanel.sources.tables import (
    MissingColumnsError,
    MissingSourceError,
    list_raw,
    read_table,
    scan_table,
    write_csv,
    write_table,
)
from edupanel.sources.versions import Manifest, VersionConflictError, VersionedTable

__all__ = [
    "Manifest", "MissingColumnsError", "MissingSourceError", "TableCache", "VersionConflictError",
    "VersionedTable",
    "list_raw", "read_geojson", "read_table", "scan_table", "write_csv", "write_table",
]
