"""Sources and sinks."""

from .files import (file_date, json_scan, latest_snapshot, newest_file, parse_json_column, parse_lines,  # noqa: F401
                    scan_delimited, scan_fixed_schema, stamp_of, string_schema, strip_control_records,
                    with_file_name)
from .sinks import export_delimited, provenance, publish, write_table  # noqa: F401
from .snapshots import read_pruned, read_snapshot, scan_pruned, snapshot_slice  # noqa: F401
