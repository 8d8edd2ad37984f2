"""Readers for the text inputs and the Parquet tables."""

from tracelake.sources.cells import parse_cells, read_cells, read_cells_csv  # noqa: F401
from tracelake.sources.lines import first_line, marked_lines, read_lines  # noqa: F401
from tracelake.sources.logs import parse_logs, read_logs, with_day  # noqa: F401
from tracelake.sources.places import read_headed_csv, read_places  # noqa: F401
from tracelake.sources.shared import fresh_path, shared_folder  # noqa: F401
from tracelake.sources.tables import (  # noqa: F401
    drop_old_versions,
    key_range,
    published,
    read_table,
    replace_table,
    table_folder,
    write_table,
)
