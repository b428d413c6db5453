"""Readers, writers and the catalog."""

from lakesteps.sources.catalog import Catalog  # noqa: F401
from lakesteps.sources.csv_blocks import read_csv_blocks, split_records  # noqa: F401
from lakesteps.sources.day_tables import patch_wide, read_days, refresh_days, stored_days  # noqa: F401
from lakesteps.sources.readers import (  # noqa: F401
    path_exists, read_delimited, read_inferred_csv, read_partition, read_typed_csv, union_feeds,
)
from lakesteps.sources.writers import (  # noqa: F401
    append, export_csv, load_mark, replace, save_mark, write_sorted,
)
