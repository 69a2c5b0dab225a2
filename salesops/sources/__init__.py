"""Readers, writers and the table catalog."""

from salesops.sources.catalog import (  # noqa: F401
    lost_in_catalog,
    lost_values,
    load_catalog,
    load_typed,
    open_set,
    open_tables,
    read_catalog,
    register_tables,
    run_sql,
    table_counts,
    typed,
)
from salesops.sources.files import (  # noqa: F401
    ORDINAL,
    bucket_number,
    discard,
    open_bucketed,
    publish,
    published,
    read_raw_csv,
    rebuild,
    staging_folder,
    write_bucketed,
    write_tables,
)
