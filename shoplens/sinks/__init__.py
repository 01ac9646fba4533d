"""Where results go: catalog tables, JDBC, folders of micro-batches."""

from shoplens.sinks.batches import read_batches, write_batch  # noqa: F401
from shoplens.sinks.tables import append_jdbc, preview, replace_table, replace_version  # noqa: F401
