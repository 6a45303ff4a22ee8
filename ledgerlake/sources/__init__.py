from .raw import add_columns, backfill_nulls, read_raw, with_lineage
from .tables import append_table, create_if_absent, overwrite_table, publish, replace_empty

__all__ = ["add_columns", "backfill_nulls", "read_raw", "with_lineage",
           "append_table", "create_if_absent", "overwrite_table", "publish", "replace_empty"]
