"""Keep lakehouse tables in step with a changing relational source, on Spark.

The package is a set of DataFrame operators (extract, conform, latest-per-key,
merge, evolve, as-of) plus the few side effects that publish their results into
catalog tables.  See README.md for the layout.
"""

from tidemark.model import TRANSAKSI, USERS, ChangeTable
from tidemark.tables import LakeTable, create_table, open_table

__all__ = ["ChangeTable", "LakeTable", "TRANSAKSI", "USERS", "create_table", "open_table"]
