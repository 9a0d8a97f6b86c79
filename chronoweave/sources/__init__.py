from chronoweave.sources.tables import read_table, TABLES
from chronoweave.sources import panels

__all__ = ["read_table", "TABLES", "panels"]
