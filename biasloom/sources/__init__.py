from biasloom.sources.store import Buckets, TableStore, load_or_build, shared_root, version
from biasloom.sources.tables import INPUTS, bind_items, bind_ratings, table
from biasloom.sources.text import read_items, read_ratings, split_ratings

__all__ = [
    "Buckets",
    "INPUTS",
    "TableStore",
    "bind_items",
    "bind_ratings",
    "load_or_build",
    "read_items",
    "read_ratings",
    "shared_root",
    "split_ratings",
    "table",
    "version",
]
