"""Where rows come from and go to."""

from tallyframe.sources.control import CursorStore
from tallyframe.sources.delimited import parse_delimited, read_seed, write_seed
from tallyframe.sources.landed import as_text_columns, keyset_page, land, rows_after, scan_landed
from tallyframe.sources.shared import settle, shared_path
from tallyframe.sources.versioned import VersionedTable

__all__ = [
    "CursorStore", "VersionedTable", "as_text_columns", "keyset_page", "land", "parse_delimited", "read_seed",
    "rows_after", "scan_landed", "settle", "shared_path", "write_seed",
]
