"""What several test modules use."""

from __future__ import annotations


def rows(df):
    """Rows as plain tuples, sorted, NULLs last."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])
