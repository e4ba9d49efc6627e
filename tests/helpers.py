from __future__ import annotations


def rows(df) -> list[tuple]:
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
