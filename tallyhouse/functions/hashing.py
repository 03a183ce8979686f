"""Content hash of a row."""

from __future__ import annotations

# How a missing cell and the separator are written before hashing.
MISSING = "nan"
SEPARATOR = "|"


def row_hash(columns: list[str]) -> str:
    """md5 of the row's values joined by a bar, as SQL text.

    ``concat_ws`` skips NULLs, which would let ``(NULL, x)`` and ``(x, NULL)`` collide, so a
    missing cell is spelled out first.
    """
    cells = ", ".join(f"coalesce(cast(`{name}` as string), '{MISSING}')" for name in columns)
    return f"md5(concat_ws('{SEPARATOR}', {cells}))"
