"""Qualified table-name building."""

from __future__ import annotations

import re

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def qualified_name(*parts: str) -> str:
    """Join validated identifier parts with dots (``catalog.schema.table``)."""
    if not parts:
        raise ValueError("no name parts given")
    for p in parts:
        if not isinstance(p, str) or not _IDENT.match(p):
            raise ValueError(f"invalid identifier part: {p!r}")
    return ".".join(parts)
