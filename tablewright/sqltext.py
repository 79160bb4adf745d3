"""Quoting for the few names and literals that jobs put into SQL text.

Values from callers go in as bound parameters (``params.py``); only
identifiers, paths and table options are spliced, always through these.
"""

from __future__ import annotations


def ident(name: str) -> str:
    """A back-quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def string(value: object) -> str:
    """A single-quoted SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
