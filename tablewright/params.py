"""Typed job parameters with defaults, bound into SQL as named parameters.

Values are never spliced into SQL text: ``spark.sql(q, args=…)`` binds them,
so a parameter is a literal of its declared type.
"""

from __future__ import annotations

import datetime as _dt
import decimal as _dec
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

def _boolean(text: str) -> bool:
    value = text.strip().lower()
    if value in ("1", "true", "yes"):
        return True
    if value in ("0", "false", "no"):
        return False
    raise ValueError(f"not a boolean: {text!r}")


_PARSERS = {
    "string": str,
    "int": int,
    "bigint": int,
    "double": float,
    "decimal": _dec.Decimal,
    "boolean": lambda v: v if isinstance(v, bool) else _boolean(str(v)),
    "date": lambda v: v if isinstance(v, _dt.date) else _dt.date.fromisoformat(str(v)),
}


@dataclass(frozen=True)
class JobParam:
    name: str
    type: str = "string"
    default: Any = None
    label: str = ""

    def parse(self, value: Any) -> Any:
        if value is None:
            return self.default
        if self.type not in _PARSERS:
            raise ValueError(f"unsupported parameter type {self.type}")
        return _PARSERS[self.type](value)


def bind(params: list[JobParam], values: Mapping[str, Any] | None = None) -> dict[str, Any]:
    """Typed values for every parameter: given value, else its default."""
    values = dict(values or {})
    unknown = set(values) - {p.name for p in params}
    if unknown:
        raise ValueError(f"unknown job parameters: {sorted(unknown)}")
    return {p.name: p.parse(values.get(p.name)) for p in params}
