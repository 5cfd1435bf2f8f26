"""Checks of pipeline specifications, all made before any Spark job."""

from __future__ import annotations

import json
from typing import Any


def expect(value: Any, kind: type | tuple[type, ...], what: str) -> Any:
    if not isinstance(value, kind) or (kind is int and isinstance(value, bool)):
        names = kind.__name__ if isinstance(kind, type) else " or ".join(k.__name__ for k in kind)
        raise TypeError(f"{what} must be of type {names}")
    return value


def expect_texts(values: Any, what: str) -> list[str]:
    expect(values, list, what)
    for value in values:
        expect(value, str, f"every element of {what}")
    return values


def required(spec: dict, field: str, kind: type | None = None) -> Any:
    if field not in spec:
        raise ValueError(f"the specification needs the field {field}")
    return spec[field] if kind is None else expect(spec[field], kind, field)


def required_column(spec: dict, field: str, columns: list[str], default: str | None = None) -> str:
    """Field naming a column that must exist."""
    name = required(spec, field) if default is None else spec.get(field, default)
    expect(name, str, field)
    existing(name, columns)
    return name


def existing(name: str, columns: list[str]) -> str:
    if name not in columns:
        raise KeyError(f"there is no column {name}")
    return name


def load_spec(source: dict | str) -> dict:
    """A specification as a dictionary or as the path of a JSON file on the driver."""
    if isinstance(source, dict):
        return source
    with open(source, encoding="utf-8") as file:
        return expect(json.load(file), dict, "the specification")
