"""Checks on keyword options: required, exclusive, bundled, conditional and single-choice."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any


def _given(options: Mapping[str, Any], name: str) -> bool:
    value = options.get(name)
    return value is not None and value != "" and value != [] and value != {}


def require(options: Mapping[str, Any], *names: str) -> None:
    """Every named option must be given."""
    missing = [name for name in names if not _given(options, name)]
    if missing:
        raise ValueError(f"required options are missing: {missing}")


def exactly_one(options: Mapping[str, Any], *names: str) -> str:
    """One and only one of the named options must be given; its name is returned."""
    given = [name for name in names if _given(options, name)]
    if len(given) != 1:
        raise ValueError(f"set exactly one of {list(names)}, got {given}")
    return given[0]


def bundled(options: Mapping[str, Any], *names: str) -> None:
    """All of the named options are given, or none."""
    given = [name for name in names if _given(options, name)]
    if given and len(given) != len(names):
        raise ValueError(f"options {list(names)} belong together, got only {given}")


def conditional(options: Mapping[str, Any], when: str, equals: Any, *names: str) -> None:
    """The named options are required when option ``when`` has the value ``equals``."""
    if options.get(when) == equals:
        require(options, *names)


def single_choice(options: Mapping[str, Any], name: str, choices: Iterable[Any]) -> Any:
    """The option, if given, is one of the choices."""
    value = options.get(name)
    allowed = list(choices)
    if value is not None and value not in allowed:
        raise ValueError(f"option {name}={value!r} is not one of {allowed}")
    return value
