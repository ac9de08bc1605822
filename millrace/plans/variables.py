"""Variables in job specs."""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

_VARIABLE = re.compile(r"\$\{([A-Za-z_][\w.]*)(:[^}]*)?\}")


def substitute(spec: Any, variables: Mapping[str, str], *, keep: frozenset[str] = frozenset()) -> Any:
    """Fill ``${name}`` and ``${name:default}`` in every text of a nested spec; ``${name:}`` defaults to empty text.
    A variable with neither value nor default raises. Names in ``keep`` are left for a later step."""
    if isinstance(spec, Mapping):
        return {key: substitute(value, variables, keep=keep) for key, value in spec.items()}
    if isinstance(spec, (list, tuple)):
        return [substitute(value, variables, keep=keep) for value in spec]
    if not isinstance(spec, str):
        return spec

    def fill(match: re.Match) -> str:
        name, default = match.group(1), match.group(2)
        if name in variables:
            return str(variables[name])
        if name in keep:
            return match.group(0)
        if default is None:
            raise KeyError(f"variable {name} has no value")
        return default[1:].strip('"')

    return _VARIABLE.sub(fill, spec)
