"""Run parameters with the reference's precedence: a value passed with the
call, else an environment variable, else the default.  Resolved on the
driver before any plan is built (they are plan constants, not data)."""

from __future__ import annotations

import json
import os
from typing import Any


# Values given with this run (``--vars`` of the command line).
GIVEN: dict[str, Any] = {}


def var(name: str, default: Any = None, call_vars: dict | None = None, env_name: str | None = None) -> Any:
    """``var('days_back', 30)``: call value -> ``$DAYS_BACK`` -> default.

    Environment values are parsed as JSON when possible (``'30'`` -> 30,
    ``'false'`` -> False, ``'[1,2]'`` -> [1, 2]) and kept as text otherwise.
    """
    for given in (call_vars, GIVEN):
        if given and name in given:
            return given[name]
    raw = os.environ.get(env_name or name.upper())
    if raw is None:
        return default
    try:
        return json.loads(raw)
    except ValueError:
        return raw
