"""All registered queries: name -> (query, check SQL or None)."""

from __future__ import annotations

from functools import cache

from contract import etl, operators, reports


@cache
def registered() -> dict:
    found: dict = {}
    for module in (reports, operators, etl):
        for name, entry in module.queries().items():
            if name in found:
                raise ValueError(f"query {name} registered twice")
            found[name] = entry
    return found
