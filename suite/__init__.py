"""Registered queries: every operator run on the given tables, with SQL to compare against."""

from suite import codebooks, columns, joins, marts, profiles, regressions, reshapes, schemas, series, sources

MODULES = (columns, sources, schemas, reshapes, joins, profiles, series, regressions, codebooks, marts)


def registered() -> dict:
    """name -> (callable, sql or None)."""
    found = {}
    for module in MODULES:
        for name, entry in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query registered twice: {name}")
            found[name] = entry
    return found
