"""Query plans over the driver's tables, and their DuckDB oracle SQL."""

from __future__ import annotations


def all_queries():
    from corpusloom.plans import corpus, dialogue, extras, io

    q = {}
    for mod in (corpus, dialogue, extras, io):
        q.update(mod.QUERIES)
    return q


def all_oracles():
    from corpusloom.plans import corpus, dialogue, extras, io

    o = {}
    for mod in (corpus, dialogue, extras, io):
        o.update(mod.ORACLE)
    return o
