"""All registered queries and their SQL."""

from __future__ import annotations

from speechlake.plans import audits, files, operations, repeats, results, signal, speech, streams

MODULES = (speech, repeats, audits, operations, signal, files, streams, results)


def queries():
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracles():
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
