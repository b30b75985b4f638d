"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from functools import wraps

from ledgerloom.llm import decontam, dialogue, langid, mixing, nearest, neardup, quality, secrets, sharding, store, tokens, toxicity, warc, whitening

_MODULES = (langid, warc, tokens, quality, neardup, decontam, nearest, toxicity, secrets, mixing, dialogue, sharding, whitening)


def _ready(query):
    @wraps(query)
    def run(spark, sf_dir):
        store.on_workers(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict:
    return {name: _ready(q) for m in _MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLE_SQL.items()}
