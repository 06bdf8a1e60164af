"""Registration of queries: a function of ``Inputs`` and, where SQL can express it, its checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from claimtree.queries.fixtures import Inputs


class Registry(dict):
    """Query name -> (run(spark, folder), checking SQL or None)."""

    def __init__(self, check: Callable[[str], str]):
        super().__init__()
        self._check = check

    def query(self, name: str, sql: str | None):
        def register(fn):
            self[name] = (lambda spark, folder: fn(Inputs(spark, folder)), self._check(sql) if sql else None)
            return fn

        return register
