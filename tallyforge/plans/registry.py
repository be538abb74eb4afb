"""A list of queries, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable


class Queries:
    def __init__(self) -> None:
        self.run: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        def add(f):
            self.run[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return add

    def queries(self) -> dict[str, Callable]:
        return dict(self.run)

    def oracle_sql(self) -> dict[str, str]:
        return dict(self.sql)
