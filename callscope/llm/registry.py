"""Queries of this package by name, and the SQL that gives the same rows."""

QUERIES = {}
SQL = {}


def register(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return add
