"""Queries registered for the driver, each with SQL that checks it where SQL can express it."""

from __future__ import annotations


def all_queries() -> dict:
    from claimtree.queries import claims, hierarchy, lab

    return {**claims.QUERIES, **lab.QUERIES, **hierarchy.QUERIES}
