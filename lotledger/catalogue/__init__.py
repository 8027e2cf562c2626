"""Registered queries, each with the SQL that gives the same rows where SQL can."""

from lotledger.catalogue import claims, collect, features, models, pages, relational, stats, tables

_GROUPS = [tables, claims, relational, stats, features, models, pages, collect]

QUERIES = {name: run for group in _GROUPS for name, run in group.QUERIES.items()}
ORACLES = {name: sql for group in _GROUPS for name, sql in group.ORACLES.items()}
