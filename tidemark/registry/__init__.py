"""Registered queries over the test tables, each beside the SQL that must give the same rows.

A module holds two dictionaries: ``QUERIES`` maps a name to a function of (spark, folder), and
``SQL`` maps the same name to a query for DuckDB. Names without SQL are fitted models; those in
``known_models`` have targets whose solution SQL knows.
"""

from __future__ import annotations

from tidemark.registry import courses, features, known_models, logs, models, relational, statistics, streams, words

MODULES = (logs, courses, relational, statistics, words, features, streams, models, known_models)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in module.SQL.items()}
