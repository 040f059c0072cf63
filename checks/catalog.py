"""All queries of this folder."""

from __future__ import annotations

from checks import files, models, prices, scores, texts

MODULES = (scores, prices, texts, models, files)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in module.SQL.items()}
