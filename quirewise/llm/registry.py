"""All queries of this subpackage."""

from __future__ import annotations

from quirewise.llm import queries_documents, queries_pages

MODULES = [queries_pages, queries_documents]
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in module.SQL.items()}
