"""All queries of the core."""

from __future__ import annotations

from quirewise.plans import composition, contracts, corpus, detections, equations, evidence, extraction, incremental, layout, pagelayout, records, transcript

MODULES = [composition, contracts, corpus, detections, equations, evidence, extraction, incremental, layout, pagelayout, records, transcript]
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in module.SQL.items()}
