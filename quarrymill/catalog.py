"""All queries outside the llm subpackage, by name, and their SQL."""

from __future__ import annotations

from quarrymill.plans import curation, hosts, markup, privacy, records, relations, release, sampling, selection, texts, web, wording

PLANS = (texts, privacy, web, relations, hosts, curation, selection, records, wording, markup, sampling, release)
QUERIES = {name: f for plan in PLANS for name, f in plan.QUERIES.items()}
ORACLE_SQL = {name: sql for plan in PLANS for name, sql in plan.ORACLE_SQL.items()}
