"""JSON in one form for equal contents."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(value: Column) -> Column:
    """Of a column of JSON: keys in order at every depth, no space, characters as they are; null for null and for what is no JSON.

    Numbers are written as Python writes them; of repeated keys the last one counts. Texts go to Python in batches by Arrow.
    """

    def canonical(text: object) -> str | None:
        try:
            return json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False) if isinstance(text, str) else None
        except (ValueError, RecursionError):
            return None

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([canonical(x) for x in texts], dtype=object)

    return run(value)


def fingerprint(value: Column) -> Column:
    """SHA-256 of the canonical form."""
    return F.sha2(canonical_json(value), 256)
