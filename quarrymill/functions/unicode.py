"""What Spark has no function for: compatibility normalisation and case folding, on Arrow batches. Plain ASCII texts pass through."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from quarrymill.sources.ship import ship


def nfkc_text(text: str | None) -> str | None:
    return text if text is None or text.isascii() else unicodedata.normalize("NFKC", text)


def casefold_text(text: str | None) -> str | None:
    return text if text is None else text.lower() if text.isascii() else text.casefold()


def nfkc(text: Column) -> Column:
    ship(SparkSession.active())

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(nfkc_text, na_action="ignore")

    return run(text)


def casefold(text: Column) -> Column:
    ship(SparkSession.active())

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(casefold_text, na_action="ignore")

    return run(text)


def value_digest(value: Column) -> Column:
    """SHA-256 of the value in compatibility form, case-folded and trimmed, so that findings can be compared but not read."""

    ship(SparkSession.active())

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: nfkc_text(v).casefold().strip(), na_action="ignore")

    return F.sha2(run(value), 256)
