"""Documents to overlapping windows of tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.functions.text import space_tokens


def chunk_documents(df: DataFrame, ident: str, text: str, window: int = 768, overlap: int = 96) -> DataFrame:
    """One row a chunk: ident, paragraph, chunk (both from 0), n_tokens, chunk_text. A chunk never crosses a paragraph, and the
    last one of a paragraph ends with it."""
    window, step = max(32, window), max(1, max(32, window) - overlap)
    paragraphs = df.select(ident, F.posexplode(F.split(F.coalesce(text, F.lit("")), r"\n[ \t\n\r\x0b\x0c]*\n")).alias("paragraph", "_p"))
    worded = paragraphs.select(ident, "paragraph", space_tokens(F.col("_p")).alias("_w")).where(F.size("_w") > 0)
    last = F.greatest(F.lit(0), F.ceil((F.size("_w") - window) / step)).cast("int")
    cut = worded.select(ident, "paragraph", F.posexplode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("_w", i * step + 1, window))).alias("chunk", "_c"))
    return cut.select(ident, F.col("paragraph").cast("long").alias("paragraph"), F.col("chunk").cast("long").alias("chunk"), F.size("_c").cast("long").alias("n_tokens"), F.array_join("_c", " ").alias("chunk_text"))
