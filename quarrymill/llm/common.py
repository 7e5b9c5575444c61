"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.operators.lineage import shared_folder
from quarrymill.sources.ship import ship
from quarrymill.sources.tables import table  # noqa: F401

#: White space of the contracts: space and the control characters 0x09 to 0x0D.
SPACES = b" \t\n\x0b\x0c\r"
#: Rows without an id sort after all others.
LAST_ID = 2**63 - 1
#: Rows that a step gets at once.
SLICE = 512


def cut(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder that the session names."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def packed(df: DataFrame, **keys) -> DataFrame:
    """The whole row as column ``row`` beside the named working columns, so that no input column clashes with them."""
    columns = [df[f"`{c}`"] for c in df.columns]
    return df.select(F.struct(*columns).alias("row"), *[c.alias(k) for k, c in keys.items()])


def unpacked(df: DataFrame, columns: list[str], **new) -> DataFrame:
    """The columns of ``row`` and the new ones; a new one takes the place of an input column of its name."""
    kept = [F.col("row").getField(c).alias(c) if c not in new else new[c].alias(c) for c in columns]
    return df.select(*kept, *[v.alias(k) for k, v in new.items() if k not in columns])


def map_batches(df: DataFrame, schema: str, start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """``start()`` runs once a task and returns what maps one Arrow batch to another; it gets SLICE rows at once, so that a task holds
    little besides the batch that Spark has sent."""

    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                yield step(batch.slice(at, SLICE))

    return df.mapInArrow(run, schema)
