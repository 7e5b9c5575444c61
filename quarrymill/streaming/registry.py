"""A set of keys seen lately, with refresh, expiry and a capacity: over a table, and over a stream with state that survives a restart."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quarrymill.sources.ship import ship
from quarrymill.streaming.hosts import ordered_fold

#: Working columns; the stream gives names of its own to columns that begin with an underscore.
BUCKET, SECONDS = "registry_bucket", "registry_seconds"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def sight(seen: OrderedDict, at: float, key: str, capacity: int, ttl: float) -> str:
    """new or seen, after what has expired is gone. Every sight makes a key the newest; a new one takes the place of the oldest when all are taken."""
    while seen and next(iter(seen.values())) <= at - ttl:
        seen.popitem(last=False)
    known = key in seen
    if not known and len(seen) >= capacity:
        seen.popitem(last=False)
    seen[key] = at
    seen.move_to_end(key)
    return "seen" if known else "new"


def bucketed(df: DataFrame, key: str, time: str, ident: str, buckets: int) -> DataFrame:
    """Blank keys go; the others are trimmed and dealt to buckets by hash."""
    k = F.trim(F.col(key))
    return df.where((k != "") & F.col(time).isNotNull()).select(F.col(ident), F.col(time), k.alias(key), F.pmod(F.xxhash64(k), F.lit(buckets)).alias(BUCKET))


def registry(df: DataFrame, key: str, time: str, ident: str, capacity: int, ttl: float, buckets: int = 64) -> DataFrame:
    """Columns ident and state_out (new or seen), over a table in the order of time and id.

    A key is seen if it was met at most ``ttl`` seconds before and hasn't been pushed out. Each of ``buckets`` parts of the keys, by hash, holds
    ``capacity`` of them: that bounds the state of a task, and spreads any number of keys. Null and blank keys, and rows without a time, give no
    row; a repeated row is seen the second time.
    """
    rows = bucketed(df, key, time, ident, buckets).withColumn(SECONDS, F.unix_micros(time) / 1e6)

    def step(state: tuple | OrderedDict, at: float, value: object) -> tuple:
        seen = state or OrderedDict()
        return seen, sight(seen, at, str(value), capacity, ttl)

    return ordered_fold(rows, BUCKET, [time, ident], SECONDS, key, step, ident).drop(BUCKET)


class Registry(StatefulProcessor):
    """A bucket's keys as map state: when each was last met, and in which order. A timer drops what nothing refreshes any more."""

    def __init__(self, key: str, time: str, ident: str, capacity: int, ttl: float):
        self.key, self.time, self.ident, self.capacity, self.ttl = key, time, ident, capacity, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "k string", "at double, nth long")

    def _load(self) -> OrderedDict:
        held = sorted((v[1], k[0], v[0]) for k, v in self.seen.iterator())
        return OrderedDict((k, at) for _, k, at in held)

    def _store(self, before: dict, now: OrderedDict) -> None:
        """Only what has changed; the order is kept by times, and among equal ones by the place."""
        for k in before.keys() - now.keys():
            self.seen.removeKey((k,))
        for nth, (k, at) in enumerate(now.items()):
            self.seen.updateValue((k,), (at, nth))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        pdf = pd.concat(list(rows)).sort_values([self.time, self.ident], kind="stable")
        seen = self._load()
        before, out = dict(seen), []
        for at, k in zip(pdf[SECONDS], pdf[self.key], strict=True):
            out.append(sight(seen, float(at), k, self.capacity, self.ttl))
        self._store(before, seen)
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if seen:
            self.handle.registerTimer(int((max(seen.values()) + self.ttl) * 1000) + 1)
        yield pd.DataFrame({self.ident: pdf[self.ident], "state_out": out})

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """All keys of the bucket have expired: the timer stands behind the newest."""
        self.seen.clear()
        yield pd.DataFrame({self.ident: pd.Series([], dtype="int64"), "state_out": pd.Series([], dtype="object")})

    def close(self) -> None:
        pass


def stream_registry(stream: DataFrame, key: str, time: str, ident: str, capacity: int, ttl: float, late: str, buckets: int = 64) -> DataFrame:
    """As ``registry``, on a stream: rows more than ``late`` behind the newest are left out, those of a micro-batch taken in the order of time and id.

    Rows in order over micro-batches give what the table gives. The state is in the checkpoint of the query, so that a query that is
    stopped goes on where it was. Needs the RocksDB state store, which is set for the session. ``ident`` is a long.
    """
    ship(stream.sparkSession)
    stream.sparkSession.conf.set(STORE, ROCKS)
    rows = bucketed(stream, key, time, ident, buckets).withColumn(SECONDS, F.unix_micros(time) / 1e6).withWatermark(time, late)
    return rows.groupBy(BUCKET).transformWithStateInPandas(Registry(key, time, ident, capacity, ttl), f"{ident} long, state_out string", "append", "eventTime")
