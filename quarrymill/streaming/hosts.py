"""State of hosts and keys along a stream of outcomes: one step function each, run as an ordered batch or as a stateful stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quarrymill.sources.ship import ship

#: A step takes the state (a tuple of numbers), the time in seconds and the row's value, and gives the new state and an output.
Step = Callable[[tuple, float, object], tuple[tuple, object]]


def circuit_step(failures: int = 3, cooldown: float = 300.0) -> Step:
    """State: failures in a row, time of opening (-1 closed). Value: whether it failed. Output: closed, open or half_open before the row.

    An open circuit lets one row through after the cooldown; if it fails, the circuit opens anew.
    """

    def step(state: tuple, t: float, failed: object) -> tuple[tuple, str]:
        n, opened = state or (0, -1.0)
        mode = "closed" if opened < 0 else "half_open" if t >= opened + cooldown else "open"
        if mode == "open":
            return (n, opened), mode
        if not failed:
            return (0, -1.0), mode
        n += 1
        return (n, t if n >= failures or mode == "half_open" else -1.0), mode

    return step


def suppression_step(most: int = 3, cooldown: float = 600.0) -> Step:
    """State: refusals in a row, end of the suppression. Value: refused, ok or other. Output: whether the row comes while suppressed."""

    def step(state: tuple, t: float, kind: object) -> tuple[tuple, str]:
        n, until = state or (0, -1.0)
        if t < until:
            return (n, until), "suppressed"
        n = n + 1 if kind == "refused" else 0 if kind == "ok" else n
        return ((0, t + cooldown) if n >= most else (n, -1.0)), "admitted"

    return step


def ewma_step(alpha: float = 0.3) -> Step:
    """State: the mean so far. Output: the mean with this value."""

    def step(state: tuple, t: float, value: object) -> tuple[tuple, float]:
        mean = float(value) if not state else (1 - alpha) * state[0] + alpha * float(value)
        return (mean,), mean

    return step


def seen_step(ttl: float = 3600.0) -> Step:
    """State: when the key was last seen; every sight counts anew. Output: new or seen."""

    def step(state: tuple, t: float, value: object) -> tuple[tuple, str]:
        return (t,), "seen" if state and t <= state[0] + ttl else "new"

    return step


def retry_step(attempts: int = 3) -> Step:
    """State: failures so far, 1 if done. Output: retry, completed, exhausted or closed."""

    def step(state: tuple, t: float, failed: object) -> tuple[tuple, str]:
        n, done = state or (0, 0)
        if done:
            return (n, 1), "closed"
        if not failed:
            return (n, 1), "completed"
        return (n + 1, int(n + 1 >= attempts)), "exhausted" if n + 1 >= attempts else "retry"

    return step


def budget_step(limit: float) -> Step:
    """State: what was spent. Value: the cost. Output: whether it fits; what doesn't is not spent."""

    def step(state: tuple, t: float, cost: object) -> tuple[tuple, str]:
        spent = state[0] if state else 0.0
        return ((spent + float(cost),), "admitted") if spent + float(cost) <= limit else ((spent,), "over_budget")

    return step


def ordered_fold(df: DataFrame, key: str, order: list[str], seconds: str, value: str, step: Step, ident: str, kind: str = "string") -> DataFrame:
    """Columns ident, key, state_out: the step over each key's rows in order.

    Rows are sorted inside the partitions of a key and read batch by batch with the state of the current key alone, so that no key's rows
    are held together.
    """
    ship(df.sparkSession)
    types = dict(df.dtypes)
    sorted_rows = df.select(ident, key, F.col(seconds).alias("_t"), F.col(value).alias("_v"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]).repartition(key).sortWithinPartitions(key, *[f"_o{i}" for i in range(len(order))]).select(ident, key, "_t", "_v")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, ()
        for pdf in batches:
            out = []
            for k, t, v in zip(pdf[key], pdf["_t"], pdf["_v"], strict=True):
                if k != current:
                    current, state = k, ()
                state, o = step(state, float(t), v)
                out.append(o)
            yield pd.DataFrame({ident: pdf[ident], key: pdf[key], "state_out": out})

    return sorted_rows.mapInPandas(run, f"{ident} {types[ident]}, {key} {types[key]}, state_out {kind}")


def stream_fold(stream: DataFrame, key: str, seconds: str, value: str, step: Step, ident: str, width: int, kind: str = "string", idle: str | None = None) -> DataFrame:
    """The same on a stream: the state of each key is ``width`` numbers; ``idle`` (as "2 hours") forgets keys without rows for so long.

    Rows of one micro-batch are taken in the order of time and id; late rows of a later batch are taken as they come.
    """
    ship(stream.sparkSession)
    types = dict(stream.dtypes)
    state_type = ", ".join(f"s{i} double" for i in range(width))
    millis = int(pd.Timedelta(idle).total_seconds() * 1000) if idle else 0

    def run(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = tuple(state.get) if state.exists else ()
        pdf = pd.concat(batches).sort_values(["_t", ident], kind="stable")
        out = []
        for t, v in zip(pdf["_t"], pdf["_v"], strict=True):
            now, o = step(now, float(t), v)
            out.append(o)
        state.update(tuple(float(x) for x in now))
        if millis:
            state.setTimeoutDuration(millis)
        yield pd.DataFrame({ident: pdf[ident], key: k[0], "state_out": out})

    rows = stream.select(ident, key, F.col(seconds).alias("_t"), F.col(value).alias("_v"))
    timeout = GroupStateTimeout.ProcessingTimeTimeout if millis else GroupStateTimeout.NoTimeout
    return rows.groupBy(key).applyInPandasWithState(run, f"{ident} {types[ident]}, {key} {types[key]}, state_out {kind}", state_type, "append", timeout)


def first_seen(stream: DataFrame, keys: list[str], time: str, within: str) -> DataFrame:
    """Rows whose keys were not seen within the watermark; state older than it is dropped."""
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, key: str, late: str, length: str) -> DataFrame:
    """Counts of each key in tumbling windows; rows later than ``late`` are left out, as the state is gone by then."""
    return stream.withWatermark(time, late).groupBy(F.window(time, length), key).agg(F.count("*").alias("n"))
