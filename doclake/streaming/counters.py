"""Rates of polled counters on a stream, with keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Per counter: time and tie of the last sample, its value, samples so far, highest rate so far.
STATE = "us bigint, tie bigint, value double, n bigint, peak double"
MIB = float(1 << 20)


def _rates(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(frames)).sort_values(["us", "tie"], kind="stable")
    before = state.get if state.exists else None
    if before is None:
        late = np.zeros(len(rows), bool)
    else:
        late = ((rows["us"] < before[0]) | ((rows["us"] == before[0]) & (rows["tie"] <= before[1]))).to_numpy()
    fresh = rows[~late]
    if len(fresh):
        us, value = fresh["us"].to_numpy(np.int64), fresh["value"].to_numpy(np.float64)
        n, peak = (0, np.nan) if before is None else (before[3], np.nan if before[4] is None else before[4])
        first_us, first_value = (us[0], value[0]) if before is None else (before[0], before[2])
        seconds = np.diff(us, prepend=first_us) / 1_000_000.0
        turn = n + 1 + np.arange(len(us))
        known = (turn > 2) & (seconds > 0)
        rate = np.where(known, np.diff(value, prepend=first_value) / MIB / np.where(seconds > 0, seconds, 1.0), np.nan)
        top = np.fmax.accumulate(np.concatenate([[peak], np.where(rate >= 0, rate, np.nan)]))[1:]
        last = None if np.isnan(top[-1]) else float(top[-1])
        state.update((int(us[-1]), int(fresh["tie"].iloc[-1]), float(value[-1]), int(turn[-1]), last))
        yield _out(key, fresh["tie"], rate, top, False)
    if late.any():
        none = np.full(int(late.sum()), np.nan)
        yield _out(key, rows["tie"][late], none, none, True)


def _out(key: tuple, tie: pd.Series, rate: np.ndarray, top: np.ndarray, late: bool) -> pd.DataFrame:
    def nullable(x: np.ndarray) -> list:
        return [None if np.isnan(v) else float(v) for v in x]

    return pd.DataFrame({
        "counter": [key[0]] * len(tie), "tie": tie.to_numpy(), "rate": pd.Series(nullable(rate), dtype=object),
        "max_rate": pd.Series(nullable(top), dtype=object), "late": late,
    })


def stream_counter_rate(samples: DataFrame, counter: str, ts: str, value: str, tie: str) -> DataFrame:
    """MiB per second between samples of cumulative counters, and the running maximum, as the samples arrive.

    One row per sample: the columns ``counter`` and ``tie`` by their own names, ``rate``, ``max_rate``, ``late``. As in the batch
    ``counter_rate``: null for the first two samples and when no time passed, and a counter that went back never raises
    the maximum. The state of a counter is one row. A batch is put in order by time and tie; a sample that is not behind
    the last one of earlier batches comes too late: it has no rate and changes nothing.
    """
    shaped = samples.select(
        F.col(counter).cast("string").alias("counter"), F.unix_micros(F.col(ts).cast("timestamp")).alias("us"),
        F.col(value).cast("double").alias("value"), F.col(tie).cast("long").alias("tie"),
    )
    rates = shaped.groupBy("counter").applyInPandasWithState(
        _rates, "counter string, tie bigint, rate double, max_rate double, late boolean", STATE, "append", GroupStateTimeout.NoTimeout
    )
    return rates.withColumnsRenamed({"counter": counter, "tie": tie})
