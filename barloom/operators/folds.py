"""Walks along a series whose state can't be composed: one pass over its bars in order of time, in parallel over series.

A walk is a function step(rows, state) -> (columns, state): rows of one series in order, what it knew before (None at the
start) and what it knows after, as something that JSON can hold. So a series may be walked at once, or a slice of time after another.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.sources.workspace import new_folder

Step = Callable[[pd.DataFrame, object], tuple[dict[str, list], object]]
_KINDS = {"double": T.DoubleType(), "long": T.LongType(), "int": T.IntegerType(), "arrays": T.ArrayType(T.DoubleType())}

_cuts: ContextVar[tuple[int, ...]] = ContextVar("cuts", default=())


@contextmanager
def sliced(cuts: Iterable[int]) -> Iterator[None]:
    """Walks that are made inside of this block go slice by slice, cut at these times."""
    token = _cuts.set(tuple(cuts))
    try:
        yield
    finally:
        _cuts.reset(token)


def fold(bars: DataFrame, keys: Iterable[str], step: Step, adds: dict[str, str], cuts: Iterable[int] | None = None) -> DataFrame:
    """bars with the columns `adds` (name -> type) that the walk gives.

    Without cuts, here or by sliced(), a series is one group. With cuts, which are times in ascending order, all series are walked up to the first of them, then on to
    the next, and so on: no group has more bars than a slice, and between slices each series leaves a row of state. Slices are
    stored, so a lost executor repeats its tasks of one slice only.
    """
    keys = list(keys)
    schema = T.StructType([*bars.schema.fields, *[T.StructField(n, _KINDS[k]) for n, k in adds.items()]])

    def walked(rows: pd.DataFrame, state: object) -> tuple[pd.DataFrame, object]:
        rows = rows.sort_values("time", kind="stable").reset_index(drop=True)
        columns, state = step(rows, state)
        return rows.assign(**{n: pd.Series(columns[n], dtype=None if k in ("long", "int") else object) for n, k in adds.items()})[schema.names], state

    cuts = list(_cuts.get() if cuts is None else cuts)
    if not cuts:
        return bars.groupBy(*keys).applyInPandas(lambda rows: walked(rows, None)[0], schema)
    if sorted(set(cuts)) != cuts:
        raise ValueError("cuts must ascend")
    spark = bars.sparkSession
    stored = T.StructType([*[T.StructField(f.name, f.dataType) for f in schema], T.StructField("__state", T.StringType())])
    known = T.StructType([*[bars.schema[k] for k in keys], T.StructField("__state", T.StringType())])
    state, parts = spark.createDataFrame([], known), []

    def run(rows: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:  # nothing in this slice: what is known is handed on, in a row without a time
            return before.reindex(columns=stored.names).astype(object).where(lambda x: x.notna(), None)
        out, after = walked(rows, json.loads(before["__state"].iloc[0]) if len(before) else None)
        out["__state"] = pd.Series([None] * (len(out) - 1) + [json.dumps(after)], dtype=object)
        return out

    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = bars
        if low is not None:
            part = part.where(F.col("time") >= low)
        if high is not None:
            part = part.where(F.col("time") < high)
        path = new_folder(spark, "walk")
        part.groupBy(*keys).cogroup(state.groupBy(*keys)).applyInPandas(run, stored).write.parquet(path)
        done = spark.read.schema(stored).parquet(path)
        parts.append(done.where("time IS NOT NULL").drop("__state"))
        state = done.where("__state IS NOT NULL").select(*keys, "__state")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def ema_of(values: list[float | None], n: int) -> list[float | None]:
    """alpha = 2 / (n + 1) from the mean of the first n values on; a missing value holds the last one."""
    out: list[float | None] = []
    seed: list[float] = []
    level = None
    for v in values:
        if v is None or v != v:
            out.append(level)
            continue
        if level is None:
            seed.append(v)
            level = sum(seed) / n if len(seed) == n else None
        else:
            level += 2 / (n + 1) * (v - level)
        out.append(level)
    return out


def rsi_of(closes: list[float], n: int) -> list[float | None]:
    """Mean gains and losses smoothed by 1 / n from the mean of the first n changes on; 50 if flat, 100 without losses."""
    out: list[float | None] = [None] * min(len(closes), n)
    gain = loss = 0.0
    for i in range(1, len(closes)):
        up, down = max(closes[i] - closes[i - 1], 0.0), max(closes[i - 1] - closes[i], 0.0)
        if i <= n:
            gain, loss = gain + up / n, loss + down / n
        else:
            gain, loss = (gain * (n - 1) + up) / n, (loss * (n - 1) + down) / n
        if i >= n:
            out.append(50.0 if gain == loss == 0 else 100.0 if loss == 0 else 100 - 100 / (1 + gain / loss))
    return out
