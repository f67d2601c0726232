"""Exact quantiles by selection: histograms narrow every wanted place down to one value.

A place is first known to lie between the least and the largest value. A pass
counts the values of every such interval in bins of equal width, and keeps the
least and the largest value of each bin; the bin that holds the place is the next
interval, whose ends are values of the data again. It is done when both ends are
equal. Nothing is sorted, no value is shuffled, and no more than bins times
wanted places ever leave the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 1024
COUNTS = "interval int, bin int, rows long, low double, high double"


def bins_of(values: np.ndarray, low: float, high: float, bins: int = BINS) -> np.ndarray:
    """The bin of every value of an interval; values that are not finite have bins of their own at the ends."""
    inside = np.isfinite(values)
    bin_ = np.where(values == -np.inf, -1, np.where(values == np.inf, bins, bins + 1))
    # Halves do not overflow.
    width = high / 2 - low / 2
    if width > 0:
        bin_[inside] = np.clip(((values[inside] / 2 - low / 2) / width * bins).astype(np.int64), 0, bins - 1)
    else:
        bin_[inside] = 0
    return bin_


def _counted(batches: Iterator[pa.RecordBatch], intervals: list[tuple[int, float, float]], bins: int) -> Iterator[pa.RecordBatch]:
    """Per interval (column, low, high) and bin of this task: rows, least and largest value."""
    rows = np.zeros((len(intervals), bins + 3), np.int64)
    low = np.full(rows.shape, np.inf)
    high = np.full(rows.shape, -np.inf)
    for batch in batches:
        for i, (column, start, end) in enumerate(intervals):
            values = batch.column(column).drop_null().to_numpy(zero_copy_only=False)
            first = start == -np.inf
            own = values if first else values[(values >= start) & (values <= end)]
            # Nothing is known at first: all finite values share a bin.
            place = 1 + (bins_of(own, 0.0, 0.0, bins) if first else bins_of(own, start, end, bins))
            rows[i] += np.bincount(place, minlength=bins + 3)
            np.minimum.at(low[i], place, own)
            np.maximum.at(high[i], place, own)
    interval, bin_ = np.nonzero(rows)
    columns = [
        pa.array(interval.astype(np.int32)),
        pa.array((bin_ - 1).astype(np.int32)),
        pa.array(rows[interval, bin_]),
        pa.array(low[interval, bin_]),
        pa.array(high[interval, bin_]),
    ]
    yield pa.RecordBatch.from_arrays(columns, names=["interval", "bin", "rows", "low", "high"])


def selected(df: DataFrame, columns: Sequence[str], places: dict[str, Sequence[int]], bins: int = BINS) -> dict[tuple[str, int], float]:
    """The values at ``places`` (0: the least) of every column, NULLs left out."""
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    # (column, place) -> rows before the interval, and its ends; without ends it holds all values.
    known = {(c, k): (0, -math.inf, math.inf) for c in columns for k in places.get(c, ())}
    found: dict[tuple[str, int], float] = {}
    while known:
        intervals = sorted({(columns.index(c), low, high) for (c, _), (_, low, high) in known.items()})
        counts = doubles.mapInArrow(lambda b, i=intervals: _counted(b, i, bins), COUNTS)
        merged = counts.groupBy("interval", "bin").agg(F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"))
        held: dict[int, list] = {}
        # At most bins + 3 rows per interval.
        for row in merged.collect():
            held.setdefault(row.interval, []).append(row)
        following = {}
        for (column, place), (before, low, high) in known.items():
            own = sorted(held[intervals.index((columns.index(column), low, high))], key=lambda r: r.bin)
            for row in own:
                if place < before + row.rows:
                    break
                before += row.rows
            if row.bin > bins:
                found[column, place] = math.nan
            elif row.low == row.high:
                found[column, place] = row.low
            else:
                following[column, place] = (before, row.low, row.high)
        known = following
    return found


def quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float], bins: int = BINS) -> DataFrame:
    """Exact quantiles with linear interpolation: (column, share, quantile); NaN counts as the largest value."""
    columns = list(columns)
    sizes = df.agg(*[F.count(c).alias(c) for c in columns]).first() if columns else {}
    at = {(c, s): (sizes[c] - 1) * float(s) for c in columns if sizes[c] for s in shares}
    places: dict[str, set[int]] = {}
    for (column, _), place in at.items():
        places.setdefault(column, set()).update((math.floor(place), math.ceil(place)))
    values = selected(df, columns, {c: sorted(p) for c, p in places.items()}, bins)
    rows = []
    for (column, share), place in at.items():
        low, high = values[column, math.floor(place)], values[column, math.ceil(place)]
        rows.append((column, float(share), low if low == high else low + (high - low) * (place - math.floor(place))))
    return df.sparkSession.createDataFrame(rows, "column string, share double, quantile double")
