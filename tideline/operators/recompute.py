"""Trailing statistics of ordered groups again, without window frames.

Rows are dealt out by group and sorted; each task reads its groups as one stream and
keeps the last rows and sums of the group that is open, so no group is ever held
whole.  The state of the last 2^j rows (count, mean, squares around the mean, least)
is merged from two states of half as many; a span of k rows is put together from the
powers of two in k.  The work is linear in the rows, whatever their groups' sizes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Spans:
    """For each row of an ordered stream, the state of a span of rows that ends there."""

    n: np.ndarray
    mean: np.ndarray
    squares: np.ndarray
    least: np.ndarray

    @classmethod
    def single(cls, v: np.ndarray) -> Spans:
        known = ~np.isnan(v)
        return cls(known.astype(float), np.where(known, v, 0.0), np.zeros(len(v)), np.where(known, v, np.inf))

    def before(self, rows: int, inside: np.ndarray) -> Spans:
        """The states that end so many rows earlier, empty where that is not ``inside`` the group."""
        empty = (0.0, 0.0, 0.0, np.inf)
        moved = [np.concatenate([np.full(min(rows, len(x)), e), x[: max(len(x) - rows, 0)]]) for x, e in zip((self.n, self.mean, self.squares, self.least), empty)]
        return Spans(*[np.where(inside, x, e) for x, e in zip(moved, empty)])

    def merged(self, other: Spans) -> Spans:
        n = self.n + other.n
        share = np.divide(other.n, n, out=np.zeros(len(n)), where=n > 0)
        away = other.mean - self.mean
        mean = np.where(self.n > 0, np.where(other.n > 0, self.mean + away * share, self.mean), other.mean)
        squares = self.squares + other.squares + np.where((self.n > 0) & (other.n > 0), away * away * self.n * share, 0.0)
        return Spans(n, mean, squares, np.minimum(self.least, other.least))


def trailing(v: np.ndarray, place: np.ndarray, k: int) -> Spans:
    """The states of the last ``k`` rows, the own one included; ``place`` is each row's place in its group from 0."""
    power, size, found, done = Spans.single(v), 1, None, 0
    while size <= k:
        if k & size:
            part = power.before(done, place >= done)
            found, done = (part if found is None else found.merged(part)), done + size
        power, size = power.merged(power.before(size, place >= size)), 2 * size
    return found


def wrong_history(rows: DataFrame, by: list[str], number: str, value: str, name: str, windows: tuple[int, ...], tolerance: float) -> int:
    """How many rows have a feature of their past that differs from the one recomputed here:
    previous value, difference, trailing mean, least and sample deviation of ``windows``,
    distance from the trailing mean of 5, and expanding mean, where ``rows`` have them.

    Nulls count as unknown and take their place in a span.  An empty table has none wrong.
    """
    names = [c for c in rows.columns if c.startswith(f"{name}_")]
    longest = max([*windows, 5])

    def wrong(v: np.ndarray, new: np.ndarray, base: tuple[float, float], told: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Whether each row is wrong, and the (sum, count) of its group up to it; ``base`` is
        what the first row's group had before these rows."""
        at = np.arange(len(v))
        start = np.maximum.accumulate(np.where(new, at, 0))
        place = at - start
        known = ~np.isnan(v)
        sums, counts = np.cumsum(np.where(known, v, 0.0)), np.cumsum(known).astype(float)
        own = lambda c, x: c - np.where(start > 0, c[np.maximum(start - 1, 0)], 0.0) + np.where(start == 0, x, 0.0)
        total, count = own(sums, base[0]), own(counts, base[1])
        mean_of = lambda s: np.where(s.n > 0, s.mean, np.nan)
        previous = np.where(place >= 1, np.r_[np.nan, v[:-1]], np.nan)
        again = {f"{name}_prev_1": previous, f"{name}_delta_1": v - previous, f"{name}_expanding_mean": np.divide(total, count, out=np.full(len(v), np.nan), where=count > 0)}
        for k in {*windows, 5}:
            s = trailing(v, place, k)
            deviation = np.sqrt(np.divide(s.squares, s.n - 1, out=np.full(len(v), np.nan), where=s.n > 1))
            again |= {f"{name}_roll_mean_{k}": mean_of(s), f"{name}_roll_min_{k}": np.where(s.n > 0, s.least, np.nan), f"{name}_roll_std_{k}": deviation, f"{name}_vs_roll_mean_{k}": v - mean_of(s)}
        bad = np.zeros(len(v), bool)
        for c, x in told.items():
            if c in again:
                y = again[c]
                bad |= (np.isnan(x) != np.isnan(y)) | (np.abs(x - y) > tolerance * np.maximum(1.0, np.abs(y)))
        return bad, np.column_stack([total, count])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, group, held, base = 0, None, np.zeros(0), (0.0, 0.0)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch["key"].to_numpy()
            column = lambda c: batch[c].to_numpy(zero_copy_only=False).astype(float)
            goes_on = group is not None and key[0] == group
            kept = len(held) if goes_on else 0
            v = np.r_[held[:kept], column("v")]
            new = np.r_[np.zeros(kept, bool), not kept, key[1:] != key[:-1]]
            told = {c: np.r_[np.full(kept, np.nan), column(f"f{i}")] for i, c in enumerate(names)}
            bad, state = wrong(v, new, base if kept else (0.0, 0.0), told)
            n += int(bad[kept:].sum())
            first = int(np.flatnonzero(new)[-1]) if new.any() else 0
            keep = min(longest, len(v) - first)
            group, held = key[-1], v[len(v) - keep :]
            known = ~np.isnan(held)
            base = (state[-1, 0] - np.where(known, held, 0.0).sum(), state[-1, 1] - known.sum())
        yield pa.RecordBatch.from_arrays([pa.array([n])], ["n"])

    cells = [F.xxhash64(*by).alias("key"), F.col(number).alias("_number"), F.col(value).cast("double").alias("v"), *[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(names)]]
    ordered = rows.select(*cells).repartition("key").sortWithinPartitions("key", "_number").drop("_number")
    return ordered.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
