"""A feature encoder that learns from the counted values of training rows and applies
as plain column expressions."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.statistics import MISSING, Summary, category, prepared, summaries, value_counts

__all__ = ["MISSING", "Encoder", "category", "fit", "learned", "prepared"]


@dataclass
class Encoder:
    """Learned parameters; ``fill``, ``mean`` and ``scale`` by column, ``levels`` by category column."""

    numeric: list[str]
    categorical: list[str]
    fill: dict[str, float | None] = field(default_factory=dict)
    indicators: list[str] = field(default_factory=list)
    mean: dict[str, float] = field(default_factory=dict)
    scale: dict[str, float] = field(default_factory=dict)
    levels: dict[str, list[str]] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        """Names of the encoded columns, in order."""
        return [*self.dense, *self.level_names]

    @property
    def dense(self) -> list[str]:
        """Names of the encoded columns that are not levels of a category."""
        return [*self.numeric, *[f"missingindicator_{c}" for c in self.indicators]]

    @cached_property
    def level_names(self) -> dict[str, tuple[str, str]]:
        """The (column, level) behind each one-hot name, in order."""
        return {f"{c}_{v}": (c, v) for c in self.categorical for v in self.levels[c]}

    def column(self, name: str) -> Column:
        """An encoded column as an expression over the raw columns."""
        if name.startswith("missingindicator_") and name not in self.numeric:
            raw = prepared(name.removeprefix("missingindicator_")).isNull().cast("double")
        elif name in self.numeric:
            raw = F.coalesce(prepared(name), F.lit(self.fill[name]).cast("double"))
        else:
            c, v = self.level_names[name]
            return F.when(category(c) == v, 1.0).otherwise(0.0)
        return (raw - self.mean[name]) / self.scale[name] if name in self.mean else raw

    def apply(self, rows: DataFrame, *keep: Column | str) -> DataFrame:
        """The encoded columns, after those to ``keep``; unseen categories are all zeros."""
        return rows.select(*keep, *[self.column(n).alias(n) for n in self.names])

    def compact(self, rows: DataFrame, *keep: Column | str) -> DataFrame:
        """The encoded columns with one column of levels for each category instead of one for each level."""
        return rows.select(*keep, *[self.column(n).alias(n) for n in self.dense], *[category(c).alias(c) for c in self.categorical])

    def parameters(self, digits: int = 9) -> dict:
        """Learned parameters for a report, rounded (ML-05)."""
        short = lambda x: round(x, digits) if isinstance(x, float) else x
        return {k: {n: short(x) for n, x in v.items()} if isinstance(v, dict) else v for k, v in asdict(self).items()}

    def description(self) -> dict:
        """What the encoder does, for a report (ML-12)."""
        return {"numeric": len(self.numeric), "categorical": len(self.categorical), "indicators": len(self.indicators), "encoded": len(self.names), "scaled": bool(self.mean)}


def learned(found: Summary, numeric: list[str], categorical: list[str], indicators: bool = True, scale: bool = True) -> Encoder:
    """The encoder of the rows that ``found`` sums up; a column without variance has scale 1."""
    made = Encoder(numeric, categorical, dict(found.fill), [c for c in numeric if indicators and found.nulls[c]], levels=dict(found.levels))
    if scale:
        made.mean = {c: found.mean.get(c, 0.0) for c in numeric}
        made.scale = {c: found.deviation.get(c, 0.0) or 1.0 for c in numeric}
        for c in made.indicators:
            share = found.nulls[c] / found.rows
            made.mean[f"missingindicator_{c}"], made.scale[f"missingindicator_{c}"] = share, (share * (1 - share)) ** 0.5 or 1.0
    return made


def fit(train: DataFrame, numeric: list[str], categorical: list[str], imputation: str = "median", indicators: bool = True, scale: bool = True) -> Encoder:
    """Learn from training rows only, in one pass over them (ML-01 to ML-04).

    Exact medians (or means), null counts, levels, and the mean and population
    deviation of what imputation left, all from the counts of distinct values.  A
    column without any training value is filled with 0, so that its encoding is
    finite everywhere.
    """
    return learned(summaries(value_counts(train, numeric, categorical), [["all"]], imputation)[0], numeric, categorical, indicators, scale)
