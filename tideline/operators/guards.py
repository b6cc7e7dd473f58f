"""Guards that prove with independent recomputation that no row knows its future.

A guard yields a Result; only PASS clears a blocking one.  What reaches the driver
are counts.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.scalars import close
from tideline.operators.encode import MISSING, Encoder, category, learned
from tideline.operators.recompute import wrong_history
from tideline.operators.regress import correlations
from tideline.operators.splits import SPLITS, chronology
from tideline.operators.statistics import Summary

PASS, FAIL, INCONCLUSIVE, SKIPPED = "PASS", "FAIL", "INCONCLUSIVE", "SKIPPED"


@dataclass
class Result:
    name: str
    status: str
    blocking: bool = True
    detail: str = ""

    @property
    def blocks(self) -> bool:
        return self.blocking and self.status != PASS


def judged(name: str, wrong: int, what: str, blocking: bool = True) -> Result:
    return Result(name, FAIL if wrong else PASS, blocking, f"{wrong} {what}" if wrong else "")


def blocking_failures(results: Iterable[Result]) -> list[Result]:
    return [r for r in results if r.blocks]


def complete(results: list[Result], required: list[str]) -> list[Result]:
    """Required guards that did not run are SKIPPED and block (G6-C)."""
    ran = {r.name for r in results}
    return results + [Result(n, SKIPPED, True, "not run") for n in required if n not in ran]


def verdict(results: list[Result], warnings: int = 0, aborted: bool = False, finished: bool = True, required: list[str] | None = None) -> str:
    """INCOMPLETE, INVALID, INCONCLUSIVE, INCOMPLETE, ABORTED, VALID_WITH_WARNINGS or VALID: the first that holds (G-V)."""
    ran = {r.name for r in results}
    if required and not ran >= set(required):
        return "INCOMPLETE"
    for status, name in ((FAIL, "INVALID"), (INCONCLUSIVE, "INCONCLUSIVE"), (SKIPPED, "INCOMPLETE")):
        if any(r.blocking and r.status == status for r in results):
            return name
    if aborted:
        return "ABORTED"
    if not finished:
        return "INCOMPLETE"
    return "VALID_WITH_WARNINGS" if warnings else "VALID"


def grain_unique(rows: DataFrame, grain: list[str]) -> Result:
    extra = rows.groupBy(*grain).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).first()[0]
    return judged("grain_unique", extra, "rows beyond the first of their key")


def target_independently(rows: DataFrame, by: list[str], number: str, value: str, target: str, tolerance: float = 1e-9) -> Result:
    """The target again, by a self-join on the next number instead of a window (JN-09, G5-2)."""
    following = rows.select(*by, (F.col(number) - 1).alias(number), F.col(value).alias("_next"))
    wrong = rows.join(following, [*by, number], "left").where(~close(F.col(target), F.col("_next"), tolerance)).count()
    return judged("target_matches_independent_derivation", wrong, "rows differ")


def last_has_no_target(rows: DataFrame, marker: str, target: str) -> Result:
    if marker not in rows.columns:
        return Result("last_lap_has_no_target", SKIPPED, False, f"no column {marker}")
    return judged("last_lap_has_no_target", rows.where(F.col(marker) & F.col(target).isNotNull()).count(), "last rows have a target")


def target_stays_in_group(rows: DataFrame, by: list[str], number: str, target: str) -> Result:
    """A target only where the next row over all groups is the same group's next number (WN-10, G5-4).

    The order over all rows is cut by session, the first of ``by``, so its last row has no next one.
    """
    w = Window.partitionBy(by[0]).orderBy(*by[1:], number)
    same = F.lead(number).over(w) == F.col(number) + 1
    for key in by[1:]:
        same &= F.lead(key).over(w) == F.col(key)
    wrong = rows.withColumn("_same", F.coalesce(same, F.lit(False))).where(F.col(target).isNotNull() & ~F.col("_same")).count()
    return judged("target_does_not_cross_driver_or_session", wrong, "targets cross a boundary")


def no_forbidden(features: Iterable[str], forbidden: Iterable[str]) -> Result:
    found = sorted(set(features) & set(forbidden))
    return Result("no_forbidden_columns_among_features", FAIL if found else PASS, True, ", ".join(found))


def rolling_from_past(rows: DataFrame, by: list[str], number: str, value: str, name: str = "lap_time", windows: tuple[int, ...] = (3, 5), tolerance: float = 1e-6) -> Result:
    """History features of every row again, from merged states of the rows up to it instead of windows (JN-16, G5-6)."""
    return judged("rolling_features_use_only_the_past", wrong_history(rows, by, number, value, name, windows, tolerance), "rows differ from their past")


def no_near_copy_of_target(rows: DataFrame, features: list[str], target: str, threshold: float = 0.99) -> Result:
    found = [r["feature"] for r in correlations(rows, features, target, threshold).where("suspicious").collect()]
    return Result("no_feature_almost_equals_the_target", FAIL if found else PASS, False, ", ".join(found))


def split_completeness(rows: DataFrame) -> Result:
    got = {r["split"] for r in rows.select("split").distinct().collect()}
    missing = [s for s in SPLITS if s not in got]
    return Result("split_completeness", FAIL if missing else PASS, True, ", ".join(missing))


def target_not_in_features(features: Iterable[str], target: str) -> Result:
    return Result("target_not_in_features", FAIL if target in set(features) else PASS)


def forbidden_not_encoded(names: Iterable[str], forbidden: Iterable[str]) -> Result:
    """Neither a forbidden column nor one that encoding made from it, indicators included (G6-3)."""
    bare = [(n, n.removeprefix("missingindicator_")) for n in names]
    found = sorted({n for n, b in bare for f in forbidden if b == f or b.startswith(f"{f}_")})
    return Result("forbidden_columns_not_in_features", FAIL if found else PASS, True, ", ".join(found))


def traceability_not_encoded(names: Iterable[str], columns: Iterable[str], keys: Iterable[str]) -> Result:
    """Keys stand in the matrix under a prefix only, never as features (G6-4)."""
    found = sorted(set(names) & {f"key_{k}" for k in keys}) + [k for k in keys if f"key_{k}" not in set(columns)]
    return Result("traceability_columns_not_in_model_features", FAIL if found else PASS, True, ", ".join(found))


def no_session_overlap(rows: DataFrame, session: str) -> Result:
    wrong = rows.groupBy(session).agg(F.count_distinct("split").alias("n")).where("n > 1").count()
    return judged("no_session_overlap_between_splits", wrong, "sessions in two splits")


def no_row_overlap(rows: DataFrame, grain: list[str]) -> Result:
    wrong = rows.groupBy(*grain).agg(F.count_distinct("split").alias("n")).where("n > 1").count()
    return judged("no_row_overlap_between_splits", wrong, "rows in two splits")


def chronological(sessions: DataFrame) -> Result:
    return judged("chronological_split", chronology(sessions).where("not coalesce(ordered, false)").count(), "boundaries out of order")


def differing(mine: Encoder, other: Encoder, tolerance: float = 1e-9) -> list[str]:
    """Columns in whose learned parameters two encoders differ, numbers by more than ``tolerance`` of their size."""
    far = lambda a, b: (a is None) != (b is None) or a is not None and abs(a - b) > tolerance * max(1.0, abs(a), abs(b))
    found = {c for kind in ("fill", "mean", "scale") for c in {**getattr(mine, kind), **getattr(other, kind)} if far(getattr(mine, kind).get(c), getattr(other, kind).get(c))}
    found |= {c for c in {*mine.levels, *other.levels} if mine.levels.get(c) != other.levels.get(c)}
    return sorted(found | set(mine.indicators) ^ set(other.indicators))


def fitted_on_train(encoder: Encoder, train: Summary, tolerance: float = 1e-6) -> Result:
    """Fill values and categories are those of the training rows' own statistics (G6-8)."""
    again = learned(train, encoder.numeric, encoder.categorical, scale=False)
    wrong = [c for c in encoder.numeric if abs(again.fill[c] - encoder.fill[c]) > tolerance] + [c for c in encoder.categorical if again.levels[c] != encoder.levels[c]]
    return Result("preprocessing_fitted_on_train_only", FAIL if wrong else PASS, True, ", ".join(wrong))


def no_statistics_from(other: str, encoder: Encoder, train: Summary, both: Summary) -> Result:
    """The statistics of train give the encoder, those of train and ``other`` do not (G6-9, G6-10).

    If both give the same, nothing can be told apart: INCONCLUSIVE.
    """
    refit = lambda found: learned(found, encoder.numeric, encoder.categorical, bool(encoder.indicators) or True, bool(encoder.mean))
    name, wrong = f"no_{other}_statistics_used_in_training", differing(encoder, refit(train))
    if wrong:
        return Result(name, FAIL, True, f"training rows say otherwise: {', '.join(wrong)}")
    return Result(name, PASS if differing(encoder, refit(both)) else INCONCLUSIVE)


def consistent_schema(names_by_split: dict[str, list[str]]) -> Result:
    return Result("consistent_feature_schema", PASS if len({tuple(v) for v in names_by_split.values()}) <= 1 else FAIL)


def unknown_category(encoder: Encoder, rows: DataFrame) -> Result:
    """A category never seen is all zeros in its columns (G6-12)."""
    if not encoder.categorical:
        return Result("categorical_unknown_handling", SKIPPED, False, "no categories")
    probe = rows.limit(1).withColumns({c: F.lit(f"{MISSING}?unseen") for c in encoder.categorical})
    row = probe.select(*[category(c) for c in encoder.categorical]).first()
    lit = [x in set(encoder.levels[c]) for c, x in zip(encoder.categorical, row or [])]
    return judged("categorical_unknown_handling", sum(lit), "categories light a column")


def target_alignment(encoded: DataFrame, source: DataFrame, grain: list[str], target: str, tolerance: float = 1e-9) -> Result:
    """Targets in the matrix are those of the source rows with the same key (JN-10, G6-13)."""
    keyed = encoded.select(*[F.col(f"key_{k}").alias(k) for k in grain], F.col(target).alias("_matrix"))
    joined = keyed.join(source.select(*grain, F.col(target).alias("_source"), F.lit(True).alias("_there")), grain, "left")
    wrong = joined.where(F.col("_there").isNull() | ~close(F.col("_matrix"), F.col("_source"), tolerance)).count()
    return judged("target_alignment", wrong, "rows without their target")


def targets_valid(rows: DataFrame, target: str) -> Result:
    wrong = rows.where(F.col(target).isNull() | F.isnan(target) | (F.abs(target) == float("inf"))).count()
    return judged("target_rows_are_valid", wrong, "rows without a finite target")
