"""From features to a trained and judged model: chronological split, encoding learned
from training rows, fourteen guards, least squares and the mean baseline."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.scalars import finite
from tideline.operators import encode, guards, regress, splits, statistics
from tideline.plans import features as feat

GRAIN = [*feat.BY, feat.NUMBER]
#: The names of the guards, in their order.
REQUIRED = [
    "split_completeness",
    "target_not_in_features",
    "forbidden_columns_not_in_features",
    "traceability_columns_not_in_model_features",
    "no_session_overlap_between_splits",
    "no_row_overlap_between_splits",
    "chronological_split",
    "preprocessing_fitted_on_train_only",
    "no_validation_statistics_used_in_training",
    "no_test_statistics_used_in_training",
    "consistent_feature_schema",
    "categorical_unknown_handling",
    "target_alignment",
    "target_rows_are_valid",
]
def kept() -> list[Column | str]:
    """What stands beside the encoded columns."""
    return ["split", feat.TARGET, *[F.col(k).alias(f"key_{k}") for k in GRAIN]]


@dataclass
class Config:
    """Defaults decide results; ``strategy`` is fraction, years or train_years_then_split."""

    strategy: str = "fraction"
    train_years: list[int] = field(default_factory=lambda: [2023, 2024])
    validation_years: list[int] = field(default_factory=list)
    test_years: list[int] = field(default_factory=list)
    train: float = 0.6
    validation: float = 0.2
    validation_share: float = 0.5
    imputation: str = "median"
    indicators: bool = True
    scale: bool = True


@dataclass
class Prepared:
    """Rows with their split, the fitted encoder, guards and verdict."""

    rows: DataFrame
    calendar: DataFrame
    encoder: encode.Encoder
    results: list[guards.Result]
    verdict: str

    @property
    def matrix(self) -> DataFrame:
        """The encoded matrix as it is published, a column for each level (SNK-09)."""
        return self.encoder.apply(self.rows, *kept())

    @property
    def compact(self) -> DataFrame:
        """The same with one column of levels for each category, for fitting and scoring."""
        return self.encoder.compact(self.rows, *kept())


def split_calendar(rows: DataFrame, config: Config) -> DataFrame:
    sessions = splits.calendar(rows, "session_key", "session_date", "year")
    if config.strategy == "years":
        return splits.by_years(sessions, config.train_years, config.validation_years, config.test_years)
    if config.strategy == "train_years_then_split":
        return splits.train_years_then_split(sessions, config.train_years, config.validation_share)
    return splits.by_fraction(sessions, config.train, config.validation)


def prepare(features: DataFrame, config: Config = Config(), guard: bool = True) -> Prepared:
    """Split, fit on train, encode all, and judge (M6).

    ``features`` should be a stored table, as guards read it many times; without
    ``guard`` nothing is judged and the verdict is INCOMPLETE.
    """
    usable = features.where(F.col("has_target") & F.col(feat.TARGET).isNotNull())
    calendar = split_calendar(usable, config)
    rows = splits.assign(usable, calendar, "session_key")
    numeric, categorical = feat.numeric_and_categorical(rows.columns)
    counts = statistics.value_counts(rows, numeric, categorical, "split", splits.SPLITS)
    unions = [["train"], ["train", "validation"], ["train", "test"]] if guard else [["train"]]
    train, *others = statistics.summaries(counts, unions, config.imputation)
    encoder = encode.learned(train, numeric, categorical, config.indicators, config.scale)
    if not guard:
        return Prepared(rows, calendar, encoder, [], "INCOMPLETE")
    names, keyed = encoder.names, rows.select(*kept())
    results = [
        guards.split_completeness(rows), guards.target_not_in_features(names, feat.TARGET), guards.forbidden_not_encoded(names, feat.FORBIDDEN),
        guards.traceability_not_encoded(names, [*keyed.columns, *names], GRAIN), guards.no_session_overlap(rows, "session_key"), guards.no_row_overlap(rows, GRAIN), guards.chronological(calendar),
        guards.fitted_on_train(encoder, train), *[guards.no_statistics_from(s, encoder, train, both) for s, both in zip(splits.SPLITS[1:], others)],
        guards.consistent_schema({s: names for s in splits.SPLITS}), guards.unknown_category(encoder, rows.where("split = 'train'")), guards.target_alignment(keyed, usable, GRAIN, feat.TARGET), guards.targets_valid(rows, feat.TARGET),
    ]
    results = guards.complete(results, REQUIRED)
    return Prepared(rows, calendar, encoder, results, guards.verdict(results, splits.thin(calendar).count(), required=REQUIRED))


def train_and_judge(prepared: Prepared) -> DataFrame:
    """(model, split, metrics): least squares and the mean baseline on each split (M7, ML-06 to ML-08)."""
    encoder, target, matrix = prepared.encoder, feat.TARGET, prepared.compact
    wrong = matrix.where(~(F.lit(True) if not encoder.dense else reduce(and_, [finite(F.col(f"`{n}`")) for n in encoder.dense]))).count()
    if wrong:
        raise ValueError(f"{wrong} rows of the matrix hold a value that is not finite")
    train = matrix.where("split = 'train'")
    model = regress.fit_linear(train, encoder.dense, encoder.levels, target)
    mean = train.agg(F.avg(target)).first()[0]
    scored = regress.predicted(matrix, encoder.dense, encoder.levels, model, "linear").withColumn("mean", F.lit(mean))
    return regress.metrics_by(scored, "split", target, ["linear", "mean"])
