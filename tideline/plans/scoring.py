"""Batch scoring under a strict contract: records are judged and scored as columns."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalars import finite
from tideline.operators.encode import Encoder
from tideline.operators.regress import prediction
from tideline.plans import features as feat
from tideline.sources import sinks


@dataclass(frozen=True)
class Contract:
    """The features that a record must hold, by kind; keys may come along (SV-01)."""

    numeric: list[str]
    categorical: list[str]
    keys: list[str]

    @classmethod
    def of(cls, encoder: Encoder, keys: list[str] = feat.KEYS) -> Contract:
        """The contract of a fitted encoder; names that leak the future are refused."""
        leaking = sorted({*encoder.numeric, *encoder.categorical} & set(feat.FORBIDDEN))
        if leaking:
            raise ValueError(f"leaking features: {', '.join(leaking)}")
        return cls(encoder.numeric, encoder.categorical, keys)

    def errors(self, columns: list[str]) -> Column:
        """All that is wrong with a record, as an array of texts (SV-02).

        Numbers may be null but must be finite; unknown columns are refused.
        """
        wanted = [*self.numeric, *self.categorical]
        found = [F.lit(f"{c}: absent") for c in wanted if c not in columns] + [F.lit(f"{c}: unknown") for c in columns if c not in (*wanted, *self.keys)]
        for c in self.numeric:
            if c in columns:
                x = F.col(f"`{c}`").cast("double")
                found.append(F.when(F.col(f"`{c}`").isNotNull() & ~finite(x), F.lit(f"{c}: not finite")))
        return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def judge(records: DataFrame, contract: Contract) -> DataFrame:
    """Records with ``errors``."""
    return records.withColumn("errors", contract.errors(records.columns))


def score(records: DataFrame, contract: Contract, encoder: Encoder, model: tuple[float, dict[str, float]]) -> DataFrame:
    """(keys, prediction, errors): no prediction for a record with errors, and an error
    where the prediction is not finite (SV-03, SV-04, PRJ-15)."""
    judged = judge(records, contract)
    keys = [k for k in contract.keys if k in records.columns]
    if any(c not in records.columns for c in (*contract.numeric, *contract.categorical)):
        return judged.select(*keys, F.lit(None).cast("double").alias("prediction"), "errors")
    encoded = encoder.apply(judged, *keys, "errors")
    guess = F.when(F.size("errors") == 0, prediction(*model))
    bad = F.when((F.size("errors") == 0) & ~finite(F.col("guess")), F.array(F.lit("prediction: not finite"))).otherwise(F.col("errors"))
    return encoded.withColumn("guess", guess).select(*keys, F.when(finite(F.col("guess")), F.col("guess")).alias("prediction"), bad.alias("errors"))


def save_package(spark: SparkSession, folder: str, contract: Contract, encoder: Encoder, model: tuple[float, dict[str, float]], provenance: dict | None = None) -> None:
    """An immutable folder of parameters at full precision; the marker comes last (SNK-06, SNK-10, SV-09)."""
    parts = {"contract": asdict(contract), "encoder": asdict(encoder), "model": {"intercept": model[0], "coefficients": model[1]}, "provenance": provenance or {}}
    for name, value in parts.items():
        sinks.write_json(spark, f"{folder}/{name}.json", value)
    sinks.write_json(spark, f"{folder}/PUBLISHED.json", {name: sinks.digest(value) for name, value in parts.items()})


def load_package(spark: SparkSession, folder: str) -> tuple[Contract, Encoder, tuple[float, dict[str, float]]]:
    """What :func:`save_package` wrote.  A folder without its marker, a part that is not
    what was published, and parts that do not fit each other are refused (SV-05, SV-06, ML-09)."""
    if not sinks.exists(spark, f"{folder}/PUBLISHED.json"):
        raise ValueError(f"{folder} is not published")
    marker = sinks.read_json(spark, f"{folder}/PUBLISHED.json")
    parts = {name: sinks.read_json(spark, f"{folder}/{name}.json") for name in ("contract", "encoder", "model", "provenance")}
    changed = [n for n, value in parts.items() if marker.get(n) != sinks.digest(value)]
    if changed:
        raise ValueError(f"changed since it was published: {', '.join(changed)}")
    contract, encoder = Contract(**parts["contract"]), Encoder(**parts["encoder"])
    if (contract.numeric, contract.categorical) != (encoder.numeric, encoder.categorical):
        raise ValueError("the contract names other features than the encoder")
    if set(parts["model"]["coefficients"]) != set(encoder.names):
        raise ValueError("the model weighs other columns than the encoder gives")
    order = {n: parts["model"]["coefficients"][n] for n in encoder.names}
    return contract, encoder, (parts["model"]["intercept"], order)


def provenance(spark: SparkSession, folder: str, expected: dict | None = None) -> dict:
    """Where a published package comes from (SV-09); refused if it was changed since, or if it is not what ``expected`` says."""
    load_package(spark, folder)
    found = sinks.read_json(spark, f"{folder}/provenance.json")
    wrong = sorted(k for k, v in (expected or {}).items() if found.get(k) != v)
    if wrong:
        raise ValueError(f"the package comes from elsewhere: {', '.join(wrong)}")
    return found
