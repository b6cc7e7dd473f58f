"""A rule engine over untyped records: every rule of a document kind is counted in
one aggregate over VARIANT values, which keep absent, null and each JSON kind apart.

Findings are rows (endpoint, file, rule, field, finding, severity, n).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.functions.scalars import instant
from tideline.operators.specs import Endpoint, Field
from tideline.sources.scratch import keep

ERROR, WARNING, INFO = "ERROR", "WARNING", "INFO"
RULES = ["structure", "schema", "types", "values", "cross_field", "missing_values", "duplicates", "temporal", "identifiers", "coverage"]


def value(name: str) -> Column:
    return F.try_variant_get("rec", f"$.{name}", "variant")


def text(name: str) -> Column:
    return F.try_variant_get("rec", f"$.{name}", "string")


def kind(v: Column) -> Column:
    """int, float, str, bool, list, object or null for a variant; SQL null if the key is absent."""
    return named_kind(F.schema_of_variant(v))


def named_kind(s: Column) -> Column:
    """The kind behind a variant's schema."""
    return (
        F.when(s == "VOID", "null").when(s == "BIGINT", "int").when(s.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "float")
        .when(s == "STRING", "str").when(s == "BOOLEAN", "bool").when(s.startswith("ARRAY"), "list").when(s.startswith("OBJECT"), "object")
    )


def is_object(rec: Column) -> Column:
    return F.coalesce(kind(rec) == "object", F.lit(False))


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """Have Spark generate a method for each expression instead of one for a whole stage where that
    would be longer than the JVM compiles; the session's setting comes back."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def facts(records: DataFrame, spec: Endpoint) -> DataFrame:
    """What the rules ask of each record of (file, pos, rec), taken out of its VARIANT once.

    (file, pos, ok, keys, k_*, n_*, t_*, i_*, at, g): whether it is an object, its keys, each
    field's kind, number and text, its natural key as texts, and its place in the document's
    order and group.  A record that is no object has nulls.
    """
    parts = records.select("file", "pos", F.try_variant_get("rec", "$", "map<string,variant>").alias("m"))
    named = list(dict.fromkeys([*spec.names, *spec.key, *([spec.order] if spec.order else []), *([spec.group] if spec.group else [])]))
    values = parts.select("file", "pos", F.col("m").isNotNull().alias("ok"), F.sort_array(F.map_keys("m")).alias("keys"), *[F.try_element_at("m", F.lit(c)).alias(f"v_{c}") for c in named])
    kinds = values.select("*", *[F.schema_of_variant(F.col(f"v_{c}")).alias(f"s_{c}") for c in named])
    whole = lambda c: F.try_variant_get(f"v_{c}", "$", "string")
    number = lambda c: F.when((F.col(f"s_{c}") == "BIGINT") | F.col(f"s_{c}").startswith("DECIMAL") | F.col(f"s_{c}").isin("DOUBLE", "FLOAT"), F.try_variant_get(f"v_{c}", "$", "double"))
    cells = [x for c in spec.names for x in (named_kind(F.col(f"s_{c}")).alias(f"k_{c}"), number(c).alias(f"n_{c}"), F.when(F.col(f"s_{c}") == "STRING", whole(c)).alias(f"t_{c}"))]
    timed = any(f.name == spec.order and "time" in f.kinds for f in spec.fields)
    at = F.lit(None).cast("double") if not spec.order else F.unix_micros(instant(whole(spec.order))).cast("double") if timed else number(spec.order)
    return kinds.select("file", "pos", "ok", "keys", *cells, *[F.to_json(f"v_{c}").alias(f"i_{i}") for i, c in enumerate(spec.key)], at.alias("at"), (F.to_json(f"v_{spec.group}") if spec.group else F.lit("")).alias("g"))


def _checks(f: Field) -> dict[tuple[str, str, str], Column]:
    """(rule, finding, severity) to whether a record of :func:`facts` shows it."""
    k, plain_text = F.col(f"k_{f.name}"), F.col(f"t_{f.name}")
    kinds = {"time": "str"}
    right = k.isin([kinds.get(x, x) for x in f.kinds])
    number = F.when(right, F.col(f"n_{f.name}"))
    held = k.isNotNull() & (k != "null")
    found: dict[tuple[str, str, str], Column] = {}
    if f.required:
        found["schema", "required_absent", ERROR] = k.isNull()
    found["types", "wrong_type", ERROR] = held & ~right
    found["missing_values", "null", INFO if f.nullable else ERROR] = k == "null"
    inside = F.lit(True)
    if f.low is not None:
        below = number <= f.low if f.above else number < f.low
        found["values", "below_minimum", ERROR], inside = below, ~below
    if f.high is not None:
        found["values", "above_maximum", ERROR] = inside & (number > f.high)
        inside &= ~(number > f.high)
    for name_, bounds, severity in (("implausible", f.plausible, WARNING), ("undocumented", f.documented, INFO)):
        if bounds:
            out = inside & ~number.between(*bounds)
            found["values", name_, severity], inside = out, inside & ~F.coalesce(out, F.lit(False))
    if f.allowed:
        plain = number if isinstance(f.allowed[0], int) else F.when(right, plain_text)
        found["values", "unexpected", INFO] = plain.isNotNull() & ~plain.isin(*f.allowed)
    if f.pattern:
        found["values", "bad_pattern", INFO] = ~plain_text.rlike(f.pattern)
    if "time" in f.kinds:
        found["temporal", "unparseable", ERROR] = plain_text.isNotNull() & instant(plain_text).isNull()
    return found


def profile(seen: DataFrame, spec: Endpoint, threshold: float = 0.5) -> DataFrame:
    """File rules but duplicates and order, in one aggregate over :func:`facts` (AG-09, AG-13, DQ-01 to DQ-06, DQ-08).

    Entries that are no objects are counted and, as entries, in the denominator
    of null shares; a null share above ``threshold`` is a warning unless nulls
    are usual.
    """
    meaning, shown = [("structure", "", "non_object", ERROR)], [~F.col("ok")]
    for f in spec.fields:
        for (rule, finding, severity), found in _checks(f).items():
            shown.append(F.col("ok") & found)
            meaning.append((rule, f.name, finding, INFO if f.sparse and rule == "missing_values" else severity))
    for low, high in spec.ordered_pairs:
        shown.append(F.col(f"n_{high}") < F.col(f"n_{low}"))
        meaning.append(("cross_field", high, f"before_{low}", ERROR))
    # The numbers of what a record shows, and -1 for the record itself, are counted by document as one map.
    numbers = F.array_compact(F.array(F.lit(-1), *[F.when(x, F.lit(i)) for i, x in enumerate(shown)]))
    counts = seen.select("file", F.explode(numbers).alias("i")).groupBy("file", "i").agg(F.count(F.lit(1)).alias("n"))
    by_file = counts.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("i", "n"))).alias("counts"))
    times = lambda i: F.coalesce(F.try_element_at("counts", F.lit(i)), F.lit(0).cast("bigint"))
    told = lambda rule, name, finding, severity, n: F.struct(F.lit(rule).alias("rule"), F.lit(name).alias("field"), F.lit(finding).alias("finding"), F.lit(severity).alias("severity"), n.alias("n"))
    sparse = {f.name: f.sparse for f in spec.fields}
    entries = [told(*m, times(i)) for i, m in enumerate(meaning)]
    shares = [told("missing_values", name, "null_share", WARNING, F.when(times(i) > times(-1) * threshold, times(i)).otherwise(0)) for i, (_, name, finding, _) in enumerate(meaning) if finding == "null" and not sparse[name]]
    long = by_file.select("file", F.explode(F.array(*entries, *shares)).alias("f")).select("file", "f.*").where("n > 0")
    return long.select(F.lit(spec.name).alias("endpoint"), "file", "rule", "field", "finding", "severity", "n")


def key_sets(seen: DataFrame, spec: Endpoint) -> DataFrame:
    """Unknown keys, and documents whose records do not share one set of keys (AG-10, DQ-01, DQ-02)."""
    keyed = seen.where("ok").groupBy("file", "keys").agg(F.count(F.lit(1)).alias("times"))  # tasks combine equal sets: few are left
    sets = keyed.groupBy("file").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("file", F.lit("structure").alias("rule"), F.lit("").alias("field"), F.lit("several_key_sets").alias("finding"), "n")
    unknown = keyed.select("file", "times", F.explode(F.array_except("keys", F.array(*map(F.lit, spec.names)))).alias("field")).groupBy("file", "field").agg(F.sum("times").alias("n"))
    unknown = unknown.select("file", F.lit("schema").alias("rule"), "field", F.lit("unknown_field").alias("finding"), "n")
    return sets.unionByName(unknown).select(F.lit(spec.name).alias("endpoint"), "file", "rule", "field", "finding", F.lit(INFO).alias("severity"), "n")


def duplicates(seen: DataFrame, spec: Endpoint) -> DataFrame:
    """Surplus records of a natural key within a document (AG-11, DQ-07)."""
    if not spec.key:
        return _rows(seen, spec, "duplicates", "", "no_key", INFO).limit(0)
    sizes = seen.where("ok").groupBy("file", *[f"i_{i}" for i in range(len(spec.key))]).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _rows(sizes.groupBy("file").agg(F.sum(F.col("n") - 1).alias("n")), spec, "duplicates", ",".join(spec.key), "surplus", ERROR)


def inversions(seen: DataFrame, spec: Endpoint) -> DataFrame:
    """Records before their predecessor in file order, by group; the predecessor is the
    last that could be read, not the greatest (WN-09, DQ-08)."""
    if not spec.order:
        return _rows(seen, spec, "temporal", "", "", INFO).limit(0)
    before = F.last("at", ignorenulls=True).over(Window.partitionBy("file", "g").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    counts = seen.where("ok").withColumn("before", before).groupBy("file").agg(F.count_if(F.col("at") < F.col("before")).alias("n")).where("n > 0")
    return _rows(counts, spec, "temporal", spec.order, "order_inversion", WARNING)


def _rows(counts: DataFrame, spec: Endpoint, rule: str, name: str, finding: str, severity: str) -> DataFrame:
    n = F.col("n") if "n" in counts.columns else F.lit(0).cast("bigint")
    return counts.select(F.lit(spec.name).alias("endpoint"), "file", F.lit(rule).alias("rule"), F.lit(name).alias("field"), F.lit(finding).alias("finding"), F.lit(severity).alias("severity"), n.alias("n"))


def document_findings(records: DataFrame, spec: Endpoint, threshold: float = 0.5, most: int | None = None) -> DataFrame:
    """All file rules of one document kind; ``most`` inspects that many first records a document (FLT-15).

    Records are read and parsed once: their :func:`facts` are written, and the rules read those.
    """
    with short_methods(records.sparkSession):
        seen = keep(facts(records if most is None else records.where(F.col("pos") < most), spec))
        return keep(profile(seen, spec, threshold).unionByName(key_sets(seen, spec)).unionByName(duplicates(seen, spec)).unionByName(inversions(seen, spec)))


def documents_without_records(files: DataFrame) -> DataFrame:
    """Empty documents warn, unreadable ones are errors; ``files`` has endpoint, file, readable, entries (DQ-01, SRC-06)."""
    bad = F.when(~F.col("readable"), F.struct(F.lit("unreadable").alias("finding"), F.lit(ERROR).alias("severity"))).when(F.col("entries") == 0, F.struct(F.lit("no_records").alias("finding"), F.lit(WARNING).alias("severity")))
    return files.withColumn("bad", bad).where("bad is not null").select("endpoint", "file", F.lit("structure").alias("rule"), F.lit("").alias("field"), "bad.finding", "bad.severity", F.lit(1).cast("bigint").alias("n"))


def identifiers(used: DataFrame, sessions: DataFrame, meetings: DataFrame, drivers: DataFrame) -> DataFrame:
    """References to sessions, meetings and drivers that no catalogue lists (JN-11, DQ-09).

    ``used`` has endpoint, session_key, meeting_key and driver_number.
    """
    def unknown(catalogue: DataFrame, on: list[str], finding: str, severity: str, rows: DataFrame) -> DataFrame:
        gone = rows.na.drop(subset=on).join(catalogue.select(*on).distinct(), on, "left_anti")
        return gone.groupBy("endpoint").agg(F.count_distinct(*on).alias("n")).select("endpoint", F.lit(None).cast("string").alias("file"), F.lit("identifiers").alias("rule"), F.lit(on[-1]).alias("field"), F.lit(finding).alias("finding"), F.lit(severity).alias("severity"), "n")

    found = unknown(sessions, ["session_key"], "unknown_session", ERROR, used)
    found = found.unionByName(unknown(meetings, ["meeting_key"], "unknown_meeting", ERROR, used))
    return found.unionByName(unknown(drivers, ["session_key", "driver_number"], "driver_not_listed", WARNING, used.where("endpoint = 'laps'")))


def coverage(expected: list[str], sessions: DataFrame, present: DataFrame, failures: DataFrame, targeted: list[str]) -> DataFrame:
    """Expected documents that a session lacks, by what the manifest says (JN-12, DQ-10).

    ``failures`` has endpoint, session_key and status (an HTTP status or null):
    404 is information, another failure or no record at all a warning, an
    endpoint that nobody asked for information.
    """
    names = sessions.sparkSession.createDataFrame([(e, e in targeted) for e in expected], "endpoint string, targeted boolean")
    absent = sessions.select("session_key").distinct().crossJoin(F.broadcast(names)).join(present.select("endpoint", "session_key").distinct(), ["endpoint", "session_key"], "left_anti")
    first = failures.groupBy("endpoint", "session_key").agg(F.min_by("status", F.coalesce("pos", F.lit(0))).alias("status"), F.lit(True).alias("failed")) if "pos" in failures.columns else failures.groupBy("endpoint", "session_key").agg(F.first("status").alias("status"), F.lit(True).alias("failed"))
    why = F.when(~F.col("targeted"), F.struct(F.lit("not_targeted").alias("finding"), F.lit(INFO).alias("severity"))).when(F.col("status") == 404, F.struct(F.lit("not_found").alias("finding"), F.lit(INFO).alias("severity"))).when(F.col("failed"), F.struct(F.lit("failed").alias("finding"), F.lit(WARNING).alias("severity"))).otherwise(F.struct(F.lit("never_recorded").alias("finding"), F.lit(WARNING).alias("severity")))
    return absent.join(first, ["endpoint", "session_key"], "left").withColumn("w", why).groupBy("endpoint", "w.finding", "w.severity").agg(F.count(F.lit(1)).alias("n")).select("endpoint", F.lit(None).cast("string").alias("file"), F.lit("coverage").alias("rule"), F.lit("session_key").alias("field"), "finding", "severity", "n")


def report(findings: DataFrame, endpoints: DataFrame, rules: list[str] = RULES) -> DataFrame:
    """(endpoint, rule, status, errors, warnings, infos): FAIL for an error, WARNING for a
    warning, else PASS, with a row for each clean pair of ``endpoints`` and rule too."""
    worst = findings.groupBy("endpoint", "rule").agg(*[F.coalesce(F.sum(F.when(F.col("severity") == s, F.col("n"))), F.lit(0)).alias(c) for s, c in ((ERROR, "errors"), (WARNING, "warnings"), (INFO, "infos"))])
    every = endpoints.select("endpoint").distinct().select("endpoint", F.explode(F.array(*map(F.lit, rules))).alias("rule"))
    full = every.join(worst, ["endpoint", "rule"], "left").na.fill(0, ["errors", "warnings", "infos"])
    return full.withColumn("status", F.when(F.col("errors") > 0, "FAIL").when(F.col("warnings") > 0, "WARNING").otherwise("PASS"))


def overall(findings: DataFrame) -> DataFrame:
    """One row: FAIL, WARNING or PASS over all findings."""
    return findings.agg(F.when(F.count_if(F.col("severity") == ERROR) > 0, "FAIL").when(F.count_if(F.col("severity") == WARNING) > 0, "WARNING").otherwise("PASS").alias("status"))


def sampling_disclosed(most: int | None, inspected: int, available: int) -> list[dict]:
    """A warning whenever records were sampled (DQ-11)."""
    if most is None:
        return []
    return [{"rule": "sampling", "severity": WARNING, "detail": f"{inspected} of {available} records inspected, {most} a document"}]


def dataset_index(rows: DataFrame, documents: DataFrame) -> DataFrame:
    """(session_key, endpoint, files, unreadable, records, objects, drivers): what is stored of
    each session and kind (AG-12), from parsed documents and their records."""
    keys = ["session_key", "endpoint"]
    stored = documents.groupBy(*keys).agg(F.count(F.lit(1)).alias("files"), F.count_if(~F.col("readable")).alias("unreadable"))
    driver = F.coalesce(F.try_variant_get("rec", "$.driver_number", "long"), F.col("driver_number"))
    is_object = F.coalesce(F.schema_of_variant("rec").startswith("OBJECT"), F.lit(False))
    held = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("records"), F.count_if(is_object).alias("objects"), F.count_distinct(driver).alias("drivers"))
    return stored.join(held, keys, "left").na.fill(0, ["records", "objects", "drivers"])
