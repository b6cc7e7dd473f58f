"""Raw documents: one JSON file a request, ``{endpoint, parameters, retrieved_at, data}``.

Files are read whole, parsed to VARIANT and exploded to records with their place,
so that nothing about a record is lost to a schema.  Damaged files are kept apart
instead of being dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS = "endpoint string, year int, meeting_key long, session_key long, driver_number int, file string, pos int, rec variant"


@dataclass(frozen=True)
class Scope:
    """An optional season, meeting and session (FLT-07)."""

    year: int | None = None
    meeting_key: int | None = None
    session_key: int | None = None

    def predicate(self) -> Column:
        wanted = F.lit(True)
        for name in ("year", "meeting_key", "session_key"):
            if (v := getattr(self, name)) is not None:
                wanted &= F.col(name) == v
        return wanted


def path_keys(path: Column) -> dict[str, Column]:
    """Keys that a file's path carries, in either layout, and a driver's number from its name (SRC-03, SRC-04)."""
    whole = lambda pattern: F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))
    number = lambda pattern, kind: whole(pattern).try_cast(kind)
    return {
        "endpoint": F.coalesce(whole(r"/endpoint=([^/]+)/"), whole(r"/([^/=]+)(?:/(?:year|meeting_key|session_key)=[^/]*)*/[^/]+$")),
        "year": number(r"/year=(-?\d+)/", "int"),
        "meeting_key": number(r"/meeting(?:_key)?=(-?\d+)/", "long"),
        "session_key": number(r"/session(?:_key)?=(-?\d+)/", "long"),
        "driver_number": number(r"/driver_(-?\d+)\.[^/]*$", "int"),
    }


def _listing(spark: SparkSession, load: Callable[[], DataFrame]) -> DataFrame:
    """What ``load`` reads; folders are listed by a few tasks of many folders each instead of a task a folder."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 2 * spark.sparkContext.defaultParallelism)))
    try:
        return load()
    finally:
        spark.conf.set(key, before)


def discover(spark: SparkSession, root: str, endpoints: list[str] | None = None, scope: Scope = Scope()) -> DataFrame:
    """The documents below ``root`` with their keys and text; hidden and unfinished files are left out (SRC-02)."""
    files = _listing(spark, lambda: spark.read.option("recursiveFileLookup", "true").option("wholetext", "true").option("pathGlobFilter", "*.json").text(root)).select(F.col("_metadata.file_path").alias("file"), F.col("value"))
    shown = files.where(~F.col("file").rlike(r"/[._][^/]*$|\.tmp(?:\.|$)"))
    keyed = shown.withColumns(path_keys(F.col("file"))).where(scope.predicate())
    return keyed.where(F.col("endpoint").isin(endpoints)) if endpoints else keyed


def in_scope(documents: DataFrame, scope: Scope) -> DataFrame:
    """The documents of a scope; for a session also the catalogues of its season, without which
    identifiers could not be checked (DQ-12): all meetings, and the sessions of its meeting.

    Catalogues stand a level above sessions, so their paths name no session.
    """
    wanted = scope.predicate()
    if scope.session_key is not None:
        season = F.col("year") == scope.year if scope.year is not None else F.lit(True)
        sessions = F.col("endpoint") == "sessions"
        if scope.meeting_key is not None:
            sessions &= F.col("meeting_key") == scope.meeting_key
        wanted = F.coalesce(wanted, F.lit(False)) | F.coalesce(season & ((F.col("endpoint") == "meetings") | sessions), F.lit(False))
    return documents.where(wanted)


def listed(documents: DataFrame) -> DataFrame:
    """(file, keys) in the order of paths, whatever order the file system lists them in (SO-07)."""
    return documents.select("file", "endpoint", "year", "meeting_key", "session_key", "driver_number").orderBy("file")


#: Where a document of each layout lies below its root.
LAYOUTS = {"plain": ["{endpoint}", "year={year}", "meeting_key={meeting_key}", "session_key={session_key}"], "lake": ["raw", "year={year}", "meeting={meeting_key}", "session={session_key}", "endpoint={endpoint}"]}


def place_in(layout: str) -> Column:
    """The path of a document in a layout, from its keys and its file's name; keys that are null have no folder."""
    def folder(part: str) -> Column:
        fixed, _, key = part.rstrip("}").partition("{")
        return F.concat(F.lit(fixed), F.col(key).cast("string")) if key else F.lit(fixed)  # null if the key is

    return F.concat_ws("/", *[folder(p) for p in LAYOUTS[layout]], F.regexp_extract("file", "[^/]+$", 0))


def parsed(documents: DataFrame) -> DataFrame:
    """Documents with ``doc`` (null if unreadable), ``readable`` and ``entries``, 0 where data is no list (SRC-01)."""
    doc = F.try_parse_json("value")
    data = F.try_variant_get("doc", "$.data", "array<variant>")
    held = documents.withColumn("doc", doc).withColumn("data", data)
    shape = F.coalesce(F.schema_of_variant("doc").startswith("OBJECT") & F.try_variant_get("doc", "$.data", "variant").isNotNull(), F.lit(False))
    return held.withColumn("readable", shape).withColumn("entries", F.when(F.col("readable"), F.coalesce(F.size("data"), F.lit(0))).otherwise(0)).drop("value")


def records(documents: DataFrame) -> DataFrame:
    """(keys, file, pos, rec) of readable documents, entries of any kind included."""
    return parsed(documents).where("readable and data is not null").select("endpoint", "year", "meeting_key", "session_key", "driver_number", "file", F.posexplode("data").alias("pos", "rec"))


def damaged(documents: DataFrame) -> DataFrame:
    """(endpoint, file) of documents that cannot be read, for a report (SRC-06)."""
    return parsed(documents).where("not readable").select("endpoint", "file")


def objects(rows: DataFrame) -> DataFrame:
    """Records that are JSON objects (SRC-05)."""
    return rows.where(F.coalesce(F.schema_of_variant("rec").startswith("OBJECT"), F.lit(False)))


def sessions(rows: DataFrame) -> DataFrame:
    """A session exists if it has a document of laps (SRC-07)."""
    return rows.where("endpoint = 'laps'").select("year", "meeting_key", "session_key").distinct()


def missing_units(wanted: DataFrame, stored: DataFrame, on: list[str], force: bool = False) -> DataFrame:
    """Wanted requests whose document is not stored and readable; all if forced (SRC-18, FLT-14)."""
    return wanted if force else wanted.join(stored.select(*on), on, "left_anti")


def newest_manifests(manifests: DataFrame) -> DataFrame:
    """The newest full run by name; without one, the newest manifest of each session (SRC-19).

    ``manifests`` has name, session_key (null for a full run) and entries.
    """
    full = manifests.where("session_key is null")
    newest = lambda df, by: df.groupBy(*by).agg(F.max_by(F.struct(*manifests.columns), "name").alias("m")).select("m.*")
    return newest(full.withColumn("_all", F.lit(1)), ["_all"]).unionByName(newest(manifests.where("session_key is not null"), ["session_key"]).join(full.select("name").limit(1), F.lit(True), "left_anti"))
