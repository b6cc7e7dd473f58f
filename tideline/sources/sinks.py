"""Sinks: session-partitioned tables, raw documents, reports and immutable runs."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.sources import archive, envelopes
from tideline.sources.scratch import keep


def write_sessions(table: DataFrame, path: str) -> None:
    """Replace the sessions that ``table`` holds and leave others (SNK-02).

    Folder columns have names of their own, as the files hold year and session_key.
    """
    named = table.withColumns({"p_year": F.col("year"), "p_session": F.col("session_key")})
    named.repartition("p_year", "p_session").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("p_year", "p_session").parquet(path)


def write_documents(records: DataFrame, path: str) -> None:
    """One raw document a row: endpoint, parameters and data as JSON text, by endpoint (SNK-01)."""
    doc = F.to_json(F.struct("endpoint", F.try_parse_json("parameters").alias("parameters"), F.date_format("retrieved_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("retrieved_at"), F.try_parse_json("data").alias("data")))
    records.select("endpoint", doc.alias("value")).write.mode("append").partitionBy("endpoint").text(path)


def write_report_csv(findings: DataFrame, path: str) -> None:
    """Findings as one CSV file with a header (SNK-05); reports are small."""
    findings.orderBy(*findings.columns).coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def copy_documents(spark: SparkSession, source: str, target: str, layout: str | None = None, overwrite: bool = False) -> DataFrame:
    """Copy raw documents to another store, and to another layout if one is named: (file, target, status, bytes, error), written (SNK-07).

    Status is copied, skipped (a document of that name is there, unless ``overwrite``) or
    failed: a file that cannot be read or written, or whose path names no endpoint, is
    reported and the others go on.  Each copy appears whole, so a second run only
    makes up for what is missing.  Bytes go from task to task's file and through no driver.
    """
    root = source.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(source).select(F.col("path").alias("file"))
    shown = files.where(~F.col("file").rlike(r"/[._][^/]*$|\.tmp(?:\.|$)|/[.][^/]*/")).withColumns(envelopes.path_keys(F.col("file")))
    kept = F.regexp_replace("file", f"^.*?{re.escape(root.partition('://')[2] or root)}/", "")
    placed = shown.select("file", (envelopes.place_in(layout) if layout else kept).alias("at"), F.col("endpoint").isNotNull().alias("known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [archive.copied(r["file"], f"{target.rstrip('/')}/{r['at']}", overwrite) if r["known"] or not layout else ("failed", 0, "no endpoint in the path") for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["file"], batch["at"], *(pa.array([t[i] for t in told], k) for i, k in enumerate((pa.string(), pa.int64(), pa.string())))], ["file", "target", "status", "bytes", "error"])

    dealt = placed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return keep(dealt.mapInArrow(run, "file string, target string, status string, bytes long, error string"))


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _files(spark, path)
    return fs.exists(p)


def canonical_json(value) -> bytes:
    """Sorted keys, no blanks, UTF-8, no NaN: equal values have equal bytes (SNK-08)."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False).encode()


def digest(value) -> str:
    """A digest of a value's canonical JSON."""
    return hashlib.sha256(canonical_json(value)).hexdigest()


def write_json(spark: SparkSession, path: str, value, replace: bool = False) -> None:
    """Write a small report, which appears whole; without ``replace`` it must be new (SNK-03, SNK-12)."""
    if not archive.write_json(path, canonical_json(value), replace):
        raise FileExistsError(path)


def read_json(spark: SparkSession, path: str):
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def write_json_unique(spark: SparkSession, path: str, value, tries: int = 100) -> str:
    """Write under the first free name of path, path-1, path-2 ... (SNK-04)."""
    stem, dot, kind = path.rpartition(".")
    for n in range(tries + 1):
        name = f"{stem}-{n}{dot}{kind}" if n else path
        if archive.write_json(name, canonical_json(value), False):  # only the creation itself tells whether the name was free
            return name
    raise FileExistsError(path)


def safe_name(name: str) -> str:
    """A name that stays in its folder."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._=-]*", name):
        raise ValueError(f"not a plain name: {name!r}")
    return name


def publish(spark: SparkSession, root: str, run_id: str, tables: dict[str, DataFrame], report: dict) -> str:
    """An immutable run: tables in a fresh folder, then digests and a marker (SNK-09, SNK-10).

    Readers trust a folder with a marker only; a run that broke off has none.
    """
    from tideline.sources.tables import content_digest

    folder = f"{root.rstrip('/')}/runs/{safe_name(run_id)}"
    if exists(spark, f"{folder}/PUBLISHED.json"):
        raise FileExistsError(folder)
    digests = {}
    for name, table in tables.items():
        table.write.mode("errorifexists").parquet(f"{folder}/{safe_name(name)}")
        digests[name] = content_digest(spark.read.parquet(f"{folder}/{name}"))
    write_json(spark, f"{folder}/report.json", report)
    write_json(spark, f"{folder}/PUBLISHED.json", {"run_id": run_id, "tables": digests, "at": datetime.now(timezone.utc).isoformat()})
    return folder


def verify(spark: SparkSession, folder: str) -> list[str]:
    """Tables of a published run whose content is not what was published (ML-10, SNK-13)."""
    from tideline.sources.tables import content_digest

    marker = read_json(spark, f"{folder}/PUBLISHED.json")
    if set(marker) != {"run_id", "tables", "at"}:
        raise ValueError("the marker has other keys than were written")
    return [n for n, d in marker["tables"].items() if content_digest(spark.read.parquet(f"{folder}/{safe_name(n)}")) != d]
