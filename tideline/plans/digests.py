"""A tree of digests over rows: bucket, session, season, stage.

A node's digest sums hashes of the rows below it, so it depends neither on their
order nor on files, and a parent's digest is the sum of its children's: the whole
tree comes from one pass over the rows and small sums of sums.  Two trees are
compared from their roots; at each level only the children of nodes that differ are
read, and at the end only the rows of buckets that differ.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.sources.scratch import keep

#: Children of a node below a session, a power of two, and levels of them.
FANOUT, DEPTH = 16, 2
#: A node: level from 0 (stage), its path, and its parent's.
NODES = "level int, parent string, path string, rows long, digest string"


def row_hash(columns: list[str]) -> Column:
    """A hash of a row of 84 bits as a decimal; sums of 10^12 of them fit, null values included."""
    text = F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
    return F.xxhash64(text).cast("decimal(38,0)") * F.lit(1 << 20) + F.pmod(F.xxhash64(F.reverse(text), F.lit(5)), F.lit(1 << 20))


def bucket_path(year: str, session: str, key: list[str]) -> Column:
    """The path of a row's bucket below its stage: /season/session/digit/digit."""
    h = F.xxhash64(*key)
    digits = [F.pmod(F.shiftright(h, d * (FANOUT.bit_length() - 1)), F.lit(FANOUT)).cast("string") for d in range(DEPTH)]
    return F.concat_ws("/", F.coalesce(F.col(year).cast("string"), F.lit("none")), F.coalesce(F.col(session).cast("string"), F.lit("none")), *digits)


def write_tree(tables: dict[str, DataFrame], folder: str, key: list[str], year: str = "year", session: str = "session_key") -> None:
    """Write the tree of the ``tables`` of several stages below ``folder``, a folder for each level (PV-01, PV-08, AG-26).

    Rows are placed by hashes of their ``key`` columns; a null season or session is one
    of its own.  An empty table has no nodes.
    """
    leaves = None
    for stage, table in tables.items():
        at = F.concat(F.lit(f"{stage}/"), bucket_path(year, session, key))
        one = table.select(at.alias("path"), row_hash(table.columns).alias("h")).groupBy("path").agg(F.count(F.lit(1)).alias("rows"), F.sum("h").alias("digest"))
        leaves = one if leaves is None else leaves.unionByName(one)
    parent = F.regexp_replace("path", r"/?[^/]*$", "")
    nodes = keep(leaves)
    for level in range(2 + DEPTH, -1, -1):
        nodes.select(F.lit(level).alias("level"), parent.alias("parent"), "path", "rows", F.col("digest").cast("string").alias("digest")).repartition("parent").sortWithinPartitions("parent").write.parquet(f"{folder}/level-{level}")
        if level:
            nodes = keep(nodes.groupBy(parent.alias("path")).agg(F.sum("rows").alias("rows"), F.sum("digest").alias("digest")))


def level(spark: SparkSession, folder: str, n: int) -> DataFrame:
    return spark.read.schema(NODES).parquet(f"{folder}/level-{n}")


@dataclass
class Difference:
    """Buckets that differ (path), by stage the first level at which it does, and how many digests were read."""

    buckets: DataFrame
    read: int


def compare(spark: SparkSession, now: str, recorded: str) -> Difference:
    """Descend from the roots of two trees along nodes that differ or stand in one tree only."""
    changed, read = None, 0
    for n in range(3 + DEPTH):
        sides = [level(spark, f, n) for f in (now, recorded)]
        if changed is not None:
            sides = [s.join(changed.select(F.col("path").alias("parent")), "parent", "left_semi") for s in sides]
        a, b = sides[0].select("path", F.col("digest").alias("now")), sides[1].select("path", F.col("digest").alias("recorded"))
        met = keep(a.join(b, "path", "full"))
        read += sum(met.select(F.count("now") + F.count("recorded")).first())
        changed = keep(met.where(~F.col("now").eqNullSafe(F.col("recorded"))).select("path"))
        if changed.isEmpty():
            break
    return Difference(changed, read)


def changed_rows(found: Difference, now: dict[str, DataFrame], recorded: dict[str, DataFrame], key: list[str], year: str = "year", session: str = "session_key") -> DataFrame:
    """(stage, key columns, change) of the rows in buckets that differ: added, removed or changed;
    a key that stands several times counts as one row.  Other rows are pruned before they are compared."""
    result = None
    for stage in now:
        mine = found.buckets.where(F.col("path").startswith(f"{stage}/"))
        hashed: Callable[[DataFrame], DataFrame] = lambda t, mine=mine, stage=stage: (
            t.withColumn("_path", F.concat(F.lit(f"{stage}/"), bucket_path(year, session, key))).join(mine.withColumnRenamed("path", "_path"), "_path", "left_semi").groupBy(*key).agg(F.sum(row_hash(t.columns)).alias("h"))
        )
        a, b = hashed(now[stage]).alias("a"), hashed(recorded[stage]).alias("b")
        same = F.lit(True)
        for k in key:
            same &= F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        change = F.when(F.col("b.h").isNull(), "added").when(F.col("a.h").isNull(), "removed").when(F.col("a.h") != F.col("b.h"), "changed")
        one = a.join(b, same, "full").select(F.lit(stage).alias("stage"), *[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in key], change.alias("change")).where("change is not null")
        result = one if result is None else result.unionByName(one)
    return result


def first_changed(found: Difference, stages: list[str], sessions: DataFrame) -> DataFrame:
    """(session_key, reusable, first_changed) for each session: the first stage with a bucket that differs (PV-02, PV-08)."""
    part = lambda n: F.element_at(F.split("path", "/"), n)
    order = F.array_position(F.array(*map(F.lit, stages)), part(1))
    hit = found.buckets.select(part(3).alias("_s"), part(1).alias("stage"), order.alias("n")).groupBy("_s").agg(F.min_by("stage", "n").alias("first_changed"))
    return sessions.select("session_key").distinct().withColumn("_s", F.col("session_key").cast("string")).join(hit, "_s", "left").select("session_key", F.col("first_changed").isNull().alias("reusable"), "first_changed")
