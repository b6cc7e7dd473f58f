"""Raw documents and session tables that readers only ever see whole.

``df.write.format("raw_documents")`` stages documents below a hidden folder and
moves each to its name when the job commits; a task or job that dies leaves nothing
that a reader lists.  Session tables are versioned: new versions of sessions are
written beside the old ones, and a snapshot, a small table of (session, version), is
made current last by one small file.
"""

from __future__ import annotations

import errno
import json
import os
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tideline.sources.scratch import keep

#: Within a document's path: plain names, none of them hidden.
_PLAIN = re.compile(r"[A-Za-z0-9][A-Za-z0-9._=-]*(/[A-Za-z0-9][A-Za-z0-9._=-]*)*\Z")
_STAGED = ".staged"
#: Tasks' folders that the driver moves at once.
MOVERS = 16


@dataclass
class Staged(WriterCommitMessage):
    """The folder of one task's documents, and how many it holds."""

    folder: str
    documents: int


class DocumentSink(DataSource):
    """Rows (path, value) as one file each below the option ``path``.

    Mode overwrite replaces documents that are there; append leaves them as they are.
    """

    @classmethod
    def name(cls) -> str:
        return "raw_documents"

    def schema(self) -> str:
        return "path string, value string"

    def writer(self, schema, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(self.options["path"], overwrite)


class DocumentWriter(DataSourceWriter):
    def __init__(self, root: str, overwrite: bool):
        self.root, self.overwrite, self.job = root.rstrip("/"), overwrite, uuid.uuid4().hex

    def write(self, rows: Iterator) -> Staged:
        """A task's documents under the names they are to have, in a folder of its own."""
        task = TaskContext.get()
        files, top = FileSystem.from_uri(self.root)
        folder, n = f"{_STAGED}/{self.job}/{task.partitionId()}-{task.taskAttemptId()}", 0
        for row in rows:
            if row["path"] is None or not _PLAIN.match(row["path"]):
                raise ValueError(f"not a plain path: {row['path']!r}")
            at = f"{top}/{folder}/{row['path']}"
            files.create_dir(at.rpartition("/")[0], recursive=True)
            with files.open_output_stream(at) as f:
                f.write((row["value"] or "").encode())
            n += 1
        return Staged(folder, n)

    def commit(self, messages: list[Staged | None]) -> None:
        """Move the documents of the tasks that ended well to their names, each in one step; tasks' folders are moved side by side."""
        files, top = FileSystem.from_uri(self.root)
        staged = [f"{top}/{m.folder}" for m in messages if m is not None and m.documents]
        with ThreadPoolExecutor(MOVERS) as pool:
            for _ in pool.map(lambda folder: publish_tree(files, folder, top, self.overwrite), staged):
                pass
        self.abort(messages)

    def abort(self, messages: list[Staged | None]) -> None:
        files, top = FileSystem.from_uri(self.root)
        if files.get_file_info(f"{top}/{_STAGED}/{self.job}").type == FileType.Directory:
            files.delete_dir(f"{top}/{_STAGED}/{self.job}")


def publish_tree(files: FileSystem, staged: str, target: str, replace: bool) -> None:
    """Give all whole files below a folder their names below ``target``.

    Where a file system renames folders, one whose name is free is moved with all it holds.
    """
    if not isinstance(files, LocalFileSystem):
        for f in files.get_file_info(FileSelector(staged, recursive=True)):
            if f.type == FileType.File:
                publish(files, f.path, f"{target}/{f.path.removeprefix(staged).lstrip('/')}", replace)
        return
    with os.scandir(staged) as found:
        entries = sorted((e.name, e.is_dir()) for e in found)
    for name, folder in entries:
        here, there = f"{staged}/{name}", f"{target}/{name}"
        if not folder:
            publish(files, here, there, replace)
            continue
        try:
            os.rename(here, there)  # takes the place of nothing but an empty folder
        except OSError as e:
            if e.errno not in (errno.ENOTEMPTY, errno.EEXIST):
                raise
            publish_tree(files, here, there, replace)


def publish(files: FileSystem, staged: str, name: str, replace: bool) -> bool:
    """Give a whole file its name in one step; without ``replace`` only if the name is free (SNK-03)."""
    files.create_dir(name.rpartition("/")[0], recursive=True)
    if not replace:
        if isinstance(files, LocalFileSystem):
            try:
                os.link(staged, name)
            except FileExistsError:
                return False
            return True
        if files.get_file_info(name).type != FileType.NotFound:
            return False
    files.move(staged, name)
    return True


def write_json(uri: str, data: bytes, replace: bool = False) -> bool:
    """A small document that appears whole or not at all; without ``replace``, False and nothing changed if its name is taken (SNK-03)."""
    files, path = FileSystem.from_uri(uri)
    staged = f"{path.rpartition('/')[0]}/{_STAGED}-{uuid.uuid4().hex}"
    files.create_dir(path.rpartition("/")[0], recursive=True)
    with files.open_output_stream(staged) as f:
        f.write(data)
    try:
        return publish(files, staged, path, replace)
    finally:
        if files.get_file_info(staged).type == FileType.File:
            files.delete_file(staged)


def copied(source: str, target: str, replace: bool) -> tuple[str, int, str | None]:
    """Copy one file, which appears whole: (copied, skipped or failed, bytes, error)."""
    try:
        here, path = FileSystem.from_uri(source)
        there, name = FileSystem.from_uri(target)
        if not replace and there.get_file_info(name).type != FileType.NotFound:
            return "skipped", 0, None
        with here.open_input_stream(path) as f:
            data = f.read()
        return ("copied", len(data), None) if write_json(target, data, replace) else ("skipped", 0, None)
    except (OSError, ValueError) as e:
        return "failed", 0, str(e)


def envelopes_of(records: DataFrame, unique: bool = False) -> DataFrame:
    """(path, value): documents {endpoint, parameters, retrieved_at, data} from rows of endpoint,
    year, meeting_key, session_key, driver_number, parameters and data (JSON texts) and retrieved_at (SNK-01).

    A name says what the document holds, so a second write meets the first; with ``unique``
    it also holds a random part.  Keys that are null have no folder.
    """
    folder = lambda c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"/{c}="), F.col(c).cast("string"))).otherwise("")
    name = F.when(F.col("driver_number").isNotNull(), F.concat(F.lit("driver_"), F.col("driver_number").cast("string"))).when(F.col("session_key").isNotNull(), F.concat(F.lit("session_"), F.col("session_key").cast("string"))).otherwise(F.col("endpoint"))
    path: Column = F.concat(F.lit("endpoint="), F.col("endpoint"), folder("year"), folder("meeting_key"), folder("session_key"), F.lit("/"), name, *([F.lit("-"), F.replace(F.uuid(), F.lit("-"), F.lit(""))] if unique else []), F.lit(".json"))
    stamp = F.date_format("retrieved_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    doc = F.struct("endpoint", F.try_parse_json("parameters").alias("parameters"), stamp.alias("retrieved_at"), F.try_parse_json("data").alias("data"))
    return records.select(path.alias("path"), F.to_json(doc).alias("value"))


# --- versioned session tables ------------------------------------------------------------------

#: Folders of one version: sessions are dealt to them by hash, so files grow with a table and not in number.
PARTS = 256


def part_of(session: str) -> Column:
    """The folder of a session within a version."""
    return F.pmod(F.xxhash64(session), F.lit(PARTS)).cast("string")


def snapshots(root: str) -> list[int]:
    """The numbers of a table's snapshots, in order."""
    files, top = FileSystem.from_uri(root)
    found = files.get_file_info(FileSelector(f"{top}/current", allow_not_found=True))
    return sorted(int(f.base_name.removesuffix(".json")) for f in found if re.fullmatch(r"\d+\.json", f.base_name))


def _members(spark: SparkSession, root: str, number: int) -> DataFrame:
    """(p_session, p_version) of a snapshot."""
    files, top = FileSystem.from_uri(root)
    with files.open_input_stream(f"{top}/current/{number}.json") as f:
        return spark.read.schema("p_session string, p_version string").parquet(f"{root}/snapshots/{json.loads(f.read())['snapshot']}")


def replace_sessions(table: DataFrame, root: str, session: str = "session_key") -> int:
    """Replace the sessions that ``table`` holds, leave others, and return the new snapshot's number (SNK-02).

    Readers see the old snapshot until the new one's file appears.  Two writers at once
    cannot both take a number: the later one builds upon the other's and tries again.
    An empty table makes a snapshot equal to the last one.  A version's files lie in at most
    ``PARTS`` folders, each sorted by session.
    """
    spark, version = table.sparkSession, uuid.uuid4().hex
    named = table.withColumn("p_session", F.coalesce(F.col(session).cast("string"), F.lit("none")))
    dealt = named.withColumn("p_part", part_of("p_session")).repartition("p_part").sortWithinPartitions("p_part", "p_session")
    dealt.write.partitionBy("p_part").parquet(f"{root}/data/p_version={version}")  # a folder of its own, as writers share a folder's unfinished files
    new = keep(named.select("p_session", F.lit(version).alias("p_version")).distinct())
    while True:
        last = (snapshots(root) or [0])[-1]
        members = new if not last else new.unionByName(_members(spark, root, last).join(new.select("p_session"), "p_session", "left_anti"))
        name = uuid.uuid4().hex
        members.write.parquet(f"{root}/snapshots/{name}")
        if write_json(f"{root}/current/{last + 1}.json", json.dumps({"snapshot": name}).encode()):
            return last + 1


def read_sessions(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The sessions of the newest snapshot, or of snapshot ``number``.

    Files are chosen by a join on their folders, so versions that are being written or were
    replaced whole are pruned and never read; of a folder that holds some current sessions the
    rows of the others go by the same join.
    """
    known = snapshots(root)
    if not known:
        raise FileNotFoundError(f"{root} has no snapshot")
    stored = spark.read.option("partitionColumnTypeInference", "false").parquet(f"{root}/data").withColumns({c: F.col(c).cast("string") for c in ("p_part", "p_version")})
    members = _members(spark, root, number or known[-1]).where("p_version > ''").withColumn("p_part", part_of("p_session"))  # Catalyst prunes folders by a side that has a filter
    return stored.join(members, ["p_session", "p_version", "p_part"], "left_semi").drop("p_session", "p_version", "p_part")


def vacuum(spark: SparkSession, root: str, retain: int = 1) -> int:
    """Delete folders of which none of the last ``retain`` snapshots holds a session, and older snapshots; returns how many folders went.

    Readers of older snapshots and writers must have ended.  A folder of many sessions stays while
    one of them is held; writing what :func:`read_sessions` gives as new versions first frees all of it.
    """
    files, top = FileSystem.from_uri(root)
    known = snapshots(root)
    held = {(r.p_part, r.p_version) for n in known[-retain:] for r in _members(spark, root, n).select(part_of("p_session").alias("p_part"), "p_version").distinct().collect()}  # one entry a folder
    gone = [f.path for f in files.get_file_info(FileSelector(f"{top}/data", recursive=True)) if f.type == FileType.Directory and (m := re.search(r"/p_version=([^/]*)/p_part=([^/]*)\Z", f.path)) and m.groups()[::-1] not in held]
    for n in known[:-retain]:
        files.delete_file(f"{top}/current/{n}.json")
    for path in gone:
        files.delete_dir(path)
    return len(gone)
