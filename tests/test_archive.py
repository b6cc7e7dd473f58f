"""Writers that readers only see whole: killed tasks, crashed jobs, concurrent readers and writers."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from tideline.sources import archive, envelopes


@pytest.fixture
def documents(spark):
    spark.dataSource.register(archive.DocumentSink)
    rows = [("laps", 2023, 1, s, None, "{}", json.dumps([{"session_key": s}])) for s in range(12)] + [("car_data", 2023, 1, 3, 44, '{"driver_number":44}', "[]"), ("meetings", 2023, None, None, None, "{}", "[1]")]
    return spark.createDataFrame(rows, "endpoint string, year int, meeting_key long, session_key long, driver_number int, parameters string, data string").withColumn("retrieved_at", F.lit("2024-01-02 03:04:05").cast("timestamp"))


def test_documents_appear_under_names_that_say_what_they_hold(spark, documents, tmp_path):
    root = f"file://{tmp_path}/raw"
    archive.envelopes_of(documents).repartition(3).write.format("raw_documents").option("path", root).mode("append").save()
    found = envelopes.discover(spark, root)
    assert found.count() == 14 and {(r.endpoint, r.session_key, r.driver_number) for r in found.where("endpoint <> 'laps'").collect()} == {("car_data", 3, 44), ("meetings", None, None)}
    doc = json.loads((tmp_path / "raw/endpoint=laps/year=2023/meeting_key=1/session_key=4/session_4.json").read_text())
    assert doc == {"endpoint": "laps", "parameters": {}, "retrieved_at": "2024-01-02T03:04:05Z", "data": [{"session_key": 4}]}
    again = archive.envelopes_of(documents.withColumn("data", F.lit("[7]")))
    again.write.format("raw_documents").option("path", root).mode("append").save()
    assert json.loads((tmp_path / "raw/endpoint=meetings/year=2023/meetings.json").read_text())["data"] == [1]  # there already
    again.write.format("raw_documents").option("path", root).mode("overwrite").save()
    assert json.loads((tmp_path / "raw/endpoint=meetings/year=2023/meetings.json").read_text())["data"] == [7]
    archive.envelopes_of(documents, unique=True).write.format("raw_documents").option("path", root).mode("append").save()
    assert envelopes.discover(spark, root).count() == 28


@pytest.mark.parametrize("path", ["../x.json", "/abs.json", "a/../b.json", ".hidden/a.json", "a//b.json", None])
def test_paths_stay_below_the_root(spark, documents, tmp_path, path):
    with pytest.raises(Exception, match="not a plain path"):
        spark.createDataFrame([(path, "{}")], "path string, value string").write.format("raw_documents").option("path", f"file://{tmp_path}/raw").mode("append").save()
    assert not list(tmp_path.rglob("*.json"))


def test_a_task_that_dies_leaves_nothing_to_see(spark, documents, tmp_path):
    root = f"file://{tmp_path}/raw"
    many = archive.envelopes_of(documents).repartition(1).sortWithinPartitions("path")
    dies = many.withColumn("value", F.when(F.col("path").contains("session_9"), F.raise_error(F.lit("killed")).cast("string")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="killed"):
        dies.write.format("raw_documents").option("path", root).mode("append").save()
    assert envelopes.discover(spark, root).count() == 0 if (tmp_path / "raw").exists() else True
    # A driver that dies before the commit leaves staged files, which no reader lists.
    left = tmp_path / "raw/.staged/dead/0-1/endpoint=laps/year=2023"
    left.mkdir(parents=True)
    (left / "half.json").write_text("{")
    many.write.format("raw_documents").option("path", root).mode("append").save()
    assert envelopes.discover(spark, root).count() == 14 and envelopes.damaged(envelopes.discover(spark, root)).count() == 0


def test_free_folders_are_moved_whole_and_others_merged(tmp_path, monkeypatch):
    """Moves grow with folders whose names are taken, not with documents; append keeps what is there."""
    from pyarrow.fs import LocalFileSystem

    def tree(top, docs):
        for name, text in docs.items():
            (top / name).parent.mkdir(parents=True, exist_ok=True)
            (top / name).write_text(text)

    moved, publish = [], archive.publish
    monkeypatch.setattr(archive, "publish", lambda files, *a: moved.append(a) or publish(files, *a))
    tree(tmp_path / "s1", {f"e=1/k={k}/a.json": "one" for k in range(40)})
    tree(tmp_path / "s2", {f"e=1/k={k}/a.json": "two" for k in range(38, 60)} | {"e=1/k=38/b.json": "two", "f.json": "two"})
    (tmp_path / "to/e=1/k=5").mkdir(parents=True)
    for s in ("s1", "s2"):
        archive.publish_tree(LocalFileSystem(), str(tmp_path / s), str(tmp_path / "to"), False)
    found = {str(p.relative_to(tmp_path / "to")): p.read_text() for p in (tmp_path / "to").rglob("*.json")}
    assert found == {f"e=1/k={k}/a.json": "one" if k < 40 else "two" for k in range(60)} | {"e=1/k=38/b.json": "two", "f.json": "two"}
    assert len(moved) == 4  # two that were there, one beside them, and one at the top
    tree(tmp_path / "s3", {"e=1/k=0/a.json": "three"})
    archive.publish_tree(LocalFileSystem(), str(tmp_path / "s3"), str(tmp_path / "to"), True)
    assert (tmp_path / "to/e=1/k=0/a.json").read_text() == "three"


def test_a_small_document_is_whole_and_once(tmp_path):
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append(archive.write_json(f"file://{tmp_path}/x/one.json", b"%d" % i * 1000))) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert won.count(True) == 1 and len((tmp_path / "x/one.json").read_bytes()) == 1000 and [p.name for p in (tmp_path / "x").iterdir()] == ["one.json"]


def rows(spark, sessions, value, n=50):
    return spark.range(n * len(sessions)).select(F.element_at(F.array(*map(F.lit, sessions)), (F.col("id") % len(sessions) + 1).cast("int")).alias("session_key"), F.lit(value).alias("v"), "id")


def told(df):
    return {(r.session_key, r.v): r.n for r in df.groupBy("session_key", "v").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_a_reader_sees_the_old_or_the_new_sessions_whole(spark, tmp_path):
    root = f"file://{tmp_path}/table"
    with pytest.raises(FileNotFoundError):
        archive.read_sessions(spark, root)
    assert archive.replace_sessions(rows(spark, [1, 2, 3], "a"), root) == 1
    old = archive.read_sessions(spark, root)
    seen, done = [], threading.Event()

    def read():
        while not done.is_set():
            seen.append(told(archive.read_sessions(spark, root)))

    reader = threading.Thread(target=read)
    reader.start()
    assert archive.replace_sessions(rows(spark, [2, 9], "b"), root) == 2
    done.set()
    reader.join()
    before, after = {(s, "a"): 50 for s in (1, 2, 3)}, {(1, "a"): 50, (3, "a"): 50, (2, "b"): 50, (9, "b"): 50}
    assert seen and all(s in (before, after) for s in seen)
    assert told(archive.read_sessions(spark, root)) == after and told(old) == before == told(archive.read_sessions(spark, root, 1))
    plan = archive.read_sessions(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan  # replaced versions are not read


def test_a_crashed_writer_and_two_writers(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/table"
    archive.replace_sessions(rows(spark, [1], "a"), root)
    monkeypatch.setattr(archive, "write_json", lambda *_: (_ for _ in ()).throw(OSError("crash")))
    with pytest.raises(OSError):
        archive.replace_sessions(rows(spark, [1], "lost"), root)
    monkeypatch.undo()
    assert told(archive.read_sessions(spark, root)) == {(1, "a"): 50}
    writers = [threading.Thread(target=archive.replace_sessions, args=(rows(spark, [s], "w"), root)) for s in (5, 6)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert archive.snapshots(root) == [1, 2, 3] and told(archive.read_sessions(spark, root)) == {(1, "a"): 50, (5, "w"): 50, (6, "w"): 50}
    archive.replace_sessions(rows(spark, [5], "x").limit(0), root)
    assert archive.vacuum(spark, root) == 1 and archive.snapshots(root) == [4]
    assert told(archive.read_sessions(spark, root)) == {(1, "a"): 50, (5, "w"): 50, (6, "w"): 50}


def test_files_do_not_grow_with_the_number_of_sessions(spark, tmp_path):
    """Sessions share folders; of a folder some of whose sessions were replaced only the others' rows are read."""
    root = f"file://{tmp_path}/table"
    table = lambda n, v: spark.range(n).select(F.when(F.col("id") > 0, F.col("id")).alias("session_key"), F.lit(v).alias("v"))
    archive.replace_sessions(table(1500, "a"), root)
    assert len(list(tmp_path.rglob("*.parquet"))) < 2 * archive.PARTS
    archive.replace_sessions(table(1500, "b").where("session_key % 5 = 0 or session_key is null"), root)
    want = {(None if i == 0 else i, "b" if i % 5 == 0 else "a"): 1 for i in range(1500)}
    assert told(archive.read_sessions(spark, root)) == want
    archive.vacuum(spark, root)
    assert told(archive.read_sessions(spark, root)) == want
    archive.replace_sessions(archive.read_sessions(spark, root), root)
    before = len(list(tmp_path.rglob("p_part=*")))
    gone = archive.vacuum(spark, root)  # what was replaced goes once all is written anew
    assert gone == before - len(list(tmp_path.rglob("p_part=*"))) and len(list(tmp_path.rglob("p_version=*/p_part=*"))) <= archive.PARTS
    assert told(archive.read_sessions(spark, root)) == want


def test_copies_keep_their_keys_and_report_each_error(spark, documents, tmp_path):
    from tideline.sources import sinks

    source, target = f"file://{tmp_path}/raw", f"file://{tmp_path}/lake"
    archive.envelopes_of(documents).write.format("raw_documents").option("path", source).mode("append").save()
    blocked = tmp_path / "lake/raw/year=2023/meeting=1/session=3"
    blocked.parent.mkdir(parents=True)
    blocked.write_text("a file where a folder must be")
    found = {r.target: r for r in sinks.copy_documents(spark, source, target, "lake").collect()}
    failed = [r for r in found.values() if r.status == "failed"]
    assert len(found) == 14 and len(failed) == 2 and all("session=3" in r.target and r.error for r in failed)
    blocked.unlink()
    assert {r.target for r in sinks.copy_documents(spark, source, target, "lake").collect() if r.status == "copied"} == {r.target for r in failed}
    there = envelopes.discover(spark, target)
    keys = ["endpoint", "year", "meeting_key", "session_key", "driver_number", "value"]
    assert sorted(map(str, there.select(keys).collect())) == sorted(map(str, envelopes.discover(spark, source).where("year is not null").select(keys).collect()))
    (tmp_path / "lake/raw/year=2023/endpoint=meetings/meetings.json").unlink()
    again = {r.target: r.status for r in sinks.copy_documents(spark, source, target, "lake").collect()}
    assert [t for t, s in again.items() if s == "copied"] == ["raw/year=2023/endpoint=meetings/meetings.json"]
    back = sinks.copy_documents(spark, target, f"file://{tmp_path}/same")
    assert {r.status for r in back.collect()} == {"copied"} and sorted(r.file.split("/lake/")[1] for r in back.collect()) == sorted(r.file.split("/same/")[1] for r in envelopes.discover(spark, f"file://{tmp_path}/same").collect())
    files = [r.file for r in envelopes.listed(there).collect()]
    assert files == sorted(files) and len(files) == 14


def test_a_session_scope_brings_its_catalogues(spark):
    rows = [("laps", 2023, 1, 7), ("laps", 2023, 1, 8), ("meetings", 2023, None, None), ("meetings", 2022, None, None), ("sessions", 2023, 1, None), ("sessions", 2023, 2, None)]
    docs = spark.createDataFrame(rows, "endpoint string, year int, meeting_key long, session_key long")
    got = sorted(map(tuple, envelopes.in_scope(docs, envelopes.Scope(2023, 1, 7)).collect()))
    assert got == [("laps", 2023, 1, 7), ("meetings", 2023, None, None), ("sessions", 2023, 1, None)]
    assert envelopes.in_scope(docs, envelopes.Scope(2023)).count() == 5 and envelopes.in_scope(docs, envelopes.Scope()).count() == 6


def test_plans_and_fingerprints(spark, tmp_path):
    from tideline.plans import incremental

    units = spark.createDataFrame([(2024, 9), (2023, 7)], "year int, session_key int")
    assert incremental.write_plan(units, f"file://{tmp_path}/plan.json") == 2
    assert json.loads((tmp_path / "plan.json").read_text()) == {"units": [{"session_key": 7, "year": 2023}, {"session_key": 9, "year": 2024}]}
    a, ignored = {"scan": {"years": [1], "kinds": ["x"]}, "check": {"most": 5}}, {"scan": {"years", "overwrite"}}
    same = {"check": {"most": 5}, "scan": {"kinds": ["x"], "overwrite": True, "years": [2]}}
    assert incremental.config_fingerprint(a, ignored) == incremental.config_fingerprint(same, ignored) != incremental.config_fingerprint({**a, "check": {"most": 6}}, ignored)
