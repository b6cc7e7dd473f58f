"""Importance resampling, the radix sort, centroid clustering and token files against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm import centroids, radix_sort, resampling, token_files
from tideline.llm.queries import oracle_sql
from tideline.llm.tokens import tokenizer_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, row long, id string, score string, pos int, name string, base int, tie int"
AWKWARD = [
    (5, "Alpha BETA gamma, delta-42 " * 9), (6, None), (7, ""), (8, "one"), (9, "two words"), (None, "x y z " * 8), (None, "é中文字 ÀB Straße " * 12), (5, "Alpha BETA gamma, delta-42 " * 9),
    (5, "another text under the same id " * 5), (-3, "-- .. !!"), (1 << 62, "w" * 200 + " tail " + "q" * 70 + " end " * 30), (12, "<|endoftext|> a\x00b\n\n\tc " * 10), (13, "long " * 60_000), (-(1 << 62), "A a " * 15),
]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "i", "s", 2, "n", 3, 4) for r in rows], SCHEMA)


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def buckets_of(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def resampled(docs, target, percent=5):
    """(doc_id, n_features, weight, score, rank) by plain Python; ties by id, rows without one last."""
    s, t = Counter(b for _, x in docs for b in buckets_of(x)), Counter(b for x in target for b in buckets_of(x))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + 10_000) / ((s[b] + 1) * (sum(t.values()) + 10_000)))) for b in range(10_000)]
    rows = []
    for doc, text in docs:
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets_of(text))
        rows.append([doc, len(buckets_of(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


@pytest.mark.parametrize("percent", [5, 60, 100])
def test_resampling(spark, percent):
    target = ["alpha beta gamma", None, "", "Straße words two", "long long long"]
    got = resampling.importance_resample(table(spark, AWKWARD), table(spark, enumerate(target)), percent)
    assert sorted(map(tuple, got.collect()), key=repr) == resampled(AWKWARD, target, percent)


def test_resampling_of_the_table_and_of_empty_ones(spark):
    docs, target = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    plain = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = resampling.importance_resample(docs, target)
    assert sorted(map(tuple, got.collect()), key=repr) == resampled(plain, [r.text for r in target.collect()])
    assert resampling.importance_resample(docs.limit(0), target).count() == 0
    alone = resampling.importance_resample(docs, target.limit(0)).collect()
    assert sorted(map(tuple, alone), key=repr) == resampled(plain, [])


def test_features_of_chunks_equal_those_of_the_whole(monkeypatch):
    texts = [(t or "").encode() for _, t in AWKWARD]
    of = lambda: Counter((int(i), int(b)) for _, of, bucket in resampling.features(texts, 3, 10_000) for i, b in zip(of, bucket))
    whole = of()
    assert whole == Counter((i, b) for i, (_, t) in enumerate(AWKWARD) for b in buckets_of(t))
    monkeypatch.setattr(resampling, "CHUNK", 7)
    short = texts[:12]
    texts = short
    assert of() == Counter({k: n for k, n in whole.items() if k[0] < 12})


def test_checksums_of_long_appendices():
    parts = [b"", b"a", b"word", b"x" * 63, b"x" * 64, b"x" * 65, b"y" * 1000, b"z" * 100_001]
    crc = np.array([zlib.crc32(b"front") for _ in parts], np.uint32)
    got = resampling.shifted(crc, np.array([len(p) for p in parts])) ^ np.array([zlib.crc32(p) for p in parts], np.uint32)
    assert got.tolist() == [zlib.crc32(b"front" + p) for p in parts]


@pytest.mark.parametrize("bits,block", [(3, 2), (12, 16)])
def test_radix_sort_is_stable_and_unsigned(spark, bits, block):
    rng = np.random.default_rng(4)
    rows = [(i, int(a), int(b)) for i, (a, b) in enumerate(zip(rng.integers(0, 5, 300), rng.choice([0, 1, 70, -1, -(1 << 63), (1 << 63) - 1], 300)))]
    df = spark.createDataFrame(rows, "row long, a long, b long").repartition(5)
    got = {r.row: r.pos for r in radix_sort.radix_sorted(df, ["a", "b"], bits=bits, block=block).collect()}
    want = sorted(rows, key=lambda r: (r[1], r[2] % (1 << 64), r[0]))
    assert got == {r[0]: i for i, r in enumerate(want)}
    same = spark.createDataFrame([(i, 7) for i in range(50)], "row long, a long")
    assert {r.row: r.pos for r in radix_sort.radix_sorted(same, ["a"], bits=bits, block=block).collect()} == {i: i for i in range(50)}
    assert radix_sort.radix_sorted(same.limit(0), ["a"]).count() == 0


def test_no_task_sorts_more_than_a_block(spark):
    """One score for all rows: each (digit, block) still holds a block at most."""
    rows = spark.range(4000).select(F.col("id").alias("row"), F.lit(3).cast("long").alias("a"))
    moved = radix_sort.radix_sorted(rows, ["a"], bits=4, block=8)
    assert moved.where("row = pos").count() == 4000
    assert rows.groupBy(F.shiftright("row", 8)).count().agg(F.max("count")).first()[0] <= 256


VECTORS = "vec_id long, embedding array<float>, label int, cluster string, v string, distance int, n int, sums int"


def clustered(rows, k=16, rounds=3):
    """(vec_id, cluster, distance) and centroids by plain Python."""
    ok = lambda e: e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)
    kept = [(i, [math.floor(64 * x) for x in e]) for i, e in rows if ok(e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    c = [v for _, v in order[:k]]
    near = lambda v: min((sum((x - y) ** 2 for x, y in zip(v, m)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        c = [[sum(col) // len(col) for col in zip(*mine)] if (mine := [v for (_, v), a in zip(kept, of) if a == j]) else m for j, m in enumerate(c)]
    return sorted(((i, *near(v)[::-1]) for i, v in kept), key=repr), c


def odd_vectors():
    rng = np.random.default_rng(2)
    one = rng.standard_normal(64).astype(np.float32)
    rows = [(i, (rng.standard_normal(64) * (1 + i % 3) + i % 5).astype(np.float32).tolist()) for i in range(120)]
    rows += [(200 + i, one.tolist()) for i in range(30)] + [(200, one.tolist()), (None, one.tolist()), (None, rows[3][1])]  # copies, a repeated id, no id
    rows += [(300, [0.0] * 64), (301, [-0.0] * 64), (302, np.roll(one, 1).tolist()), (303, [1000.0] * 64), (304, [-1000.0] * 64)]
    return rows + [(400, None), (401, []), (402, [1.0] * 63), (403, [1.0] * 65), (404, [float("nan")] + [1.0] * 63), (405, [float("-inf")] + [1.0] * 63), (406, [None] + [1.0] * 63), (407, [3e9] + [0.0] * 63)]


def test_clustering(spark):
    rows = odd_vectors()
    table = spark.createDataFrame([(i, e, 1, "c", "v", 1, 2, 3) for i, e in rows], VECTORS).repartition(3)
    assigned, found = centroids.cluster(table)
    want, c = clustered([r for r in rows if r[0] != 407])  # beyond what a long's distances hold: left out
    assert sorted(map(tuple, assigned.collect()), key=repr) == want and found == c
    told = {r.cluster: r for r in centroids.with_inertia(assigned, found).collect()}
    for j, r in told.items():
        assert r.cluster_inertia == sum(d for _, a, d in want if a == j) and r.inertia == sum(d for *_, d in want)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()


def test_clustering_of_few_and_none(spark):
    few = odd_vectors()[:5]
    table = spark.createDataFrame([(i, e, 1, "c", "v", 1, 2, 3) for i, e in few], VECTORS)
    assigned, found = centroids.cluster(table)
    want, c = clustered(few)
    assert sorted(map(tuple, assigned.collect()), key=repr) == want and found == c and len(c) == 5
    none, left = centroids.cluster(table.limit(0))
    assert none.count() == 0 and left == [] and centroids.with_inertia(none, left).count() == 0


def test_clustering_equals_its_sql_on_ties_and_copies(spark):
    rows = [(i, e) for i, e in odd_vectors() if i != 407]
    con = duckdb.connect()
    con.register("embeddings", pa.table({"vec_id": pa.array([i for i, _ in rows], pa.int64()), "embedding": pa.array([e for _, e in rows], pa.list_(pa.float32()))}))
    table = spark.createDataFrame([(i, e, 1, "c", "v", 1, 2, 3) for i, e in rows], VECTORS)
    got = centroids.with_inertia(*centroids.cluster(table)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(con.sql(oracle_sql()["op12_centroid_clustering"]).fetchall(), key=repr)


def test_search_is_exact_and_rejects_most_centroids():
    rng = np.random.default_rng(3)
    c = (rng.standard_normal((200, 64)) * 20 + np.linspace(-300, 300, 200)[:, None]).astype(np.int64)
    v = (c[rng.integers(0, 200, 3000)] + rng.integers(-9, 10, (3000, 64))).astype(np.int64)
    who, best, computed = centroids.nearest_centroids(v, c)
    every = np.square(v[:, None, :] - c[None]).sum(2)
    assert (best == every.min(1)).all() and (who == every.argmin(1)).all() and computed < 0.2 * every.size
    wide = np.full((2, 64), centroids.LARGEST)
    wide[1] *= -1
    assert centroids.nearest_centroids(wide[:1], wide[1:])[1].tolist() == [64 * (2 * centroids.LARGEST) ** 2]


def coded(text):
    return np.array([*Tokenizer.from_file(str(tokenizer_path("byte_bpe_50k.json"))).encode(text or "", add_special_tokens=False).ids, 2], "<u4")


@pytest.mark.parametrize("shards", [1, 4])
def test_token_files_round_trip(spark, tmp_path, shards):
    folder = f"file://{tmp_path}/files"
    told = token_files.write_tokens(table(spark, AWKWARD), folder, shards=shards).orderBy("shard").collect()
    assert sum(r.n_docs for r in told) == len(AWKWARD) and {r.width for r in told} == {2}
    got = sorted(token_files.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in AWKWARD), key=lambda d: (d is not None, d or 0))
    place = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (place, len(r.ids) // 4, zlib.crc32(r.ids))
        place += r.n_tokens
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == Counter((d, coded(t).tobytes()) for d, t in AWKWARD)
    # Any document by memory map, from the manifest alone.
    for s in told:
        offsets = token_files.part(f"{folder}/{s.name}.offsets", "<i8", 0, s.n_docs + 1)
        ids = token_files.part(f"{folder}/{s.name}.ids", "<u2", 0, s.n_tokens)
        assert isinstance(ids, np.memmap) and offsets[-1] == s.n_tokens
        at = [r for r in got if r.start == s.base + offsets[0]][0]
        assert ids[: offsets[1]].astype("<u4").tobytes() == bytes(at.ids)
    assert token_files.read_tokens(spark, folder, with_ids=False).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_token_files_of_an_empty_table_and_wide_ids(spark, tmp_path):
    docs = table(spark, AWKWARD[:4])
    assert token_files.write_tokens(docs.limit(0), f"file://{tmp_path}/none").count() == 0
    assert token_files.read_tokens(spark, f"file://{tmp_path}/none").count() == 0
    token_files.write_tokens(docs, f"file://{tmp_path}/wide", end_id=1 << 20, shards=2)
    got = sorted(token_files.read_tokens(spark, f"file://{tmp_path}/wide").collect(), key=lambda r: r.start)
    assert [np.frombuffer(r.ids, "<u4")[-1] for r in got] == [1 << 20] * 4
    with pytest.raises(Exception, match="exist"):
        token_files.write_tokens(docs, f"file://{tmp_path}/wide", shards=2)


def test_files_of_lost_attempts_are_not_read(spark, tmp_path):
    """A manifest names the files of attempts that ended; others may lie beside them."""
    folder = f"file://{tmp_path}/files"
    token_files.write_tokens(table(spark, AWKWARD), folder, shards=2)
    before = sorted(map(tuple, token_files.read_tokens(spark, folder, with_ids=False).collect()), key=repr)
    for kind in ("ids", "offsets", "docs"):
        (tmp_path / "files" / f"000000-999-dead.{kind}").write_bytes(b"\x01" * 24)
    assert sorted(map(tuple, token_files.read_tokens(spark, folder, with_ids=False).collect()), key=repr) == before
