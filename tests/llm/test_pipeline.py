"""The corpus pipeline stage by stage, on a small corpus whose outcome is known."""

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from tideline.llm.common import keep

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*corpus_pipeline.COLUMNS)


def extra(spark):
    secret = 'here token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" stands among the words of this text'
    return spark.createDataFrame([(9000, None, "en", "src0", 0), (9001, "123 !!", "en", "src0", 6), (9002, secret, "en", None, 80), (9003, secret, "en", None, 80), (9003, secret, "en", None, 80), (None, "some text that has no id at all", "en", "src1", 31)], SCHEMA)


def test_stages(spark, corpus):
    docs = corpus.unionByName(extra(spark))
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, "unused"))
        after[name] = docs
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    ids = {n: {r.doc_id for r in d.select("doc_id").distinct().collect()} for n, d in after.items()}
    assert not {9000, 9001} & ids["language"] and {9002, 9003, None} <= ids["language"]
    assert ids["language"] >= {r.doc_id for r in corpus.where("text rlike '[a-z]'").collect()}
    assert 9002 in ids["near_duplicates"] and 9003 not in ids["near_duplicates"] and None in ids["near_duplicates"]
    texts = after["near_duplicates"].groupBy("text").count().where("count > 1")
    assert texts.count() == 0 and ids["secrets"] == ids["near_duplicates"]
    masked = after["secrets"].where("doc_id = 9002").first()
    assert "[SECRET]" in masked.text and "24be" not in masked.text and masked.n_chars == len(masked.text)
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    before = {r.source: r.n for r in after["secrets"].groupBy("source").agg(F.sum(words).alias("n")).collect()}
    mixed = {r.source: r.n for r in after["mixture"].groupBy("source").agg(F.sum(words).alias("n")).collect()}
    assert sum(mixed.values()) == pytest.approx(sum(before.values()), rel=0.1)
    assert all(mixed.get(s, 0) <= 3 * n for s, n in before.items())
    lengths = np.array([r.length for r in after["packing"].select("length").collect()])
    assert (lengths & (lengths - 1) == 0).all() and lengths.max() <= 2048


def test_unlearned_languages_go(spark, corpus):
    known = ["the house stands by the river and the old men walk", "Wir gehen heute nach Hause", "some text that has no id at all", "key 24be64439e3e49cf46b2d7c90f3602a3d0b907ff stands among the words"]
    unknown = ["Вчера вечером мы долго гуляли по берегу реки и говорили о доме", "昨天晚上我们在河边散步聊天", "xq7zk vjw9q pzx kqjv wq8 zzxv qkj vvqx zkq jqw", "I går kveld gikk vi lenge langs elva og snakket om huset vårt"]
    docs = corpus.unionByName(spark.createDataFrame([(8000 + i, t, None, "src0", len(t)) for i, t in enumerate(known + unknown)], SCHEMA))
    ids = {r.doc_id for r in corpus_pipeline.language(spark, docs, "unused").where("doc_id >= 8000").collect()}
    assert ids == {8000 + i for i in range(len(known))}


def test_near_copies_go(spark):
    rng, rows = np.random.default_rng(8), []
    for g in range(40):
        base = [f"w{x}" for x in rng.integers(0, 5000, 200)]
        for v in range(4):  # copies with up to 3 words changed, and an unrelated one
            words = list(base) if v < 3 else [f"w{x}" for x in rng.integers(0, 5000, 200)]
            for at in rng.choice(200, v if v < 3 else 0, replace=False):
                words[at] = "changed"
            rows.append((g * 10 + v, " ".join(words), "en", "src0", 0))
    sets = {d: set(zip(*(t.split()[i:] for i in range(5)))) for d, t, *_ in rows}
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    want = {d for d in sets if not any(near(d, e) for e in sets if e < d)}
    assert len(want) == 80
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "unused").collect()} == want


def test_empty_corpus(spark, corpus):
    docs = corpus.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, "unused"))
    assert docs.count() == 0


def test_rows_without_ids_and_repeated_ids(spark):
    """Rows count by themselves: different texts under no id or one id all stay, copies go."""
    words = lambda s: " ".join(f"w{x}" for x in np.random.default_rng(s).integers(0, 5000, 60))
    rows = [(None, words(i), "en", "src0", 0) for i in range(6)] + [(None, words(0).upper(), "en", "src0", 0), (7, words(20), "en", "src0", 0), (7, words(21), "en", "src0", 0), (3, words(21), "en", "src0", 0), (7, words(21), "en", "src0", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = corpus_pipeline.near_duplicates(spark, docs, "unused").collect()
    assert sorted((str(r.doc_id), r.text.lower()) for r in kept) == sorted([("None", words(i)) for i in range(6)] + [("7", words(20)), ("3", words(21))])
    mixed = corpus_pipeline.mixture(spark, spark.createDataFrame(rows[:6], SCHEMA), "unused")
    assert sorted(r.text for r in mixed.collect()) == sorted(words(i) for i in range(6))
