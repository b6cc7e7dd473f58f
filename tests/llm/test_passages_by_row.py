"""Passages of rows that share an id or have none, and texts without them."""

from time import process_time

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tideline.llm import substring_dedup

SCHEMA = "doc_id long, text string, row string, h int, spans string"


def table(spark, tmp_path, rows):
    """Rows as a stored table of a few files."""
    spark.createDataFrame([(d, t, "r", 1, "s") for d, t in rows], SCHEMA).repartition(3).write.mode("overwrite").parquet(f"file://{tmp_path}/t")
    return spark.read.parquet(f"file://{tmp_path}/t")


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, 100_000, n))


@pytest.mark.parametrize("a,b", [(1, 2), (None, None), (1, 1), (1, None)])
def test_rows_hide_nothing_of_each_other(spark, tmp_path, a, b):
    """A line in A and 5, a run within longer lines in B and 6: four rows, whatever the ids of A and B."""
    line, run = prose(1, 110), prose(2, 60)
    rows = [(a, line), (b, f"{prose(3, 70)} {run} {prose(4, 70)}"), (5, line), (6, f"{prose(5, 75)} {run} {prose(6, 75)}")]
    docs = table(spark, tmp_path, rows)
    found = substring_dedup.every_passage(docs).collect()
    assert sorted(((r.doc_id, r.n_words >= 100) for r in found), key=repr) == sorted([(a, True), (b, False), (5, True), (6, False)], key=repr)
    assert sum(r.kept for r in found) == 2 and len({r.row for r in found}) == 4
    cleaned = substring_dedup.without_passages(docs, spark.createDataFrame(found))
    assert cleaned.columns == docs.columns and cleaned.count() == 4
    assert sum(len((r.text or "").split()) for r in cleaned.collect()) == sum(len(t.split()) for _, t in rows) - sum(r.n_words for r in found if not r.kept)


def test_texts_of_one_id_lose_only_their_own_passages(spark, tmp_path):
    p, q = prose(10, 80), prose(11, 80)
    docs = table(spark, tmp_path, [(5, p), (7, p), (7, q), (None, p), (None, None), (None, "")])
    found = substring_dedup.every_passage(docs)
    left = [(r.doc_id, r.text) for r in substring_dedup.without_passages(docs, found).collect()]
    assert sorted(left, key=repr) == sorted([(5, p), (7, ""), (7, q), (None, ""), (None, None), (None, "")], key=repr)


def test_spans_against_brute_force(spark, tmp_path):
    """Planted runs of 50 to 90 words: the marked words are those that both texts hold, but for a few at either end."""
    rng, rows, planted = np.random.default_rng(3), [], {}
    for g in range(10):
        run = prose(100 + g, int(rng.integers(55, 90))).split()
        for v in range(2):
            before, after = (prose(1000 + 10 * g + 2 * v + k, int(rng.integers(120, 200))).split() for k in range(2))
            rows.append((None if g % 3 == 0 else g % 2, " ".join([*before, *run, *after])))
            planted[rows[-1][1]] = set(run)
    rows += [(g, prose(5000 + g, 300)) for g in range(6)]
    docs = table(spark, tmp_path, rows)
    marked = {}
    texts = {r._row: r.text for r in docs.selectExpr("monotonically_increasing_id() AS _row", "text").collect()}
    for r in substring_dedup.every_passage(docs).collect():
        marked.setdefault(texts[r.row], set()).update(texts[r.row][r.start : r.start + r.n_chars].split())
    assert set(marked) == set(planted)  # clean rows are left alone, ids or not
    for text, run in planted.items():
        assert marked[text] <= run and len(run - marked[text]) <= 2 * 15


def test_a_very_long_text_and_many_rows_without_an_id(spark, tmp_path):
    line = prose(20, 60)
    long = "\n".join([prose(21, 60_000), line, prose(22, 60_000)])
    docs = table(spark, tmp_path, [(1, long)] + [(None, f"{prose(30 + i, 50)}\n{line}") for i in range(40)])
    found = substring_dedup.every_passage(docs).collect()
    assert len({r.row for r in found}) == 41 and sum(r.kept for r in found) == 1
    assert [r.doc_id for r in found if r.kept] == [1]


def test_pairs_of_a_busy_first_member_are_dealt_out(spark):
    texts = spark.createDataFrame([(i, bytearray(b"a b c d e f g h" if i % 2 else b"q r s t u v w %d" % i)) for i in range(300)], "pid long, text binary")
    pairs = spark.createDataFrame([(i, 1) for i in range(300) if i != 1] + [(4, 2)], "pid long, rep long")
    for limit in (7, 512):
        got = {(r.src, r.dst) for r in substring_dedup.verified_stars(pairs, texts, 2, 0.8, limit).collect()}
        assert got == {(i, 1) for i in range(3, 300, 2)}


def test_copies_and_rows_without_an_id_are_spread_over_blocks(spark, monkeypatch):
    """50,000 rows of one source, size and text without an id: no block holds more than a few times its share."""
    from tideline.llm import mixing

    held = []
    real = mixing.by_key
    monkeypatch.setattr(mixing, "by_key", lambda df: held.append(df.groupBy("key").count().collect()) or real(df))
    docs = spark.range(50_000).selectExpr("cast(null as long) AS doc_id", "'one two three' AS text", "'hot' AS source").unionByName(spark.range(100).selectExpr("id AS doc_id", "'a b' AS text", "'cold' AS source"))
    got = mixing.mix(docs).groupBy("source").sum("taken", "size").collect()
    most = {r.source: r for r in got}
    assert abs(most["hot"]["sum(taken)"] - 149_600) <= 3 and most["cold"]["sum(taken)"] == 600 and len(held[0]) >= 50_000 // mixing.BLOCK
    assert max(r["count"] for r in held[0]) < 2 * mixing.BLOCK


def banding(monkeypatch):
    """What a task of ``paragraph_bands`` runs on its batches of texts."""

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    monkeypatch.setattr(substring_dedup, "small_batches", lambda docs: docs)
    return substring_dedup.paragraph_bands(Docs(), 40, 5, 17, 4, 3, "text")


def test_bands_meet_as_often_as_their_similarity_says(spark, monkeypatch):
    """Of pairs at a known Jaccard similarity s, a share of s**4 of the bands is equal; case and white space are none of it."""
    run, share, want = banding(monkeypatch), [], []
    for g in range(150):
        words = prose(7000 + g, 90).split()
        other = [*words[: 60 + g % 20], *prose(9000 + g, 30 - g % 20).split()]
        texts = [" ".join(words), "  ".join(other).upper()]
        a, b = (set(substring_dedup.shingles(t.lower().encode().split(), 5)) for t in texts)
        got = pa.Table.from_batches(run(iter([pa.RecordBatch.from_pydict({"text": texts})])))
        first, second = got["band"].to_numpy().reshape(2, 17)
        share.append((first == second).mean())
        want.append((len(a & b) / len(a | b)) ** 4)
    assert abs(np.mean(share) - np.mean(want)) < 0.04


def test_banding_hashes_no_shingle_by_itself(spark, monkeypatch):
    """All of a task's banding takes less CPU time than making the shingles' texts and hashing each would."""
    run, texts = banding(monkeypatch), [prose(i, 100) for i in range(6000, 9000)]
    batch = pa.RecordBatch.from_pydict({"text": texts})

    def seconds(f):
        took = []
        for _ in range(3):
            begun = process_time()
            f()
            took.append(process_time() - begun)
        return min(took)

    each = seconds(lambda: [xxhash.xxh64_intdigest(s) for t in texts for s in substring_dedup.shingles(t.encode().split(b" "), 5)])
    assert seconds(lambda: sum(b.num_rows for b in run(iter([batch])))) < 0.9 * each
