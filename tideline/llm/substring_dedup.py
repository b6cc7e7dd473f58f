"""Repeated passages by MinHash banding of paragraphs.

Paragraphs are lines of usual length; short lines in a row and long lines are cut
into paragraphs at words that content picks.  Equal paragraphs are one; the MinHash
signature of each distinct paragraph is cut into bands, tuned so that a pair at the
threshold shares a band almost surely.  Paragraphs that meet in a band are verified
by the exact Jaccard similarity of their shingles, links form components, and of
each component the first paragraph by document and place is kept.

A passage may also end anywhere within paragraphs.  Its equal runs of words are
found on overlapping units of the whole text that start at the words which content
picks: equal units are one, and those that repeat are merged to spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import Forest, among, block_pairs, by_key, connected_components, keep, pairs_in_runs, small_batches, whole_groups
from tideline.sources.scratch import settled


def bands_needed(rows: int, similarity: float, recall: float) -> int:
    """Bands of ``rows`` hashes in which a pair at ``similarity`` meets with probability ``recall``."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))


def shingles(words: list[bytes], k: int) -> list[bytes]:
    """All runs of ``k`` words; the whole sequence if it is shorter."""
    return list(map(b" ".join, zip(*(words[i:] for i in range(k))))) if len(words) > k else [b" ".join(words)]


#: Words of the shortest and the longest line that is a paragraph, and shingles on
#: either side among which a cut has the smallest hash.
LEAST, MOST, SIDE = 40, 120, 40


def sliding_least(h: np.ndarray, n: int) -> np.ndarray:
    """The least of each ``n`` values in a row."""
    size = 1
    while 2 * size <= n:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (n - size)], h[n - size :]) if n > size else h


def sliding_places(h: np.ndarray, n: int) -> np.ndarray:
    """The place of the least of each ``n`` values in a row, of equal ones the first; places never fall."""

    at, size = np.arange(len(h)), 1
    while size < n:
        step = min(size, n - size)
        at = np.where(h[step:] < h[:-step], at[step:], at[:-step])
        h = np.minimum(h[:-step], h[step:])
        size += step
    return at


def paragraph_cuts(texts: list[bytes], least: int) -> tuple[np.ndarray, ...]:
    """(text, first word's number, first byte, byte past the end, words, whole line) of the paragraphs.

    A line of ``least`` to MOST words is a paragraph.  What lies between such
    lines, short lines in a row and long ones, is cut where content says so: before
    a shingle whose hash is the smallest of SIDE on either side, so that equal
    stretches are cut alike wherever they stand.  Pieces under ``least`` words,
    which only ends of a stretch can be, are no paragraphs.
    """
    lex = lexed(texts)
    _, begin, first, past, of, _ = lex
    s, e, whole = cut_words(lex, least)
    base = np.searchsorted(first, begin)
    return of[s], s - base[of[s]], first[s] - begin[of[s]], past[e - 1] - begin[of[s]], e - s, whole


def cut_words(lex: tuple[np.ndarray, ...], least: int) -> tuple[np.ndarray, ...]:
    """(first word, word past the end, whole line) of the paragraphs of texts that are :func:`lexed`."""
    b, _, first, _, of, word = lex
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    line = np.cumsum(np.bincount(np.searchsorted(first, np.flatnonzero(b == 10)), minlength=len(first)))[: len(first)]
    opens = np.r_[True, (line[1:] != line[:-1]) | (of[1:] != of[:-1])]
    at = np.flatnonzero(opens)
    size = np.diff(np.r_[at, len(first)])
    whole = (size >= least) & (size <= MOST)
    is_whole = np.repeat(whole, size)
    starts = opens & is_whole | np.r_[True, (is_whole[1:] != is_whole[:-1]) | (of[1:] != of[:-1])]
    n = len(first) - PICK + 1
    if n > 2 * SIDE:
        i = np.arange(n)
        h = range_hashes(word, i, i + PICK, _BASES[1])
        low = sliding_least(h, SIDE)
        mid = np.arange(SIDE, n - SIDE)
        mid = mid[(h[mid] < low[mid - SIDE]) & (h[mid] <= low[mid + 1])]
        stretch = np.cumsum(starts)
        starts[mid[(stretch[mid - SIDE] == stretch[mid + SIDE + PICK - 1]) & ~is_whole[mid]]] = True
    s = np.flatnonzero(starts)
    e = np.r_[s[1:], len(first)]
    long = e - s >= least
    s, e = s[long], e[long]
    return s, e, is_whole[s]


def in_characters(b: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
    """Places in bytes as places in characters."""
    if b.max(initial=0) < 128:
        return list(places)
    chars = np.r_[0, np.cumsum((b & 0xC0) != 0x80)]
    return [chars[p] for p in places]


def plain_forms(lex: tuple[np.ndarray, ...], s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """64-bit digests of the paragraphs of words ``s`` to ``e`` and their texts, lower-cased (A-Z) with single spaces."""
    b, _, first, past, _, _ = lex
    low, odd = b.tobytes(), np.zeros(len(first), np.int64)
    np.cumsum((first[1:] != past[:-1] + 1) | (b[past[:-1]] != 32), out=odd[1:])
    is_plain = odd[e - 1] == odd[s]
    plains = [low[x:y] if p else b" ".join(low[x:y].split()) for x, y, p in zip(first[s].tolist(), past[e - 1].tolist(), is_plain.tolist())]
    return np.frombuffer(b"".join([hashlib.blake2b(x, digest_size=8).digest() for x in plains]), "<i8"), plains


def line_edges(lex: tuple[np.ndarray, ...], s: np.ndarray, e: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, ...]:
    """The line in which each paragraph starts, counted in its text, and in the joined bytes its
    first one and the one past it, which for whole lines are those of the line."""
    b, begin, first, past, of, _ = lex
    ends, mine = np.flatnonzero(b == 10), begin[of[s]]
    line, edges = np.searchsorted(ends, first[s]), np.r_[-1, ends, len(b)]
    close = np.r_[begin[1:] - 1, len(b)][of[s]]
    lo, hi = np.maximum(edges[line] + 1, mine), np.minimum(edges[line + 1], close)
    return line - np.searchsorted(ends, mine), np.where(whole, lo, first[s]), np.where(whole, hi, past[e - 1])


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, text): rows by their place, which is the same each time that a stored table is read."""
    return small_batches(docs).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def paragraphs(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, paragraph, start, n_chars, n_words, pid): ``paragraph`` is the
    line in which it starts, ``pid`` the digest of its plain form."""
    names = ["row", "doc_id", "paragraph", "start", "n_chars", "n_words", "pid"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_groups(batches):
            lex = lexed(texts)
            s, e, whole = cut_words(lex, min_words)
            if len(s):
                of = lex[4][s]
                line, lo, hi = line_edges(lex, s, e, whole)
                begin, start, end = in_characters(lex[0], lex[1][of], lo, hi)
                key = [pa.array([k[i] for k in keys], pa.int64()).take(pa.array(of)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*key, *map(pa.array, (line, start - begin, end - start, e - s, plain_forms(lex, s, e)[0]))], names)

    return numbered(docs, id_col, text_col).mapInArrow(run, ", ".join(f"{c} long" for c in names))


def plain_paragraphs(lex: tuple[np.ndarray, ...], least: int, seen: set[int], held: int = 250_000) -> tuple[np.ndarray, ...]:
    """(digests, first words, words past the end, plain forms) of the paragraphs that are not in ``seen``,
    which holds some of those that this task has met, so that copies rarely come twice."""
    s, e, _ = cut_words(lex, least)
    pids, plains = plain_forms(lex, s, e)
    new = []
    for i, pid in enumerate(pids.tolist()):
        if pid not in seen:
            if len(seen) >= held:
                seen.clear()
            seen.add(pid)
            new.append(i)
    at = np.array(new, np.int64)
    return pids[at], s[at], e[at], [plains[i] for i in new]


def some_at_once(found: Iterator[tuple[int, bytes]], most: int = 2_000_000, rows: int = 500) -> Iterator[tuple[list[int], list[bytes]]]:
    """Paragraphs in lists of bounded size."""
    pids, plains, held = [], [], 0
    for pid, plain in found:
        pids.append(pid)
        plains.append(plain)
        held += len(plain)
        if held > most or len(pids) == rows:
            yield pids, plains
            pids, plains, held = [], [], 0
    if pids:
        yield pids, plains


def paragraph_texts(docs: DataFrame, min_words: int, text_col: str, wanted: DataFrame) -> DataFrame:
    """(pid, text), once each, of paragraphs with the pids of ``wanted`` and of few others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for _, texts in text_groups(batches):
            found, _, _, plain = plain_paragraphs(lexed(texts), min_words, seen)
            for pids, plains in some_at_once(zip(found.tolist(), plain)):
                yield pa.RecordBatch.from_arrays([pa.array(pids, pa.int64()), pa.array(plains, pa.binary())], ["pid", "text"])

    every = small_batches(docs).select(F.col(text_col).alias("text")).mapInArrow(run, "pid long, text binary")
    return among(every, wanted, "pid", scattered=True).groupBy("pid").agg(F.max("text").alias("text"))


def text_groups(batches: Iterator[pa.RecordBatch], most: int = 500_000) -> Iterator[tuple[list[tuple], list[bytes]]]:
    """The leading columns and the last one, texts as bytes (null: empty), of some rows of bounded size at once."""
    for batch in batches:
        keys, texts, held = [], [], 0
        leading = list(zip(*(c.to_pylist() for c in batch.columns[:-1]))) or [()] * batch.num_rows
        for key, text in zip(leading, batch.columns[-1].cast(pa.binary())):
            keys.append(key)
            texts.append(text.as_py() or b"")
            held += len(texts[-1])
            if held > most:
                yield keys, texts
                keys, texts, held = [], [], 0
        if keys:
            yield keys, texts


def linear_hashes(n: int, seed: int) -> np.ndarray:
    """Factors and summands of ``n`` hash functions modulo 2^64."""
    draw = np.random.default_rng(seed)
    odd, add = (draw.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
    return np.stack([odd, add])


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands) hashes of the bands of (texts, bands * rows) signatures."""
    key = np.zeros((len(signatures), bands), np.uint64)
    for r in range(rows):
        key = (key ^ signatures[:, r::rows]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key ^ np.arange(bands, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)


def least_hashes(h: np.ndarray, starts: np.ndarray, odd: np.ndarray, add: np.ndarray) -> np.ndarray:
    """(stretches, functions) the least value that each hash function takes on each stretch of ``h``."""
    found, value = np.empty((len(odd), len(starts)), np.uint64), np.empty_like(h)
    for row, a, b in zip(found, odd, add):
        np.multiply(h, a, out=value)
        value += b
        np.minimum.reduceat(value, starts, out=row)
    return found.T


def paragraph_bands(docs: DataFrame, min_words: int, k: int, bands: int, rows: int, seed: int, text_col: str) -> DataFrame:
    """(pid, band): a hash for each band of each paragraph; of copies some come more than once.

    The hash of a shingle is made from those of its words, for all paragraphs of a batch at once.
    """
    odd, add = linear_hashes(bands * rows, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for _, texts in text_groups(batches):
            lex = lexed(texts)
            pids, s, e, _ = plain_paragraphs(lex, min_words, seen)
            if len(pids):
                n = np.maximum(e - s - k + 1, 1)
                starts = np.cumsum(n) - n
                at = np.arange(n.sum()) + np.repeat(s - starts, n)
                h = range_hashes(lex[5], at, np.minimum(at + k, np.repeat(e, n)), _BASES[1])
                key = band_hashes(least_hashes(h, starts, odd, add), bands, rows)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(pids, bands)), pa.array(key.ravel().view(np.int64))], ["pid", "band"])

    return small_batches(docs).select(F.col(text_col).alias("text")).mapInArrow(run, "pid long, band long")


#: One in so many texts is looked at for large buckets; the members of a part of such a bucket.
SAMPLED, PART = 64, 4096


def busy_bands(sample: DataFrame) -> DataFrame:
    """(band, parts) of the buckets that, by the bands of one text in SAMPLED, are large."""
    counted = sample.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    return keep(counted.where(F.col("n") * SAMPLED > 2 * PART).select("band", F.ceil(F.col("n") * SAMPLED / PART).alias("parts")))


def buckets(bands: DataFrame, busy: DataFrame) -> DataFrame:
    """(band, pid, rep, n, split): the rows of ``bands`` that share their bucket, in one exchange.

    ``rep`` is the smallest pid of the bucket and ``n`` its rows; buckets that
    ``busy`` knows are split, with both taken by part, so no task meets one whole.
    """
    dealt = bands.join(busy, "band", "left").select("band", "pid", F.pmod(F.xxhash64("pid"), F.coalesce("parts", F.lit(1))).alias("part"), F.col("parts").isNotNull().alias("split"))
    whole = Window.partitionBy("band", "part")
    met = dealt.select("band", "pid", "split", F.min("pid").over(whole).alias("rep"), F.max("pid").over(whole).alias("last"), F.count(F.lit(1)).over(whole).alias("n"))
    return met.where("rep < last or split").drop("last")


def similar(texts_of: Callable[[DataFrame], DataFrame], bands: DataFrame, busy: DataFrame, k: int, similarity: float, near: DataFrame | None = None) -> DataFrame:
    """Links (src, dst) that span the components of all verified pairs of pids that share a
    band.  ``texts_of`` gives the (pid, text) of a table of pids.

    Every member of a bucket is first compared with the bucket's smallest pid (in a
    bucket that is split, with that of its part, and those with one another's), each
    such pair once for all bands.  A bucket whose members are then in one component
    has nothing left to say, nor has one of two; only in others do the pairs between
    components meet, in blocks.  ``near`` may add pairs (pid, rep) to be compared.
    """
    meet = keep(buckets(bands, busy))
    heads = meet.where("split").select("band", F.col("rep").alias("pid")).distinct()
    heads = heads.join(heads.groupBy("band").agg(F.min("pid").alias("rep")), "band").select("pid", "rep")
    pairs = meet.select("pid", "rep").unionByName(heads).where("pid <> rep")
    pairs = keep((pairs if near is None else pairs.unionByName(near)).distinct())
    needed = keep(pairs.select("pid").unionByName(pairs.select(F.col("rep").alias("pid"))).distinct())
    texts = keep(texts_of(needed))
    stars = keep(verified_stars(pairs, texts, k, similarity))
    known = connected_components(stars).withColumnRenamed("id", "pid")
    labelled = keep(meet.where("n > 2 or split").select("band", "pid").distinct().join(known, "pid", "left").select("band", "pid", F.coalesce("component", "pid").alias("part")))
    open_ = labelled.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("band")
    rest = block_pairs(labelled.join(open_, "band"), ["band"], F.col("pid"), limit=512).select("key", "pid", "part", "block", "same")
    return stars.unionByName(verified_links(rest, texts, k, similarity))


def verified_stars(pairs: DataFrame, texts: DataFrame, k: int, similarity: float, limit: int = 512) -> DataFrame:
    """(src, dst): the pairs (pid, rep) whose texts are similar enough.  The pairs of one
    rep are dealt out by ``limit``, with its text in each part.  Only reps with more pairs
    than that are joined to the pairs: a small table, which Catalyst broadcasts within its bound."""
    parts = keep(pairs.groupBy("rep").agg(F.ceil(F.count(F.lit(1)) / limit).alias("parts")))
    busy = keep(parts.where("parts > 1"))
    members = pairs.join(busy, "rep", "left").select("pid", "rep", F.pmod(F.xxhash64("pid"), F.coalesce("parts", F.lit(1))).alias("part"))
    firsts = parts.select(F.col("rep").alias("pid"), "rep", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    dealt = members.unionByName(firsts).select("pid", "rep", F.xxhash64("rep", "part").alias("key")).join(texts, "pid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            pid, rep, plain = table["pid"].to_pylist(), table["rep"].to_pylist(), table["text"].combine_chunks()
            first, found = None, []
            for i in sorted(range(len(pid)), key=lambda i: (rep[i], pid[i] != rep[i])):
                pieces = set(shingles(plain[i].as_py().split(b" "), k))
                if pid[i] == rep[i]:
                    first = pieces
                elif (both := len(pieces & first)) >= similarity * (len(pieces) + len(first) - both):
                    found.append((pid[i], rep[i]))
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in (0, 1)], ["src", "dst"])

    return by_key(dealt).mapInArrow(run, "src long, dst long")


def verified_links(meet: DataFrame, texts: DataFrame, k: int, similarity: float) -> DataFrame:
    """Links (src, dst) between the rows (key, pid, part, block, same) of one key that are of
    different parts and whose texts are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            key, pid = table["key"].to_numpy(), table["pid"].to_numpy()
            block, same, part = (table[c].to_numpy() for c in ("block", "same", "part"))
            plain, of, held, forest = table["text"].combine_chunks(), {}, 0, Forest(len(key))

            def pieces(i: int) -> set[bytes]:
                nonlocal held
                if pid[i] not in of:
                    if held > 1_500_000:
                        of.clear()
                        held = 0
                    of[pid[i]] = set(shingles(plain[int(i)].as_py().split(b" "), k))
                    held += len(of[pid[i]])
                return of[pid[i]]

            for i, j in pairs_in_runs(key):
                meets = (same[i] | (block[i] != block[j])) & (part[i] != part[j])
                root = forest.settle()
                meets &= root[i] != root[j]
                linked = [(a, b) for a, b in zip(i[meets], j[meets]) if (both := len((x := pieces(a)) & (y := pieces(b)))) >= similarity * (len(x) + len(y) - both)]
                if linked:
                    forest.link(*np.array(linked).T)
            root = forest.settle()
            at = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays([pa.array(pid[at]), pa.array(pid[root[at]])], ["src", "dst"])

    return by_key(meet.join(texts, "pid")).mapInArrow(run, "src long, dst long")


def repeated_passages(
    docs: DataFrame, min_words: int = 40, k: int = 5, similarity: float = 0.8, rows: int = 4, recall: float = 0.9998, seed: int = 3,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row for each paragraph (see :func:`paragraph_cuts`) that is repeated: row (the
    place of its row in ``docs``, which must be a stored table), doc_id, paragraph (the line it starts in, from 0), start and n_chars in the text, n_words,
    component_doc and component_paragraph (the first of its component), n_members
    and kept (whether it is that first one).

    Null and empty texts have none; rows with a null id stand last in the order; of
    rows that repeat an id and its text one is kept; an empty table gives no rows;
    other columns are ignored.  Paragraphs with the same 64-bit digest are taken as equal.
    """
    found = keep(paragraphs(docs, min_words, id_col, text_col))
    bands = lambda some: paragraph_bands(some, min_words, k, bands_needed(rows, similarity, recall), rows, seed, text_col)
    busy = busy_bands(bands(docs.where(F.pmod(F.xxhash64(text_col), F.lit(SAMPLED)) == 0)))
    links = similar(lambda wanted: paragraph_texts(docs, min_words, text_col, wanted), bands(docs), busy, k, similarity)
    groups = connected_components(links).withColumnRenamed("id", "pid")
    placed = keep(found.join(groups, "pid", "left").withColumn("component", F.coalesce("component", "pid")).drop("pid"))
    place = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("paragraph").alias("p"), F.col("start").alias("s"), F.col("row").alias("r"))
    many = keep(placed.groupBy("component").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n_members")).where("n_members > 1"))
    first = (F.col("row") == F.col("first.r")) & (F.col("start") == F.col("first.s"))
    return placed.join(many, "component").select(
        "row", "doc_id", "paragraph", "start", "n_chars", "n_words", F.col("first.d").alias("component_doc"), F.col("first.p").alias("component_paragraph"), "n_members", first.alias("kept")
    )


#: Shingles among which the smallest hash starts a unit, and the words of a shingle.
WINDOW, PICK = 16, 5
_DRAW = np.random.default_rng(11)
_BYTE = _DRAW.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = [int(x) * 8 + 5 for x in _DRAW.integers(0, 1 << 60, 3)]
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2^64."""
    if len(_powers.get(base, ())) < n:
        _powers[base] = np.cumprod(np.r_[np.uint64(1), np.full(2 * n, base % (1 << 64), np.uint64)], dtype=np.uint64)
    return _powers[base][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ h >> np.uint64(33)


def range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """A hash of ``values[start:end]`` for each range, wherever it stands."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    return mixed((sums[end] - sums[start]) * powers(pow(base, -1, 1 << 64), len(values) + 1)[start])


def lexed(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Lower-cased bytes of ``texts`` joined, where each text begins, where words
    begin and end, the text of each word and its hash."""
    b = np.frombuffer(b" ".join(texts).lower(), np.uint8)
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    space = np.ones(len(b) + 2, bool)
    space[1:-1] = (b - np.uint8(9) < 5) | (b == 32)
    edge = np.flatnonzero(space[1:] != space[:-1])
    first, past = edge[::2], edge[1::2]
    of = np.repeat(np.arange(len(texts)), np.diff(np.r_[np.searchsorted(first, begin), len(first)]))
    return b, begin, first, past, of, range_hashes(_BYTE.take(b), first, past, _BASES[0])


def units(texts: list[bytes], size: int) -> tuple[np.ndarray, ...]:
    """(text, first word, first byte, byte past the end, hash) of the units of ``size`` words.

    A unit starts where a shingle has the smallest hash of ``WINDOW`` in a row,
    so two equal runs of ``size + WINDOW - 1`` words have one in common.
    """
    b, begin, first, past, of, word = lexed(texts)
    if len(first) < max(size, WINDOW + PICK - 1):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    i = np.arange(len(first) - PICK + 1)
    least = sliding_places(range_hashes(word, i, i + PICK, _BASES[1]), WINDOW)
    at = least[of[: len(least)] == of[WINDOW + PICK - 2 :]]
    at = at[np.r_[True, at[1:] != at[:-1]]] if len(at) else at
    at = at[at + size <= len(first)]
    at = at[of[at] == of[at + size - 1]]
    h = range_hashes(word, at, at + size, _BASES[2])
    _, back, times = np.unique(mixed(h + of[at].astype(np.uint64) * np.uint64(_BASES[0] | 1)), return_inverse=True, return_counts=True)
    stays, last = np.ones(len(at), bool), {}
    for j in np.flatnonzero(times[back] > 1).tolist():  # of equal units of a text that overlap, one
        if at[j] - last.get(back[j], -size) >= size:
            last[back[j]] = at[j]
        else:
            stays[j] = False
    at, h = at[stays], h[stays]
    of, base = of[at], np.searchsorted(first, begin)
    return of, at - base[of], first[at] - begin[of], past[at + size - 1] - begin[of], h


def unit_hashes(docs: DataFrame, size: int, text_col: str) -> DataFrame:
    """(h): the hash of each unit, once for each row of ``docs`` that holds it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_groups(batches):
            of, _, _, _, h = units(texts, size)
            order = np.lexsort((h, of))
            of, h = of[order], h[order]
            once = np.r_[True, (h[1:] != h[:-1]) | (of[1:] != of[:-1])] if len(h) else slice(0)
            yield pa.RecordBatch.from_arrays([pa.array(h[once].astype(np.uint64).view(np.int64))], ["h"])

    return small_batches(docs).select(F.col(text_col).alias("text")).mapInArrow(run, "h long")


def unit_rows(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(h, row, doc_id, word, start, n_chars, paragraph) for each unit."""

    def some(keys: list[tuple], texts: list[bytes]) -> pa.RecordBatch:
        of, word, start, past, h = units(texts, size)
        b = np.frombuffer(b" ".join(texts), np.uint8)
        ends, begin = np.flatnonzero(b == 10), np.cumsum([0, *(len(t) + 1 for t in texts)])[of]
        line = np.searchsorted(ends, begin + start) - np.searchsorted(ends, begin)
        zero, start, past = in_characters(b, begin, begin + start, begin + past)
        start, past = start - zero, past - zero
        key = lambda i: pa.array([k[i] for k in keys], pa.int64()).take(pa.array(of, pa.int64()))
        int_ = lambda x: pa.array(x.astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), key(0), key(1), int_(word), int_(start), int_(past - start), int_(line)], ["h", "row", "doc_id", "word", "start", "n_chars", "paragraph"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_groups(batches):
            yield some(keys, texts)

    return numbered(docs, id_col, text_col).mapInArrow(run, "h long, row long, doc_id long, word int, start int, n_chars int, paragraph int")


MARKS = "row long, doc_id long, paragraph long, start long, n_chars long, n_words long, component_doc long, component_paragraph long, n_members long, kept boolean"


def merge_units(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """One row for each span of units of a row that overlap or touch and agree in ``kept``
    and the document of their first places."""
    schema = pa.schema([(c, pa.bool_() if t == "boolean" else pa.int64()) for c, t in (x.split() for x in MARKS.split(", "))])
    for table in whole_groups(batches, "row"):
        spans, ends = [], {}
        for r in sorted(table.to_pylist(), key=lambda r: (r["row"], r["word"])):
            what = (r["row"], r["kept"], r["component_doc"])
            last = ends.get(what)
            if last and r["word"] <= last["word"] + last["n_words"]:
                last |= {"n_words": r["word"] + size - last["word"], "n_chars": r["start"] + r["n_chars"] - last["start"], "n_members": max(last["n_members"], r["n_members"])}
            else:
                spans.append(r | {"n_words": size})
                ends[what] = spans[-1]
        yield pa.RecordBatch.from_pylist([{c: s[c] for c in schema.names} for s in spans], schema)


def repeated_runs(docs: DataFrame, run_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows as of :func:`repeated_passages` for runs of equal words, over line ends and within lines.

    Every run of ``run_words`` words or more that stands in two documents is found in
    all its places, but for up to ``WINDOW - 1`` words at either end; shorter ones
    from ``run_words - WINDOW + 1`` words are found where a unit meets them.
    ``paragraph`` is the line in which the span starts, ``n_members`` the documents
    that hold its most repeated unit; ``kept`` spans are the first places of their units.
    Words are compared by 64-bit hashes of units, without regard to case (A-Z) and white space.
    Each row counts by itself, whether its id is null, repeated or neither; null and
    empty texts and empty tables have no runs.
    """
    size = run_words - WINDOW + 1
    many = keep(unit_hashes(docs, size, text_col).groupBy("h").agg(F.count(F.lit(1)).alias("n_members")).where("n_members > 1"))
    found = keep(unit_rows(docs, size, id_col, text_col).join(many, "h"))
    place = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("row").alias("r"), F.col("start").alias("s"), F.col("paragraph").alias("p"))
    first = keep(found.groupBy("h").agg(F.min(place).alias("first")))
    marked = found.join(first, "h").withColumns({"kept": place == F.col("first"), "component_doc": F.col("first.d"), "component_paragraph": F.col("first.p")}).drop("h", "first")
    return marked.repartition("row").sortWithinPartitions("row").mapInArrow(lambda batches: merge_units(batches, size), MARKS)


def every_passage(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of :func:`repeated_passages`, and those of :func:`repeated_runs` that
    say more: spans within a repeated line of the same row are left out if the line goes or the span stays.

    Each row of ``docs`` counts by itself, so rows that share an id, or have none, hide
    nothing of each other; ``row`` is a row's place in ``docs``, which must be a stored
    table.  Null and empty texts and empty tables have no passages; other columns are ignored.
    """
    lines = settled(lambda: repeated_passages(docs, id_col=id_col, text_col=text_col))
    runs = settled(lambda: repeated_runs(docs, id_col=id_col, text_col=text_col))
    at = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n_chars")).alias("end"), "kept")))
    known = lines.groupBy("row").agg(at.alias("known"))
    covered = F.exists("known", lambda x: (x["start"] <= F.col("start")) & (x["end"] >= F.col("start") + F.col("n_chars")) & (F.col("kept") | ~x["kept"]))
    more = runs.join(known, "row", "left").where(~F.coalesce(covered, F.lit(False))).drop("known")
    return lines.unionByName(more.select(*lines.columns))


def without_passages(docs: DataFrame, passages: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the passages that are not kept: whole lines go with their line
    end, of other spans the words that no kept span of runs holds.

    ``passages`` are those of :func:`every_passage` of the same stored table, and are taken
    from the rows that hold them: ids need not be there or be unique.  Rows without
    passages, null texts among them, stay as they are; all columns are kept.
    """
    spans = F.collect_set(F.struct("start", "n_chars", "kept"))
    gone = passages.groupBy(F.col("row").alias("_row")).agg(spans.alias("_spans")).where(F.exists("_spans", lambda x: ~x["kept"]))
    joined = docs.withColumn("_row", F.monotonically_increasing_id()).join(gone, "_row", "left").drop("_row")
    names, at = docs.columns, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [text if text is None or not some else without_spans(text, some) for text, some in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(cut, pa.string()) if i == at else batch.column(i) for i in range(len(names))], names)

    return small_batches(joined).mapInArrow(run, docs.schema)


def without_spans(text: str, spans: list[dict]) -> str:
    """A text without the spans (start, n_chars, kept) that are not kept."""

    def whole(s: dict) -> bool:
        """Whether a span is whole lines."""
        end = s["start"] + s["n_chars"]
        return (s["start"] == 0 or text[s["start"] - 1] == "\n") and (end == len(text) or text[end] == "\n")

    stays = np.ones(len(text) + 1, bool)
    for s in sorted((x for x in spans if not (x["kept"] and whole(x))), key=lambda x: (x["kept"], whole(x))):
        stays[s["start"] : s["start"] + s["n_chars"]] = s["kept"]
    for s in spans:
        if not s["kept"] and whole(s):
            stays[s["start"] : s["start"] + s["n_chars"] + 1] = False
    left = "".join(text[a:b] for a, b in _stretches(stays[:-1]))
    return left[:-1] if not stays[-1] and left.endswith("\n") else left


def _stretches(stays: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.diff(np.r_[False, stays, False].astype(np.int8))
    return zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())
