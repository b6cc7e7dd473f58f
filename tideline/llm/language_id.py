"""Language identification by prediction by partial matching.

For each language a context tree counts which byte follows each context of up to
three bytes.  A byte's code length is that of its longest known context; where
the byte was not seen there, an escape is paid and the context loses its oldest
byte, down to a uniform code (escape method C).  The trees are fitted once and
then frozen, so the exact code length of a whole text is a sum of table entries:
the trees of all languages are laid over one another and each (context, byte)
pair that was seen gets its length for every language.  The shortest code names the language.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import keep, small_batches

ORDER = 3
_LETTER = regex.compile(r"\p{L}")
_CODED = regex.compile(r"\S*\d\S*")
#: Times the usual code length a byte that a text in a learned language may take, and bits that any text may take besides.
WIDE, SPARE = 4.0, 64.0


@dataclass
class Model:
    """Frozen code lengths in bits, for the pairs of context and byte that were seen only.

    ``symbol`` numbers the bytes that were seen (0: any other) and ``node`` gives the
    longest known context of three symbols.  A context has a bit for each symbol that was
    seen after it in any language; ``bits`` has a row, a code length for each language, for
    each such pair, in the order of contexts and symbols, and ``first`` the row of each
    context's first symbol of each 64.  A symbol without a bit costs the context's
    ``escape`` in each language and goes on at its ``lower`` context, one byte shorter.
    """

    langs: list[str]
    symbol: np.ndarray
    node: np.ndarray
    seen: np.ndarray
    first: np.ndarray
    lower: np.ndarray
    escape: np.ndarray
    bits: np.ndarray

    def code_lengths(self, text: bytes) -> np.ndarray:
        """Bits that each language's frozen tree needs for ``text``."""
        k, total = int(self.symbol.max()) + 1, np.zeros(len(self.langs))
        padded = np.concatenate([np.full(ORDER, 32, np.uint8), np.frombuffer(text, np.uint8)])
        for at in range(0, len(text), 1 << 20):
            s = self.symbol[padded[at : at + (1 << 20) + ORDER]]
            total += self.lengths(self.node[(s[:-3] * k + s[1:-2]) * k + s[2:-1]], s[3:])
        return total

    def lengths(self, node: np.ndarray, s: np.ndarray) -> np.ndarray:
        """The sum of the code lengths of symbols after their contexts."""
        total = np.zeros(len(self.langs))
        for _ in range(ORDER + 1):
            word, place = s >> 6, (s & 63).astype(np.uint64)
            some = self.seen[node, word]
            there = (some >> place & np.uint64(1)).astype(bool)
            ahead = np.bitwise_count(some & (np.uint64(1) << place) - np.uint64(1))
            total += self.bits[(self.first[node, word] + ahead)[there]].sum(0, dtype=np.float64)
            node, s = node[~there], s[~there]
            total += self.escape[node].sum(0, dtype=np.float64) + 8.0 * (node == 0).sum()  # below the empty context, which is the first, a byte takes 8 bits
            s, node = s[node > 0], self.lower[node[node > 0]]
        return total


def normal(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def training_rows(docs: DataFrame, allowed: Column, docs_per_lang: int, text_col: str, lang_col: str, id_col: str) -> DataFrame:
    """(lang, text) of up to ``docs_per_lang`` whole texts a language, by hash order."""
    rows = docs.where(allowed & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string"), F.lit(3)).alias("h"))
    order = Window.partitionBy("lang").orderBy("h")
    picked = keep(rows.select("lang", "h").withColumn("n", F.row_number().over(order)).where(F.col("n") <= docs_per_lang).select("lang", "h").distinct())
    texts = rows.join(picked, ["lang", "h"])  # broadcast within Catalyst's bound; again limited: repeated ids share a hash
    return texts.withColumn("n", F.row_number().over(order)).where(F.col("n") <= docs_per_lang).select("lang", "text")


def ngram_counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each byte follows each context of 3 bytes; texts start after spaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                b = np.frombuffer(b" " * ORDER + normal(text), np.uint8).astype(np.int64)
                gram, n = np.unique(((b[:-3] << 8 | b[1:-2]) << 8 | b[2:-1]) << 8 | b[3:], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n)], ["lang", "gram", "n"])

    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, allowed: Column, docs_per_lang: int = 200, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model:
    """Fit on a bounded sample: at most ``docs_per_lang`` whole labelled texts of
    each language where ``allowed`` holds.  The counts that reach the driver are
    bounded by the sample.  Without labelled text the model has no language."""
    counts = ngram_counts(training_rows(docs, allowed, docs_per_lang, text_col, lang_col, id_col)).toArrow()
    of = counts["lang"].combine_chunks().dictionary_encode()
    names = of.dictionary.to_pylist()
    langs = sorted(names)
    number = np.array([langs.index(x) for x in names], np.int64)
    return build(langs, number[of.indices.to_numpy()], counts["gram"].to_numpy(), counts["n"].to_numpy())


def build(langs: list[str], of: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    """The frozen model for counts ``n`` of 4-grams ``gram`` in language number ``of``: its size
    is that of the distinct pairs of context and byte, times languages."""
    bytes_ = np.stack([gram >> s & 255 for s in (24, 16, 8, 0)]) if len(gram) else np.zeros((4, 0), np.int64)
    known_bytes = np.union1d(bytes_.ravel(), [32])
    symbol = np.zeros(256, np.int32)
    symbol[known_bytes] = np.arange(1, len(known_bytes) + 1)
    k, m = len(known_bytes) + 1, len(langs)
    words, s = (k + 63) // 64, symbol[bytes_].astype(np.int64)
    node = np.zeros(k**3, np.int32)
    every = np.arange(k**3, dtype=np.int64)
    seen, first, lower, escapes, rows = [], [], [], [], []
    start = row = below_start = 0
    pairs_below, bits_below, contexts_below = np.zeros(0, np.int64), np.zeros((0, m), np.float32), np.zeros(1, np.int64)
    for order in range(ORDER + 1):
        ctx = np.zeros(len(gram), np.int64)
        for i in range(3 - order, 3):
            ctx = ctx * k + s[i]
        pairs, pair = np.unique(ctx * k + s[3], return_inverse=True)
        count = np.zeros((len(pairs), m), np.float32)
        np.add.at(count, (pair, of), n)
        contexts, at = np.unique(pairs // k, return_inverse=True) if len(pairs) or order else (np.zeros(1, np.int64), np.zeros(0, np.int64))
        total, kinds = np.zeros((len(contexts), m), np.float32), np.zeros((len(contexts), m), np.float32)
        np.add.at(total, at, count)
        np.add.at(kinds, at, (count > 0).astype(np.float32))
        tail = contexts % k ** max(order - 1, 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0).astype(np.float32)
            known = -np.log2(count / (total + kinds)[at])
        below = bits_below[np.searchsorted(pairs_below, tail[at] * k + pairs % k)] if order else np.float32(8)
        bits = np.where(count > 0, known, escape[at] + below).astype(np.float32)  # a pair that a longer context holds stands after the shorter one, too
        after, bitmap = pairs % k, np.zeros((len(contexts), words), np.uint64)
        np.bitwise_or.at(bitmap, (at, after >> 6), np.uint64(1) << (after & 63).astype(np.uint64))
        ahead = np.cumsum(np.bitwise_count(bitmap).ravel()) - np.bitwise_count(bitmap).ravel()
        seen.append(bitmap)
        first.append((row + ahead.astype(np.int64)).reshape(bitmap.shape))
        lower.append(below_start + np.searchsorted(contexts_below, tail) if order else np.zeros(len(contexts), np.int64))
        escapes.append(escape)
        rows.append(bits)
        # The node of three symbols is their longest known context.
        if len(contexts):
            end = every % k**order
            found = np.searchsorted(contexts, end).clip(0, len(contexts) - 1)
            hit = contexts[found] == end
            node[hit] = start + found[hit]
        below_start, start, row = start, start + len(contexts), row + len(pairs)
        pairs_below, bits_below, contexts_below = pairs, bits, contexts
    return Model(langs, symbol, node, np.concatenate(seen), np.concatenate(first), np.concatenate(lower).astype(np.int32), np.concatenate(escapes), np.concatenate(rows))


def words_only(text: str) -> bytes:
    """``text`` without the tokens that hold digits, such as keys and numbers; all of it if no letter is left."""
    left = _CODED.sub(" ", text)
    return normal(left if _LETTER.search(left) else text)


def usual_length(docs: DataFrame, allowed: Column, model: Model, docs_per_lang: int = 200, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> float:
    """The median over the training texts of the bits a byte that their shortest code takes."""
    frozen = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [words_only(t) for t in batch["text"].to_pylist() if t and _LETTER.search(t)]
            yield pa.RecordBatch.from_arrays([pa.array([float(frozen.value.code_lengths(t).min() / len(t)) for t in texts], pa.float64())], ["bits"])

    rows = training_rows(docs, allowed, docs_per_lang, text_col, lang_col, id_col)
    found = rows.mapInArrow(run, "bits double").toArrow()["bits"].to_numpy() if model.langs else []
    return float(np.median(found)) if len(found) else float("inf")


def predict(docs: DataFrame, model: Model, text_col: str = "text", usual: float | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, and with ``learned`` if ``usual`` is given,
    one row for each row; columns of these names are replaced.

    ``score`` is the language's share of the likelihood under equal priors.  A
    null text, a text without a letter and every text under a model without
    languages give ``und`` and 0.  Equal code lengths go to the first language
    by name.  The whole text counts, whatever its length.  ``score`` only compares
    the learned languages and is near 1 for a text in none of them; ``learned``
    says whether the shortest code is near enough to the ``usual`` bits a byte.
    """
    frozen = small_batches(docs).sparkSession.sparkContext.broadcast(model)

    def judge(text: str | None) -> tuple[str, float, bool]:
        m = frozen.value
        if not text or not m.langs or not _LETTER.search(text):
            return "und", 0.0, False
        whole = normal(text)
        bits = m.code_lengths(whole)
        best, fits = int(bits.argmin()), False
        if usual is not None:
            plain = words_only(text)
            fits = bool((bits if plain == whole else m.code_lengths(plain)).min() <= WIDE * usual * len(plain) + SPARE)
        return m.langs[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()), fits

    @F.pandas_udf("lang_pred string, score double, learned boolean")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            yield pd.DataFrame([judge(t) for t in part], columns=["lang_pred", "score", "learned"])

    once = scored.asNondeterministic()  # else a filter on its result would have it run again
    judged = docs.select(F.struct(*docs.columns).alias("row"), once(F.col(text_col)).alias("judged"))
    added = ["lang_pred", "score"] + ["learned"] * (usual is not None)
    kept = [c for c in docs.columns if c not in added]
    return judged.select(*[F.col("row")[c].alias(c) for c in kept], *[f"judged.{c}" for c in added])
