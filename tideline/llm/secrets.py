"""Secret scans whose false positives a random forest removes, in SQL functions only.

A pattern finds candidates: runs of 16 and more key characters with a letter and
a digit.  A random forest judges each by its length, the transitions between its
characters, how much of it is frequent words of the corpus, the path it was found under
and the words beside it.  The forest is trained from labelled findings with Spark
ML and then written out as one SQL expression, so scanning is a single pass over
the texts without a shuffle.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import keep

#: A candidate, and what separates candidates in a text.
CANDIDATE = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*[0-9])(?=[0-9_+/-]*[A-Za-z])[A-Za-z0-9_+/-]{16,}={0,2}"
#: Characters before and after a candidate that are looked at.
AROUND = 64
#: Fixed word lists: names beside secrets, names beside harmless values, paths of samples.
SECRET_NAMES = "token|secret|passw(?:or)?d|passphrase|pwd|api_?key|access_?key|private_?key|credentials?|auth|bearer|client_?secret|key"
HARMLESS_NAMES = "commit|sha1|sha256|md5|checksum|digest|uuid|revision|etag|build|version|example|sample|placeholder|dummy|hash|id"
SAMPLE_PATHS = "test|spec|example|sample|fixture|mock|demo|doc"
FEATURES = ["length", "mix", "bigrams", "covered", "upper", "digits", "distinct", "named", "assigned", "harmless", "sample_path", "path_depth"]
#: Characters of lower-cased candidates; a pair of them has a number.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789_+/-="
#: Labelled findings that a forest is trained on, at most.
TRAINING_ROWS = 8000


@dataclass
class Model:
    """A forest over FEATURES as SQL over the fields of ``f``, the log-odds of
    character pairs by their number, and the dictionary."""

    sql: str
    pairs: list[float]
    words: list[str]


def classes(candidate: Column) -> Column:
    """A candidate with its characters replaced by their kinds: vowel, consonant, capital, digit, sign."""
    c = F.regexp_replace(candidate, "[aeiouy]", "v")
    for pattern, kind in (("[b-df-hj-np-tw-xz]", "c"), ("[A-Z]", "U"), ("[0-9]", "9"), ("[_+/=-]", "-")):
        c = F.regexp_replace(c, pattern, kind)
    return c


def dictionary(docs: DataFrame, size: int = 5000, text_col: str = "text") -> list[str]:
    """The ``size`` most frequent words of four and more letters a-z in all texts."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(text_col), F.lit("[a-z]{4,}"), F.lit(0))).alias("word"))
    top = words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(size)
    return [r["word"] for r in top.collect()]


def features(candidate: Column, before: Column, after: Column, path: Column, pairs: Column, words: list[str]) -> Column:
    """A struct of FEATURES.  Null context and null paths count as empty."""
    before, after, path = (F.coalesce(x, F.lit("")) for x in (before, after, path))
    kinds, low, n = classes(candidate), F.lower(candidate), F.length(candidate)
    share = lambda pattern: (n - F.length(F.regexp_replace(candidate, pattern, ""))) / n
    mix = (F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1) / (n - 1)
    steps = F.sequence(F.lit(1), n - 1)
    bigrams = F.aggregate(steps, F.lit(0.0), lambda acc, i: acc + F.coalesce(F.get(pairs, pair_number(low, i)), F.lit(0.0))) / (n - 1)
    runs = F.filter(F.split(low, "[^a-z]+"), lambda w: w.isin(words))
    covered = F.length(F.array_join(runs, "")) / n if words else F.lit(0.0)
    beside = F.regexp_extract(before, r"((?:\S+\s+){0,2}\S*)$", 1)
    yes = lambda x: x.cast("double")
    return F.struct(
        n.cast("double").alias("length"), mix.alias("mix"), bigrams.alias("bigrams"), covered.alias("covered"), share("[A-Z]").alias("upper"), share("[0-9]").alias("digits"),
        (F.array_size(F.array_distinct(F.split(candidate, ""))) / n).alias("distinct"),
        yes(beside.rlike(rf"(?i)(?:^|[^a-z])(?:\w*_)?(?:{SECRET_NAMES})[\"']?\W*$")).alias("named"), yes(before.rlike(r"[:=]\s*[\"']?$")).alias("assigned"),
        yes(beside.rlike(rf"(?i)(?:^|[^a-z])(?:{HARMLESS_NAMES})\W*$") | after.rlike(rf"(?i)^\W*(?:{HARMLESS_NAMES})(?:[^a-z]|$)")).alias("harmless"),
        yes(path.rlike(rf"(?i)(?:^|[^a-z])(?:{SAMPLE_PATHS})s?(?:[^a-z]|$)")).alias("sample_path"), F.size(F.split(path, "/")).cast("double").alias("path_depth"),
    )


def pair_number(low: Column, i: Column) -> Column:
    """The number of the pair of characters at ``i`` (from 1) of a lower-cased candidate."""
    at = lambda k: F.instr(F.lit(ALPHABET), F.substr(low, k, F.lit(1)))
    return at(i) * (len(ALPHABET) + 1) + at(i + 1)


def pair_odds(labelled: DataFrame) -> list[float]:
    """Log-odds of character pairs in secrets against other candidates, smoothed; unseen pairs have 0."""
    low = F.lower("candidate")
    each = labelled.select("label", F.explode(F.transform(F.sequence(F.lit(1), F.length("candidate") - 1), lambda i: pair_number(low, i))).alias("pair"))
    counts = [(r["pair"], r["yes"], r["no"]) for r in each.groupBy("pair").agg(F.sum("label").alias("yes"), F.sum(1 - F.col("label")).alias("no")).collect()]
    size = (len(ALPHABET) + 1) ** 2
    yes, no = (sum(c[k] for c in counts) + size for k in (1, 2))
    odds = [0.0] * size
    for pair, y, n in counts:
        odds[pair] = round(math.log((y + 1) / yes) - math.log((n + 1) / no), 4)
    return odds


def pair_array(pairs: list[float]) -> Column:
    return F.from_json(F.lit(json.dumps(pairs)), "array<double>")


def as_sql(node) -> str:
    """A tree of Spark ML as SQL for the share of secrets in the leaf."""
    if node.getClass().getSimpleName() == "LeafNode":
        stats = list(node.impurityStats().stats())
        return repr(stats[1] / max(sum(stats), 1e-9))
    split = node.split()
    return f"if(f.{FEATURES[split.featureIndex()]} <= {split.threshold()!r}D, {as_sql(node.leftChild())}, {as_sql(node.rightChild())})"


def train(labelled: DataFrame, words: list[str], trees: int = 20, depth: int = 5, seed: int = 9) -> Model:
    """Train on (candidate, before, after, path, label): label 1 for a secret, 0 for none.

    Of more than TRAINING_ROWS findings those first by hash are used; findings
    with a null label or a candidate under two characters are not.  Findings of
    one label alone give that label to all, and none at all give 0.
    """
    usable = labelled.where("label is not null and length(candidate) >= 2").select("candidate", "before", "after", "path", F.col("label").cast("double").alias("label"))
    rows = keep(usable.orderBy(F.xxhash64("candidate", "before", "after", "path"), "label").limit(TRAINING_ROWS))
    share = rows.agg(F.avg("label")).first()[0] or 0.0
    if share in (0.0, 1.0):  # nothing to tell apart
        return Model(f"{share}D", [0.0] * (len(ALPHABET) + 1) ** 2, words)
    pairs = pair_odds(rows)
    f = features(F.col("candidate"), F.col("before"), F.col("after"), F.col("path"), pair_array(pairs), words)
    judged = keep(rows.select("label", f.alias("f")).select("label", "f.*").coalesce(1))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(judged)
    forest = RandomForestClassifier(featuresCol="vector", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(vectors)
    return Model(f"({' + '.join(as_sql(t._call_java('rootNode')) for t in forest.trees)}) / {float(trees)}D", pairs, words)


def weak_labels(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", sample: int = 2000) -> DataFrame:
    """Labelled findings where none are at hand: values of known kinds planted
    between words of up to ``sample`` documents, first by hash.

    Secrets are keys of providers' forms, bare or named, and random values under
    a secret name; other findings are digests and ids under harmless names, bare
    digests, identifiers, dates, placeholders and words joined with numbers.
    """
    hashed = docs.where(F.length(text_col) > 20).select(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("h"), F.col(text_col).alias("t"), F.col(path_col).cast("string").alias("path"))
    cut = hashed.select("h").orderBy("h").limit(sample).agg(F.max("h")).first()[0]  # hashes alone are ordered, not texts
    base = hashed.where(F.col("h") <= F.lit(cut).cast("long")).orderBy("h", "t").limit(sample)
    words = F.filter(F.split("t", r"\s+"), lambda w: F.length(w) > 0)
    hexa = lambda salt: F.sha2(F.concat(F.col("h").cast("string"), F.lit(salt)), 256)
    b64 = lambda salt: F.regexp_replace(F.base64(F.unhex(hexa(salt))), "=", "")
    number = lambda salt, n: F.pmod(F.xxhash64("h", F.lit(salt)), F.lit(n))
    word = lambda salt: F.coalesce(F.try_element_at(F.col("w"), (number(salt, 997) % F.greatest(F.size("w"), F.lit(1)) + 1).cast("int")), F.lit("x"))
    some = lambda salt, *values: F.element_at(F.array(*[F.lit(v) for v in values]), (number(salt, len(values)) + 1).cast("int"))
    letters = lambda salt: F.upper(F.regexp_replace(b64(salt), "[^A-Za-z0-9]", ""))
    plain = lambda salt: F.regexp_replace(F.lower(word(salt)), "[^a-z]", "")
    name = some("n", "token", "secret", "password", "api_key", "access_key", "client_secret", "auth_token", "passwd", "private_key", "key")
    sign = some("s", ' = "', "=", ": ", ' = ', '="', ": '", ' := "', "': '")
    harmless = some("m", "commit ", "sha256: ", "md5 ", "checksum=", "uuid ", "revision ", "build ", "digest: ", "id=", "etag: ")
    near = F.concat(word("b1"), F.lit(" "), word("b2"), F.lit(" "))
    kinds = [
        (1, F.substring(hexa("a"), 1, (number("a", 4) * 8 + 16).cast("int")), F.concat(near, name, sign)),
        (1, F.substring(b64("c"), 1, (number("c", 24) + 18).cast("int")), F.concat(near, name, sign)),
        (1, F.substring(hexa("a2"), 1, (number("a2", 46) + 18).cast("int")), F.concat(near, name, sign)),
        (1, F.concat(some("p", "AKIA", "ASIA"), F.rpad(F.substring(letters("d"), 1, 16), 16, "A")), near),
        (1, F.concat(some("p2", "AKIA", "ASIA"), F.rpad(F.substring(letters("e"), 1, 16), 16, "B")), F.concat(near, name, sign)),
        (1, F.concat(some("q", "ghp_", "gho_", "sk_live_", "glpat-", "AIza", "xoxb-", "npm_", "sk-"), F.substring(F.regexp_replace(b64("g"), "[+/]", "x"), 1, 36)), near),
        (0, F.substring(hexa("i"), 1, (number("i", 2) * 24 + 40).cast("int")), F.concat(near, harmless)),
        (0, F.substring(hexa("j"), 1, (number("j", 4) * 8 + 16).cast("int")), near),
        (0, F.concat_ws("-", F.substring(hexa("k"), 1, 8), F.substring(hexa("k"), 9, 4), F.substring(hexa("k"), 13, 4), F.substring(hexa("k"), 17, 4), F.substring(hexa("k"), 21, 12)), near),
        (0, F.concat(plain("l1"), F.lit("_"), plain("l2"), F.lit("_"), plain("l3"), F.lit("_"), number("l", 100).cast("string"), F.lit("_value")), near),
        (0, F.concat(plain("u1"), plain("u2"), plain("u3"), number("u", 3000).cast("string"), plain("u4"), F.lit("section")), near),
        (0, F.concat(F.lit("20"), (number("y", 30) + 10).cast("string"), F.lit("-0"), (number("y2", 9) + 1).cast("string"), F.lit("-1"), number("y3", 10).cast("string"), F.lit("T10-20-30Z")), near),
        (0, F.concat(F.lit("your_"), name, F.lit("_here_"), number("z", 1000).cast("string")), F.concat(near, name, sign)),
        (0, F.concat(plain("v1"), F.lit("/"), plain("v2"), F.lit("/"), plain("v3"), number("v", 100).cast("string"), F.lit("/index_page")), near),
    ]
    base = keep(base.select("h", "path", words.alias("w")))
    found = None
    for label, candidate, before in kinds:
        after = F.concat(F.when(before.endswith('"'), '"').otherwise(""), F.lit(" "), word("x"))
        one = base.select("path", F.lit(label).alias("label"), candidate.alias("candidate"), before.alias("before"), after.alias("after"))
        found = one if found is None else found.unionByName(one)
    return found.where("length(candidate) >= 16")


def scanned(docs: DataFrame, model: Model, text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """``docs`` with ``_between``, the text around its candidates, and ``_found``,
    an array with (candidate, before, after, score) for each."""
    path = F.col(path_col).cast("string") if path_col else F.lit("")
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = docs.withColumn("_has", text.rlike(CANDIDATE)).withColumns({"_between": F.when(F.col("_has"), F.split(text, CANDIDATE, -1)).otherwise(F.array(text)), "_candidates": F.when(F.col("_has"), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))).otherwise(F.array().cast("array<string>"))})
    pairs = pair_array(model.pairs)

    def one(candidate: Column, i: Column) -> Column:
        before = F.right(F.get("_between", i), F.lit(AROUND))
        after = F.left(F.get("_between", i + 1), F.lit(AROUND))
        return F.struct(candidate.alias("candidate"), before.alias("before"), after.alias("after"), features(candidate, before, after, path, pairs, model.words).alias("f"))

    docs = docs.withColumn("_features", F.transform("_candidates", one))
    score = f"transform(_features, x -> struct(x.candidate as candidate, x.before as before, x.after as after, {model.sql.replace('f.', 'x.f.')} as score))"
    return docs.withColumn("_found", F.expr(score)).drop("_features", "_candidates", "_has")


def findings(docs: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """(doc_id, place, start, n_chars, candidate, score, is_secret), one row for each candidate.

    ``start`` is its place in the text in characters from 0.  Whole texts are
    read; null and empty texts have no candidate; null ids stay null; repeated
    rows and repeated candidates each have rows; an empty table gives none.
    """
    found = scanned(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(path_col).alias("path")) if path_col else docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model, "text", "path" if path_col else None)
    lengths = F.transform("_found", lambda x, i: F.length(F.get("_between", i)) + F.length(x["candidate"]))
    ends = F.aggregate(lengths, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    rows = found.where(F.size("_found") > 0).withColumn("_ends", ends).select("doc_id", "_ends", F.posexplode("_found").alias("place", "x"))
    n = F.length("x.candidate")
    return rows.select("doc_id", "place", (F.get("_ends", F.col("place") + 1) - n).alias("start"), n.alias("n_chars"), F.col("x.candidate").alias("candidate"), F.col("x.score").alias("score"), (F.col("x.score") >= threshold).alias("is_secret"))


def redact(docs: DataFrame, model: Model, threshold: float = 0.5, mask: str = "[SECRET]", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """``docs`` with every secret in its text replaced by ``mask``; null texts stay
    null, and all other columns, of whatever names, are kept as they are."""
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    found = scanned(docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text"), path.alias("path")), model, "text", "path")
    parts = F.transform("_found", lambda x, i: F.concat(F.get("_between", i), F.when(x["score"] >= threshold, F.lit(mask)).otherwise(x["candidate"])))
    text = F.when(F.size("_found") > 0, F.concat(F.array_join(parts, ""), F.element_at("_between", -1))).otherwise(F.col("text"))
    return found.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
