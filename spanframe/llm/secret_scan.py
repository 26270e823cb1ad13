"""Secret scans: candidate tokens judged by a random forest.

Candidates are values assigned to a secret's name (``password = ...``), whatever
their characters, and tokens that could be a secret by their shape: runs of
``MIN_LEN`` or more letters, digits and ``+/_-`` that hold a digit.  Each is
described by its length, its character transitions, how much of it words of the
corpus cover, whether it is part of a path, and the words beside it.

The forest learns from labelled findings.  ``label_findings`` labels a bounded
sample of the candidates by rules of high precision: tokens of a fixed, public
key format, or assigned to a name such as ``token`` or ``password``, are
secrets; path parts, uuids, dates, words with a number and repeated characters
are not; the rest teaches nothing.  Formats and shapes are not among the
features, so the forest can judge tokens that no rule knows.

The words of all documents are counted into a table, without a cap.  Letter
transitions are summed from it, 26 x 26 of them, and the words that candidates
ask for are looked up in it by a join, so nothing that grows with the corpus
reaches the driver or a broadcast.  Fitting and scoring are Spark ML jobs over
rows of numbers.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import bound_arrow_batches, materialise, packed, text_key, unpacked

MIN_LEN = 12
CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{{{MIN_LEN},}}=*(?![A-Za-z0-9+/_-])")
ALPHA = re.compile(r"[a-z]{3,}")
MIN_DOCS = 3  # a corpus word stands in so many documents at least

# fixed values: public key formats, names that introduce a secret, and harmless shapes
FORMATS = re.compile(
    r"^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|glpat-[0-9A-Za-z_-]{20}|xox[abprs]-[0-9A-Za-z-]{10,}"
    r"|sk_live_[0-9A-Za-z]{16,}|AIza[0-9A-Za-z_-]{35}|eyJ[0-9A-Za-z_-]{10,})$")
NAMES = ("token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "auth", "key", "credential", "bearer")
HARMLESS = re.compile(
    r"^([0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}|\d{4}-\d\d-\d\d\S*|[\d+/_-]+|[a-z]+[-_/]?\d{1,4}|(.)\2{7,})$", re.I)

# a value after a name that holds one of NAMES
ASSIGNED = re.compile(rf"(?:{'|'.join(NAMES)})[\w-]{{0,40}}[\"']?[ \t]{{0,3}}(?::=|=>|[=:])[ \t]{{0,3}}[\"']?"
                      r"([^\s\"'`,;()<>\[\]{}]{4,})", re.I)

FEATURES = ("length", "digits", "uppers", "symbols", "entropy", "class_changes", "transition", "coverage", "in_path",
            "assigned", "named", "quoted", "left_words", "right_words")


def _char_class(c: str) -> str:
    return "d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s"


def spans(text: str) -> list[tuple[int, int]]:
    """Spans of the candidates of a text, in order and apart: assigned values first, then what has the shape."""
    named = [m.span(1) for m in ASSIGNED.finditer(text)]
    out, k = list(named), 0
    for m in CANDIDATE.finditer(text):
        while k < len(named) and named[k][1] <= m.start():
            k += 1
        if k == len(named) or named[k][0] >= m.end():
            out.append(m.span())
    return sorted(out)


def transition_score(token: str, pairs: dict[str, float]) -> float:
    """Mean log-probability of the token's letters after the letters before them, as in words of the corpus."""
    low = token.lower()
    found = [pairs.get(low[i : i + 2], -9.0) for i in range(len(low) - 1)]
    return sum(found) / len(found) if found else -9.0


def describe(text: str, b: int, e: int, pairs: dict[str, float]) -> tuple[list[float], list[str], list[str], list[str]]:
    """(features that need no dictionary, letter parts of the token, three words before it, three words after it)."""
    t = text[b:e]
    n = len(t)
    counts = Counter(t)
    kinds = [_char_class(c) for c in t]
    before, after = text[max(0, b - 40) : b], text[e : e + 40]
    left = before.rstrip("\"' ")
    words_left, words_right = re.findall(r"\w+", before), re.findall(r"\w+", after)
    return [
        float(n), kinds.count("d") / n, kinds.count("u") / n, kinds.count("s") / n,
        -sum(c / n * math.log2(c / n) for c in counts.values()),
        sum(x != y for x, y in zip(kinds, kinds[1:])) / max(1, n - 1),
        transition_score(t, pairs),
        float("/" in t or before.endswith(("/", ".", "\\")) or after.startswith(("/", "\\", "."))
              and after[1:2].isalnum()),
        float(left.endswith(("=", ":", ":=", "=>"))),
        float(bool(words_left) and any(k in words_left[-1].lower() for k in NAMES)),
        float(before.endswith(('"', "'")) and after.startswith(('"', "'"))),
    ], ALPHA.findall(t.lower()), [w.lower() for w in words_left[-3:]], [w.lower() for w in words_right[:3]]


def corpus_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): every lower-case word of letters, under 30 of them, with the number of documents that hold it.

    All documents are counted; each task emits the words of a batch once, and
    the sums combine map-side.
    """
    bound_arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(w for w in set(text.lower().split()) if w.isalpha() and len(w) < 30)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), type=pa.string()),
                                                  pa.array(list(seen.values()), type=pa.int64())], names=["word", "n"])

    return docs.select(text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letter_pairs(words: DataFrame) -> dict[str, float]:
    """Log-probability of each letter a-z after each other one, from the counted words (one added to each count)."""
    at = F.sequence(F.lit(1), F.length("word") - 1)
    pairs = words.filter(F.length("word") > 1).select("n", F.explode(F.transform(
        at, lambda i: F.substring("word", i, F.lit(2)))).alias("pair"))
    found = pairs.filter(F.col("pair").rlike("^[a-z]{2}$")).groupBy("pair").agg(F.sum("n").alias("n")).collect()
    n = {r.pair: r.n for r in found}
    letters = "abcdefghijklmnopqrstuvwxyz"
    total = {a: sum(n.get(a + b, 0) + 1 for b in letters) for a in letters}
    return {a + b: math.log((n.get(a + b, 0) + 1) / total[a]) for a in letters for b in letters}


def candidates(docs: DataFrame, words: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, th, start, length, token, label, features): each candidate of every whole text.

    ``label`` is 1.0, 0.0 or null by the rules of high precision.  ``words`` is
    the table of ``corpus_words``; those in ``min_docs`` documents or more count
    as words.
    """
    bound_arrow_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
    schema = StructType([src.schema["id"], src.schema["th"], *StructType.fromDDL(
        "start long, length long, token string, x array<double>, parts array<string>, before array<string>, "
        "after array<string>, format boolean, harmless boolean")])
    arrow = to_arrow_schema(schema)
    model = docs.sparkSession.sparkContext.broadcast(letter_pairs(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, th, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for b, e in spans(text) if text else ():
                    token = text[b:e]
                    rows.append((doc, th, b, e - b, token, *describe(text, b, e, model.value),
                                 bool(FORMATS.match(token)), bool(HARMLESS.match(token))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    found = materialise(src.mapInArrow(run, schema))
    # what a candidate asks the dictionary depends on its text alone: rows that repeat a text ask once
    asked = found.groupBy("th", "start").agg(F.first(F.array_distinct(F.concat("parts", "before", "after"))).alias("w")) \
        .select("th", "start", F.explode_outer("w").alias("word"))
    known = asked.join(words.filter(F.col("n") >= min_docs).select("word"), "word") \
        .groupBy(F.col("th").alias("k_th"), F.col("start").alias("k_start")).agg(F.collect_set("word").alias("known"))
    d = found.join(materialise(known), (F.col("th") == F.col("k_th")) & (F.col("start") == F.col("k_start")), "left") \
        .withColumn("known", F.coalesce("known", F.array().cast("array<string>")))
    chars = F.aggregate("parts", F.lit(0), lambda a, p: a + F.when(F.array_contains("known", p), F.length(p)).otherwise(0))
    of_three = lambda c: F.size(F.filter(c, lambda w: F.array_contains("known", w))) / F.lit(3.0)
    d = d.withColumn("coverage", chars / F.col("length"))
    x = lambda name: F.get("x", F.lit([f for f in FEATURES if f not in ("coverage", "left_words", "right_words")].index(name)))
    secret = F.col("format") | ((x("named") == 1) & (x("assigned") == 1) & (F.col("coverage") < 0.3))
    plain = F.col("harmless") | (x("in_path") == 1) | (F.col("coverage") > 0.5)
    cut = FEATURES.index("coverage")
    return d.select("id", "th", "start", "length", "token",
                    F.when(secret, 1.0).when(plain, 0.0).alias("label"),
                    F.concat(F.slice("x", 1, cut), F.array("coverage"), F.slice("x", cut + 1, len(FEATURES)),
                             F.array(of_three("before"), of_three("after"))).alias("features"))


def _draw():
    return F.pmod(F.xxhash64("token", "start", "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))


def label_findings(found: DataFrame, max_rows: int = 20_000) -> DataFrame:
    """(features, label): about ``max_rows`` labelled candidates at most, half of them for each class.

    A hash sample, so that reruns agree; a class with fewer rows gives all.
    """
    known = found.filter(F.col("label").isNotNull())
    n = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("label") == 1.0, min(1.0, max_rows / 2 / max(1, n.get(1.0, 0)))) \
        .otherwise(min(1.0, max_rows / 2 / max(1, n.get(0.0, 0))))
    return known.filter(_draw() < share).select("token", "start", "features", "label")


def _vector(frame: DataFrame) -> DataFrame:
    return frame.withColumn("x", array_to_vector("features"))


def learn(labelled: DataFrame, trees: int = 40, depth: int = 8, seed: int = 3) -> RandomForestClassificationModel | None:
    """The forest, or None where a class has no example.

    The sample is bounded, so it is put in order in one partition: trees, and
    with them the scores, are then the same in every run.
    """
    rows = materialise(labelled.orderBy("label", "token", "start", "features").coalesce(1))
    if rows.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed,
                                  probabilityCol="p", cacheNodeIds=False).fit(_vector(rows.coalesce(1)))


def judge(found: DataFrame, model: RandomForestClassificationModel | None, threshold: float = 0.5) -> DataFrame:
    """``found`` with ``score`` and ``is_secret``; without a model the rules' label decides, 0.5 where there is none."""
    if model is None:
        scored = found.withColumn("score", F.coalesce("label", F.lit(0.5)))
    else:
        scored = model.transform(_vector(found)).withColumn("score", vector_to_array("p")[1]) \
            .drop("x", "p", model.getRawPredictionCol(), model.getPredictionCol())
    return scored.withColumn("is_secret", F.col("score") > threshold)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 20_000,
                 threshold: float = 0.5) -> DataFrame:
    """(id, th, start, length, token, label, features, score, is_secret): every candidate of every row of ``docs``.

    ``start`` counts code points; ``th`` is the text's fingerprint.  A null or
    empty text has no candidate; a null id stays null; a repeated row gives its
    findings again; an empty table gives none.  Where the corpus has labelled
    findings of one class only, nothing can be learned and the rules decide.
    """
    words = materialise(corpus_words(docs, text_col))
    found = materialise(candidates(docs, words, id_col, text_col))
    return judge(found, learn(label_findings(found, max_rows)), threshold)


def redact(docs: DataFrame, mark: str = "[secret]", id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with each secret replaced by ``mark``; all columns stay.

    Null and empty texts stay as they are, rows with a null id are matched by
    their text, and rows repeated in full are all redacted.  Cuts of one text
    do not overlap.  An empty table stays empty.
    """
    found = scan_secrets(docs, id_col, text_col, **options).filter("is_secret").groupBy("id", "th").agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias("cuts")) \
        .withColumnsRenamed({"id": "r_id", "th": "r_th"})
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform("cuts", lambda c: c["start"] + c["length"]))
    ends = F.concat(F.transform("cuts", lambda c: c["start"]), F.array(F.length("text").cast("long")))
    parts = F.zip_with(begins, ends, lambda b, e: F.substring(F.col("text"), (b + 1).cast("int"), (e - b).cast("int")))
    met = packed(docs, id=id_col, text=text_col).withColumn("th", text_key(F.col("text"))).join(
        found.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("r_id")) & (F.col("th") == F.col("r_th")), "left")
    return unpacked(met, docs.columns, **{
        text_col: F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.array_join(parts, mark))})
