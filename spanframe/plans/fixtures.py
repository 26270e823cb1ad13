"""Fixture relations over the driver tables (Spark side).

They stand in for the reference's CSV inputs (patient notes, features,
annotated train rows) and for a model's token scores.  Every relation is a
lazy DataFrame; nothing is collected.  The DuckDB twins live in
``oracle_sql.py``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrow import drawn_tokens
from ..functions.spans import parse_loc_strip_split
from ..functions.text import WORD_PATTERN
from ..operators import packed as PK
from ..sources.tables import Tables

FEATURES_PER_CASE = 4


def tokens_of(df: DataFrame, key_cols, text_col: str) -> DataFrame:
    """Explode a text column into word tokens with offsets (one row per token).

    A map without an exchange; see ``operators.packed``.  ``tok_no`` is the
    1-based word rank; ``pos`` is the word's index among all segments (2k, or
    2k+1 when the text starts with a gap).
    """
    return PK.explode_tokens(PK.pack_tokens(df, key_cols, text_col), key_cols)


def token_draw(key):
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def prob_of(label, h):
    """Stand-in score of a token: its label, blurred by the hash draw of its key."""
    draw = F.when(h % 1000 < 2, F.lit(549)).otherwise(h % 450)
    return (label * 450 + draw) / F.lit(1000.0)


def token_key(tok_no):
    return F.concat_ws("_", F.col("pn_num").cast("string"), F.col("feature_num").cast("string"), tok_no.cast("string"))


def annotate(packed: DataFrame, features: DataFrame) -> DataFrame:
    """Every packed note with every feature of its case, and the packed hits of
    the feature's term; the only join is on the case, so it runs on streams."""
    f = features.select("feature_num", F.col("case_num").alias("f_case"), "term")
    return PK.term_hits(packed.join(f, F.col("case_num") == F.col("f_case")).drop("f_case"))


def score(annotated: DataFrame) -> DataFrame:
    """``annotated`` with ``toks``: array<struct<tok_no,s,e,label,prob>>."""
    def tok(x, i):
        label = F.when(x["words"] == F.col("term"), 1).otherwise(0)
        return F.struct((i + 1).alias("tok_no"), x["s"].alias("s"), x["e"].alias("e"), label.alias("label"),
                        prob_of(label, x["h"]).alias("prob"))

    draws = F.transform("s", lambda _, i: token_draw(token_key(i + 1)))  # on their own, so that each is drawn once
    return annotated.withColumn("toks", F.transform(F.arrays_zip("s", "e", "words", draws.alias("h")), tok))


def score_by_batch(annotated: DataFrame) -> DataFrame:
    """``score`` by an Arrow step: the draws of a batch are hashed side by side, where lambdas are interpreted token by token."""
    labels = F.transform("words", lambda w: F.when(w == F.col("term"), 1).otherwise(0))
    return annotated.withColumn("toks", drawn_tokens(labels, "s", "e", F.concat(row_id(), F.lit("_"))))


def row_id():
    return F.concat_ws("_", F.col("pn_num").cast("string"), F.col("feature_num").cast("string"))


def literals(annotated: DataFrame) -> tuple:
    """(annotation, location): hits in order as list literals, two to an annotation (its pieces)."""
    n = F.size("hits")
    parts = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / 2).cast("int")),
                        lambda i: F.slice("hits", (i * 2 + 1).cast("int"), 2))

    def literal(piece, sep):
        item = F.transform(parts, lambda p: F.array_join(F.transform(p, piece), sep))
        return F.when(n == 0, F.lit("[]")).otherwise(F.concat(F.lit("['"), F.array_join(item, "', '"), F.lit("']")))

    return (literal(lambda h: h["token"], " "),
            literal(lambda h: F.concat_ws(" ", h["s"].cast("string"), h["e"].cast("string")), ";"))


def dealt(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt out by ``key`` if it lies in fewer files than the session has cores.

    A small file often is one row group, which one task would read and work on
    alone; a large table has files enough and is left as it lies, without an
    exchange.  Only the number of files decides."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if not df.isStreaming and len(df.inputFiles()) < cores else df


class Fixtures:
    """Relations of one query.  Nothing is cached or collected: each query
    plans its own reads, so filters and column lists reach the scans."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = Tables(spark, sf_dir)

    def case_of(self, key: str):
        """Case of a note or feature: about FEATURES_PER_CASE features share
        one, so the pairs of a note stay constant while the catalogue grows."""
        n = self.t.benchmark.agg(F.greatest(F.lit(1), F.expr(f"count(1) div {FEATURES_PER_CASE}"))).scalar()
        return F.pmod(F.col(key), n).cast("int")

    @cached_property
    def notes(self) -> DataFrame:
        """Notes as a plain scan; no exchange."""
        return self.t.documents.select(F.col("doc_id").alias("pn_num"), self.case_of("doc_id").alias("case_num"),
                                       F.col("text").alias("pn_history"))

    @cached_property
    def features(self) -> DataFrame:
        b = self.t.benchmark
        words = F.split(F.col("text"), " ")
        return b.select(
            F.col("item_id").alias("feature_num"), self.case_of("item_id").alias("case_num"),
            F.concat(F.array_join(F.slice(words, 1, 2), "-"), F.lit("-OR-"),
                     F.try_element_at(words, F.lit(3))).alias("feature_text"),
            F.lower(F.regexp_extract(F.col("text"), r"\p{L}+", 0)).alias("term"))

    @cached_property
    def packed(self) -> DataFrame:
        """(pn_num, case_num, first, words, s, e): each note tokenised once."""
        return PK.pack_tokens(dealt(self.notes, "pn_num"), ["pn_num", "case_num"], "pn_history")

    def packed_with(self, per_note: DataFrame) -> DataFrame:
        """``packed`` of the notes that ``per_note`` holds by ``pn_num``, with its other columns; texts meet it before anything is made of them."""
        notes = dealt(self.notes, "pn_num").join(per_note, "pn_num")
        return PK.pack_tokens(notes, ["pn_num", "case_num", *[c for c in per_note.columns if c != "pn_num"]], "pn_history")

    @cached_property
    def packed_with_words(self) -> DataFrame:
        """``packed`` without the notes that have no word, told by their text before anything is made of it."""
        worded = self.notes.filter(F.col("pn_history").rlike(WORD_PATTERN))
        return PK.pack_tokens(dealt(worded, "pn_num"), ["pn_num", "case_num"], "pn_history")

    @cached_property
    def tokens_with_case(self) -> DataFrame:
        return PK.explode_tokens(self.packed, ["pn_num", "case_num"])

    @cached_property
    def tokens(self) -> DataFrame:
        return PK.explode_tokens(self.packed, ["pn_num"])

    @cached_property
    def annotated(self) -> DataFrame:
        """Every note with every feature of its case: token arrays and packed hits in one row."""
        return annotate(self.packed, self.features)

    @cached_property
    def train(self) -> DataFrame:
        """Annotation rows: (id, case_num, pn_num, feature_num, annotation, location)."""
        annotation, location = literals(self.annotated)
        return self.annotated.select(row_id().alias("id"), "case_num", "pn_num", "feature_num",
                                     annotation.alias("annotation"), location.alias("location"))

    @cached_property
    def annotated_rows(self) -> DataFrame:
        """``train`` with the token arrays beside it and its parsed spans (``strip_split`` dialect)."""
        return self._with_spans(self.annotated)

    def _with_spans(self, annotated: DataFrame) -> DataFrame:
        a = annotated.withColumn("location", literals(annotated)[1])
        return a.select(row_id().alias("id"), "pn_num", "feature_num", "case_num", "location", "words", "s", "e", "term",
                        parse_loc_strip_split("location").alias("spans"))

    @cached_property
    def _rows_made(self) -> DataFrame:
        """``annotated_rows`` with the spans made once, to be filtered by them."""
        return PK.once(self.annotated_rows, "location", "spans")

    @cached_property
    def scored(self) -> DataFrame:
        """Every annotated row with its scored tokens packed in ``toks``, and its true spans.
        A note without tokens has no scores."""
        return score(self._rows_to_score).drop("words", "s", "e", "term")

    @cached_property
    def scored_by_batch(self) -> DataFrame:
        """``scored``, for plans that may take a second Arrow step."""
        return score_by_batch(self._rows_to_score).drop("words", "s", "e", "term")

    @cached_property
    def _rows_to_score(self) -> DataFrame:
        return self._with_spans(annotate(self.packed_with_words, self.features))

    @cached_property
    def pred_tok(self) -> DataFrame:
        """Every annotated row scored over every token of its note, one row a
        token; the only join is that of notes and features on the case."""
        return self.drawn(self.token_pairs_of(self.packed, "key"))

    def drawn(self, pairs: DataFrame) -> DataFrame:
        """``token_pairs`` with ``prob``, drawn by the ``key`` of their row."""
        # the draw is a column of its own: inlined into the score, it would be made once for each mention
        drawn = pairs.drop("word", "term").withColumn("h", token_draw(F.concat("key", F.col("tok_no").cast("string"))))
        return drawn.withColumn("prob", prob_of(F.col("label"), F.col("h"))).drop("h", "key")

    def word_pairs_of(self, packed: DataFrame, *extra: str) -> DataFrame:
        """(pn_num, feature_num, tok_no, label, word, term) of these packed notes, without offsets."""
        r = packed.join(self.features.select("feature_num", F.col("case_num").alias("f_case"), "term"), F.col("case_num") == F.col("f_case"))
        # zipped with the starts: without the Arrow step for them ``first`` would be inlined into the lambda that
        # picks the words, and a text matched anew for each of its segments
        t = r.select(*extra, "pn_num", "feature_num", "term", F.posexplode_outer(F.arrays_zip("words", "s")).alias("i", "t")) \
            .filter(F.col("i").isNotNull()).withColumn("word", F.col("t.words"))
        label = F.when(F.col("word") == F.col("term"), 1).otherwise(0)
        return t.select(*extra, "pn_num", "feature_num", (F.col("i") + 1).alias("tok_no"), label.alias("label"), "word", "term")

    def scored_items(self, packed: DataFrame, items: str) -> DataFrame:
        """Every packed note with every feature of its case, one row for each of the note's ``items`` (structs that
        name a token by ``item``, its index): the item's other fields, the start ``s`` and the score ``prob`` of its token.

        A token is drawn on its own row, where the draw is compiled; inside a lambda it would be interpreted."""
        r = packed.join(self.features.select("feature_num", F.col("case_num").alias("f_case"), "term"), F.col("case_num") == F.col("f_case"))
        t = r.select("pn_num", "feature_num", "term", "words", "s", F.concat(row_id(), F.lit("_")).alias("key"), PK.each(items).alias("x")) \
            .filter("x is not null")
        h = token_draw(F.concat("key", (F.col("x.item") + 1).cast("string")))
        label = F.when(F.get("words", F.col("x.item")) == F.col("term"), 1).otherwise(0)
        t = t.select("pn_num", "feature_num", "x.*", F.get("s", F.col("x.item")).alias("s"), label.alias("label"), h.alias("h")).drop("item")
        return t.withColumn("prob", prob_of(F.col("label"), F.col("h"))).drop("h", "label")

    @cached_property
    def token_pairs(self) -> DataFrame:
        """(pn_num, feature_num, tok_no, s, e, label, word, term): every token with every feature of its note's case."""
        return self.token_pairs_of(self.packed)

    def token_pairs_of(self, packed: DataFrame, *extra: str) -> DataFrame:
        """``token_pairs`` of these packed notes, with their columns ``extra``; ``key`` is that of the row's draws, made once a row."""
        r = packed.join(self.features.select("feature_num", F.col("case_num").alias("f_case"), "term"),
                        F.col("case_num") == F.col("f_case")).withColumn("key", F.concat(row_id(), F.lit("_")))
        t = r.select(*extra, "pn_num", "feature_num", "term", F.posexplode_outer(F.arrays_zip("s", "e", "words")).alias("i", "t")) \
            .filter(F.col("i").isNotNull())
        label = F.when(F.col("t.words") == F.col("term"), 1).otherwise(0)
        return t.select(*extra, "pn_num", "feature_num", (F.col("i") + 1).alias("tok_no"), F.col("t.s").alias("s"),
                        F.col("t.e").alias("e"), label.alias("label"), F.col("t.words").alias("word"), "term")


def md5_unit(*cols) -> "F.Column":
    """Uniform draw in [0,1) from the first 32 bits of md5(concat_ws('_', cols))."""
    key = F.concat_ws("_", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                             for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


class Bindings(Fixtures):
    """Other relations bound to driver tables (SURVEY 5.3 'other bindings')."""

    @cached_property
    def merged(self) -> DataFrame:
        """train LEFT JOIN features LEFT JOIN notes (the reference's wide frame)."""
        return (self.train.join(self.features, ["feature_num", "case_num"], "left")
                .join(self.notes, ["pn_num", "case_num"], "left"))

    @cached_property
    def passengers(self) -> DataFrame:
        t = self.t
        n_orders = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
        c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left") \
            .join(n_orders, F.col("c_custkey") == F.col("o_custkey"), "left")
        return c.select(
            F.col("c_custkey").alias("pid"),
            F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("age"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_nationkey").alias("nationkey"),
            F.col("n_name").alias("nation"),
            F.when(F.coalesce(F.col("n_orders"), F.lit(0)) > 10, 1).otherwise(0).alias("survived"))

    @cached_property
    def series(self) -> DataFrame:
        """Metric series: run = event_type, 1-based dense step, loss = value."""
        from .ordered import group_index

        e = self.t.events.select(F.col("event_type").alias("run"), "event_id", F.col("value").alias("loss"))
        return group_index(e, ["run"], ["event_id"], name="step")

    @cached_property
    def class_scores(self) -> DataFrame:
        """(vec_id, label, scores array<struct<cls, score>> by class): dot product
        of the vector with each class centroid.

        The centroids are one row (classes x dimensions), a scalar subquery, so
        scoring is a map over the vectors without a shuffle."""
        e = self.t.embeddings.select("vec_id", "label", "embedding")
        dims = e.select("label", F.posexplode("embedding").alias("dim", "v")) \
            .groupBy("label", "dim").agg(F.avg("v").alias("cv"))
        cent = dims.groupBy("label").agg(F.transform(
            F.sort_array(F.collect_list(F.struct("dim", "cv"))), lambda x: x["cv"]).alias("cv"))
        all_cent = cent.agg(F.sort_array(F.collect_list(F.struct(F.col("label").alias("cls"), "cv"))).alias("c")).scalar()
        scores = F.transform("_c", lambda c: F.struct(c["cls"].alias("cls"), F.aggregate(
            F.zip_with("embedding", c["cv"], lambda a, b: a.cast("double") * b), F.lit(0.0), lambda x, y: x + y).alias("score")))
        return e.withColumn("_c", all_cent).select("vec_id", "label", scores.alias("scores"))

    @cached_property
    def class_scores_long(self) -> DataFrame:
        return self.class_scores.select("vec_id", "label", F.explode("scores").alias("x")) \
            .select("vec_id", "label", "x.cls", "x.score")

    @cached_property
    def bias_rows(self) -> DataFrame:
        d = self.t.documents.select("doc_id", "lang")
        j = self.t.labels.join(d, "doc_id")
        return j.select(
            "doc_id",
            F.col("toxic").cast("double").alias("target"),
            (F.lit(0.5) * F.col("toxic") + F.lit(0.6) * md5_unit("doc_id")).alias("prediction"),
            F.when(F.col("lang") == "fr", 1.0).otherwise(0.0).alias("id_fr"),
            F.when(F.col("lang") == "de", 1.0).otherwise(0.0).alias("id_de"),
            F.when(F.col("lang") == "es", 1.0).otherwise(0.0).alias("id_es"))

    @cached_property
    def tweets(self) -> DataFrame:
        d = self.t.documents.select("doc_id", "text")
        return self.t.labels.join(d, "doc_id").select(
            "doc_id", "text", (F.col("quality") * 2 + F.col("toxic")).alias("label"))

    @cached_property
    def note_tok_arrays(self) -> DataFrame:
        """(pn_num, toks array<struct<s,e>>) in token order."""
        return self.packed.select("pn_num", F.arrays_zip("s", "e").alias("toks"))

    @cached_property
    def train_spans(self) -> DataFrame:
        """train rows with their parsed span list (``strip_split`` dialect)."""
        return self.annotated_rows.select("id", "pn_num", "feature_num", "case_num", "location", "spans")

    @cached_property
    def rows_with_spans(self) -> DataFrame:
        return self._rows_made.select("id", "pn_num", "feature_num", "case_num", "location", "spans").filter(F.size("spans") > 0)

    @cached_property
    def packed_with_spans(self) -> DataFrame:
        """``rows_with_spans`` with the note's token arrays beside them."""
        return self._rows_made.filter(F.size("spans") > 0)
