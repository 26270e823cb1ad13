"""Line dedup by a suffix array over line ids, built by prefix doubling.

Each text is the sequence of its ``\\n``-split lines, and every line starts a
suffix of its document.  Doubling names the prefix of 1, 2, 4, ... lines of a
suffix; equal prefixes get equal names, so one name is one interval of the
suffix array whose longest common prefix is at least that long.  A name is the
first position (document id, line) that holds the prefix, which makes names
exact and tells the first copy from the later ones without another pass.

A run of lines counts if it has ``min_lines`` lines, or ``min_words`` words on
fewer lines, so a long paragraph on one line counts too.  A line goes if a run
that counts, lies in its document and covers it also starts earlier (smaller
id, or same id and an earlier line).  Each such run is covered by runs of
``min_lines`` lines or is shorter, which bounds the depth: prefixes of 1 to
``min_lines`` lines are named, those between two powers of two by two
overlapping names.  Chains of the runs found are the repeated stretches; deeper
names could not cover another line.

Only repeated prefixes stay in play: a prefix that ends in a line found once
cannot repeat.  All joins are equi-joins of two written tables on a name, which
AQE can split when one line is very common, and first positions are aggregated
map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, packed, text_key, unpacked, word_count

MIN_LINES = 3
MIN_WORDS = 20


def _named(prefixes: DataFrame, key: list[str]) -> DataFrame:
    """Name each repeated prefix by its first position; prefixes found once drop out.

    ``prefixes`` has (id, th, line), the columns ``key`` that identify the
    prefix, and others, which are carried.  A repeated row of the same document
    is the same position.
    """
    at = F.struct("id", "th", "line")
    # a table of its own: both sides of the join are then plain exchanges, of which AQE splits a hot key's partition
    names = materialise(prefixes.groupBy(*key).agg(F.min(at).alias("first"), F.max(at).alias("last"))
                        .filter(F.col("first") != F.col("last")).drop("last"))
    return prefixes.join(names, key).withColumnRenamed("first", "name").drop(*key)


def _lines_on(step: int):
    """Window on the line ``step`` lines further on in the same document."""
    return W.partitionBy("id", "th").orderBy("line").rangeBetween(step, step)


def _ahead(names: DataFrame, step: int) -> DataFrame:
    """Pair each name with the name ``step`` lines further on in the same document."""
    return names.withColumn("next", F.max("name").over(_lines_on(step))).filter(F.col("next").isNotNull()) \
        .withColumnRenamed("name", "prefix")


def _enough(min_lines: int, min_words: int | None) -> Column:
    """Least number of lines from a line on that make a run count: ``min_lines``, or fewer with ``min_words`` words.

    A missing line, which is one that does not repeat, ends the sum.
    """
    least = F.lit(min_lines)
    if min_words is None:
        return least
    words = [F.max("n").over(_lines_on(k)) for k in range(min_lines - 1)]
    for j in range(min_lines - 1, 0, -1):
        least = F.when(sum(words[1:j], words[0]) >= min_words, j).otherwise(least)
    return least


def _later(names: DataFrame, n_lines: int) -> DataFrame:
    """(id, th, line, end) of the runs of ``n_lines`` lines that count and also start earlier."""
    first, own = F.col("name"), F.col("id")
    before = (first["id"] < own) | (first["id"].isNull() & own.isNotNull()) \
        | (first["id"].eqNullSafe(own) & (first["line"] < F.col("line")))
    return names.filter((F.col("least") <= n_lines) & before).select("id", "th", "line", (F.col("line") + n_lines).alias("end"))


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = MIN_WORDS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Repeated stretches that are later copies: (id, th, first_line, n_lines).

    ``th`` is the text's fingerprint; it tells rows that share an id apart.
    Lines count from 0.  ``min_words`` None counts lines only.
    """
    if min_lines < 1 or (min_words is not None and min_words < 1):
        raise ValueError("min_lines and min_words must be at least 1")
    lines = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("th"),
                        F.posexplode(F.split(F.col(text_col), "\n")).alias("line", "text"))
    # a line id is 128 bits of its content; the text itself is not shuffled
    n = F.lit(0).cast("long") if min_words is None else word_count(F.col("text"))
    ids = materialise(lines.select("id", "th", "line", F.xxhash64("text").alias("a"),
                                   F.xxhash64("text", F.lit(0x5EED)).alias("b"), n.alias("n")))
    names = materialise(_named(ids, ["a", "b"]).withColumn("least", _enough(min_lines, min_words)).drop("n"))
    depth, found = 1, []
    for k in range(1, min_lines + 1):
        if k == 2 * depth:
            names, depth = materialise(_named(_ahead(names, depth), ["prefix", "next"])), k
        if k == min_lines or min_words is not None:
            found.append(_later(names if k == depth else _named(_ahead(names, k - depth), ["prefix", "next"]), k))
    later = found[0]
    for more in found[1:]:
        later = later.unionByName(more)
    # chains of overlapping or touching runs (gaps and islands inside one document)
    w = W.partitionBy("id", "th").orderBy("line")
    reach = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    chains = later.groupBy("id", "th", "line").agg(F.max("end").alias("end")) \
        .withColumn("new", F.coalesce(F.col("line") > reach, F.lit(True))) \
        .withColumn("run", F.sum(F.col("new").cast("int")).over(w))
    return chains.groupBy("id", "th", "run").agg(
        F.min("line").alias("first_line"), (F.max("end") - F.min("line")).alias("n_lines")).drop("run")


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = MIN_WORDS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The documents with later copies of repeated line runs deleted.

    A run counts from ``min_lines`` lines on, or from ``min_words`` words on
    (runs of other characters than blanks).  All columns stay; ``text_col`` holds the kept lines, joined by ``\\n``, and
    ``_n_lines`` and ``_n_removed`` (long) are added.  A null text stays null
    with 0 lines; an empty text is one empty line.  A document all of whose
    lines go keeps its row with an empty text.  Rows with a null id come before
    all others in the order of copies.  A row repeated in full is one position,
    so it does not delete its twin.  Rows that share an id but differ in text
    are ordered by line only and do not delete one another's equal line.
    Empty tables give empty results; other columns are carried along.
    """
    runs = repeated_runs(docs, min_lines, min_words, id_col, text_col)
    cuts = runs.groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("first_line", "n_lines"))).alias("cuts")) \
        .withColumnsRenamed({"id": "cut_id", "th": "cut_th"})
    # build on the cuts, so that the texts are shuffled but not sorted
    d = packed(docs, id=id_col, text=text_col).withColumn("th", text_key(F.col("text"))).join(
        cuts.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("cut_id")) & (F.col("th") == F.col("cut_th")), "left")
    d = d.withColumn("lines", F.split(F.col("text"), "\n"))
    no_cut = F.col("cuts").isNull()
    # kept ranges are the gaps between the cuts: linear in the lines
    begins = F.concat(F.array(F.lit(0)), F.transform("cuts", lambda c: (c["first_line"] + c["n_lines"]).cast("int")))
    ends = F.concat(F.transform("cuts", lambda c: c["first_line"].cast("int")), F.array(F.size("lines")))
    kept = F.flatten(F.zip_with(begins, ends, lambda b, e: F.slice(F.col("lines"), b + 1, e - b)))
    removed = F.aggregate("cuts", F.lit(0).cast("long"), lambda n, c: n + c["n_lines"])
    return unpacked(d, docs.columns, **{
        text_col: F.when(no_cut, F.col("text")).otherwise(F.array_join(kept, "\n")),
        "_n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long"),
        "_n_removed": F.when(no_cut, F.lit(0).cast("long")).otherwise(removed)})
