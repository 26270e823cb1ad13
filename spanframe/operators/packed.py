"""Token work on packed rows: one row per note, or per (note, feature), with parallel arrays.

A note is tokenised once into ``words``, ``s`` and ``e`` (lower-cased words and
their half-open char ranges, in order).  Labels, scores, runs and overlap counts
are expressions on the arrays of one row, so nothing is exploded, joined back or
windowed to decode it, and the same code runs on a stream.  Each expression is
linear in the row's tokens (the overlap sweep sorts them).

``toks`` is ``array<struct<tok_no,s,e,label,prob>>`` in token order; starts and
ends must not decrease, as with the offsets of a tokeniser.  For nested offsets
paint first (``operators.decode.paint``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrow import word_bounds
from ..functions.spans import format_spans, span
from ..functions.text import WORD_START_PATTERN, segments


def pack_tokens(df: DataFrame, key_cols, text_col: str) -> DataFrame:
    """(keys, first, words, s, e), one row per row of ``df``; a map without an exchange.

    One JVM regex pass cuts the text into alternating word and gap segments; an
    Arrow step turns their lengths into the offsets of the words.  ``first`` is
    the index of the first word among the segments (0 or 1).  A null text has
    null arrays, a text without words empty ones.
    """
    keys = [F.col(k) for k in key_cols]
    w = df.select(*keys, segments(text_col).alias("_g"),
                  F.when(F.col(text_col).rlike(WORD_START_PATTERN), 0).otherwise(1).alias("first"))
    w = w.withColumn("_b", word_bounds(F.transform("_g", lambda x: F.length(x)), "first"))
    # ``first`` stands outside the lambdas: inlined into one, the text would be matched anew for each of its segments
    words = F.when(F.col("first") == 0, F.filter("_g", lambda x, i: i % 2 == 0)).otherwise(F.filter("_g", lambda x, i: i % 2 == 1))
    words = F.transform(words, lambda x: F.lower(x))
    return w.select(*keys, "first", words.alias("words"), F.col("_b.s").alias("s"), F.col("_b.e").alias("e"))


def explode_tokens(packed: DataFrame, key_cols) -> DataFrame:
    """One row per token: (keys, pos, token, s, e, tok_no); ``pos`` is the word's index among all segments."""
    keys = [F.col(k) for k in key_cols]
    # an outer explode: for a plain one Spark would make the words a second time, in a filter on their number
    t = packed.select(*keys, "first", F.posexplode_outer(F.arrays_zip("words", "s", "e")).alias("i", "t")).filter(F.col("i").isNotNull())
    return t.select(*keys, (F.col("i") * 2 + F.col("first")).cast("int").alias("pos"), F.col("t.words").alias("token"),
                    F.col("t.s").alias("s"), F.col("t.e").alias("e"), (F.col("i") + 1).alias("tok_no"))


def each(items) -> Column:
    """An outer explode, to be followed by a filter on null.

    For a plain explode Spark infers a filter on the array's size and pushes it
    down, where the whole expression is inlined and made a second time, inside
    lambdas once for each item."""
    return F.explode_outer(items)


def once(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` with ``cols`` made once, whatever reads them next.

    A filter on an expression is pushed down and the expression inlined there,
    lambdas included, so that it is made again for each mention, inside lambdas
    for each item.  Nothing is pushed or inlined through an explode."""
    rest = [c for c in df.columns if c not in cols]
    d = df.select(*rest, F.explode_outer(F.array(F.struct(*cols))).alias("_once"))
    return d.select(*[F.col(f"_once.{c}").alias(c) if c in cols else c for c in df.columns])


def term_hits(packed: DataFrame, term: str = "term", name: str = "hits") -> DataFrame:
    """``packed`` with the tokens equal to the row's term: array<struct<s,e,token>>, empty if there is none."""
    zipped = F.arrays_zip(F.col("s"), F.col("e"), F.col("words").alias("token"))
    return packed.withColumn(name, F.coalesce(F.filter(zipped, lambda x: x["token"] == F.col(term)), F.array()))


def runs(df: DataFrame, items: str, joined: Callable[[Column, Column], Column], name: str) -> DataFrame:
    """``df`` with ``name``: the maximal runs of ``items`` as array<struct<first,last>>.

    ``joined(before, item)`` tells whether an item goes on with the one before."""
    a = F.col(items)
    starts = F.filter(a, lambda x, i: (i == 0) | ~joined(F.get(a, i - 1), x))
    ends = F.filter(a, lambda x, i: (i == F.size(a) - 1) | ~joined(x, F.get(a, i + 1)))
    return df.withColumn(name, F.zip_with(starts, ends, lambda x, y: F.struct(x.alias("first"), y.alias("last"))))


def token_runs(df: DataFrame, keep: Callable[[Column], Column], name: str, toks: str = "toks") -> DataFrame:
    """Runs of consecutive kept tokens: array<struct<start,end,first_tok,last_tok>>."""
    d = df.withColumn("_kept", F.filter(toks, keep))
    d = runs(d, "_kept", lambda p, x: x["tok_no"] == p["tok_no"] + 1, "_runs")
    return d.withColumn(name, F.transform("_runs", lambda r: F.struct(
        r["first"]["s"].alias("start"), r["last"]["e"].alias("end"), r["first"]["tok_no"].alias("first_tok"),
        r["last"]["tok_no"].alias("last_tok")))).drop("_kept", "_runs")


def char_runs(df: DataFrame, keep: Callable[[Column], Column], name: str, toks: str = "toks") -> DataFrame:
    """Runs of chars covered by kept tokens: array<struct<start,end>>; touching tokens are one run."""
    d = df.withColumn("_kept", F.filter(toks, lambda x: keep(x) & (x["e"] > x["s"])))
    d = runs(d, "_kept", lambda p, x: x["s"] <= p["e"], "_runs")
    return d.withColumn(name, F.transform("_runs", lambda r: span(r["first"]["s"], r["last"]["e"]))).drop("_kept", "_runs")


def shifted(spans: str, start: int = 0, end: int = 0) -> Column:
    return F.transform(spans, lambda x: span(x["start"] + start, x["end"] + end))


def closed_runs(token_run_col: str, last_tok: Column) -> Column:
    """Runs that a later token closes, never from or to offset 0; a run that starts at 0 takes all later ones with it."""
    zero = F.array_position(F.transform(token_run_col, lambda r: r["start"] == 0), True)
    return F.filter(token_run_col, lambda r, i: ((zero == 0) | (i + 1 < zero)) & (r["last_tok"] < last_tok)
                    & (r["start"] != 0) & (r["end"] != 0))


def decode_tokens(df: DataFrame, th: float = 0.5) -> DataFrame:
    """``df`` with the token-run locations ``flush`` (``;``) and ``noflush`` (``; ``)."""
    d = token_runs(df, lambda x: x["prob"] > th, "_tr")
    return d.withColumn("flush", format_spans("_tr")) \
        .withColumn("noflush", format_spans(closed_runs("_tr", F.size("toks")), "; ")).drop("_tr")


def decode_chars(df: DataFrame, keep: Callable[[Column], Column], name: str = "location", start: int = 0) -> DataFrame:
    """``df`` with the char-run location ``name``; ``start`` is added to the starts."""
    return char_runs(df, keep, "_cr").withColumn(name, format_spans(shifted("_cr", start))).drop("_cr")


def overlap_lengths(pred: Column, truth: Column) -> Column:
    """struct<tp,fp,fn> of chars between two span lists of one row, by a sweep over their sorted ends.

    Overlaps inside one list count once; empty spans count nothing."""
    def events(spans, dp, dt):
        real = F.filter(spans, lambda x: x["end"] > x["start"])
        at = lambda side, sign: F.transform(real, lambda x: F.struct(
            x[side].cast("long").alias("pos"), F.lit(sign * dp).alias("dp"), F.lit(sign * dt).alias("dt")))
        return [at("start", 1), at("end", -1)]

    zero, none = F.lit(0).cast("long"), F.lit(0)
    state = F.struct(zero.alias("pos"), none.alias("p"), none.alias("t"), zero.alias("tp"), zero.alias("fp"), zero.alias("fn"))

    def step(a, x):
        length = x["pos"] - a["pos"]
        add = lambda old, on: F.when(on, old + length).otherwise(old)
        p, t = a["p"] > 0, a["t"] > 0
        return F.struct(x["pos"].alias("pos"), (a["p"] + x["dp"]).alias("p"), (a["t"] + x["dt"]).alias("t"),
                        add(a["tp"], p & t).alias("tp"), add(a["fp"], p & ~t).alias("fp"), add(a["fn"], ~p & t).alias("fn"))

    order = F.sort_array(F.concat(*events(pred, 1, 0), *events(truth, 0, 1)))
    return F.aggregate(order, state, step, lambda a: F.struct(a["tp"].alias("tp"), a["fp"].alias("fp"), a["fn"].alias("fn")))


def count_at_most(values: Column, bound: Column) -> Column:
    """How many of the ascending ``values`` are <= ``bound``, by binary search."""
    n = F.size(values)
    steps = F.sequence(F.lit(0), F.ceil(F.log2(n + 1)).cast("int"))

    def halve(a, _):
        mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        low = F.get(values, mid) <= bound
        go = a["lo"] < a["hi"]
        return F.struct(F.when(go & low, mid + 1).otherwise(a["lo"]).alias("lo"),
                        F.when(go & ~low, mid).otherwise(a["hi"]).alias("hi"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), n.alias("hi")), halve, lambda a: a["lo"])
