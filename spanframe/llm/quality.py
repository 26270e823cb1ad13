"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

A rule is a Boolean column that is true where a document must go.  The cascade
measures every rule on a bounded sample (its cost per row and the share of
rows it rejects) and evaluates the rules in order of rejections per cost, each
only on rows that all rules before it let pass.  The order changes the work,
never the verdict: a document is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, packed, unpacked, word_array

SHINGLE = 5
COUNTS = ("_n_words", "_word_chars", "_n_symbols", "_n_lines", "_n_dup_lines", "_n_repeat_words")
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


@dataclass(frozen=True)
class Measured:
    rule: Rule
    cost_s: float
    rejected: float

    @property
    def rank(self) -> float:
        return self.rejected / max(self.cost_s, 1e-9)


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts the rules read, all of type long.

    ``_n_words``; ``_word_chars`` (code points in words); ``_n_symbols``;
    ``_n_lines`` and ``_n_dup_lines`` (lines with a word; those equal to an
    earlier one); ``_n_repeat_words`` (words in five-word windows found twice
    or more in the text, the first included).  A null or empty text counts 0.

    Each text is handled inside its own row: windows become 64-bit hashes, and
    only texts with a repeated hash sort their windows, so the work is linear
    for most texts and n log n for the rest.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    word = F.lit(r"[^\x20\x09-\x0D]")
    n = F.size("_w")
    at = lambda i: F.get(F.col("_w"), i)
    window = lambda i: F.xxhash64(*[at(i + k) for k in range(SHINGLE)])
    d = docs.withColumn("_w", word_array(F.col(text_col)))
    d = d.withColumns({
        "_n_words": n.cast("long"),
        "_word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "_n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "_lines": F.filter(F.split(text, "\n"), lambda x: F.rlike(x, word)),
        "_h": F.when(n >= SHINGLE, F.transform(F.sequence(F.lit(0), n - SHINGLE), window))
               .otherwise(F.array().cast("array<bigint>")),
    }).drop("_w")
    # windows in hash order, only where some hash is found twice
    d = d.withColumns({
        "_n_lines": F.size("_lines").cast("long"),
        "_n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_p": F.when(F.size(F.array_distinct("_h")) < F.size("_h"),
                     F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    }).drop("_lines", "_h")
    pair = lambda j: F.get(F.col("_p"), j)["h"]
    twice = F.transform("_p", lambda p, j: F.when(
        F.coalesce(p["h"] == pair(j - 1), F.lit(False)) | F.coalesce(p["h"] == pair(j + 1), F.lit(False)), p["i"]))
    d = d.withColumn("_s", F.sort_array(F.array_compact(twice))).drop("_p")
    # a window covers its five words, or up to the next one that is covered too
    covered = F.transform("_s", lambda s, j: F.least(
        F.lit(SHINGLE), F.coalesce(F.get(F.col("_s"), j + 1) - s, F.lit(SHINGLE))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, c: a + c)
    return d.withColumn("_n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("_s")


def base_rules() -> list[Rule]:
    return [
        Rule("too_short", F.col("_n_words") < 10),
        Rule("repeated_words", 100 * F.col("_n_repeat_words") > 20 * F.col("_n_words")),
    ]


def default_rules(text_col: str = "text") -> list[Rule]:
    """Base rules and those that need no list of words, so that no language is at a disadvantage."""
    text = F.col(text_col)
    return base_rules() + [
        Rule("symbols", 10 * F.col("_n_symbols") > F.col("_n_words")),
        Rule("repeated_lines", 10 * F.col("_n_dup_lines") > 3 * F.col("_n_lines")),
        Rule("word_length", (F.col("_word_chars") < 2 * F.col("_n_words"))
             | (F.col("_word_chars") > 20 * F.col("_n_words"))),
        Rule("shouting", 2 * F.regexp_count(text, F.lit(r"\p{Lu}")) > F.regexp_count(text, F.lit(r"\p{L}"))),
        Rule("exclamations", 10 * F.regexp_count(text, F.lit("!!")) > F.col("_n_words")),
    ]


def measure(docs: DataFrame, rules: list[Rule], sample_rows: int = 2000) -> list[Measured]:
    """Cost and selectivity of each rule on at most ``sample_rows`` rows, best first.

    The sample is written once; each rule's job runs twice, and the second run
    counts, so compiling is not mistaken for cost.  An empty sample keeps the
    given order.
    """
    sample = materialise(docs.limit(sample_rows))

    def timed(frame: DataFrame) -> tuple[float, int]:
        frame.count()
        began = time.perf_counter()
        found = frame.count()
        return time.perf_counter() - began, found

    scan_s, rows = timed(sample.filter(F.lit(True)))
    if not rows:
        return [Measured(r, 0.0, 0.0) for r in rules]
    out = []
    for r in rules:
        s, rejected = timed(sample.filter(F.coalesce(r.rejects, F.lit(False))))
        out.append(Measured(r, max(s - scan_s, 1e-4), rejected / rows))
    return sorted(out, key=lambda m: -m.rank)


def cascade(docs: DataFrame, rules: list[Rule], sample_rows: int = 2000) -> DataFrame:
    """``docs`` with ``_kept`` (boolean): no rule rejects the row.

    ``docs`` must hold the columns the rules read.  A rule that gives null does
    not reject.  A CASE expression stops at the first rule that rejects, so the
    rules behind it are not evaluated for that row.  Repeated rows are judged
    alike; an empty table stays empty; without rules every row is kept.
    """
    rejected = F.lit(False)
    for m in reversed(measure(docs, rules, sample_rows) if rules else []):
        rejected = F.when(F.coalesce(m.rule.rejects, F.lit(False)), F.lit(True)).otherwise(rejected)
    return docs.withColumn("_kept", ~rejected)


def judge(docs: DataFrame, text_col: str = "text", rules: list[Rule] | None = None,
          sample_rows: int = 2000) -> DataFrame:
    """``docs`` with the counts of ``text_statistics`` and the verdict ``_kept``.

    ``rules`` read the counts and the text, as ``text``.  A null or empty text
    has no words and is rejected as too short.  All columns of ``docs`` stay,
    null ids included; one named like a count or the verdict is replaced.
    """
    d = cascade(text_statistics(packed(docs, text=text_col)), default_rules() if rules is None else rules, sample_rows)
    return unpacked(d, docs.columns, **{c: F.col(c) for c in (*COUNTS, "_kept")})
