"""Span-list expressions: parse the five literal dialects, format, mask.

A span is ``struct<start:int, end:int>`` (half-open char range); a span list
is ``array<span>``.  All parsers are native expressions, so they run inside
whole-stage codegen, let filters push past them and work on streams.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def span(start: Column, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))


def _piece_to_span_single_blank(x: Column) -> Column:
    parts = F.split(F.trim(x), " ")
    return span(F.element_at(parts, 1), F.element_at(parts, 2))


def _piece_to_span_ws(x: Column) -> Column:
    parts = F.split(F.trim(x), r"\s+")
    return span(F.element_at(parts, 1), F.element_at(parts, 2))


def parse_loc_strip_split(c) -> Column:
    """Dialect ``strip_split``: drop ``[]'``, split on ``[,;]``, trim, split
    on one blank.  Source order kept."""
    pieces = F.split(F.translate(_c(c), "[]'", ""), "[,;]")
    pieces = F.filter(pieces, lambda x: F.trim(x) != "")
    return F.transform(pieces, _piece_to_span_single_blank)


def parse_loc_sorted(c) -> Column:
    """Dialect ``sorted_decode``: ``,``->``;``, split ``;``, skip empties,
    split on whitespace, stable sort by start."""
    txt = F.translate(F.translate(_c(c), "[]'", ""), ",", ";")
    pieces = F.filter(F.split(txt, ";"), lambda x: F.trim(x) != "")
    tagged = F.transform(pieces, lambda x, i: F.struct(
        _piece_to_span_ws(x)["start"].alias("start"), i.alias("i"),
        _piece_to_span_ws(x)["end"].alias("end")))
    ordered = F.sort_array(tagged)
    return F.transform(ordered, lambda s: span(s["start"], s["end"]))


# A Python string literal in either quote style, escapes included
STRING_LITERAL = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*\""""


def parse_string_list(c) -> Column:
    """Python list literal of strings (``['a b', "c's"]``) -> array<string>.

    Both quote styles and backslash escapes are read; never evaluated as code.
    A null literal gives null, a literal without strings an empty list."""
    items = F.regexp_extract_all(_c(c), F.lit(STRING_LITERAL), 0)
    inner = F.transform(items, lambda x: F.substring(x, F.lit(2), F.length(x) - 2))
    return F.transform(inner, lambda x: F.when(F.contains(x, F.lit("\\")), F.regexp_replace(
        F.regexp_replace(F.regexp_replace(x, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"),
                         r"(?<!\\)((?:\\\\)*)\\t", "$1\t"), r"\\(.)", "$1")).otherwise(x))


def parse_loc_literal(c) -> Column:
    """Dialect ``literal_then_split``: literal -> elements -> split ``;`` ->
    split on one blank."""
    elems = parse_string_list(c)
    pieces = F.flatten(F.transform(elems, lambda x: F.split(x, ";")))
    return F.transform(pieces, _piece_to_span_single_blank)


def parse_loc_scoring(c) -> Column:
    """Dialect ``scoring``: join the elements with ``;`` then split ``;`` and
    whitespace."""
    joined = F.array_join(parse_string_list(c), ";")
    pieces = F.filter(F.split(joined, ";"), lambda x: x != "")
    return F.transform(pieces, _piece_to_span_ws)


def parse_loc_prediction(c) -> Column:
    """Dialect ``prediction``: ``""`` -> []; split ``;`` then whitespace."""
    c = _c(c)
    pieces = F.filter(F.split(c, ";"), lambda x: F.trim(x) != "")
    return F.when(c == "", F.array().cast("array<struct<start:int,end:int>>")) \
        .otherwise(F.transform(pieces, _piece_to_span_ws))


def format_spans(c, sep: str = ";") -> Column:
    """array<span> -> ``"s e;s e"`` (``"; "`` for the blank variant)."""
    return F.array_join(F.transform(_c(c), lambda s: F.concat_ws(
        " ", s["start"].cast("string"), s["end"].cast("string"))), sep)


def overlap_ratio(ts: Column, te: Column, rs: Column, re: Column) -> Column:
    """Overlap ratio with the reference's +1 convention:
    max(min(te,re)+1 - max(ts,rs), 0) / (te+1-ts)."""
    num = F.greatest(F.least(te, re) + 1 - F.greatest(ts, rs), F.lit(0))
    return num / (te + 1 - ts)
