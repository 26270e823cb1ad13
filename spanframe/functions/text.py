"""Text expressions (all JVM-side, codegen'd, streaming-safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The segment rule used for word tokens with offsets.  A word
# is a maximal run of Unicode letters/digits; everything else is a gap.
# Words and gaps alternate and cover the whole text.
SEGMENT_PATTERN = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"
WORD_START_PATTERN = r"^[\p{L}\p{N}]"
WORD_PATTERN = r"[\p{L}\p{N}]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_feature_text(c) -> Column:
    """`I-year`->`1-year`, then `-OR-`->` or `, then `-`->blank (in this order)."""
    c = _c(c)
    c = F.replace(c, F.lit("I-year"), F.lit("1-year"))
    c = F.replace(c, F.lit("-OR-"), F.lit(" or "))
    return F.replace(c, F.lit("-"), F.lit(" "))


def norm_feature_text_train(c) -> Column:
    """Training variant: no `I-year` rule."""
    c = F.replace(_c(c), F.lit("-OR-"), F.lit(" or "))
    return F.replace(c, F.lit("-"), F.lit(" "))


def norm_text_submission(c) -> Column:
    """Submission variant: `-OR-`->`;-` which the next rule turns into `; `;
    control blanks become spaces."""
    c = F.replace(_c(c), F.lit("-OR-"), F.lit(";-"))
    c = F.replace(c, F.lit("-"), F.lit(" "))
    return clean_spaces(c)


def clean_spaces(c) -> Column:
    """`\\n`, `\\t`, `\\r` -> blank; length preserving so offsets stay valid."""
    return F.translate(_c(c), "\n\t\r", "   ")


# The characters that Python's str.strip() takes for white space
PYTHON_BLANKS = ("\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
                 "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip_note(c) -> Column:
    """Python ``str.strip()``: Unicode white space goes at both ends."""
    return F.btrim(_c(c), F.lit(PYTHON_BLANKS))


def strip_shift(c) -> Column:
    """Number of leading blanks removed by :func:`strip_note` (offset shift)."""
    c = _c(c)
    return F.length(c) - F.length(F.ltrim(c, F.lit(PYTHON_BLANKS)))


def segments(text) -> Column:
    """Alternating word and gap segments that cover the text."""
    return F.regexp_extract_all(_c(text), F.lit(SEGMENT_PATTERN), 1)
