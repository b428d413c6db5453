"""String expressions. All are JVM-side column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# The Unicode White_Space characters.
UNICODE_SPACES = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Markup runs (a dot stops only at \n) and everything that is not a word character.
MARKUP = r"(?d)<.*?>"
NON_WORD = r"[^\p{L}\p{N}_]+"


def trim_ws(c: Column) -> Column:
    """Strip every Unicode white-space character; Spark's plain ``trim`` strips only the blank."""
    return F.btrim(c, F.lit(UNICODE_SPACES))


def normal(c: Column) -> Column:
    """Lower-cased, stripped form of a code or label."""
    return F.lower(trim_ws(c))


def clean_text(c: Column) -> Column:
    """Markup out, punctuation to blanks, runs of blanks to one.

    White space is neither letter, digit nor underscore, so one pattern covers both the
    punctuation step and the blank-collapsing step.
    """
    words = F.regexp_replace(F.regexp_replace(c, MARKUP, " "), NON_WORD, " ")
    return F.btrim(words)


def contains_any(cols: Sequence[Column], terms: Sequence[str]) -> Column:
    """True where the lower-cased, blank-joined texts contain one of the terms.

    The joined text is the one element of an array, so that it is built once per row and not once
    per term.
    """
    text = F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in cols]))
    wanted = list(dict.fromkeys(t.lower() for t in terms))
    if not wanted:
        return F.lit(False)
    return F.exists(F.array(text), lambda x: reduce(or_, [x.contains(t) for t in wanted]))


def surrogate_key(cols: Sequence[Column], sep: str = "_", method: str = "md5") -> Column:
    """Stable text key of the joined values; NULL when any part is NULL."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(c.cast("string"))
    joined = F.concat(*parts)
    if method == "md5":
        return F.md5(joined)
    if method == "xxhash64":
        return F.when(joined.isNotNull(), F.xxhash64(joined).cast("string"))
    raise ValueError(f"unknown key method {method!r}")


def joined_key(cols: Sequence[Column], sep: str = "-") -> Column:
    """Readable key of the joined values; NULL when any part is NULL."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(c.cast("string"))
    return F.concat(*parts)


def absolute_url(c: Column, host: str) -> Column:
    """Put the host before a link that starts with ``/``."""
    return F.when(c.startswith("/"), F.concat(F.lit(host), c)).otherwise(c)


def first_non_empty(*cols: Column) -> Column:
    """The first value that is neither NULL nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def prefix(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def class_by_membership(c: Column, codes: Sequence[str], in_label: str, out_label: str) -> Column:
    """``in_label`` where the value is one of ``codes``, otherwise ``out_label``."""
    return F.when(c.isin(list(codes)), F.lit(in_label)).otherwise(F.lit(out_label))


# Airport codes counted as domestic.
DOMESTIC_AIRPORTS = (
    "SGN", "HAN", "DAD", "CXR", "PQC", "HPH", "VII", "VDH", "UIH", "VCA", "VKG",
    "VCS", "DLI", "TBB", "HUI", "PXU", "BMV", "VDO", "THD", "DIN", "VCL",
)

# Terms that mark a local article.
LOCAL_TERMS = (
    "đà nẵng", "bà nà", "bà nà hills", "sơn trà", "mỹ khê",
    "ngũ hành sơn", "cầu rồng", "hòa vang", "da nang", "danang",
)
