"""Text normalisation as JVM regex expressions (TX1, TX6-TX10, TX15).

Patterns use explicit Unicode classes so the Java engine (Spark) and RE2
(the DuckDB twins) agree on them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# HTML-to-text patterns (drop <head>, links -> HYPERLINK, strip
# tags, collapse newline runs) and the number pattern of the reference.
HEAD_RE = r"(?is)<head.*?>.*?</head>"
LINK_RE = r"(?is)<a\s.*?>"
TAG_RE = r"(?s)<.*?>"
NEWLINES_RE = r"(\s*\n)+"
NUMBER_RE = r"\d+(?:\.\d*(?:[eE]\d+))?"
# URL: scheme or www. prefix up to whitespace / quote / angle bracket
URL_RE = r"(?i)(?:(?:https?|ftp)://|www\.)[^\s<>\"']+"
# Python's \W (Unicode): anything but letters, digits (any script) and '_'
PUNCT_RE = r"[^\p{L}\p{N}_]+"
# Python's str.split() whitespace set
WS_RE = (r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
         r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+")
# Common named / numeric entities, &amp; last so "&amp;lt;" unescapes once.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&apos;", "'"), ("&nbsp;", " "), ("&copy;", "©"),
            ("&middot;", "·"), ("&amp;", "&")]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def unescape_common(c) -> Column:
    out = _c(c)
    for ent, ch in ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


def html_to_text(c, unescape: bool = True) -> Column:
    """TX1."""
    t = F.regexp_replace(_c(c), HEAD_RE, "")
    t = F.regexp_replace(t, LINK_RE, " HYPERLINK ")
    t = F.regexp_replace(t, TAG_RE, "")
    t = F.regexp_replace(t, NEWLINES_RE, "\n")
    return unescape_common(t) if unescape else t


def lower(c) -> Column:
    """TX6."""
    return F.lower(_c(c))


def replace_urls(c) -> Column:
    """TX7: URLs -> ' URL '."""
    return F.regexp_replace(_c(c), URL_RE, " URL ")


def replace_numbers(c) -> Column:
    """TX8."""
    return F.regexp_replace(_c(c), NUMBER_RE, "NUMBER")


def strip_punctuation(c) -> Column:
    """TX9."""
    return F.regexp_replace(_c(c), PUNCT_RE, " ")


def tokens(c) -> Column:
    """TX10: whitespace split without empty tokens (array<string>)."""
    return F.filter(F.split(_c(c), WS_RE), lambda w: w != "")


def normalize(c, lower_case=True, urls=True, numbers=True, punctuation=True) -> Column:
    """The reference's per-message order: lower, URLs, numbers, punctuation."""
    t = _c(c)
    if lower_case:
        t = lower(t)
    if urls and lower_case:     # texts without a scheme or www. are not searched
        t = F.when(F.contains(t, F.lit("://")) | F.contains(t, F.lit("www.")), replace_urls(t)).otherwise(t)
    elif urls:
        t = replace_urls(t)
    if numbers:
        t = replace_numbers(t)
    if punctuation:
        t = strip_punctuation(t)
    return t


def words(df, c: str, out: str = "word", plain: bool = False):
    """TX10 as rows: one per token.  ``plain``: only spaces stand between them, as
    after ``strip_punctuation``."""
    if not plain:
        return df.withColumn(out, F.explode(tokens(c))).drop(c)
    return df.withColumn(out, F.explode(F.split(_c(c), " "))).drop(c).where(F.col(out) != "")


def currency_label(c, unit: int = 1000) -> Column:
    """TX15: '$%dk' label."""
    return F.format_string("$%dk", (_c(c) / F.lit(unit)).cast("int"))
