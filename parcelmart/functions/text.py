"""Text helpers re-aimed from the Python snippets.

Printing becomes a column of the printed text; everything is a native
expression except fixed-point formatting of DOUBLE values (``format_fixed``),
which needs Python's exact-binary rounding and runs as an Arrow-batched
pandas UDF.
"""

from __future__ import annotations

import re
import sys

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- Y1: fixed-point formatting ------------------------------------------------------

@F.pandas_udf(T.StringType())
def _format_fixed_udf(values: pd.Series, digits: pd.Series) -> pd.Series:
    out = []
    for v, n in zip(values, digits):
        if v is None or n is None or pd.isna(v) or pd.isna(n):
            out.append(None)
        else:
            out.append(f"{float(v):.{int(n)}f}")
    return pd.Series(out, dtype=object)


def format_fixed(number, digits) -> Column:
    """``'{number:.{digits}f}'`` -- ``digits`` may differ per row.

    Python rounds the exact binary value half-to-even (0.125 -> '0.12',
    2.675 -> '2.67'); Java's formatter does not, so DOUBLE input goes through
    a pandas UDF. For a DECIMAL column and a fixed ``digits`` use
    ``format_fixed_decimal`` (native).
    """
    d = digits if isinstance(digits, Column) else F.lit(digits)
    return _format_fixed_udf(_col(number).cast("double"), d.cast("int"))


def format_fixed_decimal(number, digits: int) -> Column:
    """Y1 for DECIMAL input: round half-even to ``digits`` and print that scale."""
    return F.bround(_col(number), digits).cast(f"decimal(38,{digits})").cast("string")


# --- Y2 -------------------------------------------------------------------------------

def py_mod(total, n=3) -> Column:
    """Y2: Python ``total % n`` (result takes the divisor's sign); default divisor 3.

    ``n = 0`` fails the task under ANSI mode, as Python raises.
    """
    d = n if isinstance(n, Column) else F.lit(n)
    t = _col(total)
    return ((t % d) + d) % d


# --- Y4: pass/fail message --------------------------------------------------------------

def pass_or_fail(grade, threshold: int = 50) -> Column:
    """Y4: 'failed' below ``threshold`` else 'passed'; NULL grade stays NULL."""
    g = _col(grade)
    return F.when(g < threshold, F.lit("failed")).when(g >= threshold, F.lit("passed"))


def grade_sentence(grade, threshold: int = 50) -> Column:
    """The printed line ``You <outcome> the quiz with a grade of <grade>``."""
    g = _col(grade)
    return F.concat(
        F.lit("You "), pass_or_fail(g, threshold), F.lit(" the quiz with a grade of "), g.cast("string")
    )


# --- Y5/Y6: dict iteration ----------------------------------------------------------------

def _py_str(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def key_value_line(key, value) -> Column:
    """``"{} = {}".format(k, v)`` for a key column and a value column."""
    return F.concat(_py_str(_col(key)), F.lit(" = "), _py_str(_col(value)))


def map_lines(df: DataFrame, map_col: str, keep: list[str] | None = None) -> DataFrame:
    """Y5 over a MapType column: one ``k = v`` line per entry (row-local explode)."""
    keep = keep or []
    return df.select(*keep, F.explode(map_col).alias("_k", "_v")).select(
        *keep, key_value_line("_k", "_v").alias("line")
    )


def rjust(c, width: int = 10) -> Column:
    """``str.rjust(width)``: pad on the left with spaces, never truncate."""
    s = _col(c)
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, " "))


def begins_with_line(key, initial, width: int = 10) -> Column:
    """``'{} begins with "{}"'.format(key.rjust(10), initial)``."""
    return F.concat(rjust(key, width), F.lit(' begins with "'), _py_str(_col(initial)), F.lit('"'))


# --- Y7: keyword search -------------------------------------------------------------------

def _python_whitespace_class() -> str:
    """Regex class of the characters ``str.split()`` splits on (rule: ``str.isspace``)."""
    points = [cp for cp in range(sys.maxunicode + 1) if chr(cp).isspace()]
    ranges, start, prev = [], points[0], points[0]
    for cp in points[1:] + [None]:
        if cp is not None and cp == prev + 1:
            prev = cp
            continue
        ranges.append((start, prev))
        if cp is not None:
            start = prev = cp
    parts = [f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges]
    return "[" + "".join(parts) + "]"


# Java and RE2 both accept the \x{...} form.
WHITESPACE_CLASS = _python_whitespace_class()
WHITESPACE_RUN = WHITESPACE_CLASS + "+"


def word_tokens(text) -> Column:
    """``str.split()``: split on runs of Python whitespace, no empty tokens."""
    return F.filter(F.split(_col(text), WHITESPACE_RUN), lambda t: t != F.lit(""))


def normalized_tokens(text) -> Column:
    """Tokens with trailing '.' and ',' removed, lower-cased (leading ones are kept)."""
    return F.transform(word_tokens(text), lambda t: F.lower(F.rtrim(t, F.lit(".,"))))


def _quote(k: str) -> str:
    return "\\Q" + k.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def keyword_pattern(lowered: list[str]) -> str:
    """Regex matching a whitespace-delimited token equal to one of ``lowered``
    once trailing '.'/',' are removed; group 1 is the keyword.

    Matching the lower-cased text with this pattern is the same test as
    ``keyword.lower() in [t.rstrip('.,').lower() for t in text.split()]``.
    """
    alts = "|".join(_quote(k) for k in lowered)
    return f"(?:^|{WHITESPACE_CLASS})({alts})[.,]*(?={WHITESPACE_CLASS}|\\z)"


def contains_word(text, keyword: str) -> Column:
    """Y7 as a predicate: does ``text`` contain ``keyword`` as a normalised token."""
    return F.array_contains(normalized_tokens(text), F.lit(keyword.lower()))


def word_search(df: DataFrame, text: str, keywords: list[str], id_col: str) -> DataFrame:
    """``(keyword, id)`` for every document whose normalised tokens contain the
    lower-cased keyword; one row per (keyword, document), ids ascending.

    One pass over each whole text and no join: a single regular expression
    over the lower-cased text finds every keyword occurrence at token
    boundaries; the distinct hits are exploded and mapped back to the keywords
    as given (the outer form of explode, as the inner one repeats the expression
    in a filter below it). No keywords give no rows. The hit rows are hash-shuffled before the global sort, so the
    sort's range sampling reads those small rows instead of re-scanning the texts.
    """
    by_lower: dict[str, list[str]] = {}
    for k in dict.fromkeys(keywords):  # each distinct keyword once, in the given order
        by_lower.setdefault(k.lower(), []).append(k)
    # A token has no whitespace and never ends in '.' or ',' after stripping.
    matchable = [k for k in by_lower if k and not re.search(r"\s", k) and k[-1] not in ".,"]
    lowered = F.lower(F.col(text))
    hits = F.array_distinct(F.regexp_extract_all(lowered, F.lit(keyword_pattern(matchable)), 1)) if matchable \
        else F.array().cast("array<string>")
    if "" in by_lower:  # only a token made of '.'/',' normalises to ''
        empty = f"(?:^|{WHITESPACE_CLASS})[.,]+(?={WHITESPACE_CLASS}|\\z)"
        hits = F.when(lowered.rlike(empty), F.array_union(hits, F.array(F.lit("")))).otherwise(hits)
    found = df.select(id_col, F.explode_outer(hits).alias("_hit")).where(F.col("_hit").isNotNull())
    if not by_lower:
        return found.select(id_col, F.col("_hit").alias("keyword"))
    originals = F.create_map(*[x for kl, ks in by_lower.items() for x in (F.lit(kl), F.array(*map(F.lit, ks)))])
    return (
        found.select(id_col, F.explode(originals[F.col("_hit")]).alias("keyword"))
        .repartition(id_col)
        .orderBy("keyword", id_col)
    )


def keyword_hits(df: DataFrame, text: str, keywords: DataFrame, keyword: str, id_col: str) -> DataFrame:
    """Y7 with the keywords as a table: ``(id, keyword)`` for every document whose
    normalised tokens contain the lower-cased keyword; one row per (keyword, document).

    ``word_search`` puts its keywords into one expression, which grows with the
    list. Here each text is cut into its distinct tokens, row by row, and the
    tokens meet the distinct keywords in an equi-join, whatever their number:
    Spark broadcasts the keywords when their measured size allows and shuffles
    both sides by the token otherwise, where AQE splits a token that very many
    documents hold. Only ids and tokens cross, no texts. The rows are not sorted.

    A null keyword and a null text match nothing; a keyword given twice counts
    once, and keywords that differ in case only are each returned as given. The
    empty keyword matches documents with a token of '.' and ',' alone.
    """
    wanted = keywords.select(F.col(keyword).alias("keyword")).where("keyword IS NOT NULL").distinct()
    tokens = df.select(F.col(id_col).alias("_id"), F.explode(F.array_distinct(normalized_tokens(text))).alias("_token"))
    hits = tokens.join(wanted, F.col("_token") == F.lower("keyword"))
    return hits.select(F.col("_id").alias(id_col), "keyword")
