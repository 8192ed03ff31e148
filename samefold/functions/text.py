"""Normalisation, tokens and scalar keys as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Everything that is neither letter, number, underscore nor white space.
SYMBOLS = r"[^\p{L}\p{N}_\s]"
URL = r"https?://\S+|www\.\S+"
#: Country spellings and their canonical form (fixed values).
COUNTRIES = {
    "us": "us",
    "usa": "us",
    "united states": "us",
    "united states of america": "us",
    "in": "india",
    "ind": "india",
    "india": "india",
}


def _fold(s: pd.Series) -> pd.Series:
    return s.fillna("").map(lambda t: unicodedata.normalize("NFKC", t).casefold())


def nfkc(c: Column) -> Column:
    """Compatibility composition; null is the empty text."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.fillna("").map(lambda t: unicodedata.normalize("NFKC", t))

    return run(c)


def casefold(c: Column) -> Column:
    """NFKC and full case folding."""
    return F.pandas_udf(_fold, "string")(c)


def collapse(c: Column) -> Column:
    """Runs of white space to one space, trimmed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def normalize_text(c: Column, urls=False, marks=False, ascii_only=False) -> Column:
    """Lower-case, drop URLs and symbols, collapse.

    ``marks`` keeps combining marks, ``ascii_only`` drops all other letters.
    """
    out = F.lower(F.coalesce(c, F.lit("")))
    if urls:
        out = F.regexp_replace(out, URL, " ")
    pattern = r"[^a-z0-9_\s]" if ascii_only else SYMBOLS.replace("_", r"_\p{M}") if marks else SYMBOLS
    return collapse(F.regexp_replace(out, pattern, " "))


def normalize_name(c: Column) -> Column:
    """The documented normaliser: folded, marks kept, underscores dropped."""
    return collapse(F.regexp_replace(F.regexp_replace(casefold(c), URL, " "), r"[^\p{L}\p{M}\p{N}\s]", " "))


def normalize_country(c: Column, fold=False) -> Column:
    """Canonical country (N5); ``fold`` adds NFKC and case folding through Python."""
    base = collapse(casefold(c) if fold else F.lower(F.coalesce(c, F.lit(""))))
    table = F.create_map(*[F.lit(x) for kv in COUNTRIES.items() for x in kv])
    return F.coalesce(F.try_element_at(table, base), base)


def words(c: Column) -> Column:
    """All words of a normalised text, none for an empty one."""
    return F.filter(F.split(c, " "), lambda x: x != "")


def tokens(c: Column, least=2) -> Column:
    """Words of at least ``least`` characters."""
    return F.filter(F.split(c, " "), lambda x: F.length(x) >= least)


def first_tokens(c: Column, n: int, least: int, slice_first=True) -> Column:
    """The first ``n`` address words; cut before or after the length test."""
    if slice_first:
        return F.filter(F.slice(words(c), 1, n), lambda x: F.length(x) >= least)
    return F.slice(tokens(c, least), 1, n)


def token_at(t: Column, i: int) -> Column:
    """The i-th token, from the end if negative, or the empty text."""
    return F.coalesce(F.try_element_at(t, F.lit(i)), F.lit(""))


def compact(c: Column) -> Column:
    return F.regexp_replace(c, " ", "")


def prefix(c: Column, n: int) -> Column:
    """First ``n`` characters without spaces, empty if there are fewer."""
    k = compact(c)
    return F.when(F.length(k) >= n, F.substring(k, 1, n)).otherwise("")


def suffix(c: Column, n: int) -> Column:
    """Last ``n`` characters without spaces, empty if there are fewer."""
    k = compact(c)
    return F.when(F.length(k) >= n, F.right(k, F.lit(n))).otherwise("")


def first_number(c: Column, bounded=True) -> Column:
    """First number of 1-6 digits standing alone, or first digits."""
    return F.regexp_extract(c, r"\b([0-9]{1,6})\b", 1) if bounded else F.regexp_extract(c, r"([0-9]+)", 1)


def numbers(c: Column, most: int | None = None) -> Column:
    """Distinct digit runs, cut into parts of ``most`` digits where given."""
    run = rf"(\p{{Nd}}{{1,{most}}})" if most else r"(\p{Nd}+)"
    return F.array_distinct(F.regexp_extract_all(c, F.lit(run), F.lit(1)))


def char_grams(c: Column, n=3) -> Column:
    """Distinct character n-grams without spaces."""
    k = compact(c)
    some = F.transform(F.sequence(F.lit(1), F.length(k) - (n - 1)), lambda i: F.substring(k, i, F.lit(n)))
    return F.array_distinct(F.when(F.length(k) >= n, some).otherwise(F.array().cast("array<string>")))
