"""Marker-name, slug and file-name expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name fragments that identify channel roles.
BLANK_PREFIXES = ("blank", "empty")
HOECHST_FRAGMENT = "hoechst"
NUCLEAR_FRAGMENTS = ("dapi", "hoechst", "draq5", "dna", "syto")
VOCAB_SKIP_FRAGMENTS = ("hoechst", "empty", "blank", "draq")

# Marker status tokens.
RESOLVED, REVIEW, NOVEL = "RESOLVED", "REVIEW", "NOVEL"


def strip(col: Column) -> Column:
    """Remove any leading and trailing white space, tabs included."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def clean_marker(col: Column) -> Column:
    """Lower case; ``- space : ( )`` to ``_``; alpha to ``a``; no ``/``."""
    return strip(F.translate(F.lower(col), "- :()α/", "_____a"))


def match_key(col: Column) -> Column:
    """Cleaned name without separators, the key of exact matching."""
    return F.replace(clean_marker(col), F.lit("_"), F.lit(""))


def contains_any(col: Column, fragments: Iterable[str]) -> Column:
    return col.rlike("|".join(re.escape(f) for f in fragments))


def is_blank_channel(col: Column) -> Column:
    name = F.lower(strip(col))
    return name.rlike("^(" + "|".join(BLANK_PREFIXES) + ")")


def is_hoechst(col: Column) -> Column:
    return F.lower(col).contains(HOECHST_FRAGMENT)


def is_qc_channel(col: Column) -> Column:
    """Blank, empty and Hoechst channels, dropped from analysis by default."""
    return is_blank_channel(col) | is_hoechst(col)


def is_nuclear(col: Column) -> Column:
    return contains_any(clean_marker(col), NUCLEAR_FRAGMENTS)


def glob_regex(pattern: str) -> str:
    """Anchored regular expression for a shell-style pattern."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        close = pattern.find("]", i + 2) if ch == "[" else -1
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif close > 0:
            body = pattern[i + 1 : close].replace("\\", "\\\\")
            negate = body.startswith("!")
            out.append("[" + ("^" + body[1:] if negate else body) + "]")
            i = close
        else:
            out.append(re.escape(ch))
        i += 1
    return "^(?s:" + "".join(out) + ")$"


def glob_any(col: Column, patterns: Iterable[str]) -> Column:
    """True where the lower-cased name matches any pattern, case ignored."""
    regexes = [glob_regex(p.lower()) for p in patterns]
    return F.lower(col).rlike("|".join(regexes)) if regexes else F.lit(False)


def common_prefix_len(a: Column, b: Column) -> Column:
    """Length of the shared leading run of two strings."""
    longest = F.least(F.length(a), F.length(b))
    lengths = F.when(longest > 0, F.sequence(F.lit(1), longest)).otherwise(F.array().cast("array<int>"))
    return F.size(F.filter(lengths, lambda n: F.left(a, n) == F.left(b, n)))


def slugify(col: Column) -> Column:
    """Lower case, runs of other characters to one ``_``, ends trimmed."""
    return F.btrim(F.regexp_replace(F.lower(col), "[^a-z0-9]+", "_"), F.lit("_"))


def variant_name(col: Column) -> Column:
    """``markers_<slug>``; ``markers_all`` without a selection; empty slug is an error."""
    slug = slugify(col)
    return (
        F.when(col.isNull(), F.lit("markers_all"))
        .when(slug == "", F.raise_error(F.concat(F.lit("no usable characters in selection name: "), col)))
        .otherwise(F.concat(F.lit("markers_"), slug))
    )


def output_stem(col: Column) -> Column:
    """File name without its (OME-)TIFF suffix."""
    return F.regexp_replace(col, r"(\.ome)?\.tiff?$", "")


def path_hash(col: Column) -> Column:
    """First 12 hex digits of the SHA-1 of a path."""
    return F.left(F.sha1(col), F.lit(12))


def is_blank_cell(col: Column) -> Column:
    """Null, NaN, empty or the text ``nan``."""
    text = F.lower(strip(col.cast("string")))
    return col.isNull() | text.isin("", "nan")


def fill_blank(current: Column, fallback: Column) -> Column:
    """Keep a filled cell, else take the fallback."""
    return F.when(is_blank_cell(current), fallback).otherwise(current)
