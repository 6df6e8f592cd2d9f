"""Text scalars as Spark Column expressions (STR-*, TOK-*, PRJ helpers).

All patterns are written with explicit Unicode classes so that they mean the
same thing in Java regex (Spark) and RE2 (the DuckDB oracle), and so that they
follow Python's Unicode ``\\w`` / ``\\s`` / ``\\d``:

* word character  = ``[\\p{L}\\p{N}_]``   (Java ``\\w`` is ASCII-only)
* white space     = tab, LF, VT, FF, CR, \\x1c-\\x1f, \\x85 and ``\\p{Z}``
* decimal digit   = ``\\p{Nd}``

Everything but character references (a table of thousands of names, which Python's
standard library has) stays inside JVM expressions (whole-stage codegen).
"""

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# ---------------------------------------------------------------- classes --
WORD = r"\p{L}\p{N}_"
SPACE = r"\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}"

TRIM_RE = rf"^[{SPACE}]+|[{SPACE}]+$"

# The characters Python's str.strip() removes (same set as SPACE).
SPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
               "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000")

# Tokeniser patterns (regex forms of the reference tokenisers).
TOKEN_PATTERNS = {
    "ws": rf"[^{SPACE}]+",                                            # TOK-A / TOK-G  \S+
    "word": rf"[{WORD}]+",                                            # TOK-B  \w+
    "word_or_symbol": rf"[{WORD}]+|[^{SPACE}]",                       # TOK-C  \w+|\S
    "annot": rf"[{WORD}]+ʻ?[{WORD}]*|['ʻ{WORD}]+|[^{WORD}{SPACE}]",   # TOK-D
    "serving": rf"[{WORD}]+ʻ?[{WORD}]+|['ʻ{WORD}]+|[^{WORD}{SPACE}]", # TOK-E
    "pretok": rf"[{WORD}]+|[^{WORD}{SPACE}]",                         # TOK-F
    "sklearn": rf"[{WORD}]{{2,}}",                                    # TOK-H  \b\w\w+\b
}

PUNCT_RE = r"^[\p{P}\p{S}]+$"
DIGIT_START_RE = r"^\p{Nd}"

# Okina and diacritic folding.
LEFT_QUOTE = "‘"
OKINA = "ʻ"
FOLD_FROM = "ĀĒĪŌŪāēīōūʻ"
FOLD_TO = "AEIOUaeiou"          # the unmatched okina is deleted

# HTML parts whose text is not part of get_text().
HTML_HIDDEN_RE = (
    r"(?i)<!--[\s\S]*?(?:-->|\z)"
    r"|<script\b[^>]*>[\s\S]*?(?:</script\s*>|\z)"
    r"|<style\b[^>]*>[\s\S]*?(?:</style\s*>|\z)"
    r"|<template\b[^>]*>[\s\S]*?(?:</template\s*>|\z)"
)
# An attribute value in quotes may hold ``>``; a tag whose quotes do not match ends at the first ``>``.
HTML_TAG_RE = r"""</?[A-Za-z!?](?:[^'">]++|"[^"]*+"|'[^']*+')*+>|</?[A-Za-z!?][^>]*>"""

SEP = "\u0001"


def utrim(c: Column) -> Column:
    """STR-06: Python ``str.strip()`` (Unicode white space on both ends).

    Character-set trim, not a regex: a plain scan from both ends.
    """
    return F.trim(c, F.lit(SPACE_CHARS))


def is_blank(c: Column) -> Column:
    return utrim(c) == ""


def normalize_okina(c: Column) -> Column:
    """STR-01: U+2018 → U+02BB, nothing else."""
    return F.translate(c, LEFT_QUOTE, OKINA)


def fold_diacritics(c: Column) -> Column:
    """STR-02: delete ʻokina, map the ten macron vowels to plain vowels."""
    return F.translate(c, FOLD_FROM, FOLD_TO)


@F.pandas_udf(StringType())
def decode_entities(texts: pd.Series) -> pd.Series:
    """Every named and numeric HTML5 character reference, as parsers read them (Arrow batches)."""
    return texts.map(html.unescape, na_action="ignore")


def html_to_text(c: Column, strip: bool = True) -> Column:
    """STR-03: concatenated text nodes (comments/script/style/template dropped)."""
    out = F.regexp_replace(c, HTML_HIDDEN_RE, "")
    out = decode_entities(F.regexp_replace(out, HTML_TAG_RE, ""))
    return utrim(out) if strip else out


def html_text_joined(c: Column) -> Column:
    """STR-04: stripped text nodes joined by one space (``stripped_strings``)."""
    out = F.regexp_replace(c, HTML_HIDDEN_RE, SEP)
    out = decode_entities(F.regexp_replace(out, HTML_TAG_RE, SEP))
    parts = F.transform(F.split(out, SEP), utrim)
    return F.array_join(F.filter(parts, lambda p: p != ""), " ")


def page_text(c: Column) -> Column:
    """STR-05: okina-normalised page text, unstripped get_text()."""
    return html_to_text(normalize_okina(c), strip=False)


def paragraph_rewrite(c: Column) -> Column:
    """PRJ-05: ``<p>`` → '', ``</p>`` → '. ', newline → space."""
    return F.replace(F.replace(F.replace(c, F.lit("<p>"), F.lit("")),
                               F.lit("</p>"), F.lit(". ")), F.lit("\n"), F.lit(" "))


def sentence_pieces(c: Column) -> Column:
    """PRJ-04 before filtering: newline → space, split on '. ', strip each."""
    return F.transform(F.split(F.replace(c, F.lit("\n"), F.lit(" ")), r"\. "), utrim)


def tokens(c: Column, kind: str) -> Column:
    """TOK-*: all matches of one tokeniser pattern, in order."""
    return F.regexp_extract_all(c, F.lit(TOKEN_PATTERNS[kind]), F.lit(0))


def is_punct(c: Column) -> Column:
    """STR-08: non-empty and every character is P* or S*."""
    return c.rlike(PUNCT_RE)


def starts_with_digit(c: Column) -> Column:
    return c.rlike(DIGIT_START_RE)


def all_upper(c: Column) -> Column:
    """PRJ-15: Python ``all(ch.isupper() for ch in s)`` (true for '')."""
    return c.rlike(r"^\p{Lu}*$")
