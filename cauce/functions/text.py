"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strip_all(text: Column) -> Column:
    """Remove every kind of white space at both ends (``trim`` only knows blanks)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def squeeze(text: Column) -> Column:
    """Collapse runs of white space to one blank."""
    return F.regexp_replace(text, r"(?U)\s+", " ")


def title_case(text: Column) -> Column:
    """Capital after every non-letter: ``o'neil mary-ann`` becomes ``O'Neil Mary-Ann``."""
    chunks = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(chunks, F.initcap), "")


def normalize_name(text: Column) -> Column:
    """Strip, title-case and squeeze a person or place name."""
    return squeeze(title_case(strip_all(text)))


def normalize_code(text: Column) -> Column:
    """Strip and upper-case a code."""
    return F.upper(strip_all(text))


def blank_to_null(text: Column, tokens: tuple[str, ...] = ("",)) -> Column:
    """NULL for the given tokens, the text otherwise."""
    return F.when(~text.isin(*tokens), text)
