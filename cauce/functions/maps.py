"""Code-to-label expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from cauce.functions.text import strip_all, title_case


def literal_map(mapping: Mapping) -> Column:
    cells = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.create_map(*cells)


def lookup(key: Column, mapping: Mapping) -> Column:
    """Value for the key, NULL where the key is missing."""
    return F.try_element_at(literal_map(mapping), key)


def map_value(text: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Look up the stripped text, then its upper-case form, else the default."""
    bare = strip_all(text)
    return F.coalesce(lookup(bare, mapping), lookup(F.upper(bare), mapping), F.lit(default))


def map_or_keep(text: Column, mapping: Mapping[str, str]) -> Column:
    """Look up the stripped text; unmapped values come back as they were, unstripped."""
    return F.coalesce(lookup(strip_all(text), mapping), text)


def canonical_name(code: Column, name: Column, names: Mapping[str, str]) -> Column:
    """Official name of a known code, else the given name in title case."""
    return F.coalesce(lookup(code, names), title_case(name))


def label_codes(code: Column, labels: Mapping, default: str) -> Column:
    return F.coalesce(lookup(code, labels), F.lit(default))


def first_match(text: Column, patterns: list[tuple[tuple[str, ...], str]]) -> Column:
    """Tag of the first entry whose LIKE patterns all match."""
    result = F.lit(None).cast("string")
    for likes, tag in reversed(patterns):
        hit = F.lit(True)
        for like in likes:
            hit = hit & text.like(like)
        result = F.when(hit, F.lit(tag)).otherwise(result)
    return result


def bucketize(value: Column, edges: list[tuple[float, str]], last: str) -> Column:
    """Label of the first upper edge above the value; NULL falls in the last bucket."""
    result = F.lit(last)
    for edge, label in reversed(edges):
        result = F.when(value < F.lit(edge), F.lit(label)).otherwise(result)
    return result


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)
