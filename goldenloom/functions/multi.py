"""Delimited multi-value strings and arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def string_set(c: Column, sep: str = "|") -> Column:
    """Aggregate: the distinct non-blank values, sorted and joined."""
    return F.concat_ws(sep, F.sort_array(F.collect_set(F.nullif(F.trim(c), F.lit("")))))


def string_list(c: Column, sep: str = "|") -> Column:
    """Aggregate: all values, sorted and joined."""
    return F.concat_ws(sep, F.sort_array(F.collect_list(c)))


def zip_lists(df: DataFrame, lists: dict[str, str], sep: str = r"\|") -> DataFrame:
    """One row per place that all of the delimited columns have: explode of the zipped arrays, cut to the
    shortest. lists: delimited column to the name of its element."""
    arrays = {c: F.split(F.col(c), sep) for c in lists}
    least = F.least(*(F.size(a) for a in arrays.values())) if len(lists) > 1 else F.size(next(iter(arrays.values())))
    cut = [F.slice(a, 1, least).alias(n) for a, n in zip(arrays.values(), lists.values())]
    rest = [c for c in df.columns if c not in lists]
    return df.select(*rest, F.explode(F.arrays_zip(*cut)).alias("_z")).select(*rest, *(F.col(f"_z.{n}") for n in lists.values()))


def distinct_tokens(c: Column, sep: str = "|") -> Column:
    """Tokens that differ only by case and punctuation once each, the first form kept."""
    key = lambda x: F.regexp_replace(F.lower(x), "[^a-z0-9]", "")
    tokens = F.split(c, f"[{sep}]")
    first = F.filter(tokens, lambda x, i: F.array_position(F.transform(tokens, key), key(x)) == i + 1)
    return F.array_join(first, sep)


def sorted_tokens(c: Column, seps: str = ",;|", out: str = "|") -> Column:
    """Any of the delimiters made one, and the trimmed tokens sorted."""
    return F.array_join(F.array_sort(F.filter(F.transform(F.split(c, f"[{seps}]"), lambda x: F.trim(x)), lambda x: x != "")), out)


def keep_matching(c: Column, pattern: str, sep: str = "|", drop: bool = False) -> Column:
    """List elements that match the pattern (or, with drop, the others)."""
    return F.array_join(F.filter(F.split(c, f"[{sep}]"), lambda x: ~x.rlike(pattern) if drop else x.rlike(pattern)), sep)
