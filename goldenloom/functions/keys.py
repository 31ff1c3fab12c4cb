"""Normalised keys, null rules and text clean-up as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = ("", "null", "na", "n/a")


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value worked out once, however often f uses it."""
    return F.transform(F.array(value), f)[0]


def norm(c: Column | str) -> Column:
    """The default key equality: trimmed and lower-cased."""
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))


def null_if_in(c: Column | str, values=BLANKS) -> Column:
    """Null where the normalised value is one of `values`."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.coalesce(norm(c), F.lit("")).isin(*values), c)


def content_hash(*columns: Column | str) -> Column:
    """SHA-256 of the normalised values, null as empty, joined by a bar."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(norm(c), F.lit("")) for c in columns)), 256)


def squeeze(c: Column) -> Column:
    """Runs of white space to one blank."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


# Accented letters and what they fold to.
ACCENTED, PLAIN = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ", "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def ascii_fold(c: Column) -> Column:
    """Accents off; other characters outside ASCII dropped; ß as ss."""
    return F.regexp_replace(F.translate(F.replace(c, F.lit("ß"), F.lit("ss")), ACCENTED, PLAIN), r"[^\x00-\x7F]", "")


def replace_words(c: Column, words: dict[str, str]) -> Column:
    """Whole words by a dictionary, one pass over the split text."""
    known = F.create_map(*(F.lit(x) for pair in words.items() for x in pair))
    return F.array_join(F.transform(F.split(c, " "), lambda w: F.coalesce(F.get(F.array(known[w]), F.lit(0)), w)), " ")


def initials(c: Column) -> Column:
    """First letters of the words of a name."""
    return F.array_join(F.transform(F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != ""), lambda w: F.upper(F.substring(w, 1, 1))), "")


def join_same(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """Null-safe join on columns of the same names; the left ones stay."""
    other = right.withColumnsRenamed({n: f"_right_{n}" for n in names})
    on = F.lit(True)
    for n in names:
        on = on & F.col(n).eqNullSafe(F.col(f"_right_{n}"))
    return left.join(other, on, how).drop(*(f"_right_{n}" for n in names))
