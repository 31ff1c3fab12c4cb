"""Standardisation against vocabularies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldenloom.functions.keys import let, norm
from goldenloom.sources import files


#: The least score that a domain accepts.
ACCEPTED = {"city": 0.85, "disease": 0.8, "sponsor": 0.67}


# Characters that n-grams leave out, by the order of steps in gram_text().
LEFT_OUT = r"[().|\[\]{}'=?]"


def gram_text(c: Column) -> Column:
    """Text as n-grams are made of it: ASCII only, without brackets and dots, & as and, commas and dashes as blanks,
    words capitalised, single blanks, and one at each end."""
    plain = F.regexp_replace(F.lower(F.regexp_replace(c, r"[^\x00-\x7F]", "")), LEFT_OUT, "")
    spaced = F.regexp_replace(F.replace(plain, F.lit("&"), F.lit("and")), "[,-]", " ")
    # A letter after anything but a letter is a capital.
    parts = F.split(spaced, "(?<![a-z])(?=[a-z])")
    titled = F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))), "")
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(titled, " +", " ")), F.lit(" "))


def accepted(df: DataFrame, domain: str, score: str = "score") -> DataFrame:
    """The rows with the domain's least score."""
    return df.where(F.col(score) >= ACCEPTED[domain])


def grams(c: Column, n: int = 3, prepare: Callable[[Column], Column] | None = None) -> Column:
    """Character n-grams of the normalised value, padded with a blank, or of `prepare`d text; repeats stay."""
    padded = prepare(c) if prepare else F.concat(F.lit(" "), norm(c), F.lit(" "))
    last = lambda t: F.greatest(F.length(t) - n, F.lit(0))
    return let(padded, lambda t: F.transform(F.sequence(F.lit(0), last(t)), lambda i: F.substring(t, i + 1, F.lit(n))))


def tfidf_top1(raw: DataFrame, vocabulary: DataFrame, least: float, n: int = 3, prepare: Callable[[Column], Column] | None = None) -> DataFrame:
    """raw(raw) and vocabulary(std), distinct values, to (raw, std, score): the standard value with the highest
    TF-IDF cosine of n-grams of at least `least`; ties by name. prepare: for example gram_text.

    A pair's score is at most the sum of the raw value's weights times the greatest weight that each gram has in any
    standard value. With a value's grams from rare to common, those after which that sum stays under `least` can't make a
    pair alone: values meet in the inverted index on the grams before, and only such pairs are scored, on all grams."""
    a, b = tfidf_weights(raw, vocabulary, n, prepare)
    met = tfidf_candidates(a, b, least)
    both = met.join(a.select("raw", "g", F.col("w").alias("wa")), "raw").join(b.select("std", "g", F.col("w").alias("wb")), ["std", "g"])
    pairs = both.groupBy("raw", "std").agg(F.sum(F.col("wa") * F.col("wb")).alias("score"))
    best = pairs.where(F.col("score") >= least).groupBy("raw").agg(F.min_by(F.struct("std", "score"), F.struct((-F.round("score", 9)).alias("s"), F.col("std"))).alias("b"))
    return best.select("raw", "b.*")


def tfidf_weights(raw: DataFrame, vocabulary: DataFrame, n: int, prepare: Callable[[Column], Column] | None) -> tuple[DataFrame, DataFrame]:
    """(raw, g, w, df) and (std, g, w, df): unit weights of each value's grams that the vocabulary has, and the number of
    its values with the gram."""
    size = vocabulary.agg(F.count("*").alias("_n"))

    def weights(values: DataFrame, column: str, idf: DataFrame) -> DataFrame:
        tf = values.select(column, F.explode(grams(F.col(column), n, prepare)).alias("g")).groupBy(column, "g").agg(F.count("*").alias("tf"))
        return tf.join(idf, "g").withColumn("w", F.col("tf") * F.col("idf")).withColumn("w", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(column)))).select(column, "g", "w", "df")

    held = vocabulary.select("std", F.explode(F.array_distinct(grams(F.col("std"), n, prepare))).alias("g")).groupBy("g").agg(F.count("*").alias("df"))
    idf = files.stored(held.crossJoin(F.broadcast(size)).select("g", "df", (F.ln((F.col("_n") + 1) / (F.col("df") + 1)) + 1).alias("idf")))  # size: one row
    return files.stored(weights(raw, "raw", idf)), files.stored(weights(vocabulary, "std", idf))


def tfidf_candidates(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """(raw, std), each once, of tfidf_weights() that may score `least`."""
    highest = b.groupBy("g").agg(F.max("w").alias("most"))
    after = Window.partitionBy("raw").orderBy("df", "g").rowsBetween(0, Window.unboundedFollowing)
    few = a.join(highest, "g").withColumn("rest", F.sum(F.col("w") * F.col("most")).over(after)).where(F.col("rest") >= least - 1e-9)
    return few.select("raw", "g").join(b.select("std", "g"), "g").select("raw", "std").distinct()


def age_band(c: Column) -> Column:
    """'a-b' to (a, b); 'a+' to (a + 1, 100); else (value, value)."""
    n = lambda x: x.try_cast("int")
    plus = n(F.regexp_extract(c, r"^(\d+)\+$", 1))
    low, high = n(F.regexp_extract(c, r"^(\d+)-(\d+)$", 1)), n(F.regexp_extract(c, r"^(\d+)-(\d+)$", 2))
    return F.struct(F.coalesce(low, plus + 1, n(c)).alias("low"), F.coalesce(high, F.when(plus.isNotNull(), 100), n(c)).alias("high"))


def sections(c: Column, first: str, second: str, stop: str) -> Column:
    """Text after the first heading up to the second, and after the second up to `stop`; null without the
    heading."""
    take = lambda head, end: F.nullif(F.regexp_replace(F.regexp_extract(c, rf"(?is){head}(.*?)(?:{end}|$)", 1), r"^\s+|\s+$", ""), F.lit(""))
    return F.struct(take(first, f"{second}|{stop}").alias("first"), take(second, stop).alias("second"))


#: Common English function words.
STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "were", "with")
#: Units and words of a dose that are no part of a drug's name, longest first.
DOSE_UNITS = ("gray/day", "mg/m^2", "mcg/kg", "mg/day", "mg/kg", "mg/ml", "ml/kg", "hours", "weeks", "hour", "week", "mtd", "mcg", "mg", "ml", "ug", "g")
DOSE_WORDS = ("administered", "matching", "multiple", "single", "weeks", "daily", "days", "dose", "week", "day")


def without_stop_words(c: Column, words: tuple[str, ...] = STOP_WORDS, least: int = 30) -> Column:
    """Special characters go; stop words go from texts of at least `least` characters."""
    plain = F.regexp_replace(c, r"[=?()\[\]-]", "")
    kept = F.array_join(F.filter(F.split(plain, r"\s+"), lambda w: ~w.isin(*words)), " ")
    return F.when(F.length(plain) >= least, kept).otherwise(plain)


def clean_drug(c: Column, words: tuple[str, ...] = STOP_WORDS) -> Column:
    """Doses, frequencies (as whole words, not inside others), punctuation, stop words and bare numbers go."""
    units = "|".join(u.replace("^", r"\^") for u in DOSE_UNITS)
    bare = F.regexp_replace(c, rf"(?i)\b[0-9]+ ?(?:{units})\b|\b(?:{'|'.join(DOSE_WORDS)})\b", " ")
    tokens = F.split(F.trim(F.regexp_replace(bare, r"[^A-Za-z0-9-]+", " ")), " ")
    return F.array_join(F.filter(tokens, lambda w: ~w.isin(*words) & ~w.rlike("^[0-9-]*$")), " ")


def is_combination(c: Column) -> Column:
    """Names of several drugs: joined by &, and, + or the word combination, or with two commas or more."""
    return c.rlike(r"&|\+|and|And|AND|combination|Combination|,.*,")


def sponsors(c: Column) -> Column:
    """Each sponsor and each parent or subsidiary in a list: pipes inside braces don't part the list, but the
    names inside a part are split at /, { and } and at those pipes. Trimmed, distinct, first places."""
    protected = F.regexp_replace(c, r"\|(?=[^{}]*\})", "^")
    parts = F.transform(F.split(protected, r"[|/{}^]"), lambda x: F.trim(x))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def age_phrase(low: Column, high: Column) -> Column:
    low, high = F.nullif(low, F.lit("")), F.nullif(high, F.lit(""))
    both = F.when(low.isNotNull() & high.isNotNull(), F.concat(low, F.lit(" to "), high))
    return both.when(low.isNotNull(), F.concat(low, F.lit(" and older"))).when(high.isNotNull(), F.concat(F.lit("upto "), high)).otherwise("Child, Adult, Older Adult")


def primary_names(df: DataFrame, column: str, synonyms: DataFrame) -> DataFrame:
    """synonyms(synonym, primary): the primary name in the column's place, matched without case; a name with
    several primaries takes the least, an unknown one stays."""
    table = synonyms.groupBy(F.lower("synonym").alias("_key")).agg(F.min("primary").alias("_primary"))
    return df.join(table, F.lower(column) == F.col("_key"), "left").withColumn(column, F.coalesce("_primary", column)).drop("_key", "_primary")
