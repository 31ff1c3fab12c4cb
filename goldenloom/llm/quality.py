"""Quality rules (9): Jensen-Shannon distance of a document's character-class and common-word histograms
to those of its language, besides plain counts. DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenloom.llm.common import named, table

# Frequent function words of each language.
COMMON = {
    "en": "the of and to in is that it was for on are with as be at by this from have or an had not but what all were when we".split(),
    "fr": "le la les de des du et un une que qui en est dans pour pas par sur au ce il se ne plus avec sont aux ou son mais".split(),
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch es an er so dass kann bei einer aus nach".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como o pero sus le ha me si sin".split(),
}
CODES = "-abcdefghijklmnopqrstuvwxyzABCD"  # bin 0 is any other word
SPACE = r"\\x20\\x09-\\x0D"
CLASSES = ("lower", "upper", "digit", "space", "point", "symbol", "other")

#: A document is rejected if its class distance is above the first, or its word distance above the second as a
#: share of the distance of a text without common words, which is the scale's end (0.32 where a fifth of the
#: words are common). As few words scatter over the bins, the word distance only counts if common words are
#: also that many times rarer than in the reference. References with a scale's end under MIN_WORD_SCALE judge
#: no words. The guards are the fewest characters and words for which a distance is looked at.
MAX_CLASS_DISTANCE = 0.35
MAX_WORD_SHARE = 0.8
TIMES_RARER = 7
MIN_WORD_SCALE = 0.1
MIN_CHARS = 200
MIN_WORDS = 60


def let(value: str, name: str, body: str) -> str:
    """SQL: body, with name bound to value, which is worked out once (also inside lambdas)."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _words(text: str) -> str:
    trimmed = f"trim(BOTH ' \\t\\n\\u000B\\u000C\\r' FROM {text})"
    return let(trimmed, "tt", f"if(tt = '', cast(array() as array<string>), split(tt, '[{SPACE}]+'))")


def _histograms(text: str, words: str, lang: str) -> list[str]:
    """SQL of named_struct arguments: classes, and bins: how often each common word stands in the text, after
    the number of other words. Common words become letters, which are then counted by taking them out."""
    lists = " ".join(f"when '{k}' then array({', '.join(repr(w) for w in v)})" for k, v in COMMON.items())
    listed = f"case {lang} {lists} else array('') end"
    rest = f"regexp_replace({text}, '[a-z{SPACE}]+', '')"
    less = lambda kind: f"(length(r) - length(regexp_replace(r, '[{kind}]+', '')))"
    space = f"(length({text}) - length(array_join({words}, '')))"
    point, symbol = r".,;:!?\\x22\\x27()\\-", r"#*$%&|<>@/\\\\\\[\\]{}=+_~^`\\x00-\\x08\\x0E-\\x1F\\x7F"
    upper, digit, points, symbols = less("A-Z"), less("0-9"), less(point), less(symbol)
    classes = f"array(length({text}) - length(r) - {space}, {upper}, {digit}, {space}, {points}, {symbols}, length(r) - {upper} - {digit} - {points} - {symbols})"
    short = f"filter({words}, x -> octet_length(x) <= {max(len(w.encode()) for v in COMMON.values() for w in v)})"
    codes = f"replace(array_join(transform({short}, x -> substring('{CODES}', cast(array_position(cc, x) as int) + 1, 1)), ''), '-', '')"
    each = ", ".join(f"length(cd) - length(replace(cd, '{c}', ''))" for c in CODES[1:])
    bins = let(listed, "cc", let(codes, "cd", f"array(size({words}) - length(cd), {each})"))
    return ["'classes'", let(rest, "r", classes), "'bins'", bins]


def _repeat_words(words: str) -> str:
    """SQL: words in 3-word windows that are found twice or more. Windows are compared by hash; sorting
    puts equal ones side by side, so the work grows with n log n of one text."""
    near = "(j > 0 and st[j - 1].h = x.h) or (j < size(st) - 1 and st[j + 1].h = x.h)"
    places = f"sort_array(filter(transform(st, (x, j) -> if({near}, x.i, -1)), p -> p >= 0))"
    covered = "aggregate(transform(ps, (p, j) -> least(3, coalesce(get(ps, j + 1), p + 3) - p)), 0, (s, x) -> s + x)"
    found = let("sort_array(transform(hs, (h, i) -> struct(h as h, i as i)))", "st", let(places, "ps", covered))
    hashes = f"transform(sequence(0, size({words}) - 3), i -> xxhash64({words}[i], {words}[i + 1], {words}[i + 2]))"
    return f"if(size({words}) < 3, 0, {let(hashes, 'hs', f'if(size(array_distinct(hs)) = size(hs), 0, {found})')})"


def measure(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """docs plus a struct column __f: the counts of each text, its histograms, and the language it is judged
    by ('other' for those that COMMON doesn't list)."""
    lines = f"filter(split(t, '\\n'), l -> l rlike '[^{SPACE}]')"
    args = ", ".join([
        "'lang'", "k", "'n_words'", "cast(size(w) as long)", "'word_chars'", "cast(length(array_join(w, '')) as long)",
        "'n_symbols'", "cast(length(regexp_replace(t, '[^#*$%&|<>]+', '')) as long)",
        "'n_dup_lines'", f"cast({let(lines, 'ls', 'size(ls) - size(array_distinct(ls))')} as long)",
        "'n_repeat_words'", f"cast({_repeat_words('w')} as long)", "'n_chars'", "length(t)", *_histograms("t", "w", "k")])
    listed = ", ".join(repr(k) for k in COMMON)
    lang = f"if(`{lang_col}` in ({listed}), `{lang_col}`, 'other')" if lang_col in docs.columns else "'other'"
    return docs.withColumn("__f", F.expr(let(text_of_sql(text_col), "t", let(lang, "k", let(_words("t"), "w", f"named_struct({args})")))))


def language_references(measured: DataFrame, min_words: int = 50) -> DataFrame:
    """(lang, ref_classes, ref_bins): summed histograms of all texts of at least `min_words` words, for each
    language of COMMON and 'other'; five rows at most."""
    sums = [F.sum(F.col("__f.classes")[i]).alias(f"c{i}") for i in range(len(CLASSES))] + [F.sum(F.col("__f.bins")[i]).alias(f"b{i}") for i in range(len(CODES))]
    return measured.where(F.col("__f.n_words") >= min_words).groupBy(F.col("__f.lang").alias("lang")).agg(*sums).select(
        "lang", F.array(*(f"c{i}" for i in range(len(CLASSES)))).alias("ref_classes"), F.array(*(f"b{i}" for i in range(len(CODES)))).alias("ref_bins"))


def _distance(counts: str, reference: str) -> str:
    """SQL: Jensen-Shannon distance (base 2, 0 to 1) of two arrays of counts; null if either is empty."""
    total = lambda a: f"nullif(aggregate({a}, 0D, (s, x) -> s + x), 0D)"
    part = "if(x <= 0D, 0D, x * log2(2D * x / (x + y)))"
    body = let(f"zip_with({counts}, {reference}, (a, b) -> struct(a / na as x, b / nb as y))", "ab", f"aggregate(ab, 0D, (s, v) -> s + {let('v.x', 'x', let('v.y', 'y', part))} + {let('v.y', 'x', let('v.x', 'y', part))})")
    return f"{let(total(counts), 'na', let(total(reference), 'nb', f'if(na is null or nb is null, null, sqrt(greatest(0D, {body} / 2D)))'))}"


def judge(measured: DataFrame, references: DataFrame) -> DataFrame:
    """measured, its __f replaced by a struct column __q: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, class_distance, word_distance, base_failed, kept.

    A null text is an empty one: it has no words, fails the base rule and is not kept. Distances are null
    where the text or the reference is empty; then, and under the guards, they reject nothing. Texts of
    a language without a common-word list, or of none, are judged by their character classes alone."""
    no_common = f"array(1{', 0' * (len(CODES) - 1)})"
    scale = F.expr(f"struct({_distance(no_common, 'ref_bins')} as d, 1 - ref_bins[0] / aggregate(ref_bins, 0D, (s, x) -> s + x) as common)")
    refs = F.broadcast(references.select(F.col("lang").alias("__k"), F.col("ref_classes").alias("__rc"), F.col("ref_bins").alias("__rb"), scale.alias("__rs")))  # five rows at most
    judged = measured.join(refs, F.col("__f.lang") == F.col("__k"), "left")
    judged = judged.withColumn("__d", F.expr(f"struct({_distance('__f.classes', '__rc')} as c, {_distance('__f.bins', '__rb')} as w)"))
    failed = "(__f.n_words < 50 or 100 * __f.n_repeat_words > 50 * __f.n_words)"
    few = f"(__rs.d >= {MIN_WORD_SCALE}D and __d.w > {MAX_WORD_SHARE}D * __rs.d and {TIMES_RARER} * (__f.n_words - __f.bins[0]) < __rs.common * __f.n_words)"
    far = f"((__f.n_chars >= {MIN_CHARS} and coalesce(__d.c, 0D) > {MAX_CLASS_DISTANCE}D) or (__f.lang <> 'other' and __f.n_words >= {MIN_WORDS} and coalesce({few}, false)))"
    fields = [f"__f.{c} as {c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    q = F.expr(f"struct({', '.join(fields)}, __d.c as class_distance, __d.w as word_distance, {failed} as base_failed, not {failed} and not {far} as kept)")
    return judged.withColumn("__q", q).drop("__f", "__k", "__rc", "__rb", "__rs", "__d")


def text_of_sql(text_col: str) -> str:
    return f"coalesce(cast(`{text_col}` as string), '')"


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row, repeated ones too: id and the fields of judge(). Other columns are ignored; an empty
    table gives an empty one. Texts are read once."""
    narrow = docs.select(F.col(id_col).alias("__id"), text_col, *([lang_col] if lang_col in docs.columns else []))
    measured = table(measure(narrow, text_col, lang_col).select("__id", "__f"), "quality-measures")
    return judge(measured, language_references(measured)).select(F.col("__id").alias(id_col), "__q.*")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The docs that are kept, with their columns, of any names. Null and empty texts go; repeated rows are judged
    alike; without a language column only character classes are compared; an empty table gives an empty one."""
    language = [F.col(lang_col)] if lang_col in docs.columns else []
    whole = docs.select(F.struct(*named(*docs.columns)).alias("__row"), F.col(text_col).alias("text"), *(c.alias("lang") for c in language))
    measured = table(measure(whole, "text", "lang").select("__row", "__f"), "quality-measures")
    return judge(measured, language_references(measured)).where("__q.kept").select("__row.*")
