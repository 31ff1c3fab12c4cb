"""PII (2): information-theoretic sanitisation (after Sanchez and Batet's C-sanitisation, 2016).

Patterns find the protected entities; secrets (keys, tokens) are long strings whose own characters carry much information.
Corpus counts over lines then tell how much a term gives away about
a kind of entity: the point-wise mutual information PMI(kind; term) as a share of the kind's information
content IC(kind). Terms over the threshold are spans too wherever they stand in a line with such an
entity, and sanitised texts have entities generalised to their kind and such terms removed. DataFrame and
SQL functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldenloom.llm.common import join_on, table
from goldenloom.llm.quality import let, text_of_sql

# (kind, cheap test, pattern, test of a match m). The patterns equal the plain ones, but are possessive and
# start only where a match can start, so they take linear time and no stack.
_MAIL = r"A-Za-z0-9._%+\\-"
KINDS = (
    ("email", "contains(t, '@')", rf"(?:(?<![{_MAIL}])|\\G)[{_MAIL}]++@[A-Za-z0-9\\-]++(?:\\.[A-Za-z0-9\\-]++)++", "true"),
    ("ip", "t rlike '[0-9]\\\\.[0-9]'", r"(?<![0-9])[0-9]++(?:\\.[0-9]++){3}", "forall(split(m, '[.]'), p -> coalesce(try_cast(p as bigint), 999) <= 255)"),
    ("card", "t rlike '[0-9][ 0-9\\\\-]{10}'", r"[0-9](?:[\\x20\\-]?+[0-9])++", let("regexp_replace(m, '[^0-9]', '')", "d", "length(d) between 12 and 19 and luhn_check(d)")),
    ("phone", "contains(t, '+')", r"\\+[0-9][\\x20().0-9\\-]+[0-9]", "length(regexp_replace(m, '[^0-9]', '')) between 9 and 15"),
)
#: A secret: a long run with letters and digits in turn, whose characters carry this many bits by their own frequencies.
_RUN, SECRET_CHARS, SECRET_TURNS, SECRET_BITS = r"A-Za-z0-9+/_=\\-", 20, 3, 64
_BITS = let("split(m, '')", "cc", "aggregate(transform(array_distinct(cc), d -> size(filter(cc, c -> c = d)) / size(cc)), 0D, (a, p) -> a - p * log2(p)) * size(cc)")
SECRET = (
    "secret", f"t rlike '[{_RUN}]{{{SECRET_CHARS}}}'", rf"(?<![{_RUN}])[{_RUN}]{{{SECRET_CHARS},}}+",
    f"size(regexp_extract_all(m, '[A-Za-z][0-9]', 0)) >= {SECRET_TURNS} and {_BITS} >= {SECRET_BITS}D",
)
PROTECTED = (*KINDS, SECRET)
#: Terms are runs of at least four letters; a term's span is listed after the protected kinds.
TERM = r"[\\p{L}]{4,}+"
SHARE = 0.8
MIN_TOGETHER = 5


def offsets(lengths: str) -> str:
    """SQL: for each of an array of lengths the sum of those before it. Blocks are summed first, so that a
    long array is not copied once for each of its members."""
    step = "(a, x) -> named_struct('at', a.at + x, 'v', concat(a.v, array(a.at))), a -> a.v"
    start = "named_struct('at', {}, 'v', cast(array() as array<int>))"
    sums = "transform(bl, b -> aggregate(b, 0, (n, x) -> n + x))"
    bases = f"aggregate({sums}, {start.format('0')}, {step})"
    spread = f"flatten(zip_with(bl, {bases}, (b, o) -> aggregate(b, {start.format('o')}, {step})))"
    blocks = "transform(sequence(0, greatest(size(v) - 1, 0), 256), i -> slice(v, i + 1, 256))"
    return let(lengths, "v", let(blocks, "bl", spread))


def placed(text: str, pattern: str) -> str:
    """SQL: array of struct(s, e, m), the start, end and text of the pattern's matches, by code points. The
    pieces between matches and the matches' lengths add up to the places."""
    pairs = f"zip_with(mm, slice(split({text}, '{pattern}', -1), 1, size(mm)), (m, p) -> named_struct('m', m, 'p', length(p), 'l', length(m)))"
    spans = "zip_with(pr, oo, (x, o) -> named_struct('s', o + x.p, 'e', o + x.p + x.l, 'm', x.m))"
    some = let(pairs, "pr", let(offsets("transform(pr, x -> x.p + x.l)"), "oo", spans))
    return let(f"regexp_extract_all({text}, '{pattern}', 0)", "mm", f"if(size(mm) = 0, cast(array() as array<struct<s:int,e:int,m:string>>), {some})")


def _base(text: str) -> str:
    """SQL: sorted array of struct(s, k, e), the entities of all kinds; k is the kind's place in PROTECTED."""
    parts = []
    for k, (_, cheap, pattern, test) in enumerate(PROTECTED):
        found = f"transform(filter({placed('t', pattern)}, f -> {let('f.m', 'm', test)}), f -> named_struct('s', f.s, 'k', {k}, 'e', f.e))"
        parts.append(f"if({cheap}, {found}, cast(array() as array<struct<s:int,k:int,e:int>>))")
    return let(text, "t", f"array_sort(concat({', '.join(parts)}))")


def entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, base, lines): base as of _base(); lines: struct(at, line, kinds) of the lines that
    hold an entity, `at` being where the line starts."""
    text = text_of_sql(text_col)
    starts = let("split(t, '\\n')", "ll", f"zip_with({offsets('transform(ll, x -> length(x) + 1)')}, ll, (a, x) -> named_struct('at', a, 'line', x))")
    held = "array_distinct(transform(filter(b, e -> e.s >= l.at and e.s < l.at + length(l.line)), e -> e.k))"
    lines = f"filter(transform({starts}, l -> named_struct('at', l.at, 'line', l.line, 'kinds', {held})), l -> size(l.kinds) > 0)"
    both = let(text, "t", let(_base("t"), "b", f"named_struct('base', b, 'lines', if(size(b) = 0, cast(array() as array<struct<at:int,line:string,kinds:array<int>>>), {lines}))"))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.expr(both).alias("f")).select("id", "text_hash", "f.base", "f.lines")


def disclosing_terms(docs: DataFrame, lines: DataFrame, text_col: str = "text", share: float = SHARE, min_together: int = MIN_TOGETHER) -> DataFrame:
    """(k, term, share): terms that stand in at least `min_together` lines with kind k and whose
    PMI(k; term) is at least `share` of IC(k). lines(line, kinds) are those with entities; the other
    counts are over all lines of docs, pre-aggregated before they are shuffled."""
    distinct = lambda c: F.expr(f"array_distinct(regexp_extract_all(lower({c}), '{TERM}', 0))")
    together = lines.select(F.explode("kinds").alias("k"), distinct("line").alias("terms")).select("k", F.explode("terms").alias("term")).groupBy("k", "term").agg(F.count("*").alias("together")).where(F.col("together") >= min_together)
    all_lines = docs.select(F.explode(F.split(F.col(text_col).cast("string"), "\n")).alias("line"))
    alone = all_lines.select(F.explode(distinct("line")).alias("term")).groupBy("term").agg(F.count("*").alias("alone"))
    total = docs.agg(F.sum(F.size(F.split(F.col(text_col).cast("string"), "\n"))).cast("double").alias("total"))
    kinds = lines.select(F.explode("kinds").alias("k")).groupBy("k").agg(F.count("*").alias("held"))
    joined = together.join(kinds, "k").join(F.broadcast(total)).join(alone, "term")  # total is one row
    pmi = F.log2(F.col("together") * F.col("total") / (F.col("alone") * F.col("held")))
    return joined.where("held < total").select("k", "term", (pmi / F.log2(F.col("total") / F.col("held"))).alias("share")).where(F.col("share") >= share)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE, min_together: int = MIN_TOGETHER) -> DataFrame:
    """(id, text_hash, base, terms): base entities as struct(s, k, e) and disclosing terms as struct(s, e), both
    sorted. One row per input row."""
    found = table(entities(docs, id_col, text_col), "pii-entities")
    lines = found.select("id", "text_hash", F.explode("lines").alias("l")).select("id", "text_hash", "l.at", "l.line", "l.kinds")
    risky = table(disclosing_terms(docs, lines, text_col, share, min_together), "disclosing-terms")
    spots = lines.dropDuplicates(["id", "text_hash", "at"]).select("id", "text_hash", "at", "kinds", F.explode(F.expr(placed("line", TERM))).alias("p"))
    spots = spots.select("id", "text_hash", F.explode("kinds").alias("k"), F.expr("p.s + at as s"), F.expr("p.e + at as e"), F.expr("lower(p.m) as term"))
    terms = spots.join(risky, ["k", "term"], "left_semi").select("id", "text_hash", "s", "e", F.lit(False).alias("known")).distinct()
    known = join_on(found.dropDuplicates(["id", "text_hash"]), terms.select("id", "text_hash").distinct(), ["id", "text_hash"], "left_semi")
    both = terms.union(known.select("id", "text_hash", F.explode("base").alias("b")).select("id", "text_hash", "b.s", "b.e", F.lit(True)))
    order = Window.partitionBy("id", "text_hash").orderBy("s", "e")  # one document's spans
    before = F.max(F.when(F.col("known"), F.col("e"))).over(order)
    after = F.min(F.when(F.col("known"), F.col("s"))).over(Window.partitionBy("id", "text_hash").orderBy(F.desc("s"), F.desc("e")))
    apart = both.withColumn("before", before).withColumn("after", after).where("not known and coalesce(before <= s, true) and coalesce(after >= e, true)")
    terms = apart.groupBy("id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("terms"))
    whole = join_on(found, terms, ["id", "text_hash"], "left")
    return whole.select("id", "text_hash", "base", F.expr("coalesce(terms, cast(array() as array<struct<s:int,e:int>>)) as terms"))


def _joined(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k, *_ in PROTECTED)
    return f"array_join(transform({spans}, x -> concat(element_at(array({names}, 'term'), x.k + 1), ':', x.s, ':', x.e)), ',')"


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret, n_term, n_spans. The first six are of
    the patterns' kinds alone; secrets and terms are what the method adds.

    A null or empty text has no spans; repeated rows give repeated rows; rows equal in id and text share
    their terms; other columns are ignored. Places are code points, ends exclusive."""
    every = f"array_sort(concat(base, transform(terms, x -> named_struct('s', x.s, 'k', {len(PROTECTED)}, 'e', x.e))))"
    count = lambda k, name: F.expr(f"cast(size(filter(base, x -> x.k = {k})) as long) as n_{name}")
    plain = f"filter(base, x -> x.k < {len(KINDS)})"
    return find(docs, id_col, text_col).select(
        F.col("id").alias(id_col), *(count(k, kind[0]) for k, kind in enumerate(KINDS)), F.sha2(F.expr(_joined(plain)), 256).alias("base_sha256"), F.expr(f"{_joined(every)} as spans"),
        count(len(KINDS), "secret"), F.expr("cast(size(terms) as long) as n_term"), F.expr("cast(size(base) + size(terms) as long) as n_spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text): entities are replaced by their kind in brackets, disclosing terms by [...]. Of spans that
    overlap the first stays."""
    spans = find(docs, id_col, text_col)
    names = ", ".join(f"'[{k}]'" for k, *_ in PROTECTED)
    every = f"array_sort(concat(base, transform(terms, x -> named_struct('s', x.s, 'k', {len(PROTECTED)}, 'e', x.e))))"
    step = f"if(x.s < a.at, a, named_struct('at', x.e, 'v', concat(a.v, substring(t, a.at + 1, x.s - a.at), element_at(array({names}, '[...]'), x.k + 1))))"
    done = f"aggregate({every}, named_struct('at', 0, 'v', ''), (a, x) -> {step}, a -> concat(a.v, substring(t, a.at + 1)))"
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.expr(f"{text_of_sql(text_col)} as t"))
    spans = spans.dropDuplicates(["id", "text_hash"])
    return join_on(rows, spans, ["id", "text_hash"]).select(F.col("id").alias(id_col), F.expr(done).alias(text_col))
