"""The operators' queries over the synthetic tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenloom.llm import chat, decontaminate, licenses, lines, negatives, periods, pii, quality, sentencepieces, simhash, tokens, urls, warc
from goldenloom.llm.common import read, text_of

TOKENIZERS = "/opt/tokenizers"


def op1_token_counts(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    vocabulary = tokens.word_end_vocabulary(f"{tokenizers}/word_bpe_49k.json")
    return tokens.token_counts(read(spark, sf_dir, "documents"), vocabulary)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    return sentencepieces.round_trip(read(spark, sf_dir, "documents"), sentencepieces.load_pieces(f"{tokenizers}/piece_bpe_32k.model"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_deleted_lines", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("text_sha256"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels")
    labelled = pages.join(labels, pages["page_id"] == labels["doc_id"]).select("url", F.expr("toxic = 1 or quality = 0").alias("bad"))
    return urls.judge_urls(pages, labelled)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(read(spark, sf_dir, "pages"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("text_hash")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read(spark, sf_dir, "documents"))


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; where crc32 of the id is a multiple of ten, the text's words from a place on repeat with a period,
    place and period by the same number."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")

    def planted(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int"))), " ")

    words = F.filter(F.split(text_of(), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # The words as a lambda's variable are split once, not once for each of them.
    text = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(""))[0]
    return docs.select("doc_id", F.when(F.pmod(h, F.lit(10)) == 0, text).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(with_periods(read(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"), F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    control = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(r"\### Assistant: </turn> ok").alias("text"))
    made = chat.format_chats(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(control))
    back = made.select("conv_id", "valid", "bad_turn", chat.written(F.col("segments")).alias("text"), chat.trained_text(F.col("segments")).alias("loss_text"))
    turns = F.array_join(F.transform(chat.read_turns(F.col("text")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size(chat.read_turns(F.col("text"))).cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.length("text").cast("long").alias("formatted_chars"), "valid", "bad_turn",
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(read(spark, sf_dir, "embeddings").withColumn("label", label), "vec_id % 100 = 0")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_token_counts, op2_pii, op3_sentencepiece, op4_line_dedup, op5_url_filter, op6_simhash, op7_warc, op8_decontaminate, op9_quality, op10_licenses, op11_periodic_runs, op12_chat_format, op13_hard_negatives, pipeline)
}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: For the operators that SQL can express whole; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op7_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, octet_length(h) AS n, CAST(CAST(unhex(sha1(h)) AS BIT) AS VARCHAR) AS z, min(page_id) OVER (PARTITION BY h) AS f FROM p)
SELECT page_id, n AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum([CAST(substr(z, 5 * i + j + 1, 1) AS INTEGER) * (16 >> j) FOR j IN range(5)])::BIGINT, 1) FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> f THEN f END AS refers_to FROM d""",
    "op8_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, w, least(13, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS g FROM i, unnest(range(1, len(w) - n + 2)) t(k) WHERE n > 0),
s AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g FROM d, s, unnest(range(1, len(w) - n + 2)) t(k)),
h AS (SELECT doc_id, k, n, item_id FROM dw JOIN iw USING (n, g)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM h) GROUP BY 1),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(x, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)""",
    "op12_chat_format": r"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (SELECT *, row_number() OVER w - 1 AS k, coalesce(lag(role) OVER w, '') || '>' || role AS went, count(*) OVER (PARTITION BY conv_id) AS n FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
e AS (SELECT *, CASE WHEN went NOT IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user') THEN k WHEN k = n - 1 AND role = 'system' THEN n END AS bad,
  length(text) + length(text) - length(replace(text, '\', '')) + (length(text) - length(replace(text, '</turn>', ''))) // 7
  + len(list_filter(range(1, length(text) - 1), lambda i: substr(text, i, 3) = '###')) + length(role) + 4 + 2 + 8 AS chars FROM o),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY k) AS t, coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '') AS l,
  CAST(sum(chars) AS BIGINT) AS formatted_chars, min(bad) AS bad_turn FROM e GROUP BY 1)
SELECT conv_id, n_turns, sha256(t) AS turns_sha256, length(l) AS loss_chars, sha256(l) AS loss_sha256, formatted_chars, bad_turn IS NULL AS valid, bad_turn FROM g""",
    "op13_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS own, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
}
