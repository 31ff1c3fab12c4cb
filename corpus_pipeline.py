"""A training corpus from raw documents: quality rules, line dedup, near-dedup, decontamination, pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenloom.llm import decontaminate, lines, quality, sentencepieces, similar
from goldenloom.llm.common import fresh, named, read, table
from goldenloom.llm.queries import TOKENIZERS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, among them those with a null or empty text. Repeated rows are judged
    alike; extra columns of any name stay; an empty table gives an empty one."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go, and with them documents that held nothing else. Null and wordless texts
    that lost nothing stay; rows equal in id and text lose the same lines; n_chars, if there, follows the text; extra
    columns of any name stay; an empty table gives an empty one."""
    (gone,) = fresh(docs, "n_deleted_lines")
    kept = lines.dedup_lines(docs, count_col=gone).where(rf"`{gone}` = 0 or text rlike '\\S'").drop(gone)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*named(*docs.columns)) if "n_chars" in docs.columns else kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (5-word shingles, similarity of 0.8 or more) the document with the smallest id
    stays. Null and wordless texts are one group; see similar.drop_similar() for ties, null ids and repeated rows."""
    return similar.drop_similar(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go. Null and wordless texts stay, repeated rows are judged alike, extra
    columns stay; without documents or benchmark items nothing goes."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The encoded corpus: ids and their round trip, one row for each document that is left, repeated ones too. A
    null or empty text has no ids; an empty table gives an empty one."""
    return sentencepieces.round_trip(docs, sentencepieces.load_pieces(f"{TOKENIZERS}/piece_bpe_32k.model"), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("sentencepiece", sentence_pieces),
]

#: SQL has neither the fingerprints' hash nor the pieces' best paths.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if k + 1 == len(STAGES):
            return made
        docs = table(made, f"stage-{k}")
    return docs
