"""From documents to packed training sequences, stage by stage.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written and read again as
the next one's documents. All but the last return the columns of documents.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm.common import quoted, staged, table, unboxed
from skytally.llm.lines import dedup_lines
from skytally.llm.packing import pack
from skytally.llm.queries import toxicity_model
from skytally.llm.repeats import remove_repeats
from skytally.llm.simhash import near_groups
from skytally.llm.toxicity import score
from skytally.operators.upsert import keep_one

TOXIC_FROM = 0.7


def _with_text(rows: DataFrame, columns: list[str], text) -> DataFrame:
    """The documents again with another text, and n_chars to match. A null text stays null."""
    text = F.when(F.col("text").isNotNull(), text)
    out = unboxed(rows.withColumn("new_text", text), columns, "text", F.col("new_text"))
    if "n_chars" in columns:
        size = F.coalesce(F.length("text"), F.lit(0)).cast(out.schema["n_chars"].dataType)
        changed = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(size)
        out = out.withColumn("n_chars", changed)
    return out


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that score as toxic."""
    model = toxicity_model(spark, sf_dir, table(spark, sf_dir, "documents"))
    clean = score(docs, model).where(F.col("score") < TOXIC_FROM)
    return unboxed(clean, docs.columns, "text", F.col("text"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that a smaller id holds."""
    return _with_text(dedup_lines(docs), docs.columns, F.col("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one that names the group, by the smallest
    id. Of rows that share this id in one group the one with the least hash of its text stays,
    and of equal ones the one with the least hash of all columns; rows that share an id in
    different groups all stay. Null and empty texts are one group. Rows without an id are in no
    group and stay."""
    groups = near_groups(docs).where("doc_id = component_id")
    kept = groups.groupBy("group").agg(F.min(F.struct("doc_id", "text_hash")).alias("named"))
    kept = kept.select("named.doc_id", "named.text_hash").withColumnsRenamed(
        {"doc_id": "_doc_id", "text_hash": "_text_hash"}
    )
    own = [docs["doc_id"] == kept["_doc_id"], F.xxhash64(docs["text"]) == kept["_text_hash"]]
    named = docs.join(kept, own, "left_semi")
    whole = F.xxhash64(*[quoted(c) for c in docs.columns if c not in ("doc_id", "text")], F.lit(0))
    one = keep_one(named.withColumn("_text", F.xxhash64("text")), ["doc_id", "_text"], [whole])
    return one.drop("_text").unionByName(docs.where("doc_id IS NULL"))


def repeat_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings of 100 bytes that occurred before."""
    return _with_text(remove_repeats(docs), docs.columns, F.col("kept_text"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of 1024 ids."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", repeat_dedup),
    ("packing", packing),
]

# SQL can express neither the nearest examples nor the fingerprints; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
