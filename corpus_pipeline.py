"""The corpus pipeline: quality rules, quality classifier, near-dedup, suffix dedup, packing.

Each stage is a function of (spark, docs, sf_dir). All but the last return the
columns of documents, whatever they are; each works on all rows that the one
before kept, written as Parquet and read again in between.

Defined cases: a stage keeps a document's columns as they came, but for
``text`` and ``n_chars`` where bytes were cut out; extra columns, also such as
have names that the operators use, go along untouched; an empty table stays
empty. Near-dedup tells rows apart by doc_id and text, so rows that repeat a
doc_id, or have none, are judged each by their own text; of rows that agree in
both, any one may be the one that stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfolio.llm import near_dedup, packing, quality_gam, quality_rules, suffix_dedup
from lumenfolio.llm.common import Scratch, remove, table
from lumenfolio.llm.components import join_sized
from lumenfolio.workers import importable

#: Similarity in percent at which two documents are near-duplicates.
NEAR_PERCENT = 80


def _carried(docs: DataFrame) -> DataFrame:
    """doc_id, text and the whole row, so that no other column can clash."""
    return docs.select("doc_id", "text", F.struct("*").alias("row"))


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the quality rules keep."""
    verdict = quality_rules.learn(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return quality_rules.judge(_carried(docs), verdict).where("kept").select("row.*")


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that score at least one half.

    The model is learned from the labelled documents of the whole table, as the
    rules stage leaves next to no bad ones to learn from.
    """
    model = quality_gam.learn(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return quality_gam.score(_carried(docs), model).where("score >= 0.5").select("row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: the one with the smallest id, null ids last, then the smallest hash of id and text."""
    judged = near_dedup.judge(docs.select("doc_id", "text"), NEAR_PERCENT, null_ids=True).where("component IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid", "rid2")).alias("first")
    winners = judged.groupBy("component").agg(first, F.count("*").alias("members")).where("members > 1")
    scratch = Scratch(spark)
    sized = scratch.keep(winners.select("component", F.col("first.rid").alias("own"), F.col("first.rid2").alias("own2"), "members"))
    grouped = join_sized(judged, sized, "component", judged.count())
    wins = (F.col("rid") == F.col("own")) & (F.col("rid2") == F.col("own2"))
    # rows of groups, by their keys: those that go, and those of which one stays
    keys = grouped.groupBy("rid", "rid2").agg(F.max(wins).alias("wins"), F.count("*").alias("copies"))
    keys = scratch.keep(keys.where("NOT wins OR copies > 1"))
    rows = docs.select(*near_dedup.row_keys(docs), F.struct("*").alias("row"))
    sent = keys.select("rid", "rid2")
    sent = F.broadcast(sent) if sent.count() <= near_dedup.BROADCAST_IDS else sent  # or else the texts are shuffled
    out = rows.join(sent, ["rid", "rid2"], "left_anti").select("row")
    if keys.where("wins").limit(1).count():
        out = out.union(rows.join(keys.where("wins"), ["rid", "rid2"], "left_semi").groupBy("rid", "rid2").agg(F.first("row").alias("row")).select("row"))
    return out.select("row.*")


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut bytes that a 100-byte match with earlier text covers."""
    others = [F.col(c) for c in docs.columns if c != "text"]
    rows = docs.select("doc_id", "text", F.struct(*others, F.col("text").isNull().alias("__null")).alias("row"))
    cut = suffix_dedup.cut_matches(rows, carry=True)
    row, changed = F.col("row"), F.col("n_removed") > 0
    own = {"text": F.when(~row["__null"], F.col("kept_text"))}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.when(changed, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(row["n_chars"])
    return cut.select(*[(own[c] if c in own else row[c]).alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into windows."""
    return packing.pack(docs)


#: Each can be called on its own: its workers find this package without a Python path set from outside.
STAGES = [
    (name, importable(stage))
    for name, stage in (
        ("quality_rules", rules_stage),
        ("quality_classifier", classifier_stage),
        ("near_dedup", near_dedup_stage),
        ("suffix_dedup", suffix_dedup_stage),
        ("packing", packing_stage),
    )
]

#: Stages that learn and link can't be told in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again, and the one before it deleted."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.keep(stage(spark, docs, sf_dir))
        if i:
            remove(spark, scratch.paths[i - 1])
    return STAGES[-1][1](spark, docs, sf_dir)
