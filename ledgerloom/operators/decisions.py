"""Decisions on unique content: what is asked, what is remembered, and how answers come back to every file."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import closed_category, compact, open_category
from ledgerloom.operators.ordering import with_ordinal

CLASSIFY, EXCLUDE, REVIEW = DECISIONS = ("classify", "exclude", "review")
#: The category that an exclusion carries inside.
EXCLUDED_INSIDE = "__排除复核__"
REASON_LIMIT = 160


def first_wins(rows: DataFrame, keys: list[str], ordinal: str = "ordinal") -> DataFrame:
    """The row of least ``ordinal`` for each key, by partial aggregation."""
    return _extreme(rows, keys, F.min_by, ordinal)


def last_wins(rows: DataFrame, keys: list[str], ordinal: str = "ordinal") -> DataFrame:
    return _extreme(rows, keys, F.max_by, ordinal)


def _extreme(rows: DataFrame, keys: list[str], pick, ordinal: str) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(pick(F.struct(*rest), F.col(ordinal)).alias("__row")).select(*keys, *(F.col(f"__row.`{c}`").alias(c) for c in rest)).select(rows.columns)


def normalise_decision(raw: DataFrame, allowed: Iterable[str] | None = None) -> DataFrame:
    """Rows (card_sha256, decision, category, reason) that hold, with the category in its inner form. ``allowed`` closes the list of categories."""
    category = open_category("category") if allowed is None else closed_category("category", allowed)
    good = raw.withColumn("category", F.when(F.col("decision") == CLASSIFY, category).when(F.col("decision") == EXCLUDE, F.lit(EXCLUDED_INSIDE)))
    good = good.filter((F.coalesce("card_sha256", F.lit("")) != "") & F.col("decision").isin(*DECISIONS) & ((F.col("decision") != CLASSIFY) | F.col("category").isNotNull()))
    return good.withColumn("reason", compact("reason", REASON_LIMIT))


def pending(inputs: DataFrame, checkpoint: DataFrame, has_content: Column) -> DataFrame:
    """Unique content that has something to ask about and no answer yet."""
    return inputs.filter(has_content).join(checkpoint.select("card_sha256"), "card_sha256", "left_anti")


def map_back(records: DataFrame, decisions: DataFrame) -> DataFrame:
    """Every record with its content's decision: category, classification_source, model_decision, needs_review, and reason where ``decisions`` have one.

    Records need card_sha256 and has_content. Without content, or without a decision, a record waits for a person.
    """
    reason = ["reason"] if "reason" in decisions.columns else []
    d = decisions.select("card_sha256", F.col("decision").alias("__decision"), F.col("category").alias("__category"), *(F.col(r).alias("__reason") for r in reason))
    decided = F.col("has_content") & F.col("__decision").isNotNull()
    joined = records.join(d, "card_sha256", "left")
    return joined.select(
        *records.columns,
        F.when(decided & (F.col("__decision") == CLASSIFY), F.col("__category")).alias("category"),
        F.when(decided, F.lit("model")).otherwise(F.lit("manual_review")).alias("classification_source"),
        F.when(decided, F.col("__decision")).otherwise(F.lit(REVIEW)).alias("model_decision"),
        (~decided | (F.col("__decision") != CLASSIFY)).alias("needs_review"),
        *(F.when(decided, F.col("__reason")).alias(r) for r in reason),
    )


def first_review_targets(classified: DataFrame) -> DataFrame:
    return classified.filter("needs_review")


def second_review_targets(classified: DataFrame) -> DataFrame:
    return classified.filter("needs_review and model_decision = 'review' and recheck_status = 'complete'")


def conflicting(previous: DataFrame) -> DataFrame:
    """Content whose records disagree on the previous decision; must be empty before a review."""
    said = F.concat_ws("\0", F.coalesce("model_decision", F.lit("")), F.coalesce("category", F.lit("")))
    return previous.groupBy("card_sha256").agg(F.min(said).alias("low"), F.max(said).alias("high")).filter("low != high").select("card_sha256")


def merge_review(classified: DataFrame, targets: DataFrame, answers: DataFrame, source: str = "model_recheck", by_hash: bool = False) -> DataFrame:
    """``classified`` with the answers merged in; columns previous_decision, previous_category, merged and recheck_status added, and recheck_reason (``by_hash``: recheck_2_reason) where ``answers`` have a reason.

    The first review touches the rows of ``targets``; the second (``by_hash``) all rows that share a target's content. Others pass unchanged.
    """
    key = ["card_sha256"] if by_hash else ["relative_path"]
    marked = classified.join(targets.select(*key).distinct().withColumn("__target", F.lit(True)), key, "left")
    said = "recheck_2_reason" if by_hash else "recheck_reason"
    reason = F.col("reason") if "reason" in answers.columns else F.lit(None).cast("string")
    a = answers.select("card_sha256", F.col("decision").alias("__decision"), F.col("category").alias("__category"), reason.alias("__reason"))
    joined = marked.join(a, "card_sha256", "left").withColumn("__target", F.coalesce("__target", F.lit(False)))
    merged = F.col("__target") & F.col("has_content") & F.col("__decision").isNotNull()
    passing = [c for c in classified.columns if c not in ("category", "classification_source", "model_decision", "needs_review", "recheck_status", "previous_decision", "previous_category", "merged", said)]
    before = F.col(said) if said in classified.columns else F.lit(None).cast("string")
    return joined.select(
        *passing,
        F.when(merged, F.when(F.col("__decision") == CLASSIFY, F.col("__category"))).otherwise(F.col("category")).alias("category"),
        F.when(merged, F.lit(source)).otherwise(F.col("classification_source")).alias("classification_source"),
        F.col("model_decision").alias("previous_decision"),
        F.col("category").alias("previous_category"),
        F.when(merged, F.col("__decision")).otherwise(F.col("model_decision")).alias("model_decision"),
        F.when(merged, F.col("__decision") != CLASSIFY).otherwise(F.col("needs_review")).alias("needs_review"),
        merged.alias("merged"),
        *([F.when(merged, F.col("__reason")).otherwise(before).alias(said)] if "reason" in answers.columns else []),
        F.when(F.col("__target"), F.when(~F.col("has_content"), "no_semantic_content").when(F.col("__decision").isNotNull(), "complete").otherwise("incomplete")).alias("recheck_status"),
    )


def transitions(merged: DataFrame) -> DataFrame:
    """previous_decision, model_decision, files of the merged rows."""
    return merged.filter("merged").groupBy("previous_decision", "model_decision").agg(F.count(F.lit(1)).alias("files"))


def counts(classified: DataFrame) -> DataFrame:
    return classified.agg(
        F.count(F.lit(1)).alias("files"), F.count_if(~F.col("needs_review")).alias("classified"), F.count_if(F.col("needs_review")).alias("review"), *(F.count_if(F.col("model_decision") == d).alias(d) for d in DECISIONS), F.count_if(F.col("classification_source") == "manual_review").alias("manual")
    )


def categories(classified: DataFrame) -> DataFrame:
    """Distinct categories in Chinese collation order."""
    return classified.filter("category is not null").select("category").distinct().orderBy(F.expr("category COLLATE zh"))


def batches(rows: DataFrame, size: int, ordinal: str = "ordinal") -> DataFrame:
    """``rows`` with batch, numbered in the order of ``ordinal``; one range sort numbers all rows."""
    numbered = with_ordinal(rows, [F.col(ordinal)], "__nth", first=0)
    return numbered.withColumn("batch", F.floor(F.col("__nth") / size).cast("long")).drop("__nth")
