"""Name variants of second-level directories: groups, recommendations, approved targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import PREFERRED_NAMES, canonical_name, comparison_key, directory_name, squeeze

INDEPENDENT_MINIMUM, LONG_TAIL_MAXIMUM = 10, 5
# Buckets by source medium, the shared world and its names, recommendations.
BUCKETS = {"动画与漫画": "其他动漫同人", "游戏": "其他游戏同人", "小说": "其他小说同人", "影视": "其他电视剧同人"}
WAITING = "待确认原作"
SHARED_WORLD = "型月世界"
SHARED_WORLD_KEYS = ("fate", "fgo", "命运冠位指定", "月姬", "魔法使之夜", "魔法少女伊莉雅")
OTHER = "其他"
SHARED, RENAME, LONG_TAIL, BELOW, VARIANT, KEEP = "共享世界观归并", "兜底目录改名", "长尾归档", "门槛待审核", "同名变体归并", "保留独立目录"


def directory_stats(files: DataFrame, directory: str, medium: str) -> DataFrame:
    """current_directory, file_count, source_categories (the distinct media, few)."""
    return files.groupBy(F.col(directory).alias("current_directory")).agg(F.count(F.lit(1)).alias("file_count"), F.sort_array(F.collect_set(F.nullif(F.col(medium), F.lit("")))).alias("source_categories"))


def candidates(directories: DataFrame, shared_keys: tuple[str, ...] = SHARED_WORLD_KEYS, other: str = OTHER, buckets: dict[str, str] | None = None, preferred: dict[str, str] | None = None) -> DataFrame:
    """A row for each directory: canonical_name, group total, source_category, recommendation, suggested_target and its total.

    ``directories`` has current_directory, file_count, source_categories. Groups are keyed by the canonical name's comparison key.
    """
    buckets, preferred = BUCKETS if buckets is None else buckets, PREFERRED_NAMES if preferred is None else preferred
    rows = directories.select(squeeze("current_directory").alias("current_directory"), "file_count", F.coalesce("source_categories", F.array().cast("array<string>")).alias("source_categories")).withColumn("canonical", canonical_name("current_directory", preferred)).withColumn("key", comparison_key("canonical"))
    best = Window.partitionBy("key").orderBy(F.desc("file_count"), F.length("canonical"), F.expr("canonical COLLATE zh"))
    whole = Window.partitionBy("key")
    spelled = F.create_map(*(F.lit(x) for kv in preferred.items() for x in kv))[F.col("key")] if preferred else F.lit(None).cast("string")
    media = F.array_distinct(F.filter(F.flatten(F.collect_set("source_categories").over(whole)), lambda m: m.isNotNull() & (m != "")))
    rows = rows.withColumns(
        {
            "canonical_name": F.coalesce(spelled, F.first("canonical").over(best)),
            "canonical_group_file_count": F.sum("file_count").over(whole),
            "members": F.count(F.lit(1)).over(whole),
            "source_category": F.when(F.size(media) == 1, media[0]),
            "has_other": F.max(F.col("current_directory") == other).over(whole),
        }
    ).withColumn("renamed", F.max(F.col("current_directory") != F.col("canonical_name")).over(whole))
    total = F.col("canonical_group_file_count")
    recommendation = F.when(F.col("key").isin(*shared_keys), SHARED).when(F.col("has_other"), RENAME).when(total <= LONG_TAIL_MAXIMUM, LONG_TAIL).when(total < INDEPENDENT_MINIMUM, BELOW).when((F.col("members") > 1) | F.col("renamed"), VARIANT).otherwise(KEEP)
    bucket = F.coalesce(F.create_map(*(F.lit(x) for kv in buckets.items() for x in kv))[F.col("source_category")], F.lit(WAITING)) if buckets else F.lit(WAITING)
    rows = rows.withColumn("recommendation", recommendation)
    rows = rows.withColumn("suggested_target", F.when(F.col("recommendation") == SHARED, SHARED_WORLD).when(F.col("recommendation") == RENAME, WAITING).when(F.col("recommendation") == LONG_TAIL, bucket).otherwise(F.col("canonical_name")))
    rows = rows.withColumn("suggested_target_file_count", F.sum("file_count").over(Window.partitionBy("suggested_target")))
    return rows.select("current_directory", "canonical_name", "suggested_target", "file_count", "canonical_group_file_count", "source_category", "recommendation", merge_basis().alias("merge_basis"), "suggested_target_file_count")


def merge_basis():
    """Why: a sentence with the count, and the medium where it decided."""
    total = F.col("canonical_group_file_count").cast("string")
    r = F.col("recommendation")
    return (
        F.when(r == SHARED, F.lit("shared world: works of one official series go together"))
        .when(r == RENAME, F.lit("the catch-all directory names no work and is renamed"))
        .when(r == LONG_TAIL, F.concat(total, F.lit(" files in all variants, fewer than 6; "), F.coalesce(F.concat(F.lit("medium "), F.col("source_category")), F.lit("no single medium"))))
        .when(r == BELOW, F.concat(total, F.lit(" files in all variants, 6 to 9: a person decides")))
        .when(r == VARIANT, F.lit("equal but for suffix, punctuation, space and case"))
        .otherwise(F.concat(total, F.lit(" files, enough for a directory")))
    )


def check_candidates(rows: DataFrame) -> None:
    """Directories must be unique, and all names valid."""
    bad = rows.filter(directory_name("current_directory").isNull() | directory_name("canonical_name").isNull() | directory_name("suggested_target").isNull()).take(1)
    repeated = rows.groupBy("current_directory").count().filter("count > 1").take(1)
    if bad or repeated:
        raise ValueError(f"candidates hold an invalid or repeated directory: {(bad or repeated)[0].current_directory}")


def approved_targets(rows: DataFrame, overrides: DataFrame, policy_recommendation: str, policy_target: str) -> DataFrame:
    """Candidates with approved_target and approval_source: a person's override, then the policy for one recommendation, then the suggestion. Overrides are few and typed by hand."""
    o = overrides.select("current_directory", F.col("approved_target").alias("__override"))
    by_policy = F.col("recommendation") == policy_recommendation
    return rows.join(o, "current_directory", "left").select(
        *rows.columns,
        F.coalesce("__override", F.when(by_policy, F.lit(policy_target)), F.col("suggested_target")).alias("approved_target"),
        F.when(F.col("__override").isNotNull(), "manual_override").when(by_policy, "minimum_policy").otherwise("candidate").alias("approval_source"),
    )


def policy_totals(rows: DataFrame, recommendation: str) -> DataFrame:
    """canonical_group_count, current_directory_count and file_count that a policy covers."""
    return rows.filter(F.col("recommendation") == recommendation).agg(F.count_distinct("canonical_name").alias("canonical_group_count"), F.count(F.lit(1)).alias("current_directory_count"), F.coalesce(F.sum("file_count"), F.lit(0)).alias("file_count"))


def reconcile(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key and problem of rows that are missing on one side or differ in a column, nulls being equal to nulls; empty when both agree."""
    l = left.select(F.col(key).alias("__lk"), *(F.col(c).alias(f"__l_{c}") for c in columns))  # noqa: E741
    r = right.select(F.col(key).alias("__rk"), *(F.col(c).alias(f"__r_{c}") for c in columns))
    both = l.join(r, F.col("__lk") == F.col("__rk"), "full_outer")
    differ = F.lit(False)
    for c in columns:
        differ = differ | ~F.col(f"__l_{c}").eqNullSafe(F.col(f"__r_{c}"))
    problem = F.when(F.col("__rk").isNull(), "missing_right").when(F.col("__lk").isNull(), "missing_left").when(differ, "different")
    return both.select(F.coalesce("__lk", "__rk").alias(key), problem.alias("problem")).filter("problem is not null")
