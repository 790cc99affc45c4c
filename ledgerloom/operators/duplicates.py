"""The four duplicate relations over file records.

Records have relative_path, file_name, sha256, card_sha256, name, creator.
``duplicate_members`` has a row for each file of a group; ``pages`` has them in
lists of bounded length, for reports. Neither holds a group in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import identity
from ledgerloom.operators.joins import join_one
from ledgerloom.operators.ordering import rank_within
from ledgerloom.plans.scratch import written

EXACT, SAME_CARD, SAME_NAME, VERSION = "exact_file_duplicate", "same_card_different_file", "same_filename_different_content", "suspected_version"


def _relations() -> dict[str, tuple[Column, str | None]]:
    """Key, and the hash that must differ within a group; rows with a null key are in no group."""
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    return {
        EXACT: (filled("sha256"), None),
        SAME_CARD: (filled("card_sha256"), "sha256"),
        SAME_NAME: (filled("__file_name"), "sha256"),
        VERSION: (F.when((F.col("__name") != "") & F.col("card_sha256").isNotNull(), F.concat("__name", F.lit("\0"), "__creator")), "card_sha256"),
    }


def _keyed(records: DataFrame) -> DataFrame:
    return records.select("relative_path", "sha256", "card_sha256", identity("file_name").alias("__file_name"), identity("name").alias("__name"), identity("creator").alias("__creator"))


def duplicate_members(records: DataFrame, types: tuple[str, ...] = (EXACT, SAME_CARD, SAME_NAME, VERSION)) -> DataFrame:
    """type, key, relative_path, group_size: one aggregation of partial counts for each relation, joined back."""
    keyed, out = _keyed(records), []
    for kind in types:
        key, differ = _relations()[kind]
        rows = keyed.select(key.alias("key"), "relative_path", (F.nullif(F.col(differ), F.lit("")) if differ else F.lit(None).cast("string")).alias("hash")).filter("key is not null")
        # Two different hashes show in the least and the largest: no distinct count is needed.
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("group_size"), F.min("hash").alias("low"), F.max("hash").alias("high")).filter(F.col("group_size") > 1)
        sizes = sizes.filter("low != high") if differ else sizes
        sizes = written(sizes.select("key", "group_size"), "group_sizes")
        out.append(join_one(rows, sizes, ["key"], "group_size").select(F.lit(kind).alias("type"), "key", "relative_path", "group_size"))
    return reduce(DataFrame.unionByName, out)


def _grouped(records: DataFrame, types: tuple[str, ...], *more: Column) -> DataFrame:
    """type, key, group_size, files_differ, cards_differ and ``more`` aggregates of every group, from one pass: each record gives a row for each relation, and all are aggregated together."""
    relations = _relations()
    rows = _keyed(records).select("relative_path", "sha256", "card_sha256", F.explode(F.array(*(F.struct(F.lit(t).alias("type"), relations[t][0].alias("key")) for t in types))).alias("r"))
    ends = [f(F.nullif(F.col(c), F.lit(""))).alias(f"{n}_{c}") for c in ("sha256", "card_sha256") for n, f in (("low", F.min), ("high", F.max))]
    sizes = rows.filter("r.key is not null").groupBy("r.type", "r.key").agg(F.count(F.lit(1)).alias("group_size"), *ends, *more)
    differ = {c: F.coalesce(F.col(f"low_{c}") != F.col(f"high_{c}"), F.lit(False)) for c in ("sha256", "card_sha256")}
    holds = reduce(lambda a, b: a | b, ((F.col("type") == t) & (differ[relations[t][1]] if relations[t][1] else F.lit(True)) for t in types))
    found = sizes.filter((F.col("group_size") > 1) & holds)
    return found.withColumns({"files_differ": differ["sha256"], "cards_differ": differ["card_sha256"]}).drop(*(f"{n}_{c}" for c in differ for n in ("low", "high")))


def group_sizes(records: DataFrame, types: tuple[str, ...] = (EXACT, SAME_CARD, SAME_NAME, VERSION)) -> DataFrame:
    """type, key, group_size, files_differ, cards_differ (different hashes of files, and of cards, are there) of every group."""
    return _grouped(records, types)


#: Paths of a page.
PAGE = 1000


def pages(members: DataFrame, size: int = PAGE) -> DataFrame:
    """type, key, group_size, page (from 0), files (sorted paths, ``size`` at most) of rows that duplicate_members() gave; pages of a group follow each other.

    Groups of one page are gathered as they are. In larger ones a path's place comes from a range sort by group and path, so that a group of any size is spread over tasks.
    """
    members = written(members, "members")
    files = F.sort_array(F.collect_list("relative_path")).alias("files")
    few = members.filter(F.col("group_size") <= size).groupBy("type", "key", "group_size").agg(files).select("type", "key", "group_size", F.lit(0).cast("long").alias("page"), "files")
    many = members.filter(F.col("group_size") > size)
    if not many.take(1):
        return few
    placed = rank_within(many, ["type", "key"], [F.col("relative_path")], "place")
    return few.unionByName(placed.withColumn("page", F.floor((F.col("place") - 1) / size)).groupBy("type", "key", "group_size", "page").agg(files))


def collated() -> list[Column]:
    """Type and key under the Unicode collation."""
    return [F.expr("type COLLATE UNICODE"), F.expr("key COLLATE UNICODE")]


def ordered(groups: DataFrame) -> DataFrame:
    """By type, key and page in the order of the Unicode collation."""
    return groups.orderBy(*collated(), "page")


def type_counts(groups: DataFrame) -> DataFrame:
    """type, groups, files, of rows (type, group_size) for each group."""
    return groups.groupBy("type").agg(F.count(F.lit(1)).alias("groups"), F.sum("group_size").alias("files"))


#: The table that a person reads, with its columns.
REVIEW = ("group_type", "group_key", "page", "file_count", "distinct_file_hashes", "distinct_card_hashes", "relative_paths", "reason")
# What each relation says.
SAID = {EXACT: "the files are equal", SAME_CARD: "one card in different files", SAME_NAME: "one file name, different content", VERSION: "one name and creator, different cards"}


def review_table(records: DataFrame, members: DataFrame, size: int = PAGE) -> DataFrame:
    """A row for each page of a group, with its sorted paths joined by `` | ``."""
    rows = members.join(records.select("relative_path", "sha256", "card_sha256"), "relative_path")
    said = F.create_map(*(F.lit(x) for pair in SAID.items() for x in pair))
    counts = rows.groupBy("type", "key").agg(F.count_distinct("sha256").alias("distinct_file_hashes"), F.count_distinct("card_sha256").alias("distinct_card_hashes"))
    table = pages(members, size).join(counts, ["type", "key"]).withColumnsRenamed({"type": "group_type", "key": "group_key", "group_size": "file_count"})
    return table.withColumns({"relative_paths": F.array_join("files", " | "), "reason": said[F.col("group_type")]}).select(*REVIEW)
