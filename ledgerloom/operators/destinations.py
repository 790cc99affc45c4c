"""The guards before a plan, and the files that a plan before it has placed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import safe_category
from ledgerloom.operators.grouping import FANWORK


def repeated_paths(rows: DataFrame, path: str = "relative_path") -> DataFrame:
    """Guard: paths that are empty or occur more than once."""
    return rows.groupBy(F.coalesce(F.col(path), F.lit("")).alias(path)).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | (F.col(path) == ""))


def bad_hashes(rows: DataFrame, column: str = "sha256") -> DataFrame:
    """Guard: rows without a SHA-256."""
    return rows.filter(~F.coalesce(F.col(column).rlike("(?i)^[0-9a-f]{64}$"), F.lit(False)))


def inconsistent_decisions(rows: DataFrame) -> DataFrame:
    """Guard: rows whose decision, category and flag do not go together."""
    d, c, r = F.col("model_decision"), F.coalesce("category", F.lit("")), F.col("needs_review")
    good = ((d == "classify") & (c != "") & ~r) | ((d == "exclude") & r) | ((d == "review") & (c == "") & r)
    return rows.filter(~F.coalesce(good, F.lit(False)))


def colliding_categories(rows: DataFrame, category: str = "category") -> DataFrame:
    """Guard: sanitised names, case aside, that several categories would share; name, owners."""
    names = rows.select(F.trim(category).alias("__c")).filter("__c is not null").distinct()
    return names.groupBy(F.lower(safe_category("__c")).alias("name")).agg(F.count(F.lit(1)).alias("owners")).filter("owners > 1")


def bad_refinements(rows: DataFrame) -> DataFrame:
    """Guard: rows without a path, a SHA-256 or the scope's flag, and fanworks that are not selected or have no directory."""
    named = F.coalesce("selected_for_refinement", F.lit(False)) & (F.coalesce(F.trim("subcategory"), F.lit("")) != "")
    good = (F.coalesce("relative_path", F.lit("")) != "") & F.coalesce(F.col("sha256").rlike("(?i)^[0-9a-f]{64}$"), F.lit(False)) & F.col("selected_for_refinement").isNotNull() & ((F.col("parent_category") != FANWORK) | named)
    return rows.filter(~F.coalesce(good, F.lit(False)))


def must_count(rows: DataFrame, expected: int | None, what: str) -> None:
    """Guard: the relation has as many rows as its summary says."""
    if expected is not None and (n := rows.count()) != expected:
        raise ValueError(f"{what} has {n} rows, its summary says {expected}")


def organised_sources(rows: DataFrame, files: DataFrame) -> DataFrame:
    """``rows`` (parent_category, file_name, sha256) with source_relative: the file below the parent's folder with that hash whose name is the row's or, else, begins with its ``stem__hash12``, case aside; null where there is none.

    ``files`` have relative_path and sha256. Of several files the first by path counts.
    """
    path = F.split("relative_path", "/")
    found = files.filter(F.size(path) == 2).select(path[0].alias("parent_category"), path[1].alias("__name"), "sha256", F.col("relative_path").alias("__path"))
    stem = lambda c: F.lower(F.regexp_replace(c, r"(?<=.)\.[^.]*$", ""))
    mark = F.lower(F.concat(F.lit("__"), F.substring("sha256", 1, 12)))
    key = lambda later, text: F.struct(F.lit(later).alias("later"), text.alias("text"))
    # A file meets the rows by its name and by each of its beginnings that end in the mark: the many copies of one content do not all meet.
    name = stem(F.col("__name"))
    ends = F.filter(F.sequence(F.lit(1), F.greatest(F.length(name), F.lit(1))), lambda i: F.substring(name, i, F.length(mark)) == mark)
    begins = F.transform(ends, lambda i: key(True, F.substring(name, F.lit(1), i + F.length(mark) - 1)))
    found = found.select("parent_category", "sha256", "__path", F.explode(F.concat(F.array(key(False, F.col("__name"))), begins)).alias("__key"))
    keys = ["parent_category", "sha256", "file_name"]
    asked = rows.select(*keys).distinct().select(*keys, F.explode(F.array(key(False, F.col("file_name")), key(True, F.concat(stem(F.col("file_name")), mark)))).alias("__key"))
    best = asked.join(found, ["parent_category", "sha256", "__key"]).groupBy(*keys).agg(F.min_by("__path", F.struct("__key.later", "__path")).alias("source_relative"))
    return rows.join(best, keys, "left")


def must_be_empty(problems: DataFrame, message: str) -> None:
    found = problems.take(3)
    if found:
        raise ValueError(f"{message}: {'; '.join(map(str, found))}")
