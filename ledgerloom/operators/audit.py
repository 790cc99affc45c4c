"""Checks of published content, and accounts of model requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ordering import running_all

# What must not be published. Examples, local hosts and the two neutral variable prefixes are allowed.
FORBIDDEN = {
    "external API endpoint": r"(?i)https?://(?!(?:localhost|127\.0\.0\.1)(?::\d+)?(?:[/:\s\"'`)]|$))(?!(?:[^/\s\"']+\.)?example(?:\.[a-z]{2,})?(?::\d+)?(?:[/:\s\"'`)]|$))(?:(?:[a-z0-9-]+\.)+[a-z]{2,})(?::\d+)?/v\d+(?:[/?#\s\"'`)]|$)",
    "credential variable": r"\b(?!(?:MODEL|API)_)[A-Z][A-Z0-9]*(?:_(?:API_KEY|API_TOKEN|SECRET|TOKEN|PASSWORD))\b",
    "unsafe prompt marker": r"(?i)\b(?:unrestricted|jailbreak)\b|(?:无限制|不受限制)(?:模式|指令)",
    "private-looking Windows path": r"(?i)\b[A-Z]:\\(?:[^\\\r\n`\"'<>|,]*\\)*(?:[^\\\r\n`\"'<>|,]*[ ][^\\\r\n`\"'<>|,]*\\|[^\\\r\n`\"'<>|,]*[^\x00-\x7F][^\\\r\n`\"'<>|,]*\\|(?:Users|home|Documents and Settings)\\[^\\\r\n`\"'<>|,]+)",
    "email address": r"(?i)\b[A-Z0-9._%+-]+@(?!(?:[A-Z0-9-]+\.)*example(?:\.[A-Z]{2,})?\b)[A-Z0-9.-]+\.[A-Z]{2,}\b",
}


def content_failures(texts: DataFrame, name: str, text: str) -> DataFrame:
    """name, label of every forbidden pattern found; binary text (NUL or replacement characters) is skipped."""
    readable = texts.filter(~F.coalesce(F.col(text).rlike("[\\x{0000}\\x{FFFD}]"), F.lit(True)))
    labels = F.array(*(F.when(F.col(text).rlike(p), F.lit(k)) for k, p in FORBIDDEN.items()))
    return readable.select(F.col(name).alias("name"), F.explode(F.array_compact(labels)).alias("label"))


def markdown_links(texts: DataFrame, name: str, text: str) -> DataFrame:
    """name, link of relative Markdown links, without anchors."""
    links = F.regexp_extract_all(F.col(text), F.lit(r"\]\(([^)\s]+)\)"), F.lit(1))
    found = texts.select(F.col(name).alias("name"), F.explode(F.array_distinct(links)).alias("link"))
    return found.filter(~F.col("link").rlike(r"(?i)^(?:[a-z][a-z0-9+.-]*:|#|//)")).withColumn("link", F.regexp_replace("link", "#.*$", "")).filter("link != ''")


def broken_links(links: DataFrame, files: DataFrame) -> DataFrame:
    """Links (name, link, resolved) whose file is not in ``files`` (path)."""
    return links.join(files.select(F.col("path").alias("resolved")).distinct(), "resolved", "left_anti")


def stale_translations(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """path, source_path of translations (path, text, source_path) that do not name the SHA-256 of their source (path, text)."""
    named = docs.select("path", "source_path", F.regexp_extract("text", r"(?i)\b([0-9a-f]{64})\b", 1).alias("named"))
    actual = sources.select(F.col("path").alias("source_path"), F.sha2(F.col("text").cast("binary"), 256).alias("actual"))
    return named.join(actual, "source_path", "left").filter("actual is null or lower(named) != actual").select("path", "source_path")


def usage_summary(events: DataFrame) -> DataFrame:
    """requests and bytes: reservations, or completions of older logs that have none; only positive finite sizes count."""
    size = F.col("request_bytes").cast("double")
    counted = F.col("event") == "request_reserved"
    legacy = F.col("event").isNull() & F.col("outcome").isin("success", "error")
    return events.agg(F.count_if(counted | legacy).alias("requests"), F.coalesce(F.sum(F.when((counted | legacy) & (size > 0) & ~F.isnan(size) & (size < float("inf")), size)), F.lit(0.0)).alias("bytes"))


def within_budget(events: DataFrame, sequence: str, size: str, requests: int, total: float | None = None) -> DataFrame:
    """``events`` with fits: whether an event, in its sequence, is still within the limits. Requests and sizes run over one range sort; what the partitions before have is carried over."""
    counted = running_all(events, [], [F.col(sequence)], {"__nth": (F.lit(1), "sum", "long"), "__size": (F.col(size), "sum", "double")})
    fits = F.col("__nth") <= requests
    if total is not None:
        fits = fits & (F.col("__size") <= total)
    return counted.withColumn("fits", fits).select(*events.columns, "fits")
