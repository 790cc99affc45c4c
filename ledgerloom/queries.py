"""The query catalogue: each operator on the given tables, with the SQL that must give the same rows."""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import canonical_json as cj
from ledgerloom.functions import text as T
from ledgerloom.operators import audit, decisions, destinations, duplicates, grouping, merging, naming, ordering
from ledgerloom.operators.model_input import LISTS, TEXTS, has_semantic_content, model_inputs
from ledgerloom.plans import stages
from ledgerloom.plans.scratch import written
from ledgerloom.sources import cards

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- The documents as file records, and labels as decisions.


def file_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    squeezed = T.squeeze("text")
    return d.select(
        F.concat("source", F.lit("/"), "lang", F.lit("/"), "doc_id", F.lit(".json")).alias("relative_path"),
        F.concat(F.lit("doc_"), F.col("doc_id") % 50, F.lit(".json")).alias("file_name"),
        F.sha2("text", 256).alias("sha256"),
        F.sha2(F.lower(squeezed), 256).alias("card_sha256"),
        F.substring(squeezed, 1, 40).alias("name"),
        F.col("source").alias("creator"),
        F.col("doc_id").alias("ordinal"),
        "lang",
        "text",
        (F.length(squeezed) > 0).alias("has_content"),
    )


RECORDS = r"""
WITH records AS (
  SELECT source || '/' || lang || '/' || doc_id || '.json' AS relative_path, 'doc_' || (doc_id % 50) || '.json' AS file_name,
    sha256(text) AS sha256, sha256(lower(squeezed)) AS card_sha256, substr(squeezed, 1, 40) AS name, source AS creator, doc_id AS ordinal,
    lang, text, squeezed, length(squeezed) > 0 AS has_content
  FROM (SELECT *, trim(regexp_replace(text, '\s+', ' ', 'g')) AS squeezed FROM documents)
)"""


def narrow_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file records without their texts, written: texts are squeezed and hashed once, however often the records are read."""
    return written(file_records(spark, sf_dir).drop("text"), "records")


def label_decisions(spark: SparkSession, sf_dir: str, records: DataFrame | None = None) -> DataFrame:
    """A decision for the content of each labelled document: toxic is excluded, good quality classified by language, the rest reviewed. Of copies the first counts."""
    records = records if records is not None else narrow_records(spark, sf_dir)
    labelled = records.join(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("ordinal"), "quality", "toxic"), "ordinal")
    decision = F.when(F.col("toxic") == 1, "exclude").when(F.col("quality") == 1, "classify").otherwise("review")
    raw = labelled.select("card_sha256", decision.alias("decision"), F.when(decision == "classify", F.col("lang")).alias("category"), F.lit("").alias("reason"), "ordinal")
    return decisions.normalise_decision(decisions.first_wins(raw, ["card_sha256"]))


DECISIONS = (
    RECORDS
    + """, decided AS (
  SELECT card_sha256, arg_min(decision, ordinal) AS decision, arg_min(lang, ordinal) AS category FROM (
    SELECT card_sha256, ordinal, lang, CASE WHEN toxic = 1 THEN 'exclude' WHEN quality = 1 THEN 'classify' ELSE 'review' END AS decision
    FROM records JOIN labels ON labels.doc_id = records.ordinal) GROUP BY card_sha256
), classified AS (
  SELECT r.*, CASE WHEN decision = 'classify' AND has_content THEN d.category END AS category,
    CASE WHEN has_content AND decision IS NOT NULL THEN 'model' ELSE 'manual_review' END AS classification_source,
    CASE WHEN has_content AND decision IS NOT NULL THEN decision ELSE 'review' END AS model_decision,
    NOT (has_content AND coalesce(decision = 'classify', false)) AS needs_review
  FROM records r LEFT JOIN decided d USING (card_sha256)
)"""
)


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classification, written as the stage writes it."""
    records = narrow_records(spark, sf_dir)
    return written(decisions.map_back(records, label_decisions(spark, sf_dir, records)).drop("reason"), "classified")


# --- Duplicates.


#: Paths of a page in these queries: few, so that groups have several.
PAGE = 10

#: What each relation needs of a record.
_NEEDED = {duplicates.EXACT: ("sha256",), duplicates.SAME_CARD: ("card_sha256", "sha256"), duplicates.SAME_NAME: ("file_name", "sha256"), duplicates.VERSION: ("name", "creator", "card_sha256")}


def paged_groups(records: DataFrame, kind: str) -> DataFrame:
    """The pages of a relation; only what it needs of the records is written."""
    rest = [c for c in ("file_name", "sha256", "card_sha256", "name", "creator") if c not in _NEEDED[kind]]
    narrow = written(records.select("relative_path", *_NEEDED[kind]), "records").select("*", *(F.lit("").alias(c) for c in rest))
    pages = duplicates.pages(duplicates.duplicate_members(narrow, (kind,)), PAGE)
    return pages.select("key", "group_size", "page", F.array_join("files", " | ").alias("files"))


def paged_sql(key: str, given: str, differ: str | None, records: str = RECORDS) -> str:
    """Groups with their pages: all records whose key is ``given``, of groups of several, in which ``differ`` has several values."""
    return f"""{records}, keyed AS (SELECT {key} AS key, relative_path, {differ or "''"} AS h FROM records WHERE {given}), placed AS (
  SELECT *, count(*) OVER w AS group_size, min(h) OVER w AS low, max(h) OVER w AS high, (row_number() OVER (PARTITION BY key ORDER BY relative_path) - 1) // {PAGE} AS page FROM keyed WINDOW w AS (PARTITION BY key)
) SELECT key, group_size, page, string_agg(relative_path, ' | ' ORDER BY relative_path) AS files FROM placed WHERE group_size > 1{" AND low <> high" if differ else ""} GROUP BY ALL"""


@query(paged_sql("sha256", "true", None))
def exact_duplicates(spark, sf_dir):
    return paged_groups(file_records(spark, sf_dir), duplicates.EXACT)


@query(paged_sql("file_name", "true", "sha256"))
def same_filename_different_content(spark, sf_dir):
    return paged_groups(file_records(spark, sf_dir), duplicates.SAME_NAME)


@query(f"SELECT * REPLACE (sha256(key) AS key) FROM ({paged_sql('lower(trim(name)) || chr(0) || lower(creator)', "name <> ''", 'card_sha256')})")
def suspected_version(spark, sf_dir):
    return paged_groups(file_records(spark, sf_dir), duplicates.VERSION).withColumn("key", F.sha2("key", 256))


_MEMBERS = """, members AS (
  SELECT 'exact_file_duplicate' AS type, sha256 AS key, count(*) AS n FROM records GROUP BY 2 HAVING count(*) > 1
  UNION ALL SELECT 'same_card_different_file', card_sha256, count(*) FROM records GROUP BY 2 HAVING count(*) > 1 AND count(DISTINCT sha256) > 1
  UNION ALL SELECT 'same_filename_different_content', file_name, count(*) FROM records GROUP BY 2 HAVING count(*) > 1 AND count(DISTINCT sha256) > 1
  UNION ALL SELECT 'suspected_version', lower(trim(name)) || chr(0) || lower(creator), count(*) FROM records WHERE name <> '' GROUP BY 2 HAVING count(*) > 1 AND count(DISTINCT card_sha256) > 1
)"""


@query(RECORDS + _MEMBERS + " SELECT type, count(*) AS groups, sum(n)::BIGINT AS files FROM members GROUP BY type")
def duplicate_type_counts(spark, sf_dir):
    return duplicates.type_counts(duplicates.group_sizes(file_records(spark, sf_dir)))


@query(RECORDS + _MEMBERS + " SELECT type, sha256(key) AS key, n AS group_size, row_number() OVER (ORDER BY type, sha256(key)) AS ordinal FROM members")
def duplicate_groups_ordered(spark, sf_dir):
    """The order of the groups is part of the rows: the place of each under the collation."""
    groups = duplicates.group_sizes(file_records(spark, sf_dir)).select("type", F.sha2("key", 256).alias("key"), "group_size")
    return ordering.with_ordinal(written(groups, "groups"), duplicates.collated())


# --- Scan, extraction and text.


@query(
    "SELECT CASE WHEN n_chars = 0 THEN 'no_card_metadata' WHEN lang = 'en' THEN 'valid' WHEN n_chars > 5000 THEN 'valid_with_warnings' ELSE 'unsupported_card_spec' END AS label, count(*) AS count FROM documents GROUP BY 1"
)
def scan_status_counts(spark, sf_dir):
    status = F.when(F.col("n_chars") == 0, "no_card_metadata").when(F.col("lang") == "en", "valid").when(F.col("n_chars") > 5000, "valid_with_warnings").otherwise("unsupported_card_spec")
    return cards.counted(table(spark, sf_dir, "documents").select(status.alias("status")), "status")


@query(
    "SELECT conv_id, turn, concat_ws('; ', CASE WHEN turn % 2 = 1 THEN 'name is not a string' END, CASE WHEN turn % 3 = 0 THEN 'description is not a string' END, CASE WHEN role = 'user' THEN 'tags is neither a string nor an array' END, CASE WHEN turn % 5 = 4 AND role <> 'user' THEN 'group_only_greetings is neither a string nor an array' END) AS warnings FROM conversations"
)
def scan_warnings(spark, sf_dir):
    """Turns as cards with fields of wrong types: users' tags are objects, others' cards are of version 3."""

    def warned(turn: pd.Series, role: pd.Series, text: pd.Series) -> pd.Series:
        def one(n: int, who: str, t: str) -> str:
            data = {"name": n if n % 2 else who, "description": [t] if n % 3 == 0 else t, "tags": {} if who == "user" else [who], "group_only_greetings": n if n % 5 == 4 else None}
            return "; ".join(cards.warnings_for({"data": data}, 2 if who == "user" else 3))

        return pd.Series([one(*x) for x in zip(turn, role, text, strict=True)], dtype=object)

    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.pandas_udf(warned, "string")("turn", "role", "text").alias("warnings"))


@query("""SELECT event_id, sha256('{"k":' || json_extract_string(props, '$.k') || '}') AS card_sha256 FROM events""")
def canonical_hash(spark, sf_dir):
    def hashed(props: pd.Series) -> pd.Series:
        return props.map(lambda p: cj.content_hash(cj.load(p)))

    return table(spark, sf_dir, "events").select("event_id", F.pandas_udf(hashed, "string")("props").alias("card_sha256"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_field_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT doc_id, CASE WHEN source LIKE '%2' THEN 2 WHEN source LIKE '%3' THEN 3 WHEN n_chars >= 100 THEN 1 END AS version FROM documents")
def version_detect(spark, sf_dir):
    """Sources that end in 2 or 3 name their specification; of the others, short documents lack a field of version 1."""

    def versions(source: pd.Series, n_chars: pd.Series, text: pd.Series) -> pd.Series:
        def one(s: str, n: int, t: str) -> int | None:
            if s[-1:] in ("2", "3"):
                return cards.version_of({"spec": f"chara_card_v{s[-1]}", "data": {}})
            card = dict.fromkeys(cards.V1_FIELDS, "") | {"description": t}
            return cards.version_of(card if n >= 100 else {k: v for k, v in card.items() if k != "description"})

        return pd.Series([one(*x) for x in zip(source, n_chars, text, strict=True)], dtype="Int32")

    return table(spark, sf_dir, "documents").select("doc_id", F.pandas_udf(versions, "int")("source", "n_chars", "text").alias("version"))


_COMPACT = r"CASE WHEN length(squeezed) > {n} THEN substr(squeezed, 1, {n}) || '…' ELSE squeezed END"


@query(RECORDS + f" SELECT ordinal AS doc_id, {_COMPACT.format(n=1000)} AS compacted FROM records")
def compact_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.compact("text", 1000).alias("compacted"))


@query(
    r"""SELECT conv_id, array_to_string(list_transform(list_slice(list(text ORDER BY turn, role, text), 1, 4), lambda x: CASE WHEN length(trim(regexp_replace(x, '\s+', ' ', 'g'))) > 240 THEN substr(trim(regexp_replace(x, '\s+', ' ', 'g')), 1, 240) || '…' ELSE trim(regexp_replace(x, '\s+', ' ', 'g')) END), ' | ') AS greetings
FROM conversations GROUP BY conv_id"""
)
def compact_array(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))), lambda t: t["text"]).alias("texts"))
    return turns.select("conv_id", F.array_join(T.compact_array("texts", 4, 240), " | ").alias("greetings"))


def _as_cards(rows: DataFrame, **fields) -> DataFrame:
    """``rows`` with ``card``: all fields of a model's input, those not given empty."""
    empty = {k: F.lit("") for k in TEXTS} | {k: F.array().cast("array<string>") for k in LISTS} | {"character_book": F.lit(None).cast("string")}
    return rows.withColumn("card", F.struct(*(v.alias(k) for k, v in (empty | fields).items())))


_INPUT = {"creator": "creator", "description": _COMPACT.format(n=1000), "personality": _COMPACT.format(n=650), "scenario": _COMPACT.format(n=650), "creator_notes": _COMPACT.format(n=350), "first_mes": _COMPACT.format(n=750), "mes_example": _COMPACT.format(n=600), "system_prompt": _COMPACT.format(n=400)}


@query(RECORDS + f" SELECT card_sha256 AS id, ordinal, trim(name) AS name, {', '.join(f'{v} AS {k}' for k, v in _INPUT.items())}, '' AS post_history_instructions, lang || ',' || creator AS tags, '' AS alternate_greetings, '' AS group_only_greetings, {_COMPACT.format(n=700)} AS character_book FROM records")
def model_input(spark, sf_dir):
    """All fifteen fields: texts, lists, and the whole text as a book of one entry."""
    text = F.col("text")
    records = _as_cards(file_records(spark, sf_dir), name=F.col("name"), creator=F.col("creator"), tags=F.array("lang", "creator"), character_book=F.to_json(F.array("text")), **dict.fromkeys(("description", "personality", "scenario", "creator_notes", "first_mes", "mes_example", "system_prompt"), text))
    return model_inputs(records, keep=("ordinal",)).withColumns({k: F.array_join(k, ",") for k in LISTS})


@query(r"SELECT page_id, page_id % 3 = 0 OR length(trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))) > 0 AS has_content FROM pages")
def has_content(spark, sf_dir):
    """Pages as cards: their bare text as description; every third has a blank greeting, which counts."""
    pages = table(spark, sf_dir, "pages").withColumn("card_sha256", F.lit(""))
    greeting = F.when(F.col("page_id") % 3 == 0, F.array(F.lit(" "))).otherwise(F.array().cast("array<string>"))
    return model_inputs(_as_cards(pages, description=F.regexp_replace("html", "<[^>]*>", " "), alternate_greetings=greeting), keep=("page_id",)).select("page_id", has_semantic_content().alias("has_content"))


@query(RECORDS + " SELECT card_sha256, min(ordinal) AS ordinal, arg_min(relative_path, ordinal) AS relative_path FROM records GROUP BY card_sha256")
def unique_content(spark, sf_dir):
    return decisions.first_wins(file_records(spark, sf_dir).select("card_sha256", "ordinal", "relative_path"), ["card_sha256"])


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def last_wins_checkpoint(spark, sf_dir):
    return decisions.last_wins(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


# --- Decisions.


@query(DECISIONS + " SELECT DISTINCT r.card_sha256 FROM records r WHERE has_content AND NOT EXISTS (SELECT 1 FROM decided d WHERE d.card_sha256 = r.card_sha256)")
def pending_anti_join(spark, sf_dir):
    records = narrow_records(spark, sf_dir)
    return decisions.pending(records.select("card_sha256", "has_content").distinct(), label_decisions(spark, sf_dir, records), F.col("has_content")).select("card_sha256")


@query(DECISIONS + " SELECT relative_path, card_sha256, category, classification_source, model_decision, needs_review FROM classified")
def decision_map_back(spark, sf_dir):
    return classified(spark, sf_dir).select("relative_path", "card_sha256", "category", "classification_source", "model_decision", "needs_review")


@query(
    DECISIONS
    + " SELECT count(*) AS files, count(*) FILTER (NOT needs_review) AS classified, count(*) FILTER (needs_review) AS review_files, count(*) FILTER (model_decision = 'classify') AS classify, count(*) FILTER (model_decision = 'exclude') AS exclude, count(*) FILTER (model_decision = 'review') AS undecided, count(*) FILTER (classification_source = 'manual_review') AS manual FROM classified"
)
def decision_counts(spark, sf_dir):
    c = classified(spark, sf_dir)
    n = lambda condition: F.count_if(condition)
    return c.agg(F.count(F.lit(1)).alias("files"), n(~F.col("needs_review")).alias("classified"), n(F.col("needs_review")).alias("review_files"), n(F.col("model_decision") == "classify").alias("classify"), n(F.col("model_decision") == "exclude").alias("exclude"), n(F.col("model_decision") == "review").alias("undecided"), n(F.col("classification_source") == "manual_review").alias("manual"))


@query(DECISIONS + " SELECT relative_path, model_decision FROM classified WHERE needs_review")
def review_target_1(spark, sf_dir):
    return decisions.first_review_targets(classified(spark, sf_dir)).select("relative_path", "model_decision")


def _reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First review: excluded content of even documents is classified, reviewed content of odd ones excluded; the rest has no answer."""
    c = classified(spark, sf_dir)
    first = decisions.first_wins(c.select("card_sha256", "ordinal", "model_decision", "classification_source", "lang"), ["card_sha256"])
    decision = F.when((F.col("model_decision") == "exclude") & (F.col("ordinal") % 2 == 0), "classify").when((F.col("classification_source") == "model") & (F.col("model_decision") == "review"), F.when(F.col("ordinal") % 2 == 1, "exclude").otherwise("review"))
    answers = first.select("card_sha256", decision.alias("decision"), F.col("lang").alias("category")).filter("decision is not null")
    return written(decisions.merge_review(c, decisions.first_review_targets(c), answers), "reviewed")


REVIEWED = (
    DECISIONS
    + """, answers AS (
  SELECT card_sha256, lang, CASE WHEN model_decision = 'exclude' AND ordinal % 2 = 0 THEN 'classify' WHEN classification_source = 'model' AND model_decision = 'review' THEN CASE WHEN ordinal % 2 = 1 THEN 'exclude' ELSE 'review' END END AS decision
  FROM classified QUALIFY row_number() OVER (PARTITION BY card_sha256 ORDER BY ordinal) = 1
), reviewed AS (
  SELECT c.relative_path, c.card_sha256, c.ordinal, c.model_decision AS previous_decision, needs_review AND has_content AND a.decision IS NOT NULL AS merged,
    CASE WHEN needs_review AND has_content AND a.decision IS NOT NULL THEN CASE WHEN a.decision = 'classify' THEN a.lang END ELSE c.category END AS category,
    CASE WHEN needs_review AND has_content AND a.decision IS NOT NULL THEN 'model_recheck' ELSE c.classification_source END AS classification_source,
    CASE WHEN needs_review AND has_content AND a.decision IS NOT NULL THEN a.decision ELSE c.model_decision END AS model_decision,
    CASE WHEN needs_review AND has_content AND a.decision IS NOT NULL THEN a.decision <> 'classify' ELSE c.needs_review END AS needs_review,
    CASE WHEN needs_review THEN CASE WHEN NOT has_content THEN 'no_semantic_content' WHEN a.decision IS NOT NULL THEN 'complete' ELSE 'incomplete' END END AS recheck_status
  FROM classified c LEFT JOIN answers a ON a.card_sha256 = c.card_sha256 AND a.decision IS NOT NULL
)"""
)


@query(REVIEWED + " SELECT relative_path, category, classification_source, previous_decision, model_decision, needs_review, merged, recheck_status FROM reviewed")
def review_merge(spark, sf_dir):
    return _reviewed(spark, sf_dir).select("relative_path", "category", "classification_source", "previous_decision", "model_decision", "needs_review", "merged", "recheck_status")


@query(REVIEWED + " SELECT relative_path FROM reviewed WHERE needs_review AND model_decision = 'review' AND recheck_status = 'complete'")
def review_target_2(spark, sf_dir):
    return decisions.second_review_targets(_reviewed(spark, sf_dir)).select("relative_path")


@query(
    REVIEWED
    + """, targets AS (SELECT DISTINCT card_sha256 FROM reviewed WHERE needs_review AND model_decision = 'review' AND recheck_status = 'complete')
SELECT relative_path, CASE WHEN t.card_sha256 IS NULL THEN model_decision ELSE 'exclude' END AS model_decision, t.card_sha256 IS NOT NULL AS merged FROM reviewed r LEFT JOIN targets t USING (card_sha256)"""
)
def second_review_merge(spark, sf_dir):
    """The second review touches all files that share a target's content; here it excludes them."""
    r = _reviewed(spark, sf_dir).drop("previous_decision", "merged")
    targets = decisions.second_review_targets(r)
    answers = targets.select("card_sha256").distinct().select("card_sha256", F.lit("exclude").alias("decision"), F.lit(None).cast("string").alias("category"))
    return decisions.merge_review(r, targets, answers, "model_recheck_2", by_hash=True).select("relative_path", "model_decision", "merged")


@query(REVIEWED + " SELECT previous_decision, model_decision, count(*) AS files FROM reviewed WHERE merged GROUP BY 1, 2")
def transition_matrix(spark, sf_dir):
    return decisions.transitions(_reviewed(spark, sf_dir))


@query(DECISIONS + " SELECT card_sha256 FROM (SELECT card_sha256, CASE WHEN ordinal % 2 = 0 THEN 'exclude' ELSE model_decision END AS model_decision, category FROM classified) GROUP BY 1 HAVING count(DISTINCT model_decision || chr(0) || coalesce(category, '')) > 1")
def conflict_guard(spark, sf_dir):
    """Decisions spoiled on purpose: those of even documents, so that copies disagree."""
    spoiled = classified(spark, sf_dir).withColumn("model_decision", F.when(F.col("ordinal") % 2 == 0, "exclude").otherwise(F.col("model_decision")))
    return decisions.conflicting(spoiled)


@query(DECISIONS + " SELECT DISTINCT category FROM classified WHERE category IS NOT NULL")
def category_list(spark, sf_dir):
    return decisions.categories(classified(spark, sf_dir))


# --- Grouping.

_ALLOWED = ["en", "fr"]
PARENTS = DECISIONS + ", parents AS (SELECT *, CASE model_decision WHEN 'exclude' THEN '排除' WHEN 'review' THEN '未分类' ELSE CASE WHEN category IN ('en', 'fr') THEN category ELSE '标准外' END END AS parent_category FROM classified)"


def _with_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = classified(spark, sf_dir)
    return c.withColumn("parent_category", grouping.parent_category(F.col("model_decision"), F.col("category"), _ALLOWED))  # c is a written table


@query(PARENTS + " SELECT relative_path, model_decision, category, parent_category FROM parents")
def parent_category(spark, sf_dir):
    return _with_parent(spark, sf_dir).select("relative_path", "model_decision", "category", "parent_category")


@query("SELECT p_type AS parent, count(*) AS files, count(*) > (SELECT count(*) // 6 FROM part) AS selected FROM part GROUP BY p_type")
def threshold_counts(spark, sf_dir):
    """Types with more than the mean number of parts, by the strict threshold."""
    p = table(spark, sf_dir, "part")
    n = p.count() // 6
    return p.groupBy(F.col("p_type").alias("parent")).agg(F.count(F.lit(1)).alias("files")).withColumn("selected", F.col("files") > n)


@query(PARENTS + " SELECT parent_category, count(*) AS files FROM parents WHERE parent_category IN ('同人', '排除', '未分类', '标准外') GROUP BY 1 HAVING count(*) > 50")
def threshold_parents(spark, sf_dir):
    return grouping.selected_parents(_with_parent(spark, sf_dir), threshold=50)


_REASON = "CASE ordinal % 9 WHEN 0 THEN '角色16岁' WHEN 1 THEN '英文内容' WHEN 2 THEN '含血腥描写' WHEN 3 THEN '伪娘角色' WHEN 4 THEN '正文加密' WHEN 5 THEN '十七岁学生' WHEN 6 THEN '116岁精灵' WHEN 7 THEN '语言混杂' ELSE '其他' END"
_AGES = r"(?:^|[^A-Za-z0-9_])(?:[0-9]|1[0-7])\s*岁|(?:十[一二三四五六七]?|[一二三四五六七八九])岁"
SPECIAL = PARENTS + f""", reasons AS (SELECT *, {_REASON} AS reason FROM parents), special AS (
  SELECT *, CASE parent_category WHEN '标准外' THEN coalesce(category, '其他') WHEN '排除' THEN CASE
    WHEN regexp_matches(reason, '英文|英语|日文|日语|外文|外语|非中文|中文内容不足|长期阅读') THEN '外文内容'
    WHEN regexp_matches(reason, 'R18G|血腥|猎奇|肢解|断肢|内脏|虐杀|食人|尸体|奸尸|血肉|重口|排泄物|身体破坏') THEN 'R18G与血腥猎奇'
    WHEN regexp_matches(reason, '未成年|幼女|幼态|儿童|孩童|婴幼儿|萝莉|正太|小学|初中|高中|国中|{_AGES}') THEN '未成年或幼态内容'
    WHEN regexp_matches(reason, '男娘|扶她|伪娘|女装男性|性转|雌雄同体') THEN '核心性别属性' ELSE '其他排除原因' END
  WHEN '未分类' THEN CASE
    WHEN regexp_matches(reason, '男娘|扶她|伪娘|女装男性|性转|雌雄同体|男性灵魂|女性身体') THEN '核心性别属性'
    WHEN regexp_matches(reason, '加密|信息不足|内容不足|无法读取|裁剪不足|正文') THEN '信息不足或加密'
    WHEN regexp_matches(reason, '年龄|未成年|幼态|视觉年龄|{_AGES}') THEN '年龄边界'
    WHEN regexp_matches(reason, '英文|英语|外文|非中文|中英文|语言') THEN '中外文边界'
    WHEN regexp_matches(reason, 'R18G|血腥|猎奇|肢解|内脏|重口') THEN 'R18G边界' ELSE '其他待复核' END END AS subcategory FROM reasons)"""


def _special(spark: SparkSession, sf_dir: str, parents: DataFrame | None = None) -> DataFrame:
    reasons = ["角色16岁", "英文内容", "含血腥描写", "伪娘角色", "正文加密", "十七岁学生", "116岁精灵", "语言混杂", "其他"]
    r = (parents if parents is not None else _with_parent(spark, sf_dir)).withColumn("reason", F.element_at(F.array(*map(F.lit, reasons)), (F.col("ordinal") % 9 + 1).cast("int")))
    return r.withColumn("subcategory", grouping.special_subcategory(F.col("parent_category"), F.col("category"), F.col("reason")))


@query(SPECIAL + " SELECT relative_path, parent_category, reason, subcategory FROM special")
def special_subcategory(spark, sf_dir):
    return _special(spark, sf_dir).select("relative_path", "parent_category", "reason", "subcategory")


@query("""SELECT p_partkey, CASE WHEN regexp_full_match(k, '(genshin|green|原神)(同人)?') THEN 'x' ELSE k END AS alias_key FROM (SELECT p_partkey, regexp_replace(lower(p_name), '[\\s·・—_\\-:：,，.。''"“”‘’()（）\\[\\]【】]', '', 'g') AS k FROM part)""".replace("\\\\", "\\"))
def alias_normalize(spark, sf_dir):
    key = T.alias_key("p_name")
    return table(spark, sf_dir, "part").select("p_partkey", F.when(key.rlike("^(?:genshin|green|原神)(?:同人)?$"), "x").otherwise(key).alias("alias_key"))


@query(
    """SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN '原神' WHEN 1 THEN '其他' WHEN 2 THEN 'Fate系列' WHEN 3 THEN '某' WHEN 4 THEN NULL WHEN 5 THEN '东方Project' ELSE p_name END AS subcategory FROM part"""
)
def subcategory_normalize(spark, sf_dir):
    names = F.array(*map(F.lit, ["Genshin Impact", "未知作品", "FATE 同人", "某作品同人", "CON", "touhou"]))
    value = F.when(F.col("p_partkey") % 7 == 6, F.col("p_name")).otherwise(F.get(names, (F.col("p_partkey") % 7).cast("int")))
    return table(spark, sf_dir, "part").select("p_partkey", grouping.normal_subcategory(F.lit(grouping.FANWORK), value).alias("subcategory"))


@query(RECORDS + " SELECT relative_path, sha256(lang || chr(0) || card_sha256) AS group_id, sha256('fanwork-source' || chr(0) || creator) AS source_group_id FROM records")
def group_id(spark, sf_dir):
    return file_records(spark, sf_dir).select("relative_path", grouping.group_id(F.col("lang"), F.col("card_sha256")).alias("group_id"), grouping.source_group_id(F.col("creator")).alias("source_group_id"))


RESOLVED = SPECIAL + """, resolved AS (
  SELECT sha256(parent_category || chr(0) || card_sha256) AS group_id, parent_category,
    CASE WHEN count(DISTINCT subcategory) > 1 THEN CASE parent_category WHEN '排除' THEN '其他排除原因' WHEN '未分类' THEN '其他待复核' ELSE '其他' END ELSE min(subcategory) END AS subcategory,
    CASE WHEN count(DISTINCT subcategory) > 1 THEN true ELSE min(subcategory) = '其他' END AS used_fallback
  FROM special WHERE subcategory IS NOT NULL GROUP BY card_sha256, parent_category)"""


def _resolved(spark: SparkSession, sf_dir: str, parents: DataFrame | None = None) -> DataFrame:
    rows = _special(spark, sf_dir, parents).filter("subcategory is not null").withColumn("group_id", grouping.group_id(F.col("parent_category"), F.col("card_sha256")))
    return grouping.resolve_groups(rows)


@query(RESOLVED + " SELECT * FROM resolved")
def deterministic_group_conflict(spark, sf_dir):
    return _resolved(spark, sf_dir)


@query(
    RESOLVED
    + """, selected AS (SELECT parent_category FROM parents WHERE parent_category IN ('同人', '排除', '未分类', '标准外') GROUP BY 1 HAVING count(*) > 50)
SELECT relative_path, p.parent_category, s.parent_category IS NOT NULL AS selected_for_refinement, CASE WHEN s.parent_category IS NOT NULL THEN coalesce(g.subcategory, '其他') END AS subcategory,
  CASE WHEN s.parent_category IS NULL THEN CASE WHEN p.parent_category IN ('同人', '排除', '未分类', '标准外') THEN 'threshold_not_triggered' ELSE 'scope_not_selected' END WHEN g.subcategory IS NULL THEN 'fallback' WHEN p.parent_category = '同人' THEN 'model' WHEN p.parent_category = '标准外' THEN 'original_category' ELSE 'reason_rule' END AS refinement_source
FROM parents p LEFT JOIN selected s ON s.parent_category = p.parent_category LEFT JOIN resolved g ON g.group_id = sha256(p.parent_category || chr(0) || p.card_sha256)"""
)
def refinement(spark, sf_dir):
    parents = _with_parent(spark, sf_dir)
    rows = parents.withColumn("group_id", grouping.group_id(F.col("parent_category"), F.col("card_sha256")))
    return grouping.refine(rows, grouping.selected_parents(rows, threshold=50), _resolved(spark, sf_dir, parents)).select("relative_path", "parent_category", "selected_for_refinement", "subcategory", "refinement_source")


@query("SELECT p_type, p_brand, count(*) AS files FROM part GROUP BY p_type, p_brand")
def leaf_counts(spark, sf_dir):
    return grouping.leaf_counts(table(spark, sf_dir, "part"), "p_type", "p_brand")


# --- Merging: suppliers by nation are directories, regions are media.


def _directories(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    files = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return merging.directory_stats(files, "n_name", "r_name")


STATS = "WITH stats AS (SELECT n_name AS current_directory, count(*) AS file_count, list_sort(list(DISTINCT r_name)) AS source_categories FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name)"


@query(STATS + " SELECT current_directory, file_count, array_to_string(source_categories, ',') AS source_categories FROM stats")
def directory_stats(spark, sf_dir):
    return _directories(spark, sf_dir).withColumn("source_categories", F.array_join("source_categories", ","))


_MEDIA = {"ASIA": "A works", "EUROPE": "E works"}


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.candidates(_directories(spark, sf_dir), ("china", "japan"), "FRANCE", _MEDIA, {"unitedstates": "United States!"})


CANDIDATES = STATS + r""", named AS (
  SELECT *, regexp_replace(lower(current_directory), '[\s·・—–_\-:：,，.。''"“”‘’()（）\[\]【】!！?？]', '', 'g') AS k FROM stats
), canon AS (
  SELECT *, CASE WHEN k = 'unitedstates' THEN 'United States!' ELSE current_directory END AS canonical FROM named
), grouped AS (
  SELECT *, CASE WHEN k = 'unitedstates' THEN 'United States!' ELSE first_value(canonical) OVER (PARTITION BY k ORDER BY file_count DESC, length(canonical), canonical) END AS canonical_name,
    (sum(file_count) OVER w)::BIGINT AS total, count(*) OVER w AS members, max(current_directory = 'FRANCE') OVER w AS has_other, source_categories[1] AS source_category FROM canon WINDOW w AS (PARTITION BY k)
), recommended AS (
  SELECT *, CASE WHEN k IN ('china', 'japan') THEN '共享世界观归并' WHEN has_other THEN '兜底目录改名' WHEN total <= 5 THEN '长尾归档' WHEN total < 10 THEN '门槛待审核' WHEN members > 1 OR current_directory <> canonical_name THEN '同名变体归并' ELSE '保留独立目录' END AS recommendation FROM grouped
), targeted AS (
  SELECT *, CASE recommendation WHEN '共享世界观归并' THEN '型月世界' WHEN '兜底目录改名' THEN '待确认原作' WHEN '长尾归档' THEN CASE source_category WHEN 'ASIA' THEN 'A works' WHEN 'EUROPE' THEN 'E works' ELSE '待确认原作' END ELSE canonical_name END AS suggested_target FROM recommended
), candidates AS (
  SELECT current_directory, canonical_name, suggested_target, file_count, total AS canonical_group_file_count, source_category, recommendation, (sum(file_count) OVER (PARTITION BY suggested_target))::BIGINT AS suggested_target_file_count FROM targeted
)"""


@query(CANDIDATES + " SELECT *, CASE recommendation WHEN '共享世界观归并' THEN 'shared' WHEN '兜底目录改名' THEN 'the' WHEN '同名变体归并' THEN 'equal' ELSE canonical_group_file_count::VARCHAR END AS merge_basis FROM candidates")
def merge_candidates(spark, sf_dir):
    """merge_basis by its first word, or by the count that it begins with."""
    return _candidates(spark, sf_dir).withColumn("merge_basis", F.split("merge_basis", "[ :]")[0])


@query("SELECT p_name AS current_directory, first_value(p_name) OVER (PARTITION BY lower(regexp_replace(p_name, '\\s', '', 'g')) ORDER BY n DESC, length(p_name), p_name) AS canonical_name, (sum(n) OVER (PARTITION BY lower(regexp_replace(p_name, '\\s', '', 'g'))))::BIGINT AS canonical_group_file_count FROM (SELECT p_name, count(*) AS n FROM part GROUP BY p_name)".replace("\\\\", "\\"))
def variant_groups(spark, sf_dir):
    rows = table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("current_directory")).agg(F.count(F.lit(1)).alias("file_count")).withColumn("source_categories", F.array().cast("array<string>"))
    return merging.candidates(rows).select("current_directory", "canonical_name", "canonical_group_file_count")


_OVERRIDES = [("CANADA", "North"), ("BRAZIL", "South")]


@query(CANDIDATES + " SELECT current_directory, CASE current_directory WHEN 'CANADA' THEN 'North' WHEN 'BRAZIL' THEN 'South' ELSE CASE WHEN recommendation = '门槛待审核' THEN '待确认原作' ELSE suggested_target END END AS approved_target, CASE WHEN current_directory IN ('CANADA', 'BRAZIL') THEN 'manual_override' WHEN recommendation = '门槛待审核' THEN 'minimum_policy' ELSE 'candidate' END AS approval_source FROM candidates")
def approved_targets(spark, sf_dir):
    overrides = spark.createDataFrame(_OVERRIDES, "current_directory string, approved_target string")
    return merging.approved_targets(_candidates(spark, sf_dir), overrides, merging.BELOW, merging.WAITING).select("current_directory", "approved_target", "approval_source")


@query(CANDIDATES + " SELECT count(DISTINCT canonical_name) AS canonical_group_count, count(*) AS current_directory_count, coalesce(sum(file_count), 0)::BIGINT AS file_count FROM candidates WHERE recommendation = '门槛待审核'")
def policy_totals(spark, sf_dir):
    return merging.policy_totals(_candidates(spark, sf_dir), merging.BELOW)


@query("SELECT p_partkey FROM part WHERE p_size > 10 EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45")
def set_difference(spark, sf_dir):
    parts = table(spark, sf_dir, "part").filter("p_size > 10").select("p_partkey").distinct()
    return parts.join(table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_anti")


# --- Plans.

DESTINATIONS = RECORDS + """, ranked AS (
  SELECT *, creator || '/' || file_name AS wanted_path, row_number() OVER (PARTITION BY lower(creator || '/' || file_name) ORDER BY ordinal) AS r FROM records
), numbered AS (
  SELECT *, sum((r > 1)::INT) OVER (PARTITION BY lower(wanted_path), substr(sha256, 1, 12) ORDER BY ordinal ROWS UNBOUNDED PRECEDING) AS n FROM ranked
)"""


@query(DESTINATIONS + " SELECT ordinal, CASE WHEN r = 1 THEN wanted_path ELSE replace(wanted_path, '.json', '') || '__' || substr(sha256, 1, 12) || CASE WHEN n > 1 THEN '-' || n ELSE '' END || '.json' END AS destination_path FROM numbered")
def destination_assign(spark, sf_dir):
    rows = file_records(spark, sf_dir).select("ordinal", "sha256", F.concat("creator", F.lit("/"), "file_name").alias("wanted_path"))
    return naming.assign_destinations(rows).select("ordinal", "destination_path")


@query(
    RECORDS
    + """SELECT ordinal, CASE WHEN row_number() OVER (PARTITION BY file_name, sha256 ORDER BY ordinal) > 1 THEN 'skipped_identical' WHEN min(ordinal) OVER (PARTITION BY file_name, sha256) = min(ordinal) OVER (PARTITION BY file_name) THEN 'copied' ELSE 'copied_version' END AS status,
  CASE WHEN min(ordinal) OVER (PARTITION BY file_name, sha256) = min(ordinal) OVER (PARTITION BY file_name) THEN file_name ELSE replace(file_name, '.json', '') || '__' || substr(sha256, 1, 12) || '.json' END AS target_name FROM records"""
)
def collect_versions(spark, sf_dir):
    rows = file_records(spark, sf_dir).select("ordinal", "sha256", "file_name")
    return naming.collect_versions(rows).select("ordinal", "status", "target_name")


@query("SELECT doc_id AS ordinal, (row_number() OVER (ORDER BY doc_id) - 1) // 30 AS batch FROM documents")
def batching(spark, sf_dir):
    return decisions.batches(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ordinal")), 30)


@query("SELECT count(*) FILTER (event_type IN ('purchase', 'error')) AS requests, coalesce(sum(value) FILTER (event_type IN ('purchase', 'error') AND value > 0), 0) AS bytes FROM events")
def usage_summary(spark, sf_dir):
    """Purchases stand for reservations, errors for completions of an old log."""
    e = table(spark, sf_dir, "events")
    log = e.select(F.when(F.col("event_type") == "purchase", "request_reserved").when(F.col("event_type") != "error", "other").alias("event"), F.when(F.col("event_type") == "error", "error").alias("outcome"), F.col("value").alias("request_bytes"))
    return audit.usage_summary(log).withColumn("bytes", F.col("bytes"))


@query(RECORDS + " SELECT file_name AS relative_path, count(*) AS n FROM records GROUP BY 1 HAVING count(*) > 1")
def plan_guard_paths(spark, sf_dir):
    return destinations.repeated_paths(file_records(spark, sf_dir).select(F.col("file_name").alias("relative_path")))


@query(RECORDS + " SELECT ordinal FROM records WHERE NOT regexp_full_match(CASE WHEN ordinal % 7 = 0 THEN substr(sha256, 2) ELSE sha256 END, '[0-9a-fA-F]{64}')")
def plan_guard_hash(spark, sf_dir):
    return destinations.bad_hashes(file_records(spark, sf_dir).select("ordinal", F.when(F.col("ordinal") % 7 == 0, F.substring("sha256", 2, 64)).otherwise(F.col("sha256")).alias("sha256"))).select("ordinal")


@query(DECISIONS + " SELECT relative_path FROM classified WHERE NOT ((model_decision = 'classify' AND coalesce(category, '') <> '' AND NOT needs_review) OR (model_decision = 'exclude' AND needs_review) OR (model_decision = 'review' AND coalesce(category, '') = '' AND needs_review)) OR ordinal % 11 = 0")
def plan_guard_decisions(spark, sf_dir):
    """Rows spoiled on purpose: every eleventh has its flag removed."""
    c = classified(spark, sf_dir).withColumn("needs_review", F.when(F.col("ordinal") % 11 != 0, F.col("needs_review")))
    return destinations.inconsistent_decisions(c).select("relative_path")


@query("SELECT lower(replace(replace(c, ':', '_'), '?', '_')) AS name, count(*) AS owners FROM (SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN p_brand || ':' ELSE upper(p_brand) || '?' END AS c FROM part) GROUP BY 1 HAVING count(*) > 1")
def name_collision_guard(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 2 == 0, F.concat("p_brand", F.lit(":"))).otherwise(F.concat(F.upper("p_brand"), F.lit("?"))).alias("category"))
    return destinations.colliding_categories(names)


_TAGS = "list_value(lang, source, 'tag' || (doc_id % 3))"


def _updated(replace: bool):
    """(tags, number added) of a card with the tags given after an update."""

    def update(own: pd.Series, additions: pd.Series) -> pd.DataFrame:
        rows = []
        for tags, more in zip(own, additions, strict=True):
            card = {"data": {"tags": list(tags)}}
            added = cards.update_tags(card, 2, list(more), replace)
            rows.append((",".join(card["data"]["tags"]), len(added)))
        return pd.DataFrame(rows, columns=["tags", "added"])

    return F.pandas_udf(update, "tags string, added long")


@query(f"SELECT doc_id, array_to_string(list_concat({_TAGS}, list_filter(list_value('en', 'tag1', 'new'), lambda t: NOT list_contains({_TAGS}, t))), ',') AS tags, len(list_filter(list_value('en', 'tag1', 'new'), lambda t: NOT list_contains({_TAGS}, t))) AS added FROM documents")
def tags_append(spark, sf_dir):
    """Original tags stay; of the additions those not yet there follow."""
    own = F.array("lang", "source", F.concat(F.lit("tag"), F.col("doc_id") % 3))
    return table(spark, sf_dir, "documents").select("doc_id", _updated(False)(own, F.array(*map(F.lit, ["en", "tag1", " new", "new"]))).alias("u")).select("doc_id", "u.tags", "u.added")


@query("SELECT doc_id, lang || ',同人' || CASE WHEN doc_id % 2 = 0 THEN ',' || source ELSE '' END AS tags, 2 + (doc_id % 2 = 0)::BIGINT AS added FROM documents")
def tags_replace(spark, sf_dir):
    """Old tags go; the language, the parent and, for fanworks of even documents, the source are the new ones."""
    wanted = F.concat(F.array("lang"), stages.tags_of("parent", "target"))
    rows = table(spark, sf_dir, "documents").withColumns({"parent": F.lit(grouping.FANWORK), "target": F.when(F.col("doc_id") % 2 == 0, F.col("source"))})
    return rows.select("doc_id", _updated(True)(F.array(F.lit("old"), F.col("lang")), wanted).alias("u")).select("doc_id", "u.tags", "u.added")


@query("WITH n AS (SELECT (lang <> 'en')::INT + (source <> 'src1')::INT AS n, doc_id % 10 = 7 AS same, doc_id % 10 = 3 AS bad FROM documents) SELECT coalesce(sum(n) FILTER (NOT same AND NOT bad), 0)::BIGINT AS added, count(*) FILTER (n = 0 AND NOT same AND NOT bad) AS already_tagged, count(*) FILTER (same) AS unchanged, count(*) FILTER (bad) AS invalid FROM n")
def tag_totals(spark, sf_dir):
    """A plan's totals: documents ending in 3 are invalid, those ending in 7 are copied as they are."""
    same, bad = F.col("doc_id") % 10 == 7, F.col("doc_id") % 10 == 3
    added = F.array_except(F.array(F.lit("en"), F.lit("src1")), F.array("lang", "source"))
    rows = table(spark, sf_dir, "documents").select(F.when(bad, "source_invalid").otherwise("ready").alias("status"), same.alias("copy_unchanged"), F.when(same, F.array().cast("array<string>")).when(~bad, added).alias("tags_actually_added"))
    return stages.tag_totals(rows)


@query("SELECT CASE o_orderstatus WHEN 'F' THEN 'copied' WHEN 'O' THEN 'moved' ELSE 'failed' END AS result, count(*) AS files FROM orders GROUP BY 1")
def execution_counts(spark, sf_dir):
    result = F.when(F.col("o_orderstatus") == "F", "copied").when(F.col("o_orderstatus") == "O", "moved").otherwise("failed")
    return table(spark, sf_dir, "orders").groupBy(result.alias("result")).agg(F.count(F.lit(1)).alias("files"))


@query(r"""SELECT page_id, link FROM (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href="(/[^"#]+)"', 1))) AS link FROM pages) WHERE link NOT IN (SELECT '/' || r_name FROM region) AND link NOT IN ('/The', '/the', '/of')""")
def link_check(spark, sf_dir):
    """Relative links of pages whose target is not among the known ones."""
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit('href="(/[^"#]+)"'), F.lit(1)))).alias("link"))
    known = table(spark, sf_dir, "region").select(F.concat(F.lit("/"), "r_name").alias("path")).unionByName(spark.createDataFrame([("/The",), ("/the",), ("/of",)], "path string"))
    return audit.broken_links(links.withColumn("resolved", F.col("link")), known).select("page_id", "link")


# --- Card files and lines, made from the tables and read back.


def _card_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = file_records(spark, sf_dir)
    card = F.struct(F.lit("chara_card_v2").alias("spec"), F.struct("name", F.col("text").alias("description"), F.array("lang", "creator").alias("tags"), F.col("ordinal").alias("create_date")).alias("data"))
    return r.select("relative_path", "ordinal", F.to_json(card).alias("json"))


def _as_png(payload: str) -> bytes:
    body = b"chara\0" + base64.b64encode(payload.encode())
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return cards.SIGNATURE + chunk(b"IHDR", bytes(13)) + chunk(b"tEXt", body) + chunk(b"IEND", b"")


@query(RECORDS + " SELECT relative_path, CASE WHEN ordinal % 5 = 0 THEN 'corrupt_png' ELSE 'valid' END AS status, CASE WHEN ordinal % 5 <> 0 THEN name END AS name, CASE WHEN ordinal % 5 <> 0 THEN lang || ',' || creator END AS tags, CASE WHEN ordinal % 5 <> 0 THEN sha256(text) END AS description_sha256 FROM records")
def png_decode(spark, sf_dir):
    """Documents as PNG cards, every fifth with a damaged byte, decoded."""

    def decoded(batches):
        for batch in batches:
            rows = []
            for path, ordinal, payload in zip(batch.relative_path, batch.ordinal, batch.json, strict=True):
                data = bytearray(_as_png(payload))
                data[60] ^= ordinal % 5 == 0
                row = cards.decode(path, bytes(data), ".png")
                card = row["card"] or {}
                rows.append((path, row["status"], card.get("name"), ",".join(card["tags"]) if card else None, hashlib.sha256(card["description"].encode()).hexdigest() if card else None))
            yield pd.DataFrame(rows, columns=["relative_path", "status", "name", "tags", "description_sha256"])

    return _card_rows(spark, sf_dir).mapInPandas(decoded, "relative_path string, status string, name string, tags string, description_sha256 string")


@query(RECORDS + " SELECT relative_path, lang || ',' || creator || ',新' AS tags, CASE WHEN lang = 'en' THEN '新' ELSE 'en,新' END AS added FROM records WHERE lang = 'en' UNION ALL SELECT relative_path, lang || ',' || creator || ',en,新', 'en,新' FROM records WHERE lang <> 'en'")
def tag_rewrite(spark, sf_dir):
    """Tags appended to PNG cards, read back from the new bytes."""

    def tagged(batches):
        for batch in batches:
            rows = []
            for path, payload in zip(batch.relative_path, batch.json, strict=True):
                data, added, _ = cards.write_tags(_as_png(payload), ".png", ["en", " 新", "新"])
                rows.append((path, ",".join(cards.decode(path, data, ".png")["card"]["tags"]), ",".join(added)))
            yield pd.DataFrame(rows, columns=["relative_path", "tags", "added"])

    return _card_rows(spark, sf_dir).mapInPandas(tagged, "relative_path string, tags string, added string")


@query("SELECT conv_id, count(*) AS turns, sha256('{\"1\":0,\"10\":0,\"turns\":[' || string_agg('{\"role\":\"' || role || '\",\"turn\":' || turn || '}', ',' ORDER BY turn, role) || ']}') AS card_sha256 FROM conversations GROUP BY conv_id")
def canonical_json_nested(spark, sf_dir):
    """Nested payloads with their keys in another order, and a date that does not count."""

    def hashed(payloads: pd.Series) -> pd.Series:
        return payloads.map(lambda p: cj.content_hash(cj.load(p)))

    turns = F.sort_array(F.collect_list(F.struct("turn", "role")))
    grouped = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.to_json(turns).alias("list"))
    payload = F.concat(F.lit('{"turns":'), "list", F.lit(',"10":0.0,"create_date":"x","1":-0}'))
    return grouped.select("conv_id", "turns", F.pandas_udf(hashed, "string")(payload).alias("card_sha256"))


@query("SELECT p_partkey, p_name AS name, p_brand AS brand FROM part")
def nfkc_normalize(spark, sf_dir):
    """Names in full-width letters come back in plain ones."""
    plain = "".join(map(chr, range(0x21, 0x7F)))
    wide = "".join(chr(ord(c) + 0xFEE0) for c in plain)
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", T.nfkc(F.translate("p_name", plain, wide)).alias("name"), T.nfkc(F.translate("p_brand", plain, wide)).alias("brand"))


@query(RECORDS + " SELECT ordinal, ordinal % 3 = 0 AS repaired, sha256(squeezed || CASE WHEN ordinal % 3 = 0 THEN chr(10) || 'x' ELSE '' END) AS text_sha256 FROM records")
def jsonl_repair(spark, sf_dir):
    """Lines whose strings hold a raw line feed, every third, repaired and parsed."""
    from ledgerloom.sources.jsonl import parse_record

    def parsed(batches):
        for batch in batches:
            rows = []
            for ordinal, payload in zip(batch.ordinal, batch.json, strict=True):
                _, _, text, repaired, _ = parse_record(payload, ordinal, ordinal)
                rows.append((ordinal, repaired, hashlib.sha256(cj.load(text)["text"].encode()).hexdigest()))
            yield pd.DataFrame(rows, columns=["ordinal", "repaired", "text_sha256"])

    r = file_records(spark, sf_dir)
    line = F.to_json(F.struct("relative_path", T.squeeze("text").alias("text")))
    raw = F.when(F.col("ordinal") % 3 == 0, F.concat(F.substring(line, F.lit(1), F.length(line) - 2), F.lit('\nx"}'))).otherwise(line)
    return r.select("ordinal", raw.alias("json")).mapInPandas(parsed, "ordinal long, repaired boolean, text_sha256 string")


@query("SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'BanG Dream!' WHEN 1 THEN '原神' WHEN 2 THEN 'C++' WHEN 3 THEN 'C#' WHEN 4 THEN '系列' ELSE p_name END AS canonical, CASE p_partkey % 6 WHEN 0 THEN 'bangdream' WHEN 1 THEN '原神' WHEN 2 THEN 'c++' WHEN 3 THEN 'c#' WHEN 4 THEN '系列' ELSE lower(replace(p_name, ' ', '')) END AS comparison_key FROM part")
def canonical_names(spark, sf_dir):
    names = F.array(*map(F.lit, ["bang dream！系列", "原神作品系列 同人", "C++", "C#", "系列"]))
    name = F.when(F.col("p_partkey") % 6 == 5, F.col("p_name")).otherwise(F.get(names, (F.col("p_partkey") % 6).cast("int")))
    return table(spark, sf_dir, "part").select("p_partkey", T.canonical_name(name).alias("canonical"), T.comparison_key(name).alias("comparison_key"))


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'a b' WHEN 3 THEN NULL ELSE p_name END AS directory, CASE p_partkey % 5 WHEN 0 THEN 'a_b' WHEN 1 THEN NULL WHEN 2 THEN 'a  b' WHEN 3 THEN 'x' ELSE p_name END AS safe FROM part")
def directory_names(spark, sf_dir):
    names = F.array(*map(F.lit, ["a/b", "con", " a  b ", "x. ."]))
    name = F.when(F.col("p_partkey") % 5 == 4, F.col("p_name")).otherwise(F.get(names, (F.col("p_partkey") % 5).cast("int")))
    return table(spark, sf_dir, "part").select("p_partkey", T.directory_name(name).alias("directory"), T.safe_category(name).alias("safe"))
