"""Level-1 parents, the strict threshold, and second-level groups by rule."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import alias_key, directory_name, nfkc, trim

# Directory names, threshold and source media.
FANWORK, EXCLUDED, UNRESOLVED, NONSTANDARD, OTHER = "同人", "排除", "未分类", "标准外", "其他"
THRESHOLD = 100
MEDIA = ("游戏", "动画与漫画", "小说", "影视", "虚拟主播与网络人物", "其他")
# Rules in their order, the first that matches counts; \b is written out, as Java's takes Han characters for words.
_AGE = r"(?:^|[^A-Za-z0-9_])(?:[0-9]|1[0-7])\s*岁|(?:十[一二三四五六七]?|[一二三四五六七八九])岁"
EXCLUDED_RULES = [
    ("外文内容", "英文|英语|日文|日语|外文|外语|非中文|中文内容不足|长期阅读"),
    ("R18G与血腥猎奇", "R18G|血腥|猎奇|肢解|断肢|内脏|虐杀|食人|尸体|奸尸|血肉|重口|排泄物|身体破坏"),
    ("未成年或幼态内容", f"未成年|幼女|幼态|儿童|孩童|婴幼儿|萝莉|正太|小学|初中|高中|国中|{_AGE}"),
    ("核心性别属性", "男娘|扶她|伪娘|女装男性|性转|雌雄同体"),
]
EXCLUDED_OTHER = "其他排除原因"
UNRESOLVED_RULES = [
    ("核心性别属性", "男娘|扶她|伪娘|女装男性|性转|雌雄同体|男性灵魂|女性身体"),
    ("信息不足或加密", "加密|信息不足|内容不足|无法读取|裁剪不足|正文"),
    ("年龄边界", f"年龄|未成年|幼态|视觉年龄|{_AGE}"),
    ("中外文边界", "英文|英语|外文|非中文|中英文|语言"),
    ("R18G边界", "R18G|血腥|猎奇|肢解|内脏|重口"),
]
UNRESOLVED_OTHER = "其他待复核"
# Names that mean "other", and aliases of works by key.
OTHER_NAMES = ("其他", "其他同人", "其他作品", "未知作品", "原创或未知")
ALIASES = [
    ("原神|genshin(?:impact)?", "原神"),
    ("绝区零|zenlesszonezero|zzz", "绝区零"),
    ("崩坏星穹铁道|星穹铁道|honkaistarrail|hsr", "崩坏星穹铁道"),
    ("崩坏3|崩坏三|honkaiimpact3rd?", "崩坏3"),
    ("蔚蓝档案|碧蓝档案|bluearchive|ba", "蔚蓝档案"),
    ("明日方舟|arknights", "明日方舟"),
    ("碧蓝航线|azurlane", "碧蓝航线"),
    ("少女前线|girlsfrontline", "少女前线"),
    ("战双帕弥什|战双", "战双帕弥什"),
    ("鸣潮|wutheringwaves", "鸣潮"),
    ("宝可梦|口袋妖怪|精灵宝可梦|pokemon", "宝可梦"),
    ("火影忍者|火影|naruto", "火影忍者"),
    ("海贼王|航海王|onepiece", "海贼王"),
    ("英雄联盟|leagueoflegends|lol", "英雄联盟"),
    ("最终幻想|finalfantasy|ff", "最终幻想"),
    ("东方project|东方|touhou", "东方Project"),
    ("fate|fate系列|命运系列", "Fate系列"),
]


def cascade(text: Column, rules: list[tuple[str, str]], otherwise: str) -> Column:
    """The label of the first pattern found."""
    out = F.lit(otherwise)
    for label, pattern in reversed(rules):
        out = F.when(text.rlike(pattern), F.lit(label)).otherwise(out)
    return out


def parent_category(decision: Column, category: Column, allowed: Iterable[str] | None) -> Column:
    """Level-1 directory; with ``allowed`` None nothing is nonstandard. An invalid state fails the query."""
    standard = F.lit(True) if allowed is None else category.isin(list(allowed))
    return (
        F.when(decision == "exclude", F.lit(EXCLUDED))
        .when(decision == "review", F.lit(UNRESOLVED))
        .when((decision == "classify") & (F.coalesce(category, F.lit("")) != ""), F.when(standard, trim(category)).otherwise(F.lit(NONSTANDARD)))
        .otherwise(F.raise_error(F.lit("invalid classification state")).cast("string"))
    )


def refinement_mode(parent: Column) -> Column:
    return F.when(parent == FANWORK, F.lit("model")).when(parent.isin(EXCLUDED, UNRESOLVED, NONSTANDARD), F.lit("deterministic"))


def group_id(parent: Column, card_sha256: Column) -> Column:
    return F.sha2(F.concat(parent, F.lit("\0"), card_sha256), 256)


def source_group_id(name: Column) -> Column:
    return F.sha2(F.concat(F.lit("fanwork-source\0"), trim(nfkc(F.coalesce(name, F.lit(""))))), 256)


def source_medium(value: Column) -> Column:
    name = trim(nfkc(value))
    return F.when(name.isin(*MEDIA), name)


#: The columns that hold reasons, those of later reviews first.
REASONS = ("recheck_2_reason", "third_reason", "recheck_reason", "reason")


def reason_text(*reasons: Column) -> Column:
    return trim(nfkc(F.coalesce(*reasons, F.lit(""))))


def special_subcategory(parent: Column, category: Column, reason: Column) -> Column:
    return (
        F.when(parent == NONSTANDARD, F.coalesce(directory_name(category), F.lit(OTHER)))
        .when(parent == EXCLUDED, cascade(reason, EXCLUDED_RULES, EXCLUDED_OTHER))
        .when(parent == UNRESOLVED, cascade(reason, UNRESOLVED_RULES, UNRESOLVED_OTHER))
    )


def normal_subcategory(parent: Column, value: Column) -> Column:
    """A work's directory: alias to canonical name, or without the fanwork suffix; null for other parents and invalid names."""
    name = directory_name(value)
    key = alias_key(name)
    known = F.lit(None).cast("string")
    for pattern, label in reversed(ALIASES):
        known = F.when(key.rlike(f"(?i)^(?:{pattern})(?:同人)?$"), F.lit(label)).otherwise(known)
    bare = trim(F.regexp_replace(name, "(?:作品)?同人$", ""))
    return F.when((parent == FANWORK) & name.isNotNull(), F.when(key.isin(*OTHER_NAMES), F.lit(OTHER)).otherwise(F.coalesce(known, F.when(bare != "", bare), F.lit(OTHER))))


def selected_parents(rows: DataFrame, parent: str = "parent_category", threshold: int = THRESHOLD) -> DataFrame:
    """parent and files of the refinable parents with more than ``threshold`` files."""
    return rows.groupBy(parent).agg(F.count(F.lit(1)).alias("files")).filter((F.col("files") > threshold) & refinement_mode(F.col(parent)).isNotNull())


def resolve_groups(rows: DataFrame) -> DataFrame:
    """group_id, parent_category, subcategory, used_fallback: rows of a group that disagree on the subcategory fall back to the parent's label."""
    agreed = rows.groupBy("group_id", "parent_category").agg(F.min("subcategory").alias("low"), F.max("subcategory").alias("high"))
    label = F.when(F.col("parent_category") == EXCLUDED, F.lit(EXCLUDED_OTHER)).when(F.col("parent_category") == UNRESOLVED, F.lit(UNRESOLVED_OTHER)).otherwise(F.lit(OTHER))
    one = F.col("low") == F.col("high")
    return agreed.select("group_id", "parent_category", F.when(one, F.col("low")).otherwise(label).alias("subcategory"), F.when(one, F.col("low") == OTHER).otherwise(F.lit(True)).alias("used_fallback"))


def refine(rows: DataFrame, selected: DataFrame, groups: DataFrame) -> DataFrame:
    """Every row with subcategory and refinement_source: that of its group where its parent is selected (few rows, broadcast)."""
    names = F.broadcast(selected.select(F.col("parent_category"), F.lit(True).alias("selected_for_refinement")))
    g = groups.select("group_id", F.col("subcategory").alias("__sub"), F.col("used_fallback").alias("__fell"))
    joined = rows.join(names, "parent_category", "left").join(g, "group_id", "left").withColumn("selected_for_refinement", F.coalesce("selected_for_refinement", F.lit(False)))
    mode = refinement_mode(F.col("parent_category"))
    chosen = F.col("selected_for_refinement")
    return joined.select(
        *rows.columns,
        "selected_for_refinement",
        F.when(chosen, F.coalesce("__sub", F.lit(OTHER))).alias("subcategory"),
        F.when(~chosen, F.when(mode.isNull(), "scope_not_selected").otherwise("threshold_not_triggered")).when(F.col("__sub").isNull(), "fallback").when(mode == "model", "model").when(F.col("parent_category") == NONSTANDARD, "original_category").otherwise("reason_rule").alias("refinement_source"),
        (chosen & F.coalesce("__fell", F.lit(True))).alias("used_fallback"),
    )


def leaf_counts(rows: DataFrame, *levels: str) -> DataFrame:
    return rows.groupBy(*levels).agg(F.count(F.lit(1)).alias("files")).orderBy(F.desc("files"), *levels)
