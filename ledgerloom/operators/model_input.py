"""What a model sees of a card: fifteen fields of bounded length, once for each content."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import canonical_json as cj
from ledgerloom.functions.text import compact, compact_array

# Characters for each text, and (items, characters) for each list.
TEXTS = {"name": 160, "creator": 120, "description": 1000, "personality": 650, "scenario": 650, "creator_notes": 350, "first_mes": 750, "mes_example": 600, "system_prompt": 400, "post_history_instructions": 400}
LISTS = {"tags": (30, 80), "alternate_greetings": (4, 240), "group_only_greetings": (3, 200)}
BOOK = 700


def flattened(column: str | Column, limit: int) -> Column:
    """The scalars of a JSON column, breadth first; null as empty."""

    def flat(values: pd.Series) -> pd.Series:
        return values.map(lambda v: "" if v is None else cj.flatten(cj.load(v), limit))

    return F.pandas_udf(flat, "string")(column)


def model_inputs(records: DataFrame, card: str = "card", keep: tuple[str, ...] = ()) -> DataFrame:
    """card_sha256 and the fields of the card of each row; the payload's other fields never leave the scan."""
    of = lambda k: F.col(f"{card}.{k}")
    return records.select(F.col("card_sha256").alias("id"), *keep, *(compact(of(k), n).alias(k) for k, n in TEXTS.items()), *(compact_array(of(k), n, m).alias(k) for k, (n, m) in LISTS.items()), flattened(of("character_book"), BOOK).alias("character_book"))


def has_semantic_content() -> Column:
    """Any text that is not empty, or any list that has an item, be it blank."""
    out = F.length("character_book") > 0
    for k in TEXTS:
        out = out | (F.length(k) > 0)
    for k in LISTS:
        out = out | (F.size(k) > 0)
    return out
