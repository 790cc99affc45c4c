"""Text columns: normal form, white space, truncation and directory names.

White space is that of ECMAScript, wider than Java's ``\\s``; truncation counts
code points (the two agree on all text of the basic plane).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space of ECMAScript, the characters that no directory name may hold, and the reserved device names.
SPACE = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
# Runs of it that are not one blank already. A character is first told by [^ -~], as trying the whole class on each is slow.
RUNS = f"[[^ -~]&&{SPACE}]{SPACE}*| {SPACE}+"
FORBIDDEN = r'[<>:"/\\|?*\x{0000}-\x{001F}]'
RESERVED = r"(?i)^(?:con|prn|aux|nul|com[1-9]|lpt[1-9])(?:\.|$)"
NAME_LIMIT = 40
# Punctuation that names are compared without.
ALIAS_PUNCTUATION = r"[\s\x{00A0}\x{3000}\x{FEFF}·・—_\-:：,，.。'\"“”‘’()（）\[\]【】]"
KEY_PUNCTUATION = r"[\s\x{00A0}\x{3000}\x{FEFF}·・—–_\-:：,，.。'\"“”‘’()（）\[\]【】!！?？]"


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nfkc(column: str | Column) -> Column:
    """Normal form NFKC; null stays null. Only text beyond ASCII, which it cannot change, is sent to Python."""
    c = _column(column)

    def normalise(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    return F.coalesce(F.pandas_udf(normalise, "string")(F.when(~c.rlike(r"^[\x00-\x7F]*$"), c)), c)


def trim(column: str | Column) -> Column:
    return F.regexp_replace(_column(column), f"^{SPACE}+|{SPACE}+$", "")


def squeeze(column: str | Column) -> Column:
    """Runs of white space as one space, none at the ends; null as empty."""
    return F.trim(F.regexp_replace(F.coalesce(_column(column), F.lit("")), RUNS, " "))


def compact(column: str | Column, limit: int) -> Column:
    """Squeezed, and cut to ``limit`` characters with an ellipsis. Where the head of a text is over the limit once squeezed, the rest cannot change the result; else the whole text is squeezed."""
    # Each branch refers to what it squeezes once, so that nothing is squeezed twice.
    c, size = _column(column), limit + limit // 4 + 16
    over = F.try_element_at(F.regexp_extract_all(squeeze(F.substring(c, 1, size)), F.lit(f"(?s)\\A.{{{limit}}}(?=.)"), F.lit(0)), F.lit(1))
    whole = F.regexp_replace(squeeze(c), f"(?s)\\A(.{{{limit}}}).+", "$1…")
    return F.when(F.length(c) > size, F.coalesce(F.concat(over, F.lit("…")), whole)).otherwise(whole)


def compact_array(column: str | Column, count: int, limit: int) -> Column:
    """The first ``count`` items, each compacted; null as an empty array."""
    return F.transform(F.slice(F.coalesce(_column(column), F.array().cast("array<string>")), 1, count), lambda x: compact(x, limit))


def identity(column: str | Column) -> Column:
    """The form in which names and creators are compared; null as empty."""
    return F.lower(trim(nfkc(F.coalesce(_column(column), F.lit("")))))


def _name_or_null(name: Column, limit: int) -> Column:
    good = (name != "") & (F.length(name) <= limit) & ~name.isin(".", "..") & ~name.rlike(FORBIDDEN) & ~name.rlike(r"[. ]$") & ~name.rlike(RESERVED)
    return F.when(good, name)


def directory_name(column: str | Column, limit: int = NAME_LIMIT) -> Column:
    """A valid directory name in normal form, or null."""
    return _name_or_null(squeeze(nfkc(column)), limit)


def open_category(column: str | Column) -> Column:
    """A category that a first pass may invent, or null: as a directory name, but inner white space stays and a leading __ is refused."""
    name = trim(nfkc(F.coalesce(_column(column), F.lit(""))))
    return F.when(~name.startswith("__"), _name_or_null(name, NAME_LIMIT))


def closed_category(column: str | Column, allowed: Iterable[str]) -> Column:
    """A category of a closed list, or null."""
    name = trim(nfkc(_column(column)))
    return F.when(name.isin(list(allowed)), name)


def safe_category(column: str | Column) -> Column:
    """A category as a directory: forbidden characters become _, dots and spaces at the end go; null where nothing valid remains."""
    name = trim(F.regexp_replace(F.regexp_replace(nfkc(F.coalesce(_column(column), F.lit(""))), FORBIDDEN, "_"), r"[. ]+$", ""))
    return F.when((name != "") & ~name.isin(".", "..") & ~name.rlike(RESERVED), name)


def alias_key(column: str | Column) -> Column:
    return F.regexp_replace(F.lower(nfkc(_column(column))), ALIAS_PUNCTUATION, "")


def without_suffix(column: str | Column) -> Column:
    """Without the generic suffixes at the end, as often as they stand there, unless nothing would remain."""
    name = squeeze(nfkc(_column(column)))
    bare = F.trim(F.regexp_replace(name, f"(?:{SPACE}*(?:作品)?(?:系列|同人))+$", ""))
    return F.when(bare != "", bare).otherwise(name)


def comparison_key(column: str | Column) -> Column:
    """Names with equal keys are variants of one name; + and # count."""
    return F.regexp_replace(F.lower(without_suffix(column)), KEY_PUNCTUATION, "")


def canonical_name(column: str | Column, preferred: dict[str, str] | None = None) -> Column:
    """Without suffixes, in the preferred spelling if there is one."""
    bare = without_suffix(column)
    pairs = [F.lit(x) for k, v in (PREFERRED_NAMES if preferred is None else preferred).items() for x in (k, v)]
    return F.coalesce(F.create_map(*pairs)[comparison_key(bare)], bare) if pairs else bare


# Spellings by comparison key.
PREFERRED_NAMES = {"bangdream": "BanG Dream!"}
