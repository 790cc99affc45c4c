"""JSON in the canonical form that content hashes are taken of: ECMAScript's rules for numbers, key order and escapes."""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections import deque

# Keys that do not count as content.
IGNORED_KEYS = frozenset({"creation_date", "modification_date", "create_date"})
_INDEX = re.compile(r"0|[1-9][0-9]{0,9}")


def number(x: float | int) -> str:
    """As ECMAScript prints a double."""
    try:
        x = float(x)
    except OverflowError:
        return "null"
    if not math.isfinite(x):
        return "null"
    if x == 0:
        return "0"
    sign, digits, exponent = "-" if x < 0 else "", *_shortest(abs(x))
    n = exponent + len(digits)
    if len(digits) <= n <= 21:
        return sign + digits + "0" * (n - len(digits))
    if 0 < n <= 21:
        return f"{sign}{digits[:n]}.{digits[n:]}"
    if -6 < n <= 0:
        return f"{sign}0.{'0' * -n}{digits}"
    mantissa = digits if len(digits) == 1 else f"{digits[0]}.{digits[1:]}"
    return f"{sign}{mantissa}e{'+' if n > 0 else '-'}{abs(n - 1)}"


def _shortest(x: float) -> tuple[str, int]:
    """Digits without zeros at the ends, and the power of ten of the last one."""
    mantissa, _, exponent = f"{x!r}".partition("e")
    whole, _, fraction = mantissa.partition(".")
    digits = (whole + fraction).lstrip("0")
    power = int(exponent or 0) - len(fraction)
    bare = digits.rstrip("0")
    return bare, power + len(digits) - len(bare)


def text(s: str) -> str:
    """Quoted; only quotes, backslashes, controls and lone surrogates are escaped."""
    quoted = json.dumps(s, ensure_ascii=False)
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", quoted)


def _keys(value: dict, sort: bool) -> list[str]:
    """Array indices ascending, then the others by UTF-16 code units, or as they came."""
    indices = [k for k in value if _INDEX.fullmatch(k) and int(k) < 2**32 - 1]
    others = [k for k in value if not (_INDEX.fullmatch(k) and int(k) < 2**32 - 1)]
    return sorted(indices, key=int) + (sorted(others, key=lambda k: k.encode("utf-16-be", "surrogatepass")) if sort else others)


def dump(value: object, sort: bool = False, ignored: frozenset[str] = frozenset(), indent: int = 0, _level: int = 0) -> str:
    if value is None or isinstance(value, bool):
        return {None: "null", True: "true", False: "false"}[value]
    if isinstance(value, int | float):
        return number(value)
    if isinstance(value, str):
        return text(value)
    deeper = lambda v: dump(v, sort, ignored, indent, _level + 1)
    if isinstance(value, dict):
        items = [f"{text(k)}:{' ' * bool(indent)}{deeper(value[k])}" for k in _keys(value, sort) if k not in ignored]
        marks = "{}"
    else:
        items, marks = [deeper(v) for v in value], "[]"
    if not items or not indent:
        return marks[0] + ",".join(items) + marks[1]
    gap = "\n" + " " * indent * (_level + 1)
    return marks[0] + gap + ("," + gap).join(items) + gap[: -indent or None] + marks[1]


def canonical(value: object) -> str:
    return dump(value, sort=True, ignored=IGNORED_KEYS)


def content_hash(value: object) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


def load(source: str) -> object:
    """Strict JSON as ECMAScript reads it: the last of equal keys counts, NaN and infinities are refused."""

    def refuse(name: str) -> None:
        raise ValueError(f"{name} is not JSON")

    return json.loads(source, parse_constant=refuse)


#: Items of an array and of an object that flatten() looks at.
MOST_ITEMS, MOST_VALUES = 30, 50


def flatten(value: object, limit: int) -> str:
    """The scalars of a nested value, breadth first, squeezed and joined until ``limit`` characters are there."""
    found: list[str] = []
    pending, length = deque([value]), 0
    while pending and length < limit:
        current = pending.popleft()
        if isinstance(current, dict):
            pending.extend([current[k] for k in _keys(current, sort=False)][:MOST_VALUES])
        elif isinstance(current, list):
            pending.extend(current[:MOST_ITEMS])
        elif current is not None:
            piece = shorten(current if isinstance(current, str) else dump(current), max(1, limit - length))
            if piece:
                found.append(piece)
                length += len(piece) + 1
    return shorten(" ".join(found), limit)


_SPACE = re.compile("[ \\t\\n\\v\\f\\r\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]+")


def shorten(s: str, limit: int) -> str:
    """As functions.text.compact(): a head that is over the limit decides, else the whole text."""
    size = limit + limit // 4 + 16
    short = _SPACE.sub(" ", s[:size]).strip(" ")
    if len(short) <= limit and len(s) > size:
        short = _SPACE.sub(" ", s).strip(" ")
    return short[:limit] + "…" if len(short) > limit else short


def shorten_ends(s: str) -> str:
    """Without white space at the ends."""
    return _ENDS.sub("", s)


_ENDS = re.compile(f"^{_SPACE.pattern}|{_SPACE.pattern}$")
