"""Row-level rules: each takes columns and returns a column, all native expressions.

None of them raises on dirty input, whatever the session's ANSI setting: what cannot be
read becomes NULL.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from asfalto import schemas as S

_NUMBER = r"^\s*[+-]?(\d+([.,]\d*)?|[.,]\d+)([eE][+-]?\d+)?\s*$"


def parse_date(text: Column) -> Column:
    return F.try_to_date(text, "dd/MM/yyyy")


def parse_hour(text: Column) -> Column:
    return F.substring_index(text, ":", 1).try_cast("int")


def parse_km(text: Column) -> Column:
    """Decimal comma to double. The guard keeps out Java literals such as `12d`."""
    return F.when(text.rlike(_NUMBER), F.replace(text, F.lit(","), F.lit(".")).try_cast("double"))


def parse_count(text: Column) -> Column:
    """The guard lets through all that Spark reads as a number: it begins with a digit, a sign or what is trimmed.

    A failed cast costs an exception, dozens of times what a good one does; for words the guard spares it.
    """
    return F.when((text < ":") | text.startswith("\x7f"), text.try_cast("int"))


def first_match(cases: list[tuple[Column, str]], default: str) -> Column:
    """Label of the first condition that holds; a NULL condition does not."""
    (condition, label), *rest = cases
    chain = F.when(condition, label)
    for condition, label in rest:
        chain = chain.when(condition, label)
    return chain.otherwise(default)


def direction(text: Column) -> Column:
    word = F.upper(F.trim(text))
    words = {S.NORTH: S.NORTH_WORDS, S.SOUTH: S.SOUTH_WORDS}
    return first_match([(word.isin(known), label) for label, known in words.items()], S.UNDEFINED)


def occurrence(text: Column) -> Column:
    """The unhurt pattern is tried first; both may match anywhere in the text."""
    patterns = {S.UNHURT: S.UNHURT_PATTERN, S.HURT: S.HURT_PATTERN}
    cases = [(F.lower(text).rlike(pattern), label) for label, pattern in patterns.items()]
    return first_match(cases, S.UNDEFINED)


def road(stretch: Column) -> Column:
    return F.trim(F.get(F.split(stretch, "/"), 0))


def state(stretch: Column) -> Column:
    """Second part of `road/state`; NULL when there is no slash."""
    return F.trim(F.get(F.split(stretch, "/"), 1))


def row_total(counts: list[Column]) -> Column:
    return reduce(add, [F.coalesce(c, F.lit(0)) for c in counts])


def severity(victims: dict[str, Column]) -> Column:
    """Worst outcome present; `victims` maps a victim column name to its parsed count."""
    worst_first = [(victims[name] > 0, label) for name, label in S.SEVERITY_LABELS.items()]
    return first_match(worst_first, S.NO_VICTIMS)


def file_key(path: Column) -> Column:
    return F.regexp_extract(path, S.FILE_KEY_PATTERN, 1)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, S.FILE_NAME_PATTERN, 1)


def accident_id() -> Column:
    """64-bit hash over five silver columns. It is not a key: distinct accidents can share it."""
    return F.xxhash64("data", "concessionaria", "km", "hora", "tipo_de_acidente")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))
