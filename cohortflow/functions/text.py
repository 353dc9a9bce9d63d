"""Text, label, identifier and hashing expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F

# Labels that stand for "no specific condition" and their fallback.
DEFAULT_LABEL = "General Clinical Encounter"
GENERIC_LABELS = ("General Clinical Encounter", "General Outpatient Checkup")
NO_LABEL = "No condition linked"
LIST_SEPARATOR = " | "


def blank(col: Column) -> Column:
    """True when a text value is NULL or holds spaces only."""
    return col.isNull() | (F.trim(col) == "")


def present(col: Column) -> Column:
    return col.isNotNull() & (F.trim(col) != "")


def first_present(*cols: Column) -> Column:
    """First trimmed, non-blank value."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cols])


def word_pattern(pattern: str) -> str:
    """The pattern limited to whole words."""
    return rf"\b(?:{pattern})\b"


#: A pattern that is a list of plain words, none of them empty.
WORDS = re.compile(r"[A-Za-z0-9 ]+(\|[A-Za-z0-9 ]+)*")


def matches(col: Column, pattern: str, whole_words: bool = False) -> Column:
    """Match against the lower-cased text; substrings count unless ``whole_words``.

    Words alone, ``a|b``, are looked up as such, which takes half the time of a regular expression.
    """
    text = F.lower(col)
    if whole_words or not WORDS.fullmatch(pattern):
        return text.rlike(word_pattern(pattern) if whole_words else pattern)
    return reduce(lambda a, b: a | b, (text.contains(word) for word in pattern.split("|")))


def normalise_label(cols: Iterable[Column], default: str = DEFAULT_LABEL) -> Column:
    """First non-NULL label with its leading code number removed."""
    return F.trim(F.regexp_replace(F.coalesce(*cols, F.lit(default)), r"^\d+\s*", ""))


def mask(col: Column, salt: str | None = None) -> Column:
    """One-way SHA-256 of an identifier; a salt guards against dictionary lookups."""
    return F.sha2(col if salt is None else F.concat(F.lit(salt), col), 256)


def shard_id(col: Column, n: int = 5) -> Column:
    """Stable shard in 1..n from the first 32 bits of the key's MD5."""
    head = F.conv(F.substring(F.md5(col), 1, 8), 16, 10).cast("bigint")
    return (head % n + 1).cast("int")


def split_labels(col: Column) -> Column:
    """Array of trimmed labels from a pipe-separated list."""
    return F.split(col, r"\s*\|\s*")


def specific_labels(col: Column) -> Column:
    """Distinct, non-blank, non-generic labels of a pipe-separated list, in order."""
    trimmed = F.transform(F.split(F.coalesce(col, F.lit("")), r"\|"), lambda x: F.trim(x))
    return F.array_distinct(
        F.filter(trimmed, lambda x: (x != "") & ~x.isin(*GENERIC_LABELS))
    )


def short_labels(col: Column, n: int = 3) -> Column:
    """First ``n`` labels of a list, then "and N more"."""
    labels = specific_labels(col)
    extra = F.size(labels) - n
    head = F.concat_ws(LIST_SEPARATOR, F.slice(labels, 1, n))
    return (
        F.when(F.size(labels) == 0, F.lit(NO_LABEL))
        .when(extra > 0, F.concat(head, F.lit(" and "), extra.cast("string"), F.lit(" more")))
        .otherwise(head)
    )


# Ordered text rules for encounter class, hours and days of stay.
ENCOUNTER_CLASSES = (
    ("emergency", ("emergency",)),
    ("inpatient", ("inpatient", "hospital")),
    ("urgentcare", ("urgent",)),
    ("wellness", ("wellness",)),
)
OTHER_CLASS = "ambulatory"
STAY_HOURS = ((("inpatient", "hospital"), 72.0), (("emergency",), 8.0))
OTHER_HOURS = 1.0
STAY_DAY_RULES = (("inpatient|hospital admission|emergency hospital", 3),)
OTHER_DAYS = 1


def _mentions(text: Column, words: Iterable[str]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return hit


def classify_encounter(col: Column) -> Column:
    """Encounter class from free text; the first class whose words occur wins."""
    text = F.lower(F.coalesce(col, F.lit("")))
    branches = [F.when(_mentions(text, words), F.lit(name)) for name, words in ENCOUNTER_CLASSES]
    return F.coalesce(*branches, F.lit(OTHER_CLASS))


def stay_hours(col: Column) -> Column:
    text = F.lower(F.coalesce(col, F.lit("")))
    branches = [F.when(_mentions(text, words), F.lit(hours)) for words, hours in STAY_HOURS]
    return F.coalesce(*branches, F.lit(OTHER_HOURS))


def stay_days(col: Column, rules=STAY_DAY_RULES, default: int = OTHER_DAYS) -> Column:
    """Days of stay by ordered patterns over a description."""
    branches = [F.when(matches(col, pattern), F.lit(days)) for pattern, days in rules]
    return F.coalesce(*branches, F.lit(default))
