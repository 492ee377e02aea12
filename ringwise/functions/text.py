"""Text, label and phone-number expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: words a CSV reader takes for "no value" unless told otherwise.
NA_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def col(name: str) -> Column:
    """Column by its literal name, so that labels with dots or spaces work as names."""
    return F.col("`" + name.replace("`", "``") + "`")


def either(condition: Column) -> Column:
    """Two-valued logic: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def any_equals(cols: Sequence[Column], value: str) -> Column:
    """True when at least one of the columns equals ``value``; null columns never do."""
    hit = F.lit(False)
    for c in cols:
        hit = hit | either(c == value)
    return hit


def any_of(cols: Sequence[Column], labels: Sequence[str]) -> Column:
    """True when at least one of the columns holds one of the labels."""
    hit = F.lit(False)
    for c in cols:
        hit = hit | either(c.isin(list(labels)))
    return hit


def blank_to_default(x: Column, default: str) -> Column:
    """Null or whitespace becomes ``default``; other text is left untrimmed."""
    return F.when(x.isNull() | (F.trim(x) == ""), F.lit(default)).otherwise(x)


def null_to_blank(x: Column) -> Column:
    return F.trim(F.coalesce(x, F.lit("")))


def show_blank(x: Column, shown: str = "(Blank)") -> Column:
    return F.when(x == "", F.lit(shown)).otherwise(x)


def blank_to_null_words(x: Column) -> Column:
    """Blank text and the other words for "no value" become null."""
    return F.when(~x.isin(list(NA_WORDS)), x)


def same_account(mail: Column, account: str) -> Column:
    """Case- and space-insensitive account match; unknown mail stays unknown."""
    return F.lower(F.trim(mail)) == F.lit(account.strip().lower())


def member_key(card: Column, dependent: Column) -> Column:
    """Card id followed by dependent code; null if either part is missing."""
    return F.concat(card, dependent)


def normalize_phone(x: Column) -> Column:
    """Ten-character number, or null.

    Spaces and leading plus signs go first, then one country digit ``1`` if the
    text is still longer than ten. Digits are not checked.
    """
    bare = F.ltrim(F.trim(x), F.lit("+"))
    local = F.when((F.length(bare) > 10) & bare.startswith("1"), F.substr(bare, F.lit(2))).otherwise(bare)
    return F.when(F.length(local) == 10, local)


def normalize_phone_loose(x: Column) -> Column:
    """Strip any leading run of ``+`` and ``1`` characters."""
    return F.ltrim(x, F.lit("+1"))


def area_code(phone: Column) -> Column:
    return F.substring(phone, 1, 3)
