"""Lead-level operators: splits, keep-first rules, member matching and contact dates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import labels
from ..functions import any_equals, any_of, area_code, either, member_key
from .skew import ROWS_PER_SLICE, distinct_keys, spread_join

STAR_COLUMNS = ("stars_1", "stars_2", "stars_3")
STATUS_COLUMNS = ("call_status_1", "call_status_2", "call_status_3")
ALL_STARS = "All"


def cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def with_member_key(leads: DataFrame, card: str = "card_id", dependent: str = "dependent_code") -> DataFrame:
    return leads.withColumn("idcard_mbr_id", member_key(F.col(card), F.col(dependent)))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in ``order``; null keys form a group of their own.

    Filtering ``row_number`` on 1 lets Spark drop all but one row per key inside each
    input task, so a key that repeats millions of times shuffles only a few rows.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_row", first).filter(F.col("_row") == 1).drop("_row")


def dedup_leads(leads: DataFrame, order: Sequence[str | Column] | None = None) -> DataFrame:
    """First row per file date and lead. Default order: all columns, which is total."""
    return keep_first(leads, ["file_date", "leadid"], order or leads.columns)


class Splits:
    """Overlapping (contract group, star) splits plus one with everything.

    The default group takes every contract, known or not, that is not listed.
    """

    def __init__(
        self,
        pairs: Sequence[tuple[str, str]] | None = None,
        default_group: str = labels.DEFAULT_GROUP,
        listed: Sequence[str] = labels.LISTED_CONTRACTS,
        everything: tuple[str, str] = labels.EVERYTHING,
        contract: str = "contract",
        stars: Sequence[str] = STAR_COLUMNS,
    ):
        self.pairs = [*(pairs or labels.DEFAULT_SPLITS), everything]
        self.default_group = default_group
        self.listed = list(listed)
        self.everything = everything
        self.contract = contract
        self.stars = list(stars)

    @classmethod
    def parse(cls, texts: Sequence[str], **kwargs) -> Splits:
        """From ``group:star`` texts, star being Stars, Nonstars, Both or All."""
        return cls([tuple(text.split(":", 1)) for text in texts], **kwargs)

    @property
    def names(self) -> list[str]:
        return [f"{group}:{star}" for group, star in self.pairs]

    def star_condition(self, star: str) -> Column:
        return F.lit(True) if star == ALL_STARS else any_equals(cols(self.stars), star)

    def star_conditions(self) -> list[Column]:
        return [self.star_condition(star) for _, star in self.pairs]

    def conditions(self) -> list[Column]:
        """One two-valued condition per split, in the order of ``names``."""
        return [self._condition(group, star) for group, star in self.pairs]

    def _condition(self, group: str, star: str) -> Column:
        if (group, star) == self.everything:
            return F.lit(True)
        contract = F.col(self.contract)
        in_group = ~either(contract.isin(self.listed)) if group == self.default_group else either(contract == group)
        return in_group & self.star_condition(star)

    def entries(self, conditions: Sequence[Column], **fields: Sequence[Column]) -> Column:
        """Array with one entry per split, null where its condition fails.

        An entry is the split's name, or a struct of ``split`` and the given per-split fields.
        Exploding it and filtering on null stays in generated code; dropping the nulls
        inside the array would be interpreted row by row.
        """
        found = []
        for i, (name, condition) in enumerate(zip(self.names, conditions, strict=True)):
            values = [column[i].alias(field) for field, column in fields.items()]
            entry = F.struct(F.lit(name).alias("split"), *values) if fields else F.lit(name)
            found.append(F.when(condition, entry))
        return F.array(*found)


def contract_star_splits(leads: DataFrame, splits: Splits) -> DataFrame:
    """Each lead once per split it belongs to, in one pass."""
    split = F.explode(splits.entries(splits.conditions()))
    return leads.withColumn("split", split).filter(F.col("split").isNotNull())


def member_semi_join(
    rows: DataFrame,
    members: DataFrame,
    keys: Sequence[str] = ("idcard_mbr_id",),
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Rows whose key occurs among the members; null matches null."""
    return spread_join(
        rows, distinct_keys(members, keys), keys, "left_semi", null_safe=True, rows_per_slice=rows_per_slice
    )


def lead_index_date(leads: DataFrame) -> DataFrame:
    """Contact date of every lead: its last file date."""
    return leads.groupBy("leadid").agg(F.max("file_date").alias("lead_index_date"))


def right_day_contacts(
    attempts: DataFrame, index_dates: DataFrame, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Attempts made on the lead's own contact date."""
    dated = spread_join(attempts, index_dates, ["leadid"], "inner", rows_per_slice=rows_per_slice)
    return dated.filter(F.to_date("attempt_ts") == F.col("lead_index_date"))


def first_disposition(
    attempts: DataFrame, order: Sequence[str | Column] | None = None, statuses: Sequence[str] = STATUS_COLUMNS
) -> DataFrame:
    """First attempt per lead and file date by time.

    Of attempts at the very same time a final one goes before a retryable one, as in the
    funnel; further ties go by ``order`` (default: all columns). Attempts without a time or
    lead cannot be first.
    """
    usable = attempts.filter(F.col("attempt_ts").isNotNull() & F.col("leadid").isNotNull())
    known = [name for name in statuses if name in attempts.columns]
    retryable = any_of(cols(known), labels.RETRYABLE) if known else F.lit(False)
    return keep_first(usable, ["leadid", "file_date"], ["attempt_ts", retryable, *(order or attempts.columns)])


def attempt_counts(attempts: DataFrame) -> DataFrame:
    """Per file date: leads with at least one and with at least two attempts."""
    per_lead = (
        attempts.filter(F.col("leadid").isNotNull())
        .groupBy("file_date", "leadid")
        .agg(F.count(F.lit(1)).alias("attempts"))
    )
    return per_lead.groupBy("file_date").agg(
        F.count_if(F.col("attempts") >= 1).alias("attempted_leads"),
        F.count_if(F.col("attempts") >= 2).alias("second_attempts"),
    )


def counts_by_file_date(rows: DataFrame, flags: dict[str, Column], keys: Sequence[str] = ("file_date",)) -> DataFrame:
    """Rows per file date for which each flag holds, all flags in one aggregate."""
    return rows.groupBy(*keys).agg(*[F.count_if(flag).alias(name) for name, flag in flags.items()])


def outer_fold(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of small per-date frames, missing counts as 0."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.join(frame, list(keys), "full_outer")
    return result.fillna(0)


def missing_days(spark: SparkSession, present: DataFrame, first: date, last: date, column: str = "file_date") -> DataFrame:
    """Days of the range that ``present`` has no row for."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))).alias(column)
    )
    seen = present.filter(F.col(column).between(F.lit(first), F.lit(last))).select(column).distinct()
    return days.join(seen, column, "left_anti").orderBy(column)


def area_code_members(leads: DataFrame, codes: DataFrame, phone: str = "phone") -> DataFrame:
    """Leads whose area code is in ``codes(area_code)``; the code table is the caller's."""
    keyed = leads.withColumn("area_code", area_code(F.col(phone)))
    return spread_join(keyed, distinct_keys(codes, ["area_code"]), ["area_code"], "left_semi").drop("area_code")
