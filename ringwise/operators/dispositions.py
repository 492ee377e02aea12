"""Disposition code -> label -> category, reporting and presentation label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import labels


def disposition_rollup(rows: DataFrame, review_label: str = labels.REVIEW) -> DataFrame:
    """Look up every label of a ``code`` column; unknown codes and labels give nulls.

    The tables are fixed in code, about a hundred rows each, so broadcasting them is safe.
    Labels are spelled differently in two of them, hence codes 73 and 74 find no reporting label.
    """
    spark = rows.sparkSession
    code = labels.lookup_frame(spark, labels.DISPOSITION_BY_CODE, "code int, label string")
    category = labels.lookup_frame(spark, labels.CATEGORY_BY_LABEL, "label string, category string")
    reporting = labels.lookup_frame(
        spark, labels.reporting_by_label(review_label), "label string, reporting_label string"
    )
    presentation = labels.lookup_frame(
        spark, labels.PRESENTATION_BY_REPORTING, "reporting_label string, presentation_label string"
    )
    return (
        rows.join(F.broadcast(code), "code", "left")
        .join(F.broadcast(category), "label", "left")
        .join(F.broadcast(reporting), "label", "left")
        .join(F.broadcast(presentation), "reporting_label", "left")
    )
