"""Which of several measures is the highest."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from aqlake.feeds import LABELLED_POLLUTANTS


def argmax_label(labels: Mapping[str, str]) -> Column:
    """Label of the highest column; ``labels`` maps column name to label.

    On a tie the column declared first wins. NULL columns are passed over, and
    if all are NULL the label is NULL: one missing reading must not fail a job.
    """
    if len(labels) == 1:
        (name, label), = labels.items()
        return F.when(F.col(name).isNotNull(), F.lit(label))
    highest = F.greatest(*labels)
    return F.coalesce(*[F.when(F.col(name) == highest, F.lit(label)) for name, label in labels.items()])


def prominent_pollutant() -> Column:
    """Label of the highest pollutant of a measurement row (CO does not compete)."""
    return argmax_label(LABELLED_POLLUTANTS)


def register_functions(spark: SparkSession) -> None:
    """Make ``prominent_index(no, no2, o3, so2, pm2_5, pm10, nh3)`` callable from SQL text.

    It is a SQL function, so Catalyst inlines its body into the caller's plan.
    """
    params = ", ".join(f"{name} DOUBLE" for name in LABELLED_POLLUTANTS)
    whens = " ".join(f"WHEN {name} THEN '{label}'" for name, label in LABELLED_POLLUTANTS.items())
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION prominent_index({params}) RETURNS STRING "
        f"RETURN CASE greatest({', '.join(LABELLED_POLLUTANTS)}) {whens} END"
    )
