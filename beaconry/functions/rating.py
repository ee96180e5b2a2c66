"""Threshold ratings.

The batch rating and the streaming severity disagree on a value exactly at the red
threshold (AMBER in batch, RED on streams), so they are separate functions.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from beaconry.functions.times import col

# fixed values: severity levels and their labels
GREEN, AMBER, RED = 0, 1, 2
SEVERITY_LABELS = ("GREEN", "AMBER", "RED")


def gen_rag(avg: Column | str, amber: Column | str, red: Column | str) -> Column:
    """GREEN below amber, RED strictly above red, AMBER between; NULL when an input is NULL."""
    avg, amber, red = col(avg), col(amber), col(red)
    return (
        F.when(avg < amber, "GREEN")
        .when((avg >= amber) & (avg > red), "RED")
        .when((avg >= amber) & (avg <= red), "AMBER")
    )


def severity(avg: Column | str, amber: Column | str, red: Column | str) -> Column:
    """0 below amber, 2 from red upwards, 1 between; NULL when an input is NULL."""
    avg, amber, red = col(avg), col(amber), col(red)
    return (
        F.when(avg < amber, F.lit(GREEN))
        .when((avg >= amber) & (avg >= red), F.lit(RED))
        .when((avg >= amber) & (avg < red), F.lit(AMBER))
    )


def severity_label(level: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in SEVERITY_LABELS]), col(level) + F.lit(1))


def register_gen_rag(spark: SparkSession) -> None:
    """Make ``gen_rag(avg, amber, red)`` callable from SQL as an inlined expression, not a UDF."""
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION gen_rag(avg INT, amber INT, red INT) RETURNS STRING
        RETURN CASE WHEN avg < amber THEN 'GREEN'
                    WHEN avg >= amber AND avg > red THEN 'RED'
                    WHEN avg >= amber AND avg <= red THEN 'AMBER' END
        """
    )
