"""Course weights, quality points, GPA and enrolment at the end of a period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordkit.functions.rules import ratio

# The letters that earn points, best first, and how many steps below the top of a
# scale each lies; the value for a pair outside the table.
LETTERS = ("A", "B", "C", "D")
UNMAPPED_POINTS = 99
DECIMAL = "decimal(18,4)"


def points_table(spark: SparkSession, scales: dict[str, int]) -> DataFrame:
    """(scale, letter, points) for scales given as name -> points of the best letter."""
    rows = [(name, letter, top - step) for name, top in scales.items() for step, letter in enumerate(LETTERS)]
    return spark.createDataFrame(rows, "scale string, letter string, points int")


def scale_points(df: DataFrame, scale: str, letter: str, out: str, scales: dict[str, int], zero_letters: tuple[str, ...]) -> DataFrame:
    """Points for a (scale, letter) pair; ``zero_letters`` give 0 and anything else 99.

    The table has ``len(scales) * 4`` rows by construction, which is why it may be broadcast.
    """
    table = points_table(df.sparkSession, scales).select(
        F.col("scale").alias("_scale"), F.col("letter").alias("_letter"), F.col("points").alias("_points")
    )
    joined = df.join(
        F.broadcast(table), (F.col(scale) == F.col("_scale")) & (F.col(letter) == F.col("_letter")), "left"
    )
    zero = F.when(F.col(letter).isin(*zero_letters), 0)
    points = F.coalesce(F.col("_points"), zero, F.lit(UNMAPPED_POINTS))
    return joined.withColumn(out, points.cast("int")).drop("_scale", "_letter", "_points")


def first_rule(rules: list[tuple[Column, object]], otherwise: Column) -> Column:
    """The value of the first rule whose condition holds."""
    condition, value = rules[0]
    chain = F.when(condition, value)
    for condition, value in rules[1:]:
        chain = chain.when(condition, value)
    return chain.otherwise(otherwise)


def quality_points(credits: Column, points: Column) -> Column:
    """``credits * points`` rounded to three places."""
    return F.round(credits * points, 3)


def credit_totals(courses: DataFrame, key: list[str], sums: list[str]) -> DataFrame:
    """Sums per key, added in the columns' own type and narrowed to decimal(18,4) afterwards; combined before the shuffle."""
    return courses.groupBy(*key).agg(*[F.sum(c).cast(DECIMAL).alias(c) for c in sums])


def gpa(points: Column, credits: Column) -> Column:
    """Sum of quality points per credit, four places; NULL when no credits were attempted."""
    return ratio(points, credits, 4)


def enrolled_at_period_end(enrolments: DataFrame, end: str, period_end: str, days: int = 10) -> DataFrame:
    """Enrolments whose end (or the period's, if open) lies in the last ``days`` of the period."""
    last_day = F.col(period_end)
    return enrolments.filter(F.coalesce(F.col(end), last_day).between(F.date_sub(last_day, days), last_day))
