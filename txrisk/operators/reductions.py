"""What the charts compute on top of their queries: shares, last values, legend figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_share(rows: DataFrame, measure: str, name: str = "share") -> DataFrame:
    """Adds each row's part of the column total, by a scalar subquery."""
    total = rows.agg(F.sum(measure).alias("total")).scalar()
    return rows.withColumn(name, F.try_divide(F.col(measure), total))


def last_not_null(field: str, *order: str) -> Column:
    """Aggregate: the last non-null value of ``field`` when rows are sorted by ``order`` ascending."""
    place = F.when(F.col(field).isNotNull(), F.struct(*order))
    return F.max_by(F.col(field), place).cast("double")


def last_values(rows: DataFrame, fields: list[tuple[str, str]], order: list[str]) -> DataFrame:
    """(panel, field, value): the last non-null value of each (panel, field)."""
    return rows.agg(
        F.array(*(
            F.struct(
                F.lit(panel).alias("panel"),
                F.lit(field).alias("field"),
                last_not_null(field, *order).alias("value"),
            )
            for panel, field in fields
        )).alias("figures")
    ).select(F.inline("figures"))


def legend_figures(series: DataFrame, measure: str, order: str) -> DataFrame:
    """One row: least, last and mean value of a series sorted by ``order`` ascending."""
    return series.agg(
        F.min(measure).alias("min"),
        last_not_null(measure, order).alias("last"),
        F.avg(measure).alias("mean"),
    )
