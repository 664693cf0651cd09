"""Inference on aggregates: every test reduces the table to one row inside Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldbook.functions.numbers import ratio
from fieldbook.functions.student_t import t_quantile, t_two_sided, t_upper_tail

CONFIDENCE = 0.95


def welch_t(df: DataFrame, value: str, is_first: Column, alternative: str = "two-sided",
            conf_level: float = CONFIDENCE) -> DataFrame:
    """Welch two-sample t-test, first group minus second.

    Columns: statistic, t_df, p_value, estimate, lower_ci, upper_ci. Rows whose group or
    value is NULL do not take part.
    """
    if alternative not in ("two-sided", "greater"):
        raise ValueError(alternative)
    v = F.col(value).cast("double")
    first, second = F.when(is_first, v), F.when(~is_first, v)
    sides = df.agg(
        F.count(first).alias("n1"), F.avg(first).alias("m1"), F.var_samp(first).alias("v1"),
        F.count(second).alias("n2"), F.avg(second).alias("m2"), F.var_samp(second).alias("v2"),
    )
    a, b = F.col("v1") / F.col("n1"), F.col("v2") / F.col("n2")
    test = sides.where("n1 > 1 and n2 > 1").select(
        (F.col("m1") - F.col("m2")).alias("estimate"),
        F.sqrt(a + b).alias("se"),
        ratio(F.pow(a + b, 2), F.pow(a, 2) / (F.col("n1") - 1) + F.pow(b, 2) / (F.col("n2") - 1)).alias("t_df"),
    ).withColumn("statistic", ratio("estimate", "se"))
    if alternative == "two-sided":
        p_value = t_two_sided("statistic", "t_df")
        quantile = t_quantile(f"{0.5 + conf_level / 2}D", "t_df")
        upper = F.col("estimate") + F.col("reach")
    else:
        p_value = t_upper_tail("statistic", "t_df")
        quantile = t_quantile(f"{conf_level}D", "t_df")
        upper = F.lit(float("inf"))
    return test.withColumn("reach", quantile * F.col("se")).select(
        "statistic", "t_df", p_value.alias("p_value"), "estimate",
        (F.col("estimate") - F.col("reach")).alias("lower_ci"), upper.alias("upper_ci"),
    )


def ols_line(df: DataFrame, y: str, x: str) -> DataFrame:
    """Least-squares line y ~ x: n, slope, intercept, correlation, r_squared, p_value of the slope."""
    fit = df.agg(
        F.regr_count(F.col(y), F.col(x)).alias("n"),
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.corr(F.col(y), F.col(x)).alias("correlation"),
        F.regr_r2(F.col(y), F.col(x)).alias("r_squared"),
    )
    freedom = F.col("n") - 2
    t = F.col("correlation") * F.sqrt(ratio(freedom.cast("double"), 1 - F.col("r_squared")))
    return fit.withColumns({"__t": t, "__df": freedom}).withColumn("p_value", t_two_sided("__t", "__df")).drop("__t", "__df")


def with_fitted_line(df: DataFrame, y: str, x: str) -> DataFrame:
    """Add the fitted value and the residual of y ~ x to every row."""
    line = df.agg(F.struct(
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
    ).alias("line")).scalar()
    return df.withColumn("fit", line["intercept"] + line["slope"] * F.col(x)).withColumn(
        "residual", F.col(y) - F.col("fit")
    )


def diff_in_props(df: DataFrame, response: Column, group: Column, name: str = "diff_in_props") -> DataFrame:
    """Share of a TRUE response where the group flag is TRUE, minus where it is FALSE."""
    hit = response.cast("int")
    return df.agg((F.avg(F.when(group, hit)) - F.avg(F.when(~group, hit))).alias(name))


def share(flag: Column) -> Column:
    """Proportion of TRUE among the known values of a flag."""
    return F.avg(flag.cast("int"))
