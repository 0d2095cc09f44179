"""The whole data-quality report of a table, as a dictionary of DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.functions.columns import numeric_columns
from starloom.operators import profile as P
from starloom.operators.correlation import correlations, cramers_v
from starloom.operators.dedupe import duplicate_rows
from starloom.operators.sampling import sample_by_key
from starloom.operators.stats import null_counts
from starloom.plans.batch import Sample, stage, unstage


def profile_report(
    df: DataFrame,
    sample: Sample | None = None,
    order: Sequence[str] | None = None,
    approx: bool = True,
    n: int = 10,
    category_columns: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Every report section by name. The table is staged once, sampled if asked, and each section
    reads only the columns that it needs; ``close_report`` removes the staged files.

    Cramer's V is computed for ``category_columns``, or else for the text columns that the section
    ``types`` calls boolean or categorical; ``uncategorised`` lists the text columns left out.
    """
    staged = stage(df, "profile")
    if sample:
        whole, staged = staged, stage(sample_by_key(staged, sample.key, sample.k, sample.seed), "sample")
        unstage(whole)
    df = staged
    numbers = numeric_columns(df)
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    kinds = P.profile_types(df, approx).collect()
    if category_columns is None:
        category_columns = [r["column"] for r in kinds if r["column"] in texts and r["kind"] in ("boolean", "categorical")]
    spark = df.sparkSession
    report = {
        "staged": df,
        "overview": P.profile_overview(df),
        "types": spark.createDataFrame(kinds, "column string, type string, kind string, n_distinct long"),
        "columns": P.profile_columns(df, approx=approx),
        "nulls": null_counts(df),
        "missing_patterns": P.missing_patterns(df),
        "duplicates": duplicate_rows(df, n),
        "alerts": P.profile_alerts(df, approx=approx),
        "top_values": P.top_values_by_column(df, df.columns, n),
        "head": P.head_rows(df, n, order or df.columns),
        "tail": P.tail_rows(df, n, order or df.columns),
        "uncategorised": spark.createDataFrame(
            [(c,) for c in texts if c not in category_columns], "column string"
        ),
    }
    if numbers:
        report["quantiles"] = P.profile_quantiles(df, numbers, approx)
        report["moments"] = P.profile_moments(df, numbers)
        report["histograms"] = P.profile_histograms(df, numbers)
        report["extremes"] = P.extreme_values_by_column(df, numbers, n)
    if texts:
        report["text_lengths"] = P.profile_text_lengths(df, texts)
    if len(numbers) > 1:
        report["pearson"] = correlations(df, numbers)
        report["spearman"] = correlations(df, numbers, "spearman_approx" if approx else "spearman")
    if len(category_columns) > 1:
        report["cramers_v"] = cramers_v(df, category_columns)
    return report


def close_report(report: dict[str, DataFrame]) -> None:
    """Remove the files that a report's sections read."""
    unstage(report["staged"])


# Sections whose rows name a column, and the figures that are told of it.
_FIGURES = {
    "columns": ("n_distinct", "n_missing", "n_zero", "n_negative", "n_infinite"),
    "nulls": ("n_null", "n_not_null"),
    "quantiles": ("min", "q05", "q25", "q50", "q75", "q95", "max", "mad"),
    "moments": ("n", "mean", "stddev", "skewness", "kurtosis"),
    "text_lengths": ("min_len", "mean_len", "max_len"),
}


def _figure(name: str) -> Column:
    return F.struct(F.lit(name).alias("figure"), F.col(name).cast("double").alias("value"))


def report_rows(report: dict[str, DataFrame]) -> DataFrame:
    """The per-column sections as rows (section, column, figure, value)."""
    parts = [
        report[section].select(
            F.lit(section).alias("section"),
            "column",
            F.inline(F.array(*[_figure(f) for f in figures])),
        )
        for section, figures in _FIGURES.items()
        if section in report
    ]
    return reduce(DataFrame.unionByName, parts)
