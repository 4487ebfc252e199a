"""Column data-quality checks. Each check returns its failing rows or
values; a check passes when that result is empty."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` seen more than once (nulls ignored): (value, n)."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` is null."""
    return df.filter(F.col(col).isNull())


def check_accepted_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Values outside the accepted set (nulls ignored, as SQL NOT IN): (value, n)."""
    return df.filter(~F.col(col).isin(list(values))).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def not_null_counts(model: str, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All not_null tests of one model in a single pass: one row per column."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_nn{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', _nn{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, failures)").select(
        F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test"), "failures"
    )


#: (column, test, accepted values)
Test = tuple[str, str, Sequence[str] | None]


def _findings(tests: Sequence[Test]) -> Column:
    """What a row gives the model's tests: (test number, value). A unique test takes every value that
    isn't null, the others only what fails; values are compared by their text."""
    found = []
    for i, (c, test, values) in enumerate(tests):
        text = F.col(c).cast("string")
        wrong = {"unique": F.col(c).isNotNull(), "not_null": F.col(c).isNull()}.get(test)
        wrong = wrong if wrong is not None else ~F.col(c).isin(list(values or ()))
        found.append(F.when(wrong, F.struct(F.lit(i).alias("t"), text.alias("v"))))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def model_report(model: str, df: DataFrame, tests: Sequence[Test]) -> DataFrame:
    """All tests of one model from one scan: a row per test.

    Each row gives its (test, value) findings; these are counted (combined before
    the shuffle, so a value that a third of the rows share is no hot spot), and the counted
    values are summed up per test: repeated values (unique), rows (not_null),
    distinct values (accepted_values).
    """
    groups = df.select(F.explode(_findings(tests)).alias("f")).groupBy("f.t", "f.v").agg(F.count(F.lit(1)).alias("n"))
    fails = {"unique": F.count_if(F.col("n") > 1), "not_null": F.sum("n"), "accepted_values": F.count(F.lit(1))}
    per_test = groups.groupBy("t").agg(*[e.alias(k) for k, e in fails.items()])
    one = per_test.agg(*[F.coalesce(F.max(F.when(F.col("t") == i, F.col(test))), F.lit(0)).alias(f"_t{i}") for i, (_, test, _) in enumerate(tests)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("test"), F.col(f"_t{i}").alias("failures")) for i, (c, t, _) in enumerate(tests)]))
    return one.select(rows.alias("r")).select(F.lit(model).alias("model"), "r.*")


def run_suite(
    models: dict[str, DataFrame],
    unique: Sequence[tuple[str, str]] = (),
    not_null: Sequence[tuple[str, str]] = (),
    accepted: Sequence[tuple[str, str, Sequence[str]]] = (),
) -> DataFrame:
    """Run a suite and report (model, column_name, test, failures, status).

    ``failures`` is the number of rows each test's failing result has: null
    rows (not_null), repeated values (unique), distinct unaccepted values
    (accepted_values). All tests of a model share one scan (``model_report``).
    """
    by_model: dict[str, list[Test]] = {}
    for model, c in not_null:
        by_model.setdefault(model, []).append((c, "not_null", None))
    for model, c, values in accepted:
        by_model.setdefault(model, []).append((c, "accepted_values", values))
    for model, c in unique:
        by_model.setdefault(model, []).append((c, "unique", None))
    if not by_model:
        raise ValueError("run_suite needs at least one test")
    out = None
    for model, tests in by_model.items():
        report = model_report(model, models[model], tests)
        out = report if out is None else out.unionByName(report)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def require_nonempty(df: DataFrame, what: str) -> DataFrame:
    """Stop a job early when an input is empty (one-row probe, not a count)."""
    if df.isEmpty():
        raise ValueError(f"no {what} found")
    return df
