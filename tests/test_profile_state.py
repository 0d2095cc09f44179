import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from starloom.plans.profile_state import date_states, keep_states, united_profile
from starloom.operators import profile as P

SCHEMA = "price double, stops int, city string, none double, process_date string"
DATES = ("2024-01-01", "2024-01-02", "2024-01-03")


def batch(spark, seed, date, n=3000):
    r = random.Random(seed)
    rows = [
        (
            math.nan if i % 50 == 0 else None if i % 41 == 0 else r.lognormvariate(3, 1) + seed,
            r.choice([0, 1, -2]) if seed else 1,
            f"city {r.randrange(700)}",
            None,
            date,
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_states_unite_to_the_profile_of_all_rows(spark, tmp_path):
    table = "kept_states"
    batches = {d: batch(spark, i, d) for i, d in enumerate(DATES)}
    for date, df in batches.items():
        keep_states(df, table, date, location=str(tmp_path / table))
    keep_states(batches[DATES[1]], table, DATES[1])  # a repeated load
    whole = batches[DATES[0]].union(batches[DATES[1]]).union(batches[DATES[2]])
    found = {r["column"]: r for r in united_profile(spark.table(table)).collect()}
    assert set(found) == {"price", "stops", "city", "none"}
    for r in P.profile_columns(whole.drop("process_date")).collect():
        f = found[r["column"]]
        assert all(f[c] == r[c] for c in ("n_missing", "n_zero", "n_negative", "n_infinite"))
        assert f["n_distinct"] == pytest.approx(r["n_distinct"], rel=0.05) and f["n_rows"] == 9000
    for r in P.profile_moments(whole, ["price", "stops"]).collect():
        for c in ("n", "mean", "stddev", "variance", "sum", "skewness", "kurtosis"):
            assert found[r["column"]][c] == pytest.approx(r[c], rel=1e-9), c
    prices = pd.Series([r[0] for r in whole.select("price").collect()], dtype=float).dropna()
    for p, q in zip(P.QUANTILES, found["price"]["quantiles"]):
        assert (prices <= q).mean() == pytest.approx(p, abs=0.02)
    empty = found["none"]
    assert empty["n"] == 0 and empty["mean"] is None and empty["quantiles"] is None and empty["n_distinct"] == 0
    # A batch that is corrected or emptied changes its date alone.
    keep_states(batches[DATES[2]].filter("false"), table, DATES[2])
    left = {r["column"]: r["n_rows"] for r in united_profile(spark.table(table)).collect()}
    assert set(left.values()) == {6000}


def test_states_of_one_pass_over_all_dates(spark):
    df = batch(spark, 0, DATES[0], 40).union(batch(spark, 4, DATES[1], 1))
    states = date_states(df, ["price", "stops"])
    assert states.count() == 4 and states.filter("n_rows = 1").count() == 2
    found = {r["column"]: r for r in united_profile(states).collect()}
    wanted = {r["column"]: r for r in P.profile_moments(df, ["price", "stops"]).collect()}
    for c in wanted:
        for name in ("n", "mean", "stddev", "skewness", "kurtosis"):
            assert found[c][name] == pytest.approx(wanted[c][name], rel=1e-9, abs=1e-12)
    assert united_profile(states.limit(0)).count() == 0
    with pytest.raises(ValueError):
        keep_states(df.withColumn("process_date", F.lit("x")), "kept_wrong", "x")
