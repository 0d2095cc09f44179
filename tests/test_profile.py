"""Profile operators against pandas and plain Python on small data with hot values and gaps."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from starloom.operators import profile as P
from starloom.operators.correlation import correlations, cramers_v
from starloom.operators.dedupe import duplicate_report, duplicate_rows
from starloom.operators.stats import value_counts

NAN, INF = float("nan"), float("inf")


def skewed_rows(n=3000, seed=5):
    """A third of the rows hold one value; some are null or NaN."""
    r = random.Random(seed)

    def value(p):
        if r.random() < 1 / 3:
            return 7.0
        return r.choice([None, NAN, round(r.gauss(0, 50), 1), float(r.randint(-5, 5))][p:])

    return [(value(0), value(2), value(2)) for _ in range(n)]


@pytest.fixture(scope="module")
def frame(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(7).cache()
    return df, pd.DataFrame(rows, columns=["a", "b", "c"], dtype=float)


def test_exact_quantiles(frame):
    df, pdf = frame
    found = {r["column"]: r for r in P.profile_quantiles(df, approx=False).collect()}
    for c in "abc":
        s = pdf[c].dropna()
        for p in P.QUANTILES:
            assert found[c][f"q{round(p * 100):02d}"] == pytest.approx(s.quantile(p))
        assert found[c]["mad"] == pytest.approx((s - s.median()).abs().median())
        assert found[c]["iqr"] == pytest.approx(s.quantile(0.75) - s.quantile(0.25))
        assert found[c]["range"] == pytest.approx(s.max() - s.min())
        assert found[c]["cv"] == pytest.approx(s.std() / s.mean())


def test_approximate_quantiles_are_close(frame):
    df, pdf = frame
    exact = {r["column"]: r for r in P.profile_quantiles(df, approx=False).collect()}
    for r in P.profile_quantiles(df).collect():
        for name in ("q05", "q50", "q95", "mad"):
            assert r[name] == pytest.approx(exact[r["column"]][name], abs=2)


def test_quantiles_of_hard_columns(spark):
    df = spark.createDataFrame(
        [(None, 1.0, -INF, 2**60), (None, 1.0, 0.0, 2**60 + 1), (None, 1.0, INF, -(2**60))],
        "nothing double, same double, endless double, big bigint",
    )
    found = {r["column"]: r for r in P.profile_quantiles(df, approx=False).collect()}
    assert found["nothing"]["q50"] is None and found["nothing"]["mad"] is None
    assert found["same"]["q05"] == found["same"]["q95"] == 1.0 and found["same"]["mad"] == 0.0
    assert found["endless"]["q50"] == 0.0
    assert found["big"]["q50"] == float(2**60)
    empty = P.profile_quantiles(df.filter("false"), ["same"], approx=False).collect()
    assert [r["q50"] for r in empty] == [None]


def test_spearman_with_ties_and_gaps(frame):
    df, pdf = frame
    found = {(r["column_x"], r["column_y"]): r["r"] for r in
             correlations(df, method="spearman").collect()}
    assert len(found) == 3
    for x, y in found:
        both = pdf[[x, y]].dropna()
        wanted = both[x].rank().corr(both[y].rank())
        assert found[x, y] == pytest.approx(wanted, abs=1e-9)


def test_spearman_of_whole_columns_and_a_hot_value(spark):
    r = random.Random(2)
    rows = [(7.0 if i % 3 else r.gauss(0, 9), r.choice([1.0, 2.0, 5.0]), float(i % 11), None) for i in range(2000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    pdf = pd.DataFrame(rows, columns=list("abcd"), dtype=float)
    found = {(x["column_x"], x["column_y"]): x["r"] for x in correlations(df, method="spearman").collect()}
    close = {(x["column_x"], x["column_y"]): x["r"] for x in correlations(df, method="spearman_approx").collect()}
    assert len(found) == len(close) == 6
    for x, y in found:
        if y == "d":
            assert found[x, y] is None and close[x, y] is None
        else:
            wanted = pdf[x].rank().corr(pdf[y].rank())
            assert found[x, y] == pytest.approx(wanted, abs=1e-9) and close[x, y] == pytest.approx(wanted, abs=0.05)


def test_spearman_of_many_missing_patterns(spark):
    r = random.Random(5)
    names = [f"c{i:02d}" for i in range(40)]
    rows = []
    for _ in range(300):
        base = r.gauss(0, 1)
        rows.append(tuple(
            None if r.random() < i / 90 else r.choice([math.nan, 3.0]) if i == 7 else round(base * i + r.gauss(0, 5), 0)
            for i in range(40)
        ))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(3)
    pdf = pd.DataFrame(rows, columns=names, dtype=float)
    found = {(x["column_x"], x["column_y"]): x["r"] for x in correlations(df, method="spearman").collect()}
    assert len(found) == 780
    for x, y in found:
        both = pdf[[x, y]].dropna()
        wanted = None if "c07" in (x, y) else both[x].rank().corr(both[y].rank())
        assert found[x, y] == (wanted if wanted is None else pytest.approx(wanted, abs=1e-9))


@pytest.mark.parametrize("frequent", [1, 5, 20_000])
def test_spearman_shuffles_rare_values_alone(spark, monkeypatch, frequent):
    from starloom.operators import ranks

    monkeypatch.setattr(ranks, "FREQUENT_RANKS", frequent)
    r = random.Random(8)
    rows = [(float(i % 3), r.choice([None, 1.0, 4.0]), r.choice([r.gauss(0, 9), 2.5, math.inf, -0.0])) for i in range(900)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(4)
    pdf = pd.DataFrame(rows, columns=list("abc"), dtype=float)
    for x in correlations(df, method="spearman").collect():
        both = pdf[[x["column_x"], x["column_y"]]].dropna()
        assert x["r"] == pytest.approx(both.iloc[:, 0].rank().corr(both.iloc[:, 1].rank()), abs=1e-9)


def test_pairs_without_common_rows_are_listed(spark):
    df = spark.createDataFrame([(1.0, None, "a", None), (None, 2.0, None, "b")], "x double, y double, s string, t string")
    for method in ("pearson", "spearman", "spearman_approx"):
        assert [r["r"] for r in correlations(df, ["x", "y"], method).collect()] == [None]
    assert [r["v"] for r in cramers_v(df, ["s", "t"]).collect()] == [None]


def test_quantiles_of_infinite_medians(spark):
    rows = [(INF, -INF, 1.0), (INF, -INF, INF), (1.0, 5.0, 2.0)]
    found = {r["column"]: r for r in P.profile_quantiles(spark.createDataFrame(rows, "a double, b double, c double"), approx=False).collect()}
    assert found["a"]["q50"] == INF and found["a"]["q05"] == INF and found["b"]["q50"] == -INF
    assert found["c"]["q50"] == 2.0 and found["c"]["q95"] == INF


def test_wide_tables(spark):
    from pyspark.sql import functions as F

    wide = spark.range(1000).select(*[(F.rand(i) * 10).alias(f"c{i}") for i in range(100)], "id")
    alerts = P.profile_alerts(wide).collect()
    assert {r["column"] for r in alerts if r["alert"] == "unique"} >= {"id"}
    texts = wide.select(*[F.floor(f"c{i}").alias(f"c{i}") for i in range(100)])
    assert value_counts(texts, texts.columns).agg(F.sum("n")).first()[0] == 100_000


def test_histogram_counts_what_it_leaves_out(spark):
    df = spark.createDataFrame([(x,) for x in (INF, -INF, NAN, None, 1.0, 2.0, 9.0)], "x double")
    assert {r["n_out"] for r in P.profile_histogram(df, "x", 2).collect()} == {2}
    assert {r["n_out"] for r in P.profile_histogram(df, "x", 2, (0.0, 5.0)).collect()} == {3}


def test_extremes_count_little(frame):
    df, _ = frame
    assert P.extreme_values_by_column(df.filter("false"), ["a"], 3).count() == 0
    limits = P._outermost(df.select(P.present(df, "a").alias("a")), 2)
    values = sorted({r["a"] for r in df.collect() if r["a"] is not None and r["a"] == r["a"]})
    assert limits == [(values[1], values[-2])]


def test_spearman_without_spread_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "x double, y double")
    assert correlations(df, method="spearman").first()["r"] is None


def test_pearson_skips_missing(frame):
    df, pdf = frame
    for r in correlations(df).collect():
        both = pdf[[r["column_x"], r["column_y"]]].dropna()
        assert r["r"] == pytest.approx(both.iloc[:, 0].corr(both.iloc[:, 1]))
    with pytest.raises(ValueError):
        correlations(df, ["a"])
    with pytest.raises(ValueError):
        correlations(df, method="kendall")


def brute_cramers_v(pairs):
    table = pd.crosstab(*zip(*[(x, y) for x, y in pairs if x is not None and y is not None]))
    t = table.to_numpy(dtype=float)
    n = t.sum()
    e = np.outer(t.sum(1), t.sum(0)) / n
    phi2 = ((t - e) ** 2 / e).sum() / n
    r, k = t.shape
    corrected = max(0.0, phi2 - (r - 1) * (k - 1) / (n - 1))
    fr, fk = r - (r - 1) ** 2 / (n - 1), k - (k - 1) ** 2 / (n - 1)
    return math.sqrt(phi2 / (min(r, k) - 1)), math.sqrt(corrected / (min(fr, fk) - 1))


def test_cramers_v_with_empty_cells(spark):
    r = random.Random(1)
    pairs = [("hot", r.choice("xy")) for _ in range(200)]
    pairs += [(r.choice(["a", "b", None]), r.choice(["x", "z", None])) for _ in range(200)]
    df = spark.createDataFrame(pairs, "x string, y string")
    v, corrected = brute_cramers_v([p for p in pairs])
    found = cramers_v(df, ["x", "y"]).first()
    assert found["v"] == pytest.approx(v) and found["v_corrected"] == pytest.approx(corrected)
    one = spark.createDataFrame([("a", "x"), ("a", "y")], "x string, y string")
    assert cramers_v(one, ["x", "y"]).first()["v"] is None


def test_columns_overview_and_patterns(spark):
    df = spark.createDataFrame(
        [(0.0, 1), (-1.5, None), (NAN, 0), (INF, 2), (None, 1), (0.0, 1)], "v double, n int"
    )
    rows = {r["column"]: r for r in P.profile_columns(df, approx=False).collect()}
    assert tuple(rows["v"])[1:] == (3, 2, 2, 1, 1)
    assert tuple(rows["n"])[1:] == (3, 1, 1, 0, 0)
    approximate = {r["column"]: r["n_distinct"] for r in P.profile_columns(df).collect()}
    assert approximate == {"v": 3, "n": 3}
    overview = P.profile_overview(df).first()
    assert (overview["n_rows"], overview["missing_cells"], overview["duplicate_rows"]) == (6, 3, 1)
    assert overview["missing_share"] == pytest.approx(0.25)
    patterns = {tuple(r)[:2]: r["n"] for r in P.missing_patterns(df).collect()}
    assert patterns == {(False, False): 3, (False, True): 1, (True, False): 2}
    empty = P.profile_overview(df.filter("false")).first()
    assert empty["n_rows"] == 0 and empty["missing_share"] is None


def test_moments_match_pandas_definitions(frame):
    df, pdf = frame
    for r in P.profile_moments(df).collect():
        s = pdf[r["column"]].dropna()
        z = (s - s.mean()) / s.std(ddof=0)
        assert r["n"] == len(s) and r["variance"] == pytest.approx(s.var())
        assert r["skewness"] == pytest.approx((z**3).mean())
        assert r["kurtosis"] == pytest.approx((z**4).mean() - 3)


def test_histogram_matches_numpy(frame, spark):
    df, pdf = frame
    s = pdf["b"].dropna()
    counts, edges = np.histogram(s, bins=7)
    found = P.profile_histogram(df, "b", 7).orderBy("bin").collect()
    assert [r["n"] for r in found] == list(counts)
    assert [r["bin_start"] for r in found] == pytest.approx(list(edges[:-1]))
    assert [r["bin_end"] for r in found] == pytest.approx(list(edges[1:]))
    inside = P.profile_histogram(df, "b", 4, (-10, 10)).collect()
    assert sum(r["n"] for r in inside) == ((s >= -10) & (s <= 10)).sum()
    same = spark.createDataFrame([(3.0,), (3.0,), (INF,), (NAN,)], "v double")
    assert [r["n"] for r in P.profile_histogram(same, "v", 3).orderBy("bin").collect()] == [2, 0, 0]
    assert P.profile_histogram(same.filter("false"), "v", 3).collect() == []


def test_types(spark):
    df = spark.createDataFrame(
        [("a", True, 1, "x"), ("b", False, 2, "x"), ("c", True, 3, "y")],
        "t string, f boolean, n int, two string",
    )
    kinds = {r["column"]: r["kind"] for r in P.profile_types(df).collect()}
    assert kinds == {"t": "categorical", "f": "boolean", "n": "numeric", "two": "boolean"}
    few = P.profile_types(df, categorical_at_most=2).collect()
    assert few[0]["kind"] == "text"


def test_top_and_extreme_values(spark):
    df = spark.createDataFrame([(v,) for v in [3, 3, 1, 1, 2, None, 9]], "v int")
    assert [tuple(r) for r in P.top_values(df, "v", 3).collect()] == [(1, 2), (3, 2), (None, 1)]
    extremes = {tuple(r) for r in P.extreme_values(df, "v", 2).collect()}
    assert extremes == {("min", 1, 2), ("min", 2, 1), ("max", 9, 1), ("max", 3, 2)}


def test_top_and_extreme_values_by_column(frame):
    df, pdf = frame
    top = {(r["column"], r["value"]): r["n"] for r in
           P.top_values_by_column(df, ["b", "c"], 3).collect()}
    assert len(top) == 6
    for c in "bc":
        assert top[c, "7.0"] == (pdf[c] == 7.0).sum()
    extremes = P.extreme_values_by_column(df, ["a", "b"], 4).collect()
    for c in "ab":
        counts = pdf[c].dropna().value_counts().sort_index()
        for side, wanted in (("min", counts.head(4)), ("max", counts.tail(4))):
            found = {r["value"]: r["n"] for r in extremes if (r["column"], r["side"]) == (c, side)}
            assert found == wanted.to_dict()


def test_text_lengths_count_characters(spark):
    df = spark.createDataFrame([("да",), ("",), (None,)], "t string")
    assert tuple(P.profile_text_lengths(df).first()) == ("t", 0, 1.0, 2)


def test_alerts(spark):
    rows = [(i, float(i), float(2 * i), 0 if i % 2 else i, f"t{i}", "k", None) for i in range(100)]
    df = spark.createDataFrame(
        rows, "id int, x double, y double, z int, t string, k string, gone string"
    )
    found = {(r["column"], r["other"], r["alert"]) for r in P.profile_alerts(df, approx=False).collect()}
    assert {("id", None, "unique"), ("t", None, "high_cardinality"), ("k", None, "constant"),
            ("gone", None, "missing"), ("z", None, "zeros"), ("x", "y", "correlated")} <= found
    assert ("x", "z", "correlated") not in found
    limits = P.AlertThresholds(correlation=2.0, missing_share=1.0, zero_share=1.0, cardinality=1000)
    quiet = {r["alert"] for r in P.profile_alerts(df, limits).collect()}
    assert quiet == {"constant", "unique"}


def test_head_and_tail(spark):
    df = spark.createDataFrame([(2,), (1,), (3,)], "v int")
    assert [r["v"] for r in P.head_rows(df, 2, ["v"]).collect()] == [1, 2]
    assert [r["v"] for r in P.tail_rows(df, 2, ["v"]).collect()] == [3, 2]


def test_exact_quantiles_descend_into_wanted_ranges_alone(spark, monkeypatch):
    """Few ranges a round and few rows a range: the result is numpy's, the driver's numbers don't follow the rows."""
    import numpy as np
    from pyspark.sql import functions as F

    from starloom.operators import ranks

    monkeypatch.setattr(ranks, "RANGES", 8)
    monkeypatch.setattr(ranks, "ROWS_PER_RANGE", 50)
    cuts = []
    with_ranges = ranks._with_ranges
    monkeypatch.setattr(ranks, "_with_ranges", lambda df, s: cuts.append(sum(map(len, s))) or with_ranges(df, s))
    probs = [0, 0.05, 0.5, 0.95, 1]
    held = []
    for n in (2_000, 30_000):
        hot = F.when(F.col("id") % 3 > 0, F.lit(7.0)).otherwise(F.rand(1) * 100)
        df = spark.range(n).select(F.rand(5).alias("a"), hot.alias("hot"), F.lit(1.0).alias("same"))
        found = ranks.exact_quantiles(df, df.columns, probs)
        rows = np.array(df.collect())
        for k in range(3):
            assert found[k] == pytest.approx(list(np.quantile(rows[:, k], probs)))
        held.append((len(cuts), max(cuts)))
        cuts.clear()
    assert held[1][0] <= held[0][0] + 3 and held[1][1] <= 2 * held[0][1] + 100


def test_histogram_tells_of_columns_without_a_value_inside(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0, inf, None), (2.0, -inf, None), (50.0, inf, None)], "a double, b double, c double")
    rows = {(r.column, r.bin): (r.bin_start, r.n, r.n_out) for r in P.profile_histograms(df, bins=2).collect()}
    assert rows == {("a", 1): (1.0, 2, 0), ("a", 2): (25.5, 1, 0), ("b", None): (None, 0, 3)}
    bounded = {(r.column, r.bin): (r.n, r.n_out) for r in P.profile_histograms(df, bins=2, bounds=(60.0, 80.0)).collect()}
    assert bounded == {("a", 1): (0, 3), ("a", 2): (0, 3), ("b", 1): (0, 3), ("b", 2): (0, 3)}


def test_duplicates_by_digest(spark):
    rows = [
        ("a", None, 0.0), ("a", None, -0.0), (None, "a", 0.0), ("ab", "c", 1.0), ("a", "bc", 1.0), ("a", "bc", math.nan),
        ("a", "bc", math.nan), (None, None, None), (None, None, None), (None, None, None), ("", None, None), ("x", "y", 2.0),
    ]
    df = spark.createDataFrame(rows, "x string, y string, v double").repartition(4)
    assert tuple(duplicate_report(df).first()) == (12, 8, 4)
    found = {(r["x"], r["y"]): r["n"] for r in duplicate_rows(df).collect()}
    assert found == {("a", None): 2, ("a", "bc"): 2, (None, None): 3}
    first = [(r["x"], r["y"], r["n"]) for r in duplicate_rows(df, 2).collect()]
    assert first == [(None, None, 3), ("a", None, 2)]
    assert duplicate_rows(df.limit(0), 2).count() == duplicate_rows(df.limit(0)).count() == 0
    over = P.profile_overview(df).first()
    missing = sum(v is None or v != v for r in rows for v in r)
    assert (over["n_rows"], over["missing_cells"], over["duplicate_rows"]) == (12, missing, 4)


@pytest.mark.parametrize("kind", ["string", "long", "decimal(12,2)", "date", "binary", "boolean"])
def test_frequent_values_are_those_of_a_whole_count(spark, kind):
    from starloom.operators.frequent import frequent_values
    from starloom.operators.profile import top_values

    # A value in a third of the rows, some in a few per cent, a long tail, and nulls.
    hot = F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 20 = 1 THEN id % 5 WHEN id % 50 = 2 THEN NULL ELSE id END")
    df = spark.range(0, 60_000, 1, 7).select(hot.alias("v"))
    if kind == "boolean":
        df = df.select((F.col("v") % 2 == 0).alias("v"))
    elif kind == "date":
        df = df.select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("v").cast("int")).alias("v"))
    else:
        df = df.select(F.col("v").cast("string").cast(kind).alias("v"))
    for n, capacity in ((1, 32), (4, 64), (6, 1000), (40, 100)):
        assert frequent_values(df, "v", n, capacity).collect() == top_values(df, "v", n).collect()
    assert frequent_values(df.limit(0), "v", 3).collect() == []
    some = df.limit(1)
    assert frequent_values(some, "v", 3).collect() == top_values(some, "v", 3).collect()


def test_frequent_values_shuffle_summaries_alone(spark):
    """Rows shuffled follow tasks and capacity, not distinct values; bounds hold for every value."""
    from starloom.operators.frequent import summaries

    df = spark.range(0, 200_000, 1, 4).select(F.expr("CASE WHEN id % 4 = 0 THEN id % 16 ELSE id END").alias("v"))
    rows = summaries(df, "v", 100).collect()
    assert len(rows) <= 4 * 101
    taken = sum(r["taken"] for r in rows)
    held = {}
    for r in rows:
        if r["present"]:
            held[r["value"]] = held.get(r["value"], 0) + r["n"]
    exact = {r["v"]: r["n"] for r in df.groupBy("v").agg(F.count("*").alias("n")).collect()}
    assert all(held.get(v, 0) <= n <= held.get(v, 0) + taken for v, n in exact.items())
    assert taken <= 200_000 / 100 + 4
