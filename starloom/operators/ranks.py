"""Exact order statistics over whole columns without bringing one to a single task.

A window without partitions sorts everything in one task, and Spark's exact ``percentile``
holds all distinct values in one buffer. Here the number line is cut into ranges of similar
size. Counting rows per range needs next to no shuffle, and the counts, a few thousand numbers,
say which range holds a wanted row; only the values of those ranges are then sorted. Ranks of
all values come from a window per range. The split points between ranges need not be exact: the
result is the same for any of them.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from starloom.functions.columns import col
from starloom.session import scratch_path

# Rows of a range that is sorted, at most, unless they share few values.
ROWS_PER_RANGE = 1_000_000
# Where all ranks are wanted, the number of ranges follows the number of rows.
LEAST_RANGES = 64
# Where single rows are wanted, ranges that a round cuts a column, or a range of one, into.
RANGES = 256
# Ranks of frequent values that every task holds for rank correlation.
FREQUENT_RANKS = 20_000


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles named v0, v1, ..., NaN as null, one zero for both."""
    values = [col(c).cast("double") for c in columns]
    return df.select(
        *[F.when(v == 0, 0.0).when(~F.isnan(v), v).alias(f"v{i}") for i, v in enumerate(values)]
    )


def _split_points(numbers: DataFrame) -> list[list[float]]:
    """Finite split points of every column, from one pass over the data (this is an action)."""
    return _cut(numbers, max(LEAST_RANGES, -(-numbers.count() // ROWS_PER_RANGE)))


def _cut(numbers: DataFrame, parts: int) -> list[list[float]]:
    """Finite points that cut every column into ``parts`` ranges of similar size, fewer if it has few values."""
    quantiles = numbers.approxQuantile(
        numbers.columns, [i / parts for i in range(1, parts)], 1 / (4 * parts)
    )
    infinities = (float("inf"), float("-inf"))
    return [sorted({q for q in qs if q not in infinities}) or [0.0] for qs in quantiles]


def _with_ranges(numbers: DataFrame, splits: Sequence[Sequence[float]]) -> DataFrame:
    """Add r0, r1, ...: which range of its column each value lies in."""
    for i, points in enumerate(splits):
        edges = [float("-inf"), *points, float("inf")]
        numbers = Bucketizer(
            splits=edges, inputCol=f"v{i}", outputCol=f"r{i}", handleInvalid="keep"
        ).transform(numbers)
    return numbers


def _positions(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """From (keys, range, value, n): add n_before, the rows with smaller values under the same
    keys, and total, all rows under them."""
    totals = counts.groupBy(*keys, "range").agg(F.sum("n").alias("__in_range"))
    whole, inside = Window.partitionBy(*keys), Window.partitionBy(*keys, "range").orderBy("value")
    offsets = totals.select(
        *keys,
        "range",
        (F.sum("__in_range").over(whole.orderBy("range")) - F.col("__in_range")).alias("__offset"),
        F.sum("__in_range").over(whole).alias("total"),
    )
    before = F.sum("n").over(inside) - F.col("n")
    return (
        counts.withColumn("__before", before)
        .join(offsets, [*keys, "range"])
        .withColumn("n_before", F.col("__before") + F.col("__offset"))
        .select(*keys, "value", "n", "n_before", "total")
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    splits: Sequence[Sequence[float]] | None = None,
) -> list[list[float | None]]:
    """Per column its quantiles, interpolated between neighbouring rows; nulls and NaN are left
    out, a column without values gives None.

    Runs when called, as ``DataFrame.approxQuantile`` does. A round cuts the columns into RANGES
    ranges each (unless ``splits`` are given) and counts rows per range; ranges that hold a wanted
    row and more than ROWS_PER_RANGE rows are cut again in the next round. So the driver holds some
    thousand numbers per column and probability however many rows there are, and rounds follow their
    logarithm. Only the values of the few ranges with a wanted row are then sorted. Copies of a value
    are counted before they are shuffled.
    """
    numbers = _numbers(df, columns)
    splits = splits or _cut(numbers, RANGES)
    while True:
        ranged = _with_ranges(numbers, splits)
        totals = _range_totals(ranged, len(columns))
        positions = {
            c: [p * (sum(n for _, n in ranges) - 1) for p in probs] for c, ranges in totals.items()
        }
        targets = _targets(totals, positions)
        finer = _cut_again(ranged, totals, targets, splits)
        if finer is None:
            break
        splits = finer
    found = _values_at(ranged, targets)
    return [
        [_interpolate(c, position, found) for position in positions.get(c, [])]
        or [None] * len(probs)
        for c in range(len(columns))
    ]


def _cut_again(
    ranged: DataFrame,
    totals: dict[int, list[tuple[int, int]]],
    targets: list[tuple[int, int, float, int]],
    splits: Sequence[Sequence[float]],
) -> list[list[float]] | None:
    """The split points and more of them inside the wanted ranges of too many rows; None if none can be added."""
    sizes = {(c, r): n for c, ranges in totals.items() for r, n in ranges}
    wide = sorted({(c, int(r)) for c, _, r, _ in targets if sizes[c, int(r)] > ROWS_PER_RANGE})
    if not wide:
        return None
    inside = [F.when(F.col(f"r{c}") == r, F.col(f"v{c}")).alias(f"v{k}") for k, (c, r) in enumerate(wide)]
    result = [set(points) for points in splits]
    for (c, _), points in zip(wide, _cut(ranged.select(*inside), RANGES)):
        result[c].update(points)
    # A range of one value, or of few others beside it, has nothing to be cut at.
    grown = any(len(new) > len(old) for new, old in zip(result, splits))
    return [sorted(points) for points in result] if grown else None


def _range_totals(ranged: DataFrame, columns: int) -> dict[int, list[tuple[int, int]]]:
    """Per column number (range, rows) in order."""
    long = ranged.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("c"),
                        F.when(F.col(f"v{i}").isNotNull(), F.col(f"r{i}")).alias("range"),
                    )
                    for i in range(columns)
                ]
            )
        )
    )
    totals: dict[int, list[tuple[int, int]]] = {}
    for row in long.filter("range IS NOT NULL").groupBy("c", "range").count().collect():
        totals.setdefault(row["c"], []).append((int(row["range"]), row["count"]))
    return {c: sorted(ranges) for c, ranges in totals.items()}


def _targets(
    totals: dict[int, list[tuple[int, int]]], positions: dict[int, list[float]]
) -> list[tuple[int, int, float, int]]:
    """The wanted rows as (column, row, range, row within the range)."""
    result = []
    for c, ranges in totals.items():
        ends = list(accumulate(n for _, n in ranges))
        for row in {f(x) for x in positions[c] for f in (math.floor, math.ceil)}:
            at = bisect_right(ends, row)
            start = ends[at - 1] if at else 0
            result.append((c, row, float(ranges[at][0]), row - start))
    return result


def _values_at(
    ranged: DataFrame, targets: list[tuple[int, int, float, int]]
) -> dict[tuple[int, int], float]:
    """{(column, row): value} for the wanted rows, sorting only the ranges that hold one."""
    if not targets:
        return {}
    cells = []
    for c in sorted({target[0] for target in targets}):
        ranges = sorted({target[2] for target in targets if target[0] == c})
        cell = F.struct(
            F.lit(c).alias("c"), F.col(f"r{c}").alias("range"), F.col(f"v{c}").alias("value")
        )
        cells.append(F.when(F.col(f"v{c}").isNotNull() & F.col(f"r{c}").isin(ranges), cell))
    counts = (
        ranged.select(F.inline(F.array(*cells)))
        .filter("c IS NOT NULL")
        .groupBy("c", "range", "value")
        .agg(F.count("*").alias("n"))
    )
    in_order = Window.partitionBy("c", "range").orderBy("value")
    placed = counts.withColumn("before", F.sum("n").over(in_order) - F.col("n"))
    # Two rows per column and probability, at most.
    wanted = ranged.sparkSession.createDataFrame(
        targets, "column int, row long, in_range double, place long"
    )
    here = (F.col("c") == F.col("column")) & (F.col("range") == F.col("in_range"))
    hit = "before <= place AND place < before + n"
    found = placed.join(F.broadcast(wanted), here).filter(hit).select("c", "row", "value")
    return {(c, row): value for c, row, value in found.collect()}


def _interpolate(c: int, position: float, values: dict[tuple[int, int], float]) -> float:
    below = math.floor(position)
    low, high = values[c, below], values[c, math.ceil(position)]
    share = position - below
    if low == high or share == 0:
        return low
    # Between an infinity and a number the infinity counts, as it would at any share but 0.
    if math.isinf(low):
        return low if not math.isinf(high) else math.nan
    return low + (high - low) * share


def quantiles_and_mad(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> list[tuple[list[float | None], float | None]]:
    """Per column its exact quantiles and its median absolute deviation.

    A deviation range is cut where a value range is, so it covers two of them at most and needs
    no split points of its own.
    """
    numbers = _numbers(df, columns)
    splits = _cut(numbers, RANGES)
    found = exact_quantiles(numbers, numbers.columns, [*probs, 0.5], splits)
    medians = [quantiles[-1] for quantiles in found]
    deviations = numbers.select(
        *[
            F.abs(F.col(f"v{i}") - F.lit(m).cast("double")).alias(f"v{i}")
            for i, m in enumerate(medians)
        ]
    )
    # Deviations from an infinite median are infinite or not a number; any cut does for them.
    centres = [m if m is not None and math.isfinite(m) else 0.0 for m in medians]
    cuts = [sorted({abs(s - m) for s in points}) for points, m in zip(splits, centres)]
    mads = exact_quantiles(deviations, numbers.columns, [0.5], cuts)
    return [(quantiles[:-1], mad[0]) for quantiles, mad in zip(found, mads)]


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (pair, r): the correlation of every pair of columns, by the pair's number.

    Each task adds up all its pairs at once as matrix products, so that a wide table costs no
    expression per pair; one small grouping by pair adds the tasks' sums. Values are taken
    relative to their column's mean, which keeps the sums exact enough.
    """
    numbers = _numbers(df, columns)
    k = len(columns)
    found = numbers.agg(*[F.avg(c) for c in numbers.columns]).first()
    means = [m if m is not None and math.isfinite(m) else 0.0 for m in found]
    rows, cols = np.triu_indices(k, 1)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, k, k))
        for batch in batches:
            for part in (batch.slice(at, 10_000) for at in range(0, batch.num_rows, 10_000)):
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in part.columns], 1).astype(float)
                here = (~np.isnan(x)).astype(float)
                with np.errstate(invalid="ignore"):
                    x = np.where(here > 0, x - means, 0.0)
                    square = x * x
                    # Per pair: rows, sums and squares of either side where the other is present, products.
                    total += [here.T @ here, x.T @ here, here.T @ x, square.T @ here, here.T @ square, x.T @ x]
        numbered = pa.array(np.arange(len(rows), dtype=np.int32))
        yield pa.record_batch([numbered, *(pa.array(t[rows, cols]) for t in total)], names)

    names = ["pair", "n", "x", "y", "xx", "yy", "xy"]
    found = numbers.mapInArrow(sums, "pair int, n double, x double, y double, xx double, yy double, xy double")
    total = found.groupBy("pair").agg(*[F.sum(c).alias(c) for c in names[1:]]).filter("n > 0")
    n, x, y = F.col("n"), F.col("x"), F.col("y")
    spread = F.sqrt((n * F.col("xx") - x * x) * (n * F.col("yy") - y * y))
    return total.select("pair", F.try_divide(n * F.col("xy") - x * y, spread).alias("r"))


def spearman(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (pair, r): for every pair of columns, by its number, the correlation of average ranks
    over the rows where both values are present.

    A value has as many ranks as there are sets of rows in which other columns are present: among
    the rows of each such set. They all come from one count of (column, value, set), whose prefix
    sums follow the order of the values. The most frequent values, a bounded number, are looked up by
    every task in a small table; only cells of other values are shuffled, to be joined with their
    ranks and to go back to their rows. So jobs and plan are the same for any number of columns and
    any pattern of missing values, and a hot value meets in no task. Ranks are taken relative to
    their mean, and each task adds up all pairs with numpy. Rows get a number and are stored first,
    as cells go back to their rows by it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "spearman-rows")
    _numbers(df, columns).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    numbers = spark.read.parquet(path)
    k = len(columns)
    names = [f"v{i}" for i in range(k)]
    # Columns missing in the same rows: equal sums of a hash of the rows' present values.
    sums = numbers.agg(
        *[F.struct(F.count(v), F.bit_xor(F.when(F.col(v).isNotNull(), F.xxhash64("row")))) for v in names]
    ).first()
    sets = list(dict.fromkeys(tuple(mark) for mark in sums))
    set_of = [sets.index(tuple(mark)) for mark in sums]
    splits = _split_points(numbers.select(*names))
    cell = [F.struct(F.lit(i).alias("c"), F.col(f"r{i}").alias("range"), F.col(v).alias("value")) for i, v in enumerate(names)]
    shown = [F.when(F.col(names[set_of.index(g)]).isNotNull(), F.lit(g)) for g in range(len(sets))]
    cells = (
        _with_ranges(numbers, splits)
        .select("row", F.filter(F.array(*shown), lambda g: g.isNotNull()).alias("sets"), F.explode(F.array(*cell)).alias("cell"))
        .select("row", "sets", "cell.*")
        .filter("value IS NOT NULL")
    )
    counts = cells.select("c", "range", "value", F.explode("sets").alias("g")).groupBy("c", "g", "range", "value").agg(
        F.count("*").alias("n")
    )
    # (n_before + (n + 1) / 2) less the mean of all ranks, (total + 1) / 2.
    rank = F.col("n_before") + (F.col("n") - F.col("total")) / F.lit(2.0)
    ranks_path = scratch_path(spark, "spearman-ranks")
    _positions(counts, ["c", "g"]).groupBy("c", "value").agg(
        F.collect_list(F.struct("g", rank.alias("rank"))).alias("ranks"), F.max("n").alias("n")
    ).write.parquet(ranks_path)
    ranks = spark.read.parquet(ranks_path)
    tables = _frequent_ranks(ranks, k, len(sets))
    left, right = np.triu_indices(k, 1)
    out = ["pair", "n", "xx", "yy", "xy"]
    step = max(1, 2_000_000 // (k * k))

    def looked_up(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranks by row, column and set; which cells are present; which of them the tables lack."""
        here = ~np.isnan(values)
        x, rare = np.zeros((*values.shape, len(sets))), here.copy()
        for c, (known, rank) in enumerate(tables):
            if len(known):
                at = np.minimum(np.searchsorted(known, values[:, c]), len(known) - 1)
                hit = known[at] == values[:, c]
                x[hit, c], rare[hit, c] = rank[at[hit]], False
        return x, here, rare

    def pair_sums(x: np.ndarray, here: np.ndarray) -> np.ndarray:
        here = here.astype(float)
        # Per column of the first axis its rank among the rows where that of the second is present.
        x = x[:, :, set_of] * here[:, :, None] * here[:, None, :]
        square = np.einsum("rij,rij->ij", x, x)
        return np.stack([here.T @ here, square, square.T, np.einsum("rij,rji->ij", x, x)])

    def as_rows(total: np.ndarray) -> pa.RecordBatch:
        numbered = pa.array(np.arange(len(left), dtype=np.int32))
        return pa.record_batch([numbered, *(pa.array(t[left, right]) for t in total)], out)

    def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        for batch in batches:
            for part in (batch.slice(at, step) for at in range(0, batch.num_rows, step)):
                yield part, np.stack([c.to_numpy(zero_copy_only=False) for c in part.columns[:k]], 1).astype(float)

    def of_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sums over rows of frequent values alone."""
        total = np.zeros((4, k, k))
        for _, values in parts_of(batches):
            x, here, rare = looked_up(values)
            whole = ~rare.any(1)
            total += pair_sums(x[whole], here[whole])
        yield as_rows(total)

    def rare_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The cells that the tables lack; the first of a row brings all values of the row."""
        for part, values in parts_of(batches):
            row, c = np.nonzero(looked_up(values)[2])
            first = np.concatenate([[True], row[1:] != row[:-1]])[: len(row)]
            ends = np.concatenate([[0], np.cumsum(np.where(first, k, 0))]).astype(np.int32)
            brought = pa.ListArray.from_arrays(pa.array(ends), pa.array(values[row[first]].ravel()))
            number = part.column(k).to_numpy()[row]
            yield pa.record_batch(
                [pa.array(number), pa.array(c.astype(np.int32)), pa.array(values[row, c]), brought], ["row", "c", "value", "values"]
            )

    def of_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sums over rows with other values."""
        total = np.zeros((4, k, k))
        for batch in batches:
            for part in (batch.slice(at, step) for at in range(0, batch.num_rows, step)):
                x, here, _ = looked_up(part.column(1).flatten().to_numpy().reshape(-1, k))
                cell = part.column(0).flatten()
                row = np.repeat(np.arange(part.num_rows), pc.list_value_length(part.column(0)))
                c, found = pc.struct_field(cell, "c").to_numpy(), pc.struct_field(cell, "ranks")
                each, length = found.flatten(), pc.list_value_length(found).to_numpy()
                at = np.repeat(row, length), np.repeat(c, length), pc.struct_field(each, "g").to_numpy()
                x[at] = pc.struct_field(each, "rank").to_numpy()
                total += pair_sums(x, here)
        yield as_rows(total)

    rows = (
        numbers.select(*names, "row")
        .mapInArrow(rare_cells, "row long, c int, value double, values array<double>")
        .join(ranks.drop("n"), ["c", "value"])
        .groupBy("row")
        .agg(F.collect_list(F.struct("c", "ranks")).alias("cells"), F.flatten(F.collect_list("values")).alias("values"))
        .select("cells", "values")
    )
    schema = "pair int, n double, xx double, yy double, xy double"
    found = numbers.select(*names).mapInArrow(of_frequent, schema).unionByName(rows.mapInArrow(of_joined, schema))
    total = found.groupBy("pair").agg(*[F.sum(c).alias(c) for c in out[1:]]).filter("n > 0")
    return total.select("pair", F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy"))).alias("r"))


def _frequent_ranks(ranks: DataFrame, columns: int, sets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per column the most frequent values in order, and their ranks by set; FREQUENT_RANKS ranks at most."""
    found = ranks.orderBy(F.desc("n"), "c", "value").limit(max(1, FREQUENT_RANKS // sets)).collect()
    by_column: list[list] = [[] for _ in range(columns)]
    for r in sorted(found, key=lambda r: r["value"]):
        by_column[r["c"]].append(r)
    tables = []
    for own in by_column:
        table = np.zeros((len(own), sets))
        for i, r in enumerate(own):
            for each in r["ranks"]:
                table[i, each["g"]] = each["rank"]
        tables.append((np.array([r["value"] for r in own], float), table))
    return tables


def approximate_ranks(df: DataFrame, columns: Sequence[str], parts: int = 1000) -> DataFrame:
    """The columns with approximate average ranks, as shares from 0 to 1, in place of values.

    Every column is cut into some ``parts`` ranges; a value's rank is the middle one of its range,
    looked up for each row, so no row is shuffled. A share is off by 1 / ``parts`` at most, by
    nothing for columns of fewer distinct values.
    """
    numbers = _numbers(df, columns)
    splits = _cut(numbers, parts)
    ranged = _with_ranges(numbers, splits)
    totals = _range_totals(ranged, len(columns))
    ranked = []
    for i, name in enumerate(columns):
        counts, before, middles = dict(totals.get(i, [])), 0, []
        whole = sum(counts.values())
        for r in range(len(splits[i]) + 1):
            n = counts.get(r, 0)
            middles.append((before + n / 2) / whole if whole else 0.0)
            before += n
        rank = F.get(F.lit(middles), F.col(f"r{i}").cast("int"))
        ranked.append(F.when(F.col(f"v{i}").isNotNull(), rank).alias(name))
    return ranged.select(*ranked)
