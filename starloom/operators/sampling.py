from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.functions.columns import col


# Leading hexadecimal digits of a rank by which keys are counted: 65,536 counts at most.
DIGITS = 4


def ranked_keys(df: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    """The distinct keys (__key, __rank) that can be among the first ``k`` by rank, few others."""
    rank = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("__key").cast("string")))
    distinct = df.select(col(key).alias("__key")).distinct().withColumn("__rank", rank)
    counts = distinct.groupBy(F.substring("__rank", 1, DIGITS).alias("head")).count()
    found, last = 0, None
    for row in sorted(counts.collect()):
        if found >= k:
            break
        found, last = found + row["count"], row["head"]
    if last is None:
        return distinct.limit(0)
    return distinct.filter(F.substring("__rank", 1, DIGITS) <= last)


def sample_by_key(
    df: DataFrame, key: str, k: int, seed: int = 0, strict: bool = False
) -> DataFrame:
    """All rows of ``k`` distinct key values, chosen by seed.

    Keys are ranked by the md5 of seed and key, so the choice depends on the data alone and not
    on partitioning or task retries. A null key can be chosen like any other. If there are fewer
    than ``k`` keys all rows are kept, or with ``strict`` an error is raised.

    Keys are first counted per leading digits of their rank, and only those up to the digits that
    hold the k-th are ordered, so that little more than ``k`` keys meet in the last merge. Runs a
    job when called. Spark knows from the limit that the chosen keys are few and broadcasts them
    when ``k`` is small enough for its threshold, so the rows themselves need not be shuffled.
    """
    keys = ranked_keys(df, key, k, seed).orderBy("__rank", "__key").limit(k).select("__key")
    if strict:
        found = keys.count()
        if found < k:
            raise ValueError(f"asked for {k} distinct values of {key}, found {found}")
    return df.join(keys, col(key).eqNullSafe(F.col("__key")), "left_semi")
