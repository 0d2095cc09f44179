"""Approximate nearest neighbours: one navigable small-world graph per shard, results merged.

Vectors are lifted by one component to equal length, so that the greatest inner product is the
nearest vector and the graph's geometry is sound. A shard holds vectors of one band of lengths, each
band twice as long as the one before, and lifts them to its own longest: a vector far longer than
the others changes nothing in their shards. A shard's graph is kept as rows with flat
neighbour arrays: for every node its neighbours on the ground level, then on each upper level.
Many insertions and searches walk the graph in step, so that numpy does the work.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import light, stored


#: Tasks of one exchange at most.
MOST_TASKS = 20_000


@dataclass(frozen=True)
class Params:
    """Neighbours per upper level (twice as many on the ground), width of searches, batch sizes.

    A block of queries holds ``block_rows`` at most, and ``block_bytes`` of components or so.
    """

    links: int = 16
    build_width: int = 64
    search_width: int = 96
    batch: int = 256
    shard_rows: int = 8192
    block_rows: int = 16384
    block_bytes: int = 1 << 25


class Graph:
    """A shard's graph: vectors, and per level an array (nodes, links) of neighbours, -1 where empty."""

    def __init__(self, x: np.ndarray, params: Params, levels: np.ndarray):
        self.x, self.params, self.levels = x, params, levels
        self.top = int(levels.max()) if len(levels) else 0
        self.near = [np.full((len(x), params.links * (1 if level else 2)), -1, np.int32) for level in range(self.top + 1)]
        self.entry = int(np.argmax(levels)) if len(levels) else -1

    def search(
        self, q: np.ndarray, level: int, starts: np.ndarray, width: int, step: int = 4
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` most similar nodes found from ``starts`` (a row per query): nodes, similarities.

        In every round each query opens its ``step`` best unopened nodes. Empty places are -1.
        """
        n, near = len(q), self.near[level]
        rows = np.arange(n)[:, None]
        seen = np.zeros((n, len(self.x) + 1), bool)  # the last column stands for -1
        seen[:, -1] = True
        nodes = np.full((n, width), -1, np.int32)
        sims = np.full((n, width), -np.inf, np.float32)
        opened = np.ones((n, width), bool)
        k = min(starts.shape[1], width)
        nodes[:, :k] = starts[:, :k]
        valid = nodes[:, :k] >= 0
        sims[:, :k] = np.where(valid, np.einsum("nkd,nd->nk", self.x[nodes[:, :k]], q), -np.inf)
        opened[:, :k] = ~valid
        seen[rows, nodes[:, :k]] = True
        live = np.arange(n)
        while len(live):
            s = np.where(opened[live], -np.inf, sims[live])
            best = np.argpartition(-s, step - 1, axis=1)[:, :step] if step < width else np.argsort(-s, axis=1)
            fresh = np.take_along_axis(s, best, 1) > -np.inf
            going = fresh.any(1)
            live, best, fresh = live[going], best[going], fresh[going]
            if not len(live):
                break
            opened[live[:, None], best] = True
            at = np.where(fresh, nodes[live[:, None], best], -1)
            found = np.where(at[:, :, None] >= 0, near[at], -1).reshape(len(live), -1)
            found = np.sort(found, axis=1)
            found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
            found[seen[live[:, None], found]] = -1
            keep = found >= 0
            seen[live[:, None], found] = True
            found_sims = np.full(found.shape, -np.inf, np.float32)
            r, c = np.nonzero(keep)
            found_sims[r, c] = np.einsum("md,md->m", self.x[found[r, c]], q[live[r]])
            all_sims = np.concatenate([sims[live], found_sims], 1)
            order = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            sims[live] = np.take_along_axis(all_sims, order, 1)
            nodes[live] = np.take_along_axis(np.concatenate([nodes[live], found], 1), order, 1)
            opened[live] = np.take_along_axis(np.concatenate([opened[live], ~keep], 1), order, 1)
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(nodes, order, 1), np.take_along_axis(sims, order, 1)

    def descend(self, q: np.ndarray, to: int, top: int, entry: int) -> np.ndarray:
        """The entry for level ``to``: greedy walks through the levels above it."""
        starts = np.full((len(q), 1), entry, np.int32)
        for level in range(top, to, -1):
            starts = self.search(q, level, starts, 4)[0][:, :1]
        return starts

    def diverse(self, sims: np.ndarray, nodes: np.ndarray, count: int) -> np.ndarray:
        """Of the nodes, best first, those nearer to the query than to any taken before; filled up with the rest."""
        nodes, sims = nodes[nodes >= 0], sims[nodes >= 0]
        if len(nodes) <= count:
            return nodes
        between = self.x[nodes] @ self.x[nodes].T
        shadow = np.full(len(nodes), -np.inf, np.float32)
        taken = np.zeros(len(nodes), bool)
        for i in range(len(nodes)):
            if sims[i] > shadow[i]:
                taken[i] = True
                np.maximum(shadow, between[i], out=shadow)
                if taken.sum() == count:
                    break
        out = np.concatenate([np.flatnonzero(taken), np.flatnonzero(~taken)])[:count]
        return nodes[out]

    def link(self, level: int, node: int, nodes: np.ndarray, sims: np.ndarray) -> None:
        """Join a node to diverse ones of its candidates, both ways; full lists are thinned the same way."""
        near = self.near[level]
        chosen = self.diverse(sims, nodes, self.params.links)
        near[node, : len(chosen)] = chosen
        for other in chosen:
            row = near[other]
            if node in row:
                continue
            free = np.flatnonzero(row < 0)
            if len(free):
                row[free[0]] = node
                continue
            every = np.append(row, np.int32(node))
            s = self.x[every] @ self.x[other]
            order = np.argsort(-s, kind="stable")
            row[:] = self.diverse(s[order], every[order], len(row))

    def build(self) -> None:
        """Insert all nodes, in growing batches whose members also see one another."""
        n, width = len(self.x), self.params.build_width
        # Higher levels first: upper graphs are whole before the many ground nodes come.
        order = np.argsort(-self.levels, kind="stable")
        done = 1
        while done < n:
            batch = order[done : done + min(self.params.batch, done)]
            q, own = self.x[batch], self.levels[batch]
            mutual = q @ q.T
            starts = np.full((len(batch), 1), self.entry, np.int32)
            for level in range(self.top, -1, -1):
                deep = own >= level
                if level and not deep.any():
                    starts = self.search(q, level, starts, 4)[0][:, :1]
                    continue
                nodes, sims = self.search(q, level, starts, width)
                for i in np.flatnonzero(deep):
                    earlier = np.flatnonzero(deep[:i])
                    every = np.concatenate([nodes[i], batch[earlier].astype(np.int32)])
                    s = np.concatenate([sims[i], mutual[i, earlier]])
                    best = np.argsort(-s, kind="stable")[:width]
                    self.link(level, batch[i], every[best], s[best])
                starts = nodes[:, :8]
            done += len(batch)

    def flat(self, node: int) -> np.ndarray:
        """The node's neighbours on the ground level, then on each of its upper levels."""
        return np.concatenate([self.near[level][node] for level in range(self.levels[node] + 1)])


def restore(x: np.ndarray, levels: np.ndarray, flat: list[np.ndarray], params: Params) -> Graph:
    """The graph from its rows."""
    graph = Graph(x, params, levels)
    for node, row in enumerate(flat):
        at = 0
        for level in range(levels[node] + 1):
            width = graph.near[level].shape[1]
            graph.near[level][node] = row[at : at + width]
            at += width
    return graph


def draw_levels(ids: np.ndarray, params: Params) -> np.ndarray:
    """Levels from the ids' hashes: each level holds one in ``links`` of those below."""
    u = pd.util.hash_array(ids.astype(np.int64)).astype(np.float64) / 2.0**64
    return np.minimum(np.floor(-np.log(np.maximum(u, 1e-18)) / np.log(params.links)), 8).astype(np.int32)


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """The rows that take part (vec_id, v): no null id, no null, zero or non-finite vector."""
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.col("vec_id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)
    return embeddings.filter(fine).select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))


def build_index(embeddings: DataFrame, keep: int, params: Params = Params()) -> DataFrame:
    """The index: dim, band, shard, node, ids, v, scale, lift, level, neighbours.

    Equal vectors are one node; ``ids`` are its ``keep`` least ids, which are all that a search for
    that many can return. Nodes of a dimension and a band of lengths are dealt to shards by hash, so
    that shards hold ``shard_rows`` or so; a band of few vectors is one small shard. ``scale`` is the
    length of the band's longest vector, and graphs are built of vectors divided by it.
    """
    rows = valid_vectors(embeddings).distinct()
    least = Window.partitionBy("v").orderBy("vec_id")
    copies = rows.withColumn("_n", F.row_number().over(least)).filter(F.col("_n") <= keep)
    # Divided by the greatest component first, so that no square leaves the range of doubles.
    most = F.array_max(F.transform("v", F.abs))
    length = F.col("_most") * F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / F.col("_most")) ** 2))
    nodes = stored(
        copies.groupBy("v")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .withColumn("_most", most)
        .withColumn("length", F.least(length, F.lit(1.7e308)))
        .select("v", "ids", "length", F.size("v").alias("dim"), F.floor(F.log2("length")).cast("int").alias("band")),
        "ann-nodes",
    )
    # One row for each dimension and power of two that occurs.
    bands = nodes.groupBy("dim", "band").agg(
        F.max("length").alias("scale"), F.ceil(F.count("*") / params.shard_rows).alias("_shards")
    )
    dealt = nodes.join(bands, ["dim", "band"]).withColumn(
        "shard", F.pmod(F.xxhash64(F.col("ids")[0]), F.col("_shards")).cast("int")
    )

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(first=[ids[0] for ids in rows["ids"]]).sort_values("first", ignore_index=True)
        x = np.stack(rows["v"].to_numpy()).astype(np.float64) / rows["scale"].iat[0]
        lift = np.sqrt(np.maximum(1 - (x * x).sum(1, keepdims=True), 0))
        graph = Graph(np.hstack([x, lift]).astype(np.float32), params, draw_levels(rows["first"].to_numpy(), params))
        graph.build()
        return pd.DataFrame(
            {
                "dim": rows["dim"],
                "band": rows["band"],
                "shard": rows["shard"],
                "node": np.arange(len(rows), dtype=np.int32),
                "ids": rows["ids"],
                "v": rows["v"],
                "scale": rows["scale"],
                "lift": lift[:, 0],
                "level": graph.levels,
                "neighbours": [graph.flat(i) for i in range(len(rows))],
            }
        )

    schema = (
        "dim int, band int, shard int, node int, ids array<long>, v array<double>, scale double, lift double, "
        "level int, neighbours array<int>"
    )
    # As many tasks as shards, which adaptive execution would merge by bytes though they are long.
    shards = bands.agg(F.sum("_shards")).first()[0] or 1
    spread = dealt.repartition(min(shards, MOST_TASKS), "dim", "band", "shard")
    return stored(spread.groupBy("dim", "band", "shard").applyInPandas(build, schema), "ann-index")


def search_index(index: DataFrame, queries: DataFrame, k: int, params: Params = Params()) -> DataFrame:
    """Per query (vec_id, v) its ``k`` nearest found: query_id, rank, vec_id, score.

    Queries go in blocks to every shard of their dimension. A shard returns its k + 1 best nodes by
    exact inner product; the merged best are spread out to their ids, less the query's own. The
    index is read by as many tasks per shard as there are blocks.
    """
    asked = queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q")).withColumn("dim", F.size("q"))
    asked = stored(asked, "ann-queries")
    most = F.greatest(F.lit(1), F.least(F.lit(params.block_rows), F.floor(params.block_bytes / (8 * F.col("dim")))))
    blocks = asked.groupBy("dim").agg(F.ceil(F.count("*") / most).cast("int").alias("blocks"))
    # One row per shard, and one per dimension.
    shards = index.select(*[F.col(c).alias(c) for c in ("dim", "band", "shard")]).distinct()
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = index.join(light(blocks), "dim").withColumn("block", each).groupBy("dim", "band", "shard", "block")
    block = F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int")
    right = (
        asked.join(light(blocks), "dim")
        .select("query_id", "q", "dim", block.alias("block"))
        .join(light(shards), "dim")
        .groupBy("dim", "band", "shard", "block")
    )
    keep = k + 1

    def search(nodes: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        if not len(nodes) or not len(some):
            return pd.DataFrame({"query_id": [], "score": [], "ids": []}).astype({"ids": object})
        nodes = nodes.sort_values("node", ignore_index=True)
        x = np.stack(nodes["v"].to_numpy())
        lifted = np.hstack([x / nodes["scale"].iat[0], nodes[["lift"]].to_numpy()]).astype(np.float32)
        graph = restore(lifted, nodes["level"].to_numpy(), list(nodes["neighbours"]), params)
        least, ids = np.array([i[0] for i in nodes["ids"]]), nodes["ids"].to_numpy()
        out = []
        for part in np.array_split(np.arange(len(some)), max(1, -(-len(some) // params.batch))):
            q = np.stack(some["q"].to_numpy()[part])
            # A query's own length changes no order, so each is divided by its greatest component.
            lowered = np.hstack([q / np.abs(q).max(1, keepdims=True), np.zeros((len(q), 1))]).astype(np.float32)
            starts = graph.descend(lowered, 0, graph.top, graph.entry)
            found, _ = graph.search(lowered, 0, starts, max(params.search_width, 2 * keep))
            for i, row in zip(part, found, strict=True):
                row = row[row >= 0]
                score = (x[row] * q[i - part[0]]).sum(1)
                best = np.lexsort((least[row], -score))[:keep]
                out.append((some["query_id"].iat[i], score[best], ids[row[best]]))
        lengths = [len(s) for _, s, _ in out]
        return pd.DataFrame(
            {
                "query_id": np.repeat(np.array([q for q, _, _ in out]), lengths),
                "score": np.concatenate([s for _, s, _ in out]),
                "ids": [list(i) for _, _, some_ids in out for i in some_ids],
            }
        )

    found = left.cogroup(right).applyInPandas(search, "query_id long, score double, ids array<long>")
    merged = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("ids")[0])
    best = found.withColumn("_n", F.row_number().over(merged)).filter(F.col("_n") <= keep)
    each_id = best.select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id != query_id")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = each_id.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(embeddings: DataFrame, queries: DataFrame, k: int = 20, params: Params = Params()) -> DataFrame:
    """The ``k`` nearest of each of ``queries`` among ``embeddings`` (both vec_id, embedding).

    Defined cases: vectors that are null, zero, or hold a null or non-finite component take no
    part, neither do rows without an id; vectors of another length are no candidates; equal rows
    count once; of several vectors under one id all are candidates, and the least one is searched
    for; fewer candidates than ``k`` are all returned; an empty table gives no rows. Other columns
    of either table are not looked at, whatever their names. Lengths may differ by any factor.
    """
    return search_index(build_index(embeddings, k + 1, params), valid_vectors(queries), k, params)
