"""Balanced label propagation: linked documents gather in shards of nearly equal bytes."""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, random_key, running_totals, stored

#: Bytes that a document counts besides its text.
OVERHEAD = 16
#: Copies of a group's row in joins, so that a group that holds a third of all rows is spread.
SALTS = 16


def _spread_join(rows: DataFrame, per_key: DataFrame, by: list[str]) -> DataFrame:
    """Left join of rows to one row per key, with the keys copied over salts and the rows dealt to them."""
    salted = rows.withColumn("_salt", F.conv(F.substring("key", 1, 1), 16, 10).cast("int") % SALTS)
    copies = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*by, "_salt"], "left").drop("_salt")


def units(linked: DataFrame, quota: int) -> DataFrame:
    """Add ``piece`` to linked rows (key, size, link): what has one link and piece is to be in one shard.

    A link within the quota is one piece. A larger one is cut by key into pieces of nearly the quota,
    so it wishes for as many shards at once as its bytes need.
    """
    sums = linked.groupBy("link").agg(F.sum("size").alias("bytes"), F.max("size").alias("largest"))
    # Each such link holds more than a shard, so there are fewer of them than shards.
    hot = F.broadcast(sums.filter(F.col("bytes") > quota).select("link", "largest"))
    rows = linked.join(hot, "link", "left")
    queued = running_totals(
        stored(rows.filter("largest is not null"), "shard-hot"), "link", "key", "size", "before"
    )
    width = F.greatest(F.lit(quota) - F.col("largest"), F.lit(quota) / 2, F.lit(1))
    cut = queued.withColumn("piece", F.floor(F.col("before") / width).cast("int"))
    whole = rows.filter("largest is null").withColumn("piece", F.lit(0))
    return whole.drop("largest").unionByName(cut.drop("largest", "before"))


def fits(count: Column, room: Column) -> Column:
    """Whether a shard's room takes the rows of a link that are not in the shard yet."""
    return F.element_at(room, count["shard"] + 1) >= F.col("bytes") - count["bytes"]


def wish(room: list[int]) -> Column:
    """The shard in which most of a link's rows are, of those with room for the others; null without any.

    Among equals a digit string decides, weighted by room, so that links without a place of their own
    are dealt to the shards in proportion to what these can take.
    """
    rooms = F.lit(room)

    def named(shard: Column, here: Column) -> Column:
        drawn = (F.pmod(F.xxhash64("hub", shard), F.lit(1 << 40)) + F.lit(0.5)) / F.lit(float(1 << 40))
        # The larger the room, the closer to 0.
        weight = F.greatest(F.element_at(rooms, shard + 1), F.lit(1))
        return F.struct(here.alias("here"), (F.log(drawn) / weight).alias("tie"), shard.alias("shard"))

    own = F.filter("counts", lambda c: fits(c, rooms))
    others = F.filter(
        F.sequence(F.lit(0), F.lit(len(room) - 1)), lambda shard: F.element_at(rooms, shard + 1) >= F.col("bytes")
    )
    return F.coalesce(
        F.array_max(F.transform(own, lambda c: named(c["shard"], c["here"])))["shard"],
        F.array_max(F.transform(others, lambda shard: named(shard, F.lit(0).cast("long"))))["shard"],
    )


def place_large(members: DataFrame, shards: int, quota: int, n_rows: int) -> tuple[dict[str, int], list[int]]:
    """Shards of the links of more than a sixteenth of a shard, in bytes or rows, and the room left.

    A row of a link table stands for each of its links, so there are at most 32 such links per shard
    and link of a row: what comes to the driver has a bound. The largest goes first, to the shard
    with the most room; one that fits nowhere whole is left to propagation.
    """
    sums = members.groupBy("hub").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    large = sums.filter((F.col("bytes") > quota / 16) | (F.col("n") > n_rows / (16 * shards))).collect()
    room, held = [quota] * shards, {}
    for unit in sorted(large, key=lambda u: (-u["bytes"], u["hub"])):
        best = max(range(shards), key=lambda s: (room[s], s))
        if room[best] >= unit["bytes"]:
            room[best] -= unit["bytes"]
            held[unit["hub"]] = best
    return held, room


def _loads(df: DataFrame, shards: int, by: str = "shard") -> list[int]:
    found = {r[by]: r["load"] for r in df.groupBy(by).agg(F.sum("size").alias("load")).collect()}
    return [found.get(shard, 0) for shard in range(shards)]


def _votes(member: DataFrame, hubs: DataFrame, room: list[int], part: int | None) -> DataFrame:
    """Rows (row, size, shard, to, lay) of the rows that may move and have a neighbour elsewhere.

    A row reads its neighbours' labels off its links: a shard gets a vote for each neighbour in it, if
    the shard can take the whole link; the wish of the row's first cut link adds to these, so that
    neighbours agree among equals; the shard in which the row is has one vote more. With a ``part``
    only half of the rows, dealt anew by its number, are asked.
    """
    rooms = F.lit(room)
    is_cut = F.size("counts") > 1
    own = lambda c: c["shard"] == F.col("shard")
    vote = lambda c: F.when(fits(c, rooms), c["here"] - F.when(own(c), 1).otherwise(0)).otherwise(0)
    asked = member.filter("not held")
    if part is not None:
        asked = asked.filter(F.pmod(F.xxhash64("row", F.lit(part)), F.lit(2)) == 0)
    restless = _spread_join(asked, hubs.filter(is_cut).select("hub", F.lit(True).alias("cut")), ["hub"])
    asked = asked.join(restless.filter("cut").select("row").distinct(), "row", "left_semi")
    rows = (
        _spread_join(asked, hubs, ["hub"])
        .withColumn(
            "votes", F.transform("counts", lambda c: F.struct(c["shard"].alias("shard"), vote(c).cast("double").alias("vote")))
        )
        .withColumn("stays", F.exists("counts", lambda c: own(c) & fits(c, rooms)))
        .groupBy("row")
        .agg(
            F.first("key").alias("key"),
            F.first("size").alias("size"),
            F.first("shard").alias("shard"),
            F.flatten(F.collect_list("votes")).alias("votes"),
            F.min(F.when(is_cut, F.col("stays"))).alias("stays"),
            F.min(F.when(is_cut, F.struct(F.xxhash64("hub"), F.col("hub"), F.col("to")))).alias("first"),
        )
    )
    here = F.struct(F.col("shard"), F.when(F.col("stays"), 1.0).otherwise(0.5).alias("vote"))
    wished = F.struct(F.coalesce("first.to", "shard").alias("shard"), F.when(F.col("first.to").isNull(), 0.0).otherwise(0.75).alias("vote"))
    rows = rows.withColumn("votes", F.concat("votes", F.array(here, wished)))
    total = lambda shard: F.aggregate(
        F.filter("votes", lambda v: v["shard"] == shard), F.lit(0.0), lambda sum_, v: sum_ + v["vote"]
    )
    named = F.array_distinct(F.transform("votes", lambda v: v["shard"]))
    best = F.array_max(F.transform(named, lambda shard: F.struct(total(shard).alias("vote"), shard.alias("shard"))))
    # Rows of a link stand side by side, so that the first links get in whole.
    lay = F.concat(F.substring(F.md5(F.col("first.hub").cast("binary")), 1, 8), F.col("key"))
    return rows.select("row", "size", "shard", best["shard"].alias("to"), lay.alias("lay"))


def propagate(nodes: DataFrame, members: DataFrame, shards: int, quota: int) -> tuple[DataFrame, list[int]]:
    """Move rows to their neighbours' shards. Gives the rows with their last labels, and the cut after every round.

    ``nodes`` are rows (row, key, size, shard, held), ``members`` the links (row, hub): rows of one hub
    are neighbours. The cut counts pairs of neighbours in different shards. In a round the labels of
    a hub's rows are counted (a join over the links), rows vote as ``_votes`` says, and those that wish
    for a shard are let in as long as their bytes fit beside the rows there that have nothing to
    wish for. Held rows are neighbours that never move. A round that doesn't lower the cut is taken
    back and done by half of the rows, as neighbours that all move at once may miss each other;
    rounds end when that lowers it neither. What comes to the driver are sums per shard.
    """
    spark = nodes.sparkSession
    cuts, tries, part = [], 0, None
    hubs, cut = _labels(nodes, members)
    while True:
        cuts.append(cut)
        if not cut:
            discard(spark, hubs)
            return nodes, cuts
        load = _loads(nodes, shards)
        while True:
            moved = _moved(nodes, members, hubs, load, quota, part)
            found, after = _labels(moved, members)
            if after < cut:
                break
            discard(spark, found, moved)
            if part is not None:
                discard(spark, hubs)
                return nodes, cuts
            tries += 1
            part = tries
        discard(spark, hubs, nodes)
        nodes, hubs, cut = moved, found, after
        part = None if part is None else part + 1


def _labels(nodes: DataFrame, members: DataFrame) -> tuple[DataFrame, int]:
    """Links (hub, bytes, counts) with their rows per shard, and the pairs of neighbours that are cut."""
    member = members.join(nodes, "row")
    counts = member.groupBy("hub", "shard").agg(
        F.count("*").alias("here"), F.sum(F.when(F.col("held"), 0).otherwise(F.col("size"))).alias("bytes")
    )
    each = F.struct("shard", "here", "bytes")
    hubs = stored(
        counts.groupBy("hub").agg(F.sum("bytes").alias("bytes"), F.array_sort(F.collect_list(each)).alias("counts")),
        "shard-links",
    )
    big = lambda c: c["here"].cast("decimal(19,0)")
    add = lambda total, n: (total + n).cast("decimal(38,0)")
    none = F.lit(0).cast("decimal(38,0)")
    # Pairs in different shards: every shard's rows with those of the shards before.
    squares = F.aggregate("counts", none, lambda total, c: add(total, big(c) * big(c)))
    whole = F.aggregate("counts", F.lit(0).cast("long"), lambda total, c: total + c["here"]).cast("decimal(19,0)")
    cut = hubs.filter("size(counts) > 1").agg(F.sum((whole * whole - squares) / 2)).first()[0]
    return hubs, int(cut or 0)


def _moved(
    nodes: DataFrame, members: DataFrame, hubs: DataFrame, load: list[int], quota: int, part: int | None
) -> DataFrame:
    """The nodes after one round: who wishes to move and fits has its new label."""
    shards = len(load)
    restless = hubs.filter("size(counts) > 1").select(F.inline("counts")).withColumnRenamed("bytes", "size")
    room = [quota - a + b for a, b in zip(load, _loads(restless, shards))]
    votes = stored(_votes(members.join(nodes, "row"), hubs.withColumn("to", wish(room)), room, part), "shard-votes")
    room = [quota - a + b for a, b in zip(load, _loads(votes, shards))]
    queued = running_totals(votes, "to", "lay", "size", "before")
    let_in = F.col("before") + F.col("size") <= F.element_at(F.lit(room), F.col("to") + 1)
    moves = queued.filter(let_in & (F.col("to") != F.col("shard"))).select("row", "to")
    label = F.coalesce("to", "shard").alias("shard")
    moved = stored(nodes.join(moves, "row", "left").select("row", "key", "size", label, "held"), "shard-labels")
    discard(nodes.sparkSession, votes)
    return moved


def shard_documents(
    documents: DataFrame,
    shards: int = 40,
    link: Column | None = None,
    seed: str = "shard",
    links: DataFrame | None = None,
) -> DataFrame:
    """Shard and slot of every document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Documents with the same ``link`` (the text's digest unless given) are linked; or give ``links``, a
    table (doc_id, link) in which a document may have any number of them, such as an edge's number
    for both its ends. Links of more than a sixteenth of a shard are placed first, whole, or in
    pieces if they exceed a shard. All others start in a shard by hash and move by balanced label
    propagation under a quota of an equal share of all bytes, while the cut falls. Documents without
    links, and what exceeds a quota, fill up the shards: laid end to end, they are cut at the
    shards' remaining room, so that shards differ by about the size of a document. The law is
    ``bytes``. Slots count from 0 in each shard without gaps.

    Defined cases: a null text has no bytes (size 16, checksum 0) and no links of its own; an empty
    text is a text like others; null and repeated doc_ids are ordinary rows, and a row of ``links``
    holds for all rows of its doc_id; null links link nothing; a link that exceeds a shard is split
    into as many pieces as its bytes need shards; an empty table gives an empty table. Other columns
    are ignored.
    """
    spark = documents.sparkSession
    link_by = F.md5(F.col("text").cast("binary")) if link is None else link.cast("string")
    bytes_of = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = stored(
        documents.select(
            "doc_id",
            (F.octet_length(bytes_of) + OVERHEAD).cast("long").alias("size"),
            F.crc32(bytes_of).alias("text_crc32"),
            link_by.alias("link"),
        )
        .withColumn("key", random_key(seed, F.col("doc_id"), F.col("link"), F.col("text_crc32")))
        # Rows may be equal; written once, the number stays.
        .withColumn("row", F.monotonically_increasing_id()),
        "shard-rows",
    )
    total, n_rows = rows.agg(F.sum("size"), F.count("*")).first()
    quota = -(-(total or 0) // shards)
    pairs = rows.select("row", "key", "size", "link")
    if links is not None:
        given = links.select("doc_id", F.col("link").cast("string").alias("link")).distinct()
        pairs = stored(rows.select("row", "key", "size", "doc_id").join(given, "doc_id").drop("doc_id"), "shard-given")
    pairs = pairs.filter("link is not null")
    shared = pairs.groupBy("link").agg(F.count("*").alias("n")).filter("n > 1")
    tied = stored(_spread_join(pairs, shared, ["link"]).filter("n is not null").drop("n"), "shard-tied")
    hub = F.concat_ws(":", "link", "piece").alias("hub")
    members = stored(units(tied, quota).select("row", "key", "size", hub), "shard-members")
    held, room = place_large(members, shards, quota, n_rows)
    named = F.from_json(F.lit(json.dumps([{"hub": h, "at": s} for h, s in held.items()])), "array<struct<hub: string, at: int>>")
    # The labels to begin with: by hash, in proportion to the room that the large links leave.
    ends = [upto / max(1, sum(room)) for upto in accumulate(room)]
    drawn = F.conv(F.substring("key", 3, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    start = F.least(F.size(F.filter(F.lit(ends), lambda end: end <= drawn)), F.lit(shards - 1))
    large = F.broadcast(spark.range(1).select(F.inline(named)))
    nodes = stored(
        members.join(large, "hub", "left")
        .groupBy("row", "key", "size")
        .agg(F.min("at").alias("at"))
        .select("row", "key", "size", F.coalesce("at", start).cast("int").alias("shard"), F.col("at").isNotNull().alias("held")),
        "shard-nodes",
    )
    small = stored(members.join(large, "hub", "left_anti").select("row", "hub"), "shard-small")
    settled, _ = propagate(nodes, small, shards, quota)
    found = stored(_within(settled, shards, quota), "shard-settled")
    columns = ["doc_id", "text_crc32", "key", "size"]
    gathered = stored(rows.join(found, "row", "left").select(*columns, "shard"), "shard-gathered")
    kept = gathered.filter("shard is not null")
    free = gathered.filter("shard is null").withColumn("lay", F.col("key"))
    # The larger half of the free rows first; the smaller half then evens out what was cut at large
    # documents.
    held_bytes, n_free = free.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    is_large = F.col("size") > held_bytes / max(1, n_free)
    first = stored(_fill(free.filter(is_large), kept, shards, quota), "shard-large")
    taken = kept.select("shard", "size").unionByName(first.select("shard", "size"))
    placed = stored(first.unionByName(_fill(free.filter(~is_large), taken, shards, quota)), "shard-filled")
    both = stored(kept.unionByName(placed.select(*columns, "shard")), "shard-placed")
    discard(spark, rows, tied, members, small, settled, found, gathered, first, placed)
    if links is not None:
        discard(spark, pairs)
    slots = running_totals(both.withColumn("_one", F.lit(1)), "shard", "key", "_one", "slot")
    return slots.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _within(nodes: DataFrame, shards: int, quota: int) -> DataFrame:
    """Rows (row, shard) of the nodes, without those that exceed their shard's quota."""
    load = _loads(nodes, shards)
    if max(load) <= quota:
        return nodes.select("row", "shard")
    left = [quota - at for at in _loads(nodes.filter("held"), shards)]
    queued = running_totals(nodes.filter("not held"), "shard", "key", "size", "before")
    within = queued.filter(F.col("before") + F.col("size") <= F.element_at(F.lit(left), F.col("shard") + 1))
    return nodes.filter("held").select("row", "shard").unionByName(within.select("row", "shard"))


def _fill(free: DataFrame, taken: DataFrame, shards: int, quota: int) -> DataFrame:
    """Lay the free rows end to end and cut them in proportion to the room that taken rows leave in each shard.

    A row at a cut goes where its middle lies, so half the largest row is kept back of each room. What
    comes to the driver is a sum for each shard, whose number is a parameter.
    """
    free_bytes, largest = free.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    load = {r["shard"]: r["load"] for r in taken.groupBy("shard").agg(F.sum("size").alias("load")).collect()}
    for margin in (largest / 2, 0):
        room = [max(0, quota - load.get(shard, 0) - margin) for shard in range(shards)]
        if sum(room) > 0:
            break
    else:
        room = [1] * shards
    cuts = [free_bytes * upto / sum(room) for upto in accumulate(room)]
    laid = running_totals(free.withColumn("_all", F.lit("all")), "_all", "lay", "size", "before").drop("_all")
    middle = F.col("before") + F.col("size") / 2
    passed = F.size(F.filter(F.lit(cuts), lambda cut: cut <= middle))
    return laid.withColumn("shard", F.least(passed, F.lit(shards - 1))).drop("before")
