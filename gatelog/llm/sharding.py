"""Sharding by balanced label propagation.

Documents start in shards of equal size and are linked through hubs (documents of one hub are each
other's neighbours, so a hub of n documents stands for n² links without listing them). In each round a
hub's documents prefer the shard that holds most of them, of equal ones another in each round. How many
may go from a shard to another is a quota: as many leave a shard as enter it, where documents without
neighbours, which are at home anywhere, fill the gaps. So sizes never change, and links cut by shard
borders only become fewer. Shards without such documents swap linked ones; as a shard that nobody leaves
would block a hub for good, a hub passes over half of those, others in each round. Hubs in one shard are
done; rounds go on until no hub is split or ``PATIENCE`` rounds in a row allow no move.

Only counts per pair of shards reach the driver. All of it is DataFrame functions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelog.llm.common import digest, numbered, stored, utf8, whole

#: Shards, and rounds in a row without a move that end the search.
SHARDS, PATIENCE = 24, 4


def quotas(wanted: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Moves (from, to) that are allowed, of linked and of free documents; every shard keeps its size.

    A shard can take in more than it gives as far as it has free documents to give instead.
    """
    allowed = wanted.astype(np.int64).copy()
    np.fill_diagonal(allowed, 0)
    while True:
        surplus = allowed.sum(axis=0) - allowed.sum(axis=1)
        over = np.flatnonzero(surplus > free)
        if not len(over):
            break
        for shard in over:
            excess = surplus[shard] - free[shard]
            for origin in np.argsort(-allowed[:, shard], kind="stable"):
                cut = min(excess, allowed[origin, shard])
                allowed[origin, shard] -= cut
                excess -= cut
                if not excess:
                    break
    fill = np.zeros_like(allowed)
    givers, takers = np.maximum(surplus, 0), np.maximum(-surplus, 0)
    for a in np.flatnonzero(givers):
        for b in np.flatnonzero(takers):
            n = min(givers[a], takers[b])
            fill[a, b] += n
            givers[a] -= n
            takers[b] -= n
    return allowed, fill


def _matrix(rows, shards: int) -> np.ndarray:
    out = np.zeros((shards, shards), np.int64)
    for r in rows:
        out[r["a"], r["b"]] = r["n"]
    return out


def balanced(docs: DataFrame, hub: Column, key: Column, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """Adds ``shard`` and ``slot`` (0, 1, 2, … in each shard) to the rows of ``docs``, or replaces them.

    Counts of shards differ by one at most. ``hub`` says which rows are linked (null: with none) and
    ``key`` gives the start, the same for any order of the input; rows alike in all columns are
    interchangeable. A hub larger than a shard fills one shard after another. ``rounds`` bounds the rounds
    (none: as many as there are moves). An empty table gives no rows.
    """
    own = whole(docs.drop("shard", "slot"))
    named = docs.select(own.alias("own"), hub.alias("hub"), key.alias("key"))
    rows = stored(numbered(named, [], [F.xxhash64("key", "own"), F.xxhash64(F.lit(1), "own")], "n"))
    # stored, so that the join below is one that the engine can split at a hot hub
    several = rows.where("hub is not null").groupBy("hub").agg(F.count("*").alias("k")).where("k > 1")
    several = stored(several.select("hub", F.lit(True).alias("linked")))
    start = rows.join(several, "hub", "left").select("n", F.when(F.col("linked"), F.col("hub")).alias("hub"), (F.col("n") % shards).cast("int").alias("shard"))
    start = stored(start)
    linked, free = start.where("hub is not null"), start.where("hub is null").drop("hub")

    total = start.groupBy("shard").count().collect()
    sizes = np.zeros(shards, np.int64)
    for r in total:
        sizes[r["shard"]] = r["count"]
    done, idle, round_ = [], 0, 0
    while idle < PATIENCE and round_ != rounds:
        room = np.zeros(shards, np.int64)
        for r in free.groupBy("shard").count().collect():
            room[r["shard"]] = r["count"]
        # a shard full of one hub is settled for it
        votes = linked.groupBy("hub", "shard").agg(F.count("*").alias("k"))
        full = F.col("k") == F.get(F.lit(sizes.tolist()), F.col("shard"))
        weight = F.struct("k", F.xxhash64("hub", "shard", F.lit(round_)).alias("tie"), "shard")
        has_room = F.get(F.lit([bool(x) for x in (room > 0) | (idle == 0 and round_ % 2 == 0)]), F.col("shard"))
        taking = ~full & (has_room | (F.pmod(F.xxhash64("shard", "hub", F.lit(round_)), F.lit(2)) == 0))
        best = votes.groupBy("hub").agg(F.count_if(~full).alias("open"), F.max(F.when(taking, weight)).alias("best"))
        goal = F.when(~full & (weight < F.col("best")), F.col("best.shard"))
        state = votes.join(best, "hub").select("hub", "shard", goal.alias("to"), (full | (F.col("open") < 2)).alias("settled"))
        told = stored(linked.join(state, ["hub", "shard"]))
        done.append(told.where("settled").select("n", "shard"))
        told = told.where("not settled")
        movers = told.where("to is not null")
        wanted = _matrix(movers.groupBy(F.col("shard").alias("a"), F.col("to").alias("b")).agg(F.count("*").alias("n")).collect(), shards)
        allowed, fill = quotas(wanted, room)
        round_ += 1
        if not allowed.any():
            linked = told.select("n", "hub", "shard")
            if linked.isEmpty():
                break
            idle += 1
            continue
        idle = 0
        place = F.col("shard") * shards + F.col("to")
        limit = F.get(F.lit(allowed.ravel().tolist()), place)
        order = [F.xxhash64("n", F.lit(round_)), F.col("n")]
        moved = numbered(movers, ["shard", "to"], order, "i").withColumn("shard", F.when(F.col("i") < limit, F.col("to")).otherwise(F.col("shard")))
        linked = stored(moved.select("n", "hub", "shard").union(told.where("to is null").select("n", "hub", "shard")))
        if fill.any():
            borders = F.lit(np.cumsum(fill, axis=1).ravel().tolist())
            ends = F.slice(borders, F.col("shard") * shards + 1, shards)
            target = F.size(F.filter(ends, lambda end: end <= F.col("i")))
            ranked = numbered(free, ["shard"], order, "i")
            free = stored(ranked.select("n", F.when(target < shards, target).otherwise(F.col("shard")).alias("shard")))

    placed = free.select("n", "shard").union(linked.select("n", "shard"))
    for part in done:
        placed = placed.union(part)
    placed = stored(placed)
    slots = numbered(placed, ["shard"], [F.col("n")], "slot")
    return rows.select("n", "own").join(slots, "n").select("own.*", "shard", F.col("slot").cast("long").alias("slot"))


def shard_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard; rows with equal texts are linked.

    The law is ``rows``: shards' counts differ by one at most. ``size`` is the text's UTF-8 bytes (null:
    none) plus 8; ``grown_shard`` is null. Null texts count as empty, and empty texts are equal texts.
    """
    body = utf8(F.col(text))
    lean = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        digest(body).alias("_text"),
    )
    out = balanced(lean, F.col("_text"), F.col("doc_id"), shards)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.hex("_text").alias("text_key")
    )
