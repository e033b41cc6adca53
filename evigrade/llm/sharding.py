"""Balanced label propagation: linked documents gather in shards of equal row counts.

Equal texts are one node, weighted by its rows, so they stay whole.  Nodes are
linked by marks of their texts: the smallest hashes of five-word shingles, which
texts with much in common share.  A mark is a hyperedge; neighbours are counted by
mark and shard, never as pairs.  Nodes are first dealt evenly, whatever their
links.  Then each round
  1. counts every mark's rows by shard (partial aggregates),
  2. joins the counts back to the mark's nodes, salted where a mark is hot, and adds
     them up to a node's linked rows in every shard,
  3. lets half of the nodes, by a hash of node and round, ask for the shard where
     they have most, if that is more than where they are,
  4. admits requests of one weight at a time by gain, as many from shard to shard as
     rings of wishes and the room of each shard, departures counted, let pass,
until rounds bring no more linked pairs together or are used up.  Documents without
links don't vote; they fill the shards to equal counts at the end.  Tables that return
to every task have a row for each shard, rank bucket, weight or size of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evigrade.llm.skew import salted_join
from evigrade.session import cut, release

SHARDS = 16
#: Rounds that bring no linked pair together after which propagation ends.
QUIET_ROUNDS = 4
#: Rounds of propagation at most; what is reached by then is a whole result.
ROUNDS = 12
#: Words of a shingle, and how many of a text's smallest shingle hashes link it.
SHINGLE, MARKS = 5, 4
#: Buckets of a distributed rank.
RANK_BUCKETS = 1024


def ranked(rows: DataFrame, key: str, name: str, within: list[str] | None = None) -> DataFrame:
    """Add a gapless rank from 0, inside the groups of `within`, in the order of a hash of `key`.

    Rows are numbered inside RANK_BUCKETS buckets of each group; the buckets'
    offsets are one small table.
    """
    groups = within or []
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(key, F.lit(name)), F.lit(RANK_BUCKETS)))
    counts = rows.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*groups, F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*groups, "_bucket").orderBy(key)
    numbered = rows.withColumn("_at", F.row_number().over(inside) - 1)
    joined = numbered.join(F.broadcast(offsets), [*groups, "_bucket"])
    return joined.withColumn(name, F.col("_before") + F.col("_at")).drop("_bucket", "_at", "_before")


def flows(asked: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many rows may move from shard to shard at once, so that none gets more than its room.

    asked: wishes by (from, to).  Departures count: wishes that form a ring of
    shards need no room, and a row that leaves makes room for another.
    """
    left = {k: n for k, n in asked.items() if n > 0 and k[0] != k[1]}
    room, moved = list(room), {}

    def push(path: list[int], n: int) -> None:
        for k in zip(path, path[1:]):
            moved[k] = moved.get(k, 0) + n
            left[k] -= n
            if not left[k]:
                del left[k]

    def path_to(start: int, end: int | None) -> list[int] | None:
        """A shortest path of wishes to a shard, or to any with room."""
        came, queue = {}, [start]
        for at in queue:
            for a, b in sorted(left):
                if a != at or b in came:
                    continue
                came[b] = a
                queue.append(b)
                if b == end or end is None and b != start and room[b] > 0:
                    path = [b]
                    while len(path) == 1 or path[-1] != start:
                        path.append(came[path[-1]])
                    return path[::-1]
        return None

    for end in (0, 1):  # rings first: they need no room
        for start in range(len(room)):
            while (path := path_to(start, None if end else start)) is not None:
                n = min(left[k] for k in zip(path, path[1:]))
                if end:
                    n = min(n, room[path[-1]])
                    room[path[-1]] -= n
                    room[start] += n
                push(path, n)
    return moved


def text_marks(text: Column, size: int = SHINGLE, count: int = MARKS) -> Column:
    """The smallest hashes of a text's distinct shingles, of the whole text; a shorter text's words are one shingle, no words no mark.

    Words are runs of other characters than blanks, A-Z in lower case.
    """
    words = F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def smallest(given: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(given) - size, F.lit(0)))
        hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(given, i + 1, size)))
        found = F.slice(F.array_distinct(F.sort_array(hashes)), 1, count)
        return F.when(F.size(given) > 0, found).otherwise(F.array().cast("array<long>"))

    # the array of one binds the words, so that they are found once and not again for each shingle
    return F.get(F.transform(F.array(words), smallest), F.lit(0))


def propagate(linked: DataFrame, capacity: list[int], rounds: int | None = None, trace: list[dict] | None = None) -> DataFrame:
    """(row, edge, shard, weight) -> the same after label propagation; no shard above its capacity.

    The given shards must keep to the capacities.  weight: rows that a node stands for, 1 if
    the column is missing.  A node with several edges stands once for each.  Ends after
    `rounds`, or when QUIET_ROUNDS rounds in a row bring no pair together; the best round's
    shards are returned.  trace: gets a dict for each round, with linked pairs that are cut before it and moves.
    """
    spark, shards = linked.sparkSession, range(len(capacity))
    if "weight" not in linked.columns:
        linked = linked.withColumn("weight", F.lit(1).cast("long"))
    linked = cut(linked.select("row", "edge", "shard", "weight"))
    marks, total = cut(linked.groupBy("edge").agg(F.count("*").alias("n"))), linked.count()
    counts = [F.col(f"c{i}") for i in shards]
    turn, quiet, best, least = 0, 0, linked, None
    while True:
        summed = [F.coalesce(F.sum(F.when(F.col("shard") == i, F.col("weight"))), F.lit(0)).alias(f"c{i}") for i in shards]
        tally = cut(linked.groupBy("edge").agg(*summed))
        rows, together = sum(counts).cast("double"), sum(c.cast("double") * c for c in counts)
        apart = tally.agg(F.sum((rows * rows - together) / 2)).first()[0] or 0
        if least is None or apart < least:
            quiet, best, least = 0, linked, apart
        else:
            quiet += 1
        if trace is not None:
            trace.append({"cut": int(apart), "moves": 0})
        if not apart or quiet == QUIET_ROUNDS or turn == rounds:
            return best
        turn += 1
        met = salted_join(linked, tally, ["edge"], ["row"], marks, total).groupBy("row", "shard", "weight")
        near = met.agg(*[F.sum(c).alias(f"c{i}") for i, c in enumerate(counts)], F.count("*").alias("edges"))
        own = F.element_at(F.array(*counts), F.col("shard") + 1) - F.col("weight") * F.col("edges")
        places = [F.when(F.col("shard") != i, F.struct(c.alias("n"), F.xxhash64("row", F.lit(i), F.lit(turn)).alias("tie"), F.lit(i).alias("to"))) for i, c in enumerate(counts)]
        near = near.withColumns({"own": own, "goal": F.greatest(*places) if len(places) > 1 else places[0]})
        awake = F.pmod(F.xxhash64("row", F.lit(-turn)), F.lit(2)) == 0
        gain = F.floor(F.log2(F.col("goal.n") - F.col("own"))).cast("int")
        wishes = cut(near.where(awake & (F.col("goal.n") > F.col("own"))).select("row", "shard", "weight", F.col("goal.to").alias("target"), gain.alias("gain")))
        nodes = linked.select("row", "shard", "weight").distinct()
        loads = {r["shard"]: r["n"] for r in nodes.groupBy("shard").agg(F.sum("weight").alias("n")).collect()}
        room = [c - loads.get(i, 0) for i, c in enumerate(capacity)]
        asked = wishes.groupBy("weight", "shard", "target", "gain").agg(F.count("*").alias("n")).collect()
        admitted = _admit([tuple(r) for r in asked], room)
        if trace is not None:
            trace[-1]["moves"] = sum(a[4] for a in admitted)
        done = [tally, wishes]
        if admitted:
            table = F.broadcast(spark.createDataFrame(admitted, "weight long, shard int, target int, gain int, served long, asked long"))
            heard = wishes.join(table, ["weight", "shard", "target", "gain"])
            whole = heard.where("served = asked").select("row", F.col("target").alias("to"))
            part = ranked(heard.where("served < asked"), "row", "at", ["weight", "shard", "target"])
            moves = whole.union(part.where("at < served").select("row", F.col("target").alias("to")))
            old, linked = linked, cut(linked.join(moves, "row", "left").select("row", "edge", F.coalesce("to", "shard").alias("shard"), "weight"))
            done += [old] if old is not best else []
        _drop(done)


def _drop(tables: list[DataFrame]) -> None:
    """Remove tables that cut() wrote, once nothing reads them."""
    folders = {file.rpartition("/")[0] for table in tables for file in table.inputFiles()}
    release(tables[0].sparkSession, sorted(folders))


def _admit(asked: list[tuple[int, int, int, int, int]], room: list[int]) -> list[tuple]:
    """Which of the requests (weight, from, to, gain, n) pass: (weight, from, to, gain, passed, n), heavy nodes and high gains first."""
    room, admitted = list(room), []
    for weight in sorted({a[0] for a in asked}, reverse=True):
        own = [a for a in asked if a[0] == weight]
        wanted: dict[tuple[int, int], int] = {}
        for _, a, b, _, n in own:
            wanted[a, b] = wanted.get((a, b), 0) + n
        quota = flows(wanted, [r // weight for r in room])
        for (a, b), n in quota.items():
            room[a] += n * weight
            room[b] -= n * weight
        for _, a, b, gain, n in sorted(own, key=lambda r: -r[3]):
            if served := min(n, quota.get((a, b), 0)):
                quota[a, b] -= served
                admitted.append((weight, a, b, gain, served, n))
    return admitted


def pack_groups(sizes: dict[int, int], capacity: list[int]) -> tuple[list[tuple], list[tuple]]:
    """Places for so many groups of each size: whole where any shard has the room, largest first.

    Returns whole: (size, first, end, shard) for the groups [first, end) of a size, and
    parts: (size, group, start, end, shard) for the rows [start, end) of a group that
    fits nowhere, over as few shards as hold it.  Each such group fills a shard, so
    there are fewer of them than shards.
    """
    room, whole, parts = list(capacity), [], []
    for size in sorted(sizes, reverse=True):
        at = 0
        while at < sizes[size]:
            for i in range(len(room)):
                if n := min(room[i] // size, sizes[size] - at):
                    whole.append((size, at, at + n, i))
                    room[i] -= n * size
                    at += n
            if at == sizes[size]:
                break
            start = 0
            while start < size:
                left = size - start
                # the last part takes the tightest shard that holds it
                i = min((r, i) for i, r in enumerate(room) if r >= left)[1] if max(room) >= left else room.index(max(room))
                n = min(room[i], left)
                parts.append((size, at, start, start + n, i))
                room[i] -= n
                start += n
            at += 1
    return whole, parts


def deal(nodes: DataFrame, capacity: list[int]) -> tuple[DataFrame, DataFrame]:
    """First places of nodes (node, n, ...), whatever their links: (node, n, shard, ...), and parts of nodes beyond a shard (node, start, stop, shard).

    Nodes of several rows are packed by pack_groups(); the others are dealt in proportion to the room that is left.
    """
    spark = nodes.sparkSession
    sizes = {r["n"]: r["nodes"] for r in nodes.groupBy("n").agg(F.count("*").alias("nodes")).collect()}
    ones = sizes.pop(1, 0)
    whole, parts = pack_groups(sizes, capacity)
    room = list(capacity)
    for size, first, stop, shard in whole:
        room[shard] -= size * (stop - first)
    for _, _, start, stop, shard in parts:
        room[shard] -= stop - start
    at, used, left = 0, 0, sum(room)
    for shard, free in enumerate(room):  # so many single nodes for each shard, in proportion
        used += free
        end = ones * used // left if left else 0
        if end > at:
            whole.append((1, at, end, shard))
            at = end
    numbered = ranked(nodes, "node", "group", ["n"])
    places = spark.createDataFrame(whole, "_n long, first long, stop long, shard int")
    inside = (F.col("n") == F.col("_n")) & (F.col("group") >= F.col("first")) & (F.col("group") < F.col("stop"))
    placed = cut(numbered.join(F.broadcast(places), inside, "left").drop("_n", "first", "stop"))
    pieces = spark.createDataFrame(parts, "n long, group long, start long, stop long, shard int")
    split = placed.where("shard is null").drop("shard").join(F.broadcast(pieces), ["n", "group"])
    return placed.where("shard is not null").drop("group"), split.select("node", "start", "stop", "shard")


def _by_bounds(rank: Column, sizes: list[int]) -> Column:
    """The index of the interval of consecutive sizes in which a rank falls."""
    shard, end = F.lit(None).cast("int"), sum(sizes)
    for i in reversed(range(len(sizes))):
        shard = F.when(rank < end, F.lit(i)).otherwise(shard)
        end -= sizes[i]
    return shard


def balanced_shards(
    docs: DataFrame, shards: int = SHARDS, links: Column | None = None, rounds: int | None = ROUNDS, trace: list[dict] | None = None
) -> DataFrame:
    """Put every row into a shard; counts of rows are at most one apart.

    docs: doc_id, text and any other columns.  links: a column of arrays of longs; rows that
    share a value are linked (null and empty: not linked); by default text_marks().  One row
    per row: doc_id, size (UTF-8 bytes of the text, null none, plus 1), text_crc32,
    law (`rows`), shard, slot (gapless from 0 in its shard) and grown_shard (null).
    Equal texts, null and empty alike, share a shard wherever any has the room; those that are more than a
    shard are spread over as few as hold them, and have no links.  Linked texts share a shard as far as propagation
    brings them together; trace gets its rounds.  Repeated and null
    doc_ids are rows like any others; an empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    known = docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("node"),
        (text_marks(text) if links is None else links.cast("array<long>")).alias("marks"),
    )
    known = cut(known.withColumn("row", F.monotonically_increasing_id()))
    nodes = cut(known.groupBy("node").agg(F.count("*").alias("n"), F.first("marks").alias("marks")))
    marked = nodes.select("node", "n", F.explode(F.array_distinct("marks")).alias("edge")).where("edge is not null")
    shared = cut(marked.groupBy("edge").agg(F.count("*").alias("texts")).where("texts > 1"))
    marked = cut(salted_join(marked, shared, ["edge"], ["node"]).select("node", "edge"))

    total = known.count()
    capacity = [total // shards + (i < total % shards) for i in range(shards)]
    voting = nodes.select("node", "n").join(marked.select("node").distinct().withColumn("voter", F.lit(True)), "node", "left")
    placed, split = deal(voting.where("voter or n > 1"), capacity)
    pieces = split.groupBy("shard").agg(F.sum(F.col("stop") - F.col("start")).alias("rows")).collect()
    open_rooms = list(capacity)
    for r in pieces:
        open_rooms[r["shard"]] -= r["rows"]
    still = {r["shard"]: r["rows"] for r in placed.where("voter is null").groupBy("shard").agg(F.sum("n").alias("rows")).collect()}
    linked = marked.join(placed.select("node", "shard", F.col("n").alias("weight")), "node").withColumnRenamed("node", "row")
    moved = propagate(linked, [c - still.get(i, 0) for i, c in enumerate(open_rooms)], rounds, trace)
    moved = moved.select(F.col("row").alias("node"), F.col("shard").alias("to")).distinct()
    settled = cut(placed.join(moved, "node", "left").select("node", "n", F.coalesce("to", "shard").alias("shard")))

    loads = {r["shard"]: r["rows"] for r in settled.groupBy("shard").agg(F.sum("n").alias("rows")).collect()}
    rooms = [c - loads.get(i, 0) for i, c in enumerate(open_rooms)]
    sizes, rows = nodes.select("node", "n"), known.select("row", "node")
    whole = salted_join(rows, settled.select("node", "shard"), ["node"], ["row"], sizes, total).select("row", "shard")
    parted = ranked(rows.join(F.broadcast(split.select("node").distinct()), "node"), "row", "at", ["node"])
    parted = parted.join(F.broadcast(split), "node").where("at >= start and at < stop").select("row", "shard")
    taken = cut(whole.union(parted))
    free = known.select("row").join(taken.select("row"), "row", "left_anti")
    filled = ranked(free, "row", "rank").select("row", _by_bounds(F.col("rank"), rooms).alias("shard"))
    placed = cut(taken.union(filled))
    placed = ranked(placed, "row", "slot", ["shard"])
    return known.drop("marks").join(placed, "row").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
