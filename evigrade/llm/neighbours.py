"""Nearest neighbours by inner product, from balanced posting lists.

Vectors are scaled into the unit ball and lifted onto the sphere by one more
coordinate, so the largest inner product is the least distance.  A bounded sample
is halved again and again along the line between two means, at the median,
which gives lists of even size; their means are the centroids.  A graph of
centroids' nearest centroids, held by every task, is searched best first.

Every vector goes to its nearest list, and a boundary vector also to further lists that are
about as near, unless one that it already has is nearer to them.  A query reads the
lists whose distance is within a ratio of its nearest one's; the ratio is the one that
finds RECALL of the sample's own neighbours.  Neighbouring lists share a shard, larger
lists are dealt over several; a shard's vectors stay in memory while its queries
stream past, each of which comes once with all its lists there.

Equal vectors are one class: only its least ids can be among the nearest, and its
queries share one search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evigrade.llm.skew import salted_join
from evigrade.llm.vectors import matrix, sound
from evigrade.session import cut

#: Vectors that lists are fitted on at most, lists at most, vectors of a list about.
FIT_ROWS = 32_768
MOST_LISTS = 4096
LIST_ROWS = 64
#: Part of the sample's neighbours that the ratio must find; queries and neighbours that it is measured on.
RECALL = 0.97
TRIALS = 512
#: Lists that a vector goes to at most, and how much farther than its nearest one they may be.
COPIES = 4
EDGE = 0.02
#: Neighbours of a centroid in the graph, and centroids that a search opens at least.
DEGREE = 24
BEAM = 16
#: Vectors of a shard about; queries that pass a copy of a shard about.
SHARD = 4096
WAVE = 4_000_000


def _lift(x: np.ndarray, most: float) -> np.ndarray:
    """Rows inside the ball of radius `most`, on the unit sphere of one more dimension."""
    x = x / most
    return np.column_stack([x, np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", x, x)))])


def _aim(x: np.ndarray) -> np.ndarray:
    """Queries as points of that sphere: only their direction matters."""
    x = x / np.abs(x).max(1, keepdims=True)
    return np.column_stack([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros(len(x))])


def _halves(points: np.ndarray, lists: int) -> np.ndarray:
    """Means of lists of even size, neighbouring ones next to each other."""
    parts, rng = [points], np.random.default_rng(0)
    while len(parts) < lists and min(map(len, parts)) > 1:
        halves = []
        for part in parts:
            low, high = part[rng.choice(len(part), 2, replace=False)]
            for _ in range(8):
                along = part @ (high - low)
                order = np.argpartition(along, len(part) // 2)
                low, high = (part[some].mean(0) for some in (order[: len(part) // 2], order[len(part) // 2 :]))
            halves += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
        parts = halves
    return np.stack([part.mean(0) for part in parts])


class Lists:
    """Centroids, their graph, and the ratio that prunes a query's lists."""

    def __init__(self, points: np.ndarray, lists: int):
        self.centroids = _halves(points, lists)
        self.squares = np.einsum("ij,ij->i", self.centroids, self.centroids)
        n = len(self.centroids)
        apart = self.squares[:, None] + self.squares[None, :] - 2 * self.centroids @ self.centroids.T
        self.apart = np.sqrt(np.maximum(apart, 0)).astype(np.float32)
        near = np.argsort(self.apart, axis=1, kind="stable")[:, 1 : DEGREE + 1]
        # the order of the halving joins all centroids, however they lie
        ring = np.column_stack([(np.arange(n) + 1) % n, (np.arange(n) - 1) % n])
        self.graph = np.hstack([near, ring])
        self.entries = np.unique(np.linspace(0, n - 1, 8).astype(int))
        self.ratio = 1.0

    def _distances(self, points: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        dots = np.concatenate(
            [np.einsum("ij,ij->i", points[row[i : i + 65536]], self.centroids[at[i : i + 65536]]) for i in range(0, len(row), 65536)]
        )
        return np.sqrt(np.maximum(1 + self.squares[at] - 2 * dots, 0))

    def search(self, points: np.ndarray, ratio: float) -> np.ndarray:
        """Distances of points on the sphere to the centroids that the graph leads to, infinite elsewhere.

        Opened best first: all that are within the ratio of the nearest found, and the BEAM nearest.
        """
        n = len(self.centroids)
        found = np.full((len(points), n), np.inf)
        opened = np.zeros((len(points), n), bool)
        row, at = (x.ravel() for x in np.meshgrid(np.arange(len(points)), self.entries, indexing="ij"))
        while len(row):
            found[row, at] = self._distances(points, row, at)
            beam = min(BEAM, n) - 1
            reach = np.maximum(found.min(1) * ratio, np.partition(found, beam, axis=1)[:, beam])
            row, at = np.nonzero((found <= reach[:, None]) & ~opened & np.isfinite(found))
            opened[row, at] = True
            ahead = np.zeros((len(points), n), bool)
            ahead[np.repeat(row, self.graph.shape[1]), self.graph[at].ravel()] = True
            row, at = np.nonzero(ahead & np.isinf(found))
        return found

    def homes(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, list) of every list that a point goes to."""
        found = self.search(points, 1 + EDGE)
        most = min(COPIES, found.shape[1])
        nearest = np.argpartition(found, most - 1, axis=1)[:, :most]
        far = np.take_along_axis(found, nearest, 1)
        order = np.lexsort((nearest, far), axis=1)
        nearest, far = np.take_along_axis(nearest, order, 1), np.take_along_axis(far, order, 1)
        kept = far <= far[:, :1] * (1 + EDGE)
        for later in range(1, most):
            for sooner in range(later):
                between = self.apart[nearest[:, sooner], nearest[:, later]]
                kept[:, later] &= ~kept[:, sooner] | (between >= far[:, later])
        row, place = np.nonzero(kept)
        return row, nearest[row, place]

    def calibrate(self, vectors: np.ndarray, points: np.ndarray) -> None:
        """The least ratio that finds RECALL of the trial queries' 20 nearest among the sample."""
        trial = np.unique(np.linspace(0, len(vectors) - 1, TRIALS).astype(int))
        trial = trial[np.abs(vectors[trial]).max(1) > 0]
        k = min(20, len(vectors) - 1)
        if not k or not len(trial):
            return
        found = [self.homes(points[low : low + 1024]) for low in range(0, len(points), 1024)]
        homes = np.concatenate([home for _, home in found])
        first = np.concatenate([[0], np.cumsum(np.concatenate([np.bincount(row) for row, _ in found]))])
        needed = []
        for low in range(0, len(trial), 32):
            some = trial[low : low + 32]
            aims = _aim(vectors[some])
            scores = aims @ points.T
            scores[np.arange(len(some)), some] = -np.inf
            near = np.argpartition(scores, -k, axis=1)[:, -k:]
            far = np.sqrt(np.maximum(1 + self.squares[None, :] - 2 * aims @ self.centroids.T, 0))
            least = np.maximum(far.min(1), 1e-300)
            needed += [far[q, homes[first[v] : first[v + 1]]].min() / least[q] for q in range(len(some)) for v in near[q]]
        self.ratio = float(np.quantile(needed, RECALL)) * (1 + 1e-9)

    def probes(self, aims: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, list) of every list that a query reads."""
        found = self.search(aims, self.ratio)
        return np.nonzero(found <= found.min(1, keepdims=True) * self.ratio)


def _blocks(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def _homes(candidates: DataFrame, lists: Lists, most: float, width: int) -> DataFrame:
    """Candidates with the lists that they go to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            row, home = lists.homes(_lift(matrix(batch.column("embedding"), width), most))
            of_row = np.searchsorted(row, np.arange(batch.num_rows + 1))
            homes = pa.ListArray.from_arrays(pa.array(of_row, pa.int32()), pa.array(home.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, homes], names=[*batch.schema.names, "lists"])

    return candidates.mapInArrow(run, _schema(candidates, "lists array<int>"))


def _schema(df: DataFrame, *more: str) -> str:
    return ", ".join([*(f"`{name}` {kind}" for name, kind in df.dtypes), *more])


class _Shards:
    """Shards of each list: short neighbouring lists share one, long ones are dealt over several."""

    def __init__(self, sizes: np.ndarray):
        self.first, self.parts = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
        shard, room = -1, 0
        for number, size in enumerate(sizes):
            if size > room:
                shard, room = shard + 1, SHARD
                if size > SHARD:
                    self.parts[number] = -(-size // SHARD)
            self.first[number] = shard
            shard, room = shard + int(self.parts[number]) - 1, 0 if self.parts[number] > 1 else room - int(size)
        self.count = shard + 1

    def of(self, row: np.ndarray, home: np.ndarray, deal: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(shard, row, list): by `deal` in one part of a long list, or in all of them where it is None."""
        if deal is None:
            parts = self.parts[home]
            part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            row, home = np.repeat(row, parts), np.repeat(home, parts)
        else:
            part = deal[row] % self.parts[home]
        shard = self.first[home] + part
        order = np.lexsort((home, row, shard))
        return shard[order], row[order], home[order]


_VISITS = ("shard", "visitor", "uid", "vec_id", "embedding", "lists")


def _ship(rows: DataFrame, visitor: int, places) -> DataFrame:
    """Rows once for each of their shards, with the lists that they have there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, 512):
            shard, row, home = places(batch)
            if not len(row):
                continue
            new = np.append(True, (shard[1:] != shard[:-1]) | (row[1:] != row[:-1]))
            start = np.flatnonzero(new)
            lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(row)), pa.int32()), pa.array(home.astype(np.int32)))
            taken = batch.select(["uid", "vec_id", "embedding"]).take(pa.array(row[start]))
            columns = [pa.array(shard[start].astype(np.int32)), pa.array(np.full(len(start), visitor, np.int32)), *taken.columns, lists]
            yield pa.RecordBatch.from_arrays(columns, names=list(_VISITS))

    kind = dict(rows.dtypes)["embedding"]
    return rows.mapInArrow(run, f"shard int, visitor int, uid long, vec_id long, embedding {kind}, lists array<int>")


class _Shard:
    """The vectors of one shard, and the queries that pass."""

    def __init__(self, batches: list[pa.RecordBatch], width: int, k: int):
        table = pa.Table.from_batches(batches)
        self.width, self.k = width, k
        self.uid, self.ids = table.column("uid").to_numpy(), table.column("vec_id").combine_chunks()
        # null ids come first, as in Spark's order
        self.vec_id = self.ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
        column = table.column("embedding").combine_chunks()
        self.x, self.dims = matrix(column, width), column.value_lengths().to_numpy(zero_copy_only=False)
        lists = table.column("lists").combine_chunks()
        self.row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        self.home = lists.flatten().to_numpy(zero_copy_only=False)
        self.place = np.arange(len(self.row)) - np.searchsorted(self.row, self.row)
        self.known = np.unique(self.home)

    def visit(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """Of each query, the k nearest of its lists here: largest product, then least id."""
        column = batch.column("embedding")
        x, dims = matrix(column, self.width), column.value_lengths().to_numpy(zero_copy_only=False)
        reads = np.zeros((len(x), len(self.known)), bool)
        lists = batch.column("lists")
        asked = lists.flatten().to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(self.known, asked), len(self.known) - 1)
        query = np.repeat(np.arange(len(x)), lists.value_lengths().to_numpy(zero_copy_only=False))
        here = self.known[at] == asked
        reads[query[here], at[here]] = True
        may = np.zeros((len(x), len(self.x)), bool)
        held = reads[:, np.searchsorted(self.known, self.home)]
        for place in np.unique(self.place):
            # one of each vector's lists at a time
            some = self.place == place
            may[:, self.row[some]] |= held[:, some]
        may &= dims[:, None] == self.dims[None, :]
        with np.errstate(over="ignore", invalid="ignore"):
            rough = np.where(may, x @ self.x.T, -np.inf)
            k = min(self.k, rough.shape[1])
            last = np.partition(rough, rough.shape[1] - k, axis=1)[:, rough.shape[1] - k]
            # products of the same two vectors may differ in their last bits from place to place
            slack = 1e-12 * np.linalg.norm(x, axis=1) * np.linalg.norm(self.x, axis=1).max()
            near = may & ~(rough < (last - slack)[:, None])
            row, member = np.nonzero(near)
            score = np.concatenate([np.empty(0)] + [(x[row[i : i + 8192]] * self.x[member[i : i + 8192]]).sum(1) for i in range(0, len(row), 8192)])
        order = np.lexsort((self.uid[member], self.vec_id[member], -score, row))
        row, member, score = row[order], member[order], score[order]
        kept = np.arange(len(row)) - np.searchsorted(row, row) < self.k
        row, member = row[kept], member[kept]
        columns = [batch.column("uid").take(pa.array(row)), self.uid[member], self.ids.take(pa.array(member)), score[kept]]
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=["query", "uid", "vec_id", "score"])


def _pass(width: int, k: int):
    """Rows come sorted: a shard's vectors, then its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, members, shard = None, [], None
        for whole in batches:
            key = whole.column("wave").to_numpy().astype(np.int64) << 32 | whole.column("shard").to_numpy()
            key = key * 2 + whole.column("visitor").to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for start, end in zip(bounds, bounds[1:]):
                if key[start] // 2 != number:
                    number, members, shard = key[start] // 2, [], None
                rows = whole.slice(start, end - start)
                if key[start] % 2 == 0:
                    members.append(rows)
                elif members:
                    shard = shard or _Shard(members, width, k)
                    yield from map(shard.visit, _blocks([rows], 256))

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """The k rows of largest inner product that the lists find for each row that is_query holds for.

    vectors: vec_id, embedding (array of numbers) and any other columns.  Returns query_id, rank (from 1, largest
    first, ties to the smaller vec_id), vec_id, score (inner product in double precision).  A query's own row is no
    candidate, rows that repeat its vec_id are.  Fewer rows come back only where lists hold fewer.  Vectors that are null, empty,
    zero or hold null or non-finite components take no part; vectors of another length than the query's are never
    near.  An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    given = sound(vectors.select(F.col("vec_id").cast("long"), "embedding", F.coalesce(is_query, F.lit(False)).alias("asks")))
    given = given.withColumn("key_a", F.xxhash64("embedding")).withColumn("key_b", F.xxhash64(F.lit(1), "embedding"))
    given = cut(given.withColumn("uid", F.monotonically_increasing_id()))

    # of equal vectors, the k + 1 least ids hold all that can be near anything, and one stands for all that ask
    least = Window.partitionBy("key_a", "key_b").orderBy("vec_id", "uid")
    candidates = given.withColumn("at", F.row_number().over(least)).where(F.col("at") <= k + 1).drop("at")
    candidates = cut(candidates.select("uid", "vec_id", "embedding"))
    queries = given.where("asks").groupBy("key_a", "key_b").agg(F.min("uid").alias("uid"), F.first("embedding").alias("embedding"))
    queries = cut(queries.withColumn("vec_id", F.lit(None).cast("long")))

    norm = F.aggregate("embedding", F.lit(0.0), lambda s, v: F.hypot(s, v.cast("double")))
    n, width, most = candidates.agg(F.count("*"), F.max(F.size("embedding")), F.max(norm)).first()
    asked = queries.count()
    if not n or not asked:
        return empty
    most = min(float(most), 1e300)
    sample = candidates.orderBy(F.xxhash64(F.lit(3), "uid")).limit(FIT_ROWS).select("embedding").toArrow()
    sample = matrix(sample.column(0).combine_chunks(), width)
    points = _lift(sample, most)
    lists = Lists(points, max(1, min(MOST_LISTS, n // LIST_ROWS)))
    lists.calibrate(sample, points)

    placed = cut(_homes(candidates, lists, most, width))
    sizes = np.zeros(len(lists.centroids), np.int64)
    for number, size in placed.select(F.explode("lists").alias("list")).groupBy("list").count().collect():
        sizes[number] = size
    shards = _Shards(sizes)

    def dwell(batch: pa.RecordBatch):
        homes = batch.column("lists")
        row = np.repeat(np.arange(batch.num_rows), homes.value_lengths().to_numpy(zero_copy_only=False))
        return shards.of(row, homes.flatten().to_numpy(zero_copy_only=False), batch.column("uid").to_numpy())

    def read(batch: pa.RecordBatch):
        return shards.of(*lists.probes(_aim(matrix(batch.column("embedding"), width))), None)

    waves = -(-asked // WAVE)
    members = _ship(placed, 0, dwell).withColumn("wave", F.explode(F.sequence(F.lit(0), F.lit(waves - 1))))
    visits = _ship(queries, 1, read).withColumn("wave", F.pmod(F.xxhash64("uid"), F.lit(waves)).cast("int"))
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(shards.count * waves, 100_000))
    rows = members.unionByName(visits).repartition(partitions, "wave", "shard").sortWithinPartitions("wave", "shard", "visitor")
    found = rows.mapInArrow(_pass(width, k + 1), "query long, uid long, vec_id long, score double")

    # a copy in another list has the same score, so it shares its rank
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "uid")
    found = found.withColumn("rank", F.dense_rank().over(best)).where(F.col("rank") <= k + 1)
    near = found.groupBy("query").agg(F.array_sort(F.collect_set(F.struct("rank", "vec_id", "uid", "score"))).alias("near"))
    near = queries.select("key_a", "key_b", F.col("uid").alias("query")).join(near, "query").drop("query")
    asking = given.where("asks").select("key_a", "key_b", F.col("vec_id").alias("query_id"), "uid")
    answered = salted_join(asking, near, ["key_a", "key_b"], ["uid"])
    others = F.slice(F.filter("near", lambda row: row["uid"] != F.col("uid")), 1, k)
    result = answered.select("query_id", F.posexplode(others).alias("at", "row"))
    return result.select("query_id", (F.col("at") + 1).alias("rank"), F.col("row.vec_id").alias("vec_id"), F.col("row.score").alias("score"))
