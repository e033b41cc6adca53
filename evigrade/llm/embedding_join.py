"""Exact metric range join of embeddings by cosine.

Angles between vectors are a metric.  A bounded sample gives pivots; every
vector belongs to the cell of its nearest pivot, and large cells are cut into
blocks, each packed into one row.  Pairs of blocks meet in a join without a shuffle: a task reads two
partitions of blocks, so disk is in proportion to the input whatever the number of pairs.  Two
cells meet only if the triangle inequality lets members of theirs be within the
range; of two blocks a member is compared only if its angle to the other's pivot differs
from that cell's innermost or outermost member by no more than the range, and the plane between the two pivots is
within the range.  One matrix product compares two blocks.  A task
returns link counts and a spanning forest of links, so what leaves it is
linear.  On vectors without clusters no metric bound prunes in many dimensions;
then every pair of blocks meets, once: the work is quadratic, the disk is not.

Equal vectors are one class with a multiplicity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evigrade.llm.components import connected_components
from evigrade.llm.vectors import is_sound, matrix, typed
from evigrade.session import cut

#: Members of a block about; pivots at most.
BLOCK = 2048
MOST_PIVOTS = 1024
#: Blocks of a file, and pairs of blocks that a Python worker is given at once.
FILE_BLOCKS = 32
PAIRS = 8
_EDGE = 1e-9


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, whatever their scale: by the largest component first, so that no square is lost or overflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _angles(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ pivots.T, -1, 1))


def _assign(classes: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the nearest pivot and the angle to it."""
    width = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                angles = _angles(_unit(matrix(batch.column(2), width)), pivots)
                cell = angles.argmin(1)
                more = [pa.array(cell.astype(np.int32)), pa.array(angles[np.arange(len(cell)), cell])]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "cell", "angle"])

    schema = f"cid long, mult long, embedding {dict(classes.dtypes)['embedding']}, cell int, angle double"
    return classes.select("cid", "mult", "embedding").mapInArrow(run, schema)


def _may_meet(pivots: np.ndarray, cells: dict[int, tuple[int, float, float]], reach: float) -> np.ndarray:
    """Whether members of two cells may be linked."""
    outer = np.array([cells[c][2] if c in cells else -9.0 for c in range(len(pivots))])
    near = _angles(pivots, pivots) <= outer[:, None] + outer[None, :] + reach + _EDGE
    return near | np.eye(len(pivots), dtype=bool)


def _packed(kind: str, near: np.ndarray):
    """One row for the members of a block and the cells that it may have links in; kind: of their components."""

    def run(table: pa.Table) -> pa.Table:
        column = table.column("embedding").combine_chunks()
        numbers = lambda c, t: table.column(c).to_numpy().astype(t).tobytes()
        row = {
            "block": table.column("block")[0].as_py(),
            "cell": table.column("cell")[0].as_py(),
            "ids": numbers("cid", np.int64),
            "mults": numbers("mult", np.int64),
            "dims": column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32).tobytes(),
            "x": column.flatten().to_numpy(zero_copy_only=False).astype(kind).tobytes(),
        }
        found = pa.array([np.flatnonzero(near[row["cell"]]).astype(np.int32)], pa.list_(pa.int32()))
        return pa.table({c: pa.array([v], _PACKED[c]) for c, v in row.items()} | {"near": found})

    return run


_PACKED = {"block": pa.int32(), "cell": pa.int32(), "ids": pa.binary(), "mults": pa.binary(), "dims": pa.binary(), "x": pa.binary()}


def _pairs(blocks: DataFrame) -> DataFrame:
    """Every pair of blocks that may have links, once: each partition of blocks is read again for each, and nothing is shuffled."""
    a = blocks.select(*[F.col(c).alias(f"a_{c}") for c in _PACKED], "near")
    b = blocks.select(*[F.col(c).alias(f"b_{c}") for c in _PACKED])
    low, high = F.least("a_block", "b_block"), F.greatest("a_block", "b_block")
    # of two blocks now the one and now the other is a, so that partitions have equal work
    host = F.when((F.col("a_block") + F.col("b_block")) % 2 == 0, low).otherwise(high)
    met = (host == F.col("a_block")) & F.array_contains("near", F.col("b_cell"))
    return a.join(b.hint("shuffle_replicate_nl"), met).drop("near")


class _Block:
    """The members of one block."""

    def __init__(self, row: list, width: int, kind: str):
        self.name, self.cell, ids, mults, dims, x = row
        self.id, self.mult = np.frombuffer(ids, np.int64), np.frombuffer(mults, np.int64)
        self.dim = np.frombuffer(dims, np.int32)
        bounds = np.concatenate([[0], np.cumsum(self.dim, dtype=np.int64)]).astype(np.int32)
        column = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.frombuffer(x, kind)))
        self.x = _unit(matrix(column, width))
        self.short = self.x.astype(np.float32)


def _linked(a: _Block, b: _Block, rows: np.ndarray, columns: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Members of a and of b that are linked: all that single precision doesn't refute, in double precision."""
    error = (a.x.shape[1] + 8) * 2.0**-22
    i, j = np.nonzero(a.short[rows] @ b.short[columns].T >= threshold - error)
    i, j = rows[i], columns[j]
    same = a.dim[i] == b.dim[j]
    if a.name == b.name:
        same &= i < j
    i, j = i[same], j[same]
    links = np.zeros(len(i), bool)
    for low in range(0, len(i), 16384):
        high = low + 16384
        links[low:high] = np.einsum("ij,ij->i", a.x[i[low:high]], b.x[j[low:high]]) >= threshold
    return i[links], j[links]


class _Links:
    """Links of all blocks that a task has met: a count for each member, and which members are connected."""

    def __init__(self):
        self.first, self.ids = {}, np.zeros(0, np.int64)
        self.counts, self.root = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def place(self, block: _Block) -> int:
        if block.name not in self.first:
            start = self.first[block.name] = len(self.ids)
            self.ids = np.concatenate([self.ids, block.id])
            self.counts = np.concatenate([self.counts, np.zeros(len(block.id), np.int64)])
            self.root = np.concatenate([self.root, np.arange(start, len(self.ids))])
        return self.first[block.name]

    def add(self, a: _Block, b: _Block, i: np.ndarray, j: np.ndarray) -> None:
        if not len(i):
            return
        at, bt = self.place(a), self.place(b)
        np.add.at(self.counts, at + i, b.mult[j])
        np.add.at(self.counts, bt + j, a.mult[i])
        u, v = at + i, bt + j
        while True:
            apart = self.root[u] != self.root[v]
            u, v = u[apart], v[apart]
            if not len(u):
                return
            ends, some = np.unique(self.root[v], return_index=True)
            for x, y in zip(self.root[u[some]].tolist(), ends.tolist()):
                x, y = self._find(x), self._find(y)
                self.root[max(x, y)] = min(x, y)
            while (up := self.root[self.root]).tobytes() != self.root.tobytes():
                self.root = up

    def _find(self, x: int) -> int:
        while (up := int(self.root[x])) != x:
            x = up
        return x

    def rows(self):
        some = np.flatnonzero(self.counts)
        yield _rows(0, self.ids[some], self.counts[some])
        moved = np.flatnonzero(self.root != np.arange(len(self.root)))
        yield _rows(1, self.ids[moved], self.ids[self.root[moved]])


def _rows(kind: int, a, b) -> pa.RecordBatch:
    columns = [pa.array(np.full(len(a), kind, np.int32)), pa.array(a, pa.int64()), pa.array(b, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["kind", "a", "b"])


def _compare(pivots: np.ndarray, cells: dict[int, tuple[int, float, float]], threshold: float, kind: str):
    """(kind 0, vector, links here) and (kind 1, vector, vector) of all pairs of blocks that a task meets."""
    reach, width = math.acos(threshold), pivots.shape[1]

    def near(block: _Block, cell: int) -> np.ndarray:
        """Members that may have links in another cell."""
        if block.cell == cell:
            return np.arange(len(block.id))
        dots = block.x @ pivots[[block.cell, cell]].T
        angles = np.arccos(np.clip(dots[:, 1], -1, 1))
        may = (angles <= cells[cell][2] + reach + _EDGE) & (angles >= cells[cell][1] - reach - _EDGE)
        if reach < math.pi / 2:
            apart = np.linalg.norm(pivots[block.cell] - pivots[cell])
            may &= dots[:, 0] - dots[:, 1] <= math.sin(reach) * apart + _EDGE
        return np.flatnonzero(may)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, a = _Links(), None
        for batch in batches:
            columns = [batch.column(c) for c in range(batch.num_columns)]
            for at in range(batch.num_rows):
                sides = [[c[at].as_py() for c in columns[low : low + len(_PACKED)]] for low in (0, len(_PACKED))]
                if a is None or a.name != sides[0][0]:
                    a = _Block(sides[0], width, kind)
                b = _Block(sides[1], width, kind)
                rows, others = near(a, b.cell), near(b, a.cell)
                if len(rows) and len(others):
                    links.add(a, b, *_linked(a, b, rows, others, threshold))
        yield from links.rows()

    return run


def cosine_links(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Every vector with its number of links and its component.

    vectors: vec_id, embedding (array of float or double) and any other columns, which are
    ignored.  Two rows link if their cosine is at least the threshold.  One row per
    row: vec_id, n_links (other rows linked directly), component_id (least vec_id
    reachable, its own included), kept (vec_id = component_id).  Vectors that are
    null, zero, empty or have null or non-finite components link with nothing, nor
    do vectors of different length.  Rows may repeat a vec_id; each is a vector.
    Null ids link but name no component; a component of null ids only has a null
    id and is kept.  An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    given = typed(vectors.select(F.col("vec_id").cast("long"), "embedding")).withColumn("sound", is_sound())
    given = given.withColumn("key_a", F.when(F.col("sound"), F.xxhash64("embedding")))
    given = given.withColumn("key_b", F.when(F.col("sound"), F.xxhash64(F.lit(1), "embedding"))).drop("sound")
    known = given.where("key_a is not null")
    classes = known.groupBy("key_a", "key_b").agg(
        F.count("*").alias("mult"), F.min("vec_id").alias("least"), F.first("embedding").alias("embedding")
    )
    classes = cut(classes.withColumn("cid", F.monotonically_increasing_id()))
    given = cut(given.select("vec_id", "key_a", "key_b"))
    known = given.where("key_a is not null")

    n, width = classes.agg(F.count("*"), F.max(F.size("embedding"))).first()
    wanted = min(MOST_PIVOTS, max(1, n // BLOCK))
    sample = classes.orderBy(F.xxhash64("key_a", F.lit(7)), "key_b").select("embedding").limit(wanted).collect()
    if not sample:
        counted = known.select("key_a", "key_b", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("root"))
        return _result(given, counted)
    pivots = np.zeros((len(sample), width))
    for row, vector in zip(pivots, sample):
        row[: len(vector[0])] = vector[0]
    pivots = _unit(pivots)

    placed = _assign(classes, pivots)
    of_cell = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high"))
    cells = {r["cell"]: (-(-r["n"] // BLOCK), r["low"], r["high"]) for r in of_cell.collect()}
    first = np.concatenate([[0], np.cumsum([cells.get(c, (0,))[0] for c in range(len(pivots))])]).tolist()
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cell") + 1)
    part = F.pmod(F.xxhash64("cid"), of([cells.get(c, (1,))[0] for c in range(len(pivots))])).cast("int")
    placed = placed.withColumn("block", (of(first[:-1]) + part).cast("int")).drop("angle")

    kind = "<f4" if dict(placed.dtypes)["embedding"] == "array<float>" else "<f8"
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-first[-1] // FILE_BLOCKS))
    near = _may_meet(pivots, cells, math.acos(threshold))
    schema = "block int, cell int, ids binary, mults binary, dims binary, x binary, near array<int>"
    blocks = cut(placed.repartition(partitions, "block").groupBy("block").applyInArrow(_packed(kind, near), schema), wide=True)
    rows = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", PAIRS)
    try:
        found = cut(_pairs(blocks).mapInArrow(_compare(pivots, cells, threshold, kind), "kind int, a long, b long"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    counts = found.where("kind = 0").groupBy(F.col("a").alias("cid")).agg(F.sum("b").alias("links"))
    components = connected_components(found.where("kind = 1").select(F.col("a").alias("u"), F.col("b").alias("v")))
    rooted = classes.select("cid", "key_a", "key_b", "mult", "least").join(
        components.withColumnRenamed("node", "cid"), "cid", "left"
    )
    rooted = cut(rooted.withColumn("component", F.coalesce("component", "cid")))
    roots = cut(rooted.groupBy("component").agg(F.min("least").alias("root")))
    rooted = rooted.join(counts, "cid", "left").join(roots, "component")
    links = F.coalesce("links", F.lit(0)) + F.col("mult") - 1
    return _result(given, cut(rooted.select("key_a", "key_b", links.alias("links"), "root")))


def _result(given: DataFrame, counted: DataFrame) -> DataFrame:
    joined = given.select("vec_id", "key_a", "key_b").join(counted, ["key_a", "key_b"], "left")
    root = F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("root"))
    return joined.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        root.alias("component_id"),
        F.coalesce(F.col("vec_id") == root, root.isNull()).alias("kept"),
    )
