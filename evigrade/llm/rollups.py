"""Token counts: rollups by source, language and tokenizer version, maintained by deltas.

A batch is a table of signed changes.  It is pre-aggregated to one delta row per
cell, written to a private folder and renamed to the batch's name; the rename is
the commit, and only one committer of a batch can have it.  A batch that is
already committed is not written again, so a retried or repeated batch changes
nothing.  Totals are sums over committed batches and never need a rescan of
documents.  compact() folds old batches into one, which remembers their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evigrade.llm.mixing import count_words
from evigrade.llm.tokens import word_tokenizer

CELL = ("source", "lang", "tokenizer")
MEASURES = ("docs", "tokens", "chars")
_SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long, chars long"


def count_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """(doc_id, source, lang, words, chars, tokens) of every row by its whole text.

    Null and empty texts count 0; a null source or language stays null; rows that
    repeat a doc_id are counted each; other columns are ignored.  An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokenizer(tokenizer)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                texts = [t or "" for t in part.column(4).to_pylist()]
                tokens = pa.array([len(encoder.encode(t)) // 4 for t in texts], pa.int64())
                chars = pa.array([len(t) for t in texts], pa.int64())
                names = ["doc_id", "source", "lang", "words", "chars", "tokens"]
                yield pa.RecordBatch.from_arrays([*part.columns[:4], chars, tokens], names=names)

    given = docs.select(F.col("doc_id").cast("long"), "source", "lang", count_words(F.col("text")).alias("words"), "text")
    return given.mapInArrow(run, "doc_id long, source string, lang string, words long, chars long, tokens long")


def inserts(counts: DataFrame, version: str, tokens: str) -> DataFrame:
    """Changes that add documents with their counts."""
    return _changes(counts, version, F.lit(1), F.col(tokens), F.col("chars"))


def deletes(counts: DataFrame, version: str, tokens: str) -> DataFrame:
    """Changes that take documents out; counts are those with which they came in."""
    return _changes(counts, version, F.lit(-1), -F.col(tokens), -F.col("chars"))


def revisions(counts: DataFrame, version: str, old: str, new: str) -> DataFrame:
    """Changes that replace documents' token counts."""
    return _changes(counts, version, F.lit(0), F.col(new) - F.col(old), F.lit(0))


def _changes(counts: DataFrame, version: str, docs, tokens, chars) -> DataFrame:
    return counts.select(
        "source",
        "lang",
        F.lit(version).alias("tokenizer"),
        docs.cast("long").alias("docs"),
        F.coalesce(tokens, F.lit(0)).cast("long").alias("tokens"),
        F.coalesce(chars, F.lit(0)).cast("long").alias("chars"),
    )


class RollupStore:
    """Committed batches of deltas under one folder that all executors share.

    Nulls in a cell's columns are a value like others, null counts are 0, and equal changes
    add up.  An empty batch commits and changes nothing; an empty store has no totals.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self):
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _held(self) -> dict[str, list[str]]:
        """All published folders and the batches that each holds."""
        files, path = self._files()
        if not files.exists(path(self.path)):
            return {}
        names = sorted(s.getPath().getName() for s in files.listStatus(path(self.path)) if s.isDirectory())
        found = {n: [n.removeprefix("batch-")] for n in names if n.startswith("batch-")}
        for name in (n for n in names if n.startswith("folded-")):
            rows = self.spark.read.schema("batch string").parquet(f"{self.path}/{name}/names").collect()
            found[name] = [r["batch"] for r in rows]
        return found

    @staticmethod
    def _counting(held: dict[str, list[str]]) -> dict[str, list[str]]:
        """The folders that count: each batch once, whatever overlapping compactions have left.

        A compaction folds all that is committed, so of two results the larger holds the
        smaller one's batches; the smaller doesn't count, nor does a batch that is folded.  Results that
        hold only some of each other's batches can't be told apart and raise.
        """
        kept, claimed = {}, set()
        for name in sorted(held, key=lambda n: (n.startswith("batch-"), -len(held[n]), n)):
            new = set(held[name]) - claimed
            if not new:
                continue
            if len(new) < len(held[name]):
                raise RuntimeError(f"folder {name} holds some batches that another one has folded, and others that it has not")
            kept[name] = held[name]
            claimed |= new
        return kept

    def _folders(self) -> dict[str, list[str]]:
        return self._counting(self._held())

    def committed(self) -> list[str]:
        """Names of the committed batches."""
        return sorted(b for held in self._folders().values() for b in held)

    def _publish(self, private: str, name: str) -> bool:
        """Rename a finished private folder; False, and the folder is gone, if the name is taken."""
        files, path = self._files()
        target = path(f"{self.path}/{name}")
        if not files.exists(target) and files.rename(path(private), target):
            nested = path(f"{self.path}/{name}/{private.rpartition('/')[2]}")
            if not files.exists(nested):
                return True
            files.delete(nested, True)  # another committer's folder took the name first, so ours went into it
            return False
        files.delete(path(private), True)
        return False

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch once; False if it was there already."""
        if batch in self.committed():
            return False
        private = f"{self.path}/_private-{uuid.uuid4().hex}"
        self._deltas(changes).write.parquet(private)
        return self._publish(private, f"batch-{batch}")

    @staticmethod
    def _deltas(changes: DataFrame) -> DataFrame:
        return changes.groupBy(*CELL).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in MEASURES])

    def _read(self, folders: list[str]) -> DataFrame:
        paths = [f"{self.path}/{n}/deltas" if n.startswith("folded-") else f"{self.path}/{n}" for n in folders]
        return self.spark.read.schema(_SCHEMA).parquet(*paths)

    def compact(self) -> int:
        """Fold all committed batches into one folder; how many folders it replaced.

        The new folder counts from its rename on, and the old ones no longer; only then are they removed.
        """
        held = self._held()
        folders = self._counting(held)
        if len(folders) < 2:
            return 0
        private = f"{self.path}/_private-{uuid.uuid4().hex}"
        self._deltas(self._read(list(folders))).write.parquet(f"{private}/deltas")
        names = [(b,) for batches in folders.values() for b in batches]
        self.spark.createDataFrame(names, "batch string").write.parquet(f"{private}/names")
        if not self._publish(private, f"folded-{uuid.uuid4().hex}"):
            return 0
        files, path = self._files()
        for name in held:
            files.delete(path(f"{self.path}/{name}"), True)
        return len(folders)

    def totals(self) -> DataFrame:
        """One row per cell with any document, token or character left."""
        folders = list(self._folders())
        if not folders:
            return self.spark.createDataFrame([], _SCHEMA)
        sums = self._deltas(self._read(folders))
        return sums.where("docs <> 0 or tokens <> 0 or chars <> 0")
