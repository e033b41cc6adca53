"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A fingerprint holds the k smallest of the 63-bit hashes of a text's distinct
shingles, or all of them if there are fewer.  The fingerprint of a union is the
k smallest of the fingerprints' union, so parts merge.  Resemblance comes from
the k smallest of both, containment from resemblance and counts, the distinct
count from the k-th smallest value.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evigrade.llm import text_kernel as tk

K = 128
WIDTH = 5
_SPACE_OF_HASHES = float(1 << 63)


def sketches(texts: pa.Array, width: int = WIDTH, k: int = K) -> list[np.ndarray]:
    """The fingerprint of each text; null counts as empty, and an empty text has no values."""
    separates, codes = tk.separators("space"), tk.byte_codes()
    out = []
    for part in tk.slices(texts):
        out += [found[:k] for found in tk.shingle_sets(part, tk.scan_words(part, separates, codes), width)]
    return out


def encode(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode()


def decode(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u8").astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The fingerprint of the union of two parts."""
    return np.union1d(a, b)[:k]


def distinct_count(sketch: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    if len(sketch) < k:
        return float(len(sketch))
    return (k - 1) / (float(sketch[k - 1]) / _SPACE_OF_HASHES)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity, 0 to 1; two empty fingerprints are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:k]
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(both <= union[-1])) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has, 0 to 1."""
    if not len(a):
        return 1.0
    both = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return min(1.0, both / distinct_count(a, k))


def fingerprint_documents(docs: DataFrame, width: int = WIDTH, k: int = K) -> DataFrame:
    """(doc_id, fingerprint, distinct_shingles) of every row; null and empty texts have an empty fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sketches(batch.column(1), width, k)
            columns = [batch.column(0), pa.array(map(encode, found)), pa.array([distinct_count(s, k) for s in found])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fingerprint", "distinct_shingles"])

    given = docs.select(F.col("doc_id").cast("long"), "text")
    return given.mapInArrow(run, "doc_id long, fingerprint string, distinct_shingles double")


def merge_fingerprints(parts: DataFrame, by: str, k: int = K, salts: int = 32) -> DataFrame:
    """(by, fingerprint) rows -> one merged fingerprint for each value of `by`.

    Merging runs in two levels over salted groups, each in constant memory, so
    a group may hold any share of the rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now = None, None
        for batch in batches:
            for group, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sketch = decode(text or "")
                if now is not None and group == key:
                    now = merge(now, sketch, k)
                    continue
                if now is not None:
                    yield _row(key, now, batch.schema)
                key, now = group, sketch
        if now is not None:
            yield _row(key, now, batch.schema)

    def _row(key, sketch, schema):
        return pa.RecordBatch.from_arrays(
            [pa.array([key], schema.field(0).type), pa.array([encode(sketch)])], names=schema.names[:2]
        )

    kind = dict(parts.dtypes)[by]
    partitions = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = parts.select(by, "fingerprint")
    for level in ("salted", "whole"):
        salt = F.pmod(F.xxhash64("fingerprint"), F.lit(salts)) if level == "salted" else F.lit(0)
        dealt = merged.withColumn("_salt", salt).repartition(partitions, by, "_salt").sortWithinPartitions(by, "_salt")
        merged = dealt.select(by, "fingerprint").mapInArrow(run, f"`{by}` {kind}, fingerprint string")
    return merged


#: Bytes of text that a range of documents holds about; a task takes four of them.
RANGE_BYTES = 16_000_000


def _placer(bounds: np.ndarray, null_ranges: int):
    """A function from doc_ids, null flags and text hashes to ranges, in descending order of doc_id, nulls last.

    bounds: ascending quantiles; one that is repeated is a doc_id with several ranges, dealt by the hash.
    """
    last = len(bounds)

    def place(ids: np.ndarray, nulls: np.ndarray, marks: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(bounds, ids, "left"), np.searchsorted(bounds, ids, "right")
        # the hash's upper half, in the order of signed numbers, as a share of 2 ** 32
        share = ((marks.astype(np.int64) >> np.int64(32)) + (1 << 31)).astype(np.float64) / (1 << 32)
        found = last - high + np.floor(share * (high - low + 1)).astype(np.int64)
        return np.where(nulls, last + 1 + np.floor(share * null_ranges).astype(np.int64), found)

    return place


def _in_descending_order(docs: DataFrame) -> DataFrame:
    """Deal rows into ranges of descending doc_id, each followed by the first row of the next range.

    Columns doc_id, text, bucket, guest, in order within each bucket.  Null doc_ids
    come last; rows with equal or null doc_ids are ordered by a hash of their
    text and may fill several ranges.  The bounds are quantiles, as many as the bytes of text ask for; the driver
    holds two numbers for each range.
    """
    spark = docs.sparkSession
    partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"))
    rows, known, size = keyed.agg(F.count("*"), F.count("doc_id"), F.sum(F.octet_length("text"))).first()
    ranges = max(4 * partitions, -(-(size or 0) // RANGE_BYTES))
    null_ranges = max(1, -(-(rows - known) * ranges // max(1, rows)))
    steps = [i / ranges for i in range(1, ranges)]
    ids = keyed.select("doc_id").where("doc_id is not null")
    found = ids.stat.approxQuantile("doc_id", steps, 0.2 / ranges) if known else []
    place = _placer(np.sort(np.array([int(b) for b in found], np.int64)), null_ranges)

    @F.pandas_udf("long")
    def bucket_of(doc_id: pd.Series, null: pd.Series, mark: pd.Series) -> pd.Series:
        return pd.Series(place(doc_id.to_numpy(), null.to_numpy(), mark.to_numpy()))

    null = F.col("doc_id").isNull()
    placed = keyed.withColumn("bucket", bucket_of(F.coalesce("doc_id", F.lit(0)), null, F.col("mark")))
    order = F.struct(null.alias("null"), F.bitwise_not("doc_id").alias("down"), "mark")
    heads = placed.groupBy("bucket").agg(F.min(order).alias("head")).select("bucket", "head.*").toArrow().to_pylist()
    heads.sort(key=lambda r: r["bucket"])
    of_bucket = {r["bucket"]: ((None if r["null"] else ~r["down"]), r["mark"]) for r in heads}
    before = {r["bucket"]: heads[i - 1]["bucket"] for i, r in enumerate(heads)}

    @F.pandas_udf("long")
    def sent_to(bucket: pd.Series, doc_id: pd.Series, null: pd.Series, mark: pd.Series) -> pd.Series:
        """The range that a row is also sent to: for the first row of a range the one before; else -1."""
        out = []
        for b, d, n, m in zip(bucket.tolist(), doc_id.tolist(), null.tolist(), mark.tolist()):
            out.append(before[b] if of_bucket[b] == (None if n else d, m) else -1)
        return pd.Series(out, dtype="int64")

    placed = placed.withColumn("to", sent_to("bucket", F.coalesce("doc_id", F.lit(0)), null, "mark"))
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("guest"))
    sent = F.struct(F.col("to").alias("bucket"), F.lit(1).alias("guest"))
    places = F.when(F.col("to") >= 0, F.array(own, sent)).otherwise(F.array(own))
    dealt = placed.select("doc_id", "text", "mark", F.explode(places).alias("place")).select("doc_id", "text", "mark", "place.*")
    dealt = dealt.repartition(max(partitions, ranges // 4), "bucket")
    dealt = dealt.sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), "mark", "text")
    return dealt.select("doc_id", "text", "bucket", "guest")


def fingerprints_with_edits(docs: DataFrame, width: int = WIDTH, k: int = K) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and how alike they are.

    The edited text has its last floor(n/2) code points replaced by the first as
    many of the next document in descending doc_id; after the last comes the
    first.  Null doc_ids come last; rows with equal doc_id follow each other by
    a hash of their text.  Null texts count as empty; other columns are ignored; an empty table
    gives an empty result.  One row per row: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def finish(ids, texts, marks):
        """Rows for all but the last of some consecutive rows of a bucket."""
        edited = []
        for text, after in zip(texts, texts[1:]):
            half = len(text) // 2
            edited.append(text[: len(text) - half] + after[:half])
        changed = sketches(pa.array(edited, pa.large_string()), width, k)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids[:-1], pa.int64()),
                pa.array([len(t) for t in texts[:-1]], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                pa.array([encode(s) for s in marks[:-1]]),
                pa.array([encode(s) for s in changed]),
                pa.array([resemblance(a, b, k) for a, b in zip(marks, changed)]),
                pa.array([resemblance(a, b, k) for a, b in zip(marks, marks[1:])]),
            ],
            names=names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for whole in batches:
            for low in range(0, whole.num_rows, 256):
                batch = whole.slice(low, 256)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                marks = sketches(batch.column(1), width, k)
                rows = list(zip(batch.column(0).to_pylist(), texts, marks, *(batch.column(i).to_pylist() for i in (2, 3))))
                run_of: list = [held] if held else []
                for row in rows:
                    if run_of and run_of[-1][3] != row[3]:
                        if len(run_of) > 1:
                            yield finish(*map(list, zip(*[r[:3] for r in run_of])))
                        run_of = []
                    if not (run_of and run_of[-1][4]):
                        run_of.append(row)
                if len(run_of) > 1:
                    yield finish(*map(list, zip(*[r[:3] for r in run_of])))
                held = run_of[-1]

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double"
    )
    return _in_descending_order(docs).mapInArrow(run, schema)
