"""Which tokens of two vocabularies cover the same bytes.

Both vocabularies cut a text's bytes into intervals.  In each task DuckDB holds the
intervals of a stretch of documents as two tables: an ASOF join finds for each
token's first byte the other side's token that covers it, and the range condition drops
tokens that end before; so every overlapping pair is found once, at the first byte
that they share.  The ends that both sides share number the groups.  Tasks count the pairs of a block of documents; Spark merges these counts, finds each
B id's highest, and sends to every block the counts of its own pairs, where they are
summed by document.  No task holds all pairs.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from evigrade.llm.tokens import byte_alphabet
from evigrade.session import cut

#: Tokens of both sides that DuckDB joins at once, and bytes of text in a block, about.
STRETCH = 500_000
BLOCK = 16 << 20

#: Characters over which the pattern of the rank file and that of the tokenizer are known to agree.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ʯЀ-ԯ‐-‧]*")

_LINKS = """
CREATE OR REPLACE TEMP TABLE links AS
SELECT a.part, a.id AS a, b.id AS b FROM a ASOF JOIN b ON a.lo >= b.lo
UNION ALL
SELECT b.part, a.id, b.id FROM b ASOF JOIN a ON b.lo > a.lo WHERE b.lo < a.hi
"""
_PAIRS = "SELECT part, a, b, count(*) AS n FROM links GROUP BY ALL ORDER BY part"


class ByteTokenizer:
    """Ids of byte_bpe_50k.json, special tokens being plain text, and each id's bytes."""

    def __init__(self, path: str, ranks: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        with open(ranks, "rb") as file:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.quick = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
        letters = byte_alphabet()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            known = all(c in letters for c in token)
            self.bytes[number] = bytes(letters[c] for c in token) if known else token.encode()

    def encode(self, text: str) -> list[int]:
        if _PLAIN.fullmatch(text):
            return self.quick.encode_ordinary(text)
        return self.whole.encode(text, add_special_tokens=False).ids


class PieceTokenizer:
    """Ids of piece_bpe_32k.model, and each id's bytes."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = range(self.model.get_piece_size())
        self.bytes = [self._bytes(number, self.model.id_to_piece(number)) for number in pieces]

    def _bytes(self, number: int, piece: str) -> bytes:
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(number) else piece.replace("▁", " ").encode()

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)


_loaded: dict[tuple[str, str, str], tuple[ByteTokenizer, PieceTokenizer]] = {}


def tokenizers(
    bytes_json: str = "byte_bpe_50k.json", ranks: str = "byte_bpe_50k.tiktoken", pieces: str = "piece_bpe_32k.model"
) -> tuple[ByteTokenizer, PieceTokenizer]:
    """This worker's two tokenizers, for files of public_tokenizers."""
    key = (bytes_json, ranks, pieces)
    if key not in _loaded:
        _loaded[key] = (
            ByteTokenizer(public_tokenizers.path(bytes_json), public_tokenizers.path(ranks)),
            PieceTokenizer(public_tokenizers.path(pieces)),
        )
    return _loaded[key]


class Aligner:
    """Token intervals of a stretch of parts of documents, joined in DuckDB."""

    def __init__(self) -> None:
        self.a, self.b = tokenizers()
        self.sizes = [np.array([len(token) for token in side.bytes]) for side in (self.a, self.b)]
        self.base = len(self.b.bytes)
        self.db = duckdb.connect(config={"threads": 1, "temp_directory": ""})
        # each id as text before a comma, a bar, a semicolon and nothing
        self.ids = max(len(self.a.bytes), self.base)
        self.texts = pa.array([f"{number}{end}".encode() for end in (",", "|", ";", "") for number in range(self.ids)], pa.binary())

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides, none where one of them does not give the text's bytes back."""
        none = np.empty(0, np.int64)
        if not text:
            return none, none
        whole, a, b = f" {text}".encode(), self.a.encode(f" {text}"), self.b.encode(text)
        if self.a.quick.decode_bytes(a) != whole or b"".join(map(self.b.bytes.__getitem__, b)) != whole:
            return none, none
        return np.array(a, np.int64), np.array(b, np.int64)

    def parts(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """A document's tokens, those of a long one in parts that end where both sides end."""
        if len(a) + len(b) <= STRETCH:
            yield a, b
            return
        ends = [np.cumsum(size[ids]) for size, ids in zip(self.sizes, (a, b))]
        both = np.intersect1d(*ends, assume_unique=True)
        at = [np.searchsorted(end, both) + 1 for end in ends]
        goals = np.arange(STRETCH, len(a) + len(b), STRETCH)
        chosen = np.unique(np.append(np.searchsorted(at[0] + at[1], goals), len(both) - 1))
        i = j = 0
        for k, m in zip(at[0][chosen], at[1][chosen]):
            yield a[i:k], b[j:m]
            i, j = k, m

    def _table(self, side: int, parts: list[np.ndarray]) -> pa.Table:
        ids = np.concatenate(parts)
        hi = np.cumsum(self.sizes[side][ids])
        part = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) for p in parts])
        lo = hi - self.sizes[side][ids]
        return pa.table({"part": part, "id": ids.astype(np.int32), "lo": lo.astype(np.int32), "hi": hi.astype(np.int32)})

    def align(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[str, int, np.ndarray, np.ndarray]]:
        """For each part: its groups as text, their number, and the keys and counts of its linked pairs."""
        ids, ends = [], []
        for side, name in enumerate("ab"):
            table = self._table(side, [p[side] for p in parts])
            ids.append(table.column("id").to_numpy())
            ends.append(table.column("hi").to_numpy())
            self.db.register(f"given_{name}", table)
            self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS FROM given_{name}")
            self.db.unregister(f"given_{name}")
        self.db.execute(_LINKS)
        pairs = self.db.sql(_PAIRS).fetchnumpy()
        keys = pairs["a"].astype(np.int64) * self.base + pairs["b"]
        pair_ends = np.searchsorted(pairs["part"], np.arange(len(parts) + 1))

        # a token's cell: how many ends that both sides share stand before it
        shared = np.intersect1d(*ends, assume_unique=True)
        cells = [np.searchsorted(shared, end, "left") for end in ends]
        ends, names = self._places(parts, ids, cells)
        # one buffer for all parts, no object for a token
        _, bounds, texts = self.texts.take(pa.array(names)).buffers()
        bounds, texts = np.frombuffer(bounds, np.int32), memoryview(texts)
        low = 0
        for p, high in enumerate(np.flatnonzero(ends == 3) + 1):
            some = slice(pair_ends[p], pair_ends[p + 1])
            groups = 1 + np.count_nonzero(ends[low:high] == 2)
            yield str(texts[bounds[low] : bounds[high]], "ascii"), int(groups), keys[some], pairs["n"][some].astype(np.int64)
            low = high

    def _places(self, parts, ids: list[np.ndarray], cells: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """All tokens by cell, then side: what follows each (0 token, 1 other side, 2 cell, 3 part), and its text's number."""
        a, b = cells
        # a token stands behind its own side's tokens and the other side's tokens of earlier cells, or of its own cell for B
        place_a = np.arange(len(a)) + np.searchsorted(b, a, "left")
        place_b = np.arange(len(b)) + np.searchsorted(a, b, "right")
        ends, names = np.zeros(len(a) + len(b), np.int8), np.empty(len(a) + len(b), np.int64)
        names[place_a], names[place_b] = ids
        ends[place_a[np.append(a[1:] != a[:-1], True)]] = 1
        ends[place_b[np.append(b[1:] != b[:-1], True)]] = 2
        ends[place_b[np.cumsum([len(p[1]) for p in parts]) - 1]] = 3
        return ends, ends.astype(np.int64) * self.ids + names


class _Document:
    """What is known of a document while its parts are aligned."""

    def __init__(self, doc_id: int | None, n_a: int, n_b: int):
        self.doc_id, self.n_a, self.n_b, self.n_groups = doc_id, n_a, n_b, 0
        self.keys, self.counts, self.digest = [], [], hashlib.sha256()

    def add(self, text: str, groups: int, keys: np.ndarray, counts: np.ndarray) -> None:
        if self.n_groups:
            self.digest.update(b";")
        self.digest.update(text.encode())
        self.n_groups += groups
        self.keys.append(keys)
        self.counts.append(counts)


_ALIGNED = pa.schema(
    [
        ("block", pa.int64()),
        ("whole", pa.bool_()),
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("groups_sha256", pa.string()),
        ("pairs", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())),
    ]
)


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their own pairs, and for each block one row (whole) with the counts of all its pairs."""
    aligner, first = Aligner(), TaskContext.get().partitionId() << 32
    block, size, waiting, parts = first, 0, [], []
    block_keys, block_counts = [], []

    def settle() -> Iterator[pa.RecordBatch]:
        if parts:
            for document, found in zip([d for d, _ in parts], aligner.align([p for _, p in parts])):
                document.add(*found)
        rows = []
        for d in waiting:
            keys, counts = (np.concatenate([np.empty(0, np.int64), *x]) for x in (d.keys, d.counts))
            block_keys.append(keys)
            block_counts.append(counts)
            sha = d.digest.hexdigest() if d.n_a else ""
            rows.append((block, False, d.doc_id, d.n_a, d.n_b, d.n_groups, sha, keys, counts))
        parts.clear()
        waiting.clear()
        fold()
        yield _batch(rows)

    def fold() -> None:
        """The block's counts, one for each pair."""
        if block_keys:
            keys, at = np.unique(np.concatenate(block_keys), return_inverse=True)
            counts = np.zeros(len(keys), np.int64)
            np.add.at(counts, at, np.concatenate(block_counts))
            block_keys[:], block_counts[:] = [keys], [counts]

    def close() -> Iterator[pa.RecordBatch]:
        if block_keys:
            yield _batch([(block, True, None, 0, 0, 0, None, block_keys[0], block_counts[0])])
            block_keys.clear()
            block_counts.clear()

    held = 0
    for batch in batches:
        for doc_id, raw in zip(*(column.to_pylist() for column in batch.columns)):
            a, b = aligner.encode((raw or b"").decode(errors="replace"))
            document = _Document(doc_id, len(a), len(b))
            for part in aligner.parts(a, b) if len(a) else ():
                if held and held + len(part[0]) + len(part[1]) > STRETCH:
                    yield from settle()
                    held = 0
                parts.append((document, part))
                held += len(part[0]) + len(part[1])
            waiting.append(document)
            size += len(raw or b"")
            if len(waiting) >= 10_000 or size >= BLOCK:
                yield from settle()
                held = 0
            if size >= BLOCK:
                yield from close()
                block, size = block + 1, 0
    yield from settle()
    yield from close()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_ALIGNED)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ALIGNED)], schema=_ALIGNED)


def _sum_up(docs: pa.Table, known: pa.Table) -> pa.Table:
    """Sums over the pairs of a block's documents, from the corpus-wide counts of that block's pairs."""
    keys, totals, best = (known.column(c).to_numpy() for c in ("pair", "total", "best"))
    order = np.argsort(keys)
    pairs = docs.column("pairs").combine_chunks()
    flat = pairs.flatten().to_numpy()
    n = docs.column("counts").combine_chunks().flatten().to_numpy()
    at = order[np.searchsorted(keys[order], flat)] if len(flat) else np.empty(0, np.int64)
    bounds = np.concatenate([[0], np.cumsum(pairs.value_lengths().to_numpy())])

    def of_documents(values: np.ndarray) -> pa.Array:
        sums = np.concatenate([[0], np.cumsum(values)])
        return pa.array(sums[bounds[1:]] - sums[bounds[:-1]], pa.int64())

    kept = docs.select(["doc_id", "n_a", "n_b", "n_groups"])
    kept = kept.append_column("n_links", of_documents(n))
    kept = kept.append_column("n_best", of_documents(n * best[at]))
    kept = kept.append_column("count_sum", of_documents(n * totals[at]))
    return kept.append_column("groups_sha256", docs.column("groups_sha256"))


def align_tokenizers(docs: DataFrame) -> DataFrame:
    """Alignment of two vocabularies' tokens, summed by document.

    docs: doc_id, text and any other columns, which are ignored.  A: byte_bpe_50k.json on a space and the
    text; B: piece_bpe_32k.model on the text, which adds the space; special tokens are plain text.  Returns doc_id,
    n_a, n_b (tokens), n_groups (pieces between byte offsets where tokens of both end), n_links
    (pairs of tokens that share bytes), n_best (links whose id pair has, over all documents, as many links as any
    pair of that B id), count_sum (over links, how many links all documents hold of that id pair), groups_sha256
    (of `a1,a2|b1;a3|b2,b3`, decimal ids in order).  Texts that are null or empty, or whose tokens do not give
    the bytes back (as text that holds U+2581 or isn't valid UTF-8), have no tokens: zeros and an
    empty string.  Rows that repeat a doc_id are documents of their own; an empty table gives an empty result.
    """
    given = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    schema = (
        "block long, whole boolean, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
        "pairs array<long>, counts array<long>"
    )
    aligned = cut(given.mapInArrow(_align, schema))
    blocks = aligned.where("whole").select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("row"))
    blocks = blocks.select(F.col("block").alias("of_block"), F.col("row.pairs").alias("pair"), F.col("row.counts").alias("n"))
    counts = blocks.groupBy("pair").agg(F.sum("n").alias("total"))
    # a B id has at most as many pairs as A has ids
    of_b = Window.partitionBy(F.col("pair") % len(tokenizers()[1].bytes))
    counts = counts.withColumn("best", F.col("total") == F.max("total").over(of_b))
    known = blocks.drop("n").join(counts, "pair")
    rows = aligned.where("not whole").drop("whole").groupBy("block").cogroup(known.groupBy("of_block"))
    result = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.applyInArrow(_sum_up, result)
