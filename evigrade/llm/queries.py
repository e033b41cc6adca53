"""The thin queries opN_<name>: each applies one operator to its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evigrade.llm.alignment import align_tokenizers
from evigrade.llm.divergence import audit_sources
from evigrade.llm.embedding_join import cosine_links
from evigrade.llm.fingerprints import fingerprints_with_edits
from evigrade.llm.license_scan import scan_licenses
from evigrade.llm.minhash_dedup import near_duplicates
from evigrade.llm.mixing import SCHEDULES, mix_positions
from evigrade.llm.neighbours import nearest
from evigrade.llm.packing import pack_documents
from evigrade.llm.rollups import RollupStore, count_documents, deletes, inserts, revisions
from evigrade.llm.sharding import balanced_shards
from evigrade.llm.surrogates import replace_pii
from evigrade.llm.toxicity import score_documents
from evigrade.session import at_release, cut, load, shared_dir, spread


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(load(spark, sf_dir, "documents"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), load(spark, sf_dir, "labels"))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(documents(spark, sf_dir)).select("doc_id", "text", "n_entities", "entity_kinds")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints_with_edits(documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in under four tokenizer versions; one is then revised and one deleted; batches are committed twice."""
    counts = cut(count_documents(documents(spark, sf_dir)))
    store = RollupStore(spark, f"{shared_dir(spark)}/rollups-{uuid.uuid4().hex}")
    at_release(store.path)
    batches = {
        "001-word-bpe": inserts(counts, "word_bpe_49k@1", "tokens"),
        "002-white-space": inserts(counts, "white_space@1", "words"),
        "003-utf8-words": inserts(counts, "word_bpe_49k@2", "words"),
        "004-trial": inserts(counts, "trial@1", "words"),
        "005-recount": revisions(counts, "word_bpe_49k@2", "words", "tokens"),
        "006-no-trial": deletes(counts, "trial@1", "words"),
    }
    for name in [*batches, *batches]:
        store.commit(name, batches[name])
    return store.totals()


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cosine_links(spread(load(spark, sf_dir, "embeddings")), 0.9)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), width=3, percent=85)


def op9_balanced_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(documents(spark, sf_dir))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes, and when and at which position of the training order each of a document's two copies is due."""
    plan = mix_positions(documents(spark, sf_dir))

    def of_copy(copy: int):
        return F.get(F.filter("takes", lambda take: take["copy"] == copy), F.lit(0))

    due = [of_copy(0), of_copy(1)]
    times = [F.round(take["time"], 9).alias(f"{name}_time") for name, take in zip(("first", "second"), due)]
    positions = [take["position"].alias(f"{name}_position") for name, take in zip(("first", "second"), due)]
    return plan.select("doc_id", "size", "source_size", "target", "taken", *times, *positions)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(documents(spark, sf_dir))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(documents(spark, sf_dir))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spread(load(spark, sf_dir, "embeddings")), F.col("vec_id") % 20 == 0, 20)


def _knots() -> str:
    """The sources' schedules as rows of SQL values: class, piece, its two times and two multipliers."""
    rows = []
    for kind, knots in enumerate(SCHEDULES):
        for piece, ((a, u), (b, v)) in enumerate(zip(knots, knots[1:])):
            rows.append(f"({kind}, {piece}, {a!r}e0, {b!r}e0, {u!r}e0, {v!r}e0)")
    return ", ".join(rows)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_pii_surrogates": op2_pii_surrogates,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_token_counts": op5_token_counts,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_balanced_sharding": op9_balanced_sharding,
    "op10_source_mixing": op10_source_mixing,
    "op11_source_divergence": op11_source_divergence,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

#: DuckDB SQL for the same rows.
ORACLES: dict[str, str] = {
    "op10_source_mixing": r"""
WITH knots(kind, piece, a, b, u, v) AS (
  VALUES """
    + _knots()
    + r"""
), areas AS (
  SELECT *, (b - a) * (u + v) / 2 AS own, sum((b - a) * (u + v) / 2) OVER (PARTITION BY kind) AS area FROM knots
), pieces AS (
  SELECT kind, piece, a AS start, u / area AS weight, (v - u) / area / (b - a) AS slope,
         coalesce(sum(own / area) OVER (PARTITION BY kind ORDER BY piece
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM areas
), sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS kind,
         CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS DOUBLE) AS weight,
         CAST(source_size * 2 AS DOUBLE) AS most
  FROM totals
), levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 150 / 100
             - coalesce(sum(most) OVER (ORDER BY most / weight, source ASC NULLS LAST
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY most / weight, source ASC NULLS LAST
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted
), targets AS (
  SELECT source, source_size, kind,
         CASE WHEN most / weight <= level THEN most
              ELSE weight * max(CASE WHEN most / weight > level THEN level END) OVER () END AS target
  FROM levels
), placed AS (
  SELECT d.doc_id, d.source, t.kind, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS wanted,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.size
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), takes AS (
  SELECT *, start + copy * source_size AS begins,
         CAST(least(greatest(wanted - start - copy * source_size, 0), size) AS BIGINT) AS words
  FROM placed, (VALUES (0), (1)) AS copies(copy)
), due AS (
  SELECT t.*, p.start + CASE WHEN p.weight + sqrt(greatest(p.weight * p.weight + 2 * p.slope * rest, 0)) = 0 THEN 0
                             ELSE 2 * rest / (p.weight + sqrt(greatest(p.weight * p.weight + 2 * p.slope * rest, 0))) END AS time
  FROM (SELECT t.*, q.piece, greatest(t.begins / t.wanted - q.before, 0) AS rest,
               row_number() OVER (PARTITION BY t.doc_id, t.copy ORDER BY q.piece DESC) AS later
        FROM takes t JOIN pieces q ON q.kind = t.kind AND (q.piece = 0 OR t.begins / t.wanted >= q.before)
        WHERE t.words > 0) t
  JOIN pieces p ON p.kind = t.kind AND p.piece = t.piece WHERE later = 1
), ordered AS (
  SELECT doc_id, copy, least(time, 1) AS time,
         row_number() OVER (ORDER BY least(time, 1), source ASC NULLS FIRST, copy, doc_id ASC NULLS FIRST) - 1 AS position FROM due
)
SELECT p.doc_id, p.size, p.source_size, p.target,
       CAST(least(greatest(p.wanted - p.start, 0), p.size)
            + least(greatest(p.wanted - p.start - p.source_size, 0), p.size) AS BIGINT) AS taken,
       round(f.time, 9) AS first_time, round(s.time, 9) AS second_time,
       f.position AS first_position, s.position AS second_position
FROM placed p LEFT JOIN ordered f ON f.doc_id = p.doc_id AND f.copy = 0 LEFT JOIN ordered s ON s.doc_id = p.doc_id AND s.copy = 1
""",
    "op11_source_divergence": r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), places AS (
  SELECT doc, lang, source, unnest(words) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM places GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM places GROUP BY ALL
), grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
  FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
  SELECT lang, source, term, n,
         1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER g + count(*) OVER g) AS p,
         1 + 1000000000::HUGEINT * (lang_n + 1) // (sum(lang_n) OVER g + count(*) OVER g) AS q
  FROM grid WINDOW g AS (PARTITION BY lang, source)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL
), rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM rows QUALIFY part = 'pair' OR rank <= 200
""",
}
