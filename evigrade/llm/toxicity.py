"""Toxicity by weak supervision.

1. All training rows with labels, equal texts once, show which words and word beginnings
   mark toxic texts: mined lexicons, by whole word and by beginning.
2. One pass over all whole texts lets every voter speak (fixed lexicons, mined
   lexicons, patterns) and notes which mined features a text has.
3. Counts of vote patterns over all training rows, labels being one more voter
   where they are known, fit the generative label model with its correlations.
4. A linear classifier is trained on the posteriors and scores every text.

Held-out rows are never read for 1, 3 and 4's fit.  Labels, language, source and
doc_id are no inputs of a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evigrade.llm import text_kernel as tk
from evigrade.llm.label_model import LabelModel, fit_label_model, fit_linear
from evigrade.session import cut

#: Rows on which the linear classifier is fitted, at most, those with labels first.  All counts are over all rows.
SAMPLE_ROWS = 20_000
#: Bits of the bitmap that names labelled documents.
MEMBER_BITS = 1 << 26
#: Features that should reach each toxic training row, where so many are telling.
REACH = 2
#: Bytes of the word beginnings that are features beside whole words.
BEGINNINGS = (4, 5, 6, 7, 8, 9)
THRESHOLD = 0.3
_BITS = 22

#: Fixed lexicons, one voter each: words that insult, swear or call people things, by language.
LEXICONS = {
    "insults_en": """idiot idiots moron morons stupid dumb loser losers pathetic worthless clown imbecile jerk ugly
coward creep liar""",
    "contempt_en": "scum trash disgusting freak filthy vermin garbage hate retard pig",
    "profanity_en": "bastard bitch asshole crap shit fuck fucking whore slut",
    "lexicon_es": "idiota imbécil estúpido basura asqueroso maldito cabrón puta mierda",
    "lexicon_de": "idiotin dummkopf arschloch abschaum wertlos ekelhaft scheiße trottel hurensohn",
    "lexicon_fr": "débile imbécile connard salaud ordure minable crétin dégueulasse putain merde",
}
#: Patterns, one voter each.
SPOKEN = {
    "spoken": re.compile(r"\b(?:shut up|nobody likes you|you are (?:a|an|so) \w+ (?:idiot|loser|moron)|i hate you|get lost)\b", re.I),
    "threats": re.compile(r"\b(?:go to hell|kill yourself|drop dead|hope you die|i will (?:kill|hurt) you)\b", re.I),
    "masked": re.compile(r"\b(?:[i1!]d[i1!]0t|m0r0n|l0s[e3]r|st[u\*]p[i1]d|b[i1\*]tch|sh[i1\*]t|f[u\*]ck|a\$\$)\b", re.I),
    "named": re.compile(r"\byou (?:are |all |\w{1,9} ){0,2}(?:idiot|moron|loser|scum|trash|liar|coward|clown|freak)s?\b", re.I),
}

VOTERS = (*LEXICONS, "mined_words", "mined_beginnings", "several_hits", *SPOKEN, "shouting")
_FIRST_MINED, _FIRST_SPOKEN = len(LEXICONS), len(LEXICONS) + 3
#: What a text without any hit must have, in words, to count as clean for the mined voters.
CLEAN_WORDS = 3


def held_out(doc_id: Column) -> Column:
    """Rows that only measure: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _features(words: tk.Words) -> list[np.ndarray]:
    """For whole words and for each beginning, a hash of every word; 0 where a word is no longer than that."""
    length = words.ends - words.starts
    out = [words.hashes(seed=1)]
    for n in BEGINNINGS:
        stop = np.minimum(words.starts + n, words.ends)
        found = words.span_hashes(words.starts, stop, seed=10 + n)
        out.append(np.where(length > n, found, np.uint64(0)))
    return out


def _short(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - _BITS)).astype(np.int32)


def _lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(tk.as_strings(column))


def _feature_rows(docs: DataFrame, schema: str, make) -> DataFrame:
    """Run make(features, rows, toxic, part) over the distinct (text, feature) pairs of slices of (row, toxic, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        separates, codes = tk.separators("alnum"), tk.byte_codes()
        for batch in batches:
            names, toxic = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for part in tk.slices(_lower(batch.column(2))):
                words = tk.scan_words(part, separates, codes)
                pairs = []
                for i, hashes in enumerate(_features(words)):
                    at = np.flatnonzero(hashes != 0)
                    pairs.append(words.text[at].astype(np.int64) << 32 | (_short(hashes[at]).astype(np.int64) + (i << _BITS)))
                pairs = np.unique(np.concatenate(pairs))
                own = slice(part.first, part.last)
                yield make(pairs & 0xFFFFFFFF, pairs >> 32, names[own], toxic[own])

    return docs.select("row", "toxic", "text").mapInArrow(run, schema)


def count_features(docs: DataFrame) -> DataFrame:
    """(feature, a, n): toxic weight and number of the texts (row, toxic, text) that have each feature."""

    def make(features, at, names, toxic):
        found, inverse = np.unique(features, return_inverse=True)
        a = np.bincount(inverse, toxic[at], len(found))
        n = np.bincount(inverse, minlength=len(found))
        return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(a), pa.array(n)], names=["feature", "a", "n"])

    counts = _feature_rows(docs, "feature int, a double, n long", make)
    return counts.groupBy("feature").agg(F.sum("a").alias("a"), F.sum("n").alias("n"))


def meet_features(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(row, toxic, feature): which of the wanted features each text (row, toxic, text) has."""
    bitmap = np.zeros((1 + len(BEGINNINGS)) << _BITS, bool)
    bitmap[wanted] = True
    packed = np.packbits(bitmap)

    def make(features, at, names, toxic):
        keep = packed[features >> 3] & (128 >> (features & 7)).astype(np.uint8) > 0
        at = at[keep]
        columns = [pa.array(names[at]), pa.array(toxic[at]), pa.array(features[keep].astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=["row", "toxic", "feature"])

    return _feature_rows(docs, "row long, toxic double, feature int", make)


def wilson_low(a: Column, n: Column, z: float) -> Column:
    """The lower end of the Wilson interval of a share."""
    share = a / n
    return (share + z * z / (2 * n) - z * F.sqrt(F.greatest(share * (1 - share), F.lit(0.0)) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def cover(met: DataFrame, times: int = REACH) -> list[int]:
    """Features that reach every toxic row `times` times, where they can.

    met: (row, toxic, feature).  In each round every open toxic row names the feature
    that adds most toxic rows, among rows not yet reached; its share of toxic rows
    there must be safely above one half (Wilson, z = 2.6).  The features named are
    taken and rows that they reach `times` times close.  So words that only come
    along with telling ones, as in copies of one toxic text, are not taken.
    """
    taken: list[int] = []
    open_rows = met
    while True:
        counts = open_rows.groupBy("feature").agg(F.sum("toxic").alias("a"), F.count("*").alias("n"))
        low = wilson_low(F.col("a"), F.col("n"), 2.6)
        good = counts.withColumn("gain", F.when(low > 0.5, F.col("a") * low)).where("gain is not null")
        best = F.max_by("feature", F.struct("gain", -F.col("feature")))
        named = open_rows.where("toxic > 0.5").join(good.select("feature", "gain"), "feature").groupBy("row").agg(best.alias("feature"))
        new = cut(named.select("feature").distinct())
        found = [r[0] for r in new.collect()]
        if not found:
            return taken
        taken += sorted(found)
        hit = open_rows.join(F.broadcast(new), "feature")
        reached = hit.groupBy("row").agg(F.count("*").alias("now"))
        left = open_rows.join(F.broadcast(new), "feature", "left_anti").join(reached, "row", "left")
        left = left.withColumn("hits", F.col("hits") + F.coalesce("now", F.lit(0))) if "hits" in left.columns else left.withColumn("hits", F.coalesce("now", F.lit(0)))
        open_rows = cut(left.where(F.col("hits") < times).drop("now"))


def may_be_in(doc_id: Column, table: DataFrame) -> Column:
    """Whether a hash of the doc_id is among those of the table: false for most that aren't there, true for all that are.

    The hashes are a bitmap of MEMBER_BITS bits, whatever the table's size; a very long table lets more through.
    """
    of = lambda c: F.pmod(F.xxhash64(c, F.lit(17)), F.lit(MEMBER_BITS))
    hashed = table.where("doc_id is not null").select(of(F.col("doc_id")).alias("h"))
    position = F.col("h").bitwiseAND(F.lit(32767))
    parts = hashed.groupBy(F.shiftright("h", 15).alias("part")).agg(F.bitmap_construct_agg(position).alias("bits")).collect()
    bitmap = np.zeros(MEMBER_BITS >> 3, np.uint8)
    for r in parts:
        bitmap[r["part"] << 12 : (r["part"] + 1) << 12] = np.frombuffer(bytes(r["bits"]), np.uint8)

    @F.pandas_udf("boolean")
    def known(h: pd.Series) -> pd.Series:
        at = h.to_numpy()
        return pd.Series((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0)

    return doc_id.isNotNull() & known(of(F.coalesce(doc_id, F.lit(0))))


def mine_features(docs: DataFrame, labels: DataFrame) -> list[int]:
    """Features that mark toxic texts among all training labels.

    Equal texts count once, with the mean of their labels.  Candidates have the lower end
    of the Wilson interval (z = 2) of their share of toxic texts above one half;
    cover() takes from them.  There are no more features than hashes, 7 * 2 ** 22.
    """
    train = labels.where(~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long"), F.col("toxic").cast("double"))
    train = train.where("doc_id is not null and toxic is not null")
    given = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("row"), "text")
    single = given.select("doc_id", "row").join(train, "doc_id").groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.avg("toxic").alias("toxic"))
    single = cut(single)
    # only texts that may have a label travel to the join, which then decides; it is a shuffle at every size
    likely = given.where(may_be_in(F.col("doc_id"), single))
    texts = cut(likely.join(single.hint("merge"), ["doc_id", "row"]).select("row", "toxic", "text"))
    counts = count_features(texts).where(wilson_low(F.col("a"), F.col("n"), 2.0) > 0.5)
    wanted = counts.select("feature").toArrow()["feature"].to_numpy()
    if not len(wanted):
        return []
    return cover(cut(meet_features(texts, wanted)))


def fixed_features() -> list[int]:
    """The features of the fixed lexicons' words."""
    return [int(f) for f in np.unique(np.concatenate([_short(_lexicon(w)) for w in LEXICONS.values()]))]


def _lexicon(words: str) -> np.ndarray:
    """Sorted hashes of a lexicon's words, as _features() gives them for whole words."""
    column = pa.array([words], pa.large_string())
    part = next(tk.slices(_lower(column)))
    return np.unique(tk.scan_words(part, tk.separators("alnum"), tk.byte_codes()).hashes(seed=1))


def _bits(members: np.ndarray, size: int) -> np.ndarray:
    """A packed bitmap of the members."""
    table = np.zeros(size, bool)
    table[members] = True
    return np.packbits(table)


def _in_bits(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Positions of values that are in a packed bitmap."""
    return np.flatnonzero(bits[values >> 3] & (128 >> (values & 7)).astype(np.uint8))


def _member(values: np.ndarray, table: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Positions of values that are members; table is a packed bitmap of their short forms."""
    at = _in_bits(table, _short(values))
    return at[np.isin(values[at], members)]


class Places:
    """Where each feature stands in a list: a packed bitmap of all features there may be, and the sorted ones that are."""

    def __init__(self, features: list[int]):
        given = np.array(features, np.int32)
        self.order = np.argsort(given).astype(np.int32)
        self.sorted = given[self.order]
        self.bits = _bits(given, (1 + len(BEGINNINGS)) << _BITS)

    def find(self, kind: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the hashes of a kind that are features, and the places of these."""
        values = _short(hashes) + np.int32(kind << _BITS)
        at = _in_bits(self.bits, values)
        at = at[hashes[at] != 0]
        return at, self.order[np.searchsorted(self.sorted, values[at])]


def read_texts(docs: DataFrame, features: list[int], mined: set[int], keep: bool = False) -> DataFrame:
    """Votes, features and shape of every whole text: doc_id, votes, hits, shape; with keep also the columns of docs, by number (text: kept_text)."""
    is_mined = np.array([f in mined for f in features] or [False])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        separates, codes = tk.separators("alnum"), tk.byte_codes()
        places = Places(features)
        lexicons = []
        for words in LEXICONS.values():
            members = _lexicon(words)
            lexicons.append((_bits(_short(members), 1 << _BITS), members))
        for batch in batches:
            column = tk.as_strings(batch.column(1))
            lowered = _lower(column)
            for part in tk.slices(lowered):
                n = part.last - part.first
                words = tk.scan_words(part, separates, codes)
                count = np.diff(words.first_of)
                whole, *beginnings = _features(words)
                kinds = []
                for kind, hashes in enumerate([whole, *beginnings]):
                    at, found = places.find(kind, hashes)
                    kinds.append((words.text[at], found))
                votes = np.zeros((n, len(VOTERS)), np.int8)
                for v, (table, members) in enumerate(lexicons):
                    votes[words.text[_member(whole, table, members)], v] = 2
                clean = count >= CLEAN_WORDS
                rows = np.concatenate([r for r, _ in kinds])
                hits = np.concatenate([h for _, h in kinds])
                for v, some in ((_FIRST_MINED, kinds[:1]), (_FIRST_MINED + 1, kinds[1:])):
                    votes[clean, v] = 1
                    votes[np.concatenate([r[is_mined[h]] for r, h in some]), v] = 2
                pairs = np.unique(rows.astype(np.int64) << 32 | hits)
                rows, hits = (pairs >> 32).astype(np.int64), (pairs & 0xFFFFFFFF).astype(np.int32)
                several = np.bincount(rows, minlength=n)
                votes[several >= 3, _FIRST_MINED + 2] = 2
                votes[clean & (several == 0), _FIRST_MINED + 2] = 1
                own = column.slice(part.first, n)
                texts = own.to_pylist()
                shape = np.zeros((n, 4))
                raw = next(tk.slices(own, 1 << 62))
                caps = np.zeros(len(raw.data) + 1, np.int64)
                np.cumsum((raw.data >= 0x41) & (raw.data <= 0x5A), out=caps[1:])
                loud = np.zeros(len(raw.data) + 1, np.int64)
                np.cumsum(raw.data == 0x21, out=loud[1:])
                size = np.maximum(1, np.diff(raw.offsets))
                shape[:, 0] = np.log1p(count)
                shape[:, 1] = np.diff(caps[raw.offsets]) / size
                shape[:, 2] = np.diff(loud[raw.offsets]) / size
                shape[:, 3] = np.minimum(several, 8)
                for i, text in enumerate(texts):
                    for v, pattern in enumerate(SPOKEN.values(), _FIRST_SPOKEN):
                        if pattern.search(text):
                            votes[i, v] = 2
                votes[(shape[:, 1] > 0.3) & (shape[:, 2] > 0.02), -1] = 2
                bounds = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int32)
                code = np.zeros(n, np.int64)
                for v in range(len(VOTERS)):
                    code = 3 * code + votes[:, v]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, n),
                        pa.array(code.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(hits)),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(0, 4 * n + 1, 4, dtype=np.int32)), pa.array(shape.ravel())
                        ),
                        *([batch.column(1).slice(part.first, n), *(other.slice(part.first, n) for other in batch.columns[2:])] if keep else []),
                    ],
                    names=names,
                )

    others = [F.col(f"`{name}`").alias(kept) for name, kept in _kept(docs) if kept != "kept_text"] if keep else []
    given = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *others)
    schema = StructType.fromDDL("doc_id long, votes int, hits array<int>, shape array<double>" + ", kept_text string" * keep)
    schema = StructType([*schema.fields, *given.schema.fields[2:]])
    names = schema.names
    return given.mapInArrow(run, schema)


def _kept(docs: DataFrame) -> list[tuple[str, str]]:
    """Each column's name and that under which read_texts() hands it on."""
    return [(name, "kept_text" if name.lower() == "text" else f"kept_{i}") for i, name in enumerate(docs.columns)]


def _votes_of(codes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(codes), len(VOTERS)), np.int64)
    for v in reversed(range(len(VOTERS))):
        out[:, v] = codes % 3
        codes = codes // 3
    return out


@dataclass
class ToxicityModel:
    features: list[int]
    voters: LabelModel
    weights: np.ndarray
    shape_weights: np.ndarray
    bias: float

    def score(self, seen: DataFrame) -> DataFrame:
        """Add the probability that a text is toxic to what read_texts() found."""
        weights = F.lit([float(w) for w in self.weights] or [0.0])
        logit = F.aggregate("hits", F.lit(self.bias), lambda total, i: total + F.element_at(weights, i + 1))
        for i, w in enumerate(self.shape_weights.tolist()):
            logit = logit + F.element_at("shape", i + 1) * w
        return seen.withColumn("score", 1 / (1 + F.exp(-logit)))


def fit(docs: DataFrame, labels: DataFrame, keep: bool = False) -> tuple[ToxicityModel, DataFrame]:
    """The model, fitted on training rows, and what read_texts() found in all rows, with their columns if they are to be kept."""
    known = labels.select(F.col("doc_id").cast("long"), "toxic").where("doc_id is not null")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    mined = mine_features(docs, known)
    features = list(dict.fromkeys([*mined, *fixed_features()]))
    seen = cut(read_texts(docs, features, set(mined), keep))
    train = seen.where(~held_out(F.col("doc_id"))).join(known, "doc_id", "left")
    told = F.when(F.col("toxic") == 1, 2).when(F.col("toxic") == 0, 1).otherwise(0).alias("told")
    patterns = train.groupBy("votes", told).agg(F.count("*").alias("n")).collect()
    patterns.sort(key=lambda r: (r["votes"], r["told"]))
    if not patterns:
        nobody = LabelModel([], 0.1, [])
        return ToxicityModel(features, nobody, np.zeros(len(features)), np.zeros(4), -2.0), seen
    codes = np.array([r["votes"] for r in patterns])
    votes = np.column_stack([_votes_of(codes), [r["told"] for r in patterns]])
    voters = fit_label_model(votes, np.array([r["n"] for r in patterns]), len(VOTERS))

    order = (F.xxhash64("doc_id", F.lit(5)), F.col("doc_id"))
    sample = train.select("doc_id", "votes", told, "hits", "shape").orderBy((told == 0).cast("int"), *order)
    rows = sample.limit(SAMPLE_ROWS).drop("doc_id").toArrow()
    votes = np.column_stack([_votes_of(rows["votes"].to_numpy()), rows["told"].to_numpy()])
    target = voters.posterior(votes)
    hits = rows["hits"].combine_chunks()
    lengths = np.asarray(hits.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    columns = hits.flatten().to_numpy(zero_copy_only=False)
    shape = rows["shape"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
    n = len(target)
    row = np.repeat(np.arange(n), lengths)
    weights, shape_weights, bias = fit_linear(row, columns, n, len(features), shape, target)
    return ToxicityModel(features, voters, weights, shape_weights, bias), seen


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row with its toxicity.

    docs: doc_id, text; labels: doc_id, toxic; other columns of either are ignored.
    One row per row: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.3).
    Lexicons are mined from all training labels and votes are counted over all training
    rows; the linear classifier is fitted on SAMPLE_ROWS rows at most.  The label model
    joins up to label_model.CLIQUE correlated voters; weaker correlations beyond that count as
    independent.  Null and empty texts are scored as texts without words.  Of several
    labels of a document the highest counts; null labels are no labels.  Rows that repeat a
    doc_id each get their text's score.  A null doc_id has
    no label and is not held out.  Without any training rows every text gets the
    same low score; an empty table gives an empty result.
    """
    model, seen = fit(docs, labels)
    scored = model.score(seen)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows whose score is at least the threshold; same columns.

    Scores are as in score_documents(), also those of nulls, empty texts and rows that
    repeat a doc_id; each row goes or stays by its own text.  An empty table gives an empty result.
    """
    model, seen = fit(docs, labels, keep=True)
    clean = model.score(seen).where(F.col("score") < threshold)
    return clean.select(*[F.col(kept).alias(name) for name, kept in _kept(docs)])
