"""How far the sources of a language diverge from it and from each other.

Every group (lang, source) gives each term that its language keeps a smoothed
share p.  Terms of a group are ranked by f = floor((p - q)^2 / q) against the
language's share q, which grows with p and, above q, falls with q.  So the terms of a
group are put into buckets by their count, and the bucket's highest p and lowest q
bound f for all its terms.  Buckets are opened best bound first, in rounds that
each reach eight times the terms of the one before; a group is done once every
bucket that it has not opened is bounded strictly below its last ranked value.

Sources of a language are compared over all kept terms.  Postings (the sources
that hold a term) meet by term and give what both have; terms that only one or
neither has are summed from the histogram of a source's shares.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evigrade.session import cut

#: A term is a run of letters of any script: ASCII letters and every byte of UTF-8 beyond ASCII.
#: This table turns A-Z to lower case and every byte that belongs to no term to a space.
TERM_BYTES = bytes(b if b > 0x7F else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))
#: Terms that a task counts before it hands them on, and bytes of a text that it takes apart at once.
HELD_TERMS = 500_000
STRETCH = 1 << 20
SCALE = 1_000_000_000
#: Counts below this are buckets of their own, those above share 16 buckets for each doubling.
EXACT_COUNTS = 64
SALTS = 16

_GROUP = ["lang", "source"]


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, a stretch at a time."""
    text, start = text.translate(TERM_BYTES), 0
    while start < len(text):
        end = text.find(b" ", start + STRETCH)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts by group and term."""
    places, holders = defaultdict(Counter), defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in places.items():
            of_docs, terms = holders[lang, source], list(counts)
            columns = [
                pa.repeat(lang, len(terms)),
                pa.repeat(source, len(terms)),
                pa.array(terms, pa.binary()),
                pa.array(counts.values(), pa.int64()),
                pa.array(map(of_docs.__getitem__, terms), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
        places.clear()
        holders.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(*(column.to_pylist() for column in batch.columns)):
            counts, of_docs = places[lang, source], holders[lang, source]
            before, distinct = len(counts), set()
            for words in _words(text):
                counts.update(words)
                distinct.update(words)
            of_docs.update(distinct)
            held += len(counts) - before
            if held > HELD_TERMS:
                yield from flush()
                held = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold it); null fields read as ''."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    counted = docs.select(*named, text.alias("text")).mapInArrow(_count, "lang string, source string, term binary, n long, docs long")
    return (
        counted.groupBy(*_GROUP, F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), exactly; 1 more than SCALE where both are zero."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    below = F.greatest(total + terms, F.lit(1)).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", above, below)


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _bucket(n: Column) -> Column:
    steps = F.floor(F.log2(n) * 16).cast("int")
    return F.when(n < EXACT_COUNTS, n.cast("int")).otherwise(F.lit(EXACT_COUNTS) + steps)


def _salted(table: DataFrame) -> DataFrame:
    return table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _salt(*by: str) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int")


def _postings(counted: DataFrame, least_docs: int) -> DataFrame:
    """Rows of kept terms, with the language's count, and whether a row is the first of its term."""
    term = Window.partitionBy("lang", "term")
    summed = counted.withColumn("lang_n", F.sum("n").over(term)).withColumn("lang_docs", F.sum("docs").over(term))
    first = F.row_number().over(term.orderBy("source")) == 1
    return summed.withColumn("first", first).where(F.col("lang_docs") >= least_docs).drop("lang_docs", "docs")


def _groups(docs: DataFrame, postings: DataFrame) -> DataFrame:
    """Every group that occurs: total over kept terms, the language's total and number of kept terms, share of an absent term."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in _GROUP]
    sums = postings.groupBy(*_GROUP).agg(F.sum("n").alias("total"), F.count_if("first").alias("firsts"))
    langs = sums.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("firsts").alias("terms"))
    found = docs.select(*named).distinct().join(sums.drop("firsts"), _GROUP, "left").join(langs, "lang", "left")
    found = found.na.fill(0, ["total", "lang_total", "terms"])
    return found.withColumn("p0", _share(F.lit(0), F.col("total"), F.col("terms")))


def _ranked(rows: DataFrame, limit: int | None = None) -> DataFrame:
    order = Window.partitionBy(*_GROUP).orderBy(F.desc("value"), F.asc("item"))
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked if limit is None else ranked.where(F.col("rank") <= limit)


def term_ranks(postings: DataFrame, limit: int) -> DataFrame:
    """The first `limit` terms of each group by f, among those whose share is above the language's.

    postings: lang, source, term, p, q, bucket.  Returns lang, source, item, value, rank.
    """
    stats = postings.groupBy(*_GROUP, "bucket").agg(F.max("p").alias("p"), F.min("q").alias("q"), F.count("*").alias("terms"))
    order = Window.partitionBy(*_GROUP).orderBy(F.desc("bound"), "bucket")
    stats = stats.where("p > q").withColumn("bound", _f(F.col("p"), F.col("q")))
    before = F.sum("terms").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("terms")
    buckets = cut(stats.select(*_GROUP, "bucket", "bound", before.alias("before")))

    ranks = postings.sparkSession.createDataFrame([], "lang string, source string, item string, value long, rank int")
    opened, reach = -1, limit
    while True:
        last = ranks.where(F.col("rank") == limit).select(*_GROUP, F.col("value").alias("last"))
        unseen = buckets.where(F.col("before") > opened).join(last, _GROUP, "left").where("last is null or bound >= last")
        if unseen.isEmpty():
            return ranks
        # a bucket is opened whole, in the round that reaches its first term
        chosen = unseen.where(F.col("before") <= reach).select(*_GROUP, "bucket")
        rows = postings.withColumn("salt", _salt("term")).join(_salted(chosen), [*_GROUP, "bucket", "salt"]).where("p > q")
        rows = rows.select(*_GROUP, F.col("term").alias("item"), _f(F.col("p"), F.col("q")).alias("value"))
        ranks = cut(_ranked(ranks.drop("rank").unionByName(rows), limit))
        opened, reach = reach, reach * 8


def pair_sums(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """f summed over all kept terms, for every ordered pair of sources of a language.

    postings: lang, source, term, p; groups: lang, source, terms, p0.  Returns lang, source, item, value.
    """
    mine = groups.select("lang", "source", "terms", "p0")
    other = _salted(groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0")))
    apart = F.col("source") != F.col("item")
    key = ["lang", "source", "item"]

    pairs = mine.withColumn("salt", _salt("source")).join(other, ["lang", "salt"]).where(apart)
    absent = pairs.select(*key, (F.col("terms") * _f(F.col("p0"), F.col("q0"))).alias("value"))

    # terms that the source has, as if the other had none; and the other way round
    shares = postings.groupBy(*_GROUP, "p").agg(F.count("*").alias("n")).join(mine.drop("terms"), _GROUP)
    against = shares.withColumn("salt", _salt("source", "p")).join(other, ["lang", "salt"]).where(apart)
    p, p0, q, q0, n = (F.col(c) for c in ("p", "p0", "q", "q0", "n"))
    against = against.groupBy(*key).agg(
        F.sum(n * (_f(p, q0) - _f(p0, q0))).alias("as_first"), F.sum(n * (_f(q0, p) - _f(q0, p0))).alias("as_second")
    )
    one = against.select(*key, F.col("as_first").alias("value")).unionByName(
        against.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("as_second").alias("value"))
    )

    # terms that both have: what the sums above got wrong, in both directions
    held = postings.join(mine.drop("terms"), _GROUP).select(*_GROUP, "term", "p", "p0")
    twin = held.select("lang", "term", F.col("source").alias("item"), p0.alias("q0"), p.alias("q"))
    both = held.join(twin, ["lang", "term"]).where(F.col("source") < F.col("item"))
    there = _f(p, q) - _f(p, q0) - _f(p0, q) + _f(p0, q0)
    back = _f(q, p) - _f(q, p0) - _f(q0, p) + _f(q0, p0)
    both = cut(both.groupBy(*key).agg(F.sum(there).alias("there"), F.sum(back).alias("back")))
    two = both.select(*key, F.col("there").alias("value")).unionByName(
        both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value"))
    )
    return absent.unionByName(one).unionByName(two).groupBy(*key).agg(F.sum("value").alias("value"))


def audit_sources(docs: DataFrame, least_docs: int = 3, limit: int = 200) -> DataFrame:
    """Divergence of each (lang, source) from its language, term by term, and from the language's other sources.

    docs: text, lang, source and any other columns, which are ignored; null fields read as ''.  A language
    keeps the terms that at least `least_docs` of its documents hold.  With n the
    count, N its sum over kept terms and V their number, p = 1 + floor(10^9 (n + 1) / (N + V)), q likewise, and f =
    floor((p - q)^2 / q).  Rows: lang, source, part, item, value, rank.  Part `pair`: item is each other source of the
    language, q its share, value f summed over all kept terms (0 where none is kept).  Part `term`: item is a kept term
    that the group holds with p above the language's q, value f, the first `limit` only.  Ranks
    go by value downwards, then by the item's UTF-8.  Repeated rows are documents of their own; empty texts only make
    their group occur; an empty table gives an empty result.  Sums beyond 64 bits raise.
    """
    kept = cut(_postings(term_counts(docs), least_docs))
    groups = cut(_groups(docs, kept))
    sizes = _salted(groups.select(*_GROUP, "total", "lang_total", "terms"))
    placed = kept.withColumn("salt", _salt("term")).join(sizes, [*_GROUP, "salt"])
    postings = cut(
        placed.select(
            *_GROUP,
            "term",
            _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
            _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
            _bucket(F.col("n")).alias("bucket"),
        )
    )
    terms = term_ranks(postings, limit).withColumn("part", F.lit("term"))
    pairs = _ranked(pair_sums(postings, groups)).withColumn("part", F.lit("pair"))
    return pairs.unionByName(terms).select(*_GROUP, "part", "item", "value", "rank")
