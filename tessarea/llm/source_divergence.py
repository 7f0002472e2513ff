"""Divergence of sources within each language, exact to the last unit.

A source's probability of a term is a whole number of billionths, p = 1 + floor(10^9 (count + 2) / (N + 2 V)): N is the
source's sum over the V kept terms of its language (those in at least ``least`` of its documents). Two sources differ by
the sum over all V terms of f(p, q) = floor((p - q)^2 / (p + q)). Sources and vocabularies are large and most counts are
zero, so the sum is not made term by term but by inclusion and exclusion over the two supports A and B:

    sum f  =  V f(p0, q0)                            both counts zero, for all V terms: a constant of the pair
            + sum over A of f(p, q0) - f(p0, q0)     from how many terms have each count in the one source: a histogram
            + sum over B of f(p0, q) - f(p0, q0)     the same of the other
            + sum over A and B of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)    from the postings of common terms, joined

1. Each task counts the terms of its texts by source, and in how many documents they are; a text is cut and counted by
   pieces, and what is counted goes out whenever ``HELD`` terms are held, so a text or task may be of any size. Terms go on by
   (lang, source, term), so no language or source comes together in one task.
2. A histogram row (source, count) meets each other source of its language once: the work is that of the output times the
   distinct counts. Postings meet by (lang, term); a term has one posting for each source at most.
3. The ten terms that a source has most above its language are bounded before they are shuffled.

Defined cases: null text, lang or source is ''; a text without terms still makes its group occur; a language without kept
terms has value 0 between all its sources and no terms; a source that is alone in its language has no pairs; repeated rows are
documents of their own; an empty table gives no rows; other columns are ignored, whatever their names. Sums are 64-bit: counts
may reach 9 x 10^18, and products are made as decimals.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessarea.llm.common import release
from tessarea.session import Scratch

HELD, PIECE = 400_000, 1 << 20  # terms of all groups held by a task; bytes of a text that are cut at once
UNIT, SALTS = 1_000_000_000, 32
# A-Z become a-z; ASCII characters that are no letters part terms; bytes of other characters stay.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, by pieces that end between terms."""
    at = 0
    while at < len(text):
        piece = text[at : at + PIECE].translate(LETTERS)
        if at + PIECE < len(text):
            cut = piece.rfind(b" ")
            while cut < 0:  # a term longer than the piece
                more = text[at + len(piece) : at + len(piece) + PIECE].translate(LETTERS)
                if not more:
                    break
                cut = more.find(b" ")
                cut, piece = (cut if cut < 0 else len(piece) + cut), piece + more
            piece = piece if cut < 0 else piece[: cut + 1]
        yield piece.split()
        at += len(piece)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it): partial counts, many rows a term. Each group has rows with a null term."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        total: dict[tuple, Counter] = defaultdict(Counter)
        holding: dict[tuple, Counter] = defaultdict(Counter)
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), counts in total.items():
                docs_of = holding[lang, source]
                terms = [None, *counts]
                n, m = [0, *counts.values()], [0, *(docs_of.get(t, 0) for t in counts)]
                for at in range(0, len(terms), 50_000):
                    part = terms[at : at + 50_000]
                    columns = ([lang] * len(part), [source] * len(part), pa.array(part, pa.binary()).cast(pa.string()), n[at : at + 50_000], m[at : at + 50_000])
                    yield pa.record_batch([pa.array(c, t) if isinstance(c, list) else c for c, t in zip(columns, schema.types, strict=True)], schema=schema)
            total.clear()
            holding.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = batch.slice(at, 64).to_pydict()
                for text, lang, source in zip(rows["text"], rows["lang"], rows["source"], strict=True):
                    counts, seen = total[lang, source], set()
                    held -= len(counts)
                    for words in pieces(text):
                        counts.update(words)
                        seen.update(words)
                    holding[lang, source].update(seen)
                    held += len(counts)
                    if held > HELD:
                        yield from flush()
                        held = 0
        yield from flush()

    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(said("lang").alias("lang"), said("source").alias("source"), F.encode(said("text"), "UTF-8").alias("text")).mapInArrow(
        run, "lang string, source string, term string, n long, docs long"
    )


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 terms)), exact; NULL where there are no terms."""
    wide = (F.lit(UNIT).cast("decimal(10,0)") * (n + 2).cast("decimal(19,0)")).cast("decimal(30,0)")
    return F.call_function("div", wide, F.nullif(total + 2 * terms, F.lit(0)).cast("decimal(20,0)")) + 1


def apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); p and q are at most a billion and one, so the square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def divergence(docs: DataFrame, least: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` has each other source of the lang, part ``term`` the ``top`` terms above the lang's share."""
    scratch = Scratch(docs.sparkSession, "divergence")
    counts = scratch.keep(term_counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    terms = counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"))
    kept = terms.filter(F.col("docs") >= least).drop("docs")
    postings = scratch.keep(counts.filter("term IS NOT NULL").drop("docs").join(kept, ["lang", "term"]), "postings")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("all_n"))
    sums = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.filter("term IS NULL").select("lang", "source").join(langs, "lang", "left").join(sums, ["lang", "source"], "left")
    nothing = F.lit(0).cast("long")
    groups = groups.select("lang", "source", *[F.coalesce(c, nothing).alias(c) for c in ("v", "all_n", "total")])
    groups = scratch.keep(groups.withColumn("zero", share(nothing, F.col("total"), F.col("v"))), "groups")

    postings = postings.join(groups, ["lang", "source"]).select("lang", "source", "term", "n", "n_lang", "v", "all_n", "total", "zero", share(F.col("n"), F.col("total"), F.col("v")).alias("p"))
    found = _pairs(groups, postings, scratch).unionByName(_terms(postings, top))
    return found


def _pairs(groups: DataFrame, postings: DataFrame, scratch: Scratch) -> DataFrame:
    # Each row meets all sources of its language: dealt over SALTS tasks a language, each of which gets the list of sources.
    others = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("zero_b"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = lambda *c: F.pmod(F.xxhash64(*c), F.lit(SALTS)).cast("int")
    # One-sided terms: how many terms of a source have each count, priced against every other source.
    histogram = postings.groupBy("lang", "source", "p", "zero").agg(F.count("*").alias("k"))
    p, a0, b0, k = (F.col(c) for c in ("p", "zero", "zero_b", "k"))
    sided = histogram.withColumn("salt", salt("source", "p")).join(others, ["lang", "salt"]).filter("source <> item").groupBy("lang", "source", "item").agg(F.sum(k * (apart(p, b0) - apart(a0, b0))).alias("one"))
    sided = scratch.keep(sided, "one-sided")
    # Common terms: postings of one term meet, each pair of sources once.
    b = postings.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("zero").alias("zero_b"))
    met = postings.select("lang", "term", "source", "p", "zero").join(b, ["lang", "term"]).filter("source < item")
    q = F.col("q")
    both = met.groupBy("lang", "source", "item").agg(F.sum(apart(p, q) - apart(p, b0) - apart(a0, q) + apart(a0, b0)).alias("both"))
    both = scratch.keep(both, "both")
    both = both.unionByName(both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "both"))
    back = sided.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("one").alias("other"))
    pairs = groups.select("lang", "source", "v", "zero", salt("source").alias("salt")).join(others, ["lang", "salt"]).filter("source <> item").drop("salt")
    for table in (sided, back, both):
        pairs = pairs.join(table, ["lang", "source", "item"], "left")
    value = F.coalesce(F.col("v") * apart(a0, b0), F.lit(0)) + sum(F.coalesce(c, F.lit(0)) for c in ("one", "other", "both"))
    return _ranked(pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value")))


def _terms(postings: DataFrame, top: int) -> DataFrame:
    q = share(F.col("n_lang"), F.col("all_n"), F.col("v"))
    over = postings.withColumn("q", q).filter("n > 0 AND p > q")
    found = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    return _ranked(found).filter(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
