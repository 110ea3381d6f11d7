"""Source divergence audit on run-length columns.

For every language the terms that stand in at least ``MIN_DOCS`` of its documents are its vocabulary, and every
(lang, source) group is a column of counts over it.  All columns hold the vocabulary in one order, by the sources
that hold a term and their counts, so equal counts lie together.  The order is cut into chunks of bounded size; in
a chunk each group's column is run-length encoded.  For a pair of groups the run boundaries are intersected: between
two boundaries both counts are constant, so the term of the divergence is computed once and multiplied by the run
length.  The parts of all chunks are summed.

Counting is one pass over the texts with dictionaries of bounded size, whose vectors of counts by source are merged in
the order of their terms; the columns of a chunk are compared in tiles
of ``TILE`` by ``TILE`` sources, so no task holds more than a tile of a chunk, however many sources or terms there are.

Edge cases: null text, lang or source count as ''; a group without terms is compared like any other (all its counts
are 0); a language without a vocabulary has pairs of value 0 and no terms; a language with one source has no pairs;
repeated rows are documents each; doc_id and other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import letter_runs, materialize

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Terms held by a counting task, bytes read between two looks at them, classes of equal terms in a chunk, sources in a
#: tile (sizes of work, not limits).
HELD, LOOK, CHUNK, TILE = 600_000, 1 << 18, 16_384, 64

#: Letters of a term: A-Z (lower-cased), a-z and every character beyond ASCII; all else sets terms apart.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


VECTORS = "lang string, term binary, d long, sources array<string>, counts array<long>"


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """VECTORS rows: for each term of a language the documents that hold it and its occurrences by source."""
    held: dict = {}  # lang -> (documents of each term, source -> occurrences of each term)

    def flush() -> Iterator[pa.RecordBatch]:
        while held:
            lang, (there, by_source) = held.popitem()
            vectors: dict = {term: ([], []) for term in there}
            while by_source:
                source, count = by_source.popitem()
                for term, n in count.items():
                    sources, counts = vectors[term]
                    sources.append(source)
                    counts.append(n)
            ends = np.cumsum([0, *(len(x) for x, _ in vectors.values())])
            yield pa.RecordBatch.from_arrays([
                pa.repeat(lang, len(there)), pa.array(list(there), pa.binary()), pa.array(list(there.values()), pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(list(chain.from_iterable(x for x, _ in vectors.values())), pa.string())),
                pa.ListArray.from_arrays(ends, pa.array(list(chain.from_iterable(x for _, x in vectors.values())), pa.int64()))],
                names=["lang", "term", "d", "sources", "counts"])

    seen = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source")), batch.column("text"), strict=True):
            there, by_source = held.setdefault(lang, (Counter(), {}))
            count = by_source.setdefault(source, Counter())
            data, own = text.as_py(), set()
            for terms in letter_runs(data, LETTERS):
                count.update(terms)
                own.update(terms)
            there.update(own)
            seen += len(data)
            if seen > LOOK:
                seen = 0
                if sum(len(c) for _, x in held.values() for c in x.values()) > HELD:
                    yield from flush()
    yield from flush()


def merged(rows: pa.Table) -> pa.RecordBatch:
    """One row for each (lang, term) of VECTORS rows that are sorted by them."""
    lang, term = (rows.column(c).combine_chunks() for c in ("lang", "term"))
    new = np.ones(len(rows), bool)
    new[1:] = pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(term[1:], term[:-1])).to_numpy(zero_copy_only=False)
    group, first = np.cumsum(new) - 1, np.flatnonzero(new)
    sources, counts = (rows.column(c).combine_chunks() for c in ("sources", "counts"))
    names = sources.flatten().dictionary_encode()
    words = np.array([x.encode() for x in names.dictionary.to_pylist()], object)
    by_name = np.argsort(words, kind="stable")
    rank = np.empty(len(words), np.int64)
    rank[by_name] = np.arange(len(words))
    of = np.repeat(group, sources.value_lengths().to_numpy()) * max(1, len(words)) + rank[names.indices.to_numpy()]
    cells, back = np.unique(of, return_inverse=True)
    total = np.zeros(len(cells), np.int64)
    np.add.at(total, back, counts.flatten().to_numpy())
    ends = np.searchsorted(cells, np.arange(len(first) + 1) * max(1, len(words)))
    named = names.dictionary.take(pa.array(by_name[cells % max(1, len(words))]))
    return pa.RecordBatch.from_arrays([
        lang.take(pa.array(first)), term.take(pa.array(first)), pa.array(np.add.reduceat(rows.column("d").to_numpy(), first)),
        pa.ListArray.from_arrays(ends, named), pa.ListArray.from_arrays(ends, pa.array(total))], names=rows.column_names)


def merge_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of sorted batches, one for each (lang, term); at most one term is held between two batches."""
    held: list = []
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            done = merged(pa.Table.from_batches([*held, batch.slice(at, 4096)]))
            held = [done.slice(done.num_rows - 1)]
            yield done.slice(0, done.num_rows - 1)
    yield from held


def vocabulary(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term, sources and counts (by source, those above 0), total: the kept terms of each language."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    texts = docs.select(blank("lang"), blank("source"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    rows = texts.mapInArrow(count_terms, VECTORS).repartition("lang", "term").sortWithinPartitions("term", "lang")
    kept = rows.mapInArrow(merge_terms, VECTORS).where(F.col("d") >= min_docs)
    return kept.select("lang", F.col("term").cast("string").alias("term"), "sources", "counts",
                       F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y).alias("total"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (n + 2 v)) by long division in steps of 1000, exact while 1000 (n + 2 v) fits 64 bits."""
    whole = n + 2 * v
    left, out = count + 2, F.lit(0).cast("long")
    for _ in range(3):
        left = left * 1000
        out, left = out * 1000 + _div(left, whole), left % whole
    return out + 1


def shares(count: np.ndarray, n: int, v: int) -> np.ndarray:
    """The same for an array of counts."""
    whole, left, out = n + 2 * v, count + 2, np.zeros(len(count), np.int64)
    for _ in range(3):
        left = left * 1000
        out, left = out * 1000 + left // whole, left % whole
    return out + 1


def encode(lang: str, chunk: int, lengths: np.ndarray, sources: list, counts: list) -> pd.DataFrame:
    """Run-length columns of one chunk of term classes: the end of each run and its count, for each source that has
    terms here; the row without a source holds the chunk's length."""
    ends = np.cumsum(lengths)
    sizes = np.fromiter(map(len, sources), np.int64, len(sources))
    where = np.repeat(np.arange(len(sources)), sizes)
    codes, names = pd.factorize(np.concatenate(sources))
    values = np.concatenate(counts).astype(np.int64)
    order = np.argsort(codes, kind="stable")
    cuts = np.searchsorted(codes[order], np.arange(len(names) + 1))
    rows = [(lang, chunk, None, [int(ends[-1])], [0])]
    for i, name in enumerate(names):
        at = order[cuts[i]:cuts[i + 1]]
        column = np.zeros(len(sources), np.int64)
        column[where[at]] = values[at]
        last = np.append(np.flatnonzero(column[1:] != column[:-1]), len(column) - 1)
        rows.append((lang, chunk, name, ends[last], column[last]))
    return pd.DataFrame(rows, columns=["lang", "chunk", "source", "ends", "counts"])


def run_columns(classes: DataFrame) -> DataFrame:
    """lang, chunk, source, ends, counts: the encoded columns of all chunks of the vocabulary, in its clustered order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lang, part in batch.groupby("lang", sort=False):
                for at in range(0, len(part), CHUNK):
                    cut = part.iloc[at:at + CHUNK]
                    yield encode(lang, chunk, cut["length"].to_numpy(), cut["sources"].tolist(), cut["counts"].tolist())
                    chunk += 1

    ordered = classes.repartitionByRange("lang", "sources", "counts").sortWithinPartitions("lang", "sources", "counts")
    return ordered.mapInPandas(run, "lang string, chunk long, source string, ends array<long>, counts array<long>")


def divergence(a: tuple, b: tuple) -> int:
    """Sum of f over the vocabulary of a chunk for two columns of (ends, shares)."""
    ends = np.union1d(a[0], b[0])
    p, q = a[1][np.searchsorted(a[0], ends)], b[1][np.searchsorted(b[0], ends)]
    f = (p - q) * (p - q) // (p + q)
    return int((f * np.diff(ends, prepend=0)).sum())


def tile_parts(tile: pd.DataFrame) -> pd.DataFrame:
    """lang, a, b, value for the pairs of a tile of one chunk (a before b)."""
    tile = tile.sort_values("source", key=lambda s: s.map(lambda x: x.encode()))
    columns = [(s, t, (np.asarray(e, np.int64), shares(np.asarray(c, np.int64), n, v) if v else np.ones(len(c), np.int64)))
               for s, t, e, c, n, v in zip(*(tile[x] for x in ("source", "tile", "ends", "counts", "n", "v")), strict=True)]
    t1, t2, lang = tile["t1"].iloc[0], tile["t2"].iloc[0], tile["lang"].iloc[0]
    out = [(lang, a[0], b[0], divergence(a[2], b[2])) for i, a in enumerate(columns) for b in columns[i + 1:]
           if t1 == t2 or a[1] != b[1]]
    return pd.DataFrame(out, columns=["lang", "a", "b", "value"])


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank: for each group all other sources of its language by
    divergence, and the ``top`` terms that it uses more than its language does."""
    kept = materialize(vocabulary(docs, min_docs), "divergence-terms")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    there = docs.select(blank("lang"), blank("source")).distinct()
    langs = there.groupBy("lang").agg(F.count("*").alias("n_sources")).join(
        kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n")), "lang", "left").select(
        "lang", F.ceil(F.col("n_sources") / TILE).cast("int").alias("tiles"), F.coalesce("v", F.lit(0).cast("long")).alias("v"), "lang_n")
    langs = materialize(langs, "divergence-langs")
    cells = kept.select("lang", "term", "total", F.explode(F.arrays_zip("sources", "counts")).alias("c")).select(
        "lang", F.col("c.sources").alias("source"), "term", F.col("c.counts").alias("n_here"), "total")
    sizes = cells.groupBy("lang", "source").agg(F.sum("n_here").alias("n"))
    groups = there.join(sizes, ["lang", "source"], "left").join(langs, "lang").select(
        "lang", "source", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "v", "lang_n", "tiles",
        F.pmod(F.xxhash64("source"), "tiles").cast("int").alias("tile"))
    groups = materialize(groups, "divergence-groups")

    # part 'term': the group's share against the language's
    p, q = share(F.col("n_here"), F.col("n"), F.col("v")), share(F.col("total"), F.col("lang_n"), F.col("v"))
    shared = cells.join(groups.select("lang", "source", "n", "v", "lang_n"), ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    gap = F.col("p") - F.col("q")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = shared.select("lang", "source", "item", _div(gap * gap, F.col("p") + F.col("q")).alias("value")).withColumn(
        "rank", F.row_number().over(best)).where(F.col("rank") <= top)

    # part 'pair': the run-length columns, chunk by chunk; one empty chunk for each language, so every pair is there
    classes = kept.groupBy("lang", "sources", "counts").agg(F.count("*").alias("length"))
    runs = materialize(run_columns(classes), "divergence-runs")
    chunks = runs.where("source is null").select("lang", "chunk", F.col("ends")[0].alias("length")).union(
        langs.select("lang", F.lit(-1).cast("long"), F.lit(0).cast("long")))
    dealt = chunks.join(langs.select("lang", "tiles"), "lang").select("lang", "chunk", "length", F.explode(
        F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    columns = dealt.join(groups, ["lang", "tile"]).join(runs.where("source is not null"), ["lang", "chunk", "source"], "left").select(
        "lang", "chunk", "source", "tile", "n", "v", F.coalesce("ends", F.array("length")).alias("ends"),
        F.coalesce("counts", F.array(F.lit(0).cast("long"))).alias("counts"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("with"))
    tiles = columns.withColumns({"t1": F.least("tile", "with"), "t2": F.greatest("tile", "with")}).drop("with")
    parts = tiles.groupBy("lang", "chunk", "t1", "t2").applyInPandas(tile_parts, "lang string, a string, b string, value long")
    summed = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    summed = summed.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                     F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value")
    pairs = summed.select("lang", "x.source", "x.item", "value").withColumn("rank", F.row_number().over(best))
    named = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return named(pairs, "pair").unionByName(named(terms, "term"))
