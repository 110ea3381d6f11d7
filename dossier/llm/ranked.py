"""Ranked lexical search by the Best Position Algorithm over impact lists.

Every document with a query term is kept in a forward index (length, numbers of its query terms, their frequencies),
written once.  A task reads its part of the index in shards of bounded size and turns each shard into impact lists:
for every term the documents of the shard by descending impact, the whole-number contribution of the term to their
score.  For a query the lists of its terms are read in parallel from the top.  Every new document is looked up in all
lists at once (direct access), which gives its full score and also marks its position in each list as seen.  The best
position of a list is the end of its contiguously seen positions; no unseen document can stand before the position
that follows it, so the impacts there add up to a threshold, which falls faster than that of the last positions read.
A query stops in a shard as soon as the threshold lies strictly below its k-th best score so far (at equality an
unseen document could still win by its id).  The k-th best carries over from shard to shard of a task, and the results
of all tasks are merged, first by salted query, then by query.

Queries are worked on in blocks of about ``BLOCK_TERMS`` term occurrences, dealt by a hash of the item's id; only a
block's queries and their vocabulary are sent to the tasks.

Edge cases: documents (or items) without an id take no part at all; null texts have no terms; rows that repeat a
doc_id are documents of their own, and each may be listed; rows that repeat an item_id count once (with different
texts, the smallest stands for the item); items without a known term, and documents of score 0, give no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import letter_runs, materialize

#: Letters of a term: 0-9, A-Z (lower-cased), a-z and every character beyond ASCII; all else sets terms apart.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

#: Term occurrences of the queries of a block, postings and documents of a shard (sizes of work, not limits).
BLOCK_TERMS, SHARD_POSTINGS, SHARD_ROWS = 400_000, 1_500_000, 32_768
#: Positions read from each list in the first step of a query; later steps read more.
FIRST_STEP = 8
SALTS = 64


def term_counts(data: bytes) -> Counter:
    """The terms of a text with their frequencies."""
    found: Counter = Counter()
    for terms in letter_runs(data, LETTERS):
        found.update(terms)
    return found


def _rows(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), terms (numbers in ``vocabulary``), tfs, for each document with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, ends, terms, tfs = [], [], [0], [], []
            for doc_id, data in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                counts = term_counts(data.as_py())
                if counts:
                    for word, tf in counts.items():
                        if word in vocabulary:
                            terms.append(vocabulary[word])
                            tfs.append(tf)
                    ids.append(doc_id.as_py())
                    sizes.append(counts.total())
                    ends.append(len(terms))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))], names=["doc_id", "n", "terms", "tfs"])

    return _rows(docs).mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def document_frequencies(index: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary; the driver gets one number for each term of the block."""
    df = np.zeros(size, np.int64)
    for term, n in index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect():
        df[term] = n
    return df


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


class Shard:
    """Impact lists of one shard: of term t, ``docs[starts[t]:starts[t + 1]]`` by descending impact, and by document."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray, weight: np.ndarray):
        impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
        order = np.lexsort((row, -impact, term))
        self.ids, self.docs, self.impacts = ids, row[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(len(weight) + 1))
        by_doc = np.lexsort((self.docs, term[order]))
        self.looked, self.place = self.docs[by_doc], by_doc  # a term's documents ascending, and where they stand

    def list_of(self, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.starts[t], self.starts[t + 1]
        return self.docs[a:b], self.impacts[a:b], self.looked[a:b], self.place[a:b] - a


def merge(best: tuple[np.ndarray, np.ndarray], ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of both, equal scores by ascending id."""
    ids, scores = np.concatenate([best[0], ids]), np.concatenate([best[1], scores])
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def best_positions(shard: Shard, query: list[tuple[int, int]], best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[tuple, int]:
    """``best`` merged with the documents of a shard for a query of (term, multiplicity), and the positions read."""
    lists = [(*shard.list_of(t), times) for t, times in query if shard.starts[t] < shard.starts[t + 1]]
    seen = [np.zeros(len(x[0]) + 1, bool) for x in lists]  # the position past the end is never seen
    next_ = [0] * len(lists)  # the first position that is not seen: the best position is the one before it
    known = np.zeros(len(shard.ids), bool)
    at, step, read = 0, FIRST_STEP, 0
    while lists:
        bound = sum(int(x[1][p]) * x[4] for x, p in zip(lists, next_, strict=True) if p < len(x[0]))
        if bound <= 0 or len(best[0]) == k and bound < best[1][-1]:
            break
        fresh = np.unique(np.concatenate([x[0][at:at + step] for x in lists]))
        read += sum(len(x[0][at:at + step]) for x in lists)
        fresh = fresh[~known[fresh]]
        known[fresh] = True
        scores = np.zeros(len(fresh), np.int64)
        for i, (_, impacts, looked, place, times) in enumerate(lists):
            where = np.searchsorted(looked, fresh)
            where[where == len(looked)] = 0
            hit = looked[where] == fresh
            found = place[where[hit]]
            scores[hit] += impacts[found] * times
            seen[i][found] = True
            next_[i] += int(np.argmin(seen[i][next_[i]:]))
        good = scores > 0
        best = merge(best, shard.ids[fresh[good]], scores[good], k)
        at, step = at + step, min(2 * step, 512)
    return best, read


def search_block(docs: DataFrame, items: list, k: int) -> DataFrame:
    """item_id, doc_id, score: at least the ``k`` best documents of each (item_id, text) of ``items``."""
    vocabulary: dict[bytes, int] = {}
    queries = []
    for item_id, data in items:
        terms = term_counts(data)
        queries.append((item_id, [(vocabulary.setdefault(w, len(vocabulary)), n) for w, n in terms.items()]))
    index = materialize(forward_index(docs, vocabulary), "ranked-index")
    total = index.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).collect()[0]
    n_docs, n_terms = total["docs"], total["terms"]
    weight = weights(document_frequencies(index, len(vocabulary)), n_docs)
    # m in decimals: 75 n N may pass 64 bits before the division
    m = (F.lit(25) + F.call_function("div", F.lit(75).cast("decimal(3,0)") * F.col("n").cast("decimal(16,0)") * F.lit(n_docs).cast("decimal(16,0)"),
                                     F.lit(n_terms or 1).cast("decimal(18,0)"))).cast("long").alias("m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(queries)
        held: list = []

        def read_shard() -> None:
            ids, ms, sizes, terms, tfs = (np.concatenate(x) for x in zip(*held, strict=True))
            row = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
            used = weight[terms] > 0  # a list of impact 0 adds nothing
            shard = Shard(ids, ms, row[used], terms[used], tfs[used], weight)
            for i, (_, query) in enumerate(queries):
                best[i] = best_positions(shard, query, best[i], k)[0]
            held.clear()

        rows = postings = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                lists = part.column("terms")
                held.append((part.column("doc_id").to_numpy(), part.column("m").to_numpy(), lists.value_lengths().to_numpy(),
                             lists.flatten().to_numpy(), part.column("tfs").flatten().to_numpy()))
                rows, postings = rows + part.num_rows, postings + len(held[-1][3])
                if rows >= SHARD_ROWS or postings >= SHARD_POSTINGS:
                    read_shard()
                    rows = postings = 0
        if held:
            read_shard()
        ids = np.repeat(np.array([item_id for item_id, _ in queries], np.int64), np.array([len(x[0]) for x in best], np.int64))
        columns = [np.concatenate([np.empty(0, np.int64), *(x[i] for x in best)]) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, [ids, *columns])), names=["item_id", "doc_id", "score"])

    return index.select("doc_id", m, "terms", "tfs").mapInArrow(run, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item of (item_id, text)."""
    asked = items.where("item_id is not null and text is not null").groupBy(F.col("item_id").cast("long").alias("item_id")).agg(
        F.min("text").alias("text"))
    asked = materialize(asked.select("item_id", F.col("text").cast("binary").alias("text"), (1 + F.floor(F.length("text") / 2)).alias("size")), "ranked-items")
    total = asked.agg(F.sum("size").alias("n")).collect()[0]["n"] or 0
    blocks = max(1, -(-total // BLOCK_TERMS))
    found = None
    for block in range(blocks):
        chosen = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        part = search_block(docs, [(r["item_id"], bytes(r["text"])) for r in chosen.orderBy("item_id").collect()], k)
        part = materialize(part, "ranked-found")
        found = part if found is None else found.unionByName(part)
    order = [F.desc("score"), F.asc("doc_id")]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    first = found.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order)))
    best = first.where(F.col("rank") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return best.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
