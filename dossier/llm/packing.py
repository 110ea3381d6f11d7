"""Packing documents into token sequences by patterns fitted with non-negative least squares.

Documents are tokenized and ended with ``END``; only longer ones than ``SIZE`` are cut, into pieces of ``SIZE``
tokens of which the first may be shorter.  The histogram of piece lengths (at most ``SIZE`` numbers, whatever
the input) decides the packing: patterns of up to three lengths that fill a sequence get repeat counts by
non-negative least squares against the histogram, the counts are rounded, and what they leave is packed by best
fit, again on the histogram.  Each pattern so stands for many sequences, and the plan is a bounded table.

A piece finds its sequence by its rank among the pieces of its length.  Ranks come from counts over ranges of a
hash, so no task sees all pieces of one length.

Edge cases: a null text is an empty document of one token; repeated rows are packed each; a null doc_id is kept;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SIZE = 1024
END = 2
VOCABULARY = "byte_bpe_50k.tiktoken"
MARK = "<|endoftext|>"  # its one special token, read as such in a text
#: Rows per rank range (a size of work, not a limit of rows).
RANGE_ROWS = 500
#: Triples tried for each largest length.
TRIPLES = 24

#: Fixed value: the pre-token pattern of the vocabulary (the public pattern with possessive repeats, which match alike).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


@functools.lru_cache(maxsize=1)
def tokenizer(vocabulary: str = VOCABULARY) -> tiktoken.Encoding:
    """The public vocabulary; its ids equal those of the ``tokenizers`` file of the same name."""
    with open(public_tokenizers.path(vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(vocabulary, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={MARK: len(ranks)})


#: White space as the pattern sees it, so long and so followed that matching it back and forth would need too much stack.
_LONG_SPACE = re.compile(r"[^\S\x1c-\x1f]{4096,}(?=[\S\x1c-\x1f])(?!" + re.escape(MARK) + ")")


def encode(text: str, vocabulary: str = VOCABULARY) -> np.ndarray:
    """The ids of a text.  A long run of white space before a word is cut before its last character, where the pattern
    ends a pre-token anyway, so the ids are those of the whole text."""
    encoding = tokenizer(vocabulary)
    special = {"allowed_special": "all"} if MARK in text else {}
    ends = [m.end() - 1 for m in _LONG_SPACE.finditer(text)]
    parts = [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)], strict=True)] if ends else [text]
    return np.concatenate([encoding.encode_to_numpy(x, **special, disallowed_special=()) for x in parts])


def cuts(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens."""
    first = (n - 1) % size + 1
    return [(0, first)] + [(at, size) for at in range(first, n, size)]


def pieces(docs: DataFrame, text: str = "text", with_ids: bool = False, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, data in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encode(data, vocabulary) if data else np.empty(0, np.uint32)
                ids = np.append(ids, END).astype("<u4")
                for k, (start, length) in enumerate(cuts(len(ids))):
                    part = ids[start:start + length]
                    rows.append((doc_id, k, start, length, zlib.crc32(part.tobytes())) + ((part.astype(np.int32),) if with_ids else ()))
            yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(run, schema)


# --- the plan, on the histogram ------------------------------------------------------------------------------

def patterns(lengths: list[int], size: int = SIZE) -> np.ndarray:
    """Rows of three lengths (0: none) that fill a sequence exactly: all pairs, and triples spread evenly over
    the second length of each largest one."""
    have = set(lengths)
    rows = [(size, 0, 0)] if size in have else []
    for a in sorted(have):
        b = size - a
        if a >= b > 0 and b in have:
            rows.append((a, b, 0))
        seconds = [b for b in range((size - a + 1) // 2, min(a, size - a - 1) + 1) if b in have and size - a - b in have]
        step = max(1, len(seconds) // TRIPLES)
        rows += [(a, b, size - a - b) for b in seconds[a % step::step]]
    return np.array(rows, np.int64).reshape(-1, 3)


def non_negative_fit(rows: np.ndarray, counts: np.ndarray, rounds: int = 600) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that minimise the squared difference to the histogram, by accelerated
    projected gradient steps."""
    width = len(counts)
    weight = (rows > 0).astype(float)
    use = lambda x: np.bincount(rows.ravel(), (weight * x[:, None]).ravel(), width)
    back = lambda r: (weight * r[rows]).sum(1)
    v = np.ones(len(rows))
    for _ in range(12):  # the largest eigenvalue gives the step
        v = back(use(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(rounds):
        nxt = np.maximum(0, y - back(use(y) - counts) / (1.05 * norm))
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        y = nxt + (before - 1) / t * (nxt - x)
        x = nxt
    return x


def packing_plan(histogram: dict[int, int], size: int = SIZE) -> pd.DataFrame:
    """length, first (rank), times, sequence, offset: the pieces of ``length`` ranked first .. first + times - 1 go to
    the sequences from ``sequence`` on, one each, at ``offset``.  Of three ways to round the fit (carrying fractions
    on, to the nearest, down) the one that needs the fewest sequences is taken."""
    rows = patterns(sorted(n for n, c in histogram.items() if c), size)
    if not len(rows):
        return _packed(histogram, rows, np.empty(0, int), size)
    counts = np.zeros(size + 1)
    for n, c in histogram.items():
        counts[n] = c
    x = non_negative_fit(rows, counts)
    rounded = (np.diff(np.floor(np.cumsum(x) + 0.5), prepend=0), np.floor(x + 0.5), np.floor(x))
    return min((_packed(histogram, rows, r.astype(int), size) for r in rounded), key=lambda p: (p["sequence"] + p["times"]).max())


def _packed(histogram: dict[int, int], rows: np.ndarray, repeats: np.ndarray, size: int) -> pd.DataFrame:
    """The slots of the repeated patterns, as far as the histogram allows, and of the rest packed by best fit."""
    left = {n: c for n, c in histogram.items() if c > 0}
    taken = dict.fromkeys(left, 0)
    slots, sequence = [], 0

    def place(parts: list[int], times: int) -> None:
        nonlocal sequence
        offset = 0
        for n in parts:
            slots.append((n, taken[n], times, sequence, offset))
            taken[n] += times
            left[n] -= times
            offset += n
        sequence += times

    for i in np.argsort(-repeats, kind="stable"):
        parts = [int(n) for n in rows[i] if n]
        times = min([int(repeats[i])] + [left[n] // parts.count(n) for n in parts])
        if times > 0:
            place(parts, times)
    order = sorted(n for n, c in left.items() if c)
    while order:
        parts, room, used = [], size, {}
        at = len(order) - 1
        while at >= 0:
            n = order[at]
            if n <= room and left[n] > used.get(n, 0):
                parts.append(n)
                used[n] = used.get(n, 0) + 1
                room -= n
                at = min(at, bisect.bisect_right(order, room) - 1)
            else:
                at = min(at - 1, bisect.bisect_right(order, room) - 1)
        place(parts, min(left[n] // k for n, k in used.items()))
        order = [n for n in order if left[n]]
    return pd.DataFrame(slots, columns=["length", "first", "times", "sequence", "offset"])


# --- placing the pieces ----------------------------------------------------------------------------------------

def ranked(found: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``found`` with ``rank``, from 0 within each length."""
    ranges = F.element_at(F.array(*[F.lit(max(1, -(-counts.get(n, 0) // RANGE_ROWS))) for n in range(SIZE + 1)]),
                          F.col("length").cast("int") + 1)
    spot = F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(1 << 40))
    rows = found.withColumn("spot", spot).withColumn("range", F.floor(F.col("spot") / F.lit(float(1 << 40)) * ranges))
    earlier = Window.partitionBy("length").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("length", "range").agg(F.count("*").alias("m")).withColumn(
        "before", F.coalesce(F.sum("m").over(earlier), F.lit(0).cast("long"))).drop("m")
    before = materialize(before, "pack-ranges")
    within = Window.partitionBy("length", "range").orderBy("spot", "doc_id", "piece", "ids_crc32")
    return (rows.withColumn("at", F.row_number().over(within) - 1).join(before, ["length", "range"])
            .withColumn("rank", F.col("before") + F.col("at")).drop("spot", "range", "at", "before"))


def pack(docs: DataFrame, text: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) of every piece of every document."""
    found = materialize(pieces(docs, text, with_ids), "pack-pieces")
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}  # SIZE rows at most
    slots = packing_plan(counts).sort_values(["length", "first"])
    by_length = {n: tuple(g[c].to_numpy() for c in ("first", "sequence", "offset")) for n, g in slots.groupby("length")}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = np.empty(len(batch), np.int64), np.empty(len(batch), np.int64)
            for n, at in batch.groupby("length").indices.items():
                first, base, place = by_length[n]
                rank = batch["rank"].to_numpy()[at]
                slot = np.searchsorted(first, rank, "right") - 1
                sequence[at], offset[at] = base[slot] + rank - first[slot], place[slot]
            yield batch.drop(columns="rank").assign(sequence_id=sequence, offset=offset).astype({"doc_id": "Int64"})

    rows = ranked(found, counts).select(*found.columns, "rank")
    return rows.mapInPandas(run, ", ".join(f"{c} {t}" for c, t in found.dtypes) + ", sequence_id long, offset long")


def sequences(docs: DataFrame, text: str = "text") -> DataFrame:
    """sequence_id, ids: the packed token sequences themselves (at most ``SIZE`` tokens each)."""
    parts = pack(docs, text, with_ids=True).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
