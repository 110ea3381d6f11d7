"""Substring deduplication over prefix-partitioned suffix trees.

A window is ``WINDOW`` consecutive words.  Every window of the corpus is a suffix cut at that depth, so a
document pair repeats a window exactly where the suffix tree has an internal node of depth ``WINDOW`` or more
above suffixes of both; windows next to one another join to the maximal repeats.

1. Documents are range-sorted by id into blocks of consecutive ids, written once.
2. The suffixes are split by their first words into groups that fit a task's memory: by the first 4 words;
   where a sample of blocks shows that a prefix is too frequent by the first 8; and by all words where that is
   still too frequent.  (The sample only shapes the groups, it does not change results.)
3. A group's tree is held as its sorted suffixes, each a 64-bit hash of its words beside the prefix hash that
   chose the group; equal neighbours are its deep internal nodes.  Each block sends a suffix once however often
   it holds it, so a passage in a third of all documents is one entry per block.  As blocks ascend by id, every
   entry of a node but its first comes from larger ids only, and one bit per entry goes back to the blocks.
4. Each block marks its windows and removes the words they cover.

Edge cases: null and empty texts have no words; rows of equal id do not remove one another's words; rows without
an id neither remove nor lose words; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, hash_share, materialize, words

WINDOW = 13
PREFIXES = (4, 8)
BLOCK_WORDS = 500_000
#: Suffixes of one group, about.
GROUP_SUFFIXES = 2_000_000
PARTITION_CHARS = 32_000_000
SAMPLE_BLOCKS = 24

_STEP = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


# --- blocks --------------------------------------------------------------------------------------------------

def blocks(docs: DataFrame, text: str = "text") -> DataFrame:
    """block (its smallest id), n_words, payload: documents in order of id, about ``BLOCK_WORDS`` words a block."""
    chars = docs.agg(F.sum(F.length(text)).alias("n")).collect()[0]["n"] or 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=3).compress
        ids, texts, n, last = [], [], 0, None

        def block() -> pd.DataFrame:
            data = b"\0".join(texts)
            return pd.DataFrame({"block": [ids[0]], "n_words": [n], "ids": [np.array(ids, np.int64).tobytes()], "payload": [pack(data)]})

        for batch in batches:
            for doc_id, data in zip(batch["doc_id"], batch["text"], strict=True):
                if n >= BLOCK_WORDS and doc_id != last:
                    yield block()
                    ids, texts, n = [], [], 0
                found = data.split() if data else []
                ids.append(doc_id)
                # a zero byte parts documents: in a word it is escaped
                texts.append(b" ".join(found).replace(b"\1", b"\1\1").replace(b"\0", b"\1\2"))
                n += len(found)
                last = doc_id
        if ids:
            yield block()

    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    rows = rows.repartitionByRange(max(1, -(-chars // PARTITION_CHARS)), "doc_id").sortWithinPartitions("doc_id")
    return materialize(rows.mapInPandas(run, "block long, n_words long, ids binary, payload binary"), "repeat-blocks")


class Block:
    """One block's documents, the hashes of its windows, and the groups they belong to."""

    def __init__(self, ids: bytes, payload: bytes, memo: Memo):
        self.ids = np.frombuffer(ids, np.int64)
        texts = zstandard.ZstdDecompressor().decompress(payload).split(b"\0")
        self.docs = [_unescape(t).split() for t in texts]
        counts = np.array([len(d) for d in self.docs])
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        h = np.fromiter((memo[w] for d in self.docs for w in d), np.uint64, int(counts.sum()))
        # window starts: all words but the last WINDOW - 1 of each document
        ok = np.ones(len(h), bool)
        for end, n in zip(self.starts[1:], counts, strict=True):
            ok[end - min(n, WINDOW - 1):end] = False
        self.at = np.flatnonzero(ok)
        self.prefix = {}
        path = np.zeros(len(self.at), np.uint64)
        for i in range(WINDOW):
            path = _mix(path * _STEP + h[self.at + i])
            if i + 1 in PREFIXES:
                self.prefix[i + 1] = path.copy()
        self.path = path
        _, rank = np.unique(self.ids, return_inverse=True)  # rows of one id are one document
        self.doc = np.repeat(rank, counts)[self.at]

    def group(self, n: int, frequent: dict[int, np.ndarray]) -> np.ndarray:
        """Group of each window, by the shortest prefix that is not too frequent."""
        m = np.uint64(n)
        out = self.prefix[PREFIXES[0]] % m
        for level, (short, long) in enumerate(zip(PREFIXES, (*PREFIXES[1:], WINDOW), strict=True)):
            deeper = np.isin(out, frequent[short]) & (out // m == level)
            key = self.prefix.get(long, None)
            key = _mix(self.path + _STEP) if key is None else key
            out = np.where(deeper, key % m + np.uint64(level + 1) * m, out)
        return out.astype(np.int64)

    def entries(self, n: int, frequent: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(group and path of the distinct suffixes, sorted; entry of each window; whether a smaller id of this block has it)."""
        group = self.group(n, frequent)
        order = np.lexsort((self.doc, self.path, group))
        g, p, d = group[order], self.path[order], self.doc[order]
        new = np.ones(len(order), bool)
        new[1:] = (g[1:] != g[:-1]) | (p[1:] != p[:-1])
        entry = np.cumsum(new) - 1
        first = d[new]
        of, seen = np.empty(len(order), np.int64), np.empty(len(order), bool)
        of[order], seen[order] = entry, d > first[entry]
        return g[new], p[new], of, seen


def _unescape(data: bytes) -> bytes:
    if b"\1" not in data:
        return data
    return b"\1".join(part.replace(b"\1\2", b"\0") for part in data.split(b"\1\1"))


def _memo() -> Memo:
    return Memo(xxhash.xxh64_intdigest)


# --- groups --------------------------------------------------------------------------------------------------

def frequent_prefixes(stored: DataFrame, n: int, total: int) -> dict[int, np.ndarray]:
    """Groups too large for one prefix length, by length, estimated on about ``SAMPLE_BLOCKS`` blocks."""
    size = stored.count()
    share = min(1.0, SAMPLE_BLOCKS / max(1, size))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, m = _memo(), np.uint64(n)
        for batch in batches:
            for ids, payload in zip(batch["ids"], batch["payload"], strict=True):
                b = Block(ids, payload, memo)
                for level, k in enumerate(PREFIXES):
                    key, c = np.unique(b.prefix[k] % m + np.uint64(level) * m, return_counts=True)
                    yield pd.DataFrame({"k": k, "key": key.astype(np.int64), "c": c, "w": 0})
                yield pd.DataFrame({"k": [0], "key": [0], "c": [len(b.path)]})

    seen = stored.where(hash_share(F.col("block"), share)).select("ids", "payload").mapInPandas(count, "k int, key long, c long")
    seen = seen.groupBy("k", "key").agg(F.sum("c").alias("c"))
    seen = materialize(seen, "repeat-prefixes")
    sampled = seen.where("k = 0").agg(F.sum("c")).collect()[0][0] or 1
    # at most total / GROUP_SUFFIXES prefixes can be over the size, for each length
    rows = seen.where((F.col("k") > 0) & (F.col("c") * (total / sampled) > GROUP_SUFFIXES)).collect()
    return {k: np.array(sorted(r["key"] for r in rows if r["k"] == k), np.uint64) for k in PREFIXES}


def repeated(stored: DataFrame, n: int, frequent: dict[int, np.ndarray]) -> DataFrame:
    """block, group, bits: which of a block's suffixes in a group occur in a smaller block."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = _memo()
        for batch in batches:
            for block, ids, payload in zip(batch["block"], batch["ids"], batch["payload"], strict=True):
                g, p, _, _ = Block(ids, payload, memo).entries(n, frequent)
                cut = np.flatnonzero(np.diff(g)) + 1
                parts = np.split(p, cut)
                keys = g[np.concatenate([[0], cut])] if len(g) else []
                if len(g):
                    yield pd.DataFrame({"group": keys, "block": block, "suffixes": [x.tobytes() for x in parts]})

    def nodes(found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values("block")
        parts = [np.frombuffer(x, np.uint64) for x in found["suffixes"]]
        every = np.concatenate(parts)
        order = np.argsort(every, kind="stable")  # equal suffixes stay in order of block
        later = np.zeros(len(every), bool)
        later[order[1:]] = every[order[1:]] == every[order[:-1]]
        bits = np.split(later, np.cumsum([len(x) for x in parts])[:-1])
        hit = [i for i, x in enumerate(bits) if x.any()]
        return pd.DataFrame({"block": found["block"].to_numpy()[hit], "group": found["group"].to_numpy()[hit],
                             "bits": [np.packbits(bits[i]).tobytes() for i in hit]})

    sent = stored.select("block", "ids", "payload").mapInPandas(emit, "group long, block long, suffixes binary")
    return sent.groupBy("group").applyInPandas(nodes, "block long, group long, bits binary")


def dedupe(docs: DataFrame, text: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept, the remaining text) for each row of ``docs``."""
    stored = blocks(docs, text)
    total = stored.agg(F.sum("n_words")).collect()[0][0] or 0
    n = max(1, -(-4 * total // GROUP_SUFFIXES))
    frequent = frequent_prefixes(stored, n, total)
    flags = repeated(stored, n, frequent)

    def remove(own: pd.DataFrame, bits: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for ids, payload in zip(own["ids"], own["payload"], strict=True):
            b = Block(ids, payload, _memo())
            g, p, entry, gone = b.entries(n, frequent)
            marked = np.zeros(len(p), bool)
            for group, x in zip(bits["group"], bits["bits"], strict=True):
                lo, hi = np.searchsorted(g, group), np.searchsorted(g, group, "right")
                marked[lo:hi] = np.unpackbits(np.frombuffer(x, np.uint8), count=hi - lo)
            starts = b.at[gone | marked[entry]]
            cover = np.zeros(b.starts[-1] + 1, np.int64)
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + WINDOW, -1)
            keep = np.cumsum(cover)[:-1] == 0
            for i, found in enumerate(b.docs):
                mask = keep[b.starts[i]:b.starts[i + 1]]
                kept = b" ".join(found if mask.all() else [w for w, k in zip(found, mask.tolist(), strict=True) if k])
                row = (int(b.ids[i]), len(found), int(len(found) - mask.sum()), hashlib.sha256(kept).hexdigest())
                rows.append(row + ((kept.decode(),) if with_text else ()))
        return pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text)

    out = stored.select("block", "ids", "payload").groupBy("block").cogroup(flags.groupBy("block")).applyInPandas(
        remove, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text)
    whole = F.array_join(words(F.col(text)), " ")
    blank = docs.where("doc_id is null").select(
        F.lit(None).cast("long").alias("doc_id"), F.size(words(F.col(text))).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_removed"), F.sha2(whole.cast("binary"), 256).alias("kept_sha256"), *([whole.alias("kept")] * with_text))
    return out.unionByName(blank)
