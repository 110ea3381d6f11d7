"""Toxicity: noisy-channel deobfuscation, then a Bernoulli model over the restored words.

A character trigram model is counted over every document, and the frequent words of the learning documents are
known to the decoder; copies among these count once.  A token that is not a plain word without doubled letters becomes a lattice: each written
character may stand for itself, for the letters it imitates, for nothing when it repeats its predecessor or
separates letters, or for a word boundary.  Viterbi finds the likeliest reading of the lattice under the character
model, the known words and the channel costs; the document is scored on the words so restored.

Edge cases: a null or empty text has no words and gets the score of a text without marked words; a null doc_id
is never used for learning and has ``held_out`` null; without usable labels of both kinds every score is 0.
Repeated rows are scored alike, row by row; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, fold, hash_share, materialize
from .neardup import shingle_hashes, word_memo

#: Labelled documents used for learning, at most about so many of each class (a documented bound of the fit).
SAMPLE_PER_CLASS = 8_000
#: Words kept in the model, and known to the decoder (the most frequent of the learning documents).
LEXICON, KNOWN = 2_000, 20_000
#: Share of words that may be marked by chance.
FALSE_WORDS = 0.05
#: Copies among the learning documents are found by so many bands of so many minima of their shingles' hashes.
BANDS, MINIMA = 4, 3
#: Standard errors by which a word's weight is less than its estimate.
DOUBT = 0.5
#: Least weight of a marked word.  Words of a language or a style are a little commoner in one class, surely so with
#: many labels; they come together, and hundreds of small weights would add up to a verdict.
LEAST_WEIGHT = 1.0
_rng = np.random.default_rng(7)
_MUL = _rng.integers(0, 1 << 63, BANDS * MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: What a written character may stand for besides itself, and the cost of that reading.
READINGS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il",
            "|": "il", "+": "t", "(": "c", "<": "c", "€": "e"}
IMITATION_COST, SYMBOL_COST, STRETCH_COST, DOUBLE_COST, MARK_COST, JOIN_COST = 1.0, 9.0, 0.5, 4.0, 2.0, 1.0

EDGE = ".,;:?()[]{}\"'`#&%*<>=~^_-+/\\|!"
PLAIN_EDGE = "".join(c for c in EDGE if c not in READINGS)
MEMO_LENGTH = 64
LETTERS = 28  # boundary, a-z, any other letter
_CLASS = np.zeros(256, np.int64)
_CLASS[ord("a"):ord("z") + 1] = np.arange(1, 27)
_CLASS[ord("A"):ord("Z") + 1] = np.arange(1, 27)
_CLASS[128:] = 27
_LIKE = re.escape("".join(c for c in READINGS if not c.isalnum()))
_MARKS = "".join(c for c in map(chr, range(0x300, 0x20000)) if unicodedata.category(c)[0] == "M")
_SINGLES = re.compile(rf"(?<![^\W_])(?<![{_MARKS}])[^\W_][{_MARKS}]*(?:(?:[^\w{_MARKS}]|_)+[^\W_][{_MARKS}]*(?![^\W_])){{2,}}")
_THREE = re.compile(r"[\W_]\w[\W_]+\w[\W_]+\w[\W_]")  # a quick necessary condition for _SINGLES
_GAP = re.compile(rf"(?:[^\w{_MARKS}{_LIKE}]|_)+")
_TWICE = re.compile(r"(.)\1")


# --- character model -------------------------------------------------------------------------------------------

def char_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Trigram counts over all texts, as a LETTERS x LETTERS x LETTERS array (a bounded model: 21,952 cells)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(LETTERS ** 3, np.int64)
        for batch in batches:
            for data in batch["text"]:
                for i in range(0, len(data), 1 << 20):
                    c = _CLASS[np.frombuffer(data[i:i + (1 << 20)], np.uint8)]
                    if len(c) > 2:
                        total += np.bincount((c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:], minlength=LETTERS ** 3)
        cells = np.flatnonzero(total)
        yield pd.DataFrame({"cell": cells, "n": total[cells]})

    rows = (docs.select(F.col(text).cast("binary").alias("text")).where("text is not null")
            .mapInPandas(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(LETTERS ** 3)
    for cell, n in rows:
        counts[cell] = n
    return counts.reshape(LETTERS, LETTERS, LETTERS)


def char_costs(counts: np.ndarray) -> np.ndarray:
    """-log P(c | a, b), add-one smoothed and mixed with the bigram estimate."""
    two = counts.sum(0) + 1.0
    bi = two / two.sum(1, keepdims=True)
    seen = counts.sum(2, keepdims=True)
    tri = (counts + 20 * bi[None]) / (seen + 20)
    return -np.log(tri)


# --- decoding ------------------------------------------------------------------------------------------------

class Words:
    """Known words as a tree of their letters, and the cost of each: -log of its share."""

    def __init__(self, counts: dict[str, int] | None = None):
        self.child: dict[tuple[int, str], int] = {}
        self.ends: dict[int, float] = {}
        self.known = counts or {}
        total = sum(self.known.values())
        for word, n in self.known.items():
            node = 0
            for c in word:
                node = self.child.setdefault((node, c), len(self.child) + 1)
            self.ends[node] = math.log(total / n)


NO_WORDS = Words()


class Readings(Memo):
    """Keeps the readings of short tokens; longer ones are decoded each time, so a worker's memory stays bounded."""

    def __missing__(self, token):
        return super().__missing__(token) if len(token) <= MEMO_LENGTH else self.compute(token)


def _is_letter(c: str) -> bool:
    return c.isalpha() or (c > "\u02ff" and unicodedata.category(c)[0] == "M")


def _in_word(c: str) -> bool:
    return c.isalnum() or _is_letter(c)


@lru_cache(4096)
def _channel(c: str) -> tuple[list, float | None, float | None]:
    """What a written character may stand for: (letter, its class, cost), the cost of a word boundary, of nothing."""
    imitated = [(r, ord(r) - 96, IMITATION_COST) for r in READINGS.get(c, "")]
    if _is_letter(c):
        return [*imitated, (c, ord(c) - 96 if "a" <= c <= "z" else 27, 0.0)], None, None
    if c.isalnum() or c in "@$€":
        return imitated, SYMBOL_COST, SYMBOL_COST
    return imitated, MARK_COST if imitated else 0.0, DOUBLE_COST if imitated else JOIN_COST


def decode(token: str, costs: list, words: Words = NO_WORDS) -> str:
    """The likeliest reading of written characters (lower case), its words set apart by blanks.

    A word costs what the character model or the known words ask for it, whichever is less.  The states after a
    character are 0 (between words), nodes of the known words, and pairs of letter classes; a state keeps its cost
    and a linked list of letters, so time and memory are linear in the length."""
    child, ends = words.child, words.ends
    first = costs[0][0]
    beams: dict = {0: (0.0, None)}
    last, n = "", len(token)
    solid = (c for c in token if _channel(c)[1] != 0.0)
    repeats = chain.from_iterable([k] * k for k in (sum(1 for _ in same) for _, same in groupby(solid)))
    for at, c in enumerate(token):
        options, apart, nothing = _channel(c)
        if apart == 0.0 and 1 < at < n - 2 and token[at - 2].isalnum() and token[at + 2].isalnum():
            nothing = DOUBLE_COST  # between longer pieces a join is less likely than between single characters
        if apart != 0.0:
            stretch = STRETCH_COST if next(repeats) > 2 else DOUBLE_COST
            if c == last:
                nothing = stretch if nothing is None else min(nothing, stretch)
            last = c
        nxt: dict = {}
        for state, (cost, path) in beams.items():
            moves = []
            if state == 0:
                if apart is not None:
                    moves.append((0, cost + apart, path))
                for r, k, channel in options:
                    moves.append(((0, k), cost + channel + first[k], (r, path)))
                    if (0, r) in child:
                        moves.append((child[0, r], cost + channel, (r, path)))
            else:
                if nothing is not None:
                    moves.append((state, cost + nothing, path))
                if type(state) is int:
                    for r, _, channel in options:
                        if (state, r) in child:
                            moves.append((child[state, r], cost + channel, (r, path)))
                    if apart is not None and state in ends:
                        moves.append((0, cost + apart + ends[state], (" ", path)))
                else:
                    row = costs[state[0]][state[1]]
                    for r, k, channel in options:
                        moves.append(((state[1], k), cost + channel + row[k], (r, path)))
                    if apart is not None:
                        moves.append((0, cost + apart + row[0], (" ", path)))
            for key, total, way in moves:
                if key not in nxt or total < nxt[key][0]:
                    nxt[key] = (total, way)
        beams = nxt
    best, path = math.inf, None
    for state, (cost, way) in beams.items():
        if state != 0:
            cost += ends.get(state, math.inf) if type(state) is int else costs[state[0]][state[1]][0]
        if cost < best:
            best, path = cost, way
    read = []
    while path:
        read.append(path[0])
        path = path[1]
    return "".join(reversed(read)).strip()


def restore(token: str, costs: list, words: Words = NO_WORDS) -> str:
    """The words, set apart by blanks, that a written token (lower case) stands for; empty if it holds no letter."""
    core, token = token.strip(EDGE), token.strip(PLAIN_EDGE)
    if core.isalpha() and not _TWICE.search(core) and (core == token or core in words.known):
        return core
    if not any(map(str.isalpha, token)):
        return ""
    return decode(token, costs, words)


def tokens(text: str) -> set[str]:
    """The distinct written tokens of a text, and each run of three or more single characters as one lattice, its
    separators written as one blank (those that may stand for letters as they are, also beside the run)."""
    low = text.lower()
    found = set(low.split())
    maybe = _THREE.search(f" {low} ")
    if not maybe:
        return found
    done = 0
    for m in _SINGLES.finditer(low, max(0, maybe.start() - 1)):
        start, end = m.span()
        while start > done and not _in_word(low[start - 1]):
            start -= 1
        while end < len(low) and not _in_word(low[end]):
            end += 1
        found.add(_GAP.sub(" ", low[start:end]).strip())
        done = m.end()
    return found


# --- learning and scoring ------------------------------------------------------------------------------------

def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "toxic",
                    per_class: int = SAMPLE_PER_CLASS) -> tuple[DataFrame, float]:
    """(doc_id, text, y) of at most about ``per_class`` labelled documents of each class, chosen by a hash of the id, and the
    log odds of the classes over all learning labels, whatever the sample holds."""
    marked = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold(F.col("doc_id"), 5) != 0)) \
        .select("doc_id", F.col(label).cast("int").alias("y")).distinct()
    sizes = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return docs.select("doc_id", F.col("text"), F.lit(0).alias("y")).where(F.lit(False)), -math.inf
    chosen = F.lit(False)
    for y, n in sizes.items():
        chosen = chosen | ((F.col("y") == y) & hash_share(F.col("doc_id"), min(1.0, per_class / n)))
    # the broadcast side holds at most about 2 * per_class rows of two numbers, whatever the input's size
    return docs.select("doc_id", "text").join(F.broadcast(marked.where(chosen)), "doc_id"), math.log(sizes[1] / sizes[0])


def first_copies(sample: DataFrame) -> DataFrame:
    """(text, y) of the learning documents, copies and near copies of one class once: words of a text that was copied
    a thousand times are the evidence of one document.  A document is a copy if one with a smaller id shares a band of
    minima (that of 0.85 similar ones is missed by 2 in 100, and meets many more of its kind)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = word_memo()
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at:at + 200].copy()
                found = []
                for text in part["text"]:
                    h = shingle_hashes((text or "").encode(), memo)
                    low = [int((h * m).min()) if len(h) else 0 for m in _MUL]
                    found.append([hash((i, *low[i * MINIMA:(i + 1) * MINIMA])) for i in range(BANDS)])
                part["bands"] = found
                yield part[["doc_id", "text", "y", "bands"]]

    rows = sample.select("doc_id", "text", "y").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    banded = materialize(rows.select("doc_id", "text", "y").mapInPandas(run, "doc_id long, text string, y int, bands array<long>"), "toxicity-bands")
    each = banded.select("doc_id", "y", F.explode("bands").alias("band"))
    firsts = each.groupBy("y", "band").agg(F.min("doc_id").alias("first"))
    copies = each.join(firsts, ["y", "band"]).where("first < doc_id").select("doc_id", "y").distinct()
    return banded.join(copies, ["doc_id", "y"], "left_anti").select("text", "y")


def word_counts(sample: DataFrame, reader: Callable[[], Callable[[str], Iterable[str]]]) -> DataFrame:
    """word, pos, neg: documents of each class that hold the word; the word '' stands for all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = reader()
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at:at + 200]
                found = Counter((w, y) for text, y in zip(part["text"], part["y"], strict=True)
                                for w in {"", *chain.from_iterable(map(read, tokens(text or "")))})
                yield pd.DataFrame([(w, n * y, n * (1 - y)) for (w, y), n in found.items()], columns=["word", "pos", "neg"])

    return sample.mapInPandas(count, "word string, pos long, neg long").groupBy("word").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def known_words(sample: DataFrame) -> dict[str, int]:
    """The words written plainly in most learning documents (two at least), both classes weighing alike."""

    def plain(token: str) -> list[str]:
        core = token.strip(EDGE)
        return [core] if core.isalpha() else []

    counted = materialize(word_counts(sample, lambda: plain), "toxicity-known")
    total = counted.where("word = ''").collect()
    if not total:
        return {}
    rate = F.col("pos") / max(1, total[0]["pos"]) + F.col("neg") / max(1, total[0]["neg"])
    rows = counted.where("word <> '' and pos + neg >= 2").orderBy(F.desc(rate), "word").limit(KNOWN).collect()
    return {r["word"]: r["pos"] + r["neg"] for r in rows}


def _tail(k: int, n: int, share: float) -> float:
    """P(X >= k) of a binomial X of n draws."""
    term = total = 1.0
    for i in range(k, n):
        term *= (n - i) / (i + 1) * share / (1 - share)
        total += term
        if term < 1e-12 * total:
            break
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log(1 - share)
    return min(1.0, math.exp(log) * total)


def marked_words(counted: DataFrame, n_pos: int, n_neg: int) -> list:
    """The rows of ``counted`` (LEXICON at most) whose words are commoner in toxic documents than chance allows.

    The test adapts to the number of labels: a word's chance is that of so many toxic ones among its documents, and
    words in about equally many documents (by powers of two) are held to a false discovery rate of FALSE_WORDS."""
    share = n_pos / (n_pos + n_neg)
    total = F.col("pos") + F.col("neg")
    words = counted.where("word <> ''").withColumn("level", F.floor(F.log2(total)).cast("int"))
    tried = {r["level"]: r["n"] for r in words.groupBy("level").agg(F.count("*").alias("n")).collect()}
    gain = F.col("pos") * F.log(F.col("pos") / (total * share)) + F.when(F.col("neg") > 0, F.col("neg") * F.log(
        F.col("neg") / (total * (1 - share)))).otherwise(0.0)
    best = words.where((F.col("pos") >= 2) & (F.col("pos") > total * share)).orderBy(F.desc(gain), "word").limit(LEXICON).collect()
    levels: dict[int, list] = {}
    for r in best:
        levels.setdefault(r["level"], []).append((_tail(r["pos"], r["pos"] + r["neg"], share), r["word"], r))
    kept = []
    for level, found in sorted(levels.items()):
        found.sort(key=lambda x: x[:2])
        n = max((i for i, (chance, *_) in enumerate(found, 1) if chance * tried[level] <= FALSE_WORDS * i), default=0)
        kept += [r for *_, r in found[:n]]
    return kept


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple[np.ndarray, dict[str, int], dict[str, float], float]:
    """Character costs, known words, weight per marked word, and the log odds of a text without any of them."""
    costs = char_costs(char_counts(docs))
    sample, prior = labelled_sample(docs, labels, per_class=per_class)
    sample = materialize(first_copies(sample), "toxicity-sample")
    as_lists = costs.tolist()
    known = known_words(sample)

    def reader() -> Callable[[str], Iterable[str]]:
        tree = Words(known)
        return Readings(lambda t: tuple(restore(t, as_lists, tree).split())).__getitem__

    counted = materialize(word_counts(sample, reader), "toxicity-words")  # the words of a bounded sample
    totals = {r["word"]: r for r in counted.where("word = ''").collect()}
    if not totals or not min(totals[""]["pos"], totals[""]["neg"]):
        return costs, known, {}, -math.inf
    n_pos, n_neg = totals[""]["pos"], totals[""]["neg"]
    rows = marked_words(counted, n_pos, n_neg)
    weights = {}
    for r in rows:
        p, q = (r["pos"] + 0.5) / (n_pos + 1), (r["neg"] + 0.5) / (n_neg + 1)
        doubt = math.sqrt(1 / (r["pos"] + 0.5) + 1 / (r["neg"] + 0.5))  # of the log odds: few documents weigh little
        weight = math.log(p / q) - math.log((1 - p) / (1 - q)) - DOUBT * doubt
        if weight > LEAST_WEIGHT:
            weights[r["word"]] = weight
            prior += math.log((1 - p) / (1 - q))
    return costs, known, weights, prior


def scorer(docs: DataFrame, labels: DataFrame):
    """A function from a text column to (score, marked), learnt from ``docs`` and ``labels``."""
    costs, known, weights, prior = fit(docs, labels)
    as_lists = costs.tolist()

    @F.pandas_udf("score double, marked string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tree = Words(known)
        get = Readings(lambda t: tuple(w for w in restore(t, as_lists, tree).split() if w in weights)).__getitem__
        for batch in batches:
            scores, marked = [], []
            for text in batch:
                hits = set(chain.from_iterable(set(map(get, tokens(text or "")))))
                logit = min(50.0, max(-50.0, prior + sum(weights[w] for w in sorted(hits))))
                scores.append(1 / (1 + math.exp(-logit)) if prior > -math.inf else 0.0)
                marked.append(",".join(sorted(hits)))
            yield pd.DataFrame({"score": scores, "marked": marked})

    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, marked (the restored words that counted, sorted) for each row of ``docs``."""
    scored = docs.select("doc_id", scorer(docs, labels)("text").alias("s"))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "s.score",
                         (F.col("s.score") >= 0.5).cast("int").alias("predicted"), "s.marked")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns kept."""
    return docs.where(scorer(docs, labels)("text")["score"] < 0.5)
