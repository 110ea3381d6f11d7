"""Language identification of words and spans.

Letters' script ranges narrow the candidate languages of a word to those that use its script in the learning
rows.  Each candidate gets the word's log likelihood under its character trigrams and whole words (hashed into
``BUCKETS`` cells), relative to the best one.  Viterbi over a text's words with a penalty for every switch
labels spans of one language; the text's language is the one whose spans hold the most letters, and its score
their share.

Learning uses a bounded sample of labelled rows (``SAMPLE_PER_LANG``); scoring reads whole texts.

Edge cases: null texts and texts without a letter are ``und`` with score 0; words in a script of no learned
language favour none; without labelled rows every text is ``und``; repeated rows are treated row by row; other
columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, hash_share

SAMPLE_PER_LANG = 1_500
BUCKETS = 1 << 16
SWITCH = 10.0
FLOOR = -8.0
#: A language uses a script if so large a share of its letters is in it.
SCRIPT_SHARE = 0.01

#: First code point of each script range (Unicode blocks).
SCRIPTS = ((0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
           (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Other"), (0x0E00, "Thai"), (0x0E80, "Other"), (0x10A0, "Georgian"),
           (0x1100, "Hangul"), (0x1200, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x2C60, "Latin"),
           (0x2C80, "Other"), (0x3040, "Kana"), (0x3100, "Other"), (0x3400, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"),
           (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Other"), (0x20000, "Han"), (0x30000, "Other"))
_FIRST = [first for first, _ in SCRIPTS]
#: Letters of a piece of a word, at most.
PIECE = 40
_WORD = re.compile(r"[^\W\d_]+")
_BEYOND_LATIN = re.compile("[\u0370-\u1fff\u2070-\U0010ffff]")
_LAST = [first - 1 for first in _FIRST[1:]] + [0x10FFFF]
_RANGES = {s: "".join(f"{chr(a)}-{chr(b)}" for (a, x), b in zip(SCRIPTS, _LAST, strict=True) if x == s) for _, s in SCRIPTS}
_RANGES["Latin"] = r"\x00-" + _RANGES["Latin"][2:]
_PIECE = re.compile("|".join(rf"(?:(?![\W\d_])[{r}]){{1,{PIECE}}}" for r in _RANGES.values()))


def script(word: str) -> str:
    return SCRIPTS[bisect_right(_FIRST, ord(word[0])) - 1][1]


def pieces(text: str) -> tuple[list[str], re.Pattern]:
    """The words of a text, cut where the script changes and after PIECE letters, and the pattern that finds them."""
    found = _WORD.findall(text)
    if max(map(len, found), default=0) <= PIECE and (text.isascii() or not _BEYOND_LATIN.search(text)):
        return found, _WORD
    return _PIECE.findall(text), _PIECE


def features(found: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of all words (marked at both ends), the place where
    each word's trigrams start, and the bucket of each word itself."""
    marked = [f"<{w}>".encode() for w in found]
    sizes = np.array([len(m) for m in marked])
    flat = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    codes = (flat[:-2] << np.uint64(16)) | (flat[1:-1] << np.uint64(8)) | flat[2:]
    inside = np.ones(len(flat), bool)
    ends = np.cumsum(sizes)
    inside[ends - 1] = inside[ends - 2] = False
    cells = ((codes[inside[:-2]] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(BUCKETS)
    starts = np.concatenate([[0], np.cumsum(sizes - 2)[:-1]])
    return cells.astype(np.int64), starts, np.array([crc32(m) % BUCKETS for m in marked])


def learning_rows(docs: DataFrame, text: str = "text", per_lang: int = SAMPLE_PER_LANG) -> DataFrame:
    """(text, lang) of about ``per_lang`` rows of each language, chosen by a hash of the id, without the held-out fold."""
    rows = docs.where(F.col("lang").isNotNull() & F.col(text).isNotNull() & (fold(F.col("doc_id"), 4) != 2))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    chosen = F.lit(False)
    for r in sizes:
        chosen = chosen | ((F.col("lang") == r["lang"]) & hash_share(F.col("doc_id"), min(1.0, per_lang / r["n"])))
    return rows.where(chosen).select(F.col(text).alias("text"), "lang")


class Model:
    """Log likelihoods per bucket and language, and the scripts each language uses."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: dict[str, set[str]]):
        self.langs = langs
        share = (counts + 0.5) / (counts.sum(0, keepdims=True) + 0.5 * BUCKETS)
        self.logs = np.log(share).astype(np.float32)
        self.uses = {s: np.array([s in scripts.get(lang, ()) for lang in langs]) for s in {x for _, x in SCRIPTS}}

    def word_scores(self, found: list[str]) -> np.ndarray:
        """A row per word: 0 for the best candidate, never below FLOOR; all 0 if no language uses the script."""
        cells, starts, own = features(found)
        s = np.add.reduceat(self.logs[cells], starts, axis=0) + self.logs[own]
        uses = np.array([self.uses[script(w)] for w in found])
        s = np.where(uses, s, -np.inf)
        best = s.max(axis=1, keepdims=True)
        return np.where(uses.any(1, keepdims=True), np.maximum(s - np.where(np.isfinite(best), best, 0), FLOOR), 0).astype(np.float32)


def fit(docs: DataFrame, text: str = "text") -> Model | None:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, used = {}, Counter()
        for batch in batches:
            for t, lang in zip(batch["text"], batch["lang"], strict=True):
                cells = grams.setdefault(lang, np.zeros(BUCKETS))
                words = Counter(map(str.lower, pieces(t)[0]))
                if not words:
                    continue
                times = np.fromiter(words.values(), float, len(words))
                at, starts, own = features(list(words))
                cells += np.bincount(at, np.repeat(times, np.diff([*starts, len(at)])), BUCKETS) + np.bincount(own, times, BUCKETS)
                for w, n in words.items():
                    used[lang, script(w)] += n * len(w)
        for lang, cells in grams.items():
            at = np.flatnonzero(cells)
            yield pd.DataFrame({"lang": lang, "script": "", "cell": at, "n": cells[at]})
        if used:
            yield pd.DataFrame([(lang, s, -1, n) for (lang, s), n in used.items()], columns=["lang", "script", "cell", "n"])

    rows = (learning_rows(docs, text).mapInPandas(count, "lang string, script string, cell long, n double")
            .groupBy("lang", "script", "cell").agg(F.sum("n").alias("n")).toPandas())  # BUCKETS rows per language at most
    if not len(rows):
        return None
    langs = sorted(rows["lang"].unique())
    counts, letters = np.zeros((BUCKETS, len(langs))), {}
    for lang, s, cell, n in rows.itertuples(index=False):
        if cell >= 0:
            counts[cell, langs.index(lang)] = n
        else:
            letters.setdefault(lang, Counter())[s] += n
    uses = {lang: {s for s, n in c.items() if n >= SCRIPT_SHARE * sum(c.values())} for lang, c in letters.items()}
    return Model(langs, counts, uses)


def spans(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language index of every word on the best path, each switch costing ``switch``."""
    n, width = scores.shape
    total = scores.sum(0)
    main = int(total.argmax())
    # Staying is the best path if no run of words gains more than a switch in any one other language (each piece of a
    # detour costs a switch at least) and the best of the others, word by word, does not gain over the whole text.
    over = scores.astype(float) - scores[:, main:main + 1]
    gain = np.vstack([np.zeros((1, width)), np.cumsum(over, axis=0)])
    over[:, main] = -np.inf
    if (gain - np.minimum.accumulate(gain, axis=0)).max() <= switch and over.max(axis=1).sum() <= 0:
        return np.full(n, main)
    back = np.empty((n, width), np.int32)
    rows = scores.tolist()
    path = rows[0]
    own = list(range(width))
    for i in range(1, n):
        top = max(path)
        at, over = path.index(top), top - switch
        prev = [k if p >= over else at for k, p in zip(own, path, strict=True)]
        back[i] = prev
        path = [max(p, over) + e for p, e in zip(path, rows[i], strict=True)]
    out = np.empty(n, np.int64)
    out[-1] = path.index(max(path))
    for i in range(n - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


class Scorer:
    """Word scores in one bounded table, reused over texts."""

    LIMIT = 200_000

    def __init__(self, model: Model):
        self.model, self.index = model, {}
        self.table = np.empty((self.LIMIT, len(model.langs)), np.float32)

    def rows(self, found: list[str]) -> np.ndarray:
        if len(found) > self.LIMIT // 2:  # a very long text: in parts
            half = len(found) // 2
            return np.vstack([self.rows(found[:half]), self.rows(found[half:])])
        index = self.index
        new = [w for w in set(found) if w not in index]
        if len(index) + len(new) > self.LIMIT:
            index.clear()
            new = list(set(found))
        if new:
            self.table[len(index):len(index) + len(new)] = self.model.word_scores(new)
            index.update(zip(new, range(len(index), len(index) + len(new)), strict=True))
        return self.table[np.fromiter(map(index.__getitem__, found), np.int64, len(found))]

    def label(self, text: str | None) -> tuple[str, float, list[tuple[int, int, str]]]:
        """(language, score, [(start, end, language)]) of a text; starts and ends are characters."""
        found, pattern = pieces(text) if text else ([], _WORD)
        if not found:
            return "und", 0.0, []
        langs = self.model.langs
        path = spans(self.rows(list(map(str.lower, found))))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        letters = np.bincount(path, sizes, len(langs))
        best = int(letters.argmax())
        cut = np.flatnonzero(np.diff(path)) + 1
        if not len(cut):
            return langs[best], 1.0, [(_WORD.search(text).start(), text.rfind(found[-1]) + len(found[-1]), langs[best])]
        at = [m.span() for m in pattern.finditer(text)]
        ends = zip([0, *cut], [*cut, len(path)], strict=True)
        return langs[best], float(letters[best] / sizes.sum()), [(at[a][0], at[b - 1][1], langs[int(path[a])]) for a, b in ends]


def identify(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, spans (start, end, lang) for each row of ``docs``."""
    model = fit(docs, text)

    @F.pandas_udf("lang string, score double, spans array<struct<start:int,end:int,lang:string>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model) if model else None
        for batch in batches:
            rows = [scorer.label(t) if scorer else ("und", 0.0, []) for t in batch]
            yield pd.DataFrame({"lang": [r[0] for r in rows], "score": [r[1] for r in rows],
                                "spans": [[{"start": a, "end": b, "lang": c} for a, b, c in r[2]] for r in rows]})

    out = docs.select("doc_id", run(F.col(text)).alias("r"))
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), F.col("r.lang").alias("lang_pred"), "r.score", "r.spans")
