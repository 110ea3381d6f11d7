"""Ranked search, the n-gram Jaccard join and the source divergence audit against brute force, and on odd rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dossier.llm import divergence, jaccard, ranked
from dossier.llm.common import letter_runs

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
LONG = " " * 1_000_000 + "a"


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_letter_runs_are_whole_whatever_the_piece():
    data = "Ab cd-ef  Übung9 ".encode() * 50 + b"x" * 300
    whole = data.translate(ranked.LETTERS).split()
    for piece in (1, 7, 64, 1 << 20):
        assert [w for part in letter_runs(data, ranked.LETTERS, piece) for w in part] == whole
    assert list(letter_runs(b"", ranked.LETTERS)) == [] and [w for p in letter_runs(LONG.encode(), ranked.LETTERS) for w in p] == [b"a"]


# 11 ranked search
def brute_search(docs, items, k):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    counted = [(i, Counter(terms(t))) for i, t in docs if i is not None]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counted:
            m = 25 + 75 * c.total() * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([3, 40, 200])))) for i in range(1, 500)]


def test_ranked_search_matches_brute_force(spark, make, prose, monkeypatch):
    docs = [*prose, (900, prose[0][1]), (901, prose[0][1]), (902, prose[0][1].upper())]  # ties
    items = [(1, prose[0][1]), (2, "w1 w1 w2 w399"), (3, "nothing known"), (4, ""), (5, "W7,w8;w9-w9")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    made = make([(i, t, None, None) for i, t in docs])
    assert sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows(ranked.search(made, frame, 10))) == brute_search(docs, items, 10)
    # several blocks of queries give the same
    monkeypatch.setattr(ranked, "BLOCK_TERMS", 50)
    assert sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows(ranked.search(made, frame, 10))) == brute_search(docs, items, 10)


def test_best_positions_stop_early_and_lose_nothing():
    rng = np.random.default_rng(11)
    n, t = 4000, 6
    row, term = np.nonzero(rng.random((n, t)) < 0.5)
    tf = rng.geometric(0.4, len(row))
    shard = ranked.Shard(np.arange(n), rng.integers(30, 300, n), row.astype(np.int32), term.astype(np.int32), tf, rng.integers(1, 9000, t))
    whole = np.zeros((n, t), np.int64)
    for x in range(t):
        docs, impacts, looked, place = shard.list_of(x)
        assert (np.diff(impacts) <= 0).all() and (docs[place] == looked).all()
        whole[docs, x] = impacts
    none = (np.empty(0, np.int64), np.empty(0, np.int64))
    for query in ([(0, 1)], [(0, 1), (3, 2)], [(i, 1) for i in range(t)]):
        scores = sum(whole[:, x] * times for x, times in query)
        order = np.lexsort((np.arange(n), -scores))[:10]
        (ids, found), read = ranked.best_positions(shard, query, none, 10)
        assert (ids == order).all() and (found == scores[order]).all()
        assert read < sum(len(shard.list_of(x)[0]) for x, _ in query)
    assert ranked.best_positions(shard, [(0, 1)], (np.arange(10), np.full(10, 1 << 60)), 10)[1] == 0  # a better answer is known


def test_ranked_search_odd_rows(spark, make, odd):
    items = spark.createDataFrame([(1, "same text", "x"), (1, "same text", "x"), (2, None, "x"), (None, "same", "x"), (3, "東京 w5 w5", "x")],
                                  "item_id long, text string, doc_id string")
    got = sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows(ranked.search(odd, items)))
    assert got == brute_search([(r["doc_id"], r["text"]) for r in rows(odd)], [(1, "same text"), (3, "東京 w5 w5")], 10)
    assert [x[2] for x in got] == [4, 4, 5, 6, 7]
    assert ranked.search(make([]), items).count() == 0 and ranked.search(odd, items.limit(0)).count() == 0
    assert ranked.search(make([(1, LONG, None, None)]), items).count() == 0


# 12 n-gram Jaccard join
def brute_components(docs, size, limit):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()

    sets = [(i, shingles(t)) for i, t in docs]
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p, (i, a) in enumerate(sets):
        for j, b in sets[p + 1:]:
            both = len(a & b)
            if both and 100 * both >= limit * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(a), find(i)) for i, a in sets}


def near_copies(seed, groups, copies, edits):
    """Groups of edited copies around the limit, each with copies of its copies, some words cut, some texts twice."""
    rng, docs = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}x{rng.randrange(5000)}" if rng.random() < 0.7 else f"common{rng.randrange(30)}" for _ in range(rng.choice([30, 120, 300]))]
        for _ in range(copies):
            text = list(rng.choice([base, docs[-1].split()]) if docs and rng.random() < 0.5 and docs[-1].startswith(f"g{g}") else base)
            for _ in range(rng.randrange(edits + 1)):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
            docs.append(" ".join(text[:len(text) - rng.choice([0, 0, 0, 2, 8])]))
    docs += docs[::17]
    rng.shuffle(docs)
    return [(i + 1, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize(("seed", "size", "limit"), [(1, 3, 90), (3, 2, 80)])
def test_jaccard_components_match_brute_force(spark, make, seed, size, limit):
    docs = near_copies(seed, 12, 25, 4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(jaccard.similar_components(make([(i, t, None, None) for i, t in docs]), limit, size))}
    want = brute_components(docs, size, limit)
    assert got == want
    sizes = Counter(c for _, c in want.values())
    assert max(sizes.values()) > 5 and len(sizes) > 20  # linked groups, and near misses that stay apart


def test_bitmap_distance_is_a_lower_bound():
    rng = np.random.default_rng(4)
    for n, m, shared in ((5, 5, 5), (300, 320, 290), (1000, 40, 40), (64, 2000, 0)):
        x = rng.integers(0, 1 << 63, n + m - shared, dtype=np.uint64)
        a, b = np.sort(x[:n]), np.sort(x[n - shared:])
        assert jaccard.distance_bound(jaccard.bitmap(a), jaccard.bitmap(b)) <= n + m - 2 * shared
    assert jaccard.distance_bound(jaccard.bitmap(a), jaccard.bitmap(a)) == 0


def test_jaccard_odd_rows(make, odd):
    got = defaultdict(set)
    for r in rows(jaccard.similar_components(odd)):
        got[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    assert got[1] == {(0, 1)} and got[2] == {(0, 2)} and got[3] == {(0, 3)} and got[4] == {(1, 4)} and got[5] == {(1, 4)}
    assert got[None] == {(None, None)} and jaccard.similar_components(odd).count() == odd.count()
    assert jaccard.similar_components(make([])).count() == 0
    same_id = make([(1, "a b c d", None, None), (1, "e f g h", None, None), (2, "a b c d", None, None), (3, LONG, None, None), (4, "A", None, None)])
    found = rows(jaccard.similar_components(same_id))
    assert len(found) == 5 and {r["component_id"] for r in found if r["doc_id"] in (3, 4)} == {3}


def test_a_large_group_of_copies_and_one_stray(make):
    base = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join([*base, f"tail{i}"])) for i in range(1, 1500)] + [(5000, " ".join(base[:40]))]
    got = {r["doc_id"]: r["component_id"] for r in rows(jaccard.similar_components(make([(i, t, None, None) for i, t in docs])))}
    assert {got[i] for i in range(1, 1500)} == {1} and got[5000] == 5000


# 13 source divergence
def brute_audit(docs, min_docs, top):
    terms = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    by_lang = defaultdict(list)
    for lang, source, text in docs:
        by_lang[lang or ""].append((source or "", Counter(terms(text))))
    out = []
    for lang, there in by_lang.items():
        df = Counter(t for _, c in there for t in c)
        kept = sorted(t for t, n in df.items() if n >= min_docs)
        groups = {s: Counter() for s, _ in there}
        for s, c in there:
            groups[s].update({t: c[t] for t in kept if t in c})
        whole = sum(groups.values(), Counter())
        share = lambda c: {t: 1 + 10 ** 9 * (c[t] + 2) // (c.total() + 2 * len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        p, q = {s: share(c) for s, c in groups.items()}, share(whole)
        for s, c in groups.items():
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            own = [(-f(p[s][t], q[t]), t) for t in kept if c[t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(own)[:top])):
                out += [(lang, s, part, item, -v, r) for r, (v, item) in enumerate(found, 1)]
    return sorted(out)


def audited(df):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in rows(df))


def test_audit_matches_brute_force_in_one_tile_and_in_many(make, monkeypatch):
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "abcdefghij" for b in "éxyz"]
    docs = [(rng.choice(["en", "fr"]), rng.choice(["s1", "s2", "s3", "s4", "é", None]), " ".join(rng.choices(words, [1 / (i + 1) for i in range(40)], k=30)) + " 12 A.B")
            for _ in range(300)] + [("de", "only", "eins zwei"), ("it", "a", None), ("it", "b", "uno"), (None, "a", "x"), ("en", "empty", "")]
    made = make([(i, t, lang, s) for i, (lang, s, t) in enumerate(docs)])
    want = brute_audit(docs, 10, 10)
    assert audited(divergence.audit(made)) == want
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "CHUNK", 7)
    assert audited(divergence.audit(made)) == want


def test_run_lengths_hold_the_column_they_encode():
    lengths = np.array([3, 1, 2, 5])
    got = divergence.encode("en", 0, lengths, [["a"], ["a", "b"], ["a", "b"], ["b"]], [[4], [4, 1], [2, 1], [1]])
    columns = {r.source: (list(r.ends), list(r.counts)) for r in got.itertuples()}
    assert columns["a"] == ([4, 6, 11], [4, 2, 0]) and columns["b"] == ([3, 11], [0, 1]) and columns[None] == ([11], [0])


def test_audit_odd_rows(make, odd):
    assert audited(divergence.audit(odd)) == brute_audit([(r["lang"], r["source"], r["text"]) for r in rows(odd)], 10, 10)
    assert divergence.audit(make([])).count() == 0
    long = make([(i, LONG, "en", "a") for i in range(12)])
    assert audited(divergence.audit(long)) == []


def test_shares_are_exact_beyond_double_precision(spark):
    cases = [(0, 0, 1), (3, 10, 4), (10 ** 12 + 7, 10 ** 15 - 1, 12345), (10 ** 15, 10 ** 15, 1)]
    for c, n, v in cases:
        want = 1 + 10 ** 9 * (c + 2) // (n + 2 * v)
        assert divergence.shares(np.array([c]), n, v)[0] == want
        assert spark.range(1).select(divergence.share(F.lit(c).cast("long"), F.lit(n).cast("long"), F.lit(v).cast("long"))).first()[0] == want


def test_vectors_merge_across_batches_and_flushes(make, monkeypatch):
    docs = [(i, "a b c " * (i % 3 + 1) + f"d{i % 5}", "en", f"s{i % 4}") for i in range(60)]
    whole = audited(divergence.audit(make(docs)))
    monkeypatch.setattr(divergence, "HELD", 2)
    monkeypatch.setattr(divergence, "LOOK", 5)
    assert audited(divergence.audit(make(docs))) == whole == brute_audit([(lang, s, t) for _, t, lang, s in docs], 10, 10)
