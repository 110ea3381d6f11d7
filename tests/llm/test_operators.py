"""Each operator against a brute-force version on the smallest tables, and on odd rows."""

import hashlib
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dossier.llm import language, licenses, mixing, neardup, packing, pii, quality, queries, repeats, topk, toxicity
from dossier.llm.common import table
from dossier.llm.graph import components

SF = "/root/testdata/sf0.001"
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}


def rows(df):
    return [r.asDict() for r in df.collect()]


def labels_of(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int, toxic int")


# 1 language
def test_language_held_out_accuracy(spark):
    got = queries.op1_language_id(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 20 and sum(r.lang == r.lang_pred for r in got) >= 0.9 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_odd_rows(odd, make):
    got = {r["doc_id"]: r for r in rows(language.identify(odd))}
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == got[3]["lang_pred"] == "und"
    assert language.identify(make([])).count() == 0


def test_words_without_spaces_are_read_whole(make):
    assert language.pieces("abc東京とdef " + "語" * 95 + " é")[0] == ["abc", "東京", "と", "def", "語" * 40, "語" * 40, "語" * 15, "é"]
    assert language.pieces("plain words")[0] == ["plain", "words"] and language.pieces("1 2 _")[0] == []
    learnt = [(i, "the house and the garden", "en", "a") for i in range(40)] + [(100 + i, "我们在花园里看书", "zh", "a") for i in range(40)]
    got = {r["doc_id"]: r for r in rows(language.identify(make([*learnt, (500, "the" + "我们在花园里看书" * 20, None, "a")])))}
    assert got[500]["lang_pred"] == "zh" and [(s["start"], s["end"], s["lang"]) for s in got[500]["spans"]][-1][1:] == (163, "zh")


def test_viterbi_matches_the_full_recursion():
    rng = np.random.default_rng(5)
    for n in (1, 2, 30):
        s = rng.uniform(-6, 0, (n, 3))
        got = language.spans(s, 4.0)
        value = lambda p: s[np.arange(n), p].sum() - 4.0 * (np.diff(p) != 0).sum()
        best = s[0].copy()
        for i in range(1, n):
            best = s[i] + np.maximum(best, best.max() - 4.0)
        assert value(got) == pytest.approx(best.max())


# 2 quality
def counts(text):
    w = SPLIT.findall(text)
    lines = [x for x in text.split("\n") if SPLIT.search(x)]
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cover = {j for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(cover) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover), failed


def test_quality_counts(spark, texts):
    for r in queries.op2_quality_rules(spark, SF).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == counts(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def rejections(text):
    """The names of the rules that reject a text, from their plain statements."""
    n_words, chars, symbols, dup_lines, *_ = counts(text)
    letters = [c for c in text if unicodedata.category(c)[0] == "L"]
    lower = [c for c in letters if unicodedata.category(c) == "Ll"]
    return {name for name, hit in {
        "symbols": symbols * 5 > n_words, "word_length": not 2 * n_words <= chars <= 14 * n_words,
        "repeated_lines": dup_lines * 2 > len(text.split("\n")), "exclamation": text.count("!") * 5 > n_words,
        "few_lowercase": len(lower) * 2 < len(letters), "few_letters": len(letters) * 10 < 6 * chars,
        "few_distinct_words": len(set(SPLIT.findall(text))) * 20 < n_words}.items() if hit}


def test_quality_verdicts_and_clashing_names(spark, make, texts):
    plain = " ".join(f"word{chr(97 + i)}" for i in range(26))
    bad = [plain, plain + " #$%&|<" * 2, "a " + " ".join("bcdefghijklmnopqrstuvwxyz"), "\n".join(f"{plain} {i // 3}" for i in range(6)), plain + " !!!!!!!",
           plain.upper(), " ".join(f"{i * 977}" for i in range(30)), " ".join((["aa", "bb", "cc"] * 70)), "é" * 9, ""]
    every = [*texts.items(), *((10**6 + i, t) for i, t in enumerate(bad))]
    clash = make([(i, t, None, None) for i, t in every]).withColumnRenamed("text", "body").withColumnRenamed("lang", "_ids").withColumn("kept", F.lit("x"))
    out = quality.judge(clash, text="body")
    assert set(clash.columns) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    seen = set()
    for r in out.collect():
        names = rejections(r["body"] or "")
        if counts(r["body"] or "")[5]:
            assert r["rejected_by"] == "base" and not r["kept"]
        else:
            assert r["kept"] == (not names) and (r["kept"] or r["rejected_by"] in names)
            seen |= names
    assert {"symbols", "word_length", "exclamation", "few_lowercase", "few_letters"} <= seen


def test_quality_cost_follows_the_work(spark):
    sample = quality.materialize(spark.range(2000).selectExpr("repeat('some words here ', 100) AS text", "1L AS n_words"), "cost-sample")
    cheap, dear = F.col("n_words") > 5, F.length(F.regexp_replace("text", r"[^\p{Ll}]+", "")) > F.col("again")
    assert quality.cost_of(sample, dear) > 2 * quality.cost_of(sample, cheap)


def test_quality_odd_rows(odd, make):
    got = rows(quality.judge(odd.select("doc_id", "text")))
    assert len(got) == 10 and all(g["base_failed"] for g in got if g["doc_id"] != 6)
    assert quality.judge(make([]).select("doc_id", "text")).count() == 0


# 3 substring deduplication
def removal(docs):
    seen = {}
    words_of = [(i, SPLIT.findall(t or "")) for i, t in sorted(docs, key=lambda d: d[0])]
    for i, w in words_of:
        for j in range(len(w) - 12):
            seen.setdefault(tuple(w[j:j + 13]), i)
    out = []
    for i, w in words_of:
        gone = {k for j in range(len(w) - 12) if seen[tuple(w[j:j + 13])] < i for k in range(j, j + 13)}
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("group, block", [(2_000_000, 500_000), (500, 300)])
def test_substring_dedup(spark, texts, monkeypatch, group, block):
    monkeypatch.setattr(repeats, "GROUP_SUFFIXES", group)
    monkeypatch.setattr(repeats, "BLOCK_WORDS", block)
    got = sorted(tuple(r) for r in queries.op3_substring_dedup(spark, SF).collect())
    assert got == removal(texts.items())


def test_substring_dedup_odd_rows(odd, make):
    got = rows(repeats.dedupe(odd))
    assert len(got) == 10 and {g["n_removed"] for g in got} == {0}
    assert repeats.dedupe(make([])).count() == 0
    zero = make([(1, "a\x00b \x01 " + "x " * 13, None, None), (2, "x " * 14 + "a\x00b", None, None)])
    assert sorted((r["n_words"], r["n_removed"]) for r in rows(repeats.dedupe(zero))) == [(15, 0), (15, 14)]


# 4 packing
def test_packing(spark, texts):
    from public_tokenizers import path
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    got = rows(queries.op4_best_fit_packing(spark, SF))
    pieces = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got}
    want = {}
    for i, text in texts.items():
        ids = t.encode(text, add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % 1024 + 1
        for k, at in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[at:first if k == 0 else at + 1024]
            want[i, k] = (at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert pieces == want
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    bins = []  # best fit decreasing, piece by piece
    for n in sorted((r["length"] for r in got), reverse=True):
        fits = [(room - n, k) for k, room in enumerate(bins) if room >= n]
        if fits:
            bins[min(fits)[1]] -= n
        else:
            bins.append(1024 - n)
    assert len(by) <= len(bins) + 1


def test_packed_sequences_hold_the_documents(odd, make):
    got = rows(packing.sequences(odd))
    assert sum(len(r["ids"]) for r in got) == sum(r["length"] for r in rows(packing.pack(odd)))
    assert packing.pack(odd).where("piece = 0").count() == 10 and packing.pack(make([])).count() == 0


# 5 near-duplicates
def shingles(text):
    w = SPLIT.findall(text.translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def classes(docs):
    sets = {i: shingles(t or "") for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for p, a in enumerate(ids):
        for b in ids[p + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op5_minhash_neardup(spark, SF).collect()}
    assert got == classes(texts.items())


def test_near_duplicates_of_chained_edits(make):
    rng = np.random.default_rng(3)
    base = [f"v{x}" for x in rng.integers(0, 10_000, 200)]
    docs, now = [], list(base)
    for i in range(40):  # neighbours are links, ends are not; near misses stay in the same buckets
        now = list(now)
        now[int(rng.integers(0, 200))] = f"e{i}"
        docs.append((i, " ".join(now), "en", "a"))
        docs.append((100 + i, " ".join(x if rng.random() > 0.03 else "q" for x in base), "en", "a"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(neardup.near_duplicates(make(docs)))}
    assert got == classes([(i, t) for i, t, _, _ in docs])


def test_tiles_split_large_buckets(spark, texts, monkeypatch):
    monkeypatch.setattr(neardup, "TILE_ROWS", 2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op5_minhash_neardup(spark, SF).collect()}
    assert got == classes(texts.items())


def test_near_duplicates_odd_rows(odd, make):
    got = rows(neardup.near_duplicates(odd))
    assert len(got) == 10 and sum(g["doc_id"] is None and g["kept"] for g in got) == 2
    assert {g["component_id"] for g in got if g["doc_id"] in (4, 5)} == {4}
    left = rows(neardup.without_duplicates(odd))
    assert sorted(str(r["doc_id"]) for r in left) == ["1", "2", "3", "4", "6", "7", "None", "None"]
    assert neardup.near_duplicates(make([])).count() == 0


def test_sketch_estimates_similarity_and_merges():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    b = np.concatenate([a[:2500], rng.integers(0, 1 << 63, 400, dtype=np.uint64)])
    ra, rb = neardup.registers(a), neardup.registers(b)
    j = neardup.joint_similarity(ra[None], rb[None], np.array([3000.0]), np.array([2900.0]))[0]
    assert abs(j - 2500 / 3400) < 0.15
    assert (neardup.merge_registers(ra, rb) == neardup.registers(np.concatenate([a, b]))).all()


# 6 licenses
def test_license_base(spark, texts):
    for r in queries.op6_license_scan(spark, SF).collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[r.doc_id].translate(LOWER))
        places = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(w)) if tuple(w[i:i + len(phrase)]) == phrase]
        at = [i for i, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))


def test_license_notices(make, odd):
    docs = make([(1, "x y Licensed under CC BY-NC 4.0. z", None, None), (2, "MIT KLicense", None, None), (3, "under the apache tree", None, None),
                 (4, "Redistribution and use in source and binary forms, with or without minor modification, are permitted provided that", None, None)])
    got = {r["doc_id"]: r for r in rows(licenses.scan(docs))}
    assert [got[i]["labels"] for i in (1, 2, 3, 4)] == ["cc-by-nc", "", "", "bsd"]
    assert len(rows(licenses.scan(odd))) == 10 and licenses.scan(make([])).count() == 0


def test_license_notices_with_insertions(make):
    first, second = "Redistribution and use in source and binary forms, with or without modification, are permitted", "provided that the following conditions are met:"
    docs = make([(1, f"x {first} (subject to the limitations in the disclaimer below) {second} y", None, None), (2, f"{first} (all source and binary forms alike) {second}", None, None),
                 (3, f"{first} {'other words ' * 30} {second}", None, None), (4, f"{first} {second} {first} {second}", None, None)])
    assert {r["doc_id"]: r["labels"] for r in rows(licenses.scan(docs))} == {1: "bsd", 2: "bsd", 3: "", 4: "bsd"}


# 7 toxicity
def test_restore():
    costs = np.full((28, 28, 28), 3.0).tolist()
    assert [toxicity.restore(x, costs) for x in ("1d10t", "tr@sh,", "idiooot", "word", "123", "$tupid!")] == ["idiot", "trash", "idiot", "word", "", "stupid"]
    assert "idiot" in {toxicity.restore(t, costs) for t in toxicity.tokens("you i d i o t !")}


def test_toxicity_learns_and_restores(spark, make):
    plain = [(i, f"plain words number {i} here", "en", "a") for i in range(200)]
    bad = [(1000 + i, f"plain words grobian here {i}", "en", "a") for i in range(100)]
    docs = make(plain + bad + [(5000, "such a gr0bian you are", "en", "a"), (5001, "a g.r.o.b.i.a.n here", "en", "a"), (5002, None, None, None), (None, "x", None, None)])
    marks = labels_of(spark, [(i, 1, int(i >= 1000)) for i, *_ in plain + bad] + [(None, 1, 1)])
    got = {r["doc_id"]: r for r in rows(toxicity.score(docs, marks))}
    assert all(got[i]["predicted"] == int(i >= 1000) for i in [*range(200), *range(1000, 1100)])
    assert got[5000]["predicted"] == 1 and got[5001]["predicted"] == 1 and got[5002]["predicted"] == 0 and got[None]["held_out"] is None
    assert toxicity.score(docs, marks.where("toxic = 0")).where("score > 0").count() == 0
    assert toxicity.score(make([]), marks).count() == 0
    assert toxicity.without_toxic(docs, marks).columns == docs.columns


def prose(*extra):
    """Costs of the character model and known words of a small text."""
    known = Counter("worthless people are stupid and this idiot asks what a stupid idiot would kill for worthless trash in class".split() * 40)
    known.update(extra)
    codes = toxicity._CLASS[np.frombuffer(" ".join(known.elements()).encode(), np.uint8)]
    counts = np.bincount((codes[:-2] * 28 + codes[1:-1]) * 28 + codes[2:], minlength=28 ** 3).reshape(28, 28, 28)
    return toxicity.char_costs(counts.astype(float)).tolist(), toxicity.Words(known)


def test_repeated_letters_long_tokens_and_joined_words_are_decoded():
    costs, words = prose()
    read = lambda t: toxicity.restore(t, costs, words)
    written = ["worthlesss", "wooorthless", "stuupid", "idiiot", "killl", "1di" + "o" * 95 + "t", "i" * 50 + "diot", "w0rthle$$", "!diot", "people", "class"]
    assert [read(t) for t in written] == ["worthless", "worthless", "stupid", "idiot", "kill", "idiot", "idiot", "worthless", "idiot", "people", "class"]
    assert read("1d10t,stupid;tr@sh," * 20).split() == ["idiot", "stupid", "trash"] * 20
    assert len(read("ab1" * 30_000)) > 10_000


def test_letters_set_apart_by_any_separator_are_decoded():
    costs, words = prose(*["a"] * 40, *["you"] * 40, *["méchant"] * 40)
    read = lambda text: {w for t in toxicity.tokens(text) for w in toxicity.restore(t, costs, words).split()}
    for text in ("you i d i o t.", "(i d i o t)", "such a i d i o t", "i.d.i.o.t,", "i.d.i.o.t", "you i  d  i  o  t", "i\nd\ni\no\nt", "i/d/i/o/t",
                 "you i,d,i,o,t !", "you: i - d - i - o - t", "i|d|i|o|t", "1 d 1 0 t", "you ! d i o t", "i d d i o t", "i_d_i_o_t s t u p i d"):
        assert "idiot" in read(text), text
    assert "stupid" in read("$ t u p i d") and "méchant" in read("m é c h a n t ?") and {"a", "idiot", "you"} <= read("you a i d i o t you")
    assert toxicity.tokens("plain words in a row") == {"plain", "words", "in", "a", "row"}
    assert len(read("a b 1 " * 20_000)) > 0 and read("1 2 3 4") == set()


def test_toxicity_restores_doubled_letters_in_documents(make, spark):
    plain = [(i, f"the class will discuss people and letters {i}", "en", "a") for i in range(200)]
    bad = [(1000 + i, f"the class will discuss worthless people {i}", "en", "a") for i in range(100)]
    docs = make(plain + bad + [(5000, "such worthlesss people", "en", "a"), (5001, "such woorthless people", "en", "a"), (5002, "so,w0rthless" + "s" * 90 + ",people", "en", "a")])
    got = {r["doc_id"]: r for r in rows(toxicity.score(docs, labels_of(spark, [(i, 1, int(i >= 1000)) for i, *_ in plain + bad])))}
    assert all(got[i]["marked"] == "worthless" and got[i]["predicted"] == 1 for i in (5000, 5001, 5002))


def test_toxicity_threshold_does_not_move_with_the_cap(make, spark):
    def logit_without_words(n_clean, per_class):
        texts = [(i, f"plain words number {i} here", "en", "a") for i in range(n_clean)] + [(9000 + i, f"plain grobian here {i}", "en", "a") for i in range(150)]
        _, _, weights, prior = toxicity.fit(make(texts), labels_of(spark, [(i, 1, int(i >= 9000)) for i, *_ in texts]), per_class)
        assert "grobian" in weights
        return prior

    whole, capped, rarer = logit_without_words(1500, 10_000), logit_without_words(1500, 100), logit_without_words(3000, 100)
    assert capped == pytest.approx(whole, abs=0.8)  # a prior of the capped counts would be 2.3 higher
    assert rarer == pytest.approx(capped - np.log(2), abs=0.4)


@pytest.mark.parametrize("sf, n_words", [("sf0.001", 4), ("sf0.01", 10)])
def test_toxicity_recall_with_few_labels(spark, sf, n_words):
    path = f"/root/testdata/{sf}"
    marked = {"idiot", "stupid", "worthless", "moron", "loser", "clown", "scum", "trash", "pathetic", "disgusting"}
    got = queries.op7_toxicity(spark, path).join(table(spark, path, "documents").select("doc_id", "text"), "doc_id").join(
        table(spark, path, "labels").select("doc_id", "toxic"), "doc_id").collect()
    bad = [r for r in got if marked & set(r.text.lower().split())]
    assert len(bad) >= 5 and sum(r.predicted for r in bad) >= 0.8 * len(bad)
    assert len(marked & {w for r in got for w in r.marked.split(",")}) >= n_words
    clean = [r for r in got if r.toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_the_same_words_are_marked_when_documents_repeat(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text"), table(spark, "/root/testdata/sf0.01", "labels").select("doc_id", "toxic")
    marked = {"idiot", "stupid", "worthless", "moron", "loser", "clown", "scum", "trash", "pathetic", "disgusting"}
    for times in (1, 5, 20):
        copies = [1_000_000 * i for i in range(times)]
        again = lambda df: df.withColumn("doc_id", F.explode(F.transform(F.array(*map(F.lit, copies)), lambda o: o + F.col("doc_id"))))
        _, _, weights, _ = toxicity.fit(again(docs), again(labels))
        assert set(weights) == marked, times


def test_near_copies_are_one_learning_document(spark):
    base = " ".join(f"w{i}" for i in range(200))
    rows_ = [(i, base.replace(f"w{i} ", f"x{i} "), 1) for i in range(1, 60)] + [(100 + i, " ".join(f"d{i}w{k}" for k in range(40)), 1) for i in range(20)]
    rows_ += [(200, base, 0), (201, None, 0), (202, "", 0), (203, "short", 0), (100, "d0w0", 1)]
    got = toxicity.first_copies(spark.createDataFrame(rows_, "doc_id long, text string, y int")).groupBy("y").count().collect()
    found = {r["y"]: r["count"] for r in got}
    assert 21 <= found[1] <= 24 and found[0] == 3  # one of the copies (a few at most), twenty others; the empty ones are alike


# 8 personal data
RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    def ok(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(x) <= 255 for x in m.split("."))
        if kind == "card":
            return 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
        return kind == "email" or 9 <= len(d) <= 15

    found = sorted((m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, rule) in enumerate(RULES.items())
                   for m in re.finditer(rule, text) if ok(name, m.group()))
    return ",".join(x for _, _, x in found)


TRICKY = ["a@b.c_d@e.f x@y z@w.q", "1.2.3.4.5 300.1.1.1 0000255.1.2.3 12.34", "4111 1111-1111 1111 4111111111111112 1 2", "+1 (980) 555-6268 +12 3 ++49 30 1234567.",
          "é€😀 mail me@x.org 東 4111111111111111", "9" * 40, "1 " * 700 + "4111111111111111", "a@" + "b." * 400 + "c", "x" * 5000 + "@y.z", ""]


def test_personal_data_base(make, spark, texts):
    for r in queries.op8_pii(spark, SF).collect():
        base = ",".join(x for x in r.spans.split(",") if not x.startswith("iban"))
        assert base == base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and r.n_email == base.count("email")
    got = pii.with_spans(make([(i, t, None, None) for i, t in enumerate(TRICKY)])).select("doc_id", pii.listed(F.col("spans")).alias("s")).collect()
    assert {r.doc_id: r.s for r in got} == {i: base_spans(t) for i, t in enumerate(TRICKY)}


def test_iban_and_redaction(make, odd):
    docs = make([(1, "my iban DE89 3704 0044 0532 0130 00 ok", None, None), (2, "no DE88370400440532013000", None, None), (3, "to a@b.co, or 10.0.0.1!", None, None)])
    got = {r["doc_id"]: r["text"] for r in rows(pii.redact(docs))}
    assert got == {1: "my iban [IBAN] ok", 2: "no DE88370400440532013000", 3: "to [EMAIL], or [IP]!"}
    assert pii.redact(docs).columns == docs.columns and pii.redact(odd).count() == 10 and pii.redact(make([])).count() == 0
    assert sorted(map(str, (r["n_chars"] for r in rows(pii.redact(odd))))) == sorted(map(str, (r["n_chars"] for r in rows(odd))))


# 9 top-k
def test_topk(spark):
    v = table(spark, SF, "embeddings").toPandas()
    m = np.floor(64 * np.array(v.embedding.tolist(), float))
    want = {(int(q), k + 1, int(j), int(s)) for i, q in enumerate(v.vec_id) if q % 20 == 0
            for k, (s, j) in enumerate(sorted(((-(m[n] @ m[i]), j) for n, j in enumerate(v.vec_id) if j != q))[:20]) for s in [-s]}
    assert {tuple(r) for r in queries.op9_exact_topk(spark, SF).collect()} == want


def test_topk_pruning_and_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = np.sort(np.abs(rng.normal(0, 1, (3000, 16)) * 3.0 ** -np.arange(16)))[::-1]
    x = np.floor(64 * x)
    ids, best = topk.max_score(x[::20], np.arange(0, 3000, 20), x, np.arange(3000), 20)
    for r, q in enumerate(range(0, 3000, 20)):
        order = sorted(((-(x[j] @ x[q]), j) for j in range(3000) if j != q))[:20]
        assert [(s, j) for s, j in zip(-best[r], ids[r], strict=True)] == order
    monkeypatch.setattr(topk, "SHARD_ROWS", 3)
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(20, [1.0, 0.5], 1), (20, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [1.0, 0.5], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1),
                                (5, None, 1), (None, [1.0, 1.0], 1), (6, [None, 1.0], 1), (7, [1.0], 1)], "vec_id long, embedding array<double>, rank int")
    got = sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(20, 1, 1, 5120), (20, 2, 2, 5120), (20, 3, 7, 4096)]
    assert topk.search(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    # an id with several vectors counts with the smallest, in whatever order the rows come
    several = [(20, [1.0, 1.0], 1), (1, [1.0, 0.0], 1), (1, [9.0, 0.0], 1), (1, [1.0, 2.0], 1), (2, [0.5], 1)]
    for order in (several, several[::-1]):
        df = spark.createDataFrame(order, "vec_id long, embedding array<double>, rank int")
        assert sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 20 == 0).collect()) == [(20, 1, 1, 4096), (20, 2, 2, 2048)]


# 10 mixing
def water_fill(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left, w = total - sum(3 * sizes[s] for s in capped), sum(weight[s] for s in names if s not in capped)
        target = {s: 3.0 * sizes[s] if s in capped else left * weight[s] / w for s in names}
        over = {s for s in names if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mixing(spark, texts):
    docs = {r.doc_id: r.source for r in table(spark, SF, "documents").collect()}
    sizes, longest = Counter(), Counter()
    for i, s in docs.items():
        n = len(SPLIT.findall(texts[i]))
        sizes[s] += n
        longest[s] = max(longest[s], n)
    target, got = water_fill(sizes), queries.op10_source_mixing(spark, SF).collect()
    taken = Counter()
    for r in got:
        s = docs[r.doc_id]
        assert r.size == len(SPLIT.findall(texts[r.doc_id])) and r.source_size == sizes[s] and r.target == pytest.approx(target[s])
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[s] += r.taken
    assert len(got) == len(docs) and sum(taken.values()) <= sum(sizes.values())
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in sizes)
    assert sorted(map(tuple, got)) == sorted(map(tuple, queries.op10_source_mixing(spark, SF).collect()))


def test_mixing_caps_small_sources_and_odd_rows(spark, make, odd):
    docs = make([(1, "a " * 10, None, "a"), (2, "b " * 1000, None, "b"), (3, "c " * 1000, None, None)])
    got = {r["doc_id"]: r for r in rows(mixing.plan(docs))}
    assert got[1]["target"] == 30 and got[1]["taken"] == 30
    assert {i: got[i]["target"] for i in (2, 3)} == {2: pytest.approx(1980 * 2 / 3), 3: pytest.approx(1980 / 3)}
    assert mixing.plan(odd).count() == 10 and mixing.mix(odd).columns == odd.columns
    assert mixing.mix(odd).groupBy().agg(F.sum(F.size(F.split("text", " ")))).collect()[0][0] <= 3 * 60_100
    assert mixing.plan(make([])).count() == 0 and mixing.mix(make([])).count() == 0


def test_components_of_chains_stars_and_repeated_links(spark):
    chain = [(i, i + 1) for i in range(100, 130)]
    shuffled = [((i * 7) % 31 + 200, (i * 7 + 7) % 31 + 200) for i in range(30)]  # a chain in no order of its ids
    links = chain + shuffled + [(300, i) for i in range(301, 340)] + [(5, 9), (9, 5), (5, 9)]
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["id"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for pair in links for x in pair}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_operators_take_rows_that_stopped_them_before(spark, make):
    # a long run of white space before a word: the ids are those that a shorter run shows to be right
    long = packing.encode(" " * 1_000_000 + "a\n" + "\t" * 5000 + "b " + packing.MARK)
    assert packing.tokenizer().decode(long.tolist()) == " " * 1_000_000 + "a\n" + "\t" * 5000 + "b " + packing.MARK
    for text in (" " * 5000 + "word", "x" + "\n" * 5000 + "  y", " " * 5000, " " * 5000 + packing.MARK, "\u00a0" * 4500 + "\x1cz"):
        assert packing.encode(text).tolist() == packing.tokenizer().encode(text, allowed_special="all")
    assert packing.pieces(make([(1, " " * 1_000_000 + "a", None, None)])).count() > 0
    # a source without words has a target of 0 and takes nothing
    got = {r["doc_id"]: r for r in rows(mixing.plan(make([(1, None, None, "a"), (2, "", None, "a"), (3, "b b", None, "b")])))}
    assert got[1]["target"] == 0 and got[1]["taken"] == 0 and got[1]["finish"] is None and got[3]["taken"] == 2
    # columns of any name
    clash = spark.createDataFrame([(1, "write to a.b@cc.de now", 9, "x", "y", "z")], "doc_id long, text string, n_chars int, _f_email string, spans string, `_spans` string")
    out = pii.redact(clash)
    assert out.columns == clash.columns and tuple(out.first()) == (1, "write to [EMAIL] now", 20, "x", "y", "z")
    # one id with two texts
    both = make([(1, "a b c d e f", None, None), (1, "g h i j k l", None, None), (1, "g h i j k l", None, None), (2, "a b c d e f", None, None)])
    assert sorted(r["text"] for r in rows(neardup.without_duplicates(both)) if r["doc_id"] == 1) == ["a b c d e f", "g h i j k l"]


def test_personal_data_context_raises_the_score(make):
    docs = make([(1, "please call +1 (980) 555-6268 or +1 (980) 555-6269", None, None), (2, "x 10.0.0.1, the host is 10.0.0.2", None, None)])
    got = {r.doc_id: r.s for r in pii.with_spans(docs).select("doc_id", pii.scores(F.col("spans")).alias("s")).collect()}
    assert got == {1: "90,60", 2: "60,90"}


def redacted(text):
    at, out = 0, ""
    for start, _, end, kind in sorted((int(a), pii.BASE.index(k), int(b), k) for k, a, b in (x.split(":") for x in base_spans(text).split(",") if x)):
        if start >= at:
            out += text[at:start] + f"[{kind.upper()}]"
        at = max(at, end)
    return out + text[at:]


def test_redaction_of_many_spans_and_long_texts(make):
    many = " ".join(f"user{i}@mail{i}.org" for i in range(20_000))
    overlaps = " ".join(f"1.2.3.4@x{i}.org 1.2.3.{i % 300}.5 4111111111111111 é😀" for i in range(900))
    far = "é😀" * 9000 + " a@b.co " + "z" * 8191 + "\n\n 10.0.0.1"
    texts = [*TRICKY, many, overlaps, far, "a" * 4096, "a" * 4090 + " a@b.co", ""]
    got = {r["doc_id"]: r["text"] for r in rows(pii.redact(make([(i, t, None, None) for i, t in enumerate(texts)])))}
    assert got == {i: redacted(t) for i, t in enumerate(texts)}
    clash = make([(1, "a@b.co", None, None)]).withColumnRenamed("words", "_f_email").withColumnRenamed("rank", "_s_ip")
    out = pii.with_spans(clash)
    assert out.columns == [*clash.columns, "spans"] and out.first()["_f_email"] == ["x"]


def test_common_words_of_a_style_mark_no_text(spark):
    """Twenty words that come together, a little commoner in toxic documents, do not add up to a verdict."""
    import random
    from dossier.llm import toxicity
    rng = random.Random(5)
    name = lambda n: "".join(chr(97 + n // 26 ** i % 26) + "aeiou"[n // 5 ** i % 5] for i in range(4))
    style, other = [name(n) for n in range(20)], [name(n) for n in range(1000, 3000)]
    rows, marks = [], []
    for i in range(1600):
        toxic, words = i % 2, rng.sample(other, 15)
        if rng.random() < (0.6 if toxic else 0.4):
            words += style
        if toxic and rng.random() < 0.95:
            words.append("moron")
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        marks.append((i, toxic))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    found = {r["doc_id"] for r in toxicity.score(docs, labels).where("predicted = 1").collect()}
    assert not [i for i in found if i % 2 == 0] and len(found) >= 700
