"""Phrases, source divergence and MinHash against brute force."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from civicspark.llm import divergence, minhash, phrases


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_phrases(rows, least=10, inside=50, top=2000):
    counts, total, out = defaultdict(Counter), Counter(), []
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in (1, 2, 3):
                counts[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, f in counts.items():
        found = []
        longer = [p for p, a in f.items() if len(p) == 3 and a >= least]
        for p, a in f.items():
            if len(p) < 2 or a < least or len(p) == 2 and any(p in (q[:2], q[1:]) and 100 * f[q] >= inside * a for q in longer):
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(found)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def phrase_rows():
    rng = random.Random(11)
    vocabulary = ["new", "york", "City", "of", "the", "é", "ß-x", "(a", "b)", "naïve", "Ω"]
    sentence = lambda: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n"]) for _ in range(40))
    rows = [(i, sentence(), [None, "und", "en", "EN", "a b"][i % 5], "s") for i in range(60)]
    return [*rows, *rows[:5], (None, None, "en", None), (1, "", None, None), (2, "New York " * 400, "fr", None)]


def test_phrases_match_brute_force(spark, phrase_rows):
    df = spark.createDataFrame(phrase_rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 AS n", "2 AS word", "3 as a")
    assert sorted(tuple(r) for r in phrases.collocations(df).collect()) == brute_phrases(phrase_rows)
    assert sorted(tuple(r) for r in phrases.collocations(df, top=7, least=15).collect()) == brute_phrases(phrase_rows, 15, top=7)


@pytest.mark.parametrize("narrow", [True, False])
def test_phrases_of_large_vocabularies(spark, phrase_rows, monkeypatch, narrow):
    """A vocabulary that is joined to shards of the texts, with ids that are packed into two numbers, and small tables."""
    monkeypatch.setattr(phrases, "_WORDS", 0)
    monkeypatch.setattr(phrases, "_SHARD", 2000)
    monkeypatch.setattr(phrases, "_GATHERED", 50)
    monkeypatch.setattr(phrases, "_SLICE", 20)
    monkeypatch.setattr(phrases, "_TABLE", 8)
    monkeypatch.setattr(phrases, "_NARROW", 21 if narrow else 1)
    df = spark.createDataFrame(phrase_rows, "doc_id long, text string, lang string, source string")
    assert sorted(tuple(r) for r in phrases.collocations(df).collect()) == brute_phrases(phrase_rows)


def test_tables_of_a_task_are_added_up():
    """What stays below half a table is kept and added to what comes."""
    kind = pa.large_string()
    one = lambda n: pa.table({"lang": pa.array(["x"], kind), "word": pa.array(["w"], kind), "n": pa.array([n])})
    assert phrases._added([phrases._added([one(1), one(2)]), one(3)]).to_pylist() == [{"lang": "x", "word": "w", "n": 6}]
    two = lambda n: pa.table({**{c: pa.array([c], kind) for c in ("lang", "source", "term")}, "n": pa.array([n]), "docs": pa.array([1])})
    assert divergence._added([divergence._added([two(1), two(2)]), two(3)]).select(["n", "docs"]).to_pylist() == [{"n": 6, "docs": 3}]


def test_phrases_of_nothing(no_docs, spark):
    assert phrases.collocations(no_docs).collect() == []
    assert phrases.collocations(spark.createDataFrame([("a b c", "en")], "text string, lang string")).collect() == []


@pytest.mark.parametrize("bits", [1, 2, 7, 20, 21, 22, 32])
def test_filters_are_lossless(bits):
    rng = np.random.default_rng(bits)
    layout = phrases.Layout(bits, min(3, 3 * bits - 1))
    ids = [rng.integers(0, 1 << bits, 500) for _ in range(3)]
    keys = phrases.pack(ids, layout)
    assert [x.tolist() for x in phrases.unpack(keys, layout)] == [x.tolist() for x in ids]
    runs = [([k[i::2] for k in keys], rng.integers(1, 3000, len(keys[0][i::2]))) for i in range(2)]
    want = Counter()
    for part, counts in runs:
        for k, c in zip(zip(*(p.tolist() for p in part), strict=True), counts.tolist(), strict=True):
            want[k] += c
    merged, counts = phrases.merge([phrases.merge([r]) for r in runs])
    back, held = phrases.decode(phrases.encode(merged, counts, layout.width), layout.width, layout.wide)
    assert dict(zip(zip(*(p.tolist() for p in back), strict=True), held.tolist(), strict=True)) == want
    assert all(a < b for a, b in itertools.pairwise(zip(*(p.tolist() for p in back), strict=True)))


def test_a_filter_is_small():
    """A thousand n-grams of three 16-bit ids: 40 bits of remainder, 2 of run lengths and 8 of counter each."""
    rng = np.random.default_rng(1)
    keys = np.sort(np.unique(rng.integers(0, 1 << 48, 1024).astype(np.uint64)))
    held = phrases.encode([keys], np.ones(len(keys), np.int64), 48)
    assert sum(len(x) for x in held.values() if isinstance(x, bytes)) <= 6.3 * len(keys)


def brute_audit(rows, min_docs=3, top=200):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in seen.items() if n >= min_docs}
        count = {s: Counter() for s in {d[1] for d in mine}}
        for _, s, w in mine:
            count[s].update(t for t in w if t in kept)
        whole = sum(count.values(), Counter())
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for s, c in count.items()}
        q = {t: 1 + 10**9 * (whole[t] + 1) // (sum(whole.values()) + len(kept)) for t in kept}
        f = lambda x, y: (x - y) ** 2 // y
        for s in count:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in count if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode()) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                out += [(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(sorted(found)[:most])]
    return sorted(out)


def test_divergence_matches_brute_force(fixture_docs, fixture_rows, monkeypatch):
    got = sorted(tuple(r) for r in divergence.audit(fixture_docs.withColumnRenamed("n", "value")).collect())
    assert got == brute_audit(fixture_rows)
    monkeypatch.setattr(divergence, "_TABLE", 20)
    monkeypatch.setattr(divergence, "_BLOCK", 8)  # many blocks, tables that are sent off early
    assert sorted(tuple(r) for r in divergence.audit(fixture_docs, min_docs=2, top=5).collect()) == brute_audit(fixture_rows, 2, 5)


def test_divergence_of_large_counts(spark):
    """Sources of very different sizes, a group without terms, a language that keeps none, one with a single source."""
    rows = [(i, "Ab cd " * n, "x", s) for i, (n, s) in enumerate([(20000, "a"), (1, "b"), (3, "b"), (0, "c"), (1, None), (1, "")])]
    rows += [(9, "zz yy", "y", "a"), (10, "zz", "y", "b"), (11, "q q", "z", "a"), (12, "q", "z", "a"), (13, "q", "z", "a"), (14, None, None, None)]
    got = divergence.audit(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    assert sorted(tuple(r) for r in got.collect()) == brute_audit(rows)


def test_runs_are_intersected():
    counts = np.array([[0, 0, 3, 3, 0], [1, 0, 0, 0, 0]])
    terms = np.array([5, 1, 2, 1, 4])
    a, b = (divergence.run_lengths(c, terms) for c in counts)
    assert [x.tolist() for x in a] == [[0, 6, 9], [0, 3, 0]]
    x, y, length = divergence.intersect(a, b, 13)
    assert list(zip(x, y, length, strict=True)) == [(0, 1, 5), (0, 0, 1), (3, 0, 3), (0, 0, 4)]


def test_divergence_of_nothing(no_docs):
    assert divergence.audit(no_docs).collect() == []


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()


def brute_copies(rows, words=4, percent=80):
    sets = [shingles(r[1], words) for r in rows]
    comp = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and comp[i] != comp[j]:
            old, new = comp[i], comp[j]
            comp = [new if c == old else c for c in comp]
    least = {c: min((r[0] for r, d in zip(rows, comp, strict=True) if d == c and r[0] is not None), default=None) for c in set(comp)}
    out = [(r[0], len(s), least[c] if s else r[0]) for r, s, c in zip(rows, sets, comp, strict=True)]
    return sorted(((*x, x[0] == x[2]) for x in out), key=repr)


def copies(df, **options):
    return sorted((tuple(r) for r in minhash.near_copies(df, **options).collect()), key=repr)


def test_near_copies_match_brute_force(fixture_docs, fixture_rows, spark):
    assert copies(fixture_docs) == brute_copies(fixture_rows)
    rows = [(None, "a b c d e", 1), (None, "A b c d e", 2), (None, None, 3), (7, "x y", 4), (None, "x y", 5), (7, "z", 6)]
    assert copies(spark.createDataFrame(rows, "doc_id long, text string, n int")) == brute_copies(rows)


def test_near_copies_of_chains_and_near_misses(spark, words, monkeypatch):
    """Chains of edits, a group around the threshold that is compared in blocks, and texts that share a line."""
    monkeypatch.setattr(minhash, "_FEW", 2)
    monkeypatch.setattr(minhash, "_BLOCK", 8)
    monkeypatch.setattr(minhash, "_ROUNDS", 1)
    rng = np.random.default_rng(4)
    base, chain = rng.choice(words, 90).tolist(), rng.choice(words, 120).tolist()
    rows = [(i, " ".join(str(rng.choice(words)) if rng.random() < 0.03 else w for w in base)) for i in range(70)]
    for i in range(20):
        chain[(i * 5) % 120] = f"edit{i}"
        rows.append((200 + i, " ".join(chain)))
    rows += [(300 + i, f"{' '.join(base[:30])} {' '.join(rng.choice(words, 10))}") for i in range(30)]
    assert copies(spark.createDataFrame(rows, "doc_id long, text string")) == brute_copies(rows)


def test_near_copies_of_nothing(no_docs):
    assert minhash.near_copies(no_docs).collect() == []


def test_batches_give_up_by_the_posterior():
    """Pairs at the threshold pass, clearly different ones go after few batches, by plain integration of the posterior."""
    least = minhash.least_agreements(80)
    grid = np.linspace(1 / 256, 1, 200001)
    for i, m in enumerate(least):
        k = (i + 1) * minhash.BATCH
        for agreements, kept in ((m, True), (m - 1, False)):
            if agreements >= 0:
                density = np.exp(agreements * np.log(grid) + (k - agreements) * np.log1p(-grid.clip(max=1 - 1e-12)))
                assert (density[grid >= 0.8 + 0.2 / 256].sum() / density.sum() >= minhash.MISS * (1 if kept else 0.999)) == kept
    rng = np.random.default_rng(5)
    a = rng.integers(0, 256, (3000, 128), dtype=np.uint8)
    at = lambda s: np.where(rng.random(a.shape) < s, a, rng.integers(0, 256, a.shape, dtype=np.uint8))
    assert len(minhash.survive(a, at(0.8), least)) == 3000
    assert len(minhash.survive(a, at(0.3), least)) < 3
    assert len(minhash.survive(a, at(0.3), least[:2])) < 600  # two batches leave about 15 %


def test_signatures_agree_as_sets_overlap():
    rng = np.random.default_rng(6)
    pool = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    a, b = np.sort(pool[:900]), np.sort(pool[100:])  # similarity 0.8
    signed = minhash.signatures(np.concatenate([a, b]), np.array([0, 900, 1800]), 4096)
    assert abs((signed[0] == signed[1]).mean() - 0.8) < 0.03


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(8)
    pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    for shared in (399, 350, 200, 0):
        a, b = np.sort(pool[: (400 + shared) // 2]), np.sort(pool[(400 - shared) // 2 :])
        bits = minhash.bitmaps(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        differ = int(np.unpackbits(bits[0] ^ bits[1]).sum())
        assert differ <= len(set(a.tolist()) ^ set(b.tolist())) and (shared == 399 or differ > 0.7 * len(set(a.tolist()) ^ set(b.tolist())))
