"""Document operators against brute force, on small tables with every odd case."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from civicspark.llm import digests, kernels, language, mixing, ngram_join, passages, queries, sentencepieces, toxicity

SF_SMALL = "/root/testdata/sf0.001"

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def sets(rows):
    out = []
    for key, text, *_ in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
        out.append((key, frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()))
    return out


def linked(found):
    parent = list(range(len(found)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(found):
        for j in range(i):
            b = found[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[top(i)] = top(j)
    least = defaultdict(lambda: 1 << 60)
    for i, (key, _) in enumerate(found):
        least[top(i)] = min(least[top(i)], key)
    return sorted((key, len(s), least[top(i)]) for i, (key, s) in enumerate(found))


def test_ngram_join_matches_brute_force(fixture_docs, fixture_rows):
    got = sorted(tuple(r) for r in ngram_join.join(fixture_docs).collect())
    assert got == linked(sets(fixture_rows))


def test_ngram_join_of_a_large_near_group(spark, words):
    """Copies that differ from each other more than from their base, beside texts that share a common line."""
    rng = np.random.default_rng(3)
    base = rng.choice(words, 80).tolist()
    rows = [(i, " ".join(str(rng.choice(words)) if rng.random() < 0.02 else w for w in base)) for i in range(60)]
    line = " ".join(base[:10])
    rows += [(100 + i, f"{line} {' '.join(rng.choice(words, 30))} {line}") for i in range(40)]
    got = sorted(tuple(r) for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == linked(sets(rows))


@pytest.mark.parametrize("fragments", [1, 3])
def test_ngram_join_with_common_shingles(fixture_docs, fixture_rows, monkeypatch, fragments):
    """Shingles that take the way of common ones, and other cuts of the order, don't change the result."""
    monkeypatch.setattr(ngram_join, "_SAMPLE", 1)
    monkeypatch.setattr(ngram_join, "_COMMON", 3)
    assert len(ngram_join._common(fixture_docs, "text", 5)) > 20
    got = sorted(tuple(r) for r in ngram_join.join(fixture_docs, fragments=fragments).collect())
    assert got == linked(sets(fixture_rows))


def test_ngram_join_of_a_shingle_in_many_nodes(spark, words, monkeypatch):
    """A rare shingle of many texts that don't link: its pairs are sought in blocks of bounded size."""
    seen = []
    real = ngram_join._met
    monkeypatch.setattr(ngram_join, "_met", lambda rows, percent: seen.append(rows.count()) or real(rows, percent))
    monkeypatch.setattr(ngram_join, "_FEW", 4)
    monkeypatch.setattr(ngram_join, "_BLOCK", 50)
    monkeypatch.setattr(ngram_join, "_ROUNDS", 1)
    monkeypatch.setattr(ngram_join, "_CENTRES", 1)
    rng = np.random.default_rng(9)
    base = rng.choice(words, 24).tolist()
    # about half of each text is common, so that pairs are candidates but few link
    rows = [(i, " ".join(base[:14] + [str(rng.choice(words)) if rng.random() < 0.25 else w for w in base[14:]])) for i in range(300)]
    got = sorted(tuple(r) for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == linked(sets(rows)) and seen[0] > 100


def test_blocks_of_a_shingle_are_bounded(spark):
    """5,000 nodes of one shingle: each group holds two parts of about a thousand."""
    kind = "shingle long, node long, n int, comp long, place int, bitmap array<long>, alone int"
    rows = spark.range(5000).selectExpr("7L AS shingle", "id AS node", "40 AS n", "id AS comp", "0 AS place", "array_repeat(id * 7919 * 104729, 8) AS bitmap", "0 AS alone")
    groups = rows.to(spark.createDataFrame([], kind).schema)
    found = ngram_join._met(groups, 75)
    assert found.where("a >= b").isEmpty()
    tiles = {r["count"] for r in groups.withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(5))).groupBy("part").count().collect()}
    assert max(tiles) < 1200


def test_ngram_join_hashes_small_slices(words):
    import tracemalloc

    rng = random.Random(3)
    column = pa.array([" ".join(rng.choice(words) for _ in range(300)) for _ in range(1500)])
    tracemalloc.start()
    found = sum(len(values) for _, _, values, _ in ngram_join._sets(column, 5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found > 400_000 and peak < 24e6, peak  # slices of a megabyte took more


def test_ngram_join_empty(no_docs):
    assert ngram_join.join(no_docs).collect() == []


def first_places(rows, length):
    first = {}
    for key, text, *_ in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            first[data[i : i + length]] = min(key, first.get(data[i : i + length], key))
    return first


def cut(rows, length=50):
    first, out = first_places(rows, length), []
    for key, text, *_ in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < key:
                gone[i : i + length] = b"\1" * length
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        out.append((key, len(data), spans, bytes(b for b, g in zip(data, gone, strict=True) if not g)))
    return sorted(out)


def test_passages_match_brute_force(fixture_docs, fixture_rows):
    got = sorted(
        (r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in passages.remove_repeats(fixture_docs).collect()
    )
    assert got == cut(fixture_rows)


def test_passages_of_few_symbols(spark):
    """Periodic and tightly repeated texts, and a shorter length."""
    rng = np.random.default_rng(2)
    rows = [
        (i, "".join(rng.choice(["a", "b"], rng.integers(0, 80)))) for i in range(30)
    ] + [(40, "ab" * 60), (41, "ab" * 80), (42, "a" * 200), (43, "a" * 90)]
    got = sorted(
        (r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept))
        for r in passages.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=12, gram=5).collect()
    )
    assert got == cut(rows, 12)


def test_passages_decode_and_carry(spark):
    rows = [(1, "é" * 40, "s"), (2, "x" + "é" * 40 + "y", "t"), (3, None, None)]
    got = {
        r.doc_id: (r.source, r.kept)
        for r in passages.remove_repeats(
            spark.createDataFrame(rows, "doc_id long, text string, source string"), carry=("source",), decode=True
        ).collect()
    }
    assert got == {1: ("s", "é" * 40), 2: ("t", "xy"), 3: (None, "")}


def test_passages_of_other_keys_and_nested_columns(spark):
    """Keys of text, and a carried struct with members that are never null."""
    rows = [("b", "x" * 60), ("a", "y" + "x" * 60), ("c", "z" * 60), (None, "z" * 55)]
    docs = spark.createDataFrame(rows, "id string, text string").withColumn("more", F.struct(F.lit(7).alias("n"), F.array(F.lit("k")).alias("list")))
    got = {r.id: (r.more.n, r.more.list, bytes(r.kept)) for r in passages.remove_repeats(docs, key="id", carry=("more",)).collect()}
    assert got == {"a": (7, ["k"], b"y" + b"x" * 60), "b": (7, ["k"], b""), "c": (7, ["k"], b"z" * 60), None: (7, ["k"], b"")}


def test_passages_empty(no_docs):
    assert passages.remove_repeats(no_docs).collect() == []


def test_repeats_where_common_grams_are_split(fixture_docs, monkeypatch):
    """Grams that few buckets hold are cut by context too: the result is the same."""
    want = sorted((r.doc_id, r.n_bytes, str(r.spans)) for r in passages.remove_repeats(fixture_docs).collect())
    monkeypatch.setattr(passages, "_COMMON", 2)
    assert sorted((r.doc_id, r.n_bytes, str(r.spans)) for r in passages.remove_repeats(fixture_docs).collect()) == want


def test_repeats_where_all_hashes_are_equal(fixture_docs, monkeypatch):
    """Equal hashes of stretches decide nothing."""
    want = sorted((r.doc_id, r.n_bytes, str(r.spans)) for r in passages.remove_repeats(fixture_docs).collect())
    monkeypatch.setattr(passages, "_content", lambda data, places, sizes: np.zeros(len(places), np.uint64))
    assert sorted((r.doc_id, r.n_bytes, str(r.spans)) for r in passages.remove_repeats(fixture_docs).collect()) == want


def test_contexts_of_a_common_gram_part():
    """Ten thousand contexts of one phrase don't make one group."""
    rng = random.Random(4)
    text = lambda n=60: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    phrase = min((text(20) for _ in range(20_000)), key=lambda x: int(passages.gram_hashes(np.frombuffer(x.encode(), np.uint8), 20)[0]))
    data, offsets = kernels.utf8(pa.array([text() + phrase + text() for _ in range(10_000)]))
    grams, _, places, counts = passages.stretches(data, offsets, 50, 20)
    common = grams == Counter(grams.tolist()).most_common(1)[0][0]
    assert common.sum() >= 5000
    strings = lambda places, counts: Counter(
        bytes(data[p + i : p + i + 50]) for p, n in zip(places, counts, strict=True) for i in range(n)
    )
    keys, of, at, n = passages.by_context(data, grams[common], places[common], counts[common], 50, 20)
    assert strings(at, n) == strings(places[common], counts[common])
    assert Counter(keys.tolist()).most_common(1)[0][1] < 0.05 * common.sum()
    # equal strings have equal keys
    doubled = np.concatenate([grams[common]] * 2), np.concatenate([places[common]] * 2), np.concatenate([counts[common]] * 2)
    again = passages.by_context(data, *doubled, 50, 20)[0]
    assert again.tolist() == keys.tolist() * 2


def test_common_prefixes_come_out_exactly():
    rng = np.random.default_rng(1)
    for length in (2, 7, 20):
        text = rng.integers(97, 100, 300).astype(np.uint8)
        text[150:190] = text[:40]
        order, shared = passages.common_prefixes(text, length)
        data = text.tobytes() + b"\0"
        assert [data[i : i + length] for i in order] == sorted(data[i : i + length] for i in range(len(data)))
        for k in range(1, len(order)):
            a, b = data[order[k - 1] :], data[order[k] :]
            same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert shared[k] == min(same, length)


def test_long_suffix_order_agrees():
    codes = np.concatenate([np.random.default_rng(4).integers(1, 4, 500), [0]])
    short = passages.suffix_order(codes, 40)
    key = np.zeros(len(codes), np.uint64)
    padded = np.concatenate([codes, np.zeros(8, int)]).astype(np.uint64)
    for i in range(8):
        key = key << np.uint64(2) | padded[i : i + len(codes)]
    assert short.tolist() == passages._long_order(key, 8, 40).tolist()


def test_sentencepiece_is_the_library(fixture_docs, fixture_rows):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    extra = [(9001, "  lead"), (9002, "trail "), (9003, "a▁b▁▁"), (9004, "x\u0000y\t\n"), (9005, "日本語 😀 ﬁ")]
    docs = fixture_docs.select("doc_id", "text", "ids").union(
        fixture_docs.sparkSession.createDataFrame(extra, "doc_id long, text string").withColumn("ids", F.lit("k"))
    )
    got = sorted((r.doc_id, r.ids, r.decoded) for r in sentencepieces.encode_decode(docs, MODEL, table_chunks=50, rows_at_once=7).collect())
    want = sorted((k, ids := model.encode(t or ""), model.decode(ids)) for k, t, *_ in [*fixture_rows, *extra])
    assert got == want


def test_sentencepiece_empty(no_docs):
    assert sentencepieces.encode_decode(no_docs, MODEL).collect() == []


def test_mix_targets_and_limits(fixture_docs, fixture_rows):
    mix = mixing.mix(fixture_docs)
    got = mix.documents.collect()
    sizes = sorted((k, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for k, t, *_ in fixture_rows)
    assert sorted((r.doc_id, r["size"]) for r in got) == sizes
    assert all(r.taken <= 2 * r["size"] for r in got)
    assert sum(r["size"] for r in got) * 1.5 == pytest.approx(
        sum({(r.source_size, r.target) for r in got} and {r.target: r.target for r in got}.values()), rel=1e-6
    )
    source = Counter()
    total = Counter()
    for k, t, _, s in fixture_rows:
        total[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by_target = defaultdict(int)
    for r in got:
        by_target[r.target, r.source_size] += r.taken
    assert sorted(size for _, size in by_target) == sorted(total.values())
    assert all(abs(taken - target) <= 0.01 * target + 3 for (target, _), taken in by_target.items()), source
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(fixture_docs.repartition(5)).documents.collect()))


def test_mix_schedule_covers_what_is_taken(fixture_docs):
    mix = mixing.mix(fixture_docs, block_words=16, least_slots=10)
    planned = {r.doc_id: r.w for r in mix.schedule.groupBy("doc_id").agg(F.sum("words").alias("w")).collect()}
    taken = {r.doc_id: r.t for r in mix.documents.groupBy("doc_id").agg(F.sum("taken").alias("t")).where("t > 0").collect()}
    assert planned == taken
    slots = mix.schedule.select("slot", "source", "block").distinct()
    assert slots.count() == slots.select("slot").distinct().count()


def test_mix_small_sources_beside_a_large_one(spark):
    """Blocks of one size, against sources of less than one and of a few."""
    small = [("s%d" % i, 1 + n // 7, n) for i, n in enumerate((1, 40, 300, 700, 3000, 9000))] + [(None, 9, 400)]
    rows = [(1000 * i + k, s, " w" * (n // parts + (k < n % parts))) for i, (s, parts, n) in enumerate(small) for k in range(parts)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").union(
        spark.range(1000).selectExpr("id + 100000", "'large'", "repeat(' w', 1500)")
    )
    mix = mixing.mix(docs, share=0.5, block_words=64, least_slots=10)
    got = mix.documents.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert sorted(r.source_size for r in got) == sorted([1_500_000, *[n for _, _, n in small]])
    assert all(abs(r.taken - r.target) <= 0.5 for r in got), got
    blocks = mix.schedule.groupBy("source", "block").agg(F.sum("words").alias("n"), F.count_distinct("slot").alias("slots"))
    last = blocks.groupBy("source").agg(F.max("block").alias("last"))
    assert blocks.where("slots > 1").isEmpty() and blocks.join(last, "source").where("block < last AND n <> 64").isEmpty()
    # each source is spread over the mix: half of its words are in the slots up to half of its last one
    ends = mix.schedule.groupBy("source").agg(F.max("slot").alias("end"), F.sum("words").alias("n"))
    for r in mix.schedule.join(ends, "source").groupBy("source", "n").agg(F.sum(F.when(F.col("slot") * 2 <= F.col("end"), F.col("words"))).alias("half")).collect():
        assert r.n < 1000 or abs(r.half / r.n - 0.5) < 0.03 + 128 / r.n, r


def plain_mixture(docs, rows, golden=None):
    """Targets, the slots of each source, and what these take of each document, by their definitions."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    place = {(r.doc_id, r.text): r.p for r in docs.select("doc_id", "text", F.xxhash64(F.lit(42), "doc_id").alias("p")).collect()}
    tie = {r.text: r.t for r in docs.select("text", F.xxhash64("text").alias("t")).collect()}
    by_source = defaultdict(list)
    for k, t, _, s in rows:
        by_source[s].append((place[k, t] % (1 << 64), k, tie[t], size(t), t))
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(x[3] for x in by_source[s]) for s in names}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(names)
    while open_:
        part = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if part[s] > 2 * sizes[s]}
        for s in over or open_:
            target[s] = 2.0 * sizes[s] if over else part[s]
        left, open_ = left - sum(target[s] for s in over), open_ - over if over else set()
    goals = {s: min(int(target[s] + 0.5), 2 * sizes[s]) for s in names}
    block = max(1, min(4096, int(sum(target.values()) // 20000)))
    blocks = {s: -(-goals[s] // block) for s in names}
    total, edge, edges = sum(blocks.values()), 0, []
    for s in names:
        edge += blocks[s]
        edges.append(edge / total)
    slots = defaultdict(list)
    for j in range(2 * total + 2):
        u = j * (golden or mixing._GOLDEN) % (1 << 53) / (1 << 53)
        s = names[next(i for i, e in enumerate(edges) if u < e)]
        if len(slots[s]) < blocks[s]:
            slots[s].append(j)
    out = []
    for s in names:
        at = 0
        for _, k, _, n, _ in sorted(by_source[s], key=lambda x: x[:3]):
            taken, first = 0, []
            for p in (0, 1):
                held = [w // block for w in range(at + p * sizes[s], min(at + p * sizes[s] + n, goals[s])) if w // block < len(slots[s])]
                taken += len(held)
                first += [slots[s][held[0]]] if held else []
            out.append((k, n, sizes[s], round(target[s], 6), taken, first))
            at += n
    return sorted(out)


@pytest.mark.parametrize("golden", [None, 1, 1 << 52])
def test_mix_matches_a_plain_version(fixture_docs, fixture_rows, monkeypatch, golden):
    """The schedule decides what is taken: with other points than those of the golden ratio sources miss their targets."""
    if golden:
        monkeypatch.setattr(mixing, "_GOLDEN", golden)
    got = mixing.mix(fixture_docs).documents.collect()
    found = sorted((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken, list(r.slots)) for r in got)
    assert found == plain_mixture(fixture_docs, fixture_rows, golden)
    taken = defaultdict(int)
    for _, _, n, target, t, _ in found:
        taken[n, target] += t
    assert all(abs(t - target) <= 0.5 for (_, target), t in taken.items()) == (golden is None)


def test_mix_starts_no_python_worker(fixture_docs):
    mixed = mixing.mix(fixture_docs.select("doc_id", "text", "source"))
    for table in (mixed.documents, mixed.schedule):
        assert "ExistingRDD" not in table._jdf.queryExecution().toString()


def test_targets_reshare_the_excess():
    found = mixing.targets([("b", 10), ("a", 1000), (None, 10)])
    assert [t.source for t in found] == ["a", "b", None]
    assert [t.target for t in found] == [1490.0, 20.0, 20.0]
    assert mixing.targets([]) == []
    assert mixing.targets([("a", 0)])[0].target == 0


def test_mix_empty(no_docs):
    mix = mixing.mix(no_docs)
    assert mix.documents.collect() == []
    assert mix.schedule.collect() == []


def test_language_is_learned(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/../sf0.01/documents.parquet")
    network = language.learn(docs, settings=language.Settings(epochs=4, docs_per_language=120))
    found = language.identify(docs, network).withColumn("held", language.held_out()).join(docs.select("doc_id", "lang"), "doc_id").where("held").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert found > 0.95


def test_language_of_odd_texts(fixture_docs, fixture_rows, no_docs):
    network = language.learn(fixture_docs, settings=language.Settings(epochs=1))
    assert network.languages == ["de", "en"]
    got = language.identify(fixture_docs, network, carry=("source", "text")).collect()
    assert sorted((r.doc_id, r.text, r.source) for r in got if r.text) == sorted((k, t, s) for k, t, _, s in fixture_rows if t)
    for r in got:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    again = language.identify(
        fixture_docs.repartition(3), language.learn(fixture_docs.repartition(2), settings=language.Settings(epochs=1))
    ).collect()
    assert sorted((r.doc_id, r.lang_pred, round(r.score, 6)) for r in got) == sorted(
        (r.doc_id, r.lang_pred, round(r.score, 6)) for r in again
    )
    assert language.identify(no_docs, network).collect() == []
    nothing = language.learn(no_docs)
    assert {r.lang_pred for r in language.identify(fixture_docs, nothing).collect()} == {"und"}


def plain_language(network, text):
    """The network's probabilities for a text, one window, place and filter after the other."""
    w, size = network.weights, network.settings.window
    folded = [c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in text.encode()]
    total, mass = np.zeros(len(network.languages)), 0
    for a in range(0, len(folded), size):
        window = (folded[a : a + size] + [32] * size)[:size]
        hidden = []
        for k in network.settings.widths:
            seen = [np.concatenate([w["emb"][c] for c in window[i : i + k]]) for i in range(size - k + 1)]
            hidden += [
                max(0.0, max(float(x @ w[f"conv{k}"][:, f]) for x in seen) + float(w[f"off{k}"][f]))
                for f in range(network.settings.filters)
            ]
        z = np.array(hidden) @ w["out"] + w["bias"]
        letters = sum(c != 32 for c in window)
        total += letters * np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        mass += letters
    return total / max(mass, 1e-12)


def test_language_matches_a_plain_forward_pass(fixture_docs, fixture_rows, spark):
    network = language.learn(fixture_docs, settings=language.Settings(epochs=2, filters=4))
    texts = [t for _, t, *_ in fixture_rows if t and any(c.isalpha() for c in t) and len(t) < 400][:25]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *texts[:3]])], "doc_id long, text string")
    for r in language.identify(docs, network, carry=("text",)).collect():
        found = plain_language(network, r.text)
        assert abs(found.max() - r.score) < 1e-4
        assert r.lang_pred == network.languages[int(found.argmax())] or np.ptp(found) < 1e-4


def test_long_texts_have_windows_of_their_own(spark, monkeypatch, fixture_docs):
    """What stands in the batch before a text doesn't change its score."""
    monkeypatch.setattr(language, "_PIECE", 1000)
    network = language.learn(fixture_docs, settings=language.Settings(epochs=1))
    long = "some words of one language and über another " * 60
    docs = spark.createDataFrame(
        [(0, "short one"), (1, long), (2, "x" * 37), (3, long), (4, long + "end")], "doc_id long, text string"
    ).coalesce(1)
    got = {r.doc_id: r.score for r in language.identify(docs, network).collect()}
    assert got[1] == got[3]
    assert abs(got[1] - plain_language(network, long).max()) < 1e-4


def test_entropy_classes():
    data = np.frombuffer(b"the quick brown fox jumps over the lazy dog aaaaaaaaaaaaaaaaaaaaaaaaa", np.uint8)
    for i, c in enumerate(digests.entropy_classes(data, 16)):
        n = np.array([*Counter(data[i : i + 16].tolist()).values()], float)
        assert abs(c - min(999, 1000 * (1 - (n * np.log2(n)).sum() / 64))) < 1.01


def test_fingerprints(fixture_docs, fixture_rows, no_docs):
    ranks = digests.rarity_ranks(digests.histogram(fixture_docs), 150)
    got = digests.neighbours(fixture_docs, ranks).collect()
    order = sorted(((k, t or "") for k, t, *_ in fixture_rows))
    following = [*order[1:], order[0]]
    want = sorted((k, len(t), digests.edited(t, f)) for (k, t), (_, f) in zip(order, following, strict=True))
    assert sorted((r.doc_id, r.n_chars, r.edited) for r in got) == want
    prints = {}
    digester = digests.Digester(ranks, digests.Settings())
    for r in got:
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
        assert 0 <= r.near_edited <= 1
        assert 0 <= r.near_next <= 1
    for k, t in order:
        [chain] = digester.many([t.encode()])
        assert digests.text_of(chain, digests.Settings()) in prints[k]
    long = [r for r in got if r.n_chars > 300]
    assert np.mean([r.near_edited for r in long]) > 0.6 > 0.3 > np.median([r.near_next for r in long])
    assert digests.neighbours(no_docs, ranks).collect() == []


M64 = (1 << 64) - 1


def plain_mix(h):
    h ^= h >> 31
    h = h * 0x7FB5D329728EA185 & M64
    h ^= h >> 27
    h = h * 0x81DADEF4BC2DD44D & M64
    return h ^ (h >> 33)


def plain_class(window):
    """The entropy class of some bytes, counted one by one."""
    gain = lambda c: round(c * math.log2(c) * 65536)
    left = gain(len(window)) - sum(gain(n) for n in Counter(window).values())
    return int(min(left * float(np.float32(1000 / gain(len(window)))), 999.0))


def plain_chain(text, ranks):
    """A digest by its definition: a chain of (set of bits, number of features)."""
    data = text.encode()
    if data and len(data) < 16:
        data += b" " * (16 - len(data))
    places = range(len(data) - 15)
    order = [(int(ranks[plain_class(data[i : i + 16])]), i) for i in places]
    runs = [order[i : i + 16] for i in range(len(order) - 15)] if len(order) >= 16 else [order] if order else []
    votes = Counter(min(run)[1] for run in runs if min(run)[0] < 1000)
    values = []
    for i in sorted(i for i, n in votes.items() if n >= min(4, max(1, len(runs)))):
        value = 0
        for k in (0, 8):
            value = plain_mix(value * 0x9E3779B97F4A7C15 + int.from_bytes(data[i + k : i + k + 8]) & M64)
        if value not in values:
            values.append(value)
    return [
        ({v >> 12 * k & 2047 for v in part for k in range(5)}, len(part))
        for part in (values[i : i + 160] for i in range(0, len(values), 160))
    ]


def plain_text(chain):
    rows = b"".join(bytes(sum(128 >> j for j in range(8) if 8 * i + j in bits) for i in range(256)) + bytes([n]) for bits, n in chain)
    return f"v1:16:{len(chain)}:" + base64.b64encode(rows).decode()


def plain_likeness(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    scores = []
    for bits, n in a:
        best = 0.0
        for other, m in b:
            chance = len(bits) * len(other) / 2048
            score = (len(bits & other) - chance) / max(min(len(bits), len(other)) - chance, 1e-9)
            best = max(best, min(1, max(0, score)) * min(1, 2 * min(n, m) / max(1, n, m)))
        scores.append((best, n))
    return sum(x * n for x, n in scores) / sum(n for _, n in scores)


def test_fingerprints_match_a_plain_version(fixture_docs, fixture_rows):
    texts = [(k, t or "") for k, t, *_ in fixture_rows if len(t or "") < 3000]
    docs = fixture_docs.where("length(coalesce(text, '')) < 3000")
    counts = Counter(plain_class(t.encode()[i : i + 16]) for _, t in texts for i in range(len(t.encode()) - 15))
    histogram = digests.histogram(docs)
    assert {i: n for i, n in enumerate(histogram.tolist()) if n} == counts
    rarest = sorted(range(1000), key=lambda c: (counts[c], c))
    ranks = [1000 if c < 150 else rarest.index(c) for c in range(1000)]
    order = sorted(texts)
    want = []
    for (k, t), (_, following) in zip(order, [*order[1:], order[0]], strict=True):
        changed = t[: len(t) - len(t) // 4] + following[: len(t) // 4]
        own, other, after = (plain_chain(x, ranks) for x in (t, changed, following))
        want.append(
            (
                k,
                plain_text(own),
                plain_text(other),
                round(plain_likeness(own, other), 9),
                1.0 if t == following else round(plain_likeness(own, after), 9),
            )
        )
    got = digests.neighbours(docs, digests.rarity_ranks(histogram, 150)).collect()
    assert sorted(
        (r.doc_id, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in got
    ) == sorted(want)


def test_fingerprint_of_one_document(spark):
    docs = spark.createDataFrame([(1, "some words that stand alone here")], "doc_id long, text string")
    [r] = digests.neighbours(docs, digests.rarity_ranks(digests.histogram(docs), 0)).collect()
    assert r.edited == "some words that stand alsome wor"
    assert r.near_next == 1.0


def test_toxicity_chain(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/../sf0.01/{t}.parquet") for t in ("documents", "labels"))
    train, test = (
        labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0) if held else labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) != 0)
        for held in (False, True)
    )
    chain = toxicity.learn(docs, train, {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")})
    got = toxicity.score(docs, chain).join(test, "doc_id").collect()
    caught = [r.p_toxic >= 0.4 for r in got if r.toxic == 1]
    assert sum(caught) / len(caught) >= 0.6
    assert not any(r.p_toxic >= 0.4 for r in got if r.toxic == 0)


def test_toxicity_matches_a_plain_chain(spark, fixture_docs, fixture_rows):
    labels = spark.createDataFrame([(k * 3, int(k % 3 == 0), int(k % 4 == 0)) for k in range(40)], "doc_id long, bad int, worse int")
    chain = toxicity.learn(
        fixture_docs, labels, {"bad": F.col("bad"), "worse": F.col("worse")}, settings=toxicity.Settings(l1=0.1, bits=16)
    )
    assert len(chain.models[1][1]) == 1 and chain.models[1][1][0] != 0  # the second sees the first one's probability

    def plain(text):
        """Distinct words and first bytes, one model after the other."""
        words = re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        low = lambda word: int(
            kernels.word_hashes(np.frombuffer(word, np.uint8), np.array([0, len(word)]), gap=toxicity.GAP)[0][0]
        )
        places = {low(w) >> 48 for w in words} | {(low(w[:4]) ^ 0x5851F42D4C957F2D) >> 48 for w in words}
        told = []
        for weights, chained, bias in chain.models:
            z = sum(float(weights[p]) for p in places) + sum(c * p for c, p in zip(chained, told, strict=True)) + bias
            told.append(1 / (1 + math.exp(-min(30, max(-30, z)))))
        return told

    want = sorted((k if k is not None else -1, *[round(p, 5) for p in plain(t)]) for k, t, *_ in fixture_rows)
    got = sorted(
        (r.doc_id if r.doc_id is not None else -1, round(r.p_bad, 5), round(r.p_worse, 5))
        for r in toxicity.score(fixture_docs, chain).collect()
    )
    assert np.abs(np.array(got) - np.array(want)).max() < 1e-4


def test_toxicity_sample_is_bounded(spark, fixture_docs, monkeypatch):
    labels = spark.createDataFrame([(k * 3, k % 2) for k in range(40)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(
        toxicity,
        "_fit",
        lambda rows,
        earlier,
        y,
        s: seen.append((len(rows), sum(map(len, rows)))) or (np.zeros(1 << s.bits, np.float32), np.zeros(earlier.shape[1]), 0.0),
    )
    many = fixture_docs.unionByName(fixture_docs)  # every key repeats
    toxicity.learn(many, labels, {"toxic": F.col("toxic")}, settings=toxicity.Settings(sample_rows=12))
    toxicity.learn(many, labels, {"toxic": F.col("toxic")}, settings=toxicity.Settings(sample_bytes=2000))
    assert seen[0][0] == 12
    assert 0 < seen[1][1] <= 500


def test_toxicity_of_odd_texts(fixture_docs, fixture_rows, no_docs, spark):
    labels = spark.createDataFrame([(0, 1), (3, 0), (6, None), (None, 1), (0, 1)], "doc_id long, toxic int")
    chain = toxicity.learn(fixture_docs, labels, {"toxic": F.col("toxic")})
    assert toxicity.score(fixture_docs, chain).count() == len(fixture_rows)
    assert toxicity.score(no_docs, chain).collect() == []
    nothing = toxicity.learn(fixture_docs, labels.limit(0), {"toxic": F.col("toxic")})
    assert all(r.p_toxic < 1e-9 for r in toxicity.score(fixture_docs, nothing).collect())


def test_word_hashes_follow_words():
    import pyarrow as pa

    data, offsets = kernels.utf8(pa.array(["Ab cd", None, "cd\tab", "ab cd", "c d"]))
    hashes, at = kernels.word_hashes(data, offsets)
    assert at.tolist() == [0, 2, 2, 4, 6, 8]
    assert hashes[0] == hashes[3] == hashes[4]
    assert hashes[1] == hashes[2] == hashes[5]
    assert len({*hashes.tolist()}) == 4


def test_digest_columns(spark):
    """The thin queries derive their columns from what the operators return."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in queries.op9_sentencepiece(spark, SF_SMALL).collect()}
    for d in docs[:50]:
        ids = model.encode(d.text)
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()
    want = {k: (n, sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest()) for k, n, spans, kept in cut([(d.doc_id, d.text) for d in docs])}
    assert {
        r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op6_suffix_dedup(spark, SF_SMALL).collect()
    } == want
