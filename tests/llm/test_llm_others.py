"""Vectors, pages, chats and the pipeline."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from civicspark.llm import chat, language, mixing, pages, queries, topk

SF_SMALL = "/root/testdata/sf0.001"


def brute_topk(rows, k=5, scale=256):
    ints = {}
    for key, v in rows:
        if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints[key] = [math.floor(scale * x) for x in v]
    out = []
    for q in ints:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=False)), key) for key, v in ints.items() if key != q)[:k]
            out += [(q, i + 1, key, -s) for i, (s, key) in enumerate(best)]
    return sorted(out)


def test_topk_odd_vectors(spark):
    rows = [(i, [((i * 7 + j * 3) % 11 - 5) / 8 for j in range(6)]) for i in range(120)]  # many ties
    rows += [
        (200, None),
        (201, [1.0, None]),
        (202, [float("nan")]),
        (203, [float("inf")]),
        (250, [0.5, -0.5]),
        (300, [1e5] * 6),
        (301, []),
        (None, [1.0] * 6),
        (350, [-0.0, 0.001]),
    ]
    df = spark.createDataFrame(
        [*rows, rows[3], rows[0]], "vec_id long, embedding array<double>"
    ).selectExpr("*", "1 as score", "2 as lane", "3 as rank")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(df, df.where("vec_id % 50 = 0")).collect())
    assert got == brute_topk(rows)


def test_topk_many_lanes_and_groups(spark):
    rng = random.Random(3)
    rows = [(i, [rng.randint(-9, 9) / 4 for _ in range(5)]) for i in range(0, 3000, 10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.search(df, df.where("vec_id % 50 = 0"), shard_rows=8, lane_rows=20, block_rows=4, group_rows=6)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == brute_topk(rows)


def test_topk_best_row_of_a_repeated_key(spark):
    df = spark.createDataFrame(
        [(0, [1.0]), (7, [1.0]), (7, [3.0]), (7, [2.0]), (8, [2.5]), (9, [0.5])], "vec_id long, embedding array<double>"
    )
    got = [(r["rank"], r.vec_id, r.score) for r in topk.search(df, df.where("vec_id = 0"), k=2).orderBy("rank").collect()]
    assert got == [(1, 7, 256 * 768), (2, 8, 256 * 640)]


def test_topk_threshold_holds_over_shards():
    """The last shards of a lane have to complete fewer scores than they would alone."""
    rng = np.random.default_rng(1)
    matrix = np.floor(rng.normal(0, 1, (4000, 32)) * rng.uniform(0.02, 3, 32) * 256).astype(np.float32)

    def packed(rows, size):
        cut = range(rows.start, rows.stop, size)
        return pa.table(
            {
                "keys": [np.arange(a, min(a + size, rows.stop)).tobytes() for a in cut],
                "matrix": [matrix[a : min(a + size, rows.stop)].tobytes() for a in cut],
                "width": [32 for _ in cut],
                "single": [True for _ in cut],
            }
        )

    queries = packed(range(0, 40), 8)
    whole, together = topk.score(packed(range(4000), 250), queries, 5)
    alone = [topk.score(packed(range(a, a + 250), 250), queries, 5) for a in range(0, 4000, 250)]
    assert together < 0.9 * sum(n for _, n in alone)
    assert all(len(scores) == 5 for scores, _ in whole.best.values()) and len(whole.best) == 40


def test_topk_few_candidates(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.search(df, df.where("vec_id = 0")).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.search(df.limit(0), df.limit(0)).collect() == []
    assert topk.search(df.limit(1), df.limit(1)).collect() == []


HEAD = "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain text", "plain text"),
        (HEAD + "<nav><ul><li><a href='/a'>Menu</a></li></ul></nav><article><h1>Title</h1><p>One&nbsp;two &amp; three<br>four</p><p>Ti.</p></article><footer>&copy; me</footer></body></html>", "Title\n\nOne two & three four\n\nTi."),
        (HEAD + "<div class='ad'>Buy</div><article><h1>T</h1><p><b>open bold<br><p>next</article><footer>f", "T\n\nopen bold\n\nnext"),
        (HEAD + "<article><p>A</p><script>var t='</p>';</script><!-- x <p>no</p> --><aside>side</aside><p>B</p><section class='comments'><p>me too</p></section></article>", "A\n\nB"),
        (HEAD + "<div><h1>No article</h1><p>" + "words " * 40 + "</p><p>end</p></div><div id='cookie-banner'>We use</div><form><p>f</p></form>", "No article\n\n" + "words " * 39 + "words\n\nend"),
        (HEAD + "<article><h1>Short</h1><p>one</p><p>two</p><p>" + "long " * 30 + "</p></article>", "Short\n\none\n\ntwo\n\n" + "long " * 29 + "long"),
        (HEAD + "<article><p>cut &am", "cut &am"),
        (HEAD + "<article><p>a</p><foot", "a"),
        (HEAD + "<article class='post has-sidebar'><ul><li>one</li><li>two</li></ul></article>", "one\n\ntwo"),
        (HEAD + "<article><p>x &lt;p&gt; &#233;&#x20AC;</p></article>", "x <p> é€"),
        ("<article><p>unclosed comment</p><!-- gone <p>b</p>", "unclosed comment"),
        (HEAD + "<nav>only a menu</nav></body>", ""),
    ],
)
def test_main_text(html, text):
    assert pages.main_text(html or "") == text


LONG = "long " * 29 + "long"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<div><p>{LONG}</p><div class=ad>x</div><p>Short end.</p></div>", LONG + "\n\nShort end."),
        (f"<div><p>First.</p><aside>note</aside><div class='share'><a>s</a></div><p>{LONG}</p></div><footer>f</footer>", "First.\n\n" + LONG),
        (f"<body><p>{LONG}</p><div class=ad>x</div><p>Short end.</p><footer>me</footer></body>", LONG + "\n\nShort end."),
        (f"<div id=t><div>{LONG}</div><div class=ad>x</div><div>Short end.</div></div>", LONG + "\n\nShort end."),
        (f"<div><p>{LONG}</p><div class=ad>x</div><ul><li>one</li><li>two</li></ul></div>", LONG + "\n\none\n\ntwo"),
        (f"<div id=w><div>Logo</div><nav>menu</nav><div><h1>T</h1><p>{LONG}</p><div class=share>s</div></div><nav>more</nav><div>Imprint</div></div>", "T\n\n" + LONG),
        (f"<article><h2>Teaser</h2><p>Short.</p></article><div><h1>T</h1><p>{LONG}</p><p>End.</p></div>", f"T\n\n{LONG}\n\nEnd."),
        (f"<div><h1>T</h1><p>{LONG}</p><div class=ad>x</div><p>End.</p></div><article><p>Teaser</p></article><article><p>Other</p></article>", f"T\n\n{LONG}\n\nEnd."),
        (f"<div><p>words {'beside ' * 15}</p></div><article><p>{LONG}</p><aside>x</aside><p>End.</p></article>", LONG + "\n\nEnd."),
        ("<p>Beside it.</p><article><p>A</p></article>", "A"),
    ],
)
def test_main_text_around_furniture_and_articles(html, text):
    assert pages.main_text(html) == text


LINKS = "".join(f"<div><a href='/{i}'>Menu entry {i}</a></div>" for i in range(6))
UNMARKED = HEAD + LINKS + f"<h1><a href='/'>Title</a></h1><p>{LONG}</p><p>Short.</p><p><a href='/c'>cited</a></p><p>End.</p>" + LINKS + "<div>(c) us</div>"


def test_surge_and_dive_points_locate_the_text(monkeypatch):
    """On pages without any marked section only the distribution tells the text from what stands around it."""
    want = f"Title\n\n{LONG}\n\nShort.\n\ncited\n\nEnd."
    assert pages.main_text(UNMARKED) == want
    assert pages.main_text(UNMARKED, window=100) != want  # a window over the whole page finds no dive
    monkeypatch.setattr(pages, "_runs", lambda rows, *_, **__: [[text for text, _ in rows if text]])
    assert pages.main_text(UNMARKED) != want


def brute_runs(weights, window=3, threshold=80):
    """Line numbers of the text, by its definition, for lines that weigh these characters."""
    sums = [sum(weights[max(0, i - window + 1) : i + 1]) for i in range(len(weights))]
    least, kept, i = min(threshold, max(sums, default=0)), [], 0
    while i < len(weights):
        j = i
        while j < len(weights) and sums[j] > 0:
            j += 1
        if j > i and max(sums[i:j]) >= least:
            kept += range(i, max(k for k in range(i, j) if weights[k]) + 1)
        i = j + 1 if j == i else j
    return kept


def test_distribution_matches_brute_force():
    rng = random.Random(8)
    for _ in range(300):
        weights = [rng.choice([0, 0, 0, rng.randint(1, 30), rng.randint(30, 200)]) for _ in range(rng.randint(1, 40))]
        blocks = ["x" * n if n else "link" for n in weights]
        page = "".join(f"<div>{b}</div>" if n else f"<div><a href='/'>{b}</a></div>" for n, b in zip(weights, blocks, strict=True))
        want = [blocks[i] for i in brute_runs(weights)] if any(weights) else blocks
        assert pages.main_text(page) == "\n\n".join(want) or not any(weights)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<div><h1>Head</h1></div><nav>menu</nav><div>{LONG}</div><aside>side</aside><div><p>Closing line.</p></div>", f"Head\n\n{LONG}\n\nClosing line."),
        ("<article><p>x <math><mi>y</mi></math> z</p><div class='related-work'>Related</div><div class='header-image'>Image</div><div class='related-posts'>no</div></article>", "x y z\n\nRelated\n\nImage"),
        ("<article><p>One <a href='/'>two</a></p><p><a href='/'>three</a></p></article>", "One two\n\nthree"),
        ("<ul><li><a href='/'>only</a></li><li><a href='/'>links</a></li></ul>", "only\n\nlinks"),
        ("<article><p>&lt<b>;</b></p><video>clip</video><select><option>1</option></select></article>", "<;\n\nclip"),
    ],
)
def test_main_text_drops_nothing_else(html, text):
    assert pages.main_text(html) == text


def test_pages_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>x</p>"), (3, "u", "<p>x</p>"), (None, "v", "<article>" + "<p>word</p>" * 20000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' as text")
    got = {(r.page_id, r.url, len(r.text)) for r in pages.extract(df).collect()}
    assert got == {(1, "u", 0), (2, None, 0), (3, "u", 1), (None, "v", 20000 * 6 - 2)}
    assert pages.extract(df).count() == 5
    assert pages.extract(df.limit(0)).collect() == []


def test_chats_collapse(spark):
    a, b, c = ("user", "hi"), ("assistant", "yes"), ("user", "more")
    chats = {1: [a], 2: [a, b], 3: [a, b, c], 4: [a, c], 5: [a, c], 6: [("user", None)], 7: [("user", None), b], 8: [(None, "hi")]}
    rows = [(k, i, r, t) for k, turns in chats.items() for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(
        [*rows, rows[0], rows[-1], (None, 0, "user", "x")], "conv_id long, turn long, role string, text string"
    ).selectExpr("*", "1 as n_turns", "2 as _c")
    got = {r.conv_id: (r.n_turns, r.n_copies, r.n_prefixes) for r in chat.maximal(df).collect()}
    assert got == {3: (3, 1, 2), 4: (2, 2, 1), 7: (2, 1, 1), 8: (1, 1, 0)}
    text = {r.conv_id: r.chat for r in chat.render(df).collect()}
    assert text[4] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>user\nmore<|im_end|>\n"
    assert text[8] == "<|im_start|>unknown\nhi<|im_end|>\n"
    assert chat.render(df.limit(0)).collect() == []


def test_chats_with_ties(spark):
    """Turns of one place and role stand by text, null first, so that what comes behind them is a prefix by text too."""
    tied = [(1, 0, "user", t) for t in ("gamma", "delta", None, "beta", "alpha", "delta")]
    longer = [
        *[(2, 0, "user", t) for t in (None, "alpha", "beta", "delta", "gamma")],
        (2, 1, "bot", "end"),
        (3, 0, "user", "alpha"),
        (4, None, None, "b"),
        (4, None, None, "a"),
    ]
    df = spark.createDataFrame(tied + longer, "conv_id long, turn int, role string, text string")
    got = {r.conv_id: (r.n_turns, r.n_prefixes, r.chat) for r in chat.render(df).collect()}
    block = lambda role, text: f"{chat.BEGIN}{role}\n{text}{chat.END}\n"
    assert got[2] == (6, 1, "".join(block("user", t) for t in ("", "alpha", "beta", "delta", "gamma")) + block("bot", "end"))
    assert got[4] == (2, 0, block("unknown", "a") + block("unknown", "b"))
    assert set(got) == {2, 3, 4}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_operator_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    found = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in found.description]
    got = queries.QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted(found.fetchall())


def test_pipeline_stages(spark, fixture_docs):
    docs = fixture_docs.select("doc_id", "text", "lang", "source", "n_chars")
    counts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, ""))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        counts.append(docs.count())
    assert counts[0] > counts[1] >= counts[2] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert last.count() == counts[-1]


def components(texts):
    """The number of each text's component of near copies."""
    sets = []
    for text in texts:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", w) if x]
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def test_pipeline_keeps_one_row_of_each_component(spark, fixture_rows):
    """Repeated rows, another text under a kept id, components of null ids alone and beside others."""
    null = lambda i, lang: (None, fixture_rows[i][1], lang, "a")
    alone = " ".join(f"only{i} null{i}" for i in range(40))
    rows = [
        *fixture_rows,
        fixture_rows[0],
        fixture_rows[5],
        null(3, "en"),
        null(41, None),
        (None, alone, "en", "a"),
        (None, alone, "en", "a"),
        (None, alone + " end", "de", None),
        (fixture_rows[2][0], fixture_rows[0][1], "de", None),
    ]
    kinds = "doc_id long, text string, lang string, source string"
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, kinds), "").collect()
    group = components([r[1] for r in rows])
    kept = [tuple(r) for r in got]
    left = list(kept)
    for g in set(group):
        members = [rows[i] for i in range(len(rows)) if group[i] == g]
        least = min((m[0] is None, m[0] or 0) for m in members)
        own = [m for m in members if m in left and (m[0] is None, m[0] or 0) == least]
        assert own, members
        left.remove(own[0])
    assert left == []
    again = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows[::-1], kinds).repartition(3), "").collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def without_repeats(rows, key, text, length=50):
    """What is left of each text without strings that stand in a row of smaller key."""
    place = lambda r: 1 << 60 if r[key] is None else r[key]
    first = {}
    for r in rows:
        data = (r[text] or "").encode()
        for i in range(len(data) - length + 1):
            s = data[i : i + length]
            first[s] = min(first.get(s, 1 << 60), place(r))
    out = []
    for r in rows:
        data = (r[text] or "").encode()
        gone = {k for i in range(len(data) - length + 1) if first[data[i : i + length]] < place(r) for k in range(i, i + length)}
        out.append((bytes(c for k, c in enumerate(data) if k not in gone).decode("utf-8", "ignore"), bool(gone)))
    return out


def test_pipeline_row_by_row(spark, fixture_docs, tmp_path):
    """Each stage against a brute-force version, with repeated rows, null ids and columns named as the operators' own."""
    known = fixture_docs.where("doc_id IN (6, 27)").withColumn("doc_id", F.lit(None).cast("long"))
    docs = corpus_pipeline.materialize(
        fixture_docs.unionByName(known).withColumns({"kept": F.lit("k"), "n_bytes": F.lit(8), "spans": F.lit(9), "lang_pred": F.lit("xx")})
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    read = lambda df: [tuple(r) for r in df.collect()]
    key, text, lang, n_chars, source = (columns.index(c) for c in ("doc_id", "text", "lang", "n_chars", "source"))

    def put(row, **values):
        return tuple(values.get(c, x) for c, x in zip(columns, row, strict=True))

    def run(name, df):
        out = corpus_pipeline.materialize(dict(corpus_pipeline.STAGES)[name](spark, df, ""))
        assert out.columns == columns
        return out

    narrow = docs.select("doc_id", "text", "lang")
    found = {r.text: (r.lang_pred, r.score) for r in language.identify(narrow, language.learn(narrow), carry=("text",)).collect()}
    spoken = run("language ID", docs)
    want = [
        put(r, lang=found[r[text]][0] if r[lang] is None else r[lang])
        for r in read(docs) if found[r[text]][0] != "und" and found[r[text]][1] >= 0.3
    ]
    assert Counter(read(spoken)) == Counter(want)

    single = run("n-gram Jaccard join", spoken)
    before, after = read(spoken), Counter(read(single))
    group, count = components([r[text] for r in before]), 0
    for g in set(group):
        members = [r for r, x in zip(before, group, strict=True) if x == g]
        least = min((r[key] is None, r[key] or 0) for r in members)
        assert sum(after[r] for r in {r for r in members if (r[key] is None, r[key] or 0) == least}) == 1
        count += 1
    assert after.total() == count < len(before)

    cut = run("suffix-array dedup", single)
    before = read(single)
    want = [put(r, text=t, n_chars=len(t)) for r, (t, gone) in zip(before, without_repeats(before, key, text), strict=True) if not gone or any(c.isalnum() for c in t)]
    assert Counter(read(cut)) == Counter(want)

    # the first words of each source's stream, in hashed order, up to its target, which all have slots
    mixed = run("mixing sources to target weights", cut)
    place = cut.select("*", F.xxhash64(F.lit(42), "doc_id").alias("place"), F.xxhash64("text").alias("tie")).collect()
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[text] or ""))
    total = Counter()
    for r in place:
        total[r[source]] += size(r)
    want = Counter()
    for t in mixing.targets(list(total.items())):
        start, goal = 0, int(t.target + 0.5)
        for r in sorted(
            (r for r in place if r[source] == t.source), key=lambda r: (r.place % 2**64, r[key] is not None, r[key] or 0, r.tie)
        ):
            n = size(r)
            taken = sum(max(0, min(goal, k * t.size + start + n) - k * t.size - start) for k in (0, 1))
            want[tuple(r)[: len(columns)]] += int(taken / n + 0.5) if n else 0
            start += n
    assert Counter(read(mixed)) == +want

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    last = corpus_pipeline.encode(spark, mixed, "").collect()
    want = Counter((r[key], ",".join(map(str, model.encode(r[text])))) for r in read(mixed))
    assert Counter((r.doc_id, r.ids if isinstance(r.ids, str) else ",".join(map(str, r.ids))) for r in last) == want
    assert Counter(map(tuple, (r[:2] + r[3:] for r in last))) == Counter(
        map(tuple, (r[:2] + r[3:] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()))
    )


NAMES = ["_row", "_kept", "_kept_row", "_repeated", "_copy", "_id", "_tie", "_times", "_others", "_slots", "_slot", "kept", "spans", "component", "score", "lang_pred", "node", "n", "size", "taken", "slots", "a b"]


@pytest.mark.parametrize("stage", range(4))
def test_pipeline_stages_leave_other_columns_alone(spark, fixture_rows, stage):
    """Columns named as helpers, values that are never null, nested ones; the table is not written before."""
    rows = list({r[0]: r for r in fixture_rows if r[1] and len(r[1]) > 80}.values())
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    for i, name in enumerate(NAMES):
        docs = docs.withColumn(name, F.lit(i))
    docs = docs.withColumn("nested", F.array(F.struct(F.lit(1).alias("x"), F.col("doc_id").alias("_row"))))
    out = corpus_pipeline.STAGES[stage][1](spark, docs, "")
    assert out.columns == docs.columns
    kept = out.collect()
    assert kept and all([r[n] for n in NAMES] == list(range(len(NAMES))) for r in kept)
    assert all(r.nested[0].x == 1 and r.nested[0]["_row"] == r.doc_id for r in kept)
    if stage == 3:
        mixed = {r.doc_id: r.slots for r in mixing.mix(docs.select("doc_id", "text", "source")).documents.collect()}
        order = [(r.doc_id, [x.doc_id for x in kept[:i]].count(r.doc_id)) for i, r in enumerate(kept)]
        places = [mixed[k][c] if c < len(mixed[k]) else mixed[k][0] for k, c in order]
        assert places == sorted(places)


def test_pipeline_of_nothing(spark, no_docs):
    docs = no_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.collect() == []


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
