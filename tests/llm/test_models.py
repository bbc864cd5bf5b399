"""Toxicity, language, pages, sharding and search against plain versions or held-out rows."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm import language, pages, sharding, toxicity, vector_search
from rankloom.llm.words import Block, Hasher, word_bytes


def made_labels(spark, docs):
    return docs.filter("doc_id is not null").select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))


def test_toxicity_finds_planted_words(spark):
    rng = random.Random(1)
    plain = [f"word{i}" for i in range(200)]
    bad = ["vilest", "grumbler", "scoffing"]
    rows = []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        if i % 6 == 0:
            for _ in range(2):
                words[rng.randrange(len(words))] = rng.choice(bad) + rng.choice(["", "ly", "ness"])
        rows.append((i, " ".join(words) + ".", int(i % 6 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    field = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    got = toxicity.score_toxicity(docs, field).withColumn("held_out", toxicity.fold() == 2).collect()
    held = [r for r in got if r.held_out]
    assert sum((r.score >= toxicity.THRESHOLD) == r.toxic for r in held) >= 0.98 * len(held)
    for r in held:
        if r.toxic:
            assert any(r.text[a:b].startswith(tuple(bad)) for a, b in zip(r.spans[::2], r.spans[1::2], strict=True))


def test_forward_backward_is_exact():
    rng = np.random.default_rng(2)
    unary, t = rng.normal(size=9), rng.normal(size=(2, 2))
    opens, lengths = np.array([0, 4, 5]), np.array([4, 1, 4])
    left, right = toxicity.forward_backward(unary, opens, lengths, t)
    for o, n in zip(opens, lengths, strict=True):
        mass = np.zeros((n, 2))
        for states in np.ndindex(*[2] * n):
            weight = np.exp(sum(unary[o + i] * s for i, s in enumerate(states)) + sum(t[a, b] for a, b in zip(states, states[1:], strict=False)))
            for i, s in enumerate(states):
                mass[i, s] += weight
        assert np.allclose((left + right)[o:o + n], np.log(mass[:, 1] / mass[:, 0]))


def test_toxicity_awkward_rows(spark, docs, no_docs):
    labels = made_labels(spark, docs)
    scored = toxicity.score_toxicity(docs, toxicity.fit(docs, labels))
    assert set(docs.columns) == set(scored.columns) and scored.count() == docs.count()
    assert scored.filter("score is null or score < 0 or score > 1 or spans is null").count() == 0
    lowest = scored.agg(F.min("score")).first()[0]
    assert scored.filter("text is null").first()["score"] == lowest
    nothing = toxicity.fit(docs, labels.withColumn("toxic", F.lit(None).cast("int")))
    assert toxicity.score_toxicity(docs, nothing).filter("score > 0.001").count() == 0
    assert toxicity.score_toxicity(no_docs, toxicity.fit(no_docs, labels.limit(0))).count() == 0


LANGS = {"aa": "tak mok rul pesh gorin tavik", "bb": "lala nunu sisi momo lalunu sinuno", "el": "και το ένα λόγος θάλασσα ήλιος"}


def test_language_of_mixed_text(spark):
    rng = random.Random(4)
    say = lambda lang, n: " ".join(rng.choice(LANGS[lang].split()) for _ in range(n))
    rows = [(i, say(lang, 20), lang) for i, lang in enumerate(["aa", "bb", "el"] * 40)]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    tests = [(0, say("aa", 12), "aa"), (1, say("bb", 12), "bb"), (2, "123 !", "und"), (3, None, "und"), (4, "", "und"), (5, say("el", 1), "el"),
             (6, "„… —", "und")]
    got = language.identify(spark.createDataFrame(tests, "doc_id long, text string, want string"), model).collect()
    assert all(r.lang_pred == r.want for r in got)
    assert all((r.score == 0) == (r.want == "und") and 0 <= r.score <= 1 for r in got)
    mixed = say("aa", 10) + ". " + say("bb", 20)
    r = language.identify(spark.createDataFrame([(mixed,)], "text string"), model).first()
    assert r.span_langs == ["aa", "bb"] and r.span_ends == [mixed.index("."), len(mixed)] and r.lang_pred == "bb"


def test_viterbi_is_best():
    rng = np.random.default_rng(3)
    scores, first = rng.normal(size=(8, 3)), np.array([0, 5, 5, 8])
    path = language.viterbi(scores, first, switch=0.7)
    for a, b in zip(first[:-1], first[1:], strict=True):
        cost = lambda p: sum(scores[a + i, s] for i, s in enumerate(p)) - 0.7 * sum(x != y for x, y in zip(p, p[1:], strict=False))  # noqa: B023, E731
        if b > a:
            assert np.isclose(cost(path[a:b].tolist()), max(cost(p) for p in np.ndindex(*[3] * (b - a))))


def test_scripts_narrow_candidates():
    texts = ["abc".encode(), "λόγος".encode(), "слово".encode(), "naïve".encode(), "言葉".encode()]
    block = Block(texts, word_bytes(digits=False), Hasher())
    assert [int(language.SCRIPTS[s]) for s in language.word_scripts(block)] == [0, 0x370, 0x400, 0, 0x3100]


def test_language_awkward_rows(docs, no_docs):
    model = language.learn(docs)
    got = language.identify(docs, model)
    assert got.count() == docs.count() and got.filter("lang_pred is null or score is null").count() == 0
    assert language.identify(docs, language.learn(no_docs)).filter("lang_pred <> 'und'").count() == 0
    assert language.identify(no_docs, model).count() == 0


PAGES = {
    "": "", None: "", "just text": "just text",
    "<article><h1>T &amp; t</h1><p>One,  two<br>three\n four.<p>Next <b>bold</b> part</article>": "T & t\n\nOne, two three four.\n\nNext bold part",
    "<nav><a href=x>Home</a></nav><div class='side-bar sidebar'><p>a, b, c, d, e</p></div><main><p>Text, of the page.</p></main><footer>f</footer>":
        "Text, of the page.",
    "<article><p>Body, text, here.</p><form>Name <input></form><section id=comments><p>So, true, yes, but, no</p></section></article>": "Body, text, here.",
    "<body><div><p>Some text, a bit</p><!-- <p>no</p> --><script>if (a<b) '</p>'</script><style>p{}</style><p>more &lt;b&gt; text&nbsp;here</p></div>":
        "Some text, a bit\n\nmore <b> text here",
    "<article><p>a &lt 3 < 4 <3</p><ul><li>x<li>y</ul></article>": "a < 3 < 4 <3\n\nx\n\ny",
    "<article><p title=\"a > b\">kept</p><p hidden>not</p><p style='display: none'>nor</p></article>": "kept",
    "<article><p>open <a href='x>never closed, text": "open never closed, text",
}


@pytest.mark.parametrize("html", PAGES)
def test_main_text(html):
    assert pages.main_text(html or "") == PAGES[html]


def test_links_discount_and_siblings_stay():
    menu = "<ul>" + "".join(f"<li><a href='/{i}'>item, number, {i}</a></li>" for i in range(30)) + "</ul>"
    story = "".join(f"<p>{'Sentence, with commas, and length. ' * 5}{i}</p>" for i in range(4))
    text = pages.main_text(f"<body><div>{menu}</div><div id=a>{story}</div><div id=b>{story}</div></body>")
    assert "item" not in text and text.count("Sentence") == 40


BODY = "<p>Short lead.</p>" + f"<p>{'Body, with commas, and length. ' * 8}</p>" * 4 + "<blockquote>Said.</blockquote><ul><li>one</li></ul>"


@pytest.mark.parametrize("html", [
    "<article><h1>Title</h1><div class=body>BODY</div><p>After.</p></article>",
    "<main><h1>Title</h1><p>Lead.</p><div>BODY</div><pre>code</pre></main>",
    "<article><div class=entry-header><h1>Title</h1></div><div>BODY</div></article>",
    "<div class='content no-sidebar'><article><h1>Title</h1>BODY</article></div>",
    "<div class='post has-comments page_with_sidebar'><h1>Title</h1>BODY</div>",
    "<main><div class='content sidebar-left'><h1>Title</h1>BODY</div></main>",
    "<div class='post comments-open'><h1>Title</h1>BODY</div><p>x</p>",
])
def test_whole_article_stays(html):
    page = "<body><nav>Menu</nav><div class=sidebar><p>Elsewhere, too.</p></div>" + html.replace("BODY", BODY) + "<footer>Foot</footer>"
    text = pages.main_text(page)
    assert text.startswith("Title\n\n") and "Short lead." in text and "Said." in text and "one" in text and text.count("Body, ") == 32
    assert not any(w in text for w in ("Menu", "Elsewhere", "Foot")) and all(w in text for w in ("Lead.", "After.", "code") if w in html)


def test_text_between_kept_siblings_stays():
    story = f"<p>{'Sentence, with commas, and length. ' * 5}</p>" * 4
    text = pages.main_text(f"<body><div>{story * 2}</div><h2>Part two</h2>loose words<p>Short.</p><div>{story}</div><div>{'x ' * 9}</div></body>")
    assert [w for w in text.split("\n\n") if not w.startswith("Sentence")] == ["Part two", "loose words", "Short."]


def test_long_comments_and_single_adverts_stay_out():
    said = f"<p>{'So, true, yes, but, no. ' * 9}</p>" * 20
    assert pages.main_text(f"<div><p>Body, text, here.</p></div><div id=comments>{said}</div>") == "Body, text, here."
    assert pages.main_text("<div class=ad>Buy, now, here, cheap</div>") == ""


def test_pages_on_awkward_rows(spark):
    deep = "<div>" * 20000 + "deep text" + "</x>" * 20000
    rows = [(1, "u", None), (2, None, ""), (3, "u", deep), (3, "u", deep), (4, "u", "<p" * 30000), (5, "u", "<!--" * 30000), (6, "u", "<a b='" * 5000 + "> t")]
    got = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))).collect()
    assert [r.text for r in got if r.page_id == 3] == ["deep text"] * 2 and all(r.n_chars == len(r.text) for r in got)


def plain_shards(sizes, shards):
    def fits(capacity):
        used, held = 1, 0
        for s in sizes:
            if s > capacity:
                return False
            if held + s > capacity:
                used, held = used + 1, 0
            held += s
        return used <= shards
    return next(c for c in range(max(sizes), sum(sizes) + 1) if fits(c))


def test_sharding_is_minimax(docs, no_docs):
    rows = sharding.shard_by_bytes(docs, 5).collect()
    assert len(rows) == docs.count()
    groups = collections.defaultdict(int)
    shard_of, held, slots = {}, collections.defaultdict(int), collections.defaultdict(list)
    for r in rows:
        groups[r.key] += r.size
        assert shard_of.setdefault(r.key, r.shard) == r.shard
        held[r.shard] += r.size
        slots[r.shard].append(r.slot)
    order = [groups[k] for k in sorted(groups)]
    assert max(held.values()) == plain_shards(order, 5)
    assert [shard_of[k] for k in sorted(groups)] == sorted(shard_of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_by_bytes(no_docs, 5).count() == 0


@pytest.mark.parametrize("shards", [1, 3, 8, 50])
def test_cuts_open_few_ranges(spark, shards):
    rng = np.random.default_rng(shards)
    keys = [int(k) for k in rng.integers(-(1 << 63), (1 << 63) - 1, 300)] + list(range(40))
    sizes = [int(s) for s in rng.integers(1, 1000, len(keys))]
    groups = spark.createDataFrame(list(zip(keys, sizes, strict=True)), "key long, size long")
    begins = sharding.minimax_cuts(groups, shards)
    held = collections.Counter()
    for k, s in zip(keys, sizes, strict=True):
        held[sum(k >= b for b in begins)] += s
    assert len(begins) < shards + 1 and max(held.values()) == plain_shards([s for _, s in sorted(zip(keys, sizes, strict=True))], shards)


def plain_top(vectors, k):
    out = []
    for q, x in vectors:
        if q % 20 == 0:
            scores = sorted(((-int(np.dot(x, y)), v) for v, y in vectors if v != q))[:k]
            out += [(q, i + 1, v, -s) for i, (s, v) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("page", [512, 4])
def test_exact_top_k(spark, page, monkeypatch):
    monkeypatch.setattr(vector_search, "PAGE", page)
    monkeypatch.setattr(vector_search, "ROWS_PER_TREE", 150)
    monkeypatch.setattr(vector_search, "QUERIES_PER_GROUP", 7)
    rng = np.random.default_rng(9)
    raw = rng.normal(size=(400, 8)) * rng.choice([0.1, 1, 5], (400, 1))
    raw[100:160] = raw[100]  # ties
    rows = [(i, x.astype(np.float32).tolist()) for i, x in enumerate(raw)]
    bad = [(1000, None), (1020, [1.0, None] + [0.0] * 6), (1040, [float("nan")] * 8), (1060, [float("inf")] * 8), (None, [1.0] * 8)]
    table = spark.createDataFrame(rows + rows[:3] + bad, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    vectors = vector_search.whole_vectors(table)
    got = vector_search.exact_top_k(vectors, vectors.filter("id % 20 = 0"), 20)
    plain = [(i, np.floor(64 * np.array(x, np.float32).astype(float))) for i, x in rows]
    assert sorted(map(tuple, got.collect())) == plain_top(plain, 20)


def test_top_k_of_few_and_none(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    vectors = vector_search.whole_vectors(table)
    assert [tuple(r) for r in vector_search.exact_top_k(vectors, vectors.filter("id = 0"), 20).collect()] == [(0, 1, 1, 64 * 128)]
    none = vector_search.whole_vectors(table.limit(0))
    assert vector_search.exact_top_k(none, none, 20).count() == 0


def test_top_k_holds_one_tree_and_one_pass_of_queries(spark, monkeypatch):
    rng = np.random.default_rng(3)
    raw = np.vstack([rng.normal(size=(500, 6)), rng.normal(size=(300, 6)) * 0.01 + 2, np.full((60, 6), 0.5)])
    rows = [(i, x.astype(np.float32).tolist()) for i, x in enumerate(raw)]
    vectors = vector_search.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    plain = [(i, np.floor(64 * np.array(x, np.float32).astype(float))) for i, x in rows]
    for cells in (1 << 21, 60):
        monkeypatch.setattr(vector_search, "PASS_CELLS", cells, raising=False)  # all queries at once; ten a pass
        monkeypatch.setattr(vector_search, "ROWS_PER_TREE", 100)
        monkeypatch.setattr(vector_search, "QUERIES_PER_GROUP", 7)
        got = vector_search.exact_top_k(vectors, vectors.filter("id % 20 = 0"), 20)
        assert "CoGroup" not in got._jdf.queryExecution().toString()  # a copy of every tree went to every group of queries
        assert sorted(map(tuple, got.collect())) == plain_top(plain, 20)


def test_hot_group_leaves_the_other_shards_even():
    rng = np.random.default_rng(9)
    for hot in (0, 400, 999):
        sizes = rng.integers(1, 5, 1000)
        sizes[hot] = sizes.sum() // 2
        capacity = sharding.least_capacity(sizes, 8, np.ones(1000, bool))
        held = np.diff(sharding.balanced(sizes, 8, capacity), prepend=0)
        rest = (sizes.sum() - sizes[hot]) / 7
        assert held.sum() == sizes.sum() and held.max() <= capacity and (held > 0).all() and np.sort(held)[:6].max() < 1.5 * rest
    assert np.diff(sharding.balanced(np.array([1000, 1000, 1000]), 8, 1000), prepend=0).max() == 1000
    for _ in range(200):
        sizes = rng.integers(1, 30, rng.integers(1, 40))
        shards = int(rng.integers(1, 10))
        capacity = sharding.least_capacity(sizes, shards, np.ones(len(sizes), bool))
        ends = sharding.balanced(sizes, shards, capacity)
        assert ends[-1] == sizes.sum() and np.diff(ends, prepend=0).max() == capacity and set(ends) <= set(np.cumsum(sizes)) | {0}
