"""Operators that learn: held-out results on given rows, exact neighbours, and the awkward rows."""

from __future__ import annotations

import math
import pickle
import random
import re
import zlib
from collections import Counter

import corpora
import numpy as np
import pytest
from pyspark.sql import functions as F

from winnower.llm.language import Mixture, identify, mixtures
from winnower.llm.quality_rank import Ranker, Ranking, rank_quality
from winnower.llm.scratch import Scratch
from winnower.llm.site_tree import SiteTree, extract, host_of, importances, main_text, parse
from winnower.llm.toxicity import Index, Nearest, build, score_toxicity

BAD = ["moronic", "scummy", "trashy"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(11)
    rows, labels = [], []
    for k in range(400):
        quality, toxic = int(rng.random() < 0.7), int(rng.random() < 0.3)
        words = corpora.prose(rng, 80).split()
        if not quality:
            words = [w + " |" for w in words]
        if toxic:
            words[5:5] = rng.choices(BAD, k=3)
        rows.append((k, " ".join(words), "en"))
        labels.append((k, quality, toxic))
    for k in range(400, 480):
        rows.append((k, " ".join("".join(random.Random(k * 99 + j).choices(["ße", "ung", "keit", "ich", "ver"], k=2)) for j in range(60)), "de"))
    rows += [(1000, None, None), (1001, "", None), (1002, "123 45", None), (None, "the of and", None), (0, rows[0][1], "en"), (0, rows[0][1], "en")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x")), spark.createDataFrame([*labels, (7, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def test_quality_ranks_held_out_documents(corpus):
    docs, labels = corpus
    got = rank_quality(docs, labels).join(labels.where("quality IS NOT NULL"), "doc_id").where("held_out").collect()
    assert len(got) > 50
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got)
    every = rank_quality(docs, labels).collect()
    assert len(every) == docs.count() and all(0 <= r["score"] <= 1 for r in every)


def test_toxicity_finds_held_out_documents(corpus):
    docs, labels = corpus
    got = score_toxicity(docs, labels).join(labels.where("toxic IS NOT NULL"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in got]) > 0.95
    every = score_toxicity(docs, labels).collect()
    assert len(every) == docs.count() and all(0 <= r["score"] <= 1 for r in every)
    held = {r["doc_id"] for r in score_toxicity(docs, labels).where("held_out").select("doc_id").collect()}
    assert not held & {n for r in every for n in r["neighbours"]}


def test_block_maxima_give_the_exact_neighbours():
    rng = np.random.default_rng(4)
    for block in (2, 5, 64):
        p = Nearest(block=block, neighbours=5)
        vectors = [(np.sort(rng.choice(12, rng.integers(0, 5), replace=False)), None) for _ in range(70)]
        vectors = [(t, rng.integers(1, 4, len(t)).astype(float)) for t, _ in vectors]
        index = Index(np.arange(12), vectors, rng.integers(0, 2, 70), np.arange(70), rng.random(12) + 0.1, p)
        full = np.zeros((70, 12))
        for k, (t, n) in enumerate(vectors):
            full[k, t] = index.weigh(t, n)
        index = pickle.loads(pickle.dumps(index))
        for k in range(70):
            t, n = vectors[k]
            cosine = np.round(full @ full[k], 9)
            order = [j for j in np.lexsort((np.arange(70), -cosine)) if cosine[j] > 0][:5]
            best, score = index.nearest(t, index.weigh(t, n))
            assert best.tolist() == order and np.allclose(score, cosine[order])


def test_neighbours_are_those_of_whole_texts(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(3000)]
    rows = [(k, " ".join(rng.choices(words, k=40))) for k in range(120)]
    # Copies under other ids, with toxic labels of texts whose words occur once or twice only.
    rows += [(1000 + k, f"{rows[k][1]} {words[k]}") for k in range(120)]
    labels = [(k, int(k % 9 == 0)) for k in range(120)]
    got = {r["doc_id"]: r for r in score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    known = {k for k in range(120) if not got[k]["held_out"]}
    assert len(known) > 80
    for k in known:
        assert got[1000 + k]["neighbours"][0] == k and got[1000 + k]["cosines"][0] > 0.9


def test_cosines_and_votes_are_those_of_a_plain_search(spark):
    rng = random.Random(21)
    vocabulary = ["".join(rng.choices("abcdeé", k=3)) for _ in range(90)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 30))) for _ in range(150)] + ["", "12 34", "the " * 3000 + "end", "The the-the"]
    docs = [(k, t) for k, t in enumerate(texts)] + [(200, None), (3, texts[3])]
    labels = {k: int("a" in texts[k][:3]) for k in range(0, 140)} | {150: 0, 151: 1}
    p = Nearest(neighbours=6, ranks=(2, 5, 40))
    got = {r["doc_id"]: r for r in score_toxicity(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"), p).collect()}

    bags = {k: Counter(re.findall("[a-zé]+", (t or "").lower())) for k, t in docs}
    df = Counter(w for k, t in docs for w in set(bags[k]))
    weight = {}
    for k, bag in bags.items():
        raw = {w: (1 + math.log(n)) * math.log((len(docs) + 1) / (df[w] + 0.5)) for w, n in bag.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        weight[k] = {w: v / norm for w, v in raw.items()}
    known = [k for k in labels if zlib.crc32(str(k).encode()) % 5]

    def near(k: int, side: int, left: int = -1) -> list[float]:
        found = [sum(v * weight[j].get(w, 0.0) for w, v in weight[k].items()) for j in known if labels[j] == side and j != left]
        return sorted(found, reverse=True)

    def votes(k: int, left: int = -1) -> list[float]:
        return [math.log(sum(near(k, side, left)[:r]) / max(1, min(r, len(near(k, side, left)))) + 1e-4) for side in (0, 1) for r in p.ranks]

    for k in bags:
        cosines = [c for c in sorted(near(k, 0) + near(k, 1), reverse=True) if c > 1e-9][:6]
        assert np.allclose(got[k]["cosines"], cosines, atol=1e-5)
        assert np.allclose([sum(v * weight[j].get(w, 0.0) for w, v in weight[k].items()) for j in got[k]["neighbours"]], cosines, atol=1e-5)
    some = [k for k in known if bags[k]]
    x, y = np.array([votes(k, k) for k in some]), np.array([labels[k] for k in some], dtype=float)
    mean, spread = x.mean(0), x.std(0)
    plane = np.zeros(x.shape[1] + 1)
    z = np.column_stack(((x - mean) / spread, np.ones(len(x))))
    for _ in range(20_000):  # plain descent
        plane += 0.02 * (z.T @ (y - 1 / (1 + np.exp(-z @ plane))) - 0.1 * plane)
    for k in range(140, 150):
        assert abs(got[k]["score"] - 1 / (1 + np.exp(-(np.append((np.array(votes(k)) - mean) / spread, 1) @ plane)))) < 1e-3
    assert got[200]["score"] == got[150]["score"] == got[151]["score"] and got[200]["neighbours"] == []


def test_examples_are_bounded_in_bytes(spark):
    docs = spark.createDataFrame([(k, "word " * (4000 if k % 50 == 7 else 20)) for k in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)], "doc_id long, toxic int")
    index = build(docs, labels, Nearest(bytes=16_000), Scratch(spark, "toxicity"))
    ids = [k for side in index.sides for k in side.ids.tolist()]
    assert 100 < len(ids) <= 160 and not any(k % 50 == 7 for k in ids)


def test_languages_of_held_out_documents(corpus):
    docs, _ = corpus
    got = identify(docs)
    rows = got.join(docs.select("doc_id", "lang").distinct(), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(rows) > 50 and all(r["lang_pred"] == r["lang"] for r in rows)
    rest = {r["doc_id"]: r for r in got.where("doc_id >= 1000").collect()}
    assert all(rest[k]["lang_pred"] == "und" and rest[k]["score"] == 0 for k in (1000, 1001, 1002))
    assert got.count() == docs.count()


def test_a_mixture_is_told_from_one_language():
    like = np.log(np.array([[0.9, 0.05, 0.05]] * 60 + [[0.05, 0.9, 0.05]] * 40 + [[0.9, 0.05, 0.05]] * 100))
    share, chosen = mixtures(like, np.array([0, 100, 200]), Mixture())
    assert chosen[0].tolist() == [True, True, False] and abs(share[0, 0] - 0.6) < 0.05
    assert chosen[1].tolist() == [True, False, False] and share[1, 0] > 0.99


def test_a_ranker_without_both_labels_says_the_same_of_all():
    x = np.random.default_rng(0).random((20, 3))
    for y in (np.ones(20, int), np.zeros(20, int)):
        assert len(set(Ranker(x, y, Ranking()).score(x))) == 1
    assert len(Ranker(np.zeros((0, 3)), np.zeros(0, int), Ranking()).score(x)) == 20


def test_nothing_to_learn_from(spark, corpus):
    docs, labels = corpus
    none = labels.limit(0)
    assert {r["score"] for r in score_toxicity(docs, none).collect()} == {0.0}
    assert len({r["score"] for r in rank_quality(docs, none).collect()}) == 1
    assert {r["lang_pred"] for r in identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    for work in (lambda d: score_toxicity(d, labels), lambda d: rank_quality(d, labels), identify):
        assert work(docs.limit(0)).count() == 0


def page(k: int, body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>T{k}</title><style>p{{}}</style><script>var t=\"</p>\";</script></head><body>{body}</body></html>"


def test_main_text_of_a_site(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for k in range(30):
        first, second = corpora.prose(rng, 30), corpora.prose(rng, 20)
        furniture = f"<nav><ul><li><a href='/{k}'>{corpora.prose(rng, 1)}</a></ul></nav><div class='box3'>All rights reserved here</div>"
        body = f"{furniture}<div class=text{k}><h2>Head {k}</h2><p>{first} &amp; <b>more<br><p>{second}</div><div id='comments'><p>{corpora.prose(rng, 9)}</div><footer>&copy; {k}</footer>"
        rows.append((k, f"https://User@Site.example:80/{k}", page(k, body), "x"))
        want[k] = f"Head {k}\n{first} & more\n{second}"
    rows += [(90, None, "<article><h1>A</h1><p>b &lt; c</p><div class=share>no</div></article><p>out", "x"), (91, "http://a.example/", None, "x"), (92, "nonsense", "", "x"), (93, "http://b.example", "<p>only <i>te</i>xt\n\n here <script>x", "x")]
    want |= {90: "A\nb < c", 91: "", 92: "", 93: "only text here"}
    got = extract(spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string, host string"), carry=("page_id", "url", "host")).collect()
    assert len(got) == len(rows) + 1
    assert {r["page_id"]: r["text"] for r in got} == want
    assert spark.createDataFrame([("https://User@Site.example:80/1",), ("x",), (None,)], "u string").select(host_of(F.col("u")).alias("h")).collect() == [("site.example",), (None,), (None,)]
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


BODY = "<h1>The head</h1><p>This is the first paragraph of the text.</p><p>And this one is the second, a little longer.</p>"
TEXT = "The head\nThis is the first paragraph of the text.\nAnd this one is the second, a little longer."
AROUND = "<nav><ul><li><a href='/'>Home</a><li><a href='/b'>News</a></ul></nav>{}<div class='sidebar'>Read more</div><footer>All rights</footer>"


@pytest.mark.parametrize("body", [
    f"<body class='page has-sidebar'>{AROUND.format(BODY)}</body>",
    f"<body class='page has-sidebar'>{AROUND.format('<article>' + BODY + '</article>')}</body>",
    f"<body><div id='content' class='with-sidebar'>{BODY}</div></body>",
    f"<body>{AROUND.format('<div class=with-sidebar>' + BODY + '</div>')}</body>",
    f"<body><form id='aspnetForm'>{AROUND.format(BODY)}</form></body>",
    f"<body><form id='aspnetForm'>{AROUND.format('<main>' + BODY + '</main>')}<button>Send</button></form></body>",
    f"<body>{AROUND.format('<main><section class=social-history>' + BODY + '</section></main>')}</body>",
    f"<body><article><header class='entry-header'>{BODY.replace('</h1>', '</h1></header>')}</article></body>",
    f"<body>{AROUND.format('<article class=teaser><p>Another text</p></article><div class=text>' + BODY + '</div>')}</body>",
    f"<body class='comments-open'><div class='modal'><form>{AROUND.format('<article>' + BODY + '</article>')}</form></div></body>",
])
def test_names_of_wrappers_do_not_empty_a_page(body):
    assert main_text(f"<!DOCTYPE html><html class='nav-open'><head><title>T</title></head>{body}</html>", {}, SiteTree()) == TEXT


def test_an_article_beside_the_text_is_not_all():
    page = f"<article><p>Short words</p></article><div>{BODY}</div>"
    assert main_text(page, {}, SiteTree()) == f"Short words\n{TEXT}"


@pytest.mark.parametrize("body", [
    "<article><p>Short.</p></article><div class='comments'><p>" + "A long comment. " * 30 + "</p></div>",
    "<article><p>Short.</p></article><section id='comment-list'><p>" + "A long comment. " * 30 + "</p></section>",
    "<article><p>Short.</p><form><p>" + "Say what you think. " * 30 + "</p></form></article>",
    "<article><p>Short.</p></article><form><p>" + "Say what you think. " * 30 + "</p></form>",
    "<p>Short.</p><footer><p>" + "All rights reserved. " * 30 + "</p></footer>",
    "<p>Short.</p><aside><p>" + "Read this too. " * 30 + "</p></aside>",
])
def test_furniture_longer_than_the_text_goes(body):
    assert main_text(f"<html><body>{body}</body></html>", {}, SiteTree()) == "Short."


@pytest.mark.parametrize("body", ["<nav><a href='/'>Home</a></nav>", "<form>Name <input> <button>Send</button></form>", "<div class='comments'><p>Well said.</p></div>", "<footer>All rights</footer>"])
def test_a_page_of_furniture_has_no_text(body):
    assert main_text(f"<html><body>{body}</body></html>", {}, SiteTree()) == ""


def test_importances_are_those_of_a_plain_count(spark):
    rng = random.Random(4)
    pages = []
    for k in range(60):
        host = f"{'abc'[rng.randrange(3)]}.example"
        parts = [f"<div class='{rng.choice(['x', 'y', f'post-z{chr(97 + k % 26)}{k}'])}'><p>{rng.choice(['one', 'two', str(k)])}</p></div>" for _ in range(rng.randrange(4))]
        pages.append((host, "<body>" + "".join(parts) + "<footer>same</footer></body>"))
    seen: dict[tuple[str, int, int], Counter] = {}
    for host, html in pages:
        nodes, blocks = parse(html, SiteTree())
        texts: dict[int, set] = {}
        looks: dict[int, set] = {}
        for n in nodes:
            if n.children or not n.blocks:
                looks.setdefault(n.key, set()).add(tuple(n.style))
        for at, text in blocks:
            texts.setdefault(nodes[at].key, set()).add(text)
        for kind, found in ((0, looks), (1, texts)):
            for key, features in found.items():
                for f in features:
                    seen.setdefault((host, key, kind), Counter())[f] += 1
    want: dict[tuple[str, int], float] = {}
    for (host, key, _), number in seen.items():
        m = sum(number.values())
        value = 1.0 if m == 1 else max(0.0, -sum(n / m * math.log(n / m) for n in number.values()) / math.log(m))
        want[host, key] = max(want.get((host, key), 0.0), value)
    got = {(r["host"], x["node"]): x["importance"] for r in importances(spark.createDataFrame(pages, "host string, html string"), SiteTree()).collect() for x in r["nodes"]}
    assert got.keys() <= want.keys() and len(got) > 10
    assert all(abs(got.get(k, 1.0) - v) < 1e-9 for k, v in want.items())


def test_a_text_shared_by_all_pages_stays_if_there_is_no_other():
    assert main_text("<article><p>same</p></article>", {}, SiteTree()) == "same"
