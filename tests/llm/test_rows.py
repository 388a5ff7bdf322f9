"""Operators that judge rows one by one: brute force, held-out accuracy and edge cases."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from leadloom.llm import decontaminate, gru, html, language, lm, quality, urls
from leadloom.llm.shared import fold, table
from tests.conftest import SF
from tests.llm.cases import documents, empty

MID = SF.replace("0.001", "0.01")
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_hits(text, items, window=10):
    words = _WORD.findall((text or "").translate(_LOW))
    hit, names = set(), set()
    for name, item in items:
        own = _WORD.findall((item or "").translate(_LOW))
        size = min(window, len(own))
        windows = {tuple(own[j : j + size]) for j in range(len(own) - size + 1)} if size else set()
        for j in range(len(words) - size + 1):
            if tuple(words[j : j + size]) in windows:
                hit.update(range(j, j + size))
                names.add(str(name))
    sha = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return len(words), len(hit), len(names), sha, bool(hit)


@pytest.mark.parametrize("block_chars", [4_000_000, 60])
def test_decontamination_edges(spark, block_chars):
    items = [(1, "the cat sat"), (2, None), (3, ""), (10, " ".join(f"w{i}x" for i in range(30))), (11, "Öl"), (1, "mat it")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark)
    found = decontaminate.report(docs, bench, block_chars=block_chars).collect()
    want = sorted(plain_hits(r["text"], items) for r in docs.collect())
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted(tuple(r[n] for n in names) for r in found) == want
    assert decontaminate.clean(docs, bench).count() == sum(not w[4] for w in want)
    assert decontaminate.report(empty(spark), bench).count() == 0
    assert decontaminate.clean(docs, bench.limit(0)).count() == 12


def test_html():
    page = (
        "<html><head><title>t</title></head><body><header>top</header><nav><a href=x>menu</a></nav>"
        "<div class='cookie-notice'>We use cookies, yes, really, all of them.</div><article><h1>Title</h1>"
        "<p>One, two &amp;\n three.<p><b>Four.<br>Five</b></p><script>if (a<b) {}</script></article>"
        "<section id=comments><p>first, second, third, a comment</p></section><form>f</form>"
        "<aside>side</aside><footer>foot</footer></body></html>"
    )
    assert html.main_text(page) == "Title\n\nOne, two & three.\n\nFour. Five"
    for odd in (None, "", "<", "<p", "</", "<!--", "<a href='x", "<div>" * 5000 + "deep"):
        assert isinstance(html.main_text(odd), str)


def test_html_keeps_whole_articles():
    text = "".join(f"<p>Sentence {k}, with a comma, in the article.</p>" for k in range(40))
    plain = html.main_text(f"<body>{text}</body>")
    assert plain.count("Sentence") == 40
    names = ("content has-sidebar", "right-sidebar", "no-comments", "comments-open", "article-print", "job-search", "main-content print", "widget", "sidebar")
    for name in names:
        assert html.main_text(f"<body><div id='x' class='{name}'>{text}</div></body>") == plain, name
    beside = "<div><p>Short one.</p><p>Two.</p><p>Three.</p></div><ul><li>item</li></ul><h3>Head</h3><pre>code</pre><table><tr><td>cell</td></tr></table>"
    page = f"<body><div class=nav><a href=x>menu</a></div><div><div>{text}</div>{beside}<div><a href=x>more links</a></div></div></body>"
    assert html.main_text(page) == plain + "\n\nShort one.\n\nTwo.\n\nThree.\n\nitem\n\nHead\n\ncode\n\ncell"
    assert html.main_text("<body><div class=comments><p>Only this.</p></div></body>") == "Only this."


def test_pages(spark):
    pages = table(spark, SF, "pages")
    found = {r["page_id"]: r for r in html.extract(pages).collect()}
    for r in pages.collect():
        text = found[r["page_id"]]["text"]
        article = r["html"].split("<article>")[1].split("</article>")[0]
        assert text and found[r["page_id"]]["n_chars"] == len(text)
        assert text.split("\n\n")[0] == html.unescape(re.sub("<[^>]*>", "", article.split("</h1>")[0])).strip()
    rows = [(1, None, None), (1, "u", ""), (None, "u", "<p>x</p>")]
    clash = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")
    assert sorted(r["text"] for r in html.extract(clash).collect()) == ["", "", "x"]


def test_urls(spark):
    rows = [None, "", "no scheme casino", "http://www.example.com/en/x", "http://EXAMPLE.com/en/", "https://a.net/es/1",
            "http://x.org/cheap-pills", "http://x.org/cheapest-pills", "http://casinos.org", "http://my-casino.org?q", "http://a.com"]
    frame = spark.createDataFrame([(i, u, 1) for i, u in enumerate(rows)], "page_id long, url string, host int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(frame).collect()}
    assert got[0] == got[1] == ("", "", None, "allow") and got[2][3] == "block"
    assert got[3] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[4][2:] == ("example.com/en/", "block") and got[5][2:] == ("net/es/", "block")
    assert [got[k][3] for k in (6, 7, 8, 9, 10)] == ["block", "allow", "allow", "block", "allow"]
    assert got[10][2] is None


def test_urls_soft_terms_and_edges(spark):
    rows = [(1, "http://a.org/buy/click/"), (1, "http://a.org/buy/click/"), (2, "http://a.org/buy/buy"),
            (None, "http://a.org/buyer/click"), (4, "http://a.org/" + "x" * 1_000_000 + "/hot-deal")]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    got = sorted((str(r["page_id"]), r["verdict"], r["soft_terms"]) for r in urls.judge(frame).collect())
    assert got == [
        ("1", "block", ["buy", "click"]), ("1", "block", ["buy", "click"]), ("2", "allow", ["buy"]),
        ("4", "block", ["deal", "hot"]), ("None", "allow", ["click"]),
    ]
    least = min(urls.SOFT.values())
    assert urls.LEAST_SOFT * least >= urls.LEAST_WEIGHT
    assert urls.judge(frame.limit(0)).count() == 0


def test_language(spark):
    docs = table(spark, MID, "documents")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.98 * len(found)
    odd = {r["doc_id"]: r for r in language.identify(documents(spark)).collect()}
    assert {odd[k]["lang_pred"] for k in (3, 4, 5, 7)} == {"und"} and len(odd) == 11
    assert language.identify(empty(spark)).count() == 0
    unknown = language.identify(documents(spark).withColumn("lang", language.F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unknown.collect()} == {"und"}
    many = language.codewords(30)
    assert min((a != b).sum() for k, a in enumerate(many) for b in many[:k]) >= 10


def test_quality(spark):
    docs, labels = table(spark, MID, "documents"), table(spark, MID, "labels")
    found = quality.score(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in found) >= 0.95 * len(found)
    marked = spark.createDataFrame([(1, 1), (2, 1), (6, 0), (None, 1)], "doc_id long, quality int")
    odd = quality.score(documents(spark), marked).collect()
    assert len(odd) == 12 and all(0 <= r["score"] <= 1 for r in odd)
    assert np.isfinite(quality.features("x" * 600_000)).all()


def test_language_model(spark):
    docs = table(spark, SF, "documents")
    found = {r["doc_id"]: r for r in lm.score(docs, head=500, train_tokens=60_000).collect()}
    rows = docs.withColumn("held", fold(language.F.col("doc_id"), 10) == 0).collect()
    counts = Counter()
    for r in rows:
        if not r["held"]:
            counts.update(lm.words(r["text"]))
    total, distinct = sum(counts.values()), len(counts)
    for r in rows:
        own, tokens = found[r["doc_id"]], lm.words(r["text"])
        base = sum(np.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens)
        assert own["held_out"] == r["held"] and own["train_tokens"] == total
        assert own["n_tokens"] == len(tokens) and own["n_known"] == sum(w in counts for w in tokens)
        assert own["base_score"] == pytest.approx(base, abs=1e-6)
    out = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    odd = lm.score(documents(spark)).collect()
    assert len(odd) == 12 and all(np.isfinite(r["score"]) for r in odd)
    assert lm.score(empty(spark)).count() == 0


@pytest.mark.parametrize("tokens", [1_500_000, 2_000])
def test_network_learns_from_all_documents(spark, tokens):
    docs = documents(spark, [(k, f"alpha{k} beta{k} gamma{k} delta{k} " * 60, "en", "a", 1) for k in range(40)])
    known = lm.vocabulary(lm.word_counts(docs))
    keyed = docs.withColumns({"held_out": language.F.lit(False), "turn": language.F.xxhash64("text")})
    weights = lm.fit(lm.encode(keyed, known), known, tokens)
    moved = (weights.enter != gru.start(known.layout).enter).any(axis=1)
    assert known.layout.words == 161 and moved[: known.layout.words].sum() >= 160
    # More than one round, and yet each word predicts the next one better than its frequency does.
    texts = [known.inputs[[known.number[w] for w in lm.words(r["text"])]] for r in docs.collect()]
    found = gru.score(weights, known.layout, texts, known.end).sum()
    assert found > gru.score(gru.start(known.layout), known.layout, texts, known.end).sum()


def test_class_prior_counts_all_texts(spark):
    """The shares above the thresholds are those over all texts, in any number of tasks."""
    docs = table(spark, MID, "documents").select("doc_id", "text").repartition(5)
    rng = np.random.default_rng(2)
    net = quality.Net(
        np.zeros(quality.WIDTH), np.ones(quality.WIDTH), rng.normal(0, 0.3, (quality.WIDTH, 3)),
        np.zeros(3), rng.normal(0, 1, 3), np.zeros(1),
    )
    values = net.raw(np.array([quality.features(r["text"]) for r in docs.collect()]))
    thresholds = np.quantile(values, [0.0, 0.33, 0.9])
    counts, n = quality._counts_above(docs, net, thresholds)
    assert n == len(values) and counts.tolist() == [(values >= t).sum() for t in thresholds]
    assert quality._counts_above(docs.limit(0), net, thresholds)[1] == 0
    # About three quarters of the given documents are good; a small sample finds the same.
    labels = table(spark, MID, "labels")
    share = labels.agg({"quality": "avg"}).first()[0]
    for sample in (20_000, 200):
        model = quality.fit(*quality.training_rows(docs, labels, 3, 1, sample), sample)
        assert abs(model.prior - share) < 0.15, (model.prior, share, sample)
    assert {r["score"] for r in quality.score(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score(docs.limit(0), labels).count() == 0
