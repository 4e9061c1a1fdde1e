"""Language ID by held-out accuracy, main text on written pages, passages by brute force."""

import hashlib
import random
from collections import Counter

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import htmltext, langid, suffixdedup

# --- language ---

WORDS = {
    "en": "the and of house water tree which would have been with this from they".split(),
    "de": "der und die das haus wasser baum welche würde haben gewesen mit dieser schön".split(),
    "fr": "le et la maison eau arbre lequel aurait été avec cette elles être où".split(),
}


def sentences(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows = [(i, sentences(rng, lang, rng.randint(4, 60)), lang, "s", 1) for i in range(240) for lang in [list(WORDS)[i % 3]]]
    return spark.createDataFrame(rows, cases.DOCS)


def test_held_out_accuracy(labelled):
    held_out = langid.fold("doc_id") == 0
    model = langid.fit(labelled.filter(~held_out), per_language=50)
    assert len(model.languages) == 9 and 0 < model.reject_below < 1
    rows = langid.identify(labelled.filter(held_out).drop("lang", "source"), model).join(labelled.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 20 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 and not r["rejected"] for r in rows)


def test_fold_is_crc32_of_the_id(spark):
    import zlib

    rows = spark.range(50).select("id", langid.fold("id").alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)


def test_language_cases(spark, labelled):
    model = langid.fit(labelled)
    numerals = [(91 + i, c * 3, None, None, 3) for i, c in enumerate("½²Ⅷ①٣五")]
    docs = cases.with_clashes(cases.documents(spark, [(90, "дом и вода", None, None, 1), *numerals]), "lang_pred", "score")
    rows = langid.identify(docs, model).collect()
    assert len(rows) == 10 + len(numerals)
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert r["lang_pred"] in {*WORDS, "und"}
    foreign = next(r for r in rows if r["doc_id"] == 90)
    assert foreign["rejected"] and foreign["score"] < model.reject_below
    nothing = langid.fit(cases.empty(labelled))
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(cases.empty(docs), model).count() == 0
    first, second = langid.fit(labelled), langid.fit(labelled.repartition(7))
    assert (first.centroids == second.centroids).all() and first.languages == second.languages


# --- html ---

PAGE = (
    "<!DOCTYPE html><html><head><title>Menu words here</title><style>p{{}}</style><script>var a='</p>';</script></head><body>"
    "<nav><ul><li><a href='/a'>One</a></li><li><a href='/b'>Two</a></li></ul></nav><div class='ad'>Buy this now please.</div>"
    "<{tag}><h1>{title}</h1><p>{body}</p>{inner}</{tag}><aside>See also that.</aside><footer>&copy; somebody 2024</footer></body></html>"
)


def page(rng, tag="article", inner=""):
    words = lambda n: " ".join(rng.choice(WORDS["en"]) for _ in range(n))
    title, body = words(6), words(rng.randint(30, 200))
    return PAGE.format(tag=tag, title=title, body=body, inner=inner), f"{title} {body}"


@pytest.fixture(scope="module")
def weights():
    rng = random.Random(2)
    return htmltext.fit([page(rng)[0] for _ in range(40)])


main_text = htmltext.main_text


@pytest.mark.parametrize("tag", ["article", "div"])
def test_region_is_the_article(weights, tag):
    rng = random.Random(3)
    for _ in range(20):
        html, text = page(rng, tag)
        assert main_text(html, weights) == text


def test_left_out_inside_the_region(weights):
    rng = random.Random(4)
    inner = "<form>Your mail <input name=x></form><div class='comments'>nice <div>post</div></div><script>x='<p>'</script><!-- no --><p>end &amp;&eacute;&#33; <b>b</b>old&nbsp;x</p>"
    html, text = page(rng, inner=inner)
    assert main_text(html, weights) == f"{text} end &é! bold x"


@pytest.mark.parametrize("html,text", [
    ("", ""), ("just words here", "just words here"), ("<p>a < b and <br>c", "a < b and c"), ("<script>never closed", ""),
    ("<!-- never closed", ""), ("<p", "<p"), ("<div title=\"a>b\">x</div>", "x"),
])
def test_broken_pages(html, text):
    assert main_text(html, htmltext.fit([])) == text


@pytest.mark.parametrize("name,stays", [
    ("related-work", True), ("social-history", True), ("commentary", True), ("social", False), ("related-posts", False),
    ("social-links", False), ("commentlist", False), ("disqus_thread", False), ("respond", False), ("post-comments", False)])
def test_names_of_parts(weights, name, stays):
    page = f"<article><p>{'main words ' * 40}</p><div class='{name}'><p>{'part of it ' * 30}</p></div><p>{'more words ' * 40}</p></article>"
    assert ("part of it" in htmltext.main_text(page, weights)) == stays


@pytest.mark.parametrize("tag", ["noscript", "svg", "select", "iframe", "form", "nav"])
def test_unclosed_elements_hold_nothing(weights, tag):
    assert htmltext.main_text(f"<p>a &lt; b</p><{tag}><p>and the rest</p>", weights) == "a < b and the rest"
    assert htmltext.main_text("<p>a</p><script>b <p>c</p>", weights) == "a"


@pytest.mark.parametrize("unit", ["<form>", "<svg>", "</form>", "<nav><p>x</p></nav>", "<div class='comments'>", "<article>", "<p>a"])
def test_very_many_tags_are_linear(weights, unit):
    import time

    start = time.time()
    htmltext.main_text(unit * 100_000, weights)
    assert time.time() - start < 30


def test_best_stretch():
    rng = random.Random(5)
    for _ in range(200):
        s = [rng.randint(-5, 5) for _ in range(rng.randint(0, 12))]
        a, b = htmltext.best_stretch(s)
        best = max((sum(s[i:j]) for i in range(len(s)) for j in range(i, len(s) + 1)), default=0)
        assert sum(s[a:b]) == max(0, best)


def test_extracted_table(spark, weights):
    html, text = page(random.Random(6))
    rows = [(1, "u", html), (2, None, None), (3, "u", ""), (None, "u", html), (4, "u", "<p>" + "word " * 50000 + "</p>")]
    pages = cases.with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string"), "text")
    got = {r["page_id"]: r for r in htmltext.extract(pages, weights).collect()}
    assert got[1]["text"] == got[None]["text"] == text and got[1]["n_chars"] == len(text)
    assert got[2]["text"] == got[3]["text"] == "" and got[2]["n_chars"] == 0 and got[4]["n_chars"] == 5 * 50000 - 1
    assert htmltext.extract(cases.empty(pages), weights).count() == 0
    assert htmltext.labelled_sample(pages, rows=1) == [html] and htmltext.labelled_sample(cases.empty(pages)) == []


# --- passages ---


def brute(texts, length=suffixdedup.LENGTH):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        mark = np.zeros(len(r) + 1, int)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                mark[i] += 1
                mark[i + length] -= 1
        on = np.cumsum(mark)[:-1] > 0
        runs = int((np.diff(np.concatenate([[0], on.astype(int)])) == 1).sum())
        out.append((len(r), int(on.sum()), runs, bytes(np.frombuffer(r, np.uint8)[~on])))
    return out


def made_texts(seed, n=110):
    rng = random.Random(seed)
    letters = lambda alphabet, k: "".join(rng.choice(alphabet) for _ in range(k))
    base = [letters("abcdefgh é", 900) for _ in range(5)]
    texts: list[str | None] = [None, "", "x"]
    for _ in range(n):
        kind, b = rng.random(), rng.choice(base)
        if kind < 0.2:
            texts.append(b)
        elif kind < 0.5:
            j = rng.randrange(900)
            texts.append(b[:j] + rng.choice("xyzü") + b[j:])
        elif kind < 0.7:
            x = rng.randrange(600)
            texts.append(letters("klmn", 300) + b[x:x + rng.choice([150, 198, 199, 200, 201, 210, 300])] + letters("op", 100))
        elif kind < 0.8:
            texts.append("a" * rng.choice([0, 199, 200, 201, 500]))
        elif kind < 0.9:
            texts.append("abc" * rng.choice([66, 67, 70, 200]))
        else:
            texts.append(b[:rng.randrange(900)] * 2)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_against_brute_force(spark, seed):
    texts = made_texts(seed)
    docs = cases.with_clashes(spark.createDataFrame(
        [(i, t, "en", "s", 1) for i, t in enumerate(texts)], cases.DOCS), "n_removed", "raw", "cover", "keep", "_row")
    rows = suffixdedup.repeated_bytes(docs).collect()
    want = {i: (n, k, runs, hashlib.sha256(left).hexdigest()) for i, (n, k, runs, left) in enumerate(brute(texts))}
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows} == want
    assert len(rows) == len(texts) and {r["keep"] for r in rows} == {"clash"}


def test_removed_text(spark):
    texts = made_texts(3, 40)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], cases.DOCS)
    got = {r["doc_id"]: r["text"] for r in suffixdedup.remove(docs).collect()}
    for i, (t, (_, _, _, left)) in enumerate(zip(texts, brute(texts))):
        assert got[i] == (None if t is None else left.decode("utf-8", "ignore"))


def test_passage_cases(spark):
    docs = cases.documents(spark)
    rows = suffixdedup.repeated_bytes(docs).collect()
    texts = [r["text"] for r in docs.collect()]
    assert Counter((r["n_bytes"], r["n_removed"], r["n_spans"]) for r in rows) == Counter(b[:3] for b in brute(texts))
    assert suffixdedup.repeated_bytes(cases.empty(docs)).count() == 0
    assert suffixdedup.remove(cases.empty(docs)).count() == 0
    assert suffixdedup.remove(docs).columns == docs.columns


def test_anchor_blocks_cover_every_window_once():
    rng = random.Random(9)
    for alphabet in ("ab", "a", "abcdefghijklmnop"):
        raw = "".join(rng.choice(alphabet) for _ in range(1500)).encode()
        anchor, lo, hi = suffixdedup.Text(raw).blocks()
        starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(lo, hi)])
        assert (starts == np.arange(1500 - suffixdedup.LENGTH + 1)).all()
        assert (anchor >= hi).all() and (anchor + suffixdedup.GRAM <= lo + suffixdedup.LENGTH).all()
        packed = suffixdedup._pack(anchor, lo, hi)
        assert all((x == y).all() for x, y in zip(suffixdedup._unpack(packed), (anchor, lo, hi)))
        for size in (16, 4, 1):
            _, _, at = suffixdedup._refine(suffixdedup.Text(raw), packed, size)
            _, a, b = suffixdedup._unpack(at)
            assert sorted(i for x, y in zip(a, b) for i in range(x, y + 1)) == starts.tolist()


def test_languages_of_a_skewed_table(spark, labelled):
    hot = labelled.unionByName(labelled.filter("lang = 'en'").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(9)))).drop("n"))
    assert set(langid.fit(hot, per_language=20).languages) == set(WORDS)


def test_latin_script_that_was_not_learned_is_rejected(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rng = random.Random(7)
    finnish = "talo vesi kissa juoksee metsässä hyvä päivää minä olen kaunis järvi yö aurinko paistaa taivaalla lapset pihalla".split()
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, " ".join(rng.choice(finnish) for _ in range(60))) for i in range(20)]
    rows += [(20 + i, "".join(rng.choice(letters) for _ in range(300))) for i in range(20)]
    rows += [(40 + i, "".join(rng.choice("0123456789abcdef") for _ in range(1000))) for i in range(20)]
    # A dozen labelled tokens far from everything must not lower the bound of longer texts.
    tokens = [(10**6 + i, "".join(rng.choice(letters) for _ in range(4)), "en") for i in range(12)]
    model = langid.fit(docs.select("doc_id", "text", "lang").union(spark.createDataFrame(tokens, "doc_id long, text string, lang string")))
    odd = langid.identify(spark.createDataFrame(rows, "doc_id int, text string"), model).collect()
    assert all(r["rejected"] for r in odd)
    clean = [(i, " ".join(r["text"].split()[:6])) for i, r in enumerate(docs.filter("n_chars > 500").limit(100).collect())]
    short = langid.identify(spark.createDataFrame(clean, "doc_id int, text string"), model).collect()
    assert sum(r["rejected"] for r in short) <= 2


def test_copies_of_one_text_take_one_place_of_the_sample(spark, labelled):
    # The German text with the smallest hash, 2,000 times: all its copies pass the cut by hash.
    first = labelled.filter("lang = 'de'").orderBy(F.shiftrightunsigned(F.xxhash64("text"), 11)).limit(1)
    hot = labelled.unionByName(first.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(2000)))).drop("n"))
    alone, crowded = langid.fit(labelled, per_language=20), langid.fit(hot, per_language=20)
    german = [i for i, lang in enumerate(crowded.languages) if lang == "de"]
    assert len(german) == 3 and np.allclose(alone.centroids, crowded.centroids, atol=1e-5)
