"""What once was lost without a word: articles of near copies, long rows of a sample, long items of a benchmark."""

import random

import pytest
from pricepanel.llm import decontaminate, html_extract, toxicity
from pyspark.sql import functions as F

PAGES = "page_id long, url string, html string"


def extracted(spark, pages):
    rows = [(i, f"https://{host}/{i}", html) for i, (host, html) in enumerate(pages)]
    return {r["page_id"]: r["text"] for r in html_extract.extract_articles(spark.createDataFrame(rows, PAGES).repartition(3)).collect()}


def article(words, n, rng):
    return [" ".join(rng.choices(words, k=12)) for _ in range(n)]


@pytest.fixture(scope="module")
def words():
    rng = random.Random(8)
    return ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(400)]


def page(title, paragraphs, around=True, inner=""):
    body = f"<article><h1>{title}</h1>{''.join(f'<p>{p}</p>' for p in paragraphs)}{inner}</article>"
    return f"<body><div class='top'>Our daily site</div>{body}<div class='end'>All rights reserved</div></body>" if around else f"<body>{body}</body>"


def test_near_copies_keep_their_article(spark, words):
    rng = random.Random(1)
    same = article(words, 30, rng)
    two = [("two", page("The title", [*same, f"updated {d}"])) for d in ("Monday", "Tuesday")]
    nine = [("nine", page("Copied", [*same, f"edition {i}"])) for i in range(6)] + [("nine", page(f"Own {i}", article(words, 25, rng))) for i in range(3)]
    got = extracted(spark, two + nine)
    for i, day in enumerate(("Monday", "Tuesday")):
        assert got[i].split("\n") == ["The title", *same, f"updated {day}"]
    for i in range(6):
        assert got[2 + i].split("\n") == ["Copied", *same, f"edition {i}"]
    assert all("daily site" not in t and "rights" not in t for t in got.values())


def test_notice_is_no_article(spark):
    pages = [("one", "<div class='cookie-notice'>We use cookies on all pages of this site</div><article><p>body</p></article>"), ("two", "<div class='notice'>A page that is a notice and nothing else at all</div><p>x</p>")]
    got = extracted(spark, pages)
    assert got[0] == "body" and got[1].startswith("A page that is a notice")


def test_comments_and_adverts_inside_an_article(spark, words):
    rng = random.Random(2)
    pages, own = [], []
    for i in range(6):
        own.append(article(words, 8, rng))
        said = "".join(f"<p>{' '.join(rng.choices(words, k=5))}</p>" for _ in range(3))
        pages.append(("host", page(f"T{i}", own[-1], inner=f"<div class='ad'>Buy {rng.choice(words)}</div><section id='comments'>{said}</section>")))
    got = extracted(spark, pages)
    for i, paragraphs in enumerate(own):
        assert got[i].split("\n") == [f"T{i}", *paragraphs]


def test_long_boilerplate_inside_short_articles_goes(spark, words):
    rng = random.Random(3)
    rules = article(words, 4, rng)
    own = [article(words, 3, rng) for _ in range(12)]
    got = extracted(spark, [("host", page(f"T{i}", [*p, *rules])) for i, p in enumerate(own)])
    assert sum(got[i].split("\n") == [f"T{i}", *p] for i, p in enumerate(own)) == 12


def test_one_long_row_does_not_empty_a_class(spark):
    docs = spark.createDataFrame([(i, ("word " * 30_000) if i % 7 == 0 else f"text {i}") for i in range(300)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    rows = toxicity.labelled_sample(docs, labels, "toxic", 1000, max_chars=100_000).collect()
    per_class = {y: [r for r in rows if r["_y"] == y] for y in (0, 1)}
    assert min(map(len, per_class.values())) > 80 and max(len(r["_text"]) for r in rows) < 5_001
    few = toxicity.labelled_sample(docs.where("doc_id % 7 > 0"), labels, "toxic", 1000, max_chars=300).collect()
    for y in (0, 1):
        size = sum(len(r["_text"]) for r in few if r["_y"] == y)
        assert 300 - 9 < size <= 300  # rows are taken as long as one fits


def test_fingerprints_of_long_items(spark):
    rng = random.Random(4)
    arrays = [[rng.getrandbits(64) - (1 << 63) for _ in range(n)] for n in (1, 2, 65_535, 65_536, 70_001)]
    got = [r["f"] for r in decontaminate.with_simhash(spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "i int, a array<long>"), "a", "f").orderBy("i").collect()]
    for f, a in zip(got, arrays, strict=True):
        want = sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in a) > len(a))
        assert f == (want - (1 << 64) if want >> 63 else want)
