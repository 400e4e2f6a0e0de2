"""Operators that learn: held-out accuracy, and cases by hand."""

import pytest
from corpusloom.llm import extraction, language, toxicity

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    held_out = language.fold_of(docs["doc_id"], 4) == 2
    learned = language.learn(docs.filter(~held_out))
    rows = language.with_language(docs.filter(held_out), learned).select("lang", "lang_pred", "score").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_prediction_rests_on_the_text_alone(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    learned = language.learn(docs)
    a = {r["doc_id"]: r["lang_pred"] for r in language.with_language(docs, learned).collect()}
    changed = docs.selectExpr("doc_id", "text", "'zz' AS lang", "'?' AS source").repartition(5)
    b = {r["doc_id"]: r["lang_pred"] for r in language.with_language(changed, learned).collect()}
    assert a == b


def test_language_of_few_texts_in_many_rows(spark):
    few = [("de", "der hund und die katze"), ("de", "ein haus am see"), ("de", "wir gehen nach hause")]
    many = [("en", f"the dog number {i} and the cat") for i in range(40)]
    skewed = spark.createDataFrame(few * 2000 + many + [("en", "zzz qqq xxx")] * 3000, "lang string, text string")
    learned = language.learn(skewed.repartition(6), per_language=4)
    assert learned.names == ["de", "en"]
    once = language.learn(skewed.distinct(), per_language=4)
    assert abs(learned.units - once.units).max() < 1e-9
    assert abs(learned.units[0] - language.learn(spark.createDataFrame(few, "lang string, text string")).units[0]).max() < 1e-9


def test_toxicity_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held_out = language.fold_of(labels["doc_id"], 5) == 0
    model = toxicity.learn(docs, labels.filter(~held_out))
    rows = toxicity.with_toxicity(docs.join(labels.filter(held_out), "doc_id"), model).select("toxic", "score").collect()
    good, bad = ([r["score"] for r in rows if r["toxic"] == t] for t in (1, 0))
    wins = sum((g > b) + (g == b) / 2 for g in good for b in bad)
    assert wins / len(good) / len(bad) >= 0.93
    assert sum((r["score"] >= 0.5) == r["toxic"] for r in rows) >= 0.97 * len(rows)


@pytest.mark.parametrize(
    ("text", "n"),
    [
        ("you IDIOT!", 1),
        ("you 1d10t", 1),
        ("іdіоt", 1),  # Cyrillic letters
        ("ｉｄｉｏｔ", 1),
        ("an !d!ot", 0),
        ("idi0t$$$ here", 1),
        ("videoidiotic", 0),
        ("idiotic", 1),
        ("the useful idiot speaks", 0),
        ("", 0),
    ],
)
def test_folded_matches(text, n):
    model = toxicity.Model({"idiot": 3.0, "idiot*": 2.0}, frozenset({"usefui idiot"}))
    assert len(model.matches(toxicity.folded(text))) == n


def test_self_labelled_pages_and_their_adverts(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    weights = extraction.learn(pages)
    page = """<html class="no-js has-sidebar"><head><title>t</title><style>p{}</style></head><body>
      <header>Site</header><nav><a href="/">Home</a></nav>
      <article class="post"><header><h1>The
        title</h1></header><p>First &amp; <b>best</b>.<br>Line</p><div class="ad">Buy</div>
        <aside>Read more</aside><form><input><label>Mail</label></form><p>Last.</p>
        <section class="comments"><article class="comment"><p>Reader</p></article></section></article>
      <div class="sidebar">Links</div><footer>&copy; me</footer></body></html>"""
    assert weights.extract(page) == "The title First & best. Line Last."


def test_page_without_landmark(spark):
    weights = extraction.learn(spark.createDataFrame([], "html string"))
    page = '<body><div class="menu">Home News</div><div class="content"><h1>Title</h1><p>Body of text.</p></div><div id="comments">Me too</div></body>'
    assert weights.extract(page) == "Title Body of text."


def test_best_run():
    assert extraction.best_run([-1, 2, -1, 3, -5, 4]) == (1, 4)
    assert extraction.best_run([-1, -2]) == (0, 0) == extraction.best_run([])
    assert extraction.best_run([0, 1, 0, -1, 1]) == (1, 2)
