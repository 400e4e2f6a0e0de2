"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import contamination, extraction, imatch, jaccard, language, licenses, mixing, repeats, toxicity
from corpusloom.llm.arrow import free_name


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty, long, equal and clashing ones."""
    long = "wort " * 4000 + "ende. " + "lang " * 3000
    passage = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (1, "Nothing here but a few plain words.", "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, None),
        (4, " \n\t ", "de", "b"),
        (5, "?!", "de", ""),
        (6, long, "de", "b"),
        (7, long, "de", "b"),
        (8, f"before {passage} after", "en", None),
        (9, f"Before {passage.upper()} after", "fr", "ü"),
        (9, f"Before {passage.upper()} after", "fr", "ü"),
        (None, "a row without an id", "en", "a"),
        (None, None, None, None),
        (10, "é ü 日本語 text", "es", "c"),
        (11, "x", "es", "c"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    clash = ("score", "found", "mix", "removed", "size", "key", "node", "h", "n", "held", "u", "row", "_score", "licenses")
    for name in clash:
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.filter("false")


@pytest.fixture(scope="session")
def bench(spark):
    return spark.createDataFrame(
        [(1, "one two three four five six seven eight nine ten eleven twelve"), (None, "a row without an id"), (3, None)],
        "item_id bigint, text string",
    )


def test_free_name(odd):
    assert free_name(odd, "score") == "__score" and free_name(odd, "fresh") == "fresh"


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_contamination(odd, nothing, bench, broadcast_bytes):
    out = contamination.with_contamination(odd, bench, broadcast_bytes=broadcast_bytes, name="fresh")
    assert out.columns == [*odd.columns, "fresh"]
    got = {(r["doc_id"], r["text"]): r["fresh"] for r in out.collect()}
    assert out.count() == odd.count()
    assert {k[0] for k, v in got.items() if v["n_hit"]} == {8, 9, None}
    assert got[9, [k[1] for k in got if k[0] == 9][0]]["n_hit"] == 12
    assert got[None, "a row without an id"]["items"] == [""]
    assert got[2, None]["n_words"] == 0
    kept = contamination.decontaminated(odd, bench, broadcast_bytes=broadcast_bytes)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    assert contamination.with_contamination(nothing, bench, broadcast_bytes=broadcast_bytes).count() == 0
    assert contamination.decontaminated(odd, bench.filter("false"), broadcast_bytes=broadcast_bytes).count() == odd.count()


def test_mixing(odd, nothing):
    out = mixing.with_copies(odd)
    assert out.count() == odd.count() and out.columns == [*odd.columns, "_mix"]
    assert all(r["_mix"]["size"] == 0 for r in out.filter("text IS NULL").collect())
    taken = mixing.mixed(odd)
    assert taken.columns == [*odd.columns, "copies"] and taken.filter("text IS NULL").count() == 0
    assert mixing.with_copies(nothing).count() == 0 and mixing.mixed(nothing).count() == 0


def test_jaccard(odd, nothing):
    rows = jaccard.classes(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[7]["class_id"] == 6 and by_id[7]["n_links"] == 1
    assert by_id[9]["n_links"] >= 1 and by_id[2]["n_links"] == 0 and by_id[2]["class_id"] == 2
    kept = jaccard.one_per_class(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()).count("9") <= 1
    assert kept.filter("text IS NULL").count() == 2
    assert jaccard.classes(nothing).count() == 0 and jaccard.one_per_class(nothing).count() == 0


def test_repeats(odd, nothing):
    out = repeats.with_removed(odd, name="fresh")
    assert out.columns == [*odd.columns, "fresh"] and out.count() == odd.count()
    got = {r["doc_id"]: r for r in out.collect()}
    assert bytes(got[6]["fresh"]["kept"]) == b"" and bytes(got[2]["fresh"]["kept"]) == b""
    assert bytes(got[10]["fresh"]["kept"]).decode() == "é ü 日本語 text"
    cut = repeats.without_repeats(odd)
    assert cut.columns == odd.columns
    assert {r["doc_id"]: r["text"] for r in cut.filter("doc_id IN (2, 3, 7)").collect()} == {2: None, 3: "", 7: ""}
    assert repeats.with_removed(nothing).count() == 0 and repeats.without_repeats(nothing).count() == 0


def test_cut_characters(spark):
    text = "日" * 300
    docs = spark.createDataFrame([(1, "a" + text, 301), (2, "b" + text, 301)], "doc_id bigint, text string, n_chars int")
    rows = repeats.without_repeats(docs).orderBy("doc_id").collect()
    assert [(r["text"], r["n_chars"]) for r in rows] == [("a", 1), ("b", 1)]


def test_imatch(odd, nothing):
    out = imatch.with_neighbours(odd, imatch.learn_lexicon(odd))
    assert out.count() == odd.count()
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out.collect())
    assert imatch.with_neighbours(nothing, imatch.learn_lexicon(nothing)).count() == 0
    one = odd.filter("doc_id = 1")
    row = imatch.with_neighbours(one, imatch.learn_lexicon(one)).collect()[0]
    assert row["near_next"] == 1


def test_language(odd, nothing):
    learned = language.learn(odd)
    assert learned.names == ["de", "en", "es", "fr"]
    out = language.with_language(odd, learned, names=("score", "found"))
    assert out.columns == [*odd.columns, "__score", "_found"]
    found = {(r["doc_id"], r["text"]): r["__score"] for r in out.collect()}
    assert found[2, None] == found[3, ""] == found[5, "?!"] == found[4, " \n\t "] == "und"
    assert found[11, "x"] in learned.names
    none = language.learn(nothing)
    assert {r["lang_pred"] for r in language.with_language(odd, none).collect()} == {"und"}
    assert language.with_language(nothing, learned).count() == 0


def test_toxicity(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 0), (6, 0), (8, 1), (8, 0), (9, 1), (None, 1), (10, None)], "doc_id bigint, toxic int")
    model = toxicity.learn(odd, labels)
    out = toxicity.with_toxicity(odd, model)
    assert out.columns == [*odd.columns, "__score"] and out.count() == odd.count()
    assert all(0 <= r["__score"] <= 1 for r in out.collect())
    assert toxicity.kept(odd, model).columns == odd.columns
    silent = toxicity.learn(odd, labels.filter("false"))
    assert toxicity.kept(odd, silent).count() == odd.count()
    assert toxicity.with_toxicity(nothing, model).count() == 0 and toxicity.learn(nothing, labels).lexicon == {}


def test_licenses(odd, nothing):
    out = licenses.with_licenses(odd)
    assert out.columns == [*odd.columns, "_licenses"] and out.count() == odd.count()
    assert licenses.with_licenses(nothing).count() == 0


def test_extraction(spark):
    pages = spark.createDataFrame(
        [(1, None), (2, ""), (3, "no markup at all"), (4, "<!-- open"), (5, "<script>x"), (6, "<p>a < b &amp; c&nbsp;d"), (7, "<div>" * 3000 + "deep")],
        "text bigint, html string",
    )
    out = extraction.with_main_text(pages, extraction.learn(pages))
    assert out.columns == ["text", "html", "_text"]
    got = {r["text"]: r["_text"] for r in out.collect()}
    assert (got[1], got[2], got[3], got[4], got[5]) == ("", "", "no markup at all", "", "")
    assert got[6] == "a < b & c d"
    assert extraction.with_main_text(pages.filter("false"), extraction.learn(pages.filter("false"))).count() == 0


def test_no_column_is_left_over(odd):
    assert not [c for c in repeats.without_repeats(odd).columns if c.startswith("__")]
    assert mixing.mixed(odd).select(F.count("*")).first()[0] >= 1
