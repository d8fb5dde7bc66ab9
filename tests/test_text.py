import random
import re

import pytest
from pyspark.sql import functions as F

from textloom.functions import hashing
from textloom.functions import text as tx
from textloom.sources import text as src


def python_words(value):
    return re.findall(r"\w+", value.lower())


def test_words_equal_python_on_all_documents(spark, documents):
    odd = ["Straße ÉCOLE x_y 12a", "日本語 テスト", "áb", "½ ² ٣", "", "___", "don't stop"]
    rows = documents.select("text").unionByName(spark.createDataFrame([(t,) for t in odd], "text string"))
    for row in tx.with_words(rows).collect():
        assert row.words == python_words(row.text)


@pytest.mark.parametrize(
    "words,keep",
    [
        (["ab"] * 19, False),
        (["ab"] * 20, True),
        (["a"] + ["ab"] * 39, False),
        (["a" * 10] * 20, True),
        (["a" * 10] * 20 + ["a" * 11], False),
        (["é_"] * 20, True),
        ([], False),
    ],
)
def test_quality_limits(spark, words, keep):
    df = spark.createDataFrame([(words,)], "words array<string>")
    assert df.filter(tx.quality_ok(F.col("words"))).count() == int(keep)


def test_shingles(spark):
    df = spark.createDataFrame([(1, list("abcdefabcde")), (2, list("abcd")), (3, list("abcde")), (4, [])], "id int, w array<string>")
    got = {r.id: set(r.s) for r in df.select("id", tx.shingles(F.col("w"), 5).alias("s")).collect()}
    words = "abcdefabcde"
    assert got[1] == {" ".join(words[i : i + 5]) for i in range(7)}
    assert got[2] == set() and got[3] == {"a b c d e"} and got[4] == set()


def test_blank_and_strip_follow_python(spark):
    values = ["", " ", "\n\t", "  ", "\x1c\x1f", "a", " a ", "​", "\n x y \n"]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    for row in df.select("t", tx.is_not_blank(F.col("t")).alias("b"), tx.strip(F.col("t")).alias("s")).collect():
        assert row.b == bool(row.t.strip()), repr(row.t)
        assert row.s == row.t.strip(), repr(row.t)


RAW = "id int, text string, content string, language string, lang string, language_score string, metadata struct<language:string,lang:string,language_score:string>"


def test_language_filter_order_and_defaults(spark):
    rows = [
        (1, "t", None, "en", None, None, None),
        (2, "t", None, None, "de", None, None),
        (3, "t", None, None, "de", None, ("en", None, None)),
        (4, "t", None, None, None, "0.9", None),
        (5, "t", None, None, None, "0.8999", None),
        (6, "t", None, None, None, "high", None),
        (7, "t", None, None, None, None, (None, "fr", None)),
        (8, "t", None, None, None, None, ("en", "fr", "0.95")),
        (9, "t", None, "en", "fr", None, ("fr", None, None)),
        (10, "t", None, None, None, "nan", None),
    ]
    df = spark.createDataFrame(rows, RAW)
    assert {r.id for r in tx.language_filter(df, "en", 0.9).collect()} == {1, 3, 4, 8, 9}


def test_language_predicate_reaches_the_scan(documents):
    plan = tx.language_filter(documents, "en")._jdf.queryExecution().executedPlan().toString()
    assert "Or(EqualTo(lang,en),IsNull(lang))" in plan


def test_metadata_as_map(spark):
    df = spark.createDataFrame([(1, {"lang": "fr"}), (2, {"x": "y"}), (3, None)], "id int, metadata map<string,string>")
    got = {r.id: r.v for r in df.select("id", tx.first_present(df.schema, ["language", "lang"], "en").alias("v")).collect()}
    assert got == {1: "fr", 2: "en", 3: "en"}


def test_text_field_falls_back(spark):
    rows = [(1, "t", "c", None, None, None, None), (2, "t", "", None, None, None, None), (3, " ", None, None, None, None, None)]
    got = src.text_rows(spark.createDataFrame(rows, RAW), "content").orderBy("id").collect()
    assert [(r.id, r.text) for r in got] == [(1, "c"), (2, "t")]


def test_source_fallback(spark, tmp_path):
    good = str(tmp_path / "good")
    spark.createDataFrame([(1, "hello", "en")], "doc_id int, text string, lang string").write.parquet(good)
    readers = [src.table(str(tmp_path / "none")), src.table(good)]
    assert src.text_source(spark, readers).count() == 1
    assert src.text_source(spark, readers, language="fr", smoke_rows=7).count() == 7
    lines = str(tmp_path / "lines")
    spark.createDataFrame([("one",), ("",)], "value string").write.text(lines)
    assert [r.text for r in src.text_source(spark, [src.table(lines, "text")]).collect()] == ["one"]


def test_smoke_corpus_cycles(spark):
    rows = src.smoke_corpus(spark, 9).orderBy("doc_id").collect()
    assert rows[0].text == rows[4].text == rows[8].text and len({r.text for r in rows}) == 4


def test_chat_and_preference_fallback(spark, conversations):
    assert src.chat_source(spark, [], "conv_id").first().instruction
    assert src.preference_source(spark, [], "conv_id").first().chosen
    reader = lambda s: src.conversation_messages(conversations)
    assert src.chat_source(spark, [reader], "conv_id", 3).count() == 3


def test_affine_signature_equals_direct_minima(spark):
    rng = random.Random(1)
    docs = [(i, ["".join(rng.choice("abcde") for _ in range(3)) for _ in range(n)]) for i, n in enumerate([0, 4, 5, 30, 0, 200])]
    df = spark.createDataFrame(docs, "id int, w array<string>")
    hashes = df.select("id", hashing.shingle_hashes(F.col("w"), 5).alias("h"))
    rows = hashes.select("id", "h", hashing.affine_signature(F.col("h"), 16).alias("sig")).collect()
    for r in rows:
        expected = [min(((a * h + b) % hashing.PRIME for h in r.h), default=0) for a, b in hashing.affine_parameters(16)]
        assert list(r.sig) == expected


def test_similarity_of_unequal_lengths_is_zero(spark):
    df = spark.createDataFrame([(1, [1, 2, 3, 4], [1, 2, 0, 4]), (2, [1], [1, 2]), (3, [], [])], "id int, a array<int>, b array<int>")
    got = {r.id: r.s for r in df.select("id", hashing.signature_similarity(F.col("a"), F.col("b")).alias("s")).collect()}
    assert got == {1: 0.75, 2: 0.0, 3: 0.0}
