import pytest
from pyspark.sql import functions as F

from textmill.functions import numbers as N
from textmill.functions import strings as S
from textmill.functions import text as X


def value(spark, text, make):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(make(F.col("t")).alias("v")).collect()[0].v


@pytest.mark.parametrize(
    "url, stem",
    [
        ("http://h/files/12-0.txt", "12-0"),
        ("http://h/a/b/", ""),
        ("http://h/plain", "plain"),
        ("http://h/two.dots.txt", "two_dots"),
        ("http://h/q.txt?x=1.5&y", "q_txt_x_1"),
        ("http://h/.hidden", ""),
        ("nopath", "nopath"),
        ("http://h/ü b.txt", "__b"),
    ],
)
def test_file_stem(spark, url, stem):
    assert value(spark, url, S.file_stem) == stem


@pytest.mark.parametrize(
    "url, bucket, key, link",
    [
        ("s3://b/k/1.txt", "b", "k/1.txt", "https://s3.console.aws.amazon.com/s3/object/b?prefix=k/1.txt"),
        ("s3://b/", "b", "", "https://s3.console.aws.amazon.com/s3/object/b?prefix="),
        ("s3://b", None, "s3://b", "s3://b"),
        ("http://h/x", None, "http://h/x", "http://h/x"),
        (None, None, None, None),
    ],
)
def test_object_urls(spark, url, bucket, key, link):
    assert value(spark, url, S.object_bucket) == bucket
    assert value(spark, url, S.object_key) == key
    assert value(spark, url, S.console_link) == link


def test_html_escape_order(spark):
    assert value(spark, "<a href=\"x\">&lt;'</a>", S.html_escape) == (
        "&lt;a href=&quot;x&quot;&gt;&amp;lt;&#39;&lt;/a&gt;"
    )
    assert value(spark, None, S.html_escape) == ""


def test_numbers(spark):
    row = (
        spark.range(1)
        .select(
            N.ceil_div(F.lit(10), F.lit(3)).alias("a"),
            N.ceil_div(F.lit(9), F.lit(3)).alias("b"),
            N.ceil_div(F.lit(0), F.lit(3)).alias("c"),
            N.ceil_div(F.lit(2**62 + 1), F.lit(2)).alias("d"),
            N.ratio(F.lit(0)).alias("e"),
            N.ratio(F.lit(-2)).alias("f"),
            N.time_budget(F.lit(180)).alias("g"),
            N.time_budget(F.lit(12)).alias("h"),
            N.clamp_workers(F.lit(-4), 5).alias("i"),
            N.clamp_workers(F.lit(9), 5).alias("j"),
            N.idle_minutes(F.lit("2024-01-01 00:00:00").cast("timestamp"), F.lit("2024-01-01 00:30:59").cast("timestamp")).alias("k"),
        )
        .collect()[0]
    )
    assert tuple(row) == (4, 3, 0, 2**61 + 1, 1, 1, 170, 10, 0, 5, 30)


def test_sentences_and_tokens(spark):
    text = "  First one... Second (2nd)!? \n. Dr. Who\x0b"
    assert value(spark, text, X.sentence_array) == ["First one...", "Second (2nd)!?", ".", "Dr.", "Who"]
    assert value(spark, "Don't go, 3x: naïve—ok", X.token_array) == [
        "Don", "'", "t", "go", ",", "3x", ":", "naïve", "—", "ok",
    ]
    assert value(spark, "", X.sentence_array) == []


def test_tags_and_formats(spark):
    tagged = spark.createDataFrame([("The dogs (barked) at 7 .",)], "t string").select(
        X.tagged_array(X.token_array(F.col("t"))).alias("g")
    )
    row = tagged.select(
        X.pos_line(F.col("g")).alias("pos"),
        X.shallow_tree(F.col("g")).alias("tree"),
        X.dependency_block(F.col("g")).alias("deps"),
        X.constituency_line(F.col("g"), 3).alias("long"),
    ).collect()[0]
    assert row.pos == "The/DT dogs/NNS (/SYM barked/VBD )/SYM at/IN 7/CD ./. "
    assert row.tree == "(ROOT (S (DT The) (NNS dogs) (SYM -LRB-) (VBD barked) (SYM -RRB-) (IN at) (CD 7) (. .)))"
    assert row.deps.split("\n")[0] == "det(dogs-2, The-1)" and row.deps.split("\n")[-1] == "root(ROOT-0, .-8)"
    assert row.long == "[SKIPPED LONG SENTENCE: 8 words]"


def test_neighbours_of_short_arrays(spark):
    def pairs(items):
        df = spark.createDataFrame([(items,)], "i array<string>")
        got = df.select(X.pairs_of(F.col("i")).alias("p")).collect()[0].p
        return got and [tuple(x) for x in got]

    assert pairs([]) is None and pairs(["a"]) is None
    assert pairs(["a", "b", "c"]) == [("a", "b"), ("b", "c")]
