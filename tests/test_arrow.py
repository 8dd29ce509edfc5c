"""The Arrow versions say what the column versions say."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textmill.functions import arrow_parse, arrow_text
from textmill.functions import text as X
from textmill.operators import annotate, cky, eisner, spans, tagstats, viterbi
from textmill.storage import materialize

TEXTS = [
    "The dog's (big) house was quickly sold, 3 times! It is 4th: Émile über straße ΣΑΣ ١٢ 12 x-ray - — nothing.",
    "walking Walked hopeful Famous THE nations Best. .. ! a", "", None, "   ", "one", "(a(b)) )-1, c-2( \u00a0 x",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def test_text_equals_columns(docs):
    tokens = F.transform(X.sentence_array(F.col("text")), X.token_array)
    rows = docs.select(F.explode(tokens).alias("s")).withColumn("g", X.tagged_array(F.col("s")))
    got = rows.select(
        "g", X.shallow_tree(F.col("g")), X.dependency_block(F.col("g")),
        arrow_text.tagged_array(F.col("s")), arrow_text.shallow_tree(F.col("s")), arrow_text.dependency_block(F.col("g")),
    ).collect()
    assert len(got) > 5
    for r in got:
        assert tuple(r)[:3] == tuple(r)[3:]


def test_bodies_equal_columns(docs):
    fetched = docs.crossJoin(docs.sparkSession.createDataFrame([("POS",), ("CONSTITUENCY",), ("DEPENDENCY",)], "method string"))
    fetched = fetched.withColumn("error", F.when(F.col("doc_id") == 5, "none"))
    plain = annotate.annotate(fetched, 6, lambda t: X.tagged_array(t)).select("doc_id", "method", "body")
    tagged = F.transform(F.transform(X.sentence_array(F.col("text")), X.token_array), X.tagged_array)
    gap = {"POS": "\n", "CONSTITUENCY": "\n\n", "DEPENDENCY": "\n\n"}
    rows = fetched.where("error is null").withColumn("g", tagged)
    want = {}
    for method, line in (("POS", X.pos_line), ("DEPENDENCY", X.dependency_block)):
        body = F.array_join(F.transform("g", lambda s: F.concat(line(s), F.lit(gap[method]))), "")
        want |= {(r[0], method): r[1] or "" for r in rows.where(F.col("method") == method).select("doc_id", body).collect()}
    body = F.array_join(
        F.transform("g", lambda s: F.concat(X.constituency_line(s, 6), F.when(F.size(s) > 6, "\n").otherwise("\n\n"))), ""
    )
    want |= {(r[0], "CONSTITUENCY"): r[1] or "" for r in rows.where("method = 'CONSTITUENCY'").select("doc_id", body).collect()}
    for some in (plain, annotate.annotate(fetched, 6).select("doc_id", "method", "body")):
        got = {(r[0], r[1]): r[2] for r in some.collect()}
        assert {k: v for k, v in got.items() if k[0] != 5} == want
        assert all(v is None for k, v in got.items() if k[0] == 5)


def test_pairs_and_edges(docs):
    tokens = F.transform(X.sentence_array(F.col("text")), X.token_array)
    g = docs.select(F.explode(tokens).alias("s")).select(X.tagged_array(F.col("s")).alias("g"))
    want = {}
    for r in g.collect():
        for a, b in zip(r["g"], r["g"][1:]):
            want[a["tag"], b["tag"]] = want.get((a["tag"], b["tag"]), 0) + 1
    assert {(r[0], r[1]): r[2] for r in tagstats.tag_bigrams(docs).collect()} == want
    lines = [
        "det(dog-2, the-1)\nroot(ROOT-0, dog-2)", "punct((-2, ,-3)\ndep(--1, )-2)", "", None, "no edge", "x det(a-1, b-2) y", "(a-1, b-2)",
        "det(a-1,  b-2)", "det(a-, b-2)", "det(a-1-2, b-3-4)", "dét(a-1, b-2)\n\ndep(é-1, ü-22)", "det(-1, b-2)",
    ]
    df = docs.sparkSession.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, d string")
    marked = F.regexp_replace("d", arrow_parse.EDGE, "$1\t$2\t$4")
    old = df.select("i", F.posexplode(F.split(marked, "\n")).alias("k", "e")).where(F.contains("e", F.lit("\t")))
    old = old.orderBy("i", "k").select("i", F.split("e", "\t").alias("g")).collect()
    new = df.select("i", F.inline(arrow_parse.edges(F.col("d")))).collect()
    assert [tuple(r) for r in new] == [(r["i"], *r["g"]) for r in old]


def test_trees_as_by_columns(spark):
    rng = random.Random(11)
    pieces = ["(", "(", ")", ")", " ", "a", "é", " b ", "(S ", "(NN dog)", "(DT the)", "\n"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 25))) for _ in range(400)]
    texts += ["(S (NP (DT a) (NN b)) (VP (V c)))", "", None, "(A (B c) d)", "(A (B c) d (E f) g)", "w (A b) x (C d)", "((", "))", "(A\tb)"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, tree string")
    assert sorted(map(str, spans.tree_spans(df, "id", arrow=True).collect())) == sorted(map(str, spans.tree_spans(df, "id").collect()))
    # the same by slices of an array
    row, columns = arrow_parse.tree_table(pa.array(["x", *texts[:9]]).slice(3))
    assert [c.to_pylist() for c in arrow_parse.tree_table(pa.array(texts[2:9]))[1]] == [c.to_pylist() for c in columns]


def test_rules_of_repeated_and_unnamed_sentences(spark):
    trees = [(1, "(S (NP (DT a)) (V b))"), (1, "(S (V c))"), (2, "(X (Y z))"), (None, "(S (V b))")]
    nodes = spans.tree_spans(spark.createDataFrame(trees, "id long, tree string"), "id")
    below = nodes.where("parent is not null").groupBy("id", F.col("parent").alias("node")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("node").alias("k"), F.col("label").alias("l")))).alias("ls")
    )
    named = below.join(nodes.select("id", "node", "label"), ["id", "node"])
    want = named.groupBy("label", F.array_join("ls.l", " ")).count()
    assert sorted(map(tuple, spans.rule_counts(nodes, "id").collect())) == sorted(map(tuple, want.collect()))
    plan = spans.rule_counts(nodes, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_tagged_sentences_by_both_ways(docs):
    assert cky.tagged_sentences(docs, "doc_id").collect() == cky.tagged_sentences(docs, "doc_id", tag_tokens=lambda t: X.tagged_array(t)).collect()


def test_paths_equal_columns(spark, docs):
    rng = random.Random(4)
    for reach in (1, 3, 900):
        tagger = viterbi.Tagger(
            tuple(rng.randrange(-reach, 1) for _ in range(len(viterbi.TAGS) ** 2)),
            tuple(rng.randrange(-reach, 1) for _ in range(len(viterbi.TAGS) * len(viterbi.CLASSES))),
        )
        rows = [[rng.randrange(len(viterbi.CLASSES)) for _ in range(rng.randrange(0, 12))] for _ in range(150)]
        df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, kinds array<int>")
        want = [r["p"] for r in df.select("i", viterbi.best_path(F.col("kinds"), tagger).alias("p")).orderBy("i").collect()]
        ends = np.cumsum([0, *map(len, rows)])
        got = viterbi.best_paths(np.array([k for r in rows for k in r]), ends, tagger).tolist()
        assert [got[a:b] for a, b in zip(ends, ends[1:])] == want
        more = docs.union(spark.createDataFrame([(90, "walks " * 501 + ". The end")], docs.schema))
        assert sorted(viterbi.context_tags(more, tagger, "doc_id", arrow=True).collect()) == sorted(viterbi.context_tags(more, tagger, "doc_id").collect())


def test_charts_of_phrases_equal_whole_charts():
    """The scores and trees of the chart over all symbols, for ties, too."""
    rng = np.random.default_rng(2)

    def whole_chart(row, g):
        rules, single, top = g.scores()
        n, size = len(row), cky.N_SYMBOLS
        best = {}
        for i in range(n):
            best[i, i + 1] = {**{p: (int(single[p, row[i]]), (p, i)) for p in range(cky.N_PHRASES)}, cky.N_PHRASES + row[i]: (0, (cky.N_PHRASES + row[i], i))}
        for width in range(2, n + 1):
            for i in range(n - width + 1):
                j, pairs = i + width, {}
                for k in range(i + 1, j):
                    for a, (x, ta) in best[i, k].items():
                        for b, (y, tb) in best[k, j].items():
                            if a * size + b not in pairs or x + y > pairs[a * size + b][0]:
                                pairs[a * size + b] = (x + y, ta, tb)
                best[i, j] = {}
                for p in range(cky.N_PHRASES):
                    total = [(pairs[q][0] + int(rules[p, q // size, q % size]), q) for q in sorted(pairs)]
                    value = max(t for t, _ in total)
                    q = next(q for t, q in total if t == value)
                    best[i, j][p] = (value, (p, pairs[q][1], pairs[q][2]))
        found = [(best[0, n][s][0] + int(top[s]), s) for s in sorted(best[0, n])]
        value = max(t for t, _ in found)
        return best[0, n][next(s for t, s in found if t == value)][1]

    for few in (False, True):
        draw = (lambda *shape: rng.integers(1, 3, shape) * 1.0) if few else (lambda *shape: rng.random(shape))
        g = cky._normal(draw(cky.N_PHRASES, cky.N_SYMBOLS, cky.N_SYMBOLS), draw(cky.N_PHRASES, len(cky.KINDS)), draw(cky.N_SYMBOLS))
        for n in (1, 2, 3, 5, 8):
            kinds = rng.integers(0, len(cky.KINDS), (4, n))
            assert cky.best_trees(kinds, g) == [whole_chart(row.tolist(), g) for row in kinds]


def test_near_pairs_equal_columns_and_are_not_stored(spark, docs, monkeypatch):
    sentences = cky.tagged_sentences(docs, "doc_id").withColumn("toks", F.transform("tagged", lambda w: w["tok"]))
    for window in (1, 4):
        got = sentences.select(arrow_text.near_pairs(F.col("toks"), window).alias("p")).collect()
        assert got == sentences.select(eisner.pair_rows(F.col("toks"), window).alias("p")).collect()
    stored = []
    monkeypatch.setattr(eisner, "materialize", lambda df, label: stored.append(label) or materialize(df, label))
    eisner.dependency_trees(sentences.drop("toks")).collect()
    assert "near-words" not in stored and "associations" in stored
