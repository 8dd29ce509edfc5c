import random

import pytest
from pyspark.sql import functions as F

from textmill.operators import cky, spans


def rows_of(spark, trees):
    df = spark.createDataFrame(list(enumerate(trees)), "id long, tree string")
    return spans.tree_spans(df, "id")


def by_stack(tree):
    """Nodes by a plain parser: ``node, parent, depth, label, word, start, end``."""
    pieces = tree.replace("(", " ( ").replace(")", " ) ").split()
    stack, out, words, count, i = [], [], 0, 0, 0
    while i < len(pieces):
        p = pieces[i]
        if p == "(":
            label = ""
            if i + 1 < len(pieces) and pieces[i + 1] not in "()":
                label = pieces[i + 1]
                i += 1
            stack.append([count, stack[-1][0] if stack else None, len(stack), label, None, words])
            count += 1
        elif p == ")":
            if stack:
                out.append((*stack.pop(), words))
        elif stack:
            stack[-1][4] = stack[-1][4] or p
            words += 1
        i += 1
    return sorted(out)


def any_tree(rng, depth=0):
    label = rng.choice(["S", "NP", "VP", "X-1", "PRP$"])
    if depth > 6 or rng.random() < 0.35:
        return f"({label} {rng.choice(['dog', 'The', '-LRB-', 'é', ','])})"
    return f"({label} {' '.join(any_tree(rng, depth + 1) for _ in range(rng.randrange(1, 4)))})"


@pytest.fixture(scope="module")
def trees():
    rng = random.Random(3)
    return [any_tree(rng) for _ in range(80)]


def test_equals_a_stack(spark, trees):
    got = {}
    for r in rows_of(spark, trees).collect():
        got.setdefault(r["id"], []).append(tuple(r)[1:])
    assert {i: sorted(v) for i, v in got.items()} == {i: by_stack(t) for i, t in enumerate(trees)}


def test_round_trip(spark, trees):
    text = {r["id"]: r["tree"] for r in spans.tree_text(rows_of(spark, trees), "id").collect()}
    assert text == dict(enumerate(trees))


@pytest.mark.parametrize(
    "tree, want",
    [
        ("", []),
        (None, []),
        ("word", []),
        (")) (A b)", [(0, None, 0, "A", "b", 0, 1)]),
        ("(A (B c)", [(1, 0, 1, "B", "c", 0, 1)]),
        ("( (S (N x)))", [(0, None, 0, "", None, 0, 1), (1, 0, 1, "S", None, 0, 1), (2, 1, 2, "N", "x", 0, 1)]),
        ("()", [(0, None, 0, "", None, 0, 0)]),
        ("(A b) (C d)", [(0, None, 0, "A", "b", 0, 1), (1, None, 0, "C", "d", 1, 2)]),
    ],
)
def test_odd_trees(spark, tree, want):
    assert [tuple(r)[1:] for r in rows_of(spark, [tree]).collect()] == want


def test_learned_trees_round_trip(spark):
    """Deep trees of the parser: as table and back, and as long as the sentence."""
    text = "The dog saw a cat in the house. She walks and he runs (away) to the town!"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    sentences = cky.tagged_sentences(docs, "doc_id")
    parsed = cky.constituency_trees(sentences, cky.learn_grammar(sentences, 1, 20), 20)
    nodes = spans.tree_spans(parsed, "doc_id", "sent_idx", column="line")
    back = {tuple(r)[:2]: r["tree"] for r in spans.tree_text(nodes, "doc_id", "sent_idx").collect()}
    assert back == {(r["doc_id"], r["sent_idx"]): r["line"] for r in parsed.collect()}
    tops = nodes.where("parent is null").join(parsed, ["doc_id", "sent_idx"]).collect()
    assert tops and all(r["start"] == 0 and r["end"] == r["n_tokens"] and r["label"] == "ROOT" for r in tops)


def test_chunks(spark):
    docs = spark.createDataFrame([(1, "The dog in the house is on it, she saw (big) cats.")], "doc_id long, text string")
    tree = cky.tagged_sentences(docs, "doc_id").select(spans.chunk_tree(F.col("tagged")).alias("t")).first()["t"]
    assert tree.startswith("(ROOT (S (NP (DT The) (NN dog)) (PP (IN in) (NP (DT the) (NN house))) (VBZ is) (IN on)")


def test_annotated_bodies(spark):
    body = "(ROOT (S (DT a)))\n\n[SKIPPED LONG SENTENCE: 31 words]\n(ROOT (S (NN b)))\n\n"
    df = spark.createDataFrame([(1, body), (2, "")], "line_no long, body string")
    assert [tuple(r) for r in spans.annotated_trees(df, "line_no").collect()] == [
        (1, 0, "(ROOT (S (DT a)))"),
        (1, 2, "(ROOT (S (NN b)))"),
    ]


def test_counts(spark):
    nodes = rows_of(spark, ["(S (NP (DT a) (NN b)) (VP (V c)))", "(S (NP (DT a) (NN d)))"])
    assert {tuple(r) for r in spans.label_counts(nodes).collect()} == {
        ("S", 2), ("NP", 2), ("VP", 1), ("DT", 2), ("NN", 2), ("V", 1)
    }
    assert {tuple(r) for r in spans.rule_counts(nodes, "id").collect()} == {
        ("S", "NP VP", 1), ("S", "NP", 1), ("NP", "DT NN", 2), ("VP", "V", 1)
    }


def test_nothing_is_shuffled(spark, trees):
    plan = rows_of(spark, trees)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_rules_of_whole_trees(spark, tmp_path):
    """The query counts what stands below every node, the tags of phrases and beside them included."""
    from textmill.plans.queries import REGISTRY

    docs = spark.createDataFrame([(1, "It is the dog. The dog ran.")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in REGISTRY["tree_rules"](spark, str(tmp_path)).collect()}
    assert got == {("ROOT", "S", 2), ("S", "PRP VBZ NP .", 1), ("S", "NP .", 1), ("NP", "DT NN", 1), ("NP", "DT NN NN", 1)}
