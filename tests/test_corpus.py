import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textmill.operators import corpus, pairs, tagstats
from textmill.operators.annotate import annotate_custom, pos_tags, register_annotator, sentence_rows, token_rows
from textmill.sources.wordlists import read_pairs

TEXTS = [
    (1, "en", "The cat saw the dog. The dog saw a cat!"),
    (2, "en", "A dog and the cat"),
    (3, "de", "Der Hund, der Hund"),
    (4, "de", ""),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, lang string, text string")


def words(text):
    return [w.strip(".,!").lower() for w in text.split()]


def test_term_frequency(spark, docs):
    tf, df = Counter(), Counter()
    for _, lang, text in TEXTS:
        tf.update((lang, w) for w in words(text))
        df.update({(lang, w) for w in words(text)})
    got = {(r.lang, r.w): (r.tf, r.df) for r in corpus.term_frequency(docs).collect()}
    assert got == {k: (tf[k], df[k]) for k in tf}


def test_stopwords_and_bigrams(spark, docs):
    stop = corpus.derived_stopwords(docs, 1)
    assert {(r.lang, r.w) for r in stop.collect()} == {("en", "a"), ("de", "der")}
    got = {(r.lang, r.w1, r.w2): r.n for r in corpus.bigram_counts(docs, stop).collect()}
    want = Counter()
    for _, lang, text in TEXTS:
        ws = words(text)
        want.update((lang, a, b) for a, b in zip(ws, ws[1:]) if not {a, b} & ({"a"} if lang == "en" else {"der"}))
    assert got == dict(want)


def test_top_k_is_limited_before_the_shuffle(spark, docs):
    plan = corpus.derived_stopwords(docs, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_log_likelihood(spark):
    k11, c1, c2, total = 110, 2552, 221, 31777

    def entropy(*ks):
        return sum(k * math.log(k / sum(ks)) for k in ks if k)

    k12, k21 = c1 - k11, c2 - k11
    k22 = total - c1 - c2 + k11
    want = 2 * (entropy(k11, k12, k21, k22) - entropy(k11 + k12, k21 + k22) - entropy(k11 + k21, k12 + k22))
    cols = [F.lit(float(x)) for x in (k11, c1, c2, total)]
    got = spark.range(1).select(corpus.log_likelihood(*cols).alias("v")).collect()[0].v
    assert got == pytest.approx(want)


def test_path_similarity_of_a_word_with_itself_is_one(spark, docs):
    bigrams = corpus.bigram_counts(docs)
    given = spark.createDataFrame([("en", "dog", "dog"), ("en", "dog", "absent")], "lang string, p string, q string")
    got = {(r.p, r.q): r.similarity for r in pairs.path_similarity(bigrams, given).collect()}
    assert got == {("dog", "dog"): 1.0, ("dog", "absent"): 0.0}


def test_pair_symmetry(spark, tmp_path):
    path = tmp_path / "p.txt"
    path.write_text("X a Y\tX b Y\nX b Y\tX a Y\nX c Y\tY d X\nX d Y\tY c X\nX e Y\tY e X\nX f Y\tX g Y\nX g Y\tY f X\n")
    rows = pairs.pair_symmetry(read_pairs(spark, str(path))).collect()
    got = {(r.p, r.q, r.swapped): (r.reverse_as_is, r.reverse_renamed) for r in rows}
    assert got == {
        ("a", "b", False): (True, True),
        ("b", "a", False): (True, True),
        ("c", "d", True): (False, True),
        ("d", "c", True): (False, True),
        ("e", "e", True): (False, True),
        ("f", "g", False): (False, False),
        ("g", "f", True): (False, False),
    }


def test_threshold_sweep_keeps_empty_bands(spark):
    df = spark.createDataFrame([(0.9, 1), (0.5, 0), (0.5, 1)], "score double, label int")
    rows = pairs.threshold_sweep(df, [0.95, 0.5, 0.1]).orderBy("threshold").collect()
    assert [(r.tp, r.fp, r.fn, r.tn, r.precision, r.recall) for r in rows] == [
        (2, 1, 0, 0, 0.6667, 1.0),
        (2, 1, 0, 0, 0.6667, 1.0),
        (0, 0, 2, 1, None, 0.0),
    ]


def test_lexicon_beats_shape_for_frequent_words(spark):
    text = "Running is fun. " * 2 + "He was running. " * 5
    docs = spark.createDataFrame([(1, text)], "d long, text string")
    lexicon = tagstats.tag_lexicon(docs)
    row = lexicon.where("w = 'running'").collect()[0]
    assert (row.tag, row.n, row.total, row.n_tags) == ("VBG", 5, 7, 2)
    tokens = token_rows(docs, "d")
    tags = {r.tag for r in pos_tags(tokens, lexicon, ["d", "sent_idx", "pos"]).where("tok = 'Running'").collect()}
    assert tags == {"VBG"}
    rare = pos_tags(tokens, lexicon, ["d", "sent_idx", "pos"], min_total=8).where("tok = 'Running'").collect()
    assert {r.tag for r in rare} == {"NNP"}


def test_tree_and_dependency_statistics(spark):
    df = spark.createDataFrame(
        [("(ROOT (S (NP (DT the) (NN dog)) (VP (VBD ran))))", "det(dog-2, the-1)\nroot(ROOT-0, ran-3)\n\nnot an edge")],
        "tree string, deps string",
    )
    labels = {r.label: r.n for r in tagstats.tree_label_counts(df).collect()}
    assert labels == {"ROOT": 1, "S": 1, "NP": 1, "DT": 1, "NN": 1, "VP": 1, "VBD": 1}
    leaves = {(r.tag, r.word) for r in tagstats.tree_tag_words(df).collect()}
    assert leaves == {("DT", "the"), ("NN", "dog"), ("VBD", "ran")}
    edges = {(r.rel, r.head, r.dep): r.n for r in tagstats.dep_edge_counts(df).collect()}
    assert edges == {("det", "dog", "the"): 1, ("root", "ROOT", "ran"): 1}


def test_custom_annotator_isolates_failures(spark):
    def loader():
        def run(sentence):
            if "bad" in sentence:
                raise ValueError("cannot parse")
            return sentence.upper()

        return run

    register_annotator("UPPER", loader)
    docs = spark.createDataFrame([(1, "ok one. bad two. ok three.")], "d long, text string")
    rows = annotate_custom(sentence_rows(docs, "d"), "UPPER").orderBy("sent_idx").collect()
    assert [(r.value, r.error) for r in rows] == [
        ("OK ONE.", None),
        (None, "[ERROR: cannot parse]"),
        ("OK THREE.", None),
    ]
    with pytest.raises(ValueError, match="Unknown parsing method: nope"):
        annotate_custom(sentence_rows(docs, "d"), "nope")


def test_custom_annotator_deadline(spark):
    def loader():
        import time

        return lambda s: time.sleep(0.3) if "slow" in s else s

    register_annotator("SLOW", loader)
    docs = spark.createDataFrame([(1, "slow one. quick two.")], "d long, text string")
    rows = annotate_custom(sentence_rows(docs, "d"), "SLOW", budget_s=0.2).orderBy("sent_idx").collect()
    assert [(r.value, r.error) for r in rows] == [(None, "Task Timed Out"), ("quick two.", None)]


def brute_similar(bigrams, k, least, least_seen):
    """All pairs of a small vocabulary, by the definition."""
    out = {}
    total = sum(bigrams.values())
    feats = {}
    for slot in "XY":
        sides = Counter()
        for (a, b), n in bigrams.items():
            sides[(b, a) if slot == "X" else (a, b)] += n
        cp, cf = Counter(), Counter()
        for (p, f), n in sides.items():
            cp[p] += n
            cf[f] += n
        for (p, f), n in sides.items():
            mi = math.log(n * total / (cp[p] * cf[f]))
            if mi > 0 and n >= least_seen:
                feats.setdefault((slot, p), {})[f] = mi
    words = sorted({p for _, p in feats})
    for p in words:
        scored = []
        for q in words:
            ratios = []
            for slot in "XY":
                a, b = feats.get((slot, p), {}), feats.get((slot, q), {})
                whole = sum(a.values()) + sum(b.values())
                ratios.append(sum(a[f] + b[f] for f in a.keys() & b.keys()) / whole if whole else 0)
            score = round(math.sqrt(ratios[0] * ratios[1]), 3)
            if p != q and score >= least:
                scored.append((-score, q))
        for rank, (score, q) in enumerate(sorted(scored)[:k]):
            out[p, rank + 1] = (q, -score)
    return out


@pytest.mark.parametrize("least, least_seen", [(0.2, 1), (0.5, 1), (0.8, 2)])
def test_similar_templates_equal_all_pairs(spark, least, least_seen):
    import random

    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(30)]
    # words of one family are used alike; some fillers go with all
    bigrams = Counter()
    for _ in range(3000):
        a = rng.randrange(30)
        b = (a % 5) * 6 + rng.randrange(6) if rng.random() < 0.8 else rng.randrange(3)
        bigrams[vocabulary[a], vocabulary[b]] += 1
    rows = spark.createDataFrame([("en", a, b, n) for (a, b), n in bigrams.items()], "lang string, w1 string, w2 string, n long")
    got = {(r.p, r.rank): (r.q, r.similarity) for r in pairs.similar_templates(rows, 4, least, least_seen).collect()}
    want = brute_similar(bigrams, 4, least, least_seen)
    assert got == want and got


def test_similar_candidates_leave_pairs_out(spark):
    """Words that share only what all words have never meet."""
    rows = []
    for i in range(40):
        rows += [("en", "the", f"w{i}", 5), ("en", f"w{i}", "of", 5)]
        rows += [("en", f"x{i // 2}", f"w{i}", 9), ("en", f"w{i}", f"y{i // 2}", 9)]
    bigrams = spark.createDataFrame(rows, "lang string, w1 string, w2 string, n long")
    features = pairs.slot_features(bigrams)
    met = {(r.p, r.q) for r in pairs.similar_candidates(features, 0.5).collect()}
    alike = {(min(f"w{i}", f"w{i + 1}"), max(f"w{i}", f"w{i + 1}")) for i in range(0, 40, 2)}
    assert alike <= met and len([p for p in met if p[0][0] == "w" and p[1][0] == "w"]) == len(alike)


def test_no_bigrams_no_templates(spark):
    none = spark.createDataFrame([], "lang string, w1 string, w2 string, n long")
    assert pairs.similar_templates(none, 3, 0.5).collect() == []


def test_words_with_one_common_filler_are_told_apart_by_blocks(spark, monkeypatch):
    """All words share fillers: no index leaves a pair out, so blocks of few words and steps of few cells must give all pairs."""
    import random

    from textmill.operators import alike

    monkeypatch.setattr(alike, "FEWEST_WORDS", 8)
    monkeypatch.setattr(alike, "STEP", 50)
    rng = random.Random(5)
    bigrams = Counter()
    for i in range(60):
        bigrams["the", f"w{i:02}"] += rng.randrange(5, 9)
        bigrams[f"w{i:02}", "of"] += rng.randrange(5, 9)
        if i % 3 == 0:
            bigrams[f"x{i % 4}", f"w{i:02}"] += rng.randrange(1, 9)
        if i % 4 == 0:
            bigrams[f"w{i:02}", f"y{i % 5}"] += rng.randrange(1, 9)
    rows = spark.createDataFrame([(lang, a, b, n) for lang in ("de", "en") for (a, b), n in bigrams.items()], "lang string, w1 string, w2 string, n long")
    got = {(r.lang, r.p, r.rank): (r.q, r.similarity) for r in pairs.similar_templates(rows, 4, 0.3).collect()}
    want = brute_similar(bigrams, 4, 0.3, 1)
    assert len(want) > 200
    assert got == {(lang, *key): value for lang in ("de", "en") for key, value in want.items()}


def test_similar_templates_store_no_row_for_every_two_words(spark, monkeypatch):
    """120 words share their fillers, 7,140 pairs of them: what is stored grows with the words."""
    from textmill.operators import alike

    rows = []
    for i in range(120):
        rows += [("en", "the", f"w{i}", 5), ("en", f"w{i}", "of", 5), ("en", "a", f"v{i}", 7)]
    bigrams = spark.createDataFrame(rows, "lang string, w1 string, w2 string, n long")
    stored = {}
    kept = pairs.materialize

    def seen(df, label="table"):
        out = kept(df, label)
        stored[label] = out.count()
        return out

    monkeypatch.setattr(pairs, "materialize", seen)
    monkeypatch.setattr(alike, "materialize", seen)
    assert pairs.similar_templates(bigrams, 3, 0.5).count() == 3 * 120
    assert stored and max(stored.values()) <= 3 * len(rows)


def test_path_similarity_counts_words_and_not_bigrams(spark, monkeypatch):
    """The totals come from one table of words, not from every bigram sent to meet the wanted fillers."""
    import random

    rng = random.Random(3)
    bigrams = Counter((f"w{rng.randrange(12)}", f"w{rng.randrange(12)}") for _ in range(400))
    rows = spark.createDataFrame([("en", a, b, n) for (a, b), n in bigrams.items()], "lang string, w1 string, w2 string, n long")
    given = spark.createDataFrame([("en", "w1", "w2"), ("en", "w3", "w4")], "lang string, p string, q string")
    rows_of = {}
    kept = pairs.materialize

    def seen(df, label="table"):
        out = kept(df, label)
        rows_of[label] = out.count()
        return out

    monkeypatch.setattr(pairs, "materialize", seen)
    got = {(r.p, r.q): r.similarity for r in pairs.path_similarity(rows, given).collect()}
    best = brute_similar(bigrams, 99, 0.0, 1)
    want = {(p, q): s for (p, _), (q, s) in best.items()}
    assert got == {("w1", "w2"): want["w1", "w2"], ("w3", "w4"): want["w3", "w4"]} and any(got.values())
    # every word once for each place; what the given words have is not stored to be counted again
    assert rows_of["marginals"] == len({a for a, _ in bigrams}) + len({b for _, b in bigrams}) and "fillers" not in rows_of
