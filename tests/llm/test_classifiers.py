import zlib

import numpy as np
import pyarrow as pa
import pytest

from textmill.llm.quality import features, fit_ranking, keep_good, quality_scores
from textmill.llm.toxicity import fit_distance, toxicity_scores, windows

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_of_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_scores(docs, labels)
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.95


def test_toxicity_on_given_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity_scores(docs, labels).join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [r for r in rows if r.held_out]
    # there are 33 toxic rows to learn from here
    assert np.mean([r.predicted for r in held if not r.toxic]) <= 0.06
    assert np.mean([r.predicted for r in held if r.toxic]) >= 0.6


def test_labels_of_the_held_fold_do_not_matter(spark, make, text):
    rows = [(i, text(i, 40) if i % 2 else "BAD!! " * 40) for i in range(80)]
    docs = make(rows)
    from textmill.llm.labelled import held_out

    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    assert labels.where(held_out(4, 2)).count() > 0
    a, b = (sorted(map(tuple, quality_scores(docs, x).collect())) for x in (labels, turned))
    assert a == b
    assert [p for _, _, _, p in a] == [i % 2 for i, _ in rows]


@pytest.mark.parametrize("given", [[], [(1, 1, 1), (4, 1, 1)], [(1, None, None), (4, 7, 7)]])
def test_odd_rows_and_one_sided_labels(make, odd, labels, given):
    docs, marks = make(odd, clash=True), labels(given)
    good = quality_scores(docs, marks).collect()
    assert len(good) == len(odd) and {r.predicted for r in good} == {1}
    assert keep_good(docs, marks).columns == docs.columns
    toxic = toxicity_scores(docs, marks).collect()
    assert len(toxic) == len(odd) and {r.predicted for r in toxic} == {0}


def test_empty_tables(make, labels):
    for f in (quality_scores, toxicity_scores):
        assert f(make([]), labels([])).count() == 0
        assert f(make([]), labels([(1, 0, 1)])).count() == 0


def test_features_do_not_depend_on_the_batch(text):
    texts = [text(1, 50), None, "", "A!! " * 9, text(2, 300)]
    together = features(pa.array(texts))
    alone = np.vstack([features(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, alone)


def test_ranking_maximises_the_pair_likelihood():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(400, 3))
    label = (x[:, 0] + 0.3 * draw.normal(size=400) > 0).astype(int)
    m = fit_ranking(x, label)
    assert m.weights[0] > 5 * np.abs(m.weights[1:]).max()
    # the quantile at the share of bad rows accepts as many rows as are good
    assert (m.score(x) >= 0.7).sum() == label.sum()


def test_distance_finds_marking_words(text):
    toxic = [text(i, 30) + (" vilewordish" if i % 2 else " nastyterm") + " " + text(i + 500, 30) for i in range(60)]
    plain = [text(i, 60) for i in range(1000, 1200)]
    m = fit_distance([*toxic, *plain], np.array([1] * 60 + [0] * 200))
    assert m.score(text(7777, 300)) < 0.7 <= m.score(text(8888, 150) + " nastyterm vilewordish " + text(9999, 150))
    assert m.score(None) == m.score("") == 0
    assert windows(" a\tb ") == [b"a", b"b"]
