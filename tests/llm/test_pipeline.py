"""Rows of every stage of the pipeline, and the classifiers' scores, against plain versions."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from textmill.llm import quality, toxicity
from textmill.llm.mixing import mix_sources
from textmill.llm.simhash import fingerprint

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def many(text):
    """Good prose, junk, copies that differ in case, near copies, repeated and null ids."""
    rows = [(i, text(i, 60 + i % 40), f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, "## " * 40 + "!!" * i, f"s{i % 3}") for i in range(40)]
    rows += [(200 + i, text(i, 60 + i % 40).upper(), "s0") for i in range(20)]
    rows += [(300 + i, text(i, 60 + i % 40) + " end", None) for i in range(20, 40)]
    rows += [(5, text(5, 65), "s2"), (5, text(7, 67), "s2"), (None, text(9, 69), "s1"), (None, None, "s1"), (400, "", "s1")]
    return rows


@pytest.fixture(scope="module")
def marked(many):
    return [(i, int(not (t or "").startswith("##")), int(i % 7 == 0)) for i, t, _ in many if i is not None and i < 200]


def of(rows):
    return Counter((r["doc_id"], r["text"]) for r in rows.collect())


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def chosen(many, marked, n, held, label):
    """(id, label, text) to learn from, in the order in which the fit takes them."""
    known = sorted({(r[0], r[label]) for r in marked if fold(r[0], n) != held})
    return sorted((i, y, t) for i, y in known for j, t, _ in many if i == j)


def test_quality_scores_by_hand(make, labels, many, marked):
    use = chosen(many, marked, 4, 2, 1)
    x = quality.features(pa.array([t for _, _, t in use], pa.string()))
    model = quality.fit_ranking(x, np.array([y for _, y, _ in use]))
    want = model.score(quality.features(pa.array([t for _, t, _ in many], pa.string())))
    got = quality.quality_scores(make(many, True), labels(marked)).collect()
    rows = Counter((r.doc_id, r.held_out, round(r.score, 6), r.predicted) for r in got)
    assert rows == Counter(
        (i, i is not None and fold(i, 4) == 2, round(float(s), 6), int(s >= 0.7)) for (i, _, _), s in zip(many, want)
    )
    assert {r.doc_id for r in got if r.predicted == 0 and r.doc_id is not None} >= set(range(100, 140))


def test_toxicity_scores_by_hand(make, labels, many, marked):
    use = chosen(many, marked, 3, 1, 2)
    model = toxicity.fit_distance([t for _, _, t in use], np.array([y for _, y, _ in use]))
    got = toxicity.toxicity_scores(make(many, True), labels(marked)).collect()
    want = Counter((i, i is not None and fold(i, 3) == 1, round(model.score(t), 6)) for i, t, _ in many)
    assert Counter((r.doc_id, r.held_out, round(r.score, 6)) for r in got) == want


def test_labelled_ids_that_repeat_are_cut_by_their_text(make, labels, text):
    """However often a labelled id repeats, the same two rows are learned from."""
    from textmill.llm.labelled import labelled_texts

    rows = [(i, text(100 * i + k, 20)) for i in range(6) for k in range(9)]
    picked = [
        sorted(map(tuple, labelled_texts(make(part), labels([(i, 1, 0) for i in range(6)]).selectExpr("doc_id", "1 AS label")).collect()))
        for part in (rows, rows[::-1])
    ]
    assert picked[0] == picked[1] and len(picked[0]) == 12


@pytest.fixture(scope="module")
def kept(spark, make, labels, many, marked, tmp_path_factory):
    """What each stage returns when fed by the one before, with the stage's input."""
    folder = str(tmp_path_factory.mktemp("tables"))
    labels(marked).write.parquet(f"{folder}/labels.parquet")
    docs, out = make(many), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, folder).cache()
        out[name] = (docs, result)
        docs = result
    return out


def test_quality_stage(kept, many, marked, make, labels):
    scored = quality.quality_scores(make(many), labels(marked)).where("predicted = 1").select("doc_id").collect()
    docs, rows = kept["quality_classifier"]
    assert Counter(r["doc_id"] for r in rows.collect()) == Counter(r["doc_id"] for r in scored)
    assert not of(rows) - of(docs) and rows.columns == docs.columns


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_exact_stage(kept):
    docs, rows = kept["exact_dedup"]
    best = {}
    for r in docs.collect():
        old = best.setdefault(lowered(r["text"]), r["doc_id"])
        if old is None or (r["doc_id"] is not None and r["doc_id"] > old):
            best[lowered(r["text"])] = r["doc_id"]
    assert Counter((lowered(r["text"]), r["doc_id"]) for r in rows.collect()) == Counter(best.items())
    assert not of(rows) - of(docs) and rows.columns == docs.columns


def test_near_stage(kept):
    docs, rows = kept["simhash_near_dedup"]
    given = [(r["doc_id"], r["text"], fingerprint(r["text"]) % (1 << 64)) for r in docs.collect()]
    group = list(range(len(given)))
    for i in range(len(given)):
        for j in range(i):
            if (given[i][2] ^ given[j][2]).bit_count() <= 2:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    want = 0
    left = of(rows)
    for g in set(group):
        members = [given[i] for i in range(len(given)) if group[i] == g]
        ids = [m[0] for m in members if m[0] is not None]
        first = [(i, t) for i, t, _ in members if i == min(ids, default=None)]
        assert sum(left[x] for x in set(first)) == 1
        want += 1
    assert sum(left.values()) == want and rows.columns == docs.columns


def test_mixing_stage(kept):
    docs, rows = kept["source_mixing"]
    taken = {(r["doc_id"], r["size"]): (r["taken"], r["size"]) for r in mix_sources(docs).collect()}
    want = Counter()
    for r in docs.collect():
        words, size = taken[r["doc_id"], len((r["text"] or "").split())]
        for p in range(2):
            part = min(max(words - p * size, 0), size)
            want[r["doc_id"], r["text"]] += part > 0 and 2 * part >= size
    assert of(rows) == +want and rows.columns == docs.columns


def test_encoding_stage(kept):
    docs, rows = kept["bpe_encoding"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    want = Counter()
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        packed = np.array(ids, "<u4").tobytes()
        want[r["doc_id"], len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in rows.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == want


def test_any_further_columns(spark, make, labels, many, marked, tmp_path):
    """Odd names, maps and structs pass through all stages that keep rows."""
    labels(marked).write.parquet(f"{tmp_path}/labels.parquet")
    docs = make(many).withColumns(
        {
            "crawl date": F.lit("x"),
            "a.b": F.lit(1),
            "`tick`": F.lit(None).cast("int"),
            "tags": F.create_map(F.lit("k"), F.col("source")),
            "nested": F.struct(F.array(F.create_map(F.lit("q"), F.col("doc_id"))).alias("in side")),
        }
    )
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        assert docs.columns == columns and docs.count(), name
