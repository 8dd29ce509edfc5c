import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from textmill.llm.resample import draw, resample

SEPARATORS = re.compile("[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in SEPARATORS.split(low) if w]


def grams(text, longest=3):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, percent=5, least=20):
    """``doc_id, n_features, weight, score, rank`` in sorted order."""
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(grams(text))
    for text in target:
        t.update(grams(text))
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 10_000) / ((s[b] + 1.0) * (big_t + 10_000))))

    rows = []
    for doc_id, text in docs:
        found = grams(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, found))
        rows.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), text))
    line = sorted(
        (r for r in rows if len(words_of(r[4])) >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1])
    )
    quota = percent * len(line) // 100
    ranked = [(*r[:4], k + 1 if k < quota else None) for k, r in enumerate(line)]
    return sorted([*ranked, *((*r[:4], None) for r in rows if len(words_of(r[4])) < least)], key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.fixture(scope="module")
def target(spark):
    def build(texts):
        return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")

    return build


@pytest.mark.parametrize("clash", [False, True])
def test_odd_rows_equal_brute_force(make, odd, target, text, clash):
    wanted = [text(1, 25), None, "", "É x-y", text(1, 25)]
    got = resample(make(odd, clash), target(wanted), percent=50)
    assert rows_of(got) == brute([r[:2] for r in odd], wanted, percent=50)


def test_many_rows_rank_across_slices(make, target, text):
    docs = [(i, text(i % 40, 15 + i % 30)) for i in range(400)]
    wanted = [text(k, 40) for k in (3, 5, 8)]
    got = resample(make(docs), target(wanted))
    assert rows_of(got) == brute(docs, wanted)
    assert sorted(r["rank"] for r in got.where("rank is not null").collect()) == list(
        range(1, 5 * sum(len(words_of(t)) >= 20 for _, t in docs) // 100 + 1)
    )


def test_empty_tables(make, target, odd):
    assert resample(make([]), target(["a b c"])).collect() == []
    assert rows_of(resample(make(odd), target([]))) == brute([r[:2] for r in odd], [])
    assert resample(make([]), target([])).collect() == []


def test_draw_keeps_rows_whole(make, target, text):
    docs = [(i, text(i, 30)) for i in range(60)] + [(3, text(3, 30))]
    wanted = [text(3, 30)]
    picked = draw(make(docs, True), target(wanted), percent=10)
    ranks = resample(make(docs), target(wanted), percent=10).where("rank is not null")
    assert {r["doc_id"] for r in picked.collect()} == {r["doc_id"] for r in ranks.collect()}
    assert picked.columns == make(docs, True).columns
    assert picked.where("doc_id = 3").count() in (0, 2)
