import hashlib
import re
import time

import numpy as np
import pytest

from textmill.llm import substring, suffix
from textmill.llm.hashing import gram_hashes, span_hashes
from textmill.llm.suffix import refine

SF = "/root/testdata/sf0.001"


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def by_words(rows, length=20):
    """Covered if the same words start earlier: by (id, place), null ids first."""
    where = {}
    split = [(-1 if i is None else i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - length + 1):
            g = tuple(w[k : k + length])
            where[g] = min(where.get(g, (i, k)), (i, k))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if where[tuple(w[k : k + length])] < (i, k):
                gone[k : k + length] = [True] * length
        out.append((i, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out)


def by_bytes(rows, length=50):
    where = {}
    raw = [(-1 if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in raw:
        for k in range(len(b) - length + 1):
            where[b[k : k + length]] = min(where.get(b[k : k + length], i), i)
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if where[b[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return sorted(out)


def words_of(df):
    rows = substring.substring_dedup(*df).collect() if isinstance(df, tuple) else df.collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows)


def bytes_of(df):
    return sorted(
        (-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()
    )


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("hot", [20_000, 2])
def test_given_documents_equal_brute_force(given, hot):
    rows = [(r.doc_id, r.text) for r in given.collect()]
    assert words_of(substring.substring_dedup(given, substring.DIGEST, hot_runs=hot)) == by_words(rows)
    assert bytes_of(suffix.suffix_dedup(given, suffix.DIGEST, hot_runs=hot)) == by_bytes(rows)


@pytest.mark.parametrize("hot", [20_000, 1])
def test_odd_rows(make, odd, hot):
    docs = make(odd, clash=True)
    assert words_of(substring.substring_dedup(docs, substring.DIGEST, hot_runs=hot)) == by_words(odd)
    assert bytes_of(suffix.suffix_dedup(docs, suffix.DIGEST, hot_runs=hot)) == by_bytes(odd)


def test_real_outputs(make, text):
    rows = [(1, text(1, 40)), (2, "new " + text(1, 40) + " end")]
    got = {r.doc_id: r for r in substring.substring_dedup(make(rows)).collect()}
    assert (got[1].kept, got[2].kept, got[2].n_spans) == (text(1, 40), "new end", 1)
    got = {r.doc_id: r for r in suffix.suffix_dedup(make(rows)).collect()}
    assert bytes(got[2].kept) == b"new  end"


def test_empty_table(make):
    assert substring.substring_dedup(make([])).count() == 0
    assert suffix.suffix_dedup(make([])).count() == 0


def test_many_contexts_around_one_passage(make, text):
    rows = [(i, f"{text(100 + i, 12)} {text(1, 30)} {text(900 + i, 12)}") for i in range(300)]
    assert words_of(substring.substring_dedup(make(rows), substring.DIGEST, hot_runs=10)) == by_words(rows)
    assert bytes_of(suffix.suffix_dedup(make(rows), suffix.DIGEST, hot_runs=10)) == by_bytes(rows)


def test_fm_index_counts_patterns():
    draw = np.random.default_rng(1)
    text = draw.integers(1, 5, 400)
    text = np.append(text, 0)
    index = substring.FMIndex(text, 9)
    low, high = substring.matching_intervals(index, np.array([0]), np.array([400]), 8)
    for k in range(393):
        want = sum((text[j : j + 8] == text[k : k + 8]).all() for j in range(393))
        assert high[k] - low[k] == want


def test_bit_vector():
    bits = np.random.default_rng(2).integers(0, 2, 1000)
    v = substring.BitVector(bits)
    assert v.ones(np.arange(1001)).tolist() == [0, *np.cumsum(bits).tolist()]


def test_refinement_finds_equal_places():
    raw = np.frombuffer(b"abcdefghijabcdefghij--abcdefghix", np.uint8)
    room = np.arange(len(raw), 0, -1)
    places, bucket = refine(raw, room, 9)
    groups = {}
    for p, b in zip(places.tolist(), bucket.tolist()):
        groups.setdefault(b, set()).add(p)
    assert sorted(map(sorted, groups.values())) == [[0, 10, 22], [1, 11]]


def test_hashes_of_equal_spans():
    x = np.array([3, 1, 4, 1, 5, 3, 1, 4, 1, 5], np.uint64)
    assert gram_hashes(x, 5)[0] == gram_hashes(x, 5)[5]
    assert len(set(gram_hashes(x, 3).tolist())) == 5
    h = span_hashes(x, np.array([0, 5, 0]), np.array([5, 10, 4]))
    assert h[0] == h[1] != h[2]


def test_one_word_a_million_times(make):
    """Long runs are cut, so repetitive text takes steps by the piece and not by the document."""
    start = time.monotonic()
    rows = [(1, "same " * 1_000_000), (2, "same same"), (3, "other " + "same " * 30)]
    got = {r.doc_id: r for r in substring.substring_dedup(make(rows), substring.DIGEST).collect()}
    # the first window stays, every later one repeats it; all words of those that follow are covered
    assert (got[1].n_words, got[1].n_removed) == (1_000_000, 999_999)
    assert (got[2].n_removed, got[3].n_removed) == (0, 30)
    assert time.monotonic() - start < 60


@pytest.mark.parametrize("most", [1, 7, 64])
def test_cut_runs_equal_brute_force(given, odd, make, most, monkeypatch):
    monkeypatch.setattr(substring, "MOST", most)
    monkeypatch.setattr(suffix, "MOST", most)
    rows = [(r.doc_id, r.text) for r in given.collect()][:80]
    docs = make([(i, t) for i, t in rows])
    assert words_of(substring.substring_dedup(docs, substring.DIGEST)) == by_words(rows)
    assert bytes_of(suffix.suffix_dedup(docs, suffix.DIGEST)) == by_bytes(rows)


def test_word_codes_tell_words_apart():
    raw = np.frombuffer("ab cd ab\x00 é ab xx cd cd".encode(), np.uint8)
    codes = substring.word_codes(raw, np.array([0, 13]), np.array([11, 11]))
    text = raw.tobytes()
    parts = [[*text[0:11].split(), None], [*text[13:24].split(), None]]
    flat = [w for p in parts for w in p]
    assert len(codes) == len(flat)
    for i in range(len(flat)):
        for j in range(len(flat)):
            assert (codes[i] == codes[j]) == (flat[i] == flat[j])
    assert all((c == 0) == (w is None) for c, w in zip(codes, flat))
