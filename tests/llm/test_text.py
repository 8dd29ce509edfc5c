import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from check_oracles import connect, difference, same_type
from textmill.llm import bpe, queries
from textmill.llm.lm import backoff_scores
from textmill.llm.mixing import keep_mixed, mix_sources
from textmill.llm.syncmers import fingerprint_documents
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    duck = connect(SF)
    result = queries.REGISTRY[name](spark, SF)
    cursor = duck.execute(queries.ORACLES[name])
    want = cursor.df()
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    assert difference(result.toPandas(), want) is None
    assert [c for c, t in result.dtypes if not same_type(t, kinds.get(c))] == []


# BPE


def same_as_library(texts):
    library = Tokenizer.from_file(VOCABULARY)
    ids, decoded = bpe.encode_texts(texts, bpe.read_vocabulary(VOCABULARY))
    for text, raw, shown in zip(texts, ids, decoded):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == want, text[:80]
        assert shown == library.decode(want, skip_special_tokens=False)


def test_bpe_equals_the_library_on_given_documents(spark):
    same_as_library([r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])


def test_bpe_equals_the_library_on_odd_texts():
    draw = random.Random(5)
    letters = "aaab'st .,!#12 éüßñ中文 \t\n  ΣσİЖ½\U0001f600"
    odd = ["".join(draw.choice(letters) for _ in range(draw.randrange(40))) for _ in range(1500)]
    same_as_library(
        ["", " ", "aaaa aaaaa", "<|endoftext|>", "x<|startoftext|>y<|endoftext|><|endoftext", "IT'S we'LL 's 'sx", "ΑΣ ΟΔΟΣ", "a\x85b\x1cc", *odd]
    )


def test_bpe_frame(make, odd):
    got = bpe.encode_decode(make(odd, clash=True), VOCABULARY)
    rows = got.collect()
    assert sorted((r.doc_id for r in rows), key=repr) == sorted((i for i, _ in odd), key=repr)
    assert all(len(r.ids) == 4 * r.n_tokens for r in rows)
    again = {(r.doc_id, r.text) for r in bpe.decode(got, VOCABULARY).collect()}
    assert again == {(r.doc_id, r.decoded) for r in rows}
    assert [r.n_tokens for r in rows if r.doc_id == 1] == [0]
    assert bpe.encode_decode(make([]), VOCABULARY).count() == 0


def test_wrong_vocabulary():
    with pytest.raises(ValueError):
        bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


# mixing


def targets_by_hand(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not over:
            return out | share
        out |= {s: 2 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    return out


def test_mixing(make, text):
    rows = [(i, text(i, 1 + i % 37), ["a", "b", "ü", "Z", None, "empty"][i % 5]) for i in range(400)]
    rows += [(1000, "", "empty"), (1001, None, "a"), (None, "one two", "b"), (5, text(5, 6), "a"), (5, text(5, 6), "a")]
    got = mix_sources(make(rows, clash=True)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want, taken = targets_by_hand(sizes), Counter()
    of = {i: s for i, _, s in rows}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and (r.position is None) == (r.taken == 0)
        assert r.target == pytest.approx(want[of[r.doc_id]]) and r.source_size == sizes[of[r.doc_id]]
        taken[of[r.doc_id]] += r.taken
    assert all(taken[s] == math.floor(want[s] + 1e-9) for s in sizes)
    places = [r.position for r in got if r.position is not None]
    assert places == sorted(places) and 0 <= places[0] and places[-1] <= 1
    again = mix_sources(make(rows[::-1], clash=True)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_mixing_small_tables(make):
    assert mix_sources(make([])).count() == 0
    assert [(r.target, r.taken) for r in mix_sources(make([(1, "", "a"), (2, None, "b")])).collect()] == [(0, 0), (0, 0)]
    docs = make([(1, "a b c", "x"), (2, "a b c d", "x"), (3, "e", "y")], clash=True)
    kept = keep_mixed(docs)
    assert kept.columns == docs.columns
    assert set(Counter(r.doc_id for r in kept.collect()).values()) <= {1, 2}


def due_by_hand(time, slope):
    """The share of a source's demand that its schedule 1 + slope (2 t - 1) has dealt by a time."""
    return (1 - slope) * time + slope * time * time


def test_every_pass_follows_the_schedule(make, text):
    rows = [(i, text(i, 1 + i % 37), ["a", "b", "c"][min(i % 10, 2)]) for i in range(300)]
    docs, source = make(rows, clash=True), {i: s for i, _, s in rows}
    slopes, repeated = {"a": -0.5, "b": 0.0, "c": 0.5}, set()
    placed = {s: [] for s in slopes}
    got = mix_sources(docs).collect()
    for r in got:
        left, s = r.taken, source[r.doc_id]
        assert len(r.positions) == -(-r.taken // r.size) and r.positions[:1] == ([r.position] if r.taken else [])
        assert len(set(r.positions)) == len(r.positions)
        for time in r.positions:
            placed[s].append((time, min(left, r.size), r.target))
            left -= min(left, r.size)
        if len(r.positions) == 2:
            repeated.add(s)
    assert repeated
    for s, passes in placed.items():
        met = 0
        for time, words, target in sorted(passes):
            assert abs(met - due_by_hand(time, slopes[s]) * target) < 1e-6
            met += words
        assert abs(met - passes[0][2]) < 1
    # the pipeline's copies stand where their passes do, up to the documents that are rounded
    of = {r.doc_id: r for r in got}
    kept = [r.doc_id for r in keep_mixed(docs).collect()]
    want = [(t, i) for i, r in of.items() for k, t in enumerate(r.positions) if 2 * (r.taken - k * r.size) >= r.size]
    assert Counter(kept) == Counter(i for _, i in want)
    times, seen = [], Counter()
    for i in kept:
        times.append(of[i].positions[seen[i]])
        seen[i] += 1
    assert times == sorted(times)


# syncmers


def test_edited_texts(make, odd, text):
    rows = [(i, t) for i, t in odd if i not in (5, None)] + [(20, "ab\U0001f600cdéfgh"), (21, text(9, 400))]
    got = {r.doc_id: r for r in fingerprint_documents(make(rows, clash=True)).collect()}
    order = sorted(rows)
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        m = len(t) // 4
        edited = t[: len(t) - m] + nxt[:m]
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_next <= 1 and 0 <= got[i].near_edited <= 1
    assert got[1].fingerprint == got[2].fingerprint == "" and got[1].near_edited == 1
    assert got[8].near_edited > 0.4 > got[8].near_next
    assert got[21].near_edited > 0.4


def test_fingerprints_are_of_the_text_alone(make, odd):
    a = {(r.doc_id, r.n_chars, r.fingerprint) for r in fingerprint_documents(make(odd)).collect()}
    b = {(r.doc_id, r.n_chars, r.fingerprint) for r in fingerprint_documents(make(odd[::-1] + [(99, "z " * 9)])).collect()}
    assert a <= b
    assert len(fingerprint_documents(make(odd)).collect()) == len(odd)
    assert fingerprint_documents(make([])).count() == 0
    assert [r.near_next for r in fingerprint_documents(make([(1, "just one text here")])).collect()] == [1.0]


def words_of(t):
    return re.findall("[^\\x20\\x09-\\x0D]+", t or "")


@pytest.fixture(scope="module")
def hashes(spark):
    """xxhash64 of tuples of strings or numbers, many at a time."""

    def build(values):
        values = list(dict.fromkeys(values))
        if not values:
            return {}
        rows = spark.createDataFrame([(i, *v) for i, v in enumerate(values)])
        got = rows.select("_1", F.xxhash64(*rows.columns[1:])).collect()
        return {values[r[0]]: r[1] for r in got}

    return build


def codes_by_hand(texts, hashes):
    """The anchors of each text, straight from the definition."""
    one = hashes([(w,) for t in texts for w in words_of(t)])
    lines = [[one[w,] for w in words_of(t)] for t in texts]
    four = hashes([tuple(u[i : i + 4]) for u in lines for i in range(len(u) - 3)])
    whole = hashes([(t,) for t in texts if t])
    out = []
    for t, u in zip(texts, lines):
        places = [i for i in range(len(u) - 3) if min(u[i : i + 4]) in (u[i], u[i + 3])]
        steps = [b - a for a, b in zip([0, *places], places)]
        assert all(s <= 4 for s in steps)
        found = [s << 28 | (four[tuple(u[i : i + 4])] % (1 << 64)) >> 36 for s, i in zip(steps, places)]
        out.append(found or ([7 << 28 | (whole[t,] % (1 << 64)) >> 36] if t else []))
    return out


def jaccard(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def by_text(codes):
    return "".join(f"{c:08x}" for c in codes)


def parsed(fingerprint):
    return [fingerprint[k : k + 8] for k in range(0, len(fingerprint), 8)]


def test_syncmer_rows_equal_definition(make, odd, text, hashes):
    """Every column by hand, cuts inside, before and after words, blanks of all kinds, short and long texts."""
    given = [
        text(1, 60), text(2, 61), "abc", "ab cd", "  lead and trail  ", "x" * 50, "a b c d e f g h", "one\ttwo\nthree four  five six",
        "é ü ö " * 9, text(3, 7) + "   " + text(4, 3), "", "\n \n", text(5, 200), "w " * 40, text(1, 60),
    ]
    given += [text(9, 40)[:n] for n in range(150, 175)]
    rows = list(enumerate(given))
    edited = []
    for i, t in rows:
        q, following = len(t) // 4, given[(i + 1) % len(given)]
        edited.append(t[: len(t) - q] + following[:q])
    plain, changed = codes_by_hand(given, hashes), codes_by_hand(edited, hashes)
    got = {r.doc_id: r for r in fingerprint_documents(make(rows, clash=True)).collect()}
    for i, t in rows:
        r = got[i]
        assert r.n_chars == len(t) and r.next_id == (i + 1) % len(given)
        assert r.edited_sha256 == hashlib.sha256(edited[i].encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (by_text(plain[i]), by_text(changed[i])), (i, t)
        assert r.near_edited == pytest.approx(jaccard(plain[i], changed[i]))
        assert r.near_next == pytest.approx(jaccard(plain[i], plain[(i + 1) % len(given)]))


@pytest.mark.parametrize("size", [395, 400, 405, 5000])
def test_likeness_comes_from_the_returned_fingerprints(make, text, size):
    docs = [(i, (text(i // 2, 1200) + " ")[i % 2 * 7 :][: size + 3 * i]) for i in range(8)] + [(9, "short one"), (10, None)]
    got = {r.doc_id: r for r in fingerprint_documents(make(docs)).collect()}
    for r in got.values():
        assert r.near_edited == pytest.approx(jaccard(parsed(r.fingerprint), parsed(r.edited_fingerprint)))
        assert r.near_next == pytest.approx(jaccard(parsed(r.fingerprint), parsed(got[r.next_id].fingerprint)))
    assert any(0 < r.near_next < 1 for r in got.values()) and all(0.4 < got[i].near_edited < 0.9 for i in range(7))


def test_likeness_counts_every_anchor(make, text):
    words = text(3, 8000).split()
    other = [*words[:4000], *text(11, 60).split(), *words[4060:]]
    moved = [*words[4000:], *words[:4000]]
    for changed, low, high in ((other, 0.96, 0.9999), (moved, 0.98, 0.9999), (words, 1, 1)):
        a, _ = fingerprint_documents(make([(1, " ".join(words)), (2, " ".join(changed))])).collect()
        assert low <= a.near_next <= high
    # equal anchors at other distances are not the same place
    one, two = "a b c d e f g h " * 60, "h g f e d c b a " * 60
    assert fingerprint_documents(make([(1, one), (2, two)])).first().near_next < 0.1


def test_fingerprints_of_text_ids(spark, text):
    rows = spark.createDataFrame([("b", text(1, 40)), ("a", text(2, 40)), (None, text(3, 40))], "doc_id string, text string")
    got = {r.doc_id: r.next_id for r in fingerprint_documents(rows).collect()}
    assert got == {None: "a", "a": "b", "b": None}


# backoff scores


def scores_by_hand(rows, order):
    docs = [(t or "").encode().split() for _, t in rows]
    grams = [[tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)] for w in docs]
    every = Counter(g for doc in grams for g in doc)
    words = sum(map(len, docs))
    out = []
    for (i, _), w, own in zip(rows, docs, map(Counter, grams)):
        rest, total = words - len(w), 0.0
        for k in range(len(w)):
            top = min(order, k + 1)
            for n in range(top, 0, -1):
                g = tuple(w[k - n + 1 : k + 1])
                count = every[g] - own[g]
                if count > 0:
                    context = rest if n == 1 else every[g[:-1]] - own[g[:-1]]
                    total += math.log10(count / context) + (top - n) * math.log10(0.4)
                    break
            else:
                total += (top - 1) * math.log10(0.4) - math.log10(rest + 1)
        out.append((i, len(w), round(total, 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_by_hand(make, odd, text, order):
    rows = [*odd, *((100 + i, text(i % 9, 50)) for i in range(20))]
    got = backoff_scores(make(rows, clash=True), order=order).collect()
    assert sorted([(r.doc_id, r.n_words, round(r.log_score, 6)) for r in got], key=repr) == scores_by_hand(rows, order)
    assert backoff_scores(make([]), order=order).count() == 0


# pipeline


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "bpe_encoding":
            assert docs.columns == columns
        if "mixing" not in name:
            assert docs.count() <= before
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert corpus_pipeline.run(spark, SF).count() == docs.count() > 0
