import hashlib
from collections import Counter, defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from textmill.llm.components import components
from textmill.llm.exact import exact_dedup, keep_exact
from textmill.llm.simhash import fingerprint, keep_near, near_dedup


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def exact_by_hand(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    out = []
    for i, t in rows:
        ids = groups[lowered(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(lowered(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_odd_rows(make, odd):
    rows = [*odd, (11, odd[3][1].upper()), (12, "É"), (13, "é")]
    got = [tuple(r) for r in exact_dedup(make(rows, clash=True)).collect()]
    assert sorted(got, key=repr) == exact_by_hand(rows)


def test_digest_shared_by_different_texts(make):
    rows = [(i, "abc"[i % 3]) for i in range(12)]
    got = exact_dedup(make(rows), digest=lambda c: F.unhex(F.lit("00"))).collect()
    assert sorted(map(tuple, got), key=repr) == exact_by_hand(rows)


def test_keep_exact(make, odd):
    kept = keep_exact(make(odd, clash=True))
    got = [(r.doc_id, r.text) for r in kept.collect()]
    want = {(keep, digest) for _, keep, _, _, digest in exact_by_hand(odd)}
    assert sorted((i, hashlib.sha256(lowered(t).encode()).hexdigest()) for i, t in got) == sorted(want)
    assert kept.columns == make(odd, clash=True).columns


def test_exact_empty(make):
    assert exact_dedup(make([])).count() == 0
    assert keep_exact(make([])).count() == 0


def simhash_by_hand(t):
    words = lowered(t).encode().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def near_by_hand(rows):
    prints = [simhash_by_hand(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    lowest = {}
    for i, (d, _) in enumerate(rows):
        lowest[find(i)] = min([x for x in (lowest.get(find(i)), d) if x is not None], default=None)
    return sorted([(d, f"{p:016x}", lowest[find(i)]) for i, ((d, _), p) in enumerate(zip(rows, prints))], key=repr)


def near_rows(text):
    """Texts a few words apart, so that some fingerprints are one, two or three bits apart."""
    base = text(5, 500).split()
    out = []
    for i in range(40):
        words = list(base)
        for k in range(i):
            words[(k * 71) % 500] = f"w{k}"
        out.append((100 + i, " ".join(words)))
    return out


def test_near_odd_rows(make, odd, text):
    rows = [*odd, *near_rows(text)]
    got = [tuple(r) for r in near_dedup(make(rows, clash=True)).collect()]
    assert sorted(got, key=repr) == near_by_hand(rows)
    assert 1 < len({r[2] for r in got if r[0] and r[0] >= 100}) < 40


def test_keep_near(make, odd):
    docs = make(odd, clash=True)
    kept = keep_near(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted({r[2] for r in near_by_hand(odd)}, key=repr)


def kept_by_hand(rows):
    """Per component the ids and texts one of which has to stay: the smallest id's, or any if none has an id."""
    prints = [simhash_by_hand(t) for _, t in rows]
    groups = []
    for i in range(len(rows)):
        near = [g for g in groups if any((prints[i] ^ prints[j]).bit_count() <= 2 for j in g)]
        groups = [g for g in groups if g not in near] + [sum(near, [i])]
    out = []
    for g in groups:
        ids = [rows[i][0] for i in g if rows[i][0] is not None]
        out.append({rows[i] for i in g if rows[i][0] == min(ids, default=None)})
    return out


def test_keep_near_of_every_component(make, odd, text):
    rows = [*odd, *near_rows(text), *((5, text(20 + i, 50)) for i in range(9)), *((None, text(40 + i, 50)) for i in range(9))]
    rows += [(None, text(40, 50)), (None, text(1, 60))]
    want = kept_by_hand(rows)
    for some in (rows, rows[::-1]):
        kept = Counter((r.doc_id, r.text) for r in keep_near(make(some, clash=True)).collect())
        assert sum(kept.values()) == len(want) and all(sum(kept[x] for x in group) == 1 for group in want)


def test_near_empty(make):
    assert near_dedup(make([])).count() == 0
    assert keep_near(make([])).count() == 0


def test_fingerprint_over_several_blocks(text):
    assert fingerprint(text(3, 70_000)) % (1 << 64) == simhash_by_hand(text(3, 70_000))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, 100 + i) for i in range(1, 50)]
    mixed = [(int(a), int(b)) for a, b in np.random.default_rng(4).integers(200, 260, (25, 2))]
    edges = chain + star + mixed
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
