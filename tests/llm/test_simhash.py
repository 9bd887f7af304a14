import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tallystar.llm import simhash as S
from tests.llm.util import by_id, documents, odd_rows, sentence


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = low.encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Least id reachable by links of distance up to four."""
    ids = sorted(prints)
    label = {i: i for i in ids}
    changed = True
    near = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 4]
    while changed:
        changed = False
        for a, b in near:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def sets(n, a, b, points):
    parent = {int(p): int(p) for p in points}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        parent[find(x)] = find(y)
    return {p: frozenset(q for q in parent if find(q) == find(p)) for p in parent}


def clustered(rng, n):
    """Random fingerprints, dense balls and chains of small steps."""
    base = rng.integers(0, 1 << 63, n // 4, dtype=np.uint64)
    out = [base]
    centre = np.uint64(rng.integers(0, 1 << 63))
    for _ in range(n // 2):
        flips = rng.choice(64, rng.integers(0, 7), replace=False)
        out.append(np.array([centre ^ np.uint64(sum(1 << int(f) for f in flips))], np.uint64))
    step = base[0]
    for _ in range(n // 4):
        step = step ^ np.uint64(1 << int(rng.integers(64))) ^ np.uint64(1 << int(rng.integers(64)))
        out.append(np.array([step], np.uint64))
    return np.unique(np.concatenate(out))


def test_forest_connects_what_links_connect(monkeypatch):
    monkeypatch.setattr(S, "PLAIN_POINTS", 16)
    rng = np.random.default_rng(1)
    for _ in range(6):
        points = clustered(rng, 400)
        near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 4
        i, j = np.nonzero(np.triu(near, 1))
        ids = np.arange(len(points))
        stored = ids % 5 > 0
        a, b = S.forest(ids, points[:, None], np.ones(len(points)), stored, 4, 0)
        one = stored[i] | stored[j]  # links between two that only ask are another shard's
        i, j = i[one], j[one]
        assert len(a) < len(points)  # a forest, not all pairs
        assert sets(0, a, b, ids) == sets(0, i, j, ids)


def test_tree_brings_every_pair_together():
    rng = np.random.default_rng(2)
    points = clustered(rng, 800)
    tree = S.VantageTree(points[::3, None], 20, 4)
    shard, place, stored = tree.deal(points[:, None])
    assert np.bincount(place[stored], minlength=len(points)).tolist() == [1] * len(points)
    home = dict(zip(place[stored].tolist(), shard[stored].tolist()))
    seen = {(p, s) for p, s in zip(place.tolist(), shard.tolist())}
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 4
    for i, j in zip(*np.nonzero(np.triu(near, 1))):
        assert (i, home[j]) in seen or (j, home[i]) in seen


def test_documents(spark, monkeypatch):
    for name, value in (("SHARD_POINTS", 4), ("TASK_QUERIES", 5), ("PLAIN_POINTS", 2)):
        monkeypatch.setattr(S, name, value)
    base = sentence(7, 400).split()
    near = [(100 + k, " ".join(base[:k] + ["other"] + base[k + 1 :])) for k in range(0, 40, 4)]
    rows = odd_rows() + near + [(50 + k, sentence(50 + k, 30)) for k in range(20)]
    docs = documents(spark, rows)
    out = S.near_duplicates(docs)
    assert out.count() == len(rows)
    found = by_id(out)
    prints = {i: brute_print(t) for i, t in rows if i is not None}
    label = brute_components(prints)
    assert {i: int(r.fingerprint, 16) for i, r in found.items()} == prints
    assert {i: r.component_id for i, r in found.items()} == label
    assert S.near_duplicates(docs.where(F.lit(False))).count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(1, 40)]
    star = [(100, k) for k in range(101, 160)]
    edges = spark.createDataFrame(path + star + [(7, 7)], "a bigint, b bigint")
    got = {r.node: r.least for r in S.components(edges).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {k: 100 for k in range(100, 160)}


def jaccard(a, b):
    sets_ = [set(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else {tuple(w)} for w in (a, b)]
    return len(sets_[0] & sets_[1]) / len(sets_[0] | sets_[1])


def test_one_of_each_takes_similar_texts_and_leaves_others(spark, monkeypatch):
    """Texts of a similarity well over 0.8 go, those under 0.6 stay."""
    # A sample so small that it misses some bins of sizes.
    for name, value in (("SHARD_POINTS", 16), ("TASK_QUERIES", 20), ("PLAIN_POINTS", 8), ("SAMPLE_POINTS", 12)):
        monkeypatch.setattr(S, name, value)
    rows, gone = [], set()
    for k in range(30):
        words = sentence(900 + k, 150 + 20 * k).split()
        rows.append((k, " ".join(words)))
        rows.append((100 + k, " ".join(words)))
        close, far = list(words), list(words)
        close[40] = "changed"
        for at in range(5, len(far), 9):
            far[at] = "other" + str(at)
        assert jaccard(words, close) > 0.9 and jaccard(words, far) < 0.6
        rows += [(200 + k, " ".join(close)), (300 + k, " ".join(far))]
        gone |= {100 + k, 200 + k}
    rows += [(None, rows[0][1]), (None, None), (400, None), (401, ""), (402, "word")]
    docs = documents(spark, rows)
    kept = S.one_of_each(docs)
    assert kept.schema == docs.schema
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 2 and set(ids) - {None} == {i for i, _ in rows if i is not None} - gone - {401}
    assert S.one_of_each(docs.where(F.lit(False))).count() == 0


def test_radius_follows_the_similarity():
    assert [S.near_radius(s, 256) for s in (0.8, 0.9, 1.0)] == [44, 31, 0]


def test_one_of_each_decides_by_the_exact_similarity(spark, monkeypatch):
    """Copies just above 0.8 go, whatever their fingerprints; those just below stay, in one block or in many."""
    rows, gone = [], set()
    for k in range(60):
        words = sentence(3000 + k, 600).split()
        rows.append((k, " ".join(words)))
        for first, changes in ((100, 13), (200, 15)):
            other = list(words)
            for c in range(changes):
                other[20 + 40 * c % 560] = f"other{first}x{c}"
            assert (jaccard(words, other) >= 0.8) == (first == 100) and jaccard(words, other) > 0.75
            rows.append((first + k, " ".join(other)))
        gone.add(100 + k)
    docs = documents(spark, rows)
    prints = {r.doc_id: np.array(r.fp).view(np.uint64) for r in S.set_fingerprints(docs, 5, 4).collect()}
    apart = {i: int(np.bitwise_count(prints[i] ^ prints[i % 100]).sum()) for i in prints}
    assert any(apart[100 + k] > 44 for k in range(60)) and any(apart[200 + k] <= 44 for k in range(60))
    for size in (2_000_000, 500):
        monkeypatch.setattr(S, "BLOCK_SHINGLES", size)
        assert {r.doc_id for r in S.one_of_each(docs).collect()} == {i for i, _ in rows} - gone


def test_similar_connects_what_similar_pairs_connect():
    rng = np.random.default_rng(5)
    for _ in range(20):
        sets_ = [np.unique(rng.integers(0, 40, rng.integers(20, 60))) for _ in range(30)]
        sets_ += [np.delete(s, rng.integers(len(s), size=3)) for s in sets_]
        ids, side = np.arange(len(sets_)), rng.integers(0, 2, len(sets_))
        pairs = [
            (i, j)
            for i in ids
            for j in ids[i + 1 :]
            if 5 * len(np.intersect1d(sets_[i], sets_[j])) >= 4 * len(np.union1d(sets_[i], sets_[j]))
        ]
        for sides in (side * 0, side):
            want = [(i, j) for i, j in pairs if not sides.any() or sides[i] != sides[j]]
            a, b = S.similar(ids, sets_, sides, 0.8)
            i, j = np.array(want).T
            assert sets(0, a, b, ids) == sets(0, i, j, ids)


def test_repeated_rows_leave_the_first_of_them(spark):
    """Rows equal in id and text may differ elsewhere; rows without an id are never repeated ones."""
    text, other = sentence(1, 40), sentence(2, 40)
    rows = [(1, text, "en", s, 3) for s in ("b", "a", "c", "a")] + [(2, other, "fr", "x", 1), (2, other, "de", "x", 1), (2, text, "de", "x", 1)]
    rows += [(None, text, "en", "a", 3)] * 3 + [(None, other, "en", s, 3) for s in "ab"] + [(3, None, "en", None, None)] * 2
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    want = [(1, text, "en", "a", 3), (3, None, "en", None, None), *rows[7:12]]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, schema).repartition(3 + seed)
        kept = S.one_of_each(docs)
        assert kept.schema == docs.schema
        # The second document has a text of the first, and goes with all its rows.
        assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, want))
