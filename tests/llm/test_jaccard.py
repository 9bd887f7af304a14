import random

import numpy as np
from pyspark.sql import functions as F

from tallystar.llm import jaccard as J
from tests.llm.util import documents, odd_rows, sentence


def shingles(text, n=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = low.encode().split()
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, similarity=85):
    """(doc_id, n, component) of rows, all pairs compared."""
    sets = [(i, shingles(t)) for i, t in rows]
    label = {i: i for i, _ in sets if i is not None}
    pairs = [
        (i, j)
        for k, (i, a) in enumerate(sets)
        for j, b in sets[:k]
        if i is not None and j is not None and a and b and 100 * len(a & b) >= similarity * len(a | b)
    ]
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    by_set = {}
    for i, s in sets:
        if i is not None and s:
            by_set[frozenset(s)] = min(label[i], by_set.get(frozenset(s), label[i]))
    return sorted(
        ((i, len(s), label[i] if i is not None else by_set.get(frozenset(s)) if s else None) for i, s in sets),
        key=repr,
    )


def found(spark, rows, **sizes):
    out = J.linked(documents(spark, rows), **sizes)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        words[at] = "".join(rng.choice("klmnop") for _ in range(6))
    return " ".join(words)


def corpus(seed, groups=12, lines=None):
    """Texts, copies at all distances around the similarity, and lines that many texts share."""
    rng = random.Random(seed)
    shared = [sentence(900 + k, 40) for k in range(3)]
    rows = []
    for g in range(groups):
        base = sentence(seed * 100 + g, rng.choice([5, 30, 120, 400])).split()
        for _ in range(rng.choice([1, 2, 8])):
            rows.append(edited(rng, base, rng.randint(0, max(1, len(base) // 40))))
        rows.append(" ".join(base) + " " + rng.choice(shared))
    rows += [rng.choice(shared) + " " + rng.choice(shared) + " " + sentence(5000 + k, rng.choice([3, 30])) for k in range(20)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_equals_brute_force(spark):
    rows = corpus(1)
    want = brute(rows)
    assert len({r[2] for r in want}) < 0.8 * len(want)
    assert found(spark, rows) == want


def test_large_groups_in_blocks(spark):
    """One group of several hundred near copies, worked on in many blocks."""
    rng = random.Random(9)
    base = sentence(77, 90).split()
    texts = [edited(rng, base, rng.randint(0, 4)) for _ in range(150)]
    texts += [" ".join(base[:45]) + " " + sentence(3000 + k, 40) for k in range(15)]
    rows = list(enumerate(texts)) + [(1000, texts[0]), (1001, " ".join(base))]
    want = brute(rows)
    assert found(spark, rows, block_tokens=900) == want
    assert found(spark, rows) == want


def test_odd_rows(spark):
    rows = odd_rows() + [(30, sentence(1, 20_000) + " more"), (31, "A B c"), (32, "a b"), (33, "b a")]
    assert found(spark, rows) == brute(rows)
    assert J.linked(documents(spark, rows).where(F.lit(False))).count() == 0


def test_texts_of_one_id_are_one_document(spark):
    a, b = sentence(1, 60), sentence(2, 60)
    out = {tuple(r) for r in J.linked(documents(spark, [(5, a), (5, b), (2, a), (9, b), (7, "")])).collect()}
    assert {(r[0], r[2]) for r in out} == {(5, 2), (2, 2), (9, 2), (7, 7)}


def test_every_filter_holds_for_similar_sets():
    """Random pairs at or above the similarity share enough first tokens, under each order."""
    rng = np.random.default_rng(4)
    counts = lambda s: (J.remixed(s, 5) % np.uint64(40)).astype(np.int64)
    checked = 0
    for _ in range(600):
        n = int(rng.integers(1, 120))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        drop = rng.random(len(a)) < rng.random() * 0.2
        b = np.unique(np.concatenate([a[~drop], rng.integers(0, 1 << 63, int(rng.integers(0, 4)), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 85 * (len(a) + len(b) - both):
            continue
        checked += 1
        least = min(J.shares(len(a), 85), J.shares(len(b), 85))
        for keys in (J.by_hash, lambda s, t: J.by_frequency(s, counts(s), t)):
            firsts = [s[np.argsort(keys(s, 2))][: int(J.first(len(s), 85))] for s in (a, b)]
            assert len(np.intersect1d(*firsts)) >= least
    assert checked > 200


def test_shared_text_makes_no_candidates(spark):
    """Texts that share a long passage pass the first filter only by what else they have in common."""
    passage = sentence(1, 60)
    rows = [(k, passage + " " + sentence(100 + k, 240)) for k in range(60)]
    common = J.common_tokens(J.first_tokens(J.described(documents(spark, rows), 4, 85))).collect()
    least = int(J.shares(297, 85))
    assert sum(r["common"] >= least for r in common) < 6 or max(r["common"] for r in common) < 40
    assert found(spark, rows) == brute(rows)
