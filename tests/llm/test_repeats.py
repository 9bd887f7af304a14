import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from tallystar.llm import repeats as R
from tests.llm.util import documents, odd_rows, sentence


def brute(rows):
    """(doc_id, text) -> kept words, from the definition."""
    first = {}
    for i, text in rows:
        words = R.split(text)
        for k in range(len(words) - R.WINDOW + 1):
            key = tuple(words[k : k + R.WINDOW])
            if i is not None:
                first[key] = min(i, first.get(key, i))
    out = []
    for i, text in rows:
        words = R.split(text)
        gone = set()
        for k in range(len(words) - R.WINDOW + 1):
            if i is not None and first[tuple(words[k : k + R.WINDOW])] < i:
                gone |= set(range(k, k + R.WINDOW))
        out.append((i, len(words), len(gone), [w for k, w in enumerate(words) if k not in gone]))
    return out


def compare(spark, rows):
    got = R.remove_repeats(documents(spark, rows), with_text=True).collect()
    want = sorted((str(i), n, g, hashlib.sha256(b" ".join(k)).hexdigest()) for i, n, g, k in brute(rows))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    for r in got:
        if r.kept_text is not None:
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_odd_table(spark):
    compare(spark, odd_rows())
    assert R.remove_repeats(documents(spark, odd_rows()).where(F.lit(False))).count() == 0


def test_random_copies_of_stretches(spark):
    rng = random.Random(8)
    source = [w for k in range(8) for w in sentence(k, 200).split()]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(1, 4)):
            kind = rng.random()
            if kind < 0.5:
                a = rng.randrange(len(source) - 120)
                words += source[a : a + rng.randint(30, 120)]
            elif kind < 0.7:  # periods and runs
                words += (["x"] * rng.randint(1, 3) + ["y"] * rng.randint(0, 2)) * rng.randint(5, 40)
            else:
                words += sentence(1000 + i, rng.randint(1, 60)).split()
        rows.append((i // 2 if i % 7 == 0 else i, " ".join(words)))
    compare(spark, rows)


def test_symbols_in_a_window_depend_on_it_alone():
    rng = np.random.default_rng(4)
    window = rng.integers(0, 1 << 62, R.WINDOW).astype(np.uint64)
    window[10:14] = window[10]
    seen = []
    for _ in range(20):
        around = [rng.integers(0, 1 << 62, rng.integers(0, 90)).astype(np.uint64) for _ in range(2)]
        name = np.concatenate([around[0], window, around[1]])
        text = np.zeros(len(name), np.int32)
        at = len(around[0])
        both = []
        for way in (0, 1):
            symbol, first, last = R.recompress(name, text, way)
            both.append({int(s) for s, a, b in zip(symbol, first, last) if a <= at <= b})
        seen.append(both)
    assert all(s == seen[0] for s in seen) and seen[0][0]


def test_window_hash_is_of_the_words():
    rng = np.random.default_rng(5)
    name = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    name[200:300] = name[40:140]
    one = R.window_hashes(name, np.uint64(0x9E3779B97F4A7C15))
    same = {(i, j) for i in range(350) for j in range(i + 1, 350) if one[i] == one[j]}
    assert same == {(40 + k, 200 + k) for k in range(51)}
