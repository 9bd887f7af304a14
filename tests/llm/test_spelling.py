import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tallystar.llm import spelling as S
from tests.llm.util import documents, odd_rows


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows):
    """The result's rows, straight from the rule."""
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    others = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(others[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(others[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def found(spark, rows, **sizes):
    out = S.variants(S.vocabulary(documents(spark, rows)), **sizes)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in out.collect())


def misspelt(seed, words, letters="abcÀÿ"):
    """Documents in which some words have variants of variants."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 11))) for _ in range(words)]

    def change(w):
        at, c = rng.randrange(len(w)), rng.choice(letters)
        return rng.choice([w[:at] + w[at + 1 :], w[:at] + c + w[at:], w[:at] + c + w[at + 1 :]])

    pool = []
    for stem in stems:
        once = [change(stem) for _ in range(3)]
        twice = [change(w) for w in once]
        pool += [stem] * rng.choice([2, 300]) + [w for w in once for _ in range(rng.choice([2, 20]))] + twice * 2
    rng.shuffle(pool)
    return [(k, " ".join(pool[k::40])) for k in range(40)]


def test_equals_brute_force(spark):
    rows = misspelt(1, 40)
    want = brute(rows)
    assert sum(r[1] is not None for r in want) > 50 and any(r[1] not in (None, r[2]) for r in want)
    assert found(spark, rows) == want
    # Small shards: keys of their own are spread over several, and every word meets all of them.
    assert found(spark, rows, shard_words=30) == want


def test_one_start_for_all_words(spark):
    rng = random.Random(4)
    words = ["inter" + "".join(rng.choice("xyz") for _ in range(rng.randint(3, 6))) for _ in range(300)]
    rows = [(1, " ".join(words * 2))]
    assert found(spark, rows, shard_words=50) == brute(rows)


def test_odd_rows(spark):
    rows = odd_rows() + [(None, "Tallyho tallyhO Tàllyho"), (None, "tallyho"), (20, "MiXeD×cased mixed×cased"), (21, "longest " * 40)]
    assert found(spark, rows) == brute(rows)
    assert S.variants(S.vocabulary(documents(spark, rows).where(F.lit(False)))).count() == 0
    assert found(spark, [(1, "short words only, no more")]) == []


def test_index_finds_each_half(spark):
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(7, 9))) for _ in range(600)})
    index = S.Words(words)
    asked = [*words[::3], "zzzabab", "aaaaaaaaaaaaaaa"]
    for ends in (False, True):
        at, place = index.search(asked, np.full(len(asked), ends))
        got = [(asked[a], index.words[p]) for a, p in zip(at, place) if asked[a] != index.words[p]]
        assert len(got) == len(set(got))
        h = {w: S.half(len(w)) for w in asked}
        want = {
            (w, v)
            for w in asked
            for v in words
            if near(w, v) and (v.endswith(w[h[w] :]) if ends else v.startswith(w[: h[w]]))
        }
        assert set(got) == want


def test_suffix_order():
    rng = np.random.default_rng(3)
    for n in (1, 2, 50):
        text = np.r_[rng.integers(1, 4, n), 0]
        want = sorted(range(n + 1), key=lambda k: text[k:].tolist())
        assert S.suffix_order(text).tolist() == want


def test_very_long_words_beside_short_ones(spark):
    rng = random.Random(8)
    long = "".join(rng.choice("ab") for _ in range(2_000))
    near_ = long[:600] + "c" + long[601:]
    words = [long, long, near_ + "x", near_, near_, "a" * 300, "a" * 300, "a" * 301, "a" * 301]
    rows = [(k, w + " shortish shortis") for k, w in enumerate(words)]
    got = {r[0]: (r[4], r[3]) for r in found(spark, rows)}
    want = {r[0]: (r[4], r[3]) for r in brute(rows)}
    assert got == want and max(map(len, want)) >= 1_999


def test_batches_are_bounded():
    sizes = np.sort(np.random.default_rng(1).integers(7, 300, 70_000))
    sizes = np.r_[sizes, 10**6, 2 * 10**6, 3 * 10**6]
    done = 0
    for b in S.batches(sizes):
        n = sizes[b]
        assert b.start == done and (len(n) == 1 or len(n) <= S.ASK_WORDS and len(n) * n[-1] <= S.ASK_SYMBOLS)
        done = b.stop
    assert done == len(sizes)
