import hashlib
import random

from pyspark.sql import functions as F

from tallystar.llm import contamination as C
from tests.llm.util import by_id, documents, odd_rows, sentence


def brute(items, words):
    """Covered words and the items, straight from the definition."""
    hit, found = set(), set()
    for item, text in items:
        own = C.split_words(text)
        for k in range(max(1, len(own) - C.WINDOW + 1) if own else 0):
            phrase = own[k : k + C.WINDOW]
            for a in range(len(words) - len(phrase) + 1):
                if words[a : a + len(phrase)] == phrase:
                    hit |= set(range(a, a + len(phrase)))
                    found.add(str(item))
    return hit, found


def test_fm_index_equals_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        letters = ["a", "b", "c"][: rng.randint(1, 3)]
        items = [
            (k, " ".join(rng.choice([*letters, "zz"]) for _ in range(rng.randint(0, 14)))) for k in range(rng.randint(0, 4))
        ]
        texts = [C.split_words(" ".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for _ in range(5)]
        spans, found = C.find(C.Phrases(items), texts)
        for t, s, f in zip(texts, spans, found):
            hit, names = brute(items, t)
            assert {x for a, b in s for x in range(a, b)} == hit and f == names
            assert all(b < c for (_, b), (c, _) in zip(s, s[1:]))  # merged


def items_and_docs():
    passage, short = sentence(2, 80), "Alpha beta gamma"
    items = [(1, passage), (1, passage), (2, short), (10, sentence(9, 40)), (3, None), (4, ""), (None, sentence(3, 12))]
    rows = [*odd_rows(), (30, "x alpha, BETA; gamma! y"), (31, sentence(9, 40) + " mid " + short)]
    return items, rows


def check(spark, blocks_bytes, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_BYTES", blocks_bytes)
    items, rows = items_and_docs()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents(spark, rows)
    out = C.digest(C.hits(docs, bench))
    assert out.count() == len(rows)
    texts = dict(rows)
    for i, r in by_id(out).items():
        words = C.split_words(texts[i])
        hit, found = brute(items, words)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(words), len(hit), len(found), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    clean = C.remove(docs, bench)
    assert clean.schema == docs.schema and clean.count() == len(rows)
    for r in clean.collect():
        assert not brute(items, C.split_words(r.text))[0]
        if r.doc_id is not None and not brute(items, C.split_words(texts[r.doc_id]))[0]:
            assert r.text == texts[r.doc_id]
        elif r.text is not None:
            assert r.n_chars == len(r.text)


def test_one_block(spark, monkeypatch):
    check(spark, 10**9, monkeypatch)


def test_many_blocks(spark, monkeypatch):
    check(spark, 200, monkeypatch)


def test_empty_tables(spark):
    docs = documents(spark, odd_rows())
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert C.hits(docs, none).where(F.size("spans") > 0).count() == 0
    assert C.hits(docs.where(F.lit(False)), none).count() == 0


def test_cut_keeps_what_surrounds():
    text = "Intro, one two! three. Rest"
    assert C.cut(text, [(1, 4)]) == "Intro, . Rest"


def test_blocks_do_not_change_what_is_cut(spark, monkeypatch):
    """Windows of two blocks that overlap, and a window that the cut of a later block brings together."""
    w, a, b = (sentence(k, n).split() for k, n in ((70, 14), (71, 10), (72, 10)))
    items = [(1, " ".join(w[:10])), (2, " ".join(w[4:])), (3, " ".join(a)), (4, " ".join(b)), (5, " ".join(w[:10]))]
    rows = [
        (1, "Before it, " + " ".join(w) + " and after."),
        (2, "start " + " ".join(a[:5] + b + a[5:]) + " end"),
        (3, "x " + " ".join(b[:6] + a[:3] + w + a[3:] + b[6:]) + " y"),
        (4, " ".join(a + b)),
        (5, "nothing here"),
        (5, None),
        (None, " ".join(a)),
    ]
    docs = documents(spark, rows)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = {(1, "Before it,  and after."), (2, "start  end"), (3, "x  y"), (4, ""), (5, "nothing here"), (5, None), (None, "")}
    for parts in ([items], [items[:1], items[1:3], items[3:]], [items[k : k + 1] for k in (3, 2, 1, 0)]):
        monkeypatch.setattr(C, "blocks", lambda _, parts=parts: iter(parts))
        clean = C.remove(docs, bench)
        assert clean.schema == docs.schema
        assert clean.columns == docs.columns  # among them all names that the stage uses
        out = clean.collect()
        assert len(out) == len(rows) and {(r.doc_id, r.text) for r in out} == want
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out)
