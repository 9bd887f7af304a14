import random

import pytest
from pyspark.sql import functions as F

from tallystar.llm import counts
from tallystar.llm.queries import piece_model
from tests.llm.util import documents, odd_rows

MODEL = piece_model()


def brute(own, text):
    """Fewest tokens of a best segmentation, each pre-token on its own, without sharing."""
    total = 0
    for word in counts.PRETOKEN.findall("▁" + text.replace(" ", "▁")) if text else []:
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            options = [(best[end - 1][0] + own.unknown, best[end - 1][1] - 1)]
            for start in range(end):
                if word[start:end] in own.score:
                    s, n = best[start]
                    options.append((s + own.score[word[start:end]], n - 1))
            best.append(max(options))
        total -= best[-1][1]
    return total


def test_equals_unshared_scores(spark):
    own = counts.counter(MODEL)
    rng = random.Random(2)
    texts = ["".join(rng.choice("abet hin▁é🦙\n") for _ in range(rng.randint(0, 40))) for _ in range(500)]
    assert own.count(texts)[1] == [brute(own, t) for t in texts]


def test_equals_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    own = counts.counter(MODEL)
    model = tokenizers.models.Unigram([("<unk>", own.unknown), *own.score.items()], 0, False)
    library = tokenizers.Tokenizer(model)
    rng = random.Random(3)
    words = ["▁" + "".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, 14))) for _ in range(2000)]
    own.learn(list(set(words)))
    for w in words:
        assert own.terminal[w] == len(library.encode(w, add_special_tokens=False).tokens)


def test_odd_table(spark, monkeypatch):
    rows = odd_rows()
    docs = documents(spark, rows)
    out = counts.token_counts(docs, MODEL).collect()
    own = counts.counter(MODEL)
    texts = dict(rows)
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id is not None and len(texts[r.doc_id] or "") < 5000:
            assert r.n_tokens == brute(own, texts[r.doc_id] or "")
    assert counts.token_counts(docs.where(F.lit(False)), MODEL).count() == 0


def test_forgetting_changes_nothing(monkeypatch):
    own = counts.UnigramCounter(MODEL)
    before = own.count(["one two three", "two four"])
    monkeypatch.setattr(counts, "REMEMBERED", 1)
    assert own.count(["one two three", "two four"]) == before
