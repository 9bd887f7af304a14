import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystar.llm import pieces
from tallystar.llm.queries import piece_model
from tests.llm.util import documents, odd_rows

MODEL = piece_model()


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def same(library, texts):
    own = pieces.codec(MODEL)
    ids, at = own.encode(texts)
    want = library.encode(texts, add_eos=True)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want
    assert own.decode(ids, at) == library.decode(want)


def test_random_characters(library):
    rng = random.Random(1)
    alphabet = "aaabbbccde   \n\t▁éñ🦙the12.,\x00- "
    same(library, ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(2000)])


def test_random_pieces(library):
    rng = random.Random(2)
    pool = [p.replace("▁", " ") for i in range(32000) for p in [library.id_to_piece(i)] if not p.startswith("<")]
    same(library, ["".join(rng.choice(pool) for _ in range(rng.randint(0, 25))) for _ in range(3000)])


def test_repetition_and_spaces(library):
    same(library, [" " * n for n in range(80)] + ["ab" * n for n in range(60)] + ["a" * 3000, "=-" * 500, "x" + " " * 500 + "y"])


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    for _ in range(3):
        same(library, ["one two three four five", "two six seven"])


def test_documents(spark, library):
    rows = odd_rows()
    docs = documents(spark, rows)
    out = pieces.round_trip(docs, MODEL, with_ids=True).collect()
    assert len(out) == len(rows)
    texts = dict(rows)
    for r in out:
        if r.doc_id is not None:
            want = library.encode(texts[r.doc_id] or "", add_eos=True)
            assert r.ids == want and r.n_tokens == len(want)
            assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(library.decode(want).encode()).hexdigest()
    ids = pieces.encode(docs, MODEL)
    back = {r.doc_id: r.text for r in pieces.decode(ids, MODEL).collect()}
    assert all(back[i] == (t or "") for i, t in rows if i is not None)
    assert pieces.round_trip(docs.where(F.lit(False)), MODEL).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>")
    assert [r.text for r in pieces.decode(nothing, MODEL).collect()] == [""]


def test_merge_of_nothing():
    flat, count = pieces.codec(MODEL).merge([])
    assert len(flat) == 0 and len(count) == 0 and np.asarray(count).dtype.kind == "i"
