import math
import re

import pytest
from pyspark.sql import functions as F

from tallystar.llm import rules
from tests.llm.util import by_id, documents, odd_rows, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    again = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)} if len(words) < 2000 else None
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        None if again is None else len(again),
    )


def rows():
    more = [
        (40 + k, "\n".join([sentence(k, 20)] * 3 + [sentence(k + 1, 40)])) for k in range(4)
    ] + [(60 + k, " ".join(w + "$$$" for w in sentence(k, 90).split())) for k in range(8)]
    more += [(80 + k, sentence(k + 100, 150) + ".") for k in range(30)]
    more += [(200, "  x   y\x1f z"), (201, "a b c a b c a b c d\n\n\n a \n a")]
    return odd_rows() + more


def test_base_columns(spark):
    table = rows()
    out = rules.judge(documents(spark, table))
    assert out.count() == len(table)
    texts = dict(table)
    for i, r in by_id(out).items():
        n, chars, symbols, lines, repeats = brute(texts[i])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == (n, chars, symbols, lines)
        if repeats is not None:
            assert r.n_repeat_words == repeats
        assert r.base_failed == (n < 50 or 100 * r.n_repeat_words > 50 * n)
        assert r.kept == (not r.base_failed and r.p_good >= 0.5)


def em(counted):
    """The same EM in plain Python."""
    share, rates = rules.GOOD, [(rules.RIGHT_GOOD, max(rules.RIGHT_BAD, 1 - rules.RIGHT_GOOD))] * rules.RULES

    def posterior(v):
        s = math.log(share / (1 - share))
        for vote, (g, b) in zip(v, rates):
            s += math.log(g / (1 - b)) if vote == 1 else math.log((1 - g) / b) if vote == -1 else 0
        return 1 / (1 + math.exp(-s))

    for _ in range(rules.ROUNDS):
        seen = [(v, n, posterior(v)) for v, n in counted]
        new = []
        for j in range(rules.RULES):
            rg = sum(n * q for v, n, q in seen if v[j] == 1)
            wg = sum(n * q for v, n, q in seen if v[j] == -1)
            rb = sum(n * (1 - q) for v, n, q in seen if v[j] == -1)
            wb = sum(n * (1 - q) for v, n, q in seen if v[j] == 1)
            g = (rg + rules.PSEUDO * rules.RIGHT_GOOD) / (rg + wg + rules.PSEUDO)
            b = (rb + rules.PSEUDO * rules.RIGHT_BAD) / (rb + wb + rules.PSEUDO)
            new.append((g, max(b, 1 - g)))
        good, total = sum(n * q for _, n, q in seen), sum(n for _, n, _ in seen)
        share, rates = (good + rules.PSEUDO * rules.GOOD) / (total + rules.PSEUDO), new
    return {tuple(v): posterior(v) for v, _ in counted}


def test_em_equals_plain_python(spark):
    voted = rules.statistics(documents(spark, rows()), ["doc_id"]).withColumn("votes", rules.votes())
    table = rules.posteriors(voted).collect()
    want = em(sorted((tuple(r.votes), r.n) for r in table))
    for r in table:
        assert r.p_good == pytest.approx(want[tuple(r.votes)], rel=1e-6)


def test_junk_goes_and_prose_stays(spark):
    table = rows()
    docs = documents(spark, table)
    kept = rules.keep(docs)
    assert kept.schema == docs.schema
    ids = {r.doc_id for r in kept.collect()}
    assert {80 + k for k in range(30)} <= ids
    assert not ids & {60 + k for k in range(8)} and not ids & {1, 2, 3, 8, 9, 11}
    verdict = {i for i, r in by_id(rules.judge(docs)).items() if r.kept}
    assert ids - {None} == verdict


def test_empty_table(spark):
    docs = documents(spark, odd_rows()).where(F.lit(False))
    assert rules.judge(docs).count() == 0 and rules.keep(docs).count() == 0


def test_no_python_in_the_plan(spark):
    plan = rules.judge(documents(spark, odd_rows()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
