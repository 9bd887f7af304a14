"""Quality rules as weak supervision, in DataFrame functions only.

Rules look at statistics of a text and vote for good, for bad, or abstain.  Nobody knows the truth, so
expectation-maximisation estimates how often each rule is right about good and about bad documents
from how the rules agree, together with the share of good ones.  A document is kept if the
posterior probability that it is good reaches one half and it passes the base checks.

The votes of a document are one of at most 3**rules patterns.  EM runs on the counted patterns, in one
row, and the posterior of a pattern goes back to the documents by a join with that small table.

Cases: a null text counts as an empty one: no words, base failed, not kept; repeated rows count each and give repeated
rows; of texts of any length the windows are sorted within the row; an empty table gives an
empty result; further columns are not read, or passed on untouched by ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import WORD, kept, words

#: Base checks: the least words, and the most repeated words in a hundred.
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = r"[#*$%&|<>]"
#: Words of a window that counts as repeated.
REPEAT = 3

#: EM: rounds, and where it starts: share of good documents, how often a vote on a good document says good,
#: and on a bad one bad.  A rule seldom blames a good document, and sees some kinds of bad ones only.
ROUNDS, GOOD, RIGHT_GOOD, RIGHT_BAD = 40, 0.8, 0.99, 0.2
#: Votes that each estimate counts as seen beforehand, at its starting value.
PSEUDO = 5.0


def repeated_words(w: Column) -> Column:
    """How many words lie in windows of ``REPEAT`` words that occur twice or more: the windows are sorted with
    their places, equal neighbours taken, and their places joined."""
    grams = F.transform(
        F.sequence(F.lit(1), F.size(w) - (REPEAT - 1)),
        lambda i: F.struct(
            F.concat_ws(" ", *(F.get(w, i + k) for k in range(-1, REPEAT - 1))).alias("g"), i.alias("i")
        ),
    )

    def places(rows: Column) -> Column:
        same = F.filter(
            rows,
            lambda r, k: (F.get(rows, k - 1)["g"] == r["g"]) | (F.get(rows, k + 1)["g"] == r["g"]),
        )
        return F.sort_array(F.transform(same, lambda r: r["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda p, k: F.least(F.lit(REPEAT), F.coalesce(F.get(at, k + 1) - p, F.lit(REPEAT)))),
            F.lit(0).cast("long"),
            lambda n, x: n + x,
        )

    # An array of one, transformed, names a value that is used more than once.
    once = F.transform(F.array(F.sort_array(grams)), lambda rows: covered_of(places(rows), covered))
    return F.when(F.size(w) < REPEAT, F.lit(0).cast("long")).otherwise(F.get(once, F.lit(0)))


def covered_of(at: Column, covered) -> Column:
    return F.get(F.transform(F.array(at), covered), F.lit(0))


def statistics(docs: DataFrame, carried: list[str]) -> DataFrame:
    """``carried`` columns and the statistics the rules look at."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(*carried, text.alias("t__"), words(text).alias("w__"), F.split(text, "\n").alias("l__"))
    full = F.filter("l__", lambda x: x.rlike(WORD))
    size = lambda column: F.char_length(column).cast("long")
    return split.select(
        *carried,
        F.size("w__").cast("long").alias("n_words"),
        size(F.array_join("w__", "")).alias("word_chars"),
        (size(F.col("t__")) - size(F.regexp_replace("t__", SYMBOLS, ""))).alias("n_symbols"),
        (F.size(full) - F.size(F.array_distinct(full))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w__")).alias("n_repeat_words"),
        F.size(full).cast("long").alias("n_lines"),
        (size(F.col("t__")) - size(F.regexp_replace("t__", "[A-Z]", ""))).alias("n_capitals"),
        (size(F.col("t__")) - size(F.regexp_replace("t__", r"\p{L}", ""))).alias("n_letters"),
        (size(F.col("t__")) - size(F.regexp_replace("t__", "[.]", ""))).alias("n_stops"),
        (size(F.col("t__")) - size(F.regexp_replace("t__", "[!?]", ""))).alias("n_marks"),
    )


def votes() -> Column:
    """One vote of each rule: 1 good, -1 bad, 0 abstains."""
    n = F.greatest(F.col("n_words"), F.lit(1))

    def rule(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    return F.array(
        rule(F.col("n_symbols") * 10 > n, F.col("n_symbols") * 50 <= n),
        rule(F.col("n_repeat_words") * 4 > n, F.col("n_repeat_words") * 10 <= n),
        rule(F.col("n_dup_lines") * 10 > F.col("n_lines") * 3, (F.col("n_dup_lines") == 0) & (F.col("n_lines") > 2)),
        rule(
            (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 12 * n),
            F.col("word_chars").between(4 * n, 9 * n),
        ),
        rule(F.col("n_capitals") * 5 > F.col("word_chars"), F.col("n_capitals") * 20 <= F.col("word_chars")),
        rule(F.col("n_stops") * 100 < n, F.col("n_stops") * 40 >= n),
        rule(F.col("n_marks") * 10 > n, F.col("n_marks") * 50 <= n),
        rule(F.col("n_letters") * 10 < F.col("word_chars") * 9, F.col("n_letters") * 100 >= F.col("word_chars") * 94),
    )


RULES = 8


def _posterior(pattern: Column, model: Column) -> Column:
    """Probability of good for a vote pattern: the prior odds times each vote's likelihood ratio."""
    evidence = F.aggregate(
        F.zip_with(
            pattern,
            model["rules"],
            lambda v, r: F.when(v == 1, F.log(r["good"] / (1 - r["bad"])))
            .when(v == -1, F.log((1 - r["good"]) / r["bad"]))
            .otherwise(F.lit(0.0)),
        ),
        F.log(model["share"] / (1 - model["share"])),
        lambda s, x: s + x,
    )
    return 1 / (1 + F.exp(-evidence))


def _model(share: Column, rules: Column) -> Column:
    return F.struct(share.alias("share"), rules.alias("rules"))


def _rule(good: Column, bad: Column) -> Column:
    """A rule's rates, which are at least as good as chance together."""
    bad = F.greatest(bad, 1 - good)
    return F.struct(good.alias("good"), bad.alias("bad"))


def posteriors(voted: DataFrame) -> DataFrame:
    """(votes, n, p_good) of each pattern of votes; at most 3**RULES rows."""
    counted = voted.groupBy("votes").agg(F.count("*").alias("n"))
    # In order, so that sums of doubles come out alike in every run.
    table = counted.agg(F.sort_array(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("p"))
    start = _model(
        F.lit(GOOD), F.array(*(_rule(F.lit(RIGHT_GOOD), F.lit(RIGHT_BAD)) for _ in range(RULES)))
    )

    def total(rows: Column, value) -> Column:
        return F.aggregate(rows, F.lit(0.0), lambda s, x: s + value(x))

    def step(model: Column, _: Column) -> Column:
        seen = F.transform(
            "p",
            lambda x: F.struct(
                x["votes"].alias("votes"), x["n"].alias("n"), _posterior(x["votes"], model).alias("q")
            ),
        )
        return F.get(F.transform(F.array(seen), refit), F.lit(0))

    def refit(seen: Column) -> Column:
        n = total(seen, lambda x: x["n"])
        good = total(seen, lambda x: x["n"] * x["q"])

        def rates(j: int) -> Column:
            vote = lambda x: F.get(x["votes"], F.lit(j))
            on = lambda x, v: F.when(vote(x) == v, x["n"]).otherwise(0.0)
            right_good = total(seen, lambda x: on(x, 1) * x["q"])
            wrong_good = total(seen, lambda x: on(x, -1) * x["q"])
            right_bad = total(seen, lambda x: on(x, -1) * (1 - x["q"]))
            wrong_bad = total(seen, lambda x: on(x, 1) * (1 - x["q"]))
            return _rule(
                (right_good + PSEUDO * RIGHT_GOOD) / (right_good + wrong_good + PSEUDO),
                (right_bad + PSEUDO * RIGHT_BAD) / (right_bad + wrong_bad + PSEUDO),
            )

        return _model((good + PSEUDO * GOOD) / (n + PSEUDO), F.array(*(rates(j) for j in range(RULES))))

    fitted = table.select("p", F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step).alias("model"))
    return fitted.select("model", F.explode("p").alias("x")).select(
        F.col("x.votes").alias("votes"), F.col("x.n").cast("long").alias("n"), _posterior(F.col("x.votes"), F.col("model")).alias("p_good")
    )


def _failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, base statistics, base_failed, kept, p_good) of each document."""
    seen = kept(statistics(docs, ["doc_id"]), "rules").withColumn("votes", votes())
    table = posteriors(seen).select(F.col("votes").alias("pattern"), "p_good")
    failed = _failed()
    # At most 3**RULES rows.
    return seen.join(F.broadcast(table), F.col("votes") == F.col("pattern")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("p_good") >= 0.5)).alias("kept"),
        "p_good",
    )


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    seen = kept(statistics(keyed, ["doc_id", "text_key"]), "rules").withColumn("votes", votes())
    table = posteriors(seen).select(F.col("votes").alias("pattern"), "p_good")
    bad = (
        seen.join(F.broadcast(table), F.col("votes") == F.col("pattern"))
        .where(_failed() | (F.col("p_good") < 0.5))
        .select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key"))
        .distinct()
    )
    # Id and text together, so that rows of one id with different texts are told apart.
    return docs.join(
        bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["bad_key"]), "left_anti"
    )
