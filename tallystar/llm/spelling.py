"""Spelling variants: words one edit from each other, found by bidirectional FM-index search schemes.

A word asks for the words one inserted, deleted or replaced code point away.  It is cut in two halves, one of which such a word
has unchanged: at its start or at its end.  So words meet by their halves: a stored word is dealt by each start and end that
a word asking for it can have, an asking word by its own two halves.  Keys with many words are spread over several shards, of each of which
the asking words have a copy.

A shard is one text, its words between delimiters, with an index of the text and one of its reverse.  A range of suffixes in the one and
the matching range in the other are extended together, to either side by a symbol.  The search scheme matches the one half
exactly, and from there on the other half with at most one error, up to the delimiter.  A whole word begins with the delimiter,
and so the place of its range among the suffixes that do is the word's place in order.

Only counts of words, and the best of the words near one, are shuffled afterwards.

Cases: a null text has no words; a null id is written as nothing before the colon; repeated rows count again; ties of the number of
occurrences go by code points; an empty table, or one without words, gives an empty result; further columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import kept, steps

#: Words of at least so many code points and occurrences; every so manieth run, by its hash, loses a code point.
LENGTH, OCCURRENCES, EVERY = 7, 2, 31
#: A form occurs so many times as often as its word.
TIMES = 10
#: Stored words of a shard, and of a key that is spread over shards of its own, on average.
SHARD_WORDS = 40_000
#: Asking words that are searched for at once, and their symbols, each as long as the longest; a longer word is searched for alone.
ASK_WORDS, ASK_SYMBOLS = 20_000, 1 << 20
#: States of the search that are extended at once.
PIECE = 1 << 14

RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{LENGTH},}}")
_LOWER = {c: c + 32 for c in range(65, 91)}
_CHECK = 8  # symbols between two rows of an index's table of counts


def vocabulary(docs: DataFrame, occurrences: int = OCCURRENCES) -> DataFrame:
    """(word, n): the words of the documents, with one code point deleted where a run's hash says so."""
    narrow = docs.select("doc_id", "text")
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                found: Counter[str] = Counter()
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    start = "" if doc is None else str(doc)
                    for run, n in Counter(RUN.findall((text or "").translate(_LOWER))).items():
                        h = zlib.crc32(f"{start}:{run}".encode())
                        if h % EVERY == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                        if len(run) >= LENGTH:
                            found[run] += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], schema=schema
                )

    counted = narrow.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= occurrences)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by prefix doubling; the last symbol is unique and least."""
    n = len(text)
    rank, width = text.astype(np.int64), 1
    while True:
        second = np.zeros(n, np.int64)
        second[: max(0, n - width)] = rank[width:] + 1
        key = rank * (n + int(text.max()) + 2) + second
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.r_[0, np.cumsum(np.diff(key[order]) != 0)]
        width *= 2
        if rank[order[-1]] == n - 1:
            return order


class Ranks:
    """How often each symbol is among the first i symbols of a transform."""

    def __init__(self, bwt: np.ndarray, symbols: int):
        rows = -(-len(bwt) // _CHECK) + 1
        self.bwt = np.full(rows * _CHECK, symbols, np.int16)
        self.bwt[: len(bwt)] = bwt
        table = np.zeros((rows, symbols + 1), np.int32)
        np.add.at(table, (np.arange(len(self.bwt) - _CHECK) // _CHECK + 1, self.bwt[:-_CHECK]), 1)
        self.table = np.cumsum(table, axis=0, dtype=np.int32)
        self.symbols = symbols

    def __call__(self, at: np.ndarray) -> np.ndarray:
        row, rest = at // _CHECK, at % _CHECK
        out = self.table[row]
        every = np.arange(len(at))
        for k in range(_CHECK - 1):
            more = np.flatnonzero(rest > k)
            if len(more):
                out[every[more], self.bwt[row[more] * _CHECK + k]] += 1
        return out[:, : self.symbols]


class Words:
    """A bidirectional index of sorted distinct words: symbol 0 ends the text, 1 is the delimiter, then the code points in order."""

    def __init__(self, words: list[str]):
        self.words = sorted(words)
        joined = "\n" + "\n".join(self.words) + "\n"  # below all letters, and in no word
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        self.alphabet = np.unique(points)
        body = np.searchsorted(self.alphabet, points) + 1
        self.symbols = len(self.alphabet) + 1
        self.size = len(body) + 1
        self.before = np.r_[0, np.cumsum(np.bincount(np.r_[body, 0], minlength=self.symbols))][:-1]
        self.left, self.right = (self._ranks(np.r_[b, 0]) for b in (body, body[::-1]))

    def _ranks(self, text: np.ndarray) -> Ranks:
        return Ranks(text[suffix_order(text) - 1], self.symbols)

    def coded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words as rows of symbols with a delimiter at either end, and how long the rows are; a code point that is in no
        stored word has a number beyond all symbols."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        at = np.searchsorted(self.alphabet, points)
        known = self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == points
        rows = np.ones((len(words), int(size.max()) + 2), np.int64)
        inside = np.arange(rows.shape[1] - 2)[None, :] < size[:, None]
        rows[:, 1:-1][inside] = np.where(known, at + 1, self.symbols)
        return rows, size + 2

    def search(self, words: list[str], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``words``, place in ``self.words``) of words one edit apart that have the first half of the word unchanged,
        or, where ``ends``, the second."""
        rows, size = self.coded(words)
        # The second half is searched as the first one of the word read backwards, in the index of the reverse.
        back = np.arange(rows.shape[1])[None, :]
        turned = np.where(back < size[:, None], np.take_along_axis(rows, np.maximum(size[:, None] - 1 - back, 0), 1), 1)
        out = [(np.empty(0, np.int64),) * 2]
        for end in (False, True):
            some = np.flatnonzero(ends == end)
            if len(some):
                exact = half(size[some] - 2) if not end else size[some] - 2 - half(size[some] - 2)
                ask, low = self._scheme((turned if end else rows)[some], size[some], exact + 1, end)
                out.append((some[ask], low))
        place, found = map(np.concatenate, zip(*out))
        return place, found

    def _scheme(self, rows: np.ndarray, size: np.ndarray, exact: np.ndarray, end: bool) -> tuple[np.ndarray, np.ndarray]:
        """Extend ranges along the rows, the first ``exact`` symbols without an error, the others with one."""
        # ``low`` and ``width`` are the range in the text that is read backwards, ``other`` begins that in the other one.
        ranks = self.left if end else self.right
        ask = np.arange(len(rows))
        at, error = np.zeros(len(rows), np.int64), np.zeros(len(rows), bool)
        low, other = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        width = np.full(len(rows), self.size)
        found = [(np.empty(0, np.int64),) * 2]
        while len(ask):
            done = at == size[ask]
            hit = done & error
            # Both texts' ranges of a whole word have one suffix; the one of the text itself gives its place.
            found.append((ask[hit], (low if end else other)[hit]))
            parts = [tuple(x[:0] for x in (ask, at, error, low, other, width))]
            for k in np.split(np.flatnonzero(~done), range(PIECE, len(done), PIECE)):
                parts += self._steps(ranks, rows, exact, *(x[k] for x in (ask, at, error, low, other, width)))
            ask, at, error, low, other, width = map(np.concatenate, zip(*parts))
            # Ways to the same range, as to leave out either of two equal letters, are one.
            state = np.lexsort((low, width, error, at, ask))
            again = np.zeros(len(state), bool)
            again[1:] = np.logical_and.reduce([x[state][1:] == x[state][:-1] for x in (ask, at, error, low, width)])
            ask, at, error, low, other, width = (x[state[~again]] for x in (ask, at, error, low, other, width))
        ask, low = map(np.concatenate, zip(*found))
        # Suffixes that begin with the delimiter stand together: first the last one, which ends the text, then a word each.
        place = low - self.before[1] - 1
        pairs = np.unique(np.stack([ask, place]), axis=1) if len(ask) else np.empty((2, 0), np.int64)
        return pairs[0], pairs[1]

    def _steps(self, ranks: Ranks, rows: np.ndarray, exact: np.ndarray, *state: np.ndarray) -> list[tuple]:
        """What states become by one symbol of their word, or one error."""
        ask, at, error, low, other, width = state
        before = ranks(low)
        counts = ranks(low + width) - before
        smaller = np.cumsum(counts, axis=1) - counts
        symbol = rows[ask, at]
        parts = []

        def step(which: np.ndarray, by: np.ndarray, move: int, wrong: bool) -> None:
            parts.append(
                (
                    ask[which],
                    at[which] + move,
                    error[which] | wrong,
                    self.before[by] + before[which, by],
                    other[which] + smaller[which, by],
                    counts[which, by].astype(np.int64),
                )
            )

        known = np.flatnonzero(symbol < self.symbols)
        known = known[counts[known, symbol[known]] > 0]
        step(known, symbol[known], 1, False)
        free = np.flatnonzero(~error & (at >= exact[ask]))
        which, by = np.nonzero(counts[free][:, 2:])  # letters only
        which, by = free[which], by + 2
        step(which, by, 0, True)  # a letter more
        changed = (symbol[which] != by) & (symbol[which] != 1)
        step(which[changed], by[changed], 1, True)  # another letter
        fewer = free[symbol[free] != 1]  # a letter less
        parts.append((ask[fewer], at[fewer] + 1, np.ones(len(fewer), bool), low[fewer], other[fewer], width[fewer]))
        return parts


def batches(sizes: np.ndarray) -> Iterator[slice]:
    """Slices of ascending lengths, each of ``ASK_WORDS`` words and ``ASK_SYMBOLS`` symbols at most, or one word."""
    begin = 0
    while begin < len(sizes):
        some = sizes[begin : begin + ASK_WORDS]
        fit = int((some * np.arange(1, len(some) + 1) <= ASK_SYMBOLS).sum())
        yield slice(begin, begin + max(1, fit))
        begin += max(1, fit)


def half(length: np.ndarray | int):
    """Code points in the first half of a word."""
    return length // 2


def _keys(words: DataFrame, extra: list[int]) -> Column:
    """Hashes of the starts and the ends of ``word``, as (key, ends), for asking words ``extra`` code points longer."""
    length = F.length("word")
    starts, ends = [], []
    for more in extra:
        first = F.floor((length + more) / 2).cast("int")
        rest = length + more - first
        start, end = F.col("word").substr(F.lit(1), first), F.col("word").substr(length - rest + 1, rest)
        starts.append(F.struct(F.xxhash64(start, F.lit(0)).alias("key"), F.lit(False).alias("ends")))
        ends.append(F.struct(F.xxhash64(end, F.lit(1)).alias("key"), F.lit(True).alias("ends")))
    return F.array_distinct(F.array(*starts, *ends))


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, n_near, best): for each word of (word, n) with near words how many there are, and (n, word) of the one that
    occurs most, the first in code-point order of several."""
    # Read from either side: a word asks with its own halves; it is stored under those of words one code point shorter or longer, too.
    stored = words.select("word", "n", F.explode(_keys(words, [-1, 0, 1])).alias("k")).select("word", "n", "k.*")
    asking = words.select("word", F.explode(_keys(words, [0])).alias("k")).select("word", "k.*")
    total = words.count()
    shards = max(1, -(-total * 4 // shard_words))
    # Keys that alone would fill a shard; at most one for each ``shard_words`` stored rows, their table is joined by its size.
    hot = kept(
        stored.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > shard_words)
        .select(F.col("key").alias("hot"), F.ceil(F.col("n") / shard_words).cast("int").alias("parts")),
        "spelling-hot",
    )
    own = F.pmod("key", F.lit(shards)).cast("int")
    where = F.col("hot").isNotNull()
    part = F.when(where, F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")).otherwise(F.lit(0))
    # A shard is named by (hot key or null, place).
    shard = [F.col("hot").alias("one"), F.when(where, F.lit(None)).otherwise(own).alias("shard")]
    stored = stored.join(hot, F.col("key") == F.col("hot"), "left").select(*shard, part.alias("part"), "word", "n")
    stored = stored.distinct().select("*", F.lit(None).cast("boolean").alias("ends"))
    every = F.explode(F.when(where, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.lit(0))))
    asking = asking.join(hot, F.col("key") == F.col("hot"), "left").select(
        *shard, every.alias("part"), "word", F.lit(None).cast("bigint").alias("n"), "ends"
    )

    def match(frame: pd.DataFrame) -> pd.DataFrame:
        found = pd.DataFrame({"word": [], "n_near": [], "best_n": [], "best": []}).astype(
            {"word": str, "n_near": "int64", "best_n": "int64", "best": str}
        )
        there = frame["ends"].isna()
        if there.all() or not there.any():
            return found
        index = Words(frame["word"][there].to_list())
        n = dict(zip(frame["word"][there], frame["n"][there].astype("int64")))
        count = np.array([n[w] for w in index.words], np.int64)
        ask, ends = frame["word"][~there].to_numpy(object), frame["ends"][~there].to_numpy(bool)
        size = np.fromiter(map(len, ask), np.int64, len(ask))
        order = np.argsort(size, kind="stable")
        parts = [found]
        for batch in batches(size[order]):
            some, here = ask[order[batch]].tolist(), ends[order[batch]]
            at, place = index.search(some, here)
            # A word that shares the first half as well is found by that one.  A shift of equal letters gives the word itself.
            fresh = [
                index.words[p] != some[a] and not (here[a] and index.words[p].startswith(some[a][: half(len(some[a]))]))
                for a, p in zip(at.tolist(), place.tolist())
            ]
            at, place = at[fresh], place[fresh]
            best = np.lexsort((place, -count[place], at))
            at, place = at[best], place[best]
            firsts = np.flatnonzero(np.r_[True, np.diff(at) != 0]) if len(at) else np.empty(0, np.int64)
            parts.append(
                pd.DataFrame(
                    {
                        "word": [some[a] for a in at[firsts].tolist()],
                        "n_near": np.diff(np.r_[firsts, len(at)]),
                        "best_n": count[place[firsts]],
                        "best": [index.words[p] for p in place[firsts].tolist()],
                    }
                )
            )
        return pd.concat(parts)

    found = (
        asking.unionByName(stored.select(*asking.columns))
        .groupBy("one", "shard", "part")
        .applyInPandas(match, "word string, n_near bigint, best_n bigint, best string")
    )
    order = F.struct(-F.col("best_n"), "best")
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min_by(F.struct("best_n", "best"), order).alias("best")
    )


def variants(words: DataFrame, times: int = TIMES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for words (word, n)."""
    words = kept(words, "spelling-words")
    near = near_words(words, shard_words).withColumnRenamed("word", "word__")
    frequent = F.col("best.best_n") >= times * F.col("n")
    formed = kept(
        words.join(near, F.col("word") == F.col("word__"), "left").select(
            "word",
            F.when(frequent, F.col("best.best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(frequent, F.col("best.best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    # Each round doubles the steps a word has followed; a form occurs ``times`` as often, so the rounds are few.
    roots = formed.where(F.col("form").isNotNull()).select(F.col("word").alias("from__"), F.col("form").alias("root__"))
    while True:
        nexts = roots.select(F.col("from__").alias("at__"), F.col("root__").alias("next__"))
        joined = roots.join(nexts, F.col("root__") == F.col("at__"), "left")
        roots = kept(
            joined.select("from__", F.coalesce("next__", "root__").alias("root__"), F.col("next__").isNotNull().alias("moved__")),
            "spelling-roots",
        )
        if roots.where("moved__").isEmpty():
            break
        roots = roots.select("from__", "root__")
    return formed.join(roots, F.col("word") == F.col("from__"), "left").select(
        "word", "form", F.coalesce("root__", "word").alias("root"), "n", "n_near", "form_n"
    )
