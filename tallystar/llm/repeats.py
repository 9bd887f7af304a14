"""Long repeats across documents, found with recompression and removed.

A document is a sequence of word symbols.  Rounds of recompression name it upwards: first runs of
one word, then pairs of neighbours that a coin on their names sets apart (left, right).  Names are
hashes of what they stand for, so all tasks name alike without meeting, and equal
stretches of words get equal interior symbols.  Each symbol carries the words its making depended
on; in any window of ``WINDOW`` words that holds all of these, the symbol is there too.  Spark
brings equal high-level symbols of different texts together: a window that holds a symbol of no other
text has no other place, and drops out.  The windows that are left are verified by a 128-bit hash of
their words, of which the smallest document is found; those of larger documents are removed.

Equal texts are worked on once, as the one of the smallest id.

Cases: a null text has no words; one of fewer than ``WINDOW`` words has no window and stays whole; repeated
rows (same id) give equal rows and do not remove each other, nor do different texts of one id;
a row without an id stays whole, and removes nothing; very long texts are steps of their own; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallystar.llm.common import kept, per_text, steps

WINDOW = 50
#: Rounds of pair naming, the most words of a symbol, and the least of one worth comparing.
ROUNDS, LONGEST, SHORTEST = 8, 16, 4

FAR = 1 << 29
U = np.uint64
_A, _B, _C = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers without pattern."""
    x = (x ^ (x >> U(30))) * _A
    x = (x ^ (x >> U(27))) * _B
    return x ^ (x >> U(31))


def word_names(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit name of every word, and the text it is of."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    name = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(texts)), U, int(size.sum()))
    return name, np.repeat(np.arange(len(texts), dtype=np.int32), size)


class Symbols:
    """Symbols over the words of a step: name, words [start, end), whether it is the last of its text,
    and the words [low, high) that the making of each depended on (beyond all words where an end of
    the text was seen)."""

    def __init__(self, name: np.ndarray, text: np.ndarray):
        at = np.arange(len(name), dtype=np.int32)
        self.name, self.start, self.end, self.low, self.high = name, at, at + 1, at.copy(), at + 1
        self.last = np.r_[text[1:] != text[:-1], np.ones(min(1, len(text)), bool)]

    def _lean(self, who: np.ndarray, to: int, low: np.ndarray, high: np.ndarray) -> None:
        """The symbols ``who`` depend on the neighbour one to the left (-1) or right (1) as well."""
        edge = self.last[who] if to == 1 else np.where(who > 0, self.last[who - 1], True)
        if to == 1:
            self.high[who[edge]] = FAR
        else:
            self.low[who[edge]] = -FAR
        who = who[~edge]
        self.low[who] = np.minimum(self.low[who], low[who + to])
        self.high[who] = np.maximum(self.high[who], high[who + to])

    def _join(self, head: np.ndarray, name: np.ndarray) -> None:
        """One symbol of each stretch that begins at a head."""
        after = np.r_[head[1:], len(self.end)] - 1
        self.name, self.start, self.end, self.last = name, self.start[head], self.end[after], self.last[after]
        # What a stretch depends on is that of its ends: their bounds are the outermost.
        self.low, self.high = (
            np.minimum(self.low[head], self.low[after]),
            np.maximum(self.high[head], self.high[after]),
        )

    def runs(self) -> None:
        """Name each run of one symbol by the symbol and its length."""
        every = np.arange(len(self.name))
        low, high = self.low.copy(), self.high.copy()
        self._lean(every, -1, low, high)
        self._lean(every, 1, low, high)
        head = np.flatnonzero(np.r_[True, (self.name[1:] != self.name[:-1]) | self.last[:-1]])
        count = np.diff(np.r_[head, len(self.name)])
        name = self.name[head]
        long = np.flatnonzero(count > 1)
        name[long] = mix(name[long] + mix(count[long].astype(U) * _C))
        self._join(head, name)

    def pairs(self, turn: int) -> None:
        """Name the pairs of a left and a right symbol of this turn's coins."""
        coin = (self.name * (_A + U(2 * turn)) >> U(63)).astype(bool)  # true: left of a pair
        pair = np.zeros(len(coin), bool)
        pair[:-1] = coin[:-1] & ~coin[1:] & ~self.last[:-1] & (self.end[1:] - self.start[:-1] <= LONGEST)
        alone = ~pair & (self.end - self.start < LONGEST)
        alone[1:] &= ~pair[:-1]
        low, high = self.low.copy(), self.high.copy()
        self._lean(np.flatnonzero(alone & coin), 1, low, high)
        self._lean(np.flatnonzero(alone & ~coin), -1, low, high)
        inner = np.zeros(len(coin), bool)
        inner[1:] = pair[:-1]
        head = np.flatnonzero(~inner)
        name = self.name[head]
        made = np.flatnonzero(pair)
        name[pair[head]] = mix(self.name[made] * _C + mix(self.name[made + 1]))
        self._join(head, name)


def recompress(name: np.ndarray, text: np.ndarray, way: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after all rounds, long enough to be compared, that some window can hold with all they
    depended on: name, and the first and last word such a window may start from.  ``way`` tells
    the coins of one parse from those of another."""
    if not len(name):
        return name, np.empty(0, np.int32), np.empty(0, np.int32)
    made = Symbols(name, text)
    made.runs()
    for turn in range(ROUNDS):
        made.pairs(way * ROUNDS + turn)
    use = (made.end - made.start >= SHORTEST) & (made.high - made.low <= WINDOW)
    low, high = made.low[use], made.high[use]
    bounds = np.searchsorted(text, np.arange(text[-1] + 2))
    begin, end = bounds[text[low]], bounds[text[low] + 1]
    first, last = np.maximum(high - WINDOW, begin), np.minimum(low, end - WINDOW)
    good = first <= last
    return mix(made.name[use][good] + U(way)), first[good], last[good]


def parses(name: np.ndarray, text: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """Symbols to compare, in order of texts: name, first and last window, and the parse they are of; and the
    windows that none can rule out.  A second parse adds symbols for the windows that the first leaves
    open.  Which these are depends on their words alone, so it is the same wherever they stand;
    only these may a symbol of the second parse rule out."""
    symbols = recompress(name, text, 0)
    symbols = (*symbols, np.zeros(len(symbols[0]), np.int8))
    free = whole_windows(text) & ~ruled_out(*symbols[1:3], len(name))
    if free.any():
        more = recompress(name, text, 1)
        sums = np.r_[0, np.cumsum(free)]
        useful = sums[more[2] + 1] > sums[more[1]]
        more = (*(x[useful] for x in more), np.ones(int(useful.sum()), np.int8))
        free &= ~ruled_out(*more[1:3], len(name))
        symbols = tuple(np.r_[a, b] for a, b in zip(symbols, more))
        order = np.argsort(symbols[1], kind="stable")
        symbols = tuple(x[order] for x in symbols)
    return symbols, free


def ruled_out(first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` words whether its window holds one of the symbols."""
    change = np.bincount(first, minlength=n + 1) - np.bincount(last + 1, minlength=n + 1)
    return np.cumsum(change)[:n] > 0


def whole_windows(text: np.ndarray) -> np.ndarray:
    """For each word whether a window from it ends in the same text."""
    inside = np.zeros(len(text), bool)
    if len(text) >= WINDOW:
        inside[: len(text) - WINDOW + 1] = text[WINDOW - 1 :] == text[: len(text) - WINDOW + 1]
    return inside


def window_hashes(name: np.ndarray, base: np.uint64) -> np.ndarray:
    """A polynomial hash of the window from each word, by doubling; the last words wrap around."""
    total, done, part, size, rest = np.zeros(len(name), U), 0, name, 1, WINDOW
    power = np.array([base])
    while rest:
        if rest & 1:
            total = total * power + np.roll(part, -done)
            done += size
        part, power, size, rest = part * power + np.roll(part, -size), power * power, size * 2, rest >> 1
    return mix(total)


def split(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _survey(texts: list[str | None]) -> dict[str, object]:
    """Of each text: its size, its hash, the names of its symbols with the windows they can rule out, and
    whether it has windows that none can."""
    words = [split(t) for t in texts]
    name, text = word_names(words)
    (symbol, first, last, way), free = parses(name, text)
    open_ = np.zeros(len(words), bool)
    open_[text[free]] = True
    offset = np.searchsorted(text, np.arange(len(words)))
    of = text[first]
    cut = np.searchsorted(of, np.arange(1, len(words)))
    return {
        "n_words": [len(w) for w in words],
        "kept_sha256": [sha(w) for w in words],
        "names": np.split(symbol.view(np.int64), cut),
        "first": np.split((first - offset[of]).astype(np.int32), cut),
        "last": np.split((last - offset[of]).astype(np.int32), cut),
        "way": np.split(way, cut),
        "open": open_,
    }


def _windows(batches: Iterator[pa.RecordBatch], kinds: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Hash of every window that holds no symbol of this text alone.  Where a smaller document of the
    step has the window, that is known at once (``found``) and joined to stretches of starts."""
    for batch in batches:
        for part in steps(batch, "text"):
            words = [split(t) for t in part.column("text").to_pylist()]
            name, text = word_names(words)
            offset = np.searchsorted(text, np.arange(len(words)))
            size = pc.list_value_length(part.column("first")).to_numpy()
            own = np.repeat(np.arange(len(words)), size)
            alone = np.ones(len(own), bool)
            begin = np.cumsum(size) - size
            common = part.column("shared")
            several = pc.fill_null(pc.list_value_length(common), 0).to_numpy(zero_copy_only=False)
            alone[np.repeat(begin, several) + common.flatten().to_numpy()] = False
            first, last, way = (part.column(c).flatten().to_numpy().astype(np.int64) for c in ("first", "last", "way"))
            first, last = first + offset[own], last + offset[own]

            def out_by(which: np.ndarray) -> np.ndarray:
                return ruled_out(first[which], last[which], len(name))  # noqa: B023

            out = out_by(alone & (way == 0)) | ~out_by(way == 0) & out_by(alone & (way == 1))
            start = np.flatnonzero(whole_windows(text) & ~out)
            if not len(start):
                continue
            one = window_hashes(name, _A | U(1))[start]
            two = window_hashes(mix(name ^ _C), _B | U(1))[start]
            ids = part.column("doc_id").to_numpy()
            doc = ids[text[start]]
            order = np.lexsort((doc, two, one))
            a, b, d = one[order], two[order], doc[order]
            head = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            least = np.repeat(d[head], np.diff(np.r_[head, len(d)]))
            found = np.zeros(len(start), bool)
            found[order] = d > least
            # Stretches of found starts, one after the other in one text.
            at = start[found]
            fresh = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(text[at]) != 0)]) if len(at) else at
            length = np.diff(np.r_[fresh, len(at)])
            rows = np.r_[np.flatnonzero(~found), np.flatnonzero(found)[fresh]]
            n = np.r_[np.ones(int((~found).sum()), np.int64), length]
            row_text = text[start[rows]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(one[rows].view(np.int64)),
                    pa.array(two[rows].view(np.int64)),
                    pa.array(ids[row_text]),
                    part.column("part").take(pa.array(row_text)),
                    pa.array((start[rows] - offset[row_text]).astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                    pa.array(found[rows]),
                ],
                schema=kinds,
            )


def _without(batches: Iterator[pa.RecordBatch], kinds: pa.Schema, rows_too: bool) -> Iterator[pa.RecordBatch]:
    """What stays of each text when the words of the windows from ``starts`` go."""
    for batch in batches:
        for part in steps(batch, "text"):
            gone, hashes, texts = [], [], []
            for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                words = split(text)
                change = np.zeros(len(words) + 1, np.int64)
                for s in spans:
                    change[s["start"]] += 1
                    change[s["start"] + s["n"] - 1 + WINDOW] -= 1
                stay = np.cumsum(change)[: len(words)] == 0
                rest = [w for w, s in zip(words, stay.tolist()) if s]
                gone.append(len(words) - len(rest))
                hashes.append(sha(rest))
                texts.append(b" ".join(rest).decode("utf-8", "surrogatepass") if rows_too else None)
            columns = [part.column("doc_id"), part.column("part"), pa.array(gone, pa.int64()), pa.array(hashes)]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(texts)] if rows_too else []), schema=kinds)


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]) of each document, every word gone that lies in a
    window whose words also start in a document of a smaller id.  ``kept_text`` is null where nothing was removed."""
    whole = docs.select("doc_id", "text", F.substring(F.unhex(F.sha2("text", 256)), 1, 16).alias("text_key"))
    id_type = whole.schema["doc_id"].dataType.simpleString()
    fields = (
        "n_words bigint, kept_sha256 string, names array<bigint>, first array<int>, last array<int>, way array<tinyint>, open boolean"
    )
    survey = kept(per_text(whole, ["doc_id", "text_key"], _survey, fields), "repeats-survey")

    part = lambda: F.hash("text_key").alias("part")  # noqa: E731  tells texts of one id apart
    with_id = survey.where(F.col("doc_id").isNotNull())
    # Of equal texts the one of the smallest id is worked on.
    firsts = survey.groupBy("text_key").agg(F.min("doc_id").alias("first_id"))
    # Only numbers travel with the names: those rows are the most that is shuffled here.
    places = with_id.select(
        "doc_id", part(), F.xxhash64("text_key").alias("of"), F.posexplode("names").alias("place", "name")
    )
    shared = (
        places.groupBy("name")
        .agg(F.min("of").alias("one"), F.max("of").alias("other"))
        .where(F.col("one") < F.col("other"))
        .select("name")
    )
    # The symbols that another text has too; texts without any and without open windows drop out.
    common = (
        places.drop("of")
        .join(shared, "name")
        .groupBy(F.col("doc_id").alias("common_id"), F.col("part").alias("common_part"))
        .agg(F.collect_set("place").alias("shared"))
    )
    chosen = firsts.where(F.col("first_id").isNotNull()).select("first_id", F.hash("text_key").alias("first_part"))
    looked = (
        with_id.select(
            F.col("doc_id").alias("look_id"), F.hash("text_key").alias("look_part"), "first", "last", "way", "open"
        )
        .join(chosen, (F.col("look_id") == F.col("first_id")) & (F.col("look_part") == F.col("first_part")))
        .join(common, (F.col("look_id") == F.col("common_id")) & (F.col("look_part") == F.col("common_part")), "left")
        .where(F.col("open") | F.col("shared").isNotNull())
        .select("look_id", "look_part", "first", "last", "way", "shared")
    )
    text = whole.select("doc_id", part(), "text").where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    schema = T.StructType.fromDDL(
        f"one bigint, two bigint, doc_id {id_type}, part int, start int, n int, found boolean"
    )
    windows = (
        text.join(looked, (F.col("doc_id") == F.col("look_id")) & (F.col("part") == F.col("look_part")))
        .select("doc_id", "part", "text", "first", "last", "way", "shared")
        .mapInArrow(lambda rows: _windows(rows, to_arrow_schema(schema)), schema)
    )
    least = F.min("doc_id").over(Window.partitionBy("one", "two"))
    spans = (
        windows.withColumn("least", least)
        .where(F.col("found") | (F.col("least") < F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("span_id"), F.col("part").alias("span_part"))
        .agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    )
    out = T.StructType.fromDDL(
        f"changed_id {id_type}, changed_part int, gone bigint, rest_sha256 string"
        + (", rest string" if with_text else "")
    )
    changed = (
        text.join(spans, (F.col("doc_id") == F.col("span_id")) & (F.col("part") == F.col("span_part")))
        .select("doc_id", "part", "text", "spans")
        .mapInArrow(lambda rows: _without(rows, to_arrow_schema(out), with_text), out)
    )
    changed = changed.dropDuplicates(["changed_id", "changed_part"])
    rows = survey.select("doc_id", "text_key", "n_words", "kept_sha256").join(
        firsts.select(F.col("text_key").alias("key"), "first_id"), F.col("text_key").eqNullSafe(F.col("key")), "left"
    )
    rows = rows.join(
        changed,
        (F.col("doc_id") == F.col("changed_id")) & (F.hash("text_key") == F.col("changed_part")),
        "left",
    )
    copy = F.coalesce((F.col("doc_id") > F.col("first_id")) & (F.col("n_words") >= WINDOW), F.lit(False))
    return rows.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256))
        .otherwise(F.coalesce("rest_sha256", "kept_sha256"))
        .alias("kept_sha256"),
        *([F.when(copy, F.lit("")).otherwise(F.col("rest")).alias("kept_text")] if with_text else []),
    )
