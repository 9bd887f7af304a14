"""Benchmark decontamination with an FM-index per training shard.

The words of the benchmark get numbers; every other word of a document separates, and stretches
between separators that are shorter than the shortest phrase hold no occurrence.  What is left of the
documents of a step is one shard: its suffix array gives the Burrows-Wheeler transform, a
wavelet tree over it answers rank queries, and all phrases are searched backwards at once, a
word a step.  Occurrences are located from sampled suffix positions by walking the transform, and
their words merge into removal spans.

The benchmark is collected in blocks of bounded size, each of which meets all documents; with
more than one block the hits of a document are brought together by document and text, and so are the spans to cut.

Cases: a null text or item has no words; an item of fewer than ``WINDOW`` words is one phrase, one
without words none; an item id may repeat and counts once; repeated documents give repeated rows; empty
tables give an empty result or no hits; further columns are not read, or passed on whatever their names; an item without id is named "None".
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import kept, per_text, rewrite

WINDOW = 10
#: Bytes of benchmark text in a block on average: what the driver collects and sends at once.
BLOCK_BYTES = 8_000_000
#: Every so many positions of a shard the suffix array keeps its value.
SAMPLE = 8

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)
_LOWER = {c: c + 32 for c in range(65, 91)}


def split_words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split() if isinstance(text, str) else []


class Phrases:
    """Windows of a block of items as rows of word numbers, by length."""

    def __init__(self, items: list[tuple[object, str | None]]):
        self.number: dict[bytes, int] = {}
        seen: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.number.setdefault(w, len(self.number) + 1) for w in split_words(text)]
            for k in range(max(1, len(words) - WINDOW + 1) if words else 0):
                seen.setdefault(tuple(words[k : k + WINDOW]), set()).add(str(item))
        self.items = list(seen.values())
        self.shortest = min(map(len, seen), default=0)
        by_length: dict[int, list[int]] = {}
        phrases = list(seen)
        for k, phrase in enumerate(phrases):
            by_length.setdefault(len(phrase), []).append(k)
        self.groups = [
            (np.array(ks), np.array([phrases[k] for k in ks], np.int64)) for ks in by_length.values()
        ]


class WaveletTree:
    """rank(c, i): how often symbol c is among the first i symbols."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        rest = symbols
        for bit in range(bits - 1, -1, -1):
            one = (rest >> bit & 1).astype(bool)
            # Stable partition of the whole level by its bit: zeros first, then ones.
            self.levels.append((bit, np.r_[0, np.cumsum(one)].astype(np.int64), len(one) - int(one.sum())))
            rest = np.r_[rest[~one], rest[one]]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(at), at
        for bit, ones, zeros in self.levels:
            up = (symbol >> bit & 1).astype(bool)
            low = np.where(up, zeros + ones[low], low - ones[low])
            high = np.where(up, zeros + ones[high], high - ones[high])
        return high - low


class FMIndex:
    """Full-text index of an array of symbols over 0 (separator) and up."""

    def __init__(self, text: np.ndarray):
        text = np.r_[text + 1, 0]  # the end of the text is below all
        n = len(text)
        rank = text.astype(np.int64)
        width, order = 1, np.argsort(rank, kind="stable")
        while True:  # prefix doubling
            second = np.zeros(n, np.int64)
            second[: max(0, n - width)] = rank[width:] + 1
            key = rank * (int(rank.max()) + int(second.max()) + 2) + second
            order = np.argsort(key, kind="stable")
            changed = np.r_[0, np.cumsum(key[order][1:] != key[order][:-1])]
            rank = np.empty(n, np.int64)
            rank[order] = changed
            width *= 2
            if changed[-1] == n - 1:
                break
        self.n = n
        self.bwt = text[order - 1]
        top = int(text.max()) + 1
        self.before = np.r_[0, np.cumsum(np.bincount(text, minlength=top))]
        self.tree = WaveletTree(self.bwt, max(1, top.bit_length()))
        sampled = order % SAMPLE == 0
        self.sampled = sampled
        self.value = np.where(sampled, order, 0)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each phrase; all phrases have one length."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[:, k] + 1
            known = symbol < len(self.before) - 1
            symbol = np.where(known, symbol, 0)
            low = self.before[symbol] + self.tree.rank(symbol, low)
            high = self.before[symbol] + self.tree.rank(symbol, high)
            high = np.where(known, high, low)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by stepping back to a sampled one."""
        steps_back = np.zeros(len(rows), np.int64)
        rows = rows.copy()
        open_ = np.flatnonzero(~self.sampled[rows])
        while len(open_):
            symbol = self.bwt[rows[open_]]
            rows[open_] = self.before[symbol] + self.tree.rank(symbol, rows[open_])
            steps_back[open_] += 1
            open_ = open_[~self.sampled[rows[open_]]]
        return self.value[rows] + steps_back


def find(phrases: Phrases, texts: list[list[bytes]]) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
    """For each text (as words): merged spans of words that occurrences cover, and the items they are of."""
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    if not phrases.groups:
        return spans, items
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    number = phrases.number.get
    whole = np.fromiter((n for t in texts for n in (*[number(w, 0) for w in t], 0)), np.int64, int(sizes.sum()))
    # Stretches of known words, long enough for the shortest phrase, each with its separator.
    known = whole > 0
    edge = np.flatnonzero(np.diff(np.r_[False, known, False].astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= phrases.shortest
    begin, end = begin[long], end[long]
    if not len(begin):
        return spans, items
    width = end - begin + 1
    origin = np.repeat(begin - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
    index = FMIndex(whole[origin])
    starts, lengths, which = [], [], []
    for ids, rows in phrases.groups:
        low, high = index.search(rows)
        count = high - low
        suffixes = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        starts.append(origin[index.locate(suffixes)])
        which.append(np.repeat(ids, count))
        lengths.append(np.full(len(suffixes), rows.shape[1]))
    start, length, phrase = map(np.concatenate, (starts, lengths, which))
    order = np.argsort(start, kind="stable")
    first = np.r_[0, np.cumsum(sizes)]
    text = np.searchsorted(first, start[order], side="right") - 1
    at = start[order] - first[text]
    for t, a, n, p in zip(text.tolist(), at.tolist(), length[order].tolist(), phrase[order].tolist()):
        if spans[t] and a <= spans[t][-1][1]:
            spans[t][-1] = (spans[t][-1][0], max(spans[t][-1][1], a + n))
        else:
            spans[t].append((a, a + n))
        items[t] |= phrases.items[p]
    return spans, items


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str | None]]]:
    """The items in blocks of about ``BLOCK_BYTES``; each is collected on its own."""
    items = benchmark.select("item_id", "text").distinct()
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    count = -(-total // BLOCK_BYTES) or 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for k in range(count):
        yield [tuple(r) for r in items.where(block == k).collect()]


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, spans, items): word spans of a text that the benchmark's windows cover (end
    exclusive, apart from each other) and the sorted ids of the items they are of."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))

    def search(held) -> DataFrame:
        def run(texts: list[str | None]) -> dict[str, object]:
            split = [split_words(t) for t in texts]
            spans, items = find(held.value, split)
            return {
                "n_words": [len(t) for t in split],
                "spans": [[{"start": a, "end": b} for a, b in s] for s in spans],
                "items": [sorted(i) for i in items],
            }

        fields = "n_words bigint, spans array<struct<start:int,end:int>>, items array<string>"
        return per_text(keyed, ["doc_id", "text_key"], run, fields)

    context = docs.sparkSession.sparkContext
    found = [search(context.broadcast(Phrases(items))) for items in blocks(benchmark)]
    if len(found) == 1:
        return found[0].drop("text_key")
    # One row of each document carries the others' hits: blocks after the first send only rows with hits.
    first, rest = found[0], found[1:]
    more = rest[0]
    for frame in rest[1:]:
        more = more.unionByName(frame)
    more = (
        more.where(F.size("items") > 0)
        .groupBy("doc_id", "text_key")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("spans"))).alias("more_spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("more_items"),
        )
        .withColumnsRenamed({"doc_id": "more_id", "text_key": "more_key"})
    )
    merged = F.aggregate(
        F.array_sort(F.concat("spans", "more_spans")),
        F.expr("cast(array() as array<struct<start:int,end:int>>)"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    joined = first.join(
        more,
        first["doc_id"].eqNullSafe(more["more_id"]) & (first["text_key"] == more["more_key"]),
        "left",
    )
    both = F.col("more_items").isNotNull()
    return joined.select(
        "doc_id",
        "n_words",
        F.when(both, merged).otherwise(F.col("spans")).alias("spans"),
        F.when(both, F.array_sort(F.array_union("items", "more_items")))
        .otherwise(F.col("items"))
        .alias("items"),
    )


def digest(found: DataFrame) -> DataFrame:
    """The counts and the hash of the items of each document."""
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the characters from the first to the last word of each span."""
    at = [m.span() for m in WORDS.finditer(text.translate(_LOWER))]
    out, done = [], 0
    for a, b in spans:
        out.append(text[done : at[a][0]])
        done = at[b - 1][1]
    return "".join([*out, text[done:]])


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans joined where they meet or touch, as ``find`` joins those of one block."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with every benchmark window cut out of ``text`` and ``n_chars`` counted anew where
    something was cut.  The spans of all blocks are cut at once.  A cut may bring words together, so a changed
    text is searched again, for the windows of all blocks, until it holds none.  Other rows and columns stay as
    they are."""
    context = docs.sparkSession.sparkContext
    held = [context.broadcast(Phrases(items)) for items in blocks(benchmark)]
    if len(held) > 1:
        return _remove_in_rounds(docs, held)

    def change(texts: list[str | None]) -> list[str | None]:
        texts, open_ = list(texts), list(range(len(texts)))
        while open_:
            spans, _ = find(held[0].value, [split_words(texts[k]) for k in open_])
            hit = [(k, s) for k, s in zip(open_, spans) if s]
            for k, s in hit:
                texts[k] = cut(texts[k], s)
            open_ = [k for k, _ in hit]
        return texts

    return rewrite(docs, change)


def _remove_in_rounds(docs: DataFrame, held: list) -> DataFrame:
    """What one block does in a task, by rounds: each finds the spans of all blocks in the texts that the round
    before changed, and cuts them.  A text is named by the hash of what it was at first."""
    todo, rounds = docs.select(F.sha2("text", 256).alias("named"), "text"), []

    def search(block) -> DataFrame:
        def run(texts: list[str | None]) -> dict[str, object]:
            spans, _ = find(block.value, [split_words(t) for t in texts])
            return {"spans": [[{"start": a, "end": b} for a, b in s] for s in spans]}

        return per_text(todo, ["named"], run, "spans array<struct<start:int,end:int>>").where(F.size("spans") > 0)

    def change(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            spans = [merged_spans([(s["start"], s["end"]) for s in row]) for row in frame["spans"]]
            yield frame[["named"]].assign(text=[cut(t, s) for t, s in zip(frame["text"], spans)])

    while True:
        found = search(held[0])
        for block in held[1:]:
            found = found.unionByName(search(block))
        found = found.groupBy("named").agg(F.flatten(F.collect_set("spans")).alias("spans"))
        hit = todo.dropDuplicates(["named"]).join(kept(found, "decontamination-spans"), "named")
        todo = kept(hit.select("named", "text", "spans").mapInPandas(change, "named string, text string"), "decontamination")
        if todo.isEmpty():
            break
        rounds.append(todo.withColumn("round", F.lit(len(rounds))))
    if not rounds:
        return docs
    every = rounds[0]
    for one in rounds[1:]:
        every = every.unionByName(one)
    last = every.groupBy("named").agg(F.max_by("text", "round").alias("text_now"))
    # Columns are named by their side: documents may have any of these names.
    changed, now = last["named"].isNotNull(), last["text_now"]
    new = {"text": now, "n_chars": F.char_length(now).cast(docs.schema["n_chars"].dataType)}
    return docs.join(last, F.sha2(docs["text"], 256) == last["named"], "left").select(
        *(F.when(changed, new[c]).otherwise(docs[c]).alias(c) if c in new else docs[c] for c in docs.columns)
    )
