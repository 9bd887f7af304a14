"""Join of documents by the Jaccard similarity of their word n-grams, by filters under several global token orders.

Under any order of all tokens that is the same for every document, two sets of the wanted similarity share some of their first
tokens: of a set of s tokens at least a = ceil(similarity s) are common, so the first s - a + m hold at least m common
ones, m being ``MARGIN`` hundredths of the smaller set (see ``shares``).  A pair has to pass under every order:

1. *By a hash*, over all sets.  A set stays if enough of its first tokens are among the first of another set.  Only tokens, no
   texts, are shuffled, and only a fifth of them.
2. *By frequency* among the sets that stayed, rare tokens first, so that text that many documents share comes last.  A set that has too many
   tokens of its own has no common token among the first.  Sets that share one of them are candidates; their connected components are groups.
3. *By frequency in the group and another hash*, and under the orders 1 and 2 again, pair by pair inside the groups; then the exact
   similarity.

Groups are worked on in blocks of bounded size.  Sets that are in one component already are not compared.  The blocks of a group are
worked on alone and with the next one; after that only sets outside the group's largest component still meet the other blocks.

Equal sets are one set, that of the least document.  Nothing but forests of links leaves a task.

Cases: a null, empty or blank text has an empty set and no link; repeated rows give repeated rows; an id with several texts links through
all of them; a row without an id links nothing and has no component unless its set has rows with ids; very long texts are steps of their own; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.llm.common import kept, per_text
from tallystar.llm.simhash import components, remixed

SHINGLE, SIMILARITY = 4, 85
#: First tokens beyond those that one common token takes, in hundredths of the set.
MARGIN = 5
#: Up to so many ids are sent to every worker to pick their texts; more of them are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Tokens of a block of a group, on average.
BLOCK_TOKENS = 500_000

#: Bytes of words that are hashed at once.
PIECE_BYTES = 4_000_000

U = np.uint64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SEED = 42
_WHITE = np.isin(np.arange(256), [32, *range(9, 14)])
_BYTES = remixed(np.arange(256, dtype=U), 3)
_POWERS = np.cumprod(np.r_[U(1), np.full(4095, 0x9E3779B97F4A7C17, U)])


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, one after the other, and how many words each text has."""
    raw = [t.encode("utf-8", "surrogatepass").translate(_LOWER) if t else b"" for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    white = _WHITE[data]
    starts = np.flatnonzero(~white & np.r_[True, white[:-1]])
    size = np.flatnonzero(white & np.r_[False, ~white[:-1]]) - starts
    bounds = np.r_[0, np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)]
    out = np.zeros(len(starts), U)
    for k in np.flatnonzero(size > len(_POWERS)).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[starts[k] : starts[k] + size[k]].tobytes(), _SEED)
    short = np.flatnonzero(size <= len(_POWERS))
    # Sums over the bytes of a word, of a random number for the byte times a power for its place.
    piece = np.flatnonzero(np.diff(np.cumsum(size[short]) // PIECE_BYTES)) + 1
    for some in np.split(short, piece):
        if len(some):
            first_ = np.cumsum(size[some]) - size[some]
            place = np.arange(int(size[some].sum())) - np.repeat(first_, size[some])
            values = _BYTES[data[np.repeat(starts[some], size[some]) + place]] * _POWERS[place]
            out[some] = np.add.reduceat(values, first_)
    return remixed(out + size.astype(U), 7), np.diff(np.searchsorted(starts, bounds))


def token_sets(texts: list[str | None], shingle: int = SHINGLE) -> list[np.ndarray]:
    """For each text the sorted 64-bit hashes of its distinct shingles; of fewer words the whole sequence is one."""
    each, size = word_hashes(texts)
    # The hash of all windows at once, those across texts included; these are not read.
    long = np.full(max(0, len(each) - shingle + 1), shingle, U)
    for k in range(shingle if len(long) else 0):
        long = remixed(long * U(0x9E3779B97F4A7C15) + each[k : k + len(long)], 1)
    out, at = [], 0
    for n in size.tolist():
        if n >= shingle:
            made = np.sort(long[at : at + n - shingle + 1])
            out.append(made[np.r_[True, made[1:] != made[:-1]]])
        else:
            made = np.full(min(n, 1), n, U)
            for word in each[at : at + n]:
                made = remixed(made * U(0x9E3779B97F4A7C15) + word, 1)
            out.append(made)
        at += n
    return out


def tokens(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    return token_sets([text], shingle)[0]


def share(part: int, n):
    """``part`` hundredths of n, rounded up."""
    return -(-part * n // 100)


def first(n, similarity: int):
    """How many first tokens of a set of n stand for it under an order."""
    return n - share(similarity, n) + np.maximum(1, share(MARGIN, n))


def shares(n, similarity: int):
    """How many of its first tokens a set of n has in common with those of any similar set, at least.

    The common tokens of two sets number at least a, the part of either that the similarity asks for.  After the m-th of them, in
    order, a set holds a - m tokens at least, so that it is among its first s - a + m.  That holds for the smaller
    margin m of the two; a similar set has no fewer than ``share(similarity, n)`` tokens."""
    return np.maximum(1, share(MARGIN, share(similarity, n)))


def by_hash(sets: np.ndarray, turn: int) -> np.ndarray:
    return remixed(sets, turn)


def by_frequency(sets: np.ndarray, counts: np.ndarray, turn: int) -> np.ndarray:
    """Keys that ascend with the counts of the tokens; a hash orders tokens of one count."""
    return (np.minimum(counts, (1 << 32) - 1).astype(U) << U(32)) | (remixed(sets, turn) >> U(32))


def set_key(found: np.ndarray) -> bytes:
    """128 bits that stand for a set; the first 64 of them number it where a chance meeting does no harm."""
    return xxhash.xxh3_128_digest(found.tobytes(), _SEED)


def described(docs: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """(doc_id, n, key, firsts): size and key of each document's set, and its first tokens by hash."""
    def run(texts: list[str | None]) -> dict[str, object]:
        sets = token_sets(texts, shingle)
        firsts = [np.partition(k, p - 1)[:p] if p else k for k, p in ((by_hash(s, 1), int(first(len(s), similarity)) if len(s) else 0) for s in sets)]
        return {"n": [len(s) for s in sets], "key": [set_key(s) for s in sets], "firsts": [f.view(np.int64) for f in firsts]}

    return per_text(docs, ["doc_id"], run, "n bigint, key binary, firsts array<bigint>")


def first_tokens(rows: DataFrame) -> DataFrame:
    """(token, number, here): the first tokens of all sets (key, firsts), with the number of the set.

    What a batch knows is not sent: a token that several of its sets have is one row without a number, and a set's tokens
    of this kind are one row with their count as ``here``."""
    schema = pa.schema([("token", pa.int64()), ("number", pa.int64()), ("here", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, firsts = batch.column("key").to_pylist(), batch.column("firsts")
            ends = firsts.offsets.to_numpy()
            flat = firsts.values.to_numpy()
            # Equal sets are one.
            of = {int.from_bytes(k[:8], "big", signed=True): row for row, k in enumerate(keys)}
            rows_ = np.fromiter(of.values(), np.int64, len(of))
            size = ends[rows_ + 1] - ends[rows_]
            if not int(size.sum()):
                continue
            number = np.repeat(np.fromiter(of, np.int64, len(of)), size)
            token = np.concatenate([flat[ends[r] : ends[r + 1]] for r in rows_])
            _, place, times = np.unique(token, return_inverse=True, return_counts=True)
            alone = times[place] == 1
            several = np.unique(token[~alone])
            known, here = np.unique(number[~alone], return_counts=True)
            lone = int(alone.sum())
            columns = [
                np.concatenate([token[alone], several, known]),
                pa.array(
                    np.concatenate([number[alone], several, known]),
                    mask=np.repeat([False, True, False], [lone, len(several), len(known)]),
                ),
                np.concatenate([np.zeros(lone + len(several), np.int64), here]),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return rows.select("key", "firsts").mapInArrow(run, "token bigint, number bigint, here bigint")


def common_tokens(firsts: DataFrame) -> DataFrame:
    """(number, common): how many of its first tokens a set has in common with others.

    The rows of one token are one per batch of the tasks before, however many sets have it."""
    token = Window.partitionBy("token")
    sent = F.col("here") == 0
    number = F.when(sent, F.col("number"))
    shared = F.max(sent & F.col("number").isNull()).over(token) | (F.min(number).over(token) < F.max(number).over(token))
    weight = F.when(sent, F.coalesce(shared, F.lit(False)).cast("long")).otherwise(F.col("here"))
    rows = firsts.withColumn("weight", weight).where("number IS NOT NULL AND weight > 0")
    return rows.groupBy("number").agg(F.sum("weight").alias("common"))


def enough(n: Column, common: Column, similarity: int) -> Column:
    """``shares`` as a condition on columns."""
    least = F.floor((F.floor((n * similarity + 99) / 100) * MARGIN + 99) / 100)
    return common >= F.greatest(F.lit(1), least)


def common_of(own: np.ndarray, number: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For lists given as places in ``number``, how many of their entries are marked in ``own``."""
    upto = np.cumsum(size)
    at = np.arange(int(upto[-1])) + np.repeat(begin - (upto - size), size)
    return np.add.reduceat(own[number[at]], upto - size, dtype=np.int64)


class Lists:
    """First tokens of all sets under one order, by set and by token."""

    def __init__(self, keys: np.ndarray, owner: np.ndarray, number: np.ndarray, sizes: np.ndarray, similarity: int, values: int):
        order = np.lexsort((keys, owner))
        self.size = first(sizes, similarity)
        starts = np.cumsum(sizes) - sizes
        self.begin = np.cumsum(self.size) - self.size
        taken = np.arange(int(self.size.sum())) + np.repeat(starts - self.begin, self.size)
        self.number = number[order[taken]]
        of = np.repeat(np.arange(len(sizes)), self.size)
        by_token = np.argsort(self.number, kind="stable")
        self.sets = of[by_token]
        self.at = np.r_[0, np.cumsum(np.bincount(self.number, minlength=values))]

    def of(self, k: int) -> np.ndarray:
        return self.number[self.begin[k] : self.begin[k] + self.size[k]]

    def common(self, k: int, rest: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Common first tokens of set k and the sets ``rest``; ``own`` is scratch."""
        mine = self.of(k)
        own[mine] = True
        found = common_of(own, self.number, self.begin[rest], self.size[rest])
        own[mine] = False
        return found


class Union:
    """Disjoint sets of 0 to n - 1, each named by one of its members."""

    def __init__(self, names: np.ndarray):
        _, place = np.unique(names, return_inverse=True)
        least = np.full(int(place.max(initial=-1)) + 1, len(names))
        np.minimum.at(least, place, np.arange(len(names)))
        self.of = least[place]
        self.begun = self.of.copy()
        self.links: list[tuple[int, int]] = []

    def join(self, k: int, others: np.ndarray) -> None:
        for x in np.unique(self.of[others]).tolist():
            if x != self.of[k]:
                self.links.append((k, int(others[self.of[others] == x][0])))
                self.of[self.of == x] = self.of[k]


def similar(
    sets: list[np.ndarray], known: np.ndarray, side: np.ndarray, ask: np.ndarray, similarity: int, within: bool
) -> list[tuple[int, int]]:
    """A forest of links between sets of the similarity, beyond the components ``known``.

    Sets with ``ask`` look for partners among all others; where not ``within``, on the other ``side`` only."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    whole = np.concatenate(sets)
    values, number, counts = np.unique(whole, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    begin = np.cumsum(sizes) - sizes
    orders = [
        Lists(keys[number], owner, number, sizes, similarity, len(values))
        for keys in (by_frequency(values, counts, 2), by_frequency(values, counts, 3), by_hash(values, 1))
    ]
    lists, further = orders[0], orders[1:]
    own, union = np.zeros(len(values), bool), Union(known)
    for k in np.flatnonzero(ask).tolist():
        mine = lists.of(k)
        size = lists.at[mine + 1] - lists.at[mine]
        upto = np.cumsum(size)
        rest = lists.sets[np.arange(int(upto[-1])) + np.repeat(lists.at[mine] - (upto - size), size)]
        # Pairs that the sizes or known links settle take no more part.
        small, large = np.minimum(sizes[rest], sizes[k]), np.maximum(sizes[rest], sizes[k])
        open_ = (union.of[rest] != union.of[k]) & (100 * small >= similarity * large) & ((rest > k) | ~ask[rest])
        if not within:
            open_ &= side[rest] != side[k]
        rest, found = np.unique(rest[open_], return_counts=True)
        least = np.maximum(1, share(MARGIN, np.minimum(sizes[rest], sizes[k])))
        rest, least = rest[found >= least], least[found >= least]
        for order in further:
            if len(rest):
                passed = order.common(k, rest, own) >= least
                rest, least = rest[passed], least[passed]
        if len(rest):
            all_ = number[begin[k] : begin[k] + sizes[k]]
            own[all_] = True
            both = common_of(own, number, begin[rest], sizes[rest])
            own[all_] = False
            union.join(k, rest[100 * both >= similarity * (sizes[rest] + sizes[k] - both)])
    return union.links


def rarest(shared: DataFrame, similarity: int) -> DataFrame:
    """(token, id): of sets (id, n, tokens, counts), given by those of their tokens that other sets have and how many do, the first
    ones by frequency.  Before these come the tokens of a set's own; where they leave too little room, the set is out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            token, owner = [np.empty(0, np.int64)], []
            for name, n, found, counts in frame[["id", "n", "tokens", "counts"]].itertuples(index=False):
                room = int(first(n, similarity)) - (n - len(found))
                if room >= shares(n, similarity):
                    keys = by_frequency(np.asarray(found).view(U), np.asarray(counts), 2)
                    token.append(np.asarray(found)[np.argpartition(keys, room - 1)[:room]])
                    owner += [name] * room
            yield pd.DataFrame({"token": np.concatenate(token), "id": owner})

    return shared.mapInPandas(run, f"token bigint, id {shared.schema['id'].dataType.simpleString()}")


def links(docs: DataFrame, rows: DataFrame, sets: DataFrame, shingle: int, similarity: int, block_tokens: int) -> DataFrame:
    """(a, b): links between ids of the distinct ``sets`` (key, number, id, n) that connect exactly what the similarity connects."""
    id_type = sets.schema["id"].dataType.simpleString()
    common = common_tokens(first_tokens(rows)).withColumnRenamed("number", "number__")
    passed = sets.join(common, F.col("number") == F.col("number__")).where(enough(F.col("n"), F.col("common"), similarity))
    stay = kept(passed.select("key", "id", "n"), "jaccard-stay")

    # The texts of the sets that stayed are read again.
    wanted = stay.select(F.col("id").alias("wanted")).distinct()
    wanted = F.broadcast(wanted) if stay.count() <= BROADCAST_IDS else wanted
    again = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("wanted"), "left_semi")
    def shingled(texts: list[str | None]) -> dict[str, object]:
        found = token_sets(texts, shingle)
        return {"key__": [set_key(s) for s in found], "tokens": [s.view(np.int64) for s in found]}

    whole = per_text(again, [], shingled, "key__ binary, tokens array<bigint>").dropDuplicates(["key__"])
    whole = whole.join(stay, F.col("key") == F.col("key__")).select("id", "n", "tokens")
    whole = kept(whole, "jaccard-sets")

    # Tokens with their frequency, for those that several sets have.
    postings = whole.select("id", "n", F.explode("tokens").alias("token"))
    often = postings.groupBy(F.col("token").alias("token__")).agg(F.count("*").alias("sets")).where("sets > 1")
    shared = postings.join(often, F.col("token") == F.col("token__")).groupBy("id", "n").agg(
        F.collect_list("token").alias("tokens"), F.collect_list("sets").alias("counts")
    )  # at most the tokens of one document
    rare = kept(rarest(shared, similarity), "jaccard-rare")
    several = rare.groupBy("token").agg(F.count("*").alias("n__"), F.min("id").alias("a")).where("n__ > 1")
    several = kept(several.select(F.col("token").alias("token__"), "a"), "jaccard-rare-common")
    number = rare.join(several, F.col("token") == F.col("token__"), "left_semi")
    number = number.groupBy("id").agg(F.count("*").alias("common")).withColumnRenamed("id", "id__")
    narrow = whole.select("id", "n")
    alive = narrow.join(number, F.col("id") == F.col("id__")).where(enough(F.col("n"), F.col("common"), similarity))
    alive = kept(alive.select("id", "n"), "jaccard-stay-rare")
    rare = rare.join(alive.select(F.col("id").alias("id__")), F.col("id") == F.col("id__"), "left_semi")
    edges = rare.join(several, F.col("token") == F.col("token__")).select("a", F.col("id").alias("b"))
    grouped = components(edges.where("a <> b").distinct())
    # What a group is cut into, from the narrow rows.
    sized = alive.join(grouped, F.col("id") == F.col("node")).select("id", "n", F.col("least").alias("group"))
    sized = kept(sized, "jaccard-groups")
    blocks = sized.groupBy("group").agg(F.greatest(F.lit(1), F.ceil(F.sum("n") / block_tokens)).cast("int").alias("blocks"))
    blocks = blocks.withColumnRenamed("group", "group__")
    placed = sized.join(blocks, F.col("group") == F.col("group__")).select(
        F.col("id").alias("id__"), "group", "blocks",
        F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")).cast("int").alias("block"),
    )
    placed = kept(placed.distinct(), "jaccard-blocks")
    group = whole.join(placed, F.col("id") == F.col("id__")).select("group", "id", "tokens", "blocks", "block")

    def match(within: bool):
        def run(frame: pd.DataFrame) -> pd.DataFrame:
            found = similar(
                [np.asarray(x).view(U) for x in frame["tokens"]],
                frame["known"].to_numpy(),
                frame["block"].to_numpy(),
                frame["ask"].to_numpy(bool),
                similarity,
                within,
            )
            ids, at = frame["id"].to_numpy(), np.array(found, np.int64).reshape(-1, 2)
            return pd.DataFrame({"a": ids[at[:, 0]], "b": ids[at[:, 1]]})

        return run

    # Each block with the next one.
    before = F.pmod(F.col("block") - 1, F.col("blocks"))
    near = group.select(
        "group", F.explode(F.array_distinct(F.array(F.col("block"), before))).alias("i"),
        F.col("id").alias("known"), "id", "tokens", "block", F.lit(True).alias("ask"),
    )
    schema = f"a {id_type}, b {id_type}"
    found = kept(near.groupBy("group", "i").applyInPandas(match(True), schema), "jaccard-links")
    many = placed.where("blocks > 3")
    if many.isEmpty():
        return found

    reached = components(found)
    many = many.join(reached, F.col("id__") == F.col("node"), "left")
    many = kept(many.select("id__", "group", "blocks", "block", F.coalesce("least", "id__").alias("known")), "jaccard-many")
    # The sets outside the largest component of their group still ask.
    members = many.groupBy("group", "known").agg(F.count("*").alias("members"))
    largest = members.groupBy("group").agg(F.max_by("known", F.struct("members", "known")).alias("largest"))
    largest = largest.withColumnRenamed("group", "group__")
    many = many.join(largest, F.col("group") == F.col("group__")).withColumn("ask", F.col("known") != F.col("largest"))
    many = kept(many.select("id__", "group", "blocks", "block", "known", "ask"), "jaccard-asking")
    asks = many.groupBy("group", "block").agg(F.max("ask").alias("asks"))
    asks = asks.select(F.col("group").alias("group__"), F.col("block").alias("other"), "asks")
    apart = F.pmod(F.col("block") - F.col("other"), F.col("blocks"))
    # All sets of a block go to a pair where the other block asks, else only those that ask.
    far = many.join(asks, (F.col("group") == F.col("group__")) & (F.col("asks") | F.col("ask")))
    far = far.where((apart > 1) & (apart < F.col("blocks") - 1)).select(
        "id__", "group", "known", "block", "ask",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
    )
    far = whole.join(far, F.col("id") == F.col("id__")).select("group", "i", "j", "known", "id", "tokens", "block", "ask")
    return found.unionByName(kept(far.groupBy("group", "i", "j").applyInPandas(match(False), schema), "jaccard-far"))


def linked(
    docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """(doc_id, n_shingles, component_id): the size of each document's set, and the least document that links of at least
    ``similarity`` hundredths reach."""
    rows = kept(described(docs, shingle, similarity), "jaccard-described")
    # Equal sets are one, named by its least document.
    points = rows.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    number = F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("bigint")
    sets = points.groupBy("key", "n").agg(F.min("doc_id").alias("id"))
    sets = kept(sets.withColumn("number", number), "jaccard-distinct")
    # The texts of one id are one document.
    of_id = points.join(sets.select(F.col("key").alias("key__"), "id"), F.col("key") == F.col("key__")).select("doc_id", "id")
    spread = of_id.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("most")).where("a < most")
    spread = spread.withColumnRenamed("doc_id", "doc__").select("doc__", "a")
    twins = of_id.join(spread, F.col("doc_id") == F.col("doc__")).where("a <> id").select("a", F.col("id").alias("b")).distinct()
    reached = components(links(docs, points, sets, shingle, similarity, block_tokens).unionByName(twins))
    named = sets.join(reached, F.col("id") == F.col("node"), "left").select(
        F.col("key").alias("key__"), F.coalesce("least", "id").alias("component")
    )
    return rows.join(named, F.col("key") == F.col("key__"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )
