"""SimHash fingerprints, and groups of documents whose fingerprints differ in few bits.

A vantage-point tree over a bounded sample of the distinct fingerprints deals all of them to shards: each
node splits by the Hamming distance to its vantage point.  A fingerprint is stored in the one shard its
path ends in, and asks in every shard that the triangle inequality does not rule out: on the far
side of a boundary no fingerprint is nearer than its distance to the boundary.  A shard splits its own
points by a tree of the same kind and compares what is left, which gives exactly the pairs within
the radius.  A shard returns a spanning forest of its links, never all pairs; the groups
are the connected components of these.

``near_duplicates`` links 64-bit fingerprints of four-word shingles at up to four bits.  ``one_of_each`` looks for
texts of a similarity (Jaccard, of five-word shingles) of 0.8 or more.  Fingerprints of 256 bits, within a radius
that the similarity and ``NEAR_DEVIATIONS`` give, only make candidates, between texts whose numbers of shingles allow it;
a link takes the exact similarity of the two sets of shingle hashes.  Candidates are verified within the groups their
links connect, in blocks of bounded size, and a block too returns a spanning forest.

Cases: a null text counts as one without words (fingerprint zero, linked like any other); equal fingerprints
are one point; repeated rows give repeated rows; an id with several texts is one document; a row without an id links nothing and has
no component unless its fingerprint has rows with ids; very long texts are steps of their own; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystar.llm.common import kept, per_text

SHINGLE, RADIUS, SEED = 4, 4, 42
#: For ``one_of_each``: shingle, similarity, and fingerprint size in words of 64 bits.
NEAR_SHINGLE, NEAR_SIMILARITY, NEAR_WORDS = 5, 0.8, 4
#: Standard deviations beyond the mean distance at that similarity up to which texts are candidates.
NEAR_DEVIATIONS = 4.0
#: Shingles of a block of candidates, on average; a task verifies the pairs of one or two blocks.
BLOCK_SHINGLES = 2_000_000

#: Distinct fingerprints a shard stores on average; the sample the shared trees are built from (an upper
#: bound, on average); the most shards.
SHARD_POINTS, SAMPLE_POINTS, MOST_SHARDS = 32_768, 65_536, 4_096
#: Askers of one task; a shard with more is worked on by several tasks, each with all its points.
TASK_QUERIES = 65_536
#: Up to so many ids are sent to every worker to mark their documents; more of them are joined by a shuffle.
BROADCAST_IDS = 1_000_000
TURN = "turn of a repeated row"
#: Points compared without a further split.
PLAIN_POINTS = 1_024

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
U = np.uint64


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """The hash of each word shingle, repeats included; of fewer words the whole sequence is one."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
    if not words:
        return np.empty(0, U)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[-n:].tolist())
    return np.fromiter((digest(line[a:b], SEED) for a, b in spans), U, n)


def majority(hashes: np.ndarray) -> int:
    """64 bits, each set where it is set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(U)[0])


def remixed(hashes: np.ndarray, turn: int) -> np.ndarray:
    """Other 64 bits of the same hashes; turn 0 is the hashes themselves."""
    if not turn:
        return hashes
    x = hashes + U(turn * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of each text as a signed 64-bit number."""

    def run(texts: list[str | None]) -> dict[str, object]:
        made = np.fromiter((majority(shingle_hashes(t, shingle)) for t in texts), U, len(texts))
        return {"fp": made.view(np.int64)}

    return per_text(docs, ["doc_id"], run, "fp bigint")


def set_key(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a sorted set of shingle hashes."""
    return xxhash.xxh3_128_digest(hashes.tobytes(), SEED)


def set_fingerprints(docs: DataFrame, shingle: int, words: int) -> DataFrame:
    """(doc_id, fp, size, key, text_key): fingerprints of ``words`` times 64 bits of the set of shingles, its size and its key,
    and 128 bits that stand for the text."""

    def run(texts: list[str | None]) -> dict[str, object]:
        made, sizes, keys = np.zeros((len(texts), words), U), [], []
        for k, text in enumerate(texts):
            hashes = np.unique(shingle_hashes(text, shingle))
            sizes.append(len(hashes))
            keys.append(set_key(hashes))
            made[k] = [majority(remixed(hashes, turn)) for turn in range(words)]
        return {"fp": list(made.view(np.int64)), "size": sizes, "key": keys, "text_key": [text_key(t) for t in texts]}

    return per_text(docs, ["doc_id"], run, "fp array<bigint>, size bigint, key binary, text_key binary")


def text_key(text: str | None) -> bytes | None:
    """128 bits that stand for a text."""
    return None if text is None else xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"), SEED)


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(set_key, shingles): the distinct sets of shingle hashes."""

    def run(texts: list[str | None]) -> dict[str, object]:
        sets = [np.unique(shingle_hashes(t, shingle)) for t in texts]
        return {"set_key": [set_key(s) for s in sets], "shingles": [s.view(np.int64) for s in sets]}

    return per_text(docs, [], run, "set_key binary, shingles array<bigint>").dropDuplicates(["set_key"])


def distances(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Hamming distances of rows of 64-bit words to one row."""
    return np.bitwise_count(points ^ point).sum(axis=-1, dtype=np.int16)


class VantageTree:
    """Nodes of a vantage-point tree; a child below zero is shard ``-1 - child``."""

    def __init__(self, sample: np.ndarray, leaf: int, radius: int):
        self.reach = radius
        self.point: list[np.ndarray] = []
        self.radius: list[int] = []
        self.child: list[list[int]] = []
        self.leaves = 0
        self.root = self._build(sample, leaf)

    def _build(self, points: np.ndarray, leaf: int) -> int:
        best = None
        if len(points) > leaf:
            # Of a few candidates, the vantage point whose boundary has the fewest points beside it.
            for at in np.linspace(0, len(points) - 1, 5).astype(int):
                distance = distances(points, points[at])
                middle = int(np.median(distance))
                for cut in (middle - 1, middle):
                    inner = int((distance <= cut).sum())
                    if 0 < inner < len(points):
                        beside = int((np.abs(distance - cut) <= self.reach).sum())
                        loss = beside / len(points) + abs(inner / len(points) - 0.5)
                        if best is None or loss < best[0]:
                            best = (loss, points[at], cut, distance <= cut)
        if best is None:
            self.leaves += 1
            return -self.leaves
        node = len(self.point)
        self.point.append(best[1])
        self.radius.append(best[2])
        self.child.append([0, 0])
        self.child[node] = [self._build(points[best[3]], leaf), self._build(points[~best[3]], leaf)]
        return node

    def deal(self, points: np.ndarray, home: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(shard, place in ``points``, stored): one stored row for each point, and rows that ask in further
        shards; without ``home`` all rows ask.  Of stored points only the outer side asks the
        inner side, so that each pair meets once."""
        none = [np.empty(0, np.int64)]
        shard, place, stored = [*none], [*none], [*none]
        todo = [(self.root, np.arange(len(points)), np.full(len(points), home))]
        while todo:
            node, at, at_home = todo.pop()
            if not len(at):
                continue
            if node < 0:
                shard.append(np.full(len(at), -1 - node))
                place.append(at)
                stored.append(at_home)
                continue
            distance = distances(points[at], self.point[node])
            inside = distance <= self.radius[node]
            # A stored point goes on to its side, and from outside asks the inside where a partner can be.
            # One that asks goes wherever partners can be.
            into = distance - self.reach <= self.radius[node]
            todo.append((self.child[node][0], at[into], (at_home & inside)[into]))
            out = np.where(at_home, ~inside, distance + self.reach > self.radius[node])
            todo.append((self.child[node][1], at[out], at_home[out]))
        return np.concatenate(shard), np.concatenate(place), np.concatenate(stored).astype(bool)


def _merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the sets of ``a`` and ``b`` pairwise; ``parent`` and the result name each set by its least member."""
    a, b = parent[a], parent[b]
    differ = a != b
    if not differ.any():
        return parent
    pairs = np.unique(np.stack([np.minimum(a[differ], b[differ]), np.maximum(a[differ], b[differ])]), axis=1)
    root = {int(x): int(x) for x in np.unique(pairs)}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in pairs.T.tolist():
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    change = np.arange(len(parent))
    for x in root:
        change[x] = find(x)
    return change[parent]


def forest(
    ids: np.ndarray, prints: np.ndarray, sizes: np.ndarray, stored: np.ndarray, radius: int, ratio: float
) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as pairs of ids, of the links of all points to the stored ones."""
    nodes, node = np.unique(ids, return_inverse=True)
    parent = np.arange(len(nodes))
    kept_, all_ = np.flatnonzero(stored), np.arange(len(ids))
    if not len(kept_):
        return nodes[:0], nodes[:0]
    local = VantageTree(prints[kept_], PLAIN_POINTS, radius)
    parts = [(*local.deal(prints[kept_]), kept_), (*local.deal(prints[~stored], home=False), all_[~stored])]
    shard = np.concatenate([p[0] for p in parts])
    row = np.concatenate([p[3][p[1]] for p in parts])
    home = np.concatenate([p[2] for p in parts])
    order = np.argsort(shard, kind="stable")
    shard, row, home = shard[order], row[order], home[order]
    for some in np.split(np.arange(len(shard)), np.flatnonzero(np.diff(shard)) + 1):
        here, own = row[some], row[some][home[some]]
        if not len(own):
            continue
        # Small blocks first: once a dense group is one set, its further links fold away.
        begin, block = 0, 8
        while begin < len(here):
            ask = here[begin : begin + block]
            apart = np.zeros((len(ask), len(own)), np.uint16)
            for word in range(prints.shape[1]):
                apart += np.bitwise_count(prints[ask, word][:, None] ^ prints[own, word][None, :])
            near = apart <= radius
            if ratio:
                a, b = sizes[ask][:, None], sizes[own][None, :]
                near &= (a >= ratio * b) & (b >= ratio * a)
            i, j = np.nonzero(near)
            parent = _merge(parent, node[ask[i]], node[own[j]])
            begin, block = begin + block, min(512, block * 4)
    moved = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[moved], nodes[parent[moved]]


def links(points: DataFrame, radius: int, ratio: float = 0.0) -> DataFrame:
    """(a, b): links between ids that connect exactly what distances up to ``radius`` connect.

    ``points`` holds (id, fp array<bigint>, size).  With a ``ratio`` only points whose sizes are that near
    link; sizes fall into bins as wide, and a point asks in its own bin and the next."""
    context = points.sparkSession.sparkContext
    bin_ = F.floor(F.log(F.greatest("size", F.lit(1))) / -math.log(ratio)).cast("int") if ratio else F.lit(0)
    points = points.withColumn("bin", bin_)
    counts = {r["bin"]: r["n"] for r in points.groupBy("bin").agg(F.count("*").alias("n")).collect()}  # a row per bin
    total = sum(counts.values())
    share = min(1.0, SAMPLE_POINTS / max(1, total))
    sample: dict[int, list] = {}
    for r in points.select("bin", "fp").sample(share, 7).collect():
        sample.setdefault(r["bin"], []).append(r["fp"])
    trees = {}
    for bin_number, n in counts.items():
        found = sorted(sample.get(bin_number, []))
        # A bin that the sample missed is one shard.
        own = np.array(found, np.int64).view(U) if found else np.empty((0, 1), U)
        shards = min(MOST_SHARDS, -(-n // SHARD_POINTS))
        trees[bin_number] = VantageTree(own, max(2, -(-len(own) // shards)), radius)
    held = context.broadcast(trees)
    id_type = points.schema["id"].dataType.simpleString()

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for number, rows in frame.groupby("bin"):
                for k in range(0, len(rows), 10_000):
                    some = rows.iloc[k : k + 10_000]
                    prints = np.stack(some["fp"].to_numpy()).view(U)
                    for tree_of in (number, number + 1) if ratio else (number,):
                        if tree_of not in held.value:
                            continue
                        shard, place, stored = held.value[tree_of].deal(prints, home=tree_of == number)
                        yield some.iloc[place].assign(shard=tree_of * MOST_SHARDS + shard, stored=stored)[
                            ["shard", "id", "fp", "size", "stored"]
                        ]

    schema = f"shard bigint, id {id_type}, fp array<bigint>, size bigint, stored boolean"
    dealt = kept(points.mapInPandas(deal, schema), "simhash-dealt")
    # Tasks of each shard: a row per shard, at most MOST_SHARDS a bin.
    tasks = dealt.groupBy("shard").agg(F.ceil(F.count("*") / TASK_QUERIES).cast("int").alias("tasks"))
    many = {r["shard"]: r["tasks"] for r in tasks.where("tasks > 1").collect()}
    count = F.lit(1)
    if many:
        lookup = F.create_map(*(F.lit(x) for kv in many.items() for x in kv))
        count = F.coalesce(lookup[F.col("shard")], F.lit(1))
    own = F.pmod(F.xxhash64("id"), count).cast("int")
    # In its task a row asks; in all tasks of its shard a stored row is there to be found.
    roles = dealt.select(
        "shard", "id", "fp", "size", "stored",
        F.explode(F.when(F.col("stored"), F.sequence(F.lit(0), count - 1)).otherwise(F.array(own))).alias("task"),
    )

    def match(frame: pd.DataFrame) -> pd.DataFrame:
        prints = np.stack(frame["fp"].to_numpy()).view(U)
        a, b = forest(
            frame["id"].to_numpy(), prints, frame["size"].to_numpy(), frame["stored"].to_numpy(bool), radius, ratio
        )
        return pd.DataFrame({"a": a, "b": b})

    return roles.groupBy("shard", "task").applyInPandas(match, f"a {id_type}, b {id_type}")


def components(edges: DataFrame) -> DataFrame:
    """(node, least): the least node that each node of the undirected ``edges`` (a, b) can reach.
    Rounds of large and small stars, each written to the shared folder; stops when nothing changes."""

    def star(rows: DataFrame) -> DataFrame:
        """Every neighbour of a node, and the least of the node and its neighbours."""
        least = rows.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        return rows.join(least, "u")

    now = kept(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = star(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))
        )
        now = kept(small.where("u <> v").distinct(), "stars")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("least")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("least")).distinct()
            )
        mark = seen


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id): the fingerprint in hexadecimal, and the smallest id that links
    reach."""
    prints = kept(fingerprints(docs), "simhash")
    # A fingerprint stands for its documents by their smallest id; the least of a component is then its id.
    points = kept(prints.groupBy("fp").agg(F.min("doc_id").alias("id")), "simhash-points")
    points = points.where(F.col("id").isNotNull())
    wide = points.select("id", F.array("fp").alias("fp"), F.lit(1).cast("long").alias("size"))
    reached = components(links(wide, RADIUS))
    groups = points.join(reached, points["id"] == reached["node"], "left").select(
        F.col("fp").alias("key"), F.coalesce("least", "id").alias("component_id")
    )
    return prints.join(groups, prints["fp"] == groups["key"], "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def near_radius(similarity: float, bits: int, deviations: float = 1.0) -> int:
    """Bits in which fingerprints of sets of that Jaccard similarity differ, and so many standard deviations."""
    part = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.floor(bits * part + deviations * math.sqrt(bits * part * (1 - part)))


def similar(
    ids: np.ndarray, shingles: list[np.ndarray], side: np.ndarray, similarity: float
) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as pairs of ids, of the pairs of sets whose Jaccard similarity is at least ``similarity``;
    where sets of two sides meet, of the pairs across only."""
    nodes, node = np.unique(ids, return_inverse=True)
    parent = np.arange(len(nodes))
    sizes = np.fromiter(map(len, shingles), np.int64, len(shingles))
    values, number = np.unique(np.concatenate(shingles), return_inverse=True)
    ends = np.cumsum(sizes)
    across = len(np.unique(side)) > 1
    own = np.zeros(len(values), bool)
    for k in range(len(ids) - 1):
        rest = np.arange(k + 1, len(ids))
        near = np.minimum(sizes[rest], sizes[k]) / np.maximum(sizes[rest], sizes[k]) >= similarity
        # What is one set already needs no further link.
        near &= parent[node[rest]] != parent[node[k]]
        if across:
            near &= side[rest] != side[k]
        rest = rest[near]
        if not len(rest):
            continue
        mine = number[ends[k] - sizes[k] : ends[k]]
        own[mine] = True
        upto = np.cumsum(sizes[rest])
        begin = upto - sizes[rest]
        at = np.arange(int(upto[-1])) + np.repeat(ends[rest] - sizes[rest] - begin, sizes[rest])
        both = np.add.reduceat(own[number[at]], begin, dtype=np.int64)
        own[mine] = False
        found = rest[both / (sizes[rest] + sizes[k] - both) >= similarity]
        parent = _merge(parent, np.full(len(found), node[k]), node[found])
    moved = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[moved], nodes[parent[moved]]


def verified(docs: DataFrame, points: DataFrame, candidates: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(a, b): links between ids of ``points`` (id, size, key) that connect exactly what pairs of at least
    ``similarity`` connect, of points that ``candidates`` connects."""
    reached = components(candidates)
    found = points.join(reached, points["id"] == reached["node"]).select("id", "size", "key", F.col("least").alias("group"))
    found = kept(found, "simhash-candidates")
    count = F.greatest(F.lit(1), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int")
    blocks = found.groupBy("group").agg(count.alias("blocks")).withColumnRenamed("group", "group_")
    wanted = found.select(F.col("id").alias("wanted")).distinct()
    sets = shingle_sets(docs.join(wanted, docs["doc_id"] == wanted["wanted"], "left_semi"), shingle)
    side = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    rows = (
        found.join(blocks, found["group"] == blocks["group_"])
        .withColumn("side", side)
        .join(sets, F.col("key") == F.col("set_key"))
        .select("group", "id", "side", "shingles", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select(
            "group", "id", "side", "shingles", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j")
        )
    )
    id_type = points.schema["id"].dataType.simpleString()

    def match(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = similar(frame["id"].to_numpy(), frame["shingles"].to_list(), frame["side"].to_numpy(), similarity)
        return pd.DataFrame({"a": a, "b": b})

    return rows.groupBy("group", "i", "j").applyInPandas(match, f"a {id_type}, b {id_type}")


def one_of_each(
    docs: DataFrame,
    shingle: int = NEAR_SHINGLE,
    similarity: float = NEAR_SIMILARITY,
    words: int = NEAR_WORDS,
) -> DataFrame:
    """``docs`` with one document, that of the smallest id, of each group of near duplicates.

    Rows equal in id and text count as one and leave one, the first by all their columns; rows without an id stay, as
    nothing tells them apart from others."""
    prints = kept(set_fingerprints(docs.where(F.col("doc_id").isNotNull()), shingle, words), "simhash")
    # Equal sets of shingles are one point.
    points = kept(prints.groupBy("key", "fp", "size").agg(F.min("doc_id").alias("id")), "simhash-points")
    candidates = links(points, near_radius(similarity, 64 * words, NEAR_DEVIATIONS), similarity)
    reached = components(verified(docs, points, candidates, shingle, similarity))
    first = points.join(reached, points["id"] == reached["node"], "left").select(
        F.col("key").alias("point"), F.coalesce("least", "id").alias("least")
    )
    gone = prints.join(first, prints["key"] == first["point"]).where(F.col("least") < F.col("doc_id"))
    # Repeated rows are found among the narrow ones; the texts of all other documents are not shuffled for them.
    again = prints.groupBy("doc_id", "text_key").agg(F.count("*").alias("times")).where("times > 1")
    marks = gone.select("doc_id", F.lit(True).alias("drop")).unionByName(again.select("doc_id", F.lit(False).alias("drop")))
    marks = kept(marks.groupBy("doc_id").agg(F.max("drop").alias("drop")), "simhash-marks")
    few = marks.count() <= BROADCAST_IDS
    marks = marks.select(F.col("doc_id").alias("id"), "drop")
    marks = F.broadcast(marks) if few else marks
    rest = docs.join(marks, docs["doc_id"] == marks["id"], "left")
    left = rest.where(~F.coalesce(marks["drop"], F.lit(False)))
    own = [docs[c] for c in docs.columns]
    turn = F.row_number().over(Window.partitionBy(docs["doc_id"], docs["text"]).orderBy(*own))
    repeated = left.where(marks["id"].isNotNull()).select(*own, turn.alias(TURN))
    return left.where(marks["id"].isNull()).select(*own).unionByName(repeated.where(F.col(TURN) == 1).drop(TURN))
