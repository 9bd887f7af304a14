"""Encoding and decoding with a merge-based (BPE) sentencepiece vocabulary, in merge rounds.

The text is cut where no piece can reach across; each distinct stretch ("word") is encoded
once.  All words of a step are flat numpy arrays of symbols: every round finds the best pair
of each word by a segmented minimum of ranks, merges its occurrences from the left and
compacts the arrays, until no word has a pair left.  Characters outside the vocabulary fall
back to their UTF-8 bytes.

Cases: a null text is encoded like an empty one (the end id alone); very long texts are steps of
their own; repeated rows give repeated rows; an empty table gives an empty result; further
columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallystar.llm.common import per_text

SPACE = "▁"
NEVER = np.iinfo(np.int32).max
SHIFT = 21  # symbols are piece ids, or the vocabulary size plus a code point: below 2**21
#: Distinct words a worker remembers before it starts anew; affects speed only.
REMEMBERED = 400_000


class PieceCodec:
    """One vocabulary: ``encode`` texts to flat ids, ``decode`` them back."""

    def __init__(self, model: str):
        import sentencepiece

        vocabulary = sentencepiece.SentencePieceProcessor(model_file=model)
        size = vocabulary.vocab_size()
        self.size, self.end = size, vocabulary.eos_id()
        names = [vocabulary.id_to_piece(i) for i in range(size)]
        special = [vocabulary.is_control(i) or vocabulary.is_unknown(i) for i in range(size)]
        as_byte = [vocabulary.is_byte(i) for i in range(size)]
        plain = [i for i in range(size) if not (special[i] or as_byte[i])]
        ids = {names[i]: i for i in plain}
        self.byte_id = np.zeros(256, np.int64)
        self.raw: list[bytes] = []
        for i, name in enumerate(names):
            if as_byte[i]:
                self.byte_id[int(name[3:5], 16)] = i
                self.raw.append(bytes([int(name[3:5], 16)]))
            elif vocabulary.is_unknown(i):
                self.raw.append(" ⁇ ".encode())
            else:
                self.raw.append(b"" if special[i] else name.replace(SPACE, " ").encode())
        self.spaced = np.array([not special[i] and names[i].startswith(SPACE) for i in range(size)])
        self.decimal = [str(i) for i in range(size)]

        # Rank 0 is the best score; pieces of equal score share a rank.
        score = {i: vocabulary.get_score(i) for i in plain}
        order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        rank = {i: order[s] for i, s in score.items()}
        symbol = lambda part: ids.get(part, size + ord(part) if len(part) == 1 else -1)
        pairs: dict[int, int] = {}
        # A piece that can be extended to one of no worse rank: its merges go one at a time.
        early = np.zeros(len(order), bool)
        for name, i in ids.items():
            for cut in range(1, len(name)):
                left, right = symbol(name[:cut]), symbol(name[cut:])
                if left >= 0 and right >= 0:
                    pairs[left << SHIFT | right] = i
                    for part in (left, right):
                        if part < size and rank[part] >= rank[i]:
                            early[rank[part]] = True
        self.early = early
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.made_rank = np.array([rank[i] for i in self.made.tolist()], np.int32)
        self.char_symbol = np.arange(size, size + 0x110000, dtype=np.int64)
        for name, i in ids.items():
            if len(name) == 1:
                self.char_symbol[ord(name)] = i

        # Where a text may be cut: before a run of spaces, and around characters of no longer piece.
        joined = {c for name in ids if len(name) > 1 for c in name} - {SPACE}
        if any(re.search(f"[^{SPACE}]{SPACE}", name) for name in ids):
            self.cut = re.compile(".+", re.DOTALL)
        else:
            chars = "".join(re.escape(c) for c in sorted(joined))
            self.cut = re.compile(f"{SPACE}*[{chars}]+|{SPACE}+|.", re.DOTALL)
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.start, self.length = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << SHIFT | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.made_rank[at], NEVER), self.made[at]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words one after the other, and how many each word has."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbol = self.char_symbol[code]
        word = np.repeat(np.arange(len(words)), size)
        count = np.zeros(len(words), np.int64)
        done_word, done_symbol = [], []
        rank = np.full(len(symbol), NEVER, np.int32)
        made = np.zeros(len(symbol), np.int64)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], made[inner] = self._look_up(symbol[inner], symbol[inner + 1])
        while len(symbol):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            span = np.diff(np.r_[first, len(word)])
            best = np.minimum.reduceat(rank, first)
            over = best == NEVER
            if over.any():
                gone = np.repeat(over, span)
                done_word.append(word[gone])
                done_symbol.append(symbol[gone])
                stay = ~gone
                symbol, word, rank, made = symbol[stay], word[stay], rank[stay], made[stay]
                span, best = span[~over], best[~over]
                if not len(symbol):
                    break
            wanted = np.repeat(best, span)
            at = np.flatnonzero(rank == wanted)
            # Of neighbours that overlap every second one counts, from the left.
            fresh = np.r_[True, np.diff(at) != 1]
            where = np.arange(len(at))
            turn = where - np.maximum.accumulate(np.where(fresh, where, 0))
            chosen = turn % 2 == 0
            single = self.early[wanted[at]]
            if single.any():
                leading = np.r_[True, word[at][1:] != word[at][:-1]]
                chosen &= ~single | leading
            at = at[chosen]
            symbol[at] = made[at]
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            moved = np.cumsum(stay) - 1
            symbol, word, rank, made = symbol[stay], word[stay], rank[stay], made[stay]
            new = moved[at]
            touched = np.unique(np.r_[new, new[new > 0] - 1])
            last = touched == len(symbol) - 1
            rank[touched[last]] = NEVER
            touched = touched[~last]
            same = word[touched] == word[touched + 1]
            rank[touched[~same]] = NEVER
            touched = touched[same]
            rank[touched], made[touched] = self._look_up(symbol[touched], symbol[touched + 1])
        if not done_word:
            return np.empty(0, np.int64), count
        word, symbol = np.concatenate(done_word), np.concatenate(done_symbol)
        order = np.argsort(word, kind="stable")
        word, symbol = word[order], symbol[order]
        foreign = symbol >= self.size
        if foreign.any():
            codes = symbol[foreign] - self.size
            parts = {c: self.byte_id[list(chr(c).encode("utf-8", "surrogatepass"))] for c in np.unique(codes).tolist()}
            width = np.ones(len(symbol), np.int64)
            width[foreign] = [len(parts[c]) for c in codes.tolist()]
            word, symbol = np.repeat(word, width), np.repeat(symbol, width)
            symbol[symbol >= self.size] = np.concatenate([parts[c] for c in codes.tolist()])
        np.add.at(count, word, 1)
        return symbol, count

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the offsets of the texts; each ends with the end id."""
        split = [
            self.cut.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts
        ]
        if len(self.index) > REMEMBERED:
            self._forget()
        index = self.index
        new = list({w: None for ws in split for w in ws if w not in index})
        if new:
            flat, length = self.merge(new)
            begin = len(self.flat)
            self.start = np.r_[self.start, begin + np.cumsum(length) - length]
            self.length = np.r_[self.length, length]
            self.flat = np.r_[self.flat, flat]
            index.update(zip(new, range(len(index), len(index) + len(new))))
        per_text = np.fromiter(map(len, split), np.int64, len(split))
        which = np.fromiter((index[w] for ws in split for w in ws), np.int64, int(per_text.sum()))
        length = self.length[which]
        total = np.r_[0, np.cumsum(length)]
        source = np.repeat(self.start[which] - total[:-1], length) + np.arange(total[-1])
        ids = self.flat[source]
        ends = total[np.cumsum(per_text)] if len(texts) else np.empty(0, np.int64)
        ids = np.insert(ids, ends, self.end)
        return ids, np.r_[0, ends + np.arange(1, len(texts) + 1)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of the ids between the offsets; the space put before a text is taken off again."""
        out, raw = [], self.raw
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            part = ids[a:b].tolist()
            text = b"".join([raw[i] for i in part]).decode("utf-8", "replace")
            lead = next((i for i in part if raw[i]), None)
            out.append(text[1:] if lead is not None and self.spaced[lead] else text)
        return out


@lru_cache(maxsize=2)
def codec(model: str) -> PieceCodec:
    return PieceCodec(model)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of each text, end id last."""

    def run(texts: list[str | None]) -> dict[str, object]:
        ids, at = codec(model).encode([t or "" for t in texts])
        return {"ids": np.split(ids.astype(np.int32), at[1:-1])}

    return per_text(docs, [id_col], run, "ids array<int>", text_col)


def decode(tokens: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): the texts of token id arrays; a null array gives the empty text."""
    narrow = tokens.select(id_col, ids_col)
    schema = T.StructType([narrow.schema[id_col], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, kinds = codec(model), to_arrow_schema(schema)
        for batch in batches:
            lists = [np.asarray(x or [], np.int64) for x in batch.column(1).to_pylist()]
            at = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int64)
            flat = np.concatenate([np.empty(0, np.int64), *lists])
            texts = pa.array(own.decode(flat, at), kinds.field("text").type)
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], schema=kinds)

    return narrow.mapInArrow(run, schema)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def round_trip(docs: DataFrame, model: str, with_ids: bool = False) -> DataFrame:
    """Encode and decode each text in one pass: (doc_id, n_tokens, ids_sha256, decoded_sha256), and
    the ids themselves where asked for."""

    def run(texts: list[str | None]) -> dict[str, object]:
        own = codec(model)
        ids, at = own.encode([t or "" for t in texts])
        bounds = zip(at[:-1].tolist(), at[1:].tolist())
        made = {
            "n_tokens": np.diff(at),
            "ids_sha256": [sha(" ".join([own.decimal[i] for i in ids[a:b].tolist()])) for a, b in bounds],
            "decoded_sha256": [sha(t) for t in own.decode(ids, at)],
        }
        return made | ({"ids": np.split(ids.astype(np.int32), at[1:-1])} if with_ids else {})

    fields = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return per_text(docs, ["doc_id"], run, fields + (", ids array<int>" if with_ids else ""))
