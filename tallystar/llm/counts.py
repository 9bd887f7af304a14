"""Token counts under a unigram vocabulary, by dynamic programming that shared prefixes share.

A text falls into pre-tokens: stretches that begin with their spaces.  The distinct pre-tokens of a step
are walked in sorted order, which is the depth-first walk of their trie: the stack holds the
forward scores of the current path, and a pre-token goes on from the longest prefix it shares with the one
before it, so the scores of a prefix are computed once.  The node where a pre-token ends gives its
terminal count, which all its occurrences share.

The score of a segmentation is the sum of its pieces' scores; a stretch without a piece costs ten below the
worst score a character.  Of segmentations with equal scores that with fewer tokens counts.

Cases: a null text counts as an empty one, with no tokens; very long texts are steps of their own, and a very
long pre-token costs its length times the longest piece; repeated rows give repeated rows; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame

from tallystar.llm.common import per_text

SPACE = "▁"
PRETOKEN = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Terminal counts a worker remembers before it starts anew; affects speed only.
REMEMBERED = 500_000


class UnigramCounter:
    """Pieces and scores of a vocabulary file, and the terminal counts found so far."""

    def __init__(self, model: str):
        import sentencepiece

        vocabulary = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = range(vocabulary.vocab_size())
        plain = [
            i
            for i in ids
            if not (vocabulary.is_control(i) or vocabulary.is_unknown(i) or vocabulary.is_byte(i))
        ]
        self.score = {vocabulary.id_to_piece(i): vocabulary.get_score(i) for i in plain}
        self.longest = max(map(len, self.score))
        self.unknown = min(s for s in self.score.values() if s > -1e8) - 10.0
        self.terminal: dict[str, int] = {}

    def learn(self, pretokens: list[str]) -> None:
        """Store the terminal counts of distinct pre-tokens."""
        get, longest, unknown = self.score.get, self.longest, self.unknown
        path = ""
        best: list[tuple[float, int]] = [(0.0, 0)]  # (score, minus tokens) by depth
        for word in sorted(pretokens):
            depth, most = 0, min(len(path), len(word))
            while depth < most and path[depth] == word[depth]:
                depth += 1
            del best[depth + 1 :]
            for end in range(depth + 1, len(word) + 1):
                score, tokens = best[end - 1]
                top = (score + unknown, tokens - 1)
                for start in range(max(0, end - longest), end):
                    own = get(word[start:end])
                    if own is not None:
                        score, tokens = best[start]
                        if (score + own, tokens - 1) > top:
                            top = (score + own, tokens - 1)
                best.append(top)
            path = word
            self.terminal[word] = -best[-1][1]

    def count(self, texts: list[str | None]) -> tuple[list[int], list[int]]:
        """How many pre-tokens and how many tokens each text has."""
        split = [PRETOKEN.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.terminal) > REMEMBERED:
            self.terminal = {}
        terminal = self.terminal
        new = {w for words in split for w in words if w not in terminal}
        if new:
            self.learn(list(new))
        return list(map(len, split)), [sum([terminal[w] for w in words]) for words in split]


@lru_cache(maxsize=2)
def counter(model: str) -> UnigramCounter:
    return UnigramCounter(model)


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of each text."""

    def run(texts: list[str | None]) -> dict[str, object]:
        pretokens, tokens = counter(model).count(texts)
        return {"n_pretokens": pretokens, "n_tokens": tokens}

    return per_text(docs, ["doc_id"], run, "n_pretokens bigint, n_tokens bigint")
