"""Secret scans: three fixed patterns, and high-entropy windows of candidate strings.

Spans are code points, end exclusive.  The base kinds are the leftmost non-overlapping matches of
their patterns that are long enough.  The kind ``entropy`` comes from candidate strings (maximal runs
of token characters): a window slides over each, its counts change by one character in and one
out, and so does its Shannon entropy; a window is taken by the threshold of the narrowest
character class that holds all its characters (digits alone, hexadecimal, base 64).  Windows that
touch are one span, without what base spans cover.  Candidates on the allow list are suppressed; a sample, a
placeholder or a run of one character suppresses its piece between separators only, and the stretches beside it are scanned.

Cases: a null text has no spans; empty texts neither; texts are scanned whole whatever their length; repeated
rows give repeated rows; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import per_text, rewrite

#: Kinds in their order at equal starts.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+", re.ASCII)
HEX = re.compile(r"[0-9a-f]{24,}", re.ASCII)
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
MIN_ASSIGN, MIN_ACCESS = 6, 20

#: The window of the entropy scan, in characters, and the least entropy in bits per class.
WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW, re.ASCII)
THRESHOLDS = {"digits": math.inf, "hex": 3.0, "base64": 3.8}
#: Stretches of candidates that are no secrets: words and identifiers without digits, paths of words, UUIDs.
ALLOWED = re.compile(
    r"[A-Za-z+/_=-]*|[0-9+/_=-]*"
    r"|[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
    r"|[A-Za-z]+[0-9]{0,4}(?:[/_-][A-Za-z]*[0-9]{0,4})*"
)
#: Samples and placeholders, and long runs of one character; the pieces of a candidate, and rules of separators.
HARMLESS = re.compile(r"(?i:example|sample|placeholder|changeme)|(.)\1{7}")
PIECE = re.compile(r"[A-Za-z0-9+]+|([/_=-])\1{7,}")
SIGN = re.compile(r"[A-Za-z0-9]")

_PART = [0.0] + [n / WINDOW * math.log2(n / WINDOW) for n in range(1, WINDOW + 1)]
_DIGITS, _HEX = frozenset("0123456789"), frozenset("0123456789abcdefABCDEF")


def entropy_spans(candidate: str) -> list[tuple[int, int]]:
    """Where windows of a candidate reach the threshold of their class, joined where they touch."""
    counts: dict[str, int] = {}
    entropy, wide, not_digit = 0.0, 0, 0
    found: list[list[int]] = []
    for end, c in enumerate(candidate, 1):
        n = counts.get(c, 0)
        entropy += _PART[n] - _PART[n + 1]
        counts[c] = n + 1
        wide += c not in _HEX
        not_digit += c not in _DIGITS
        if end > WINDOW:
            out = candidate[end - WINDOW - 1]
            m = counts[out]
            entropy += _PART[m] - _PART[m - 1]
            counts[out] = m - 1
            wide -= out not in _HEX
            not_digit -= out not in _DIGITS
        if end >= WINDOW:
            kind = "base64" if wide else "hex" if not_digit else "digits"
            if entropy >= THRESHOLDS[kind]:
                start = end - WINDOW
                if found and start <= found[-1][1]:
                    found[-1][1] = end
                else:
                    found.append([start, end])
    return [(a, b) for a, b in found]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the fixed patterns."""
    low = text.encode("utf-8", "surrogatepass").translate(LOWER)
    out = []
    if any(w in low for w in ASSIGN_WORDS):
        out += [
            (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= MIN_ASSIGN
        ]
    if b"akia" in low:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def stretches(candidate: str) -> list[tuple[int, int]]:
    """What is left of a candidate between its harmless pieces."""
    if not HARMLESS.search(candidate):
        return [(0, len(candidate))]
    out, at = [], 0
    for m in PIECE.finditer(candidate):
        if HARMLESS.search(m[0]):
            out.append((at, m.start()))
            at = m.end()
    return [*out, (at, len(candidate))]


def outside(start: int, end: int, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The parts of a span that no base span (in order of starts) covers."""
    out = []
    for s, _, e in base:
        if s < end and start < e:
            if start < s:
                out.append((start, s))
            start = max(start, e)
    return [*out, (start, end)] if start < end else out


def all_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The base spans, and what entropy spans have outside them."""
    more = []
    for m in CANDIDATE.finditer(text):
        for begin, end in stretches(m[0]):
            stretch = m[0][begin:end]
            if len(stretch) < WINDOW or ALLOWED.fullmatch(stretch):
                continue
            for a, b in entropy_spans(stretch):
                parts = outside(a + begin + m.start(), b + begin + m.start(), base)
                more += [(s, 3, e) for s, e in parts if SIGN.search(text, s, e)]
    return sorted(base + more)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): all spans of each text as an array of (kind, start, end)."""

    def run(texts: list[str | None]) -> dict[str, object]:
        spans = [all_spans(t, base_spans(t)) if t else [] for t in texts]
        return {"spans": [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in found] for found in spans]}

    return per_text(docs, ["doc_id"], run, "spans array<struct<kind:string,start:int,end:int>>")


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans and all spans as text."""

    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return scanned.select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        of("entropy").alias("n_entropy"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def hidden(text: str | None, mark: str) -> str | None:
    """``text`` with every span replaced by ``mark``."""
    if not text:
        return text
    out, at = [], 0
    for start, _, end in all_spans(text, base_spans(text)):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark`` and ``n_chars`` counted anew where
    something was replaced; other rows and columns stay as they are."""
    return rewrite(docs, lambda texts: [hidden(t, mark) for t in texts])
