"""Secrets in texts: patterns of known kinds, and strings whose sliding windows have the entropy of random characters."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platework.llm.common import in_batches

KINDS = ("assign", "access", "hex", "entropy")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Shortest second group, access key and run of hex digits that count. A run of digits that is too short has no longer
#: one inside, so that these can be sought at once.
ASSIGNED, ACCESS, HEX = 6, 20, 24
_HEX = re.compile(r"[0-9a-f]{%d,}" % HEX)

#: A string that may be a secret: a whole run of these, as long as a window at least. The run is taken whole, as no run
#: can begin inside another.
WINDOW = 20
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % WINDOW)


@dataclass(frozen=True)
class Alphabet:
    """A class of characters. Windows of a string that it holds whole are random from ``bits`` of entropy a character on,
    if they have a character of each set of ``needs``."""

    name: str
    holds: frozenset[str]
    bits: float
    needs: tuple[frozenset[str], ...]


_DIGIT, _LOW, _UP = frozenset("0123456789"), frozenset(map(chr, range(97, 123))), frozenset(map(chr, range(65, 91)))
#: From the narrowest on; a string belongs to the first that holds it. Windows of 20 characters drawn evenly have on
#: average 3.4 bits (16 characters), 3.9 (36) and 4.1 (64); words and numbers in them have less or lack a set.
ALPHABETS = (
    Alphabet("hex", _DIGIT | frozenset("abcdef"), 3.0, (_DIGIT, frozenset("abcdef"))),
    Alphabet("HEX", _DIGIT | frozenset("ABCDEF"), 3.0, (_DIGIT, frozenset("ABCDEF"))),
    Alphabet("lower", _DIGIT | _LOW, 3.6, (_DIGIT, _LOW)),
    Alphabet("upper", _DIGIT | _UP, 3.6, (_DIGIT, _UP)),
    Alphabet("mixed", _DIGIT | _LOW | _UP | frozenset("+/_=-"), 3.8, (_DIGIT, _LOW, _UP)),
)

#: Strings that look random and are none of anyone's secrets, by the string itself ...
ALLOWED = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",  # identifiers of 128 bits
    r"[+/_=-]*(?:[A-Za-z]+|[0-9]+)(?:[+/_=-]+(?:[A-Za-z]+|[0-9]+))*[+/_=-]*",  # words and numbers, as in paths and names
    r"(?i:.*(?:0123456789|abcdefghij|qwertyuiop|example|placeholder|changeme|xxxxx).*)",
)
#: ... and by what stands before it: digests that are published to be compared, and data in addresses.
ALLOWED_AFTER = (r"(?i:sha-?(?:1|224|256|384|512)|md5|digest|checksum|integrity|commit|etag)[\"']?\x20*[:=-]?\x20*[\"']?",
                 r"base64,")
CONTEXT = 24

_SCALE = 1 << 32


def _weights(window: int) -> list[int]:
    """c * log2(c) in whole numbers, so that sums do not depend on the way to them."""
    return [0, *[round(c * math.log2(c) * _SCALE) for c in range(1, window + 1)]]


def random_spans(text: str, alphabets: Sequence[Alphabet] = ALPHABETS, window: int = WINDOW) -> list[tuple[int, int]]:
    """(start, end) of the unions of overlapping or touching windows of ``text`` that are random in its class."""
    letters = set(text)
    alphabet = next((a for a in alphabets if letters <= a.holds), None)
    if alphabet is None or len(text) < window or not all(letters & need for need in alphabet.needs):
        return []
    weights = _weights(window)
    # entropy = log2(window) - sum(c * log2(c)) / window
    limit = round((math.log2(window) - alphabet.bits) * window * _SCALE)
    counts, total = dict.fromkeys(letters, 0), 0
    within = [0] * len(alphabet.needs)
    sets = {x: [k for k, need in enumerate(alphabet.needs) if x in need] for x in letters}
    spans: list[tuple[int, int]] = []
    for at, come in enumerate(text):
        c = counts[come]
        total += weights[c + 1] - weights[c]
        counts[come] = c + 1
        for k in sets[come]:
            within[k] += 1
        if at + 1 >= window:
            start = at + 1 - window
            if total <= limit and all(within):
                if spans and spans[-1][1] >= start:
                    spans[-1] = (spans[-1][0], at + 1)
                else:
                    spans.append((start, at + 1))
            go = text[start]
            c = counts[go]
            total += weights[c - 1] - weights[c]
            counts[go] = c - 1
            for k in sets[go]:
                within[k] -= 1
    return spans


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), leftmost and not overlapping within a kind; those that are too short are dropped after."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS]
    return found + [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]


class Scanner:
    def __init__(self, allowed: Sequence[str] = ALLOWED, allowed_after: Sequence[str] = ALLOWED_AFTER):
        self.allowed = [re.compile(x) for x in allowed]
        self.after = [re.compile(f"(?:{x})$") for x in allowed_after]

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """All (start, kind, end) of ``text``, in order. A random span within a base span is that one again and left out."""
        found = base_spans(text)
        covers = sorted((a, b) for a, _, b in found)
        for m in _CANDIDATE.finditer(text):
            new = [(m.start() + a, m.start() + b) for a, b in random_spans(m[0])]
            if new and not self._is_allowed(text, m):
                found += [(a, 3, b) for a, b in new if not any(x <= a and b <= y for x, y in covers)]
        return sorted(found)

    def _is_allowed(self, text: str, m: re.Match) -> bool:
        before = text[max(0, m.start() - CONTEXT) : m.start()]
        return any(p.fullmatch(m[0]) for p in self.allowed) or any(p.search(before) for p in self.after)


def scan(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", allowed: Sequence[str] = ALLOWED,
         allowed_after: Sequence[str] = ALLOWED_AFTER) -> DataFrame:
    """Per row: the id and ``spans``, an array of (kind, start, end) by start, kind and end; code points, end exclusive.

    Kinds: ``assign``, ``access`` and ``hex`` by their patterns, which nothing suppresses; ``entropy`` for windows of
    ``WINDOW`` characters of a candidate string with the entropy of random ones, unless the string is on the allow-list
    (``allowed``: patterns of whole strings; ``allowed_after``: of the text before it). Null and empty texts have no
    spans. Rows that repeat, or share an id, each give a row; an empty table gives an empty result; other columns are not
    read. Texts are scanned whole; a task holds a batch of them.
    """
    kind = df.schema[id_column].dataType.simpleString()
    known = {}

    def run(batch):
        scanner = known.get(0) or known.setdefault(0, Scanner(allowed, allowed_after))
        rows = [scanner.spans(t) if t else [] for t in batch["text"].to_pylist()]
        return {
            id_column: batch[id_column],
            "spans": [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in row] for row in rows],
        }

    rows = df.select(F.col(id_column), F.col(text_column).alias("text"))
    return in_batches(rows, run, f"`{id_column}` {kind}, spans array<struct<kind:string,start:long,end:long>>")


def masked(df: DataFrame, text_column: str = "text", mask: str = "[secret]", allowed: Sequence[str] = ALLOWED,
           allowed_after: Sequence[str] = ALLOWED_AFTER) -> DataFrame:
    """The rows with every secret replaced by ``mask``; overlapping spans by one. Null texts stay null."""
    names = df.columns
    known = {}

    def run(batch):
        scanner = known.get(0) or known.setdefault(0, Scanner(allowed, allowed_after))
        return {**batch, text_column: [t and _masked(t, scanner.spans(t), mask) for t in batch[text_column].to_pylist()]}

    ddl = ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)
    return in_batches(df, run, ddl)


def _masked(text: str, spans: Sequence[tuple[int, int, int]], mask: str) -> str:
    pieces, at = [], 0
    reach = 0
    for start, _, end in spans:
        if start >= reach:
            pieces += [text[at:start], mask]
        reach = max(reach, end)
        at = reach
    return "".join([*pieces, text[at:]]) if pieces else text


def written(spans: str, *kinds: str):
    """Spans as ``kind:start:end`` in their order, joined by commas; of the given kinds only."""
    chosen = F.filter(spans, lambda x: x["kind"].isin(*kinds)) if kinds else F.col(spans)
    return F.array_join(F.transform(chosen, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
