"""A SentencePiece vocabulary read as a unigram model: pieces with scores, best segmentation by added scores.

Scores are added exactly (64-bit floats), where the C++ library adds 32-bit floats; the rules are its own: pieces
are tried by ascending start, a later candidate must be strictly better, a character that no one-character piece
matches costs the lowest score less 10, and turns into its bytes where the vocabulary has byte pieces. A blank is
put before the text (none before an empty one), and blanks are the vocabulary's ``▁``.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import ahocorasick
import numpy as np

#: Fixed values of the format.
SPACE, UNKNOWN_PENALTY = "▁", 10.0
#: So many stretches, and ids of them, are remembered by a worker at most.
REMEMBERED, REMEMBERED_IDS = 400_000, 1 << 22
#: Characters whose stretches are held as strings at once.
SLICE = 1 << 18


@dataclass
class Vocabulary:
    """Plain lists, so that it can be sent to the executors. Its size is that of the model file."""

    pieces: dict[str, tuple[int, float]]  # with blanks for ``▁``: id, score
    unknown_id: int
    unknown_score: float
    bytes_from: int | None  # id of byte 0, if the vocabulary has byte pieces
    texts: list[bytes] = field(repr=False, default_factory=list)  # by id, for decoding
    longest: int = 1
    fingerprint: int = 0
    pattern: str = ""  # finds stretches between which no piece reaches

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces: dict[str, tuple[int, float]] = {}
        texts, low, byte_ids = [], 0.0, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids.append(i)
                texts.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                texts.append(b"" if model.is_control(i) else " ⁇ ".encode())
            else:
                plain = piece.replace(SPACE, " ")
                pieces[plain] = (i, float(model.get_score(i)))
                texts.append(plain.encode())
                low = min(low, float(model.get_score(i)))
        return cls.of(pieces, model.unk_id(), low - UNKNOWN_PENALTY, byte_ids[0] if len(byte_ids) == 256 else None, texts)

    @classmethod
    def of(cls, pieces, unknown_id, unknown_score, bytes_from, texts) -> Vocabulary:
        if any(" " in p.lstrip(" ") for p in pieces):
            pattern = r"(?s).+"  # a piece may reach over a blank: the whole text is one stretch
        elif any("\n" in p and p != "\n" for p in pieces):
            pattern = r" *[^ ]+| +"
        else:
            pattern = r" *[^ \n]+| +|\n"
        return cls(pieces, unknown_id, unknown_score, bytes_from, texts, max(map(len, pieces), default=1), hash(tuple(pieces.items())), pattern)

    def automaton(self) -> ahocorasick.Automaton:
        """All pieces that end at a character are found in one walk over the text."""
        found = ahocorasick.Automaton()
        for piece, (i, score) in self.pieces.items():
            found.add_word(piece, (len(piece), score, i))
        if self.pieces:
            found.make_automaton()
        return found

    def matches(self, automaton, text: str) -> list[list[tuple[int, float, int]]]:
        """For each end (1 to len) the pieces that end there: (length, score, id), longest first."""
        ends: list[list] = [[] for _ in range(len(text) + 1)]
        if self.pieces:
            for last, match in automaton.iter(text):
                ends[last + 1].append(match)
        for at in ends:
            at.sort(key=lambda m: -m[0])
        return ends

    def segment(self, automaton, text: str) -> tuple[list, float]:
        """The pieces by which each place of the best path is reached, and its score.

        The automaton gives matches by ascending end and, of one end, the longest first: a later one must be strictly
        better. That is all where every character is a piece; else unknown ones are looked at too.
        """
        size, lost, single = len(text), -float("inf"), 0
        best, by = [lost] * (size + 1), [None] * (size + 1)
        best[0] = 0.0
        for last, match in automaton.iter(text) if self.pieces else ():
            length, score, _ = match
            last += 1
            score += best[last - length]
            if length == 1:
                single += 1
            if score > best[last]:
                best[last], by[last] = score, match
        if single < size:
            best, by = forward(self, self.matches(automaton, text), text, {0: 0.0}, size)
        return by, best[size]

    def counted(self, automaton, text: str) -> tuple[int, float]:
        """Number of pieces of the best path and its score, by the rules of ``segment``: both are carried from place to
        place, and no path is kept."""
        size, lost, single = len(text), -float("inf"), 0
        best, pieces = [lost] * (size + 1), [0] * (size + 1)
        best[0] = 0.0
        for last, (length, score, _) in automaton.iter(text) if self.pieces else ():
            last += 1
            score += best[last - length]
            if length == 1:
                single += 1
            if score > best[last]:
                best[last], pieces[last] = score, pieces[last - length] + 1
        if single == size:
            return pieces[size], best[size]
        ends = self.matches(automaton, text)
        best = [0.0] + [lost] * size
        for end in range(1, size + 1):
            single = False
            for length, score, _ in ends[end]:
                single |= length == 1
                if best[end - length] + score > best[end]:
                    best[end], pieces[end] = best[end - length] + score, pieces[end - length] + 1
            if not single and best[end - 1] + self.unknown_score > best[end]:
                best[end] = best[end - 1] + self.unknown_score
                pieces[end] = pieces[end - 1] + self.unknown_count(text[end - 1])
        return pieces[size], best[size]

    def unknown_count(self, character: str) -> int:
        return 1 if self.bytes_from is None else len(character.encode())

    def unknown_ids(self, character: str) -> list[int]:
        return [self.unknown_id] if self.bytes_from is None else [self.bytes_from + b for b in character.encode()]

    def finder(self) -> re.Pattern:
        return re.compile(self.pattern)


def forward(vocabulary: Vocabulary, ends: list, text: str, start: dict[int, float], stop: int) -> tuple[list, list]:
    """Best score to reach each place of ``text`` and the match it is reached by, from the places in ``start`` (score).

    No piece starts at ``stop`` or later. An unknown character is a match of id -1; an unreached place has no score.
    """
    size = len(text)
    best: list[float | None] = [None] * (size + 1)
    by: list[tuple | None] = [None] * (size + 1)
    for place, score in start.items():
        best[place] = score
    unknown = (1, vocabulary.unknown_score, -1)
    for end in range(1, size + 1):
        single, top, how = False, best[end], None
        for match in ends[end]:  # longest first: ascending start, so a later one must be strictly better
            single |= match[0] == 1
            before = best[end - match[0]] if match[0] <= end and end - match[0] < stop else None
            if before is not None and (top is None or before + match[1] > top):
                top, how = before + match[1], match
        if not single and end - 1 < stop and best[end - 1] is not None:
            if top is None or best[end - 1] + vocabulary.unknown_score > top:
                top, how = best[end - 1] + vocabulary.unknown_score, unknown
        best[end], by[end] = top, how
    return best, by


def backward(vocabulary: Vocabulary, text: str, by: list, end: int) -> tuple[list[int], int]:
    """Ids of the best path to ``end`` and the place it starts from."""
    ids: list[int] = []
    match = by[end]
    while match is not None:
        length, _, i = match
        if i < 0:
            ids.extend(reversed(vocabulary.unknown_ids(text[end - 1])))
        else:
            ids.append(i)
        end -= length
        match = by[end]
    ids.reverse()
    return ids, end


class Remembered(dict):
    """Segmentations of stretches between which no piece reaches: their row, with sizes, scores and ids by row.

    The key of a stretch that begins with its only blank is what follows the blank; that of any other is the stretch
    after one blank more.
    """

    def __init__(self, vocabulary: Vocabulary, with_ids: bool):
        self.vocabulary, self.automaton, self.find = vocabulary, vocabulary.automaton(), vocabulary.finder().findall
        self.with_ids, self.whole = with_ids, vocabulary.pattern.startswith("(?s)")
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.flat, self.starts, self.sizes, self.scores = array("i"), array("q"), array("i"), array("d")

    def __missing__(self, key: str) -> int:
        text = key[1:] if key.startswith(" ") else " " + key
        self.starts.append(len(self.flat))
        if self.with_ids:
            by, score = self.vocabulary.segment(self.automaton, text)
            ids, _ = backward(self.vocabulary, text, by, len(text))
            self.flat.extend(ids)
            self.sizes.append(len(ids))
        else:
            n, score = self.vocabulary.counted(self.automaton, text)
            self.sizes.append(n)
        self.scores.append(score)
        row = self[key] = len(self.sizes) - 1
        return row

    def keys_of(self, text: str) -> list[str]:
        """Keys of the stretches of a text (without the blank put before it)."""
        text = text.replace(SPACE, " ")
        if not self.whole and "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [self.key(u) for u in self.find(" " + text)]

    @staticmethod
    def key(unit: str) -> str:
        return unit[1:] if unit[0] == " " and " " not in unit[1:] else " " + unit

    def slices(self, text: str) -> Iterator[str]:
        """Parts of a text, each without the blank before it; a part ends where a stretch does."""
        at = 0
        while len(text) - at > SLICE and not self.whole:
            end = text.find(" ", at + SLICE)
            while end > 0 and text[end - 1] == " ":
                end = text.find(" ", end + 1)
            if end < 0:
                break
            yield text[at:end]
            at = end + 1
        yield text[at:]

    def rows_of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of all stretches of the texts, and where each text's begin and end."""
        if len(self) > REMEMBERED or len(self.flat) > REMEMBERED_IDS:
            self.forget()
        rows, counts, held, size = [], [], [], 0

        def settle() -> None:
            nonlocal held, size
            rows.append(np.fromiter(map(self.__getitem__, chain.from_iterable(held)), np.int64, sum(map(len, held))))
            held, size = [], 0

        for text in texts:
            n = 0
            for part in self.slices(text) if text else ():
                held.append(self.keys_of(part) if part else [""])
                n += len(held[-1])
                size += len(part)
                if size > SLICE:
                    settle()
            counts.append(n)
        settle()
        return np.concatenate(rows), np.cumsum([0, *counts])

    def rows_inside(self, text: str) -> np.ndarray:
        """Rows of the stretches of a part of a text that begins and ends where a stretch does."""
        if text.startswith(" ") and len(text) > 1 and text[1] != " ":
            return self.rows_of([text[1:]])[0]
        keys = [self.key(u) for u in self.find(text)]
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, starts, sizes and scores by row: views, to be let go before further stretches are looked up."""
        kinds = ((self.flat, np.int32), (self.starts, np.int64), (self.sizes, np.int32), (self.scores, np.float64))
        return tuple(np.frombuffer(x, kind) if len(x) else np.zeros(0, kind) for x, kind in kinds)


_KNOWN: dict[tuple[int, bool], Remembered] = {}


def remembered(shared, with_ids: bool) -> Remembered:
    """What this worker process remembers for a broadcast vocabulary, over all of its tasks."""
    key = (shared.value.fingerprint, with_ids)
    if key not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[key] = Remembered(shared.value, with_ids)
    return _KNOWN[key]


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """``flat[start : start + size]`` of every start and size, joined."""
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    out = np.empty(total[-1], flat.dtype)
    for at in range(0, len(starts), step):
        a, b = total[at], total[min(at + step, len(starts))]
        n = sizes[at : at + step]
        out[a:b] = flat[np.repeat(starts[at : at + step] - (total[at : at + step][: len(n)] - a), n) + np.arange(b - a)]
    return out
