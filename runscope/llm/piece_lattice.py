"""N-best segmentation of a text into pieces of a given vocabulary.

The pieces that fit a string form a lattice over its characters. A forward Viterbi pass
gives the best score from the start to every position. A backward A-star search from the
end uses these scores as its heuristic; they are exact, so complete segmentations leave
the queue in order of their scores (Nagata, "A Stochastic Japanese Morphological Analyzer
Using a Forward-DP Backward-A* N-Best Search Algorithm", COLING 1994). An entry of the queue stands for segmentations that no
other entry has, and its key is the score of its best one. So of a queue only as many entries are kept as segmentations are wanted.

No usable piece reaches from one word into the next (a blank can only open a piece), so
the lattice of a text is a chain of word lattices. The forward pass runs once per distinct word and keeps
the two best scores; new words of a batch run through it together, as many at a time as have the same length.
The N best of the chain differ from the best one only in the N - 1 words whose second
best segmentation costs least; these are searched backwards.

Words and the ids of their best segmentation, packed as 32-bit integers, are kept up to a number of bytes. Very
long words are not kept. A text is taken in blocks of limited size.
"""

from __future__ import annotations

import heapq
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np

BLANK = "▁"
#: Pieces at or below this score are no choice, except that a single character may need one.
UNUSABLE = -1e8
#: Below the worst piece, for a character that no usable piece covers; without any piece it becomes its UTF-8 bytes.
UNKNOWN_PENALTY = 10.0
_LOWEST = float("-inf")

#: Bytes of words that are kept; words longer than ``LONG`` are not. Characters of a text that are taken at once.
KEPT_BYTES = 64 << 20
LONG = 512
BLOCK = 1 << 20
#: What a kept word takes besides its characters and ids.
_ENTRY = 280
#: Words of up to so many characters run together, so many at a time; fewer than so many new words run alone.
_WIDEST, _CHUNK, _FEWEST = 48, 8192, 200
_BASE, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Change(NamedTuple):
    """Instead of ``drop`` ids from place ``at`` of the best segmentation on stand ``ids``, packed."""

    at: int
    drop: int
    ids: bytes


class Found(NamedTuple):
    """The best segmentation with its ids, packed, and the next best ones as changes of it from left to right."""

    score: float
    ids: bytes
    others: list[tuple[float, list[Change]]]


class _PieceTable:
    """Finds pieces by the hashes of their characters: an open hash table in arrays."""

    BITS = 18

    def __init__(self, pieces: dict[str, tuple[int, float]]):
        size = 1 << self.BITS
        while size < 4 * len(pieces):
            size *= 2
        self._mask, self._shift = size - 1, np.uint64(64 - size.bit_length() + 1)
        self._keys = np.zeros(size, dtype=np.uint64)
        self.ids, self.scores = np.full(size, -1, dtype=np.int32), np.full(size, _LOWEST)
        for piece, (number, score) in pieces.items():
            codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            key = self.prefixes(codes[None, :])[0, -1]
            with np.errstate(over="ignore"):
                slot = int((key * _SPREAD) >> self._shift)
            while self._keys[slot]:
                if self._keys[slot] == key:
                    raise ValueError(f"the hash of {piece!r} is that of another piece")
                slot = (slot + 1) & self._mask
            self._keys[slot], self.ids[slot], self.scores[slot] = key, number, score

    @staticmethod
    def prefixes(codes: np.ndarray) -> np.ndarray:
        """Hashes of all beginnings of every row."""
        out = np.zeros((codes.shape[0], codes.shape[1] + 1), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(codes.shape[1]):
                out[:, k + 1] = out[:, k] * _BASE + codes[:, k] + np.uint64(1)
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or an empty one."""
        slots = ((keys * _SPREAD) >> self._shift).astype(np.int64)
        there = self._keys[slots]
        going = np.flatnonzero((there != keys) & (there != 0))
        while len(going):
            at = (slots[going] + 1) & self._mask
            slots[going] = at
            there = self._keys[at]
            going = going[(there != keys[going]) & (there != 0)]
        return slots


class Lattices:
    """Segments words and texts; ``pieces`` maps each piece to (id, score)."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int], kept_bytes: int = KEPT_BYTES):
        self._unknown = min(score for _, score in pieces.values() if score > UNUSABLE) - UNKNOWN_PENALTY
        self._bytes = byte_ids
        self._pieces = {
            p: (i, score if score > UNUSABLE else self._unknown)
            for p, (i, score) in pieces.items()
            if score > UNUSABLE or len(p) == 1
        }
        if any(BLANK in p[1:] for p in self._pieces):
            raise ValueError("a piece that crosses a blank can't be segmented word by word")
        self._longest = max(map(len, self._pieces))
        self._table = _PieceTable(self._pieces)
        self._limit = kept_bytes
        self._forget()

    def _forget(self) -> None:
        #: Places of words in the lists of best scores, packed ids of the best, and what the second best costs more.
        self._words: dict[str, int] = {}
        self._scores, self._parts, self._gaps = array("d"), [], array("d")
        self._size = 0

    # ---- one word

    def _from(self, word: str, i: int) -> list[tuple[int, int, float]]:
        """The edges that leave position ``i``: end, id (-1 for the bytes of a character), score."""
        edges = [
            (end, *self._pieces[word[i:end]])
            for end in range(i + 1, min(i + self._longest, len(word)) + 1)
            if word[i:end] in self._pieces and not (i and word[i] == BLANK)
        ]
        return edges if edges and edges[0][0] == i + 1 else [*edges, (i + 1, -1, self._unknown)]

    def _into(self, word: str, end: int) -> list[tuple[int, int, float]]:
        """The edges that reach position ``end``: start, id, score."""
        get, edges = self._pieces.get, []
        for start in range(max(0, end - self._longest), end):
            # A literal blank character is no word boundary and goes by its bytes.
            if start and word[start] == BLANK:
                continue
            found = get(word[start:end])
            if found:
                edges.append((start, *found))
        if not edges or edges[-1][0] != end - 1:
            edges.append((end - 1, -1, self._unknown))
        return edges

    def _forward(self, word: str) -> tuple[array, array, array, array]:
        """Viterbi: best and second best score up to every position, and start and id of the last piece of the best."""
        n = len(word)
        best, second = array("d", [_LOWEST]) * (n + 1), array("d", [_LOWEST]) * (n + 1)
        starts, ids = array("i", [0]) * (n + 1), array("i", [-1]) * (n + 1)
        best[0] = 0.0
        for end in range(1, n + 1):
            top, next_ = _LOWEST, _LOWEST
            for start, piece, score in self._into(word, end):
                total, other = best[start] + score, second[start] + score
                if total > top:
                    top, next_, total = total, max(top, next_), _LOWEST
                    starts[end], ids[end] = start, piece
                next_ = max(next_, total, other)
            best[end], second[end] = top, next_
        return best, second, starts, ids

    def n_best(self, word: str, n: int) -> list[tuple[float, bytes]]:
        """The n best segmentations of one word as (score, packed ids), best first."""
        best = self._forward(word)[0]
        found: list[tuple[float, bytes]] = []
        queue: list[tuple] = [(-best[-1], 0, 0.0, len(word), None)]
        serial = 0
        while queue and len(found) < n:
            _, _, done, at, path = queue.pop(0)
            if at == 0:
                found.append((done, self._packed(word, path)))
                continue
            for start, piece, more in self._into(word, at):
                serial += 1
                score = done + more
                queue.append((-(score + best[start]), serial, score, start, (start, at, piece, path)))
            # Equal scores: what has got furthest, as it was put in last, goes first.
            queue.sort(key=lambda e: (e[0], e[1]))
            del queue[n - len(found) :]
        return found

    def _packed(self, word: str, path: tuple | None) -> bytes:
        ids = array("i")
        while path:
            start, end, piece, path = path
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(self._byte_ids(word[start:end]))
        return ids.tobytes()

    def _byte_ids(self, character: str) -> list[int]:
        return [self._bytes[b] for b in character.encode("utf-8", "surrogatepass")]

    def _entry(self, word: str) -> tuple[float, bytes, float]:
        marked = BLANK + word
        best, second, starts, ids = self._forward(marked)
        at, path = len(marked), None
        while at:
            path = (starts[at], at, ids[at], path)
            at = starts[at]
        return best[-1], self._packed(marked, path), best[-1] - second[-1]

    # ---- many words

    def learn(self, words: Iterable[str]) -> None:
        """Segment the words that are not kept yet; if there are too many, all but these give way."""
        words = set(words)
        if self._size > self._limit:
            places, scores, parts, gaps = self._words, self._scores, self._parts, self._gaps
            self._forget()
            still = [w for w in words if w in places]
            self._keep(still, [(scores[i], parts[i], gaps[i]) for i in map(places.__getitem__, still)])
        new = sorted(words - self._words.keys(), key=len)
        narrow = bisect_right(new, _WIDEST, key=len) if len(new) >= _FEWEST else 0
        for at in range(0, narrow, _CHUNK):
            part = new[at : min(at + _CHUNK, narrow)]
            self._keep(part, self._together(part))
        alone = new[narrow : bisect_right(new, LONG, key=len)]
        self._keep(alone, list(map(self._entry, alone)))

    def _keep(self, words: list[str], entries: list[tuple[float, bytes, float]]) -> None:
        if words:
            scores, parts, gaps = zip(*entries)
            self._words.update(zip(words, range(len(self._parts), len(self._parts) + len(words))))
            self._scores.extend(scores)
            self._parts.extend(parts)
            self._gaps.extend(gaps)
            self._size += _ENTRY * len(words) + 2 * sum(map(len, words)) + sum(map(len, parts))

    def _together(self, words: list[str]) -> list[tuple[float, bytes, float]]:
        """Entries of words of about the same length, the longest last."""
        lengths = np.array([len(w) + 1 for w in words])
        n, count = int(lengths[-1]), len(words)
        # What a word is filled up with lies behind its end.
        marked = "".join([(BLANK + w).ljust(n, "\0") for w in words])
        codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(count, n)
        prefixes = self._table.prefixes(codes)
        byte_ids = np.array(self._bytes[:128], dtype=np.int32)
        literal = codes == ord(BLANK)
        literal[:, 0] = False
        odd = literal.any()
        best, second = np.full((n + 1, count), _LOWEST), np.full((n + 1, count), _LOWEST)
        starts, ids = np.zeros((n + 1, count), dtype=np.int16), np.full((n + 1, count), -1, dtype=np.int32)
        best[0] = 0.0
        powers = [np.uint64(1)]
        with np.errstate(over="ignore", invalid="ignore"):
            for _ in range(self._longest):
                powers.append(powers[-1] * _BASE)
            for end in range(1, n + 1):
                top, next_ = best[end], second[end]
                for start in range(max(0, end - self._longest), end):
                    slots = self._table.slots(prefixes[:, end] - prefixes[:, start] * powers[end - start])
                    score, piece = self._table.scores[slots], self._table.ids[slots]
                    if odd and start:
                        score[literal[:, start]], piece[literal[:, start]] = _LOWEST, -1
                    if start == end - 1:
                        none = np.flatnonzero(piece < 0)
                        score[none] = self._unknown
                        code = codes[none, start]
                        piece[none] = np.where(code < 128, byte_ids[code & 127], -1)
                    fits = np.flatnonzero(score > _LOWEST)
                    if len(fits) == 0:
                        continue
                    score, piece, old = score[fits], piece[fits], top[fits]
                    total, other = best[start][fits] + score, second[start][fits] + score
                    next_[fits] = np.maximum(np.maximum(next_[fits], other), np.minimum(old, total))
                    better = total > old
                    rows = fits[better]
                    top[rows] = total[better]
                    starts[end][rows], ids[end][rows] = start, piece[better]
        # Back from the ends, all words a piece at a time.
        every, at = np.arange(count), lengths
        final, second_best = best[lengths, every], second[lengths, every]
        chain: list[np.ndarray] = []
        sizes = np.zeros(count, dtype=np.int64)
        plain = np.ones(count, dtype=bool)
        while True:
            going = at > 0
            if not going.any():
                break
            piece = np.where(going, ids[at, every], -2)
            plain &= piece != -1
            chain.append(piece)
            sizes += going
            at = np.where(going, starts[at, every], 0)
        backwards = np.stack(chain[::-1], axis=1)
        packed = np.ascontiguousarray(backwards[backwards != -2], dtype=np.int32).tobytes()
        ends = (4 * np.cumsum(sizes)).tolist()
        parts = map(packed.__getitem__, map(slice, [0, *ends[:-1]], ends))
        entries = list(zip(final.tolist(), parts, (final - second_best).tolist()))
        for i in np.flatnonzero(~plain).tolist():
            # Some character becomes several bytes.
            entries[i] = self._entry(words[i])
        return entries

    def _entries(self, words: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """Scores, packed ids and gaps of words in their order."""
        if max(map(len, words)) <= LONG:
            try:
                places = list(map(self._words.__getitem__, words))
            except KeyError:
                self.learn(words)
                places = list(map(self._words.__getitem__, words))
            scores, gaps = np.frombuffer(self._scores), np.frombuffer(self._gaps)
            return scores[places], list(map(self._parts.__getitem__, places)), gaps[places]
        self.learn(words)
        known = ((self._scores[i], self._parts[i], self._gaps[i]) if i is not None else None for i in map(self._words.get, words))
        scores, parts, gaps = zip(*(entry or self._entry(word) for entry, word in zip(known, words)))
        return np.array(scores), list(parts), np.array(gaps)

    # ---- texts

    def segmentations(self, text: str, n: int) -> Found:
        """The n best segmentations of a text.

        Equal scores are ordered by the word that differs. An empty text has one, without ids.
        """
        if not text:
            return Found(0.0, b"", [])
        total, packed, done, cheapest = 0.0, [], 0, []
        for words in _blocks(text):
            scores, parts, costs = self._entries(words)
            total += float(scores.sum())
            # Any other choice is no better than the n segmentations that the cheapest words give.
            for i, cost in _least(costs, n - 1):
                cheapest.append((cost, done + len(b"".join(parts[:i])), words[i], parts[i]))
            cheapest = heapq.nsmallest(n - 1, cheapest)
            packed.append(b"".join(parts))
            done += len(packed[-1])
        chosen: list[tuple[float, list[Change]]] = [(0.0, [])]
        for _, place, word, first in sorted(cheapest, key=lambda c: c[1]):
            options = self.n_best(BLANK + word, n)
            top = options[0][0]
            if options[0][1] != first:
                # Of equal scores the queue may have brought another one first.
                options = [(top, first), *(o for o in options if o[1] != first)][:n]
            change = lambda ids: Change(place // 4, len(first) // 4, ids)  # noqa: B023, E731
            chosen = heapq.nsmallest(
                n,
                (
                    (cost + top - score, changes if k == 0 else [*changes, change(ids)])
                    for cost, changes in chosen
                    for k, (score, ids) in enumerate(options)
                ),
                key=lambda c: c[0],
            )
        return Found(total, b"".join(packed), [(total - cost, changes) for cost, changes in chosen[1:]])

    def segment_arrays(self, text: str, n: int) -> list[tuple[float, array]]:
        """The n best segmentations as (score, ids), best first."""
        found = self.segmentations(text, n)
        return [(score, array("i", changed(found.ids, changes))) for score, changes in [(found.score, []), *found.others]]

    def segment(self, text: str, n: int) -> list[tuple[float, list[int]]]:
        return [(score, ids.tolist()) for score, ids in self.segment_arrays(text, n)]

    def best_and_scores(self, text: str, n: int) -> tuple[list[int], list[float]]:
        """The ids of the best segmentation and the scores of the n best."""
        found = self.segmentations(text, n)
        return array("i", found.ids).tolist(), [found.score, *(score for score, _ in found.others)]


def _least(values: np.ndarray, n: int) -> list[tuple[int, float]]:
    """Places and values of the n least finite values; of equal ones the first. ``values`` is used up."""
    found: list[tuple[int, float]] = []
    for _ in range(n):
        at = int(values.argmin())
        if values[at] == np.inf:
            break
        found.append((at, float(values[at])))
        values[at] = np.inf
    return found


def _blocks(text: str) -> Iterator[list[str]]:
    """The words of a text, those of about ``BLOCK`` characters at a time."""
    start = 0
    while len(text) - start > BLOCK:
        end = text.find(" ", start + BLOCK)
        if end < 0:
            break
        yield text[start:end].split(" ")
        start = end + 1
    yield (text[start:] if start else text).split(" ")


def changed(ids: bytes, changes: list[Change]) -> bytes:
    """Packed ids after the changes."""
    parts, at = [], 0
    for change in changes:
        parts += [ids[at : 4 * change.at], change.ids]
        at = 4 * (change.at + change.drop)
    return b"".join([*parts, ids[at:]])


def decoded_bytes(packed: bytes, table: list[bytes]) -> bytes:
    """UTF-8 bytes of packed ids, the blank in front included; ``table`` has the bytes of every id."""
    return b"".join(map(table.__getitem__, array("i", packed)))


def decoded(ids: list[int], table: list[bytes]) -> str:
    """The text of a sequence of ids, the inverse of every segmentation.

    ``table`` has the bytes of every id, with blanks in place of their mark.
    """
    raw = b"".join(map(table.__getitem__, ids))
    return raw.decode("utf-8", "surrogatepass")[1:]
