"""Shingle sets of texts and their sketches ("Fast Similarity Sketching", Dahlgaard, Knudsen and Thorup, FOCS 2017).

A sketch has ``BINS`` coordinates. In each of the first ``BINS`` rounds every element is thrown into a
hashed bin with a hashed value; a bin keeps the least (round, value) it has met. In round
``BINS + j`` all elements go to bin ``j``, so after at most ``2 * BINS`` rounds every bin is
filled. A text is done after the first round in which all its bins are: a text
with many elements needs one to three rounds, one with few needs many over few elements.
Two sets agree in a coordinate with the probability of their Jaccard similarity, and the number of agreements is
concentrated as strongly as with independent samples.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash

from runscope.llm.texts import WordHashes, spaced_words

SHINGLE = 5
ROWS = 5
BANDS = 26
BINS = ROWS * BANDS
#: Probability with which a pair at the threshold may miss all bands.
MISS = 2.5e-7
#: Bytes of texts that are cut into words together.
_TOGETHER = 1 << 18
#: Bytes that are no ASCII white space, and masks of the first bytes of eight.
_IN_WORD = np.array([c not in b" \t\n\r\x0b\x0c" for c in range(256)], dtype=np.int8)
_MASKS = np.array([256**n - 1 for n in range(9)], dtype=np.uint64)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_VALUE_BITS = np.uint64(54)
_VALUE = np.uint64((1 << 54) - 1)


def mixed(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every bit of the input reaches every bit of the result."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; a shorter text is one run, an empty one none."""
    words = spaced_words(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    seq = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    runs = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for j in range(width):
        runs = mixed(runs * np.uint64(0x9E3779B97F4A7C15) + seq[j : len(seq) - width + j + 1])
    return np.unique(runs)


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """``shingles`` of many texts, with word hashes made from their bytes for all words at once."""
    found: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        upto, length = at, 0
        while upto < len(texts) and (upto == at or length + len(texts[upto]) < _TOGETHER):
            length += len(texts[upto]) + 1
            upto += 1
        found += _shingle_sets(texts[at:upto], size)
        at = upto
    return found


def _shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    # A text ends with a blank, so no word goes on into the next one; behind the last one all eight bytes can be read.
    buffer = np.frombuffer(b"\n".join([*texts, bytes(8)]).lower(), dtype=np.uint8)
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    edge = np.flatnonzero(np.diff(_IN_WORD.take(buffer[: int(lengths.sum())]), prepend=np.int8(0)))
    first, last = edge[::2], edge[1::2]
    words = np.bincount(np.searchsorted(np.cumsum(lengths), first, side="right"), minlength=len(texts))
    hashes = _word_hashes(buffer, first, last - first)
    ends = np.cumsum(words)
    width = np.minimum(words, size)
    of_run = np.repeat(width, words)
    runs, whole = of_run.astype(np.uint64), bool((of_run == size).all())
    # A run that begins too late in its text is left out below.
    for j in range(size):
        longer = mixed(runs * np.uint64(0x9E3779B97F4A7C15) + np.roll(hashes, -j))
        runs = longer if whole else np.where(of_run > j, longer, runs)
    sets = []
    for n, end, w in zip(words.tolist(), ends.tolist(), width.tolist()):
        own = np.sort(runs[end - n : end - w + 1]) if n else runs[:0]
        sets.append(own[np.concatenate(([True], own[1:] != own[:-1]))] if n else own)
    return sets


def _word_hashes(buffer: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A well mixed hash of every word, from its length and its bytes, eight at a time."""
    eight = np.lib.stride_tricks.as_strided(buffer, (max(len(buffer) - 7, 0), 8), (1, 1), writeable=False)
    h = mixed(length.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    rows, at, left = np.arange(len(first)), first, length
    while len(rows):
        part = eight[at].view("<u8").ravel() & _MASKS.take(np.minimum(left, 8))
        h[rows] = mixed((h[rows] ^ part) * np.uint64(0xD1B54A32D192ED03) + np.uint64(0x9E3779B97F4A7C15))
        more = np.flatnonzero(left > 8)
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    return h


def fingerprint(elements: np.ndarray) -> bytes:
    """128 bits of a set: equal sets, and only they, have equal ones."""
    return xxhash.xxh3_128_digest(elements.tobytes())


def sketches(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` coordinates per set; empty sets have none filled."""
    out = np.full(len(sets) * bins, _EMPTY, dtype=np.uint64)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    elements = np.concatenate(sets) if len(sets) else np.zeros(0, dtype=np.uint64)
    for turn in range(2 * bins):
        if len(elements) == 0:
            break
        h = mixed(elements + np.uint64((turn + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
        value = (np.uint64(turn) << _VALUE_BITS) | (h & _VALUE)
        # The bin comes from the upper bits of a second mixing, independent of the value.
        bin_of = (mixed(h) >> np.uint64(33)) % np.uint64(bins) if turn < bins else np.uint64(turn - bins)
        np.minimum.at(out, owner * bins + np.asarray(bin_of, dtype=np.int64), value)
        open_sets = (out.reshape(len(sets), bins) == _EMPTY).any(axis=1)
        going = open_sets[owner]
        elements, owner = elements[going], owner[going]
    return out.reshape(len(sets), bins)


def bands_for(percent: int, rows: int = ROWS) -> int:
    """Bands of which a pair of that similarity misses all with a probability of at most ``MISS``."""
    if percent >= 100:
        return 1
    return math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** rows)))


def bands(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band of ``rows`` coordinates."""
    count = sketch.shape[1] // rows
    keys = np.tile(np.arange(1, count + 1, dtype=np.uint64), (len(sketch), 1))
    for j in range(rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + sketch[:, j : count * rows : rows])
    return keys
