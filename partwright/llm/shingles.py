"""Word shingles of UTF-8 texts as 64-bit hashes, computed on byte arrays."""

from __future__ import annotations

import functools

import numpy as np

from partwright.llm.common import mix64, pair64

WORDS = 5
# Bytes hashed at a time; a text is cut at white space only.
STEP_BYTES = 1 << 20

_BASE = np.uint64(0x9E6C63D0876A3F35)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@functools.lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    ones = np.ones(n, np.uint64)
    up, down = ones.copy(), ones
    up[1:], down[1:] = _BASE, _INVERSE
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word: a difference of prefix sums of a polynomial, shifted to a common place."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(max(16, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def word_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased), and the text's position for each."""
    hashes, texts = [], []
    bounds = np.unique(offsets)
    at, end = 0, int(offsets[-1])
    while at < end:
        stop = min(at + STEP_BYTES, end)
        if stop < end:  # move on to the next white space or end of a text
            spaces = np.flatnonzero(_IS_SPACE[flat[stop : stop + STEP_BYTES]])
            border = int(bounds[np.searchsorted(bounds, stop)])
            while not len(spaces) and stop + STEP_BYTES < border:
                stop += STEP_BYTES
                spaces = np.flatnonzero(_IS_SPACE[flat[stop : stop + STEP_BYTES]])
            stop = min(stop + int(spaces[0]), border) if len(spaces) else border
        data = _FOLD[flat[at:stop]]
        solid = ~_IS_SPACE[data]
        inner = bounds[(bounds > at) & (bounds < stop)] - at
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        first[inner] |= solid[inner]
        last[inner - 1] |= solid[inner - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        hashes.append(_hash_words(data, starts, ends))
        texts.append(np.searchsorted(offsets, starts + at, side="right") - 1)
        at = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(texts)


def shingle_sets(flat: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted within the text, and the text's position for each.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    hashes, texts = word_hashes(flat, offsets)
    n = len(offsets) - 1
    counts = np.bincount(texts, minlength=n)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    grams, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(hashes) >= words:
        grams = hashes[: len(hashes) - words + 1]
        for k in range(1, words):
            grams = pair64(grams, hashes[k : len(hashes) - words + 1 + k])
        whole = texts[: len(grams)] == texts[words - 1 :]
        grams, owner = grams[whole], texts[: len(whole)][whole]
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        one = hashes[first[short]]
        for k in range(1, words - 1):
            more = counts[short] > k
            one[more] = pair64(one[more], hashes[first[short][more] + k])
        grams = np.concatenate([grams, mix64(one ^ np.uint64(0xA5A5A5A5A5A5A5A5))])
        owner = np.concatenate([owner, short])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[fresh], owner[fresh]
