"""SuperMinHash signatures: correlated permutation ranks per element, with early stopping."""

from __future__ import annotations

import numpy as np
import xxhash

CHUNK = 1 << 14  # elements whose permutations are held at a time
RANK = 48  # bits below the step number in a register
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on all bits of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """Hashes of words; forgets them all when it holds too many."""

    def __init__(self, most: int = 1 << 20):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 42)
        return value


def shingle_set(text: str | None, words: Words, size: int = 2) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct shingles of ``size`` lower-cased words.

    Fewer words: the whole sequence is the only shingle; none: the set is empty. Words hold
    no blanks, so the hashes of the words in order stand for the joined shingle.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.array([words[w] for w in found], np.uint64)
    width = min(size, len(hashes))
    state = np.full(len(hashes) - width + 1, width, np.uint64)
    for k in range(width):
        state = _mix(state * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(state)])
    return np.unique(state)


def _draws(elements: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """For each element its rank within the step (a fraction of 2**48) and a number to draw a place with."""
    drawn = _mix(elements + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return drawn >> np.uint64(64 - RANK), _mix(drawn ^ np.uint64(0xD1B54A32D192ED03))


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """(sets, m) registers; an empty set keeps its registers at the highest value.

    Each element walks a random permutation of the registers (Fisher-Yates) and offers
    ``step + fraction`` to the register met at each step; registers keep the least offer.
    An element meets each register once, so the offers of a set are correlated and spread
    evenly. A set is done as soon as no register is above the next step: later offers
    cannot be lower. All elements of many sets take each step together.
    """
    out = np.full((len(sets), m), _NEVER)
    sizes = np.array([len(s) for s in sets], np.int64)
    at = 0
    while at < len(sets):
        end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), CHUNK, side="right")))
        part = out[at:end].reshape(-1)
        owner = np.repeat(np.arange(end - at), sizes[at:end])
        elements = np.concatenate(sets[at:end]) if end > at else np.zeros(0, np.uint64)
        for low in range(0, len(elements), CHUNK):  # a set beyond the chunk is walked in pieces: minima combine
            _walk(part, owner[low : low + CHUNK], elements[low : low + CHUNK], m)
        at = end
    return out


def _walk(part: np.ndarray, owner: np.ndarray, elements: np.ndarray, m: int) -> None:
    places = None
    for step in range(m):
        rank, choice = _draws(elements, step)
        chosen = step + (choice % np.uint64(m - step)).astype(np.int64)
        rows = np.arange(len(elements))
        if step == 0:
            register = chosen
        else:
            if places is None:  # only sets that did not end with the first step need their permutations
                places = np.broadcast_to(np.arange(m, dtype=np.int16), (len(elements), m)).copy()
                first = (_draws(elements, 0)[1] % np.uint64(m)).astype(np.int64)
                places[rows, first] = 0
                places[rows, 0] = first
            register = places[rows, chosen].astype(np.int64)
            places[rows, chosen] = places[rows, step]
        np.minimum.at(part, owner * m + register, rank + np.uint64(step << RANK))
        highest = part.reshape(-1, m).max(axis=1)
        going = highest[owner] >= np.uint64((step + 1) << RANK)
        if not going.any():
            return
        if not going.all():
            owner, elements = owner[going], elements[going]
            if places is not None:
                places = places[going]


def band_keys(registers: np.ndarray, rows: int = 4) -> np.ndarray:
    """(sets, m / rows) signed 64-bit keys, each packing the 16-bit hashes of ``rows`` = 4 registers."""
    digests = (_mix(registers) >> np.uint64(48)).astype("<u2")
    return np.ascontiguousarray(digests).view("<i8").reshape(len(registers), registers.shape[1] // rows)
