"""Hashed word n-grams and skip-grams of texts, as numpy arrays."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

_WORD = re.compile(r"\w+")
_KNOWN_WORDS = 200_000
_BLOCK_WORDS = 1 << 18


class _Known(dict):
    """Hashes of words, of the first many kept."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < _KNOWN_WORDS:
            self[word] = value
        return value


_known = _Known()

# Odd multipliers that tell the gram kinds apart.
_FIRST = np.uint64(0x9E3779B97F4A7C15)
_NEXT = np.uint64(0xC2B2AE3D27D4EB4F)
_SKIP = np.uint64(0x165667B19E3779F9)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def _pieces(text: str, size: int = 1 << 20) -> Iterator[str]:
    """A long text in parts of about ``size`` characters, cut where no word is."""
    at = 0
    while len(text) - at > size:
        end = at + size
        while end < len(text) and (text[end].isalnum() or text[end] == "_"):
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def word_blocks(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row number, word hash) arrays in bounded blocks; a null text has no words.

    Within a text that spans blocks the last two words are repeated, so that no
    gram across the cut is lost.
    """
    rows: list[int] = []
    values: list[int] = []
    for row, text in enumerate(texts):
        # The last two words of this text's blocks; it may have none so far.
        tail: list[int] = []
        for piece in _pieces((text or "").lower()):
            found = list(map(_known.__getitem__, _WORD.findall(piece)))
            if found and tail:
                found, tail = tail + found, []
            values += found
            rows += [row] * len(found)
            if len(values) >= _BLOCK_WORDS:
                yield np.array(rows, np.int64), np.array(values, np.uint64)
                tail = [v for r, v in zip(rows[-2:], values[-2:]) if r == row]
                rows, values = [], []
    if values:
        yield np.array(rows, np.int64), np.array(values, np.uint64)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, each value once."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _slot(values: np.ndarray, bits: int) -> np.ndarray:
    mixed = (values ^ (values >> np.uint64(33))) * _MIX
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def gram_blocks(
    texts: Iterable[str | None], bits: int, skips: bool = True
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row number, slot) of every word, word pair and pair around one word."""
    for rows, words in word_blocks(texts):
        out_rows, out = [rows], [words]
        if len(words) > 1:
            same = rows[1:] == rows[:-1]
            out_rows.append(rows[1:][same])
            out.append((words[:-1] * _FIRST ^ words[1:] * _NEXT)[same])
        if skips and len(words) > 2:
            same = rows[2:] == rows[:-2]
            out_rows.append(rows[2:][same])
            out.append((words[:-2] * _FIRST ^ words[2:] * _SKIP)[same])
        yield np.concatenate(out_rows), _slot(np.concatenate(out), bits)


def gram_sets(texts: Iterable[str | None], bits: int, skips: bool = True) -> list[np.ndarray]:
    """The distinct slots of each text."""
    texts = list(texts)
    pairs = [
        distinct(rows << np.int64(bits) | slots) for rows, slots in gram_blocks(texts, bits, skips)
    ]
    every = distinct(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
    edges = np.searchsorted(every, np.arange(len(texts) + 1, dtype=np.int64) << bits)
    slots = (every & ((1 << bits) - 1)).astype(np.int32)
    return [slots[a:b] for a, b in zip(edges, edges[1:])]


def weighted_sums(texts, weights: np.ndarray, bits: int, skips: bool = True) -> np.ndarray:
    """For each text, the sum of the weights of its distinct slots."""
    texts = list(texts)
    hits = []
    for rows, slots in gram_blocks(texts, bits, skips):
        active = weights[slots] != 0
        hits.append(distinct(rows[active] << np.int64(bits) | slots[active]))
    if not hits:
        return np.zeros(len(texts))
    every = distinct(np.concatenate(hits))
    return np.bincount(
        every >> bits, weights=weights[every & ((1 << bits) - 1)], minlength=len(texts)
    )
