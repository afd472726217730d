"""Counts of a run of whole texts, as numpy columns with a row for each document."""

from __future__ import annotations

import numpy as np

from .arrow_text import _K, MUL, SPACE, Texts, mix, span_hashes, words

# fixed values: the symbols of the base rules
SYMBOLS = b"#*$%&|<>"


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_IS = {
    "symbols": _table(SYMBOLS),
    "upper": _table(bytes(range(65, 91))),
    "lower": _table(bytes(range(97, 123))),
    "digits": _table(b"0123456789"),
    "pipes": _table(b"|"),
    "stops": _table(b".,;:"),
    "marks": _table(b"!?"),
    "feeds": _table(b"\n"),
}

_LEXICAL = _IS["upper"] | _IS["lower"] | _IS["digits"] | (np.arange(256) >= 0x80)


def sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of each stretch between consecutive offsets, the sum of the flags in it."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[at])


def _dup_lines(data: bytes) -> int:
    found = [x for x in data.split(b"\n") if x.strip()]
    return len(found) - len(set(found))


def _again(keys: np.ndarray) -> np.ndarray:
    """Flags of keys that occur more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def text_stats(texts: Texts, wanted: frozenset[str] | None = None) -> dict[str, np.ndarray]:
    """Counts by document.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with
    a word that equal an earlier line), n_repeat_words (words in 3-word windows
    found twice or more in the text), n_lexical (words with a letter, digit or
    character outside ASCII), and n_distinct, n_adjacent (words equal to the one before), code_points and the counts of classes of characters.
    """
    data, at = texts.data, texts.offsets
    w = words(texts)
    n = np.diff(w.first)
    head = (data & 0xC0) != 0x80
    out = {"n_words": n, "word_chars": sums(head & ~SPACE[data], at), "code_points": sums(head, at)}
    out |= {f"n_{k}": sums(table[data], at) for k, table in _IS.items() if wanted is None or f"n_{k}" in wanted}
    out["n_wide"] = sums(data >= 0xC0, at)
    lexical = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_LEXICAL[data], out=lexical[1:])
    out["n_lexical"] = sums(lexical[w.end] > lexical[w.start], w.first)
    raw = data.tobytes()
    out["n_dup_lines"] = np.array([_dup_lines(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], np.int64)

    h = span_hashes(data, w.start, w.end, fold=False)
    doc = np.repeat(np.arange(len(n)), n)
    salt = mix(doc.astype(np.uint64) * MUL + np.uint64(7))
    covered = np.zeros(len(h) + 3, np.int64)
    if len(h) >= 3:
        key = mix(h[:-2] * _K[0] + h[1:-1] * _K[1] + h[2:] * _K[2]) + salt[:-2]
        inside = doc[:-2] == doc[2:]
        hit = np.flatnonzero(inside)[_again(key[inside])]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + 3, -1)
    out["n_repeat_words"] = sums(np.cumsum(covered)[: len(h)] > 0, w.first)
    if wanted is None or "n_distinct" in wanted:
        key = np.sort(mix(h) + salt)
        # the salt mixes documents up in the order, so count first occurrences by document
        order = np.argsort(mix(h) + salt, kind="stable")
        first = np.ones(len(h), bool)
        first[1:] = key[1:] != key[:-1]
        out["n_distinct"] = np.bincount(doc[order[first]], minlength=len(n)) if len(h) else np.zeros(len(n), np.int64)
        near = np.zeros(len(h), bool)
        if len(h) > 1:
            near[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        out["n_adjacent"] = sums(near, w.first)
    return out
