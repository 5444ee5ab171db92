"""Ids of the byte-level tokenizer at numpy speed: texts are cut as the tokenizer cuts them, each distinct piece is encoded once.

The tokenizer first cuts a text into pieces by ``PATTERN`` and encodes each piece by itself. Here numpy finds the pieces of a whole
chunk of texts, and the library is asked only for pieces a worker hasn't met lately. Texts with characters outside ``ranges``, whose
classes are certain, go to the library whole. The result is the library's, which the tests check.
"""

from __future__ import annotations

import numpy as np
import regex
from tokenizers import Tokenizer

from .common import distinct_spans

#: The tokenizer's own rule for pieces (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACE, _LETTER, _NUMBER, _OTHER, _UNSURE = range(5)


def _classes() -> np.ndarray:
    out = np.full(0x2100, _UNSURE, dtype=np.uint8)
    for low, high in ((0x09, 0x0B), (0x0D, 0x0E), (0x20, 0x7F), (0xA0, 0x250), (0x2010, 0x2028), (0x2030, 0x205F)):
        for c in range(low, high):
            one = chr(c)
            out[c] = _SPACE if one.isspace() else _LETTER if regex.match(r"\p{L}", one) else _NUMBER if regex.match(r"\p{N}", one) else _OTHER
    return out


def piece_starts(points: np.ndarray, kind: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the pieces start in the code points of texts that begin at ``begins``."""
    n = len(points)
    first = np.zeros(n + 3, dtype=bool)
    first[begins[begins < n]] = True
    start = first[:n].copy()
    changed = kind[1:] != kind[:-1]
    start[1:] |= changed & ((kind[1:] == _SPACE) | (points[:-1] != 0x20))
    # The last of white space before anything else starts a piece.
    start[:-1] |= changed & (kind[:-1] == _SPACE) & ~first[1:n]
    marks = np.flatnonzero((points == 0x27) & start)
    if len(marks):
        padded = np.concatenate([points, np.zeros(3, dtype=points.dtype)])
        one, two = padded[marks + 1], padded[marks + 2]
        one = np.where(first[marks + 1], 0, one)
        two = np.where(first[marks + 2], 0, two)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for found, size in ((marks[short], 2), (marks[long], 3)):
            start[found + 1] = False
            after = found + size
            start[after[after < n]] = True
    return np.flatnonzero(start)


class Encoder:
    """Encodes chunks of texts; keeps the ids of at most ``remembered`` pieces."""

    def __init__(self, path: str, remembered: int = 800_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kinds = _classes()
        self.remembered = remembered
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.spaced[[i for t, i in vocabulary.items() if t[0] == "Ġ"]] = True
        self.feed = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.pool = np.zeros(1 << 20, dtype=np.uint32)
        self.used = 0
        self.at = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _remember(self, hashes: list[int], at: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """Pieces whose ids lie in ``ids`` at ``at``."""
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(ids)), dtype=np.uint32)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.known.update(zip(hashes, range(len(self.at), len(self.at) + len(hashes))))
        self.at = np.concatenate([self.at, at + self.used])
        self.size = np.concatenate([self.size, size])
        self.used += len(ids)

    def _learn(self, text: str, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, kind: np.ndarray, points: np.ndarray) -> None:
        """Encodes new pieces; those that can stand side by side without changing go to the library as one text."""
        first = kind[starts]
        leading = (points[starts] == 0x20) & (ends - starts > 1) & (kind[np.minimum(starts + 1, len(kind) - 1)] != _SPACE)
        for chosen, glue in ((leading, ""), (first != _SPACE, "\n")):
            some = np.flatnonzero(chosen)
            if not len(some):
                continue
            ids = self._whole([glue.join([text[i:j] for i, j in zip(starts[some].tolist(), ends[some].tolist())])])[0]
            if glue:
                cuts = np.flatnonzero(ids == self.feed)
                at, stop = np.concatenate(([0], cuts + 1)), np.append(cuts, len(ids))
            else:
                at = np.flatnonzero(self.spaced[ids])
                stop = np.append(at[1:], len(ids))
            self._remember(hashes[some].tolist(), at, stop - at, ids)
        alone = np.flatnonzero(~leading & (first == _SPACE))
        for k, ids in zip(alone, self._whole([text[starts[k] : ends[k]] for k in alone])):
            self._remember([int(hashes[k])], np.zeros(1, dtype=np.int64), np.array([len(ids)]), ids)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        points = [np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32) for t in texts]
        every = np.concatenate([*points, np.zeros(0, dtype=np.uint32)])
        if all(texts) and len(every) and int(every.max()) < len(self.kinds) and not (self.kinds[every] == _UNSURE).any():
            return self._fast("".join(texts), points)
        sure = [len(p) > 0 and int(p.max()) < len(self.kinds) and not (self.kinds[p] == _UNSURE).any() for p in points]
        out: list = [np.zeros(0, dtype=np.uint32)] * len(texts)
        rest = [k for k, (s, t) in enumerate(zip(sure, texts)) if t and not s]
        for k, ids in zip(rest, self._whole([texts[k] for k in rest])):
            out[k] = ids
        chosen = [k for k, s in enumerate(sure) if s]
        if chosen:
            for k, ids in zip(chosen, self._fast("".join(texts[k] for k in chosen), [points[k] for k in chosen])):
                out[k] = ids
        return out

    def _fast(self, text: str, parts: list[np.ndarray]) -> list[np.ndarray]:
        points = np.concatenate(parts)
        begins = np.cumsum([0, *(len(p) for p in parts)])
        kind = self.kinds[points]
        starts = piece_starts(points, kind, begins)
        ends = np.append(starts[1:], len(points))
        first, piece, hashes = distinct_spans(points, starts, ends, with_hashes=True)
        keys = hashes.tolist()
        if len(self.known) > self.remembered:
            self._forget()
        new = np.array([k for k, h in enumerate(keys) if h not in self.known], dtype=np.int64)
        self._learn(text, starts[first[new]], ends[first[new]], hashes[new], kind, points)
        slots = np.array([self.known[h] for h in keys])[piece]
        at, size = self.at[slots], self.size[slots]
        total = np.cumsum(size)
        ids = self.pool[np.repeat(at - (total - size), size) + np.arange(total[-1])]
        bounds = total[np.searchsorted(starts, begins[1:-1]) - 1]
        return np.split(ids, bounds)
