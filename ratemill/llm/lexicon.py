"""A minimal acyclic transducer: words to numbers, kept as flat arrays in one file.

Words are added in sorted order; states with equal futures are shared, so common
endings exist once. Every arc carries how many words sort before its branch, and the
sum along a word's path is the word's number among all words. The number leads to
the word's token ids. The file is mapped into memory, so workers on a machine share
its pages.
"""

from __future__ import annotations

import numpy as np

MAGIC = np.int64(0x4C455849434F4E31)


class _Builder:
    """Incremental construction over sorted words."""

    def __init__(self) -> None:
        self.arcs: list[dict[int, int]] = [{}]
        self.final = [False]
        self.known: dict[tuple, int] = {}
        self.open: list[tuple[int, int, int]] = []  # parent, byte, child on the last word's path
        self.last = b""

    def _close(self, depth: int) -> None:
        while len(self.open) > depth:
            parent, byte, child = self.open.pop()
            same = self.known.setdefault(
                (self.final[child], tuple(self.arcs[child].items())), child
            )
            self.arcs[parent][byte] = same

    def add(self, word: bytes) -> None:
        shared = 0
        for a, b in zip(word, self.last):
            if a != b:
                break
            shared += 1
        self._close(shared)
        state = self.open[-1][2] if self.open else 0
        for byte in word[shared:]:
            self.arcs.append({})
            self.final.append(False)
            child = len(self.arcs) - 1
            self.arcs[state][byte] = child
            self.open.append((state, byte, child))
            state = child
        self.final[state] = True
        self.last = word


def compile_lexicon(entries: dict[bytes, tuple[int, ...]]) -> bytes:
    """The file of a lexicon: words with their token ids."""
    builder, words = _Builder(), sorted(entries)
    for word in words:
        builder.add(word)
    builder._close(0)
    # Only states that are reachable are written, children before parents.
    order, number, stack = [], {}, [(0, False)]
    while stack:
        state, ready = stack.pop()
        if ready:
            number[state] = len(order)
            order.append(state)
        elif state not in number:
            number[state] = -1
            stack.append((state, True))
            stack.extend((c, False) for c in builder.arcs[state].values() if c not in number)
    paths = {}
    keys, targets, before = [], [], []
    for state in order:
        n = int(builder.final[state])
        for byte, child in sorted(builder.arcs[state].items()):
            keys.append(number[state] << 8 | byte)
            targets.append(number[child])
            before.append(n)
            n += paths[child]
        paths[state] = n
    at = np.argsort(np.array(keys, np.int64), kind="stable")
    ids = [entries[w] for w in words]
    parts = [
        np.array(keys, np.int64)[at],
        np.array(targets, np.int64)[at],
        np.array(before, np.int64)[at],
        np.array([builder.final[s] for s in order], np.int64),
        np.cumsum([0, *map(len, ids)], dtype=np.int64),
        np.array([i for x in ids for i in x], np.int64),
    ]
    head = np.array([MAGIC, number[0], *(len(p) for p in parts)], np.int64)
    return b"".join(p.tobytes() for p in (head, *parts))


class Lexicon:
    """A compiled lexicon, mapped from its file."""

    def __init__(self, path: str) -> None:
        data = np.asarray(np.memmap(path, np.int64, "r"))  # a plain view of the mapped pages
        if data[0] != MAGIC:
            raise ValueError(f"{path} is not a lexicon")
        self.root, ends = int(data[1]), 8 + np.cumsum(data[2:8])
        parts = [data[e - n : e] for e, n in zip(ends, data[2:8])]
        self.keys, self.targets, self.before, self.final, self.offsets, self.ids = parts

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for words not in the lexicon. All step together."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        state = np.full(len(words), self.root, np.int64)
        total = np.zeros(len(words), np.int64)
        alive, step = np.flatnonzero(lengths > 0) if len(self.keys) else np.zeros(0, np.int64), 0
        ended = np.zeros(len(words), bool)
        while len(alive):
            wanted = state[alive] << 8 | text[starts[alive] + step]
            arc = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            there = self.keys[arc] == wanted
            alive, arc = alive[there], arc[there]
            state[alive] = self.targets[arc]
            total[alive] += self.before[arc]
            step += 1
            done = lengths[alive] == step
            ended[alive[done]] = self.final[state[alive[done]]] == 1
            alive = alive[~done]
        return np.where(ended, total, -1)

    def ids_of(self, number: int) -> list[int]:
        return self.ids[self.offsets[number] : self.offsets[number + 1]].tolist()
