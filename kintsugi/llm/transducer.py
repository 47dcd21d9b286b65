"""Minimal acyclic transducer: sorted byte strings with sequences of ids.

Strings share their prefixes and, once an end is complete, equal ends share one
state (same finality, same arcs, same outputs).  Each arc carries the ids that
are certain once it is taken, so shared ends need not know their beginnings.
The finished automaton is a flat block of integers that can be memory-mapped;
numpy walks many strings through it at once.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np


class _State:
    __slots__ = ("arcs", "end")

    def __init__(self):
        self.arcs: dict[int, list] = {}  # byte -> [target, ids]
        self.end: tuple[int, ...] | None = None  # ids due when a string ends here


def _common(a: tuple, b: tuple) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def compile_transducer(entries: dict[bytes, tuple[int, ...]]) -> bytes:
    """The transducer of ``entries`` as one block of bytes (see :class:`Transducer`)."""
    kept: dict[tuple, int] = {}
    done: list[tuple] = []

    def settle(state: _State) -> int:
        key = (state.end, tuple((byte, arc[0], arc[1]) for byte, arc in state.arcs.items()))
        if key not in kept:
            kept[key] = len(done)
            done.append(key)
        return kept[key]

    path, before = [_State()], b""

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            state = path.pop()
            path[-1].arcs[before[len(path) - 1]][0] = settle(state)

    for word in sorted(entries):
        ids, shared = tuple(entries[word]), _common(before, word)
        close(shared)
        for k in range(shared):
            arc = path[k].arcs[word[k]]
            n = _common(arc[1], ids)
            late, arc[1], ids = arc[1][n:], arc[1][:n], ids[n:]
            if late:  # what the other strings still owe moves one state on
                for other in path[k + 1].arcs.values():
                    other[1] = late + other[1]
                if path[k + 1].end is not None:
                    path[k + 1].end = late + path[k + 1].end
        for k in range(shared, len(word)):
            path[-1].arcs[word[k]] = [-1, ids if k == shared else ()]
            path.append(_State())
        path[-1].end = () if len(word) > shared else ids
        before = word
    close(0)
    root = settle(path[0])

    pool: dict[tuple, int] = {(): 0}
    arcs, ends = [], np.full(len(done), -1, np.int64)
    for state, (end, out) in enumerate(done):
        if end is not None:
            ends[state] = pool.setdefault(end, len(pool))
        arcs += [(state << 8 | byte, target, pool.setdefault(ids, len(pool))) for byte, target, ids in out]
    table = np.array(arcs, np.int64).reshape(-1, 3)
    begins = np.cumsum([0] + [len(p) for p in pool])
    ids = np.array([i for p in pool for i in p], np.int64)
    head = np.array([root, len(table), len(done), len(pool), len(ids)], np.int64)
    return np.concatenate((head, table.T.ravel(), ends, begins, ids)).tobytes()


class Transducer:
    """A compiled block, mapped from a file that is unlinked at once so that
    nothing stays behind in the task's folder."""

    def __init__(self, block: bytes):
        fd, name = tempfile.mkstemp(suffix=".fst")
        try:
            with os.fdopen(fd, "wb") as f:
                f.write(block)
            flat = np.memmap(name, np.int64, "r")
        finally:
            os.unlink(name)
        self.root, n_arcs, n_states, n_pool, n_ids = (int(x) for x in flat[:5])
        at = np.cumsum([5, n_arcs, n_arcs, n_arcs, n_states, n_pool + 1, n_ids])
        self.keys, self.targets, self.outs, self.ends, self.begins, self.ids = (
            np.asarray(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True))
        self.n_states = n_states

    def lookup(self, words: list[bytes]) -> list[np.ndarray | None]:
        """The ids of each word; None for a word that is not in the lexicon."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-length, kind="stable")
        size = length[order]
        data = np.frombuffer(b"".join(words[i] for i in order), np.uint8)
        begin = np.cumsum(size) - size
        state = np.full(len(words), self.root, np.int64)
        who, out = [], []
        for t in range(int(size[0]) if len(size) else 0):
            alive = np.flatnonzero((state >= 0) & (size > t))
            if not len(alive) or not len(self.keys):
                state[size > t] = -1
                break
            key = state[alive] << 8 | data[begin[alive] + t]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            state[alive] = np.where(hit, self.targets[arc], -1)
            who.append(alive[hit])
            out.append(self.outs[arc[hit]])
        end = np.where(state >= 0, self.ends[np.maximum(state, 0)], -1)
        found = end >= 0
        who.append(np.flatnonzero(found))
        out.append(end[found])
        result: list[np.ndarray | None] = [None] * len(words)
        owner, part = np.concatenate(who), np.concatenate(out)
        good = found[owner] & (self.begins[part + 1] > self.begins[part])
        owner, part = owner[good], part[good]
        by_word = np.argsort(owner, kind="stable")
        owner, part = owner[by_word], part[by_word]
        count = self.begins[part + 1] - self.begins[part]
        spot = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.begins[part], count)
        flat = np.asarray(self.ids[spot], np.int32)
        total = np.zeros(len(words), np.int64)
        np.add.at(total, owner, count)
        stop = np.cumsum(total)
        for k in np.flatnonzero(found).tolist():
            result[order[k]] = flat[stop[k] - total[k]:stop[k]]
        return result
