"""A minimal acyclic transducer: words in, id sequences out, in flat arrays that can be memory-mapped."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from tidemark.llm.arrays import Places

_PARTS = ("keys", "targets", "skips", "final", "at", "ids", "table")


class Lexicon:
    """Arcs by (state, byte). The numbers on a word's arcs add up to its rank among all words."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.keys, self.targets, self.skips, self.final, self.at, self.ids, table = (parts[n] for n in _PARTS)
        self.root, self.places = len(self.final) - 1, Places(table)

    @classmethod
    def build(cls, entries: dict[bytes, Sequence[int]]) -> Lexicon:
        """Compile words in sorted order, merging each finished state with an equal one."""
        known: dict[tuple, int] = {}
        states: list[tuple[bool, tuple]] = []

        def freeze(node: list) -> int:
            signature = (node[0], tuple(node[1]))
            if signature not in known:
                known[signature] = len(states)
                states.append(signature)
            return known[signature]

        words = sorted(entries)
        path: list[list] = [[False, []]]
        last = b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                node = path.pop()
                path[-1][1].append((last[len(path) - 1], freeze(node)))

        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            close(same)
            path += [[False, []] for _ in word[same:]]
            path[-1][0] = True
            last = word
        close(0)
        # The root comes last; nothing points at it, so no other state is equal to it.
        states.append((path[0][0], tuple(path[0][1])))
        reach, keys, targets, skips = [], [], [], []
        for number, (final, arcs) in enumerate(states):
            passed = int(final)
            for byte, target in arcs:
                keys.append(number * 256 + byte)
                targets.append(target)
                skips.append(passed)
                passed += reach[target]
            reach.append(passed)
        sizes = [len(entries[w]) for w in words]
        parts = {
            "keys": keys,
            "targets": targets,
            "skips": skips,
            "final": [f for f, _ in states],
            "at": np.concatenate([[0], np.cumsum(sizes)]),
            "ids": [i for w in words for i in entries[w]],
        }
        arrays = {n: np.array(part).astype(np.int64) for n, part in parts.items()}
        return cls(arrays | {"table": Places.build(arrays["keys"]).table})

    def save(self, path: str) -> None:
        parts = [self.keys, self.targets, self.skips, self.final, self.at, self.ids, self.places.table]
        head = np.array([len(p) for p in parts], np.int64)
        np.concatenate([head, *parts]).astype(np.int64).tofile(path)

    @classmethod
    def open(cls, path: str) -> Lexicon:
        """The arrays as they lie in the file; pages are read when an arc on them is followed."""
        raw = np.memmap(path, np.int64, "r")
        stops = len(_PARTS) + np.cumsum(raw[: len(_PARTS)])
        return cls({n: raw[b - size : b] for n, b, size in zip(_PARTS, stops, raw, strict=False)})

    def numbers(self, starts: np.ndarray, lengths: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The rank of each word data[start:start + length], or -1; all words advance byte by byte together."""
        out = np.full(len(starts), -1, np.int64)
        live = np.arange(len(starts))
        state, total, step = np.full(len(starts), self.root), np.zeros(len(starts), np.int64), 0
        while len(live):
            done = lengths[live] == step
            ended = done & (self.final[state] == 1)
            out[live[ended]] = total[ended]
            live, state, total = live[~done], state[~done], total[~done]
            found = self.places.of(state * 256 + data[starts[live] + step], self.keys)
            hit = found >= 0
            live, found = live[hit], found[hit]
            state, total = self.targets[found], total[hit] + self.skips[found]
            step += 1
        return out
