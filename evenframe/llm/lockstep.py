"""Folds of many words at a time: those of about one length move on together."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

#: Words that move on together, at most.
WIDTH = 8192
#: An empty place of a lookup table; no key is as small.
EMPTY = np.iinfo(np.int64).min
#: What fills short words up; greater than every character.
FILL = 0x110000

#: Places of some words in a list, how many ids each has, and their ids one after another.
Folded = tuple[np.ndarray, np.ndarray, np.ndarray]
#: Places of some words in a list, their lengths, and their characters, a row each.
Group = tuple[np.ndarray, np.ndarray, np.ndarray]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``starts[0], starts[0] + 1, ...`` of every run of ``sizes``, run after run."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << 32 | b


class Lookup:
    """Numbers under pairs of numbers, in a table of open addresses."""

    def __init__(self, found: dict[tuple[int, int], int]):
        pairs = np.array(list(found), np.int64).reshape(-1, 2)
        self.shift = np.uint64(64 - max(4, (4 * len(pairs)).bit_length()))
        self.keys = np.full(1 << 64 - int(self.shift), EMPTY)
        self.values = np.full(len(self.keys), -1, np.int32)
        keys, values = _key(*pairs.T), np.fromiter(found.values(), np.int32, len(found))
        place = self._place(keys)
        while len(keys):
            free = self.keys[place] == EMPTY
            self.keys[place[free]] = keys[free]
            own = self.keys[place] == keys
            self.values[place[own]] = values[own]
            keys, values, place = keys[~own], values[~own], self._next(place[~own])

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def _next(self, place: np.ndarray) -> np.ndarray:
        return place + 1 & len(self.keys) - 1

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The numbers under ``a, b``, or -1; a negative ``a`` or ``b`` has none."""
        shape, keys = a.shape, _key(a, b).reshape(-1)
        place = self._place(keys)
        there = self.keys[place]
        out = np.where(there == keys, self.values[place], -1)
        left = np.flatnonzero((there != keys) & (there != EMPTY))
        place = place[left]
        while len(left):
            place = self._next(place)
            there = self.keys[place]
            hit = there == keys[left]
            out[left[hit]] = self.values[place[hit]]
            on = ~hit & (there != EMPTY)
            left, place = left[on], place[on]
        return out.reshape(shape)


class Lockstep:
    """The pieces as a tree of characters, and which neighbours make a piece.

    A part of a word is a node of the tree, or ``-1 - c`` for a character ``c``
    that no piece has.
    """

    def __init__(self, pieces: dict[str, tuple[int, float]], unknown: float, spell: Callable[[str], list[int]]):
        self.unknown, self.spell = unknown, spell
        self.longest = max(map(len, pieces), default=1)
        node: dict[str, int] = {"": 0}
        steps: dict[tuple[int, int], int] = {}
        for piece in [*sorted({c for p in pieces for c in p}), *pieces]:
            for end in range(1, len(piece) + 1):
                if piece[:end] not in node:
                    node[piece[:end]] = len(node)
                    steps[node[piece[: end - 1]], ord(piece[end - 1])] = node[piece[:end]]
        self.steps = Lookup(steps)
        # the last entry stands for the number -1, which no node has
        self.ids, self.scores = np.full(len(node) + 1, -1, np.int64), np.full(len(node) + 1, -np.inf)
        self.first = np.array([ord(s[0]) if s else 0 for s in node] + [0])
        for piece, (i, score) in pieces.items():
            self.ids[node[piece]], self.scores[node[piece]] = i, score
        parts = {s: n for s, n in node.items() if len(s) == 1 or s in pieces}
        self.joins = Lookup({
            (parts[p[:cut]], parts[p[cut:]]): node[p]
            for p in pieces for cut in range(1, len(p)) if p[:cut] in parts and p[cut:] in parts
        })

    @staticmethod
    def groups(words: list[str], longest: int) -> list[Group]:
        """Words of about one length, ``longest`` at most, together."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts, flat = np.cumsum(lengths) - lengths, np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        most = np.where(lengths <= 8, lengths, np.where(lengths <= 16, lengths + lengths % 2, -(-lengths // 8) * 8))
        order, out = np.argsort(most, kind="stable"), []
        for size in np.unique(most[lengths <= longest]).tolist():
            found = order[slice(*np.searchsorted(most[order], [size, size + 1]))]
            found = found[lengths[found] <= longest]
            for start in range(0, len(found), WIDTH):
                places = found[start : start + WIDTH]
                characters = np.full((len(places), size), FILL)
                used = np.arange(size) < lengths[places, None]
                characters[used] = flat[ragged(starts[places], lengths[places])]
                out.append((places, lengths[places], characters))
        return out

    def _folded(self, places: np.ndarray, parts: np.ndarray, used: np.ndarray) -> Folded:
        """The ids of the used parts, a row of them for each word."""
        sizes, parts = used.sum(axis=1), parts[used]
        ids = np.where(parts < 0, -1, self.ids[parts])
        other = np.flatnonzero(ids < 0)
        if len(other):
            codes, kind = np.unique(np.where(parts < 0, -1 - parts, self.first[parts])[other], return_inverse=True)
            spelled = [self.spell(chr(c)) for c in codes.tolist()]
            n = np.array([len(s) for s in spelled])
            repeats = np.ones(len(ids), np.int64)
            repeats[other] = n[kind]
            sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes), repeats, len(sizes)).astype(np.int64)
            starts, ids = np.cumsum(repeats) - repeats, np.repeat(ids, repeats)
            ids[ragged(starts[other], n[kind])] = np.concatenate(spelled)[ragged((np.cumsum(n) - n)[kind], n[kind])]
        return places, sizes, ids.astype("<u4")

    def best(self, groups: list[Group]) -> Iterator[Folded]:
        """Viterbi: the ids of greatest total score, of equals those with the longest last piece."""
        for places, lengths, characters in groups:
            n, most = characters.shape
            # a state is a place in a word, places before words; edges lead from one to a later one
            flat = np.ascontiguousarray(characters.T).reshape(-1)
            edges, at, node = [], np.arange(n * most), np.zeros(n * most, np.int32)
            for k in range(min(self.longest, most)):
                inside = at < (most - k) * n
                at, node = at[inside], node[inside]
                node = self.steps.find(node, flat[at + k * n])
                piece = self.scores[node] > -np.inf
                if k == 0:
                    single = np.where(piece, node, -1 - flat)
                    edges.append((at, at + n, single, np.where(piece, self.scores[node], self.unknown)))
                else:
                    edges.append((at[piece], at[piece] + (k + 1) * n, node[piece], self.scores[node[piece]]))
                at, node = at[node >= 0], node[node >= 0]
            begin, end, part, score = map(np.concatenate, zip(*edges, strict=True))
            order = np.argsort((begin // n).astype(np.int16), kind="stable")
            begin, end, part, score = begin[order], end[order], part[order], score[order]
            first = np.searchsorted(begin // n, np.arange(most + 1))
            total, via = np.full(n * (most + 1), -np.inf), np.zeros(n * (most + 1), np.int64)
            total[:n] = 0
            for start, stop in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                reach, before = total[begin[start:stop]] + score[start:stop], total[end[start:stop]]
                # a character that is no piece comes before a piece of the same total
                better = np.flatnonzero((reach > before) | (part[start:stop] < 0) & (reach == before))
                total[end[start:stop][better]] = reach[better]
                via[end[start:stop][better]] = start + better
            path, used = np.zeros((n, most), np.int64), np.zeros((n, most), bool)
            rows, state, column = np.arange(n), lengths * n + np.arange(n), most
            while len(rows):
                column -= 1
                edge = via[state]
                path[rows, column], used[rows, column] = part[edge], True
                on = begin[edge] >= n
                rows, state = rows[on], begin[edge][on]
            yield self._folded(places, path, used)

    def merged(self, groups: list[Group]) -> Iterator[Folded]:
        """Merges the neighbours of greatest score, the leftmost of equals, until none is a piece."""
        for places, _, characters in groups:
            node = self.steps.find(np.zeros_like(characters), characters)
            parts = np.where(node < 0, -1 - characters, node)
            joins = self.joins.find(parts[:, :-1], parts[:, 1:])
            while joins.shape[1]:
                score = self.scores[joins]
                at = score.argmax(axis=1)
                on = score[np.arange(len(at)), at] > -np.inf
                if not on.all():
                    yield self._folded(places[~on], parts[~on], parts[~on] != -1 - FILL)
                    places, parts, joins, at = places[on], parts[on], joins[on], at[on]
                # each word that goes on has one part less
                each, width = np.arange(len(at)), joins.shape[1]
                columns, new = np.arange(width), joins[each, at]
                parts = np.take_along_axis(parts, columns + (columns > at[:, None]), axis=1)
                parts[each, at] = new
                joins = np.take_along_axis(joins, (columns + (columns >= at[:, None]))[:, :-1], axis=1)
                left, right = np.flatnonzero(at > 0), np.flatnonzero(at < width - 1)
                joins[left, at[left] - 1] = self.joins.find(parts[left, at[left] - 1], new[left])
                joins[right, at[right]] = self.joins.find(new[right], parts[right, at[right] + 1])
            yield self._folded(places, parts, parts != -1 - FILL)
