"""Suffix order by induced sorting with queues on disk.

The order of the suffixes of a byte string is induced from that of the leftmost small-type ones (a
suffix is of small type if it sorts before the next one, of large type if after; leftmost small-type
if it is small and the one before it is large). Those are named by their substrings; if names repeat, the
string of names is sorted first, which is a third as long or shorter. Then one ascending pass induces
the large suffixes and one descending pass the small ones: whoever comes off the front of the order
puts its predecessor, by its first byte, at the end of that byte's queue.

The queues are the buckets of a radix priority queue: priority is the first byte, and within a byte
the order of arrival is the order of suffixes. An entry is a tuple of position and common prefix with the
entry before it. Queues hold `HELD` tuples in memory and the rest in files. The passes stream, but not all does:
the text's types and the names take some 8-byte arrays of its length, a symbol's whole queue is loaded to be turned,
`order` gives the whole order and its common prefixes as arrays, and names that repeat are sorted by
prefix doubling in memory instead of by recursion. More than `INNER` names are an error.

The common prefix of two neighbours in a
queue is one more than the least one met between the two suffixes that put them there, so it is carried
along and never recomputed, but for the first entry of a bucket's halves. Common prefixes are cut off at
`most`, and suffixes that agree in `most` symbols may come in any order.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

#: Tuples of a queue that stay in memory; those read back at once.
HELD = 1 << 19
#: A string of names up to this length is sorted in memory, by doubling.
INNER = 1 << 25

FAR = np.iinfo(np.int32).max


class DiskQueue:
    """Arrays in order of arrival, on disk beyond `HELD` entries."""

    def __init__(self, folder: str, name: str):
        self.path, self.parts, self.size, self.stored = os.path.join(folder, name), [], 0, 0

    def put(self, places: np.ndarray, common: np.ndarray) -> None:
        self.parts.append((places, common))
        self.size += len(places)
        if self.size - self.stored > HELD:
            with open(self.path, "ab") as out:
                for part in self.parts:
                    out.write(np.stack(part, axis=1).astype(np.int64).tobytes())
            self.stored, self.parts = self.size, []

    def take(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All entries so far, oldest first, in blocks. What is put meanwhile is not seen."""
        parts, stored = self.parts, self.stored
        self.parts, self.stored, self.size = [], 0, 0
        if stored:
            os.rename(self.path, self.path + ".read")
            with open(self.path + ".read", "rb") as data:
                while block := data.read(HELD * 16):
                    rows = np.frombuffer(block, np.int64).reshape(-1, 2)
                    yield rows[:, 0], rows[:, 1]
            os.remove(self.path + ".read")
        if len(parts) > 1:
            yield np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
        elif parts and len(parts[0][0]):
            yield parts[0]


def types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is of small type; the last symbol is smaller than all others."""
    n = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])
    # The end of the run of equal symbols that a position is in decides.
    end = differs[np.minimum(np.searchsorted(differs, np.arange(n)), len(differs) - 1)] if len(differs) else np.zeros(n, int)
    small = text[end] < text[np.minimum(end + 1, n - 1)]
    small[-1] = True
    return small


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Equal symbols from `a` and `b` on, at most `most`."""
    n, out = len(text), np.zeros(len(a), np.int64)
    at = np.arange(len(a))
    for k in range(most):
        x, y = a[at] + k, b[at] + k
        same = (x < n) & (y < n)
        same[same] = text[x[same]] == text[y[same]]
        at = at[same]
        if not len(at):
            break
        out[at] = k + 1
    return out


def by_doubling(names: np.ndarray, enough: int) -> np.ndarray:
    """The suffix order of a string of names, in memory, by its first `enough` names at least."""
    rank = names.astype(np.int64)  # dense: 0, 1, 2, ...
    n, width = len(names), 1
    while True:
        pair = rank * (n + 1)
        pair[: max(0, n - width)] += rank[width:] + 1
        order = np.argsort(pair)
        pair = pair[order]
        new = np.ones(n, np.int64)
        new[1:] = pair[1:] != pair[:-1]
        rank[order] = np.cumsum(new) - 1
        width *= 2
        if new.all() or width >= enough:
            return order


class InducedSorter:
    """Suffix order of `text` (symbols below 2**16; its last one is smaller than all others)."""

    def __init__(self, text: np.ndarray, folder: str, most: int):
        self.text, self.folder, self.most = text, folder, most
        self.small = types(text)
        before = np.concatenate([[False], self.small[:-1]])
        leftmost = self.small & ~before
        leftmost[0] = False
        self.seeds = np.flatnonzero(leftmost)
        self.symbols = np.unique(text)
        self.number = 0

    def _queues(self, kind: str) -> dict[int, DiskQueue]:
        self.number += 1
        return {int(s): DiskQueue(self.folder, f"{kind}{self.number}-{s}") for s in self.symbols}

    def _pass(self, seeds: dict[int, DiskQueue], large: bool, carry: bool, out) -> None:
        """Induces one type from the suffixes in `seeds`, per symbol in scan order, handing on blocks
        (symbol, own, places, common) in scan order; `own` tells induced ones from seeds."""
        text, most = self.text, self.most
        queues = self._queues("large" if large else "small")
        least = np.full(int(self.symbols[-1]) + 1, FAR, np.int64)  # common prefix met since a symbol's queue last grew
        last: int | None = None
        for symbol in self.symbols.tolist() if large else self.symbols[::-1].tolist():
            queue = queues[symbol]
            for own in (True, False):
                rounds = True
                first_of_half = True
                while rounds:
                    rounds = False
                    for places, common in (queue if own else seeds[symbol]).take():
                        rounds = own  # equal symbols in a row put entries into the queue being read
                        if carry and first_of_half:
                            common = common.copy()
                            # Another first symbol before it, or the other half of this symbol.
                            common[0] = 0 if last is None else common_prefix(text, np.array([last]), places[:1], most)[0]
                            first_of_half = False
                        last = int(places[-1])
                        out(symbol, own, places, common)
                        self._induce(places, common, queues, least if carry else None, large)

    def _induce(self, places, common, queues, least, large) -> None:
        text, small = self.text, self.small
        source = places - 1
        wanted = source >= 0
        wanted[wanted] = small[source[wanted]] != large
        at = np.flatnonzero(wanted)
        first = text[source[at]]
        order = np.argsort(first, kind="stable")
        edge = np.flatnonzero(np.diff(first[order])) + 1
        seen = []
        cuts = [0, *edge.tolist(), len(at)]
        at = at[order]
        for a, b in zip(cuts[:-1], cuts[1:]) if len(at) else ():
            group = at[a:b]
            symbol = int(text[source[group[0]]])
            if least is None:
                queues[symbol].put(source[group], group)
                continue
            seen.append(symbol)
            begin = np.zeros(len(group), np.int64)
            begin[1:] = group[:-1] + 1
            spans = np.minimum.reduceat(common[: group[-1] + 1], begin)
            spans[0] = min(spans[0], least[symbol])
            queues[symbol].put(source[group], np.minimum(spans + 1, self.most))
            after = common[group[-1] + 1 :]
            least[symbol] = after.min() if len(after) else FAR
        if least is None:
            return
        kept = least[seen]
        np.minimum(least, common.min(), out=least)
        least[seen] = kept

    def _induced(self, seeds: np.ndarray, common: np.ndarray, carry: bool, out) -> None:
        """Both passes from seeds in order; `out(places, common)` gets the order from its end.
        Common prefixes are right only if they are carried."""
        sown, large = self._queues("seed"), self._queues("induced")
        self._sow(sown, seeds, common)
        self._pass(sown, True, carry, lambda s, own, p, c: large[s].put(p, c) if own else None)
        # Descending: common prefixes now refer to the entry after, so shift them within each symbol.
        turned = self._queues("turned")
        for symbol, queue in large.items():
            self._turn(queue, turned[symbol])
        self._pass(turned, False, carry, lambda s, own, p, c: out(p, c))
        # Nothing follows the end of the text that could induce it; it is the smallest suffix.
        out(np.array([len(self.text) - 1]), np.zeros(1, np.int64))

    def _sow(self, queues, places, common) -> None:
        first = self.text[places]
        edge = np.flatnonzero(np.diff(first)) + 1
        for p, c in zip(np.split(places, edge), np.split(common, edge)):
            if len(p):
                queues[int(self.text[p[0]])].put(p, c)

    @staticmethod
    def _turn(queue: DiskQueue, to: DiskQueue) -> None:
        blocks = list(queue.take())
        if not blocks:
            return
        places = np.concatenate([x[0] for x in blocks])[::-1]
        common = np.concatenate([x[1] for x in blocks])[::-1]
        to.put(places, np.concatenate([[0], common[:-1]]))

    def order(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions in suffix order and each one's common prefix with the one before."""
        seeds = self._sorted_seeds()
        common = np.zeros(len(seeds), np.int64)
        common[1:] = common_prefix(self.text, seeds[:-1], seeds[1:], self.most)
        places, shared = [], []
        self._induced(seeds, common, True, lambda p, c: (places.append(p), shared.append(c)))
        order, after = np.concatenate(places)[::-1], np.concatenate(shared)[::-1]
        return order, np.concatenate([[0], after[:-1]])

    def _sorted_seeds(self) -> np.ndarray:
        text, seeds = self.text, self.seeds
        if len(seeds) < 2:
            return seeds
        # The same passes over unordered seeds sort the substrings from one seed to the next.
        start = seeds[np.argsort(text[seeds], kind="stable")]
        found = []
        marked = np.zeros(len(text), bool)
        marked[seeds] = True
        self._induced(start, np.zeros(len(start), np.int64), False, lambda p, c: found.append(p[marked[p]]))
        ordered = np.concatenate(found)[::-1]
        next_seed = np.zeros(len(text), np.int64)
        next_seed[seeds[:-1]] = seeds[1:]
        next_seed[seeds[-1]] = len(text) - 1
        lengths = next_seed[ordered] - ordered + 1
        a, b = ordered[:-1], ordered[1:]
        equal = lengths[:-1] == lengths[1:]
        at = np.flatnonzero(equal)
        step = 0
        while len(at):
            same = text[a[at] + step] == text[b[at] + step]
            equal[at[~same]] = False
            at, step = at[same], step + 1
            at = at[lengths[at] > step]
        names = np.empty(len(text), np.int64)
        names[ordered] = np.concatenate([[0], np.cumsum(~equal)])
        inner = names[seeds]
        if inner.max() == len(seeds) - 1:
            return ordered
        if len(inner) > INNER:
            raise MemoryError("deal the text to more shards")
        return seeds[by_doubling(inner, self.most)]
