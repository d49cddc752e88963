"""Suffix order and common prefixes by induced sorting, in the memory of one task plus its disk.

The suffixes at which the text turns from falling to rising (LMS suffixes) are sorted first; all
others are induced from them.  Every induced suffix is a tuple (place, common prefix with the
suffix queued before it), queued by its first symbol.  As tuples are queued in the order of the
suffixes that induce them, each symbol's queue is already sorted, and taking the queues by symbol
is the order of one priority queue.  Queues above ``memory`` bytes go to an unlinked temporary
file until their symbol's turn (a task's own spill, gone with the task).

LMS suffixes are sorted by induction of their blocks, which get names in order; the string of names
(a third of the length or less) is sorted by ranks of pairs, doubling the length each time; its common
prefixes are read off the ranks.  Common prefixes are exact up to ``cap`` and end there.
"""

from __future__ import annotations

import tempfile

import numpy as np


class SymbolQueues:
    """Tuples (place, common prefix) by first symbol, spilled to disk beyond ``memory`` bytes."""

    def __init__(self, symbols: int, memory: int):
        self.runs: list[list] = [[] for _ in range(symbols)]
        self.memory, self.held, self.file = memory, 0, None

    def put(self, symbol: int, places: np.ndarray, common: np.ndarray) -> None:
        self.runs[symbol].append((places, common))
        self.held += places.nbytes + common.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for runs in self.runs:
            for k, run in enumerate(runs):
                if isinstance(run, tuple):
                    at = self.file.tell()
                    for part in run:
                        self.file.write(part.tobytes())
                    runs[k] = [at, len(run[0]), run[0].dtype, run[1].dtype]
        self.held = 0

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        places, common = [], []
        for run in self.runs[symbol]:
            if isinstance(run, list):
                at, n, a, b = run
                self.file.seek(at)
                run = (np.frombuffer(self.file.read(n * a.itemsize), a), np.frombuffer(self.file.read(n * b.itemsize), b))
            else:
                self.held -= run[0].nbytes + run[1].nbytes
            places.append(run[0])
            common.append(run[1])
        self.runs[symbol] = []
        if not places:
            return np.zeros(0, np.int32), np.zeros(0, np.int16)
        return np.concatenate(places), np.concatenate(common)


def range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low + 1 .. high] for each pair; low < high."""
    span = high - low
    out = np.empty(len(low), values.dtype)
    level = np.frexp(span.astype(float))[1] - 1  # floor of the binary logarithm
    table = values
    for k in range(int(level.max()) + 1 if len(level) else 0):
        here = np.flatnonzero(level == k)
        if len(here):
            a, z = low[here] + 1, high[here] - (1 << k) + 1
            out[here] = np.minimum(table[a], table[z])
        if len(table) > 1 << k:
            table = np.minimum(table[:len(table) - (1 << k)], table[1 << k:])
    return out


class _Text:
    """Symbols (last one 0, alone), their types, and where equal symbols end."""

    def __init__(self, text: np.ndarray):
        self.t, n = text, len(text)
        change = np.flatnonzero(text[1:] != text[:-1])
        ends = np.append(change, n - 1)
        lengths = np.diff(np.append(-1, ends))
        rising = np.append(text[change] < text[change + 1], True)  # the last run is the end mark: S
        self.s_type = np.repeat(rising, lengths)
        self.run = (np.repeat(ends, lengths) - np.arange(n) + 1).astype(np.int32)
        self.lms = (np.flatnonzero(self.s_type[1:] & ~self.s_type[:-1]) + 1).astype(np.int32)
        self.symbols = int(text.max()) + 1
        wide = np.concatenate([text, np.zeros(4, text.dtype)]).astype(np.uint64)
        self.words = (wide[:-4] << np.uint64(48)) | (wide[1:-3] << np.uint64(32)) | (wide[2:-2] << np.uint64(16)) | wide[3:-1]

    def common(self, a: np.ndarray, b: np.ndarray, cap: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes at a and b (a != b), at most cap."""
        out = np.zeros(len(a), np.int64)
        open_ = np.arange(len(a))
        n = len(self.t)
        while len(open_):
            i, j = a[open_] + out[open_], b[open_] + out[open_]
            inside = (i < n) & (j < n) & (out[open_] < cap[open_])
            open_, i, j = open_[inside], i[inside], j[inside]
            differ = self.words[i] ^ self.words[j]
            same = differ == 0
            out[open_[same]] += 4
            rest = differ[~same]
            out[open_[~same]] += (rest < 1 << 48).astype(np.int64) + (rest < 1 << 32) + (rest < 1 << 16)
            open_ = open_[same]
        return np.minimum(out, cap)


def _induce(x: _Text, lms: np.ndarray, lms_common: np.ndarray, cap: int, memory: int, tops_only: bool = False):
    """Order and common prefixes of all suffixes, from the order of the LMS suffixes.

    ``tops_only``: the LMS suffixes in the order of their blocks alone.
    """
    t = x.t
    bounds = np.searchsorted(t[lms], np.arange(x.symbols + 1))
    left: list[tuple] = [None] * x.symbols

    def push(queues, places, common, wanted_type, skip):
        """Queue the places before ``places`` that are of the wanted type and not of symbol ``skip``."""
        have = np.flatnonzero(places > 0)
        before = places[have] - 1
        good = (x.s_type[before] == wanted_type) & (t[before] != skip)
        have, before = have[good], before[good]
        if not len(have):
            return
        first = t[before]
        order = np.argsort(first, kind="stable")
        have, before, first = have[order], before[order], first[order]
        joint = np.empty(len(have), common.dtype)
        joint[0] = 1
        follows = first[1:] == first[:-1]
        joint[1:] = 1
        at = np.flatnonzero(follows) + 1
        if len(at):
            joint[at] = np.minimum(range_minima(common, have[at - 1], have[at]) + 1, cap)
        cuts = np.append(np.flatnonzero(np.append(True, ~follows)), len(first))
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            queues.put(int(first[a]), before[a:z], joint[a:z])

    def chain(places, common, symbol, wanted_type):
        """A queue with what its suffixes induce under the same symbol, round after round."""
        all_places, all_common = [places], [common]
        while len(places):
            have = np.flatnonzero(places > 0)
            have = have[(t[places[have] - 1] == symbol) & (x.s_type[places[have] - 1] == wanted_type)]
            if not len(have):
                break
            nxt = places[have] - 1
            joint = np.empty(len(have), common.dtype)
            joint[0] = min(cap, int(x.run[places[-1]]), int(x.run[nxt[0]]))  # runs of different length
            if len(have) > 1:
                joint[1:] = np.minimum(range_minima(common, have[:-1], have[1:]) + 1, cap)
            places, common = nxt, joint
            all_places.append(places)
            all_common.append(common)
        return np.concatenate(all_places), np.concatenate(all_common)

    queues = SymbolQueues(x.symbols, memory)
    for c in range(x.symbols):
        places, common = queues.take(c)
        if len(places):
            common = common.copy()
            common[0] = 0
            places, common = chain(places, common, c, False)
        left[c] = (places, common)
        a, z = bounds[c], bounds[c + 1]
        if a < z:
            tops, joint = lms[a:z], lms_common[a:z].copy()
            joint[0] = min(cap, int(x.run[places[-1]]), int(x.run[tops[0]])) if len(places) else 0
            places, common = np.concatenate([places, tops]), np.concatenate([common, joint])
        if len(places):
            push(queues, places, common, False, c)
    right: list[tuple] = [None] * x.symbols
    queues = SymbolQueues(x.symbols, memory)
    # Downwards; a tuple's common prefix is that with the suffix after it.
    for c in range(x.symbols - 1, -1, -1):
        places, common = queues.take(c)
        if len(places):
            common = common.copy()
            common[0] = 0
            places, common = chain(places, common, c, True)
        if c == 0:  # the end mark
            places, common = np.array([len(t) - 1], np.int32), np.zeros(1, np.int16)
        right[c] = (places, common)
        lp, lc = left[c]
        if len(lp):
            down = np.empty(len(lp), lc.dtype)
            down[1:] = lc[1:][::-1]
            down[0] = min(cap, int(x.run[places[-1]]), int(x.run[lp[-1]])) if len(places) else 0
            places, common = np.concatenate([places, lp[::-1]]), np.concatenate([common, down])
        if len(places):
            push(queues, places, common, True, c)
    if tops_only:
        is_top = np.zeros(len(t), bool)
        is_top[x.lms] = True
        found = [p[::-1][is_top[p[::-1]]] for p, _ in right]
        return np.concatenate(found), None
    order, joint = [], []
    for c in range(x.symbols):
        (lp, lc), (rp, rc) = left[c], right[c]
        up = np.empty(len(rp), np.int16)
        if len(rp):
            up[1:] = rc[1:][::-1]
            up[0] = min(cap, int(x.run[lp[-1]]), int(x.run[rp[-1]])) if len(lp) else 0
        order += [lp, rp[::-1]]
        joint += [lc, up]
    return np.concatenate(order), np.concatenate(joint)


def suffix_order(text: np.ndarray, cap: int, memory: int = 64 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): suffixes of ``text`` ascending, each one's common prefix with the one before.

    ``text``: symbols of uint16, above 0.  Orders and common prefixes hold up to ``cap`` symbols.
    """
    x = _Text(np.append(text, 0).astype(np.uint16))
    n, tops = len(x.t), x.lms
    if len(tops) > 1:
        rough = tops[np.argsort(x.t[tops], kind="stable")]
        blocks, _ = _induce(x, rough, np.zeros(len(rough), np.int16), cap, memory, tops_only=True)
        nth = np.zeros(n, np.int64)
        nth[tops] = np.arange(len(tops))
        length = np.append(np.diff(tops) + 1, 1).astype(np.int64)
        a, b = nth[blocks[:-1]], nth[blocks[1:]]
        whole = np.minimum(length[a], length[b])
        equal = (length[a] == length[b]) & (x.common(blocks[:-1].astype(np.int64), blocks[1:].astype(np.int64), whole) >= whole)
        names = np.zeros(len(tops), np.int64)
        names[nth[blocks]] = np.append(0, np.cumsum(~equal))
        levels, width = [names], 1
        while levels[-1].max() + 1 < len(tops) and 2 * width <= 2 * cap:
            r = levels[-1]
            after = np.append(r[width:] + 1, np.zeros(min(width, len(r)), np.int64))[:len(r)]
            _, pairs = np.unique(r * (len(r) + 1) + after, return_inverse=True)
            levels.append(pairs.astype(np.int64))
            width *= 2
        order = np.argsort(levels[-1], kind="stable")
        a, b = order[:-1].copy(), order[1:].copy()
        m = len(tops)
        for k in range(len(levels) - 1, -1, -1):
            ok = (a < m) & (b < m)
            same = np.zeros(len(a), bool)
            same[ok] = levels[k][a[ok]] == levels[k][b[ok]]
            a, b = a + (same << k), b + (same << k)
        base = np.append(tops, n).astype(np.int64)
        a, b = np.minimum(a, m), np.minimum(b, m)
        gone = base[a] - base[order[:-1]]
        common = np.minimum(gone + x.common(base[a], base[b], np.maximum(cap - gone, 0)), cap)
        tops, common = tops[order], np.append(0, common).astype(np.int16)
    else:
        common = np.zeros(len(tops), np.int16)
    order, joint = _induce(x, tops, common, cap, memory)
    return order[1:], joint[1:]  # without the end mark
