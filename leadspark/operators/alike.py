"""All pairs of alike names and addresses between two blocks of rows, in numpy: exact bounds first, then bit-parallel subsequences.

A name pair is first bound by the letters that the names do not share (bits of the letters' counts, word by word), then by its longest common
subsequence; the rows of a name pair by the letters that the addresses share, then window by window, passing over windows that cannot reach
what is needed. No bound loses a pair: the result is that of scoring every pair."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np

#: Texts of more characters, and patterns of more than 64, are compared one by one.
WIDE = 128
WORD = 64
#: Pairs of names, and of rows, worked on at once.
NAMES_AT_ONCE, ROWS_AT_ONCE = 100_000, 1_000_000
ONE = np.uint64(1)


class Texts:
    """Texts as rows of character codes (0 is none), with 128 bits of their letters' counts."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.length = np.fromiter(map(len, texts), np.int64, len(texts))
        self.hard = (self.length > WIDE) | np.fromiter(("\0" in t for t in texts), bool, len(texts))
        wide = max(1, int(self.length[~self.hard].max(initial=1)))
        plain = np.array(["" if h else t for t, h in zip(texts, self.hard)], f"<U{wide}").view(np.uint32).reshape(len(texts), wide)
        times = np.bincount(plain.ravel(), minlength=1)
        known = np.flatnonzero(times)
        known = known[known > 0]
        self.size = len(known) + 1
        code = np.zeros(len(times), np.uint8 if self.size <= 256 else np.uint32)
        code[known] = np.arange(1, self.size)
        self.codes = code[plain]
        self._bits(known, times)

    def _bits(self, known: np.ndarray, times: np.ndarray, letters: int = 60, most: int = 6) -> None:
        """A bit says that a text has a letter t times or more; the 128 bits that part the texts most are kept. Letters without a bit are
        counted in `rest`."""
        n, wide = self.codes.shape
        top = known[np.argsort(-times[known], kind="stable")[:letters]]
        at = np.full(self.size, len(top), np.int64)
        at[np.searchsorted(known, top) + 1] = np.arange(len(top))
        counts = np.zeros((n, len(top)), np.uint8)
        for a in range(0, n, 8192):
            c = at[self.codes[a : a + 8192]]
            r, w = len(c), len(top) + 1
            counts[a : a + r] = np.bincount((c + np.arange(r)[:, None] * w).ravel(), minlength=r * w).reshape(r, w)[:, :-1]
        for k in np.flatnonzero(self.hard):
            have = Counter(self.texts[k])
            counts[k] = [min(255, have.get(chr(c), 0)) for c in top]
        share = [(p * (1 - p), k, t) for k in range(len(top)) for t in range(1, most + 1) for p in (float((counts[:, k] >= t).mean()),)]
        chosen = sorted((s for s in share if s[0] > 0), reverse=True)[: 2 * WORD]
        self.bits = np.zeros((2, n), np.uint64)
        for b, (_, k, t) in enumerate(chosen):
            self.bits[b // WORD] |= (counts[:, k] >= t).astype(np.uint64) << np.uint64(b % WORD)
        self.rest = self.length - np.bitwise_count(self.bits).sum(0)

    def masks(self, which: np.ndarray) -> np.ndarray:
        """For each text (64 characters at most) and each code the places where the text has it, as bits; flat."""
        m = np.zeros((len(which), self.size), np.uint64)
        codes, length = self.codes[which], self.length[which]
        for i in range(int(length.max(initial=0))):
            k = np.flatnonzero(length > i)
            m[k, codes[k, i]] |= ONE << np.uint64(i)
        return m.ravel()


def common(masks: np.ndarray, base: np.ndarray, column: Callable[[int], np.ndarray], steps: int) -> np.ndarray:
    """Lengths of longest common subsequences: base is where a pattern's masks begin, column(j) the j-th code of each text."""
    s = np.full(len(base), np.iinfo(np.uint64).max, np.uint64)
    for j in range(steps):
        u = masks.take(base + column(j))
        u &= s
        rest = s - u
        s += u
        s |= rest
    return np.bitwise_count(~s).astype(np.int64)


class Side:
    """Rows of a block in the order of their names; the names ordered by length."""

    def __init__(self, ids: np.ndarray, names: list[str], addresses: list[str], alone: np.ndarray):
        seen: dict[str, int] = {}
        at = np.fromiter((seen.setdefault(n, len(seen)) for n in names), np.int64, len(names))
        distinct = list(seen)
        order = np.argsort(np.fromiter(map(len, distinct), np.int64, len(distinct)), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        at = rank[at]
        rows = np.argsort(at, kind="stable")
        self.names = [distinct[k] for k in order]
        self.rows = np.bincount(at, minlength=len(order))
        self.start = np.cumsum(self.rows) - self.rows
        self.ids, self.alone = ids[rows], alone[rows]
        self.addresses = [addresses[k] for k in rows]
        self.open = np.bincount(at, weights=alone, minlength=len(order)) > 0


def _expand(first: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(k, v) for each k and each v of first[k], first[k] + 1, ... of which there are times[k]."""
    k = np.repeat(np.arange(len(times)), times)
    return k, np.arange(len(k)) - np.repeat(np.cumsum(times) - times, times) + first[k]


def _parts(times: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of whose times not more than `most` are in one, or one alone."""
    end, a = np.cumsum(times), 0
    while a < len(times):
        b = max(a + 1, int(np.searchsorted(end, (end[a - 1] if a else 0) + most, "right")))
        yield slice(a, b)
        a = b


class Blocks:
    """Pairs (smaller id, larger id) between two blocks, or within one (y None), of which the smaller id's row is alone."""

    def __init__(self, x: Side, y: Side | None, least: float, name_least: float, indel: Callable[[str, str], float], partial: Callable[[str, str], float]):
        self.same = y is None
        self.x, self.y = x, y or x
        self.least, self.name_least, self.indel, self.partial = least, name_least, indel, partial
        self.names = Texts(x.names + ([] if y is None else y.names))
        self.addresses = Texts(x.addresses + ([] if y is None else y.addresses))
        self.nx, self.ax = (0, 0) if y is None else (len(x.names), len(x.addresses))  # where y's texts begin
        self.columns = np.ascontiguousarray(self.names.codes.T)
        a = self.addresses.codes
        self.padded = np.zeros((len(a), a.shape[1] + 2 * WORD), a.dtype)  # a window may begin before a text and end behind it
        self.padded[:, WORD:-WORD] = a

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for xs, ys in self._near():
            xs, ys, score = self._names(xs, ys)
            yield from self._rows(xs, ys, score)

    def _near(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Name pairs that the letters they do not share leave within reach."""
        lx, ly = self.names.length[: len(self.x.names)], self.names.length[self.nx : self.nx + len(self.y.names)]
        (x0, x1), (y0, y1) = self.names.bits, self.names.bits[:, self.nx :]
        reach = (100.0 - self.name_least) / 100
        xs, ys, n, at = [], [], 0, -1
        for x in range(len(lx)):
            if not self.x.open[x] and not self.y.open.any():
                continue
            if lx[x] != at:
                at = lx[x]
                most = np.minimum(np.floor(reach * (at + ly) + 1e-6), 255).astype(np.uint8)
                low, high = np.searchsorted(17 * ly, 11 * at), np.searchsorted(11 * ly, 17 * at, "right")
            a = max(low, x) if self.same else low
            if a >= high:
                continue
            d = np.bitwise_count(y0[a:high] ^ x0[x])
            k = np.flatnonzero(d <= most[a:high])
            d = d[k]
            k += a
            k = k[d + np.bitwise_count(y1[k] ^ x1[x]) <= most[k]]
            if not self.x.open[x]:
                k = k[self.y.open[k]]
            if len(k):
                xs.append(np.full(len(k), x))
                ys.append(k)
                n += len(k)
                if n >= NAMES_AT_ONCE:
                    yield np.concatenate(xs), np.concatenate(ys)
                    xs, ys, n = [], [], 0
        if n:
            yield np.concatenate(xs), np.concatenate(ys)

    def _names(self, xs: np.ndarray, ys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The name pairs alike enough, with their ratios."""
        t, n = self.names, self.names.length
        score = np.zeros(len(xs))
        hard = t.hard[xs] | t.hard[ys + self.nx] | (n[xs] > WORD)
        for k in np.flatnonzero(hard):
            score[k] = self.indel(t.texts[xs[k]], t.texts[ys[k] + self.nx])
        easy = np.flatnonzero(~hard)
        some = max(256, 4_000_000 // t.size)
        for a in range(0, len(easy), some):
            k = easy[a : a + some]
            which, base = np.unique(xs[k], return_inverse=True)
            text = ys[k] + self.nx
            both = n[xs[k]] + n[text]
            score[k] = 200.0 * common(t.masks(which), base * t.size, lambda j: self.columns[j].take(text), int(n[text].max(initial=0))) / both
        k = score >= self.name_least
        return xs[k], ys[k], score[k]

    def _rows(self, xs: np.ndarray, ys: np.ndarray, score: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The rows of the name pairs whose addresses lift them to what is needed."""
        x, y, t = self.x, self.y, self.addresses
        for part in _parts(x.rows[xs], ROWS_AT_ONCE):
            k, r1 = _expand(x.start[xs[part]], x.rows[xs[part]])
            name, other, times = score[part][k], ys[part][k], y.rows[ys[part][k]]
            own = self.same & (xs[part][k] == other)
            for inner in _parts(times, ROWS_AT_ONCE):
                k, q = _expand(y.start[other[inner]], times[inner])
                p, s = r1[inner][k], name[inner][k]
                i, j = x.ids[p], y.ids[q]
                ok = np.where(i < j, x.alone[p], y.alone[q]) & (i != j)
                ok &= ~own[inner][k] | (p < q)
                need = (self.least - 0.7 * s) / 0.3
                q = q + self.ax
                shared = np.bitwise_count(t.bits[0][p] & t.bits[0][q]).astype(np.int64) + np.bitwise_count(t.bits[1][p] & t.bits[1][q]) + np.minimum(t.rest[p], t.rest[q])
                ok &= shared * (200 - need) >= need * np.minimum(t.length[p], t.length[q]) - 1e-6
                ok = np.flatnonzero(ok)
                turn = i[ok] > j[ok]
                p, q, s, i, j = p[ok], q[ok], s[ok], i[ok], j[ok]
                good = self._addresses(np.where(turn, q, p), np.where(turn, p, q), s)
                yield np.minimum(i, j)[good], np.maximum(i, j)[good]

    def _addresses(self, p: np.ndarray, q: np.ndarray, name: np.ndarray) -> np.ndarray:
        """Which pairs of addresses reach what their names leave to be reached."""
        t = self.addresses
        longer = t.length[p] > t.length[q]
        p, q = np.where(longer, q, p), np.where(longer, p, q)
        good = np.zeros(len(p), bool)
        hard = t.hard[p] | t.hard[q] | (t.length[p] > WORD)
        for k in np.flatnonzero(hard):
            good[k] = 0.7 * name[k] + 0.3 * self.partial(t.texts[p[k]], t.texts[q[k]]) >= self.least
        easy = np.flatnonzero(~hard)
        easy = easy[np.argsort(t.length[p[easy]], kind="stable")]
        some = max(256, 4_000_000 // t.size)
        for a in range(0, len(easy), some):
            k = easy[a : a + some]
            good[k] = self._windows(p[k], q[k], name[k])
        return good

    def _windows(self, p: np.ndarray, q: np.ndarray, name: np.ndarray) -> np.ndarray:
        t, flat, wide = self.addresses, self.padded.ravel(), self.padded.shape[1]
        which, base = np.unique(p, return_inverse=True)
        masks, base = t.masks(which), base * t.size
        n, m, begin = t.length[p], t.length[q], q * wide + WORD
        need = (self.least - 0.7 * name) / 0.3
        short = np.maximum(1, np.ceil(need * n / (200 - need) - 1e-6).astype(np.int64))  # no shorter window can do
        at, last = short - n, m - short
        good, left = np.zeros(len(p), bool), np.flatnonzero(at <= last)
        while len(left):
            w, f = at[left], begin[left] + at[left]
            got = common(masks, base[left], lambda j: flat.take(f + j), int(n[left].max())) if (n[left] == n[left[0]]).all() else self._mixed(masks, base[left], flat, f, n[left])
            both = n[left] + np.minimum(m[left], w + n[left]) - np.maximum(0, w)
            done = 0.7 * name[left] + 0.3 * (200.0 * got / both) >= self.least
            good[left[done]] = True
            # one step on, a window has one more common letter at most: those that cannot do are passed over
            at[left] += np.maximum(1, np.ceil(need[left] * both / 200 - got - 1e-6).astype(np.int64))
            left = left[~done & (at[left] <= last[left])]
        return good

    @staticmethod
    def _mixed(masks: np.ndarray, base: np.ndarray, flat: np.ndarray, f: np.ndarray, n: np.ndarray) -> np.ndarray:
        """common() for patterns, and so windows, of several lengths; ordered by length."""
        s = np.full(len(base), np.iinfo(np.uint64).max, np.uint64)
        first = np.searchsorted(n, np.arange(int(n[-1])), "right")
        for j, a in enumerate(first):
            u = masks.take(base[a:] + flat.take(f[a:] + j))
            u &= s[a:]
            rest = s[a:] - u
            s[a:] += u
            s[a:] |= rest
        return np.bitwise_count(~s).astype(np.int64)
