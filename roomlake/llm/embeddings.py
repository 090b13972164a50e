"""Embedding near-duplicates (operator 5): sketches find the classes, whole vectors settle the links.

A cosine of at least ``c`` between unit vectors means a squared distance of at most
``2 - 2c``.  Unit vectors are rotated by random sign flips and Walsh-Hadamard transforms,
so that every block of coordinates carries a like share of a distance; if each block's were over
its share, the sum would be too.  So each block is range-joined under its own share, on sketches
(the block in 16 bits a coordinate, the others in 8 bits): rows live in the cell of the nearest of
some centres and visit the cells of lower number that reach them.  Within a task the rows of a cell
lie in small shells around finer centres, and only shells within reach are compared.

A sketch's distance is off by a known bound, so the classes of its links hold the true ones.
The whole vectors of a class then meet in one task; of large classes, they go through the same
range join with whole vectors instead of sketches.  Sketches are sent in rounds of a bounded
number of bytes, and what a round has shuffled is removed at its end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomlake.llm.common import cut, mix64, release
from roomlake.llm.components import components
from roomlake.llm.simhash import spanning

BLOCK = 13                  # coordinates of a block, as long as there are few blocks
BLOCKS = 5
CELL_ROWS = 150_000         # rows of a cell that meet in one task; larger cells are dealt out
TASK_BYTES = 40 << 20       # of those rows and, again, of the rows that they meet
SHELL, ROWS = 256, 256      # rows of a shell, and of those compared with it at a time
CHUNK = 16_384
CLASS_ROWS = 4096           # larger classes of the sketches are joined by cells again
BUCKET_BYTES = 4 << 20
ROUND_LEAST = 64 << 20      # bytes sent in a round: 1.5 times the vectors, this at least
SAMPLE_ROWS, SAMPLE_BYTES = 20_000, 8 << 20
_SLACK = 1e-9


def rotate(x: np.ndarray, seed: int = 11) -> np.ndarray:
    """Random rotation of the rows of ``x`` (padded to a power of two), the same for a row in any company."""
    d = 1 << max(0, x.shape[1] - 1).bit_length()
    out = np.zeros((len(x), d))
    out[:, :x.shape[1]] = x
    rng = np.random.default_rng(seed)
    for _ in range(3):
        out *= rng.integers(0, 2, d) * 2.0 - 1.0
        h = 1
        while h < d:
            y = out.reshape(len(x), d // (2 * h), 2, h)
            out = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(len(x), d)
            h *= 2
        out /= math.sqrt(d)
    return out


@lru_cache(maxsize=4)
def _rotation(d: int) -> np.ndarray:
    return rotate(np.eye(d))


def unit_rows(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)       # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _coordinates(raw: np.ndarray, whole: bool, steady: bool = False) -> np.ndarray:
    """Coordinates that the cells are laid in; ``steady``: to the last bit the same for a row in any company."""
    u = unit_rows(raw)
    if whole:
        return u if steady else u.astype(np.float32)
    if steady or u.shape[1] > 512:
        return rotate(u)
    return (u @ _rotation(u.shape[1])).astype(np.float32)


def blocks_of(d: int, whole: bool = False) -> list[slice]:
    """The blocks of vectors of ``d`` numbers, after the rotation; of whole vectors, one."""
    if whole:
        return [slice(0, d)]
    d = 1 << max(0, d - 1).bit_length()
    ends = np.linspace(0, d, min(BLOCKS, max(1, round(d / BLOCK))) + 1).round().astype(int)
    return [slice(int(a), int(b)) for a, b in zip(ends, ends[1:])]


def _budget(cosine: float) -> float:
    return (2 - 2 * cosine) * (1 + _SLACK) + _SLACK


def _reach(d: int, block: int, cosine: float, whole: bool) -> float:
    """Distance within a block that some block of every link keeps to."""
    blocks = blocks_of(d, whole)
    return math.sqrt(_budget(cosine) * (blocks[block].stop - blocks[block].start) / blocks[-1].stop) + 1e-5


def _matrix(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float32).reshape(-1, d)


# -- what travels: rows of bytes

def _limit(d: int) -> float:
    """Coordinates of a sketch are cut off there, which brings no two rows farther apart."""
    return min(1.0, 4 / math.sqrt(d))


def _width(d: int, block: int, whole: bool) -> int:
    if whole:
        return 16 + 4 * d
    blocks = blocks_of(d)
    return 8 + blocks[-1].stop + blocks[block].stop - blocks[block].start


def _pack(z: np.ndarray, raw: np.ndarray, node: np.ndarray, copies: np.ndarray, sl: slice, whole: bool) -> np.ndarray:
    parts = [node.astype("<i8")[:, None].view(np.uint8)]
    if whole:
        parts += [copies.astype("<i8")[:, None].view(np.uint8), np.ascontiguousarray(raw, "<f4").view(np.uint8)]
    else:
        top = _limit(z.shape[1])
        rest = np.delete(z, np.r_[sl], axis=1)
        parts += [np.rint(z[:, sl] * 32767).astype("<i2").view(np.uint8),
                  np.rint(np.clip(rest, -top, top) * (127 / top)).astype(np.int8).view(np.uint8)]
    return np.concatenate(parts, axis=1)


def _numbers(rows: np.ndarray, a: int, b: int, kind: str) -> np.ndarray:
    return np.ascontiguousarray(rows[:, a:b]).view(kind)


# -- cells

def _cells(z: np.ndarray, raw: np.ndarray, sl: slice, centres: np.ndarray, reach: float,
           whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Each row's home, the cell of its nearest centre, and a mask of the lower cells within reach."""
    n, c = len(z), centres
    if len(c) == 1:
        return np.zeros(n, np.int64), np.zeros((n, 1), bool)
    d2 = (c * c).sum(axis=1) - 2 * (z[:, sl].astype(np.float32) @ c.T)
    home, every = d2.argmin(axis=1), np.arange(n)
    least = d2[every, home]
    d2[every, home] = np.inf
    tied = np.flatnonzero(d2.min(axis=1) - least < 1e-4)
    d2[every, home] = least
    for a in range(0, len(tied), 256):                  # the same home in every round
        some = tied[a:a + 256]
        zt = _coordinates(raw[some], whole, steady=True)[:, sl]
        home[some] = ((zt[:, None] - c) ** 2).sum(axis=2).argmin(axis=1)
    visits, planes, left = np.arange(len(c)) < home[:, None], _planes(c, reach), d2.copy()
    for _ in range(min(3, len(c))):                     # by the planes to the three nearest centres
        near = left.argmin(axis=1)
        visits &= d2 - d2[every, near][:, None] <= planes[near]
        left[every, near] = np.inf
    return home, visits


def _planes(c: np.ndarray, reach: float) -> np.ndarray:
    """Rows of a centre lie on its side of the plane between it and another one.

    Only where the squared distance to a centre exceeds that to another one by no more than this may a row
    reach the rows of the centre.
    """
    return np.stack([np.sqrt(((c - x) ** 2).sum(axis=1)) for x in c]) * np.float32(2 * reach) + np.float32(1e-5)


def _centres(x: np.ndarray, n: int) -> np.ndarray:
    """At most ``n`` centres of the rows of ``x``, by a few rounds of k-means."""
    c = np.unique(x[:n], axis=0)
    for _ in range(6):
        a = _nearest(x, c)
        size = np.bincount(a, minlength=len(c))
        mean = np.stack([np.bincount(a, weights=col, minlength=len(c)) for col in x.T], axis=1)
        c = np.unique(np.where(size[:, None] > 0, mean / np.maximum(size, 1)[:, None], c).astype(np.float32), axis=0)
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    c2 = (c * c).sum(axis=1)
    step = max(1, (4 << 20) // len(c))
    return np.concatenate([(c2 - 2 * x[a:a + step] @ c.T).argmin(axis=1) for a in range(0, len(x), step)])


class Plan:
    """Cells of every length of vector and block, dealt out to tasks, and these to rounds.

    A unit is a part of a cell's home rows, which meet each other, the rows of the cell's later parts
    and the visitors; where these are many, they are dealt to several tasks.
    """

    def __init__(self, nodes: DataFrame, cosine: float, whole: bool):
        self.cosine, self.whole = cosine, whole
        self.rows = {r["d"]: r["n"] for r in nodes.groupBy("d").agg(F.count("*").alias("n")).collect()}
        self.centres: dict[int, list[np.ndarray]] = {}
        for d, n in sorted(self.rows.items()):
            blocks, cells = blocks_of(d, whole), -(-n // self.cell_rows(d, 0))
            if cells > 1:
                sample = max(4 * cells, min(SAMPLE_ROWS, SAMPLE_BYTES // (4 * d)))
                some = nodes.where(F.col("d") == d).where(F.pmod(F.xxhash64("node"), F.lit(max(1, n // sample))) == 0)
                raw = np.frombuffer(b"".join(r["v"] for r in some.select("v").limit(2 * sample).collect()), np.float32)
                z = _coordinates(raw.reshape(-1, d), whole) if len(raw) else np.zeros((1, blocks[-1].stop), np.float32)
                self.centres[d] = [_centres(z[:, sl].astype(np.float32), cells) for sl in blocks]
            else:
                self.centres[d] = [np.zeros((1, sl.stop - sl.start), np.float32) for sl in blocks]
        self._deal(self._count(nodes) if any(len(c) > 1 for x in self.centres.values() for c in x) else {})

    def cell_rows(self, d: int, block: int) -> int:
        return max(1, min(CELL_ROWS, TASK_BYTES // _width(d, block, self.whole)))

    def _count(self, nodes: DataFrame) -> dict[tuple[int, int], np.ndarray]:
        """Home rows and visitors of each cell."""
        centres, cosine, whole = self.centres, self.cosine, self.whole

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, int], np.ndarray] = {}
            for d, raw, _, _ in _by_length(batches):
                z = _coordinates(raw, whole)
                for k, sl in enumerate(blocks_of(d, whole)):
                    c = centres[d][k]
                    home, visits = _cells(z, raw, sl, c, _reach(d, k, cosine, whole), whole)
                    now = np.stack((np.bincount(home, minlength=len(c)), visits.sum(axis=0)))
                    total[d, k] = total.get((d, k), 0) + now
            for (d, k), x in total.items():
                m = x.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, d, np.int32)), pa.array(np.full(m, k, np.int32)),
                     pa.array(np.arange(m, dtype=np.int32)), pa.array(x[0]), pa.array(x[1])],
                    names=["d", "block", "cell", "homes", "visits"])

        found = nodes.select("node", "copies", "v", "d").mapInArrow(
            run, "d int, block int, cell int, homes long, visits long")
        out = {(d, k): np.zeros((2, len(c)), np.int64) for d, x in self.centres.items() for k, c in enumerate(x)}
        for r in found.groupBy("d", "block", "cell").agg(F.sum("homes"), F.sum("visits")).collect():
            out[r[0], r[1]][:, r[2]] = r[3], r[4]
        return out

    def _deal(self, counts: dict[tuple[int, int], np.ndarray]) -> None:
        self.ways, self.base, self.unit_of, tasks, sent = {}, {}, [], [], []
        for d, x in self.centres.items():
            for k in range(len(x)):
                homes, visits = counts.get((d, k), np.array([[self.rows[d]], [0]]))
                most, width = self.cell_rows(d, k), _width(d, k, self.whole)
                ways = np.maximum(1, -(-homes // most))
                self.ways[d, k], self.base[d, k] = ways, len(tasks) + np.cumsum(ways) - ways
                for h, v, w in zip(homes.tolist(), visits.tolist(), ways.tolist()):
                    for s in range(w):
                        met = h * (w - 1 - s) // w + v
                        n = max(1, -(-met // (2 * most)))
                        self.unit_of.append((d, k))
                        tasks.append(n)
                        sent.append((n * h // w + met) * width)
        self.tasks = np.array(tasks, np.int64)
        self.first_key = np.cumsum(self.tasks) - self.tasks
        room = max(ROUND_LEAST, 3 * sum(n * (4 * d + 24) for d, n in self.rows.items()) // 2)
        self.rounds, a, total = [], 0, 0
        for b, x in enumerate(sent):
            if b > a and total + x > room:
                self.rounds.append((a, b))
                a, total = b, 0
            total += x
        self.rounds.append((a, len(sent)))


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(d, vectors, nodes, copies) of the rows (node, copies, v, d)."""
    for b in batches:
        dims = b.column(3).to_numpy(zero_copy_only=False)
        for d in np.unique(dims):
            part = b if (dims == d).all() else b.take(pa.array(np.flatnonzero(dims == d)))
            yield int(d), _matrix(part.column(2), int(d)), part.column(0).to_numpy(), part.column(1).to_numpy()


def _spread(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every row as often as counted, and the numbers 0, 1, ... beside."""
    ends = np.cumsum(counts)
    return np.repeat(rows, counts), np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def _addresses(plan: Plan, d: int, k: int, node: np.ndarray, home: np.ndarray, visits: np.ndarray,
               span: tuple[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(rows, keys of their tasks, own) for the units of a round."""
    ways, base = plan.ways[d, k], plan.base[d, k]
    h = mix64(node.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    part = ((h >> np.uint64(32)) % ways[home].astype(np.uint64)).astype(np.int64)
    mine = np.arange(len(node))
    unit = base[home] + part
    keep = (unit >= span[0]) & (unit < span[1])
    rows, t = _spread(mine[keep], plan.tasks[unit[keep]])
    yield rows, plan.first_key[unit[rows]] + t, True
    row, cell = np.nonzero(visits)
    rows, s = _spread(mine, part)                       # earlier parts of the own cell
    seen, q = _spread(np.arange(len(row)), ways[cell])  # all parts of the visited cells
    rows, unit = np.concatenate((rows, row[seen])), np.concatenate((base[home[rows]] + s, base[cell[seen]] + q))
    keep = (unit >= span[0]) & (unit < span[1])
    rows, unit = rows[keep], unit[keep]
    t = ((h[rows] & np.uint64(0xFFFFFFFF)) % plan.tasks[unit].astype(np.uint64)).astype(np.int64)
    yield rows, plan.first_key[unit] + t, False


def _send(nodes: DataFrame, plan: Plan, span: tuple[int, int]) -> DataFrame:
    """Rows (key, own, pack) of a round: the packed rows of many vectors that go to one task."""
    wanted = set(plan.unit_of[span[0]:span[1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bool], list[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (key, own), packs in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key], pa.int64()), pa.array([own]), pa.array([b"".join(packs)], pa.binary())],
                    names=["key", "own", "pack"])
            held.clear()

        for d, raw, node, copies in _by_length(batches):
            z = _coordinates(raw, plan.whole)
            for k, sl in enumerate(blocks_of(d, plan.whole)):
                if (d, k) not in wanted:
                    continue
                home, visits = _cells(z, raw, sl, plan.centres[d][k], _reach(d, k, plan.cosine, plan.whole), plan.whole)
                packs = _pack(z, raw, node, copies, sl, plan.whole)
                for rows, keys, own in _addresses(plan, d, k, node, home, visits, span):
                    order = np.argsort(keys, kind="stable")
                    names, starts = np.unique(keys[order], return_index=True)
                    for key, some in zip(names.tolist(), np.split(order, starts[1:])):
                        held.setdefault((key, own), []).append(packs[rows[some]].tobytes())
                        size += len(some) * packs.shape[1]
                if size > 32 << 20:
                    yield from flush()
                    size = 0
        yield from flush()

    return nodes.select("node", "copies", "v", "d").mapInArrow(run, "key long, own boolean, pack binary")


# -- within a task

def _shells(own: np.ndarray, probe: np.ndarray | None, reach: float):
    """An order of the own rows, and (rows of ``probe``, a, b): all that can be within ``reach`` of the rows a to b - 1 of the order.

    Without ``probe``, rows of the order meet those at or after their place.
    """
    n = len(own)
    rng = np.random.default_rng(7)
    c = own[rng.choice(n, max(1, n // (2 * SHELL)), replace=False)]
    for _ in range(2 if len(c) > 1 else 0):
        a = _nearest(own, c)
        size = np.bincount(a, minlength=len(c))
        mean = np.stack([np.bincount(a, weights=col, minlength=len(c)) for col in own.T], axis=1)
        c = np.where(size[:, None] > 0, mean / np.maximum(size, 1)[:, None], c).astype(np.float32)
    a = _nearest(own, c)
    far = np.sqrt(((own - c[a]) ** 2).sum(axis=1, dtype=np.float64))
    order = np.lexsort((far, a))
    far = far[order]
    ends = np.cumsum(np.bincount(a, minlength=len(c)))
    shells = [(s, min(s + SHELL, e), j) for j, e in enumerate(ends.tolist())
              for s in range(int(ends[j - 1]) if j else 0, e, SHELL)]

    def tiles() -> Iterator[tuple[np.ndarray, int, int]]:
        rows = own[order] if probe is None else probe
        c2 = (c * c).sum(axis=1)[:, None]
        planes = _planes(c, reach)
        for low in range(0, len(rows), CHUNK):
            p = rows[low:low + CHUNK]
            norm = (p * p).sum(axis=1)
            d2 = c @ (-2 * p).T
            d2 += c2
            home = d2.argmin(axis=0)
            side = d2 - d2[home, np.arange(len(p))] <= planes.take(home, axis=1)
            for s, e, j in shells:
                if probe is not None or e > low:
                    near = np.flatnonzero(side[j] & (d2[j] <= np.float32((far[e - 1] + reach) ** 2 + 1e-5) - norm))
                    if probe is None:                   # places from e on meet this shell in theirs
                        near = near[near + low < e]
                    if len(near):
                        yield near + low, s, e

    return order, tiles()


class _Classes:
    """Classes of a task's rows while links are found."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def link(self, x: np.ndarray, y: np.ndarray) -> None:
        u, v = spanning(self.label[x], self.label[y])
        if len(u):
            to = np.arange(len(self.label))
            to[u] = v
            self.label = to[self.label]
            self.links.append((u, v))

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.links:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*self.links))


def sketch_links(own: np.ndarray, probe: np.ndarray | None, d: int, block: int,
                 cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs of packed sketches that can be links: indices of the rows, ``probe`` after ``own``."""
    sl, full = blocks_of(d)[block], blocks_of(d)[-1].stop
    k = sl.stop - sl.start
    rows = own if probe is None else np.concatenate((own, probe))
    z = _numbers(rows, 8, 8 + 2 * k, "<i2").astype(np.float32) / np.float32(32767)
    rest = rows[:, 8 + 2 * k:].view(np.int8)
    step = _limit(full) / 127
    off = math.sqrt(k) / 32767 + 1e-5
    reach = _reach(d, block, cosine, False) + off
    most = (math.sqrt(_budget(cosine)) + math.hypot(off, step * math.sqrt(full - k)) + 1e-5) ** 2
    n = len(own)
    order, tiles = _shells(z[:n], None if probe is None else z[n:], reach)
    at = np.concatenate((order, np.arange(n, len(rows))))           # place -> row
    zo = z[order]
    zp = zo if probe is None else z[n:]
    first = 0 if probe is None else n                               # place of the first probe
    # |v - u|^2 - reach^2 = (v, 1, |v|^2 - reach^2) . (-2 u, |u|^2, 1): one product and one comparison a pair
    right = np.column_stack((-2 * zo, (zo * zo).sum(axis=1), np.ones(n))).astype(np.float32)
    left = np.column_stack((zp, np.ones(len(zp)), (zp * zp).sum(axis=1) - (reach * reach + 1e-5))).astype(np.float32)
    over = np.empty(ROWS * SHELL, np.float32)
    classes, xs, ys, held = _Classes(len(rows)), [], [], 0

    def settle() -> None:
        x, y = at[np.concatenate(xs)], at[np.concatenate(ys)]
        for a in range(0, len(x), 100_000):
            i, j = x[a:a + 100_000], y[a:a + 100_000]
            apart = classes.label[i] != classes.label[j]
            i, j = i[apart], j[apart]
            r = rest[i].astype(np.float32) - rest[j]
            b = z[i] - z[j]
            ok = (b * b).sum(axis=1, dtype=np.float64) + (r * r).sum(axis=1, dtype=np.float64) * step ** 2 <= most
            classes.link(i[ok], j[ok])

    def apart(near: np.ndarray, s: int, e: int) -> np.ndarray:
        """Rows that a shell of one class is not linked with yet."""
        label = classes.label[order[s:e]]
        return near[classes.label[at[first + near]] != label[0]] if _alike(label) else near

    for near, s, e in tiles:
        near, w, shell = apart(near, s, e), e - s, np.ascontiguousarray(right[s:e].T)
        even = -(-len(near) // max(1, -(-len(near) // ROWS)))       # slices of one length
        while len(near):
            some, near = near[:even], near[even:]
            m = len(some) * w
            np.matmul(left.take(some, axis=0), shell, out=over[:m].reshape(-1, w))
            if over[:m].min() <= 0:
                x, y = np.divmod(np.flatnonzero(over[:m] <= 0), w)
                x, y = first + some[x], s + y
                if probe is None:
                    keep = x < y
                    x, y = x[keep], y[keep]
                xs.append(x)
                ys.append(y)
                held += len(x)
                if held > 50_000:
                    settle()
                    xs, ys, held = [], [], 0
                    near = apart(near, s, e)
    if held:
        settle()
    return classes.forest()


def _alike(label: np.ndarray) -> bool:
    return label[0] == label[-1] and bool((label == label[0]).all())


def _join_classes(classes: _Classes, x: np.ndarray, y: np.ndarray, hit: np.ndarray) -> None:
    """Links the rows ``x`` and ``y`` where ``hit`` says, a few rows at a time as long as ``y`` is of several classes."""
    a, step = 0, 16
    while a < len(x):
        label = classes.label[y]
        if _alike(label):
            rest = np.flatnonzero((classes.label[x[a:]] != label[0]) & hit[a:].any(axis=1)) + a
            if len(rest):
                classes.link(x[rest], np.full(len(rest), y[0]))
            return
        i, j = np.nonzero(hit[a:a + step] & (classes.label[x[a:a + step]][:, None] != label))
        if len(i):
            classes.link(x[a + i], y[j])
        a, step = a + step, 2 * step if not len(i) else 16


def _linked(u: np.ndarray, v: np.ndarray, raw_u: np.ndarray, raw_v: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of ``u`` and ``v`` (as float32 unit vectors) are links, near the threshold by the whole numbers."""
    dot = u @ v.T
    band = (u.shape[1] + 8) * (1.2e-7 if dot.dtype == np.float32 else 1e-15)
    hit = dot >= cosine
    x, y = np.divmod(np.flatnonzero(np.abs(dot - cosine) <= band), len(v))
    for a in range(0, len(x), 20_000):
        i, j = x[a:a + 20_000], y[a:a + 20_000]
        hit[i, j] = (unit_rows(raw_u[i]) * unit_rows(raw_v[j])).sum(axis=1) >= cosine
    return hit


def vector_links(own: np.ndarray, probe: np.ndarray | None, d: int,
                 cosine: float) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Of packed whole vectors, the copies of each row's links and a spanning forest: ``probe`` after ``own``."""
    rows = own if probe is None else np.concatenate((own, probe))
    copies, raw = _numbers(rows, 8, 16, "<i8")[:, 0], _numbers(rows, 16, 16 + 4 * d, "<f4")
    n, u = len(own), np.concatenate([unit_rows(raw[a:a + CHUNK]).astype(np.float32) for a in range(0, len(raw), CHUNK)])
    order, tiles = _shells(u[:n], None if probe is None else u[n:], _reach(d, 0, cosine, True))
    at = np.concatenate((order, np.arange(n, len(rows))))
    first = 0 if probe is None else n
    u, raw, copies = u[at], raw[at], copies[at].astype(np.float64)
    total, classes = np.zeros(len(rows)), _Classes(len(rows))
    kind = np.float32 if copies.max() < 1 << 13 else np.float64     # sums of a tile are exact
    copies = copies.astype(kind)
    for near, s, e in tiles:
        for a in range(0, len(near), 1024):
            x = first + near[a:a + 1024]
            hit = _linked(u[x], u[s:e], raw[x], raw[s:e], cosine)
            if probe is None:
                hit &= x[:, None] < np.arange(s, e)
            tile = hit.astype(kind)
            total[x] += tile @ copies[s:e]
            total[s:e] += copies[x] @ tile
            _join_classes(classes, at[x], at[s:e], hit)
    out = np.empty(len(rows), np.int64)
    out[at] = np.rint(total).astype(np.int64)
    return out, classes.forest()


def _meet(nodes: DataFrame, cosine: float, whole: bool) -> list[DataFrame]:
    """Tables (node, links, other) of all rounds, as ``embedding_links`` says; of sketches, links are 0."""
    plan, out = Plan(nodes, cosine, whole), []

    def join(table: pa.Table) -> pa.Table:
        key = table.column("key")[0].as_py()
        unit = int(np.searchsorted(plan.first_key, key, side="right")) - 1
        d, block = plan.unit_of[unit]
        mine, packs = table.column("own").to_numpy(), table.column("pack")
        rows = [np.frombuffer(b"".join(packs.filter(pa.array(mine == own)).to_pylist()), np.uint8)
                .reshape(-1, _width(d, block, whole)) for own in (True, False)]
        node = np.concatenate([_numbers(x, 0, 8, "<i8")[:, 0] for x in rows])
        us, vs, total = [], [], np.zeros(len(node), np.int64)
        met = ([None] if key == plan.first_key[unit] else []) + ([rows[1]] if len(rows[1]) else [])
        for probe in met if len(rows[0]) else []:
            if whole:
                links, (u, v) = vector_links(rows[0], probe, d, cosine)
                total[:len(links)] += links
            else:
                u, v = sketch_links(rows[0], probe, d, block, cosine)
            us.append(node[u])
            vs.append(node[v])
        hit = np.flatnonzero(total)
        u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
        return pa.table({
            "node": pa.array(np.concatenate((node[hit], u)).astype(np.int64)),
            "links": pa.array(np.concatenate((total[hit], np.zeros(len(u), np.int64)))),
            "other": pa.array(np.concatenate((np.zeros(len(hit), np.int64), v)).astype(np.int64),
                              mask=np.concatenate((np.ones(len(hit), bool), np.zeros(len(v), bool))))})

    for span in plan.rounds if plan.unit_of else []:
        found = (_send(nodes, plan, span).groupBy("key")
                 .applyInArrow(join, "node long, links long, other long"))
        out.append(cut(found, "links"))
    return out


def _union(spark: SparkSession, tables: list[DataFrame]) -> DataFrame:
    out = spark.createDataFrame([], "node long, links long, other long") if not tables else tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _edges(found: DataFrame) -> DataFrame:
    return found.where("other IS NOT NULL").select(F.col("node").alias("u"), F.col("other").alias("v"))


def _class_links(classes: DataFrame, cosine: float) -> DataFrame:
    """Rows (node, links, root) of the vectors (node, copies, v, d, component, bucket) of small classes."""
    def run(table: pa.Table) -> pa.Table:
        dims, comp = table.column("d").to_numpy(), table.column("component").to_numpy()
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        order = np.lexsort((node, comp))
        starts = np.flatnonzero(np.r_[True, np.diff(comp[order]) != 0])
        vectors = table.column("v").combine_chunks()
        links, root = np.zeros(len(node), np.int64), node.copy()
        for some in np.split(order, starts[1:]):
            raw = _matrix(vectors.take(pa.array(some)), int(dims[some[0]]))
            u = unit_rows(raw)
            hit = np.concatenate([_linked(u[a:a + 512], u, raw[a:a + 512], raw, cosine) for a in range(0, len(u), 512)])
            hit |= hit.T
            np.fill_diagonal(hit, False)
            links[some] = np.rint(hit @ copies[some].astype(np.float64)).astype(np.int64)
            left = np.ones(len(some), bool)
            for i in range(len(some)):
                if left[i]:                             # the least node of its class
                    new = hit[i] & left
                    left[i] = False
                    while new.any():
                        root[some[new]] = node[some[i]]
                        left &= ~new
                        new = hit[new].any(axis=0) & left
        return pa.table({"node": node, "links": links, "root": root})

    return classes.groupBy("bucket").applyInArrow(run, "node long, links long, root long")


def embedding_links(nodes: DataFrame, cosine: float = 0.95) -> DataFrame:
    """Of distinct vectors (node, copies, v, d): rows (node, links, root) of those that may have links.

    ``links`` sums the copies of directly linked other nodes, ``root`` is the least node of the class.  All
    links are counted where they are found, none is sent but those of spanning forests.
    """
    spark = nodes.sparkSession
    rounds = _meet(nodes, cosine, whole=False)
    comp = cut(components(_edges(_union(spark, rounds))), "classes")
    release(*rounds)
    large = cut(comp.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > CLASS_ROWS)
                .select("component"), "large")
    d, n = nodes.agg(F.max("d"), F.count("*")).first()
    linked = comp.count()
    buckets = max(16, linked * (4 * (d or 1) + 24) // BUCKET_BYTES)
    small = (comp.join(large, "component", "left_anti")
             .withColumn("bucket", F.pmod(F.xxhash64("component"), F.lit(buckets))))
    turns = max(1, -(-2 * linked // max(1, n)))         # half of the vectors a round, beside the shuffle that finds them
    settled = []
    for turn in range(turns):
        some = small.where(F.pmod("bucket", F.lit(turns)) == turn)
        settled.append(cut(_class_links(nodes.select("node", "copies", "v", "d").join(some, "node"), cosine), "settled"))
    out = settled[0]
    for t in settled[1:]:
        out = out.unionByName(t)
    if not large.isEmpty():
        members = cut(nodes.select("node", "copies", "v", "d")
                      .join(comp.join(large, "component", "left_semi").select("node"), "node"), "members")
        rounds = _meet(members, cosine, whole=True)
        found = _union(spark, rounds)
        links = found.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
        settled = (members.select("node").join(links, "node", "left").join(components(_edges(found)), "node", "left")
                   .select("node", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("root")))
        out = out.unionByName(cut(settled, "settled"))
        release(members, *rounds)
    return out


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a query shuffles is removed at its end, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _packed(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (id, v): the vector's float32 bytes, null where it links with nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            counts = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            x = lists.flatten().cast(pa.float32(), safe=False).to_numpy(zero_copy_only=False) + np.float32(0)  # -0.0 is 0.0
            row = np.repeat(np.arange(len(counts)), counts)
            fine = np.bincount(row, weights=~np.isfinite(x), minlength=len(counts)) == 0
            fine &= np.bincount(row, weights=x != 0, minlength=len(counts)) > 0
            x, counts = x[fine[row]], np.where(fine, counts, 0)
            ends = np.r_[0, 4 * np.cumsum(counts)].astype(np.int32)
            v = pa.Array.from_buffers(pa.binary(), len(counts), [pa.array(fine).buffers()[1], pa.py_buffer(ends),
                                                                 pa.py_buffer(np.ascontiguousarray(x, np.float32))])
            yield pa.RecordBatch.from_arrays([b.column(0), v], names=["id", "v"])

    kind = vectors.schema[id_col].dataType
    return (vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("x"))
            .mapInArrow(run, T.StructType([T.StructField("id", kind), T.StructField("v", T.BinaryType())])))


def _digest(v):
    return F.xxhash64(v)


def embedding_duplicates(vectors: DataFrame, *, cosine: float = 0.95, id_col: str = "vec_id",
                         vector_col: str = "embedding") -> DataFrame:
    """Per row: the id, n_links, component_id (smallest id reachable) and kept (id = component_id).

    Vectors that are null, empty, zero or hold null or non-finite numbers link with
    nothing: 0 links and their own component.  Vectors of different lengths do not
    link.  Equal vectors are one node with a number of copies; copies link with each other.  A null id
    is in no component's minimum and is not kept; repeated ids are rows of their own.

    ``vectors`` is read twice, for the classes and for the rows that they are given to.
    """
    if not 0.0 < cosine <= 1.0:
        raise ValueError("the cosine must be in (0, 1]")
    rows = _packed(vectors, id_col, vector_col).withColumn("h", F.when(F.col("v").isNotNull(), _digest("v")))
    with _shuffles_removed(vectors.sparkSession):
        groups = rows.where("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
        nodes = cut(groups.select(F.monotonically_increasing_id().alias("node"), "copies", "least", "v",
                                  (F.length("v") / 4).cast("int").alias("d"), _digest("v").alias("h")), "nodes")
        found = embedding_links(nodes, cosine)
        # rows find their class by a digest of the vector; where distinct vectors share it, by the vector too
        clash = cut(nodes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h", F.lit(True).alias("clash")), "clash")
        told = lambda df: df.join(clash, "h", "left").withColumn(                                       # noqa: E731
            "w", F.when(F.col("clash"), F.col("v")).otherwise(F.lit(b"")))
        named = (told(nodes).select("node", "h", "w", "copies", "least").join(found, "node", "left")
                 .withColumn("root", F.coalesce("root", "node")))
        least = named.groupBy("root").agg(F.min("least").alias("component_id"))
        classes = cut(named.join(least, "root").select(
            "h", "w", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "classes")
        release(nodes)
    out = told(rows).drop("v").join(classes, ["h", "w"], "left")
    # a vector that links with nothing is its own component
    component = F.when(F.coalesce("n_links", F.lit(0)) > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
