"""SimHash near-duplicates (operator 4) by the generalised pigeonhole principle.

Fingerprints within ``distance`` bits agree, in at least one of ``parts``
groups of bits, up to that group's threshold, when the thresholds sum to
``distance - parts + 1`` (a threshold of -1 leaves its group out).  Correlated
bits go into one group, so the groups differ in how well they select, and
dynamic programming gives each group the threshold that keeps the estimated
candidates fewest.  Fingerprints then probe their groups' buckets and every
candidate is verified on all 64 bits.

A bucket with too many fingerprints is not compared pair by pair: its
fingerprints agree on the group's bits, so the same principle splits the
remaining bits again, until every bucket is small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomlake.llm.common import cut, texts
from roomlake.llm.components import components

BUCKET_ROWS = 1500
PROBE_COST = 200.0          # a bucket row's shuffle and sort, in comparisons of two fingerprints
_BITS = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.int64)   # byte -> its bits, low first
_LANES = (np.arange(8) * 256).astype(np.int64)


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the text's word shingles (A-Z lower-cased, ASCII-separated words)."""
    words = text.encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    h = np.fromiter((digest(line[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[k - 1:].tolist())),
                    np.uint64, n)
    per_byte = np.bincount((h.view(np.uint8).reshape(-1, 8) + _LANES).ravel(), minlength=2048).reshape(8, 256)
    ones = (per_byte @ _BITS).ravel()
    return int(sum(1 << int(i) for i in np.flatnonzero(2 * ones > n)))


def fingerprints(docs: DataFrame, *, shingle: int = 3, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: the id, ``text_hash`` and ``fp`` (long, the 64 bits signed).  Null or wordless text: zero."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.xxhash64(text_col).alias("h"))
    schema = T.StructType([T.StructField(id_col, src.schema["id"].dataType), T.StructField("text_hash", T.LongType()),
                           T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in texts(b.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fps.view(np.int64), pa.int64())],
                                             names=schema.names)

    return src.mapInArrow(run, schema)


def _unpack(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype(np.int64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often each two bits are set together (64 x 64), over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64)), 0
        for b in batches:
            x = _unpack(b.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            total += x.T @ x
            n += len(x)
        flat = np.concatenate(([n], total.ravel())).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4097), pa.int32()), pa.array(flat, pa.int64())],
                                         names=["cell", "n"])

    rows = fps.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(4097)
    for r in rows:                                      # 4,097 rows at any input size
        flat[r["cell"]] = r["n"]
    return int(flat[0]), flat[1:].reshape(64, 64)


def group_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups: the most correlated bits share one; groups even out their entropy."""
    p = np.clip(np.diag(together) / max(n, 1), 1e-9, 1 - 1e-9)
    spread = np.sqrt(p * (1 - p))
    corr = np.abs(together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    entropy = -(p * np.log2(p) + (1 - p) * np.log2(1 - p))
    clusters = {i: [i] for i in range(64)}
    home = list(range(64))
    most = 64 // (2 * parts)
    pairs = sorted(((corr[i, j], i, j) for i in range(64) for j in range(i)), reverse=True)
    for _, i, j in pairs:
        a, b = home[i], home[j]
        if a != b and len(clusters[a]) + len(clusters[b]) <= most:
            for x in clusters[b]:
                home[x] = a
            clusters[a] += clusters.pop(b)
    groups: list[list[int]] = [[] for _ in range(parts)]
    for c in sorted(clusters.values(), key=lambda c: (-entropy[c].sum(), c)):
        min(groups, key=lambda g: (entropy[g].sum() if g else 0.0, len(g))).extend(c)
    return [sorted(g) for g in groups]


def _mask(bits: list[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >= 1 << 63 else m         # as a signed long


def allocate(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds (from -1) that sum to ``total`` at the least summed cost; ``costs[i][t + 1]`` is of threshold t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for s, (c, chosen) in best.items():
            for t, cost in enumerate(row, start=-1):
                new = (c + cost, [*chosen, t])
                if s + t not in step or new < step[s + t]:
                    step[s + t] = new
        best = step
    return best[total][1]


def plan_parts(fps: DataFrame, distance: int, parts: tuple[int, ...]) -> list[tuple[list[int], int]]:
    """Bit groups with their thresholds, from statistics over all of ``fps`` (distinct).

    Tries each number of groups in ``parts`` and keeps the plan of least estimated cost.
    """
    n, together = bit_statistics(fps)
    p = np.diag(together) / max(n, 1)
    differ = 2 * p * (1 - p) / (p * p + (1 - p) * (1 - p))     # odds that a bit differs between two rows
    options = {m: group_bits(n, together, m) for m in parts}
    keys = [(100 * m + i, g) for m, groups in options.items() for i, g in enumerate(groups)]
    same = fps.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_mask(g))).alias("key"))
        for i, g in keys])).alias("x")).groupBy("x.part", "x.key").count()
    pairs = {r["part"]: float(r["pairs"] or 0) for r in
             same.groupBy("part").agg((F.sum(F.expr("count * (count - 1.0D)")) / 2).alias("pairs")).collect()}
    best = None
    for m, groups in options.items():
        costs = []
        for i, g in enumerate(groups):
            # elementary symmetric sums: odds of exactly e differing bits, relative to none
            sums = [1.0, *[0.0] * distance]
            for b in g:
                for e in range(distance, 0, -1):
                    sums[e] += sums[e - 1] * float(differ[b])
            row, candidates, probes = [0.0], 0.0, 0.0
            for e in range(distance + 1):
                candidates += pairs.get(100 * m + i, 0.0) * sums[e]
                probes += n * float(len(g) ** e)
                row.append(candidates + PROBE_COST * probes)
            costs.append(row)
        chosen = allocate(costs, distance - m + 1)
        cost = sum(row[t + 1] for row, t in zip(costs, chosen))
        if best is None or cost < best[0]:
            best = (cost, list(zip(groups, chosen)))
    return best[1]


def _flips(bits: list[int], most: int) -> np.ndarray:
    """All values with 1 to ``most`` of ``bits`` set."""
    out, layer = [], [(0, -1)]
    for _ in range(most):
        layer = [(v | 1 << b, k) for v, at in layer for k, b in enumerate(bits) if k > at]
        out += [v for v, _ in layer]
    return np.array(out, dtype=np.uint64)


def _probe_rows(fps: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """Bucket rows: each fingerprint under its own key and, as a probe, under all keys within the threshold."""
    steps = [(np.uint64(_mask(g) & (1 << 64) - 1), _flips(g, t), i) for i, (g, t) in enumerate(plan) if t >= 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for mask, flips, i in steps:
                key = fp & mask
                for flip in [np.uint64(0), *flips]:
                    k = len(fp)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k, i, np.int64)), pa.array((key ^ flip).view(np.int64)),
                         pa.array(np.full(k, mask, np.uint64).view(np.int64)), pa.array(fp.view(np.int64)),
                         pa.array(np.full(k, flip == 0))], names=["part", "key", "used", "fp", "own"])

    return fps.select("fp").mapInArrow(run, "part long, key long, used long, fp long, own boolean")


def _split_bucket(rows: DataFrame, distance: int) -> DataFrame:
    """Re-key the rows of too large buckets by one of ``distance + 1`` slices of the bits not yet used.

    Two fingerprints within ``distance`` agree on at least one slice whole.
    """
    ways = distance + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, key, used, fp = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            for u in np.unique(used):
                at = np.flatnonzero(used == u)
                left = [i for i in range(64) if not int(u) >> i & 1]
                for w in range(ways):
                    bits = left[w * len(left) // ways:(w + 1) * len(left) // ways]
                    m = np.int64(_mask(bits))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part[at]), pa.array(key[at]), pa.array(np.full(len(at), w, np.int32)),
                         pa.array(fp[at] & m), pa.array(np.full(len(at), u | m)), pa.array(fp[at]),
                         b.column(4).take(pa.array(at))],
                        names=["part", "key", "way", "slice", "used", "fp", "own"])

    keyed = rows.mapInArrow(
        run, "part long, key long, way int, slice long, used long, fp long, own boolean")
    return keyed.select(F.xxhash64("part", "key", "way").alias("part"),
                        F.xxhash64("key", "slice").alias("key"), "used", "fp", "own")


def _verify(rows: DataFrame, distance: int) -> DataFrame:
    """Links of a spanning forest within each (small) bucket; candidates are compared on all 64 bits."""
    def links(own: np.ndarray, every: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(own) == 0 or len(every) < 2:
            return own[:0], own[:0]
        near = np.bitwise_count(own[:, None] ^ every[None, :]) <= distance
        near &= own[:, None] != every[None, :]
        a, b = np.nonzero(near)
        return spanning(own[a], every[b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in _buckets(batches):
            part, key, fp, own = cols
            new = np.flatnonzero((np.diff(part) != 0) | (np.diff(key) != 0)) + 1
            us, vs = [], []
            for a, b in zip([0, *new], [*new, len(part)]):
                if b - a > 1:
                    u, v = links(fp[a:b][own[a:b]], np.unique(fp[a:b]))
                    us.append(u)
                    vs.append(v)
            if us:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(us).view(np.int64)), pa.array(np.concatenate(vs).view(np.int64))],
                    names=["u", "v"])

    dealt = rows.select("part", "key", "fp", "own").repartition("part", "key").sortWithinPartitions("part", "key")
    return dealt.mapInArrow(run, "u long, v long")


def _buckets(batches: Iterator[pa.RecordBatch]):
    """Column arrays holding whole buckets: the last bucket of a batch waits for the next batch."""
    rest = None
    for b in batches:
        cols = [b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False),
                b.column(2).to_numpy(zero_copy_only=False).view(np.uint64),
                b.column(3).to_numpy(zero_copy_only=False)]
        if rest is not None:
            cols = [np.concatenate(x) for x in zip(rest, cols)]
        if len(cols[0]) == 0:
            continue
        last = int(np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))[-1]) + 1 \
            if (cols[0][0] != cols[0][-1] or cols[1][0] != cols[1][-1]) else 0
        rest = [c[last:] for c in cols]
        if last:
            yield [c[:last] for c in cols]
    if rest is not None and len(rest[0]):
        yield rest


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of ``u - v`` reduced to one from each node to its class's smallest node."""
    nodes, flat = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = flat[:len(u)], flat[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def hamming_links(fps: DataFrame, distance: int = 2, parts: tuple[int, ...] = (2, 3, 4)) -> DataFrame:
    """Links ``u, v`` that connect all fingerprints (``fp``: distinct longs) within ``distance`` bits.

    Every link is verified; links of one bucket are thinned to a spanning
    forest, so classes are whole while a class of n sends n - 1 links.
    """
    rows = _probe_rows(fps, plan_parts(fps, distance, parts))
    found = None
    while True:
        rows = cut(rows, "probes")
        sizes = rows.groupBy("part", "key").agg(F.count("*").alias("n"), F.max("own").alias("_own"))
        some = sizes.where("n > 1 AND _own").select("part", "key", (F.col("n") > BUCKET_ROWS).alias("large"))
        kept = cut(rows.join(some, ["part", "key"]), "buckets")
        links = cut(_verify(kept.where("NOT large"), distance), "links")
        found = links if found is None else found.unionByName(links)
        large = kept.where("large")
        if large.isEmpty():
            return found
        rows = _split_bucket(large.select("part", "key", "used", "fp", "own"), distance)


def simhash_groups(docs: DataFrame, *, shingle: int = 3, seed: int = 42, distance: int = 2,
                   parts: tuple[int, ...] = (2, 3, 4), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``text_hash``, ``fp``, ``root`` (its class) and ``component_id`` (smallest id reachable).

    Null and wordless texts have fingerprint zero and link like any other.
    Equal fingerprints are one node, so copies of any number cost one.  Null ids count
    for no component's smallest id (null if there is no other).
    """
    fps = cut(fingerprints(docs, shingle=shingle, seed=seed, id_col=id_col, text_col=text_col), "fingerprints")
    nodes = cut(fps.groupBy("fp").agg(F.min(id_col).alias("least")), "nodes")
    comp = components(hamming_links(nodes.select("fp"), distance, parts))
    named = (nodes.join(comp, nodes.fp == comp.node, "left")
             .select(nodes.fp, "least", F.coalesce("component", nodes.fp).alias("root")))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(least, "root").select("fp", "root", "component_id")
    return fps.join(classes, "fp").select(id_col, "text_hash", "fp", "root", "component_id")


def keep_one_per_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each SimHash class, all columns: the smallest id (nulls last), then text hash.

    Of fully repeated rows one stays.
    """
    groups = simhash_groups(docs, id_col=id_col, text_col=text_col, **options)
    chosen = groups.groupBy("root").agg(
        F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                       F.col("text_hash").alias("h"))).alias("m")).select(F.col("m.id").alias("_id"), F.col("m.h").alias("_h"))
    rows = docs.withColumn("_text_hash", F.xxhash64(text_col))
    kept = rows.join(chosen.distinct(), rows[id_col].eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_h")),
                     "left_semi")
    return kept.dropDuplicates([id_col, "_text_hash"]).select(*docs.columns)
