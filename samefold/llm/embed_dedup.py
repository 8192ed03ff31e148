"""Near-duplicate embeddings by counting collisions of projections.

A pair within the cosine bound has a short difference, so on a random
one-dimensional projection its two values fall into a window centred on either
of them.  A pair that collides on enough of ``PROJECTIONS`` projections is
verified by its cosine in double precision; the count is calibrated by
simulation for pairs that lie exactly on the bound.

Counting over all pairs would be quadratic, and any one window holds a large
share of all vectors, so counting is confined to vectors that share a cell.  A
table draws ``k`` random rotations; a vector's cell names, for each of them, the
projection of largest magnitude and its sign.  Near vectors agree on it far more
often than others do (0.6 against 0.006 in 64 dimensions), so that the number of
tables that ``RECALL`` asks for hardly grows with the number of vectors.  ``k``
is chosen by the expected cost of the rows that have to move.

Cells and members are counted as narrow rows; a vector is sent only to cells
that it shares with others.  A crowded cell is dealt as a grid of ``QUERIES``
queries by ``SLICE`` members, so no task gets more, and each grid cell sends on
a forest of its links and counts, never its pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different length do not link; equal
vectors are one class whose members link with each other; rows with equal ids are
one vector, the sound one of least digest, and give one row; null ids are
ignored; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samefold.llm import common
from samefold.llm.components import connected_components

BOUND = 0.95
RECALL = 0.999
PROJECTIONS = 32
#: Window half-width, in deviations of a bounding pair's difference.
WINDOW = 2.5
#: Queries and members of a crowded cell that are compared with each other in one go.
QUERIES, SLICE = 512, 512
#: Roles of a row in its group: both sides of a whole cell, or one side of a grid cell.
BOTH, QUERY, PAST = 2, 1, 0
#: Pairs checked at once, and rows of whole cells taken together.
PAIRS, TOGETHER = 50_000, 4096
#: Bytes of a counted cell row, and of a vector's row beside its components.
NARROW, WIDE = 16, 100
#: Vectors whose projections are computed at once.
BLOCK = 256
#: Rows that one task of the comparison gets.
TASK_ROWS = 50_000
SEED = 11


def directions(dim: int, count: int, seed: int) -> np.ndarray:
    """Unit directions, orthogonal within each run of ``dim``."""
    rng = np.random.default_rng([seed, dim])
    runs = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-count // dim))]
    return np.concatenate(runs, axis=1)[:, :count]


def spread(dim: int, bound: float) -> float:
    """Deviation, along a random direction, of the difference of a bounding pair."""
    return math.sqrt(2 * (1 - bound) / dim)


@functools.lru_cache
def needed_count(dim: int, bound: float, recall=RECALL) -> int:
    """Largest collision count that pairs on the bound reach with ``recall``."""
    g = directions(dim, PROJECTIONS, SEED)
    u = np.random.default_rng(5).standard_normal((20_000, dim))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    hits = (np.abs(u @ g) * math.sqrt(2 * (1 - bound)) <= WINDOW * spread(dim, bound)).sum(axis=1)
    return int(np.quantile(hits, 1 - recall, method="lower"))


def extreme(y: np.ndarray) -> np.ndarray:
    """Index and sign of the projection of largest magnitude, along the last axis."""
    at = np.abs(y).argmax(axis=-1)
    top = np.take_along_axis(y, at[..., None], -1)[..., 0]
    return 2 * at + (top > 0)


@functools.lru_cache
def agreement(dim: int, bound: float) -> tuple[float, float]:
    """Chance that pairs on the bound, and unrelated pairs, share their extreme."""
    rng = np.random.default_rng(3)
    u, v = rng.standard_normal((2, 20_000, dim))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    v -= (u * v).sum(axis=1, keepdims=True) * u
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    near = bound * u + math.sqrt(1 - bound * bound) * v
    hits = [float((extreme(u @ g) == extreme(near @ g)).mean()) for g in (directions(dim, dim, 100 + i) for i in range(4))]
    return float(np.mean(hits)), 1 / (2 * dim)


def tables(n: int, dim: int, bound: float, recall=RECALL) -> tuple[int, int]:
    """(rotations a cell, number of tables) of the least expected traffic for ``n`` vectors."""
    near, far = agreement(dim, bound)
    best = None
    for k in range(1, 16):
        count = max(1, math.ceil(math.log(1 - recall) / math.log(max(1e-12, 1 - near**k)))) if near < 1 else 1
        company = n * far**k
        cost = count * (NARROW + (1 - math.exp(-company)) * (WIDE + 4 * dim) + company * 2)
        if best is None or cost < best[0]:
            best = (cost, k, count)
    return best[1:]


def _hashed(batches, dim, k, n_tables):
    """(id, n, cells, vec): the cell of a vector in every table, as 32-bit numbers."""
    turns = directions(dim, dim * k * n_tables, SEED + 1).astype(np.float32)
    mix = np.random.default_rng(SEED + 3).integers(1, 1 << 62, k, dtype=np.int64) | 1
    for b in batches:
        for lo in range(0, b.num_rows, BLOCK):
            part = b.slice(lo, BLOCK)
            x = np.stack(part.column(2).to_numpy(zero_copy_only=False)).astype(np.float64)
            unit = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
            at = np.stack([extreme((unit @ turns[:, t * dim * k : (t + 1) * dim * k]).reshape(len(x), k, dim)) for t in range(n_tables)], axis=1)
            with np.errstate(over="ignore"):
                key = ((at + 1) * mix).sum(axis=2)
                key ^= key >> 29
                key = (key * 0x5851F42D4C957F2D >> 32).astype(np.int32)
            raw = x.astype(np.float32) if (x.astype(np.float32) == x).all() else x
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([c.tobytes() for c in key], pa.binary()), pa.array([v.tobytes() for v in raw], pa.binary())], ["id", "n", "cells", "vec"])


def _narrow(batches):
    """(tab, cell, id) of every vector and table."""
    for b in batches:
        key = np.frombuffer(b"".join(b.column(1).to_pylist()), np.int32).reshape(b.num_rows, -1)
        n = key.shape[1]
        yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(n, dtype=np.int32), len(key))), pa.array(key.ravel()), b.column(0).take(pa.array(np.repeat(np.arange(len(key)), n)))], ["tab", "cell", "id"])


def forest(linked: np.ndarray) -> list[tuple[int, int, bool]]:
    """Edges (row, row or column, is a column) that connect what ``linked`` connects."""
    rows_seen, cols_seen = np.zeros(linked.shape[0], bool), np.zeros(linked.shape[1], bool)
    out: list[tuple[int, int, bool]] = []
    for start in np.flatnonzero(linked.any(axis=1)).tolist():
        if rows_seen[start]:
            continue
        rows_seen[start] = True
        front = np.asarray([start])
        while len(front):
            cols = np.flatnonzero(linked[front].any(axis=0) & ~cols_seen)
            cols_seen[cols] = True
            out.extend((start, c, True) for c in cols.tolist())
            front = np.flatnonzero(linked[:, cols].any(axis=1) & ~rows_seen) if len(cols) else np.zeros(0, int)
            rows_seen[front] = True
            out.extend((start, r, False) for r in front.tolist())
    return out


class _Checker:
    """Collision counts and cosines of pairs of members of cells."""

    def __init__(self, dim: int, bound: float):
        self.dim, self.bound = dim, bound
        self.g = directions(dim, PROJECTIONS, SEED)
        self.least, self.window = needed_count(dim, bound), np.float32(WINDOW * spread(dim, bound))

    def members(self, rows):
        """(ids, mult, cells, unit vectors, projections) of (id, n, cells, vec) columns."""
        ids, mult, cells, raw = rows
        wide = [len(v) == 8 * self.dim for v in raw]
        if not any(wide):
            x = np.frombuffer(b"".join(raw), np.float32).reshape(-1, self.dim).astype(np.float64)
        else:
            x = np.stack([np.frombuffer(v, np.float64 if w else np.float32) for v, w in zip(raw, wide)]).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        return np.asarray(ids), np.asarray(mult), np.frombuffer(b"".join(cells), np.int32).reshape(len(x), -1), x, (x @ self.g).astype(np.float32)

    def linked(self, left, right, tab, q, d):
        """The pairs (q, d) that collide enough, were not counted in an earlier table, and verify."""
        found = []
        for lo in range(0, len(q), PAIRS):
            i, j = q[lo : lo + PAIRS], d[lo : lo + PAIRS]
            on = left[0][i] != right[0][j]
            i, j = i[on], j[on]
            on = (np.abs(left[4][i] - right[4][j]) <= self.window).sum(axis=1) >= self.least
            i, j = i[on], j[on]
            for t in range(int(tab[i].max(initial=0))):
                on = (tab[i] <= t) | (left[2][i, t] != right[2][j, t])
                i, j = i[on], j[on]
            on = np.einsum("ij,ij->i", left[3][i], right[3][j]) >= self.bound
            found.append((i[on], j[on]))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 2


def _grid(check: _Checker, tab: int, head, streams, out):
    """A chunk of queries of a crowded cell against the slice of members that streams past it."""
    left = check.members(head)
    n = len(left[0])
    links = np.zeros(n, np.int64)
    tabs = np.full(n, tab)
    for rows in streams:
        right = check.members(rows)
        m = len(right[0])
        step = max(1, PAIRS // m)
        linked = np.zeros((n, m), bool)
        for lo in range(0, n, step):
            q = np.repeat(np.arange(lo, min(n, lo + step)), m)
            i, j = check.linked(left, right, tabs, q, np.tile(np.arange(m), len(q) // m))
            np.add.at(links, i, right[1][j])
            linked[i, j] = True
        for a, b, column in forest(linked):
            out.append((int(left[0][a]), int(right[0][b] if column else left[0][b]), 0))
    out.extend((int(left[0][i]), None, int(links[i])) for i in np.flatnonzero(links))


def _cells(check: _Checker, tab, group, rows, out):
    """Whole cells side by side; ``group`` numbers the rows' cells from 0 on, in order."""
    part = check.members(rows)
    sizes = np.bincount(group)
    starts = np.cumsum(sizes) - sizes
    per_row = sizes[group]
    ends = np.cumsum(per_row)
    links = np.zeros(len(group), np.int64)
    hits = []
    lo = 0
    while lo < len(group):  # pairs of a run of rows at a time
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - per_row[lo] + PAIRS, side="right")))
        n = per_row[lo:hi]
        q = np.repeat(np.arange(lo, hi), n)
        d = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[group[lo:hi]], n)
        i, j = check.linked(part, part, tab, q, d)
        np.add.at(links, i, part[1][j])
        hits.append((i, j))
        lo = hi
    i, j = (np.concatenate(x) for x in zip(*hits))
    at = np.searchsorted(group[i], np.arange(len(sizes) + 1))
    for g in np.flatnonzero(np.diff(at)).tolist():
        linked = np.zeros((sizes[g], sizes[g]), bool)
        linked[i[at[g] : at[g + 1]] - starts[g], j[at[g] : at[g + 1]] - starts[g]] = True
        ids = part[0][starts[g] : starts[g] + sizes[g]]
        out.extend((int(ids[a]), int(ids[b]), 0) for a, b, _ in forest(linked) if a != b)
    out.extend((int(part[0][i]), None, int(links[i])) for i in np.flatnonzero(links))


def _count(batches, dim, bound):
    """(u, v, links) of rows in the order of (tab, cell, chunk, slice, falling role)."""
    check = _Checker(dim, bound)
    whole, rest = [], None  # whole cells to do together; rows of the group that is still open

    def flush(out):
        if whole:
            tabs, sizes = zip(*((g[0], len(g[1][0])) for g in whole))
            rows = [sum((g[1][c] for g in whole), []) for c in range(4)]
            _cells(check, np.repeat(tabs, sizes), np.repeat(np.arange(len(sizes)), sizes), rows, out)
            whole.clear()

    def close(group, out):
        key, roles = group
        if BOTH in roles:
            whole.append((key[0], roles[BOTH][0]))
            if sum(len(g[1][0]) for g in whole) >= TOGETHER:
                flush(out)
        elif QUERY in roles and PAST in roles:
            _grid(check, key[0], roles[QUERY][0], roles[PAST], out)

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["u", "v", "links"])

    for b in batches:
        out: list = []
        keys = [b.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        change = np.zeros(max(0, b.num_rows - 1), bool)
        for c in keys:
            change |= c[1:] != c[:-1]
        cuts = np.flatnonzero(change) + 1
        cols = [b.column(i).to_pylist() for i in range(5, 9)]
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
            key, role = tuple(int(c[lo]) for c in keys[:4]), int(keys[4][lo])
            if rest is None or key != rest[0]:
                if rest is not None:
                    close(rest, out)
                rest = (key, {})
            parts = rest[1].setdefault(role, [[[], [], [], []]])
            for c, v in zip(parts[0], cols):
                c.extend(v[lo:hi])
        if out:
            yield batch(out)
    out = []
    if rest is not None:
        close(rest, out)
    flush(out)
    if out:
        yield batch(out)


def _links(part: DataFrame, dim: int, bound: float, recall: float) -> DataFrame:
    """(u, v, links) of the classes ``part`` (id, n, x) of one length, staged."""
    spark = part.sparkSession
    k, n_tables = tables(part.count(), dim, bound, recall)
    hashed = common.staged(part.select("id", "n", "x").mapInArrow(common.tidied(lambda b: _hashed(b, dim, k, n_tables)), "id long, n long, cells binary, vec binary"), "hashed")
    narrow = hashed.select("id", "cells").mapInArrow(common.tidied(_narrow), "tab int, cell int, id long")
    crowd = narrow.groupBy("tab", "cell").agg(F.count("*").alias("m")).where("m > 1")
    crowd = common.staged(crowd.select("tab", "cell", "m", F.ceil(F.col("m") / QUERIES).cast("int").alias("chunks"), F.ceil(F.col("m") / SLICE).cast("int").alias("slices")), "crowd")
    size = crowd.agg(F.sum(F.col("m") * (F.col("chunks") + F.col("slices")))).first()[0] or 0
    # the cells of a vector that others share, then the vector once for each
    at = common.join_small(narrow, crowd, ["tab", "cell"])
    own = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    mine = F.pmod(F.xxhash64("id", F.lit(1)), F.col("slices")).cast("int")

    def role(chunk, part, what):
        return F.struct(chunk.alias("chunk"), part.alias("slice"), F.lit(what).alias("role"))

    grid = F.concat(F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda i: role(own, i, QUERY)), F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda i: role(i, mine, PAST)))
    alone = (F.col("chunks") == 1) & (F.col("slices") == 1)
    at = at.select("id", F.explode(F.when(alone, F.array(role(F.lit(0), F.lit(0), BOTH))).otherwise(grid)).alias("g"), "tab", "cell")
    dealt = at.join(hashed, "id").select("tab", "cell", "g.chunk", "g.slice", "g.role", "id", "n", "cells", "vec")
    dealt = dealt.repartition(common.parts(spark, size, TASK_ROWS), "tab", "cell", "chunk", "slice").sortWithinPartitions("tab", "cell", "chunk", "slice", F.desc("role"))
    found = common.staged(dealt.mapInArrow(common.tidied(lambda b: _count(b, dim, bound)), "u long, v long, links long"), "links")
    common.dispose(hashed)
    common.dispose(crowd)
    return found


def dedup(vectors: DataFrame, bound=BOUND, id_col="vec_id", vec_col="embedding", recall=RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row with an id."""
    spark = vectors.sparkSession
    common.configure(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x")).where("id IS NOT NULL")
    fine = F.col("x").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0)
    rows = rows.withColumn("class", F.when(F.coalesce(fine, F.lit(False)), F.sha2(F.concat_ws(",", F.transform("x", lambda v: v.cast("string"))), 256)))
    rows = common.staged(rows, "vectors")
    many = common.staged(rows.groupBy("id").agg(F.count("*").alias("k")).where("k > 1").select("id"), "repeated")
    if not many.isEmpty():
        once = common.join_small(rows, many, "id", "left_semi").groupBy("id").agg(F.min_by("x", "class").alias("x"), F.min("class").alias("class"))
        whole = rows
        rows = common.staged(common.join_small(whole, many, "id", "left_anti").unionByName(once), "vectors")
        common.dispose(whole)
    common.dispose(many)
    sound = rows.where("class IS NOT NULL")
    classes = sound.groupBy("class").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.min_by("x", "id").alias("x"))
    classes = common.staged(classes, "classes")
    dims = [r[0] for r in classes.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).where("n > 1").select("d").collect()]  # vectors of one table have few lengths
    parts = [_links(classes.where(F.size("x") == dim), dim, bound, recall) for dim in dims]
    found = functools.reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "u long, v long, links long")
    counts = found.groupBy("u").agg(F.sum("links").alias("links"))
    comps = connected_components(found.where("v IS NOT NULL").select("u", "v"))
    known = classes.select("class", F.col("id").alias("rep"), "n").join(counts.withColumnRenamed("u", "rep"), "rep", "left").join(comps.toDF("rep", "component"), "rep", "left")
    known = common.staged(known.select("class", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")), "known")
    for old in (*parts, classes, comps):
        common.dispose(old)
    out = rows.select("id", "class").join(known, "class", "left")
    comp = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), comp.alias("component_id"), (F.col("id") == comp).alias("kept"))
