"""Best-fit packing by a configuration linear program over the length histogram.

The histogram has at most ``capacity`` distinct lengths whatever the corpus
size, so the covering program (one variable per way to fill a sequence) is
solved on the driver: multiplicative weights keep a price per length class, one
pass of a knapsack dynamic program prices every room, which gives the most
valuable fill around each class, and a round buys these fills for the classes
that lag.  The fractional counts are rounded down.  A sequence of the plan takes
the exact lengths of its classes so that it is full, or goes without its last
piece and stays open.  What the rounding leaves is placed best-fit, still by
histogram counts, into the open sequences first.  A price of length over capacity
is feasible for the dual, so all tokens over the capacity are a lower bound; if a
plan does not meet it, less of the program is kept, down to a thirtieth, and the
best plan counts.  The plan is a bounded table of rank intervals; every piece finds its
place from its rank among the pieces of its length.  Pieces of a length are ranked by
a hash, and sequences are numbered in a scattered order, so that neither neighbours of
the corpus nor sequences of one plan stand together.

Defined results: a null or empty text is one piece holding only the end id; a
document longer than ``capacity`` is cut into full pieces and a last shorter
one; pieces of equal length are interchangeable and ranked by hash, then document and piece;
repeated rows are packed once per row; null ids are kept as null; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from samefold.llm import common, tokens

CAPACITY = 4096
END_ID = 1
#: Width of a length class in the program, and the number of lengths up to which each is
#: a class of its own; sequences take exact lengths.
CLASS_WIDTH, EXACT_KINDS = 8, 600
#: Pieces up to this share of the capacity stay out of the program and fill the
#: room it leaves, as in the asymptotic schemes for bin packing.
SMALL_SHARE = 8
#: Rounds of the multiplicative-weights solver and its step size.
ROUNDS, STEP = 24, 0.25
#: Parts of the program's counts that are kept, in the order they are tried.
KEPT = (1.0, 0.7, 0.4, 0.2, 0.1, 0.03)
#: Pieces ranked together; a length with more is split into salted parts.
RANK_GROUP = 128
SEED = 6


def token_pieces(docs: DataFrame, id_col="doc_id", text_col="text", capacity=CAPACITY, end_id=END_ID, tokenizer: str | None = None) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32) of every document."""
    common.configure(docs.sparkSession)

    def cut(batches):
        tok = tokens.load(tokenizer)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            rows = ([], [], [], [], [])
            for lo, hi in common.slices(pc.binary_length(texts), tokens.SLICE):
                flat, bounds = tok.flat(texts.slice(lo, hi - lo))
                for doc, a, b in zip(ids[lo:hi], bounds.tolist(), bounds[1:].tolist()):
                    for k in range(a, b + 1, capacity):
                        stop = min(k + capacity, b + 1)  # the end id stands at b
                        crc = zlib.crc32(flat[k : min(stop, b)])
                        crc = zlib.crc32(end, crc) if stop > b else crc
                        for col, v in zip(rows, (doc, (k - a) // capacity, k - a, stop - k, crc)):
                            col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), *(pa.array(c, pa.int64()) for c in rows[2:])], ["doc_id", "piece", "start", "length", "ids_crc32"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(common.tidied(cut), "doc_id long, piece int, start long, length long, ids_crc32 long")


def _price(value: np.ndarray, units: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack over all rooms: value of the best fill, and its last class (-1: a unit stays empty)."""
    best = np.zeros(room + 1)
    pick = np.full(room + 1, -1)
    upto = np.searchsorted(units, np.arange(room + 1), side="right")
    for c in range(1, room + 1):
        n = upto[c]
        best[c] = best[c - 1]
        if n:
            gain = best[c - units[:n]] + value[:n]
            k = int(gain.argmax())
            if gain[k] > best[c]:
                best[c], pick[c] = gain[k], k
    return best, pick


def _fill(pick: np.ndarray, units: np.ndarray, first: int, room: int) -> list[int]:
    """Classes of the most valuable fill that holds the class ``first``."""
    out, c = [first], room - int(units[first])
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            out.append(int(pick[c]))
            c -= int(units[pick[c]])
    return out


def configurations(units: np.ndarray, demand: np.ndarray, room: int, rounds=ROUNDS, step=STEP) -> dict[tuple[int, ...], float]:
    """Fractional cover of ``demand`` by fills of ``room`` units; ``units`` ascend.

    After each round every class is covered to the round's share.  Prices fall
    with what covers a class, and a fill is bought until its scarcest class is
    two rounds ahead, so prices and cover move together.
    """
    n = len(units)
    load = np.zeros(n)
    total: dict[tuple[int, ...], float] = {}
    for r in range(1, rounds + 1 if n else 1):
        price = units / room * np.exp(-(load * rounds - (r - 1)) * step)
        _, pick = _price(price, units, room)
        for first in range(n - 1, -1, -1):
            while load[first] < r / rounds - 1e-9:
                kinds, counts = np.unique(_fill(pick, units, first, room), return_counts=True)
                ahead = np.maximum((r + 1) / rounds - load[kinds], 0) * demand[kinds] / counts
                lag = (r / rounds - load[first]) * demand[first] / counts[kinds == first][0]
                amount = float(min(ahead.min(), lag))
                if amount <= 1e-9 * lag:  # a companion is far ahead: the class alone
                    kinds, counts = np.asarray([first]), np.asarray([room // int(units[first])])
                    amount = float((r / rounds - load[first]) * demand[first] / counts[0])
                load[kinds] += amount * counts / demand[kinds]
                key = tuple(np.repeat(kinds, counts)[::-1].tolist())
                total[key] = total.get(key, 0.0) + amount
    return total


def _sequences(found, by_class, classes, left, kept, capacity):
    """(copies, lengths) of the kept part of the program; takes them out of ``left``."""
    groups: list[tuple[int, list[int]]] = []
    pools = {c: [x for x in by_class[c] if left[x]] for c in classes}
    for fill, x in sorted(found.items(), key=lambda p: (-p[1], p[0])):
        copies = int(x * kept + 1e-9)
        while copies > 0:
            need: dict[int, int] = {}
            lengths: list[int] = []
            for k in fill[:-1]:
                pool = pools[classes[k]]
                while pool and not left[pool[-1]]:
                    pool.pop()
                got = next((y for y in reversed(pool) if left[y] > need.get(y, 0)), None)
                if got is None or sum(lengths) + got > capacity:
                    break
                need[got] = need.get(got, 0) + 1
                lengths.append(got)
            else:
                rest = capacity - sum(lengths)
                if left.get(rest, 0) > need.get(rest, 0):  # full to the last token
                    need[rest] = need.get(rest, 0) + 1
                    lengths.append(rest)
            if len(lengths) < max(1, len(fill) - 1):
                break  # a class has run out: the rest is placed best-fit
            take = min(copies, *(left[y] // m for y, m in need.items()))
            for y, m in need.items():
                left[y] -= take * m
            groups.append((take, lengths))
            copies -= take
    return groups


def plan(histogram: dict[int, int], capacity=CAPACITY, width: int | None = None, rounds=ROUNDS, small_share=SMALL_SHARE) -> tuple[np.ndarray, int]:
    """Rank intervals (length, rank_from, count, first_sequence, offset), sequences used."""
    start = {int(k): int(v) for k, v in histogram.items() if v > 0}
    bound = -(-sum(k * v for k, v in start.items()) // capacity)
    by_class: dict[int, list[int]] = {}
    large = [x for x in start if x * small_share > capacity]
    width = width or (1 if len(large) <= EXACT_KINDS else CLASS_WIDTH)
    for length in sorted(large):
        by_class.setdefault(-(-length // width), []).append(length)
    classes = sorted(by_class)
    demand = np.asarray([sum(start[x] for x in by_class[c]) for c in classes], dtype=float)
    found = configurations(np.asarray(classes, dtype=int), demand, capacity // width, rounds)
    groups, used = [], None
    for kept in KEPT:
        left = dict(start)
        got = _best_fit(_sequences(found, by_class, classes, left, kept, capacity), left, capacity)
        n = sum(copies for copies, _ in got)
        if used is None or n < used:
            groups, used = got, n
        if used <= bound:
            break
    rows, rank, seq = [], {}, 0
    for copies, lengths in groups:
        at = 0
        for y in lengths:
            rows.append((y, rank.get(y, 0), copies, seq, at))
            rank[y] = rank.get(y, 0) + copies
            at += y
        seq += copies
    rows.sort()
    return np.asarray(rows, dtype=np.int64).reshape(-1, 5), seq


def _best_fit(groups, left, capacity):
    """Place the remaining counts, longest first, where the least room is left."""
    by_slack: dict[int, list[tuple[int, list[int]]]] = {}
    for copies, lengths in groups:
        by_slack.setdefault(capacity - sum(lengths), []).append((copies, lengths))
    slacks = sorted(by_slack)

    def put(slack, group):
        if slack not in by_slack or not by_slack[slack]:
            if slack not in by_slack:
                insort(slacks, slack)
            by_slack[slack] = []
        by_slack[slack].append(group)

    for y in sorted(left, reverse=True):
        rest = left[y]
        while rest:
            at = bisect_left(slacks, y)
            if at == len(slacks):
                each = min(capacity // y, rest)
                bins = rest // each
                put(capacity - each * y, (bins, [y] * each))
                rest -= bins * each
                continue
            slack = slacks[at]
            copies, lengths = by_slack[slack].pop()
            if not by_slack[slack]:
                del by_slack[slack], slacks[at]
            each = min(slack // y, rest)
            bins = min(copies, rest // each)
            if bins < copies:
                put(slack, (copies - bins, lengths))
            put(slack - each * y, (bins, [*lengths, *[y] * each]))
            rest -= bins * each
    return [g for s in slacks for g in by_slack[s]]


def scatter(n: int) -> int:
    """A factor coprime to ``n`` near its golden section: numbers times it, mod n, are a permutation."""
    turn = max(1, int(n * 0.6180339887))
    while math.gcd(turn, max(1, n)) != 1:
        turn += 1
    return turn


def best_fit_pack(docs: DataFrame, id_col="doc_id", text_col="text", capacity=CAPACITY, end_id=END_ID, tokenizer: str | None = None) -> DataFrame:
    """One row per piece with its sequence and its place there.

    Output: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    spark = docs.sparkSession
    pieces = common.staged(token_pieces(docs, id_col, text_col, capacity, end_id, tokenizer), "pieces")
    counts = pieces.groupBy("length").agg(F.count("*").alias("n"))
    hist = {r.length: r.n for r in counts.collect()}  # at most `capacity` rows
    runs, used = plan(hist, capacity)
    turn = scatter(used)
    sizes = spark.createDataFrame([(k, -(-v // RANK_GROUP)) for k, v in hist.items()], "length long, n_salts long")
    salted = pieces.join(F.broadcast(sizes), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("n_salts"))).drop("n_salts")
    part = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    base = part.select("length", "salt", (F.sum("n").over(W.partitionBy("length").orderBy("salt")) - F.col("n")).alias("base"))
    ranked = salted.withColumn("rank", F.row_number().over(W.partitionBy("length", "salt").orderBy(F.xxhash64(F.lit(SEED), "doc_id", "piece", "ids_crc32"), "doc_id", "piece", "start", "ids_crc32")) - 1)
    ranked = ranked.join(base, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("base"))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    key = runs[:, 0] << 44 | runs[:, 1]
    share = spark.sparkContext.broadcast((key, runs))

    def place(batches):
        keys, table = share.value
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            run = table[at]
            cols = [b.column(i) for i in range(5)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array((run[:, 3] + rank - run[:, 1]) * turn % max(1, used)), pa.array(run[:, 4])], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(common.tidied(place), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
