"""Pairs of records that share block keys, met record by record instead of shuffled as rows.

The number of pairs grows much faster than the table, so no pair may cross the
network.  Every record is one row with the 64-bit hashes of its keys.  The
records of a country are dealt in tiles, some S1 records beside some source
records; a tile holds an inverted list of its source keys and walks over its S1
records one by one.  Shared keys are counted in one array, several rules in the
bits of one number.
"""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa

#: Most records of a tile, and S1 records worth a tile of their own.
S1_ROWS, SOURCE_ROWS, SPREAD = 100_000, 200_000, 5_000
#: Rows of a batch sent back.
OUT_ROWS = 50_000
LANE = 16


def tiles_of(n_s1: int, n_source: int, wide=4) -> tuple[int, int]:
    """How many parts the S1 and the source records of a country are dealt in."""
    return max(-(-n_s1 // S1_ROWS), min(wide, -(-n_s1 // SPREAD)), 1), max(-(-n_source // SOURCE_ROWS), 1)


def nested(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list of lists and the length of every inner list, row after row."""
    inner = column.flatten()
    return inner.flatten().to_numpy(zero_copy_only=False), np.diff(inner.offsets.to_numpy())


class Fields:
    """Places of the rules' counts in the bits of some 64-bit counters."""

    def __init__(self, most: np.ndarray, least: list[int], weights: list[int]):
        bits = [int(m).bit_length() for m in most]
        self.place, self.lanes = [None] * len(bits), []  # (counter, shift); (counter, shift, width, rules)
        counter, at, room = 0, 0, 0
        for r in sorted(range(len(bits)), key=lambda r: -bits[r]):
            if not bits[r]:
                continue
            if bits[r] > room:
                width = max(LANE, bits[r])
                if at + width > 64:
                    counter, at = counter + 1, 0
                self.lanes.append((counter, at, width, []))
                room, at = width, at + width
            c, s, w, rules = self.lanes[-1]
            self.place[r] = (c, s + w - room)
            rules.append((r, w - room, (1 << bits[r]) - 1))
            room -= bits[r]
        self.counters = counter + 1
        self.least, self.weights = least, weights
        self.tables = {}

    def sums(self, seen: list[np.ndarray], value) -> np.ndarray:
        """The sum over the rules of ``value(rule, count)`` for the counters ``seen``."""
        out = np.zeros(len(seen[0]), np.int64)
        for k, (c, s, w, rules) in enumerate(self.lanes):
            x = seen[c] >> np.uint64(s) & np.uint64((1 << w) - 1)
            if w > LANE:
                for r, shift, mask in rules:
                    out += value(r, (x >> np.uint64(shift) & np.uint64(mask)).astype(np.int64))
                continue
            table = self.tables.get((value, k))
            if table is None:
                every = np.arange(1 << w, dtype=np.int64)
                table = sum(value(r, every >> shift & mask) for r, shift, mask in rules)
                self.tables[value, k] = table
            out += table[x.astype(np.int64)]
        return out

    def count(self, seen: list[np.ndarray], r: int) -> np.ndarray:
        if self.place[r] is None:
            return np.zeros(len(seen[0]), np.int64)
        c, s = self.place[r]
        mask = next(m for x in self.lanes for q, _, m in x[3] if q == r)
        return (seen[c] >> np.uint64(s) & np.uint64(mask)).astype(np.int64)


def meet(names: list[str], least: list[int], weights: list[int], scheme: str, k: int | None, dropped):
    """A ``mapInArrow`` function over rows (cell, side, entity_id, ks) in this order, source records (side 0) first.

    Yields (sid, cid, rule, n) for the scheme ``hits``, else (sid, cid, block_score,
    block_rules, block_rank) of all pairs, or of the ``k`` best of every S1 record.
    """
    def hit(r, n):
        return (n >= least[r]).astype(np.int64)

    def held(r, n):
        return hit(r, n) << r

    def total(r, n):
        return hit(r, n) * weights[r]

    def votes(r, n):
        return hit(r, n) * n

    def run(batches):
        out = Out(names, scheme)
        cell, source, index = None, [], None
        try:
            for b in batches:
                cells, sides = b.column(0).to_numpy(), b.column(1).to_numpy()
                cuts = np.flatnonzero((np.diff(cells) != 0) | (np.diff(sides) != 0)) + 1
                for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cells)]):
                    if hi == lo:
                        continue
                    if cells[lo] != cell:
                        cell, source, index = cells[lo], [], None
                    part = b.slice(lo, hi - lo)
                    if sides[lo] == 0:
                        source.append(part)
                        continue
                    if not source and index is None:
                        continue
                    if index is None:
                        index, source = Index(source, len(names), dropped.value), []
                    yield from walk(part, index, out)
            yield from out.rest()
        finally:
            index = source = None
            gc.collect()
            pa.default_memory_pool().release_unused()

    def walk(part, index, out):
        sids = part.column(2)
        keys, lens = nested(part.column(3))
        rule = np.repeat(np.tile(np.arange(len(names)), part.num_rows), lens)
        sizes = lens.reshape(-1, len(names))
        ends = np.concatenate([[0], np.cumsum(sizes.sum(axis=1))])
        lo, hi = index.find(keys)
        fields = Fields(sizes.max(axis=0), least, weights)
        unit = [np.uint64(1 << p[1]) if p else np.uint64(0) for p in fields.place]
        where = [p[0] if p else 0 for p in fields.place]
        counts = [np.zeros(len(index.ids), np.uint64) for _ in range(fields.counters)]
        for i in range(part.num_rows):
            at = np.flatnonzero(lo[ends[i] : ends[i + 1]] < hi[ends[i] : ends[i + 1]]) + ends[i]
            if not len(at):
                continue
            spans = list(zip(lo[at].tolist(), hi[at].tolist(), rule[at].tolist()))
            for a, z, r in spans:
                counts[where[r]][index.posts[a:z]] += unit[r]
            if 8 * sum(z - a for a, z, _ in spans) < len(index.ids):
                found = np.unique(np.concatenate([index.posts[a:z] for a, z, _ in spans]))
            else:
                found = np.flatnonzero(counts[0] if len(counts) == 1 else np.bitwise_or.reduce(counts))
            seen = [c[found] for c in counts]
            for c in counts:
                c[found] = 0
            if scheme == "hits":
                for r in np.unique(rule[at]).tolist():
                    n = fields.count(seen, r)
                    on = n >= least[r]
                    yield from out.put(sids, i, index.ids, found[on], np.full(int(on.sum()), r), n[on], None)
                continue
            if scheme == "max":
                score = np.zeros(len(found), np.int64)
                for r in np.unique(rule[at]).tolist():
                    score = np.maximum(score, total(r, fields.count(seen, r)))
                real = score > 0
            else:
                score = fields.sums(seen, total if scheme == "sum" else votes)
                real = score > 0
            if not real.all():
                found, score, seen = found[real], score[real], [x[real] for x in seen]
            if k is not None:
                if len(found) > k:  # all that reach the k-th score, then the first ids among equals
                    pick = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
                    found, score, seen = found[pick], score[pick], [x[pick] for x in seen]
                order = np.argsort(-score, kind="stable")[:k]
                found, score, seen = found[order], score[order], [x[order] for x in seen]
            yield from out.put(sids, i, index.ids, found, fields.sums(seen, held), score, np.arange(1, len(found) + 1))

    return run


class Index:
    """Inverted lists of source records; ``ids`` in order, ``posts`` their places by key."""

    def __init__(self, parts: list[pa.RecordBatch], rules: int, dropped: np.ndarray):
        table = pa.Table.from_batches(parts)
        self.ids = pa.concat_arrays(table.column(2).chunks)
        got = [nested(p.column(3)) for p in parts]
        keys = np.concatenate([x for x, _ in got])
        owner = np.repeat(np.arange(len(self.ids), dtype=np.int32), np.concatenate([n for _, n in got]).reshape(-1, rules).sum(axis=1))
        if len(dropped):
            on = dropped[np.searchsorted(dropped, keys).clip(max=len(dropped) - 1)] != keys
            keys, owner = keys[on], owner[on]
        order = np.argsort(keys, kind="stable")
        keys, self.posts = keys[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.starts = keys[first], np.append(first, len(keys))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the list of each key begins and ends; empty for an unknown one."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at = np.searchsorted(self.keys, keys).clip(max=len(self.keys) - 1)
        return self.starts[at], np.where(self.keys[at] == keys, self.starts[at + 1], self.starts[at])


class Out:
    """Rows gathered to batches."""

    def __init__(self, names: list[str], scheme: str):
        self.names, self.scheme, self.rows, self.held = names, scheme, 0, []
        self.order = sorted(range(len(names)), key=lambda r: names[r])

    def put(self, sids, i, ids, found, rules, value, rank):
        # a record may meet very many others
        for at in range(0, len(found), OUT_ROWS):
            z = at + OUT_ROWS
            n = len(found[at:z])
            self.held.append((sids.take(pa.array(np.full(n, i))), ids.take(pa.array(found[at:z])), rules[at:z], value[at:z], None if rank is None else rank[at:z]))
            self.rows += n
            if self.rows >= OUT_ROWS:
                yield self.batch()

    def rest(self):
        if self.rows:
            yield self.batch()

    def batch(self):
        sid, cid = (pa.concat_arrays([h[c] for h in self.held]) for c in (0, 1))
        rules, value = (np.concatenate([h[c] for h in self.held]) for c in (2, 3))
        if self.scheme == "hits":
            cols = [sid, cid, pa.array(self.names).take(pa.array(rules)), pa.array(value)]
            names = ["sid", "cid", "rule", "n"]
        else:
            sets, which = np.unique(rules, return_inverse=True)
            texts = pa.array([",".join(self.names[r] for r in self.order if s >> r & 1) for s in sets.tolist()], pa.string())
            rank = np.concatenate([h[4] for h in self.held]).astype(np.int32)
            cols, names = [sid, cid, pa.array(value), texts.take(pa.array(which)), pa.array(rank)], ["sid", "cid", "block_score", "block_rules", "block_rank"]
        self.rows, self.held = 0, []
        return pa.RecordBatch.from_arrays(cols, names)
