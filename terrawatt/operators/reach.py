"""Distinct-count sketches of all vertices, united along links in tasks' memory.

Vertices are known by hashed longs and dealt into blocks; a piece holds the links into a block (a
crowded block's in several pieces, by their sources). Sketches arrive and leave in the serialised form of Spark's
`hll_*` functions: coupons (register and rank of one element) while they are few, and one byte a register after that. In
between they are packed: one row carries what a task sends to a piece.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

DEAL_LINKS = 1 << 19  # links that a task sorts by their pieces at once
_SLICE, _ENTRIES, _AT_ONCE = 1 << 18, 1 << 19, 256
_PACK_ROWS, _PACK_BYTES = 1 << 16, 1 << 25

LINK_ROWS = "piece int, turn int, data binary, key bigint, targets array<int>"
MESSAGES = "piece int, turn int, data binary"
SKETCHES = "key bigint, whole boolean, s binary"

Batches = Iterator[pa.RecordBatch]


class Pieces:
    """Which piece takes the link from a source to a vertex; `crowded` has the pieces of blocks with more than one."""

    def __init__(self, blocks: int, crowded: dict[int, int]):
        self.share = np.ones(blocks, np.int64)
        for b, n in crowded.items():
            self.share[b] = n
        self.first = np.cumsum(self.share) - self.share
        self.n = int(self.share.sum())
        self.whole = np.repeat(self.share == 1, self.share)

    def of(self, vertex: np.ndarray, source: np.ndarray) -> np.ndarray:
        block = vertex % len(self.share)
        return self.first[block] + (source >> 32) % self.share[block]


def _binaries(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of the ranges [start, start + length), one range after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def _distinct(values: np.ndarray) -> np.ndarray:
    """As `np.unique`, which hashes and takes several times as long."""
    values = np.sort(values)
    return values[_edges_of_runs(values)[:-1]] if len(values) else values


def _edges_of_runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, [len(sorted_values)]])


# --- links ------------------------------------------------------------------------------


def deal(pieces: Pieces) -> Callable[[Batches], Batches]:
    """(a, b) of links to rows (piece, data): the links in both directions, sorted by their pieces."""

    def dealt(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        a, b = (np.concatenate([x.column(i).to_numpy() for x in held]) for i in (0, 1))
        low, high = np.minimum(a, b), np.maximum(a, b)
        order = np.argsort(low * 31 + high)  # equal links come together; those that others part go later
        low, high = low[order], high[order]
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        low, high = low[new], high[new]
        u, w = np.concatenate([low, high]), np.concatenate([high, low])
        piece = pieces.of(u, w)
        order = np.argsort(piece.astype(np.uint16) if pieces.n <= 1 << 16 else piece, kind="stable")
        both, piece = np.stack([u[order], w[order]], axis=1), piece[order]
        at = _edges_of_runs(piece)
        return pa.RecordBatch.from_arrays([pa.array(piece[at[:-1]].astype(np.int32)), _binaries(both.view(np.uint8), np.diff(at) * 16)], ["piece", "data"])

    def work(batches: Batches) -> Batches:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= DEAL_LINKS:
                yield dealt(held)
                held, n = [], 0
        if n:
            yield dealt(held)

    return work


def gather(pieces: Pieces) -> Callable[[Batches], Batches]:
    """`LINK_ROWS` of a piece: its vertices (turn 0), its links by their sources (turn 1), and to which pieces its
    vertices' sketches go (the rows with a key)."""

    def row(piece: int, turn: int, data: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([piece], pa.int32()), pa.array([turn], pa.int32()), pa.array([data], pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int32()))],
            ["piece", "turn", "data", "key", "targets"],
        )

    def rows(piece: int, parts: list[np.ndarray]) -> Batches:
        both = np.concatenate(parts).reshape(-1, 2)
        u, w = both[:, 0].copy(), both[:, 1].copy()
        del both
        keys = _distinct(u)
        order = np.argsort(w)
        at = _edges_of_runs(w[order])
        sources = w[order[at[:-1]]]
        source = np.repeat(np.arange(len(sources)), np.diff(at))
        links = _distinct(source << 32 | np.searchsorted(keys, u[order]))
        del u, w, order, source
        source, local = links >> 32, links.astype(np.int32)
        yield row(piece, 0, keys.tobytes())
        at = _edges_of_runs(source)
        i = 0
        while i < len(at) - 1:
            j = max(i + 1, int(np.searchsorted(at, at[i] + _SLICE, "right")) - 1)
            counts = np.diff(at[i : j + 1]).astype(np.int32)
            yield row(piece, 1, np.int64(j - i).tobytes() + sources[i:j].tobytes() + counts.tobytes() + local[at[i] : at[j]].tobytes())
            i = j
        goes = _distinct(local.astype(np.int64) * pieces.n + pieces.of(sources[source], keys[local]))
        ends = np.searchsorted(goes, np.arange(len(keys) + 1) * pieces.n)
        to = (goes % pieces.n).astype(np.int32)
        for i in range(0, len(keys), 8192):
            k = keys[i : i + 8192]
            e = ends[i : i + len(k) + 1]
            lists = pa.ListArray.from_arrays(pa.array((e - e[0]).astype(np.int32)), pa.array(to[e[0] : e[-1]]))
            no = [pa.nulls(len(k), t) for t in (pa.int32(), pa.int32(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*no, pa.array(k), lists], ["piece", "turn", "data", "key", "targets"])

    def work(batches: Batches) -> Batches:
        parts: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for piece, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                parts.setdefault(piece, []).append(np.frombuffer(data.as_buffer(), np.int64).copy())
        for piece in [*parts]:
            yield from rows(piece, parts.pop(piece))

    return work


# --- sketches ---------------------------------------------------------------------------


def coupon_limit(lg_config: int) -> int:
    """Coupons up to which a sketch lists them, as in Spark's sketches."""
    return 3 << (lg_config - 5) if lg_config > 7 else 7


def packed_registers(registers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of registers as bytes, and the bytes of each row: four bits of steps to a register, four bits added to its rank."""
    n, size = registers.shape
    at = np.flatnonzero(registers)
    rank, row = registers.ravel()[at].astype(np.int64), at // size
    step = np.diff(at, prepend=-1)
    heads = np.flatnonzero(np.diff(row, prepend=-1))
    step[heads] = at[heads] - row[heads] * size + 1
    skips, more = (step - 1) // 15, (rank - 1) // 15
    taken = skips + 1 + more
    own = np.cumsum(taken) - taken + skips
    out = np.full(int(taken.sum()), 15 << 4, np.uint8)  # a skip: fifteen steps, nothing added
    out[own] = (step - 15 * skips) << 4 | np.minimum(rank, 15)
    for i in range(1, int(more.max(initial=0)) + 1):
        high = more >= i
        out[own[high] + i] = np.minimum(rank[high] - 15 * i, 15)
    return out, np.bincount(row, taken, n).astype(np.int64)


def unpacked_registers(data: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(len(lengths) * size, np.uint8)
    if not len(data):
        return out.reshape(-1, size)
    steps, rank = data >> 4, data & 15
    at = np.cumsum(steps, dtype=np.int64)
    ends = np.cumsum(lengths)
    before = np.concatenate([[0], at])[ends - lengths]
    at += np.repeat(np.arange(len(lengths)) * size - before - 1, lengths)
    if (more := np.flatnonzero(steps == 0)).size:
        first = steps > 0
        out[at[first]] = rank[first]
        np.add.at(out, at[more], rank[more])
    else:
        out[at] = rank
    return out.reshape(-1, size)


class Unions:
    """Sketches of `n` vertices that take in coupons and registers."""

    def __init__(self, n: int, lg_config: int):
        self.n, self.lg, self.size, self.limit = n, lg_config, 1 << lg_config, coupon_limit(lg_config)
        self.met, self.dense = np.zeros(n, bool), np.zeros(n, bool)
        self.registers = np.zeros((n, self.size), np.uint8)  # pages that nothing is written to take no memory
        self.settled, self.waiting, self.n_waiting = np.zeros(0, np.uint64), [], 0

    def _scatter(self, at: np.ndarray, coupons: np.ndarray) -> None:
        where = at.astype(np.int64) * self.size + (coupons & np.uint32(self.size - 1))
        np.maximum.at(self.registers.reshape(-1), where, (coupons >> np.uint32(26)).astype(np.uint8))

    def add_coupons(self, at: np.ndarray, coupons: np.ndarray) -> None:
        dense = self.dense[at]
        if dense.any():
            self._scatter(at[dense], coupons[dense])
            at, coupons = at[~dense], coupons[~dense]
        if len(at):
            self.waiting.append(at.astype(np.uint64) << np.uint64(32) | coupons)
            self.n_waiting += len(at)
            if self.n_waiting > len(self.settled) + (1 << 20):
                self.settle()

    def add_registers(self, at: np.ndarray, registers: np.ndarray) -> None:
        """To the vertices `at`, each given once."""
        for i in range(0, len(at), _AT_ONCE):
            some = at[i : i + _AT_ONCE]
            self.registers[some] = np.maximum(self.registers[some], registers)
        self.dense[at] = True

    def settle(self) -> None:
        """Counts the waiting coupons; vertices with more than the limit get registers."""
        pairs = _distinct(np.concatenate([self.settled, *self.waiting]))
        rows = (pairs >> np.uint64(32)).astype(np.int64)
        self.dense |= np.bincount(rows, minlength=self.n) > self.limit
        over = self.dense[rows]
        self._scatter(rows[over], pairs[over].astype(np.uint32))
        self.settled, self.waiting, self.n_waiting = pairs[~over], [], 0

    def serialised(self) -> Iterator[tuple[np.ndarray, pa.Array]]:
        """(vertices, sketches) of those that met any sketch."""
        self.settle()
        few = np.flatnonzero(self.met & ~self.dense)
        ends = np.searchsorted(self.settled >> np.uint64(32), np.arange(self.n + 1, dtype=np.uint64))
        for i in range(0, len(few), 8192):
            some = few[i : i + 8192]
            yield some, self._listed(ends[some], ends[some + 1] - ends[some])
        many = np.flatnonzero(self.met & self.dense)
        for i in range(0, len(many), 2 * _AT_ONCE):
            some = many[i : i + 2 * _AT_ONCE]
            yield some, self._registered(self.registers[some])

    def _listed(self, starts: np.ndarray, counts: np.ndarray) -> pa.Array:
        head = np.where(counts < 8, 8, 12)
        lengths = head + 4 * counts
        at = np.cumsum(lengths) - lengths
        out = np.zeros(int(lengths.sum()), np.uint8)
        # Bytes 0 to 7: words of the head, version, family, registers (lg), table size (lg), flags, listed, mode.
        out[at], out[at + 1], out[at + 2], out[at + 3] = np.where(counts < 8, 2, 3), 1, 7, self.lg
        out[at + 4] = np.where(counts < 8, 3, np.maximum(5, np.ceil(np.log2(np.maximum(counts, 1) * 4 / 3))))
        out[at + 5] = np.where(counts == 0, 8 | 4, 8)
        out[at + 6] = np.where(counts < 8, counts, 0)
        out[at + 7] = np.where(counts < 8, 0, 1) | 2 << 2
        words = out.view("<u4")
        many = counts >= 8
        words[at[many] // 4 + 2] = counts[many]
        words[_ranges((at + head) // 4, counts)] = self.settled[_ranges(starts, counts)].astype(np.uint32)
        return _binaries(out, lengths)

    def _registered(self, registers: np.ndarray) -> pa.Array:
        n = len(registers)
        out = np.zeros((n, 40 + self.size), np.uint8)
        out[:, :8] = [10, 1, 7, self.lg, 0, 16, 0, 2 | 2 << 2]  # flag 16: the sketch comes of a union
        sums = np.zeros((n, 3))
        sums[:, 1] = _PAIR_SUMS[registers.view(np.uint16)].sum(axis=1)
        for i in np.flatnonzero(registers.max(axis=1) > 31):
            sums[i, 2] = np.exp2(-registers[i][registers[i] > 31].astype(float)).sum()
        out[:, 8:32] = sums.view(np.uint8)
        out[:, 32:36] = (self.size - np.count_nonzero(registers, axis=1)).astype("<u4").view(np.uint8).reshape(n, 4)
        out[:, 40:] = registers
        return _binaries(out, np.full(n, 40 + self.size))


_POWERS = np.where(np.arange(256) < 32, np.exp2(-np.arange(256.0)), 0.0)
#: Of two registers read as one number: the sum of 2 to the minus rank, ranks above 31 left out.
_PAIR_SUMS = (_POWERS[:, None] + _POWERS).ravel()


def _parsed(batch: pa.RecordBatch, size: int) -> tuple[list, np.ndarray, np.ndarray]:
    """Of serialised sketches (column 1): what is sent of each, the coupons of each, and which are registers."""
    n = batch.num_rows
    column = batch.column(1)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)
    at, view = offsets[:-1], memoryview(data)
    mode, flags = data[at + 7], data[at + 5]
    dense = mode & 3 == 2
    if (dense & (mode >> 2 != 2)).any():
        raise ValueError("sketches with registers of a byte each are read")
    kind = mode & 3
    counts = data[at + 6].astype(np.int64)
    tables = np.flatnonzero(kind == 1)
    counts[tables] = data[at[tables, None] + np.arange(8, 12)].view("<u4").ravel()
    starts = at + np.where(kind == 1, 12, 8)
    sent = [view[i:j] for i, j in zip(starts.tolist(), (starts + 4 * counts).tolist(), strict=True)]
    for i in tables[flags[tables] & 8 == 0]:  # a hash table with empty places
        words = data[starts[i] : offsets[i + 1]].view("<u4")
        sent[i] = memoryview(words[words != 0]).cast("B")
    rows = np.flatnonzero(dense)
    for i in range(0, len(rows), _AT_ONCE):
        some = rows[i : i + _AT_ONCE]
        packed, lengths = packed_registers(np.stack([data[at[r] + 40 : at[r] + 40 + size] for r in some]))
        ends, packed = np.cumsum(lengths), memoryview(packed)
        for r, start, end in zip(some, ends - lengths, ends, strict=True):
            sent[r] = packed[start:end]
    counts[dense] = [len(sent[r]) for r in rows]
    return sent, counts, dense


def send(low: int, high: int, lg_config: int) -> Callable[[Batches], Batches]:
    """(key, s, targets) to `MESSAGES`: the sketches that go to a piece from `low` to before `high`."""

    def messages(held: list[pa.RecordBatch]) -> Batches:
        keys = np.concatenate([x.column(0).to_numpy() for x in held])
        parsed = [_parsed(x, 1 << lg_config) for x in held]
        sent = [s for x in parsed for s in x[0]]
        counts, dense = (np.concatenate([x[i] for x in parsed]) for i in (1, 2))
        targets = np.concatenate([x.column(2).flatten().to_numpy() for x in held])
        sizes = np.concatenate([x.column(2).value_lengths().to_numpy() for x in held])
        rows = np.repeat(np.arange(len(keys)), sizes)
        here = (targets >= low) & (targets < high)
        targets, rows = targets[here], rows[here]
        order = np.lexsort((keys[rows], dense[rows], targets))
        targets, rows = targets[order], rows[order]
        if not len(rows):
            return
        at = _edges_of_runs(targets)
        for i, j in zip(at[:-1], at[1:], strict=True):
            r = rows[i:j]
            head = np.array([len(r), np.count_nonzero(~dense[r])], np.int64).tobytes()
            data = b"".join([head, keys[r].tobytes(), counts[r].tobytes(), *[sent[x] for x in r.tolist()]])
            yield pa.RecordBatch.from_arrays([pa.array([int(targets[i])], pa.int32()), pa.array([2], pa.int32()), pa.array([data], pa.binary())], ["piece", "turn", "data"])

    def work(batches: Batches) -> Batches:
        held, n, size = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n, size = n + batch.num_rows, size + batch.nbytes
            if n >= _PACK_ROWS or size >= _PACK_BYTES:
                yield from messages(held)
                held, n, size = [], 0, 0
        if n:
            yield from messages(held)

    return work


class _Piece:
    """The links of a piece, and its vertices' sketches as messages come in."""

    def __init__(self, keys: np.ndarray, lg_config: int):
        self.keys, self.unions, self.slices, self.sources = keys, Unions(len(keys), lg_config), [], None

    def add_links(self, data: np.ndarray) -> None:
        n = int(data[:8].view(np.int64)[0])
        counts = data[8 + 8 * n : 8 + 12 * n].view(np.int32).copy()
        self.slices.append((data[8 : 8 + 8 * n].view(np.int64).copy(), counts, data[8 + 12 * n :].view(np.int32).copy()))

    def _sorted(self) -> None:
        self.slices.sort(key=lambda x: x[0][0])
        self.sources, self.counts, self.local = (np.concatenate([x[i] for x in self.slices]) for i in range(3))
        self.starts = np.cumsum(self.counts, dtype=np.int64) - self.counts
        self.slices = []

    def add(self, data: np.ndarray) -> None:
        if self.sources is None:
            self._sorted()
        n, few = data[:16].view(np.int64)
        keys, counts = data[16 : 16 + 8 * n].view(np.int64), data[16 + 8 * n : 16 + 16 * n].view(np.int64)
        found = np.searchsorted(self.sources, keys)
        if not np.array_equal(self.sources[np.minimum(found, len(self.sources) - 1)], keys):
            raise ValueError("a sketch came to a piece that has no links from it")
        ends = int(16 + 16 * n + 4 * counts[:few].sum())
        self._add_few(found[:few], counts[:few], data[16 + 16 * n : ends].view(np.uint32))
        self._add_dense(found[few:], counts[few:], data[ends:])

    def _add_few(self, found: np.ndarray, counts: np.ndarray, coupons: np.ndarray) -> None:
        links = self.counts[found].astype(np.int64)
        at = self.local[_ranges(self.starts[found], links)]
        self.unions.met[at] = True
        starts, counts = np.repeat(np.cumsum(counts) - counts, links), np.repeat(counts, links)
        part = (np.cumsum(counts) // _ENTRIES) if len(counts) else counts
        edges = _edges_of_runs(part) if len(part) else [0]
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            self.unions.add_coupons(np.repeat(at[i:j], counts[i:j]), coupons[_ranges(starts[i:j], counts[i:j])])

    def _add_dense(self, found: np.ndarray, lengths: np.ndarray, packed: np.ndarray) -> None:
        ends = np.cumsum(lengths)
        for i in range(0, len(found), _AT_ONCE):
            some, size = found[i : i + _AT_ONCE], lengths[i : i + _AT_ONCE]
            rows = unpacked_registers(packed[ends[i] - size[0] : ends[i + len(some) - 1]], size, self.unions.size)
            for row, start, n in zip(rows, self.starts[some].tolist(), self.counts[some].tolist(), strict=True):
                at = self.local[start : start + n]
                self.unions.add_registers(at, row)
                self.unions.met[at] = True


def meet(pieces: Pieces, lg_config: int) -> Callable[[Batches], Batches]:
    """Rows (piece, turn, data), sorted by piece and turn, to `SKETCHES` of the pieces' vertices."""

    def united(piece: int, held: _Piece) -> Batches:
        for some, sketches in held.unions.serialised():
            whole = pa.array(np.full(len(some), pieces.whole[piece]))
            yield pa.RecordBatch.from_arrays([pa.array(held.keys[some]), whole, sketches], ["key", "whole", "s"])

    def work(batches: Batches) -> Batches:
        last, held = None, None
        for batch in batches:
            for piece, turn, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                data = np.frombuffer(value.as_buffer(), np.uint8)
                if piece != last:
                    if held is not None:
                        yield from united(last, held)
                    last, held = piece, _Piece(data.view(np.int64).copy(), lg_config)
                elif turn == 1:
                    held.add_links(data)
                else:
                    held.add(data)
        if held is not None:
            yield from united(last, held)

    return work
