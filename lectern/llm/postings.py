"""Which of a row's 48-bit keys other owners have too, and how many of them.

Rows go in through one Arrow function, keys travel as packed numpy blocks, and
each owner that shares a key comes back with its shared keys from rare to common.

1. A task gathers the keys of a few thousand owners (a *flush*), drops repeated
   owners, and deals the keys to blocks by key.  A key that very many owners of
   the flush have is *hot*: its entries stay with the owners and only the key
   itself is sent on, so no task ever holds all owners of a hot key.
2. Blocks with the same number meet.  Keys with one owner are dropped, the rest
   goes on by owner with a rank of the owner count.
3. Blocks meet by owner.  The order (rank, key) is the same for all owners, which
   is what a prefix filter needs; the rank of a hot key is the highest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.scratch import shuffle_parts

KEY_BITS = 48
HOT_RANK = 255
#: Owners of one key within a flush from which its entries stay with the owners.
HOT_IN_FLUSH = 256
FLUSH_OWNERS, FLUSH_KEYS = 16384, 1_000_000
_LOW = np.uint64(0xFFFF)
_SIXTEEN = np.uint64(16)

BLOCK = pa.schema([("slot", pa.int32()), ("kind", pa.int8()), ("owners", pa.binary()),
                   ("sizes", pa.binary()), ("keys", pa.binary())])
BLOCK_DDL = "slot int, kind byte, owners binary, sizes binary, keys binary"


def pack(values: np.ndarray) -> bytes:
    """Bytes plane by plane, which compresses well for sorted integers."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def unpack(data: bytes, dtype: type) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def rank_of(counts: np.ndarray) -> np.ndarray:
    """A coarse logarithm, 16 steps to a doubling; rises with the count."""
    return np.minimum(HOT_RANK - 1, np.floor(16 * np.log2(np.maximum(counts, 1)))).astype(np.uint64)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return starts, np.diff(np.r_[starts, len(values)])


def _deal(owner: np.ndarray, size: np.ndarray, key: np.ndarray, low: np.ndarray, slots: int,
          kind: int, by_owner: bool) -> Iterator[tuple]:
    """Blocks (slot, kind, owners, sizes, keys); a key carries 16 bits, see ``low``."""
    if not len(key):
        return
    slot = (owner.view(np.uint64) if by_owner else key) % np.uint64(slots)
    order = np.argsort(slot, kind="stable")
    starts, counts = _runs(slot[order])
    for start, count in zip(starts, counts, strict=True):
        at = order[start:start + count]
        yield int(slot[at[0]]), kind, pack(owner[at]), pack(size[at]), pack((key[at] << _SIXTEEN) | low[at])


class _Flush:
    """Keys of a few thousand owners."""

    def __init__(self, slots: int) -> None:
        self.slots = slots
        self.clear()

    def clear(self) -> None:
        self.owners: dict[int, int] = {}
        self.sizes: list[int] = []
        self.keys: list[np.ndarray] = []
        self.total = 0

    def add(self, owner: int, size: int, keys: np.ndarray) -> None:
        if owner not in self.owners:
            self.owners[owner] = len(self.sizes)
            self.sizes.append(size)
            self.keys.append(keys)
            self.total += len(keys)

    def full(self) -> bool:
        return len(self.sizes) >= FLUSH_OWNERS or self.total >= FLUSH_KEYS

    def blocks(self) -> Iterator[tuple]:
        owner = np.fromiter(self.owners, np.int64, len(self.sizes))
        size = np.array(self.sizes, np.int32)
        lengths = [len(k) for k in self.keys]
        if not sum(lengths):
            self.clear()
            return
        low = np.repeat(np.arange(len(lengths), dtype=np.uint64), lengths)
        entry = np.sort((np.concatenate(self.keys) << _SIXTEEN) | low)
        self.clear()
        key, low = entry >> _SIXTEEN, entry & _LOW
        starts, counts = _runs(key)
        hot = np.repeat(counts >= HOT_IN_FLUSH, counts)
        if hot.any():
            at = low[hot].astype(np.int64)
            yield from _deal(owner[at], size[at], key[hot], np.full(hot.sum(), HOT_RANK, np.uint64),
                             self.slots, 1, True)
            known = key[starts[counts >= HOT_IN_FLUSH]]
            yield from _dealt_keys(known, np.full(len(known), HOT_RANK, np.uint64), self.slots)
        yield from _indexed(owner, size, key[~hot], low[~hot], self.slots)


def _indexed(owner: np.ndarray, size: np.ndarray, key: np.ndarray, low: np.ndarray,
             slots: int) -> Iterator[tuple]:
    """Blocks by key whose entries point into a short list of owners (kind 0)."""
    slot = key % np.uint64(slots)
    order = np.argsort(slot, kind="stable")
    starts, counts = _runs(slot[order])
    for start, count in zip(starts, counts, strict=True):
        at = order[start:start + count]
        used, local = np.unique(low[at], return_inverse=True)
        used = used.astype(np.int64)
        yield (int(slot[at[0]]), 0, pack(owner[used]), pack(size[used]),
               pack((key[at] << _SIXTEEN) | local.astype(np.uint64)))


def _dealt_keys(keys: np.ndarray, low: np.ndarray, slots: int) -> Iterator[tuple]:
    """Hot keys by slot, without owners (kind 2)."""
    slot = keys % np.uint64(slots)
    for s in np.unique(slot):
        at = slot == s
        yield int(s), 2, b"", b"", pack((keys[at] << _SIXTEEN) | low[at])


def _batches(rows: Iterator[tuple], at_once: int = 256) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += len(row[4])
        if len(held) >= at_once or weight > 4_000_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), BLOCK.types)], schema=BLOCK)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), BLOCK.types)], schema=BLOCK)


def shared_postings(
    df: DataFrame,
    keys_of: Callable[[pa.RecordBatch], Iterator[tuple[int, int, np.ndarray]]],
    finish: Callable[[Iterator[tuple[int, int, np.ndarray, np.ndarray]]], Iterator[pa.RecordBatch]],
    ddl: str,
) -> DataFrame:
    """Hand each owner with shared keys to ``finish``, which makes the rows (``ddl``).

    ``keys_of`` yields (owner, number of keys, distinct uint64 keys under 2**48)
    per row; an owner that comes again must have the same keys.  ``finish`` gets
    (owner, number of keys, shared keys from rare to common, their ranks).  The input should be a scan or a stored table: a
    task that runs again must see its rows in the same order.
    """
    slots = shuffle_parts(df)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            flush = _Flush(slots)
            for batch in batches:
                for owner, size, keys in keys_of(batch):
                    flush.add(owner, size, keys)
                    if flush.full():
                        yield from flush.blocks()
            yield from flush.blocks()
        yield from _batches(rows())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All blocks of a slot: keys with two or more owners, dealt by owner."""
        def rows() -> Iterator[tuple]:
            owners, sizes, entries, hot, base = [], [], [], [], 0
            for batch in batches:
                for _, kind, own, siz, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if kind == 1:  # already by owner
                        held = unpack(own, np.int64)
                        yield int(held[0].view(np.uint64) % np.uint64(slots)), 1, own, siz, key
                    elif kind == 2:
                        hot.append(unpack(key, np.uint64) >> _SIXTEEN)
                    else:
                        one = unpack(key, np.uint64)
                        owners.append(unpack(own, np.int64))
                        sizes.append(unpack(siz, np.int32))
                        entries.append((one >> _SIXTEEN, (one & _LOW).astype(np.int64) + base))
                        base += len(owners[-1])
            if not entries:
                return
            owner, size = np.concatenate(owners), np.concatenate(sizes)
            key = np.concatenate([k for k, _ in entries])
            at = np.concatenate([i for _, i in entries])
            entries.clear()
            _, dense = np.unique(owner, return_inverse=True)
            order = np.lexsort((dense[at], key))
            key, at = key[order], at[order]
            same = dense[at]
            fresh = np.r_[True, (key[1:] != key[:-1]) | (same[1:] != same[:-1])]
            key, at = key[fresh], at[fresh]
            _, counts = _runs(key)
            rank = np.repeat(rank_of(counts), counts)
            kept = np.repeat(counts > 1, counts)
            if hot:
                is_hot = np.isin(key, np.concatenate(hot))
                rank[is_hot] = HOT_RANK
                kept |= is_hot
            at = at[kept]
            yield from _deal(owner[at], size[at], key[kept], rank[kept], slots, 1, True)
        yield from _batches(rows())

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All blocks of an owner's slot."""
        parts = [(unpack(own, np.int64), unpack(siz, np.int32), unpack(key, np.uint64))
                 for batch in batches
                 for _, _, own, siz, key in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        if not parts:
            return
        owner, size, entry = (np.concatenate(x) for x in zip(*parts, strict=True))
        key, rank = entry >> _SIXTEEN, entry & _LOW
        # An owner that came in several flushes is named by each for a hot key.
        order = np.lexsort((key, rank, owner))
        owner, size, key, rank = owner[order], size[order], key[order], rank[order]
        fresh = np.r_[True, (owner[1:] != owner[:-1]) | (key[1:] != key[:-1]) | (rank[1:] != rank[:-1])]
        owner, size, key, rank = owner[fresh], size[fresh], key[fresh], rank[fresh]
        starts, counts = _runs(owner)

        def found() -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
            for a, n in zip(starts.tolist(), counts.tolist(), strict=True):
                yield int(owner[a]), int(size[a]), key[a:a + n], rank[a:a + n].astype(np.uint8)
        yield from finish(found())

    dealt = df.mapInArrow(deal, BLOCK_DDL)
    counted = dealt.repartitionById(slots, F.col("slot")).mapInArrow(count, BLOCK_DDL)
    return counted.repartitionById(slots, F.col("slot")).mapInArrow(gather, ddl)
