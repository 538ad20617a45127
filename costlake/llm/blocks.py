"""Dealing documents into blocks that several passes find again, and packed
arrays for the rows that travel between blocks and hash partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def block_id(rows_per_block: int) -> Column:
    """Block of a row: so many consecutive rows of one scan task. Two reads of
    one stored table give the same blocks."""
    place = F.monotonically_increasing_id()
    return F.shiftleft(F.shiftright(place, 33), 33) + F.floor(
        place.bitwiseAND((1 << 33) - 1) / rows_per_block).cast("bigint")


def whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """(block, its rows) from batches whose first column is the block, with the
    blocks contiguous."""
    held: list[pa.RecordBatch] = []
    now = None
    for b in batches:
        block = b.column(0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else []
        for i, j in zip(cuts, [*cuts[1:], len(block)]):
            if held and int(block[i]) != now:
                yield now, pa.Table.from_batches(held)
                held = []
            now = int(block[i])
            held.append(b.slice(i, j - i))
    if held:
        yield now, pa.Table.from_batches(held)


def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (without the part) of one part after the other, from batches with the
    columns block, part, ... sorted by part."""
    held: list[tuple] = []
    now = None
    for b in batches:
        for block, part, *rest in zip(*(c.to_pylist() for c in b.columns)):
            if part != now and held:
                yield held
                held = []
            now = part
            held.append((block, part, *rest))
    if held:
        yield held


def planes(x: np.ndarray) -> bytes:
    """Bytes of equal significance together: zeros compress in the shuffle."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def unplanes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, -1).T.copy().view(kind).reshape(-1)


def batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], f.type) for c, f in enumerate(schema)],
                                      schema=schema)
