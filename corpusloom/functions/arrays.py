"""Expressions over token arrays."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..schemas import IDS


#: Bytes of text, or ids, that a task looks at together.
TEXT_RUN, IDS_RUN = 1 << 20, 1 << 18


def small_parts(column: pa.Array, most: int) -> Iterator[pa.Array]:
    """Consecutive values, texts or lists, that hold about ``most`` bytes or members together."""
    sizes = pc.list_value_length(column) if pa.types.is_list(column.type) else pc.binary_length(column)
    sizes = pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = (np.cumsum(sizes) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(column)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a < b:
            yield column.slice(a, b - a)


def by_parts(most: int) -> Callable:
    """Let a function of an Arrow column see ``small_parts``, so that its memory does not grow with Spark's batches."""

    def wrap(run: Callable[[pa.Array], pa.Array]) -> Callable[[pa.Array], pa.Array]:
        @functools.wraps(run)
        def whole(column: pa.Array) -> pa.Array:
            return pa.concat_arrays([run(part) for part in small_parts(column, most)]) if len(column) else run(column)

        return whole

    return wrap


def in_parts(most: int) -> Callable:
    """The same for an iterator UDF, which hands each part on as it is done: a task never holds the results of one of
    Spark's batches together, and gives back to the system what Arrow has freed when it ends."""

    def wrap(run: Callable[[pa.Array], pa.Array]) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
        def parts(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for column in columns:
                for part in small_parts(column, most):
                    yield run(part)
            pa.default_memory_pool().release_unused()

        return parts

    return wrap


def drop_unknown_ids(ids: Column) -> Column:
    return F.filter(ids, lambda x: x != fixed.UNK_ID)


def clamp_ids(ids: Column, vocab_size: int) -> Column:
    return F.transform(ids, lambda x: F.least(x, F.lit(vocab_size - 1)))


def shift_inputs(row: Column) -> Column:
    return F.slice(row, F.lit(1), F.size(row) - 1)


def shift_labels(row: Column) -> Column:
    return F.slice(row, F.lit(2), F.size(row) - 1)


def eos_spans(ids: Column, eos_id: int = fixed.EOS_ID) -> Column:
    """``array<struct<first,last>>``, 1-based: each EOS closes its span, a remainder is the last."""
    n = F.size(ids)
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    ends = F.filter(places, lambda i: (F.element_at(ids, i) == eos_id) | (i == n))
    # Most rows hold one span, which needs no look at every place: no EOS, or the first one at the end.
    first = F.array_position(ids, F.lit(eos_id))
    ends = F.when((n > 0) & ((first == 0) | (first == n)), F.array(n)).otherwise(ends)
    starts = F.concat(F.array(F.lit(1)), F.transform(ends, lambda e: e + 1))
    return F.arrays_zip(F.slice(starts, F.lit(1), F.size(ends)).alias("first"), ends.alias("last"))


@F.arrow_udf(T.BinaryType())
@in_parts(IDS_RUN)
def _pack_u16(ids: pa.Array) -> pa.Array:
    flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if flat.size and (flat.min() < 0 or flat.max() >= fixed.MAX_VOCAB):
        raise ValueError("token id does not fit 16 bits")
    sizes = np.array([0 if n is None else n for n in ids.value_lengths().to_pylist()], dtype=np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes) * 2]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(flat.astype("<u2").tobytes())]
    )


@F.arrow_udf(IDS)
@in_parts(2 * IDS_RUN)
def _unpack_u16(packed: pa.Array) -> pa.Array:
    rows = [np.frombuffer(b, dtype="<u2", count=len(b) // 2) for b in packed.to_pylist()]
    sizes = np.cumsum([0] + [len(r) for r in rows]).astype(np.int32)
    flat = np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat))


def pack_u16(ids: Column) -> Column:
    """Little-endian 16-bit ids as one binary value; an id beyond 65,535 is an error, not a wrap."""
    return _pack_u16(F.coalesce(ids, F.array().cast("array<int>")))


def unpack_u16(packed: Column) -> Column:
    """Inverse of ``pack_u16``; an odd last byte is ignored."""
    return _unpack_u16(F.coalesce(packed, F.lit(b"")))
