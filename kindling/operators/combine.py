"""User-defined combiners by key (UDF3, AGG16): ``reduceByKey`` with any two-argument function."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Keys that a task holds before it sends its partial results on; the rows of a result batch.
HELD_KEYS, BATCH = 100_000, 10_000


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns), strict=True)


def reduce_by_key(df: DataFrame, keys: list[str], values: list[str], merge: Callable[[tuple, tuple], tuple],
                  held_keys: int = HELD_KEYS) -> DataFrame:
    """One row a key: the tuples of ``values`` of all its rows, merged pairwise by ``merge``,
    which must be associative and commutative (rows come in no order) and return a tuple of the same types.

    Two stages, as a built-in aggregate has: every task first merges the rows of a key
    that it holds and sends one partial tuple a key (again whenever ``held_keys`` keys
    are held, which bounds its memory), and only these are shuffled. So a key with a third of all rows sends a
    row or two a task. Behind the shuffle partial tuples come sorted by key and are merged as they stream by.
    Null keys are a key. It is the slow path, for what no built-in aggregate expresses."""
    n = len(keys)
    some = df.select(*keys, *values)
    kind = some.schema

    def out(held: dict) -> pa.RecordBatch:
        columns = list(zip(*((*k, *v) for k, v in held.items()), strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types(), strict=True)], kind.names)

    def types() -> list[pa.DataType]:
        from pyspark.sql.pandas.types import to_arrow_type

        return [to_arrow_type(f.dataType) for f in kind.fields]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for b in batches:
            for row in _rows(b):
                key, value = row[:n], row[n:]
                if key in held:
                    held[key] = merge(held[key], value)
                else:
                    if len(held) >= held_keys:
                        yield out(held)
                        held = {}
                    held[key] = value
        if held:
            yield out(held)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for b in batches:
            for row in _rows(b):
                key, value = row[:n], row[n:]
                if key in held:  # rows are sorted by key, so it is the last one
                    held[key] = merge(held[key], value)
                else:
                    if len(held) >= BATCH:
                        yield out(held)
                        held = {}
                    held[key] = value
        if held:
            yield out(held)

    return some.mapInArrow(partial, kind).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(final, kind)
