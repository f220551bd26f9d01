"""State of many keys in a few rows of the state store.

From Python every call into the store costs about a millisecond, whatever it
moves, so a state per key makes a stream's time follow the number of its keys.
Here keys are dealt by hash to shards. A shard's rows are kept as columns
(Arrow bytes): each micro-batch appends a chunk, and what is left when the
shard's timer fires becomes one chunk again. The timer stands at the least
time at which any key of the shard has something to do.

A shard is held in memory whole while its timer is handled, so ``shards``
should grow with the state; it belongs to the checkpoint, and a query goes on
with the number it began with.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARDS = 512


def to_ms(us: int) -> int:
    """The first millisecond that is not before a microsecond time."""
    return -(-us // 1000)


def key_columns(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The keys as text (binary as it is): pandas keeps integers exact only
    where none is NULL."""
    out = []
    for f in df.select(*keys).schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            raise ValueError(f"key {f.name} must be atomic")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = c + F.lit(0).cast(f.dataType)  # -0.0 and 0.0 are one key
        out.append((c if isinstance(f.dataType, T.BinaryType) else c.cast("string")).alias(f.name))
    return out


def key_schema(df: DataFrame, keys: Sequence[str]) -> str:
    """The schema text of ``key_columns``."""
    return ", ".join(f"`{f.name}` {'binary' if isinstance(f.dataType, T.BinaryType) else 'string'}" for f in df.select(*keys).schema.fields)


def typed_back(out: DataFrame, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``out`` with the keys in the types that they have in ``df``."""
    types = {f.name: f.dataType for f in df.select(*keys).schema.fields}
    return out.select(*[F.col(c).cast(types[c]).alias(c) if c in types else c for c in out.columns])


def shard_of(keys: Sequence[str], shards: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(shards)).cast("int").alias("shard")


def packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as w:
        w.write_table(rows)
    return sink.getvalue().to_pybytes()


def unpacked(chunks: Iterable[bytes]) -> pa.Table | None:
    tables = [pa.ipc.open_stream(c).read_all() for c in chunks]
    return pa.concat_tables(tables, promote_options="permissive") if tables else None


class Shard:
    """Rows and timer of the shard that a processor is called with."""

    def __init__(self, handle):
        self.handle = handle
        self.rows = handle.getListState("rows", "chunk binary")
        self.due = handle.getValueState("due", "ms bigint")

    def add(self, rows: pd.DataFrame) -> None:
        self.rows.appendValue((packed(pa.Table.from_pandas(rows, preserve_index=False)),))

    def held(self, columns: Sequence[str]) -> pd.DataFrame:
        t = unpacked(bytes(r[0]) for r in self.rows.get())
        return pd.DataFrame(columns=list(columns)) if t is None else t.to_pandas()

    def wake(self, ms: int) -> None:
        """The timer goes off at ``ms``, or earlier if it is set so."""
        was = self.due.get()[0] if self.due.exists() else None
        if was is None or ms < was:
            if was is not None:
                self.handle.deleteTimer(was)
            self.handle.registerTimer(ms)
            self.due.update((ms,))

    def keep(self, rows: pd.DataFrame, ms: int | None) -> None:
        """When the timer has gone off: the rows that are left, and its next time."""
        self.rows.clear()
        if len(rows):
            self.add(rows)
        if ms is None:
            self.due.clear()
        else:
            self.handle.registerTimer(ms)
            self.due.update((ms,))
