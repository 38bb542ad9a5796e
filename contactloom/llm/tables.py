"""Shared helpers: column selection, memory of idle workers and fixed-size Bloom filters."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.session import stage

__all__ = ["Bloom", "col", "field_type", "leaving_little", "stage"]


def col(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def field_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def give_back() -> None:
    """Return freed memory to the machine, which Arrow and the C library otherwise keep for later."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def leaving_little(run: Callable, *forget: Callable[[], None]) -> Callable:
    """``run`` over batches; at a task's end the worker calls ``forget`` and gives memory back.

    Spark keeps a worker for the next tasks, beside a JVM that fills its heap
    meanwhile, so what an idle worker holds counts in every stage.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            for f in forget:
                f()
            give_back()

    return task


#: 64-bit cells of a filter that travel as one value.
BLOCK_CELLS = 1024


def _packed(batches):
    """Cells of the filter as the bytes of whole blocks."""
    blocks: dict[int, np.ndarray] = {}
    for b in batches:
        block, cell, v = (b.column(c).to_numpy() for c in ("block", "cell", "v"))
        for k in np.unique(block).tolist():
            here = block == k
            blocks.setdefault(k, np.zeros(BLOCK_CELLS, np.int64))[cell[here] % BLOCK_CELLS] = v[here]
    if blocks:
        yield pa.RecordBatch.from_pydict({"block": pa.array(list(blocks), pa.int64()), "v": pa.array([v.tobytes() for v in blocks.values()], pa.binary())})


class Bloom:
    """A Bloom filter of a fixed number of bits over rows of two integers.

    It is built by an aggregation into 64-bit cells, so what reaches the driver
    and what is broadcast is at most ``bits / 8`` bytes whatever the input.
    False positives only send more rows through the exact check that follows.
    """

    def __init__(self, bits: int, probes: int = 3):
        if bits % 64:
            raise ValueError("bits must be a multiple of 64")
        self.bits, self.probes = bits, probes
        self.cells = np.zeros(bits // 64, np.int64)

    @classmethod
    def build(cls, keys: DataFrame, a: str, b: str, bits: int = 1 << 23, probes: int = 3) -> Bloom:
        out = cls(bits, probes)
        at = F.explode(F.array(*[F.pmod(F.col(a) + F.lit(k) * F.col(b), F.lit(bits)) for k in range(probes)]))
        cells = (
            keys.select(at.alias("at"))
            .groupBy(F.expr("at div 64").alias("cell"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("v"))
        )
        packed = cells.withColumn("block", F.expr(f"cell div {BLOCK_CELLS}")).repartition("block").mapInArrow(_packed, "block bigint, v binary")
        for row in packed.collect():
            part = np.frombuffer(row["v"], np.int64)
            at0 = row["block"] * BLOCK_CELLS
            out.cells[at0 : at0 + BLOCK_CELLS] |= part[: len(out.cells) - at0]
        return out

    def has(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For int64 arrays below 2**40 in size: which rows may be members."""
        found = np.ones(len(a), bool)
        cells = self.cells.view(np.uint64)
        for k in range(self.probes):
            at = (a + k * b) % self.bits
            found &= (cells[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
        return found
