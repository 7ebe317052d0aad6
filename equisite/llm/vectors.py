"""What the operators on vectors share: which vectors count, their keys, and packed rows of many vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PACK = 2048
"""Vectors of a packed row at most."""

PACK_BYTES = 1 << 20
"""Bytes of a packed row's numbers at most (one vector is never cut)."""


def finite(vector: str) -> Column:
    """True for vectors with a component, none of them null or non-finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


def content_key(*columns) -> Column:
    """16 bytes that stand for the content of the columns."""
    def part(*seed):
        return F.lpad(F.hex(F.xxhash64(*seed, *columns)), 16, "0")
    return F.unhex(F.concat(part(), part(F.lit(1))))


def matrix(vectors: pa.Array) -> np.ndarray:
    """List column of equal lengths as rows of doubles."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def by_key(batches, keys: list[str]):
    """(key, [batch slices]) for every run of equal keys of sorted batches; slices come one by one as (key, slice)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = list(zip(*(batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys)))
        start = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or values[i] != values[start]:
                yield values[start], batch.slice(start, i - start)
                start = i


def packed_rows(rows: DataFrame, keys: list[str], fields: dict[str, str], order: list[str]) -> DataFrame:
    """One row per at most ``PACK`` rows of a key: the keys, ``m`` rows, ``v`` (doubles) and every field as raw bytes.

    ``fields`` maps the name of a column to the numpy type of its packed form ("raw": 16-byte keys as they are). The
    rows need a column ``v``, equally long within a key. No key is held longer than one packed row.
    """
    types = dict(rows.dtypes)
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), "m int", "v binary", *(f"{f} binary" for f in fields)])
    from equisite.llm.base import arrow_schema
    arrow = arrow_schema(schema)

    def pack(batches):
        held: dict = {}
        size, current = 0, None

        def flush():
            v = np.concatenate(held["v"])
            row = dict(zip(keys, current)) | {"m": len(v), "v": v.tobytes()}
            row |= {f: b"".join(held[f]) for f in fields}
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for key, part in by_key(batches, keys):
            if key != current:
                if size:
                    yield flush()
                held, size, current = {"v": [], **{f: [] for f in fields}}, 0, key
            width = max(1, len(part.column("v")[0].as_py()))
            most = max(1, min(PACK, PACK_BYTES // (8 * width)))
            at = 0
            while at < part.num_rows:
                take = part.slice(at, most - size)
                at, size = at + take.num_rows, size + take.num_rows
                held["v"].append(matrix(take.column("v")))
                for f, kind in fields.items():
                    column = take.column(f)
                    held[f].append(b"".join(column.to_pylist()) if kind == "raw" else
                                   column.to_numpy(zero_copy_only=False).astype(kind).tobytes())
                if size >= most:
                    yield flush()
                    held, size = {"v": [], **{f: [] for f in fields}}, 0
        if size:
            yield flush()

    return (rows.select(*keys, "v", *fields, *[o for o in order if o not in (*keys, *fields)])
            .repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(pack, schema))
