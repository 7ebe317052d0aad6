"""Small helpers shared by the text operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = re.compile(r"[^ \t-\r]+")
"""A word: a run without ASCII white space."""

WORD_SQL = r"[^\\x20\\x09-\\x0D]+"
"""The same pattern inside a SQL string literal with escapes."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


def map_batches(df: DataFrame, schema: str, make: Callable[[], Callable[[dict], dict]]) -> DataFrame:
    """``mapInArrow`` with column lists: ``make()`` runs once per task and returns the batch function.

    The batch function takes a dict of lists and returns a dict of lists; output types follow ``schema``.
    """
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            # long texts: a batch is worked off in pieces, so that Python objects stay few
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                out = step({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of the documents that no model may learn from; a null id is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def sample_share(rows: int, wanted: int) -> float:
    """The share of ``rows`` that gives about ``wanted``."""
    return min(1.0, wanted / max(1, rows))


def hashed_below(share: float, *columns: str) -> Column:
    """A reproducible sample: rows whose hash falls in the lowest ``share`` of all values."""
    return F.pmod(F.xxhash64(F.lit("sample"), *columns), F.lit(1 << 30)) < int(share * (1 << 30))
