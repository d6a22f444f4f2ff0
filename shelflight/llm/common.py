"""Helpers of the text operators: reading tables, tables in the shared folder, Arrow passes."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelflight.session import settle, ship_package, work_path

#: Bytes of an Arrow batch that goes to Python: a few long texts must not make it large.
BATCH_BYTES = 16 << 20
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; ``TOKENIZER_DIR`` names another folder."""
    try:
        import public_tokenizers
        return public_tokenizers.path(name)
    except ImportError:
        return os.path.join(TOKENIZERS, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A fresh path in the folder that all executors share, and a table written there and read back.
new_path, stored = work_path, settle


def arrow_pass(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch], pa.Schema], Iterator[pa.RecordBatch]],
               schema: str | T.StructType) -> DataFrame:
    """``step`` over the Arrow batches of each partition; it gets the Arrow schema it has to return."""
    ship_package(df.sparkSession)
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if df.sparkSession.conf.get(setting) == f"{64 << 20}b":  # Spark's default; another choice of the session stands
        df.sparkSession.conf.set(setting, str(BATCH_BYTES))
    struct = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    target = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches, target)
        # A worker lives on after its task; what Arrow keeps for later would add to the next operator's memory.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, struct)


def batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    """Columns as one batch of the given schema."""
    arrays = [c.cast(f.type) if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
              for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
