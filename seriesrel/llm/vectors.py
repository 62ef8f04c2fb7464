"""Dense vectors of one job: each task adds up its own, a tree of grouped sums adds up the tasks'.

A task's vector travels in chunks, so no row is large, and at most ``FAN`` vectors meet
in one group on each level of the tree. The length is fixed by the caller, not by the data.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesrel.session import scratch_path

CHUNK, FAN = 1 << 15, 16
SCHEMA = "branch long, chunk int, sums binary"


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` as a table in the shared folder (``options`` of the writer): what follows has no lineage before it."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_of(vector: np.ndarray) -> pa.RecordBatch:
    """One task's vector (int64) as rows of ``SCHEMA``."""
    parts = [vector[i:i + CHUNK].astype("<i8").tobytes() for i in range(0, len(vector), CHUNK)]
    branch = TaskContext.get().partitionId()
    return pa.record_batch({"branch": pa.array([branch] * len(parts), pa.int64()),
                            "chunk": pa.array(range(len(parts)), pa.int32()), "sums": pa.array(parts, pa.binary())})


def tree_sum(rows: DataFrame, length: int) -> np.ndarray:
    """The sum of all tasks' vectors."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, "<i8") for x in pdf["sums"])
        return pd.DataFrame({"branch": [pdf["branch"].iat[0] // FAN], "chunk": pdf["chunk"].iloc[:1].to_numpy(), "sums": [total.tobytes()]})

    rows = written(rows, "vectors")
    last = rows.agg(F.max("branch")).first()[0]
    while last:
        rows = written(rows.groupBy("chunk", F.expr(f"branch div {FAN}").alias("above")).applyInPandas(add, SCHEMA), "vectors")
        last //= FAN
    out = np.zeros(length, np.int64)
    for r in rows.collect():
        part = np.frombuffer(r.sums, "<i8")
        out[r.chunk * CHUNK:r.chunk * CHUNK + len(part)] += part
    return out
