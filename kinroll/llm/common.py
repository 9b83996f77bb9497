"""Helpers the operators share: private column names, white space, checkpoints.

Python functions passed to Spark are imported by name on the executors, so the
package has to be installed there (or shipped with ``--py-files``).
"""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The white space of the contracts, [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"
WHITE_BYTES = WHITE.encode()


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to add (the result's
    columns replace input columns of the same name, in any letter case)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(quoted(c)) for c in df.columns if c.lower() not in taken])


def quoted(name: str) -> str:
    """A column name as Spark SQL text, dots and back-ticks included."""
    return "`" + name.replace("`", "``") + "`"


def narrow(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Only the named inputs of ``df``, under the names the operator uses."""
    return df.select(*[
        (F.col(quoted(c)) if isinstance(c, str) else c).alias(name) for name, c in columns.items()
    ])


def text_bytes(name: str) -> Column:
    """The text's UTF-8 bytes; null is the empty text."""
    return F.coalesce(F.col(quoted(name)).cast("binary"), F.lit(b"").cast("binary"))


# Texts are long: Arrow batches to Python workers hold this many bytes at most.
BATCH_BYTES = 8 * 1024 * 1024


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` by position: columns of any name, dots included, pass.
    Sets the session's bound on an Arrow batch."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    plain = T.StructType([T.StructField(f"r{i}", f.dataType, True) for i, f in enumerate(schema)])
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(fn, plain).toDF(*schema.names)


def ascii_lower(text: str | Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed. A text of ASCII
    alone takes the engine's own ``lower``, which is the same there and quicker."""
    text = F.col(quoted(text)) if isinstance(text, str) else text
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def to_arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def extended(df: DataFrame, extra: str) -> T.StructType:
    """The schema of ``df`` (all columns nullable) and the columns of the DDL text ``extra``."""
    fields = [T.StructField(f.name, f.dataType, True, f.metadata) for f in df.schema.fields]
    return T.StructType(fields + list(T._parse_datatype_string(extra).fields))


def append(batch: pa.RecordBatch, **arrays) -> pa.RecordBatch:
    """``batch`` with further columns, in the order given."""
    columns = [*batch.columns, *(a if isinstance(a, pa.Array) else pa.array(a) for a in arrays.values())]
    return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *arrays])


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (shift-multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder; Spark's cleaner
    removes the files when the frame is no longer in use."""
    from kinroll.session import cut_lineage

    return cut_lineage(df)


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared checkpoint folder and read
    back: as ``cut``, for wide tables that are read more than once, by column."""
    from kinroll.session import ensure_checkpoint_dir

    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
