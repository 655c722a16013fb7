"""Helpers shared by the text operators: Arrow mapping, checkpoints, splits."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import ensure_checkpoint_dir

#: Bytes of text handled at once inside a task; only working memory depends on it.
CHUNK_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """The column of that very name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like ``wanted`` that no column of ``df`` has, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` as a table written in the shared folder, its lineage cut.

    Unlike a checkpoint, a written table doesn't hand the plan's inferred
    constraints on; in loops they would grow with every step.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` materialised by a reliable checkpoint in the shared folder, where no loop builds on it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def crc_split(id_col: str, folds: int, fold: int) -> Column:
    """True where crc32 of the id as text leaves ``fold`` modulo ``folds``; a null id counts as text ''."""
    return F.crc32(F.coalesce(quoted(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def chunks(batch: pa.RecordBatch, text_at: int, max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``max_bytes`` of text each; a longer text gets a slice of its own."""
    n = batch.num_rows
    if not n:
        return
    col = batch.column(text_at)
    size = np.asarray(pc.binary_length(col).fill_null(0)).astype(np.int64)
    ends = np.cumsum(size)
    lo = 0
    while lo < n:
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def map_texts(df: DataFrame, fn: Callable[[list[bytes], pa.RecordBatch], Sequence], fields: list[T.StructField],
              text_col: str = "text", keep: Sequence[str] | None = None, extra: Sequence[Column] = (),
              max_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``keep`` columns of ``df`` (all by default) plus ``fields``, which ``fn`` computes a chunk at a time.

    ``fn`` gets the texts as UTF-8 bytes (null: empty) and the chunk, whose
    columns are ``keep``, the text and ``extra``; it returns one sequence per
    field.  A kept column whose name is among ``fields`` is replaced by it.
    """
    made = {f.name for f in fields}
    keep = [c for c in (df.columns if keep is None else keep) if c not in made]
    n_keep = len(keep)
    # columns have plain names on the way: mapInArrow can't take dots in them
    schema = T.StructType([T.StructField(f"k{i}", df.schema[c].dataType, True) for i, c in enumerate(keep)] + fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(schema)
        for whole in batches:
            for part in chunks(whole, n_keep, max_bytes):
                got = fn(texts_of(part.column(n_keep)), part)
                cols = [part.column(i).cast(out.field(i).type) for i in range(n_keep)]
                cols += [v if isinstance(v, pa.Array) else pa.array(v, type=out.field(n_keep + i).type)
                         for i, v in enumerate(got)]
                yield pa.RecordBatch.from_arrays(cols, schema=out)

    given = [quoted(c).alias(f"k{i}") for i, c in enumerate(keep)] + [quoted(text_col).alias("text")]
    given += [c.alias(f"x{i}") for i, c in enumerate(extra)]
    return df.select(*given).mapInArrow(run, schema).toDF(*keep, *(f.name for f in fields))


def row_keys(seen: int, n: int) -> np.ndarray:
    """Keys of ``n`` rows after ``seen`` others of this task, unique over the tasks of one stage."""
    return (np.int64(TaskContext.get().partitionId()) << np.int64(40)) + np.arange(seen, seen + n, dtype=np.int64)
