"""What every operator here needs: the package on the executors, tables, working folders, the fold of a document."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import weakref
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_dir

_shipped: "weakref.WeakSet" = weakref.WeakSet()

#: Words are runs of anything but ASCII white space.
WORD_GAP = r"[\x20\x09-\x0D]+"


#: Bytes of a batch on its way to a Python worker: the engine's default of 64 MB fills small executors, at both ends.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, which may not have it installed, once per context; and bound batches by bytes."""
    if spark.conf.get(_BATCH).rstrip("b") == str(64 << 20):
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    context = spark.sparkContext
    if context in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="curbline-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}_pkg", "zip", package.parent, package.name))
    _shipped.add(context)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``stored``, and the folder, for callers that remove it when they are done."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared working folder and read it back: lineage ends, values stay as they are."""
    return stored_at(df, label)[0]


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels must not be learnt: a quarter, by crc32 of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def drawn(ids: DataFrame, column: str, rows: int) -> DataFrame:
    """At most ``rows`` of ``ids``, the same on each run: those whose hashed id is least.

    Every task of a limit sends as many rows as it asks for to one task. So where there are many ids, a bound on the
    hash that leaves about twice as many as are wanted comes first; it changes nothing unless it leaves too few, and then goes.
    """
    hashed = F.xxhash64(column)
    n = ids.count()
    if n > 8 * rows:
        below = ids.where(hashed < F.lit(-(1 << 63) + int((1 << 64) * 2 * rows / n)))
        ids = below if below.count() >= rows else ids
    return ids.orderBy(hashed, column).limit(rows)


def drawn_rows(rows: DataFrame, chosen: DataFrame, limit: int) -> DataFrame:
    """The rows of the ids in ``chosen``, equal rows once: at most ``limit``, the same on each run, those whose hash is least.

    An id may have any number of rows, so bounding ids doesn't bound rows. Equal rows are folded before the shuffle.
    """
    own = rows.join(F.broadcast(chosen), "doc_id").distinct()
    return own.orderBy(F.xxhash64(*own.columns), *own.columns).limit(limit)


def whole_row(df: DataFrame) -> Column:
    """All columns as one, so that columns added beside it clash with none of them."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


#: What operators keep in a worker between its tasks, by operator; a worker serves one stage after the other.
kept_in_worker: dict[str, dict] = {}


def _give_back() -> None:
    """Free memory goes back to the machine; allocators would keep it for a next time."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not this allocator
        pass


def tidy(run):
    """``run`` (batches to batches) that starts without what other operators left in the worker, and leaves nothing itself."""
    def tidied(batches):
        for kept in kept_in_worker.values():
            kept.clear()
        _give_back()
        try:
            yield from run(batches)
        finally:
            _give_back()

    return tidied


def byte_slices(batch, column: int, most: int = 4 << 20):
    """``batch`` in slices of about ``most`` bytes of the string or binary ``column``, one row at least.

    What a worker makes of a batch is a multiple of its text: batches of 64 MB would not fit beside each other.
    """
    import numpy as np
    import pyarrow.compute as pc
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right"))
        end = min(max(end, at + 1), at + 2_048)
        yield batch.slice(at, end - at)
        at = min(end, batch.num_rows)


def kept_rows(docs: DataFrame, keep) -> DataFrame:
    """``docs`` without the rows whose text ``keep`` (texts to booleans) refuses, all columns as they were."""
    at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for part in byte_slices(batch, at):
                yield part.filter(pa.array(keep(part.column(at).to_pylist()), pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
