"""Token ids of all documents in files, in the order of the document ids, and back.

Documents are range-partitioned by id and sorted; each task encodes its documents and writes sections, each
a directory of whole documents and their ids in coded blocks (see ``token_coder``). Sections are rows of a
Parquet folder, so that Spark commits them, retries tasks, and reads them from any store. The reader decodes
sections independently and takes the place of a document from prefix sums over tasks, sections and rows.

Defined results: null texts hold the end id alone; null ids come first; ids that repeat follow each other in
the order of their texts' hashes; a damaged section raises an error; a table without rows gives files without
sections. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import scratch_dir
from . import token_coder
from .runtime import ship
from .tokens import default_path, encoder

END_ID = 0
#: Ids after which a section ends. More of them side by side are faster and take more memory.
SECTION_IDS = 1 << 22
SECTIONS = "chunk bigint, section int, docs bigint, ids bigint, data binary"


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, section_ids: int = SECTION_IDS) -> str:
    """Write the files of ``docs`` to the folder ``path``."""
    ship(docs.sparkSession)
    tokenizer, end = tokenizer or default_path("byte_bpe_50k.json"), end_id.to_bytes(4, "little")

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        ids_of, chunk, section = encoder(tokenizer), TaskContext.get().partitionId(), 0
        names, raws, total = [], [], 0

        def row(number: int):
            data = token_coder.encode(names, raws)
            columns = [[chunk], [number], [len(names)], [total], [data]]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              names=["chunk", "section", "docs", "ids", "data"])

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                for name, raw in zip(part.column(0).to_pylist(), ids_of(part.column(1).to_pylist()), strict=True):
                    names.append(token_coder.NULL_ID if name is None else name)
                    raws.append(raw + end)
                    total += len(raw) // 4 + 1
                    if total >= section_ids:
                        yield row(section)
                        names, raws, total, section = [], [], 0, section + 1
        if names:
            yield row(section)

    # Rows that repeat an id are told apart by their number, so that a hot id is cut like any other range.
    rows = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange("doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie", "row").select("doc_id", "text")
    ordered.mapInArrow(encode, SECTIONS).write.option("compression", "none").parquet(path)
    return path


def read(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document in the files, and ids (little-endian 32-bit) on demand."""
    ship(spark)
    files = spark.read.schema(SECTIONS).parquet(path)

    def decode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, section = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                names, counts, ids = token_coder.decode(batch.column(2)[i].as_py())
                ends = np.cumsum(counts)
                starts, raw = ends - counts, ids.astype("<u4").tobytes()
                own = [raw[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [pa.array(np.full(len(names), chunk)), pa.array(np.full(len(names), section, np.int32)),
                           pa.array(names, mask=names == token_coder.NULL_ID), pa.array(starts), pa.array(counts),
                           pa.array([zlib.crc32(r) for r in own], pa.int64())]
                fields = ["chunk", "section", "doc_id", "inside", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(own, pa.binary())] if keep_ids else []),
                                                 names=fields + (["ids"] if keep_ids else []))

    # Ids before a section: those of earlier tasks, then of earlier sections of the task.
    sizes = files.select("chunk", "section", "ids")
    tasks = sizes.groupBy("chunk").agg(F.sum("ids").alias("n"))
    earlier = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inner = Window.partitionBy("chunk").orderBy("section").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.join(tasks, "chunk").select(
        "chunk", "section", (F.col("before") + F.coalesce(F.sum("ids").over(inner), F.lit(0))).alias("base"))
    schema = "chunk bigint, section int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    rows = files.select("chunk", "section", "data").mapInArrow(decode, schema + (", ids binary" if keep_ids else ""))
    return rows.join(bases, ["chunk", "section"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if keep_ids else []))


def written_and_read(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``read`` of what ``write`` puts into the shared working folder."""
    spark = docs.sparkSession
    return read(spark, write(docs, scratch_dir(spark, "token-files"), tokenizer))
