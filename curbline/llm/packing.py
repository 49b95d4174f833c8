"""Best-fit packing by minimum bin slack.

Documents become token ids, long ones are cut, and the pieces are packed into sequences of a fixed
capacity. Which lengths share a sequence is decided on the histogram of lengths alone: for one bin after
the other, a subset-sum over the lengths still available, kept as a bitset, finds the fullest feasible
combination. A combination is taken as often as the counts allow before the next is sought, so the work
on the driver is bounded by the capacity, not by the data. Each piece then finds its place from its rank
among the pieces of its length.

Defined results: null and empty texts are the end id alone; a document of exactly the capacity is not
cut; a table without rows gives no rows; equal lengths are told apart by rank, so repeated rows and repeated
ids each get a place of their own. Only the columns ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window, functions as F

from .runtime import ship, stored
from .tokens import default_path, encoder

CAPACITY = 4096
END_ID = 1
PIECES = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, chunk bigint, nth int")
#: Rows after which a task begins a new chunk: ranks are counted in chunks, chunks by prefix sums.
CHUNK = 4096


def cut_tokens(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, keep_ids: bool) -> DataFrame:
    """A row per piece; ``nth`` counts the pieces of its length in its chunk."""
    end = end_id.to_bytes(4, "little")
    schema = PIECES + (", ids binary" if keep_ids else "")

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encode = encoder(tokenizer)
        chunk, seen = TaskContext.get().partitionId() << 33, {}
        names = [c.split()[0] for c in schema.split(", ")]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        out_schema = pa.schema(list(zip(names, types)))
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                rows = []
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()), strict=True):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                        own = ids[4 * start:4 * (start + capacity)]
                        n = len(own) // 4
                        nth = seen[n] = seen.get(n, -1) + 1
                        rows.append((doc_id, piece, start, n, zlib.crc32(own), chunk, nth) + ((own,) if keep_ids else ()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema=out_schema)
                if sum(seen.values()) > CHUNK:
                    chunk, seen = chunk + 1, {}

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def fullest(counts: dict[int, int], capacity: int) -> list[int]:
    """Lengths, with repeats, of the fullest bin that ``counts`` allow.

    Bit s of a bitset says that some of the lengths seen so far sum to s. Lengths come shortest first, each
    with the copies that may fit, and the fullest sum is traced back from the longest, so that among
    equally full bins long pieces go first.
    """
    mask, reach, steps = (1 << capacity + 1) - 1, 1, []
    for n in sorted(counts):
        left, power = min(counts[n], capacity // n), 1
        while left:
            times = min(power, left)
            steps.append((n, times, reach))
            reach |= reach << n * times & mask
            left -= times
            power *= 2
    total, chosen = reach.bit_length() - 1, []
    for n, times, before in reversed(steps):
        taken = total - n * times
        if taken >= 0 and before >> taken & 1:
            chosen += [n] * times
            total = taken
    return chosen


def bin_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(how often, lengths of one bin) until every piece is in a bin."""
    counts, out = dict(histogram), []
    if counts.get(capacity):
        out.append((counts.pop(capacity), [capacity]))
    while counts:
        # The longest length is placed first: what fills its bin best is sought among the rest.
        longest = max(counts)
        rest = {n: c for n, c in counts.items() if n <= capacity - longest}
        if longest in rest:
            rest[longest] -= 1
            if not rest[longest]:
                del rest[longest]
        lengths = [longest, *fullest(rest, capacity - longest)]
        need = {n: lengths.count(n) for n in lengths}
        times = min(counts[n] // k for n, k in need.items())
        out.append((times, lengths))
        for n, k in need.items():
            counts[n] -= times * k
            if not counts[n]:
                del counts[n]
    return out


def places(patterns: list[tuple[int, list[int]]]) -> dict[int, tuple[list[int], list[tuple[int, int, int]]]]:
    """By length: first ranks of its runs, and for each run (first sequence, pieces a sequence, offset)."""
    out: dict[int, tuple[list[int], list[tuple[int, int, int]]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for times, lengths in patterns:
        offset = 0
        for n in sorted(set(lengths), reverse=True):
            k = lengths.count(n)
            firsts, runs = out.setdefault(n, ([], []))
            firsts.append(used.get(n, 0))
            runs.append((sequence, k, offset))
            used[n] = used.get(n, 0) + times * k
            offset += n * k
        sequence += times
    return out


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with the sequence and the offset each is at.

    Columns doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids (little-endian 32-bit) on
    demand. The pieces are written once to the shared folder, so a lost executor repeats no placement.
    """
    spark = docs.sparkSession
    ship(spark)
    pieces = stored(cut_tokens(docs, tokenizer or default_path("word_bpe_49k.json"), capacity, end_id, keep_ids), "pieces")
    # One row per chunk and length; ranks begin at the pieces of earlier chunks.
    counted = pieces.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # At most one row per possible length.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    by_length = places(bin_patterns(histogram, capacity))
    shared = spark.sparkContext.broadcast(by_length)

    def place(batches: Iterator) -> Iterator:
        import pyarrow as pa
        table = shared.value
        for batch in batches:
            sequences, offsets = [], []
            for n, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist(), strict=True):
                firsts, runs = table[n]
                i = bisect.bisect_right(firsts, rank) - 1
                sequence, k, offset = runs[i]
                sequences.append(sequence + (rank - firsts[i]) // k)
                offsets.append(offset + (rank - firsts[i]) % k * n)
            kept = batch.drop_columns(["rank"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())],
                                             names=[*kept.schema.names, "sequence_id", "offset"])

    own = PIECES.split(", chunk")[0] + (", ids binary" if keep_ids else "")
    ranked = pieces.join(bases, ["length", "chunk"]).select(
        *[c.split()[0] for c in own.split(", ")], (F.col("base") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(place, own + ", sequence_id bigint, offset bigint")
