"""Alignment of two tokenizers over the same text, and how often their ids meet.

Documents are shuffled by full text and folded; each distinct text is tokenised and aligned once, and its measures are
joined to the doc_ids. A is a byte-level BPE over space + text, B a piece model that adds the space itself. Offsets in
bytes at which a token of A and one of B both end cut the tokens into groups; tokens whose bytes overlap are linked. The
count of an id pair is the number of documents that hold it linked: each distinct text counts as often as it occurs.

Neither tokenizer merges across the start of white space after other text, so units between such places are
aligned once and remembered; a text in which that is not certain is aligned whole. Every text stores its distinct
pairs and their numbers; counting and looking up read these and don't tokenise again. Pairs are summed in tasks before
they are shuffled. The counts (at most one row for each pair of ids) come back to the texts as broadcast slices of
at most ``PAIRS`` rows, as many as there are: usually one; with more, each slice adds its part to the sums.

Defined results: texts null or empty, and those whose tokens of A or B do not spell space + text (U+2581 does not),
have no tokens: zeros and an empty ``groups_sha256``. Strings of special tokens are plain text. Rows that repeat count
and are returned each, null ids too. Only ``doc_id`` and ``text`` are read. A long text is aligned in windows; its
distinct pairs are held at once.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .runtime import byte_slices, kept_in_worker, ship, stored
from .tokens import Encoder, byte_letters, default_path

#: Rows of a slice of the pair counts, which tasks hold while they look up (17 bytes each).
PAIRS = 4_000_000
#: Units longer than this, in code points, are not remembered; of the others two generations of so many, about.
_LONG, _REMEMBERED = 48, 240_000
#: Code points of a window of a long text.
WINDOW = 1 << 19
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
_GAPS = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_MARK = "▁"


class Aligner:
    """``Aligner(a, b)(text)``: measures, SHA-256 of the groups, distinct pair codes and their numbers; None without tokens."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        byte_of = {c: b for b, c in byte_letters().items()}
        names = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.a_bytes[i] = bytes(map(byte_of.__getitem__, name)) if all(c in byte_of for c in name) else name.encode()
        self.width = self.b.vocab_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.width)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = list(map(len, self.a_bytes)), list(map(len, self.b_bytes))
        self.space = self.b.piece_to_id(_MARK)
        #: Cuts are safe if no piece goes on across one.
        self.cuts = not any(_MARK in p.lstrip(_MARK) or "\n" in p for p in pieces)
        self.encoder = Encoder(a_path, special=False)
        self.known: dict[str, tuple | None] = {}
        self.before: dict[str, tuple | None] = {}

    def units(self, spaced: str) -> list[str]:
        """Parts of space + text, each white space and what follows it; more white space may lie inside."""
        if not self.cuts:
            return [spaced]
        if _GAPS.search(spaced):
            return _CUT.split(spaced)
        return [p if p[:1] == "\n" else " " + p for p in spaced.replace("\n", " \n").split(" ")[1:]]

    def windows(self, spaced: str) -> Iterator[str]:
        """``spaced`` in parts of about WINDOW code points, cut where units are."""
        at = 0
        while at < len(spaced):
            cut = _CUT.search(spaced, at + WINDOW) if self.cuts else None
            yield spaced[at:cut.start() if cut else None]
            at = cut.start() if cut else len(spaced)

    def _b_ids(self, units: list[str]) -> list[list[int] | None]:
        """Ids of B for each unit. The model puts a space before a text; where the unit has none, that token goes."""
        coded = self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        return [([self.space] if u == " " else ids) if u[0] == " " else ids[1:] if ids[:1] == [self.space] else None
                for u, ids in zip(units, coded)]

    def _a_ids(self, unit: str) -> list[int]:
        if unit.isascii() and unit[0] == " " and unit[1:].isalpha():  # a word needs the merges alone
            return [t.id for t in self.a.model.tokenize("Ġ" + unit[1:])]
        raw = self.encoder.piece(unit)
        return list(struct.unpack(f"<{len(raw) // 4}I", raw))

    def aligned(self, unit: str, a: list[int], b: list[int] | None) -> tuple[str, bytes, int] | None:
        """Groups, codes of all links, and tokens of A; None if the tokens do not spell ``unit``.

        Each link but a group's last steps on by one token, so there are as many links as tokens without the groups.
        """
        raw, a_size, b_size, width = unit.encode(), self.a_size, self.b_size, self.width
        if b is None or b"".join([self.b_bytes[y] for y in b]) != raw or b"".join([self.a_bytes[x] for x in a]) != raw:
            return None
        if len(a) == 1 and len(b) == 1:
            return f"{a[0]}|{b[0]}", array("I", (a[0] * width + b[0],)).tobytes(), 1
        groups, links, i, j, own_a, own_b, n_a = "", [], 0, 0, "", "", len(a)
        x, y = a[0], b[0]
        ahead = a_size[x] - b_size[y]  # how much farther the token of A ends
        while True:
            links.append(x * width + y)
            if not ahead:
                groups += f"{own_a}{x}|{own_b}{y}"
                i, j, own_a, own_b = i + 1, j + 1, "", ""
                if i == n_a:
                    return groups, array("I", links).tobytes(), n_a
                groups += ";"
                x, y = a[i], b[j]
                ahead = a_size[x] - b_size[y]
            elif ahead < 0:
                own_a += f"{x},"
                i += 1
                x = a[i]
                ahead += a_size[x]
            else:
                own_b += f"{y},"
                j += 1
                y = b[j]
                ahead -= b_size[y]

    def _units(self, units: list[str]) -> list[tuple[str, bytes, int] | None]:
        """``aligned`` of each, remembered: what was not met lately falls out, a generation at a time."""
        known, before = self.known, self.before
        fresh = []
        for u in dict.fromkeys(units):
            if u not in known:
                if u in before:
                    known[u] = before[u]
                else:
                    fresh.append(u)
        known.update((u, self.aligned(u, self._a_ids(u), b)) for u, b in zip(fresh, self._b_ids(fresh) if fresh else ()))
        own = list(map(known.__getitem__, units))
        for u in fresh:
            if len(u) > _LONG:
                del known[u]
        if len(known) > _REMEMBERED:
            self.before, self.known = known, {}
        return own

    def __call__(self, text: str | None):
        if not text or _MARK in text:
            return None
        found = self._whole(self._units(self.units(w)) for w in self.windows(" " + text))
        return found or self._whole([[self.aligned(" " + text, self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text))]])

    def _whole(self, windows):
        n_a, n_groups, n_links, state, sep, codes, numbers = 0, 0, 0, hashlib.sha256(), "", [], []
        for own in windows:
            if None in own:
                return None
            groups, links, sizes = zip(*own)
            groups, links = (sep + ";".join(groups)).encode(), np.frombuffer(b"".join(links), "=u4")
            state.update(groups)
            n_a, n_groups, n_links = n_a + sum(sizes), n_groups + groups.count(b"|"), n_links + len(links)
            code, n = np.unique(links, return_counts=True)
            codes.append(code)
            numbers.append(n)
            sep = ";"
        if len(codes) > 1:
            code, where = np.unique(np.concatenate(codes), return_inverse=True)
            codes, numbers = [code], [np.bincount(where, np.concatenate(numbers), len(code))]
        return np.array([n_a, n_links - n_a + n_groups, n_groups, n_links]), state.hexdigest(), codes[0], numbers[0].astype("<u4")


_aligners: dict[tuple[str, str], Aligner] = kept_in_worker.setdefault("aligners", {})


def aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker process."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def measured(texts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """key, n, measures, groups_sha256, codes and numbers (binary) of the distinct ``texts`` (key, n, text) that have tokens."""
    ship(texts.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        align = aligner(a_path, b_path)
        for batch in batches:
            for part in byte_slices(batch, 2):
                found = list(map(align, part.column(2).to_pylist()))
                keep = pa.array([f is not None for f in found], pa.bool_())
                found = [f for f in found if f is not None]
                sums = np.array([f[0] for f in found], np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).filter(keep), part.column(1).filter(keep), *[pa.array(sums[:, i]) for i in range(4)],
                     pa.array([f[1] for f in found], pa.string()), pa.array([f[2].astype("<u4").tobytes() for f in found], pa.binary()),
                     pa.array([f[3].tobytes() for f in found], pa.binary())],
                    names=["key", "n", *MEASURES, "groups_sha256", "codes", "numbers"])

    schema = f"key string, n bigint, {', '.join(m + ' bigint' for m in MEASURES)}, groups_sha256 string, codes binary, numbers binary"
    return texts.select("key", "n", "text").mapInArrow(run, schema)


def pair_counts(own: DataFrame) -> DataFrame:
    """code, count: the documents that hold each pair. Summed in a task as far as some million pairs go, then shuffled."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def folded(codes: list, weights: list):
            code, where = np.unique(np.concatenate(codes), return_inverse=True)
            return code, np.bincount(where, np.concatenate(weights), len(code)).astype(np.int64)

        def out(code, weight):
            for at in range(0, len(code), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(code[at:at + 200_000].astype(np.int64)), pa.array(weight[at:at + 200_000])],
                                                 names=["code", "count"])

        codes, weights, held = [], [], 0
        for batch in batches:
            for n, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                codes.append(np.frombuffer(raw.as_buffer(), "<u4").copy())
                weights.append(np.full(len(codes[-1]), n, np.int64))
                held += len(codes[-1])
                if held > 2_000_000:
                    code, weight = folded(codes, weights)
                    if len(code) > 1_000_000:
                        yield from out(code, weight)
                        codes, weights, held = [], [], 0
                    else:
                        codes, weights, held = [code], [weight], len(code)
        if codes:
            yield from out(*folded(codes, weights))

    return own.select("n", "codes").mapInArrow(run, "code bigint, count bigint").groupBy("code").agg(F.sum("count").alias("count"))


def looked_up(own: DataFrame, counts: DataFrame, width: int, most: int = PAIRS) -> DataFrame:
    """key, n_best, count_sum of every row of ``own``; ``counts`` (stored) holds code and count."""
    spark = own.sparkSession
    best = counts.groupBy(F.floor(F.col("code") / width).alias("a")).agg(F.max("count").alias("most"))
    marked = stored(counts.withColumn("a", F.floor(F.col("code") / width)).join(best, "a").select(
        "code", "count", (F.col("count") == F.col("most")).alias("best")), "pairs")
    slices = max(1, -(-marked.count() // most))

    def summed(one: DataFrame) -> DataFrame:
        rows = one.select("code", "count", "best").toPandas().sort_values("code")  # a slice: ``most`` rows, about
        shared = spark.sparkContext.broadcast((rows["code"].to_numpy(np.uint32), rows["count"].to_numpy(np.int64), rows["best"].to_numpy(bool)))

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa
            code, count, top = shared.value
            for batch in batches:
                sums = []
                for raw, raw_numbers in zip(batch.column(1), batch.column(2)):
                    own_codes, numbers = (np.frombuffer(r.as_buffer(), "<u4") for r in (raw, raw_numbers))
                    at = np.minimum(np.searchsorted(code, own_codes), max(len(code) - 1, 0))
                    hit = code[at] == own_codes if len(code) else np.zeros(len(own_codes), bool)
                    at, numbers = at[hit], numbers[hit].astype(np.int64)
                    sums.append((int(numbers[top[at]].sum()), int((numbers * count[at]).sum())))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s[0] for s in sums], pa.int64()), pa.array([s[1] for s in sums], pa.int64())],
                                                 names=["key", "n_best", "count_sum"])

        return own.select("key", "codes", "numbers").mapInArrow(run, "key string, n_best bigint, count_sum bigint")

    if slices == 1:
        return summed(marked)
    parts = [summed(marked.where(F.pmod(F.xxhash64("code"), F.lit(slices)) == i)) for i in range(slices)]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, most: int = PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs``."""
    a_path, b_path = a_path or default_path("byte_bpe_50k.json"), b_path or default_path("piece_bpe_32k.model")
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    texts = rows.where(F.length("text") > 0).groupBy("text").agg(F.count("*").alias("n"))
    own = stored(measured(texts.withColumn("key", F.sha2("text", 256)), a_path, b_path), "aligned")
    counts = stored(pair_counts(own), "pair-counts")
    sums = looked_up(own, counts, Aligner(a_path, b_path).width, most)
    found = own.select("key", *MEASURES, "groups_sha256").join(sums, "key")
    named = rows.select("doc_id", F.coalesce(F.sha2("text", 256), F.lit("")).alias("key")).join(found, "key", "left")
    return named.select("doc_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in (*MEASURES, "n_best", "count_sum")],
                        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
