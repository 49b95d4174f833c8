"""The trie of conversations' prefixes: which turns conversations share, from their start.

Distinct conversations are sorted as sequences of turns; neighbours then share the longest prefixes, and their
common lengths (LCP) are the edges of a forest. Union-find takes the edges in descending depth: two components
that meet at depth L first climb to L, which closes the nodes on the way, and every merge makes, or widens, the
branching node at depth L. A component carries the sums of its subtree, so each node is written once, closed.

Blocks of the sorted order do this side by side. A node that holds a block's first or last conversation may
go on beyond the block and stays open: what the block knows of it (members, closed children, their sums) is a partial.
The block's forest is thus contracted to its two outer conversations with a partial for each depth. These are
sorted and go through the same union-find again, which adds the partials of one node, until one block is left, whose
nodes all close. A closed child of an open node learns its parent's smallest member by the digest of the parent's prefix.

Defined results: a conversation is a non-null ``conv_id`` (rows without one take no part); turns are ordered by
``turn``, null first, then role, then text; rows that repeat are turns each; null role or text is empty; a table without
rows has no node. Only ``conv_id``, ``turn``, ``role`` and ``text`` are read. Equal conversations are folded before
they are sorted, and the digest over the members that end at a node is streamed over sorted pieces, so a group of copies
of any size meets no single task. A conversation is one row of 32 digits and a size for each turn (10 million turns
are 400 MB): texts themselves move once, to be ordered.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window, functions as F

from .runtime import ship, stored

#: Hex digits of a turn's digest.
DIGITS = 32
#: Turns that a conversation may take over, at most, and conversations that share what they take.
HEAD, FAMILY = 8, 5
#: Conversations of a block, and digits of their keys, about, and conversations at least.
BLOCK, BLOCK_DIGITS, LEAST = 20_000, 1 << 25, 16
#: Ids of a piece of the list of members that end at a node.
PIECE = 4_096

PARTIAL = "struct<depth:bigint,n:bigint,least:bigint,children:bigint,leaves:bigint,weighted:bigint,once:bigint,ends:string>"
ITEM = f"key string, sizes array<bigint>, at array<{PARTIAL}>"
NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends string, node string, parent string")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id and seq, its turns (digest, size in bytes): the first h of the family's first conversation, then its own from h on."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint"), F.col("turn"), role.alias("role"), text.alias("text"))
    place = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    marked = rows.withColumn("pos", F.row_number().over(place)).select(
        "conv_id", "pos", F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, DIGITS).alias("digest"),
        F.octet_length("text").cast("bigint").alias("size"))
    own = marked.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "size"))).alias("own"))
    own = stored(own.select("conv_id", F.transform("own", lambda t: F.struct(t["digest"], t["size"])).alias("own"),
                            (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).cast("int").alias("h")), "conversations")
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.slice("own", 1, HEAD).alias("head"))
    joined = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "base", "left")
    taken = F.slice(F.coalesce("head", F.array().cast("array<struct<digest:string,size:bigint>>")), F.lit(1), F.col("h"))
    return joined.select("conv_id", F.concat(taken, F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0)))).alias("seq"))


def _columns(rows: list[tuple], schema):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def ends(members: DataFrame) -> DataFrame:
    """id and ends: SHA-256 of the decimal conv_ids of each id, ascending, with commas between.

    Ranges of the order (id, conv_id) are read as they come. A list that lies inside a range is hashed there; of a
    list that is long, or first or last in its range, pieces are written, and hashed in their order afterwards.
    """
    ship(members.sparkSession)

    def pieces(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        schema = pa.schema([("id", pa.string()), ("chunk", pa.int64()), ("part", pa.int64()), ("listed", pa.string()), ("ends", pa.string())])
        chunk, name, first, own, part, out = TaskContext.get().partitionId(), None, True, [], 0, []
        for batch in batches:
            for each, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if each != name:
                    if name is not None:
                        listed, whole = ",".join(own), not first and not part
                        out.append((name, chunk, part, None if whole else listed, hashlib.sha256(listed.encode()).hexdigest() if whole else None))
                        first = False
                    name, own, part = each, [], 0
                elif len(own) == PIECE:
                    out.append((name, chunk, part, ",".join(own), None))
                    own, part = [], part + 1
                own.append(str(conv))
                if len(out) >= 1_000:
                    yield _columns(out, schema)
                    out = []
        if own:
            out.append((name, chunk, part, ",".join(own), None))
        if out:
            yield _columns(out, schema)

    def joined(batches: Iterator) -> Iterator:
        import pyarrow as pa
        schema = pa.schema([("id", pa.string()), ("ends", pa.string())])
        name, state = None, None
        for batch in batches:
            out = []
            for each, listed in zip(batch.column(0), batch.column(1)):
                each, listed = each.as_py(), listed.as_py().encode()
                if each != name:
                    if name is not None:
                        out.append((name, state.hexdigest()))
                    name, state = each, hashlib.sha256(listed)
                else:
                    state.update(b",")
                    state.update(listed)
            if out:
                yield _columns(out, schema)
        if name is not None:
            yield _columns([(name, state.hexdigest())], schema)

    ordered = members.select("id", "conv_id").repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
    found = stored(ordered.mapInArrow(pieces, "id string, chunk bigint, part bigint, listed string, ends string"), "members")
    rest = found.where("ends is null").repartition("id").sortWithinPartitions("id", "chunk", "part").select("id", "listed")
    return found.where("ends is not null").select("id", "ends").unionByName(rest.mapInArrow(joined, "id string, ends string"))


def common(a: str, b: str) -> int:
    """Turns that two keys share from their start."""
    at, most = 0, min(len(a), len(b))
    while at < most and a[at:at + DIGITS] == b[at:at + DIGITS]:
        at += DIGITS
    return at // DIGITS


def _plus(a: list | None, b: list) -> list:
    """Two partials of one node: [n, least, children, leaves, weighted, once, ends]."""
    if a is None:
        return b
    return [a[0] + b[0], b[1] if a[1] is None else a[1] if b[1] is None else min(a[1], b[1]), a[2] + b[2], a[3] + b[3], a[4] + b[4], a[5] + b[5], a[6] or b[6]]


_NONE = [0, None, 0, 0, 0, 0, None]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


class Forest:
    """Union-find over the LCP edges of sorted ``items`` (key, sizes, {depth: partial}), the deepest first.

    ``rows`` are the closed nodes, ``outer`` the partials of the open ones at the first and last item. With ``close`` all close.
    """

    def __init__(self, items: list[tuple[str, list[int], dict[int, list]]], close: bool, named: bool):
        self.items, self.close, self.named = items, close, named
        n = len(items)
        self.last = n - 1
        self.up = list(range(n))
        self.low, self.high = list(range(n)), list(range(n))
        #: Depth of a component's top node, the sums of that node's closed children, partials at or above it, rows whose parent it is.
        self.depth = [len(key) // DIGITS for key, _, _ in items]
        self.child = [_NONE] * n
        self.partials = [at for _, _, at in items]
        self.waiting: list[list[int]] = [[] for _ in range(n)]
        self.rows: list[list] = []
        self.outer: dict[int, dict[int, list]] = {0: {}, self.last: {}}
        edges = [common(a[0], b[0]) for a, b in zip(items, items[1:])]
        for i in sorted(range(n - 1), key=edges.__getitem__, reverse=True):
            self._merge(self._root(i), self._root(i + 1), edges[i])
        self._climb(self._root(0), -1)

    def _root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def _name(self, i: int, depth: int) -> str:
        return hashlib.md5(self.items[i][0][:depth * DIGITS].encode()).hexdigest()

    def _climb(self, root: int, to: int) -> None:
        """Finish the nodes of a component below depth ``to``."""
        while self.depth[root] > to:
            d = self.depth[root]
            node = _plus(self.partials[root].pop(d, None), self.child[root])
            waiting = self.waiting[root]
            if not self.close and (self.low[root] == 0 or self.high[root] == self.last):
                self.outer[0 if self.low[root] == 0 else self.last][d] = node
                if waiting:
                    name = self._name(root, d)
                    for r in waiting:
                        self.rows[r][9] = name
                self.child[root], self.waiting[root] = _NONE, []
            else:
                n, least, children, leaves, weighted, once, own_ends = node
                size = self.items[root][1][d - 1] if d else 0
                leaves, weighted, once = leaves if children else 1, weighted + n * size, once + size
                for r in waiting:
                    self.rows[r][2] = least
                self.rows.append([least, d, None, n, children, leaves, weighted - once, own_ends or _NO_ENDS,
                                  self._name(root, d) if self.named else None, None])
                self.child[root], self.waiting[root] = [n, least, 1, leaves, weighted, once, None], [len(self.rows) - 1]
            self.depth[root] -= 1

    def _merge(self, a: int, b: int, depth: int) -> None:
        self._climb(a, depth)
        self._climb(b, depth)
        if len(self.waiting[a]) + len(self.partials[a]) < len(self.waiting[b]) + len(self.partials[b]):
            a, b = b, a
        self.up[b] = a
        self.low[a], self.high[a] = min(self.low[a], self.low[b]), max(self.high[a], self.high[b])
        self.child[a] = _plus(self.child[a], self.child[b])
        self.waiting[a].extend(self.waiting[b])
        for d, p in self.partials[b].items():
            self.partials[a][d] = _plus(self.partials[a].get(d), p)
        self.waiting[b], self.partials[b] = [], {}

    def contracted(self) -> list[tuple]:
        """The outer items with their partials, as rows of ITEM."""
        return [(self.items[i][0], self.items[i][1], [(d, *p) for d, p in sorted(at.items())]) for i, at in sorted(self.outer.items())]


def _level(items: DataFrame, close: bool, named: bool, most: tuple[int, int, int]) -> DataFrame:
    """Rows of NODE and, where ``key`` is not null, of ITEM: one forest a block of the sorted ``items``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    ship(items.sparkSession)
    schema = to_arrow_schema(StructType.fromDDL(f"{NODE}, {ITEM}"))
    most_items, most_digits, least = most

    def run(batches: Iterator) -> Iterator:
        block, digits = [], 0

        def closed(block: list):
            forest = Forest(block, close, named)
            rows = [(*r, None, None, None) for r in forest.rows]
            if not close:
                rows += [(*[None] * 10, *i) for i in forest.contracted()]
            for at in range(0, len(rows), 10_000):
                yield _columns(rows[at:at + 10_000], schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                for key, sizes, partials in zip(*(part.column(i).to_pylist() for i in range(3))):
                    if not close and len(block) >= least and (len(block) >= most_items or digits >= most_digits):
                        yield from closed(block)
                        block, digits = [], 0
                    block.append((key, sizes, {p["depth"]: list(p.values())[1:] for p in partials}))
                    digits += len(key)
        if block:
            yield from closed(block)

    ordered = (items.repartition(1) if close else items.repartitionByRange("key")).sortWithinPartitions("key")
    return stored(ordered.mapInArrow(run, f"{NODE}, {ITEM}"), "trie")


def trie(conversations: DataFrame, most: tuple[int, int, int] = (BLOCK, BLOCK_DIGITS, LEAST)) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    ``most`` bounds blocks, and the last one, by conversations and by digits of their keys, but not below so many conversations.
    """
    key = F.array_join(F.transform("seq", lambda t: t["digest"]), "")
    convs = stored(rebuilt(conversations).select("conv_id", key.alias("key"), F.transform("seq", lambda t: t["size"]).alias("sizes"))
                   .withColumn("id", F.md5("key")), "rebuilt")
    folded = convs.groupBy("id").agg(F.first("key").alias("key"), F.first("sizes").alias("sizes"),
                                     F.count("*").alias("n"), F.min("conv_id").alias("least"))
    zero = F.lit(0).cast("bigint")
    at = F.struct((F.length("key") / DIGITS).cast("bigint").alias("depth"), F.col("n"), F.col("least"), zero.alias("children"),
                  zero.alias("leaves"), zero.alias("weighted"), zero.alias("once"), F.col("ends"))
    items = folded.join(ends(convs), "id").select("key", "sizes", F.array(at).alias("at"))
    if most[2] < 4:
        raise ValueError("a block needs four conversations at least, for only its two outer ones go on")
    levels, before = [_level(items, close=False, named=False, most=most)], math.inf
    while True:
        items = levels[-1].where("key is not null").select("key", "sizes", "at")
        size = items.agg(F.count("*").alias("n"), F.sum(F.length("key")).alias("digits")).first()
        if size["n"] <= most[0] and (size["digits"] or 0) <= most[1] or size["n"] <= most[2]:
            break
        if 2 * size["n"] > before:  # ranges of a few very long conversations each: another round would not contract them
            break
        before = size["n"]
        levels.append(_level(items, close=False, named=True, most=most))
    levels.append(_level(items, close=True, named=True, most=most))
    nodes = [level.where("key is null").drop("key", "sizes", "at") for level in levels]
    upper = nodes[1]
    for more in nodes[2:]:
        upper = upper.unionByName(more)
    every = nodes[0].unionByName(upper)
    parents = upper.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256")]
    told = every.where("parent is null").select(*columns)
    asked = every.where("parent is not null").join(parents, "parent").withColumn("parent_conv_id", F.col("above")).select(*columns)
    return told.unionByName(asked)
