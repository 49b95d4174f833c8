import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest

from curbline.llm import prefix_trie, queries
from odd_rows import SMALL
import oracle

TURNS = "conv_id bigint, turn int, role string, text string, key string, n int, depth int"


def plain_nodes(rows):
    """The contract, written plainly over all prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        seq = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:])
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = Counter(s[:-1] for s in members if s)
    leaves, saved = Counter(), Counter()
    for s in members:
        for d in range(len(s) + 1):
            saved[s[:d]] += (len(members[s]) - 1) * (len(s[-1][1].encode()) if s else 0)
            leaves[s[:d]] += not children[s]
    return Counter((members[s][0], len(s), members[s[:-1]][0] if s else None, len(members[s]), children[s], leaves[s], saved[s],
                    hashlib.sha256(",".join(map(str, ends[s])).encode()).hexdigest()) for s in members)


def found(df, **kw):
    return Counter(tuple(r) for r in prefix_trie.trie(df, **kw).collect())


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2) for r in rows], TURNS)


#: Hot first turn, copies of a conversation, a conversation that begins another, one long, and odd values.
ROWS = ([(c, t, "user" if t % 2 else "system", f"turn {t}" if t < 3 else f"own {c} {t}") for c in range(0, 60) for t in range(5)]
        + [(c, t, "user", f"same {t}") for c in range(100, 160) for t in range(1 + c % 4)]
        + [(200, t, "user", f"long {t % 7}") for t in range(300)] + [(205, t, "user", f"long {t % 7}") for t in range(260)]
        + [(7_000_000_001, None, None, None), (7_000_000_001, 1, None, "ä😀"), (7_000_000_001, 1, None, "ä😀"), (7_000_000_001, None, "", "x"),
           (-3, 2, "user", ""), (-3, 1, "user", "first"), (-5, 1, "user", "first"), (None, 1, "user", "nobody"), (8, 0, "system", "turn 0")])


@pytest.mark.parametrize("most", [(20_000, 1 << 25, 16), (4, 1 << 25, 4), (1_000, 4_000, 4)])
def test_nodes_equal_brute_force_in_any_blocks(spark, most):
    df = conversations(spark, ROWS).repartition(5)
    assert found(df, most=most) == plain_nodes(ROWS)


def test_turnless_conversations_and_empty_tables(spark):
    lone = [(c, 1, "user", "only") for c in (1, 2, 3, 4, 11, 12, 13)]
    assert found(conversations(spark, lone)) == plain_nodes(lone)
    assert found(conversations(spark, [])) == Counter()
    nobody = [(None, 1, "user", "x")]
    assert found(conversations(spark, nobody)) == Counter()


def test_whole_table_equals_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert found(df, most=(7, 1 << 25, 4)) == plain_nodes([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])


def test_oracle_gives_the_same_rows(spark):
    con = oracle.connect(SMALL)
    sql = queries.ORACLES["op11_prefix_trie"]
    df = queries.op11_prefix_trie(spark, SMALL)
    assert oracle.spark_rows(df) == oracle.duck_rows(con, sql)
    assert not oracle.type_mismatches(df, con, sql)


def test_members_of_a_large_group_are_hashed_in_pieces(spark):
    """A third of all conversations are copies: their list is cut into pieces, and no task of the trie holds them."""
    ids = list(range(0, 3 * prefix_trie.PIECE))
    members = spark.createDataFrame([("hot", i) for i in ids] + [(f"own{i}", i) for i in range(50)], "id string, conv_id bigint").repartition(7)
    got = {r.id: r.ends for r in prefix_trie.ends(members).collect()}
    assert got["hot"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert len(got) == 51 and got["own7"] == hashlib.sha256(b"7").hexdigest()
