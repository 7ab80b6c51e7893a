"""op13: nodes against SQL and against a walk through nested dictionaries."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from tests.conftest import SMALL
from tests.oracle import same
from wickwork.llm import prefix_trie
from wickwork.llm.base import cut, table

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def expected(rows: list[tuple]) -> list[tuple]:
    """From (conv_id, turn, role, text), by walking a trie."""
    convs: dict[int, list] = {}
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    convs = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in convs.items()}
    members: dict[tuple, list] = {}
    ends: dict[tuple, list] = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole = tuple(convs.get(base, [])[:h] + own[h:])
        ends.setdefault(whole, []).append(c)
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(c)
    kids: dict[tuple, list] = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    saved, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode().split()) if node else 0
        saved[node] = own + sum(saved[k] for k in kids.get(node, []))
        leaves[node] = sum(leaves[k] for k in kids.get(node, [])) or 1
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids.get(n, [])), leaves[n], saved[n], sha(ends.get(n, []))) for n, m in members.items())


def got(spark, rows: list[tuple], tasks: int = 3) -> list[tuple]:
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(tasks)
    out = prefix_trie.trie(prefix_trie.rebuilt(cut(prefix_trie.turns_of(df))))
    return sorted(tuple(r[c] for c in COLUMNS) for r in out.collect())


def test_query_equals_sql_and_walk(spark, duck):
    same(spark, duck, prefix_trie.query, prefix_trie.SQL, SMALL)
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table(spark, SMALL, "conversations").collect()]
    assert got(spark, rows) == expected(rows)


ODD = [
    (None, 1, "user", "of no conversation"), (0, None, "user", "first of all"), (0, 1, None, "x y"), (0, 2, "user", None), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "bot", "a"), (21, 5, "user", "own turns only"),
    (22, 0, "user", ""), (23, 0, "us", "er:x"), (43, 0, "user", ":x"), (-3, 0, "user", "below zero"), (-20, 0, "user", "base below zero"), (-20, 1, "user", "second"), (2**62, 0, "user", "far"), (2**62 + 1, 3, "user", "w " * 50_000),
]


@pytest.mark.parametrize("rows", [ODD, [], [(27, 0, "user", "one turn")], [(None, None, None, None)], [(5, None, None, None)], ODD + ODD])
def test_odd_rows(spark, rows):
    assert got(spark, rows) == expected(rows)


def test_shared_beginnings_and_copies(spark):
    """A third of the conversations identical, another third with one first turn; lengths up to 300 turns."""
    rows = []
    for c in range(600):
        if c % 3 == 0:
            rows += [(c, k, "user", f"the same {k}") for k in range(5)]
        elif c % 3 == 1:
            rows += [(c, 0, "user", "hello there")] + [(c, k, "bot", f"{c // 6} of {k}") for k in range(1, 4)]
        else:
            rows += [(c, k, "user", f"{c} {k}") for k in range(300 if c == 2 else 2)]
    assert got(spark, rows) == got(spark, rows, 50) == expected(rows)


def test_hash_of_ends_crosses_blocks(spark):
    rows = [(c * 1000, 0, "user", "all alike") for c in range(500)]
    found = [r for r in got(spark, rows) if r[1] == 1]
    assert found == [r for r in expected(rows) if r[1] == 1]


def test_other_columns_are_ignored(spark):
    df = spark.createDataFrame([(1, 0, "user", "a", 9, "b"), (2, 0, "user", "a", 8, "c")], "conv_id long, turn long, role string, text string, pos long, node string")
    assert prefix_trie.trie(prefix_trie.turns_of(df)).count() == 2
