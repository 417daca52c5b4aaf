"""Operator 11 against brute force and DuckDB."""

import hashlib
import random
import zlib

import pytest
from conftest_llm import SF
from oracle_check import compare, duck

from quayside.llm import prefix_trie, queries
from quayside.llm.shipping import ship_package

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, seq string, pos int, depth string"


def plain_sequences(rows):
    own = {}
    for c, turn, role, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    return own


def plain_rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def plain_nodes(convs):
    members = {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[c] for c in below) or 1
        saved[p] = sum(saved[c] for c in below) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
        ends = ",".join(str(c) for c in sorted(c for c in members[p] if len(convs[c]) == len(p)))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    assert df.columns[:8] == COLUMNS
    return sorted((tuple(r)[:8] for r in df.collect()), key=str)


def test_oracle(spark):
    r = compare(queries.QUERIES["op11_prefix_trie"](spark, SF), duck(SF), queries.ORACLE_SQL["op11_prefix_trie"])
    assert r["columns_match"] and r["hash_match"] and not r["type_mismatches"], r


def test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.QUERIES["op11_prefix_trie"](spark, SF)) == plain_nodes(plain_rebuilt(plain_sequences(rows)))


@pytest.mark.parametrize("shards", [1, 2, 5, 13])
def test_prefixes_over_many_shards(spark, shards):
    ship_package(spark)
    rng, rows = random.Random(shards), []
    for c in range(-40, 160):
        if c < 20 or c > 120:                       # copies of one conversation, a third of all rows and more
            turns = [("u", "same"), ("a", "é same"), ("u", "")]
        else:
            turns = [(rng.choice("ua"), rng.choice(["x", "yy", "", "ünï"])) for _ in range(rng.randrange(6))]
        if c == 150:
            turns = [("u", "same"), ("a", "é same"), ("u", "")] + [("u", str(i % 7)) for i in range(3_000)]
        if c == 151:
            turns = [("u", "same"), ("a", "é same"), ("u", "")] + [("u", str(i % 7)) for i in range(2_000)] + [("a", "x" * 100_000)]
        rows += [(c, i, role, text, "s", 1, "d") for i, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    convs = prefix_trie.sequences(spark.createDataFrame(rows, SCHEMA))
    assert got(prefix_trie.trie_nodes(convs, shards)) == plain_nodes(plain_sequences(rows))
    assert got(prefix_trie.trie_nodes(prefix_trie.rebuilt(convs), shards)) == plain_nodes(plain_rebuilt(plain_sequences(rows)))


def test_odd_rows(spark):
    ship_package(spark)
    rows = [(None, 1, "u", "no conversation"), (7, None, "u", "null turn first"), (7, 1, None, "a"), (7, 1, None, "a"), (7, 1, "", None), (8, 3, "u", "late"), (8, -1, "u", None),
            (10, 0, "u", "ab"), (10, 0, "u", "a"), (11, 0, "ua", "b"), (5, None, None, None), (-3, 1, "u", "negative")]
    df = spark.createDataFrame([(*r, "s", 1, "d") for r in rows], SCHEMA)
    convs = prefix_trie.sequences(df)
    for shards in (1, 4):
        assert got(prefix_trie.trie_nodes(convs, shards)) == plain_nodes(plain_sequences(rows))
        assert got(prefix_trie.trie_nodes(prefix_trie.rebuilt(convs), shards)) == plain_nodes(plain_rebuilt(plain_sequences(rows)))
    assert prefix_trie.trie_nodes(prefix_trie.sequences(df.limit(0))).count() == 0
    turns = {(r.conv_id, r.depth): (r.role, r.text) for r in prefix_trie.last_turns(prefix_trie.trie_nodes(convs), df).collect()}
    assert turns[(7, 1)] == ("u", "null turn first") and turns[(-3, 0)] == (None, None) and turns[(10, 1)] == ("u", "a")
