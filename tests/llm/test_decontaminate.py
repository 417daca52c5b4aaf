"""Operator 12 against brute force and DuckDB."""

import hashlib
import random
import re

import pytest
from conftest_llm import EDGE, SF
from oracle_check import compare, duck

from quayside.llm import decontaminate, queries
from quayside.llm.shipping import ship_package

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(rows, bench, window=10):
    windows = {}
    for item, text in bench:
        w = words(text)
        if item is not None and w:
            for i in range(max(1, len(w) - window + 1)):
                windows.setdefault(tuple(w[i:i + window]), set()).add(str(item))
    sizes, out = {len(w) for w in windows}, []
    for i, text in rows:
        w, hit, items = words(text), set(), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if (x := windows.get(tuple(w[at:at + n]))):
                    hit.update(range(at, at + n))
                    items |= x
        out.append((str(i), len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def got(df):
    return sorted((str(r[0]), *tuple(r)[1:6]) for r in df.collect())


def test_oracle(spark):
    r = compare(queries.QUERIES["op12_suffix_decontamination"](spark, SF), duck(SF), queries.ORACLE_SQL["op12_suffix_decontamination"])
    assert r["columns_match"] and r["hash_match"] and not r["type_mismatches"], r


BENCH = [(1, "one"), (2, "The CAT sat, on the mat"), (2, "word word word"), (3, None), (4, " ., "), (None, "secret"), (5, "password: hunter22 token=ab token=token:abcdefgh deadbeef"),
         (6, "the cat sat on the mat the cat sat on the mat the cat"), (60, "the cat sat on the mat the cat sat on the mat the cat"), (7, "日本語 😀 x"), (8, "word " * 12)]


def test_odd_texts(spark, edge, none):
    bench = spark.createDataFrame([(i, t, 1) for i, t in BENCH], "item_id long, text string, n_words int")
    rows = [(i, t) for i, t, _, _ in EDGE]
    assert got(decontaminate.contamination(edge, bench)) == plain(rows, BENCH)
    assert any(r[2] for r in plain(rows, BENCH))
    # small shards and one block for every few words give the same
    assert got(decontaminate.contamination(edge, bench, shard_words=20, block_words=8)) == plain(rows, BENCH)
    assert decontaminate.contamination(none, bench).count() == 0
    assert got(decontaminate.contamination(edge, bench.limit(0))) == plain(rows, [])
    kept = decontaminate.remove_contaminated(edge, bench)
    assert kept.columns == edge.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(r[0] for r in plain(rows, BENCH) if not r[5])


@pytest.mark.parametrize("window", [10, 4])
def test_random_texts(spark, monkeypatch, window):
    ship_package(spark)
    rng = random.Random(window)
    vocabulary = [f"w{i}" for i in range(30)]
    bench = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 8, 9, 10, 11, 40])))) for i in range(30)]
    bench += [(100 + i, bench[5][1]) for i in range(20)]
    rows = []
    for i in range(120):
        w = [rng.choice(vocabulary + ["other"] * 5) for _ in range(rng.randrange(60))]
        if i % 3 == 0:
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(bench)[1].split()
        rows.append((i, ", ".join(w)))
    rows += [(500 + i, bench[5][1]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = spark.createDataFrame(bench, "item_id long, text string")
    assert got(decontaminate.contamination(docs, df, window)) == plain(rows, bench, window)
    # items cut into pieces, many blocks, small shards
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 16)
    assert got(decontaminate.contamination(docs, df, window, shard_words=100, block_words=60)) == plain(rows, bench, window)


def test_longest_matches(spark):
    ship_package(spark)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)]
    bench = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 6, 30, 60])))) for i in range(25)]
    rows = []
    for i in range(60):
        w = [rng.choice(vocabulary + ["zz"]) for _ in range(40)]
        if i % 2:
            item = rng.choice(bench)[1].split()
            a = rng.randrange(len(item))
            w[7:7] = item[a:a + rng.randrange(1, 50)]
        rows.append((i, " ".join(w)))
    want = {}
    for item, text in bench:
        t = text.split()
        least = min(4, len(t))
        found = []
        for d, doc in rows:
            w = doc.split()
            for a in range(len(t)):
                for b in range(len(w)):
                    n = 0
                    while a + n < len(t) and b + n < len(w) and t[a + n] == w[b + n]:
                        n += 1
                    if n >= least:
                        found.append((-n, a, d, b))
        if found:
            want[str(item)] = min(found)[:2]
    docs, df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2), spark.createDataFrame(bench, "item_id long, text string")
    texts = dict(rows)
    for kw in ({}, {"shard_words": 300, "block_words": 90}):
        out = decontaminate.longest_matches(docs, df, 4, **kw).collect()
        assert {r.item_id: (-r.n_words, r.item_at) for r in out} == want
        for r in out:
            assert texts[r.doc_id].split()[r.doc_at:r.doc_at + r.n_words] == dict(bench)[int(r.item_id)].split()[r.item_at:r.item_at + r.n_words]
