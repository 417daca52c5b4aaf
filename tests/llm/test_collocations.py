"""Operator 13 against brute force and DuckDB."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from conftest_llm import EDGE, SF
from oracle_check import compare, duck

from quayside.llm import collocations, queries
from quayside.llm.collocations import Transducer
from quayside.llm.shipping import ship_package


def plain(rows, least=10, top=2000, inside=50, longest=3):
    f, total = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", "".join(c.lower() if c.isascii() else c for c in text or "")):
            w = re.findall("[^ \t]+", piece)
            total[lang or ("und" if lang is None else lang)] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[("und" if lang is None else lang, tuple(w[i:i + k]))] += 1
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, p), a in found.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                longer[lang, p[i:i + size]] = max(longer[lang, p[i:i + size]], a)
    by_lang = {}
    for (lang, p), a in found.items():
        if 100 * longer[lang, p] >= inside * a:
            continue
        score, k = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, n, x[2].decode(), -x[1], x[3], x[4], total[lang], -x[0]) for lang, some in by_lang.items() for n, x in enumerate(sorted(some)[:top], 1))


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def test_oracle(spark):
    r = compare(queries.QUERIES["op13_collocations"](spark, SF), duck(SF), queries.ORACLE_SQL["op13_collocations"])
    assert r["columns_match"] and r["hash_match"] and not r["type_mismatches"], r


def test_table(spark, docs):
    want = plain([(r.lang, r.text) for r in docs.collect()])
    assert len(want) > 100
    assert got(queries.QUERIES["op13_collocations"](spark, SF)) == want
    # many flushes and many ranges
    assert got(collocations.top_phrases(docs, flush_words=3_000, range_bytes=20_000)) == want


def test_odd_texts(edge, none):
    rows = [(lang, t) for _, t, lang, _ in EDGE]
    for kw in ({"least": 10}, {"least": 1, "flush_words": 1, "range_bytes": 4_000}, {"least": 2, "top": 3, "inside": 100}):
        plain_kw = {k: v for k, v in kw.items() if k in ("least", "top", "inside")}
        assert got(collocations.top_phrases(edge, **kw)) == plain(rows, **plain_kw)
    assert collocations.top_phrases(none).count() == 0


def test_ties_hot_words_and_containment(spark):
    ship_package(spark)
    rng, rows = random.Random(3), []
    for i in range(400):
        words = ["the"] * rng.randrange(4) + [rng.choice(["of the", "new york city", "a b", "b a b", "é É", "x\x0by"]) for _ in range(rng.randrange(8))]
        rows.append((rng.choice(["en", "en", None, "und", ""]), f"{' '.join(words)}{rng.choice('.,;: !?')}{' '.join(reversed(words))}\tThe  END", 1, "r"))
    df = spark.createDataFrame(rows, "lang string, text string, n long, rank string").repartition(4)
    for kw in ({}, {"flush_words": 200, "range_bytes": 300}):
        assert got(collocations.top_phrases(df, **kw)) == plain([r[:2] for r in rows])
    assert got(collocations.top_phrases(df, longest=4, flush_words=500, range_bytes=900)) == plain([r[:2] for r in rows], longest=4)


def test_large_counts_are_exact():
    def grams(counts):
        return Transducer.build(pa.array([b"a", b"b"]), [([np.array([0, 1])], np.array(counts)), ([np.array([0]), np.array([1])], np.array([5])), ([np.zeros(0, int)] * 3, np.zeros(0, int))])

    t = grams([3 * 10**12, 7])
    t, words = collocations.union([Transducer.unpack(t.labels, t.pack()), t])
    assert words == 6 * 10**12 + 14
    assert t.weights(pa.array([b"a", b"a b", b"b a", b"b", b"z", b"a b a"])).tolist() == [6 * 10**12, 10, 0, 14, 0, 0]
    assert Transducer.unpack(t.labels, t.pack()).weights(pa.array([b"a"])).tolist() == [6 * 10**12]
    rare, words = collocations.union([t, grams([0, 1])], least=15)
    assert rare.labels.to_pylist() == [b"a", b"b"] and rare.weights(pa.array([b"a", b"b", b"a b"])).tolist() == [6 * 10**12, 15, 15] and words == 6 * 10**12 + 15


def test_sequences_beyond_63_bits():
    rng = np.random.default_rng(1)
    columns = [rng.integers(0, 1 << 40, 500) for _ in range(3)]
    packing = collocations.Packing(columns, 1 << 40)
    assert [c.tolist() for c in packing.unpack(packing.keys)] == [c.tolist() for c in columns]
    assert np.argsort(packing.keys).tolist() == np.lexsort(columns[::-1]).tolist()


def test_chunks_keep_words_whole():
    text = b" ".join(str(i).encode() for i in range(5_000)) + b"." + b"x" * 3_000
    for size in (10, 1_000):
        assert [w for c in collocations.chunks(text, size) for w in collocations.words_of(c).to_pylist()] == collocations.words_of(text).to_pylist()


def test_a_text_over_many_flushes(spark, monkeypatch):
    ship_package(spark)
    rng = random.Random(9)
    rows = [("en", " ".join(rng.choice(["a", "b", "c d", "e. f", "g"]) for _ in range(3_000))), ("fr", "a b c " * 20)]
    monkeypatch.setattr(collocations, "chunks", lambda text, cut=collocations.chunks: cut(text, 40))
    df = spark.createDataFrame(rows, "lang string, text string")
    assert got(collocations.top_phrases(df, flush_words=25, range_bytes=2_000)) == plain(rows)
