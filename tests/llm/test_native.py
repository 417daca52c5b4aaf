"""Operators 3 and 4 against DuckDB and plain Python."""

import re

import pytest
from conftest_llm import EDGE, SF, plain_redaction, plain_spans
from oracle_check import compare, duck

from quayside.llm import mixing, queries, secret_scan
from quayside.llm.secret_scan import Rule

@pytest.mark.parametrize("name", ["op3_secret_scan", "op4_mix_sources", "op10_quality_rules"])
def test_oracle(spark, name):
    r = compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLE_SQL[name])
    assert r["columns_match"] and r["hash_match"] and not r["type_mismatches"], r


def test_plans_are_native(spark):
    for name in ("op3_secret_scan", "op4_mix_sources"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_spans_of_odd_texts(edge, none):
    got = secret_scan.secret_digest(edge).collect()
    assert sorted((str(r.doc_id), r.spans) for r in got) == sorted((str(i), plain_spans(t)) for i, t, _, _ in EDGE)
    assert any(r.n_assign and r.n_access and r.n_hex for r in got)
    assert secret_scan.secret_digest(none).count() == 0


def test_ledger_scans_only_what_is_new(spark, edge, none, tmp_dir):
    ledger = f"{tmp_dir}/ledger"
    blobs = len({t or "" for _, t, _, _ in EDGE})
    assert secret_scan.scan(edge, ledger) == 3 * blobs
    assert secret_scan.scan(edge, ledger) == 0
    assert secret_scan.scan(none, ledger) == 0
    more = edge.union(edge.filter("doc_id = 1").withColumn("text", edge["source"]))
    assert secret_scan.scan(more, ledger) == 3
    raised = (secret_scan.RULES[0], Rule("access", "AKIA[A-Z0-9]{16,}", 0, 20, version=2), secret_scan.RULES[2])
    assert secret_scan.scan(edge, ledger, raised) == blobs
    assert sorted((str(r.doc_id), r.spans) for r in secret_scan.secret_digest(edge, ledger, raised).collect()) == sorted((str(i), plain_spans(t)) for i, t, _, _ in EDGE)


def test_redaction(edge, none):
    got = secret_scan.redact(edge)
    assert got.columns == edge.columns
    assert sorted((str(r.doc_id), str(r.text), r.spans) for r in got.collect()) == sorted((str(i), str(plain_redaction(t)), "s") for i, t, _, _ in EDGE)
    assert secret_scan.redact(none).count() == 0


def water_fill(sizes, weights=(5, 2, 1), budget=1.5, most=2):
    """Targets by resharing until no source is above its limit."""
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    left, open_sources, target = budget * sum(sizes.values()), set(sizes), {}
    while open_sources:
        total = sum(weight[s] for s in open_sources)
        full = {s for s in open_sources if left * weight[s] / total > most * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in open_sources}
        for s in full:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in full)
        open_sources -= full
    return target


def test_mix_of_odd_texts(edge, none):
    got = mixing.mix_sizes(edge).collect()
    sizes, words = {}, []
    for i, t, _, s in EDGE:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        sizes[s] = sizes.get(s, 0) + n
        words.append((str(i), n, s))
    target = water_fill(sizes)
    assert sorted((str(r.doc_id), r.size, r.source_size, round(r.target, 6)) for r in got) == sorted((i, n, sizes[s], round(target[s], 6)) for i, n, s in words)
    for r in got:
        assert r.taken == r.copies * r.size <= 2 * r.size
    assert sorted(map(tuple, mixing.mix_sizes(edge).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert mixing.mix_sizes(none).count() == 0 and mixing.emit(none).count() == 0
    out = mixing.emit(edge)
    assert out.columns == edge.columns and out.count() == sum(r.copies for r in got)


def test_targets_match_resharing(spark):
    cases = [{"a": 10, "b": 1000, "c": 3, None: 50}, {"a": 0, "b": 0}, {"x": 7}, {f"s{i}": (i * 37) % 101 for i in range(40)}]
    for sizes in cases:
        df = spark.createDataFrame([(k, s, n) for k, (s, n) in enumerate(sizes.items())], "doc_id long, source string, size long")
        got = {r.source: r.target for r in mixing.mix_plan(df).collect()}
        want = water_fill(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_taken_words_are_near_the_targets(spark):
    rows = [(i, "w " * (5 + i % 7), f"s{i % 3}") for i in range(9000)]
    by = {}
    for r in mixing.mix_sizes(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        t = by.setdefault(r.target, [0])
        t[0] += r.taken
    assert all(abs(taken[0] / target - 1) < 0.05 for target, taken in by.items())


def test_many_spans_in_one_text(spark):
    """Blocks of spans give what a plain walk gives, also where spans touch, overlap or are dropped."""
    kinds = ("password=abcdef{0}", "secret:abc", "AKIA" + "A" * 16 + "{0}", "é{0} 0123456789abcdef0123456789", "token=0123456789abcdef0123456789")
    texts = {n: " \n".join(kinds[(k * k + n) % 5].format(k) for k in range(n)) for n in (1, 2, 3, 4, 5, 9, 10, 300, 2000)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in secret_scan.redact(df).collect()}
    spans = {r.doc_id: r.spans for r in secret_scan.secret_digest(df).collect()}
    for n, text in texts.items():
        want, out, at = [], "", 0
        for rank, rule in enumerate(secret_scan.RULES):
            for m in re.finditer(rule.pattern, text):
                if len(m.group(rule.group)) >= rule.least:
                    want.append((m.start(), rank, m.end(), rule.kind))
        want.sort()
        assert spans[n] == ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in want), n
        for a, _, b, _ in want:
            if a > at or not out:
                out += text[at:a] + "[secret]"
            at = max(at, b)
        assert got[n] == out + text[at:], n
