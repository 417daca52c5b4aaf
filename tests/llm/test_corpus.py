"""Operators 5, 7, 9, 10 and the pipeline against brute force."""

import collections
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
import xxhash
from conftest_llm import EDGE, PIECES, SF, plain_redaction

import corpus_pipeline
from quayside.llm import langid, lm_score, quality, simhash
from quayside.llm.shipping import ship_package

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


# SimHash

def plain_fingerprint(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, bits=2):
    parent = list(range(len(fps)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[top(i)] = top(j)
    return [top(i) for i in range(len(fps))]


def plain_components(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    group = components(fps)
    least = {}
    for (i, _), g in zip(rows, group):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    return [(str(i), f"{f:016x}", least[g]) for (i, _), f, g in zip(rows, fps, group)]


def test_components_of_tables(docs, edge, none):
    for df in (docs, edge):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        got = simhash.simhash_components(df).collect()
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == sorted((i, f, str(c)) for i, f, c in plain_components(rows))
    assert simhash.simhash_components(none).count() == 0


def test_one_row_of_each_component_stays(edge, none):
    rows = [(i, t) for i, t, _, _ in EDGE]
    groups = collections.defaultdict(set)
    for (i, t), g in zip(rows, components([plain_fingerprint(t) for _, t in rows])):
        groups[g].add(i)
    kept = simhash.near_dedup(edge)
    assert kept.columns == edge.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(min((x for x in g if x is not None), default=None)) for g in groups.values())
    assert simhash.near_dedup(none).count() == 0


def test_pipeline_keeps_a_row_of_each_component(spark, edge):
    rows = [(i, t) for i, t, _, _ in EDGE]
    groups = collections.defaultdict(set)
    for (i, t), g in zip(rows, components([plain_fingerprint(t) for _, t in rows])):
        groups[g].add(i)
    kept = corpus_pipeline.near_duplicates(spark, edge, SF)
    assert kept.columns == edge.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(min((x for x in g if x is not None), default=None)) for g in groups.values())


def test_linked_rows_without_ids_are_one(spark, edge):
    words = [f"w{i}" for i in range(400)]
    first, second = next((a, b) for k in range(400) if 0 < (plain_fingerprint(a := " ".join(words)) ^ plain_fingerprint(b := " ".join(words[:k] + words[k + 1:]))).bit_count() <= 2)
    df = spark.createDataFrame([(None, first), (None, second), (None, "something else")], "doc_id long, text string")
    kept = [r.text for r in simhash.near_dedup(df).collect()]
    assert len(kept) == 2 and "something else" in kept


def test_one_id_with_unrelated_texts_keeps_both(spark):
    ship_package(spark)
    df = spark.createDataFrame([(6, "one text of its own", "b"), (6, "one text of its own", "a"), (6, "something else entirely here", "c")], "doc_id long, text string, source string")
    assert sorted(r.source for r in simhash.near_dedup(df).collect()) == ["a", "c"]


def test_trees_lose_no_link():
    rng = np.random.default_rng(1)
    points = [rng.integers(0, 2**63, 100, dtype=np.uint64)]
    for _ in range(5):
        x = rng.choice(points[-1], 400)
        points.append(x ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)))
    fps = np.unique(np.concatenate([*points, rng.integers(0, 2**63, 1500, dtype=np.uint64)]))
    want = components([int(f) for f in fps])
    at = {int(f): i for i, f in enumerate(fps)}

    def same(stars):
        parent = list(range(len(fps)))

        def top(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for members, first in stars:
            for m in members:
                parent[top(at[int(m)])] = top(at[int(first)])
        number = {}
        return [number.setdefault(top(i), n) for i, n in enumerate(want)] == want and len({top(i) for i in range(len(fps))}) == len(set(want))

    assert same(simhash.stars(fps, 2))
    tree = simhash.DealingTree(rng.choice(fps, 500, replace=False), 12, 2)
    dealt = list(tree.deal(fps))
    assert len(dealt) > 4 and same([s for _, part in dealt for s in simhash.stars(fps[part], 2)])


def test_star_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(500, i) for i in range(300, 400)]
    edges = [(a, b) for a, b in edges if a != b]
    parent = {x: x for e in edges for x in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    got = {r.node: r.root for r in simhash.star_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in parent if top(x) != x}


# language model

def test_lattice_scores(docs, edge, none):
    library = lm_score._library(PIECES)
    for df, key in ((docs.limit(60), "doc_id"), (edge, "doc_id")):
        rows = [(r[key], WORD.findall(lower(r.text))) for r in df.select(key, "text").collect()]
        held = [zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, _ in rows]
        count = collections.Counter(w for (_, ws), h in zip(rows, held) if not h for w in [*ws, ""])
        n, v = sum(count.values()), len(count)
        piece = np.ones(library.get_piece_size() + 1)
        piece[-1] += count[""]
        for w, c in count.items():
            for p in library.encode(w) if w else []:
                piece[p] += c
        logp = np.log(piece / piece.sum())
        ids = {library.id_to_piece(i): i for i in range(library.get_piece_size()) if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))}

        def marginal(word):
            if not word:
                return logp[-1]
            w = "▁" + word
            a = [0.0] + [-math.inf] * len(w)
            for i in range(len(w)):
                if w[i] not in ids:
                    a[i + 1] = np.logaddexp(a[i + 1], a[i] + sum(logp[library.piece_to_id(f"<0x{b:02X}>")] for b in w[i].encode()))
                for k in range(1, 17):
                    if i + k <= len(w) and w[i:i + k] in ids:
                        a[i + k] = np.logaddexp(a[i + k], a[i] + logp[ids[w[i:i + k]]])
            return a[-1]

        memo = {w: marginal(w) for w in {"", *(w for _, ws in rows for w in ws)}}
        want = sorted((str(i), h, len(ws) + 1, sum(count[w] > 0 for w in [*ws, ""]), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in [*ws, ""]), 4),
                       round(sum(memo[w] for w in [*ws, ""]) / math.log(10), 4)) for (i, ws), h in zip(rows, held))
        got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 4)) for r in lm_score.score_documents(df, PIECES).collect())
        assert [g[:5] for g in got] == [w[:5] for w in want]
        assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-6, atol=1e-3)
    assert lm_score.score_documents(none, PIECES).count() == 0


def test_a_long_word_takes_time_by_its_length():
    library = lm_score._library(PIECES)
    rng = np.random.default_rng(3)
    logp = np.log(rng.dirichlet(np.ones(library.get_piece_size())))
    lattice = lm_score.Lattice(PIECES, logp)
    base = "thequickbrownfoxjumpsü日over"
    some = [(base * 400)[:n] for n in (1, 255, 256, 257, 300, 1000, lm_score.STRETCH // 16 + 3)]
    short = lattice._score_block([lm_score.START + w for w in some])
    assert np.allclose(lattice.score(some), short, rtol=1e-9)
    stretch, lm_score.STRETCH = lm_score.STRETCH, 37               # stretches shorter than the word
    try:
        assert np.allclose(lattice.score(some), short, rtol=1e-9)
    finally:
        lm_score.STRETCH = stretch
    began = time.monotonic()
    million = lattice.score([base * 40_000])[0]
    assert len(base) * 40_000 >= 1_000_000 and np.isfinite(million) and time.monotonic() - began < 60


# language ID

def plain_grams(text):
    """Buckets of the 2- and 3-grams; the last 2-gram counts four times."""
    t = " " + re.sub(r"[^a-z]+", " ", text.lower()).strip() + " "
    c = list(map(ord, t))
    two = [(a * 0x9E3779B97F4A7C15 + b) % 2**64 for a, b in zip(c, c[1:])]
    three = [(x * 0xC2B2AE3D27D4EB4F + d) % 2**64 for x, d in zip(two, c[2:])]
    place = lambda h, m: (h * m % 2**64) >> 50
    two = [place(h, 0xD6E8FEB86659FD93) for h in two]
    return two + [place(h, 0xA5CB9243F0AEF993) for h in three] + 3 * two[-1:]


def test_training_counts_what_the_texts_have(spark):
    ship_package(spark)
    rows = [(1, "the cat sat", "en"), (2, "le chat noir", "fr"), (3, "Die Katze!", "de"), (4, "12 34", "en"), (5, "the", "en"), (6, None, "fr"), (7, "x", None),
            (8, "la la", "fr"), (9, "...", "zz"), (9, "die die", "de")]
    counts, docs = collections.defaultdict(collections.Counter), collections.Counter()
    for _, t, lang in rows:
        if t and lang and re.search("[a-z]", t.lower()):
            counts[lang].update(plain_grams(t))
            docs[lang] += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for at_once in (1, 2, 512):
        got = {r.lang: r for r in langid.train(df, at_once=at_once).collect()}
        assert {lang: r.documents for lang, r in got.items()} == docs
        for lang, r in got.items():
            n = np.frombuffer(r.grams, np.int64)
            assert {int(b): int(n[b]) for b in np.flatnonzero(n)} == counts[lang]
        # the posterior, from these counts
        pred = {(r.doc_id, r.lang_pred): r.score for r in langid.predict(df, langid.train(df, at_once=at_once), at_once=at_once).collect()}
        for i, t, _ in rows:
            if not t or not re.search("[a-z]", t.lower()):
                assert pred[i, "und"] == 0
                continue
            total = {lang: math.log(docs[lang] / sum(docs.values())) + sum(math.log((c[g] + 0.5) / (sum(c.values()) + 0.5 * langid.BUCKETS)) for g in plain_grams(t)) for lang, c in counts.items()}
            best = max(total, key=total.get)
            assert pred[i, best] == pytest.approx(1 / sum(math.exp(x - total[best]) for x in total.values()))


def many_labels(spark, docs, n=600):
    """Rows of ``docs`` under n labels, with texts of at least 50 words."""
    texts = [r.text for r in docs.orderBy("doc_id").collect() if r.text and len(r.text.split()) >= 60]
    rows = [(i, " ".join(texts[i % len(texts)].split()[i % 7:70 + i % 11]), f"l{i % n:04d}") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)


def test_more_labels_than_are_held_at_once(spark, docs):
    df = many_labels(spark, docs)
    result = lambda frame: sorted((*r[:-1], round(r[-1], 9)) for r in frame.collect())
    one, blocks = (result(langid.language_id(df, parts=1, part=1, at_once=n)) for n in (1000, 512))
    assert one == blocks and len(langid.label_blocks(df, 512)) == 2
    judged = [sorted((*r[:-2], round(r[-2], 9), round(r[-1], 9)) for r in quality.quality_report(df, at_once=n).collect()) for n in (1000, 512, 250)]
    assert judged[0] == judged[1] == judged[2] and len(judged[0]) == 600
    kept = {r[0] for r in judged[0] if r[7]}
    assert kept
    for n in (512, 250):
        good = quality.keep_good(df.selectExpr("*", "doc_id AS NEAR"), at_once=n)
        assert good.columns == ["doc_id", "text", "lang", "NEAR"] and {r.doc_id for r in good.collect()} == kept


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ship_package(spark)
    lang = {r.doc_id: r.lang for r in df.collect()}
    got = langid.language_id(df).collect()
    assert {r.doc_id: r.held_out for r in got} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in lang}
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_scores_are_the_naive_bayes_posterior(spark, edge, none):
    got = langid.language_id(edge).collect()
    assert len(got) == len(EDGE)
    for r in got:
        assert r.lang_pred in {"en", "fr", "de", "xx", "und"}
    blank = {i for i, t, _, _ in EDGE if not any(c.isalpha() for c in t or "")}
    assert {r.doc_id for r in got if r.lang_pred == "und"} - {None} == blank - {None}
    assert langid.language_id(none).count() == 0
    unlabelled = langid.language_id(edge.withColumn("lang", edge["lang"].substr(9, 1)).withColumn("lang", edge["id"].substr(0, 0)).filter("false"))
    assert unlabelled.count() == 0
    texts, langs = ["the cat", "le chat noir", "", "x"], ["a", "b"]
    rng = np.random.default_rng(0)
    model = np.log(rng.dirichlet(np.ones(langid.BUCKETS + 1), 2))
    pred, p = langid.score(texts, langs, model)
    for t, l, q in zip(texts, pred, p):
        grams, _, ok = langid.buckets_of([t])
        if not ok[0]:
            assert (l, q) == ("und", 0.0)
            continue
        s = model[:, grams].sum(axis=1) + model[:, -1]
        e = np.exp(s - s.max())
        assert l == langs[int(s.argmax())] and q == pytest.approx(e.max() / e.sum())


def test_buckets_do_not_depend_on_the_batch():
    texts = ["abc def", "", "x", "ÀÉ 12 zz", "hello"]
    together, start, _ = langid.buckets_of(texts)
    ends = [*start[1:].tolist(), len(together)]
    for t, a, b in zip(texts, start.tolist(), ends):
        alone, _, _ = langid.buckets_of([t])
        assert (together[a:b] == alone).all()


# quality rules

def plain_features(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeated), n < 50 or 100 * len(repeated) > 50 * n


def plain_js(p, q):
    p, q = p / p.sum(), q / q.sum()
    kl = lambda a, b: sum(x * math.log2(x / y) for x, y in zip(a, b) if x > 0)
    return math.sqrt(max(0.0, (kl(p, (p + q) / 2) + kl(q, (p + q) / 2)) / 2))


def test_quality_features_and_verdict(docs, edge, none):
    for df in (docs, edge):
        rows = df.select("doc_id", "text", "lang").collect()
        references, large = {}, set()
        for lang in {r.lang for r in rows if r.lang is not None}:
            good = [r.text for r in rows if r.lang == lang and r.text is not None and not (f := plain_features(r.text))[5] and f[2] * quality.REFERENCE_SYMBOLS <= f[0]]
            if good:
                classes = sum(quality.class_counts(t) for t in good).astype(float)
                words = collections.Counter(w for t in good for w in WORD.findall(lower(t)))
                top = sorted(words, key=lambda w: (-words[w], w.encode()))[:quality.COMMON]
                references[lang] = classes, top, np.array([words[w] for w in top] + [sum(words.values()) - sum(words[w] for w in top)], float)
                if len(good) >= quality.REFERENCE_DOCUMENTS and sum(words.values()) >= quality.REFERENCE_WORDS:
                    large.add(lang)
        references = {k: v for k, v in references.items() if k in large or not large}
        want = []
        for r in rows:
            f = plain_features(r.text)
            kept = not f[5]
            if kept and references:
                words = collections.Counter(WORD.findall(lower(r.text)))
                scores = []
                for classes, top, counts in references.values():
                    c = plain_js(quality.class_counts(r.text).astype(float), classes)
                    hist = np.array([words[w] for w in top] + [f[0] - sum(words[w] for w in top)], float)
                    w = plain_js(hist, counts) if f[0] >= quality.LEAST_WORDS else 0
                    scores.append(max(c / quality.MAX_CHAR_DISTANCE, w / quality.MAX_WORD_DISTANCE))
                kept = min(scores) <= 1
            want.append((str(r.doc_id), *f, kept))
        got = [(str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in quality.quality_report(df).collect()]
        assert sorted(got) == sorted(want)
        good = quality.keep_good(df)
        assert good.columns == df.columns and sorted(str(r.doc_id) for r in good.collect()) == sorted(w[0] for w in want if w[-1])
    assert quality.quality_report(none).count() == 0 and quality.keep_good(none).count() == 0


def test_labels_agree_with_the_verdict(spark):
    ship_package(spark)
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r.kept for r in quality.quality_report(spark.read.parquet(f"{d}/documents.parquet")).collect() if not r.base_failed}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    clean = [got[i] for i, q in label.items() if q == 1 and i in got]
    junk = [got[i] for i, q in label.items() if q == 0 and i in got]
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.3 * len(junk)


def added(docs, rows):
    """``docs`` and more rows (doc_id, text, lang), in the columns of ``docs``."""
    return docs.unionByName(docs.sparkSession.createDataFrame(rows, "doc_id long, text string, lang string"), allowMissingColumns=True).select(*docs.columns)


def short_good(docs):
    """A text of some 60 words from a document that passes the base rules."""
    for r in docs.filter("lang = 'en'").orderBy("doc_id").collect():
        t = " ".join((r.text or "").split()[:60])
        if len(t) < 600 and "0" not in t and not plain_features(t)[5] and not plain_features(r.text)[5]:
            return t


def test_pipeline_judges_short_texts_by_their_characters(spark, docs):
    junk, good = " ".join(map(str, range(1000, 1060))), short_good(docs)
    assert len(junk) < 600 and not plain_features(junk)[5]
    more = added(docs, [(-1, junk, "en"), (-2, good, "en")])
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, more, SF).collect()}
    assert -2 in kept and -1 not in kept
    # one verdict: the report says the same
    assert kept == {r.doc_id for r in quality.quality_report(more).collect() if r.kept}


def test_pipeline_takes_no_reference_from_a_rare_label(spark, docs):
    junk = " ".join(map(str, range(10_000, 10_200)))
    assert len(junk) >= 600 and not plain_features(junk)[5]
    rows = [(-1, junk, "rare"), (-2, junk + " 7", "en"), (-3, short_good(docs), "rarer")]
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, added(docs, rows), SF).collect()}
    assert -3 in kept and not {-1, -2} & kept
    alone = docs.limit(0).unionByName(added(docs, rows).filter("doc_id = -1"))       # no label has enough: all make references
    assert len(quality.language_references(alone)) == 1


# pipeline

def test_pipeline_stage_by_stage(spark, docs, tmp_dir):
    columns, now = docs.columns, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = now.collect()
        stage(spark, now, SF).write.parquet(f"{tmp_dir}/{k}")
        now = spark.read.parquet(f"{tmp_dir}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == columns, name
        rows = now.collect()
        if name == "quality rules":
            assert 0 < len(rows) < len(before) and not any(plain_features(r.text)[5] for r in rows)
        elif name == "near duplicates":
            assert sorted(r.doc_id for r in rows) == sorted({c for _, _, c in plain_components([(r.doc_id, r.text) for r in before])})
        elif name == "secrets":
            assert sorted((r.doc_id, r.text, r.n_chars) for r in rows) == sorted((r.doc_id, t := plain_redaction(r.text), len(t)) for r in before)
        elif name == "mix":
            assert {r.doc_id for r in rows} <= {r.doc_id for r in before} and max(collections.Counter(r.doc_id for r in rows).values()) <= 2
        else:
            assert len(rows) == len(before)
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, now.collect()))


def test_pipeline_of_an_empty_table(spark, docs, tmp_dir):
    docs.limit(0).write.parquet(f"{tmp_dir}/documents.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0


def test_a_word_that_a_document_has_very_often(spark):
    ship_package(spark)
    df = spark.createDataFrame([(i, "a " * n) for i, n in ((0, 70_000), (1, 65_535), (2, 131_071), (3, 1))], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_tokens, r.n_known) for r in lm_score.score_documents(df, PIECES, 1000, 999).collect()) == [
        (0, 70_001, 70_001), (1, 65_536, 65_536), (2, 131_072, 131_072), (3, 2, 2)]
