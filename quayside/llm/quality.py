"""Quality rules by distribution divergence (operator 10).

Base rules come first: too few words, or more than half of the words in 3-word windows that
the text has twice.  What passes them, symbol-laden texts aside, makes the references: for each language label the
histogram of character classes and that of its ``COMMON`` most frequent words (all other
words in one bucket), counted over the whole corpus.  A document that passes the base rules
is kept if it is near one language: for some reference, the Jensen-Shannon distances (base
2, 0 to 1) of its character classes and of its common words are both within their limits.
Minimum-length guards: under ``LEAST_WORDS`` words a text's word histogram is too noisy, so only its
character classes are compared; and a label makes a reference only from ``REFERENCE_DOCUMENTS`` documents and
``REFERENCE_WORDS`` words on, unless no label has as many, so that rare labels don't vouch for their own junk.

The references have one row per language label.  Their counts are a written table, and
``LANGUAGES_AT_ONCE`` labels are compared at a time: up to so many in one pass over the texts, each further
block of labels in a further pass, which carries on the nearest one so far.

Contract: a null text has no words and fails; a null language adds to no reference and is
judged like any other, and so is a text whose label has no reference because it has too few
documents or words (``Limits``); without any reference the base rules decide; ties in word counts go
to the smaller word; repeated rows count as they come; an empty table gives an empty result;
``keep_good`` keeps extra columns.  Whole texts count.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from quayside.llm.langid import label_blocks
from quayside.llm.texts import slices, texts_of
from quayside.session import scratch_path

SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "symbol", "punctuation", "other")
COMMON = 40
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.185, 0.45
LEAST_WORDS = 100
REFERENCE_DOCUMENTS, REFERENCE_WORDS = 20, 2_000
LANGUAGES_AT_ONCE = 512
WORDS_HELD = 200_000
#: A text adds to a reference if it has at most one symbol in so many words.
REFERENCE_SYMBOLS = 20


@dataclass(frozen=True)
class Limits:
    char_distance: float = MAX_CHAR_DISTANCE
    word_distance: float = MAX_WORD_DISTANCE
    least_words: int = LEAST_WORDS
    #: Documents and words that a label's reference needs, unless no label has as many.
    reference_documents: int = REFERENCE_DOCUMENTS
    reference_words: int = REFERENCE_WORDS


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Character class by code point."""
    of = {"Lu": 1, "Lt": 1, "Cc": 3}
    by_group = {"L": 0, "M": 0, "N": 2, "Z": 3, "S": 4, "P": 5, "C": 6}
    table = np.array([of.get(c := unicodedata.category(chr(i)), by_group[c[0]]) for i in range(0x110000)], np.uint8)
    table[[ord(c) for c in SYMBOLS]] = 4
    return table


def class_counts(text: str) -> np.ndarray:
    return np.bincount(class_table()[np.frombuffer(text.encode("utf-32-le"), np.uint32)], minlength=len(CLASSES))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    hit = np.fromiter((count[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:k + len(hit)] |= hit
    return int(covered.sum())


def base_features(text: str) -> tuple[list[bytes], tuple[int, int, int, int, int], bool]:
    """Words, (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), base_failed."""
    words = text.encode().split()                       # bytes: ASCII white space only
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    repeats = repeated_words(words)
    return words, (n, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeats), n < 50 or 100 * repeats > 50 * n


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2, of two count vectors."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    part = lambda x: float((x[x > 0] * np.log2(x[x > 0] / m[x > 0])).sum())
    return float(np.sqrt(max(0.0, (part(p) + part(q)) / 2)))


@dataclass(frozen=True)
class Reference:
    """A language's counts: character classes, and its common words with all others last."""

    classes: np.ndarray
    words: dict[bytes, int]
    counts: np.ndarray


class References:
    """All references as matrices, so that a text is compared with all of them at once."""

    def __init__(self, references: list[Reference]):
        self.n = len(references)
        self.place = {w: i for i, w in enumerate(sorted({w for r in references for w in r.words}))}
        width = max((len(r.words) for r in references), default=0)
        # a reference's words by place, in the order of its counts; those it lacks stand at an empty place
        self.words = np.full((self.n, width), len(self.place), np.int64)
        self.word_shares, self.class_shares = np.zeros((self.n, width + 1)), np.zeros((self.n, len(CLASSES)))
        for k, r in enumerate(references):
            for w, i in r.words.items():
                self.words[k, i] = self.place[w]
            self.word_shares[k, :len(r.words)], self.word_shares[k, -1] = r.counts[:-1] / r.counts.sum(), r.counts[-1] / r.counts.sum()
            self.class_shares[k] = r.classes / r.classes.sum()

    def class_distances(self, text: str) -> np.ndarray:
        counts = class_counts(text)
        return js_distances(np.broadcast_to(counts / counts.sum(), self.class_shares.shape), self.class_shares)

    def word_distances(self, words: list[bytes]) -> np.ndarray:
        counts = np.zeros(len(self.place) + 1)
        for w, n in Counter(map(bytes.lower, words)).items():
            if (at := self.place.get(w)) is not None:
                counts[at] = n
        p = np.zeros(self.word_shares.shape)
        p[:, :-1] = counts[self.words] / len(words)
        p[:, -1] = (len(words) - counts[self.words].sum(axis=1)) / len(words)
        return js_distances(p, self.word_shares)


def js_distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of each pair of rows."""
    m = (p + q) / 2
    part = [np.where(x > 0, x * np.log2(np.where(x > 0, x / np.where(m > 0, m, 1), 1)), 0.0).sum(axis=1) for x in (p, q)]
    return np.sqrt(np.maximum(0.0, (part[0] + part[1]) / 2))


def verdict(text: str, words: list[bytes], references: References, limits: Limits) -> tuple[bool, float, float]:
    """Whether the text is near a reference, and its distances to the nearest one (0 where not tested)."""
    if not references.n:
        return True, 0.0, 0.0
    c = references.class_distances(text)
    w = references.word_distances(words) if len(words) >= limits.least_words else np.zeros(references.n)
    far = np.maximum(c / limits.char_distance, w / limits.word_distance)
    best = np.lexsort((w, c, far))[0]
    return bool(far[best] <= 1), float(c[best]), float(w[best])


def nearer(a: tuple[bool, float, float], b: tuple[bool, float, float], limits: Limits) -> tuple[bool, float, float]:
    """Of two verdicts over different references, the one with the nearest."""
    far = lambda v: (max(v[1] / limits.char_distance, v[2] / limits.word_distance), v[1], v[2])
    return min(a, b, key=far)


def language_references(df: DataFrame, text_col: str = "text", lang_col: str = "lang", common: int = COMMON, limits: Limits = Limits(),
                        at_once: int = LANGUAGES_AT_ONCE) -> LanguageReferences:
    """References of the language labels, from the rows of ``df`` that pass the base rules."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)
        classes: dict[str, np.ndarray] = {}
        documents: Counter = Counter()

        def rows(groups) -> pa.RecordBatch:
            flat = [(lang, kind, key, int(n)) for lang, kind, items in groups for key, n in items if n]
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in flat], pa.string()), pa.array([x[1] for x in flat], pa.int32()),
                                               pa.array([x[2] for x in flat], pa.binary()), pa.array([x[3] for x in flat], pa.int64())], ["lang", "kind", "key", "n"])

        for part in slices(batches):
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words, (n, _, symbols, *_), failed = base_features(text)
                if failed or symbols * REFERENCE_SYMBOLS > n:
                    continue
                held[lang].update(map(bytes.lower, words))
                classes[lang] = classes.get(lang, 0) + class_counts(text)
                documents[lang] += 1
            if sum(map(len, held.values())) > WORDS_HELD:
                yield rows((lang, 1, c.items()) for lang, c in held.items())
                held.clear()
        yield rows((lang, 1, c.items()) for lang, c in held.items())
        yield rows((lang, 0, ((str(i).encode(), n) for i, n in enumerate(c))) for lang, c in classes.items())
        yield rows((lang, 2, [(b"", n)]) for lang, n in documents.items())

    counted = (df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
               .filter("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(count, "lang string, kind int, key binary, n long")
               .groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")))
    spark = df.sparkSession
    path = scratch_path(spark, "quality-counts")
    counted.write.parquet(path)
    return LanguageReferences(spark.read.parquet(path), common, limits, at_once)


class LanguageReferences:
    """References of a corpus, read from the written counts (lang, kind, key, n) by blocks of labels."""

    def __init__(self, counted: DataFrame, common: int, limits: Limits, at_once: int):
        spark = counted.sparkSession
        path = scratch_path(spark, "quality-sizes")
        (counted.filter("kind > 0").groupBy("lang").agg(F.sum(F.expr("if(kind = 1, n, 0)")).alias("words"), F.sum(F.expr("if(kind = 2, n, 0)")).alias("documents"))
         .write.parquet(path))
        sizes = spark.read.parquet(path)                  # a row per label
        large = sizes.filter((F.col("words") >= limits.reference_words) & (F.col("documents") >= limits.reference_documents))
        self.used = sizes if large.isEmpty() else large
        self.counted, self.common = counted, common
        self.blocks = label_blocks(self.used, at_once)

    def __len__(self) -> int:
        return self.used.count()

    def block(self, k: int) -> References:
        """References of the labels of block k; without any label, none."""
        if not self.blocks:
            return References([])
        totals = {r["lang"]: r["words"] for r in self.used.filter(F.col("lang").between(*self.blocks[k])).collect()}
        top = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key")
        # the row_number filter is applied in each task before rows of a language meet
        rows = (self.counted.filter((F.col("kind") < 2) & F.col("lang").isin(list(totals)))
                .withColumn("r", F.row_number().over(top)).filter(F.col("r") <= max(self.common, len(CLASSES))).collect())
        of_label: dict[str, list] = defaultdict(list)
        for r in sorted(rows, key=lambda r: r["r"]):
            of_label[r["lang"]].append(r)
        out = []
        for lang in sorted(totals):
            classes = np.zeros(len(CLASSES))
            for r in of_label[lang]:
                if r["kind"] == 0:
                    classes[int(bytes(r["key"]))] = r["n"]
            words = [(bytes(r["key"]), r["n"]) for r in of_label[lang] if r["kind"] == 1 and r["r"] <= self.common]
            counts = np.array([n for _, n in words] + [totals[lang] - sum(n for _, n in words)], float)
            out.append(Reference(classes, {w: i for i, (w, _) in enumerate(words)}, counts))
        return References(out)


FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def by_blocks(state: DataFrame, references: LanguageReferences, compare) -> DataFrame:
    """``compare(state, references, first, last)`` with each block of references in turn; what it carries on is written in between."""
    passes = max(1, len(references.blocks))
    for k in range(passes):
        state = compare(state, references.block(k), k == 0, k == passes - 1)
        if k < passes - 1:
            path = scratch_path(state.sparkSession, "quality-judged")
            state.write.parquet(path)
            state = state.sparkSession.read.parquet(path)
    return state


def quality_report(df: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   at_once: int = LANGUAGES_AT_ONCE) -> DataFrame:
    """(id, base features, base_failed, kept, char_distance, word_distance) of every row."""
    kind = df.schema[id_col].dataType.simpleString()
    result = ", ".join(f"{name} long" for name in FEATURES) + ", base_failed boolean, kept boolean, char_distance double, word_distance double"

    def compare(state: DataFrame, references: References, first: bool, last: bool) -> DataFrame:
        carried = 1 if last else 2                          # the id, and the text for the next block

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                features, failed, judged = [], [], []
                earlier = [] if first else [part.column(2 + k).to_pylist() for k in range(9)]
                for i, text in enumerate(texts_of(part.column(1))):
                    if first:
                        words, found, bad = base_features(text)
                        verdict_0 = None
                    else:
                        found, bad, verdict_0 = [e[i] for e in earlier[:5]], earlier[5][i], tuple(e[i] for e in earlier[6:])
                        words = [] if bad else text.encode().split()
                    features.append(found)
                    failed.append(bad)
                    now = (False, 0.0, 0.0) if bad else verdict(text, words, references, limits)
                    judged.append(now if bad or first else nearer(verdict_0, now, limits))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:carried], *(pa.array([f[k] for f in features], pa.int64()) for k in range(5)), pa.array(failed, pa.bool_()),
                     pa.array([j[0] for j in judged], pa.bool_()), pa.array([j[1] for j in judged], pa.float64()), pa.array([j[2] for j in judged], pa.float64())],
                    [*["id", "text"][:carried], *FEATURES, "base_failed", "kept", "char_distance", "word_distance"])

        return state.mapInArrow(run, f"id {kind}, {result}" if last else f"id {kind}, text string, {result}")

    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return by_blocks(texts, language_references(df, text_col, lang_col, limits=limits, at_once=at_once), compare).withColumnRenamed("id", id_col)


def keep_good(df: DataFrame, limits: Limits = Limits(), text_col: str = "text", lang_col: str = "lang", at_once: int = LANGUAGES_AT_ONCE) -> DataFrame:
    """The rows of ``df`` that are kept, with all their columns."""
    names, schema = df.columns, df.schema
    at, near = names.index(text_col), "near"
    while near in map(str.lower, names):
        near += "_"
    with_near = StructType([*schema.fields, StructField(near, BooleanType())])

    def compare(state: DataFrame, references: References, first: bool, last: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                passed, good = [], []
                before = [False] * part.num_rows if first else part.column(len(names)).to_pylist()
                for text, near_one in zip(texts_of(part.column(at)), before):
                    words, _, bad = base_features(text) if first else ([] if near_one else text.encode().split(), None, False)
                    passed.append(not bad)
                    good.append(near_one or not bad and verdict(text, words, references, limits)[0])
                columns = part.columns[:len(names)]
                out = pa.RecordBatch.from_arrays(columns if last else [*columns, pa.array(good, pa.bool_())], names if last else with_near.names)
                yield out.filter(pa.array(good if last else passed, pa.bool_()))

        return state.mapInArrow(run, schema if last else with_near)

    return by_blocks(df, language_references(df, text_col, lang_col, limits=limits, at_once=at_once), compare)


ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, lang, text IS NULL AS none, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
win AS (SELECT rid, i, words[i:i + 2] AS g FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
hit AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM hit, (VALUES (0), (1), (2)) v(k) GROUP BY rid),
f AS (
  SELECT w.*, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(rep.n, 0) AS n_repeat_words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM w LEFT JOIN rep USING (rid)),
b AS (SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
cls AS (
  SELECT rid, unnest([0, 1, 2, 3, 4, 5, 6]) AS k, unnest([lo, up, di, sp, sy, pu - ps, length(text) - lo - up - di - sp - sy - pu + ps])::DOUBLE AS n FROM (
    SELECT rid, text, length(regexp_replace(text, '[^\p{Ll}\p{Lm}\p{Lo}\p{M}]', '', 'g')) AS lo, length(regexp_replace(text, '[^\p{Lu}\p{Lt}]', '', 'g')) AS up,
      length(regexp_replace(text, '[^\p{N}]', '', 'g')) AS di, length(regexp_replace(text, '[^\p{Z}\p{Cc}]', '', 'g')) AS sp,
      length(regexp_replace(text, '[^\p{S}#*%&]', '', 'g')) AS sy, length(regexp_replace(text, '[^\p{P}]', '', 'g')) AS pu,
      length(regexp_replace(text, '[^#*%&]', '', 'g')) AS ps FROM b WHERE NOT base_failed)),
wc AS (
  SELECT rid, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word, count(*) AS n
  FROM (SELECT rid, unnest(words) AS word FROM b WHERE NOT base_failed) GROUP BY ALL),
good AS (SELECT rid, lang FROM b WHERE lang IS NOT NULL AND NOT none AND NOT base_failed AND n_symbols * 20 <= n_words),
ref_c AS (SELECT lang, k, sum(n) AS n FROM cls JOIN good USING (rid) GROUP BY ALL),
ref_w AS (SELECT lang, word, sum(n)::DOUBLE AS n FROM wc JOIN good USING (rid) GROUP BY ALL),
size AS (SELECT lang, total, docs FROM (SELECT lang, sum(n) AS total FROM ref_w GROUP BY lang) JOIN (SELECT lang, count(*) AS docs FROM good GROUP BY lang) USING (lang)),
used AS (SELECT lang FROM size WHERE (total >= 2000 AND docs >= 20) OR NOT EXISTS (SELECT 1 FROM size WHERE total >= 2000 AND docs >= 20)),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS r, sum(n) OVER (PARTITION BY lang) AS total FROM ref_w JOIN used USING (lang)) WHERE r <= 40),
langs AS (SELECT lang, max(total) AS total, sum(n) AS held FROM top GROUP BY lang),
buckets AS (SELECT lang, r, word, n / total AS q FROM top UNION ALL SELECT lang, 0, NULL, (total - held) / total FROM langs),
doc_w AS (
  SELECT b.rid, u.lang, u.r, u.q, coalesce(wc.n, 0)::DOUBLE / b.n_words AS p0 FROM b JOIN buckets u ON NOT b.base_failed AND b.n_words >= 100
  LEFT JOIN wc ON wc.rid = b.rid AND wc.word = u.word),
doc_p AS (SELECT *, CASE WHEN r = 0 THEN greatest(1 - sum(CASE WHEN r > 0 THEN p0 ELSE 0 END) OVER (PARTITION BY rid, lang), 0) ELSE p0 END AS p FROM doc_w),
word_d AS (
  SELECT rid, lang, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS d
  FROM doc_p GROUP BY ALL),
cls_p AS (
  SELECT c.rid, r.lang, c.n / sum(c.n) OVER (PARTITION BY c.rid, r.lang) AS p, r.n / sum(r.n) OVER (PARTITION BY c.rid, r.lang) AS q
  FROM cls c JOIN ref_c r USING (k) JOIN used USING (lang)),
class_d AS (
  SELECT rid, lang, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS d
  FROM cls_p GROUP BY ALL),
near AS (
  SELECT b.rid, bool_or(coalesce(c.d, 0) <= 0.185 AND coalesce(x.d, 0) <= 0.45) AS ok FROM b CROSS JOIN langs l
  LEFT JOIN class_d c ON c.rid = b.rid AND c.lang = l.lang LEFT JOIN word_d x ON x.rid = b.rid AND x.lang = l.lang GROUP BY b.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(near.ok, true) AS kept
FROM b LEFT JOIN near USING (rid)
"""
