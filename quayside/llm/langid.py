"""Language ID by multinomial naive Bayes over hashed character n-grams (operator 9).

Texts are lower-cased, every run of non-letters reads as one blank, and the 2- and 3-grams
of characters are hashed into ``BUCKETS`` counts.  Training counts them per language in each
task and sums over tasks; the matrix of log-probabilities has one row per language and is
what scoring tasks get.  Scoring looks up each n-gram's column and adds up by document.

Bound: the matrix takes 8 x ``BUCKETS`` bytes (128 kB) per language label.  The counts of all labels
are a written table with a row per label; ``LANGUAGES_AT_ONCE`` of them (64 MB) are a matrix at a time.
Up to so many labels one pass over the texts scores them; each further block of labels is a further
pass, whose best label and sum of probabilities are carried on, so that results don't depend on the blocks.

Contract: only text and non-null ``lang`` of the training rows are learned from; the split
looks at the id alone (a null id reads as the empty text).  A text that is null or has no
letter is ``und`` with score 0, and so is every text if nothing was learned; nothing is learned
from such texts.  Equal scores go to the smaller label.  Repeated rows count as they come; an empty table gives an empty
result; extra columns play no part.  Whole texts count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.texts import slices, texts_of
from quayside.session import scratch_path

BUCKETS = 1 << 14
LANGUAGES_AT_ONCE = 512
SMOOTHING = 0.5
SLICE = 64
NO_LETTERS = regex.compile(r"\P{L}+")


def buckets_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all texts in a row, each text's bounds in them, and whether it has letters."""
    clean = [NO_LETTERS.sub(" ", t.lower()).strip() for t in texts]
    row = np.frombuffer("".join(f" {t} " for t in clean).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.array([len(t) + 2 for t in clean], np.int64)
    two = row[:-1] * np.uint64(0x9E3779B97F4A7C15) + row[1:] if len(row) else row
    three = two[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + row[2:] if len(row) else row
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    grams = np.empty((len(row), 2), np.int32)          # n-grams that begin at each character; those across two texts are put right below
    grams[:-1, 0] = (two * np.uint64(0xD6E8FEB86659FD93)) >> shift
    grams[:-2, 1] = (three * np.uint64(0xA5CB9243F0AEF993)) >> shift
    stop = np.cumsum(size)
    grams[stop - 1] = grams[stop[:, None] - np.minimum(size, 2)[:, None], [0, 0]]   # none begins at the last blank: its place repeats the text's last 2-gram
    grams[stop - 2, 1] = grams[stop - 2, 0]
    return grams.ravel(), 2 * (stop - size), np.array([bool(t) for t in clean])


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def train(df: DataFrame, lang_col: str = "lang", text_col: str = "text", at_once: int = LANGUAGES_AT_ONCE) -> DataFrame:
    """A written table (lang, documents, grams): a row per learned label, its counts of all buckets packed."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, n in counts.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], ["lang", "bucket", "n"])
            counts.clear()

        for part in slices(batches, SLICE):
            langs, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            for lang in set(langs):
                grams, start, lettered = buckets_of([t for t, x in zip(texts, langs) if x == lang])
                if lang not in counts:
                    if len(counts) >= at_once:
                        yield from rows()
                    counts[lang] = np.zeros(BUCKETS + 1, np.int64)
                counts[lang][:-1] += np.bincount(grams[np.repeat(lettered, np.diff([*start, len(grams)]))], minlength=BUCKETS)
                counts[lang][-1] += int(lettered.sum())
        yield from rows()

    def pack(of_label: pa.Table) -> pa.Table:
        n = np.zeros(BUCKETS + 1, np.int64)               # a label's group has at most a row per bucket
        n[of_label.column("bucket").to_numpy()] = of_label.column("n").to_numpy()
        return pa.table({"lang": of_label.column("lang").slice(0, 1), "documents": pa.array([n[-1]]), "grams": pa.array([n[:-1].tobytes()], pa.binary())})

    spark = df.sparkSession
    path = scratch_path(spark, "language-counts")
    (df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
     .filter("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(count, "lang string, bucket int, n long")
     .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
     .groupBy("lang").applyInArrow(pack, "lang string, documents long, grams binary").write.parquet(path))
    return spark.read.parquet(path)


def label_blocks(labels: DataFrame, at_once: int) -> list[tuple[str, str]]:
    """First and last label of each block of ``at_once`` of the distinct labels ``lang``, in order."""
    blocks: list[tuple[str, str]] = []
    while True:
        rest = labels.filter(F.col("lang") > blocks[-1][1]) if blocks else labels
        some = [r[0] for r in rest.select("lang").orderBy("lang").limit(at_once).collect()]
        if some:
            blocks.append((some[0], some[-1]))
        if len(some) < at_once:
            return blocks


def model_of(counted: DataFrame, block: tuple[str, str], documents: int) -> tuple[list[str], np.ndarray]:
    """A block's labels in order, and log-probabilities: a row per label, its prior in the last column."""
    rows = sorted(counted.filter(F.col("lang").between(*block)).collect(), key=lambda r: r["lang"])
    grams = np.stack([np.frombuffer(r["grams"], np.int64) for r in rows]) + SMOOTHING
    prior = np.array([[r["documents"] / documents] for r in rows])
    return [r["lang"] for r in rows], np.concatenate([np.log(grams / grams.sum(axis=1, keepdims=True)), np.log(prior)], axis=1)


def best_label(texts: list[str], langs: list[str], model: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Each text's best label, its log-probability, the sum of all labels' probabilities relative to it, and whether the text has letters."""
    grams, start, lettered = buckets_of(texts)
    total = np.stack([np.add.reduceat(row[grams], start) for row in model[:, :-1]], axis=1) + model[:, -1]
    best = total.argmax(axis=1)
    top = total[np.arange(len(texts)), best]
    return [langs[b] if ok else "und" for b, ok in zip(best.tolist(), lettered.tolist())], top, np.exp(total - top[:, None]).sum(axis=1), lettered


def score(texts: list[str], langs: list[str], model: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and posterior probability of each text."""
    if not langs or not texts:
        return ["und"] * len(texts), np.zeros(len(texts))
    pred, _, mass, lettered = best_label(texts, langs, model)
    return pred, posterior(mass, lettered)


def posterior(mass: np.ndarray, lettered: np.ndarray) -> np.ndarray:
    return np.where(lettered, np.minimum(1 / mass, 1.0), 0.0)


def predict(df: DataFrame, counted: DataFrame, id_col: str = "doc_id", text_col: str = "text", at_once: int = LANGUAGES_AT_ONCE) -> DataFrame:
    """(id, lang_pred, score) of every row; ``counted`` as ``train`` writes it."""
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    state = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks = label_blocks(counted, at_once)
    documents = counted.agg(F.sum("documents")).first()[0]

    def score_block(state: DataFrame, model: tuple[list[str], np.ndarray], last: bool) -> DataFrame:
        shared = spark.sparkContext.broadcast(model)          # at most ``at_once`` rows

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, matrix = shared.value
            for part in slices(batches, SLICE):
                pred, top, mass, lettered = best_label(texts_of(part.column(1)), names, matrix)
                if part.num_columns > 2:                      # what earlier blocks found; theirs are the smaller labels
                    earlier, top_0, mass_0 = part.column(2).to_pylist(), part.column(3).to_numpy(), part.column(4).to_numpy()
                    pred = [p if new else q for p, q, new in zip(pred, earlier, (top > top_0).tolist())]
                    both = np.maximum(top, top_0)
                    top, mass = both, mass * np.exp(top - both) + mass_0 * np.exp(top_0 - both)
                found = [pa.array(posterior(mass, lettered))] if last else [pa.array(top), pa.array(mass)]
                kept = [part.column(0)] if last else [part.column(0), part.column(1)]
                names_out = ["id", "lang_pred", "score"] if last else ["id", "text", "lang_pred", "top", "mass"]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(pred, pa.string()), *found], names_out)

        return state.mapInArrow(run, f"id {kind}, lang_pred string, score double" if last else f"id {kind}, text string, lang_pred string, top double, mass double")

    for k, block in enumerate(blocks):
        last = k == len(blocks) - 1
        state = score_block(state, model_of(counted, block, documents), last)
        if not last:
            path = scratch_path(spark, "language-scores")
            state.write.parquet(path)
            state = spark.read.parquet(path)
    if not blocks:
        state = state.select("id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return state.withColumnRenamed("id", id_col)


def language_id(df: DataFrame, parts: int = 4, part: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                at_once: int = LANGUAGES_AT_ONCE) -> DataFrame:
    """(id, held_out, lang_pred, score); learns from the rows that aren't held out."""
    counted = train(df.filter(~held_out(F.col(id_col), parts, part)), lang_col, text_col, at_once)
    return predict(df, counted, id_col, text_col, at_once).select(id_col, held_out(F.col(id_col), parts, part).alias("held_out"), "lang_pred", "score")
