"""Phrase collocations by weighted acyclic automata (operator 13).

Every task counts the n-grams (1 to ``LONGEST`` words) of some millions of words at a time and
builds, from the sorted n-grams, one acyclic transducer per prefix range: arcs are words, a state
is a prefix, an arc's weight is the count of the n-gram that ends with it, and all last arcs lead to one final state.
A prefix range holds the n-grams whose language and first two words (one, for single words) hash
into it, so a frequent first word is spread over all ranges.  Each range unites its transducers
and sums their weights; what occurs fewer than ``least`` times is dropped, which loses no
part of a phrase, as a part is never rarer than its phrase.

Parts are looked up by composition: a range walks its own arcs for a phrase's first words, and asks
the ranges of the other parts, each distinct part once per asking range, so a word that a third of all
phrases share costs one look-up a range.  The request also tells the count of the longest phrase
around a part, which settles the containment rule where the part lives.

Memory: a task holds ``FLUSH_WORDS`` words and their n-grams (a text is cut where they are full, and its
last words lead on), or one range, about ``RANGE_BYTES`` of text's n-grams.  Nothing is collected but the text's size.

Contract: null text has no words, a null language reads as ``und``; repeated rows count as they come; ties
are ordered by count, then phrase; a language without phrases has no row; an empty table gives an empty
result; extra columns play no part; whole texts count, in chunks of a bounded size.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.texts import slices
from quayside.session import scratch_path

LONGEST, LEAST, INSIDE, TOP, NO_LANGUAGE = 3, 10, 50, 2000, "und"
FLUSH_WORDS, RANGE_BYTES, CHUNK_BYTES = 1 << 20, 4 << 20, 1 << 20
SCALE, PARTS = 1_000_000, 32
BREAK = b"\n"                    # stands between pieces
_TABLE = bytes(0x0A if chr(c) in ".,;:!?\n\x0b\x0c\r" else 0x20 if c == 0x09 else c for c in range(256))
#: Distinct n-grams: a column of label numbers for each word, in order, and their counts.
Grams = tuple[list[np.ndarray], np.ndarray]


def words_of(chunk: bytes) -> pa.Array:
    """Words of a text's chunk, with a ``BREAK`` between pieces."""
    clean = chunk.lower().translate(_TABLE).replace(BREAK, b" \n ")         # bytes: only A-Z are lower-cased
    words = pc.split_pattern(pa.array([clean], pa.binary()), b" ").flatten()
    return words.filter(pc.greater(pc.binary_length(words), 0))


def chunks(text: bytes, size: int = CHUNK_BYTES) -> Iterator[bytes]:
    """The text in chunks that end before a blank."""
    at = 0
    while at < len(text):
        stop = text.find(b" ", at + size) if len(text) - at > size else -1
        stop = len(text) if stop < 0 else stop
        yield text[at:stop]
        at = stop


def hash_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def ranges_of(lang: str, ranges: int, first: np.ndarray, second: np.ndarray | None = None) -> np.ndarray:
    """Prefix range by language and the hashes of the first one or two words."""
    mixed = first * np.uint64(0x9E3779B97F4A7C15) + np.uint64(hash_of(lang.encode()))
    if second is not None:
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) + second
    mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0x94D049BB133111EB)
    return ((mixed >> np.uint64(16)) % np.uint64(ranges)).astype(np.min_scalar_type(ranges))


def heads(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)


class Packing:
    """Sequences of label numbers below ``size`` as single numbers in the same order; where 63 bits don't do, a prefix is replaced by its rank."""

    def __init__(self, columns: list[np.ndarray], size: int):
        self.size, self.ranks = max(2, size), []
        self.keys, bound = columns[0].astype(np.int64), self.size
        for column in columns[1:]:
            seen = None
            if bound * self.size >= 1 << 63:
                seen = np.unique(self.keys)
                self.keys, bound = np.searchsorted(seen, self.keys), len(seen)
            self.ranks.append(seen)
            self.keys, bound = self.keys * self.size + column, bound * self.size

    def unpack(self, keys: np.ndarray) -> list[np.ndarray]:
        columns = []
        for seen in reversed(self.ranks):
            columns.append(keys % self.size)
            keys = keys // self.size
            keys = keys if seen is None else seen[keys]
        return [keys, *columns[::-1]]


class Transducer:
    """Acyclic automaton over words.  arcs[k]: words of the arcs into the states of depth k + 1, in order of state and word; fan[k]: arcs
    out of each state of depth k; weight[k]: count of the n-gram that ends with the arc, 0 if there is none."""

    def __init__(self, labels: pa.Array, arcs: list[np.ndarray], fan: list[np.ndarray], weight: list[np.ndarray]):
        self.labels, self.arcs, self.fan, self.weight = labels, arcs, fan, weight

    @classmethod
    def build(cls, labels: pa.Array, grams: list[Grams]) -> "Transducer":
        """grams[k]: distinct sequences of k + 1 label numbers, sorted; labels: sorted."""
        size = max(1, len(labels))
        arcs, fan, weight = [], [], []
        above = 1                                              # states of the depth above
        state = [np.zeros(len(n), np.int64) for _, n in grams]      # the state each n-gram's prefix has reached
        for k, (_, counts) in enumerate(grams):
            key = [s * size + g[k] for s, (g, _) in zip(state[k:], grams[k:])]          # sorted, as the n-grams are
            states = np.sort(np.concatenate([x[heads(x)] for x in key]))
            states = states[heads(states)]
            arcs.append(states % size)
            fan.append(np.bincount(states // size, minlength=above))
            n = np.zeros(len(states), np.int64)
            n[np.searchsorted(states, key[0])] = counts
            weight.append(n)
            state[k:] = [np.searchsorted(states, x) for x in key]
            above = len(states)
        return cls(labels, arcs, fan, weight)

    def grams(self) -> list[Grams]:
        """The n-grams of each size and their counts, sorted."""
        out, path = [], []
        for arcs, fan, weight in zip(self.arcs, self.fan, self.weight):
            path = [*(np.repeat(p, fan) for p in path), arcs]
            held = weight > 0
            out.append((path, weight) if held.all() else ([p[held] for p in path], weight[held]))
        return out

    def weights(self, paths: pa.Array) -> np.ndarray:
        """Count of each n-gram (words with blanks between), 0 where it has none: all walk at once, an arc a step."""
        split = pc.split_pattern(paths, b" ")
        length, start = np.diff(split.offsets.to_numpy()), split.offsets.to_numpy()[:-1]
        number = pc.fill_null(pc.index_in(split.values, value_set=self.labels), -1).to_numpy(zero_copy_only=False)
        size, out = max(1, len(self.labels)), np.zeros(len(paths), np.int64)
        state, live = np.zeros(len(paths), np.int64), np.arange(len(paths))
        for k, (arcs, fan, weight) in enumerate(zip(self.arcs, self.fan, self.weight)):
            live = live[length[live] > k]
            word = number[start[live] + k]
            keys = np.repeat(np.arange(len(fan)), fan) * size + arcs
            want = state[live] * size + word
            at = np.searchsorted(keys, want)
            good = (word >= 0) & (at < len(keys))
            good[good] = keys[at[good]] == want[good]
            live, at = live[good], at[good]
            state[live] = at
            last = length[live] == k + 1
            out[live[last]] = weight[at[last]]
        return out

    def pack(self) -> bytes:
        """All but the labels: the depth, then each array's length, bytes per number, and numbers."""
        out = [np.array([len(self.arcs)], "<i8").tobytes()]
        for a in (*self.arcs, *self.fan, *self.weight):
            width = next(w for w in (1, 2, 4, 8) if not len(a) or int(a.max()) < 1 << 8 * w)
            out += [np.array([len(a), width], "<i8").tobytes(), a.astype(f"<u{width}").tobytes()]
        return b"".join(out)

    @classmethod
    def unpack(cls, labels: pa.Array, data: bytes) -> "Transducer":
        [k], at, out = np.frombuffer(data, "<i8", 1).tolist(), 8, []
        for _ in range(3 * k):
            n, width = np.frombuffer(data, "<i8", 2, at).tolist()
            out.append(np.frombuffer(data, f"<u{width}", n, at + 16).astype(np.int64))
            at += 16 + n * width
        return cls(labels, out[:k], out[k:2 * k], out[2 * k:])


def sorted_labels(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words in order, and each word's number."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    return coded.dictionary.take(order), place[coded.indices.to_numpy()]


def ngram_counts(ids: np.ndarray, stop: int, size: int, longest: int, stale: int = 0) -> list[Grams]:
    """n-grams of a sequence of word numbers (``stop`` between pieces) and their counts; the first ``stale`` words only lead into n-grams that end after them."""
    out, inside = [], np.ones(len(ids), bool)
    for k in range(longest):
        inside = inside[:len(ids) - k] & (ids[k:] != stop)
        ends = inside.copy()
        ends[:max(0, stale - k)] = False
        packing = Packing([ids[j:len(ids) - k + j][ends] for j in range(k + 1)], size)
        keys = np.sort(packing.keys)
        first = heads(keys)
        out.append((packing.unpack(keys[first]), np.diff(first, append=len(keys))))
    return out


def union(parts: list[Transducer], least: int = 1) -> tuple[Transducer, int]:
    """One transducer with the sums of all weights, without n-grams under ``least``; and the sum over single words, rare ones included."""
    labels, number = sorted_labels(pa.concat_arrays([p.labels for p in parts]))
    stop = np.cumsum([len(p.labels) for p in parts])
    grams = [([number[b - len(p.labels):b], p.grams()]) for p, b in zip(parts, stop.tolist())]
    out, words = [], 0
    for k in range(len(parts[0].arcs)):
        packing = Packing([np.concatenate([to[g[k][0][j]] for to, g in grams]) for j in range(k + 1)], len(labels))
        keys = np.sort(packing.keys)
        keys = keys[heads(keys)]
        n = np.zeros(len(keys), np.int64)
        at = 0
        for _, g in grams:                                   # each part's keys are in order and distinct
            own = packing.keys[at:at + len(g[k][1])]
            n[np.searchsorted(keys, own)] += g[k][1]
            at += len(own)
        words += int(n.sum()) if k == 0 else 0
        out.append((packing.unpack(keys[n >= least]), n[n >= least]))
    used = np.zeros(len(labels), bool)
    for columns, _ in out:
        for c in columns:
            used[c] = True
    place = np.cumsum(used) - 1
    return Transducer.build(labels.filter(pa.array(used)), [([place[c] for c in columns], n) for columns, n in out]), words


def by_range(lang: str, labels: pa.Array, hashes: np.ndarray, grams: list[Grams], ranges: int) -> Iterator[pa.RecordBatch]:
    """A transducer for each range that has n-grams; labels: of all of them, in order."""
    dealt = []
    for columns, n in grams:
        if len(columns) == 1:
            where = ranges_of(lang, ranges, hashes[columns[0]])
        else:                                                # n-grams with the same first two words stand together
            change = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
            first = np.flatnonzero(np.concatenate(([True], change))) if len(n) else np.empty(0, np.int64)
            where = np.repeat(ranges_of(lang, ranges, hashes[columns[0][first]], hashes[columns[1][first]]), np.diff(first, append=len(n)))
        order = np.argsort(where, kind="stable")             # still sorted within a range
        dealt.append(([c[order] for c in columns], n[order], np.searchsorted(where[order], np.arange(ranges + 1))))
    filled = np.flatnonzero(sum(np.diff(cuts) for *_, cuts in dealt))
    mark, place = np.zeros(len(labels), bool), np.zeros(len(labels), np.int64)
    for some in np.array_split(filled, max(1, -(-len(filled) // 256))):
        held, rows = [], []
        for r in some.tolist():
            mine = [([c[cuts[r]:cuts[r + 1]] for c in columns], n[cuts[r]:cuts[r + 1]]) for columns, n, cuts in dealt]
            for columns, _ in mine:
                for c in columns:
                    mark[c] = True
            used = np.flatnonzero(mark)
            mark[used] = False
            place[used] = np.arange(len(used))
            held.append(used)
            rows.append(Transducer.build(used, [([place[c] for c in columns], n) for columns, n in mine]).pack())
        names = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(u) for u in held]))), pa.int32()), labels.take(pa.array(np.concatenate(held)))) if held else pa.array([], pa.list_(pa.binary()))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([lang] * len(some), pa.string()), names, pa.array(rows, pa.binary())], ["range", "lang", "labels", "automaton"])


def transducers(df: DataFrame, ranges: int, longest: int, lang_col: str, text_col: str, flush_words: int) -> DataFrame:
    """(range, lang, labels, automaton): count transducers of some documents each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Array]] = defaultdict(list)
        stale, n = {}, 0

        def flush() -> Iterator[pa.RecordBatch]:
            size = {lang: sum(map(len, some)) for lang, some in held.items()}
            labels, ids = sorted_labels(pa.concat_arrays([pa.array([BREAK], pa.binary()), *(x for some in held.values() for x in some)]))
            hashes = np.fromiter(map(hash_of, labels.to_pylist()), np.uint64, len(labels))
            at = 1
            for lang, count in size.items():
                grams = ngram_counts(ids[at:at + count], int(ids[0]), len(labels), longest, stale.get(lang, 0))
                at += count
                yield from by_range(lang, labels, hashes, grams, ranges)

        for part in slices(batches):
            texts = defaultdict(list)
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                texts[lang].append(text)
            for lang, some in texts.items():
                for chunk in chunks(BREAK.join(some) + BREAK):
                    words = words_of(chunk)
                    held[lang].append(words)
                    n += len(words)
                    if n >= flush_words:
                        yield from flush()
                        # a chunk may end inside a text: its last words lead into the next n-grams
                        last = pa.concat_arrays(held[lang][-longest:])
                        last = last.slice(max(0, len(last) - longest + 1))
                        held, stale, n = defaultdict(list, {lang: [last]}), {lang: len(last)}, 0
        if n:
            yield from flush()

    return (df.filter(F.col(text_col).isNotNull()).select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "range int, lang string, labels array<binary>, automaton binary"))


def written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def phrase_counts(df: DataFrame, least: int = LEAST, longest: int = LONGEST, lang_col: str = "lang", text_col: str = "text",
                  flush_words: int = FLUSH_WORDS, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, int]:
    """(range, lang, automaton, words) of the n-grams with ``least`` occurrences or more, a written table, and the number of ranges; words: how many words of the range's single ones."""
    ranges = max(1, -(-(df.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0) // range_bytes))

    def unite(key: tuple, table: pa.Table) -> pa.Table:
        by_lang = defaultdict(list)
        for lang, t in automata_of(table):
            by_lang[lang].append(t)
        langs, rows, words = sorted(by_lang), [], []
        for lang in langs:
            whole, n = union(by_lang.pop(lang), least)
            rows.append(whole)
            words.append(n)
        return pa.table({"range": pa.array([key[0].as_py()] * len(rows), pa.int32()), "lang": pa.array(langs, pa.string()),
                         "labels": pa.array([t.labels.to_pylist() for t in rows], pa.list_(pa.binary())),
                         "automaton": pa.array([t.pack() for t in rows], pa.binary()), "words": pa.array(words, pa.int64())})

    counted = (transducers(df, ranges, longest, lang_col, text_col, flush_words).groupBy("range")
               .applyInArrow(unite, "range int, lang string, labels array<binary>, automaton binary, words long"))
    return written(counted, "phrase-counts"), ranges


def automata_of(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[str, Transducer]]:
    """(language, transducer) of each row."""
    for lang, labels, data in zip(*(table.column(c) for c in ("lang", "labels", "automaton"))):
        yield lang.as_py(), Transducer.unpack(labels.values, data.as_py())


def phrases_of(t: Transducer) -> list[tuple[tuple[bytes, ...], int]]:
    """The phrases of two words and more, and their counts."""
    labels = t.labels.to_pylist()
    return [(tuple(labels[i] for i in path), n) for columns, c in t.grams()[1:] for *path, n in zip(*(x.tolist() for x in columns), c.tolist())]


def collocations(counts: DataFrame, ranges: int, inside: int = INSIDE) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer candidate explains."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every part that another range may hold, with the largest count of a candidate around it (0 for cuts' single words)."""
        for part in slices(batches, 1):
            source, [(lang, automaton)] = part.column(0)[0].as_py(), automata_of(part)
            around: dict[tuple[bytes, ...], int] = {}
            for path, n in phrases_of(automaton):
                for k in range(1, len(path)):
                    for piece in (path[:k], path[k:]):
                        around[piece] = max(around.get(piece, 0), n)
                for size in range(2, len(path)):                       # phrases inside that no cut yields
                    for k in range(len(path) - size + 1):
                        around[path[k:k + size]] = max(around.get(path[k:k + size], 0), n)
            if not around:
                continue
            pieces = list(around)
            hashes = {w: hash_of(w) for w in {w for p in pieces for w in p}}
            first = np.fromiter((hashes[p[0]] for p in pieces), np.uint64, len(pieces))
            second = np.fromiter((hashes[p[1]] if len(p) > 1 else 0 for p in pieces), np.uint64, len(pieces))
            one = np.fromiter((len(p) == 1 for p in pieces), bool, len(pieces))
            where = np.where(one, ranges_of(lang, ranges, first), ranges_of(lang, ranges, first, second))
            order = np.argsort(where, kind="stable")
            to, start = np.unique(where[order], return_index=True)
            rows = [[pieces[i] for i in some] for some in np.split(order, start[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int32()), pa.array([source] * len(rows), pa.int32()), pa.array([lang] * len(rows)),
                 pa.array([b"\n".join(b" ".join(p) for p in some) for some in rows], pa.binary()),
                 pa.array([[around[p] for p in some] for some in rows], pa.list_(pa.int64()))], ["range", "source", "lang", "parts", "around"])

    def answer(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        """Counts of the parts for the ranges that asked, and for this range the largest candidate around each of its phrases."""
        automata = dict(automata_of(held))
        around: dict[str, dict[bytes, int]] = defaultdict(dict)      # by language, then phrase
        to, langs, parts, numbers, kinds = [], [], [], [], []

        def add(target: int, lang: str, names: bytes, values: list[int], kind: int) -> None:
            for x, v in zip((to, langs, parts, numbers, kinds), (target, lang, names, values, kind)):
                x.append(v)

        for source, lang, names, largest in zip(*(asked.column(c).to_pylist() for c in ("source", "lang", "parts", "around"))):
            split = names.split(b"\n")
            add(source, lang, names, automata[lang].weights(pa.array(split, pa.binary())).tolist(), 0)
            for p, n in zip(split, largest):
                if b" " in p:
                    around[lang][p] = max(around[lang].get(p, 0), n)
        for lang, found in around.items():
            add(key[0].as_py(), lang, b"\n".join(found), list(found.values()), 1)
        return pa.table({"range": pa.array(to, pa.int32()), "lang": pa.array(langs, pa.string()), "parts": pa.array(parts, pa.binary()),
                         "numbers": pa.array(numbers, pa.list_(pa.int64())), "kind": pa.array(kinds, pa.int32())})

    def score(key: tuple, held: pa.Table, answers: pa.Table) -> pa.Table:
        known: dict[str, dict[bytes, int]] = defaultdict(dict)
        longer: dict[str, dict[bytes, int]] = defaultdict(dict)
        for lang, names, numbers, kind in zip(*(answers.column(c).to_pylist() for c in ("lang", "parts", "numbers", "kind"))):
            (longer if kind else known)[lang].update(zip(names.split(b"\n"), numbers))
        rows = []
        for lang, automaton in automata_of(held):
            count, around = known[lang], longer[lang]
            for path, a in phrases_of(automaton):
                phrase = b" ".join(path)
                if 100 * around.get(phrase, 0) >= inside * a:
                    continue
                cuts = [(count[b" ".join(path[:k])], count[b" ".join(path[k:])]) for k in range(1, len(path))]
                scored = [SCALE * a * a // (x * y) for x, y in cuts]           # Python's integers are exact
                best = min(range(len(cuts)), key=scored.__getitem__)           # the first of equal ones
                rows.append((lang, phrase.decode(), a, *cuts[best], scored[best]))
        columns = list(zip(*rows)) or [()] * 6
        return pa.Table.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), *(pa.array(c, pa.int64()) for c in columns[2:])],
                                    ["lang", "phrase", "a", "l", "r", "score"])

    held = counts.select("range", "lang", "labels", "automaton")
    asked = held.mapInArrow(ask, "range int, source int, lang string, parts binary, around array<long>")
    # other names on the left side, so that Spark keeps the columns of both
    answers = (asked.groupBy("range").cogroup(held.withColumnRenamed("range", "of").groupBy("of"))
               .applyInArrow(answer, "range int, lang string, parts binary, numbers array<long>, kind int"))
    return (held.groupBy("range").cogroup(answers.withColumnRenamed("range", "of").groupBy("of"))
            .applyInArrow(score, "lang string, phrase string, a long, l long, r long, score long"))


def top_phrases(df: DataFrame, top: int = TOP, least: int = LEAST, inside: int = INSIDE, longest: int = LONGEST, lang_col: str = "lang", text_col: str = "text",
                flush_words: int = FLUSH_WORDS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by score, count, then phrase; n: all its words."""
    counts, ranges = phrase_counts(df, least, longest, lang_col, text_col, flush_words, range_bytes)
    sizes = counts.groupBy(F.col("lang").alias("of")).agg(F.sum("words").alias("n"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    found = collocations(counts, ranges, inside)
    # the first ones of each part of a language come first, so that no task gets more than PARTS x top rows of a language
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(sizes, F.col("lang") == F.col("of")).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
g AS (SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) v(k) WHERE len(words) >= k)),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS n FROM g GROUP BY ALL),
total AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1 AND n >= 10),
cuts AS (SELECT lang, phrase, a, k, cut, array_to_string(words[1:cut], ' ') AS x, array_to_string(words[cut + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, cut, x.n AS l, y.n AS r, (1000000::HUGEINT * a * a) // (x.n * y.n) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.x AND x.k = cut JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.y AND y.k = cuts.k - cut),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_ AS (
  SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS phrase FROM c WHERE k = 3) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inner_ i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, total.n AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN total USING (lang) WHERE rank <= 2000
"""
