"""Secret scans with an incremental blob ledger (operator 3): DataFrame functions only.

Every version of a document is addressed by the SHA-256 of its text.  The ledger is a folder
with two tables: ``scanned`` has the (blob, rule, version) triples that were scanned, and
``findings`` the spans of each.  A scan takes the distinct blobs of its input, drops the
pairs of blob and rule version the ledger has, runs only the rules that are left on each
blob, appends to the ledger, and joins the findings back to every path that holds the blob.
Raising a rule's version scans all blobs anew for that rule and no other.

Spans are found by Java regular expressions: the matches and the text between them, whose
lengths add up to the offsets (code points, end exclusive).

Contract: a null text is the empty text; repeated rows and ids are paths of their own; an
empty table gives an empty result; extra columns are kept by ``redact``.  Very long texts are
scanned whole, in time that grows with the power 1.5 of their spans.  Findings of a run
that fails half-way may stand twice in the ledger; they are made distinct when read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from quayside.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """A pattern's matches, leftmost and non-overlapping; those whose ``group`` has fewer than ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1


#: Longer runs than asked for are one match, so for ``access`` and ``hex`` the least length
#: can stand in the pattern; a dropped ``assign`` match still hides what begins inside it.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
SPANS = ArrayType(StructType([StructField("start", IntegerType()), StructField("rank", IntegerType()), StructField("end", IntegerType()), StructField("kind", StringType())]))


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def find_spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of one rule, in order."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    kept = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    none = F.array().cast(SPANS)

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["match"])
        span = F.array(F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind")))
        return F.struct(end.alias("at"), F.when(F.length(x["kept"]) >= rule.least, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    def add_block(acc: Column, block: Column) -> Column:
        done = F.aggregate(block, F.struct(acc["at"].alias("at"), none.alias("spans")), add)
        return F.transform(F.array(done), lambda d: F.struct(d["at"].alias("at"), F.concat(acc["blocks"], F.array(d["spans"])).alias("blocks")))[0]

    matches = F.arrays_zip(found.alias("match"), kept.alias("kept"), F.slice(between, 1, F.size(found)).alias("gap"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(ArrayType(SPANS)).alias("blocks"))
    walk = F.aggregate(_blocks(matches), start, add_block, lambda acc: F.flatten(acc["blocks"]))
    return F.when(F.rlike(text, pattern), walk).otherwise(none)   # most texts have none


def _blocks(items: Column) -> Column:
    """An array in blocks of about the root of its size: a walk that appends copies a block for each item and the
    list of blocks for each block, so its time grows with the power 1.5 of the items, not with their square."""
    def cut(all_items: Column) -> Column:
        size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(all_items)))).cast("int")
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(all_items)), size)
        return F.transform(starts, lambda at: F.slice(all_items, at, size))
    return F.transform(F.array(items), cut)[0]


def _ledger(spark: SparkSession, path: str, table: str) -> DataFrame | None:
    """A ledger table, or None before the first scan."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{table}")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.parquet(f"{path}/{table}")


def scan(df: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> int:
    """Scan the blobs of ``df`` for the rule versions the ledger lacks; the number of pairs scanned."""
    spark = df.sparkSession
    blobs = df.select(blob_id(F.col(text_col)).alias("blob"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).dropDuplicates(["blob"])
    tag = {r.kind: f"{r.kind}@{r.version}" for r in rules}
    done = _ledger(spark, ledger, "scanned")
    if done is None:
        blobs = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:
        seen = done.groupBy("blob").agg(F.collect_set("rule").alias("seen"))   # as many as rule versions
        blobs = (blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
                 .filter(F.size(F.array_except(F.array(*map(F.lit, tag.values())), F.col("seen"))) > 0))
    columns = [F.when(~F.array_contains("seen", tag[r.kind]), find_spans(F.col("text"), r, k)).alias(r.kind) for k, r in enumerate(rules)]
    results = F.explode(F.array(*[F.struct(F.lit(tag[r.kind]).alias("rule"), F.col(r.kind).alias("spans")) for r in rules])).alias("r")
    pairs = blobs.select("blob", *columns).select("blob", results).select("blob", "r.*").filter(F.col("spans").isNotNull())
    new = scratch_path(spark, "scan")
    pairs.write.parquet(new)
    pairs = spark.read.parquet(new)
    pairs.filter(F.size("spans") > 0).write.mode("append").parquet(f"{ledger}/findings")   # before scanned: a crash between leads to a rescan
    pairs.select("blob", "rule").write.mode("append").parquet(f"{ledger}/scanned")
    return pairs.count()


def findings(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans): all spans of the rules' versions by blob, in order of start, then rule."""
    tags = [f"{r.kind}@{r.version}" for r in rules]
    found = _ledger(spark, ledger, "findings").filter(F.col("rule").isin(tags)).dropDuplicates(["blob", "rule"])
    return found.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))   # a list per rule


def scan_paths(df: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``df`` with ``spans_col``, an array of (start, rank, end, kind), in place of any such column; without ``ledger`` a new one is begun."""
    spark = df.sparkSession
    ledger = ledger or scratch_path(spark, "secret-ledger")
    scan(df, ledger, rules, text_col)
    by_blob = scratch_path(spark, "findings")   # read back, so that Catalyst knows its size
    findings(spark, ledger, rules).select(F.struct("blob", "spans").alias("__found")).write.parquet(by_blob)
    found = spark.read.parquet(by_blob)
    joined = df.join(found, blob_id(F.col(text_col)) == F.col("__found.blob"), "left")
    return joined.select(*[joined[c] for c in df.columns if c != spans_col], F.coalesce(F.col("__found.spans"), F.array().cast(SPANS)).alias(spans_col))


def secret_digest(df: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_<kind> by rule, base_sha256, spans) of every document."""
    found = scan_paths(df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), ledger, rules)
    joined = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(r.kind) for r in rules]
    return found.select(F.col("id").alias(id_col), *counts, F.sha2(joined, 256).alias("base_sha256"), joined.alias("spans"))


def redact(df: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``df`` with every span in its texts replaced by ``mark``; spans that touch or overlap become one."""
    found = scan_paths(df, ledger, rules, text_col, "__spans")
    text = F.col(text_col)
    strings = ArrayType(StringType())

    def redact_block(acc: Column, block: Column) -> Column:
        # ``tail`` is the text from ``base`` on: a piece is looked up in it, not in the whole text
        base = F.greatest(acc["at"], F.lit(0))

        def step(inner: Column, s: Column) -> Column:
            begin = F.greatest(inner["at"], F.lit(0))
            pieces = F.concat(inner["pieces"], F.array(F.substr(acc["tail"], begin - base + 1, s["start"] - begin), F.lit(mark)))
            return F.struct(F.greatest(inner["at"], s["end"]).alias("at"), F.when(s["start"] > inner["at"], pieces).otherwise(inner["pieces"]).alias("pieces"))

        done = F.aggregate(block, F.struct(acc["at"].alias("at"), F.array().cast(strings).alias("pieces")), step)
        return F.transform(F.array(done), lambda d: F.struct(
            d["at"].alias("at"), F.substr(acc["tail"], d["at"] - base + 1).alias("tail"),
            F.concat(acc["out"], F.array(F.array_join(d["pieces"], ""))).alias("out")))[0]

    start = F.struct(F.lit(-1).alias("at"), text.alias("tail"), F.array().cast(strings).alias("out"))
    new = F.aggregate(_blocks(F.col("__spans")), start, redact_block, lambda acc: F.concat(F.array_join(acc["out"], ""), acc["tail"]))
    return found.withColumn(text_col, F.when(F.size("__spans") > 0, new).otherwise(text)).drop("__spans")


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS (
  SELECT doc_id, kind, rank, least_size, regexp_extract_all(text, pattern) AS found, regexp_extract_all(text, pattern, grp) AS kept, string_split_regex(text, pattern) AS gaps
  FROM t, (VALUES
    ('assign', 0, 6, 2, '((?i:pa)[Ss][Ss](?i:word)|(?i:pa)[Ss][Ss](?i:wd)|[Ss](?i:ecret)|(?i:to)[Kk](?i:en)|(?i:api_?)[Kk](?i:ey))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
    ('access', 1, 20, 0, 'AKIA[A-Z0-9]+'), ('hex', 2, 24, 0, '[0-9a-f]+')) r(kind, rank, least_size, grp, pattern)),
spans AS (
  SELECT doc_id, kind, rank, unnest(list_filter(list_transform(range(1, len(found) + 1), lambda i: {
      's': CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS BIGINT),
      'n': length(found[i]), 'k': length(kept[i])}), lambda x: x.k >= least_size)) AS x FROM m),
by_doc AS (
  SELECT doc_id, string_agg(kind || ':' || x.s || ':' || (x.s + x.n), ',' ORDER BY x.s, rank) AS spans,
         count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN by_doc USING (doc_id)
"""
