"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of every path is named by the SHA-256 of its text. The ledger is a table on shared
storage with one row per (blob, rule version) that was ever scanned, its spans included. A scan
takes the distinct blobs, leaves out the pairs that the ledger has, applies the remaining rules to
each text once, appends what it found, and joins the ledger's spans back to all paths. A rule's
version is the hash of its definition: a changed or new rule is scanned over known blobs, an
unchanged one is not.

Only built-in functions touch the rows. The place of a match follows from the lengths of the
matches and of the text between them, which ``split`` and ``regexp_extract_all`` give; running sums
over a blob's matches turn them into positions (code points, end exclusive).

Cases. A NULL text is an empty one. Repeated rows and NULL paths are kept. A blob that thousands of
paths share is scanned once. An absent or empty ledger means that nothing was scanned yet; a pair that
stands in it twice counts once. Texts of any length are scanned whole; no documents give no rows. Only
the two named columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfield.llm.tables import stored


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    likely: str         # a cheaper pattern that every text with a match contains
    group: int = 0      # the group whose length decides
    least: int = 1

    @property
    def version(self) -> str:
        return hashlib.sha256(repr((self.kind, self.pattern, self.group, self.least)).encode()).hexdigest()[:16]


# Patterns of the base rules. The last two match whole runs only, as their length
# asks; shorter runs can hold no match.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}", r"AKIA[A-Z0-9]{14}"),
    Rule("hex", r"[0-9a-f]{16,}", r"[0-9a-f]{16}"),
)
EXTRA = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", r"PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abeprs]-[A-Za-z0-9-]{10,}", r"xox[abeprs]-"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ"),
)
RULES = BASE + EXTRA
SPAN = "struct<start:int,place:int,end:int,kind:string>"
LEDGER = f"blob string, rule string, spans array<{SPAN}>"


def ledger_table(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger, or an empty one if nothing was written there yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(LEDGER).parquet(folder) if there else spark.createDataFrame([], LEDGER)


def matches(text: Column, rule: Rule) -> Column:
    """Lengths of (text before each match and after the last, matches, deciding groups)."""
    def lengths(parts: Column) -> Column:
        return F.transform(parts, F.length)

    def found(group: int) -> Column:
        return lengths(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group)))

    none = F.array().cast("array<int>")
    likely = text.rlike(rule.likely)
    return F.struct(
        F.lit(rule.version).alias("rule"),
        F.when(likely, lengths(F.split(text, rule.pattern, -1))).otherwise(none).alias("gaps"),
        F.when(likely, found(0)).otherwise(none).alias("whole"),
        F.when(likely, found(rule.group)).otherwise(none).alias("part"))


def scan_new(versions: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan the unseen (blob, rule version) pairs of ``versions`` (blob, text); append to the ledger."""
    spark = versions.sparkSession
    blobs = versions.select("blob", F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["blob"])
    wanted = F.array(*(F.lit(r.version) for r in rules))
    seen = ledger_table(spark, folder).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    unseen = blobs.join(seen, "blob", "left").withColumn(
        "todo", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))).filter(F.size("todo") > 0)
    scanned = unseen.select("blob", F.explode(F.filter(F.array(*(
        F.when(F.array_contains("todo", r.version), matches(F.col("text"), r)) for r in rules)),
        lambda x: x.isNotNull())).alias("s")).select("blob", "s.*")
    scanned = stored(scanned, "secret-scan")
    facts = spark.createDataFrame(
        [(r.version, i, r.kind, r.least) for i, r in enumerate(rules)], "rule string, place int, kind string, least int")
    hits = scanned.filter(F.size("whole") > 0).select("blob", "rule", F.posexplode(F.arrays_zip(
        F.slice("gaps", 1, F.size("whole")).alias("gap"), F.col("whole"), F.col("part"))).alias("k", "m")) \
        .select("blob", "rule", "k", "m.*")
    end = F.sum(F.col("gap") + F.col("whole")).over(Window.partitionBy("blob", "rule").orderBy("k")).cast("int")
    spans = hits.withColumn("end", end).join(facts, "rule").filter("part >= least").groupBy("blob", "rule").agg(
        F.collect_list(F.struct((F.col("end") - F.col("whole")).alias("start"), "place", "end", "kind")).alias("spans"))
    scanned.select("blob", "rule").join(spans, ["blob", "rule"], "left").select(
        "blob", "rule", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans")) \
        .write.mode("append").parquet(folder)


def findings(paths: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``paths`` (with ``blob``) and all ``spans`` of the rules, by start, then rule order."""
    # The rule order is part of the span, so that it stays right if rules were reordered since.
    order = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.version), F.lit(i))))
    ledger = ledger_table(paths.sparkSession, folder).filter(F.col("rule").isin([r.version for r in rules])) \
        .filter(F.size("spans") > 0)
    # A pair may stand in the ledger twice, after two scans at once or one that was repeated.
    found = ledger.groupBy("blob").agg(F.array_distinct(F.array_sort(F.flatten(F.collect_list(F.transform(
        "spans", lambda s: F.struct(s.start.alias("start"), order[F.col("rule")].alias("place"), s.end.alias("end"),
                                    s.kind.alias("kind"))))))).alias("spans"))
    # Written and read again, so that a blob of very many paths can be split in the join.
    found = stored(found, "secret-findings")
    return paths.join(found, "blob", "left").withColumn(
        "spans", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def scan(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, blob, spans) of every row, with the ledger in ``folder`` brought up to date."""
    versions = docs.select(F.col(id_col).alias("path"), F.col(text_col).alias("text")).select(
        "path", F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"), "text")
    scan_new(versions, folder)
    return findings(versions.select("path", "blob"), folder).select(F.col("path").alias(id_col), "blob", "spans")


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""
    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s.kind.isin(*kinds))

    return found.select(
        id_col, *(F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE),
        F.sha2(joined(of(*(r.kind for r in BASE))), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def oracle() -> str:
    """The report in SQL: positions again from the text between matches."""
    def kind(place: int, r: Rule) -> str:
        pattern = r.pattern.replace("'", "''")
        return f"""SELECT id, '{r.kind}' AS kind, {place} AS place, {r.least} AS least,
  list_transform(string_split_regex(t, '{pattern}'), lambda x: length(x)) AS gaps,
  list_transform(regexp_extract_all(t, '{pattern}'), lambda x: length(x)) AS whole,
  list_transform(regexp_extract_all(t, '{pattern}', {r.group}), lambda x: length(x)) AS part FROM d"""
    kinds = " UNION ALL ".join(kind(i, r) for i, r in enumerate(RULES))
    base = ", ".join(f"'{r.kind}'" for r in BASE)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    return f"""WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({kinds}),
e AS (SELECT id, kind, place, least, unnest(range(1, len(whole) + 1)) AS k, gaps, whole, part FROM m WHERE len(whole) > 0),
s AS (SELECT id, kind, place, whole[k] AS size, list_sum(gaps[1:k]) + list_sum(whole[1:k]) AS fin FROM e
      WHERE part[k] >= least),
l AS (SELECT id, kind, place, fin - size AS start, kind || ':' || (fin - size) || ':' || fin AS span FROM s),
a AS (SELECT id, {counts}, coalesce(string_agg(span, ',' ORDER BY start, place) FILTER (kind IN ({base})), '') AS b,
      string_agg(span, ',' ORDER BY start, place) AS spans FROM l GROUP BY id)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (id)"""
