"""Secret scans as an incremental ledger of blobs, in DataFrame operations alone.

Every historical version of every path is content-addressed by SHA-256. Of all
pairs of blob and rule version, only those that the ledger does not hold yet are
scanned, each blob once however many paths have it; the new rows are written beside
the ledger's, and findings are joined back to all paths.

Positions are code points. A rule's matches are leftmost and do not overlap: the
text is split at the rule's pattern, and lengths of what lies before and within
the matches add up to the offsets.

Defined results: null texts count as empty; repeated rows and paths are rows of
their own; a text without findings has zero counts and the digest of the empty
string; blobs already in the ledger under the rule version are not scanned
again. Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, written

# Patterns as the contract states them, letters of "assign" in either case.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"


@dataclass(frozen=True)
class Rule:
    """``least`` characters of ``group`` make a match a finding. ``narrow`` finds the same findings but fewer failing matches."""

    kind: str
    pattern: str
    group: int
    least: int
    narrow: str | None = None


RULES = (
    Rule("assign", ASSIGN, 2, 12),
    # a run of a class is matched whole, so a short run fails whether it is matched or passed over
    Rule("access", ACCESS, 0, 18, r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", HEX, 0, 16, r"[0-9a-f]{16,}"),
)
RULES_VERSION = "1"


def rule_spans(text: Column, rule: Rule) -> Column:
    """Array of (start, rank-free kind, end) of a rule's findings."""
    pattern = rule.narrow or rule.pattern
    empty = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), F.length)

    def walk(matches: Column) -> Column:
        step = F.zip_with(F.slice(between, F.lit(1), F.size(matches)), matches, lambda gap, m: F.struct(gap.alias("gap"), m.alias("m")))
        start = F.struct(F.lit(0).alias("at"), empty.alias("found"))

        def add(acc: Column, x: Column) -> Column:
            begin, end = acc["at"] + x["gap"], acc["at"] + x["gap"] + F.length(x["m"])
            own = x["m"] if not rule.group else F.regexp_extract(x["m"], pattern, rule.group)
            span = F.array(F.struct(begin.alias("start"), end.alias("end"), F.lit(rule.kind).alias("kind")))
            return F.struct(end.alias("at"), F.when(F.length(own) >= rule.least, F.concat(acc["found"], span)).otherwise(acc["found"]).alias("found"))

        return F.aggregate(step, start, add, lambda acc: acc["found"])

    # most texts have no match: they are neither split nor walked
    return F.when(text.rlike(pattern), walk(matches)).otherwise(empty)


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``found``, findings of all rules by start and then by the rules' order, beside the blobs' other columns."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    placed = lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("rank"), s["end"].alias("end"),
        s["kind"].alias("kind"))
    ranked = F.transform(F.concat(*[rule_spans(F.col("text"), r) for r in rules]), placed)
    return blobs.withColumn("found", F.array_sort(ranked))


def versions_of(docs: DataFrame, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, blob): every version content-addressed; null texts are empty."""
    rows = id_and_text(docs, path_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return rows.withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))


def scan_unseen(
    versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, rules_version: str = RULES_VERSION
) -> DataFrame:
    """(blob, rules_version, found) of every blob that the ledger does not hold under the rule version, written.

    Copies meet after each task has dropped its own, and a blob's findings, not
    its text, are what is written.
    """
    unseen = versions
    if ledger is not None:
        done = ledger.filter(F.col("rules_version") == rules_version).select(F.col("blob").alias("done"))
        unseen = versions.join(done, versions["blob"] == done["done"], "left_anti")
    blobs = unseen.groupBy("blob").agg(F.first("text").alias("text"))
    return written(scan(blobs, rules).select("blob", F.lit(rules_version).alias("rules_version"), "found"), "ledger")


def update_ledger(
    versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, rules_version: str = RULES_VERSION
) -> DataFrame:
    """The ledger with every blob of ``versions``; only unseen pairs are scanned, what the ledger held is not rewritten."""
    fresh = scan_unseen(versions, ledger, rules, rules_version)
    return fresh if ledger is None else ledger.select(fresh.columns).unionAll(fresh)


def findings(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """(doc_id, found) of every row, through a ledger given as a table; see ``scanned`` for one that is kept."""
    versions = versions_of(docs)
    return _to_paths(versions, update_ledger(versions, ledger))


def _to_paths(versions: DataFrame, ledger: DataFrame) -> DataFrame:
    """Findings joined back to every path of their blob."""
    seen = ledger.filter((F.col("rules_version") == RULES_VERSION) & (F.size("found") > 0)).select(F.col("blob").alias("seen"), "found")
    paths = versions.select("doc_id", "blob")
    none = F.array().cast(seen.schema["found"].dataType)
    joined = paths.join(seen, paths["blob"] == seen["seen"], "left")
    return joined.select("doc_id", F.coalesce("found", none).alias("found"))


def digest(found: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    spans = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", *[count(r.kind) for r in RULES], F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


def scanned(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, found) of every row, through the ledger kept at ``path``: what it holds is read, what was unseen is added to it.

    A second run over the same texts scans nothing. New rows are written whole
    before they are added, so a run that fails half-way leaves them unseen.
    """
    spark = docs.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    held = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    versions = versions_of(docs)
    scan_unseen(versions, spark.read.parquet(path) if held else None).write.mode("append").parquet(path)
    return _to_paths(versions, spark.read.parquet(path))


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns, each finding in ``text`` replaced by its kind in brackets; of findings that overlap, the union goes.

    ``n_chars``, where there is one, is counted anew. The rows' own columns
    travel as one struct, so they may have any name.
    """
    found = update_ledger(versions_of(docs)).filter(F.size("found") > 0).select(F.col("blob").alias("seen"), "found")
    own = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)
    joined = docs.select(own.alias("own"), F.struct("*").alias("row")).join(found, F.col("own") == F.col("seen"), "left")
    text, changed = F.col("row").getField("text"), F.col("found").isNotNull()

    def cut(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]"))
        out = F.when(fresh, F.concat(acc["out"], piece)).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("found", start, cut, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    columns = []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == "text":
            value = F.when(changed, clean).otherwise(value)
        elif c == "n_chars":
            value = F.when(changed, F.length(clean).cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return joined.select(*columns)
