"""Licence scans by canonical digest lookup, in DataFrame operations alone.

A text is made canonical: letters lower-cased, copyright lines dropped,
punctuation and white space turned into single spaces, equivalent spellings made
one. Its SHA-256 is looked up, by hash join, among those of known licence texts
made canonical the same way. Besides the entire text, each of its lines is
looked up as a text of its own, however long, which finds notices and whole
licences written on one line.

Known digests are a table of any size: it is broadcast if it is small, and joined
by shuffle otherwise.

Defined results: null and empty texts, and texts of copyright lines alone, have
the digest of the empty string and no licence; repeated rows are looked up each;
a text known under two licences takes the first by name. Only the named columns
are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, written
from .licence_texts import KNOWN, full_texts

# Fixed values. Patterns use classes that every regular expression engine reads alike.
MARKS = "©"
PUNCTUATION = r"[^a-z0-9\x{80}-\x{10FFFF}]+"
#: Canonical lines that name a holder: with the mark or a year, or with a name behind the word.
COPYRIGHT_LINE = r"^((portions )?copyright( c)?( [^ ].*)?|c [0-9][0-9][0-9][0-9].*|all rights reserved)$"
#: Lines that begin so are of a licence's body, wherever it is wrapped; a mark or a year makes them a holder's all the same.
BODY_LINE = (
    r"^(portions )?copyright (also|and|as|at|but|by|claims?|disclaimer|for|holders?|if|in|infringement|interests?|is|it|laws?|licen[sc]es?|lines?|means|notices?"
    r"|of|on|or|owners?|ownership|permission|protection|rights?|shall|statements?|status|term|terms|that|the|then|this|to|treaty|under|which|with)( [^0-9]*)?$"
)
#: Equivalent spellings: (as written, canonical), whole words of canonical text.
SPELLINGS: tuple[tuple[str, str], ...] = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"), ("sublicence", "sublicense"),
    ("non infringement", "noninfringement"), ("non commercial", "noncommercial"), ("merchantibility", "merchantability"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("organisation", "organization"),
    ("acknowledgement", "acknowledgment"), ("favour", "favor"), ("whilst", "while"), ("and or", "and"), ("https", "http"),
)
#: Known texts broadcast at most; more are joined by shuffle.
MOST_KNOWN = 1_000


def canonical_words(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(F.lower(line), F.lit(MARKS), F.lit(" c ")), PUNCTUATION, " "))


def respelled(words: Column) -> Column:
    out = F.concat(F.lit(" "), words, F.lit(" "))
    for written, canonical in SPELLINGS:
        out = F.replace(out, F.lit(f" {written} "), F.lit(f" {canonical} "))
    return F.trim(out)


def canonical_lines(text: Column) -> Column:
    """Canonical lines of a text; empty ones and copyright lines are dropped."""
    lines = F.split(F.coalesce(text, F.lit("")), r"\r\n|\n|\r", -1)
    holder = lambda x: x.rlike(COPYRIGHT_LINE) & ~x.rlike(BODY_LINE)
    return F.filter(F.transform(lines, canonical_words), lambda x: (x != "") & ~holder(x))


def sha(words: Column) -> Column:
    return F.sha2(words.cast("binary"), 256)


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    """(digest, licence, chars) of the known texts, all by default; an empty canonical text is none."""
    texts = spark.createDataFrame(list(KNOWN + full_texts() if known is None else known), "licence string, text string")
    words = texts.select("licence", respelled(F.array_join(canonical_lines(F.col("text")), " ")).alias("words")).filter("words != ''")
    return words.groupBy(sha(F.col("words")).alias("digest"), F.length("words").alias("chars")).agg(F.min("licence").alias("licence"))


def licences(docs: DataFrame, known: DataFrame | None = None, most: int = MOST_KNOWN) -> DataFrame:
    """(doc_id, digest, licence, notices): the entire text's licence, and the licences of single lines, sorted and comma-joined.

    ``known`` is (digest, licence, chars). Up to ``most`` known texts meet the
    texts in a broadcast hash join and the lines in a map of the same rows, so
    that texts are neither exploded nor shuffled; a line is hashed only if it is
    as long as some known text. More known texts meet digests by shuffle.
    """
    known = written(known_digests(docs.sparkSession) if known is None else known.select("digest", "licence", "chars"), "known")
    known = known.groupBy("digest", "chars").agg(F.min("licence").alias("licence"))
    rows = known.limit(most + 1).collect()
    named = known.select(F.col("digest").alias("known_digest"), "licence")
    lines = id_and_text(docs).select("doc_id", canonical_lines(F.col("text")).alias("lines"))
    whole = sha(respelled(F.array_join("lines", " "))).alias("digest")
    if len(rows) > most:
        return _joined(lines.select("doc_id", whole, F.array_distinct(F.transform("lines", lambda x: sha(respelled(x)))).alias("digests")), named)
    table = F.map_from_arrays(F.lit([r["digest"] for r in rows]).cast("array<string>"), F.lit([r["licence"] for r in rows]).cast("array<string>"))
    lengths = sorted({r["chars"] for r in rows}) or [-1]
    joined = lines.select("doc_id", "lines", whole).join(F.broadcast(named), F.col("digest") == F.col("known_digest"), "left")
    spelled = F.filter(F.transform("lines", respelled), lambda x: F.length(x).isin(lengths))
    found = F.filter(F.transform(spelled, lambda x: F.try_element_at(table, sha(x))), lambda x: x.isNotNull())
    return joined.select("doc_id", "digest", "licence", F.array_join(F.array_sort(F.array_distinct(found)), ",").alias("notices"))


def _joined(texts: DataFrame, known: DataFrame) -> DataFrame:
    """Digests of texts and lines joined to any number of known ones: what occurs of them is found first, from distinct digests."""
    rows = written(texts.withColumn("uid", F.monotonically_increasing_id()), "digests")
    single = rows.select("uid", F.explode("digests").alias("line"))
    occur = written(single.select("line").distinct().join(known, F.col("line") == F.col("known_digest")).select(F.col("line").alias("met"),
        "licence"), "occurring")
    hits = single.join(occur, F.col("line") == F.col("met")).groupBy(F.col("uid").alias("of")).agg(F.array_sort(F.collect_set("licence")).alias("found"))
    whole = rows.select("uid", "doc_id", "digest").join(known, F.col("digest") == F.col("known_digest"), "left")
    joined = whole.join(hits, F.col("uid") == F.col("of"), "left")
    return joined.select("doc_id", "digest", "licence", F.coalesce(F.array_join("found", ","), F.lit("")).alias("notices"))


def plain_digest(text: str) -> tuple[str, int]:
    """Digest and length of a text's canonical form in plain Python: what the expressions above give, for checks."""
    lines = [re.sub(r"[^a-z0-9\x80-\U0010ffff]+", " ", x.lower().replace(MARKS, " c ")).strip(" ") for x in re.split(r"\r\n|\n|\r", text)]
    kept = [x for x in lines if x and not (re.search(COPYRIGHT_LINE, x) and not re.search(BODY_LINE, x))]
    words = f" {' '.join(kept)} "
    for written_, canonical in SPELLINGS:
        words = words.replace(f" {written_} ", f" {canonical} ")
    words = words.strip(" ")
    return hashlib.sha256(words.encode()).hexdigest(), len(words)
