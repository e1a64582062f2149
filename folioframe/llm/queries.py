"""The queries opN_<name> over whole tables, with production parameters, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from . import decontaminate, embedding, language, licences, packing, secrets, sentencepiece_codec, simhash, token_counts, toxicity
from .licence_texts import KNOWN, full_texts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where the public tokenizers' files are; the package is installed on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scanned(table(spark, sf_dir, "documents"), scratch_path(spark, "secrets-ledger")))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op8_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_decontamination, op3_language, op4_secrets, op5_token_counts, op6_simhash,
        op7_packing, op8_embedding, op9_licences, op10_sentencepiece)}


_WORDS = r"list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '')"
_SHINGLES = "list_distinct(list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i+{m}], ' ')))".format
_FIVE = f"CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE {_SHINGLES(n=5, m=4)} END"

#: Five-word shingles, and for items of n < 5 words the n-word shingles of all documents.
DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
     ds AS (SELECT doc_id, 5 AS n, unnest({_SHINGLES(n=5, m=4)}) AS s FROM d WHERE len(w) >= 5
            {"".join(f" UNION ALL SELECT doc_id, {n}, unnest({_SHINGLES(n=n, m=n - 1)}) FROM d WHERE len(w) >= {n} AND {n} IN (SELECT len(w) FROM i)" for n in (1, 2, 3, 4))}),
     isz AS (SELECT item_id, w, {_FIVE} AS l FROM i),
     ish AS (SELECT item_id, least(len(w), 5) AS n, unnest(l) AS s FROM isz),
     m AS (SELECT doc_id, item_id, count(DISTINCT s) AS n_shared FROM ds JOIN ish USING (n, s) GROUP BY ALL)
SELECT m.doc_id, m.item_id, CAST(len(l) AS BIGINT) AS n_shingles, CAST(n_shared AS BIGINT) AS n_shared, n_shared / len(l) AS containment
FROM m JOIN isz USING (item_id) WHERE n_shared >= 0.8 * len(l)
"""


def _spans(kind: str, pattern: str, own: str, least: int) -> str:
    """SQL for the findings of one kind: offsets are sums of what lies before and within the matches."""
    p = pattern.replace("'", "''")
    return f"""
    SELECT doc_id, rank, kind, s AS start, s + length(m) AS fin FROM (
      SELECT doc_id, {{'assign': 0, 'access': 1, 'hex': 2}}['{kind}'] AS rank, '{kind}' AS kind, m, {own} AS own,
             sum(length(g)) OVER (PARTITION BY doc_id ORDER BY k) + sum(length(m)) OVER (PARTITION BY doc_id ORDER BY k) - length(m) AS s
      FROM (SELECT doc_id, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g, unnest(range(1, len(ms) + 1)) AS k
            FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS ms, string_split_regex(t, '{p}') AS gs FROM d)))
    WHERE length(own) >= {least}"""


_ASSIGN_SQL = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
SECRETS_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     f AS ({" UNION ALL ".join((
         _spans("assign", _ASSIGN_SQL, "regexp_extract(m, '" + _ASSIGN_SQL.replace("'", "''") + "', 2)", 12),
         _spans("access", "AKIA[A-Z0-9]+", "m", 18),
         _spans("hex", "[0-9a-f]+", "m", 16),
     ))}),
     g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
                  string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(fin AS BIGINT), ',' ORDER BY start, rank) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


#: Every pair of a label, and reachability by recursion: for tables of test size.
EMBEDDING_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CASE WHEN isfinite(x) THEN CAST(x AS DOUBLE) ELSE 0 END) AS e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
     l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) ELSE 0 END >= 0.93),
     r AS (SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON l.a = r.c),
     n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(any_value(n_links), 0) AS n_links, min(c) AS component_id, vec_id = min(c) AS kept FROM r LEFT JOIN n ON n.a = r.vec_id GROUP BY vec_id
"""


def _canonical(text: str) -> str:
    lines = f"regexp_split_to_array(coalesce({text}, ''), '\\r\\n|\\n|\\r')"
    words = f"trim(regexp_replace(replace(lower(x), '{licences.MARKS}', ' c '), '{licences.PUNCTUATION}', ' ', 'g'))"
    holder = f"(regexp_matches(x, '{licences.COPYRIGHT_LINE}') AND NOT regexp_matches(x, '{licences.BODY_LINE}'))"
    return f"list_filter(list_transform({lines}, lambda x: {words}), lambda x: x <> '' AND NOT {holder})"


def _respelled(words: str) -> str:
    out = f"(' ' || {words} || ' ')"
    for written, canonical in licences.SPELLINGS:
        out = f"replace({out}, ' {written} ', ' {canonical} ')"
    return f"trim({out})"


def licences_sql() -> str:
    """Documents are made canonical in SQL; the digests of all known texts are those that plain Python gives."""
    digests = {(name, licences.plain_digest(text)[0]) for name, text in KNOWN + full_texts()}
    known = ", ".join(f"('{name}', '{digest}')" for name, digest in sorted(digests))
    return f"""
WITH k AS (SELECT digest, min(licence) AS licence FROM (VALUES {known}) AS v(licence, digest) GROUP BY 1),
     l AS (SELECT doc_id, {_canonical("text")} AS lines FROM documents),
     w AS (SELECT doc_id, sha256({_respelled("array_to_string(lines, ' ')")}) AS digest FROM l),
     n AS (SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices
           FROM (SELECT doc_id, unnest(lines) AS x FROM l) JOIN k ON sha256({_respelled("x")}) = k.digest GROUP BY doc_id)
SELECT w.doc_id, w.digest, k.licence, coalesce(n.notices, '') AS notices FROM w LEFT JOIN k USING (digest) LEFT JOIN n ON n.doc_id = w.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": DECONTAMINATION_SQL, "op4_secrets": SECRETS_SQL, "op8_embedding": EMBEDDING_SQL, "op9_licences": licences_sql()}
