"""Style semantics as a dimension table: rule joins, usage counts, overlays."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RULE_SCHEMA = (
    "name string, kind string, level int, ordered boolean, marker string, nested boolean, variant string, title string, language string, role string, raw map<string,string>"
)
#: Rules broadcast at most: a style sheet is small, and the bound is checked.
MOST_RULES = 10_000


def rules_table(spark: SparkSession, rules: dict[str, dict[str, Any]]) -> DataFrame:
    """One row a rule; keys that no column has stay in ``raw``."""
    rows = []
    for name, rule in rules.items():
        if not isinstance(rule, dict):
            raise TypeError(f"rule of {name!r} is no mapping")
        ordered = bool(rule.get("ordered", False))
        rows.append((
            name, str(rule.get("kind", "paragraph")), int(rule.get("level", 1)), ordered, str(rule.get("marker", "decimal" if ordered else "bullet")),
            bool(rule.get("nested", False)), str(rule.get("variant", "note")), rule.get("title"), str(rule.get("language", "")), rule.get("role"),
            {k: str(v) for k, v in rule.items()},
        ))
    return spark.createDataFrame(rows, RULE_SCHEMA)


def small(rules: DataFrame, most: int = MOST_RULES) -> DataFrame:
    """``rules`` for a broadcast if they are at most ``most`` rows; else as they are, for a shuffle."""
    return F.broadcast(rules) if rules.limit(most + 1).count() <= most else rules


def apply_rules(paragraphs: DataFrame, rules: DataFrame, unknown: str = "passthrough") -> DataFrame:
    """Left join to the rules by ``style``; what has none becomes a paragraph, or goes under ``drop``."""
    joined = paragraphs.join(small(rules.withColumnRenamed("name", "rule_name")), F.col("style") == F.col("rule_name"),
        "left").withColumn("mapped", F.col("rule_name").isNotNull())
    if unknown == "drop":
        joined = joined.filter("mapped")
    elif unknown not in ("passthrough", "warn"):
        raise ValueError(f"unknown policy {unknown!r}")
    return joined.withColumn("kind", F.coalesce("kind", F.lit("paragraph"))).drop("rule_name")


def usage(rows: DataFrame, style: str = "style", order: str | None = None) -> DataFrame:
    """(style, n, first_pos): how often each style occurs, and where first."""
    aggs = [F.count("*").alias("n")] + ([F.min(order).alias("first_pos")] if order else [])
    return rows.groupBy(F.col(style).alias("style")).agg(*aggs)


def most_used(rows: DataFrame, top: int, style: str = "style", order: str = "ord") -> DataFrame:
    """Styles by use, ties by first appearance; all for ``top`` zero."""
    ranked = usage(rows, style, order).orderBy(F.desc("n"), "first_pos")
    return ranked.limit(top) if top else ranked


def seen_and_unmapped(
    rows: DataFrame, rules: DataFrame, style: str = "style", silent_prefix: str | None = None, by: tuple[str, ...] = ()
) -> DataFrame:
    """(by, style, seen, unmapped): uses, and uses without a rule; styles with ``silent_prefix`` are never reported unmapped."""
    names = small(rules.select(F.col("name").alias("rule_name")).distinct())
    missing = F.col("rule_name").isNull()
    if silent_prefix:
        missing &= ~F.startswith(F.col(style), F.lit(silent_prefix))
    joined = rows.join(names, F.col(style) == F.col("rule_name"), "left")
    return joined.groupBy(*by, F.col(style).alias("style")).agg(F.count("*").alias("seen"), F.count_if(missing).alias("unmapped"))


def overlay_paths(base: DataFrame, over: DataFrame, key: str = "path", value: str = "value") -> DataFrame:
    """Overlay of one (path, value) table on another: a full outer join in which the overlay wins."""
    b, o = base.select(F.col(key).alias("path"), F.col(value).alias("base")), over.select(F.col(key).alias("path"), F.col(value).alias("over"))
    return b.join(o, "path", "full").select("path", F.coalesce("over", "base").alias("value"))


def merged(base: dict[str, Any], over: dict[str, Any]) -> dict[str, Any]:
    """Mappings merged key by key, the overlay winning; anything else replaces."""
    return {**base, **{k: merged(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in over.items()}}
