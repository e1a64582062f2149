"""MathML out of EPS text, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip

# Openings that the exporter glues to their first attribute, by element.
GLUED: dict[str, tuple[str, ...]] = {
    r"\?xml": ("version",),
    "math": ("xmlns", "display"),
    "mo": ("stretchy",),
    "munder": ("accentunder",),
    "mover": ("lace",),
    "mfenced": ("close", "open", "separators"),
}
#: Where a blank is missing: behind such an opening, or between a closing quote and the next attribute.
UNSPACED = "(<(?:" + "|".join(f"{tag}(?={'|'.join(names)})" for tag, names in GLUED.items()) + r"""))|(?<=["'])(?=[a-zA-Z_][\w:-]*=)"""
NAMESPACE = "http://www.w3.org/1998/Math/MathML"


class EquationExtractionError(Exception):
    """An EPS file without usable MathML."""


def eps_text(content: Column) -> Column:
    """Bytes as Latin-1 text with universal newlines."""
    return F.regexp_replace(F.decode(content, "ISO-8859-1"), "\r\n?", "\n")


def comment_block(text: Column) -> Column:
    """The comment lines behind the MathML header, joined without their percent signs; null without any."""
    block = F.nullif(F.regexp_extract(text, r"%MathType!MathML![^\n]*\n((?:%[^\n]*(?:\n|$))+)", 1), F.lit(""))
    return F.replace(F.regexp_replace(block, r"(?m)^%", ""), F.lit("\n"), F.lit(""))


def math_element(block: Column) -> Column:
    """The first ``math`` element; null without a whole one."""
    return F.nullif(F.regexp_extract(block, r"(?s)<math.*?</math>", 0), F.lit(""))


def repaired(mathml: Column) -> Column:
    """Missing blanks put in, the namespace in double quotes."""
    spaced = F.regexp_replace(mathml, UNSPACED, "$1 ")
    return strip(F.replace(spaced, F.lit(f"xmlns='{NAMESPACE}'"), F.lit(f'xmlns="{NAMESPACE}"')))


def extract(eps: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``status`` (ok, no_marker, mtef_only, no_block or no_math), ``mathml`` and ``sha1``."""
    block = comment_block(F.col(text_col))
    found = eps.withColumn("_block", block).withColumn("_math", math_element(F.col("_block")))
    status = (
        F.when(~F.contains(F.col(text_col), F.lit("MathType")), "no_marker")
        .when(F.col("_block").isNull() & F.contains(F.col(text_col), F.lit("MathType!MTEF!")), "mtef_only")
        .when(F.col("_block").isNull(), "no_block")
        .when(F.col("_math").isNull(), "no_math")
        .otherwise("ok")
    )
    found = found.withColumn("status", status).withColumn("mathml", F.when(F.col("status") == "ok", repaired(F.col("_math"))))
    return found.withColumn("sha1", F.sha1(F.col("mathml").cast("binary"))).drop("_block", "_math")
