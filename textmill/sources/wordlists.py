"""Stop-word and template-pair scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.strings import trimmed


def parse_stopwords(lines: DataFrame) -> DataFrame:
    """``(lang, w)`` from ``(lang, value)``: trimmed, lower case, no duplicates."""
    words = lines.select("lang", F.lower(trimmed(F.col("value"))).alias("w"))
    return words.where("w <> ''").dropDuplicates(["lang", "w"])


def read_stopwords(spark: SparkSession, path: str, lang: str | None = None) -> DataFrame:
    """Word lists below ``path``; without ``lang`` it comes from ``lang=`` folders."""
    lines = spark.read.option("lineSep", "\n").text(path)
    if lang is not None:
        lines = lines.withColumn("lang", F.lit(lang))
    return parse_stopwords(lines)


# both sides of a line as "X pred Y"
_BLANK = r"[\x00-\x08\x0a-\x20]*"
_SIDE = _BLANK + r"[XY] [^\t]+ [XY]" + _BLANK
PAIR_LINE = "^" + _SIDE + r"\t" + _SIDE + r"(\t.*)?$"


def _plain_side(side: Column) -> Column:
    """Whether a piece without tab is a side and nothing else, by its ends."""
    starts = F.startswith(side, F.lit("X ")) | F.startswith(side, F.lit("Y "))
    ends = F.endswith(side, F.lit(" X")) | F.endswith(side, F.lit(" Y"))
    return (F.octet_length(side) >= 5) & starts & ends


def _predicate(side: Column) -> Column:
    return F.substr(side, F.lit(3), F.length(side) - 4)


def parse_pairs(lines: DataFrame, value: str = "value") -> DataFrame:
    """Template pairs from lines ``X pred Y<TAB>X pred Y`` (or ``Y pred X``).

    Adds ``lhs, rhs, p, q`` (predicates), their verbs and prepositions, and
    ``swapped``: whether the right side names the slots in the other order.
    Lines of another form are dropped.  A line of two bare sides is told by its bytes; ``PAIR_LINE`` decides on the others only.
    """
    rest = [c for c in lines.columns if c != value]
    line = F.col(value)
    bare = F.when(F.endswith(line, F.lit("\r")), F.substr(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    # made by a generator: a filter on columns would be pushed below and cut the line over and over
    cut = F.struct(
        F.substring_index(bare, "\t", 1).alias("_l"), F.substring_index(bare, "\t", -1).alias("_r"), F.octet_length(bare).alias("_size")
    )
    pieces = lines.select(*rest, line.alias("_line"), F.inline(F.array(cut)))
    one_tab = F.octet_length("_l") + F.octet_length("_r") + 1 == F.col("_size")
    plain = one_tab & _plain_side(F.col("_l")) & _plain_side(F.col("_r"))
    kept = pieces.where(F.when(plain, True).otherwise(F.col("_line").rlike(PAIR_LINE)))
    sides = F.split(F.col("_line"), "\t")
    out = kept.select(
        *rest,
        F.when(plain, F.col("_l")).otherwise(trimmed(sides[0])).alias("lhs"),
        F.when(plain, F.col("_r")).otherwise(trimmed(sides[1])).alias("rhs"),
    )
    out = out.withColumn("p", _predicate(F.col("lhs"))).withColumn("q", _predicate(F.col("rhs")))
    for side, verb, prep in (("p", "p_verb", "p_prep"), ("q", "q_verb", "q_prep")):
        head = F.substring_index(side, " ", 1)
        tail = F.substr(F.col(side), F.length(head) + 2)
        out = out.withColumn(verb, head).withColumn(prep, tail)
    swapped = F.substring("lhs", 1, 1) != F.substring("rhs", 1, 1)
    return out.withColumn("swapped", swapped)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Template pairs of a text file; see ``parse_pairs``."""
    return parse_pairs(spark.read.option("lineSep", "\n").text(path))
