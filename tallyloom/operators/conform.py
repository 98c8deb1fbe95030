"""Conforming: parties from several roles, prefix classification, keyword matching."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import decode, regex_or_null

# Label for rows that match no keyword.
UNKNOWN_MODULE = "DESCONOCIDO"


def union_tagged(frames: Mapping[str, DataFrame], columns: Sequence[str], tag_col: str = "origin") -> DataFrame:
    """``UNION ALL`` of several sources, by column name, each tagged with its origin."""
    out = None
    for tag, df in frames.items():
        part = df.select(F.lit(tag).alias(tag_col), *columns)
        out = part if out is None else out.unionByName(part)
    return out


def conform_parties(parties: DataFrame, name_col: str, norm_id: Column, norm_col: str = "norm_id",
                    best_col: str = "best_name", count_col: str = "n_names") -> DataFrame:
    """One best label per normalised id (``MAX(name)``), spread back to every party row.

    The label table is an aggregate (combined map-side, so one id holding a
    third of all rows is reduced before the shuffle) and is joined back on
    the computed key.  Parties without an id match nothing and never enter the
    join, so they do not meet in one task.
    """
    tagged = parties.withColumn(norm_col, norm_id)
    best = tagged.filter(F.col(norm_col).isNotNull()).groupBy(norm_col).agg(F.max(name_col).alias(best_col),
                                        F.countDistinct(name_col).alias(count_col))
    known = tagged.filter(F.col(norm_col).isNotNull()).join(best, norm_col, "left").select(*tagged.columns, best_col, count_col)
    rest = tagged.filter(F.col(norm_col).isNull()).select(
        "*", F.lit(None).cast(best.schema[best_col].dataType).alias(best_col), F.lit(None).cast("long").alias(count_col))
    return known.unionByName(rest)


def classify_by_prefix(df: DataFrame, text_col: str, pattern: str, mapping: Mapping[str, str],
                       default: str, prefix_col: str = "prefix", class_col: str = "system") -> DataFrame:
    """Take a prefix by regex and decode it to a class (unknown prefixes get ``default``)."""
    prefix = regex_or_null(text_col, pattern)
    return df.withColumn(prefix_col, prefix).withColumn(class_col, decode(F.col(prefix_col), mapping, default))


def best_keyword_match(df: DataFrame, keywords: DataFrame, key: str, text_col: str, prefix_col: str,
                       kw_prefix_col: str = "prefix", module_col: str = "module", words_col: str = "words",
                       unknown: str = UNKNOWN_MODULE) -> DataFrame:
    """Module of each row by the longest keyword contained in its text, then alphabetical.

    Candidates come from an equi-join on the prefix plus a ``contains`` residual
    (never a cross join); the planner broadcasts the
    keyword table if it is small.
    Rows without a match get ``unknown`` and a NULL keyword.
    """
    kw = keywords.select(F.col(kw_prefix_col).alias("_tl_prefix"), F.col(module_col).alias("_tl_module"),
                         F.explode(words_col).alias("_tl_word"))
    text = F.lower(F.col(text_col))
    cand = df.select(key, prefix_col, text_col).join(
        kw,
        (F.col(prefix_col) == F.col("_tl_prefix")) & text.contains(F.lower(F.col("_tl_word"))),
    )
    best = cand.groupBy(key).agg(F.min(F.struct(
        (-F.length("_tl_word")).alias("neg_len"), F.col("_tl_word").alias("word"),
        F.col("_tl_module").alias("module"))).alias("_tl_best"))
    out = df.join(best, key, "left")
    return out.withColumn(module_col, F.coalesce(F.col("_tl_best.module"), F.lit(unknown))) \
        .withColumn("keyword", F.col("_tl_best.word")).drop("_tl_best")


def indexed_keyword_match(df: DataFrame, keywords: DataFrame, key: str, text_col: str, prefix_col: str,
                          kw_prefix_col: str = "prefix", module_col: str = "module", words_col: str = "words",
                          unknown: str = UNKNOWN_MODULE, n: int = 3) -> DataFrame:
    """``best_keyword_match`` for long keyword lists: the same rows without comparing every text with every keyword.

    A keyword is filed under one of its ``n``-character parts, the one that the
    fewest texts have; a shorter keyword is filed under itself.  Texts meet keywords
    by an equi-join on prefix and part, so a text is compared with the keywords
    whose rarest part it holds, and ``contains`` decides.  A part that many texts
    share files a keyword only if the keyword has no rarer one.  The empty keyword
    is in every text of its prefix.

    A text is searched once, however many rows have it, and of a keyword's modules
    only the first can win.  Texts cut into parts are many times larger than the
    planner takes them for, so no join may send them, or what came of them, whole to
    the driver: all are merge joins.
    """
    kw = keywords.select(F.col(kw_prefix_col).alias("_tl_prefix"), F.col(module_col).alias("_tl_module"),
                         F.explode(words_col).alias("_tl_word")).filter(F.col("_tl_word").isNotNull())
    kw = kw.groupBy("_tl_prefix", "_tl_word").agg(F.min(F.struct("_tl_module")).alias("_tl_first")).select(
        "_tl_prefix", "_tl_word", "_tl_first._tl_module", F.lower("_tl_word").alias("_tl_lower")).checkpoint(eager=True)
    sizes = [r[0] for r in kw.select(F.least(F.length("_tl_lower"), F.lit(n)).alias("s")).distinct().collect()]  # n + 1 at most
    rows = df.select(key, F.col(prefix_col).alias("_tl_prefix"), F.lower(F.col(text_col)).alias("_tl_text")).filter(
        F.col(key).isNotNull() & F.col("_tl_prefix").isNotNull() & F.col("_tl_text").isNotNull())
    texts = rows.select("_tl_prefix", "_tl_text").distinct()

    def parts(text: str, size: int) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
        every = F.filter(F.transform(places, lambda at: F.substr(F.col(text), at, F.lit(size))), lambda p: F.length(p) == size)
        return F.array_distinct(every)

    grams = F.flatten(F.array(*[parts("_tl_text", s) for s in sizes])) if sizes else F.array().cast("array<string>")
    filed = texts.select("_tl_prefix", "_tl_text", F.explode(grams).alias("_tl_part"))
    own = F.when(F.length("_tl_lower") < n, F.array("_tl_lower")).otherwise(parts("_tl_lower", n))
    candidates = kw.withColumn("_tl_part", F.explode(own))
    common = filed.groupBy("_tl_prefix", "_tl_part").agg(F.count(F.lit(1)).alias("_tl_n"))
    # a keyword with a part that no text has is in none
    rarest = candidates.hint("merge").join(common, ["_tl_prefix", "_tl_part"], "left").groupBy("_tl_prefix", "_tl_word", "_tl_module").agg(
        F.min(F.struct(F.coalesce("_tl_n", F.lit(0)).alias("n"), F.col("_tl_part").alias("part"))).alias("_tl_file"))
    index = rarest.filter("_tl_file.n > 0").select(
        "_tl_prefix", "_tl_word", "_tl_module", F.col("_tl_file.part").alias("_tl_part"))
    cand = filed.hint("merge").join(index, ["_tl_prefix", "_tl_part"]).filter(F.col("_tl_text").contains(F.lower("_tl_word")))
    first = F.min(F.struct((-F.length("_tl_word")).alias("neg_len"), F.col("_tl_word").alias("word"),
                           F.col("_tl_module").alias("module"))).alias("_tl_best")
    found = cand.groupBy("_tl_prefix", "_tl_text").agg(first)
    best = rows.hint("merge").join(found, ["_tl_prefix", "_tl_text"]).groupBy(key).agg(F.min("_tl_best").alias("_tl_best"))
    out = df.hint("merge").join(best, key, "left")
    return out.withColumn(module_col, F.coalesce(F.col("_tl_best.module"), F.lit(unknown))) \
        .withColumn("keyword", F.col("_tl_best.word")).drop("_tl_best")
