"""Lookups: code tables, pre-aggregated scalar lookups, fallbacks.  No join here is forced to a broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when ``keys`` repeat (guard against fan-out before a one-to-one join)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"keys {list(keys)} are not unique, e.g. {dup[0].asDict()}")


def code_lookup(df: DataFrame, lookup: DataFrame, kind: str, lang: str, key: Column, out: str,
                kind_col: str = "type", code_col: str = "code", lang_col: str = "lang",
                meaning_col: str = "meaning", code_cast: str | None = None) -> DataFrame:
    """Left-join a label from a code table filtered to one type and language.

    The type/language filter sits on the lookup side (a constant predicate in
    ON keeps every left row); the lookup is reduced to one meaning per code so
    it can never multiply rows.  The planner broadcasts it when its bytes are under the session's threshold.
    """
    code = F.col(code_col).cast(code_cast) if code_cast else F.col(code_col)
    lk = (
        lookup.filter((F.col(kind_col) == kind) & (F.col(lang_col) == lang))
        .groupBy(code.alias("_tl_code"))
        .agg(F.max(meaning_col).alias(out))
    )
    return df.join(lk, key == F.col("_tl_code"), "left").drop("_tl_code")


def scalar_lookup(df: DataFrame, ref: DataFrame, key: str, ref_key: str, aggs: Sequence[Column]) -> DataFrame:
    """Correlated scalar subquery rewritten as pre-aggregation + left join (J21/J22)."""
    pre = ref.groupBy(F.col(ref_key).alias("_tl_rk")).agg(*aggs)
    return df.join(pre, df[key] == pre["_tl_rk"], "left").drop("_tl_rk")


def fallback(*cols, default=None) -> Column:
    """First non-null value of a chain of lookups, else ``default``."""
    chain = [F.col(c) if isinstance(c, str) else c for c in cols]
    if default is not None:
        chain.append(F.lit(default))
    return F.coalesce(*chain)


def lookup_many(df: DataFrame, code_cols: Sequence[str], lookup: DataFrame, code_col: str = "code",
                value_col: str = "meaning", suffix: str = "_name") -> DataFrame:
    """Label many code columns from one lookup table, one left join per column.

    The lookup is reduced to one value per code first, so no row can be
    multiplied.  A code table is small: the planner broadcasts it and the rows
    are not shuffled at all.
    """
    lk = lookup.groupBy(F.col(code_col).alias("_tl_code")).agg(F.max(value_col).alias("_tl_value"))
    for c in code_cols:
        one = lk.select(F.col("_tl_code").alias(f"_tl_{c}"), F.col("_tl_value").alias(f"{c}{suffix}"))
        df = df.join(one, F.col(c).cast("string") == F.col(f"_tl_{c}"), "left").drop(f"_tl_{c}")
    return df


def star_join(fact: DataFrame, dims: Sequence[tuple], how: str = "left", check: bool = False) -> DataFrame:
    """Join a fact to its dimensions: ``dims`` is a list of ``(dim_df, fact_keys, dim_keys)``.

    Each dimension is reduced to the columns it contributes and renamed onto
    the fact's key names, so there is one key column per join.  With
    ``check=True`` every dimension is first verified unique on its key (a
    one-to-many side would multiply fact rows); the check is a key-only
    aggregate with a one-row result.
    """
    out = fact
    for dim, fact_keys, dim_keys in dims:
        fact_keys = [fact_keys] if isinstance(fact_keys, str) else list(fact_keys)
        dim_keys = [dim_keys] if isinstance(dim_keys, str) else list(dim_keys)
        if check:
            check_unique(dim, dim_keys)
        renamed = dim.select(*[F.col(d).alias(f) for d, f in zip(dim_keys, fact_keys)],
                             *[c for c in dim.columns if c not in dim_keys])
        out = out.join(renamed, fact_keys, how)
    return out


def fallback_chain(df: DataFrame, chain: Sequence[tuple], out: str, default=None,
                   source_col: str | None = None) -> DataFrame:
    """First value found along a chain of lookups, the chain given once as data.

    ``chain`` holds ``(name, lookup_df, left_key, right_key, value)``, where
    ``value`` is a column name or a Column (a struct carries several fields at
    once); each lookup is reduced to one value per key (``max``) so it cannot
    multiply rows.  Lookups by the same ``left_key`` are put together first, where
    their aggregates already lie by key, so ``df`` is joined (and at scale shuffled)
    once per key column and not once per link.  ``source_col`` names which link
    supplied the value.
    """
    values, names, by_key = [], [], {}
    for i, (name, lookup, left_key, right_key, value_col) in enumerate(chain):
        v = f"_tl_fb{i}"
        value = F.col(value_col) if isinstance(value_col, str) else value_col
        key = f"_tl_k_{left_key}"
        lk = lookup.filter(F.col(right_key).isNotNull()).groupBy(F.col(right_key).alias(key)).agg(F.max(value).alias(v))
        by_key[left_key] = by_key[left_key].join(lk, key, "full_outer") if left_key in by_key else lk
        values.append(v)
        names.append(name)
    for left_key, lk in by_key.items():
        key = f"_tl_k_{left_key}"
        df = df.join(lk, F.col(left_key) == F.col(key), "left").drop(key)
    out_df = df.withColumn(out, fallback(*values, default=default))
    if source_col:
        src = None
        for v, name in zip(values, names):
            cond = F.col(v).isNotNull()
            src = F.when(cond, F.lit(name)) if src is None else src.when(cond, F.lit(name))
        out_df = out_df.withColumn(source_col, src.otherwise(F.lit("NONE")))
    return out_df.drop(*values)


def master_join(sources: dict, key: str, order: dict | None = None) -> DataFrame:
    """One master row per key from several sources (``{name: (df, key_col)}``).

    The key set is the union of all sources' keys; each source is first reduced
    to one row per key -- its newest row by ``order[name]`` when given, else
    any deterministic max -- and its columns are prefixed with the source name.
    """
    from .dedup import latest_per_key

    keys = None
    for name, (df, k) in sources.items():
        ks = df.select(F.col(k).alias(key))
        keys = ks if keys is None else keys.unionByName(ks)
    out = keys.filter(F.col(key).isNotNull()).distinct()
    for name, (df, k) in sources.items():
        renamed = df.withColumnRenamed(k, key)
        cols = [c for c in renamed.columns if c != key]
        by = (order or {}).get(name) or cols[:1]
        one = latest_per_key(renamed, [key], by)
        out = out.join(one.select(key, *[F.col(c).alias(f"{name}_{c}") for c in cols]), key, "left")
    return out
