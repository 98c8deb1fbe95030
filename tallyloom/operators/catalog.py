"""Metadata, audit and lineage jobs as plain table jobs over metadata DataFrames.

Nothing here reads a live catalog: table, column, option, routine and audit
rows arrive as DataFrames (from any source), so every job is an ordinary
Spark plan that grows with its input.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date
from ..functions.text import regex_or_null, size_label

# Scan price per 10^12 billed bytes.
PRICE_PER_TB = 6.25
# Storage state rule (ACTIVE when changed within 90 whole days).
ACTIVE_DAYS = 90

HOST_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)"
HREF_RE = r'href="([^"]*)"'


def extract_links(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Every distinct ``href`` of each page, its host (the page's own host when relative)
    and whether it leaves the page's host.  Distinct inside each row, so no shuffle."""
    links = F.array_distinct(F.regexp_extract_all(F.col(html_col), F.lit(HREF_RE), 1))
    page_host = regex_or_null(url_col, HOST_RE)
    out = pages.select(id_col, page_host.alias("_tl_page_host"), F.explode(links).alias("href"))
    host = F.coalesce(regex_or_null("href", HOST_RE), F.col("_tl_page_host"))
    return out.select(id_col, "href", host.alias("link_host"),
                      (~host.eqNullSafe(F.col("_tl_page_host"))).cast("long").alias("is_external"))


KV_RE = r'"([A-Za-z_][A-Za-z0-9_]*)"\s*:\s*"?([^",}]*)"?'


def parse_key_values(df: DataFrame, text_col: str, pattern: str = KV_RE) -> DataFrame:
    """``key: value`` pairs found by regex in free text, one row per pair (CROSS JOIN UNNEST)."""
    keys = F.regexp_extract_all(F.col(text_col), F.lit(pattern), 1)
    vals = F.regexp_extract_all(F.col(text_col), F.lit(pattern), 2)
    return df.withColumn("_tl_kv", F.explode(F.arrays_zip(keys.alias("key"), vals.alias("value")))) \
        .withColumn("label_key", F.col("_tl_kv.key")).withColumn("label_value", F.col("_tl_kv.value")) \
        .drop("_tl_kv")


def pivot_labels(pairs: DataFrame, keys_cols: Sequence[str], label_names: Sequence[str],
                 prefix: str = "label_") -> DataFrame:
    """One column per named label (the greatest value wins when a key repeats); other labels stay in ``pairs``."""
    return pairs.groupBy(*keys_cols).agg(*[
        F.max(F.when(F.col("label_key") == k, F.col("label_value"))).alias(f"{prefix}{k}") for k in label_names])


def _closure_of(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(start, node, level) by breadth-first rounds until the frontier is empty.

    Each round joins the frontier to the edges, drops (start, node) pairs already
    visited -- which cuts cycles -- and de-duplicates.  A round is written with a
    reliable checkpoint, so a lost executor never recomputes earlier rounds.
    """
    zero = F.lit(0).cast("long")
    frontier = starts.select("start", F.col("start").alias("node"), zero.alias("level")).checkpoint(eager=True)
    reached = frontier
    depth = 0
    while not frontier.isEmpty():
        depth += 1
        frontier = (frontier.join(edges, "node")
                    .select("start", F.col("next").alias("node"), F.lit(depth).cast("long").alias("level")).distinct()
                    .join(reached.select("start", "node"), ["start", "node"], "left_anti").checkpoint(eager=True))
        reached = reached.unionByName(frontier)
    return reached


def lineage_closure(edges: DataFrame, starts: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """All nodes reachable from each start node, with the first level they are reached at.

    The graph is closed once over its inner nodes (those that an edge leads to);
    a start's own edges then join that closure.  So many starts over one small
    graph -- tables over a few layers -- walk it once and not once each.  Only
    reachability is kept, never whole paths; a start does not reach itself.
    """
    # the edge list is read by every round: materialised once (reliable checkpoint)
    e = edges.select(F.col(src).alias("node"), F.col(dst).alias("next")).distinct().checkpoint(eager=True)
    inner = e.select(F.col("next").alias("start")).distinct()
    closed = _closure_of(e.join(inner, e["node"] == inner["start"], "left_semi"), inner)
    first = starts.select("start").distinct().join(e.withColumnRenamed("node", "start"), "start")
    through = first.join(closed.select(F.col("start").alias("next"), "node", "level"), "next")
    return through.filter(~F.col("node").eqNullSafe(F.col("start"))).groupBy("start", "node").agg(
        (F.min("level") + 1).alias("level"))


def table_profile(tables: DataFrame, bytes_col: str, modified_col: str | None = None, as_of=None) -> DataFrame:
    """Size label plus, when a modification time is given, storage and freshness state:
    ACTIVE when changed within 90 whole days; updated = changed less than 24 h before ``as_of``."""
    out = tables.withColumn("size_label", size_label(bytes_col))
    if modified_col is not None:
        now = F.lit(as_date(as_of) if not isinstance(as_of, dt.datetime) else as_of).cast("timestamp")
        hours = F.timestamp_diff("HOUR", F.col(modified_col), now)
        days = F.timestamp_diff("DAY", F.col(modified_col), now)
        out = out.withColumn("storage_status", F.when(days <= ACTIVE_DAYS, "ACTIVE").otherwise("LONG_TERM")) \
            .withColumn("update_status", F.when(hours < 24, "YES").otherwise("NO"))
    return out


def job_cost(jobs: DataFrame, start_col: str, end_col: str, billed_col: str) -> DataFrame:
    """Seconds (rounded to cents of a second, half up) and cost of each job."""
    ms = F.timestamp_diff("MILLISECOND", F.col(start_col), F.col(end_col))
    return jobs.withColumn("seconds", F.floor((ms + 5) / 10) / 100) \
        .withColumn("cost", F.col(billed_col).cast("double") / 1e12 * PRICE_PER_TB)


def daily_delta(counts: DataFrame, keys: Sequence[str], day_col: str, measure: str, initial: int = 0) -> DataFrame:
    """Day-over-day change of a count (``LAG``), and a moved/not-moved flag.

    The window runs over one row per (key, day): counts are already aggregated.
    The first day compares against ``initial``.
    """
    w = Window.partitionBy(*keys).orderBy(day_col)
    prev = F.coalesce(F.lag(measure).over(w), F.lit(initial))
    return counts.withColumn("prev_count", prev.cast("long")) \
        .withColumn("loaded", (F.col(measure) - F.col("prev_count")).cast("long")) \
        .withColumn("moved", F.when(F.abs(F.col("loaded")) > 0, 1).otherwise(0).cast("long"))


def latest_event(log: DataFrame, keys: Sequence[str], order: Sequence[str], fields: dict[str, Column],
                 extra_aggs: dict[str, Column] | None = None) -> DataFrame:
    """Newest log row per key with chosen (possibly nested) fields, as one aggregate;
    ``extra_aggs`` (name -> aggregate, e.g. counts and sums) are computed in the same pass."""
    extra = extra_aggs or {}
    packed = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                      *[c.alias(n) for n, c in fields.items()])
    return log.groupBy(*keys).agg(F.max(packed).alias("_tl_last"), *[a.alias(n) for n, a in extra.items()]).select(
        *keys, *[F.col(f"_tl_last.{n}").alias(n) for n in fields], *extra)


def latest_of_kinds(log: DataFrame, key: Column, kinds: dict[str, dict[str, Column]], order: Sequence[str]) -> DataFrame:
    """Per key the newest event of each kind with that event's own fields, and the best of them.

    ``kinds`` lists, best kind first, each kind's fields: columns of the nested log
    that are NULL in rows of other kinds.  ``order`` names the fields that tell the
    newest (the first one is known in every event of its kind); ties go to the
    greatest remaining fields.  Returns the key, a struct per kind, ``best`` (the
    newest event of the first kind that has one, with its ``kind``), and
    ``n_events``.  All picks are maximums of structs in one aggregate over the log,
    combined map-side, so a resource with most of the events is no one task's work.
    """
    rank, events = list(kinds), []
    for i, (kind, fields) in enumerate(kinds.items()):
        rest = [f for f in fields if f not in order]
        there = fields[order[0]].isNotNull()
        events.append(F.when(there, F.struct(F.lit(-i).alias("_rank"), *[fields[f].alias(f) for f in [*order, *rest]])))
    packed = log.select(key, *[e.alias(f"_tl_{k}") for k, e in zip(rank, events, strict=True)])
    name = packed.columns[0]
    picked = packed.withColumn("_tl_best", F.coalesce(*[F.col(f"_tl_{k}") for k in rank]))
    return picked.groupBy(name).agg(
        *[F.max(f"_tl_{k}").alias(k) for k in rank], F.max("_tl_best").alias("_tl_best"), F.count("_tl_best").alias("n_events")).select(
        name, *rank, F.struct(F.when(F.col("_tl_best").isNotNull(), F.element_at(
            F.array(*map(F.lit, rank)), 1 - F.col("_tl_best._rank"))).alias("kind"),
                              *[F.col(f"_tl_best.{f}").alias(f) for f in next(iter(kinds.values()))]).alias("best"), "n_events")


# A table name in routine text: parts joined by dots, each bare or in back quotes, or the whole name
# in quotes.  Comments are taken out first, so that neither statements nor names in them count.
_COMMENT = r"(?s)--[^\n]*|/\*.*?\*/"
_PART = r"(?:`[^`]+`|[\w$-]+)"
_NAME = rf"({_PART}(?:\s*\.\s*{_PART})*)"
# Ways to write a table, the one that counts first when a routine has several.
_WRITES = (rf"(?i)\bCREATE\s+(?:OR\s+REPLACE\s+)?TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?{_NAME}",
           rf"(?i)\bMERGE\s+(?:INTO\s+)?{_NAME}",
           rf"(?i)\bINSERT\s+(?:INTO\s+)?{_NAME}")
_READS = rf"(?i)\b(?:FROM|JOIN)\s+{_NAME}"


def _without_comments(ddl: str) -> Column:
    return F.regexp_replace(F.col(ddl), _COMMENT, " ")


def _name_parts(name: Column) -> Column:
    """The parts of a name, quotes and blanks dropped; a name quoted as a whole has its dots inside."""
    return F.split(F.regexp_replace(name, r"[`\s]", ""), r"\.")


def _dataset_and_table(parts: Column) -> tuple[Column, Column]:
    """The last two parts, so ``project.dataset.table`` and ``dataset.table`` are the same; NULL for one part."""
    long_enough = F.size(parts) >= 2
    return (F.when(long_enough, F.get(parts, F.size(parts) - 2)), F.when(long_enough, F.get(parts, F.size(parts) - 1)))


def extract_write_target(routines: DataFrame, name_col: str = "name", ddl_col: str = "ddl") -> DataFrame:
    """(name, target, dataset, table) a routine writes: CREATE TABLE, else MERGE, else INSERT; comments do not count."""
    text = _without_comments(ddl_col)
    found = F.coalesce(*[regex_or_null(text, pattern) for pattern in _WRITES])
    dataset, table = _dataset_and_table(F.col("_tl_parts"))
    return routines.select(name_col, _name_parts(found).alias("_tl_parts")).select(
        name_col, F.concat_ws(".", "_tl_parts").alias("_tl_full"), "_tl_parts",
        dataset.alias("dataset"), table.alias("table")).select(
        name_col, F.when(F.col("_tl_parts").isNotNull(), F.col("_tl_full")).alias("target"), "dataset", "table")


def extract_read_tables(routines: DataFrame, datasets: DataFrame, name_col: str = "name", ddl_col: str = "ddl",
                        dataset_col: str = "dataset") -> DataFrame:
    """Distinct (name, dataset, table) named after FROM or JOIN in each routine's whole text.

    Names are reduced to dataset and table before they are compared, and only
    those of a known dataset stay (a semi join): columns, aliases, CTEs and
    temporary tables have none.
    """
    names = F.explode(F.regexp_extract_all(_without_comments(ddl_col), F.lit(_READS), 1))
    dataset, table = _dataset_and_table(F.col("_tl_parts"))
    found = routines.select(name_col, names.alias("_tl_name")).select(name_col, _name_parts(F.col("_tl_name")).alias("_tl_parts"))
    found = found.select(name_col, dataset.alias("dataset"), table.alias("table")).filter("dataset is not null").distinct()
    known = datasets.select(F.col(dataset_col).alias("dataset")).distinct()
    return found.join(known, "dataset", "left_semi").select(name_col, "dataset", "table")


def extract_edges(routines: DataFrame, datasets: DataFrame, name_col: str = "name", ddl_col: str = "ddl",
                  dataset_col: str = "dataset") -> tuple[DataFrame, DataFrame]:
    """(targets (name, src), edges (src, dst)): what each routine writes, and what it reads for it.

    The same names as ``extract_write_target`` and ``extract_read_tables`` give,
    joined by a dot, from one pass over the text: comments are taken out once, and
    nothing is joined by routine.
    """
    full = lambda x: F.concat_ws(".", *_dataset_and_table(x))
    text = routines.select(name_col, _without_comments(ddl_col).alias("_tl_text"))
    written = F.coalesce(*[regex_or_null("_tl_text", pattern) for pattern in _WRITES])
    named = text.select(name_col, _name_parts(written).alias("_tl_parts"),
                        F.regexp_extract_all("_tl_text", F.lit(_READS), F.lit(1)).alias("_tl_reads"))
    named = named.filter(F.size("_tl_parts") >= 2).select(name_col, full(F.col("_tl_parts")).alias("src"), "_tl_reads")
    reads = named.select("src", F.explode(F.array_distinct("_tl_reads")).alias("_tl_name")).select(
        "src", _name_parts(F.col("_tl_name")).alias("_tl_parts"))
    reads = reads.select("src", _dataset_and_table(F.col("_tl_parts"))[0].alias("dataset"), full(F.col("_tl_parts")).alias("dst"))
    known = datasets.select(F.col(dataset_col).alias("dataset")).distinct()
    return named.select(name_col, "src"), reads.join(known, "dataset", "left_semi").select("src", "dst").distinct()


# One label of an option text: two quoted values in a STRUCT.
_LABEL = r'STRUCT\(\s*"([^"]+)"\s*,\s*"([^"]*)"\s*\)'


def capitalise(col: Column) -> Column:
    """First letter of every word in upper case, the rest in lower; any mark but an apostrophe ends a word."""
    words = F.split(F.lower(col), r"(?<=[^\p{L}\p{N}'])")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), "")


def parse_option_labels(tables: DataFrame, options: DataFrame, labels: Sequence[str],
                        keys: Sequence[str] = ("dataset", "table")) -> DataFrame:
    """Labels parsed out of option text and pivoted, plus the description option.

    Both the labels and the description are joined to the table list, so a
    table with a description but no labels keeps its description.
    """
    keys = list(keys)
    value = F.col("value")
    pairs = options.filter(F.col("option") == "labels").select(*keys, F.explode(F.arrays_zip(
        F.regexp_extract_all(value, F.lit(_LABEL), 1).alias("k"), F.regexp_extract_all(value, F.lit(_LABEL), 2).alias("v")))
        .alias("_tl_p")).select(*keys, F.lower("_tl_p.k").alias("label_key"), capitalise(F.col("_tl_p.v")).alias("label_value"))
    pivot = pairs.groupBy(*keys).agg(*[
        F.max(F.when(F.col("label_key") == k.lower(), F.col("label_value"))).alias(k) for k in labels])
    desc = options.filter(F.col("option") == "description").groupBy(*keys).agg(F.max("value").alias("description"))
    return tables.select(*keys).distinct().join(pivot, keys, "left").join(desc, keys, "left")


def partition_cluster_profile(columns: DataFrame, keys: Sequence[str] = ("dataset", "table"),
                              max_cluster: int = 4) -> DataFrame:
    """Per table: column count, partitioning column and cluster columns 1..``max_cluster`` (static pivot).

    A table has four cluster columns at most, so the default shows them all.
    """
    keys = list(keys)
    part = F.col("is_partition") == "YES"
    return columns.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.count_if(part).alias("n_partition_columns"),
        F.max(F.when(part, F.col("column"))).alias("partition_column"),
        *[F.max(F.when(F.col("cluster_position") == i, F.col("column"))).alias(f"cluster_{i}")
          for i in range(1, max_cluster + 1)],
    )


def data_dictionary(columns: DataFrame, descriptions: DataFrame,
                    keys: Sequence[str] = ("dataset", "table", "column")) -> DataFrame:
    """Column list with hand-kept descriptions (composite-key left join) and a printable key."""
    keys = list(keys)
    desc = descriptions.groupBy(*keys).agg(F.max("description").alias("description"))
    sk = F.sha2(F.concat_ws("|", *[F.col(k) for k in keys]), 256)
    return columns.join(desc, keys, "left").withColumn("sk_column", sk)


def lineage_detail(closure: DataFrame, freshness: DataFrame, raw_prefix: str = "RAW.",
                   node_col: str = "node", name_col: str = "table", modified_col: str = "modified") -> DataFrame:
    """One row per start node and raw ancestor, with the ancestor's last change.

    The list of all ancestors belongs to the table, see ``table_monitor``.
    """
    raw = closure.filter(F.col(node_col).startswith(raw_prefix))
    fresh = freshness.select(F.col(name_col).alias(node_col), F.col(modified_col).alias("source_modified"))
    return raw.join(fresh, node_col, "left")


def column_profile(columns: DataFrame, keys: Sequence[str] = ("dataset", "table")) -> DataFrame:
    """Columns in order of position with their table's number of columns and place among them.

    The count is an aggregate joined back: a window would need a table's rows in one task.
    """
    keys = list(keys)
    n = columns.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_columns"), F.max("position").alias("last_position"))
    return columns.join(n, keys).withColumn("is_last", (F.col("position") == F.col("last_position")).cast("long"))


def table_monitor(tables: DataFrame, detail: DataFrame, creators: DataFrame | None = None,
                  key: str = "start") -> DataFrame:
    """One row per table: its raw sources as ordered text, the oldest source change
    (a NULL date counts as oldest, as in an ordered array aggregate), and its creator."""
    oldest = detail.groupBy(key).agg(
        F.min(F.struct(F.col("source_modified").isNotNull().alias("known"), F.col("source_modified").alias("d"),
                       F.col("node").alias("n"))).alias("_tl_old"),
        F.array_join(F.sort_array(F.collect_set("node")), ", ").alias("sources"))
    out = tables.join(oldest.select(key, "sources", F.col("_tl_old.d").alias("oldest_source_change"),
                                    F.col("_tl_old.n").alias("oldest_source")), key, "left")
    if creators is not None:
        out = out.join(creators, key, "left")
    return out
