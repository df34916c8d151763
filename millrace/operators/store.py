"""Keyed stores: joins against what is known, merges, upserts and their side tables.

Ties are broken by an explicit order column; input order means nothing in Spark.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("source", "job_id")


def keep_first(df: DataFrame, key: tuple[str, ...], order: list[Column]) -> DataFrame:
    """One row per key, the first by order; an aggregate, so a frequent key is reduced in each task
    before the shuffle. Null keys are a group like any other."""
    payload = F.struct(*[F.col(c) for c in df.columns])
    names = [f"_o{i}" for i in range(len(order))]
    ranked = df.select(*[F.col(k) for k in key], payload.alias("_row"), *[o.alias(n) for o, n in zip(order, names, strict=True)])
    return ranked.groupBy(*key).agg(F.min_by("_row", F.struct(*names)).alias("_row")).select("_row.*")


def keep_last(df: DataFrame, key: tuple[str, ...], seq: str) -> DataFrame:
    """One row per key, the last by seq; a null seq is before all others, and of equal ones the row that
    sorts last counts."""
    payload = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*key).agg(F.max_by(payload, F.struct(F.col(seq).isNotNull(), F.col(seq))).alias("_row")).select("_row.*")


def best_of_group(df: DataFrame, key: list[Column], prefer: list[Column]) -> DataFrame:
    """One row per group by a preference given as sort expressions (desc() allowed)."""
    w = Window.partitionBy(*key).orderBy(*prefer)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def dedupe_same_role(df: DataFrame) -> DataFrame:
    """Of rows with the same normalised title, company and city: the longest description, then the
    newest, then the first seen."""
    from millrace.functions.text import norm_key

    key = [norm_key(F.col(c)) for c in ("title", "company", "city")]
    return best_of_group(df, key, [F.length(F.coalesce("description", F.lit(""))).desc(), F.col("created_ms").desc_nulls_last(), F.col("seq")])


def unknown(new: DataFrame, *known: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """New rows whose key no known table holds: left anti joins on the key columns only."""
    for k in known:
        new = new.join(k.select(*key).distinct(), list(key), "left_anti")
    return new


def marked(new: DataFrame, known: DataFrame, flag: str, key: tuple[str, ...] = KEY) -> DataFrame:
    """All new rows, with whether their key is known."""
    ids = known.select(*key).distinct().withColumn(flag, F.lit(True))
    return new.join(ids, list(key), "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def append_new(store: DataFrame, new: DataFrame, seq: str = "seq", key: tuple[str, ...] = KEY) -> DataFrame:
    """Store rows stay as they are; of new rows the first of each unknown key is appended. Columns
    that one side lacks are filled with ""."""
    fresh = unknown(keep_first(new, key, [F.col(seq)]), store, key=key)
    out = store.unionByName(fresh.drop(*[c for c in (seq,) if c not in store.columns]), allowMissingColumns=True)
    return out.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in out.dtypes])


def archive(old: DataFrame, dropped: DataFrame, seq: str = "seq", key: tuple[str, ...] = KEY) -> DataFrame:
    """Union of an archive and newly dropped rows, columns of either vintage kept; the last by seq of
    each key stays, rows of the archive come before new ones."""
    both = old.withColumn("_new", F.lit(0)).unionByName(dropped.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    order = F.struct("_new", F.col(seq).isNotNull(), F.col(seq)) if seq in both.columns else F.struct("_new")
    return keep_last(both.withColumn("_order", order), key, "_order").drop("_new", "_order")


def review_log(log: DataFrame, entries: DataFrame, keep: str = "first", seq: str = "seq", key: tuple[str, ...] = KEY) -> DataFrame:
    """A review log after a run: "first" or "last" of each key over log and entries, "new" appends
    entries of unknown keys only, "replace" is the entries alone."""
    if keep == "replace":
        return entries
    if keep == "new":
        return log.unionByName(unknown(entries, log, key=key), allowMissingColumns=True)
    if keep == "last":
        return archive(log, entries, seq, key)
    if keep != "first":
        raise ValueError("keep is first, last, new or replace")
    both = log.withColumn("_new", F.lit(0)).unionByName(entries.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return keep_first(both, key, [F.col("_new"), F.col(seq).isNull(), F.col(seq)] if seq in both.columns else [F.col("_new")]).drop("_new")


def upsert(master: DataFrame, fetched: DataFrame, key: str, version: str) -> DataFrame:
    """Full outer merge with a status: new, updated (another version), unchanged or kept (not
    fetched). Updated and new rows carry the fetched values."""
    m, f = master.alias("m"), fetched.alias("f")
    j = m.join(f, F.col(f"m.{key}") == F.col(f"f.{key}"), "full_outer")
    status = (
        F.when(F.col(f"m.{key}").isNull(), "new").when(F.col(f"f.{key}").isNull(), "kept")
        .when(~F.col(f"m.{version}").eqNullSafe(F.col(f"f.{version}")), "updated").otherwise("unchanged")
    )
    cols = [F.when(status.isin("new", "updated"), F.col(f"f.{c}")).otherwise(F.col(f"m.{c}")).alias(c) for c in master.columns]
    return j.select(*cols, status.alias("status"))


def day_merge(before: DataFrame, after: DataFrame, key: tuple[str, ...] = ("application_url", "title")) -> DataFrame:
    """A day's export: of equal keys the later run's row stays."""
    both = before.withColumn("_run", F.lit(0)).unionByName(after.withColumn("_run", F.lit(1)))
    return keep_last(both, key, "_run").drop("_run")


def overlay(store: DataFrame, detail: DataFrame, column: str, key: tuple[str, ...] = KEY) -> DataFrame:
    """Updates one column where the detail table has a value that isn't blank; see overlay_row()."""
    return overlay_row(store, detail.select(*key, column), key)


def overlay_row(store: DataFrame, detail: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """Detail wins: each column that both tables have takes the detail's value where that isn't blank.
    Of several details of a key the largest value of a column counts, so none multiplies rows."""
    shared = [c for c in store.columns if c in detail.columns and c not in key]
    value = lambda c: F.when(F.trim(F.col(c).cast("string")) != "", F.col(c))
    d = detail.groupBy(*key).agg(*[F.max(value(c)).alias(f"_new_{c}") for c in shared])
    out = store.join(d, list(key), "left")
    return out.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in shared else F.col(c) for c in store.columns])


def newest_first(df: DataFrame, days: tuple[str, ...], *then: str) -> DataFrame:
    """Sorted by the first of the days that isn't blank, newest first, blank last; then by other columns, falling."""
    day = F.coalesce(*[F.nullif(F.trim(d), F.lit("")) for d in days])
    return df.orderBy(day.desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in then])


def first_rows(df: DataFrame, n: int | None, seq: str = "seq") -> DataFrame:
    """The first n rows by seq (all without n): a run's limit on new rows, taken before same-role dedup."""
    return df if n is None else df.orderBy(F.col(seq).asc_nulls_last()).limit(n)


def veto_histogram(dropped: DataFrame) -> DataFrame:
    """How often each veto phrase, whatever its case, stopped a row."""
    return dropped.where("vetoed_by <> ''").groupBy(F.lower("vetoed_by").alias("vetoed_by")).agg(F.count(F.lit(1)).alias("n"))


def facet_check(counts: DataFrame, total: DataFrame, n: str = "n") -> DataFrame:
    """One row: what the facets cover of a total, and whether that is all. total: one row."""
    covered = counts.agg(F.coalesce(F.sum(n), F.lit(0)).alias("covered"))
    both = covered.crossJoin(F.broadcast(total.select(F.col(n).alias("total")).limit(1)))  # one row each
    return both.withColumn("missing", F.col("total") - F.col("covered")).withColumn("complete", F.col("missing") == 0)


def slices(parts: list[tuple[DataFrame, int, *tuple[str, ...]]], cap: int, key: str = "job_id", seq: str = "seq") -> tuple[DataFrame, bool]:
    """Rows of slices of a source that shows `cap` rows of a slice at most, one per key, and whether they
    are complete: every slice that reached the cap was itself cut into further slices (a row count
    below the cap). parts: (rows, depth), a deeper slice refines those before it; (rows, depth, column, ...)
    are as many slices as the columns have values."""
    rows = parts[0][0].withColumn("_depth", F.lit(parts[0][1])).withColumn("_slice", F.lit(0))
    for i, (df, depth, *_) in enumerate(parts[1:], 1):
        rows = rows.unionByName(df.withColumn("_depth", F.lit(depth)).withColumn("_slice", F.lit(i)), allowMissingColumns=True)
    deepest = max(p[1] for p in parts)
    sizes = [df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).select("n") for df, depth, *by in parts if depth == deepest]
    complete = reduce(DataFrame.union, sizes).where(F.col("n") >= cap).isEmpty()
    return keep_first(rows, (key,), [F.col("_depth"), F.col("_slice"), F.col(seq)]).drop("_depth", "_slice"), complete


def touch(store: DataFrame, listing: DataFrame, today: str, key: tuple[str, ...] = KEY) -> DataFrame:
    """last_seen is today for rows whose key is in the listing."""
    return marked(store, listing, "_live", key).withColumn("last_seen", F.when(F.col("_live"), F.lit(today)).otherwise(F.col("last_seen"))).select(*store.columns)


def union_with_provenance(feeds: DataFrame, key: str = "job_id", seq: str = "seq", label: str = "feed") -> DataFrame:
    """One row per key: the first by seq, with the labels of all feeds that hold it, in order."""
    row = F.struct(*[F.col(c) for c in feeds.columns if c not in (seq, label)])
    labels = F.transform(F.array_sort(F.collect_set(F.struct(seq, label))), lambda x: x[label])
    out = feeds.groupBy(key).agg(F.min_by(row, F.struct(F.col(seq).isNull(), F.col(seq))).alias("_row"), F.array_distinct(labels).alias("feeds"))
    return out.select("_row.*", F.array_join("feeds", "; ").alias("feeds"))


def first_known(df: DataFrame, key: Column, seq: str, columns: tuple[str, ...]) -> DataFrame:
    """One row per key, the first by seq; the named columns take their first value in that order
    that isn't blank, so later rows fill gaps and change nothing. One aggregate, no window."""
    row = F.struct(*[F.col(c) for c in df.columns if c not in columns])
    order = F.struct(F.col(seq).isNull(), F.col(seq))
    filled = [F.min_by(F.when(F.trim(c) != "", F.col(c)), F.when(F.trim(c) != "", order)).alias(c) for c in columns]
    out = df.groupBy(key.alias("_key")).agg(F.min_by(row, order).alias("_row"), *filled)
    return out.select("_row.*", *columns).select(*df.columns)


def resolved(wanted: DataFrame, live: DataFrame, name: str = "name") -> DataFrame:
    """Configured names against live ones on their normalised key: all wanted rows, with the live
    columns or nulls where a name is missing. Of live rows with one key the largest id counts."""
    from millrace.functions.text import norm_facet

    keyed = live.where(norm_facet(F.col(name)) != "").select(norm_facet(F.col(name)).alias("_key"), *[c for c in live.columns if c != name])
    one = keyed.groupBy("_key").agg(*[F.max_by(c, "id").alias(c) for c in keyed.columns if c != "_key"])
    return wanted.withColumn("_key", norm_facet(F.col(name))).join(one, "_key", "left").drop("_key")
