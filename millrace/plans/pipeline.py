"""The incremental ingest plan and the reclassification plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import schema
from millrace.functions import dates, money, text
from millrace.lexicon import Lexicon
from millrace.operators import gates, store
from millrace.operators.classify import classify
from millrace.sources.readers import SourceConfig


@dataclass
class Result:
    """All outputs of a run; nothing has run yet."""

    store: DataFrame
    export: DataFrame
    review: DataFrame
    out_of_scope: DataFrame
    seen_old: DataFrame
    counters: DataFrame


def verdicts(df: DataFrame, lexicon: Lexicon, title: str, skills: str, description: str, where: Column | None = None) -> DataFrame:
    """df with the verdict's fields as columns; null for rows that are not to be classified."""
    v = classify(F.expr(title), F.expr(skills), F.expr(description), lexicon)
    v = v if where is None else F.when(where, v)
    return df.withColumn("_v", v).select(*[c for c in df.columns if c not in schema.VERDICT.names], "_v.*")


def mapped(df: DataFrame, columns: dict[str, tuple[str, ...]], default: str = "") -> DataFrame:
    """A row of texts from a payload: each column takes the first of its expressions that is neither
    null nor blank, else the default."""
    value = lambda e: F.nullif(F.trim(F.expr(e).cast("string")), F.lit(""))
    return df.select(*[F.coalesce(*map(value, tried), F.lit(default)).alias(name) for name, tried in columns.items()])


def run(
    new: DataFrame, known: DataFrame, archived: DataFrame, old_ids: DataFrame, lexicon: Lexicon, source: SourceConfig, as_of: str, since: str | None = None,
    limit: int | None = None, same_role: bool = False, work: str | None = None,
) -> Result:
    """One run of one source.

    new: landed rows with job_id, seq and the source's columns. known: the store. archived: rows
    out of scope before. old_ids: ids that were too old before. Rows are marked once with the gate
    that stops them, and only those that earlier gates let pass are classified; each output is a
    filter of that. work is a folder to which the marked rows are written, so that the outputs don't
    each mark them again. limit takes the first rows of what is kept, before rows of the same role
    are reduced to one (same_role).
    """
    day = F.lit(as_of).cast("date")
    newest = known.where(F.col("source") == source.name).agg(F.max(dates.to_date(F.col("posted_date"))).alias("newest"))
    rows = store.keep_first(new, ("job_id",), [F.col("seq")]).withColumn("source", F.lit(source.name))
    for name, expression in source.extra.items():
        rows = rows.withColumn(name, F.expr(expression))
    rows = store.marked(rows, known, "_known")
    rows = store.marked(rows, archived, "_archived")
    rows = store.marked(rows, old_ids, "_old")
    rows = rows.crossJoin(F.broadcast(newest))  # one row
    posted = dates.to_date(F.expr(source.posted))
    cut = dates.cutoff(F.col("newest"), day, source.grace_days, source.window_days, since, source.rolling_days)
    fresh = (gates.recent_or_unknown if source.unknown_dates == "keep" else gates.recent)(posted, cut)
    rows = rows.withColumn("_fresh", fresh & ~F.col("_old"))
    company = F.col("company_name") if "company_name" in rows.columns else F.lit("")
    stops = {
        "blocked": gates.listed(company, source.blocked_companies) if source.blocked_companies else F.lit(False),
        "known": F.col("_known"), "out_of_scope_known": F.col("_archived"), "excluded_old": ~F.col("_fresh"), "out_of_scope": ~F.coalesce(F.col("in_scope"), F.lit(False)),
    }
    order = [("blocked", stops["blocked"]), *[(g, stops[g]) for g in source.gates]]
    before = order[: [g for g, _ in order].index("out_of_scope")] if "out_of_scope" in source.gates else order
    rows = verdicts(rows, lexicon, source.title, source.skills, source.description, gates.disposition(before) == "kept")
    rows = rows.withColumn("disposition", gates.disposition(order))
    rows = rows.withColumn("jd_too_short", gates.too_short(F.expr(source.description), source.short_description).cast("string"))
    if work:
        rows.write.mode("overwrite").parquet(work)
        rows = rows.sparkSession.read.schema(rows.schema).parquet(work)
    kept = rows.where("disposition = 'kept'").withColumn("scraped_at", F.lit(f"{as_of}T00:00:00Z"))
    kept = store.first_rows(kept, limit)
    kept = store.dedupe_same_role(kept) if same_role else kept
    merged = store.append_new(known, kept.select(*[F.col(c).cast("string").alias(c) if c != "seq" else F.col(c) for c in kept.columns if not c.startswith("_") and c not in ("newest", "disposition")]))
    return Result(
        store=merged,
        export=export(merged),
        review=kept.where("needs_review or jd_too_short = 'true'").select("source", "job_id", F.expr(source.title).alias("title"), "needs_review", "jd_too_short"),
        out_of_scope=rows.where("disposition = 'out_of_scope'").select("source", "job_id", "seq", F.expr(source.title).alias("title"), "vetoed_by"),
        seen_old=rows.where("disposition = 'excluded_old'").select("source", "job_id", F.expr(source.posted).alias("posted_date")),
        counters=rows.groupBy("source", "disposition").agg(F.count(F.lit(1)).alias("n")),
    )


def export(rows: DataFrame) -> DataFrame:
    """Store rows as export rows: source and the 23 columns, blanks filled by defaults, the salary
    block whole or not at all."""
    have = set(rows.columns)
    col = lambda n, default="": F.coalesce(F.nullif(F.trim(F.col(n)), F.lit("")), F.lit(default)) if n in have else F.lit(default)
    computed = {"job_type": col("job_type", "full_time"), "posted_at": col("posted_at") if "posted_at" in have else col("posted_date"), "qualification": F.when(col("qualification") == "", text.qualifications(col("description"))).otherwise(col("qualification"))}
    block = money.export_block(F.nullif(col("min_salary"), F.lit("")), F.nullif(col("max_salary"), F.lit("")), col("salary_currency"), col("salary_period"))
    named = dict(zip(("min_salary", "max_salary", "salary_period", "salary_currency"), block, strict=True))
    return rows.select(col("source").alias("source"), *[(named.get(c, computed.get(c, col(c)))).alias(c) for c in schema.EXPORT_COLUMNS])


def reclassify(rows: DataFrame, lexicon: Lexicon, title: str = "title", skills: str = "skills", description: str = "description") -> tuple[DataFrame, DataFrame]:
    """All store rows classified anew: what is kept, what goes to the archive."""
    out = verdicts(rows.fillna(""), lexicon, title, skills, description)
    return out.where("in_scope"), out.where("not in_scope")


def summary(counters: DataFrame, as_of: str) -> DataFrame:
    """One JSON text of a run's counters: the day, and the rows of each disposition by source."""
    per = counters.groupBy("source").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("disposition", "n")))).alias("counts"))  # a few names a source
    return per.select(F.to_json(F.struct(F.lit(as_of).alias("as_of"), "source", "counts")).alias("value"))
