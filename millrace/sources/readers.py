"""Readers of landed payloads, and writers of the store's files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.text import clean_text

CARD = (
    "jobId string, title string, companyName string, tagsAndSkills string, jobDescription string, createdDate long, jdURL string,"
    " jobType string, placeholders array<struct<type:string,label:string>>"
)
POSTING = "title string, externalPath string, locationsText string, postedOn string, bulletFields array<string>"


@dataclass(frozen=True)
class SourceConfig:
    """What differs between sources; one pipeline serves all."""

    name: str
    title: str = "title"
    skills: str = "''"
    description: str = "description"
    posted: str = "posted_date"
    window_days: int | None = 7
    rolling_days: int | None = None  # a window that ignores the store
    grace_days: int = 2
    unknown_dates: str = "keep"  # or drop
    gates: tuple[str, ...] = ("known", "out_of_scope_known", "excluded_old", "out_of_scope")
    blocked_companies: tuple[str, ...] = ()
    short_description: int = 200
    extra: dict[str, str] = field(default_factory=dict)  # column: expression


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def csv_store(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A store of strings; a missing path is an empty store. Quoted line ends and "" are read."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).options(header=True, multiLine=True, escape='"', mode="PERMISSIVE").csv(path).fillna("")


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, a byte-order mark before the first name is dropped."""
    df = spark.read.options(header=True, multiLine=True, escape='"', inferSchema=False, maxCharsPerColumn=10_000_000).csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def ids(df: DataFrame, column: str = "job_id") -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull() & (F.col(column) != "")).distinct()


def captures(spark: SparkSession, path: str, item: str = CARD, envelope: str = "jobDetails") -> DataFrame:
    """Cards of JSON files in three shapes: a list, an envelope, a list of envelopes; bad files give no row."""
    raw = spark.read.text(path, wholetext=True)
    as_list = F.from_json("value", f"array<struct<{envelope}:array<struct<{_ddl(item)}>>,{_ddl(item)}>>")
    as_one = F.array(F.from_json("value", f"struct<{envelope}:array<struct<{_ddl(item)}>>,{_ddl(item)}>"))
    rows = raw.select(F.explode(F.when(F.ltrim("value").startswith("["), as_list).otherwise(as_one)).alias("e"), F.col("_metadata.file_path").alias("file"))
    names = [c.split()[0] for c in _split(item)]
    inner = F.struct(*[F.col(f"e.{n}").alias(n) for n in names])
    cards = rows.where("e is not null").select("file", F.posexplode(F.when(F.col(f"e.{envelope}").isNotNull(), F.col(f"e.{envelope}")).otherwise(F.array(inner))).alias("seq", "c"))
    return cards.where(f"c.{names[0]} is not null").select("file", "seq", "c.*")


def _split(ddl: str) -> list[str]:
    out, depth = [""], 0
    for ch in ddl:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append("")
        else:
            out[-1] += ch
    return [x.strip() for x in out]


def _ddl(ddl: str) -> str:
    return ",".join(":".join(x.split(None, 1)) for x in _split(ddl))


def newest_file(spark: SparkSession, path: str, pattern: str = r"(\d{2})-(\d{2})-(\d{4})") -> DataFrame:
    """The path of the file whose name holds the latest DD-MM-YYYY, by date."""
    files = spark.read.format("binaryFile").load(path).select("path")
    p = [F.regexp_extract(F.substring_index("path", "/", -1), pattern, i) for i in (1, 2, 3)]
    day = F.try_to_timestamp(F.concat_ws("-", p[2], p[1], p[0]), F.lit("yyyy-MM-dd"))
    return files.withColumn("day", day).agg(F.max_by("path", "day").alias("path"))


def rss(spark: SparkSession, path: str) -> DataFrame:
    """Items of RSS files; a malformed file gives none."""
    schema = "title string, link string, author string, pubDate string, description string, category array<string>, guid string"
    return spark.read.format("xml").options(rowTag="item", mode="DROPMALFORMED").schema(schema).load(path)


def sitemap(raw: DataFrame, text: str = "value", pattern: str = r"(\d+)/?$") -> DataFrame:
    """(job_id, url) of sitemap texts; of equal ids the last URL. Sort by the id as a number where an order is wanted."""
    locs = raw.select(F.posexplode(F.regexp_extract_all(F.col(text), F.lit(r"<loc>\s*([^<]+?)\s*</loc>"), F.lit(1))).alias("pos", "url"))
    locs = locs.withColumn("job_id", F.regexp_extract("url", pattern, 1)).where("job_id <> ''")
    return locs.groupBy("job_id").agg(F.max_by("url", "pos").alias("url"))


def cards(html: Column, marker: str, fields: dict[str, str]) -> Column:
    """array<struct> of the cards of a page: its parts behind each marker, a pattern for each field."""
    parts = F.slice(F.split(F.coalesce(html, F.lit("")), marker), 2, 1_000_000)
    return F.transform(parts, lambda p: F.struct(*[F.regexp_extract(p, pattern, 1).alias(n) for n, pattern in fields.items()]))


def anchors(html: Column) -> Column:
    """array<struct<href, label>> of a page's links, unescaped and without tags."""
    pattern = r"(?is)<a\b[^>]*href=\"([^\"]*)\"[^>]*>(.*?)</a>"
    both = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("label"))
    return F.transform(both, lambda a: F.struct(clean_text(a["href"]).alias("href"), clean_text(F.regexp_replace(a["label"], r"<[^>]*>", " ")).alias("label")))


def absolute_links(html: Column, base: Column) -> Column:
    """anchors() with absolute targets; empty ones, fragments, scripts and mail addresses go."""
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)

    def whole(u: Column) -> Column:
        return (
            F.when(u.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), u).when(u.startswith("//"), F.concat(F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), u))
            .when(u.startswith("/"), F.concat(origin, u)).otherwise(F.concat(F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/"))), u))
        )

    real = F.filter(anchors(html), lambda a: (a["href"] != "") & ~a["href"].rlike("^(?:#|javascript:|mailto:)"))
    return F.transform(real, lambda a: F.struct(whole(a["href"]).alias("href"), a["label"].alias("label")))


def enrich(listing: DataFrame, detail: DataFrame, key: tuple[str, ...] = ("source", "job_id")) -> DataFrame:
    """Listing with its details; rows without one are marked detail_failed."""
    found = detail.withColumn("_found", F.lit(True))
    return listing.join(found, list(key), "left").withColumn("detail_failed", F.col("_found").isNull()).drop("_found")


def write_export(df: DataFrame, path: str, run_date: str) -> None:
    """The export as quoted CSV, partitioned by run date and source; a run replaces only its own."""
    out = df.withColumn("run_date", F.lit(run_date))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date", "source").options(header=True, quoteAll=True, escape='"').csv(path)


def write_store(df: DataFrame, path: str) -> None:
    """The store, partitioned by source; only the sources of df are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(path)


def card_files(spark: SparkSession, json_path: str, html_path: str, marker: str, fields: dict[str, str], names: dict[str, str]) -> DataFrame:
    """Cards of JSON captures and of saved pages in one table (file, seq, names): names gives for each
    output column the capture's column; fields gives each output column's pattern in a page's card."""
    a = captures(spark, json_path).select("file", "seq", *[F.col(c).cast("string").alias(n) for n, c in names.items()])
    pages = spark.read.text(html_path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), cards(F.col("value"), marker, fields).alias("c"))
    b = pages.select("file", F.posexplode("c").alias("seq", "c")).select("file", "seq", *[F.col(f"c.{n}").alias(n) for n in names])
    return a.unionByName(b)


def paged(pages: DataFrame, items: str, total: str, offset: str = "offset", key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Items of landed pages of a listing, one per key, the first by (offset, place); and one row (seen,
    total, complete). A total is read where a page states one above 0, since later pages may say 0."""
    rows = pages.select(F.col(offset).alias("_offset"), F.posexplode(items).alias("_place", "_item")).select("_offset", "_place", "_item.*")
    order = F.struct("_offset", "_place")
    kept = [c for c in rows.columns if c not in ("_offset", "_place")]
    one = rows.groupBy(key).agg(F.min_by(F.struct(*kept), order).alias("_row")).select("_row.*")
    stated = pages.agg(F.max(F.when(F.col(total) > 0, F.col(total))).alias("total"))
    seen = one.agg(F.count(F.lit(1)).alias("seen")).crossJoin(F.broadcast(stated))  # one row each
    return one, seen.withColumn("complete", F.coalesce(F.col("seen") >= F.col("total"), F.lit(False)))


def posts(df: DataFrame, categories: list[int] | None = None, after: Column | None = None, categories_col: str = "categories", date_col: str = "date") -> DataFrame:
    """Landed posts that carry one of the categories and are younger than `after`; both reach the scan."""
    if categories is not None:
        df = df.where(F.arrays_overlap(categories_col, F.array(*map(F.lit, categories))))
    return df if after is None else df.where(F.col(date_col) > after)


def fair_order(df: DataFrame, group: str, seq: str, turn: str = "turn") -> DataFrame:
    """Rows with the turn in which groups that take turns would give them, from 0: order by (turn,
    group) before a limit."""
    return df.withColumn(turn, F.row_number().over(Window.partitionBy(group).orderBy(seq)) - 1)


def landing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stream of the JSON files that a receiver lands in a folder; broken lines give no row."""
    return spark.readStream.schema(schema).option("mode", "DROPMALFORMED").json(path)


def _paths(spark: SparkSession, *paths: str):
    made = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return made[0].getFileSystem(spark._jsc.hadoopConfiguration()), made


def replace_table(df: DataFrame, path: str) -> None:
    """Writes beside path and then takes its place by renaming, so a reader never sees half a table and
    df may read path itself. A run that dies leaves path, or path.old, whole."""
    new, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old"
    df.write.parquet(new)
    fs, (here, fresh, before) = _paths(df.sparkSession, path, new, old)
    if fs.exists(here):
        fs.delete(before, True)
        fs.rename(here, before)
    if not fs.rename(fresh, here):
        raise OSError(f"could not rename {new} to {path}")
    fs.delete(before, True)


@contextmanager
def single_writer(spark: SparkSession, path: str) -> Iterator[None]:
    """Holds a lock file while its block runs; fails where another run holds it."""
    fs, (lock,) = _paths(spark, path)
    try:
        fs.create(lock, False).close()
    except Exception as e:
        raise RuntimeError(f"{path} is locked by another run") from e
    try:
        yield
    finally:
        fs.delete(lock, False)


def write_sheets(df: DataFrame, path: str) -> None:
    """Quoted CSV whose part files each begin with a byte-order mark and the header, as spreadsheets
    want them. Lines are made by the engine; Python only puts the header in front."""
    quoted = [F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in df.columns]
    head = "﻿" + ",".join('"' + c.replace('"', '""') + '"' for c in df.columns)

    def with_header(batches):
        yield pa.RecordBatch.from_arrays([pa.array([head])], ["value"])
        yield from (pa.RecordBatch.from_arrays([b.column(0)], ["value"]) for b in batches)

    df.select(F.concat_ws(",", *quoted).alias("value")).mapInArrow(with_header, "value string").write.mode("overwrite").text(path)
