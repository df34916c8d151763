"""Arrays, maps and JSON."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType


def list_text(x: Column) -> Column:
    """array<string> of a JSON list, also with single quotes; a plain text is parted by commas."""
    t = F.trim(F.coalesce(x, F.lit("")))
    parsed = F.from_json(F.regexp_replace(t, "'", '"'), "array<string>")
    plain = F.filter(F.transform(F.split(t, ","), lambda p: F.trim(p)), lambda p: p != "")
    return F.when(t.startswith("["), F.coalesce(parsed, F.array().cast("array<string>"))).otherwise(plain)


def last_wins(pairs: Column) -> Column:
    """A map of array<struct(key, value)>; of equal keys the last counts."""
    keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.element_at(F.filter(pairs, lambda p: p["key"] == k), -1)["value"])))


def first_wins(pairs: Column) -> Column:
    """A map of array<struct(key, value)>; of equal keys the first counts."""
    keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.element_at(F.filter(pairs, lambda p: p["key"] == k), 1)["value"])))


def typed(items: Column, kind: str, value: str = "label", key: str = "type") -> Column:
    """The value of the first struct whose key is `kind`, else ""."""
    return F.coalesce(F.try_element_at(F.filter(items, lambda i: i[key] == kind), F.lit(1))[value], F.lit(""))


def resolve_ref(graph: Column, ref: Column, key: str = "id") -> Column:
    """The struct of an array whose key is ref."""
    return F.try_element_at(F.filter(graph, lambda n: n[key] == ref), F.lit(1))


def resolved(stub: Column, graph: Column, key: str = "@id") -> Column:
    """A map node with the fields of the node that it refers to laid over its own; the last node of
    that key counts, a node that refers to none stays as it is."""
    target = F.try_element_at(F.filter(graph, lambda n: F.try_element_at(n, F.lit(key)) == F.try_element_at(stub, F.lit(key))), F.lit(-1))
    own = F.map_filter(stub, lambda k, _: ~F.array_contains(F.map_keys(target), k))
    return F.when(target.isNull(), stub).otherwise(F.map_concat(own, target))


def listify(x: Column) -> Column:
    """A JSON value as an array of JSON texts: a list's items, else the value alone; null is empty."""
    t = F.trim(x)
    none = F.array().cast("array<string>")
    return F.when(t.isNull() | (t == "null"), none).when(t.startswith("["), F.coalesce(F.from_json(t, "array<string>"), none)).otherwise(F.array(t))


@pandas_udf(ArrayType(StringType()))
def json_values(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The JSON value at the start of each text, as an array of its items (a list's, a @graph's, or the
    value alone); what follows it is ignored, and a text without one gives an empty array. Python,
    since no built-in stops at the end of a value."""
    decode = json.JSONDecoder(strict=False).raw_decode

    def items(text: str) -> list[str]:
        try:
            value = decode(text.strip())[0]
        except ValueError:
            return []
        if isinstance(value, dict) and isinstance(value.get("@graph"), list):
            value = value["@graph"]
        return [json.dumps(v, ensure_ascii=False) for v in (value if isinstance(value, list) else [value]) if isinstance(v, dict)]

    for s in parts:
        yield s.map(lambda t: [] if t is None else items(t))


def ld_blocks(html: Column) -> Column:
    """The texts of a page's JSON-LD blocks."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))


def json_ld(blocks: Column, schema: str, kind: str = "JobPosting") -> Column:
    """The first item of this @type, parsed, of JSON-LD blocks as json_values() gives each, flattened."""
    good = F.filter(blocks, lambda b: F.get_json_object(b, "$['@type']") == kind)
    return F.from_json(F.try_element_at(good, F.lit(1)), schema)


def with_postings(pages: DataFrame, schema: str, html: str = "html", key: str = "page_id", kind: str = "JobPosting") -> DataFrame:
    """pages with `posting`, the first JSON-LD item of this @type over all blocks of a page in order;
    bad blocks are skipped, null where there is none."""
    blocks = pages.select(key, F.posexplode(ld_blocks(F.col(html))).alias("_at", "_block")).withColumn("_items", json_values("_block"))
    first = blocks.withColumn("_posting", json_ld(F.col("_items"), schema, kind)).where("_posting is not null").groupBy(key).agg(F.min_by("_posting", "_at").alias("posting"))
    return pages.join(first, key, "left")


@pandas_udf(StringType())
def balanced(texts: pd.Series, marks: pd.Series) -> pd.Series:
    """The {...} that starts at or behind a mark in a text, by matching braces outside of strings; null
    without one. Python, since no built-in counts braces."""

    def cut(text: str | None, mark: str | None) -> str | None:
        at = -1 if text is None or mark is None else text.find(mark)
        start = text.find("{", at + len(mark)) if at >= 0 else -1
        if start < 0:
            return None
        depth = 0
        for m in re.finditer(r'"(?:[^"\\]|\\.)*"|[{}]', text[start:], re.S):
            depth += {"{": 1, "}": -1}.get(m[0], 0)
            if not depth:
                return text[start : start + m.end()]
        return None

    return pd.Series([cut(t, m) for t, m in zip(texts, marks, strict=True)])


def flight_text(html: Column) -> Column:
    """The decoded text chunks that a page pushes to its client, joined; chunks that don't parse go."""
    chunks = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r'self\.__next_f\.push\(\[1,("(?:[^"\\]|\\.)*")\]\)'), F.lit(1))
    decoded = F.transform(chunks, lambda c: F.from_json(F.concat(F.lit('{"v":'), c, F.lit("}")), "v string")["v"])
    return F.array_join(F.filter(decoded, lambda c: c.isNotNull()), "")


def embedded_json(html: Column, element_id: str = "__NEXT_DATA__") -> Column:
    """The text of the script element with this id."""
    return F.regexp_extract(html, rf'(?s)<script[^>]*id="{element_id}"[^>]*>(.*?)</script>', 1)


def joined_set(values: Column, separator: str = "; ") -> Column:
    """Distinct values that aren't blank, sorted and joined."""
    return F.array_join(F.array_sort(F.filter(F.array_distinct(values), lambda v: F.trim(v) != "")), separator)


def routed(values: Column, vocabularies: dict[str, tuple[str, ...]], rest: str, skip: Column | None = None) -> Column:
    """A struct of arrays: each value that isn't blank or `skip` goes to the first closed vocabulary
    that holds it, what none holds to `rest`."""
    v = F.filter(F.transform(values, lambda x: F.trim(x)), lambda x: (x != "") & (~x.eqNullSafe(F.trim(skip)) if skip is not None else F.lit(True)))
    route = lambda x: F.coalesce(*[F.when(x.isin(*words), F.lit(name)) for name, words in vocabularies.items()], F.lit(rest))
    to = lambda name: F.filter(v, lambda x: route(x) == name).alias(name)
    return F.struct(*[to(name) for name in (*vocabularies, rest)])


def labels_of(ids: Column, names: dict[str, str], separator: str = ", ") -> Column:
    """Names of identifiers, sorted and joined; an unknown identifier stands for itself."""
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv]) if names else F.create_map().cast("map<string,string>")
    known = F.transform(ids, lambda i: F.coalesce(F.try_element_at(table, i.cast("string")), i.cast("string")))
    return F.array_join(F.array_sort(known), separator)


def places(locations: Column) -> Column:
    """array<struct(code, city)> of JSON-LD places; UNAVAILABLE and null are blank, places without
    either are left out."""
    known = lambda c: F.when(F.upper(F.trim(c)) == "UNAVAILABLE", F.lit("")).otherwise(F.trim(F.coalesce(c, F.lit(""))))
    read = F.transform(locations, lambda p: F.struct(F.upper(known(p["address"]["addressCountry"])).alias("code"), known(p["address"]["addressLocality"]).alias("city")))
    return F.filter(read, lambda p: (p["code"] != "") | (p["city"] != ""))
