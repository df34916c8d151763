"""Location functions and the country dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import clean_text, is_remote

#: Other spellings of country names, lower case.
FIXUPS = {
    "united states of america": "United States", "usa": "United States", "us": "United States", "uk": "United Kingdom", "great britain": "United Kingdom",
    "korea, republic of": "South Korea", "republic of korea": "South Korea", "russian federation": "Russia", "viet nam": "Vietnam", "czechia": "Czech Republic",
}


def lookup(key: Column, table: dict[str, str]) -> Column:
    """Value of a small fixed table, null if the key isn't in it."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def country_name(x: Column, fixups: dict[str, str] = FIXUPS) -> Column:
    return F.coalesce(lookup(F.lower(clean_text(x)), fixups), clean_text(x))


def with_country(df: DataFrame, countries: DataFrame, name: str, code: str) -> DataFrame:
    """Adds country_name, country_code, country_dial_code: a known code wins, else the folded name;
    an unknown name stays with blank codes. countries: name, code, dial, one row per country; the
    engine broadcasts it by its size."""
    by_code = countries.select(F.upper("code").alias("_k1"), F.struct("name", "code", "dial").alias("_c1")).dropDuplicates(["_k1"])
    by_name = countries.select(F.lower("name").alias("_k2"), F.struct("name", "code", "dial").alias("_c2")).dropDuplicates(["_k2"])
    out = df.withColumn("_k1", F.upper(clean_text(F.col(code)))).withColumn("_k2", F.lower(country_name(F.col(name))))
    out = out.join(by_code, "_k1", "left").join(by_name, "_k2", "left").withColumn("_c", F.coalesce("_c1", "_c2"))
    return out.withColumns({
        "country_name": F.coalesce("_c.name", country_name(F.col(name))), "country_code": F.coalesce("_c.code", F.lit("")), "country_dial_code": F.coalesce("_c.dial", F.lit("")),
    }).drop("_k1", "_k2", "_c1", "_c2", "_c")


def city(x: Column, country: Column, code: Column, last: bool = False, drop: tuple[str, ...] = ()) -> Column:
    """First (or last) segment between , - – that is no country, code, remote mark or `N locations`."""
    low = lambda p: F.lower(p)
    fixed = F.array(*[F.lit(d) for d in (*FIXUPS, *drop)])
    parts = F.transform(F.split(clean_text(x), "[,\\-–]"), lambda p: F.trim(p))
    ok = lambda p: (p != "") & (low(p) != F.lower(F.coalesce(country, F.lit("")))) & (low(p) != F.lower(F.coalesce(code, F.lit("")))) & ~F.array_contains(fixed, low(p)) & ~is_remote(p) & ~low(p).rlike(r"^\d+\s+locations?$")
    return F.coalesce(F.try_element_at(F.filter(parts, ok), F.lit(-1 if last else 1)), F.lit(""))


def locality(x: Column, states: tuple[str, ...], countries: dict[str, tuple[str, str, str]], home: str = "us") -> Column:
    """struct(city, country, code, dial, remote): `Country, City`; `City, ST` or a bare state is home's;
    any other text is a city of an unknown country with blank codes. What stands in brackets goes;
    `Regional X` is remote work in X. countries: (name, code, dial) by lower-cased name."""
    text = clean_text(x)
    ends = r"^[ ,]+|[ ,]+$"
    bare = F.regexp_replace(F.regexp_replace(text, r"\s*\([^)]*\)", ""), ends, "")
    regional = bare.rlike(r"(?iU)^regional\b")
    core = F.when(regional, F.regexp_replace(F.regexp_replace(bare, r"(?i)^regional\s+", ""), ends, "")).otherwise(bare)
    parts = F.split(core, ",", 2)
    head, rest = F.trim(parts[0]), F.trim(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")))
    state = lambda c: F.lower(F.regexp_replace(c, r"^\.+|\.+$", "")).isin(*[n.lower() for n in states])
    table = lambda i: {k: v[i] for k, v in countries.items()}
    key = F.when(lookup(F.lower(head), table(0)).isNotNull() & (rest != ""), F.lower(head))
    key = F.coalesce(key, F.when((rest != "") & state(rest), F.lit(home)), F.when((rest == "") & state(core), F.lit(home)), F.when(rest == "", F.lower(core)))
    name = lookup(key, table(0))
    known_head = lookup(F.lower(head), table(0)).isNotNull()
    place = F.when((rest != "") & known_head, F.regexp_replace(rest, ends, "")).when((rest != "") & state(rest), head).when((rest == "") & ~state(core) & name.isNotNull(), "").otherwise(core)
    blank = F.lit("")
    return F.struct(
        place.alias("city"), F.coalesce(name, blank).alias("country"), F.coalesce(lookup(key, table(1)), blank).alias("code"), F.coalesce(lookup(key, table(2)), blank).alias("dial"),
        (regional | text.rlike(r"(?i)remote|home[\s-]?based|home[\s-]?working")).alias("remote"),
    )


def peel(x: Column, phrases: tuple[str, ...]) -> Column:
    """A text without the phrases that it begins with, longest first, again and again, each up to a
    space, comma, dash or the end."""
    words = sorted({p.lower() for p in phrases if p}, key=lambda p: (-len(p), p))
    if not words:
        return x
    quoted = "|".join(r"\Q" + w + r"\E" for w in words)
    return F.regexp_replace(x, rf"(?iu)^(?:(?:{quoted})(?:$|(?=[ ,\-–])[ ,\-–]*))+", "")


def city_or_remote(city_name: Column, *texts: Column) -> Column:
    """Remote where there is no city and one of the texts says remote."""
    return F.when((F.coalesce(city_name, F.lit("")) == "") & is_remote(*texts), "Remote").otherwise(city_name)


def first_city(x: Column, countries: dict[str, str], home: str = "India") -> Column:
    """struct(city, country) of a list of cities: its first; a bare country is a city of that name;
    no country is home. countries: names by lower-cased name."""
    whole = F.trim(F.coalesce(x, F.lit("")))
    first = F.trim(F.regexp_replace(F.trim(F.split(whole, ",")[0]), r"(?i)\s*\(all areas\)\s*$", ""))
    bare, named = lookup(F.lower(first), countries), lookup(F.lower(whole), countries)
    country = F.coalesce(named, bare, F.lit(home))
    return F.struct(F.coalesce(F.when(bare.isNotNull(), country), first).alias("city"), country.alias("country"))


def split_location(x: Column, countries: tuple[str, ...], aliases: dict[str, str], stations: dict[str, str]) -> Column:
    """struct(city, country, remote) of parts between |: the first that is no country is the city;
    a city alone takes its station's country, never a guess."""
    parts = F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), r"\|"), clean_text), lambda p: p != "")
    away = lambda p: F.lower(p).rlike("^remote|home[ -]based")
    named = F.transform(F.filter(parts, lambda p: ~away(p)), lambda p: F.struct(p.alias("part"), F.coalesce(lookup(p, aliases), p).alias("name")))
    is_country = lambda n: n["name"].isin(*countries)
    city_name = F.coalesce(F.try_element_at(F.filter(named, lambda n: ~is_country(n)), F.lit(1))["part"], F.lit(""))
    country = F.try_element_at(F.filter(named, is_country), F.lit(1))["name"]
    return F.struct(city_name.alias("city"), F.coalesce(country, lookup(city_name, stations), F.lit("")).alias("country"), F.exists(parts, away).alias("remote"))


def job_type(time_type: Column, remote: Column) -> Column:
    return F.when(remote, "remote").when(F.lower(clean_text(time_type)).contains("part"), "part_time").otherwise("full_time")


def hinted_job_type(*texts: Column) -> Column:
    """remote, hybrid, part_time or full_time, the first that the texts hint at."""
    t = F.lower(F.concat_ws(" ", *[F.coalesce(x, F.lit("")) for x in texts]))
    return F.when(t.rlike("work from home|wfh|remote"), "remote").when(t.contains("hybrid"), "hybrid").when(t.rlike("part[ -]time"), "part_time").otherwise("full_time")


def profession(x: Column) -> Column:
    """nurses, pharmacists, doctors or non_clinical, the first that a title names."""
    t = F.coalesce(x, F.lit(""))
    named = lambda words: t.rlike(rf"(?iU)\b(?:{words})\b")
    return (
        F.when(named("nurse|nursing|midwif|anm|gnm"), "nurses").when(named("pharmacist|pharmacy"), "pharmacists")
        .when(named("doctor|physician|surgeon|mbbs|dentist|medical officer|specialist"), "doctors").otherwise("non_clinical")
    )


def company_type(x: Column, pharma: str = r"(?i)pharma|biotech|bio|research|clinical|cro\b|therapeutics|life sciences") -> Column:
    return F.when(F.coalesce(x, F.lit("")).rlike(pharma), "pharma").otherwise("hospital")
