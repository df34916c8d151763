"""Date functions. Each takes the day it is (as_of); none asks the clock. Unknown is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import clean_text


def iso_date(x: Column) -> Column:
    """A leading YYYY-MM-DD as text, not checked against the calendar; "" without one."""
    return F.regexp_extract(F.coalesce(x, F.lit("")), r"^\s*(\d{4}-\d{2}-\d{2})", 1)


def to_date(x: Column) -> Column:
    return F.try_to_timestamp(F.nullif(iso_date(x), F.lit("")), F.lit("yyyy-MM-dd")).cast("date")


def _number(x: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(x, pattern, 1), F.lit("")).try_cast("int")


def posted_on(x: Column, as_of: Column) -> Column:
    """Posted Today / Yesterday / N(+) Days Ago."""
    t = F.lower(F.coalesce(x, F.lit("")))
    days = _number(t, r"(\d+)\+?\s*days?")
    return F.when(t.contains("today") | t.contains("just posted"), as_of).when(t.contains("yesterday"), F.date_sub(as_of, 1)).when(days.isNotNull(), F.date_sub(as_of, days))


def _ago(x: Column, as_of: Column, month: int, year: int, day_from_hours: bool) -> Column:
    t = F.lower(F.coalesce(x, F.lit("")))
    n = F.coalesce(_number(t, r"(\d+)"), F.when(t.rlike(r"\ban?\b"), F.lit(1)))
    hours = F.when(n >= 24, 1).otherwise(0) if day_from_hours else F.lit(0)
    days = (
        F.when(t.rlike("minute|hour|just now|today"), F.coalesce(F.when(t.contains("hour"), hours), F.lit(0))).when(t.contains("yesterday"), 1)
        .when(t.contains("day"), n).when(t.contains("week"), n * 7).when(t.contains("month"), n * month).when(t.contains("year"), n * year)
    )
    return F.date_sub(as_of, days.cast("int"))


def ago(x: Column, as_of: Column) -> Column:
    """N days, weeks (7), months (30), years (365) ago; 24 hours or more are a day."""
    return _ago(x, as_of, 30, 365, True)


def newest_possible(x: Column, as_of: Column) -> Column:
    """The latest day an age allows: a month is 28 days."""
    return _ago(x, as_of, 28, 365, False)


def epoch_ms(x: Column, zone: str = "UTC") -> Column:
    """Day of milliseconds since 1970; zero and below are unknown."""
    n = x.try_cast("long")
    return F.when(n > 0, F.to_date(F.from_utc_timestamp(F.timestamp_millis(n), zone)))


def epoch_s(x: Column, zone: str = "UTC") -> Column:
    n = x.try_cast("long")
    return F.when(n > 0, F.to_date(F.from_utc_timestamp(F.timestamp_seconds(n), zone)))


def object_id_date(x: Column) -> Column:
    """Day of an object id: its first eight hex digits are seconds."""
    return F.when(x.rlike(r"^[0-9a-fA-F]{24}$"), epoch_s(F.conv(F.left(x, F.lit(8)), 16, 10)))


def rfc822(x: Column) -> Column:
    """Day of an RSS date; the weekday is dropped first."""
    t = F.regexp_replace(F.trim(x), r"^[A-Za-z]{3,9},\s*", "")
    t = F.regexp_replace(F.regexp_replace(t, r"\b(?:GMT|UTC|Z)$", "+0000"), r"^(\d)\b", "0$1")
    return F.to_date(F.try_to_timestamp(t, F.lit("dd MMM yyyy HH:mm:ss Z")))


def card_date(x: Column, as_of: Column) -> Column:
    """A day and month without year: this year, or last year if that is over two days ahead."""
    day = _number(x, r"(\d{1,2})")
    month = F.position(F.lower(F.left(F.regexp_extract(x, r"([A-Za-z]{3,})", 1), F.lit(3))), F.lit("janfebmaraprmayjunjulaugsepoctnovdec"))
    m = F.when((month > 0) & (month % 3 == 1), ((month + 2) / 3).cast("int"))
    here = F.try_make_timestamp(F.year(as_of), m, day, F.lit(0), F.lit(0), F.lit(0)).cast("date")
    before = F.try_make_timestamp(F.year(as_of) - 1, m, day, F.lit(0), F.lit(0), F.lit(0)).cast("date")
    return F.when(here > F.date_add(as_of, 2), before).otherwise(here)


def deadline(x: Column) -> Column:
    """The first ISO date, else day, month (a name or a number) and year, as text YYYY-MM-DD; ranges are
    checked, the calendar isn't."""
    t = clean_text(x)
    iso = F.regexp_extract(t, r"\b\d{4}-\d{2}-\d{2}\b", 0)
    d, m, y = (F.regexp_extract(t, r"\b(\d{1,2})[\s./-]+([A-Za-z]{3,9}|\d{1,2})[\s./-]+(\d{4})\b", i) for i in (1, 2, 3))
    place = F.position(F.lower(F.left(m, F.lit(3))), F.lit("janfebmaraprmayjunjulaugsepoctnovdec"))
    month = F.coalesce(m.try_cast("int"), F.when((place > 0) & (place % 3 == 1), ((place + 2) / 3).cast("int")))
    built = F.concat_ws("-", y, F.lpad(month.cast("string"), 2, "0"), F.lpad(d, 2, "0"))
    return F.when(iso != "", iso).when((y != "") & d.try_cast("int").between(1, 31) & month.between(1, 12), built).otherwise(F.lit(""))


def hijri(year: Column, month: Column, day: Column) -> Column:
    """Day of the tabular Islamic calendar (civil epoch) by its Julian day number; years 1300 to 1600."""
    y, m, d = (c.cast("long") for c in (year, month, day))
    jdn = F.floor((y * 11 + 3) / 30) + 354 * y + 30 * m - F.floor((m - 1) / 2) + d + 1948440 - 385
    return F.when(m.between(1, 12) & d.between(1, 30) & y.between(1300, 1600), F.date_add(F.lit("1970-01-01").cast("date"), (jdn - 2440588).cast("int")))


def is_active(closes: Column, posted: Column, status: Column, as_of: Column, days: int = 30) -> Column:
    """By a status of running, expired or closed; else by the closing day; else by `days` after posting;
    false if nothing is known."""
    s = F.lower(clean_text(status))
    known = F.when(s.contains("still running") | (s == "running"), True).when(s.rlike("expired|closed"), False)
    return F.coalesce(known, closes >= as_of, F.date_add(posted, days) >= as_of, F.lit(False))


def state_time(x: Column, zone: str = "Asia/Kolkata") -> Column:
    """The instant of an ISO time; one without an offset is of the zone. Null if it is none."""
    t = F.trim(x)
    offset = t.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$")
    naive = F.try_to_timestamp(F.replace(F.regexp_extract(t, r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}", 0), F.lit(" "), F.lit("T")), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    local = F.convert_timezone(F.lit(zone), F.lit("UTC"), naive.cast("timestamp_ntz"))
    return F.when(offset, F.replace(t, F.lit(" "), F.lit("T")).try_cast("timestamp")).otherwise(F.convert_timezone(F.lit("UTC"), F.current_timezone(), local).cast("timestamp"))


def time_cutoff(last_run: Column, now: Column, grace_hours: int = 48, first_days: int = 7, since: Column | None = None, days: int | None = None) -> Column:
    """The instant behind which rows are new: since; else now less days; else the last run less the
    grace; else now less first_days."""
    back = lambda t, hours: t - F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(0), F.lit(0))
    first = F.coalesce(back(last_run, grace_hours), back(now, 24 * first_days))
    return F.coalesce(*([since] if since is not None else []), *([back(now, 24 * days)] if days is not None else []), first)


def cutoff(newest: Column, as_of: Column, grace: int = 2, window: int | None = 7, since: str | None = None, rolling: int | None = None) -> Column:
    """Oldest day that counts as new: since; else as_of less rolling, whatever is stored; else newest
    stored day less grace; else as_of less window, or null (keep all) with no window."""
    if since:
        return F.lit(since).cast("date")
    if rolling is not None:
        return F.date_sub(as_of, rolling)
    first = F.date_sub(as_of, window) if window is not None else F.lit(None).cast("date")
    return F.coalesce(F.date_sub(newest, grace), first)


#: The months.
_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_HUMAN = r"(\d{1,2})\s+([A-Za-z]+)\s+(\d{4})"
#: Fixed pattern: day, month, year and what marks a Hijri year.
_TOKEN = r"(?i)\b(\d{1,2})\s*[/\-.]\s*(\d{1,2})\s*[/\-.]\s*(1[34]\d{2}|20\d{2})\s*(AH|H\b|هـ)?"


def _day(year: Column, month: Column, day: Column) -> Column:
    return F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0)).cast("date")


def human_date(x: Column) -> Column:
    """`27 August 2026` as text YYYY-MM-DD, not checked against the calendar; "" without one."""
    t = clean_text(x)
    d, m, y = (F.regexp_extract(t, _HUMAN, i) for i in (1, 2, 3))
    month = F.array_position(F.array(*[F.lit(n) for n in _MONTHS]), F.lower(m))
    return F.when(month > 0, F.concat_ws("-", y, F.lpad(month.cast("string"), 2, "0"), F.lpad(d, 2, "0"))).otherwise(F.lit(""))


def page_date(x: Column) -> Column:
    """Day of `27 August 2026`; null if the calendar has none."""
    return F.try_to_timestamp(F.nullif(human_date(x), F.lit("")), F.lit("yyyy-MM-dd")).cast("date")


def url_month(x: Column) -> Column:
    """struct(year, month) of an id that begins like august-2026/, else null."""
    name, year = (F.regexp_extract(F.coalesce(x, F.lit("")), r"^([a-z]+)-(\d{4})/", i) for i in (1, 2))
    month = F.array_position(F.array(*[F.lit(n) for n in _MONTHS]), name).cast("int")
    return F.when(month > 0, F.struct(year.try_cast("int").alias("year"), month.alias("month")))


def slug_date(x: Column) -> Column:
    """Day of a 20YY-M-D inside a URL."""
    y, m, d = (F.regexp_extract(F.coalesce(x, F.lit("")), r"(20\d{2})-(\d{1,2})-(\d{1,2})", i).try_cast("int") for i in (1, 2, 3))
    return _day(y, m, d)


def token_date(x: Column) -> Column:
    """Day of one d/m/y; Hijri by its mark or by a year from 1300 to 1499."""
    d, m, y = (F.regexp_extract(x, _TOKEN, i).try_cast("int") for i in (1, 2, 3))
    marked = F.regexp_extract(x, _TOKEN, 4) != ""
    return F.when(marked | (y < 1500), hijri(y, m, d)).otherwise(_day(y, m, d))


def application_window(x: Column) -> Column:
    """struct(opens, closes, snippet): the first two days that a text names, swapped if reversed, and
    up to 240 characters around them; null days and "" without any."""
    body = clean_text(x)
    # the text between the tokens gives their places
    between, tokens = F.split(body, _TOKEN), F.regexp_extract_all(body, F.lit(_TOKEN), F.lit(0))
    length = lambda parts, n: F.aggregate(F.slice(parts, 1, n), F.lit(0), lambda a, p: a + F.length(p))
    placed = F.transform(tokens, lambda t, i: F.struct(token_date(t).alias("day"), (length(between, i + 1) + length(tokens, i)).alias("start"), (length(between, i + 1) + length(tokens, i + 1)).alias("end")))
    known = F.filter(placed, lambda p: p["day"].isNotNull())
    one, two, last = F.try_element_at(known, F.lit(1)), F.try_element_at(known, F.lit(2)), F.try_element_at(known, F.lit(-1))
    start = F.greatest(one["start"] - 90, F.lit(0))
    snippet = F.left(F.trim(F.substring(body, start + 1, last["end"] + 20 - start)), F.lit(240))
    opens = F.when(two["day"] < one["day"], two["day"]).otherwise(one["day"])
    closes = F.when(two["day"] < one["day"], one["day"]).otherwise(two["day"])
    return F.struct(opens.alias("opens"), closes.alias("closes"), F.coalesce(snippet, F.lit("")).alias("snippet"))
