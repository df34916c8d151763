"""Salary and experience. Rounding is half to even (bround)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import clean_text

_TOKEN = r"\d[\d,]*(?:\.\d+)?"


def amounts(x: Column) -> Column:
    """All numbers of a text, without commas, as doubles."""
    found = F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(_TOKEN), F.lit(0))
    return F.transform(found, lambda t: F.replace(t, F.lit(","), F.lit("")).try_cast("double"))


def int_text(x: Column) -> Column:
    """A number as digits, cut towards zero; "" for what isn't one."""
    n = x.try_cast("double")
    return F.coalesce(F.when(~F.isnan(n), n.try_cast("long").cast("string")), F.lit(""))


def annual_lakh(x: Column) -> Column:
    """struct(raw, low, high, period, currency) of the first two positive numbers of a display text.

    No currency is INR; another one than INR and USD leaves only raw. LPA and lakh count 100,000, k
    1,000 for numbers below 1,000; without a period 100,000 or more is a year. Null without text."""
    t = clean_text(x)
    a = F.filter(amounts(t), lambda v: v > 0)
    foreign = F.regexp_extract(t, r"\b(?:AED|SAR|QAR|KWD|BHD|OMR|USD|GBP|EUR|CHF)\b|[$£€]", 0)
    known = (F.size(a) > 0) & foreign.isin("", "USD", "$")
    scale = lambda v: F.when(t.rlike("(?i)lpa|lakh|lac"), v * 100000).when(t.rlike(r"(?i)\d\s*k\b") & (v < 1000), v * 1000).otherwise(v)
    first = scale(F.try_element_at(a, F.lit(1)))
    second = F.coalesce(scale(F.try_element_at(a, F.lit(2))), first)
    period = (
        F.when(t.rlike(r"(?i)per\s*year|/\s*year|annum|p\.?\s?a\b|yearly|annual|lpa"), "per_annum").when(t.rlike(r"(?i)month|p\.?\s?m\b|stipend"), "per_month")
        .when(F.greatest(first, second) >= 100000, "per_annum").otherwise("per_month")
    )
    shown = lambda v: F.when(known, v)
    whole = lambda v: shown(F.bround(v).cast("long"))
    out = F.struct(
        F.left(t, F.lit(120)).alias("raw"), whole(F.least(first, second)).alias("low"), whole(F.greatest(first, second)).alias("high"),
        shown(period).alias("period"), shown(F.when(foreign == "", "INR").otherwise("USD")).alias("currency"),
    )
    return F.when(t != "", out)


def monthly(x: Column) -> Column:
    """struct(raw, low, high, period): least and largest of all numbers, per month. Numbers below 1,000
    without a comma are lakh if the text says so; yearly ones are divided by 12; without a period
    there are no amounts; hidden or no text is Not Disclosed."""
    raw = clean_text(x)
    t = F.lower(raw)
    hidden = (raw == "") | t.contains("hidden") | t.contains("not disclosed")
    period = F.when(t.rlike(r"/yr|p\.a|annum|year"), "Yr").when(t.rlike(r"/mo|p\.m|month"), "Mo").otherwise("")
    lakh = t.rlike("lakh|lpa")
    value = lambda v: F.replace(v, F.lit(","), F.lit("")).try_cast("double")
    all_ = F.transform(F.regexp_extract_all(raw, F.lit(_TOKEN), F.lit(0)), lambda v: F.when(lakh & ~v.contains(",") & (value(v) < 1000), value(v) * 100000).otherwise(value(v)))
    part = lambda v: F.when(~hidden & (period != ""), F.bround(v / F.when(period == "Yr", 12).otherwise(1)).cast("long"))
    return F.struct(
        F.when(hidden, "Not Disclosed").otherwise(raw).alias("raw"), part(F.array_min(all_)).alias("low"), part(F.array_max(all_)).alias("high"), F.when(hidden, "").otherwise(period).alias("period")
    )


def yearly_or_monthly(low: Column, high: Column, hide: Column, currency: Column) -> Column:
    """struct(raw, low, high, period, currency, hidden) per month of two structs (absoluteValue,
    absoluteMonthlyValue): yearly figures are preferred, a monthly one replaces a twelfth; hidden ones
    are kept and marked."""
    amount = lambda s, f: F.when(s[f].try_cast("double") > 0, s[f].try_cast("double"))
    y0, y1, m0, m1 = amount(low, "absoluteValue"), amount(high, "absoluteValue"), amount(low, "absoluteMonthlyValue"), amount(high, "absoluteMonthlyValue")
    code = F.when(F.trim(F.coalesce(currency, F.lit(""))) == "", "INR").otherwise(F.trim(currency))
    yearly, monthly_ = y0.isNotNull() | y1.isNotNull(), m0.isNotNull() | m1.isNotNull()
    a, b = F.when(yearly, F.coalesce(y0, y1)).otherwise(F.coalesce(m0, m1)), F.when(yearly, F.coalesce(y1, y0)).otherwise(F.coalesce(m1, m0))
    told = F.concat(code, F.lit(" "), F.bround(a).cast("long"), F.lit("-"), F.bround(b).cast("long"), F.when(yearly, " P.A.").otherwise(" P.M."))
    month = lambda m, v: F.bround(F.when(yearly, F.coalesce(m, v / 12)).otherwise(v)).cast("long")
    any_ = yearly | monthly_
    return F.struct(
        F.when(any_, told).otherwise("Not Disclosed").alias("raw"), F.when(any_, month(m0, a)).alias("low"), F.when(any_, month(m1, b)).alias("high"),
        F.when(yearly, "Yr").when(monthly_, "Mo").otherwise("").alias("period"), F.when(any_, code).otherwise("").alias("currency"), F.coalesce(hide, F.lit(False)).alias("hidden"),
    )


#: Names of periods.
_PERIODS = {"annual": "per_annum", "monthly": "per_month", "hourly": "per_hour", "weekly": "per_week", "daily": "per_day"}


def _described(low: Column, high: Column, currency: Column, period: Column, known: Column) -> Column:
    raw = F.concat(F.when(currency == "", "?").otherwise(currency), F.lit(" "), low, F.lit(" - "), high, F.when(period == "", "").otherwise(F.concat(F.lit(" "), F.replace(period, F.lit("_"), F.lit(" ")))))
    shown = lambda v: F.when(known, v).otherwise("")
    return F.struct(F.when(known, raw).otherwise("Not Disclosed").alias("raw"), F.when(known, low).alias("low"), F.when(known, high).alias("high"), shown(currency).alias("currency"), shown(period).alias("period"))


def stated_salary(low: Column, high: Column, currency: Column, period: Column) -> Column:
    """struct(raw, low, high, currency, period) of four texts in which None means missing."""
    value = lambda c: F.when(F.coalesce(F.trim(c.cast("string")), F.lit("")).isin("", "None"), "").otherwise(F.trim(c.cast("string")))
    a, b = (F.bround(value(c).try_cast("double")).cast("long") for c in (low, high))
    a, b = F.coalesce(a, b), F.coalesce(b, a)
    named = F.coalesce(*[F.when(F.lower(value(period)) == k, F.lit(v)) for k, v in _PERIODS.items()], F.lit(""))
    return _described(F.least(a, b), F.greatest(a, b), value(currency), named, a.isNotNull())


def listed_salary(kind: Column, low: Column, high: Column, currency: Column, period: Column, placeholders: tuple[int, ...] = (64,), currencies: tuple = ((1, "GBP"),), periods: tuple = ((5, "per_annum"), (1, "per_hour"))) -> Column:
    """struct(raw, low, high, currency, period) of a listing's numbers and codes; a placeholder kind,
    or no lower bound, is undisclosed."""
    named = lambda c, table: F.coalesce(*[F.when(c == k, F.lit(v)) for k, v in table], F.lit(""))
    a = F.bround(low.try_cast("double")).cast("long")
    b = F.bround(F.coalesce(F.when(high.try_cast("double") != 0, high.try_cast("double")), low.try_cast("double"))).cast("long")
    known = ~F.coalesce(kind.isin(*placeholders), F.lit(False)) & F.coalesce(low.try_cast("double") != 0, F.lit(False))
    return _described(a, b, named(currency, currencies), named(period, periods), known)


def pair(low: Column, high: Column, hidden: Column | None = None) -> Column:
    """struct(low, high): a missing or zero side takes the other, a reversed pair is swapped,
    hidden is null."""
    a, b = (F.when(c.try_cast("double") > 0, c.try_cast("double")) for c in (low, high))
    a, b = F.coalesce(a, b), F.coalesce(b, a)
    shown = ~F.coalesce(hidden, F.lit(False)) if hidden is not None else F.lit(True)
    return F.struct(F.when(shown, F.bround(F.least(a, b)).cast("long")).alias("low"), F.when(shown, F.bround(F.greatest(a, b)).cast("long")).alias("high"))


def base_salary(low: Column, high: Column, unit: Column) -> Column:
    """pair() per month: YEAR is divided by 12."""
    part = F.when(F.upper(unit) == "YEAR", 12.0).otherwise(1.0)
    return pair(low.try_cast("double") / part, high.try_cast("double") / part)


def experience_years(x: Column) -> Column:
    """Years that a description asks for, 1 to 30 as text; the second pattern is tried where the
    first finds nothing in range; else ""."""
    t = F.coalesce(x, F.lit(""))
    # fixed patterns
    first = F.regexp_extract(t, r"(?iU)(?:minimum|at\s?least)\s+(?:of\s+)?(\d{1,2})\s*(?:\+|-\s*\d{1,2})?\s*years?", 1)
    second = F.regexp_extract(t, r"(?iU)(\d{1,2})\s*(?:\+|-\s*\d{1,2})?\s*years?['’s]*\s*(?:of\s+)?(?:relevant\s+|work(?:ing)?\s+|professional\s+|prior\s+)?experience", 1)
    ok = lambda c: F.when(F.nullif(c, F.lit("")).try_cast("int").between(1, 30), F.nullif(c, F.lit("")).try_cast("int").cast("string"))
    return F.coalesce(ok(first), ok(second), F.lit(""))


def experience_range(x: Column) -> Column:
    """struct(low, high) of what a text says of years: a range, swapped if reversed, else a minimum;
    what stands in brackets doesn't count, a single number above 40 is an age; freshers start at 0."""
    whole = clean_text(x)
    t = F.regexp_replace(whole, r"\([^)]*\)", " ")
    number = r"(\d+(?:\.\d+)?)"
    get = lambda pattern, i: F.nullif(F.regexp_extract(t, "(?iU)" + pattern, i), F.lit("")).try_cast("double").cast("int")
    span = number + r"\s*(?:-|–|—|to)\s*" + number + r"\s*(?:\+\s*)?y"
    a, b, one = get(span, 1), get(span, 2), get(number + r"\s*\+?\s*y", 1)
    fresher = whole.rlike(r"(?iU)fresher|entry.level|no experience|0\s*year")
    low = F.when(fresher, 0).when(a.isNotNull(), F.least(a, b)).when(one <= 40, one)
    high = F.when(a.isNotNull(), F.greatest(a, b)).when(fresher, F.when(one <= 40, one).otherwise(0))
    return F.struct(low.alias("low"), high.alias("high"))


def experience_span(x: Column) -> Column:
    """struct(low, high) of `1 to 5 Yrs`; one number is both."""
    get = lambda i: F.nullif(F.regexp_extract(clean_text(x), r"(?iU)(\d+)(?:\s*to\s*(\d+))?\s*Yrs?", i), F.lit("")).try_cast("int")
    return F.struct(get(1).alias("low"), F.coalesce(get(2), get(1)).alias("high"))


#: Fixed patterns: what introduces a required number of years, what follows one, and training.
_CUE = r"(?:\bnot\s+less\s+than\b|\bnlt\b|\bminimum(?:\s+of)?\b|\bmin\.?\b|\bat\s+least\b|\bmore\s+than\b)\s*(\d{1,2})\s*(?:\+|\s*(?:-|to)\s*\d{1,2})?\s*(?:year|yr)"
_TRAILING = r"(\d{1,2})\s*(?:\+)?\s*(?:-|to)?\s*(?:\d{1,2})?\s*(?:year|yr)s?[’'`]?s?\b[^.;]{0,40}?\bexperience\b"
_TRAINING = ("internship", "traineeship", "training", "residency", "residence", "rotation", "fellowship", "study", "studies", "course", "programme", "program", "contract", "probation")


def least_experience(x: Column) -> Column:
    """The least number of years, 0 to 40, that a cue asks for and no word of training follows within 30
    characters, or that stands before `experience` in its sentence."""
    t = clean_text(x)
    no_training = "(?!" + "|".join(rf".{{0,{30 - len(w)}}}\b{w}\b" for w in _TRAINING) + ")"
    asked = F.transform(F.regexp_extract_all(t, F.lit("(?iU)" + _CUE + no_training), F.lit(1)), lambda n: n.cast("int"))
    named = F.transform(F.regexp_extract_all(t, F.lit("(?iU)" + _TRAILING), F.lit(1)), lambda n: n.cast("int"))
    return F.array_min(F.filter(F.concat(asked, named), lambda n: n <= 40))


def export_block(low: Column, high: Column, currency: Column, period: Column) -> list[Column]:
    """min_salary, max_salary, salary_period, salary_currency: all or none of them."""
    ok = low.isNotNull() & currency.isin("INR", "USD") & (F.coalesce(period, F.lit("")) != "")
    cols = (("min_salary", low), ("max_salary", F.coalesce(high, low)), ("salary_period", period), ("salary_currency", currency))
    return [F.when(ok, c.cast("string")).otherwise(F.lit("Not Disclosed" if n == "min_salary" else "")).alias(n) for n, c in cols]


#: Units of a displayed salary, the first that occurs counts.
_UNITS = (("annum|year", "per_annum"), ("month", "per_month"), ("hour", "per_hour"), ("day", "per_day"), ("week", "per_week"))
#: Currency codes and signs, in the order in which they are looked for.
_CODES = ("AED", "SAR", "QAR", "KWD", "OMR", "BHD", "USD", "EGP", "JOD", "LBP", "IQD", "MAD", "GBP", "EUR", "INR")
_SIGNS = (("$", "USD"), ("£", "GBP"), ("€", "EUR"))


def _salary(raw: Column, low: Column, high: Column, currency: Column, period: Column, known: Column) -> Column:
    whole = lambda v: F.when(known, F.bround(v).cast("long"))
    shown = lambda v: F.coalesce(F.when(known, v), F.lit(""))
    return F.struct(raw.alias("raw"), whole(F.least(low, high)).alias("low"), whole(F.greatest(low, high)).alias("high"), shown(currency).alias("currency"), shown(period).alias("period"))


def display_salary(x: Column) -> Column:
    """struct(raw, low, high, currency, period) of a displayed salary: its first two numbers per
    stated unit; without number or unit only raw. Pounds only by their sign."""
    raw = F.trim(F.coalesce(x, F.lit("")))
    a, unit = amounts(raw), F.coalesce(*[F.when(F.lower(raw).rlike(p), F.lit(u)) for p, u in _UNITS])
    first = F.try_element_at(a, F.lit(1))
    second = F.coalesce(F.try_element_at(a, F.lit(2)), first)
    return _salary(F.when(raw == "", "Not Disclosed").otherwise(raw), first, second, F.when(raw.contains("£"), "GBP"), unit, first.isNotNull() & unit.isNotNull())


def salary_text(x: Column) -> Column:
    """struct(raw, low, high, currency, period) of a monthly salary: least and largest positive
    number; currency by code, else by sign; null where nothing is disclosed."""
    raw = clean_text(x)
    found = F.transform(F.regexp_extract_all(raw, F.lit(r"\d[\d,.]*"), F.lit(0)), lambda t: F.bround(F.replace(t, F.lit(","), F.lit("")).try_cast("double")))
    a = F.filter(found, lambda v: v > 0)
    code = F.coalesce(*[F.when(F.upper(raw).rlike(rf"(?U)\b{c}\b"), c) for c in _CODES], *[F.when(raw.contains(s), c) for s, c in _SIGNS])
    told = ~F.lower(raw).isin("", "not specified", "not disclosed", "unspecified", "negotiable", "n/a")
    return F.when(told & (F.size(a) > 0), _salary(raw, F.array_min(a), F.array_max(a), code, F.lit("per_month"), F.lit(True)))


def pay_range(x: Column) -> Column:
    """struct(raw, low, high, currency, period) of a yearly range in dollars that a description
    states; under 10,000 only raw, null without one."""
    # a fixed pattern
    pattern = r"(?iU)(?:pay|salary|compensation)\s+range[^$\n]{0,80}?\$\s*([\d,]+(?:\.\d+)?)\s*(?:-|–|—|\bto\b)\s*\$?\s*([\d,]+(?:\.\d+)?)"
    t = clean_text(x)
    raw = F.regexp_extract(t, pattern, 0)
    low, high = (F.replace(F.regexp_extract(t, pattern, i), F.lit(","), F.lit("")).try_cast("double") for i in (1, 2))
    return F.when(raw != "", _salary(F.left(raw, F.lit(120)), F.floor(low), F.floor(high), F.lit("USD"), F.lit("per_annum"), F.least(low, high) >= 10000))


def object_salary(salary: Column) -> Column:
    """struct(low, high, period) per month of a struct(type, minAmount, maxAmount): monthly or
    yearly; another type, or no amount, is undisclosed (null)."""
    kind = F.lower(F.trim(salary["type"].cast("string")))
    divisor = F.when(kind == "monthly", 1).when(kind == "yearly", 12)
    low, high = (F.greatest(F.coalesce(salary[c].try_cast("double"), F.lit(0.0)), F.lit(0.0)) for c in ("minAmount", "maxAmount"))
    high = F.when(high <= 0, low).otherwise(high)
    whole = lambda v: F.bround(v / divisor).cast("long")
    told = F.struct(whole(F.least(low, high)).alias("low"), whole(F.greatest(low, high)).alias("high"), F.when(kind == "monthly", "P.M").otherwise("P.A").alias("period"))
    return F.when(divisor.isNotNull() & (high > 0), told)


def lakh_pair(low: Column, high: Column, threshold: float = 1000.0) -> Column:
    """struct(low, high) per year of figures in mixed units: below the threshold they are lakh. A
    missing or zero side takes the other, a reversed pair is swapped, null without either."""
    one = lambda c: c.try_cast("double") * F.when(c.try_cast("double") < threshold, 100000.0).otherwise(1.0)
    both = pair(one(low), one(high))
    return F.when(both["low"].isNotNull(), both)


def ctc_range(x: Column, threshold: float = 1000.0) -> Column:
    """lakh_pair() of two figures with one dash between them."""
    parts = F.split(clean_text(x), "-")
    return F.when(F.size(parts) == 2, lakh_pair(F.trim(parts[0]), F.trim(F.try_element_at(parts, F.lit(2))), threshold))


def experience_in_context(x: Column) -> Column:
    """struct(raw, low, high) of the first sentence that speaks of experience, minimum or at least and
    names years; null without one."""
    parts = F.split(clean_text(x), r"(?U)(?<=[.;•])\s+|\s{2,}")
    span, single = r"(?iU)(\d{1,2})\s*\)?\s*(?:[-–—]|\bto\b)\s*(\d{1,2})\s*\)?\s*\+?\s*year", r"(?iU)(\d{1,2})\s*\)?\s*\+?\s*year"
    part = F.try_element_at(F.filter(parts, lambda p: p.rlike("(?i)experien|minimum|at least") & p.rlike(single)), F.lit(1))
    a, b = (F.regexp_extract(part, span, i).try_cast("int") for i in (1, 2))
    alone = F.regexp_extract(part, single, 1).try_cast("int")
    told = F.struct(F.left(F.trim(part), F.lit(200)).alias("raw"), F.coalesce(F.least(a, b), alone).alias("low"), F.greatest(a, b).alias("high"))
    return F.when(part.isNotNull(), told)


#: Number words.
_WORDS = {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12, "fifteen": 15, "twenty": 20}


def stated_minimum(x: Column) -> Column:
    """Years after the first `minimum (of)`, in digits or words, 1 to 40; null without them."""
    found = F.lower(F.regexp_extract(F.coalesce(x, F.lit("")), rf"(?iU)minimum(?:\s+of)?\s+(\d{{1,2}}|{'|'.join(_WORDS)})\s*\+?\s*(?:\(\d+\)\s*)?years?", 1))
    n = F.coalesce(*[F.when(found == w, F.lit(v)) for w, v in _WORDS.items()], found.try_cast("int"))
    return F.when(n.between(1, 40), n)
