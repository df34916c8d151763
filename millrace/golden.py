"""Registered queries of scalar functions: cases dealt over a table's rows, beside what each must give.

The SQL states the results as values, worked out by hand from the semantics, and shares nothing with
the code. A struct's fields are joined by |, null is -.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates, location, money, nested, text
from millrace.operators import gates

def as_of() -> Column:
    """The day it is, in all cases."""
    return F.lit("2026-09-01").cast("date")

Case = tuple[str | None, ...]


def shown(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("-"))


def fields(c: Column, *names: str) -> Column:
    return F.when(c.isNull(), "-").otherwise(F.concat_ws("|", *[shown(c[n]) for n in names]))


def listed(c: Column) -> Column:
    return F.when(c.isNull(), "-").otherwise(F.array_join(F.transform(c, lambda x: x.cast("string")), "|", "-"))


def _query(f: Callable[..., Column], cases: list[Case]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey")
        place = (F.col("n_nationkey") % len(cases) + 1).cast("int")
        inputs = [F.element_at(F.array(*[F.lit(c[i]).cast("string") for c in cases]), place).alias(f"x{i}") for i in range(len(cases[0]) - 1)]
        dealt = rows.select("n_nationkey", *inputs)
        return dealt.select("n_nationkey", shown(f(*[F.col(f"x{i}") for i in range(len(inputs))])).alias("value"))

    return run


def _sql(cases: list[Case]) -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {quoted(c[-1])})" for i, c in enumerate(cases))
    return f"SELECT n_nationkey, value FROM nation JOIN (VALUES {values}) t(i, value) ON n_nationkey % {len(cases)} = i"


PAY = ("raw", "low", "high", "period", "currency")
QUOTED = ("raw", "low", "high", "currency", "period")
STATES = ("ca", "california", "il", "illinois", "pa", "georgia")
COUNTRIES = {"india": ("India", "IN", "+91"), "us": ("United States", "US", "+1"), "united states": ("United States", "US", "+1"), "united states of america": ("United States", "US", "+1"), "georgia": ("Georgia", "GE", "+995")}
CITY = ("city", "country", "code", "dial", "remote")
D = lambda c: dates.to_date(c)
JSON_PAIRS = "array<struct<key:string,value:string>>"
PLACES = "array<struct<address:struct<addressCountry:string,addressLocality:string>>>"
VALUES = "struct<absoluteValue:double,absoluteMonthlyValue:double>"

#: name: (function, cases); a case's last value is the result.
CASES: dict[str, tuple[Callable[..., Column], list[Case]]] = {
    "unescape_references": (text.unescape, [
        ("a &amp; b", "a & b"), ("&#8211;", "–"), ("&eacute;t&eacute;", "été"), ("&#x27;x&#x27;", "'x'"), ("&amp;lt;", "&lt;"), ("&notit;", "¬it;"), ("&copy 2026", "© 2026"), ("AT&T", "AT&T"), ("&#150;", "–"),
        ("&#0;", "\ufffd"), ("&", "&"), ("&&amp;&", "&&&"), ("&nosuch;", "&nosuch;"), ("&#x1F600;", "😀"), ("&hellip;&rsquo;", "…’"), (None, "-"), ("&#39;&quot;&#34;", "'\"\""), ("&ampx", "&x"),
    ]),
    "clean_texts": (text.clean_text, [(" a&amp;b \n c ", "a&b c"), (None, ""), ("x&nbsp;&nbsp;y", "x y"), ("caf&eacute;\t", "café"), ("&#8220;q&#8221;", "“q”")]),
    "inline_tags": (lambda c: text.strip_html(c, ""), [("a<b>b</b>", "ab"), ("<p>a</p><p>b</p>", "a b"), ("a<script>x</script>b", "a b"), ("x<br/>y", "x y"), (None, "")]),
    "page_texts": (text.html_to_text, [
        ("<h2>Pay</h2><p>Good</p>", "## Pay\nGood"), ("<ul><li>a</li><li>b</li></ul>", "- a\n\n- b"), ("<table><tr><td>a</td><td>b</td></tr></table>", "| a | b"), ('see <a href="http://x/?a=1&amp;b=2">here <b>now</b></a>.', "see here now [http://x/?a=1&b=2]."),
        ('<a href="#top">up</a>', "up"), ('a<a href="http://x"><img src="i"></a>b', "ab"), ("<figure><img src=x>pic</figure>t", "t"), ("<figure class=w><table><tr><th>k</th><td>v</td></tr></table></figure>", "| k | v"),
        ("a<br><br><br>b", "a\n\nb"), ("x<script>y</script>&amp;&nbsp;z", "x & z"), (None, ""),
    ]),
    "visible_texts": (text.visible_text, [
        ('a<div style="display:none">b</div>c', "a c"), ("a <b>c</b> <spa", "a c"), ("<style>p{}</style>x", "x"), ("a​b", "ab"), ("x < 3", "x < 3"), (None, ""), ("<span class=a style='x:y; display: none'>q</span>r", "r"),
    ]),
    "lines_of_text": (text.strip_per_line, [("<b>a</b>\n\n c ", "a\nc"), ("", ""), ("x&amp;y\n<i></i>\nz", "x&y\nz")]),
    "hard_cap": (lambda c: F.left(c, F.lit(5)), [("abcdefgh", "abcde"), ("ab", "ab"), ("", "")]),
    "folded_marks": (text.fold_diacritics, [("Épidémiologie", "Epidemiologie"), ("über", "uber"), ("ñandú", "nandu"), ("plain", "plain"), (None, "-")]),
    "titles_in_case": (text.title_case, [
        ("STAFF NURSE I", "Staff Nurse I"), ("NON-MALIGNANT HEMATOLOGY", "Non-Malignant Hematology"), ("HEAD OF QA AND ICU", "Head of QA and ICU"), ("PHD IN PUBLIC HEALTH", "PhD in Public Health"), ("McKinsey eCRF Lead", "McKinsey eCRF Lead"),
        ("OF MICE", "Of Mice"), ("IN-PATIENT/OUT-PATIENT (ICU)", "In-Patient/Out-Patient (ICU)"), (None, ""), ("(SENIOR) NURSE", "(senior) Nurse"), ("CT/MRI TECH", "CT/MRI Tech"),
    ]),
    "recased": (text.recase, [("SENIOR WRITER", "Senior Writer"), ("Senior WRITER", "Senior WRITER"), ("123", "123")]),
    "cleaned_titles": (text.clean_title, [
        ("Research Associate Job at IISER | Earn Upto ₹71,920/Month | Apply Now", "Research Associate Job at IISER"), ("Apply Online Now | Medical Writer at Cipla", "Medical Writer at Cipla"), ("Hiring Alert: Medical Writer at Cipla – Apply Online Now", "Medical Writer at Cipla"),
        ("Rs. 67,000/- p.m. Research Associate Jobs at JNCASR", "Research Associate Jobs at JNCASR"), ("Pharma Careers 2026", "Pharma Careers"), ("Apply Now", "Apply Now"), ("Cipla is Hiring! | Hurry up", "Cipla is Hiring"), (None, ""),
        ("Latest Clinical Research Jobs With Rs. 50,000 Salary | Apply", "Clinical Research Jobs"), ("Medical Coder | Don't miss it", "Medical Coder"),
    ]),
    "role_keys": (text.norm_key, [("  Senior   C++ Dev ", "senior c++ dev"), ("C#", "c#"), (None, ""), ("A\tB", "a b")]),
    "facet_keys": (text.norm_facet, [("R&D / Ops", "r and d ops"), (None, ""), ("Health &amp; Safety", "health and safety")]),
    "posting_ids": (lambda b, p: text.job_id(F.split(b, ","), p), [(" ,R1", "x/y_Z9", "R1"), ("", "/job/City/Title_R-77", "R-77"), ("", "/job/plain", "plain"), (" X 1 ", "a", "X 1")]),
    "requisition_ids": (lambda b, p: text.requisition_id(F.split(b, ","), p), [("Mumbai,Mumbai,R0029512", "x", "R0029512"), ("Pune", "/job/t_R-5", "R-5"), ("885928", "x", "885928"), ("", "/a/b", "b")]),
    "guid_ids": (text.guid_id, [("https://x/jobs/android-engineer-5243463048", "5243463048"), ("https://x/companies/acme/jobs/nurse/", "acme/nurse"), ("slug", "slug"), (None, "")]),
    "mail_addresses": (lambda c: listed(text.emails(c)), [("X@y.org x@Y.org z@y.org.", "X@y.org|z@y.org"), ("none", ""), (None, "")]),
    "page_targets": (lambda c: listed(text.links(c)), [
        ('<a href="http://a/?x=1&amp;y=2">a</a><a class=k href="http://a/?x=1&amp;y=2">b</a>', "http://a/?x=1&y=2"), ('<a href="#x">a</a><a href="mailto:a@b">m</a><a href=" /rel ">r</a>', "/rel"),
        ('<a href="https://www.facebook.com/p">f</a><a href="https://box.com/x.com">b</a><a href="//x.com/i">x</a>', "https://box.com/x.com"), (None, ""),
    ]),
    "credentials": (text.qualifications, [("MPH or Ph.D, MPH", "PhD, MPH"), ("", ""), ("B.Pharm / M.Pharm, life sciences", "B.Pharm, M.Pharm, Life Sciences"), ("Bachelor's degree in Nursing, RN", "RN, Bachelor's degree"), ("MBBS MBA MPH DVM BSN MSN RAC CCRA CPC", "MBBS, MPH, DVM, BSN, MSN, MBA, RAC, CCRA")]),
    "cut_epilogues": (lambda c: text.cut_epilogue(c, "Equal rights", 5, 20), [("Long text here. We back Equal rights for all", "Long text here."), ("Shr Equal rights", "Shr Equal rights"), (None, ""), ("No marker at all", "No marker at all")]),
    "routed_chips": (lambda c: fields(text.chips(F.split(c, ",")), "location", "job_type", "salary"), [("Lagos,Full Time,NGN 50,Remote", "Lagos|Full Time|NGN 50"), ("", "||"), ("Confidential,Contract", "|Contract|Confidential")]),
    "remote_texts": (lambda a, b: text.is_remote(a, b), [("Remote, India", "", "true"), ("x", "Home-Based", "true"), ("Remotely", "office", "false"), (None, "work  from home", "true"), (None, None, "false")]),
    "other_language": (text.looks_non_english, [("le la les des une pour dans el los", "true"), ("der und für eine nicht werden x und y der", "true"), ("the cat sat on the mat", "false"), (None, "false"), ("le la les des", "false")]),
    "cjk_texts": (text.looks_cjk, [("日本語の求人", "true"), ("plain", "false"), (None, "false"), ("Office in 東京 for a long English text that goes on", "false")]),
    "short_texts": (lambda c: gates.too_short(c, 4), [("abc", "true"), ("abcd", "false"), (None, "true")]),
    "iso_dates": (dates.iso_date, [("2026-02-31T00:00", "2026-02-31"), ("on 2026-01-01", ""), (None, ""), (" 2026-01-05", "2026-01-05")]),
    "ages": (lambda c: dates.ago(c, as_of()), [("2 weeks ago", "2026-08-18"), ("1 month ago", "2026-08-02"), ("30 hours ago", "2026-08-31"), ("an hour ago", "2026-09-01"), ("odd", "-"), ("a year ago", "2025-09-01"), ("yesterday", "2026-08-31")]),
    "newest_days": (lambda c: dates.newest_possible(c, as_of()), [("1 month ago", "2026-08-04"), ("30 hours ago", "2026-09-01"), ("2 years ago", "2024-09-01"), ("3 days ago", "2026-08-29"), (None, "-")]),
    "epoch_days": (lambda ms, s: F.concat_ws("|", shown(dates.epoch_ms(ms)), shown(dates.epoch_ms(ms, "Asia/Kolkata")), shown(dates.epoch_s(s))), [("1788289200000", "1788220800", "2026-09-01|2026-09-02|2026-09-01"), ("0", "-5", "-|-|-"), ("x", "", "-|-|-")]),
    "object_ids": (dates.object_id_date, [(f"{1788307200:x}" + "0" * 16, "2026-09-02"), ("xyz", "-"), (None, "-"), ("00000000" + "f" * 16, "-")]),
    "feed_dates": (dates.rfc822, [("Tue, 01 Sep 2026 10:00:00 GMT", "2026-09-01"), ("1 Sep 2026 10:00:00 +0530", "2026-09-01"), ("nonsense", "-"), (None, "-")]),
    "card_dates": (lambda c: dates.card_date(c, F.lit("2026-01-05").cast("date")), [("28 Dec", "2025-12-28"), ("6 Jan", "2026-01-06"), ("7 Jan", "2026-01-07"), ("8 Jan", "2025-01-08"), ("x", "-")]),
    "deadlines": (dates.deadline, [("3/4/2026", "2026-04-03"), ("14 Sep 2026", "2026-09-14"), ("14-September-2026", "2026-09-14"), ("till 2026-09-14 noon", "2026-09-14"), ("99/4/2026", ""), ("3 Foo 2026", ""), (None, ""), ("31.02.2026", "2026-02-31")]),
    "human_dates": (lambda c: F.concat_ws("|", dates.human_date(c), shown(dates.page_date(c)), shown(dates.slug_date(c))), [("Closes 1 September 2026", "2026-09-01|2026-09-01|-"), ("31 February 2026", "2026-02-31|-|-"), ("/ads-2023-10-4-001", "|-|2023-10-04"), (None, "|-|-")]),
    "islamic_days": (lambda y, m, d: dates.hijri(y.cast("int"), m.cast("int"), d.cast("int")), [("1446", "1", "1", "2024-07-08"), ("1299", "1", "1", "-"), ("1445", "13", "1", "-"), ("1444", "9", "31", "-"), ("1601", "1", "1", "-")]),
    "date_tokens": (dates.token_date, [("10.10.2023", "2023-10-10"), ("10.10.2023 H", "-"), ("31/02/2023", "-"), (None, "-"), ("1/1/1446", "2024-07-08")]),
    "still_active": (lambda c, p, s: dates.is_active(D(c), D(p), s, as_of()), [
        ("", "", "Still Running", "true"), ("2026-12-01", "", "Expired", "false"), ("2026-09-01", "", "", "true"), ("2026-08-31", "2026-08-31", "", "false"), ("", "2026-08-02", "", "true"), ("", "2026-08-01", "", "false"), ("", "", "", "false"),
        ("", "", "Inactive", "false"), ("", "", "running", "true"), ("", "2026-08-30", "Closed", "false"), (None, None, None, "false"),
    ]),
    "state_times": (lambda c: F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), dates.state_time(c).cast("timestamp_ntz")), "yyyy-MM-dd HH:mm:ss"), [("2026-09-01T10:00:00", "2026-09-01 04:30:00"), ("2026-09-01T10:00:00+00:00", "2026-09-01 10:00:00"), ("2026-09-01T10:00:00+05:30", "2026-09-01 04:30:00"), ("x", "-"), (None, "-")]),
    "time_cutoffs": (lambda last, now: dates.time_cutoff(last.try_cast("timestamp_ntz"), now.cast("timestamp_ntz")), [("2026-08-30 10:00:00", "2026-09-01 00:00:00", "2026-08-28 10:00:00"), (None, "2026-09-01 00:00:00", "2026-08-25 00:00:00"), ("x", "2026-09-08 06:00:00", "2026-09-01 06:00:00")]),
    "day_cutoffs": (lambda n: F.concat_ws("|", *[shown(c) for c in (dates.cutoff(D(n), as_of()), dates.cutoff(D(n), as_of(), window=None), dates.cutoff(D(n), as_of(), since="2026-01-01"), dates.cutoff(D(n), as_of(), rolling=30))]), [
        ("2026-08-20", "2026-08-18|2026-08-18|2026-01-01|2026-08-02"), ("", "2026-08-25|-|2026-01-01|2026-08-02"),
    ]),
    "url_months": (lambda c: gates.url_month_before(c, as_of()), [("august-2026/x", "true"), ("september-2026/x", "false"), ("august/x", "false"), ("foo-2020/x", "false"), (None, "false"), ("december-2025/y", "true")]),
    "gates_of_dates": (lambda d, c: F.concat_ws("|", *[shown(x) for x in (gates.recent_or_unknown(D(d), D(c)), gates.recent(D(d), D(c)), gates.recent(D(d), gates.loose_cutoff(D(c), 3)))]), [
        ("2026-09-01", "2026-09-01", "true|true|true"), ("2026-08-30", "2026-09-01", "false|false|true"), ("", "2026-09-01", "true|false|false"), ("2026-08-01", "", "true|true|true"), ("", "", "true|false|false"),
    ]),
    "announcements": (lambda t, b: fields(gates.announcement(t, b), "is_job", "review"), [
        ("Tender for vacancies", "job application", "false|false"), ("Job vacancies", "", "true|false"), ("Hiring nurses", "Training program", "true|true"), ("Hiring nurses", "Training program, apply for this job", "true|false"),
        ("News", "vacancies in the ministry", "true|true"), ("Scholarship offers", "", "true|true"), ("News", "", "false|false"), (None, None, "false|false"),
    ]),
    "skipped_listings": (gates.skippable, [("Research Associate (Fixed Term)", "physics", "true"), ("Research Associate", "Faculty of Health", "false"), ("Research Fellow in Islamic Art", "", "false"), ("Senior Research Assistant x2", "", "true"), ("Lecturer", "", "false"), (None, None, "false")]),
    "recruitment_notices": (gates.recruitment_notice, [
        ("Vacancy notice", "http://x/a", "true"), ("Survey report", "http://x/a", "false"), ("Recruitment Rules Guidelines", "http://x/a", "false"), ("Applications are invited: survey officer", "http://x/a", "true"), ("PDF", "http://x/walk-in.pdf", "true"), (None, None, "false"),
    ]),
    "prescreens": (lambda s, t: F.concat_ws("|", *[shown(gates.prescreened(s.cast("boolean"), t, "(?i)clinical", e)) for e in (True, False)]), [("true", "x", "true|true"), ("false", "Clinical x", "true|true"), ("false", "x", "false|true"), ("false", None, "false|true")]),
    "blocklists": (lambda c: gates.listed(c, ("Acme Jobs",)), [(" ACME jobs ", "true"), ("acme", "false"), (None, "false")]),
    "countries": (location.country_name, [("United States of America", "United States"), ("UK", "United Kingdom"), ("India", "India"), (None, "")]),
    "cities": (lambda c: location.city(c, F.lit("India"), F.lit("IN")), [("Hyderabad - TS - IN", "Hyderabad"), ("2 Locations", ""), ("India, Remote, Pune", "Pune"), (None, "")]),
    "last_cities": (lambda c: location.city(c, F.lit("India"), F.lit("IN"), last=True), [("India, Remote, Pune", "Pune"), ("Pune, Mumbai, IN", "Mumbai"), (None, "")]),
    "peeled_locations": (lambda c: location.peel(c, ("Virtual", "United States", "United States of America")), [("Virtual United States Michigan", "Michigan"), ("united states of america - Ohio", "Ohio"), ("Virtually", "Virtually"), ("Virtual", ""), ("Ohio, Virtual", "Ohio, Virtual"), (None, "-")]),
    "localities": (lambda c: fields(location.locality(c, STATES, COUNTRIES), *CITY), [
        ("India, Chennai", "Chennai|India|IN|+91|false"), ("United States of America", "|United States|US|+1|false"), ("California", "California|United States|US|+1|false"), ("Chicago, IL", "Chicago|United States|US|+1|false"), ("US, Blue Bell (ICON)", "Blue Bell|United States|US|+1|false"),
        ("Regional United States (PRA)", "|United States|US|+1|true"), ("Atlantis", "Atlantis||||false"), ("X, Y", "X, Y||||false"), ("Georgia, Tbilisi", "Tbilisi|Georgia|GE|+995|false"), ("Georgia", "Georgia|United States|US|+1|false"), ("Remote, India", "Remote, India||||true"), (None, "||||false"),
    ]),
    "first_cities": (lambda c: fields(location.first_city(c, {"qatar": "Qatar"}), "city", "country"), [("Nashik, Pune (All Areas)", "Nashik|India"), ("Qatar", "Qatar|Qatar"), (None, "|India"), ("Pune (All Areas), X", "Pune|India")]),
    "split_places": (lambda c: fields(location.split_location(c, ("Pakistan",), {"PK": "Pakistan"}, {"Nairobi": "Kenya"}), "city", "country", "remote"), [("Islamabad | PK", "Islamabad|Pakistan|false"), ("Remote | Nairobi", "Nairobi|Kenya|true"), (None, "||false"), ("Home-based", "||true")]),
    "linked_places": (lambda c: listed(F.transform(nested.places(F.from_json(c, PLACES)), lambda p: F.concat_ws(":", p["code"], p["city"]))), [
        ('[{"address":{"addressCountry":"in","addressLocality":"UNAVAILABLE"}},{"address":{"addressCountry":null,"addressLocality":"Pune"}}]', "IN:|:Pune"), ('[{"address":{}}]', ""), ("[]", ""),
    ]),
    "remote_cities": (location.city_or_remote, [("", "Remote - US", "Remote"), ("Pune", "Remote", "Pune"), ("", "office", ""), (None, "home based", "Remote")]),
    "job_types": (lambda t, r: location.job_type(t, r.cast("boolean")), [("Part time", "false", "part_time"), ("Full time", "true", "remote"), (None, "false", "full_time")]),
    "hinted_job_types": (location.hinted_job_type, [("Writer WFH", "hybrid", "remote"), ("Hybrid role", "part time", "hybrid"), ("Part-time nurse", "", "part_time"), ("Nurse", None, "full_time"), ("x", "Work From Home", "remote")]),
    "professions": (location.profession, [("Staff Nurse / Doctor", "nurses"), ("Pharmacist", "pharmacists"), ("Medical Officer (MBBS)", "doctors"), ("Consultant", "non_clinical"), (None, "non_clinical"), ("Nurses", "non_clinical")]),
    "integers": (money.int_text, [("2.7", "2"), ("-2.7", "-2"), ("x", ""), (None, ""), ("1e3", "1000"), ("NaN", "")]),
    "club_salaries": (lambda c: fields(money.annual_lakh(c), *PAY), [
        ("67,000/- p.m.", "67,000/- p.m.|67000|67000|per_month|INR"), ("₹3.5 - 5 LPA", "₹3.5 - 5 LPA|350000|500000|per_annum|INR"), ("INR 20,000 - 30,000", "INR 20,000 - 30,000|20000|30000|per_month|INR"), ("EUR 5,000", "EUR 5,000|-|-|-|-"), ("As per norms", "As per norms|-|-|-|-"),
        ("$90k - 80k", "$90k - 80k|80000|90000|per_month|USD"), ("Rs 4,50,000", "Rs 4,50,000|450000|450000|per_annum|INR"), ("USD 120,000 per year", "USD 120,000 per year|120000|120000|per_annum|USD"), (None, "-"), ("Stipend 12000", "Stipend 12000|12000|12000|per_month|INR"),
    ]),
    "monthly_figures": (lambda c: fields(money.monthly(c), "raw", "low", "high", "period"), [
        ("Rs 4.0  - 4.5 Lakh/Yr", "Rs 4.0 - 4.5 Lakh/Yr|33333|37500|Yr"), ("< Rs 50,000  - 2.5 Lakh/Yr", "< Rs 50,000 - 2.5 Lakh/Yr|4167|20833|Yr"), ("[Salary Hidden]", "Not Disclosed|-|-|"), ("Rs 20,000 - 30,000", "Rs 20,000 - 30,000|-|-|"), ("20000/Mo", "20000/Mo|20000|20000|Mo"), (None, "Not Disclosed|-|-|"),
    ]),
    "structured_pairs": (lambda a, b, h: fields(money.pair(a, b, h.cast("boolean")), "low", "high"), [("5", "3", "false", "3|5"), ("0", "7", "false", "7|7"), ("", "", "false", "-|-"), ("1", "2", "true", "-|-")]),
    "yearly_or_monthly": (lambda a, b, h, c: fields(money.yearly_or_monthly(F.from_json(a, VALUES), F.from_json(b, VALUES), h.cast("boolean"), c), "raw", "low", "high", "period", "currency", "hidden"), [
        ('{"absoluteValue":450000}', '{"absoluteValue":600000}', "false", "INR", "INR 450000-600000 P.A.|37500|50000|Yr|INR|false"), ('{"absoluteMonthlyValue":20000}', '{"absoluteMonthlyValue":25000}', "true", "", "INR 20000-25000 P.M.|20000|25000|Mo|INR|true"),
        ("{}", "{}", "false", "USD", "Not Disclosed|-|-|||false"), ('{"absoluteValue":120000,"absoluteMonthlyValue":11000}', "{}", "false", "USD", "USD 120000-120000 P.A.|11000|10000|Yr|USD|false"),
    ]),
    "stated_salaries": (lambda a, b, c, p: fields(money.stated_salary(a, b, c, p), *QUOTED), [
        ("120000", "150000", "USD", "annual", "USD 120000 - 150000 per annum|120000|150000|USD|per_annum"), ("None", "None", "None", "annual", "Not Disclosed|-|-||"), ("9", "None", "None", "odd", "? 9 - 9|9|9||"), ("5", "3", "EUR", "Hourly", "EUR 3 - 5 per hour|3|5|EUR|per_hour"),
    ]),
    "listed_salaries": (lambda k, a, b, c, p: fields(money.listed_salary(k.cast("int"), a, b, c.cast("int"), p.cast("int")), *QUOTED), [
        ("1", "41000", "42000", "1", "5", "GBP 41000 - 42000 per annum|41000|42000|GBP|per_annum"), ("64", "41000", "42000", "1", "5", "Not Disclosed|-|-||"), ("1", "0", "9", "1", "5", "Not Disclosed|-|-||"), ("1", "18.4", None, "2", "9", "? 18 - 18|18|18||"), (None, "9", "0", "1", "1", "GBP 9 - 9 per hour|9|9|GBP|per_hour"),
    ]),
    "object_salaries": (lambda c: fields(money.object_salary(F.from_json(c, "struct<type:string,minAmount:double,maxAmount:double>")), "low", "high", "period"), [('{"type":"Yearly","minAmount":240000,"maxAmount":0}', "20000|20000|P.A"), ('{"type":"0"}', "-"), ('{"type":"monthly","minAmount":5,"maxAmount":3}', "3|5|P.M")]),
    "mixed_units": (lambda c: fields(money.ctc_range(c), "low", "high"), [("13.0000-15.0000", "1300000|1500000"), ("400000-200000", "200000|400000"), ("0-0", "-"), (None, "-"), ("5", "-")]),
    "display_salaries": (lambda c: fields(money.display_salary(c), *QUOTED), [("£41,000 - £42,000 per annum", "£41,000 - £42,000 per annum|41000|42000|GBP|per_annum"), ("18.85 per hour", "18.85 per hour|19|19||per_hour"), ("Competitive salary", "Competitive salary|-|-||"), (None, "Not Disclosed|-|-||")]),
    "monthly_texts": (lambda c: fields(money.salary_text(c), *QUOTED), [("30000 - 40000 AED", "30000 - 40000 AED|30000|40000|AED|per_month"), ("$5,000 - $4,000", "$5,000 - $4,000|4000|5000|USD|per_month"), ("Not Specified", "-"), ("AED", "-"), (None, "-")]),
    "export_blocks": (lambda a, b, c, p: F.concat_ws("|", *money.export_block(F.nullif(a, F.lit("")), F.nullif(b, F.lit("")), c, p)), [("5", "6", "INR", "per_month", "5|6|per_month|INR"), ("5", "", "USD", "per_annum", "5|5|per_annum|USD"), ("5", "6", "EUR", "per_month", "Not Disclosed|||"), ("", "", "INR", "per_month", "Not Disclosed|||"), ("5", "6", "INR", "", "Not Disclosed|||")]),
    "asked_years": (money.experience_years, [("at least 3+ years", "3"), ("minimum 45 years; 5 years of relevant experience", "5"), ("none", ""), (None, ""), ("Minimum of 2 - 4 years", "2")]),
    "experience_ranges": (lambda c: fields(money.experience_range(c), "low", "high"), [("2-5 Years", "2|5"), ("Freshers", "0|0"), ("Min 3 years, 2 openings", "3|-"), ("5-2 yrs", "2|5"), ("45 years", "-|-"), ("(2026 pass-outs)", "-|-"), ("0 Years", "0|0"), ("Fresher or 2 years", "0|2"), (None, "-|-"), ("1.5 to 3 years", "1|3")]),
    "experience_spans": (lambda c: fields(money.experience_span(c), "low", "high"), [("1 to 5 Yrs", "1|5"), ("0 Yrs", "0|0"), ("x", "-|-"), (None, "-|-")]),
    "experience_sentences": (lambda c: fields(money.experience_in_context(c), "raw", "low", "high"), [("Ten days. Two posts, 9 year old. Minimum 5 to 2 years. 7 years of experience", "Minimum 5 to 2 years.|2|5"), ("at least (3)+ years", "at least (3)+ years|3|-"), ("experience", "-"), (None, "-")]),
    "least_years": (money.least_experience, [
        ("2 year contract, minimum 5 years", "5"), ("Minimum 1 year of internship/training and then in the wards. Minimum 3 years of experience", "3"), ("at least 4 years; 2 years of lab experience", "2"), ("25 years of age", "-"), (None, "-"), ("not less than 6-8 yrs", "6"), ("min. 50 years", "-"),
    ]),
    "stated_minima": (money.stated_minimum, [("a minimum of two years, minimum 4 years", "2"), ("Minimum 10+ years", "10"), ("minimum 0 years", "-"), (None, "-")]),
    "listish_texts": (lambda c: listed(nested.list_text(c)), [("['United States', 'India']", "United States|India"), ("a, b", "a|b"), (None, ""), ('["x"]', "x")]),
    "typed_elements": (lambda c: nested.typed(F.from_json(c, "array<struct<type:string,label:string>>"), "salary"), [('[{"type":"experience","label":"1"},{"type":"salary","label":"5 LPA"}]', "5 LPA"), ("[]", ""), ('[{"type":"x","label":"y"}]', "")]),
    "flex_fields": (lambda c: F.concat_ws("|", *[shown(F.try_element_at(f(F.from_json(c, JSON_PAIRS)), F.lit("a"))) for f in (nested.last_wins, nested.first_wins)]), [('[{"key":"a","value":"1"},{"key":"a","value":"3"}]', "3|1"), ('[{"key":"b","value":"1"}]', "-|-"), ("[]", "-|-")]),
    "listified": (lambda c: listed(nested.listify(c)), [('["a","b"]', "a|b"), ("x", "x"), (None, ""), ("null", ""), ('[{"k":1}]', '{"k":1}')]),
    "resolved_nodes": (lambda s, g: F.concat_ws("|", *[shown(F.try_element_at(nested.resolved(F.from_json(s, "map<string,string>"), F.from_json(g, "array<map<string,string>>")), F.lit(k))) for k in ("@id", "name", "x")]), [
        ('{"@id":"1","name":"stub","x":"own"}', '[{"@id":"1","name":"full"}]', "1|full|own"), ('{"@id":"2","name":"stub"}', '[{"@id":"1","name":"full"}]', "2|stub|-"), ('{"name":"n"}', "[]", "-|n|-"),
    ]),
    "found_nodes": (lambda g: nested.resolve_ref(F.from_json(g, "array<struct<id:string,name:string>>"), F.lit("1"))["name"], [('[{"id":"1","name":"a"},{"id":"2","name":"b"}]', "a"), ("[]", "-")]),
    "embedded_states": (nested.embedded_json, [('<script id="__NEXT_DATA__" x>{"a":1}</script>', '{"a":1}'), ("<script>x</script>", "")]),
    "flight_states": (nested.flight_text, [('<script>self.__next_f.push([1,"a\\"b"])</script><script>self.__next_f.push([1,"\\u0063"])</script>', 'a"bc'), ("x", ""), ('self.__next_f.push([0,"q"])', "")]),
    "balanced_states": (lambda h: nested.balanced(h, F.lit("data=")), [('x data= {"a":{"b":"}"}} y', '{"a":{"b":"}"}}'), ("data={", "-"), ('{"a":1}', "-"), (None, "-"), ('data={"k":"\\"{"}z', '{"k":"\\"{"}')]),
    "first_json_values": (lambda c: listed(nested.json_values(c)), [('{"a": 1} trailing', '{"a": 1}'), ('[{"b": 2}, 3]', '{"b": 2}'), ('{"@graph": [{"c": 3}, {"d": 4}]}', '{"c": 3}|{"d": 4}'), ("broken", ""), (None, "")]),
    "named_labels": (lambda c: nested.labels_of(F.split(c, ","), {"1": "b", "2": "a"}), [("1,2,9", "9, a, b"), ("2", "a")]),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(f, cases) for name, (f, cases) in CASES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: _sql(cases) for name, (_, cases) in CASES.items()}
