"""Row gates. Which way an unknown date goes is in the name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def recent_or_unknown(day: Column, cutoff: Column) -> Column:
    """Unknown days pass; with no cutoff all do."""
    return cutoff.isNull() | day.isNull() | (day >= cutoff)


def recent(day: Column, cutoff: Column) -> Column:
    """Unknown days fail, even with no cutoff; with no cutoff all known days pass."""
    return day.isNotNull() & (cutoff.isNull() | (day >= cutoff))


def month_before(year: Column, month: Column, cutoff: Column) -> Column:
    """A known (year, month) before the cutoff's."""
    return F.coalesce((year * 12 + month) < (F.year(cutoff) * 12 + F.month(cutoff)), F.lit(False))


def listed(x: Column, names: tuple[str, ...]) -> Column:
    """Exact match of the trimmed lower-case text."""
    return F.lower(F.trim(F.coalesce(x, F.lit("")))).isin(*[n.lower() for n in names])


def allowed(x: Column, allow: str, deny: str, strong: str | None = None) -> Column:
    """Matches allow and not deny, or matches strong whatever deny says."""
    t = F.coalesce(x, F.lit(""))
    ok = t.rlike(allow) & ~t.rlike(deny)
    return ok | t.rlike(strong) if strong else ok


def too_short(x: Column, least: int) -> Column:
    return F.length(F.coalesce(x, F.lit(""))) < least


def disposition(order: list[tuple[str, Column]]) -> Column:
    """The name of the first gate that stops a row, else kept. Sources order their gates
    differently, which changes counters but not what is kept."""
    out = F.lit("kept")
    for name, stops in reversed(order):
        out = F.when(stops, F.lit(name)).otherwise(out)
    return out


def loose_cutoff(cutoff: Column, margin: int) -> Column:
    """The cutoff of a pre-filter on days that may lack their year; the exact gate follows it."""
    return F.date_sub(cutoff, margin)


def url_month_before(x: Column, cutoff: Column) -> Column:
    """Whether an id like august-2026/... is of a month before the cutoff's; other ids never are."""
    from millrace.functions.dates import url_month

    m = url_month(x)
    return F.coalesce(month_before(m["year"], m["month"], cutoff), F.lit(False))


def prescreened(in_scope: Column, title: Column, rescue: str, enabled: bool = False) -> Column:
    """Whether a listing's detail is worth reading: its title is in scope or holds a rescue word. Off
    (all pass) unless enabled."""
    return in_scope | F.coalesce(title, F.lit("")).rlike(rescue) if enabled else F.lit(True)


#: Words of announcement titles that rule a vacancy out, and that make one.
DENIED_TITLES = (
    "tender", "bid", "procurement", "prequalification", "pre-qualification", "qualified companies", "qualified firms", "qualification phase", "e-consultation", "consultation results",
    "consultation on", "survey", "checks", "cheques", "forum", "conference", "hackathon", "healththon", "privatization", "expression of interest", "eoi", "business plan", "purchase plan",
    "budget", "surplus", "results of consultation", "showcase your brand",
)
ALLOWED_TITLES = ("vacanc", "vacant", "job", "jobs", "employment application", "recruit", "hiring", "appointment", "career", "posts for", "receiving applications", "seasonal staff", "resident dentist")
#: Fixed patterns: what a body says of applying, and of training to be reviewed.
APPLYING = r"employment application|job application|receiv(?:e|ing) (?:employment |job )?application|apply for this job|employment (?:portal|website)|recruitment portal|job opening|vacanc|appointment of|announces the availability of receiving"
TRAINING = r"training program|training track|registration for|scholarship|wa'?ed track|diploma program"


def announcement(title: Column, body: Column) -> Column:
    """struct(is_job, review): a denied word in the title ends it; an allowed one, or a body that speaks
    of applying or training, makes a job. Review where only the body tells, or where training is all it says."""
    from millrace.functions.text import clean_text

    t, b = F.lower(clean_text(title)), F.lower(clean_text(body))
    holds = lambda c, words: F.exists(F.array(*map(F.lit, words)), lambda w: c.contains(w))
    denied, named, asks = holds(t, DENIED_TITLES), holds(t, ALLOWED_TITLES), b.rlike(APPLYING)
    trains = t.rlike(TRAINING) | b.rlike(TRAINING)
    return F.struct((~denied & (named | asks | trains)).alias("is_job"), (~denied & F.when(named, trains & ~asks).otherwise(asks | trains)).alias("review"))


#: Fixed patterns: words of the field, and a research title that names no discipline.
HEALTH_SCOPE = r"(?i)health|medical|medicine|clinical|nursing|pharma|epidemiolog|biomed|psychiat|oncolog|immunolog|virol|microbiol|neurosci|dental|veterinary|physiolog|toxicol|nutrition|life science|biostatist"
RESEARCH_TITLE = r"(?iU)^(?:senior |postdoctoral )?research (?:associate|assistant|fellow)s?\b"
#: Words behind such a title that still name none.
TITLE_FILLER = ("fixed", "term", "full", "part", "time", "fte", "x", "post", "posts", "position", "positions", "vacancy", "vacancies", "ref", "grade", "maternity", "cover", "months", "month", "years", "year")


def skippable(title: Column, card: Column) -> Column:
    """Whether a listing needs no look: a bare research title, and no word of the field in title or card."""
    from millrace.functions.text import clean_text

    t = clean_text(title)
    rest = F.regexp_extract_all(F.lower(F.regexp_replace(t, RESEARCH_TITLE, "")), F.lit("[a-z]+"), F.lit(0))
    bare = t.rlike(RESEARCH_TITLE) & F.forall(rest, lambda w: w.isin(*TITLE_FILLER))
    return bare & ~F.concat_ws(" ", title, card).rlike(HEALTH_SCOPE)


#: Fixed patterns: recruitment notices, documents, and what makes a document a notice all the same.
RECRUITING = (
    r"(?i)vacanc|recruit|walk[\s-]?in|applications?\s+(?:are\s+)?invited|engagement\s+of|hiring\s+of|advertisement\s+for\s+(?:the\s+)?post|contractual\s+(?:post|position|engagement)"
    r"|job\s+opening|expression\s+of\s+interest\s+for\s+(?:individual\s+)?consultant"
)
DOCUMENTS = r"(?i)guideline|training\s+module|operational|report|newsletter|minutes|curriculum|compendium|factsheet|survey|framework|policy"
INVITING = r"(?i)applications?\s+(?:are\s+)?invited|walk[\s-]?in"


def recruitment_notice(label: Column, url: Column) -> Column:
    """allowed() on a link's label and its URL's path."""
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    t = F.concat_ws(" ", F.coalesce(label, F.lit("")), path)
    return t.rlike(RECRUITING) & allowed(t, RECRUITING, DOCUMENTS, INVITING)
