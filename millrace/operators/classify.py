"""The classifier: a weighted, ordered lexicon compiled into one Column, without UDFs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.lexicon import Lexicon, SubCategory

#: Case-insensitive and Unicode-aware; only \n ends a line for the dot.
FLAGS = "(?iuUd)"


def matches(text: Column, pattern: str) -> Column:
    """Distinct whole matches, lower-cased."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(FLAGS + pattern), F.lit(0)), lambda m: F.lower(m)))


def hits(text: Column, pattern: str | None) -> Column:
    return F.size(matches(text, pattern)) if pattern else F.lit(0)


def _fields(title: Column, skills: Column, description: Column, lexicon: Lexicon) -> dict[str, Column]:
    none = F.lit("")
    return {"title": F.coalesce(title, none), "skills": F.coalesce(skills, none), "description": F.left(F.coalesce(description, none), F.lit(lexicon.scan_chars))}


def _all_like(values: Column, pattern: str) -> Column:
    return F.forall(values, lambda m: m.rlike(pattern))


def veto(title: Column, skills: Column, lexicon: Lexicon) -> Column:
    """The first veto phrase in title or skills, as written, else ""."""
    if not lexicon.veto:
        return F.lit("")
    return F.regexp_extract(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(skills, F.lit(""))), FLAGS + f"({lexicon.veto})", 1)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _best(rows: Column) -> Column:
    """The first of an array of structs in their natural order, null if there is none."""
    return F.try_element_at(F.array_sort(rows), F.lit(1))


def sub_category(title: Column, skills: Column, description: Column, lexicon: Lexicon) -> Column:
    """struct(category, name, basis) or null: by title, else by strong keywords, weak ones break ties."""
    kind = "struct<category:string,name:string,basis:string>"
    if not lexicon.subcategories:
        return F.lit(None).cast(kind)
    f = _fields(title, skills, description, lexicon)
    rest = F.concat(f["skills"], F.lit(" \n "), f["description"])

    def ranked(count: Callable[[SubCategory], Column], tie: Callable[[SubCategory], Column]) -> Column:
        return F.array(*[
            F.struct((-count(s)).alias("h"), (-tie(s)).alias("w"), F.lit(i).alias("i"), F.lit(s.category).alias("category"), F.lit(s.name).alias("name"))
            for i, s in enumerate(lexicon.subcategories)
        ])

    def named(rows: Column, basis: str) -> Column:
        return _let(_best(rows), lambda x: F.when(x.isNotNull(), F.struct(x["category"].alias("category"), x["name"].alias("name"), F.lit(basis).alias("basis"))))

    first = named(F.filter(ranked(lambda s: hits(f["title"], s.titles), lambda s: F.lit(0)), lambda x: x["h"] < 0), "title")
    second = named(F.filter(ranked(lambda s: hits(rest, s.strong), lambda s: hits(rest, s.weak)), lambda x: x["h"] <= -lexicon.least_strong), "skills")
    return F.coalesce(first, second)


def family_rows(title: Column, skills: Column, description: Column, lexicon: Lexicon) -> Column:
    """array<struct(score negated, place, name, fields, generic)> of the families that are kept."""
    f = _fields(title, skills, description, lexicon)
    context = f["title"].rlike(FLAGS + lexicon.context) if lexicon.context else F.lit(True)
    found = F.array(*[F.struct(*[matches(f[n], fam.pattern).alias(n) for n, _ in lexicon.weights]) for fam in lexicon.families])
    fixed = F.array(*[
        F.struct(F.lit(i).alias("place"), F.lit(x.name).alias("name"), F.lit(x.least).alias("least"), F.lit(x.needs_title_or_skills).alias("strict"), F.lit(x.generic).cast("string").alias("like"))
        for i, x in enumerate(lexicon.families)
    ])

    def scored(m: Column, x: Column) -> Column:
        score = sum((F.size(m[n]) * w for n, w in lexicon.weights), F.lit(0))
        fields = F.filter(F.array(*[F.when(F.size(m[n]) > 0, F.lit(n)) for n, _ in lexicon.weights]), lambda v: v.isNotNull())
        everything = F.flatten(F.array(*[m[n] for n, _ in lexicon.weights]))
        generic = F.lit(False)
        for p in sorted({x.generic for x in lexicon.families if x.generic}):
            generic = F.when(x["like"] == p, _all_like(everything, FLAGS + p)).otherwise(generic)
        return F.struct((-score).alias("score"), x["place"].alias("place"), x["name"].alias("name"), fields.alias("fields"), generic.alias("generic"), x["least"].alias("least"), x["strict"].alias("strict"))

    kept = lambda x: (-x["score"] >= x["least"]) & ~(x["strict"] & (x["fields"] == F.array(F.lit("description")))) & (~x["generic"] | context)
    return F.array_sort(F.filter(F.zip_with(found, fixed, scored), kept))


def classify(title: Column, skills: Column, description: Column, lexicon: Lexicon) -> Column:
    """The verdict struct (schema.VERDICT). A list of skills is joined by " , " before.

    A veto ends it. The family with the highest score wins, precedence breaks ties. A sub-category
    that is found gives the category even where the family disagrees; a coarse family without one
    keeps its own name as category, a blank sub-category and needs review; any other family is
    its own sub-category. Null fields are empty. Each pattern is matched once a row.
    """
    other = F.coalesce(title, F.lit("")).rlike(FLAGS + lexicon.other_profession) if lexicon.other_profession else F.lit(False)
    families = _let(veto(title, skills, lexicon), lambda v: F.struct(v.alias("blocked"), F.when(v == "", family_rows(title, skills, description, lexicon)).alias("rows")))
    kind = "struct<category:string,name:string,basis:string>"

    def parts(x: Column) -> Column:
        found = F.coalesce(F.size(x["rows"]) > 0, F.lit(False))
        return F.struct(
            x["blocked"].alias("blocked"), x["rows"].alias("rows"), F.try_element_at(x["rows"], F.lit(1)).alias("winner"),
            F.when(found, sub_category(title, skills, description, lexicon)).otherwise(F.lit(None).cast(kind)).alias("sub"), (found & other).alias("other"), found.alias("in_scope"),
        )

    def verdict(x: Column) -> Column:
        none, winner, sub, score = F.lit(""), x["winner"], x["sub"], -x["winner"]["score"]
        coarse = winner["name"].isin(*lexicon.coarse) if lexicon.coarse else F.lit(False)
        when = lambda y: F.when(x["in_scope"], y).otherwise(none)
        review = x["other"] | winner["generic"] | (sub.isNull() & coarse)
        return F.struct(
            x["in_scope"].alias("in_scope"),
            when(F.coalesce(sub["category"], F.when(coarse, winner["name"]).otherwise(F.lit(lexicon.default_category)))).alias("category"),
            when(F.coalesce(sub["name"], F.when(coarse, none).otherwise(winner["name"]))).alias("sub_category"),
            when(F.coalesce(sub["basis"], F.when(coarse, none).otherwise(F.lit("family")))).alias("sub_category_basis"),
            when(winner["name"]).alias("role_family"),
            (x["in_scope"] & F.coalesce(review, F.lit(False))).alias("needs_review"),
            x["blocked"].alias("vetoed_by"),
            when(F.array_join(F.transform(x["rows"], lambda r: r["name"]), "|")).alias("all_families"),
            when(F.array_join(F.transform(x["rows"], lambda r: F.concat_ws("=", r["name"], (-r["score"]).cast("string"))), ";")).alias("family_scores"),
            when(F.when(score >= 5, "high").when(score >= 3, "medium").otherwise("low")).alias("family_confidence"),
            when(F.array_join(winner["fields"], "|")).alias("matched_in"),
        )

    return _let(_let(families, parts), verdict)
