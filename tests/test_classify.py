"""The classifier kernel over small tables."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.lexicon import Lexicon, phrases, subcategories_from_markdown
from millrace.operators.classify import classify

KEYWORDS = """
## Category: Non Clinical

### 1. Clinical Data Management

**Job titles:** Clinical Data Manager, Clinical Data Analyst (CDA)

**Strong skill keywords:** Medidata Rave, EDC, CDISC, SDTM

**Weak skill keywords:** clinical trials, GCP

## Category: Public Health

### 1. Epidemiology

**Job titles:** Epidemiologist

**Strong skill keywords:** outbreak investigation, disease surveillance, contact tracing

**Weak skill keywords:** epidemiology
"""
CASES = [
    # title, skills, description, in_scope, category, sub_category, family, review, veto
    ("Clinical Data Manager", "", "", True, "Non Clinical", "Clinical Data Management", "Clinical Data Management", False, ""),
    ("Staff Nurse", "clinical research", "", False, "", "", "", False, "Staff Nurse"),
    ("Pharmacovigilance Associate", "drug safety", "", True, "Non Clinical", "Pharmacovigilance", "Pharmacovigilance", False, ""),
    ("Meal Coordinator", "", "", False, "", "", "", False, ""),
    ("MEAL Officer", "", "", True, "Public Health", "", "Public Health", True, ""),
    ("Analyst", "", "we support clinical research", False, "", "", "", False, ""),
    ("Analyst", "", "clinical research, clinical trials and GCP", True, "Non Clinical", "Clinical Research", "Clinical Research", False, ""),
    ("Analyst", "", "clinical research clinical research Clinical Research", False, "", "", "", False, ""),
    ("Analyst", "", "x" * 4000 + " clinical research clinical trials gcp", False, "", "", "", False, ""),
    ("Research Associate in Islamic Art", "", "", False, "", "", "", False, ""),
    ("Research Coordinator, Asthma Centre", "", "", True, "Non Clinical", "Clinical Research", "Clinical Research", True, ""),
    ("Analyst", "", "epidemiology public health malaria hiv vaccination", False, "", "", "", False, ""),
    ("Epidemiologist", "", "", True, "Public Health", "Epidemiology", "Public Health", False, ""),
    ("Scientist", "drug safety, EDC, CDISC", "", True, "Non Clinical", "Clinical Data Management", "Clinical Data Management", False, ""),
    ("Counsel, Regulatory Affairs", "", "", True, "Non Clinical", "Regulatory Affairs", "Regulatory Affairs", True, ""),
    (None, None, None, False, "", "", "", False, ""),
    ("Paravet traveller", "", "", False, "", "", "", False, ""),
]


@pytest.fixture(scope="module")
def lexicon():
    return Lexicon.roles(subcategories_from_markdown(KEYWORDS))


def test_cases(spark, lexicon):
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(CASES)], "i int, title string, skills string, description string")
    got = df.select("i", classify(F.col("title"), F.col("skills"), F.col("description"), lexicon).alias("v")).select("i", "v.*").orderBy("i").collect()
    for r, c in zip(got, CASES, strict=True):
        assert (r.in_scope, r.category, r.sub_category, r.role_family, r.needs_review, r.vetoed_by) == c[3:], c


def test_scores_and_ties(spark, lexicon):
    df = spark.createDataFrame([("Medical Writer, Clinical Research", "tmf", "tmf")], "t string, s string, d string")
    v = df.select(classify(F.col("t"), F.col("s"), F.col("d"), lexicon).alias("v")).first().v
    assert v.family_scores == "Medical Writer=5;Clinical Research=5;TMF=3" and v.matched_in == "title" and v.family_confidence == "high"


def test_repetition_changes_nothing(spark, lexicon):
    df = spark.createDataFrame([(k, "drug safety " * k) for k in range(1, 6)], "k int, d string")
    got = {r.v.family_scores for r in df.select(classify(F.lit("Pharmacovigilance"), F.lit(""), F.col("d"), lexicon).alias("v")).collect()}
    assert got == {"Pharmacovigilance=6"}


def test_lexicon_of_json(spark):
    lex = Lexicon.from_json(json.dumps({"families": [{"name": "A", "pattern": "a+"}], "veto": phrases(["b c"])}))
    df = spark.createDataFrame([("aa",), ("x b-c",), ("ART in particular",)], "t string")
    got = [r.v for r in df.select(classify(F.col("t"), F.lit(""), F.lit(""), lex).alias("v")).collect()]
    assert [g.in_scope for g in got] == [True, False, True] and got[1].vetoed_by == "b-c"
