"""URL filters: given host and path rules first, then association rules from labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import ROW, materialize, with_row_key

#: Fixed values: (verdict, host, path) of the given rules.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
BAD = "label:bad"
#: Mined rules above this number are an error (raise the support); the index is broadcast.
MAX_RULES = 50_000


def host_of(url: Column) -> Column:
    """From the first :// up to the next / ? # or the end, A-Z lower-cased; "" without ://."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? or # or the end; "" without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: host labels, path words (digits are one token) and query keys."""
    words = lambda x, tag: F.transform(
        F.filter(F.split(F.lower(x), r"[^\p{L}\p{N}]+"), lambda w: w != ""), lambda w: F.concat(F.lit(tag), F.when(w.rlike(r"^\p{N}+$"), F.lit("#")).otherwise(w))
    )
    keys = F.regexp_extract_all(F.coalesce(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), F.lit("")), F.lit(r"(?:^|&)([^=&]+)"), F.lit(1))
    return F.array_distinct(F.concat(words(host, "h:"), words(path, "p:"), F.transform(keys, lambda k: F.concat(F.lit("q:"), F.lower(k)))))


def given(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule (host and path joined) and verdict of the longest given rule that fits, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def mine(baskets: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """Rules (rule_id, antecedent, confidence, support) that conclude BAD from URL tokens.

    baskets: items array, distinct, not null. A rule is pruned below min_support (share of the labelled
    rows) or min_confidence, or if a rule whose tokens are a subset has its confidence at least.
    """
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where(F.array_contains("consequent", BAD))
    rules = rules.select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support")
    rules = rules.withColumn("rule_id", F.xxhash64("antecedent"))
    # a rule's narrower rivals have their first token among its tokens: an equi-join, then a subset test
    narrow = rules.select(F.col("antecedent").alias("_narrow"), F.col("confidence").alias("_conf"), F.col("antecedent")[0].alias("_token"))
    rival = rules.withColumn("_token", F.explode("antecedent")).join(narrow, "_token")
    rival = rival.where((F.size("_narrow") < F.size("antecedent")) & (F.size(F.array_except("_narrow", "antecedent")) == 0) & (F.col("_conf") >= F.col("confidence")))
    rival = rival.select("rule_id").distinct()
    return rules.join(rival, "rule_id", "left_anti")


def filter_urls(
    pages: DataFrame,
    labels: DataFrame | None = None,
    rules: Sequence[tuple[str, str, str]] = RULES,
    min_support: float = 0.01,
    min_confidence: float = 0.8,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Allow or block each URL by the longest given rule that fits, else by mined rules.

    A given rule fits its host and all subdomains where the path starts with the rule's.
    Mined rules come from FP-growth over the token sets of labelled URLs. labels is (id_col, bad 0
    or 1); of several labels of an id the worst counts, null ones are ignored. Without labels the
    given rules are what is known of URLs: those that they block are bad, and all others count as
    not bad, so a token combination must be blocked nearly wherever it occurs. Rules are pruned by
    support (a share of the labelled rows) and confidence. They are an inverted index: a row's
    distinct tokens join the rules' tokens, and a rule whose tokens are all found blocks. Rows meet
    their hits by a key of their own, so a frequent or null URL costs no more than others.

    A null URL, or one without ://, has host and path "" and is allowed unless a rule fits; a null URL
    has no tokens. Very long URLs are read whole. Where nothing is labelled bad, nothing is mined.
    Repeated rows each get their result; an empty table gives no rows. Other input columns are
    ignored.

    Returns id_col, host, path, rule string, verdict string, mined string (the tokens of the mined
    rule that decided, the one with the highest confidence; else null).
    """
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"))
    host, path = host_of(F.col("_url")), path_of(F.col("_url"))
    rule, verdict = given(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("host", host).withColumn("path", path).withColumn("rule", rule).withColumn("_given", verdict)
    rows = with_row_key(rows, "url-rows")

    tokens = F.when(F.col("_url").isNotNull(), tokens_of(F.col("_url"), F.col("host"), F.col("path")))
    if labels is None:
        known = rows.withColumn("_bad", F.coalesce(F.col("_given") == "block", F.lit(False)))
    else:
        worst = labels.where(F.col("bad").isin(0, 1)).groupBy(F.col(id_col).alias("_lid")).agg(F.max("bad").alias("_worst"))
        known = rows.join(worst, F.col("_id") == F.col("_lid")).withColumn("_bad", F.col("_worst") == 1)
    items = F.when(F.col("_bad"), F.array_append(tokens, F.lit(BAD))).otherwise(tokens)
    baskets = materialize(known.select(items.alias("items")).where(F.size("items") > 0), "url-baskets")
    mined = materialize(mine(baskets, min_support, min_confidence), "url-rules")
    n = mined.count()
    if n > MAX_RULES:
        raise ValueError(f"{n} rules; raise min_support or min_confidence")

    name = F.array_join("antecedent", " ")
    index = mined.select("rule_id", F.size("antecedent").alias("_need"), name.alias("_name"), "confidence", F.explode("antecedent").alias("_token"))
    found = rows.where("_given is null and _url is not null").select(ROW, F.explode(tokens).alias("_token")).join(F.broadcast(index), "_token")  # MAX_RULES rules at most
    whole = found.groupBy(ROW, "rule_id").agg(F.count(F.lit(1)).alias("_n"), F.first("_need").alias("_need"), F.first("_name").alias("_name"), F.first("confidence").alias("_conf"))
    hits = whole.where("_n = _need").groupBy(ROW).agg(F.max(F.struct("_conf", "_need", "_name"))["_name"].alias("mined"))
    verdict = F.coalesce("_given", F.when(F.col("mined").isNotNull(), F.lit("block")), F.lit("allow"))
    return rows.join(hits, ROW, "left").withColumn("verdict", verdict).select(F.col("_id").alias(id_col), "host", "path", "rule", "verdict", "mined")
