"""The pipeline's stages, each held against the brute-force operator tests' own measures."""

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))
corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.01"


def test_stages(spark):
    from millrace.llm._common import materialize
    from tests.llm.test_operators import brute_components

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for _, f in corpus_pipeline.STAGES[:-1]:
        kept.append(materialize(f(spark, kept[-1], SF), "test"))
        assert kept[-1].columns == docs.columns
    sets = [[tuple(r) for r in k.collect()] for k in kept]
    assert all(set(b) <= set(a) for a, b in zip(sets, sets[1:], strict=False))
    clean = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
    assert len(clean & {r[0] for r in sets[1]}) > 0.97 * len(clean)
    best = {}
    for r in sets[1]:
        best[r[1]] = max(r[0], best.get(r[1], r[0]))
    assert {r[0] for r in sets[2]} == set(best.values())
    want = {i for (i, _, low) in brute_components(sets[2], 5, 80) if i == low}
    assert Counter(r[0] for r in sets[3]) == Counter(want)
    assert max(Counter(r[0] for r in sets[4]).values()) <= 3
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept[-1], SF).toPandas()
    assert (pieces.groupby("sequence_id").length.sum() <= 2048).all()
    assert pieces.length.sum() == (pieces[pieces.start == 0].doc_tokens).sum()


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 100


def test_rows_without_own_id(spark):
    """Null and equal identifiers: rows are dropped and repeated each, never by their identifier."""
    words = lambda a, n=60: " ".join(f"{a}{i}" for i in range(n))
    near = lambda a: words(a) + " end"
    docs = [(1, words("a")), (None, near("a")), (None, words("b")), (None, words("c")), (None, near("c"))]
    docs += [(7, words("d")), (7, words("e")), (3, near("e")), (9, words("f")), (9, near("f")), (None, None), (None, "")]
    frame = spark.createDataFrame([(i, x, "en", "s", 0) for i, x in docs], "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter((r["doc_id"], (r["text"] or "-").split(" ")[0][:1]) for r in corpus_pipeline.near_dedup_stage(spark, frame, SF).collect())
    assert got == Counter([(1, "a"), (None, "b"), (None, "c"), (7, "d"), (3, "e"), (9, "f"), (None, "-"), (None, "-")])

    from millrace.llm._common import materialize, with_row_key
    from millrace.llm.mixing import mix_sources

    rows = [(None if i % 2 else 5, words(f"x{i}_", 10 + i), "en", "ab"[i % 3 > 0], 0) for i in range(60)]
    frame = materialize(spark.createDataFrame(rows, frame.schema), "test").coalesce(1)
    mixed = Counter(r["text"] for r in corpus_pipeline.mixing_stage(spark, frame, SF).collect())
    keyed = with_row_key(frame, "test-rows")
    mix = mix_sources(keyed, row_col="__mr_row").join(keyed.select("__mr_row", "text"), "__mr_row").collect()
    assert len(mix) == 60 and {r["text"]: r["copies"] for r in mix if r["copies"]} == dict(mixed)
    for s in "ab":
        mine = [r for r in mix if r["source"] == s]
        taken = sum(len(r["text"].split()) * mixed[r["text"]] for r in mine)
        assert abs(taken - mine[0]["target"]) < max(r["size"] for r in mine)
