"""Each operator against a brute-force version, over awkward rows and over empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from millrace.llm import exact_dedup, license_scan, line_quality, mixing, ngram_jaccard, packing, sharding, token_counts, toxicity, url_filter
from millrace.llm._tokens import counter, word_encoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, key long, n long, _id long, kept boolean"
SF = "/root/testdata/sf0.01"


def rows():
    r = random.Random(5)
    vocabulary = ["alpha", "Beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "été", "straße", "日本", "a b", "x1"]
    texts = [None, "", " \n\t ", "one", "One", "one two", "ONE TWO", "one\ttwo three", "a b c d", "A b C d", "a b c d e"]
    base = [" ".join(r.choice(vocabulary) for _ in range(60)) for _ in range(12)]
    texts += base + base[:4] + [b.upper() for b in base[:2]]
    for b in base[:6]:
        w = b.split(" ")
        w[30] = "changed"
        texts += [" ".join(w), " ".join([*w[:-1], "end"]), " ".join(w[:45])]
    texts += [" ".join(r.choice(vocabulary) for _ in range(9000)), "same line here\n" * 12 + "last", "word " * 50, "!!! ### $$$ | %%%"]
    out = [(i * 7 % 101, t, None if i % 9 == 0 else "en", None if i % 11 == 0 else f"s{i % 4}", None if t is None else len(t)) for i, t in enumerate(texts)]
    out += [out[12], out[12], (None, "no id at all here", "en", "s1", 3)]
    return [(*x, 1, 2, 3, 4, 5, True) for x in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 3 and 1, int(i % 5 == 0)) for i in range(60)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def text(x):
    return x or ""


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_dedup(spark, docs, none, keep):
    got = exact_dedup.exact_dedup(docs, keep=keep).collect()
    groups = defaultdict(list)
    for r in rows():
        groups[text(r[1])].append(r[0])
    best = min if keep == "smallest" else max
    want = Counter()
    for t, ids in groups.items():
        k = best((i for i in ids if i is not None), default=None)
        want.update((i, k, len(ids), i == k, hashlib.sha256(t.encode()).hexdigest()) for i in ids)
    assert Counter(map(tuple, got)) == want
    assert exact_dedup.exact_dedup(none).count() == 0
    kept = exact_dedup.drop_exact_copies(docs, keep=keep)
    assert kept.columns == docs.columns
    assert Counter(text(r["text"]) for r in kept.collect()) == Counter(groups.keys())
    with pytest.raises(ValueError):
        exact_dedup.exact_dedup(docs, keep="other")


def test_shards(docs, none):
    got = [r.asDict() for r in sharding.balanced_shards(docs, 4).collect()]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((r[0], len(text(r[1]).encode()) + 1, zlib.crc32(text(r[1]).encode())) for r in rows())
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    where = defaultdict(set)
    of = {r[0]: text(r[1]) for r in rows()}
    for r in got:
        where[of[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())
    assert sharding.balanced_shards(none).count() == 0


def brute_bytes_law(data, shards):
    """The law as stated, on its own: groups of equal texts in digest order, each in the shard where the
    middle of its bytes lies; inside a group by a hash of the id, equal ids as they come."""
    groups = defaultdict(list)
    for r in data:
        groups[hashlib.sha256(text(r[1]).encode()).digest()].append(r)
    total, at, where = sum(len(text(r[1]).encode()) + 1 for r in data), 0, {}
    for sha in sorted(groups):
        size = sum(len(text(r[1]).encode()) + 1 for r in groups[sha])
        where[sha] = min(shards - 1, shards * (at + size // 2) // total)
        at += size
    return where


@pytest.mark.parametrize("shards", [1, 3, 4, 16])
def test_shards_follow_the_law(docs, shards):
    want = brute_bytes_law(rows(), shards)
    of = {r[0]: hashlib.sha256(text(r[1]).encode()).digest() for r in rows()}
    got = sharding.balanced_shards(docs, shards).collect()
    assert all(r["shard"] == want[of[r["doc_id"]]] for r in got) and len(got) == len(rows())


def test_shards_of_one_text_and_no_ids(spark):
    d = spark.createDataFrame([(None, "same")] * 500 + [(256 * i, "same") for i in range(100)] + [(i, f"t{i}") for i in range(300)], "doc_id long, text string")
    got = [r.asDict() for r in sharding.balanced_shards(d, 5).collect()]
    assert len(got) == 900
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_shards_are_balanced(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [r["s"] for r in sharding.balanced_shards(d).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 16 and max(sizes) < 1.05 * min(sizes)


def test_targets():
    assert mixing.capped_targets([100, 100, 100], [1, 2, 3]) == [50, 100, 150]
    got = mixing.capped_targets([10, 1000, 90], [1, 2, 3])
    assert got[0] == 30 and got[2] == 270 and math.isclose(sum(got), 1100)
    assert mixing.capped_targets([], []) == [] and mixing.capped_targets([0, 5], [1, 1]) == [0, 5]


def test_pivotal_keeps_mass_and_expectation():
    r = np.random.default_rng(1)
    p, size = np.full(40, 0.3), r.integers(1, 90, 40).astype(float)
    mean = np.zeros(40)
    for _ in range(1500):
        q, held = mixing.pivotal(p, size, r.random(40))
        assert math.isclose((q * size).sum(), (p * size).sum(), rel_tol=1e-6)
        assert all(x in (0, 1) for i, x in enumerate(q) if i != held)
        mean += q
    assert np.abs(mean / 1500 - 0.3).max() < 0.06


def test_mixing(spark, docs, none):
    got = mixing.mix_sources(docs)
    a, b = (sorted(map(str, got.collect())), sorted(map(str, mixing.mix_sources(docs.repartition(3)).collect())))
    assert a == b
    by = defaultdict(list)
    for r in got.collect():
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        by[r["source"]].append(r)
    n = defaultdict(int)
    for r in rows():
        n[r[3]] += len(WORD.findall(text(r[1])))
    order = sorted(n, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, mixing.capped_targets([n[s] for s in order], [i % 3 + 1 for i in range(len(order))]), strict=True))
    for s, rs in by.items():
        assert {r["source_size"] for r in rs} == {n[s]} and math.isclose(rs[0]["target"], want[s])
        assert abs(sum(r["taken"] for r in rs) - want[s]) <= max(r["size"] for r in rs)
    assert mixing.mix_sources(none).count() == 0


def test_mixing_of_rows_that_nothing_tells_apart(spark):
    """A third of all rows agree in everything, ids are null or repeated: targets are met all the same."""
    data = [(None, "w " * 7, "a")] * 300 + [(5, f"x{i} " * (1 + i % 9), "a") for i in range(200)] + [(i, "y " * (1 + i % 30), "b") for i in range(400)]
    d = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = mixing.mix_sources(d, weights=(2, 3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_sources(d.repartition(7), weights=(2, 3)).collect()))
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == Counter((i, len(t.split()), s) for i, t, s in data)
    for s in "ab":
        mine = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= max(r["size"] for r in mine)
    alike = [r["copies"] for r in got if r["doc_id"] is None]
    assert max(alike) - min(alike) <= 1


def test_repeat_rows_goes_by_row(spark):
    d = spark.createDataFrame([(1, "a", 7), (2, "b", 7), (3, "c", None), (4, None, 1)], "row long, text string, doc_id long")
    mix = spark.createDataFrame([(1, 3), (2, 0), (3, 1), (4, 0)], "row long, copies long")
    out = mixing.repeat_rows(d, mix, "row")
    assert out.columns == d.columns and Counter(r["row"] for r in out.collect()) == {1: 3, 3: 1}
    assert mixing.repeat_rows(d.limit(0), mix, "row").count() == 0


def test_mixing_over_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 8)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    d = spark.read.parquet(f"{SF}/documents.parquet")
    for r in mixing.mix_sources(d).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("target"), F.max("size").alias("m"), F.count("*").alias("n")).collect():
        assert r["n"] == 50 and abs(r["t"] - r["target"]) <= r["m"]


def test_pieces_equal_the_library():
    from tokenizers import Tokenizer

    r = random.Random(2)
    parts = ["a", "Bc", "'s", "'", "é", " ", "  ", "\n", "\n\n", "\t", "\r\n", ".", "!!", "<|endoftext|>", "1", "\x01", "　", "\x85", "\x1c", "Σ", "İ", "J̌", "日本", "🙂", "\xa0", "ll"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(3000)] + [text(x[1]) for x in rows()]
    for name, got in (("word_bpe_49k.json", word_encoder), ("byte_bpe_50k.json", counter)):
        t = Tokenizer.from_file(public_tokenizers.path(name))
        for x, y in zip(texts, got(public_tokenizers.path(name))(texts), strict=True):
            ids = t.encode(x, add_special_tokens=False).ids
            assert y == (len(ids) if isinstance(y, int) else np.array(ids, "<u4").tobytes()), x


def test_word_merges_equal_the_library():
    """Every token of the vocabulary as a word, joined tokens, letters at random, runs of one letter."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t, r = Tokenizer.from_file(path), random.Random(3)
    words = sorted(x.removesuffix("</w>") for x in t.get_vocab(with_added_tokens=False))
    texts = words + [a + b for a, b in zip(r.sample(words, 9000), r.sample(words, 9000), strict=True)]
    texts += ["".join(r.choice("etaoinshrdluéßÀÿEZ") for _ in range(r.randint(1, 30))) + r.choice(["", ".", "!?", "'", "'s"]) for _ in range(9000)]
    texts += ["a" * 3000, "<|ENDOFTEXT|> x", "A<|startoftext|>B", "H\u0331 E\u0301", "\ufb01 \u212a \u03a3\u03a3", ""]
    want = [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]
    assert word_encoder(path)(texts) == want
    assert word_encoder(path)([]) == []


def test_packing_round_trip(docs, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    ids = defaultdict(list)
    for r in rows():
        x = [*t.encode(text(r[1]), add_special_tokens=False).ids, 1]
        want[r[0], len(x)] += len(x)
        ids[r[0], len(x)].append(np.array(x, "<u4"))
    got = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), window=64).collect()
    have, seqs = Counter(), defaultdict(list)
    for p in got:
        have[p["doc_id"], p["doc_tokens"]] += p["length"]
        assert any(zlib.crc32(x[p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"] for x in ids[p["doc_id"], p["doc_tokens"]])
        seqs[p["sequence_id"]].append((p["offset"], p["length"]))
    assert have == want
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 64 and at & (at - 1) == 0
    single = [k for k, v in ids.items() if len(v) == 1 and k[0] is not None]
    for k in single:
        starts = sorted((p["start"], p["length"]) for p in got if (p["doc_id"], p["doc_tokens"]) == k)
        assert [s for s, _ in starts] == list(np.cumsum([0, *[n for _, n in starts]])[:-1])
    assert packing.pack(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_index_scores_are_bm25():
    tails = [np.array(x, "<u4") for x in ([1, 1, 2], [2, 3], [4], [1, 4, 4, 5])]
    idf = np.array([0, 0.5, 0.7, 1.1, 0.9, 1.3])
    ix = packing.Index(tails, lambda t: idf[t], 2.5)
    for d, q in enumerate(tails):
        want = []
        for x in tails:
            tf = Counter(x.tolist())
            want.append(sum(idf[t] * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(x) / 2.5)) for t in set(q.tolist()) if tf[t]))
        assert np.allclose(ix.scores(d), want)


def brute_pack(tails, idf, mean, window):
    """The greedy rule as stated, with plain dictionaries."""
    counts, rest, at, out = [Counter(x) for x in tails], [len(x) for x in tails], [0] * len(tails), []

    def weight(t, d):
        return idf[t] * counts[d][t] * 2.2 / (counts[d][t] + 1.2 * (0.25 + 0.75 * len(tails[d]) / mean))

    while sum(rest) >= window:
        seed = max(range(len(tails)), key=lambda d: (rest[d], -d))
        query = sorted(counts[seed], key=lambda t: (-weight(t, seed), t))[: packing.QUERY_TERMS]
        n = min(rest[seed], window)
        here, room = [(seed, at[seed], n)], window - n
        at[seed], rest[seed] = at[seed] + n, rest[seed] - n
        ranked = sorted((d for d in range(len(tails)) if rest[d]), key=lambda d: (-round(sum(weight(t, d) for t in query if t in counts[d]), 9), d))
        for only_whole in (True, False):
            for d in ranked:
                if room and rest[d] and (rest[d] <= room or not only_whole):
                    n = min(rest[d], room)
                    here.append((d, at[d], n))
                    at[d], rest[d], room = at[d] + n, rest[d] - n, room - n
        out.append(here)
    return out


@pytest.mark.parametrize("terms", [64, 5])
def test_windows_equal_brute_force(monkeypatch, terms):
    monkeypatch.setattr(packing, "QUERY_TERMS", terms)
    r = np.random.default_rng(9)
    idf = r.random(60) + 0.1
    for _ in range(6):
        tails = [r.integers(0, 60, r.integers(1, 50)) for _ in range(40)] + [np.array([3])] * 3
        mean = sum(map(len, tails)) / len(tails)
        full, left = packing.pack_shard([len(x) for x in tails], packing.Index(tails, lambda t: idf[t], mean), 64)
        assert full == brute_pack([x.tolist() for x in tails], idf, mean, 64)
        assert sum(n for here in full for _, _, n in here) + sum(n for _, _, n in left) == sum(map(len, tails)) and sum(n for _, _, n in left) < 64


def test_packing_over_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 16)
    d = spark.read.parquet(f"{SF}/documents.parquet")
    p = packing.pack(d, public_tokenizers.path("word_bpe_49k.json")).toPandas()
    n = p.groupby("sequence_id").length.sum()
    assert (n != 2048).sum() <= 11 and all(x & (x - 1) == 0 for x in n)
    assert (p.groupby("doc_id").length.sum() == p.groupby("doc_id").doc_tokens.first()).all() and p.doc_id.nunique() == 1000


def brute_components(docs, n, percent):
    sets = []
    for r in docs:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text(r[1])))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for i, r in enumerate(docs):
        if r[0] is not None:
            low[find(i)] = min(r[0], low.get(find(i), r[0]))
    return Counter((r[0], len(sets[i]), low.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(docs))


@pytest.mark.parametrize(("n", "percent", "most"), [(4, 85, 4096), (5, 80, 4096), (4, 85, 2), (2, 40, 3)])
def test_jaccard(docs, none, monkeypatch, n, percent, most):
    monkeypatch.setattr(ngram_jaccard, "MAX_DOCS", most)
    got = ngram_jaccard.jaccard_components(docs, n, percent).collect()
    assert Counter(map(tuple, got)) == brute_components(rows(), n, percent)
    if most == 4096 and n == 4:
        assert ngram_jaccard.jaccard_components(none, n, percent).count() == 0


def test_metric_join_recurses(monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "LEAF", 8)
    r = random.Random(3)
    sets = []
    for c in range(40):
        base = [c * 1000 + i for i in range(100)]
        for _ in range(r.randint(1, 8)):
            sets.append(np.array(sorted({*r.sample(base, 93), *(r.randrange(10**6) for _ in range(r.randint(0, 6)))})))
    at = ngram_jaccard.Threshold(85)
    got = ngram_jaccard.metric_join(ngram_jaccard.Sets(sets), at, np.zeros(len(sets), bool))
    u = ngram_jaccard.Union(len(sets))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                u.join(i, np.array([j]))
    want = u.flat()
    assert len(set(got.tolist())) == len(set(want.tolist())) and len({*zip(got.tolist(), want.tolist(), strict=True)}) == len(set(want.tolist()))
    hist = ngram_jaccard.join_histograms([ngram_jaccard.histogram(s) for s in sets], np.array([len(s) for s in sets]), at, np.zeros(len(sets), bool))
    assert len({*zip(want.tolist(), hist.tolist(), strict=True)}) == len(set(want.tolist()))  # loses no link


def test_token_counts_and_cache(spark, docs, none, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    want = Counter((r[0], len(text(r[1]).encode()), n := len(t.encode(text(r[1]), add_special_tokens=False).ids), n > 1024) for r in rows())
    cache = str(tmp_path / "cache")
    for _ in range(2):
        assert Counter(map(tuple, token_counts.token_counts(docs, path, cache).collect())) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() == len({text(r[1]) for r in rows()})
    token_counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), cache).count()
    told = str(tmp_path / "told")  # a cache that holds another number for each text: nothing is encoded again
    stored.withColumn("n_tokens", F.lit(7).cast("long")).write.parquet(told)
    assert {r["n_tokens"] for r in token_counts.token_counts(docs, path, told).collect()} == {7}
    assert spark.read.parquet(told).count() == stored.count()
    assert spark.read.parquet(cache).select("version").distinct().count() == 2
    assert token_counts.token_counts(none, path).count() == 0


def test_toxicity_on_held_out(spark):
    d, lab = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.toxicity(d, lab).join(lab, "doc_id").where("held_out").toPandas()
    p, n = got[got.toxic == 1], got[got.toxic == 0]
    assert (p.predicted == 1).mean() > 0.85 and (n.predicted == 0).mean() > 0.99
    assert got.score.between(0, 1).all() and all((zlib.crc32(str(i).encode()) % 5 == 0) for i in got.doc_id)


def test_toxicity_of_awkward_rows(docs, none, labels):
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert toxicity.toxicity(none, labels).count() == 0 and toxicity.toxicity(docs, labels.limit(0)).count() == len(rows())
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns


def brute_em(votes, start, steps):
    """EM for independent voters, row by row."""
    p = list(start)
    for _ in range(steps):
        n1 = sum(p)
        prior = (n1 + 0.1) / (len(p) + 0.2)
        on1 = [(sum(q for q, v in zip(p, votes, strict=True) if v[j]) + 0.05) / (n1 + 0.1) for j in range(len(votes[0]))]
        on0 = [(sum(1 - q for q, v in zip(p, votes, strict=True) if v[j]) + 0.05) / (len(p) - n1 + 0.1) for j in range(len(votes[0]))]
        p = []
        for v in votes:
            a, b = prior, 1 - prior
            for j, x in enumerate(v):
                a, b = a * (on1[j] if x else 1 - on1[j]), b * (on0[j] if x else 1 - on0[j])
            p.append(a / (a + b))
    return np.array(p), np.array([on0, on1])


def test_label_model_is_em(monkeypatch):
    monkeypatch.setattr(toxicity, "CORRELATED", 2.0)  # nothing but a voter itself is above that
    r = np.random.default_rng(5)
    y = r.random(300) < 0.3
    votes = np.stack([np.where(y, r.random(300) < a, r.random(300) < b) for a, b in ((0.8, 0.05), (0.6, 0.1), (0.5, 0.02), (0.3, 0.3))], 1)
    start = np.where(votes.sum(1) > 1, 0.8, 0.1)
    got = toxicity.label_model(votes, np.ones(300), start, steps=12)
    monkeypatch.undo()
    want, fires = brute_em(votes.tolist(), start.tolist(), 12)
    assert np.allclose(got.posterior, want, atol=1e-6) and np.allclose(got.fires, fires, atol=1e-6)
    unique, inverse, times = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    monkeypatch.setattr(toxicity, "CORRELATED", 2.0)
    again = toxicity.label_model(unique, times.astype(float), np.where(unique.sum(1) > 1, 0.8, 0.1), steps=12)
    assert np.allclose(again.posterior[inverse.ravel()], want, atol=1e-6)


def test_label_model_estimates_accuracy_and_correlation():
    r = np.random.default_rng(0)
    y = r.random(4000) < 0.2
    a, b, c = (np.where(y, r.random(4000) < 0.7, r.random(4000) < 0.05) for _ in range(3))
    votes = np.stack([a, b, c], 1)
    alone = toxicity.label_model(votes, np.ones(4000), votes.mean(1))
    assert np.abs(alone.fires[1] - 0.7).max() < 0.08 and np.abs(alone.fires[0] - 0.05).max() < 0.03 and 0.15 < alone.prior < 0.25
    assert np.abs(alone.correlation - np.eye(3)).max() < 0.15
    votes = np.stack([a, a, a, b, c], 1)
    thrice = toxicity.label_model(votes, np.ones(4000), np.stack([a, b, c], 1).mean(1))
    assert thrice.correlation[0, 1] > 0.99 and abs(thrice.evidence[:3].sum() - alone.evidence[0]) < 0.3 * alone.evidence[0]


def test_toxicity_labels_with_extra_columns(spark, docs, labels):
    more = labels.select("*", F.lit("x").alias("text"), F.lit(1).alias("_id"), F.lit("z").alias("_text"), F.lit(2).alias("_y"))
    assert sorted(map(str, toxicity.toxicity(docs, more).collect())) == sorted(map(str, toxicity.toxicity(docs, labels).collect()))
    twice = labels.unionByName(labels.limit(20))
    assert len(toxicity.toxicity(docs, twice).collect()) == len(rows())


def brute_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest, re.S)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :], re.S)[0]


URLS = [None, "", "nothing", "http://A.Example.COM/en/7x", "https://example.com/en/8", "https://b.example.net/de/81?x=/en/", "http://net/de/", "http://xnet/de/", "http://example.org#/es/", "http://x.org/es/1\n2", "://", "http://example.org?a=b&c"]


def test_given_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, verdict string")
    for r in url_filter.filter_urls(pages).collect():
        u = (URLS * 2)[r["page_id"]]
        host, path = brute_host_path(u)
        fits = [(h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda f: len(f[0])) if fits else (None, r["verdict"])
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict) and verdict in ("allow", "block")
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def brute_rules(baskets, support, confidence):
    """All token combinations of the labelled URLs, counted one by one."""
    from itertools import combinations

    n, bad = Counter(), Counter()
    for tokens, is_bad in baskets:
        for k in range(1, len(tokens) + 1):
            for c in combinations(sorted(tokens), k):
                n[c] += 1
                bad[c] += is_bad
    least = math.ceil(support * len(baskets) - 1e-9)
    found = {c: bad[c] / n[c] for c in n if bad[c] >= max(1, least) and bad[c] / n[c] >= confidence}
    return {c: f for c, f in found.items() if not any(set(d) < set(c) and g >= f for d, g in found.items())}


def brute_tokens(url):
    host, path = brute_host_path(url)
    number = lambda w: "#" if re.fullmatch(r"[0-9]+", w) else w
    words = lambda x, tag: {tag + number(w) for w in re.split(r"[\W_]+", x.lower()) if w}
    query = re.search(r"\?([^#]*)", url, re.S)
    return words(host, "h:") | words(path, "p:") | {"q:" + k.lower() for k in re.findall(r"(?:^|&)([^=&]+)", query[1] if query else "")}


@pytest.mark.parametrize("labelled", [True, False])
def test_mined_url_rules_equal_brute_force(spark, labelled):
    r = random.Random(8)
    urls = [f"http://{r.choice(['a', 'b', 'm'])}.h{i % 7}.{r.choice(['com', 'org'])}/{r.choice(['en', 'es', 'casino/win', 'casino/news'])}/{i}{r.choice(['', '?ref=1', '#x'])}" for i in range(300)]
    urls += ["http://same.h1.com/casino/win/5"] * 40
    pages = spark.createDataFrame(list(enumerate([*urls, None, "nothing"])), "page_id long, url string")
    tag = lambda u: ("casino/win" in u) != (len(u) % 11 == 0)
    rules = [] if labelled else [("block", "com", "/casino/win"), ("block", "h3.org", "/e"), ("allow", "h2.com", "/casino/win")]
    labels = spark.createDataFrame([(i, int(tag(u))) for i, u in enumerate(urls) if i % 3] + [(1, 0), (None, 1), (2, None)], "page_id long, bad int") if labelled else None
    got = {x["page_id"]: x for x in url_filter.filter_urls(pages, labels, rules, min_support=0.02, min_confidence=0.7).collect()}

    def by_rule(u):
        host, path = brute_host_path(u)
        fits = [(len(h + p), v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[1] if fits else None

    if labelled:
        baskets = [(brute_tokens(u), tag(u)) for i, u in enumerate(urls) if i % 3]
    else:
        baskets = [(brute_tokens(u), by_rule(u) == "block") for u in urls]
    want = brute_rules(baskets, 0.02, 0.7)
    assert want
    for i, u in enumerate(urls):
        hit = any(set(c) <= brute_tokens(u) for c in want)
        assert got[i]["verdict"] == (by_rule(u) or ("block" if hit else "allow")), u
        assert (got[i]["mined"] is not None) == (hit and by_rule(u) is None)
    assert got[len(urls)]["verdict"] == got[len(urls) + 1]["verdict"] == "allow"


def test_url_labels_with_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://x.com/a", "h", 1), (1, "http://x.com/a", "h", 0)], "page_id long, url string, host string, bad int")
    labels = spark.createDataFrame([(1, 1, "http://y", "z")], "page_id long, bad int, url string, _token string")
    assert [r["verdict"] for r in url_filter.filter_urls(pages, labels, []).collect()] == ["block", "block"]
    assert [r["verdict"] for r in url_filter.filter_urls(pages, labels.limit(0), []).collect()] == ["allow", "allow"]


MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""
BSD2 = """Copyright (c) 2020, Somebody
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NAMES = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL ANYONE BE LIABLE."""
GPL = """/* This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU {} as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 */"""
GPL2 = """ This program is free software; you can redistribute it and/or modify
 it under the terms of the GNU General Public License as published by
 the Free Software Foundation; either version 2 of the License, or
 (at your option) any later version."""
LGPL21 = GPL2.replace("program", "library").replace("General", "Lesser General").replace("version 2 of", "version 2.1 of")
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""


def test_licenses(docs, none, spark):
    texts = {
        "apache-2.0": ["Licensed under the Apache License, Version 2.0.\nwords", APACHE, "SPDX-License-Identifier: Apache-2.0", APACHE.replace("# ", "// ").replace("#", "//"), "GNU\n\n  Apache License\n  Version 2.0, January 2004\n  http://www.apache.org/licenses/\n\n TERMS"],
        "mit": [MIT, MIT.replace("\n", "\r\n"), "/*\n" + MIT.replace("\n", "\n * ") + "\n*/", "text. Released under the MIT License.", "a\nReleased under the MIT License\nb"],
        "bsd-3-clause,proprietary": [BSD2 + NAMES + WARRANTY, (BSD2 + NAMES + WARRANTY).replace("\n1. ", "\n * ").replace("\n2. ", "\n * ").replace("\n3. ", "\n * ")],
        "bsd-2-clause,proprietary": [BSD2 + WARRANTY],
        "gpl-3.0": [GPL.format("General Public License"), "SPDX-License-Identifier: GPL-3.0-or-later", "a. This work is licensed under the GNU General Public License version 3. b", "  GNU GENERAL PUBLIC LICENSE\n     Version 3, 29 June 2007\n\n Copyright"],
        "agpl-3.0": [GPL.format("Affero General Public License")], "lgpl-3.0": [GPL.format("Lesser General Public License")],
        "gpl-2.0": [GPL2], "lgpl-2.1": [LGPL21, "# SPDX-License-Identifier: LGPL-2.1-only"], "isc": [ISC, "SPDX-License-Identifier: ISC\n"], "mpl-2.0": [MPL],
        "cc-by-nc-4.0": ["x\nLicensed under CC BY-NC 4.0."], "cc-by-sa-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0\nInternational License."],
        "unlicense": ["This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy"], "proprietary": ["(c) 2020 X. ALL RIGHTS RESERVED"],
        "apache-2.0,mit": [MIT + "\n\n" + APACHE], "": [None, "", "license of another kind", "The software is mine.", "MIT", "Permission is hereby granted, free of charge, to any person.", "x" * 300_000 + " software"],
    }
    flat = [(x, want) for want, xs in texts.items() for x in xs]
    d = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(flat)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(d).collect()}
    for i, (x, want) in enumerate(flat):
        assert got[i]["licenses"] == want, (x, got[i])
        assert got[i]["license"] == (want.split(",")[0] or None)
    for s in license_scan.SENTENCES:
        assert re.search(license_scan.ANCHORS, s), s
    assert license_scan.scan_licenses(docs).count() == len(rows()) and license_scan.scan_licenses(none).count() == 0


def brute_base(t):
    w = WORD.findall(t)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines, seen, dup = t.split("\n"), set(), 0
    for x in lines:
        dup += x in seen and bool(WORD.search(x))
        seen.add(x)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit)


def test_quality_base(docs, none, labels):
    want = Counter()
    for r in rows():
        b = brute_base(text(r[1]))
        want[(r[0], *b, b[0] < 10 or 100 * b[4] > 20 * b[0])] += 1
    got = line_quality.line_quality(docs, labels).collect()
    assert Counter(tuple(r)[:7] for r in got) == want
    assert all(not (r["base_failed"] and r["kept"]) for r in got)
    assert line_quality.line_quality(none, labels).count() == 0
    assert all(r["kept"] != r["base_failed"] for r in line_quality.line_quality(docs, labels.limit(0)).collect())


def test_quality_keeps_clean_and_drops_junk(spark):
    d, lab = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = line_quality.line_quality(d, lab).join(lab, "doc_id").toPandas()
    assert got[(got.quality == 1) & ~got.base_failed].kept.mean() > 0.97 and got[got.quality == 0].kept.mean() < 0.1


def test_lines_measured_apart_equal_lines_measured_together(monkeypatch):
    texts = [text(r[1]).encode() for r in rows()]
    whole = line_quality.read_lines(texts)
    monkeypatch.setattr(line_quality, "SIDE_BY_SIDE", 50)
    parts = list(line_quality.side_by_side(texts))
    assert len(parts) > 9
    for k in range(4):
        assert (np.concatenate([p[k] for p in parts]) == whole[k]).all()
    words = [w.encode() for t in texts for w in t.decode().split()]
    raw = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    h = line_quality.word_hashes(raw, ends - [len(w) for w in words], ends)
    assert len(set(h.tolist())) == len(set(words)) == len(set(zip(h.tolist(), words, strict=True)))


def all_paths(n):
    return [tuple(k >> i & 1 for i in range(n)) for k in range(1 << n)]


def path_score(crf, at, p, extra=None):
    s = crf.emit[at].sum(1) + (0 if extra is None else extra)
    return sum(s[t, p[t]] for t in range(len(p))) + sum(crf.move[p[t], p[t + 1]] for t in range(len(p) - 1))


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(4)
    crf = line_quality.Crf(r.normal(size=(line_quality.N_FEATURES, 2)), r.normal(size=(2, 2)))
    count = np.array([7, 0, 1, 5, 7, 2])
    at = r.integers(0, line_quality.N_FEATURES, (count.sum(), 10))
    got, low = crf.viterbi(at, count), 0
    for n in count:
        one = at[low : low + n]
        if n:
            assert tuple(got[low : low + n]) == max(all_paths(n), key=lambda p: path_score(crf, one, p)) == tuple(crf.viterbi(one))
        low += n


def test_expectations_and_gradient_equal_all_paths():
    """Posteriors against a sum over all paths; one training step against the likelihood's numeric slope."""
    r = np.random.default_rng(6)
    crf = line_quality.Crf(r.normal(size=(line_quality.N_FEATURES, 2)), r.normal(size=(2, 2)))
    count, label = np.array([4, 1, 6, 3]), np.array([0, 1, 1, 0])
    at = np.stack([line_quality._OFFSET[k] + r.integers(0, len(e) + 1, count.sum()) for k, e in line_quality.EDGES.items()] + [np.zeros(count.sum(), int)], 1)
    p, pair, second = crf.expect(crf.score(at), line_quality.Chains(count))
    low = 0
    for n in count:
        paths = all_paths(n)
        w = np.exp([path_score(crf, at[low : low + n], x) for x in paths])
        w /= w.sum()
        assert np.allclose(p[low : low + n, 1], [sum(q for q, x in zip(w, paths, strict=True) if x[t]) for t in range(n)])
        for t in range(1, n):
            at_pair = pair[list(second).index(low + t)]
            assert np.allclose(at_pair[1, 0], sum(q for q, x in zip(w, paths, strict=True) if x[t - 1] and not x[t]))
        low += n

    def likelihood(emit, move):
        c, total, at_line = line_quality.Crf(emit, move), 0.0, 0
        share = np.bincount(label)
        for n, y in zip(count, label, strict=True):
            one = at[at_line : at_line + n]
            known = np.zeros((n, 2))
            known[:, 1] = line_quality._EVIDENCE[one].sum(1) + line_quality.BY_LABEL[y]
            z = [np.log(np.sum(np.exp([path_score(c, one, x, e) for x in all_paths(n)]))) for e in (known, None)]
            total += (z[0] - z[1]) / (2 * share[y] * n)
            at_line += n
        return total

    one = line_quality.train_crf(at, count, label, steps=1, rate=1.0, l2=0.0)  # the first step is the sign of the slope
    emit, move = np.zeros((line_quality.N_FEATURES, 2)), np.zeros((2, 2))
    for f in sorted(set(at.ravel()))[::3]:
        e = emit.copy()
        e[f, 1] = 1e-4
        slope = likelihood(e, move) - likelihood(emit, move)
        assert abs(slope) < 1e-9 or np.sign(slope) == np.sign(one.emit[f, 1])
    for i in range(2):
        for j in range(2):
            m = move.copy()
            m[i, j] = 1e-4
            slope = likelihood(emit, m) - likelihood(emit, move)
            assert abs(slope) < 1e-9 or np.sign(slope) == np.sign(one.move[i, j])


def test_mixed_documents_are_split_by_line(spark):
    """Junk inside prose and prose inside junk, with document labels only."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdeghilmnorstu") for _ in range(r.randint(2, 8)))
    prose = lambda n: [" ".join([word().capitalize(), *[word() for _ in range(r.randint(7, 14))]]) + "." for _ in range(n)]
    junk = lambda n: [" | ".join(word() for _ in range(r.randint(3, 9))) for _ in range(n)]
    texts = ["\n".join((prose(9) + junk(2) if i % 2 else prose(2) + junk(9)) + prose(2)) for i in range(80)]
    docs = spark.createDataFrame([*enumerate(texts), (3, texts[3]), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(None, 1), (5, None)], "doc_id long, quality int")
    crf = line_quality.fit(docs, labels)
    planted = prose(5) + junk(6) + prose(4) + junk(3)
    lines = line_quality.read_lines(["\n".join(planted).encode()])
    assert crf.viterbi(lines.at, lines.count).tolist() == [1] * 5 + [0] * 6 + [1] * 4 + [0] * 3
    share = line_quality.content_shares(lines, crf)[0]
    n = [sum(map(len, x.split())) for x in planted]
    assert math.isclose(share, (sum(n[:5]) + sum(n[11:15])) / sum(n))


def test_line_training_reads_whole_texts(spark):
    r = random.Random(3)
    prose = lambda n: ["".join(r.choice("abcdefghi ") for _ in range(40)) + " end." for _ in range(n)]
    texts = ["\n".join(prose(230 + i) + (["### $$$ 123"] * 250 if i % 2 else [])) for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(20)], "doc_id long, quality int")
    got = line_quality.fit(docs, labels)
    lines = line_quality.read_lines([x.encode() for x in texts])
    want = line_quality.train_crf(lines.at, lines.count, np.array([1 - i % 2 for i in range(20)]))
    assert np.allclose(got.emit, want.emit, atol=1e-6) and np.allclose(got.move, want.move, atol=1e-6)
    assert not got.viterbi(line_quality.read_lines([b"### $$$ 123\n" * 50]).at).any()


def test_pandas_is_only_a_carrier(docs):
    assert isinstance(exact_dedup.exact_dedup(docs).limit(1).toPandas(), pd.DataFrame)
