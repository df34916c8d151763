"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import materialize, per_worker, small_batches

#: Labelled rows that the models are fitted on at most, taken by a hash of their identifiers.
TRAIN_ROWS = 20_000
#: Voters at most; the strongest on the labelled rows are taken.
VOTERS = 600
#: Evidence that a voter needs: about this log-likelihood ratio.
LEAST_RATIO = 12.0
PREFIXES = (3, 4, 5, 6)
#: Insults whose voters exist even where no label shows them.
LEXICON = (
    "arse", "arsehole", "asshole", "bastard", "bitch", "braindead", "bullshit", "clown", "coward", "creep", "cretin", "degenerate", "despicable", "dimwit", "dipshit",
    "disgusting", "douche", "dumb", "dumbass", "filth", "fool", "freak", "fuck", "garbage", "hate", "idiot", "idiotic", "imbecile", "jerk", "kill", "liar", "loser", "lunatic",
    "moron", "moronic", "nitwit", "parasite", "pathetic", "pig", "prick", "retard", "scum", "scumbag", "shit", "slut", "stupid", "subhuman", "trash", "twat", "ugly", "useless",
    "vermin", "vile", "whore", "worthless", "wretch",
)
#: Pseudo-rows by which a labelled row anchors the accuracies of the voters in the label model.
ANCHOR = 4.0
#: Two voters with a correlation above this, given the class, are taken as partly the same evidence.
CORRELATED = 0.1
_TABLE = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def words(text: str) -> set[str]:
    """Distinct lower-case words: runs of letters (any non-ASCII character counts as one)."""
    return set(text.lower().encode("utf-8", "replace").translate(_TABLE).decode("utf-8", "replace").split())


def candidates(word: str) -> list[str]:
    """The voters that a word calls: the word itself (lexicon), its beginnings (patterns)."""
    return [f"={word}"] * (len(word) <= 24) + [f"{word[:n]}*" for n in PREFIXES if len(word) > n]


class Model(NamedTuple):
    weight: dict[str, float]  # of the classifier, by voter
    bias: float
    accuracy: dict[str, tuple[float, float]]  # how often a voter fires on class 1 and on class 0
    independent: dict[str, float]  # how much of a voter is evidence of its own


class LabelModel(NamedTuple):
    posterior: np.ndarray  # of label 1, by row
    fires: np.ndarray  # (2, voters): share of class 0 and of class 1 on which a voter fires
    correlation: np.ndarray  # (voters, voters), given the class
    independent: np.ndarray  # by voter
    prior: float

    @property
    def evidence(self) -> np.ndarray:
        """Log-odds that a firing voter adds."""
        return np.log(self.fires[1] / self.fires[0]) * self.independent


def correlations(x: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Correlations of the voters on rows of these weights; 0 for one that is constant there."""
    n = max(weight.sum(), 1e-9)
    mean = weight @ x / n
    var = mean * (1 - mean)
    z = (x - mean) / np.sqrt(np.maximum(var, 1e-12)) * (var > 1e-9)
    return z.T @ (z * weight[:, None]) / n


class Anchor(NamedTuple):
    """A prior on the voters' accuracies: shares of each class on which they fire, (2, voters), and
    the rows that these count for, (2,)."""

    fires: np.ndarray
    rows: np.ndarray


def label_model(votes: np.ndarray, rows: np.ndarray, start: np.ndarray, anchor: Anchor | None = None, steps: int = 60) -> LabelModel:
    """EM for a latent label that voters, which fire or abstain, depend on. No row's own label enters.

    votes: rows x voters, 0 or 1; rows: how many rows each one stands for; start: the first
    posterior. Each step estimates the share of label 1, how often every voter fires on either class
    (with the anchor's rows as pseudo-counts), and the voters' correlations given the class. A voter
    counts by the inverse of its summed squared correlations, so a word and its beginnings count
    about once.
    """
    x, n, p = votes.astype("float64"), rows.sum(), start.astype("float64")
    anchor = anchor or Anchor(np.full((2, x.shape[1]), 0.5), np.full(2, 0.1))
    k0, k1 = anchor.rows
    for _ in range(steps):
        one, zero = rows * p, rows * (1 - p)
        prior = np.clip((one.sum() + k1) / (n + k0 + k1), 1e-3, 1 - 1e-3)
        fires = np.stack([(zero @ x + k0 * anchor.fires[0]) / (zero.sum() + k0), (one @ x + k1 * anchor.fires[1]) / (one.sum() + k1)])
        rho = (one.sum() * correlations(x, one) + zero.sum() * correlations(x, zero)) / n
        np.fill_diagonal(rho, 0)
        independent = 1 / (1 + np.where(np.abs(rho) > CORRELATED, rho**2, 0).sum(1))
        fire, quiet = (np.log(f[1] / f[0]) * independent for f in (fires, 1 - fires))
        odds = np.log(prior / (1 - prior)) + x @ (fire - quiet) + quiet.sum()
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        moved, p = np.abs(new - p).max(), new
        if moved < 1e-6:
            break
    return LabelModel(p, fires, rho + np.eye(len(rho)), independent, float(prior))


def anchored(votes: np.ndarray, rows: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, Anchor]:
    """What labelled rows say of the voters: the first posterior, in which a row is as likely label 1
    as the labelled rows of its surest voter are, and how often voters fire on either label."""
    x, one, zero = votes.astype("float64"), rows * gold, rows * (1 - gold)
    right = (one @ x + 0.1) / (rows @ x + 1.0)
    fires = np.stack([(zero @ x + 0.05) / (zero.sum() + 0.1), (one @ x + 0.05) / (one.sum() + 0.1)])
    return np.where(votes.any(1), (x * right).max(1), 0.01), Anchor(fires, ANCHOR * np.array([zero.sum(), one.sum()]))


def linear(votes: np.ndarray, target: np.ndarray, rows: np.ndarray, ridge: float = 0.3, steps: int = 30) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps."""
    x, cost = np.hstack([votes.astype("float64"), np.ones((len(votes), 1))]), rows
    w, pull = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (cost * (p - target)) + pull * w
        h = (x * (cost * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5 / max(1e-9, np.abs(step).max()))
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many rows of either label call each voter, per batch."""
    for b in batches:
        n: dict[str, list[int]] = {}
        for text, y in zip(b.column("_text").to_pylist(), b.column("_y").to_pylist(), strict=True):
            for v in {v for w in words(text) for v in candidates(w)}:
                n.setdefault(v, [0, 0])[y] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array([x[1] for x in n.values()], pa.int64()), pa.array([x[0] for x in n.values()], pa.int64())], ["voter", "n1", "n0"])


def _votes(index: dict[str, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hits = [sorted({index[v] for w in words(x) for v in candidates(w) if v in index}) for x in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_lid"), b.column("_y"), pa.array(hits, pa.list_(pa.int32()))], ["_lid", "_y", "hits"])

    return run


def held_out(id_col: str = "doc_id"):
    """True where crc32 of the identifier as text is 0 modulo 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS, voters: int = VOTERS) -> Model:
    """Fit on labelled rows that are not held out, at most `rows` of them, taken by a hash of their
    identifiers; of rows with one identifier the smallest text is taken, of labels the worst.

    Voters are the lexicon and the words and word beginnings that tell the labels apart best on
    these rows (by log-likelihood ratio, LEAST_RATIO at least). Labels choose the voters and anchor
    their accuracies, which label_model() then estimates from votes; the classifier is trained on its
    posteriors, not on labels. A lexicon voter that never fired weighs as the lexicon's median. Counts, and per row the voters that fire, are all that reaches the driver.

    Null identifiers and null labels are ignored, null texts are empty. Without labels of both
    classes, or where no voter fires (empty tables too), the lexicon alone votes.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("_lid")).agg(F.max("toxic").alias("_y")).orderBy(F.xxhash64("_lid"), "_lid").limit(rows)
    text = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    sample = text.join(F.broadcast(known), F.col("_id") == F.col("_lid")).groupBy("_lid", "_y").agg(F.min("_text").alias("_text"))  # `rows` rows at most
    sample = materialize(sample, "toxicity-sample")
    n = {r["_y"]: r["count"] for r in sample.groupBy("_y").count().collect()}
    base = Model({f"={w}": 6.0 for w in LEXICON}, -3.0, {}, {})
    if len(n) < 2:
        return base
    counts = sample.select("_text", "_y").mapInArrow(_count, "voter string, n1 long, n0 long").groupBy("voter").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    p1, p0 = (F.col("n1") + 0.1) / (n[1] + 0.2), (F.col("n0") + 0.1) / (n[0] + 0.2)
    ratio = F.col("n1") * F.log(p1 / ((F.col("n1") + F.col("n0")) / (n[0] + n[1])))
    best = counts.where((ratio >= LEAST_RATIO) & (p1 > 5 * p0)).orderBy(ratio.desc(), "voter").limit(voters).collect()
    names = sorted({r["voter"] for r in best} | set(base.weight))
    index = {v: i for i, v in enumerate(names)}
    got = sample.mapInArrow(_votes(index), "_lid {}, _y int, hits array<int>".format(dict(labels.dtypes)[id_col])).select("_y", "hits").collect()
    alike: dict[tuple, int] = {}  # most rows call no voter at all
    for r in got:
        key = (*r["hits"], r["_y"])
        alike[key] = alike.get(key, 0) + 1
    keys = sorted(alike)
    votes, y, rows_of = np.zeros((len(keys), len(names)), np.uint8), np.array([k[-1] for k in keys]), np.array([float(alike[k]) for k in keys])
    for i, k in enumerate(keys):
        votes[i, list(k[:-1])] = 1
    seen = votes.any(0)
    if not seen.any():
        return base
    votes, names = votes[:, seen], [v for v, s in zip(names, seen, strict=True) if s]
    found = label_model(votes, rows_of, *anchored(votes, rows_of, y))
    w, bias = linear(votes, found.posterior, rows_of)
    heard = [x for v, x in zip(names, w.tolist(), strict=True) if v in base.weight]
    unheard = dict.fromkeys(base.weight, float(np.median(heard)) if heard else 6.0)
    fires, own = found.fires.T[:, ::-1].tolist(), found.independent.tolist()
    return Model(
        unheard | dict(zip(names, w.tolist(), strict=True)), bias,
        {v: tuple(f) for v, f in zip(names, fires, strict=True)}, dict(zip(names, own, strict=True)),
    )


def _score(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, bias = model.weight, model.bias
        calls: dict[str, tuple[str, ...]] = per_worker(("voters", tuple(sorted(weight.items()))), dict)
        for b in batches:
            out = []
            for text in b.column("_text").to_pylist():
                fired: set[str] = set()
                for w in words(text):
                    c = calls.get(w)
                    if c is None:
                        if len(calls) > 150_000:
                            calls.clear()
                        calls[w] = c = tuple(v for v in candidates(w) if v in weight)
                    if c:
                        fired.update(c)
                odds = bias + sum(sorted(weight[v] for v in fired))
                out.append(1 / (1 + np.exp(-max(-30.0, min(30.0, odds)))))
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(out, pa.float64())], ["_id", "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score the whole text of every row by the linear classifier that fit() trains.

    Only the text enters a score. Null texts count as empty and, with no voter firing, score low.
    Very long texts are read whole. Repeated rows each get their result. An empty table gives no rows. Other input columns are
    ignored. A null identifier is held out of nothing and gets held_out false.

    Returns id_col, held_out boolean, score double (0 to 1), predicted int (score >= 0.5).
    """
    small_batches(docs.sparkSession)
    model = fit(docs, labels, id_col, text_col)
    kind = dict(docs.dtypes)[id_col]
    text = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    out = text.mapInArrow(_score(model), f"_id {kind}, score double")
    return out.select(F.col("_id").alias(id_col), F.coalesce(held_out("_id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that toxicity() predicts 0 for, all columns unchanged, in one pass without a shuffle.

    Rows with null or empty text, and null or repeated identifiers, are judged by their text alone as
    all others, and each by itself. An empty table gives no rows; without labels see fit()."""
    small_batches(docs.sparkSession)
    model = fit(docs, labels, id_col, text_col)
    score = _score(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = pa.array(["" if x is None else str(x) for x in b.column(text_col).to_pylist()], pa.string())
            got = next(score(iter([pa.RecordBatch.from_arrays([text, text], ["_id", "_text"])])))
            yield b.filter(pa.array([x < 0.5 for x in got.column("score").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
