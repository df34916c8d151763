"""Quality rules and a linear-chain CRF that marks lines as content or boilerplate."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import materialize, small_batches

#: Labelled rows that training takes at most, with all their lines.
TRAIN_ROWS = 4000
#: Bytes of texts that are measured side by side (one text may have more).
SIDE_BY_SIDE = 4 << 20
SYMBOLS = b"#*$%&|<>"
_SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def _bytes_in(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SPACE, _SYMBOL, _DIGIT, _MARK = _bytes_in(_SPACES), _bytes_in(SYMBOLS), _bytes_in(b"0123456789"), _bytes_in(b"!?{}[]()=;_~^")
_UPPER = _bytes_in(bytes(range(65, 91)))
_LETTER = _UPPER | _bytes_in(bytes(range(97, 123)))
_END = _bytes_in(b".!?:;\"',|").astype(np.int64) + _bytes_in(b".!?:;\"'")
#: Edges of the buckets into which a line's measures fall.
EDGES = {
    "symbols": (0.01, 0.03, 0.06, 0.12, 0.25),
    "upper": (0.05, 0.15, 0.3, 0.6),
    "repeat": (0.1, 0.25, 0.4, 0.6, 0.8),
    "words": (1, 3, 6, 12, 30, 80),
    "mean_word": (2, 3, 4, 6, 9),
    "digits": (0.02, 0.1, 0.3),
    "marks": (0.03, 0.08, 0.15, 0.3),
    "copies": (1, 2, 4),
    "end": (1, 2),
}
#: What a line's measures say of it before any training, as log-odds of content by bucket: symbols,
#: shouting, words or lines that repeat and signs speak against it, a sentence of several words for it.
EVIDENCE = {
    "symbols": (0.5, 0, -3, -3, -3, -3), "upper": (0, 0, 0, 0, -3), "repeat": (0, 0, 0, -1, -3, -3), "words": (0, -1, 0, 0, 0.5, 0.5, 0.5), "mean_word": (0, 0, 0, 0, 0, 0),
    "digits": (0, 0, 0, -1), "marks": (0, 0, -1, -2, -3), "copies": (0, 0, -2, -2), "end": (-0.5, -1, 1),
}
#: Log-odds that a document's label adds to each of its lines: boilerplate, content.
BY_LABEL = (-1.0, 1.0)
_OFFSET, N_FEATURES = {}, 1
for _name, _edges in EDGES.items():
    _OFFSET[_name] = N_FEATURES
    N_FEATURES += len(_edges) + 1


#: Log-odds of content by feature; the bias has none.
_EVIDENCE = np.concatenate([[0.0], *[np.array(EVIDENCE[n], "float64") for n in EDGES]])


#: A hash of a word is the sum of its bytes' random values, each times a power of an odd number.
_BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def word_hashes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words raw[begins:ends], all at once by sums of prefixes."""
    powers = np.full(len(raw) + 1, _BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    sums = np.append(np.uint64(0), np.cumsum(_VALUES[raw] * powers[:-1]))
    back = np.full(len(raw) + 1, pow(_BASE, -1, 1 << 64), np.uint64)
    back[0] = 1
    h = (sums[ends] - sums[begins]) * np.cumprod(back)[begins]
    return (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + (ends - begins).astype(np.uint64)


class Base(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int


def repeat_words(ids: np.ndarray, doc: np.ndarray, window: int = 5) -> np.ndarray:
    """Whether each word lies in a window that occurs twice or more in its document, first
    occurrences included. doc: the document of each word, in order."""
    n = len(ids) - window + 1
    out = np.zeros(max(0, len(ids)), bool)
    if n < 2:
        return out
    h = doc[:n].astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
    for k in range(window):
        h = (h ^ ids[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    whole = np.flatnonzero(doc[:n] == doc[window - 1 :])
    order = whole[np.argsort(h[whole], kind="stable")]
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    mark = np.zeros(len(ids) + 1, np.int64)
    mark[:n] += twice
    mark[window : window + n] -= twice
    return np.cumsum(mark)[:-1] > 0


class Lines(NamedTuple):
    """Lines that hold a word, of several documents in order."""

    stats: np.ndarray  # (documents, 5), as Base
    count: np.ndarray  # lines of each document
    at: np.ndarray  # (lines, measures + 1), the active features; the last is the bias
    weight: np.ndarray  # code points in a line's words


def read_lines(texts: list[bytes]) -> Lines:
    """Base counts of each text, and features of each line that holds a word (a bucket per measure).

    All texts are measured side by side as one array of bytes. Measures are shares of a line's code
    points in words, or of its words."""
    data = b"\n".join([*texts, b""])
    lines = data.split(b"\n")[:-1]
    per_doc = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    doc_of_line = np.repeat(np.arange(len(texts)), per_doc)
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw == 10)
    starts = np.append(0, ends[:-1] + 1)
    per_line = lambda mask: np.add.reduceat(mask.view(np.uint8), starts, dtype=np.int64)

    inside = ~_SPACE[raw]
    begins = inside & ~np.append(False, inside[:-1])
    n, n_words = per_line(inside & ((raw & 0xC0) != 0x80)), per_line(begins)
    symbols, letters, upper = per_line(_SYMBOL[raw]), per_line(_LETTER[raw]), per_line(_UPPER[raw])
    last = np.maximum.reduceat(np.where(inside, np.arange(len(raw)), 0), starts)

    hashed = word_hashes(raw, np.flatnonzero(begins), np.flatnonzero(inside & ~np.append(inside[1:], False)) + 1)
    line_of_word = np.repeat(np.arange(len(lines)), n_words)
    order = np.lexsort((hashed, line_of_word))
    a, b = hashed[order], line_of_word[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(hashed)]
    distinct = np.bincount(b[new], minlength=len(lines))
    doc_of_word = doc_of_line[line_of_word]
    repeated = np.bincount(doc_of_word[repeat_words(hashed, doc_of_word)], minlength=len(texts))

    copies, dup, low = np.ones(len(lines), np.int64), np.zeros(len(texts), np.int64), 0
    for i, k in enumerate(per_doc.tolist()):
        part = lines[low : low + k]
        times = Counter(part)
        if len(times) < k:
            copies[low : low + k] = [times[x] for x in part]
            dup[i] = sum(v - 1 for x, v in times.items() if v > 1 and x.strip(_SPACES))
        low += k

    by_doc = lambda x: np.bincount(doc_of_line, x, len(texts)).astype(np.int64)
    stats = np.stack([by_doc(n_words), by_doc(n), by_doc(symbols), dup, repeated], 1)
    kept = np.flatnonzero(n_words > 0)
    n, k = n[kept], n_words[kept]
    values = {
        "symbols": symbols[kept] / n, "upper": upper[kept] / np.maximum(1, letters[kept]), "repeat": 1 - distinct[kept] / k, "words": k, "mean_word": n / k,
        "digits": per_line(_DIGIT[raw])[kept] / n, "marks": per_line(_MARK[raw])[kept] / n, "copies": copies[kept], "end": _END[raw[last[kept]]],
    }
    at = np.zeros((len(kept), len(EDGES) + 1), np.int64)
    for j, (name, edges) in enumerate(EDGES.items()):
        at[:, j] = _OFFSET[name] + np.searchsorted(edges, values[name], "right")
    return Lines(stats, np.bincount(doc_of_line[kept], minlength=len(texts)), at, n.astype("float64"))


def side_by_side(texts: list[bytes]) -> Iterator[Lines]:
    """read_lines() of as many texts at a time as SIDE_BY_SIDE bytes hold."""
    low, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > SIDE_BY_SIDE:
            yield read_lines(texts[low:i])
            low, size = i, 0
        size += len(t)
    if texts:
        yield read_lines(texts[low:])


class Chains:
    """Chains of lines, one behind the other in flat arrays; step t of all chains that are that long
    is one operation."""

    def __init__(self, count: np.ndarray):
        first = np.cumsum(count) - count
        order = np.argsort(-count, kind="stable")
        order = order[count[order] > 0]
        self.first, self.count = first[order], count[order]
        longest = int(self.count[0]) if len(order) else 0
        self.live = np.searchsorted(-self.count, -np.arange(longest), "left")  # chains longer than t

    def steps(self) -> Iterator[np.ndarray]:
        """The lines at place t, t from 1, of the chains that have one."""
        for t in range(1, len(self.live)):
            yield self.first[: self.live[t]] + t

    def steps_back(self) -> Iterator[np.ndarray]:
        for t in range(len(self.live) - 1, 0, -1):
            yield self.first[: self.live[t]] + t


class Crf(NamedTuple):
    """States: 0 boilerplate, 1 content."""

    emit: np.ndarray  # (N_FEATURES, 2)
    move: np.ndarray  # (2, 2)

    def score(self, at: np.ndarray) -> np.ndarray:
        return self.emit[at].sum(1)

    def viterbi(self, at: np.ndarray, count: np.ndarray | None = None) -> np.ndarray:
        """The best path of each chain; count: the lines of each chain (one chain without it)."""
        chains = Chains(np.array([len(at)]) if count is None else count)
        best = self.score(at)
        back = np.zeros((len(at), 2), np.int64)
        for i in chains.steps():
            step = best[i - 1][:, :, None] + self.move
            back[i] = step.argmax(1)
            best[i] += step.max(1)
        path = np.zeros(len(at), np.int64)
        ends = chains.first + chains.count - 1
        path[ends] = best[ends].argmax(1)
        for i in chains.steps_back():
            path[i - 1] = back[i, path[i]]
        return path

    def expect(self, score: np.ndarray, chains: Chains) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Posteriors of the states of each line, of each pair of neighbours, and the pairs' second lines."""
        e, m = np.exp(score - score.max(1, keepdims=True)), np.exp(self.move - self.move.max())
        fwd, bwd = e.copy(), np.ones_like(e)
        for i in chains.steps():
            x = (fwd[i - 1] @ m) * e[i]
            fwd[i] = x / x.sum(1, keepdims=True)
        for i in chains.steps_back():
            x = (e[i] * bwd[i]) @ m.T
            bwd[i - 1] = x / x.sum(1, keepdims=True)
        p = fwd * bwd
        second = np.ones(len(e), bool)
        second[chains.first] = False
        second = np.flatnonzero(second)
        pair = fwd[second - 1][:, :, None] * m * (e * bwd)[second][:, None, :]
        return p / p.sum(1, keepdims=True), pair / pair.sum((1, 2), keepdims=True), second


def train_crf(at: np.ndarray, count: np.ndarray, label: np.ndarray, steps: int = 60, rate: float = 0.5, l2: float = 1e-4) -> Crf:
    """Maximum likelihood for a chain whose states are hidden, by gradient ascent.

    at, count: lines as in Lines; label: 0 or 1 of each document. What is known of a line's state is
    weak: EVIDENCE of its own measures and BY_LABEL of its document, added up as log-odds. The
    gradient is what the chain expects with that evidence less what it expects without, so a document
    may hold content and boilerplate whatever its label. Classes weigh the same in total.
    """
    chains, doc = Chains(count), np.repeat(np.arange(len(count)), count)
    known = np.zeros((len(at), 2))
    known[:, 1] = _EVIDENCE[at].sum(1) + np.array(BY_LABEL)[label][doc]
    share = np.bincount(label[count > 0], minlength=2)
    w = (1 / (2 * np.maximum(1, share[label]) * np.maximum(1, count)))[doc]
    emit, move = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    g2e, g2m = np.full_like(emit, 1e-8), np.full_like(move, 1e-8)
    for _ in range(steps):
        crf = Crf(emit, move)
        score = crf.score(at)
        (p1, q1, second), (p0, q0, _) = crf.expect(score + known, chains), crf.expect(score, chains)
        diff = (p1 - p0) * w[:, None]
        ge = np.stack([np.bincount(at.ravel(), np.repeat(diff[:, s], at.shape[1]), N_FEATURES) for s in range(2)], 1) - l2 * emit
        gm = ((q1 - q0) * w[second][:, None, None]).sum(0) - l2 * move
        g2e, g2m = g2e + ge**2, g2m + gm**2
        emit, move = emit + rate * ge / np.sqrt(g2e), move + rate * gm / np.sqrt(g2m)
    return Crf(emit, move)


def content_shares(lines: Lines, crf: Crf) -> np.ndarray:
    """Code points of words in content lines over those in all lines, by document; 1 without lines."""
    doc = np.repeat(np.arange(len(lines.count)), lines.count)
    total = np.bincount(doc, lines.weight, len(lines.count))
    content = np.bincount(doc, lines.weight * crf.viterbi(lines.at, lines.count), len(lines.count))
    return np.where(total > 0, content / np.maximum(total, 1), 1.0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> Crf | None:
    """A CRF from at most `rows` labelled rows, taken by a hash of their identifiers, all their lines.

    Labels are quality 0 (mostly boilerplate) and 1 (mostly content); null labels and identifiers are
    ignored, of several labels of an identifier the smallest counts, of several rows the smallest
    text; null texts have no lines. None where a class has no row, as with empty tables. Only line
    features of these rows reach the driver.
    """
    known = labels.where("quality in (0, 1)").groupBy(F.col(id_col).alias("_lid")).agg(F.min("quality").alias("_y"))
    known = known.where("_lid is not null").orderBy(F.xxhash64("_lid"), "_lid").limit(rows)
    text = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    sample = text.join(F.broadcast(known), F.col("_id") == F.col("_lid")).groupBy("_lid", "_y").agg(F.min("_text").alias("_text"))  # `rows` rows at most
    sample = sample.select("_lid", "_y", F.col("_text").cast("binary").alias("_text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [x for lines in side_by_side(b.column("_text").to_pylist()) for x in np.split(lines.at.astype("<u1"), np.cumsum(lines.count)[:-1])]
            yield pa.RecordBatch.from_arrays([b.column("_lid"), b.column("_y"), pa.array([x.tobytes() for x in parts], pa.binary())], ["_lid", "_y", "_at"])

    kind = dict(labels.dtypes)[id_col]
    got = materialize(sample.mapInArrow(features, f"_lid {kind}, _y int, _at binary"), "quality-sample").orderBy("_lid").collect()
    if len({r["_y"] for r in got if r["_at"]}) < 2:
        return None
    one = [np.frombuffer(r["_at"], "<u1").astype(np.int64).reshape(-1, len(EDGES) + 1) for r in got]
    return train_crf(np.concatenate(one), np.array([len(x) for x in one]), np.array([r["_y"] for r in got]))


SCHEMA = (
    "_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, content_share double, kept boolean"
)


def _judge(crf: Crf | None, least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            stats, shares = [], []
            for lines in side_by_side(b.column("_text").to_pylist()):
                stats.append(lines.stats)
                shares.append(content_shares(lines, crf) if crf else np.ones(len(lines.stats)))
            stats, share = np.concatenate(stats), np.concatenate(shares)
            n, repeated = stats[:, 0], stats[:, 4]
            bad = (n < 10) | (100 * repeated > 20 * n)
            cols = [pa.array(c, pa.int64()) for c in stats.T]
            names = ["_id", *Base._fields, "base_failed", "content_share", "kept"]
            yield pa.RecordBatch.from_arrays([b.column("_id"), *cols, pa.array(bad, pa.bool_()), pa.array(share, pa.float64()), pa.array(~bad & (share >= least), pa.bool_())], names)

    return run


def line_quality(docs: DataFrame, labels: DataFrame, least_content: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base rules, and the share of content by Viterbi decoding of a linear-chain CRF.

    The CRF is trained on a bounded sample of labelled rows (TRAIN_ROWS, all their lines), whose line
    states are hidden; see train_crf(). Every line of every row is decoded, very long texts too. A row fails the base rules with under 10 words, or with more than
    20 % of its words in 5-word windows that occur twice or more in it. It is kept if it passes
    them and lines marked as content hold least_content of its word characters.

    Null texts count as empty: no words, so the base rules fail. Without labels of both classes
    there is no CRF and all lines count as content. Repeated rows each get their result. An
    empty table gives no rows. Other input columns are ignored.

    Returns id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed, kept boolean, content_share double.
    """
    small_batches(docs.sparkSession)
    crf = fit(docs, labels, id_col, text_col)
    kind = dict(docs.dtypes)[id_col]
    text = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("_text"))
    out = text.mapInArrow(_judge(crf, least_content), SCHEMA.format(kind=kind))
    return out.select(F.col("_id").alias(id_col), *Base._fields, "base_failed", "kept", "content_share")
