"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's features are character-class shares, word
repetition and shape, and the same of the lines before and after it; the chain
adds a weight for each pair of neighbouring labels. A training document gives its label
to all its lines. Scoring runs forward and backward over all lines of a text;
the marginals of *good*, weighted by line length, average to the document's
share of good text. The score is the probability of label 1 given that share,
by a logistic curve fitted to the training documents.

Training uses a bounded sample of whole documents: of the labelled training
documents the ``TRAIN_DOCS`` with the lowest hash of their id, and of these, in
the same order, as many as have ``SAMPLE_LINES`` lines in all; a document with
more lines than that is not learned from. Of rows with the same id, the text
with the lowest hash is learned from. Scoring has no such bounds.

Defined results: null or empty text is one empty line and is scored like any
other; a document with several labels counts as the highest; null labels and
ids are not learned from; a null id is not held out. Without labels of both kinds every score is
the share of label 1 (0.5 if there is none). Rows are mapped one to one;
existing columns named score or predicted are replaced.
"""

from __future__ import annotations

import math
from array import array
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.llm.common import add_columns, materialize, slices, texts_of
from airlake.llm.language_id import held_out

TRAIN_DOCS = 6000
#: Lines of the whole sample: 39 features of 8 bytes each, 120 MB.
SAMPLE_LINES = 384_000
#: Lines of a text whose features are held at once.
LINE_BLOCK = 4096
EPOCHS = 150
LEARNING_RATE = 0.1
PENALTY = 1e-3
THRESHOLD = 0.3

UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = b"0123456789"
SPACES = b" \t\r\x0b\x0c"
SYMBOLS = b"|#*%&$@<>{}[]~^_=+\\/"
MARKS = b".,;:!?'\"()-"
N_OWN = 13


def line_features(line: str) -> list[float]:
    raw = line.encode()
    n = len(raw)
    if not n:
        return [1.0] + [0.0] * (N_OWN - 2) + [1.0]

    def share(of: bytes) -> float:
        return (n - len(raw.translate(None, of))) / n

    words = line.split()
    many = max(1, len(words))
    return [
        1.0,
        math.log1p(n) / 8,
        share(UPPER),
        share(DIGITS),
        share(SPACES),
        share(SYMBOLS),
        share(MARKS),
        sum(map(eq, words, words[1:])) / many,
        len(set(words)) / many,
        n / many / 16,
        float(raw[-1:] in b".!?"),
        float(line[0].isupper()),
        0.0,
    ]


def chain_features(lines: list[str]) -> np.ndarray:
    """Own features of every line and those of its neighbours."""
    own = np.array([line_features(x) for x in lines])
    out = np.zeros((len(lines), 3 * N_OWN))
    out[:, :N_OWN] = own
    out[1:, N_OWN : 2 * N_OWN] = own[:-1]
    out[:-1, 2 * N_OWN :] = own[1:]
    return out


def line_odds(lines: list[str], weights: np.ndarray) -> np.ndarray:
    """Score of good against bad per line, from features of ``LINE_BLOCK`` lines at a time."""
    out = np.empty(len(lines))
    for at in range(0, len(lines), LINE_BLOCK):
        before = min(at, 1)  # a line's neighbours may be in other blocks
        own = chain_features(lines[at - before : at + LINE_BLOCK + 1])
        out[at : at + LINE_BLOCK] = (own @ weights)[before : before + LINE_BLOCK]
    return np.clip(out, -30, 30)


def line_lengths(lines: list[str]) -> np.ndarray:
    return np.array([len(x) + 1 for x in lines], dtype=np.float64)


def marginals(odds: np.ndarray, links: np.ndarray) -> np.ndarray:
    """Probability of *good* for every line. ``odds``: score of good against
    bad per line; ``links``: 2 x 2 scores of label pairs (bad 0, good 1)."""
    top = links.max()
    (bb, bg), (gb, gg) = np.exp(links - top).tolist()
    # each line's pair of potentials, scaled to a maximum of 1
    def potentials(at):
        own = odds[at : at + LINE_BLOCK]
        return np.exp(np.minimum(-own, 0)).tolist(), np.exp(np.minimum(own, 0)).tolist()

    # numbers of all lines are in arrays, those of a block in lists
    forward_bad, forward_good = array("d"), array("d")
    out, starts = np.empty(len(odds)), range(0, len(odds), LINE_BLOCK)
    b, g = 1.0, 1.0
    for at in starts:
        for i, (pb, pg) in enumerate(zip(*potentials(at), strict=True), at):
            b, g = (pb, pg) if i == 0 else (pb * (b * bb + g * gb), pg * (b * bg + g * gg))
            total = b + g
            b, g = b / total, g / total
            forward_bad.append(b)
            forward_good.append(g)
    b, g = 1.0, 1.0
    for at in reversed(starts):
        bad, good = potentials(at)
        for i in range(at + len(bad) - 1, at - 1, -1):
            fb, fg = forward_bad[i], forward_good[i]
            out[i] = fg * g / (fb * b + fg * g)
            pb, pg = bad[i - at] * b, good[i - at] * g
            b, g = bb * pb + bg * pg, gb * pb + gg * pg
            total = b + g
            b, g = b / total, g / total
    return out


def fit(chains: list[np.ndarray], labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(feature weights, 2 x 2 link scores) of highest penalised likelihood, by
    full-batch gradient steps (Adam). All chains lie one behind another; the
    recursions go by the ratio of good to bad, one number per line."""
    x = np.concatenate(chains)
    size = len(x)
    stops = np.cumsum([len(c) for c in chains])
    bounds = list(zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True))
    y = np.repeat(np.array(labels), [len(c) for c in chains])
    linked = np.ones(size - 1, dtype=bool)  # a line and the next are of one chain
    linked[stops[:-1] - 1] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (np.array(labels), np.array(labels)), [len(c) - 1 for c in chains])
    weights, links = np.zeros(3 * N_OWN), np.zeros((2, 2))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (weights, links)]
    for step in range(1, EPOCHS + 1):
        ratio = np.exp(np.clip(x @ weights, -30, 30))
        (bb, bg), (gb, gg) = np.exp(links).tolist()
        own = ratio.tolist()
        forward, backward = [], [1.0] * size
        for start, stop in bounds:
            r = own[start]
            forward.append(r)
            for p in own[start + 1 : stop]:
                r = p * (bg + gg * r) / (bb + gb * r)
                forward.append(r)
            r = 1.0
            for t in range(stop - 1, start, -1):
                r *= own[t]
                backward[t - 1] = r = (gb + gg * r) / (bb + bg * r)
        before, after = np.array(forward), np.array(backward)
        both = before * after
        slope = y - both / (1 + both)
        ahead = (ratio * after)[1:][linked]
        before = before[:-1][linked]
        joint = np.stack((np.full_like(ahead, bb), bg * ahead, gb * before, gg * before * ahead))
        expected = (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
        grads = (slope @ x / size - PENALTY * weights, (seen - expected) / size - PENALTY * links)
        for value, grad, (m, v) in zip((weights, links), grads, moments, strict=True):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value += LEARNING_RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return weights, links


def good_share(odds: np.ndarray, length: np.ndarray, links: np.ndarray) -> float:
    """Log odds of the length-weighted mean marginal of *good*."""
    mean = min(max(float(marginals(odds, links) @ length / length.sum()), 1e-6), 1 - 1e-6)
    return math.log(mean / (1 - mean))


def calibrate(shares: list[float], labels: list[int]) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton steps with a small
    penalty, so that separable labels have an answer."""
    x = np.stack((np.array(shares), np.ones(len(shares))), axis=1)
    y, curve = np.array(labels, dtype=float), np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        curve += np.linalg.solve(hessian, x.T @ (y - p) - 0.1 * curve)
    return float(curve[0]), float(curve[1])


def last_spot(sizes: list[tuple[int, int]]) -> int | None:
    """Where the sample ends: of documents (spot, lines) in order of spot, the
    last one up to which all have at most ``SAMPLE_LINES`` lines."""
    total, last = 0, None
    for spot, n in sorted(sizes):
        total += n
        if total > SAMPLE_LINES:
            break
        last = spot
    return last


def train(docs: DataFrame, labels: DataFrame) -> tuple:
    """(weights, links, curve, share of label 1) learned from labelled documents
    that are not held out; weights are None without labels of both kinds."""
    known = (
        labels.where("doc_id is not null and quality is not null")
        .where(~held_out("doc_id", 5, 0))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("_label"))
    )
    picked = (
        known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAIN_DOCS)
    )

    def features(batches):
        for part in slices(batches):
            rows = []
            for text, label in zip(texts_of(part, "text"), part.column("_label").to_pylist(), strict=True):
                lines = text.split("\n")
                rows.append((int(label), chain_features(lines).tobytes(), line_lengths(lines).tobytes()))
            if rows:
                kinds = (pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["y", "x", "n"]
                )

    # at most TRAIN_DOCS ids are broadcast; one text of each leaves the aggregation, however many rows hold its id
    text = F.coalesce(F.col("text"), F.lit(""))
    sample = (
        docs.select("doc_id", text.alias("text"))
        .join(F.broadcast(picked), "doc_id")
        .groupBy("doc_id", "_label")
        .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("_row"))
        .select(F.xxhash64("doc_id").alias("spot"), "_row.text", "_label")
    )
    n_lines = F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"))) + 1
    sample = materialize(sample.withColumn("n", n_lines).where(F.col("n") <= SAMPLE_LINES), "quality-sample")
    last = last_spot(sample.select("spot", "n").collect())  # two numbers per document, TRAIN_DOCS at most
    sample = sample.where(F.col("spot") <= last).select("text", "_label")
    rows = sample.mapInArrow(features, "y int, x binary, n binary").collect()
    rows.sort(key=lambda r: (r["y"], bytes(r["x"])))  # the same order in every run
    labels_ = [r["y"] for r in rows]
    share = sum(labels_) / len(labels_) if rows else 0.5
    if len(set(labels_)) < 2:
        return None, None, None, share
    chains = [np.frombuffer(r["x"], dtype=np.float64).reshape(-1, 3 * N_OWN) for r in rows]
    weights, links = fit(chains, labels_)
    odds = [np.clip(c @ weights, -30, 30) for c in chains]
    shares = [good_share(o, np.frombuffer(r["n"]), links) for o, r in zip(odds, rows, strict=True)]
    return weights, links, calibrate(shares, labels_), share


def score_documents(docs: DataFrame, model: tuple) -> DataFrame:
    """``docs`` plus score (0 to 1) and predicted (1 if score >= 0.3)."""
    weights, links, curve, share = model

    def score(text: str) -> float:
        if weights is None:
            return share
        lines = text.split("\n")
        log_odds = good_share(line_odds(lines, weights), line_lengths(lines), links)
        return 1 / (1 + math.exp(-min(max(curve[0] * log_odds + curve[1], -30.0), 30.0)))

    def make():
        return lambda part: [pa.array([score(t) for t in texts_of(part, "text")], pa.float64())]

    scored = add_columns(docs.drop("predicted"), "score double", make)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    model = train(docs, labels)
    rows = docs.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "text")
    return score_documents(rows, model).drop("text")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # its own score column, if any, stays as it is
    rows = docs.select("text", whole.alias("row"))
    return score_documents(rows, train(docs, labels)).where("predicted = 1").select("row.*")
