"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad.  Its score is linear in features of the line itself and of the lines
before and after it; a 2 x 2 table scores the labels of neighbouring lines.  Forward-backward gives
each line's probability of being good, and a document's score is their mean weighted by line
length.  The field is fitted by gradient ascent on its log-likelihood, each line of a training
document bearing the document's label.

Only the training sample is bounded: of ``sample_docs`` labelled documents of smallest hash, the
``sample_chains`` chains of ``TRAIN_LINES`` lines of smallest hash, from anywhere in a document.  Features
are made where the rows lie; the driver receives a few numbers for each line of these chains.

Defined cases: null or empty text -> one empty line, scored like any; rows with a null doc_id are
scored (their remainder is that of the empty text, 0); repeated rows are scored each; labels with a
null doc_id or quality are left out; without labels of both kinds the score is the share of label 1
(0.5 without any label); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.llm.common import small, texts_of

THRESHOLD, SAMPLE_DOCS, FOLDS = 0.3, 4000, 5
SAMPLE_CHAINS = 16384  # at most 50 MB of features of lines
TRAIN_LINES = 48  # longer training documents are cut into chains of this many lines
#: Classes of bytes: upper case, lower case, digits, space, stops, other ASCII marks, the rest.
_CLASS = bytes(
    ord("u") if 65 <= c < 91 else ord("l") if 97 <= c < 123 else ord("d") if 48 <= c < 58
    else ord("s") if c in b" \t\r\x0b\x0c" else ord("p") if c in b".,;:?'\"()-" else ord("m") if c < 128 else ord("h")
    for c in range(256))
OWN = 16
WIDTH = 3 * OWN + 2
MAX_CELLS = 1 << 18  # lines of one padded group of documents


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines x OWN features, line weights) of one document."""
    lines = text.split("\n")
    rows, seen = [], set()
    for line in lines:
        raw = line.encode("utf-8", "replace")
        kinds = raw.translate(_CLASS)
        n = len(raw) + 1
        up, low, digits, stops, marks, high = (kinds.count(k) for k in (b"u", b"l", b"d", b"p", b"m", b"h"))
        words = raw.split()
        many = len(words) + 1
        parts = [p for p in raw.split(b".") if len(p) > 12]
        old = sum(p in seen for p in parts)
        again = sum(map(eq, words, words[1:])) / many
        seen.update(parts)
        letters = up + low + high + 1
        rows.append((
            1.0, min(n, 2000) / 1000, up / letters, float(up > 0.5 * letters), digits / n, stops / many,
            marks / n, float(marks > 0.02 * n), float(marks > 0.08 * n),
            len(set(words)) / many, (len(raw) - len(words)) / many / 10, old / (len(parts) + 1),
            float(2 * old > len(parts) > 0), float(not words), again, float(again > 0.3)))
    return np.array(rows), np.array([len(x) + 1.0 for x in lines])


def with_neighbours(own: np.ndarray) -> np.ndarray:
    """Features of every line with those of the lines before and after it, and whether it is first or last."""
    full = np.zeros((len(own), WIDTH))
    full[:, :OWN] = own
    full[1:, OWN:2 * OWN] = own[:-1]
    full[:-1, 2 * OWN:3 * OWN] = own[1:]
    full[0, -2] = full[-1, -1] = 1.0
    return full


@dataclass
class Field:
    """Weights of label good (bad scores 0), and the scores of neighbouring labels [from, to]."""

    weights: np.ndarray
    steps: np.ndarray
    constant: float | None = None


def forward_backward(emit: np.ndarray, lengths: np.ndarray, steps: np.ndarray):
    """For padded sequences, longest first: P(good) [N, T], sums of label pairs [2, 2], log partition [N].

    ``emit``: [N, T] score of label good.  Messages are normalised at every line, so no length overflows.
    """
    n, t = emit.shape
    move = np.exp(steps)
    # exp of (0, score) less its maximum
    psi = np.exp(np.stack([np.zeros_like(emit), emit], axis=2) - np.maximum(emit, 0)[:, :, None])
    live = [int(np.searchsorted(-lengths, -k, side="left")) for k in range(t)]  # sequences longer than k
    a, b, scale = np.zeros((n, t, 2)), np.ones((n, t, 2)), np.zeros((n, t))
    for k in range(t):
        m = live[k]
        v = psi[:m, k] if k == 0 else (a[:m, k - 1] @ move) * psi[:m, k]
        scale[:m, k] = s = v.sum(axis=1)
        a[:m, k] = v / s[:, None]
    pairs = np.zeros((2, 2))
    for k in range(t - 2, -1, -1):
        m = live[k + 1]
        back = psi[:m, k + 1] * b[:m, k + 1] / scale[:m, k + 1, None]
        b[:m, k] = back @ move.T
        pairs += np.einsum("ni,ij,nj->ij", a[:m, k], move, back)
    on = np.arange(t)[None, :] < lengths[:, None]
    both = a * b
    good = np.where(on, both[:, :, 1] / np.maximum(both.sum(axis=2), 1e-300), 0)
    log_z = np.where(on, np.log(np.where(on, scale, 1)) + np.maximum(emit, 0), 0).sum(axis=1)
    return good, pairs, log_z


def _groups(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Indices of documents, longest first, in groups whose padded size is bounded."""
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        size = max(1, MAX_CELLS // int(lengths[order[at]]))
        # not many short ones behind a long one
        upto = min(len(order), at + size)
        short = at + int(np.searchsorted(-lengths[order[at:upto]], -(lengths[order[at]] // 2), side="right"))
        upto = max(at + 1, min(upto, max(short, at + 1)))
        yield order[at:upto]
        at = upto


def _padded(full: list[np.ndarray], group: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(full[i]) for i in group])
    emit = np.zeros((len(group), lengths.max()))
    for r, i in enumerate(group):
        emit[r, :lengths[r]] = full[i] @ weights
    return emit, lengths


def fit(full: list[np.ndarray], labels: np.ndarray, rounds: int = 150, rate: float = 0.2,
        ridge: float = 1e-4) -> Field:
    """Adam ascent on the mean log-likelihood of the lines of labelled chains, less a ridge."""
    if len(labels) == 0 or labels.min() == labels.max():
        return Field(np.zeros(WIDTH), np.zeros((2, 2)), float(labels.mean()) if len(labels) else 0.5)
    lengths = np.array([len(x) for x in full])
    total = lengths.sum()
    groups = [(g, np.concatenate([full[i] for i in g])) for g in _groups(lengths)]
    theta, first, second = np.zeros(WIDTH + 4), np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)
    for step in range(1, rounds + 1):
        w, steps = theta[:WIDTH], theta[WIDTH:].reshape(2, 2)
        up = np.zeros_like(theta)
        for group, rows in groups:
            own = lengths[group]
            on = np.arange(own[0])[None, :] < own[:, None]
            emit = np.zeros(on.shape)
            emit[on] = rows @ w
            good, pairs, _ = forward_backward(emit, own, steps)
            truth = np.repeat(labels[group][:, None], own[0], axis=1)
            up[:WIDTH] += rows.T @ (truth - good)[on]
            met = np.zeros((2, 2))
            for y in (0, 1):
                met[y, y] = (own - 1)[labels[group] == y].sum()
            up[WIDTH:] += (met - pairs).ravel()
        up = up / total - ridge * theta
        first = 0.9 * first + 0.1 * up
        second = 0.99 * second + 0.01 * up * up
        theta = theta + rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return Field(theta[:WIDTH], theta[WIDTH:].reshape(2, 2))


def scores(texts: list[str], field: Field) -> np.ndarray:
    """Length-weighted mean of the lines' probabilities of being good."""
    if field.constant is not None:
        return np.full(len(texts), field.constant)
    out = np.zeros(len(texts))
    made = [line_features(t) for t in texts]
    full = [with_neighbours(x) for x, _ in made]
    for group in _groups(np.array([len(x) for x in full], dtype=np.int64)):
        emit, lengths = _padded(full, group, field.weights)
        good, _, _ = forward_backward(emit, lengths, field.steps)
        for r, i in enumerate(group):
            weight = made[i][1]
            out[i] = float(good[r, :lengths[r]] @ weight / weight.sum())
    return np.clip(out, 0.0, 1.0)


def remainder(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def cut_chain(own: np.ndarray, nth: int) -> bytes:
    """The lines of a document's chain ``nth``, with the line before and the line after it if there are any."""
    at = nth * TRAIN_LINES
    return own[max(0, at - 1):at + TRAIN_LINES + 1].astype(np.float32).tobytes()


def chain_features(cut: bytes, nth: int) -> np.ndarray:
    """Features with neighbours of the lines of a chain that ``cut_chain`` cut."""
    own = np.frombuffer(cut, np.float32).reshape(-1, OWN).astype(float)
    at = int(nth > 0)
    full = with_neighbours(own)
    return full[at:at + TRAIN_LINES]


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chains: int = SAMPLE_CHAINS) -> Field:
    """Field fitted on labelled rows outside fold 0."""
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (remainder() != 0))
              .select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_docs))
    # At most ``sample_docs`` rows of two numbers are broadcast.
    texts = texts_of(docs).join(F.broadcast(chosen), "doc_id")
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    # Chains are chosen by numbers alone; at most ``sample_chains`` rows of three numbers are broadcast.
    chains = (texts.select("doc_id", "quality", F.explode(F.sequence(F.lit(0), F.floor((lines - 1) / TRAIN_LINES).cast("int"))).alias("nth"))
              .distinct().orderBy(F.xxhash64("doc_id", "nth"), "doc_id", "nth", "quality").limit(sample_chains)
              .groupBy("doc_id", "quality").agg(F.collect_list("nth").alias("chains")))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["doc_id", "quality", "nth", "lines"], [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for b in small(batches):
            rows = []
            for doc, quality, text, wanted in zip(*(c.to_pylist() for c in b.columns)):
                own = line_features(text)[0]
                # a repeated id may have a shorter text
                rows += [(doc, quality, k, cut_chain(own, k)) for k in wanted if k * TRAIN_LINES < len(own)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    rows = (texts_of(docs).join(F.broadcast(chains), "doc_id").select("doc_id", "quality", "text", "chains")
            .mapInArrow(features, "doc_id long, quality int, nth int, lines binary")
            .groupBy("doc_id", "quality", "nth").agg(F.min("lines").alias("lines"))  # repeated rows of a document
            .collect())
    rows.sort(key=lambda r: (r["doc_id"], r["quality"], r["nth"]))
    return fit([chain_features(r["lines"], r["nth"]) for r in rows], np.array([r["quality"] for r in rows], dtype=float))


def score_documents(docs: DataFrame, field: Field, threshold: float = THRESHOLD, carry: tuple = ()) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, and the columns of ``carry``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            own = scores(b.column("text").to_pylist(), field)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[b.column(c) for c in carry], pa.array(own)],
                                             ["doc_id", *carry, "score"])

    texts = texts_of(docs, carry=carry)
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields if f.name in carry]
    return (texts.mapInArrow(run, ", ".join(["doc_id long", *kept, "score double"]))
            .select("doc_id", *carry, (remainder() == 0).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, field: Field, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the field accepts, all columns as they are."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for b in small(batches):
            own = scores([t or "" for t in b.column(at).to_pylist()], field)
            yield b.filter(pa.array(own >= threshold))

    return docs.mapInArrow(run, docs.schema)
