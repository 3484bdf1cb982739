"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on the driver, on a bounded sample of
labelled rows; its weights (a few tens of kB) go to the tasks. A text is cut into segments of ``STEPS``
bytes, all bytes belong to one. In a segment two GRUs read forwards and backwards, each position gets a
probability per language, and a document's probabilities are the means over its positions.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostersync.llm.common import col, hash_key, refuse_names, slices

STEPS, HIDDEN = 64, 8
#: Bounds of the training sample: rows per language, and the characters read of each (a window of the
#: text at a hashed place).
SAMPLE_ROWS, SAMPLE_CHARS = 800, 320
#: Parts of the key in which a language's sample is narrowed down before one task sorts the rest.
SAMPLE_PARTS = 64
#: Languages that may give ``SAMPLE_ROWS`` each; with more, each gives fewer.
MOST_LANGUAGES = 256
ROUNDS, BATCH, RATE = 400, 256, 0.02
WIDTH = 4096
UNDETERMINED = "und"
#: How far from chance to certainty a score must come for a document to stay: 0.3 for four languages.
LEAD = 1 / 15


def sigmoid(x: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    out = np.multiply(x, 0.5, out=out)
    np.tanh(out, out=out)
    out *= 0.5
    out += 0.5
    return out


@dataclass
class Weights:
    """Both directions stacked on the first axis; gates in the order update, reset, new."""

    x: np.ndarray  # (2, 3H, 256): what a byte adds to the gates
    u: np.ndarray  # (2, 3H, H)
    b: np.ndarray  # (2, H, 1): inside the reset product of the new state
    v: np.ndarray  # (2, L, H)
    c: np.ndarray  # (L, 1)

    @classmethod
    def fresh(cls, languages: int, hidden: int, seed: int) -> Weights:
        make = np.random.default_rng(seed)
        draw = lambda *shape: (make.standard_normal(shape) * 0.3).astype(np.float32)
        zero = lambda *shape: np.zeros(shape, np.float32)
        return cls(draw(2, 3 * hidden, 256), draw(2, 3 * hidden, hidden), zero(2, hidden, 1), draw(2, languages, hidden), zero(languages, 1))

    def parts(self) -> list[np.ndarray]:
        return [self.x, self.u, self.b, self.v, self.c]


def _both_ways(segments: np.ndarray, t: int) -> np.ndarray:
    """The bytes the two directions read in step ``t``; segments: (N, T)."""
    return np.stack([segments[:, t], segments[:, segments.shape[1] - 1 - t]])


def forward(w: Weights, segments: np.ndarray, trace: list | None = None) -> np.ndarray:
    """Logits (T, L, N) of every position. ``trace`` collects what backpropagation needs."""
    n, steps = segments.shape
    hidden = w.u.shape[2]
    h = np.zeros((2, hidden, n), np.float32)
    logits = np.zeros((steps, w.c.shape[0], n), np.float32)
    logits += w.c
    gates = np.empty((2, 3 * hidden, n), np.float32)
    columns = np.ascontiguousarray(segments.T)
    for t in range(steps):
        read = (columns[t], columns[steps - 1 - t])
        for d in range(2):
            np.take(w.x[d], read[d], axis=1, out=gates[d], mode="clip")
        a = w.u @ h
        gates[:, : 2 * hidden] += a[:, : 2 * hidden]
        zr = sigmoid(gates[:, : 2 * hidden])
        z, r = zr[:, :hidden], zr[:, hidden:]
        inner = a[:, 2 * hidden :]
        inner += w.b
        new = r * inner
        new += gates[:, 2 * hidden :]
        np.tanh(new, out=new)
        before = h
        h = before - new
        h *= z
        h += new
        logits[t] += w.v[0] @ h[0]
        logits[steps - 1 - t] += w.v[1] @ h[1]
        if trace is not None:
            trace.append((before, z, r, new, inner, h))
    return logits


def softmax(logits: np.ndarray, axis: int = 1) -> np.ndarray:
    p = logits - logits.max(axis=axis, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(axis=axis, keepdims=True)
    return p


def gradients(w: Weights, segments: np.ndarray, labels: np.ndarray, mask: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy over all positions, and its gradients through time."""
    n, steps = segments.shape
    hidden = w.u.shape[2]
    trace: list = []
    p = softmax(forward(w, segments, trace))
    weight = (mask.T / mask.sum()).astype(np.float32)  # (T, N)
    loss = float(-(np.log(np.maximum(p[:, labels, np.arange(n)], 1e-9)) * weight).sum())
    out = p
    out[:, labels, np.arange(n)] -= 1
    out *= weight[:, None, :]
    g = Weights(*[np.zeros_like(a) for a in w.parts()])
    g.c[:] = out.sum(axis=(0, 2))[:, None]
    dh = np.zeros((2, hidden, n), np.float32)
    for t in reversed(range(steps)):
        before, z, r, new, inner, h = trace[t]
        pair = np.stack([out[t], out[steps - 1 - t]])
        g.v += pair @ h.transpose(0, 2, 1)
        dh += w.v.transpose(0, 2, 1) @ pair
        da = dh * (1 - z) * (1 - new * new)
        dz = dh * (before - new) * z * (1 - z)
        dr = da * inner * r * (1 - r)
        din = da * r
        g.b += din.sum(axis=2, keepdims=True)
        into = np.concatenate([dz, dr, din], axis=1)
        g.u += into @ before.transpose(0, 2, 1)
        dh = dh * z + w.u.transpose(0, 2, 1) @ into
        on_bytes = np.concatenate([dz, dr, da], axis=1)
        read = _both_ways(segments, t)
        for d in range(2):
            order = np.argsort(read[d], kind="stable")
            there, starts = np.unique(read[d][order], return_index=True)
            g.x[d][:, there] += np.add.reduceat(on_bytes[d][:, order], starts, axis=1)
    return loss, g.parts()


def segment(texts: list[bytes], steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments (N, steps) of all texts, the bytes each holds, and the number of its text.

    A text's last segment is filled up with spaces that count for nothing.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    pieces = -(-sizes // steps)
    raw = np.frombuffer(b"".join(t + b" " * (-len(t) % steps) for t in texts), np.uint8)
    owner = np.repeat(np.arange(len(texts)), pieces)
    held = np.full(len(owner), steps, np.int64)
    ends = np.cumsum(pieces)[pieces > 0] - 1
    held[ends] = (sizes - (pieces - 1) * steps)[pieces > 0]
    return raw.reshape(-1, steps), held, owner


def train(texts: list[bytes], labels: np.ndarray, languages: int, rounds: int = ROUNDS, seed: int = 11) -> Weights:
    """Adam on batches that hold every language equally often."""
    w = Weights.fresh(languages, HIDDEN, seed)
    segments, held, owner = segment(texts)
    of = labels[owner]
    make = np.random.default_rng(seed)
    by = [np.flatnonzero(of == k) for k in range(languages)]
    by = [(k, x) for k, x in enumerate(by) if len(x)]
    first = [np.zeros_like(a) for a in w.parts()]
    second = [np.zeros_like(a) for a in w.parts()]
    each = max(1, BATCH // len(by))
    for step in range(1, rounds + 1):
        chosen = np.concatenate([make.choice(x, each) for _, x in by])
        mask = np.arange(STEPS) < held[chosen, None]
        _, grads = gradients(w, segments[chosen], of[chosen], mask)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * min(1.0, 2 * (1 - (step - 1) / rounds))
        for a, g, m, s in zip(w.parts(), grads, first, second, strict=True):
            g *= min(1.0, 1.0 / max(norm, 1e-9))
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            a -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return w


def document_probabilities(w: Weights, texts: list[bytes]) -> np.ndarray:
    """(texts, languages): mean over all positions of a text; zeros for a text without bytes."""
    segments, held, owner = segment(texts)
    languages = w.c.shape[0]
    total = np.zeros((len(texts), languages))
    for start in range(0, len(segments), WIDTH):
        part, size = segments[start : start + WIDTH], held[start : start + WIDTH]
        p = softmax(forward(w, part))
        short = np.flatnonzero(size < STEPS)
        for i in short:
            p[size[i] :, :, i] = 0
        at = owner[start : start + WIDTH]
        sums = p.sum(axis=0)
        for k in range(languages):
            total[:, k] += np.bincount(at, sums[k], minlength=len(texts))
    sizes = np.array([max(len(t), 1) for t in texts])
    return total / sizes[:, None]


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32 of the id as text, modulo 5, is 0. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[Weights, list[str]] | None:
    """A network and its languages, or None if no row may be learned from.

    Learns from at most ``SAMPLE_ROWS`` rows a language (those with the smallest hash of id and text),
    of each a window of ``SAMPLE_CHARS`` characters. Of more than ``MOST_LANGUAGES`` languages each gives
    fewer, as many as another up to one, so that the sample has ``MOST_LANGUAGES * SAMPLE_ROWS`` rows.
    """
    body = col(text)
    rows = docs.filter(
        col(doc_id).isNotNull() & ~held_out(col(doc_id)) & col(lang).isNotNull() & has_letter(body)
    ).select(
        col(lang).alias("lang"),
        hash_key(col(doc_id), body, seed=3).alias("key"),
        F.substring(body, (F.pmod(F.xxhash64(body), F.greatest(F.length(body) - SAMPLE_CHARS, F.lit(0)) + 1) + 1).cast("int"), F.lit(SAMPLE_CHARS)).alias("window"),
    )
    sample = rows.withColumn("part", F.pmod("key", F.lit(SAMPLE_PARTS)))
    for by in (("lang", "part"), ("lang",)):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("key"))
        sample = sample.withColumn("place", place).filter(F.col("place") <= SAMPLE_ROWS)
    found = sample.select("lang", "key", F.col("window").cast("binary").alias("window"), "place")
    # Every language's first rows before any language's next ones, so all lose alike.
    found = found.orderBy("place", "lang").limit(MOST_LANGUAGES * SAMPLE_ROWS).collect()
    if not found:
        return None
    found.sort(key=lambda r: (r["lang"], r["key"], bytes(r["window"])))
    languages = sorted({r["lang"] for r in found})
    labels = np.array([languages.index(r["lang"]) for r in found])
    return train([bytes(r["window"]) for r in found], labels, len(languages)), languages


def identify(docs: DataFrame, model: tuple[Weights, list[str]] | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every input row, with ``lang_pred`` and ``score`` of its whole text.

    A text that is null or has no letter is ``und`` with score 0, as is every text without a model. Only
    the text is looked at. Of languages with equal probabilities the first in order is named. Rows alike
    get the same answer; an empty table gives no rows. A kept column may not be called like a result.
    """
    refuse_names(keep, ("lang_pred", "score"))
    body = col(text)
    rows = docs.select(F.struct(*[col(c) for c in keep]).alias("row"), F.when(has_letter(body), body.cast("string")).alias("text"))
    if model is None:
        return rows.select("row.*", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, languages = shared.value
        names = np.array([*languages, UNDETERMINED], object)
        for batch in slices(batches, 1, 4 << 20):
            texts = batch.column(1)
            known = pc.is_valid(texts).to_numpy(zero_copy_only=False)
            p = document_probabilities(weights, pc.fill_null(texts, "").cast(pa.binary()).to_pylist())
            best = np.where(known, p.argmax(axis=1), len(languages))
            score = np.where(known, np.clip(p.max(axis=1), 0.0, 1.0), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names[best], pa.string()), pa.array(score, pa.float64())], names=["row", "lang_pred", "score"])

    schema = rows.select("row").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, schema).select("row.*", "lang_pred", "score")


def least_score(languages: int, lead: float) -> float:
    """The score that is ``lead`` of the way from chance to 1; a single language's score is always 1."""
    chance = 1 / languages
    return min(chance + lead * (1 - chance), 1 - 1e-6)


def in_known_language(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", lead: float = LEAD) -> DataFrame:
    """The input without documents whose language is undetermined or scores below ``least_score``.

    Without a model (no row may be learned from) no language can be told: all documents with a letter stay.
    """
    names = tuple(docs.columns)
    model = fit(docs, doc_id, text, lang)
    if model is None:
        return docs.filter(has_letter(col(text)))
    named = identify(docs.select(F.struct(*[col(c) for c in names]).alias("row"), col(text).alias("text")), model, "text", ("row",))
    return named.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score(len(model[1]), lead))).select("row.*")
