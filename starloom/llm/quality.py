"""Quality scores: n-gram indicators scaled by naive Bayes ratios under a linear hinge-loss model."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from starloom.llm import text as tx
from starloom.staging import settle

#: Buckets of hashed n-grams, bytes of the character n-grams, words of the shape n-grams.
BUCKETS, BYTE_GRAMS, SHAPE_GRAMS = 1 << 17, (3, 5), (1, 2, 3)
#: At most so many labelled documents are fitted on, those of the smallest hash of their id, and at most
#: so many buckets of theirs, four bytes each on the driver; the row that would go beyond is the first left out.
MAX_TRAINING_ROWS, MAX_TRAINING_BUCKETS = 4_000, 32_000_000
#: Bytes of text whose features are made at once: some hundred bytes of arrays for each.
FEATURE_BYTES = 1 << 17

_KIND = np.zeros(256, np.uint8)  # 0 other sign, 1 lower or not ASCII, 2 upper, 3 digit
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[128:] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3


def _bucket(code: np.ndarray, kind: int) -> np.ndarray:
    code = (code + np.uint64(kind + 1)) * np.uint64(0x9E3779B97F4A7C15)
    return (code >> np.uint64(64 - 17)).astype(np.uint32)


def _share(part: np.ndarray, whole: np.ndarray, steps: int) -> np.ndarray:
    return (part * steps // np.maximum(whole, 1)).astype(np.uint64)


def features(texts: pa.Array) -> list[np.ndarray]:
    """For each text the n-gram buckets it has, with repeats.

    N-grams are of bytes, and of word shapes: which kinds of characters a word has, its length,
    and whether the word or the word pair stood just before. Four more
    indicators tell the share of distinct words, of capitals, signs and digits, in steps.
    """
    data, offsets = tx.joined(texts)
    rows = len(texts)
    parts: list[list[np.ndarray]] = [[] for _ in range(rows)]
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    for kind, n in enumerate(BYTE_GRAMS):
        code = np.zeros(len(data), np.uint64)
        for k in range(n):
            code |= padded[k : k + len(data)] << np.uint64(8 * k)
        found = _bucket(code, kind)
        for i in range(rows):
            parts[i].append(found[offsets[i] : max(offsets[i], offsets[i + 1] - n + 1)])
    start, end, row = tx.words(data, offsets)
    if len(start):
        prefix = tx.prefix_hashes(tx.lower_ascii(data))
        code = tx.span_hashes(prefix, start, end)
        kinds = _KIND[data]
        n = [np.concatenate([[0], np.cumsum(kinds == k)]) for k in range(4)]
        n = [c[end] - c[start] for c in n]
        size = end - start
        same = np.zeros(len(code), np.uint64)
        for gap in (1, 2):
            same[gap:] |= ((code[gap:] == code[:-gap]) & (row[gap:] == row[:-gap])).astype(
                np.uint64
            ) << np.uint64(gap - 1)
        shape = (
            same
            | np.minimum(n[0], 3).astype(np.uint64) << np.uint64(2)
            | (n[1] > 0).astype(np.uint64) << np.uint64(4)
            | np.minimum(n[2], 2).astype(np.uint64) << np.uint64(5)
            | (n[3] > 0).astype(np.uint64) << np.uint64(7)
            | np.minimum(size // 4, 7).astype(np.uint64) << np.uint64(8)
        )
        first = np.searchsorted(row, np.arange(rows + 1))
        for k in SHAPE_GRAMS:
            grams = np.zeros(max(len(shape) - k + 1, 0), np.uint64)
            for j in range(k):
                grams = grams * np.uint64(2053) + shape[j : len(shape) - k + 1 + j]
            found = _bucket(tx.mix(grams), 10 + k)
            for i in range(rows):
                parts[i].append(found[first[i] : max(first[i], first[i + 1] - k + 1)])
        for i in range(rows):
            a, b = first[i], first[i + 1]
            if b > a:
                whole = np.array([b - a, size[a:b].sum(), size[a:b].sum(), size[a:b].sum()])
                part = [len(np.unique(code[a:b])), *(n[k][a:b].sum() for k in (2, 0, 3))]
                steps = _share(np.array(part), whole, 20)
                parts[i].append(
                    _bucket(tx.mix(steps + np.arange(4, dtype=np.uint64) * np.uint64(64)), 20)
                )
    return [np.concatenate(p) if p else np.empty(0, np.uint32) for p in parts]


@dataclass
class Model:
    """Weights by bucket: ``weight`` with the ratio multiplied in, the squared ratio for the
    length of a document's vector, and the sigmoid that turns margins into scores."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, found: np.ndarray, seen: np.ndarray) -> float:
        """``seen`` is a scratch array of flags, all false before and after."""
        seen[found] = True
        at = np.flatnonzero(seen)
        seen[at] = False
        margin = self.bias + self.weight[at].sum() / max(np.sqrt(self.square[at].sum()), 1e-9)
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40))))


def _descend(
    rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, c: float, epochs: int
) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the L1 hinge loss; every row has length one, plus a bias."""
    w, bias, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(y))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(len(y)):
            slack = 1 - y[i] * (w[rows[i]] @ values[i] + bias)
            new = min(max(alpha[i] + slack / 2, 0.0), c)  # the row's length and the bias make 2
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[rows[i]] += step * values[i]
                bias += step
                worst = max(worst, abs(new - alpha[i]))
                alpha[i] = new
        if worst < 0.02:
            break
    return w, bias


def _sigmoid(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the likeliest sigmoid, with smoothed targets and Newton steps."""
    good, bad = (y > 0).sum(), (y < 0).sum()
    goal = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -40, 40)))
        d, v = p - goal, np.maximum(p * (1 - p), 1e-9)
        g = np.array([(d * margin).sum() + 1e-3 * slope, d.sum()])
        h = np.array([[(v * margin**2).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-9]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(slope), float(shift)


def fit(rows: list[np.ndarray], labels: np.ndarray, c: float = 1.0, epochs: int = 12) -> Model:
    """Fits on rows of distinct buckets and labels 0 and 1.

    With one class only, or no rows, every score is the smoothed share of label 1.
    """
    y = np.where(labels == 1, 1.0, -1.0)
    good, bad = int((y > 0).sum()), int((y < 0).sum())
    if not good or not bad:
        zero = np.zeros(BUCKETS, np.float32)
        return Model(zero, zero, 0.0, 0.0, float(np.log((good + 1) / (bad + 1))))
    count = {s: np.ones(BUCKETS) for s in (1.0, -1.0)}
    for found, side in zip(rows, y):
        count[side][found] += 1
    ratio = np.log(count[1.0] / count[1.0].sum()) - np.log(count[-1.0] / count[-1.0].sum())
    ratio[(count[1.0] == 1) & (count[-1.0] == 1)] = 0  # never seen: says nothing

    def scaled(found: np.ndarray) -> np.ndarray:
        value = ratio[found]
        return (value / max(np.sqrt((value**2).sum()), 1e-9)).astype(np.float32)

    values = [scaled(found) for found in rows]
    # every fifth row is held back once, for the sigmoid alone
    back = np.arange(len(y)) % 5 == 4
    if min((y[back] > 0).sum(), (y[back] < 0).sum()) >= 5:
        use = np.flatnonzero(~back)
        w, bias = _descend([rows[i] for i in use], [values[i] for i in use], y[use], c, epochs)
        held = np.flatnonzero(back)
        margin = np.array([w[rows[i]] @ values[i] + bias for i in held])
        slope, shift = _sigmoid(margin, y[held])
        w, bias = _descend(rows, values, y, c, epochs)
    else:
        w, bias = _descend(rows, values, y, c, epochs)
        slope, shift = _sigmoid(np.array([w[r] @ v + bias for r, v in zip(rows, values)]), y)
    return Model(
        (w * ratio).astype(np.float32), (ratio**2).astype(np.float32), bias, slope, shift
    )


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text has remainder 2 by 4. A null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = MAX_TRAINING_ROWS,
    max_buckets: int = MAX_TRAINING_BUCKETS,
) -> Model:
    """Fits on at most ``max_rows`` labelled documents that are not held out, and on at most
    ``max_buckets`` buckets of theirs in all: the driver holds no more than that, whatever texts
    there are and however often an id occurs.

    The rows of smallest id hash are taken, so the sample does not depend on partitions. Labels
    other than 0 and 1, null ids and null labels are left out; a document with several
    label rows counts as often. Of several documents of one id the least text counts, once.
    """
    usable = F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    chosen = (
        labels.where(usable)
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(max_rows)
    )
    chosen = settle(chosen, "training_labels")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in tx.chunks(batch.column(1), FEATURE_BYTES):
                found = [np.unique(x).astype("<u4") for x in features(batch.column(1).slice(a, b - a))]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a), pa.array([x.tobytes() for x in found], pa.binary()),
                        pa.array([len(x) for x in found], pa.int64()),
                    ],
                    names=["doc_id", "found", "n"],
                )

    # the ids are bounded by max_rows, so they may be broadcast
    ids = chosen.select("doc_id").distinct()
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text"))
    sample = settle(sample.mapInArrow(run, "doc_id bigint, found binary, n bigint"), "training_rows")
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
    # one number a row here, for max_rows rows
    sizes = sample.select("doc_id", "n").join(chosen, "doc_id")
    sizes = sizes.withColumn("total", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    taken = sizes.where(F.col("total") <= max_buckets).select("doc_id", "quality")
    rows = sample.join(taken, "doc_id").select("doc_id", "quality", "found").collect()
    rows.sort(key=lambda r: (r[0], r[1], r[2]))
    return fit(
        [np.frombuffer(r[2], "<u4") for r in rows], np.array([r[1] for r in rows], np.int64)
    )


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with column ``name``, from 0 to 1, higher where label 1 is likelier.

    Only ``text`` is looked at. Null and empty texts have no n-grams and get the score of the bias
    alone. Rows are neither dropped nor added; whole texts are read.
    """
    if name in docs.columns:
        raise ValueError(f"column {name} exists")
    at = docs.columns.index("text")
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType(), False)])
    weights = docs.sparkSession.sparkContext.broadcast(model)  # two arrays of BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, seen = weights.value, np.zeros(BUCKETS, bool)
        for batch in batches:
            scores = [
                fitted.score(found, seen)
                for a, b in tx.chunks(batch.column(at), FEATURE_BYTES)
                for found in features(batch.column(at).slice(a, b - a))
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=schema.names
            )

    return docs.mapInArrow(run, schema)
