"""Quality classifier by importance resampling (operator 10).

Two generative models over hashed n-grams: the target (labelled good texts) and the raw corpus (all texts).  A text's
log-weight is the sum over its n-grams of the log ratio of the two models; adding Gumbel noise and taking the ``k``
largest draws ``k`` texts without replacement in proportion to the weights.  N-grams are words, word pairs, and pairs
and triples of token shapes (case, digits, sign, repeats the word before).  The raw model counts every document.  ``k``
is how many documents weigh at least as much as the log-weight that best parts the labelled rows.

The ``k``-th largest key is found exactly: histograms with ever finer bins over the written keys, so that the driver
sees bin counts only.

Defined results: a null or empty text has log-weight 0; documents with equal ids and texts get equal keys, and all rows
that tie with the ``k``-th are kept; null ids share their noise; an empty table gives no rows; without labelled rows of both kinds
every document is kept; other columns are not read, and ``keep`` returns them as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecframe.llm.common import SAMPLE_FILES, files_for, filter_text, held_out, labelled_sample, map_text, text_buffer, text_slices, token_runs, written

#: Buckets that n-grams are hashed into.
BUCKETS = 1 << 15
#: Pseudo-counts that lean both models to each other in buckets where the labelled texts' counts say little.
PRIOR = 20.0

# Bytes: 0 white space and controls, 1 letters and digits and everything beyond ASCII, 2 other signs.
KIND = np.array([0 if c <= 32 or c == 127 else 1 if c >= 128 or chr(c).isalnum() else 2 for c in range(256)], np.uint8)
FOLD = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
MIX = np.uint64(0xD6E8FEB86659FD93)


def buckets(column: pa.Array, size: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of texts: ``(bucket, text)`` arrays."""
    raw, at = text_buffer(column)
    if not raw:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(raw, np.uint8)
    kind = KIND[data]
    word, first, end, bound = token_runs(FOLD[data], kind, at)
    n = len(word)
    text = np.repeat(np.arange(len(column)), np.diff(bound))
    place = np.arange(n) - bound[text]
    # shapes
    upper = np.concatenate(([0], np.cumsum((data >= 65) & (data <= 90))))
    digit = np.concatenate(([0], np.cumsum((data >= 48) & (data <= 57))))
    length, caps = end - first, upper[end] - upper[first]
    shape = np.where(digit[end] > digit[first], 4, np.where((caps == length) & (length > 1), 3, np.where(caps > 0, 2, 1)))
    shape = np.where(kind[first] == 2, 16 + data[first] * 4 + np.minimum(length, 3), shape)
    again = np.zeros(n, bool)
    for back in (1, 2):
        again[back:] |= (word[back:] == word[:-back]) & (place[back:] >= back)
    shape = np.where(again & (kind[first] == 1), 9, shape).astype(np.uint64)

    def gram(parts, salt):
        mixed = np.uint64(salt * int(MIX) & (1 << 64) - 1)
        for part in parts:
            mixed = (mixed ^ part) * MIX
            mixed ^= mixed >> np.uint64(29)
        return ((mixed * MIX) >> np.uint64(40)).astype(np.int64) % size

    out, of = [gram([word], 1)], [text]
    for parts, salt in ((word, 2), (shape, 3)):
        at2 = np.flatnonzero(place >= 1)
        out.append(gram([parts[at2 - 1], parts[at2]], salt))
        of.append(text[at2])
    at3 = np.flatnonzero(place >= 2)
    out.append(gram([shape[at3 - 2], shape[at3 - 1], shape[at3]], 4))
    of.append(text[at3])
    return np.concatenate(out), np.concatenate(of)


def counted(docs: DataFrame, text_col: str = "text", size: int = BUCKETS) -> np.ndarray:
    """N-grams in each bucket over all rows: counted per task, then summed by bucket."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for part in text_slices(batch, 0):
                total += np.bincount(buckets(part.column(0), size)[0], minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    rows = docs.select(text_col).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size, np.int64)  # one row a bucket at most
    for r in rows:
        out[r[0]] = r[1]
    return out


@dataclass
class Model:
    """Log ratio of target to raw by bucket, and the log-weight that parts good from bad."""

    ratio: np.ndarray
    cut: float


def log_weights(column: pa.Array, ratio: np.ndarray) -> np.ndarray:
    bucket, text = buckets(column, len(ratio))
    return np.round(np.bincount(text, weights=ratio[bucket], minlength=len(column)), 6)


def parting(weight: np.ndarray, good: np.ndarray) -> float:
    """The middle of the widest gap of weights that parts the rows with the best balanced accuracy."""
    order = np.argsort(weight, kind="stable")
    weight, good = weight[order], good[order]
    n1, n0 = max(1, good.sum()), max(1, (~good).sum())
    # cutting before row i: bad rows below are right, good rows from i on are right
    right = np.concatenate(([0], np.cumsum(~good))) / n0 + 1 - np.concatenate(([0], np.cumsum(good))) / n1
    low, high = np.concatenate(([weight[0] - 2], weight)), np.concatenate((weight, [weight[-1] + 2]))
    gap = np.where((right >= right.max() - 1e-12) & (high > low), high - low, -1)
    i = int(gap.argmax())
    return float((low[i] + high[i]) / 2)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = BUCKETS) -> Model:
    """Raw model from all of ``docs``; target model and parting weight from a bounded sample of labelled rows."""
    sample = written(labelled_sample(docs, labels, "quality", id_col, text_col, held_out=held_out), "labelled", SAMPLE_FILES, dealt=True)
    raw, good = counted(docs, text_col, size), counted(sample.where("label = 1"), "text", size)
    if not good.sum() or sample.where("label = 0").isEmpty():
        return Model(np.zeros(size), -np.inf)
    expected = raw * (good.sum() / raw.sum())  # were the target as the corpus is
    ratio = np.log((good + PRIOR) / (expected + PRIOR))
    rows = map_text(sample, ["label", "text"], lambda b: (b.column(0), log_weights(b.column(1), ratio)), "label int, w double").collect()
    return Model(ratio, parting(np.array([r[1] for r in rows]), np.array([r[0] == 1 for r in rows])))


def gumbel(doc_id, seed: int):
    """Gumbel noise that depends on the id alone, so that a task that runs again draws the same."""
    u = (F.pmod(F.xxhash64(F.lit(seed), doc_id.cast("string")), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", seed: int = 7) -> DataFrame:
    """``(id, log_weight, key)`` of every row; the key is the log-weight with Gumbel noise."""
    kind = docs.schema[id_col].dataType.simpleString()
    ratio = docs.sparkSession.sparkContext.broadcast(model.ratio)
    rows = map_text(docs, [id_col, text_col], lambda b: (b.column(0), log_weights(b.column(1), ratio.value)), f"`{id_col}` {kind}, log_weight double")
    return rows.withColumn("key", F.col("log_weight") + gumbel(F.col(id_col), seed))


def kth_largest(values: DataFrame, column: str, k: int, bins: int = 4096) -> float:
    """The exact ``k``-th largest value, from histograms over narrowing ranges."""
    x = F.col(column)
    low, high = values.agg(F.min(x), F.max(x)).first()
    while True:
        if low == high:
            return low
        step = (high - low) / bins
        bin_of = F.least(F.floor((x - low) / step), F.lit(bins - 1)).cast("int")
        inside = values.where(x.between(low, high))
        rows = inside.groupBy(bin_of.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi")).collect()
        for r in sorted(rows, reverse=True):
            if k <= r.n:
                if r.lo == r.hi or step <= 0 or (r.lo, r.hi) == (low, high):
                    return r.lo if r.lo == r.hi else inside.where(x >= r.lo).orderBy(x.desc()).limit(k).agg(F.min(x)).first()[0]
                low, high = r.lo, r.hi
                break
            k -= r.n
        else:
            return low


def chosen(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int | None = None,
           seed: int = 7) -> tuple[DataFrame, Model, float]:
    """``(scored rows, model, key that the last chosen row has)``."""
    model = fit(docs, labels, id_col, text_col)
    rows = written(scores(docs, model, id_col, text_col, seed), "weights", files_for(docs.count()), dealt=True)
    k = rows.where(F.col("log_weight") >= model.cut).count() if k is None else k
    return rows, model, kth_largest(rows, "key", k) if k and not rows.isEmpty() else np.inf if k == 0 else -np.inf


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int | None = None, seed: int = 7) -> DataFrame:
    """``(id, log_weight double, key double, kept boolean)`` of every row."""
    rows, _, last = chosen(docs, labels, id_col, text_col, k, seed)
    return rows.withColumn("kept", F.col("key") >= F.lit(float(last)))


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int | None = None, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` that are chosen."""
    _, model, last = chosen(docs, labels, id_col, text_col, k, seed)
    ratio = docs.sparkSession.sparkContext.broadcast(model.ratio)
    # the noise is a column so that the task adds just what ``scores`` added
    noise = "__vf_noise"
    marked = docs.withColumn(noise, gumbel(F.col(id_col), seed))

    def decide(batch, at):
        key = log_weights(batch.column(at), ratio.value) + batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
        return key >= last

    return filter_text(marked, text_col, decide).select(*docs.columns)
