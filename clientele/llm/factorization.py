"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j); the pairwise sum is computed in linear time as
half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

The model is fitted on at most ``sample`` labelled rows, those of smallest key hash; scoring covers every row.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.bpe import _arrow
from clientele.llm.common import words_of

SPACE, DIGIT, UPPER, LOWER = b" \t\r\x0b\x0c", b"0123456789", bytes(range(65, 91)), bytes(range(97, 123))
STRUCTURE = (
    "log_bytes", "upper", "digit", "white", "lines", "mark", "symbol", "bracket", "wide", "letters_per_word", "distinct_words",
    "commonest_word", "short_lines", "repeated_lines", "log_words",
)


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 15  # of hashed words
    rank: int = 8
    sample: int = 6000  # labelled rows at most
    epochs: int = 12
    batch: int = 128
    rate: float = 0.02
    decay: float = 1e-4
    seed: int = 7


def structure(text: str, words: list[bytes], counts: dict[bytes, int]) -> list[float]:
    raw = text.encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    of = lambda chars: float(seen[list(chars)].sum()) / n
    lines = [x for x in text.split("\n") if x]
    most = max(counts.values(), default=0)
    return [
        np.log1p(len(raw)), of(UPPER), of(DIGIT), of(SPACE), float(seen[10]) / n, of(b".,;:!?'\"-"), of(b"#$%&*@^~_|/\\+=<>`"),
        of(b"()[]{}"), float(seen[128:].sum()) / n, min(40.0, n / max(1, len(words))), len(counts) / max(1, len(words)),
        most / max(1, len(words)), sum(len(x) < 20 for x in lines) / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(len(words)),
    ]


class Features:
    """Numbers and values of the features of a text: hashed words first, then one number for each statistic."""

    def __init__(self, buckets: int, metadata: int) -> None:
        self.buckets, self.metadata = buckets, metadata
        self.hashes: dict[bytes, int] = {}

    def __call__(self, text: str | None, metadata: list[float | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        text = text or ""
        words = words_of(text)
        counts: dict[bytes, int] = {}
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        hashes = self.hashes
        if len(hashes) > 150_000:
            hashes.clear()
        ids = np.empty(len(counts), np.int64)
        for i, w in enumerate(counts):
            h = hashes.get(w)
            if h is None:
                h = hashes[w] = zlib.crc32(w) % self.buckets
            ids[i] = h
        values = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
        if len(values):
            values /= np.sqrt((values**2).sum())
        known = [0.0 if m is None or not np.isfinite(m) else float(np.sign(m) * np.log1p(abs(m))) for m in metadata]
        return ids, values, np.array(structure(text, words, counts) + known)


@dataclass
class Model:
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    buckets: int

    def inputs(self, ids, values, stats):
        dense = np.clip((stats - self.mean) / self.scale, -4, 4) / np.sqrt(len(stats))
        return np.concatenate([ids, self.buckets + np.arange(len(stats))]), np.concatenate([values, dense])

    def score(self, ids, values, stats) -> float:
        ids, x = self.inputs(ids, values, stats)
        v = self.factor[ids] * x[:, None]
        total = self.bias + self.weight[ids] @ x + 0.5 * float((v.sum(0) ** 2).sum() - (v**2).sum())
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], settings: Settings, width: int) -> Model:
    """Weights by Adam on the log loss, both classes weighing the same; without both classes the score is constant."""
    rng = np.random.default_rng(settings.seed)
    size = settings.buckets + width
    stats = np.array([r[2] for r in rows]).reshape(-1, width)
    y = np.array([r[3] for r in rows], np.float64)
    mean, scale = (stats.mean(0), stats.std(0) + 1e-9) if len(rows) else (np.zeros(width), np.ones(width))
    model = Model(0.0, np.zeros(size), rng.normal(0, 0.02, (size, settings.rank)), mean, scale, settings.buckets)
    share = y.mean() if len(rows) else 0.5
    if share in (0.0, 1.0) or not len(rows):
        model.factor[:] = 0
        model.bias = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        return model
    weigh = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    inputs = [model.inputs(*r[:3]) for r in rows]
    moments = [np.zeros((2, size)), np.zeros((2, size, settings.rank)), np.zeros(2)]
    step = 0
    for _ in range(settings.epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), settings.batch):
            part = order[at : at + settings.batch]
            ids = np.concatenate([inputs[i][0] for i in part])
            x = np.concatenate([inputs[i][1] for i in part])
            sizes = np.array([len(inputs[i][0]) for i in part])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            vx = model.factor[ids] * x[:, None]
            sums = np.add.reduceat(vx, starts)
            total = model.bias + np.add.reduceat(model.weight[ids] * x, starts) + 0.5 * ((sums**2).sum(1) - np.add.reduceat((vx**2).sum(1), starts))
            gap = weigh[part] * (1 / (1 + np.exp(-np.clip(total, -30, 30))) - y[part]) / len(part)
            g = np.repeat(gap, sizes) * x
            used, place = np.unique(ids, return_inverse=True)
            slope = np.bincount(place, g, len(used)) + settings.decay * model.weight[used]
            wide = g[:, None] * (np.repeat(sums, sizes, axis=0) - vx)
            slopes = np.stack([np.bincount(place, wide[:, f], len(used)) for f in range(settings.rank)], 1) + settings.decay * model.factor[used]
            step += 1
            for target, grad, m, where in ((model.weight, slope, moments[0], used), (model.factor, slopes, moments[1], used)):
                m[0, where] = 0.9 * m[0, where] + 0.1 * grad
                m[1, where] = 0.99 * m[1, where] + 0.01 * grad**2
                target[where] -= settings.rate * (m[0, where] / (1 - 0.9**step)) / (np.sqrt(m[1, where] / (1 - 0.99**step)) + 1e-8)
            grad = gap.sum()
            moments[2][:] = 0.9 * moments[2][0] + 0.1 * grad, 0.99 * moments[2][1] + 0.01 * grad**2
            model.bias -= settings.rate * (moments[2][0] / (1 - 0.9**step)) / (np.sqrt(moments[2][1] / (1 - 0.99**step)) + 1e-8)
    return model


def held_out(key: Column) -> Column:
    """The fold that is never learned from: crc32 of the key as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), metadata: tuple[str, ...] = ("n_chars",),
          key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fits on labelled rows outside the held-out fold.

    Null labels and null keys are left out; a key with several labels counts as 1 if their mean is 0.5 or more; of repeated
    documents one is learned from. At most ``settings.sample`` keys are joined and sent to the driver, as features.
    """
    known = (
        labels.select(F.col(key).alias("k"), F.col(label).cast("double").alias("l")).where(F.col("k").isNotNull() & F.col("l").isNotNull())
        .where(~held_out(F.col("k"))).groupBy("k").agg((F.avg("l") >= 0.5).cast("int").alias("l"))
        .orderBy(F.xxhash64("k"), "k").limit(settings.sample)
    )
    features, width = Features(settings.buckets, len(metadata)), len(STRUCTURE) + len(metadata)

    def run(batches):
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            made = [features(t, list(m)) for t, *m in zip(*columns[2:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), *(pa.array([x[i].tolist() for x in made], pa.list_(t)) for i, t in enumerate((pa.int64(), pa.float64(), pa.float64())))],
                names=["h", "l", "ids", "x", "stats"],
            )

    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), *(F.col(m).cast("double").alias(f"m{i}") for i, m in enumerate(metadata)))
    learned = (
        source.join(F.broadcast(known), "k")  # no more rows than the sample
        .select(F.xxhash64("k").alias("h"), "l", "t", *(f"m{i}" for i in range(len(metadata))))
        .mapInArrow(run, "h long, l int, ids array<long>, x array<double>, stats array<double>")
    )
    return fit(_distinct(learned.toArrow()), settings, width)  # one job; at most the sample and its repeated rows


def _distinct(learned: pa.Table) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Inputs and label of every key in the order of its hash; of repeated documents the one whose inputs come first."""
    learned = learned.combine_chunks()
    hashed, label = (learned.column(c).to_numpy() for c in ("h", "l"))

    def parts(name: str) -> tuple[np.ndarray, np.ndarray]:
        column = learned.column(name).combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        return column.values.to_numpy(), column.offsets.to_numpy()

    (ids, at), (x, _), (stats, own) = parts("ids"), parts("x"), parts("stats")
    rows: list[tuple] = []
    last = None
    for i in np.argsort(hashed, kind="stable").tolist():
        row = ids[at[i] : at[i + 1]], x[at[i] : at[i + 1]], stats[own[i] : own[i + 1]], int(label[i])
        if hashed[i] != last:
            rows.append(row)
        else:
            rows[-1] = min(rows[-1], row, key=lambda r: (*(tuple(part.tolist()) for part in r[:3]), r[3]))
        last = hashed[i]
    return rows


def score(docs: DataFrame, model: Model, metadata: tuple[str, ...] = ("n_chars",), key: str = "doc_id", text: str = "text",
          keep: tuple[str, ...] | None = None, above: float | None = None) -> DataFrame:
    """``key``, ``score`` and ``predicted`` of every row; null text is scored as empty, null metadata as 0.

    With ``keep``, the named columns (``key``, ``text`` and others, untouched) of rows that score ``above`` or more.
    """
    features = Features(model.buckets, len(metadata))
    columns = list(keep) if keep else [key]
    plain = docs.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(columns)), F.col(text).alias("t"), *(F.col(m).cast("double").alias(f"m{i}") for i, m in enumerate(metadata)))
    from pyspark.sql.pandas.types import to_arrow_schema

    carried = to_arrow_schema(plain.select(*(f"k{i}" for i in range(len(columns)))).schema)
    schema = carried if keep else pa.schema([*carried, ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        n = len(columns)
        for batch in batches:
            rest = [c.to_pylist() for c in batch.columns[n + 1 :]]
            scores = [model.score(*features(t.as_py(), [m[i] for m in rest])) for i, t in enumerate(batch.column(n))]
            own = [c.cast(f.type) for c, f in zip(batch.columns[:n], carried)]
            if keep:
                yield pa.RecordBatch.from_arrays(own, schema=schema).filter(pa.array([s >= above for s in scores], pa.bool_()))
            else:
                yield pa.RecordBatch.from_arrays([*own, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], schema=schema)

    fields = ", ".join(f"k{i} {plain.schema[i].dataType.simpleString()}" for i in range(len(columns)))
    out = plain.mapInArrow(run, fields if keep else f"{fields}, score double, predicted int")
    return out.toDF(*columns) if keep else out.withColumnRenamed("k0", key)
