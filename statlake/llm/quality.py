"""Quality classifier (operator 6): co-training of a text view and a metadata view.

Two logistic classifiers see different sides of a document: its text's make-up,
and its page metadata (source, language, declared length, line layout). They start from
the labelled sample and exchange confident pseudo-labels over rounds: what
one is surest about in an unlabelled pool joins the other's training rows. Each
view is calibrated on a held-out fold, and the calibrated log-odds are combined.

Training uses bounded samples (``max_labelled``, ``max_pool`` rows, by hash);
every document is scored, in one pass, without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import bounded_batches, least, pick, slices, span_hashes, stored, utf8, word_spans

_FIELDS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}

# byte classes counted per text
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "symbol": b"#*$%&|<>{}[]=+~^_\\/@",
    "exclaim": b"!?",
    "stop": b".,;:",
    "space": b" \t\r\n\x0b\x0c",
    "high": bytes(range(128, 256)),
}
_CLASS = np.zeros(256, np.int64)
for _k, _chars in enumerate(_CLASSES.values()):
    _CLASS[list(_chars)] = _k + 1
LANG_SLOTS, SOURCE_SLOTS = 16, 64
_SPAN = 8  # how far back a word's repetition is looked for


def text_view(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Features of the texts' content, one row for each text."""
    n = len(at) - 1
    size = np.diff(at)
    k = len(_CLASSES) + 1
    owner = np.repeat(np.arange(n), size)
    counts = np.bincount(owner * k + _CLASS[raw], minlength=n * k).reshape(n, k)[:, 1:].astype(np.float64)
    first, last, heads = word_spans(raw, at)
    words = np.diff(heads)
    h = span_hashes(raw, first, last)
    of = np.repeat(np.arange(n), words)
    again = np.zeros(len(h), bool)
    for d in range(1, min(_SPAN, len(h) - 1) + 1):
        again[d:] |= (h[d:] == h[:-d]) & (of[d:] == of[:-d])
    repeats = np.bincount(of, weights=again, minlength=n)
    span = (last - first).astype(np.float64)
    total, squares = np.bincount(of, weights=span, minlength=n), np.bincount(of, weights=span**2, minlength=n)
    w = np.maximum(words, 1)
    mean = total / w
    spread = np.sqrt(np.maximum(squares / w - mean**2, 0))
    letters = np.maximum(total, 1)[:, None]
    return np.column_stack([counts / letters, np.sqrt(counts / w[:, None]), repeats / w, mean, spread, np.log1p(words)])


def metadata_view(langs: list, sources: list, n_chars: np.ndarray, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Features of the pages' metadata, one row for each page. NULLs have slots of their own."""
    n = len(at) - 1
    breaks = np.concatenate([[0], np.cumsum(raw == 10)])
    lines = (breaks[at[1:]] - breaks[at[:-1]] + 1).astype(np.float64)
    size = np.maximum(np.nan_to_num(n_chars, nan=0.0), 0)
    hot = np.zeros((n, LANG_SLOTS + SOURCE_SLOTS + 1))
    slot = lambda v, m: 0 if v is None else 1 + zlib.crc32(v.encode()) % (m - 1)
    rows = np.arange(n)
    hot[rows, [slot(v, LANG_SLOTS) for v in langs]] = 1
    hot[rows, [LANG_SLOTS + slot(v, SOURCE_SLOTS) for v in sources]] = 1
    hot[:, -1] = np.isnan(n_chars)
    return np.column_stack([np.log1p(size), np.log1p(lines), np.log1p(size / lines), hot])


def views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    raw, at = utf8(batch.column("text"))
    n_chars = batch.column("n_chars").to_numpy(zero_copy_only=False).astype(np.float64)
    langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
    return text_view(raw, at), metadata_view(langs, sources, n_chars, raw, at)


@dataclass
class Logistic:
    """Ridge logistic regression on standardised features, by Newton steps."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> Logistic:
        mean, scale = x.mean(0), x.std(0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
        # classes weigh the same in total, whatever their shares
        share = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
        w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
        penalty[-1] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            h = (z * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(h, z.T @ (share * (y - p)) - penalty * w)
            w += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -20, 20)
        return np.clip(z @ self.w[:-1] + self.w[-1], -30, 30)


@dataclass
class CoTrained:
    text: Logistic
    meta: Logistic
    text_scale: Logistic
    meta_scale: Logistic
    both: Logistic
    threshold: float

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability of good quality by text, by metadata, and by both."""
        a = self.text_scale.logit(self.text.logit(text)[:, None])
        b = self.meta_scale.logit(self.meta.logit(meta)[:, None])
        p = [1 / (1 + np.exp(-v)) for v in (a, b, self.both.logit(np.column_stack([a, b])))]
        return p[0], p[1], p[2]


def _calibrated(logits: np.ndarray, y: np.ndarray) -> Logistic:
    """Log-odds of good quality by a view's own log-odds, from the held-out fold."""
    return Logistic.fit(logits[:, None], y, ridge=0.1)


def co_train(
    text: np.ndarray, meta: np.ndarray, y: np.ndarray, held: np.ndarray,
    pool_text: np.ndarray, pool_meta: np.ndarray, rounds: int = 4, exchanged: float = 0.1, confident: float = 0.9,
) -> CoTrained:
    """Train both views; ``held`` marks the labelled rows kept for calibration.

    Per round each view proposes, for each class, its most confident pool rows
    (at most a share ``exchanged`` of the pool, at a calibrated probability of
    ``confident`` or surer), to the other.
    """
    fit = ~held
    extra = {"text": (np.zeros(0, int), np.zeros(0)), "meta": (np.zeros(0, int), np.zeros(0))}
    size = int(exchanged * len(pool_text))
    edge = float(np.log(confident / (1 - confident)))
    for r in range(rounds + 1):
        models = {}
        for name, x, pool in (("text", text, pool_text), ("meta", meta, pool_meta)):
            i, labels = extra[name]
            models[name] = Logistic.fit(np.vstack([x[fit], pool[i]]), np.concatenate([y[fit], labels]))
        if r == rounds or not size:
            break
        for name, other, x, pool in (("text", "meta", text, pool_text), ("meta", "text", meta, pool_meta)):
            v = _calibrated(models[name].logit(x[held]), y[held]).logit(models[name].logit(pool)[:, None])
            order = np.argsort(v, kind="stable")
            low, high = order[:size], order[::-1][:size]
            low, high = low[v[low] <= -edge], high[v[high] >= edge]
            extra[other] = (np.concatenate([low, high]), np.concatenate([np.zeros(len(low)), np.ones(len(high))]))
    a, b, yh = models["text"].logit(text[held]), models["meta"].logit(meta[held]), y[held]
    ts, ms = _calibrated(a, yh), _calibrated(b, yh)
    a, b = ts.logit(a[:, None]), ms.logit(b[:, None])
    both = Logistic.fit(np.column_stack([a, b]), yh)
    p = 1 / (1 + np.exp(-both.logit(np.column_stack([a, b]))))
    # where sensitivity + specificity is highest; in the middle of a gap between the classes
    cuts = np.unique(p)
    gain = [(p[yh == 1] >= c).mean() + (p[yh == 0] < c).mean() for c in cuts]
    best = int(np.argmax(gain))
    threshold = float((cuts[best] + cuts[best - 1]) / 2) if best else float(cuts[0])
    return CoTrained(models["text"], models["meta"], ts, ms, both, min(threshold, 0.5))


def train_quality(docs: DataFrame, labels: DataFrame, max_labelled: int = 12_000, max_pool: int = 12_000) -> CoTrained | None:
    """Fit the two views on bounded samples. None when a class has no labelled document.

    ``labels``: ``doc_id, quality`` (0/1). NULL ids, other qualities, ids with
    contradicting labels and ids without a document are left out. Both classes have half of
    ``max_labelled`` (what one class lacks goes to the other): the ids of least 64-bit hash, so a
    rare class is not missed and reruns agree. Of documents that share an id, the one of least
    text hash is taken. A quarter, by hash of the id, is held out for calibration; a class that this leaves
    without rows on either side is split by rank (a lone document serves for both). The threshold is never above 1/2: a document as likely good as bad stays.
    """
    rows = pick(docs, _FIELDS)
    known = pick(labels, {"doc_id": "bigint", "quality": "bigint"}).dropna().groupBy("doc_id")
    known = known.agg(F.min("quality").alias("quality"), F.max("quality").alias("q")).filter("quality = q AND q IN (0, 1)").drop("q")
    # only ids meet here; few labels are broadcast, by their size on disk
    known = rows.select("doc_id").join(stored(known, "quality-labels"), "doc_id").distinct()
    known = stored(known.withColumn("h", F.xxhash64(F.lit("sample"), "doc_id")), "quality-known")
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_docs, half, some = rows.count(), max_labelled // 2, []
    for c in (0, 1):
        quota = max(half, max_labelled - sizes.get(1 - c, 0))
        of = known.filter((F.col("quality") == c) & least(F.col("h"), quota, sizes.get(c, 0)))
        some.append(of.orderBy("h", "doc_id").limit(quota).drop("h"))
    # at most max_labelled rows of two numbers: small enough to send to every task
    marked = rows.join(F.broadcast(some[0].unionByName(some[1])), "doc_id")
    fields = [c for c in _FIELDS if c != "doc_id"]
    one = F.min_by(F.struct(*fields), F.struct(F.xxhash64("text"), F.xxhash64(*fields))).alias("one")
    marked = marked.groupBy("doc_id", "quality").agg(one).select("doc_id", "quality", "one.*")
    marked = marked.withColumn("h", F.lit(0).cast("bigint"))
    h = F.xxhash64(F.lit("sample"), "doc_id", "text")
    pool = rows.withColumn("h", h).filter(least(F.col("h"), max_pool, n_docs)).withColumn("quality", F.lit(None).cast("bigint"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1024, 2 << 20):
                t, m = views(part)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "quality", "h")), pa.array(list(t), pa.list_(pa.float64())), pa.array(list(m), pa.list_(pa.float64()))],
                    ["doc_id", "quality", "h", "t", "m"],
                )

    schema = "doc_id bigint, quality bigint, h bigint, t array<double>, m array<double>"
    marked, pool = (d.select(*_FIELDS, "quality", "h").mapInArrow(features, schema) for d in (marked, pool))
    found = [marked.toPandas(), pool.orderBy("h", "doc_id", "t", "m").limit(max_pool).toPandas()]
    found = [f.assign(o=[zlib.crc32(np.asarray(v).tobytes()) for v in f["t"]]).sort_values(["doc_id", "o"], kind="stable") for f in found]
    lab, free = found
    free = free[~free["doc_id"].isin(set(lab["doc_id"]))]
    y = lab["quality"].to_numpy(np.float64)
    crc = np.array([zlib.crc32(str(i).encode()) for i in lab["doc_id"]], dtype=np.int64)
    held, again = crc % 4 == 0, []
    for c in (0.0, 1.0):
        own = np.flatnonzero(y == c)
        if not len(own):
            return None
        if held[own].all() or not held[own].any():  # too few for the hash: every fourth, from the second on
            own = own[np.argsort(crc[own], kind="stable")]
            held[own], held[own[1::4]] = False, True
        again += own.tolist() if len(own) == 1 else []
    lab = lab.iloc[[*range(len(lab)), *again]]
    y, held = np.append(y, y[np.array(again, dtype=int)]), np.append(held, np.ones(len(again), bool))
    stack = lambda s, like: np.vstack(s.to_list()) if len(s) else np.zeros((0, like))
    text, meta = np.vstack(lab["t"].to_list()), np.vstack(lab["m"].to_list())
    return co_train(text, meta, y, held, stack(free["t"], text.shape[1]), stack(free["m"], meta.shape[1]))


def _scores(model: CoTrained | None, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if model is None:
        one = np.ones(part.num_rows)
        return one, one, one, one.astype(bool)
    t, m, p = model.score(*views(part))
    return t, m, p, p >= model.threshold


def score_quality(docs: DataFrame, model: CoTrained | None) -> DataFrame:
    """``doc_id, text_score, metadata_score, score, kept`` for every row.

    * NULL or empty text, and NULLs in the metadata, are scored like any values.
    * without a model (no labels of one class) all scores are 1 and all rows kept.
    * NULL ids stay, repeated rows are scored alike, an empty table stays empty;
      other columns are ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1024, 2 << 20):
                t, m, p, kept = _scores(model, part)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(t), pa.array(m), pa.array(p), pa.array(kept)],
                    ["doc_id", "text_score", "metadata_score", "score", "kept"],
                )

    schema = "doc_id bigint, text_score double, metadata_score double, score double, kept boolean"
    return pick(docs, _FIELDS).mapInArrow(run, schema)


def good_documents(docs: DataFrame, model: CoTrained | None) -> DataFrame:
    """The rows of ``docs`` that the model keeps, all columns unchanged."""
    bounded_batches(docs.sparkSession)
    names = docs.columns
    lower = [n.lower() for n in names]
    at = {f: names.index(f) if f in names else lower.index(f) if f in lower else None for f in _FIELDS}
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    kinds = {"bigint": pa.int64(), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # the fields scored, taken from the rows' own columns
            fields = [pa.nulls(batch.num_rows, kinds[k]) if at[f] is None else batch.column(at[f]).cast(kinds[k]) for f, k in _FIELDS.items()]
            scored, done = pa.RecordBatch.from_arrays(fields, list(_FIELDS)), 0
            for part in slices(scored, "text", 1024, 2 << 20):
                kept = _scores(model, part)[3]
                yield batch.slice(done, part.num_rows).filter(pa.array(kept))
                done += part.num_rows

    return plain.mapInArrow(run, plain.schema).toDF(*names)
