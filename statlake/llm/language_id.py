"""Language ID (operator 4): sparse multinomial logistic regression on TF-IDF
character n-grams, by follow-the-regularised-leader with elastic-net penalties.

N-grams of one to three characters (lower-cased, runs of non-letters one
blank) are hashed to ``2^BITS`` columns; weights are log counts times inverse
document frequency, scaled to length 1. Document frequencies are counted over all
training documents; the weights are learned from a bounded sample, spread evenly over
the languages; a temperature fitted on a fifth of it calibrates the scores.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.common import least, mix, pick, slices

BITS = 15
_LETTER = re.compile(r"[^\W\d_]")
_FIXED: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    if "letters" not in _FIXED:
        _FIXED["letters"] = np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(0x30000)])
    return _FIXED["letters"]


def ngram_counts(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Columns and counts of each text's n-grams."""
    lowered = [t.lower() for t in texts]
    size = np.array([len(t) for t in lowered], np.int64)
    cp = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), size)
    known = _letters()
    cp = np.where(known[np.minimum(cp, len(known) - 1).astype(np.int64)], cp, np.uint64(32))
    blank = cp == 32
    # a run of non-letters is one blank
    keep = np.ones(len(cp), bool)
    keep[1:] = ~(blank[1:] & blank[:-1] & (owner[1:] == owner[:-1]))
    cp, owner, blank = cp[keep], owner[keep], blank[keep]
    edge = np.searchsorted(owner, np.arange(len(texts) + 1))
    h = mix(cp + np.uint64(1))
    grams, inside = [], np.ones(len(cp), bool)
    for n in range(3):
        if n:
            longer = np.zeros(len(cp), np.uint64)
            longer[:-n] = cp[n:]
            h = mix(h * np.uint64(3) + longer)
            last = np.zeros(len(cp), bool)
            last[:-n] = owner[n:] == owner[:-n]
            inside = inside & last
        column = (h >> np.uint64(64 - BITS)).astype(np.int64)
        grams.append(np.where(inside if n else ~blank, column, -1))
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        c = np.bincount(np.concatenate([g[a:b] for g in grams]) + 1, minlength=(1 << BITS) + 1)[1:]
        some = np.flatnonzero(c)
        yield some, c[some]


def tf_idf(columns: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1 + np.log(counts)) * idf[columns]
    return v / max(float(np.sqrt(v @ v)), 1e-12)


class Ftrl:
    """Multinomial FTRL-proximal; per-coordinate rates, L1 and L2 penalties."""

    def __init__(self, classes: int, columns: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01):
        self.z, self.n = np.zeros((classes, columns)), np.zeros((classes, columns))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        g = np.outer(softmax(w @ x), x)
        g[y] -= x
        n = self.n[:, at]
        self.z[:, at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[:, at] = n + g * g


def softmax(v: np.ndarray) -> np.ndarray:
    e = np.exp(v - v.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by ternary search on its logarithm.

    Each label counts as one short of certain by 1 / (rows + 2), so that a
    sample without errors does not make the scores certain.
    """
    k = logits.shape[1]
    target = np.full(logits.shape, 1 / (len(y) + 2) / max(k - 1, 1))
    target[np.arange(len(y)), y] = 1 - 1 / (len(y) + 2)

    def loss(t: float) -> float:
        return -(target * np.log(np.maximum(softmax(logits / np.exp(t)), 1e-300))).sum(axis=1).mean()

    low, high = -4.0, 4.0
    for _ in range(60):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class LanguageModel:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # classes x (columns + 1), the last column the intercept
    temperature: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """A learned language and its calibrated probability; ``und`` and 0 without a letter."""
        texts = [t or "" for t in texts]
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not self.langs:
            return langs, scores
        some = [i for i, t in enumerate(texts) if _LETTER.search(t)]
        for i, (at, counts) in zip(some, ngram_counts([texts[i] for i in some]), strict=True):
            x = tf_idf(at, counts, self.idf)
            p = softmax((self.weights[:, at] @ x + self.weights[:, -1]) / self.temperature)
            best = int(p.argmax())
            langs[i], scores[i] = self.langs[best], float(p[best])
        return langs, scores


def train_language_model(labelled: DataFrame, max_rows: int = 4000, epochs: int = 3) -> LanguageModel:
    """Learn from ``text`` and ``lang`` of ``labelled`` (NULL or letterless rows teach nothing).

    ``max_rows`` bounds the sample: an equal number for each language, its rows of
    least 64-bit hash, so reruns agree (and the languages: the most frequent ones, if there are more).
    """
    rows = pick(labelled, {"doc_id": "bigint", "text": "string", "lang": "string"})
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for part in slices(batch, "text", 512, 4 << 20):
                for at, _ in ngram_counts(part.column("text").to_pylist()):
                    df[at] += 1
                    n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([df.tobytes()], pa.binary())], ["n", "df"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for m, blob in zip(batch.column("n").to_pylist(), batch.column("df").to_pylist(), strict=True):
                df, n = df + np.frombuffer(blob, np.int64), n + m
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([df.tobytes()], pa.binary())], ["n", "df"])

    schema = "n bigint, df binary"
    per_task = rows.select("text").mapInArrow(frequencies, schema)
    # one fixed-size row for each task, added up in 16 places and then here
    sums = per_task.repartition(16).mapInArrow(added, schema).collect()
    n = sum(r["n"] for r in sums)
    df = sum((np.frombuffer(r["df"], np.int64) for r in sums), np.zeros(1 << BITS, np.int64))
    idf = np.log((1 + n) / (1 + df)) + 1

    # at most as many languages as sampled rows, so this may go to every task
    per = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_rows)
    n_langs = per.count()
    quota = max(1, max_rows // max(n_langs, 1))
    some = rows.join(F.broadcast(per.withColumnRenamed("lang", "l")), F.col("lang") == F.col("l"))
    some = some.withColumn("h", F.xxhash64(F.lit("sample"), "doc_id", "text")).filter(least(F.col("h"), quota, F.col("n")))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 512, 4 << 20):
                texts = part.column("text").to_pylist()
                lines = []
                for text, (at, counts) in zip(texts, ngram_counts(texts), strict=True):
                    own = np.column_stack([at, counts]).astype("<i4").tobytes() if _LETTER.search(text) else None
                    lines.append((zlib.crc32(text.encode()), own))
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), part.column("h"), pa.array([c for c, _ in lines], pa.int64()), pa.array([o for _, o in lines], pa.binary())],
                    ["lang", "h", "crc", "x"],
                )

    found = some.select("lang", "h", "text").mapInArrow(features, "lang string, h bigint, crc bigint, x binary")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "crc"))
    found = found.filter("x IS NOT NULL").withColumn("place", place).filter(F.col("place") <= quota)
    found = found.select("lang", "h", "crc", "x").toPandas().sort_values(["crc", "lang", "h"], kind="stable")
    langs = sorted(set(found["lang"]))
    model = LanguageModel(langs, idf, np.zeros((len(langs), (1 << BITS) + 1)), 1.0)
    if not langs:
        return model
    where = {v: i for i, v in enumerate(langs)}
    samples = []
    for lang, blob in zip(found["lang"], found["x"], strict=True):
        at, counts = np.frombuffer(blob, "<i4").reshape(-1, 2).T.astype(np.int64)
        # the intercept is a column of its own
        samples.append((np.append(at, 1 << BITS), np.append(tf_idf(at, counts, idf), 1.0), where[lang]))
    held = [s for i, s in enumerate(samples) if i % 5 == 0] if len(samples) >= 5 else []
    fit = [s for i, s in enumerate(samples) if i % 5] if held else samples
    ftrl = Ftrl(len(langs), (1 << BITS) + 1)
    for e in range(epochs):
        for i in np.random.default_rng(e).permutation(len(fit)).tolist():
            ftrl.learn(*fit[i])
    model.weights = ftrl.weights()
    if held:
        logits = np.stack([model.weights[:, at] @ x for at, x, _ in held])
        model.temperature = fit_temperature(logits, np.array([y for _, _, y in held]))
    model.weights = model.weights.astype(np.float32)
    return model


def identify_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, from its whole text alone.

    * NULL text, or text without a letter: ``und`` with score 0; so are all
      rows when nothing was learned.
    * repeated rows are scored alike, NULL ids stay, an empty table gives an
      empty one; other columns are ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 512, 4 << 20):
                langs, scores = model.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return pick(docs, {"doc_id": "bigint", "text": "string"}).mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def language_report(docs: DataFrame, max_rows: int = 4000) -> DataFrame:
    """Learn from three quarters of the ids and predict all: ``doc_id, held_out, lang_pred, score``.

    Held out: ids whose text's CRC-32 modulo 4 is 2 (a NULL id is not held out, and not learned from).
    """
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    rows = pick(docs, {"doc_id": "bigint", "text": "string", "lang": "string"})
    model = train_language_model(rows.filter(fold != 2), max_rows)
    found = identify_languages(rows, model)
    return found.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
