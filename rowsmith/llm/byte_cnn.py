"""Operator 9: language identification by a byte convolutional network.

Texts are seen as windows of ``WINDOW`` bytes, all of them, one after the other.
A window goes through byte embeddings, filters of several widths, ReLU, the maximum
over the window, and a softmax; a text's prediction is the mean over its windows by
their bytes. The network is trained in numpy on the driver, from at most
``TRAIN_DOCS`` labelled documents for each language (the first by a hash of the
key) and at most ``TRAIN_WINDOWS`` windows of each, cut on the executors at places
drawn by the text's hash; documents of the held-out fold never take part. In
prediction a filter is a sum of table rows by byte pairs, so a window costs a few
gathers and no matrix product.

Inputs of a prediction are the text's bytes alone.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and
so is every text when no labelled rows are there; a null key is held out; rows are
judged one by one, so repeated rows repeat; an empty table gives an empty result;
other input columns are carried along or not looked at, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tables
from .tokens import text_bytes

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 12
TRAIN_DOCS = 600
TRAIN_WINDOWS = 3
EPOCHS = 4
FOLDS = 5
UNKNOWN = "und"
#: Windows worked on at once in prediction.
CHUNK = 256

_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Network:
    """Weights; ``filters[w]`` has the shape (w, EMBEDDING, FILTERS)."""

    languages: list[str]
    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray


def windows_of(data: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """All windows of a text's bytes, the last one filled up with zeros."""
    n = max(1, -(-len(data) // window))
    out = np.zeros(n * window, np.uint8)
    out[: len(data)] = data
    return out.reshape(n, window)


# -- training -----------------------------------------------------------------------


def _forward(net: Network, x: np.ndarray) -> tuple[np.ndarray, dict, np.ndarray]:
    """Pooled features, where each maximum was, and probabilities."""
    e = net.embedding[x]
    pooled, where = [], {}
    for w, f in net.filters.items():
        n = x.shape[1] - w + 1
        conv = sum(e[:, k : k + n] @ f[k] for k in range(w))
        where[w] = conv.argmax(axis=1)
        pooled.append(np.maximum(np.take_along_axis(conv, where[w][:, None], 1)[:, 0] + net.bias[w], 0))
    h = np.concatenate(pooled, axis=1)
    z = h @ net.out + net.out_bias
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return h, where, p / p.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 1) -> Network:
    """Cross-entropy by Adam; gradients flow through the maxima alone."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(np.prod(shape[:-1]))).astype(np.float32)
    net = Network(
        languages, rng.standard_normal((256, EMBEDDING)).astype(np.float32) * np.float32(0.5), {w: draw(w, EMBEDDING, FILTERS) for w in WIDTHS},
        {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}, draw(FILTERS * len(WIDTHS), len(languages)), np.zeros(len(languages), np.float32),
    )
    params = [net.embedding, net.out, net.out_bias, *net.filters.values(), *net.bias.values()]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    share = np.bincount(labels, minlength=len(languages))
    weight = (len(labels) / np.maximum(share, 1) / max(1, (share > 0).sum())).astype(np.float32)
    step = 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // 64)):
            x, y = windows[rows], labels[rows]
            h, where, p = _forward(net, x)
            dz = p
            dz[np.arange(len(y)), y] -= 1
            dz *= (weight[y] / len(y))[:, None]
            dh = (dz @ net.out.T) * (h > 0)
            demb, dfilters, dbias = np.zeros_like(net.embedding), {}, {}
            for i, (w, f) in enumerate(net.filters.items()):
                g = dh[:, i * FILTERS : (i + 1) * FILTERS]
                dbias[w], dfilters[w] = g.sum(axis=0), np.empty_like(f)
                for k in range(w):
                    byte = np.take_along_axis(x, where[w] + k, 1)
                    dfilters[w][k] = np.einsum("bf,bfd->df", g, net.embedding[byte])
                    np.add.at(demb, byte.ravel(), (g[:, :, None] * f[k].T[None]).reshape(-1, EMBEDDING))
            step += 1
            for j, (p_, d) in enumerate(zip(params, [demb, h.T @ dz, dz.sum(axis=0), *dfilters.values(), *dbias.values()])):
                first[j] += 0.1 * (d - first[j])
                second[j] += 0.001 * (d * d - second[j])
                p_ -= 0.004 * (first[j] / (1 - 0.9**step)) / (np.sqrt(second[j] / (1 - 0.999**step)) + 1e-8)
    return net


# -- prediction -----------------------------------------------------------------------


class Predictor:
    """A network as tables: the part of a filter over two bytes is one row by the byte pair."""

    def __init__(self, net: Network):
        self.net, self.parts = net, {}
        for w, f in net.filters.items():
            each = [net.embedding @ f[k] for k in range(w)]
            pairs = [(k, (each[k][:, None] + each[k + 1][None]).reshape(65536, -1)) for k in range(0, w - 1, 2)]
            self.parts[w] = pairs, [(w - 1, each[w - 1])] if w % 2 else []

    def windows(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of each window."""
        out = np.empty((len(x), len(self.net.languages)), np.float32)
        for at in range(0, len(x), CHUNK):
            # Places first, then windows: a maximum over places runs over whole rows.
            b = np.ascontiguousarray(x[at : at + CHUNK].T).astype(np.int32)
            pair = (b[:-1] << 8) | b[1:]
            pooled = []
            for w, (pairs, single) in self.parts.items():
                n = len(b) - w + 1
                conv = None
                for k, t in pairs:
                    got = t.take(pair[k : k + n], axis=0)
                    conv = got if conv is None else np.add(conv, got, out=conv)
                for k, t in single:
                    conv += t.take(b[k : k + n], axis=0)
                pooled.append(np.maximum(conv.max(axis=0) + self.net.bias[w], 0))
            z = np.concatenate(pooled, axis=1) @ self.net.out + self.net.out_bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            out[at : at + CHUNK] = p / p.sum(axis=1, keepdims=True)
        return out

    def texts(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        data, offsets = text_bytes(column)
        names, scores, held, owners, count = [], np.zeros(len(column)), [], [], 0
        total = np.zeros((len(column), len(self.net.languages)))

        def flush():
            nonlocal held, owners, count
            if held:
                x = np.concatenate(held)
                weight = np.maximum((x != 0).sum(axis=1), 1)
                np.add.at(total, np.concatenate(owners), self.windows(x) * weight[:, None])
                held, owners, count = [], [], 0

        letters = np.zeros(len(column), bool)
        for i in range(len(column)):
            text = data[offsets[i] : offsets[i + 1]]
            letters[i] = _LETTER.search(text.tobytes().decode()) is not None
            if not letters[i]:
                continue
            for k in range(0, len(text), 4096 * WINDOW):
                x = windows_of(text[k : k + 4096 * WINDOW])
                held.append(x)
                owners.append(np.full(len(x), i))
                count += len(x)
                if count >= 4096:
                    flush()
        flush()
        for i in range(len(column)):
            if letters[i]:
                p = total[i] / total[i].sum()
                best = int(p.argmax())
                names.append(self.net.languages[best])
                scores[i] = min(1.0, float(p[best]))
            else:
                names.append(UNKNOWN)
        return names, scores


# -- the operator -----------------------------------------------------------------------


def held_out(key: Column) -> Column:
    """The fold that is never learned from: crc32 of the key as text, modulo FOLDS, is 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def fit(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_docs: int = TRAIN_DOCS) -> Network | None:
    """Trains on a bounded sample of the labelled rows outside the held-out fold; None without any."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(key_col)))
    # Keys are picked without their texts, so that no text is sorted or moved for it.
    # By the hash's place among all its values only about twice as many as wanted are
    # ranked, so a language with most of the rows is no hot group.
    keys = known.select(F.col(key_col).alias("key"), F.col(lang_col).cast("string").alias("lang")).distinct()
    counts = keys.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("lang", "_lang")
    place = F.xxhash64("key")
    near = (place.cast("double") / 2.0**64 + 0.5) * F.col("_n") <= 2.0 * train_docs + 64
    few = keys.join(counts, F.col("lang") == F.col("_lang")).where(near).select("key", "lang")
    first = Window.partitionBy("lang").orderBy(place, "key")
    picked = few.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") <= train_docs).select("key", "lang")
    texts = known.select(F.col(key_col).alias("key"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))

    def cut(batches):
        for b in batches:
            langs, found = [], []
            data, offsets = text_bytes(b.column(1))
            for i, lang in enumerate(b.column(0).to_pylist()):
                text = data[offsets[i] : offsets[i + 1]]
                if not len(text):
                    continue
                rng = np.random.default_rng(zlib.crc32(text.tobytes()))
                for _ in range(min(TRAIN_WINDOWS, -(-len(text) // WINDOW))):
                    at = int(rng.integers(0, max(1, len(text) - WINDOW + 1)))
                    langs.append(lang)
                    found.append(windows_of(text[at : at + WINDOW])[0].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary())], ["lang", "window"])

    # Written, so that their true size decides how the texts are joined: a few languages have few keys.
    # Of rows that repeat a key in a language the least text counts, so one text a key goes on.
    joined = texts.join(tables.written(picked, "picked"), ["key", "lang"]).groupBy("key", "lang").agg(F.min("text").alias("text"))
    sample = joined.select("lang", "text").mapInArrow(cut, "lang string, window binary")
    rows = sorted((r["lang"], bytes(r["window"])) for r in sample.collect())
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    labels = np.array([languages.index(lang) for lang, _ in rows])
    return train(np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(len(rows), WINDOW), labels, languages)


def identify(docs: DataFrame, net: Network | None, text_col: str = "text", names: tuple[str, str] = ("lang_pred", "lang_score")) -> DataFrame:
    """``docs`` and two columns, by ``names``: language and score. One narrow stage, no shuffle.

    Names that ``docs`` has already get underscores in front (``tables.fresh``).
    """
    language, score = (tables.fresh(docs, n) for n in names)
    schema = tables.fields(docs, f"`{language}` string, `{score}` double")
    at = docs.columns.index(text_col)

    def predict(batches):
        own = Predictor(net) if net else None
        for b in batches:
            names, scores = own.texts(b.column(at)) if own else ([UNKNOWN] * b.num_rows, np.zeros(b.num_rows))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema.names)

    return docs.mapInArrow(predict, schema)


def op9_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
