"""Toxicity scores from a bidirectional GRU with attention pooling, in numpy (operator 6)."""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRAIN_DOCS = 3000  # labelled documents the model is fitted on, at most
EPOCHS = 6
STEPS = 24  # gradient steps of an epoch, about
WINDOW, STRIDE = 64, 48  # words in a window, and from one window's start to the next
BUCKETS, WIDTH, HIDDEN = 1 << 15, 6, 6
GRAMS = (4, 5)  # lengths of the character n-grams of a word between its boundary marks
SEED = 11
CHUNK = 1 << 21  # characters that are scored at a time
PORTION = 1 << 20  # characters that are trained on at a time
_WORD = re.compile(r"\w+")
_P, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _buckets(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(31))) * _MIX
    return ((hashes ^ (hashes >> np.uint64(29))) % np.uint64(BUCKETS)).astype(np.int64)


def word_inputs(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each word's bucket, and the (word, bucket) entries of its character n-grams."""
    codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), np.uint32)
    codes = codes.astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    starts = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(codes)) - starts[word]
    powers = np.multiply.accumulate(np.full(int(lengths.max(initial=1)), _P))
    whole = _buckets(np.add.reduceat(codes * powers[place], starts)) if words else np.empty(0, np.int64)
    of, bucket = [], []
    for n in GRAMS:
        fits = np.flatnonzero(place + n <= lengths[word])
        total = np.zeros(len(fits), np.uint64)
        for j in range(n):
            total = total * _P + codes[fits + j]
        of.append(word[fits])
        bucket.append(_buckets(total + np.uint64(n)))
    return whole, np.concatenate(of), np.concatenate(bucket)


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows over texts laid end to end: text, first word and size of each."""
    count = np.maximum(1, -(-(lengths - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(lengths)), count)
    step = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    first = (np.cumsum(lengths) - lengths)[text] + step * STRIDE
    return text, first, np.minimum(WINDOW, lengths[text] - step * STRIDE)


class Batch:
    """Texts as word codes with windows; the codes index ``words``, the last of them blank."""

    def __init__(self, texts: list[str]):
        self._hold([_WORD.findall(t.lower()) for t in texts])

    @classmethod
    def of_words(cls, split: list[list[str]]) -> Batch:
        """Texts that are cut into words already."""
        batch = cls.__new__(cls)
        batch._hold(split)
        return batch

    def _hold(self, split: list[list[str]]) -> None:
        self.lengths = np.array([len(s) for s in split], np.int64)
        flat = np.empty(int(self.lengths.sum()), object)
        flat[:] = [w for s in split for w in s]
        self.codes, self.words = pd.factorize(flat)
        self.words = list(self.words)
        self.text, self.first, self.size = windows(self.lengths)
        self.inputs = word_inputs(self.words)

    def ids(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word codes of some windows, padded with the blank word, and where words are."""
        steps = np.arange(WINDOW)
        mask = steps < self.size[which][:, None]
        at = np.minimum(self.first[which][:, None] + steps, max(0, len(self.codes) - 1))
        codes = self.codes[at] if len(self.codes) else np.zeros(at.shape, np.int64)
        return np.where(mask, codes, len(self.words)), mask


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Model:
    """Embeddings of words and character n-grams, a GRU each way, attention, one logit."""

    def __init__(self, rng: np.random.Generator):
        h, d = HIDDEN, WIDTH
        draw = lambda *shape: rng.standard_normal(shape).astype(np.float32)
        self.p = {"word": draw(BUCKETS, d) * 0.01, "gram": draw(BUCKETS, d) * 0.01}
        for way in "fb":
            self.p |= {
                f"W{way}": draw(d, 3 * h) / np.sqrt(d),
                f"U{way}": draw(h, 3 * h) / np.sqrt(h),
                f"c{way}": np.zeros(3 * h, np.float32),
            }
        self.p |= {"att": draw(2 * h) * 0.3, "out": draw(2 * h) * 0.3, "bias": np.full(1, -1.0, np.float32)}

    def embed(self, inputs) -> np.ndarray:
        whole, of, gram = inputs
        x = self.p["word"][whole]
        table = self.p["gram"]
        for k in range(WIDTH):
            x[:, k] += np.bincount(of, weights=table[gram, k], minlength=len(whole))
        return np.concatenate([x, np.zeros((1, WIDTH), np.float32)])

    def run(self, gates: dict[str, np.ndarray], ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows; ``keep`` also returns what the gradient needs."""
        h, n = HIDDEN, len(ids)
        live = mask.astype(np.float32)[:, :, None]
        states = np.empty((WINDOW, n, 2 * h), np.float32)
        tape = {}
        for way, order in (("f", range(WINDOW)), ("b", range(WINDOW - 1, -1, -1))):
            part = slice(0, h) if way == "f" else slice(h, 2 * h)
            state, U = np.zeros((n, h), np.float32), self.p[f"U{way}"]
            for t in order:
                g = gates[way][ids[:, t]]
                zr = _sigmoid(g[:, : 2 * h] + state @ U[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                new = np.tanh(g[:, 2 * h :] + (r * state) @ U[:, 2 * h :])
                before = state
                state = state + live[:, t] * z * (new - state)
                states[t, :, part] = state
                if keep:
                    tape[way, t] = before, z, r, new
        weight = states @ self.p["att"]
        weight = np.where(mask.T, weight, -30.0)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * states).sum(axis=0)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return (logit, states, weight, pooled, tape) if keep else logit

    def gates(self, x: np.ndarray) -> dict[str, np.ndarray]:
        return {way: x @ self.p[f"W{way}"] + self.p[f"c{way}"] for way in "fb"}

    def logits(self, batch: Batch, at_once: int = 4096) -> np.ndarray:
        gates, out = self.gates(self.embed(batch.inputs)), []
        for a in range(0, len(batch.text), at_once):
            which = np.arange(a, min(a + at_once, len(batch.text)))
            out.append(self.run(gates, *batch.ids(which)))
        return np.concatenate(out) if out else np.empty(0, np.float32)

    def evidence(self, batch: Batch) -> np.ndarray:
        """Sum over each window of the first dimension, which starts as log-odds."""
        sums = np.append(np.cumsum(self.embed(batch.inputs)[batch.codes, 0]), 0.0)
        if not len(batch.codes):
            return np.zeros(len(batch.text))
        return sums[batch.first + batch.size - 1] - sums[batch.first - 1]

    def gradient(self, batch: Batch, which: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Mean cross-entropy gradient over the given windows."""
        h, p = HIDDEN, self.p
        x = self.embed(batch.inputs)
        ids, mask = batch.ids(which)
        logit, states, weight, pooled, tape = self.run(self.gates(x), ids, mask, keep=True)
        dl = ((_sigmoid(logit) - label) / len(label)).astype(np.float32)
        g = {"bias": dl.sum(keepdims=True), "out": pooled.T @ dl}
        dpool = dl[:, None] * p["out"]
        dweight = (states * dpool).sum(axis=2)
        datt = weight * (dweight - (weight * dweight).sum(axis=0))
        g["att"] = np.einsum("tn,tnk->k", datt, states)
        dstates = weight[:, :, None] * dpool + datt[:, :, None] * p["att"]
        live = mask.astype(np.float32)
        dx = np.zeros_like(x)
        for way, order in (("f", range(WINDOW - 1, -1, -1)), ("b", range(WINDOW))):
            part = slice(0, h) if way == "f" else slice(h, 2 * h)
            U, carry = p[f"U{way}"], np.zeros((len(ids), h), np.float32)
            dU, dgates = np.zeros_like(U), np.zeros((len(x), 3 * h), np.float32)
            for t in order:
                before, z, r, new = tape[way, t]
                d = carry + dstates[t, :, part]
                m = live[:, t][:, None]
                dnew = d * m * z * (1 - new * new)
                dz = d * m * (new - before) * z * (1 - z)
                drh = dnew @ U[:, 2 * h :].T
                dr = drh * before * r * (1 - r)
                dzr = np.concatenate([dz, dr], axis=1)
                dU[:, : 2 * h] += before.T @ dzr
                dU[:, 2 * h :] += (r * before).T @ dnew
                carry = d * (1 - m * z) + drh * r + dzr @ U[:, : 2 * h].T
                np.add.at(dgates, ids[:, t], np.concatenate([dzr, dnew], axis=1))
            g[f"U{way}"], g[f"W{way}"], g[f"c{way}"] = dU, x.T @ dgates, dgates.sum(axis=0)
            dx += dgates @ p[f"W{way}"].T
        whole, of, gram = batch.inputs
        g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
        for k in range(WIDTH):
            g["word"][:, k] = np.bincount(whole, weights=dx[:-1, k], minlength=BUCKETS)
            g["gram"][:, k] = np.bincount(gram, weights=dx[of, k], minlength=BUCKETS)
        return g


def fit(texts: list[str], labels: np.ndarray) -> Model:
    """Train on whole documents of which only some windows need be toxic.

    The first input dimension starts at the log-odds of each word and n-gram. Every epoch
    picks the window of each document that scores highest now and takes Adam steps on
    those, so toxic documents pull up their worst passage and clean ones push theirs down.
    """
    rng = np.random.default_rng(SEED)
    model, labels = Model(rng), labels.astype(np.float32)
    if not len(texts) or labels.min() == labels.max():
        model.p["bias"][:] = 4.0 if len(texts) and labels.min() == 1 else -4.0
        model.p["out"][:] = 0
        return model
    parts = _portions(texts)
    tally = {t: np.zeros((2, BUCKETS)) for t in ("word", "gram")}
    for a, b in parts:
        _count_buckets(tally, Batch(texts[a:b]), labels[a:b].astype(int))
    for table, (clean, toxic) in tally.items():
        odds = np.log((toxic + 0.5) / (labels.sum() + 1)) - np.log((clean + 0.5) / (len(labels) - labels.sum() + 1))
        model.p[table][:, 0] += 0.3 * np.clip(odds * ((toxic + clean) >= 4), -1, 5)
    best = _worst_windows(texts, parts, model.evidence)
    first, second = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(texts))
        size = max(16, min(256, len(texts) // STEPS))
        for a in range(0, len(order), size):
            docs = order[a : a + size]
            small = Batch.of_words([best[i] for i in docs])
            grad = model.gradient(small, np.arange(len(docs)), labels[docs])
            step += 1
            rate = 0.01 * min(1.0, 2 * (1 - epoch / EPOCHS))
            for k, g in grad.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                fixed = np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8
                model.p[k] -= rate * first[k] / (1 - 0.9**step) / fixed
        if epoch + 1 < EPOCHS:
            best = _worst_windows(texts, parts, model.logits)
    return model


def _portions(texts: list[str]) -> list[tuple[int, int]]:
    """Runs of texts of about ``PORTION`` characters, which are worked on one run at a time."""
    ends, size = [0], 0
    for i, text in enumerate(texts, 1):
        size += len(text)
        if size >= PORTION or i == len(texts):
            ends.append(i)
            size = 0
    return list(zip(ends, ends[1:]))


def _worst_windows(texts: list[str], parts: list[tuple[int, int]], score) -> list[list[str]]:
    """The words of each text's window that scores highest; of the rest nothing is kept."""
    out = []
    for a, b in parts:
        batch = Batch(texts[a:b])
        best = np.lexsort((-score(batch), batch.text))
        for which in best[np.searchsorted(batch.text[best], np.arange(b - a))]:
            first = batch.first[which]
            out.append([batch.words[c] for c in batch.codes[first : first + batch.size[which]]])
    return out


def _count_buckets(tally: dict[str, np.ndarray], batch: Batch, labels: np.ndarray) -> None:
    """Add the number of documents of either label that hold each bucket."""
    whole, of, gram = batch.inputs
    doc = np.repeat(np.arange(len(labels)), batch.lengths)
    doc, word = np.divmod(np.unique(doc * len(whole) + batch.codes), max(1, len(whole)))
    # The n-gram entries of each word lie together once sorted by word.
    by_word = np.argsort(of, kind="stable")
    spans = np.searchsorted(of[by_word], np.arange(len(whole) + 1))
    runs = spans[word + 1] - spans[word]
    flat = np.repeat(spans[word] - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
    for table, d, b in (("word", doc, whole[word]), ("gram", np.repeat(doc, runs), gram[by_word][flat])):
        d, b = np.divmod(np.unique(d * BUCKETS + b), BUCKETS)
        np.add.at(tally[table], (labels[d], b), 1)


def held_out(doc_id) -> F.Column:
    """Documents never trained on: a fifth by the CRC of the id, and those without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_DOCS) -> Model:
    """Fit on at most ``bound`` labelled documents that are not held out, drawn by hash of the id.

    Documents with contradicting labels count as toxic; null labels are left out. One task
    fits on the drawn documents; only the fitted parameters reach the driver.
    """
    known = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Ids are drawn from the labels alone; only then are the drawn texts read.
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound).select("doc_id", F.col("toxic").cast("double"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")
    rows = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            labels += batch.column("toxic").to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, np.array(labels)).p)])], names=["fitted"])

    placed = rows.repartition(1).sortWithinPartitions("doc_id").select("text", "toxic")
    fitted = placed.mapInArrow(run, "fitted binary").collect()
    if not fitted:
        return fit([], np.empty(0))
    model = Model.__new__(Model)
    model.p = pickle.loads(fitted[0]["fitted"])
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``score``: the chance of the most toxic window of the whole text.

    All overlapping windows are scored. Texts are worked on in chunks of about ``CHUNK``
    characters; memory follows the longest text where one has more.
    Null and empty texts have one window without words. Repeated rows are scored alike;
    other columns pass; a column called ``score`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.p)
    keep = [c for c in docs.columns if c != "score" and (keep_text or c != text_col)]
    schema = T.StructType([docs.schema[c] for c in keep]).add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.__new__(Model)
        own.p = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column("__scored").to_pylist()]
            scores, a, size = [np.empty(0)], 0, 0
            for i, text in enumerate(texts):
                size += len(text)
                if size >= CHUNK or i + 1 == len(texts):
                    scores.append(_scores(own, texts[a : i + 1]))
                    a, size = i + 1, 0
            columns = [*(batch.column(c) for c in keep), pa.array(np.concatenate(scores), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score"])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("__scored"))
    return rows.mapInArrow(run, schema)


def _scores(model: Model, texts: list[str]) -> np.ndarray:
    batch = Batch(texts)
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, batch.text, model.logits(batch))
    return _sigmoid(top.astype(np.float64))
