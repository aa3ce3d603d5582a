"""Language ID by a bidirectional gated recurrent network over bytes.

The network reads the bytes of the text itself, across words, and labels every position with a probability for each
language; a document's probabilities are the means over its positions that hold letters (ASCII letters, and all bytes of
other characters). Its unit is gated by one gate, which both resets and updates the state (a minimal gated unit):

    f = LEAK + (1 - LEAK) * sigmoid(W x + U h),  c = tanh(W' x + f * (U' h)),  h = h + f * (c - h)

The leak makes old bytes fade by at least that share at every step.

A text is read in windows of CORE bytes, so that many run side by side whatever the texts' lengths. The state is carried
through HALO further bytes before a window (and, for the other direction, after it), of which no position is labelled
twice. That so much context is enough is tested against a pass over whole texts with one carried state.

It is trained in numpy by backpropagation through time (Adam) on the driver, from a bounded sample of labelled rows: at
most PER_LANGUAGE rows of each language and SAMPLE in all, the first in the order of a hash of their doc_id, and of each
at most SAMPLE_CHARS characters from a place that a hash chooses, drawn only from documents with a language whose
crc32(doc_id as text) mod 3 is not 1. Labels, sources and ids are never inputs of a prediction, and the same rows give
the same model. Every text is predicted from the whole of it.

Defined results: a null text, or one without a letter, is `und` with score 0; so is every text if no row is labelled; a
null doc_id is not held out and never trained on; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import BATCH_BYTES, arrow_bytes, bounded_batches, boxed, pick, table, text_slices, unboxed

#: The bounds of the training sample.
PER_LANGUAGE, SAMPLE, SAMPLE_CHARS = 200, 2000, 4000
#: Bytes of a window and of the context on either side; windows that run side by side.
CORE, HALO, LANES = 512, 48, 3072
LEAK = 0.125
HIDDEN, SPAN, STEPS, BATCH, RATE = 8, 64, 400, 256, 0.02
#: Share of the training windows that are read in upper case.
UPPER = 0.15
#: A document of which no language reaches this mean probability is rejected by identified().
LEAST_SCORE = 0.5
_ANY_LETTER = r"\p{L}"
_LETTER = np.zeros(256, np.float32)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


class Scan:
    """One direction over rows of bytes; states are (row, unit)."""

    def __init__(self, w: np.ndarray, u: np.ndarray, rows: int):
        n = u.shape[1]
        parts = [(w[:n] / 2, u[:n] / 2), (w[n:], u[n:])]  # sigmoid(x) = tanh(x / 2) / 2 + 1 / 2
        (self.wf, self.uf), (self.wc, self.uc) = ([np.ascontiguousarray(m.T) for m in part] for part in parts)
        self.h = np.zeros((rows, n), np.float32)
        self.room = [np.empty((rows, n), np.float32) for _ in range(4)]

    def step(self, x: np.ndarray) -> np.ndarray:
        """Moves the first len(x) states on by one byte each."""
        k = len(x)
        h = self.h[:k]
        f, c, g, q = (m[:k] for m in self.room)
        np.take(self.wf, x, axis=0, out=f, mode="clip")
        np.take(self.wc, x, axis=0, out=c, mode="clip")
        np.matmul(h, self.uf, out=g)
        np.matmul(h, self.uc, out=q)
        f += g
        np.tanh(f, out=f)
        f *= (1 - LEAK) / 2
        f += (1 + LEAK) / 2
        q *= f
        c += q
        np.tanh(c, out=c)
        c -= h
        c *= f
        h += c
        return h


def _windows(starts: np.ndarray, core: int, halo: int) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end: each window's text, first byte read, first and last byte labelled, last byte read."""
    sizes = np.diff(starts)
    times = -(-sizes // core)
    text = np.repeat(np.arange(len(sizes)), times)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(times) - times, times)
    low, high = starts[text], starts[text + 1]
    first = low + nth * core
    last = np.minimum(first + core, high)
    return text, np.maximum(low, first - halo), first, last, np.minimum(high, last + halo)


class Network:
    """Two gated recurrent scans over bytes and a softmax at every position."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 11):
        draw = np.random.default_rng(seed)
        self.languages = languages
        normal = lambda *shape: (draw.standard_normal(shape) / np.sqrt(hidden)).astype(np.float32)
        self.weights = [normal(2 * hidden, 256), normal(2 * hidden, hidden), normal(2 * hidden, 256), normal(2 * hidden, hidden), normal(len(languages), 2 * hidden), np.zeros((len(languages), 1), np.float32)]

    # ---- reading

    def sums(self, data: np.ndarray, starts: np.ndarray, core: int = CORE, halo: int = HALO) -> np.ndarray:
        """For each text the summed probabilities of its letters' positions, and how many there are."""
        out = np.zeros((len(starts) - 1, len(self.languages) + 1))
        if not len(data):
            return out
        text, left, first, last, right = _windows(np.asarray(starts), core, halo)
        order = np.argsort(left - right, kind="stable")  # the longest first: what still runs is always a prefix
        lanes = max(16, min(LANES, (8 << 20) // ((core + 2 * halo) * len(self.languages))))
        for at in range(0, len(order), lanes):
            own = order[at : at + lanes]
            np.add.at(out, text[own], self._read(data, left[own], first[own], last[own], right[own]).T)
        return out

    def _read(self, data: np.ndarray, left: np.ndarray, first: np.ndarray, last: np.ndarray, right: np.ndarray) -> np.ndarray:
        """(languages and count, windows): sums over the labelled positions of windows, the longest first."""
        wf, uf, wb, ub, v, bias = self.weights
        n, kinds, rows, steps = uf.shape[1], len(self.languages), len(left), int(right[0] - left[0])
        running = np.searchsorted(left - right, -np.arange(steps), side="left").tolist()  # windows longer than t bytes
        scan = Scan(wf, uf, rows)
        read = np.empty((steps, rows), np.uint8)
        logits = np.zeros((steps, kinds, rows), np.float32)
        ahead, back = np.ascontiguousarray(v[:, :n]), np.ascontiguousarray(v[:, n:])
        for t, k in enumerate(running):
            x = read[t, :k] = data[left[:k] + t]
            np.matmul(ahead, scan.step(x).T, out=logits[t, :, :k])
        logits += bias
        wide = (np.abs(v).sum(axis=1) + np.abs(bias[:, 0])).max() > 60  # else, as states lie between -1 and 1, no exponential overflows
        scan = Scan(wb, ub, rows)
        out = np.zeros((kinds + 1, rows), np.float32)
        low, high = first - left, last - left
        all_from, all_to = int(low.max()), int(np.min(high[right > last], initial=steps))  # between them, every position counts
        room = np.empty((kinds, rows), np.float32)
        for t in range(steps - 1, -1, -1):
            k = running[t]
            x = read[t, :k]
            p = np.matmul(back, scan.step(x).T, out=room[:, :k])
            p += logits[t, :, :k]
            if wide:
                p -= p.max(axis=0)
            np.exp(p, out=p)
            label = _LETTER[x]
            if t < all_from or t >= all_to:
                label *= (low[:k] <= t) & (high[:k] > t)
            out[-1, :k] += label
            label /= p.sum(axis=0)
            p *= label
            out[:-1, :k] += p
        return out

    def predict(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """lang_pred and score of each text."""
        data, starts = arrow_bytes(texts)
        sums = self.sums(data, starts)
        told = pc.fill_null(pc.match_substring_regex(texts, _ANY_LETTER), False).to_numpy(zero_copy_only=False) & (sums[:, -1] > 0)
        p = sums[:, :-1] / np.maximum(sums[:, -1:], 1)
        best = p.argmax(axis=1)
        names = np.where(told, np.array([*self.languages, "und"], object)[best], "und")
        return pa.array(names, pa.string()), pa.array(np.where(told, np.minimum(1.0, p.max(axis=1)), 0.0))

    # ---- learning

    def _states(self, x: np.ndarray, w: np.ndarray, u: np.ndarray, backward: bool) -> tuple[np.ndarray, list]:
        """States (time, unit, row) of one direction over x (time, row), and what the gradient needs."""
        n, kept = u.shape[1], []
        h, out = np.zeros((n, x.shape[1]), w.dtype), np.empty((x.shape[0], n, x.shape[1]), w.dtype)
        for t in range(x.shape[0] - 1, -1, -1) if backward else range(x.shape[0]):
            a, g = w[:, x[t]], u @ h
            f = (1 - LEAK) / 2 * np.tanh(0.5 * (a[:n] + g[:n])) + (1 + LEAK) / 2
            c = np.tanh(a[n:] + f * g[n:])
            kept.append((t, h, f, c, g[n:]))
            h = h + f * (c - h)
            out[t] = h
        return out, kept

    @staticmethod
    def _unscan(x: np.ndarray, u: np.ndarray, kept: list, to_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of w and u, from the gradient at the states: backpropagation through time."""
        n = u.shape[1]
        du, carry = np.zeros_like(u), np.zeros_like(kept[0][1])
        at_inputs = np.empty((x.shape[0], 2 * n, x.shape[1]), u.dtype)
        for t, h, f, c, pulled in reversed(kept):
            full = to_states[t] + carry
            d_c = full * f * (1 - c * c)
            d_f = (full * (c - h) + d_c * pulled) * (f - LEAK) * (1 - f) / (1 - LEAK)
            d_g = np.concatenate([d_f, d_c * f])
            du += d_g @ h.T
            at_inputs[t, :n], at_inputs[t, n:] = d_f, d_c
            carry = full * (1 - f) + u.T @ d_g
        flat = x.ravel()
        dw = np.stack([np.bincount(flat, at_inputs[:, i].ravel(), 256) for i in range(2 * n)]).astype(u.dtype)
        return dw, du

    def probabilities(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, list, list]:
        """Probabilities (time, language, row), states of both directions, and what their gradients need."""
        wf, uf, wb, ub, v, bias = self.weights
        ahead, kept_ahead = self._states(x, wf, uf, False)
        back, kept_back = self._states(x, wb, ub, True)
        states = np.concatenate([ahead, back], axis=1)
        logits = v @ states + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True), states, kept_ahead, kept_back

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """The mean loss over the positions of mask, and its gradients; x, mask (time, row), y a label for each row."""
        _, uf, _, ub, v, _ = self.weights
        p, states, kept_ahead, kept_back = self.probabilities(x)
        weight = (mask / mask.sum())[:, None, :]
        rows = np.arange(len(y))
        loss = -float((np.log(p[:, y, rows] + 1e-9) * weight[:, 0]).sum())
        d = p.copy()
        d[:, y, rows] -= 1
        d *= weight
        to_states, n = v.T @ d, uf.shape[1]
        dwf, duf = self._unscan(x, uf, kept_ahead, to_states[:, :n])
        dwb, dub = self._unscan(x, ub, kept_back, to_states[:, n:])
        return loss, [dwf, duf, dwb, dub, np.einsum("tlr,tsr->ls", d, states), d.sum(axis=(0, 2))[:, None]]

    def train(self, texts: list[bytes], labels: np.ndarray, steps: int = STEPS, seed: int = 12) -> float:
        """Adam over windows of the texts, languages alike and texts of one language by length; the last losses' mean."""
        draw = np.random.default_rng(seed)
        first, second = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights]
        sizes = np.array([len(t) for t in texts])
        padded = np.frombuffer(b"".join(t + b" " * SPAN for t in texts), np.uint8)
        starts = np.cumsum(sizes + SPAN) - sizes - SPAN
        chances = sizes / np.bincount(labels, sizes, len(self.languages))[labels]
        chances, last = chances / chances.sum(), []
        upper = np.arange(256)
        upper[97:123] -= 32
        for step in range(1, steps + 1):
            at = draw.choice(len(texts), BATCH, p=chances)
            begin = starts[at] + (draw.random(BATCH) * np.maximum(1, sizes[at] - SPAN + 1)).astype(np.int64)
            x = padded[begin + np.arange(SPAN)[:, None]].astype(np.int64)
            x = np.where(draw.random(BATCH) < UPPER, upper[x], x)
            mask = _LETTER[x]
            mask[0, mask.sum(axis=0) == 0] = 1e-6
            loss, gradients = self.gradients(x, mask, labels[at])
            last = [*last[-49:], loss]
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for w, g, a, b in zip(self.weights, gradients, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
        return float(np.mean(last))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(documents: DataFrame, per_language: int = PER_LANGUAGE, sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Network | None:
    """documents (doc_id, text, lang): the trained network, or None if no row is labelled.

    The driver gets at most `sample` rows of at most `chars` characters, however often a doc_id or text is repeated.
    """
    labelled = pick(documents, "doc_id", "text", "lang").filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").filter(~held_out())
    place = F.pmod(F.xxhash64("text"), F.greatest(F.lit(1), F.length("text") - chars + 1)).cast("int") + 1
    labelled = labelled.select(F.col("lang").cast("string").alias("lang"), "doc_id", F.xxhash64("text").alias("key"), F.col("text").substr(place, F.lit(chars)).alias("part"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "key")
    chosen = labelled.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= per_language)
    rows = sorted(chosen.orderBy("nth", "lang").limit(sample).select("lang", "doc_id", "key", "part").collect())
    rows = [r for r in rows if re.search(r"[^\W\d_]", r.part)]
    if not rows:
        return None
    languages = sorted({r.lang for r in rows})
    network = Network(languages)
    network.train([r.part.encode() for r in rows], np.array([languages.index(r.lang) for r in rows]))
    return network


def _told(network: Network | None):
    """text to its language and score, as a column that Python makes from the text alone."""

    @F.arrow_udf("lang_pred string, score double")
    def told(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            names, scores = [], []
            for part in text_slices(batch, BATCH_BYTES):
                name, score = network.predict(part) if network else (pa.array(["und"] * len(part)), pa.array([0.0] * len(part)))
                names.append(name)
                scores.append(score)
            arrays = [pa.concat_arrays(x) if x else pa.array([], kind) for x, kind in ((names, pa.string()), (scores, pa.float64()))]
            yield pa.StructArray.from_arrays(arrays, names=["lang_pred", "score"])

    return told.asNondeterministic()  # else a filter on the verdict would have every text read twice


def identify(documents: DataFrame, network: Network | None) -> DataFrame:
    """documents (doc_id, text): doc_id, lang_pred, score. Nothing else of a row is read."""
    bounded_batches(documents.sparkSession)
    slim = pick(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.select("doc_id", _told(network)("text").alias("told")).select("doc_id", "told.lang_pred", "told.score")


def identified(documents: DataFrame, network: Network | None, least: float = LEAST_SCORE) -> DataFrame:
    """The documents whose language can be told, with all their columns; a null lang becomes the predicted one.

    Those without a letter go, and those of which no language reaches the mean probability `least`. Without a network
    (no row to train on) no language can be told: then only those without a letter go, and lang stays as it is. Only
    texts are sent to Python, and only verdicts come back.
    """
    bounded_batches(documents.sparkSession)
    box = boxed(documents)
    letter = F.coalesce(F.col("text").rlike(_ANY_LETTER), F.lit(False))
    if network is None:
        return unboxed(box.filter(letter), documents)
    box = box.withColumn("told", _told(network)("text")).filter(F.col("told.score") >= least)
    at = {name: i for i, name in reversed(list(enumerate(documents.columns)))}
    lang = {"lang": F.coalesce(F.col(f"rest._c{at['lang']}"), F.col("told.lang_pred").cast(documents.schema[at["lang"]].dataType))} if "lang" in at else {}
    return unboxed(box, documents, **lang)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return identify(documents, fit(documents)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
