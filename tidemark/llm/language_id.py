"""Language identification with a linear-chain conditional random field.

Words are runs of letters. A word's emission scores come from hashed affixes (first and last two and three bytes), byte
trigrams and a lexicon of whole words; transitions between the languages of neighbouring words are learned with them, so a
text that switches languages gets a label for every word. Training maximizes the conditional likelihood by Adagrad on the
words of a bounded sample of labelled rows, cut into sequences, half of which are spliced from texts of different
languages. Prediction runs forward-backward over whole texts, all texts of a block in step, and a text's language is the
one with the largest mean marginal over its words; that mean is the score.

Defined cases: a null text or one without a letter is `und` with score 0, and so is every text if no row could be learned
from; repeated rows are predicted alike; null labels are never learned from; a label that occurs once is a label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, set_aside

#: Bound of the training sample: rows of each label, and UTF-8 bytes of a row (shorter ones than 200 only if a label has no other).
ROWS_PER_LABEL = 200
LONGEST_ROW = 50_000
#: Characters of texts that go through forward-backward together: eight times as many took 165 MB of arrays.
GROUP_CHARS = 1 << 20
BITS = 17
_KINDS = 6  # first 2, first 3, last 2, last 3, whole word, trigrams
_ALPHABET = np.zeros(256, bool)
_ALPHABET[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
UNDETERMINED = "und"


def _slot(x: np.ndarray, kind: int) -> np.ndarray:
    """Row of the weight table for a 32-bit value of one kind of feature."""
    h = (x.astype(np.uint32) + np.uint32(kind * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
    return ((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(32 - BITS)).astype(np.int32)


@dataclass
class Words:
    """Features of the words of some texts: slots of the five features a word has, and of its trigrams in a row."""

    fixed: np.ndarray  # words x 5
    trigrams: np.ndarray
    begin: np.ndarray  # first trigram of each word
    size: np.ndarray  # trigrams of each word
    first: np.ndarray  # byte at which each word starts


def featurize(data: bytes) -> Words:
    """Words of lower-cased UTF-8 bytes. A word of n bytes has n trigrams over itself with a boundary on either side."""
    b = np.frombuffer(data, np.uint8)
    letter = _ALPHABET[b]
    edge = np.diff(np.concatenate(([False], letter, [False])).astype(np.int8))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    size = end - first
    padded = np.zeros(len(b) + 6, np.uint32)
    padded[3 : 3 + len(b)] = np.where(letter, b, 0)
    at = first + 3
    a0, a1, a2 = padded[at], padded[at + 1], padded[at + 2]
    a2 = np.where(size > 1, a2, 0)
    z = end + 2
    z0, z1, z2 = padded[z], np.where(size > 1, padded[z - 1], 0), np.where(size > 2, padded[z - 2], 0)
    middle = np.flatnonzero(letter) + 3
    grams = padded[middle - 1] << np.uint32(16) | padded[middle] << np.uint32(8) | padded[middle + 1]
    begin = np.concatenate(([0], np.cumsum(size)[:-1])) if len(size) else size
    # The word's hash is a sum over its bytes of powers of an odd base, as in the prefix sums of a rolling hash.
    power = np.full(len(b) + 1, 0x01000193, np.uint32)
    power[0] = 1
    power = np.multiply.accumulate(power)
    inverse = np.full(len(b) + 1, pow(0x01000193, -1, 1 << 32), np.uint32)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    sums = np.concatenate((np.zeros(1, np.uint32), np.cumsum((b.astype(np.uint32) + np.uint32(1)) * np.uint32(0x2C1B3C6D) * power[:-1], dtype=np.uint32)))
    whole = (sums[end] - sums[first]) * inverse[first] + size.astype(np.uint32)
    fixed = np.stack(
        [_slot(a0 << np.uint32(8) | a1, 0), _slot(a0 << np.uint32(16) | a1 << np.uint32(8) | a2, 1), _slot(z1 << np.uint32(8) | z0, 2), _slot(z2 << np.uint32(16) | z1 << np.uint32(8) | z0, 3), _slot(whole, 4)],
        axis=1,
    ).reshape(-1, 5)
    return Words(fixed, _slot(grams, 5), begin, size, first)


def emissions(words: Words, weights: np.ndarray) -> np.ndarray:
    """Score of each label for each word: its fixed features' weights and the mean of its trigrams' weights."""
    if not len(words.size):
        return np.zeros((0, weights.shape[1]), np.float32)
    out = np.add.reduceat(weights[words.trigrams], words.begin, axis=0) / words.size[:, None].astype(np.float32)
    for k in range(words.fixed.shape[1]):
        out += weights[words.fixed[:, k]]
    return out


@dataclass
class Crf:
    labels: list[str]
    weights: np.ndarray  # slots x labels
    transitions: np.ndarray  # from x to, scores
    start: np.ndarray


def forward_backward(scores: np.ndarray, counts: np.ndarray, crf_transitions: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of every word (texts one after another, counts[d] words each) and expected transitions.

    All texts advance together, the longest first, so step t works on the texts with more than t words.
    """
    n_labels = scores.shape[1]
    order = np.argsort(-counts, kind="stable")
    lens = counts[order]
    steps = int(lens[0]) if len(lens) else 0
    active = np.searchsorted(-lens, -np.arange(steps), side="left")
    offset = np.concatenate(([0], np.cumsum(active)))
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    doc = np.repeat(np.arange(len(counts)), counts)
    t = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = offset[t] + rank[doc]
    e = np.empty((len(doc), n_labels), np.float32)
    e[place] = np.exp(scores - scores.max(axis=1, keepdims=True))
    move = np.exp(crf_transitions - crf_transitions.max()).astype(np.float32)
    alpha = np.empty_like(e)
    now = None
    for s in range(steps):
        a, b = offset[s], offset[s + 1]
        now = e[a:b] * (np.exp(start - start.max()).astype(np.float32) if now is None else now[: b - a] @ move)
        now /= now.sum(axis=1, keepdims=True)
        alpha[a:b] = now
    beta = np.ones((len(counts), n_labels), np.float32)
    marginals = np.empty_like(e)
    expected = np.zeros((n_labels, n_labels))
    back = move.T.copy()
    for s in range(steps - 1, -1, -1):
        a, b = offset[s], offset[s + 1]
        now = beta[: b - a]
        m = alpha[a:b] * now
        m /= m.sum(axis=1, keepdims=True)
        marginals[a:b] = m
        if s:
            right = e[a:b] * now
            left = alpha[offset[s - 1] : offset[s - 1] + b - a]
            below = right @ back
            z = (left * below).sum(axis=1, keepdims=True)
            expected += (left / z).T @ right * move
            beta[: b - a] = below / below.sum(axis=1, keepdims=True)
    return marginals[place], expected


def train(texts: list[str], labels: list[str], rounds: int = 12, length: int = 60, seed: int = 5) -> Crf:
    """Fit on labelled texts: sequences of `length` words, as they stand and spliced from runs of different texts."""
    names = sorted(set(labels))
    at = {x: k for k, x in enumerate(names)}
    rng = np.random.default_rng(seed)
    lowered = [x.lower() for x in texts]
    tokens: list[tuple[list[bytes], int]] = []
    for x, y in zip(lowered, labels, strict=True):
        raw = bytes(c if ok else 32 for c, ok in zip(raw_, _ALPHABET[np.frombuffer(raw_, np.uint8)].tolist(), strict=True)) if (raw_ := x.encode()) else b""
        w = raw.split()
        if w:
            tokens.append((w, at[y]))
    weights = np.zeros((1 << BITS, len(names)), np.float32)
    moves, start = np.zeros((len(names), len(names))), np.zeros(len(names))
    if not tokens:
        return Crf(names, weights, moves, start)
    sequences: list[tuple[list[bytes], list[int]]] = []
    for w, y in tokens:
        k = int(rng.integers(0, max(1, len(w) - length + 1)))
        sequences.append((w[k : k + length], [y] * len(w[k : k + length])))
    for _ in range(len(tokens)):
        words: list[bytes] = []
        truth: list[int] = []
        while len(words) < length:
            w, y = tokens[int(rng.integers(len(tokens)))]
            n = int(rng.integers(8, 40))
            k = int(rng.integers(0, max(1, len(w) - n + 1)))
            words += w[k : k + n]
            truth += [y] * len(w[k : k + n])
        sequences.append((words[:length], truth[:length]))
    f = featurize(b"\n".join(b" ".join(w) for w, _ in sequences))
    counts = np.array([len(w) for w, _ in sequences])
    truth = np.concatenate([np.array(y) for _, y in sequences])
    hot = np.eye(len(names), dtype=np.float32)[truth]
    firsts = np.cumsum(counts) - counts
    inner = np.ones(len(truth), bool)
    inner[firsts] = False
    i = np.flatnonzero(inner)
    observed = np.zeros_like(moves)
    np.add.at(observed, (truth[i - 1], truth[i]), 1)
    of_gram = np.repeat(np.arange(len(f.size)), f.size)
    square_w, square_m, square_s = np.full_like(weights, 1e-6), np.full_like(moves, 1e-6), np.full_like(start, 1e-6)
    for _ in range(rounds):
        marginals, expected = forward_backward(emissions(f, weights), counts, moves, start)
        error = hot - marginals
        per_gram = (error / f.size[:, None].astype(np.float32))[of_gram]
        grad = np.empty_like(weights)
        for k in range(len(names)):
            g = np.bincount(f.trigrams, per_gram[:, k], 1 << BITS)
            for c in range(f.fixed.shape[1]):
                g += np.bincount(f.fixed[:, c], error[:, k], 1 << BITS)
            grad[:, k] = g
        grad = grad / len(truth) - 1e-7 * weights
        gm, gs = (observed - expected) / len(truth), error[firsts].sum(0) / len(truth)
        for x, g, sq, rate in ((weights, grad, square_w, 0.5), (moves, gm, square_m, 0.3), (start, gs, square_s, 0.1)):
            sq += g * g
            x += (rate * g / np.sqrt(sq)).astype(x.dtype)
    return Crf(names, weights, moves, start)


def label_texts(texts: list[str], crf: Crf) -> tuple[list[np.ndarray], list[list[bytes]]]:
    """Marginals of every word of every text, and the words."""
    out, words = [], []
    for x in texts:
        data = x.lower().encode()
        f = featurize(data)
        m, _ = forward_backward(emissions(f, crf.weights), np.array([len(f.size)]), crf.transitions, crf.start)
        out.append(m)
        words.append([data[a : a + n] for a, n in zip(f.first.tolist(), f.size.tolist(), strict=True)])
    return out, words


def classify(texts: list[str], crf: Crf) -> list[tuple[str, float]]:
    """Language and score of each text."""
    return [(label, score) for label, score, _ in classify_surely(texts, crf)]


def classify_surely(texts: list[str], crf: Crf) -> list[tuple[str, float, float]]:
    """Language, score and certainty of each text; certainty is the mean over words of each word's largest marginal.

    Texts of like length advance together, GROUP_CHARS of them at once: so memory is that of a group (or of one longer text), and a short text
    doesn't wait for a long one.
    """
    if not crf.labels:
        return [(UNDETERMINED, 0.0, 0.0)] * len(texts)
    out: list[tuple[str, float, float]] = [(UNDETERMINED, 0.0, 0.0)] * len(texts)
    group: list[int] = []
    size = 0
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        if group and size + len(texts[i]) > GROUP_CHARS:
            _classify_group(texts, group, crf, out)
            group, size = [], 0
        group.append(i)
        size += len(texts[i])
    _classify_group(texts, group, crf, out)
    return out


def _classify_group(every: list[str], group: list[int], crf: Crf, out: list[tuple[str, float, float]]) -> None:
    """Set the members of the group in out."""
    texts = [every[i] for i in group]
    scores, counts, pending, pending_size = [], np.zeros(len(texts), np.int64), [], 0

    def flush() -> None:
        nonlocal pending, pending_size
        if pending:
            data = b"\n".join(d for _, d in pending)
            f = featurize(data)
            scores.append(emissions(f, crf.weights))
            ends = np.cumsum([len(d) + 1 for _, d in pending])
            np.add.at(counts, [i for i, _ in pending], np.diff(np.searchsorted(f.first, ends), prepend=0))
            pending, pending_size = [], 0

    for i, x in enumerate(texts):
        data = x.lower().encode()
        at = 0
        while at < len(data):  # pieces of a megabyte, cut at a space
            stop = at + (1 << 20)
            if stop < len(data):
                space = data.rfind(b" ", at, stop)
                stop = space if space > at else stop
            pending.append((i, data[at:stop]))
            pending_size += stop - at
            at = stop
            if pending_size >= 1 << 20:
                flush()
    flush()
    found = np.concatenate(scores) if scores else np.zeros((0, len(crf.labels)), np.float32)
    some = np.flatnonzero(counts)
    sums, sure = np.zeros((len(texts), len(crf.labels))), np.zeros(len(texts))
    if len(some):
        m, _ = forward_backward(found, counts[some], crf.transitions, crf.start)
        firsts = np.cumsum(counts[some]) - counts[some]
        sums[some] = np.add.reduceat(m.astype(np.float64), firsts, axis=0)
        sure[some] = np.add.reduceat(m.max(axis=1).astype(np.float64), firsts)
    for i, x, n, s, c in zip(group, texts, counts.tolist(), sums, sure.tolist(), strict=True):
        if n and any(map(str.isalpha, x)):
            k = int(np.argmax(s))
            out[i] = crf.labels[k], min(1.0, float(s[k] / n)), min(1.0, c / n)


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 3; fold 1 is held out."""
    return F.crc32(key.cast("string")) % 3


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", rows_per_label: int = ROWS_PER_LABEL) -> Crf:
    """Train on at most rows_per_label rows of each label outside the held-out fold. limit() reads only the partitions it needs."""
    known = docs.filter(F.col(label).isNotNull() & (fold(F.col(key)) != 1)).select(F.col(text).alias("text"), F.col(label).alias("label"))
    texts, labels = [], []
    for (name,) in known.select("label").distinct().collect():
        rows = known.filter((F.col("label") == name) & F.octet_length("text").between(200, LONGEST_ROW)).limit(rows_per_label).collect()
        rows = rows or known.filter((F.col("label") == name) & F.col("text").isNotNull()).limit(rows_per_label).collect()
        texts += [r["text"] for r in rows]
        labels += [r["label"] for r in rows]
    return train(texts, labels)


def predict(docs: DataFrame, crf: Crf, text: str = "text", certainty: str | None = None) -> DataFrame:
    """All rows with lang_pred and score appended, and the certainty under the given name.

    Scores are rounded to six digits, so equal texts have equal scores whatever stands beside them.
    """
    outputs = ("lang_pred", "score", *([certainty] if certainty else []))
    docs = set_aside(docs, *outputs)
    schema = docs.select("*").schema.add("lang_pred", "string").add("score", "double")
    if certainty:
        schema = schema.add(certainty, "double")
    model = docs.sparkSession.sparkContext.broadcast(crf)  # a fixed number of weights for each label

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, text, 8 << 20):
            found = [(name, round(score, 6), round(sure, 6)) for name, score, sure in classify_surely(texts, model.value)]
            columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.float64()))][: len(outputs)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    return docs.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = predict(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
