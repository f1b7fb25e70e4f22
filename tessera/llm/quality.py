"""Document quality from a linear-chain conditional random field over lines.

Each line is a state, good or bad. Its evidence is its own features and its
neighbours' (previous and next line), its coupling to the next line a learned
transition. Forward-backward gives every line's marginal; their mean, weighted
by line length, is the document's quality, which a one-variable logistic fit
brings to the scale of the labels.

The field is fitted on at most about ``sample`` labelled documents chosen by a
hash of the id, of at most ``longest`` characters each and about ``characters``
in all (their lines inherit the document's label); scoring reads every line of
every document, a long one in a slice of its own. Empty and null texts are one empty line. Labels are
never read when scoring. Null labels are ignored, repeated ones count once
(the higher). Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, light, text_or_empty
from tessera.llm.textarrays import mix, powers, slices

_CLASSES = {
    "upper": lambda b: 65 <= b <= 90,
    "lower": lambda b: 97 <= b <= 122,
    "high": lambda b: b >= 128,
    "digit": lambda b: 48 <= b <= 57,
    "blank": lambda b: b in (32, 9, 13),
    "stop": lambda b: b in b".,;:?'\"-",
    "mark": lambda b: b in b"!#$%&*+/<=>@[\\]^_{|}~()`",
}
_TABLE = np.array([[bool(f(b)) for f in _CLASSES.values()] for b in range(256)])
_HASH = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line, lines' lengths, first line of each text)."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    sizes = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=sizes[1:])
    at = np.searchsorted(starts, sizes)
    n = ends - starts

    def per_line(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, dtype=np.int32)
        np.cumsum(mask, out=total[1:])
        return (total[ends] - total[starts]).astype(float)

    masks = {k: _TABLE[:, i][data] for i, k in enumerate(_CLASSES)}
    c = {k: per_line(m) for k, m in masks.items()}
    inside = ~masks["blank"] & (data != 10)
    begins = inside & ~np.concatenate(([False], inside[:-1]))
    words = per_line(begins)
    size, letters = np.maximum(n, 1.0), c["upper"] + c["lower"] + c["high"]

    up, down = powers(len(data) + 1)
    running = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_HASH[data] * up[1:], dtype=np.uint64)))
    word_first = np.flatnonzero(begins)
    word_last = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False]))) + 1
    doc_of_line = np.repeat(np.arange(len(texts)), np.diff(at))

    def repeats(group: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Whether each value has come before in its group."""
        order = np.lexsort((np.arange(len(value)), value, group))
        again = np.zeros(len(value), dtype=bool)
        again[order[1:]] = (value[order[1:]] == value[order[:-1]]) & (group[order[1:]] == group[order[:-1]])
        return again

    word_hash = mix((running[word_last] - running[word_first]) * down[word_first])
    line_of_word = np.searchsorted(ends, word_first)
    word_again = np.bincount(line_of_word, weights=repeats(doc_of_line[line_of_word], word_hash), minlength=len(ends))
    line_hash = mix((running[ends] - running[starts]) * down[starts])
    line_again = repeats(doc_of_line, line_hash) & (n > 0)
    pair = mix(word_hash[:-1] * np.uint64(3) + word_hash[1:]) if len(word_hash) > 1 else word_hash[:0]
    pair_again = np.bincount(line_of_word[: len(pair)], weights=repeats(doc_of_line[line_of_word[: len(pair)]], pair), minlength=len(ends))

    w = np.maximum(words, 1)
    own = np.stack(
        [
            np.ones(len(n)), n == 0, n < 30, n > 400, np.log1p(n) / 6, np.log1p(words) / 4,
            c["upper"] / np.maximum(letters, 1), (c["upper"] > 0.5 * letters) & (letters > 3), c["digit"] / size, c["digit"] > 0.2 * size,
            c["stop"] / size * 5, c["mark"] / size * 3, c["mark"] > 0.02 * size, c["mark"] > 0.1 * size, letters / size, letters < 0.6 * size,
            c["blank"] / size * 3, np.minimum(n / w / 10, 3), n > 15 * w, word_again / w, word_again > 0.6 * w, line_again, pair_again / w, pair_again > 0.2 * w,
        ],
        axis=1,
    ).astype(float)
    before, after = np.roll(own[:, 1:], 1, axis=0), np.roll(own[:, 1:], -1, axis=0)
    before[at[:-1]], after[at[1:] - 1] = 0, 0
    share = np.add.reduceat(own[:, 1:] * size[:, None], at[:-1], axis=0) / np.add.reduceat(size, at[:-1])[:, None]
    return np.concatenate((own, before, after, share[doc_of_line]), axis=1), size, at


@dataclass
class LineField:
    weights: np.ndarray  # evidence for good of each feature
    couple: np.ndarray  # 2 x 2 transitions
    scale: tuple[float, float] = (1.0, 0.0)

    def marginals(self, evidence: np.ndarray, at: np.ndarray, expect: bool = False):
        """P(good) of each line; with ``expect`` also the log partition and the
        expected transitions. Texts advance side by side, longest first."""
        count = np.diff(at)
        order = np.argsort(-count, kind="stable")
        first, count = at[:-1][order], count[order]
        top = int(count[0]) if len(count) else 0
        alive = np.searchsorted(-count, -np.arange(1, top + 1), side="right")
        both = np.stack([-evidence / 2, evidence / 2], axis=1)
        alpha, beta = np.zeros_like(both), np.zeros_like(both)
        couple = self.couple
        for t in range(top):
            rows = first[: alive[t]] + t
            alpha[rows] = both[rows] + (0 if t == 0 else np.logaddexp(alpha[rows - 1, :1] + couple[0], alpha[rows - 1, 1:] + couple[1]))
        for t in range(top - 2, -1, -1):
            rows = first[: alive[t + 1]] + t
            after = both[rows + 1] + beta[rows + 1]
            beta[rows] = np.logaddexp(couple[:, 0] + after[:, :1], couple[:, 1] + after[:, 1:])
        last = first + count - 1
        whole = np.zeros(len(at) - 1)
        whole[order] = np.logaddexp(alpha[last, 0], alpha[last, 1])
        each = np.repeat(whole, np.diff(at))
        good = np.exp(alpha[:, 1] + beta[:, 1] - each)
        if not expect:
            return good
        inner = np.ones(len(evidence), dtype=bool)
        inner[at[1:] - 1] = False
        i = np.flatnonzero(inner)
        pair = np.exp(alpha[i][:, :, None] + couple[None] + (both[i + 1] + beta[i + 1])[:, None, :] - each[i][:, None, None])
        return good, whole, pair, i

    def raw(self, features: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
        good = self.marginals(features @ self.weights, at)
        return np.add.reduceat(good * size, at[:-1]) / np.add.reduceat(size, at[:-1])

    def score(self, texts: list[str]) -> np.ndarray:
        out = [np.zeros(0)]
        for a, b in slices(texts, 500_000):
            raw = np.clip(self.raw(*line_features(texts[a:b])), 1e-6, 1 - 1e-6)
            out.append(1 / (1 + np.exp(-(self.scale[0] * np.log(raw / (1 - raw)) + self.scale[1]))))
        return np.concatenate(out)


def fit_field(texts: list[str], labels: np.ndarray, rounds: int = 150, penalty: float = 1e-3) -> LineField:
    """Penalized maximum likelihood by Adam: of each document the log likelihood of
    its lines' labels counts by one over their number, steps and lines alike."""
    if not len(texts):
        return LineField(np.zeros(line_features([""])[0].shape[1]), np.zeros((2, 2)))
    features, size, at = line_features(texts)
    per_line = np.repeat(labels, np.diff(at)).astype(float)
    weight = np.repeat(1 / np.diff(at), np.diff(at))  # of a line, and of the step behind it
    model = LineField(np.zeros(features.shape[1]), np.zeros((2, 2)))
    flat = np.zeros(features.shape[1] + 4)
    m, v = np.zeros_like(flat), np.zeros_like(flat)
    for k in range(1, rounds + 1):
        model.weights, model.couple = flat[:-4], flat[-4:].reshape(2, 2)
        good, _, pair, inner = model.marginals(features @ model.weights, at, expect=True)
        slope = features.T @ ((good - per_line) * weight) / len(texts)
        state = per_line[inner].astype(int)
        seen = np.zeros((2, 2))
        np.add.at(seen, (state, state), weight[inner])
        grad = np.concatenate((slope, ((pair * weight[inner][:, None, None]).sum(axis=0) - seen).ravel() / len(texts))) + penalty * flat
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        flat = flat - 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    model.weights, model.couple = flat[:-4].copy(), flat[-4:].reshape(2, 2).copy()
    raw = np.clip(model.raw(features, size, at), 1e-6, 1 - 1e-6)
    x, a, b = np.log(raw / (1 - raw)), 1.0, 0.0
    for _ in range(50):  # Newton's method with a small ridge
        p = 1 / (1 + np.exp(-(a * x + b)))
        r, h = p - labels, np.maximum(p * (1 - p), 1e-6)
        gradient = np.array([(r * x).sum() + 0.1 * (a - 1), r.sum() + 0.1 * b])
        hessian = np.array([[(h * x * x).sum() + 0.1, (h * x).sum()], [(h * x).sum(), h.sum() + 0.1]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(hessian, gradient), -1, 1)
    model.scale = (float(a), float(b))
    return model


def learn_field(docs: DataFrame, labels: DataFrame, use: Column, sample: int = 3000, characters: int = 20_000_000, longest: int = 200_000) -> LineField:
    """Fits on the labelled documents of ``use``; the driver gets the sample alone."""
    known = labels.filter(use & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    size = F.length(text_or_empty())
    n, total = docs.filter(use).select("doc_id", size.alias("size")).filter(F.col("size") <= longest).join(known, "doc_id").agg(F.count("*"), F.sum("size")).first()
    share = min(1.0, sample / max(1, n), characters / max(1, total or 0))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) / F.lit(float(1 << 20)) < F.lit(share)
    drawn = docs.filter(use & draw & (size <= longest)).select("doc_id", text_or_empty().alias("text"))  # before the join: few texts are shuffled
    rows = drawn.join(known.filter(draw), "doc_id").select("doc_id", "text", "label").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return fit_field([r["text"] for r in rows], np.array([r["label"] for r in rows], dtype=float))


def score_documents(docs: DataFrame, field: LineField) -> DataFrame:
    """(doc_id, score) of every row."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": field.score(pdf["text"].tolist())})

    bounded_batches(docs.sparkSession)
    # Ids pass as strings: pandas would make nullable longs floats.
    slim = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_or_empty().alias("text"))
    return slim.mapInPandas(light(score), "doc_id string, score double").withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
