"""Speaker turns out of clustered windows: clustering, conflicts, lone labels.

Turns are folded per session: what happens to one depends on what became of the
one before, so a session's windows are taken in order in one group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

TURNS = "session_id long, s_ms double, e_ms double, speaker string, confidence double"


def silhouette(x: np.ndarray, labels: np.ndarray) -> float:
    """Mean silhouette by Euclidean distance; a point alone in its cluster counts 0."""
    square = (x * x).sum(axis=1)
    far = np.sqrt(np.maximum(0, square[:, None] + square[None, :] - 2 * x @ x.T))
    names, code = np.unique(labels, return_inverse=True)
    sums = np.stack([far[:, code == k].sum(axis=1) for k in range(len(names))], axis=1)
    count = np.bincount(code)
    rows = np.arange(len(x))
    own = sums[rows, code] / np.maximum(1, count[code] - 1)
    other = sums / count
    other[rows, code] = np.inf
    other = other.min(axis=1)
    score = np.where(count[code] > 1, (other - own) / np.maximum(np.maximum(own, other), 1e-12), 0.0)
    return float(score.mean())


def k_means(x: np.ndarray, k: int, seed: int = 0, starts: int = 10, rounds: int = 100) -> np.ndarray:
    rng = np.random.default_rng(seed)
    best, low = np.zeros(len(x), int), np.inf
    for _ in range(starts):
        centre = x[[rng.integers(len(x))]]
        while len(centre) < k:
            gap = ((x[:, None, :] - centre[None]) ** 2).sum(-1).min(axis=1)
            centre = np.vstack([centre, x[rng.choice(len(x), p=gap / gap.sum()) if gap.sum() > 0 else rng.integers(len(x))]])
        for _ in range(rounds):
            d = ((x[:, None, :] - centre[None]) ** 2).sum(-1)
            label = d.argmin(axis=1)
            new = np.stack([x[label == c].mean(axis=0) if (label == c).any() else centre[c] for c in range(k)])
            if np.allclose(new, centre):
                break
            centre = new
        cost = float(d[np.arange(len(x)), label].sum())
        if cost < low:
            best, low = label, cost
    return best


def count_speakers(x: np.ndarray, least: int = 1, most: int = 2, seed: int = 0, bar: float = 0.10) -> tuple[int, float]:
    """The number of clusters with the best silhouette, and a confidence; one if none reaches the bar (half of it for narrow bands)."""
    n = len(x)
    if n <= 2 or least == most:
        return max(least, 1), 0.5
    if min(most, n - 1) < 2:
        return 1, 0.5
    found = []
    for k in range(max(least, 2), min(most, n - 1) + 1):
        label = k_means(x, k, seed)
        if len(set(label)) > 1:
            found.append((silhouette(x, label), -k))
    score, k = max(found, default=(-1.0, -1))
    if score < bar and least <= 1:
        return 1, max(0.0, score + 0.5)
    return -k, float(np.clip((score + 1) / 2, 0, 1))


Turn = tuple[float, float, str, float]


def settle(turns: list[Turn], gap_ms: float = 400.0) -> list[Turn]:
    """One speaker at a time: of two who overlap each gets half of the contested span; then a speaker's close turns join."""
    calm: list[Turn] = []
    for s, e, who, conf in sorted(turns, key=lambda x: (x[0], x[1])):
        if not calm or s >= calm[-1][1]:
            calm.append((s, e, who, conf))
            continue
        a, b, last, c = calm.pop()
        if who == last:
            calm.append((a, max(b, e), who, (c + conf) / 2))
        else:
            middle = (max(a, s) + min(b, e)) / 2
            calm.append((a, middle, last, c))
            if e > middle:
                calm.append((middle, e, who, conf))
    out: list[Turn] = []
    for turn in calm:
        if out and out[-1][2] == turn[2] and turn[0] - out[-1][1] <= gap_ms:
            a, b, who, c = out.pop()
            turn = (a, max(b, turn[1]), who, (c + turn[3]) / 2)
        out.append(turn)
    return [x for x in out if x[1] - x[0] > 1]


def absorb(turns: list[Turn], short_ms: float = 1000.0) -> list[Turn]:
    """A short turn whose label stands nowhere else takes the label of its longer neighbour, the one before if they are alike; then settle()."""
    labels = [x[2] for x in turns]
    length = [x[1] - x[0] for x in turns]
    while len(turns) > 1:
        lone = next((i for i, who in enumerate(labels) if length[i] < short_ms and labels.count(who) == 1), None)
        if lone is None:
            break
        near = [i for i in (lone - 1, lone + 1) if 0 <= i < len(turns)]
        labels[lone] = labels[max(near, key=lambda i: (length[i], -i))]
    return settle([(a, b, who, c) for (a, b, _, c), who in zip(turns, labels, strict=True)])


def fold_turns(windows: DataFrame, gap_ms: float = 400.0, short_ms: float = 1000.0) -> DataFrame:
    """Turns of labelled windows (session_id, s_ms, e_ms, speaker, confidence)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = list(zip(pdf.s_ms, pdf.e_ms, pdf.speaker, pdf.confidence, strict=True))
        out = absorb(settle(rows, gap_ms), short_ms)
        return pd.DataFrame([(pdf.session_id.iloc[0], *x) for x in out], columns=["session_id", "s_ms", "e_ms", "speaker", "confidence"])

    return windows.selectExpr("session_id", "double(s_ms) s_ms", "double(e_ms) e_ms", "speaker", "double(confidence) confidence").groupBy("session_id").applyInPandas(run, TURNS)


def cluster_windows(windows: DataFrame, most: int = 2, seed: int = 0, narrowband: bool = False) -> DataFrame:
    """Windows (session_id, s_ms, e_ms, embedding) with speaker labels in order of first appearance, and the session's confidence."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["s_ms", "e_ms"])
        x = np.array(pdf.embedding.tolist(), np.float64)
        k, conf = count_speakers(x, 1, most, seed, 0.05 if narrowband else 0.10)
        label = k_means(x, k, seed) if k > 1 else np.zeros(len(x), int)
        names = {v: f"SPEAKER_{i:02d}" for i, v in enumerate(dict.fromkeys(label.tolist()))}
        return pd.DataFrame({"session_id": pdf.session_id, "s_ms": pdf.s_ms.astype(float), "e_ms": pdf.e_ms.astype(float), "speaker": [names[v] for v in label], "confidence": conf})

    return windows.select("session_id", "s_ms", "e_ms", "embedding").groupBy("session_id").applyInPandas(run, TURNS)
