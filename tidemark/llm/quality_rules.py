"""Quality rules: counts over the text, then a linear-chain CRF over its lines.

Each line that has a word is labelled content or boilerplate by Viterbi
decoding of a linear-chain conditional random field; a document is kept if its
counts pass and content lines hold at least ``MIN_CONTENT`` of its words.

The CRF is trained on a bounded sample of labelled documents
(``TRAIN_DOCUMENTS`` rows, all lines of each, in batches of sequences of like
length): lines of good documents count as content, lines of bad ones as
boilerplate, and weights are pulled towards ``PRIOR``, which also serves where
there are no labels.  Scoring reads whole texts.

Edge cases: null or empty text has no words and fails the base rules; very
long texts are processed whole; repeated rows are judged alike; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame

from .common import add_columns, keep_rows, labelled_sample, windows

TRAIN_DOCUMENTS = 3000
#: Runs of consecutive lines that a document is sampled by where a caller of ``fit`` bounds its lines.
TRAIN_RUNS = 4
#: Lines, with those that fill up shorter sequences, of one training batch.
BATCH_LINES = 1 << 16
MIN_CONTENT = 0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS, UPPER, DIGITS, SPACE = b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\x0b\x0c\r"
FEATURES = ("bias", "words", "symbols", "bars", "upper", "loud", "digits", "repeats", "seen_before")
#: Score of content minus boilerplate for each feature, before training.
PRIOR = np.array([2.0, 0.2, -12.0, -12.0, -4.0, -12.0, -3.0, -4.0, -3.0])
#: Score of staying in the same label minus changing it, before training.
PRIOR_STAY = 0.5


def count_of(raw: bytes, these: bytes) -> int:
    """How many bytes of ``raw`` are among ``these``."""
    return len(raw) - len(raw.translate(None, these))


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features, words) of every line that has a word."""
    rows, sizes, seen = [], [], set()
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        rows.append((1.0, min(n, 40) / 40, count_of(line, SYMBOLS) / n, line.count(b"|") / n, count_of(line, UPPER) / len(line),
                     (line.count(b"!!") + line.count(b"??")) / n, count_of(line, DIGITS) / len(line),
                     1 - len(set(words)) / n if n > 8 else 0.0, 1.0 if line in seen else 0.0))
        sizes.append(n)
        seen.add(line)
    return np.array(rows, dtype=float).reshape(len(rows), len(FEATURES)), np.array(sizes, dtype=float)


def viterbi(scores: np.ndarray, stay: float) -> np.ndarray:
    """Best labels (True: content) for scores of content against boilerplate, with ``stay`` for each unchanged label."""
    n = len(scores)
    out = np.zeros(n, dtype=bool)
    if not n:
        return out
    bad, good, back = 0.0, float(scores[0]), []
    for s in scores[1:].tolist():
        from_good, to_bad = bad + stay < good, bad + stay
        keep_good, to_good = good + stay >= bad, good + stay
        back.append((from_good, keep_good))
        bad, good = (good if from_good else to_bad), (to_good if keep_good else bad) + s
    now = good >= bad
    for i in range(n - 1, -1, -1):
        out[i] = now
        if i:
            from_good, keep_good = back[i - 1]
            now = keep_good if now else from_good
    return out


def batches(sequences: list[tuple[np.ndarray, int]], lines: int = BATCH_LINES) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(features, labels, which lines there are) of sequences of like length, filled up to the longest of the batch."""
    out, rest = [], sorted(sequences, key=lambda s: len(s[0]))
    while rest:
        longest = len(rest[-1][0])
        group = rest[-max(1, lines // longest):]
        del rest[-len(group):]
        x = np.zeros((len(group), longest, len(FEATURES)))
        for i, (f, _) in enumerate(group):
            x[i, :len(f)] = f
        on = np.arange(longest)[None, :] < np.array([len(f) for f, _ in group])[:, None]
        out.append((x, np.array([float(label) for _, label in group])[:, None], on))
    return out


def expected(x: np.ndarray, y: np.ndarray, on: np.ndarray, w: np.ndarray, stay: float) -> tuple[np.ndarray, float]:
    """Gradient of the likelihood for the weights and for ``stay`` over one batch: forward and backward sums in log space, both labels, all sequences at once."""
    n, longest = on.shape
    s = x @ w
    fb, fg = np.zeros((n, longest)), np.zeros((n, longest))
    bb, bg = np.zeros((n, longest)), np.zeros((n, longest))
    fg[:, 0] = s[:, 0]
    for t in range(1, longest):
        fb[:, t] = np.where(on[:, t], np.logaddexp(fb[:, t - 1] + stay, fg[:, t - 1]), fb[:, t - 1])
        fg[:, t] = np.where(on[:, t], np.logaddexp(fg[:, t - 1] + stay, fb[:, t - 1]) + s[:, t], fg[:, t - 1])
    for t in range(longest - 2, -1, -1):
        nb, ng = bb[:, t + 1], bg[:, t + 1] + s[:, t + 1]
        bb[:, t] = np.where(on[:, t + 1], np.logaddexp(nb + stay, ng), 0)
        bg[:, t] = np.where(on[:, t + 1], np.logaddexp(ng + stay, nb), 0)
    z = np.logaddexp(fb[:, -1], fg[:, -1])[:, None]
    p_good = np.exp(np.clip(fg + bg - z, -50, 0)) * on
    same = np.exp(np.clip(fb[:, :-1] + stay + bb[:, 1:] - z, -50, 0)) + np.exp(np.clip(fg[:, :-1] + stay + s[:, 1:] + bg[:, 1:] - z, -50, 0))
    return ((y * on - p_good)[:, :, None] * x).sum((0, 1)), float(((1 - same) * on[:, 1:]).sum())


def train(sequences: list[tuple[np.ndarray, int]], steps: int = 60, rate: float = 0.5, pull: float = 0.02) -> tuple[np.ndarray, float]:
    """Weights and ``stay`` by gradient ascent on the CRF's likelihood, pulled towards the prior."""
    w, stay = PRIOR.copy(), PRIOR_STAY
    made = batches([s for s in sequences if len(s[0])])
    total = sum(int(on.sum()) for _, _, on in made)
    for _ in range(steps if total else 0):
        grads = [expected(*batch, w, stay) for batch in made]
        w = w + rate * (sum(g for g, _ in grads) / total * 10 - pull * (w - PRIOR))
        stay += rate * (sum(g for _, g in grads) / total - pull * (stay - PRIOR_STAY))
    return w, min(stay, 2.0)


def runs(text: str, n: int, lines: int) -> list[tuple[int, int]]:
    """Runs (start, end) of at most ``lines`` of the ``n`` lines of a text: all, or one at a hashed place in each equal section."""
    if n <= lines:
        return [(0, n)]
    k = min(TRAIN_RUNS, lines)
    size, key = lines // k, text.encode("utf-8", "surrogatepass")
    edges = [n * j // k for j in range(k + 1)]
    starts = [a + zlib.crc32(key, j) % (b - a - size + 1) for j, (a, b) in enumerate(zip(edges, edges[1:]))]
    return [(s, s + size) for s in starts]


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCUMENTS, lines: int | None = None) -> tuple[np.ndarray, float]:
    """Train on at most ``limit`` whole documents; with ``lines``, on as many lines of each, in runs that are sequences of their own.

    Features are made in tasks and come back as packed 64-bit floats.
    """
    def start():
        def run(texts: list[str]) -> dict:
            got = [(t, line_features(t)[0]) for t in texts]
            return {"f": [[f[a:b].tobytes() for a, b in (runs(t, len(f), lines) if lines else [(0, len(f))])] for t, f in got]}
        return run

    got = add_columns(labelled_sample(docs, labels, "quality", limit), ["doc_id", "y"], start, "f array<binary>").collect()
    return train([(np.frombuffer(f).reshape(-1, len(FEATURES)), r["y"]) for r in sorted(got, key=lambda r: r["doc_id"]) for f in r["f"]])


def counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen, dup = set(), 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip(SPACE):
            seen.add(line)
    repeats = 0
    if len(words) > 5:
        found = windows(np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64), 5)
        if len(np.unique(found)) < len(found):
            _, where, n = np.unique(found, return_inverse=True, return_counts=True)
            twice = np.flatnonzero(n[where] > 1)
            covered = np.zeros(len(words) + 1, dtype=np.int64)
            covered[twice] += 1  # places are distinct
            covered[twice + 5] -= 1
            repeats = int((covered.cumsum() > 0).sum())
    return len(words), len(text) - count_of(raw, SPACE), count_of(raw, SYMBOLS), dup, repeats


def verdict(text: str, weights: np.ndarray, stay: float) -> dict:
    """Counts, base verdict, share of words in content lines, and the final verdict of one text."""
    n, chars, symbols, dup, repeats = counts(text)
    failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
    f, sizes = line_features(text)
    share = float(sizes[viterbi(f @ weights, stay)].sum() / sizes.sum()) if len(sizes) else 0.0
    return {"n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeats,
            "base_failed": failed, "kept": not failed and share >= MIN_CONTENT, "content_share": share}


VERDICT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"


def judge(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id with its counts, base_failed, kept and content_share."""
    def start():
        def run(texts: list[str]) -> dict:
            rows = [verdict(t, *model) for t in texts]
            return {k.split()[0]: [r[k.split()[0]] for r in rows] for k in VERDICT.split(", ")}
        return run

    return add_columns(docs, ["doc_id"], start, VERDICT)


def filter_documents(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep."""
    def start():
        return lambda texts: [verdict(t, *model)["kept"] for t in texts]

    return keep_rows(docs, start)
