"""Benchmark decontamination: BM25 with block-max WAND over the test items.

The inverted index holds the test items (not the corpus): postings per term in
item order, cut into blocks of ``BLOCK`` items that carry the largest BM25 impact
in them, as a share of what its item needs.  Items are classed by length, up to
the next power of two; every passage of every training text (windows twice as
long as the class, by half a window) is a query for the items of its class; all
that reach ``SHARE`` of their own self-score are retrieved, then question and
answer overlap is verified.  Block maxima alone decide what is skipped: a block
whose maxima do not add up to what an item needs is never opened, nor is a
passage without an open block; in an open block the pivot moves by the same
maxima, and only postings of items that it stops at are added up.  The index is broadcast
in parts of about ``PART_BYTES`` of item text, so its size per task is bounded
whatever the benchmark's size.  Item count, mean length and document frequencies
are those of the whole benchmark, and sums are rounded once, so an item's scores
do not depend on the items that share its part.

Edge cases: null or empty texts match nothing; an item without words matches
nothing; very long texts are queried whole; a repeated item or document gives
a row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

from .common import add_columns, keep_rows

K1, B = 1.2, 0.5
#: Share of an item's self-score that a passage must reach.
SHARE = 0.5
#: Share of the question's and of the answer's word triples that must occur in the passage.
OVERLAP = 0.5
#: Items of a block of the index.
BLOCK = 4
#: Sum of bounds, in shares of what an item needs, that an item must reach; bounds are plain sums.
REACHED = 1 - 1e-9
#: Passages that are ruled out together, if their words as one query reach no item.
STRETCH = 8
PART_BYTES = 2_000_000
#: Bytes between words: ASCII that is neither a letter nor a digit.
BETWEEN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(BETWEEN).split()


def question_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """An item's words up to its last sentence, and those of the last sentence; a single sentence is cut in half."""
    parts = [w for w in map(words, re.split(r"(?<=[.!?:])\s+|\n", text)) if w]
    if not parts:
        return [], []
    if len(parts) == 1:
        half = (len(parts[0]) + 1) // 2
        return parts[0][:half], parts[0][half:]
    return [w for p in parts[:-1] for w in p], parts[-1]


def grams(ws: list[bytes], n: int = 3) -> set[tuple[bytes, ...]]:
    n = min(n, len(ws))
    return {tuple(ws[i:i + n]) for i in range(len(ws) - n + 1)} if n else set()


def known(ids: np.ndarray) -> np.ndarray:
    """Distinct terms of the index among word ids (-1: none)."""
    ids = np.unique(ids)
    return ids[1:] if len(ids) and ids[0] < 0 else ids


def half_window(length: int) -> int:
    """Length class of an item, which is half its window: the next power of two."""
    return 1 << max(0, length - 1).bit_length()


class Index:
    """Block-max inverted index of test items.

    ``n``, ``mean`` and ``df`` (items, mean length, items of each term) are of the
    whole benchmark, if ``items`` are only a part of it.
    """

    def __init__(self, items: list[tuple[int, str]], n: int | None = None, mean: float | None = None, df: dict[bytes, int] | None = None):
        self.items = [(i, words(t or ""), question_answer(t or "")) for i, t in items]
        lengths = [len(w) for _, w, _ in self.items]
        n = len(self.items) if n is None else n
        mean = max(1.0, sum(lengths) / max(1, len(lengths)) if mean is None else mean)
        order = sorted(range(len(self.items)), key=lambda k: half_window(lengths[k]))  # a block holds items of one class
        self.items, lengths = [self.items[k] for k in order], [lengths[k] for k in order]
        self.halves = np.array([half_window(x) for x in lengths], dtype=np.int64)
        self.half = int(self.halves.max(initial=1))
        found = defaultdict(list)
        for k, (_, ws, _) in enumerate(self.items):
            for t, tf in Counter(ws).items():
                found[t].append((k, tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[k] / mean))))
        self.terms: dict[bytes, int] = {}
        self.postings: list[list[tuple[int, float]]] = []
        own: list[list[float]] = [[] for _ in self.items]
        for t, posting in found.items():
            seen = len(posting) if df is None else df[t]
            idf = math.log(1 + (n - seen + 0.5) / (seen + 0.5))
            posting = [(k, idf * x) for k, x in posting]
            self.terms[t] = len(self.postings)
            self.postings.append(posting)
            for k, x in posting:
                own[k].append(x)
        self.self_score = [math.fsum(x) for x in own]
        self.needed = [SHARE * s if s > 0 else math.inf for s in self.self_score]
        self.block_of, self.block_half = self.cut_blocks()
        self.index_blocks()
        self.parts = [(grams(q), grams(a)) for _, _, (q, a) in self.items]
        self.scored = 0  # postings that retrieve has added up

    def cut_blocks(self) -> tuple[list[int], np.ndarray]:
        """(block of each item, length class of each block): runs of at most ``BLOCK`` items of one class."""
        of, half, held = [], [], 0
        for h in self.halves.tolist():
            if not half or half[-1] != h or held == BLOCK:
                half.append(h)
                held = 0
            held += 1
            of.append(len(half) - 1)
        return of, np.array(half, dtype=np.int64)

    def index_blocks(self) -> None:
        """Per term the blocks that hold it: the largest share of its need that it brings an item there, and where its postings lie."""
        block, top, place, start = [], [], [], [0]
        for posting in self.postings:
            shares = [(k, x / self.needed[k]) for k, x in posting]
            j = 0
            while j < len(shares):
                i, b = j, self.block_of[shares[j][0]]
                while j < len(shares) and self.block_of[shares[j][0]] == b:
                    j += 1
                block.append(b)
                top.append(max(x for _, x in shares[i:j]))
                place.append((i, j))
            start.append(len(block))
        self.entry_block, self.entry_top, self.entry_place = np.array(block, dtype=np.int64), np.array(top), place
        self.start = np.array(start[:-1], dtype=np.int64)
        self.size = np.diff(np.array(start, dtype=np.int64))

    def entries(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entries of the terms, blocks whose sum of maxima reaches what an item needs): postings are not read."""
        n = self.size[terms]
        at = np.repeat(self.start[terms] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        bound = np.bincount(self.entry_block[at], self.entry_top[at], minlength=len(self.block_half))
        return at, np.flatnonzero(bound >= REACHED)

    def reachable(self, terms: np.ndarray) -> np.ndarray:
        """Length classes of the blocks that these distinct terms could reach; bounds every query over a part of them."""
        return self.block_half[self.entries(terms)[1]]

    def retrieve(self, query: list[int], half: int | None = None) -> list[tuple[int, float]]:
        """All items (of class ``half``, if given) whose score for the distinct terms ``query`` reaches what they need (block-max WAND)."""
        terms = np.array(query, dtype=np.int64)
        at, open_blocks = self.entries(terms)
        term, block = np.repeat(terms, self.size[terms]), self.entry_block[at]
        out = []
        for b in open_blocks.tolist():
            if half is None or self.block_half[b] == half:
                here = np.flatnonzero(block == b)
                cursors = [[self.postings[t], *self.entry_place[e], self.entry_top[e]] for t, e in zip(term[here].tolist(), at[here].tolist())]
                out += self.wand(cursors)
        return out

    def wand(self, cursors: list[list]) -> list[tuple[int, float]]:
        """Items of one block that reach their need; ``cursors``: (postings, next, end, largest share) of each term."""
        out = []
        while cursors:
            cursors.sort(key=lambda c: c[0][c[1]][0])
            bound = 0.0
            for pivot, c in enumerate(cursors):
                bound += c[3]
                if bound >= REACHED:
                    break
            else:  # the terms left can bring no item to its need
                break
            item = cursors[pivot][0][cursors[pivot][1]][0]
            goal = item
            if cursors[0][0][cursors[0][1]][0] == item:
                impacts = [c[0][c[1]][1] for c in cursors if c[0][c[1]][0] == item]
                self.scored += len(impacts)
                total = math.fsum(impacts)
                if total >= self.needed[item]:
                    out.append((item, total))
                goal = item + 1
            for c in cursors:
                posting, j, end, _ = c
                if posting[j][0] >= goal:
                    break  # they are in order
                while j < end and posting[j][0] < goal:
                    j += 1
                c[1] = j
            cursors = [c for c in cursors if c[1] < c[2]]
        return out

    def windows(self, ids: np.ndarray) -> Iterator[tuple[int, int, int, list[int]]]:
        """(half, start, end, distinct terms) of the passages that can hold an item of their class, in order within a class.

        The windows of a class lie inside those of the next one (a window of 4h
        words holds its two or three windows of 2h words), so a window without a
        reachable item rules out all smaller ones in it.
        """
        n, half = len(ids), self.half
        tops = range(0, max(1, n - half), half)
        for lo in tops[::STRETCH]:
            if not len(self.reachable(known(ids[lo:lo + (STRETCH + 1) * half]))):
                continue
            todo = [(half, s) for s in tops[lo // half:lo // half + STRETCH]][::-1]
            while todo:
                h, s = todo.pop()
                e = min(s + 2 * h, n)
                terms = known(ids[s:e])
                classes = self.reachable(terms)
                if (classes == h).any():
                    yield h, s, e, terms.tolist()
                if (classes < h).any():
                    small = h // 2
                    last = s + h >= max(1, n - h)  # the last window of its class also holds the window at its middle
                    todo += [(small, x) for x in (s, s + small, s + h)[:3 if last else 2] if x < max(1, n - small)][::-1]

    def matches(self, text: str) -> list[tuple[int, float, float, float]]:
        """(item_id, score, question overlap, answer overlap): the best verified passage for each item."""
        ws = words(text)
        n = len(ws)
        if not n or not self.postings:
            return []
        ids = np.fromiter(map(self.terms.get, ws, repeat(-1)), dtype=np.int64, count=n)
        best = {}
        for half, s, e, query in self.windows(ids):
            seen = None
            for k, score in self.retrieve(query, half):
                if seen is None:
                    seen = {m: grams(ws[s:e], m) for m in (1, 2, 3)}
                shares = []
                for part in self.parts[k]:
                    size = len(next(iter(part))) if part else 3
                    shares.append(len(part & seen[size]) / len(part) if part else 1.0)
                if min(shares) >= OVERLAP and (k not in best or score > best[k][0]):
                    best[k] = (score, *shares)
        return [(self.items[k][0], *v) for k, v in sorted(best.items())]


def indexes(benchmark: DataFrame, part_bytes: int = PART_BYTES) -> list[Index]:
    """All parts of the index at once (a small benchmark)."""
    return list(each_index(benchmark, part_bytes))


def each_index(benchmark: DataFrame, part_bytes: int = PART_BYTES) -> Iterator[Index]:
    """The index in parts of about ``part_bytes`` of item text; each part is collected on its own, with the frequencies of its terms."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // part_bytes) or 1
    items = benchmark.select("item_id", "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).alias("part"))

    def start():
        def run(texts: list[str]) -> dict:
            got = [words(t) for t in texts]
            return {"n": [len(w) for w in got], "term": [sorted(set(w)) for w in got]}
        return run

    counted = materialize(add_columns(items, ["part"], start, "n long, term array<binary>"), "benchmark-terms")
    whole = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("words")).first()
    pairs = counted.select("part", F.explode("term").alias("term")).groupBy("part", "term").agg(F.count(F.lit(1)).alias("df"))
    if parts > 1:
        pairs = materialize(pairs, "benchmark-pairs")
        pairs = materialize(pairs.select("part", "term").join(pairs.groupBy("term").agg(F.sum("df").alias("df")), "term"), "benchmark-frequencies")
    mean = (whole["words"] or 0) / max(1, whole["n"])
    for p in range(parts):
        df = {bytes(r["term"]): r["df"] for r in pairs.where(F.col("part") == p).select("term", "df").collect()}
        yield Index([(r["item_id"], r["text"]) for r in items.where(F.col("part") == p).orderBy("item_id", "text").collect()], whole["n"], mean, df)


def find(docs: DataFrame, index: Index) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): a row for each document and item that it contains."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def start():
        return lambda texts: {"m": [[dict(zip(("item_id", "score", "question_overlap", "answer_overlap"), m)) for m in shared.value.matches(t)] for t in texts]}

    return (add_columns(docs, ["doc_id"], start, "m array<struct<item_id:long,score:double,question_overlap:double,answer_overlap:double>>")
            .where(F.size("m") > 0).select("doc_id", F.explode("m").alias("m")).select("doc_id", "m.*"))


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All verified (document, item) pairs over every part of the index."""
    return reduce(DataFrame.unionByName, [find(docs, x) for x in each_index(benchmark)])


def filter_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no test item."""
    for index in each_index(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        docs = keep_rows(docs, lambda shared=shared: lambda texts: [not shared.value.matches(t) for t in texts])
    return docs
