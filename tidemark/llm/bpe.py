"""Byte-level BPE encoding and decoding.

Encoding has no shuffle: a task splits the texts of a block by the tokenizer's
pattern, keeps each distinct piece once, folds the ranked merges over the bytes
of all distinct pieces together (array operations; one round merges the best
pair of every piece), and puts the ids of each document together.

``fold`` does the same with Spark higher-order functions and a literal rank
map.  It gives equal ids, but costs 60 to 125 microseconds a piece where the
array form costs about 2, which the time limits do not allow on whole tables
(figures in the README); so it serves for columns of single words.

Decoding concatenates the bytes of the ids.

Pieces over ``LONG`` bytes (no word; runs of one character class) would make
the fold quadratic, so a heap merges them with the same ranks and result.

Edge cases: null and empty texts have no ids; very long texts are encoded
whole, in as many pieces as they have; lone surrogates cannot occur in Spark
strings; repeated rows are encoded alike; an unknown id in decoding is an
error; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: More than the largest id, and than the bytes of a folded piece.
IDS = 1 << 20  # fold shifts by 20
NONE = (1 << 62) - 1
LONG = 64
#: Texts of one block, in characters at least; bounds the distinct pieces of a row.
BLOCK_CHARS = 6_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file with a base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def pair_table(ranks: dict[bytes, int]) -> list[int]:
    """A cuckoo table: every pair (left * ``IDS`` + right) whose bytes are a token lies, as pair * ``IDS`` + rank, at one of its two places."""
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left * IDS + right] = rank
    size = 3 * len(pairs) | 1
    while True:
        table = [0] * size
        for key, rank in pairs.items():
            entry, at = key * IDS + rank, key % size
            for _ in range(200):
                entry, table[at] = table[at], entry
                if not entry:
                    break
                key = entry // IDS
                one, two = key % size, (key * 31 + key // IDS * 7) % size
                at = two if at == one else one
            else:
                break
        else:
            return table
        size += 2


def pair_literal(ranks: dict[bytes, int]) -> tuple[Column, int]:
    """The pair table as one literal, and its size."""
    table = pair_table(ranks)
    return F.from_json(F.lit(json.dumps(table)), "array<bigint>"), len(table)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def fold(piece: Column, table: Column, size: int) -> Column:
    """array<int>: ids of one piece, given as the ids of its bytes, by merging the adjacent pair of least rank until none has one."""
    def best(p: Column) -> Column:
        """Rank and place of the pair to merge, as rank * IDS + place; ``NONE`` without one."""
        def pair(x: Column, i: Column) -> Column:
            key = x.cast("long") * IDS + F.get(p, i + 1)
            found = [F.get(table, (k % size).cast("int")) for k in (key, key * 31 + x * 7)]
            return F.coalesce(*[F.when(F.shiftright(e, 20) == key, e % IDS * IDS + i) for e in found], F.lit(NONE))
        return F.array_min(F.transform(p, pair))

    def step(p: Column, _: Column) -> Column:
        def merge(b: Column) -> Column:
            at, rank = (b % IDS).cast("int"), F.shiftright(b, 20).cast("int")
            return F.when(b == NONE, p).otherwise(F.concat(F.slice(p, F.lit(1), at), F.array(rank), F.slice(p, at + 3, F.size(p))))
        return F.when(F.size(p) < 2, p).otherwise(_let(best(p), merge))

    return F.when(F.size(piece) < 2, piece).otherwise(F.aggregate(F.sequence(F.lit(2), F.size(piece)), piece, step))


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a long piece, with a heap over a linked list: n log n."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or end[j] != stop or end[i] != j:
            continue
        end[i], alive[j], after[i] = stop, False, after[j]
        if after[j] < n:
            before[after[j]] = i
            if (r := ranks.get(piece[i:end[after[j]]])) is not None:
                heapq.heappush(heap, (r, i, end[after[j]]))
        if before[i] >= 0 and (r := ranks.get(piece[before[i]:stop])) is not None:
            heapq.heappush(heap, (r, before[i], stop))
    return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]


class Merges:
    """Folds the ranked merges over many distinct pieces at once: one round merges the best pair of every piece."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        pairs = sorted((left * IDS + right, rank) for token, rank in ranks.items() for cut in range(1, len(token))
                       if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None)
        self.keys = np.array([k for k, _ in pairs] + [NONE], dtype=np.int64)
        self.found = np.array([r for _, r in pairs] + [0], dtype=np.int64)
        self.bytes = np.array([ranks.get(bytes([i]), -1) for i in range(256)], dtype=np.int64)

    def best(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * IDS + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.found[at], IDS)

    def fold(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and the number of each piece's ids."""
        out: list = [None] * len(pieces)
        todo = []
        for i, w in enumerate(pieces):
            if (r := self.ranks.get(w)) is not None:
                out[i] = (r,)
            elif not w or len(w) > LONG:
                out[i] = merge_long(w, self.ranks) if w else ()
            else:
                todo.append(i)
        where, sizes = np.array(todo, dtype=np.int64), np.array([len(pieces[i]) for i in todo], dtype=np.int64)
        ids = self.bytes[np.frombuffer(b"".join([pieces[i] for i in todo]), dtype=np.uint8)]
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(ids):
            rank = np.append(self.best(ids[:-1], ids[1:]), IDS)
            rank[np.cumsum(sizes) - 1] = IDS  # the last id of a piece has no pair
        while len(where):
            starts = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(rank * (1 << 32) + np.arange(len(rank)), starts)
            over = least >= IDS << 32
            if over.any():
                gone = np.repeat(over, sizes)
                done.append((where[over], sizes[over], ids[gone]))
                if over.all():
                    break
                ids, rank, where, sizes, least = ids[~gone], rank[~gone], where[~over], sizes[~over], least[~over]
                least = (least >> 32 << 32) + (least & 0xFFFFFFFF) - np.cumsum(gone)[least & 0xFFFFFFFF]
            at = least & 0xFFFFFFFF
            ids[at] = least >> 32
            rank[at] = rank[at + 1]
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # places after the removals before
            ids, rank, sizes = ids[keep], rank[keep], sizes - 1
            ends = np.cumsum(sizes)
            again = np.concatenate([at, at - 1])
            starts = ends - sizes
            again = again[np.concatenate([at < ends - 1, at > starts])]
            rank[again] = self.best(ids[again], ids[again + 1])
        count = np.array([0 if x is None else len(x) for x in out], dtype=np.int64)
        for w, n, _ in done:
            count[w] = n
        start = np.cumsum(count) - count
        flat = np.empty(int(count.sum()), dtype=np.int32)
        for i, x in enumerate(out):
            if x is not None:
                flat[start[i]:start[i] + len(x)] = x
        for w, n, x in done:
            flat[np.repeat(start[w] - (np.cumsum(n) - n), n) + np.arange(len(x))] = x
        return flat, count


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, merges = regex.compile(pattern).findall, Merges(shared.value)

        def block(doc_ids: list[pa.Array], texts: list[str]) -> Iterator[pa.RecordBatch]:
            known: dict[str, int] = {}
            at = [np.fromiter([known.setdefault(w, len(known)) for w in split(t)], dtype=np.int64) for t in texts]
            flat, sizes = merges.fold([w.encode("utf-8") for w in known])
            starts = np.cumsum(sizes) - sizes
            doc_ids = pa.concat_arrays(doc_ids)
            for lo in range(0, len(at), 512):  # parts, so that what leaves at once stays small
                part = at[lo:lo + 512]
                pieces = np.concatenate(part)
                n = sizes[pieces]
                ids = flat[np.repeat(starts[pieces] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
                ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum([len(x) for x in part])])]
                yield pa.RecordBatch.from_arrays([doc_ids[lo:lo + 512], pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(ids))], names=["doc_id", "ids"])

        doc_ids, texts, size = [], [], 0
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                doc_ids.append(b.column("doc_id")[lo:lo + 64])
                got = [t or "" for t in b.column("text")[lo:lo + 64].to_pylist()]
                texts += got
                size += sum(map(len, got)) + 100 * len(got)
                if size >= BLOCK_CHARS:
                    yield from block(doc_ids, texts)
                    doc_ids, texts, size = [], [], 0
        if texts:
            yield from block(doc_ids, texts)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of its ids, concatenated."""
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    shared = encoded.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.__getitem__
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), pa.array([b"".join(map(get, x.as_py())) for x in b.column("ids")], type=pa.binary())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
