"""BPE encoding with reuse of content-defined chunks, and decoding.

A rolling hash cuts texts into chunks wherever its upper bits are zero, so equal
passages have equal chunks wherever they stand.  Chunks that occur at least
twice in the corpus are encoded once each, after a shuffle of their texts by
128-bit hash, and their ids go to the documents that hold them.  The rest of
the texts is encoded where it lies, and documents without a shared chunk never
move.

Joins are repaired: a chunk's ids hold for its document from the first place
where the document's own pieces, encoded again from before the join on, begin
at one of the chunk's piece starts.  From there both agree up to the last
pieces of the chunk, which may depend on what follows, and the next join begins.
So ids equal those of the whole text.

Which chunks are shared is known in a pass over the texts through a bit table of
fixed size (``FILTER_BITS``) made from the counts.  It never misses one; a
collision only makes a chunk of one document take the longer way.

Strings of special tokens in a text are their ids, and pieces do not reach over
them.  Ids are packed as little-endian unsigned 32-bit integers.

Edge cases: null and empty texts have no ids; very long texts are encoded whole;
repeated rows and rows with one id are encoded alike, each for itself; an unknown
id in decoding is an error; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

from .common import parts

#: Bytes that the rolling hash sees, bytes of a chunk at least, and bits that are zero at a cut (chunks of about 2 ** ZERO bytes).
WINDOW, LEAST, ZERO = 16, 64, 9
#: Bits of the table of shared chunks: 8 MB.
FILTER_BITS = 1 << 26
#: Bytes of text that a task encodes together.
BLOCK = 6_000_000
#: Pieces that a task remembers.
PIECES = 300_000
#: Longer pieces (no words) are merged by a heap.
LONG = 64
#: Marks the first id of a piece among a chunk's ids.
FIRST = 1 << 31
NONE = (1 << 62) - 1
#: Characters after a piece that may decide where it ends.
AHEAD = 2
#: Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tokenizer:
    """Vocabulary, ranked merges and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from 256 on
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        vocab = spec["model"]["vocab"]
        of = lambda token: bytes(byte[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens = {i: of(t) for t, i in vocab.items() if t not in self.special} | {i: t.encode() for t, i in self.special.items()}
        self.bytes = {byte[t]: i for t, i in vocab.items() if len(t) == 1}
        #: (left id, right id) to (rank, id)
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(spec["model"]["merges"])}

    def special_pattern(self) -> regex.Pattern | None:
        """Finds special tokens in UTF-8, the longest of those that begin at one place."""
        names = sorted((s.encode() for s in self.special), key=len, reverse=True)
        return regex.compile(b"(" + b"|".join(map(regex.escape, names)) + b")") if names else None


class Encoder:
    """Encodes pieces, remembering those seen before; texts become lists of piece numbers and ready ids."""

    def __init__(self, t: Tokenizer):
        self.t, self.width = t, max(t.tokens) + 1
        self.split = regex.compile(PATTERN)
        pairs = sorted((a * self.width + b, rank, i) for (a, b), (rank, i) in t.merges.items())
        self.keys = np.array([p[0] for p in pairs] + [NONE], dtype=np.int64)
        self.rank = np.array([p[1] for p in pairs] + [NONE], dtype=np.int64)
        self.made = np.zeros(len(t.merges), dtype=np.int64)
        for rank, i in t.merges.values():
            self.made[rank] = i
        self.first = np.array([t.bytes.get(b, -1) for b in range(256)], dtype=np.int64)
        self.length = np.zeros(self.width, dtype=np.int64)
        for i, token in t.tokens.items():
            self.length[i] = len(token)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.size, self.start = np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def number(self, pieces: list[str]) -> np.ndarray:
        """Numbers of pieces; new ones are encoded by ``learn``."""
        known = self.known
        return np.fromiter([known.setdefault(w, len(known)) for w in pieces], dtype=np.int64, count=len(pieces))

    def learn(self) -> None:
        """Encode the pieces numbered since the last time."""
        new = [w.encode() for w in list(self.known)[len(self.size):]]
        flat, size = self.fold(new)
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.flat, self.size = np.concatenate([self.flat, flat]), np.concatenate([self.size, size])

    def ids(self, numbers: np.ndarray, mark: bool = False) -> np.ndarray:
        """Ids of numbered pieces; ``mark`` sets ``FIRST`` on the first of each."""
        n = self.size[numbers]
        begin = np.cumsum(n) - n
        out = self.flat[np.repeat(self.start[numbers] - begin, n) + np.arange(int(n.sum()))]
        if mark:
            out[begin] |= np.uint32(FIRST)
        return out

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.rank[at], NONE)

    def fold(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row and their counts: in each round every piece merges all places of its pair of least rank."""
        count = np.zeros(len(pieces), dtype=np.int64)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for i, w in enumerate(pieces):
            if len(w) > LONG:
                ids = np.array(self.merge_long(w), dtype=np.int64)
                done.append((np.array([i]), np.array([len(ids)]), ids))
        who = np.array([i for i, w in enumerate(pieces) if len(w) <= LONG], dtype=np.int64)
        size = np.array([len(pieces[i]) for i in who], dtype=np.int64)
        ids = self.first[np.frombuffer(b"".join([pieces[i] for i in who]), dtype=np.uint8)]
        rank = np.append(self.ranks(ids[:-1], ids[1:]), NONE)[:len(ids)]
        rank[np.cumsum(size) - 1] = NONE  # the last id of a piece has no pair
        while len(who):
            least = np.minimum.reduceat(rank, np.cumsum(size) - size)
            over = least == NONE
            if over.any():
                gone = np.repeat(over, size)
                done.append((who[over], size[over], ids[gone]))
                who, size, least, ids, rank = who[~over], size[~over], least[~over], ids[~gone], rank[~gone]
                if not len(who):
                    break
            hit = rank == np.repeat(least, size)
            at = np.flatnonzero(hit)
            new_run = np.append(True, np.diff(at) > 1)  # of places side by side, every other one merges
            at = at[(np.arange(len(at)) - np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))) % 2 == 0]
            ids[at] = self.made[rank[at]]
            rank[at] = rank[at + 1]
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            size = size - np.bincount(np.searchsorted(np.cumsum(size), at, side="right"), minlength=len(size))
            at = at - np.arange(len(at))
            ids, rank = ids[keep], rank[keep]
            ends = np.zeros(len(ids), dtype=bool)
            ends[np.cumsum(size) - 1] = True
            again = np.concatenate([at, at[at > 0] - 1])
            again = again[~ends[again]]
            rank[again] = self.ranks(ids[again], ids[again + 1])
            rank[at[ends[at]]] = NONE
        for w, n, _ in done:
            count[w] = n
        begin = np.cumsum(count) - count
        flat = np.empty(int(count.sum()), dtype=np.uint32)
        for w, n, x in done:
            flat[np.repeat(begin[w] - (np.cumsum(n) - n), n) + np.arange(len(x))] = x
        return flat, count

    def merge_long(self, piece: bytes) -> list[int]:
        """The same merges with a heap of pairs over a linked list."""
        ids = [int(self.first[b]) for b in piece]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(ids) and (m := self.t.merges.get((ids[i], ids[after[i]]))):
                heapq.heappush(heap, (m[0], i, ids[i], ids[after[i]]))

        for i in range(len(ids)):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:
                continue
            ids[i], ids[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [i for i in ids if i >= 0]

    def repaired(self, text: str, chunks: list[tuple[int, int, np.ndarray]]) -> list[np.ndarray]:
        """Piece numbers (int64) and ready ids (uint32) of a text, of whose ``chunks`` (bytes from, to) marked ids are known."""
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        place = np.append(0, np.cumsum((raw & 0xC0) != 0x80))  # characters before a byte
        out: list[np.ndarray] = []
        at = 0
        for lo, hi, packed in chunks:
            ids = packed & np.uint32(FIRST - 1)
            token = np.flatnonzero(packed >> np.uint32(31))
            ends = np.cumsum(self.length[ids])
            begin = place[lo + (ends - self.length[ids])[token]]
            stop = np.append(begin[1:], place[hi])
            sure = len(begin) if hi == len(raw) else int(np.searchsorted(stop, place[hi] - AHEAD, side="right"))
            if sure == 0 or at > begin[sure - 1]:
                continue
            new: list[str] = []
            if begin[0] - at > 200:  # what lies before the chunk, without the pieces that may reach into it
                new = self.split.findall(text, at, int(begin[0]))
                at += sum(map(len, new))
                while new and at + AHEAD > begin[0]:
                    at -= len(new.pop())
            last = int(begin[sure - 1])
            starts = {int(x): k for k, x in enumerate(begin[:sure])}
            while at not in starts and at <= last:
                new.append(self.split.match(text, at)[0])
                at += len(new[-1])
            out.append(self.number(new))
            if at in starts:
                k = starts[at]
                out.append(ids[token[k]:token[sure] if sure < len(token) else len(ids)])
                at = int(stop[sure - 1])
        out.append(self.number(self.split.findall(text, at)))
        return out


def cuts(data: np.ndarray, offsets: np.ndarray, special: regex.Pattern | None) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the chunks of texts that lie one after the other in ``data``, and which chunks are special tokens.

    The hash of the last ``WINDOW`` bytes decides, and a chunk has ``LEAST``
    bytes, so a cut depends on its own text alone.
    """
    factor = 0x9E3779B1
    hashes = ((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)).astype(np.uint32)[data]
    reach = 1
    while reach < WINDOW and reach < len(hashes):
        older = hashes[:-reach] * np.uint32(pow(factor, reach, 1 << 32))
        hashes[reach:] += older
        reach *= 2
    found = np.flatnonzero(hashes >> np.uint32(32 - ZERO) == 0) + 1
    found = found[found < len(data)]
    found = found[(data[found] & 0xC0) != 0x80]
    forced, marks = set(offsets.tolist()), set()
    raw = data.tobytes() if special else b""
    if special and special.search(raw):
        for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            for m in special.finditer(raw[lo:hi]):
                forced |= {lo + m.start(), lo + m.end()}
                marks.add(lo + m.start())
    hard = np.array(sorted(forced), dtype=np.int64)
    base = hard[np.searchsorted(hard, found, side="right") - 1]
    bounds, last, low = [], -1, -1
    for x, b in zip(found[found - base >= LEAST].tolist(), base[found - base >= LEAST].tolist()):
        if b != low:
            low = last = b
        if x - last >= LEAST:
            bounds.append(x)
            last = x
    bounds = np.unique(np.concatenate([hard, np.array(bounds, dtype=np.int64)]))
    return bounds, np.isin(bounds[:-1], np.array(sorted(marks), dtype=np.int64))


class Batch:
    """The texts of an Arrow batch (binary column ``_text``) and their chunks."""

    def __init__(self, b: pa.RecordBatch, special: regex.Pattern | None, table: np.ndarray | None = None):
        column = b.column("_text")
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        body = column.buffers()[2]
        data = np.frombuffer(body, dtype=np.uint8)[offsets[0]:offsets[-1]] if body is not None and offsets[-1] > offsets[0] else np.empty(0, dtype=np.uint8)
        self.offsets = offsets - offsets[0]
        self.raw = data.tobytes()
        self.bounds, self.is_special = cuts(data, self.offsets, special)
        self.hash = [b"" if s else xxhash.xxh3_128_digest(self.raw[lo:hi]) for lo, hi, s in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), self.is_special.tolist())]
        self.short = np.frombuffer(b"".join(h[:8] or bytes(8) for h in self.hash), dtype=np.int64)
        self.row = np.searchsorted(self.offsets, self.bounds[:-1], side="right") - 1
        if table is not None:
            slot = self.short & (FILTER_BITS - 1)
            self.shared = ((table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).astype(bool) & ~self.is_special
            self.linked = np.zeros(b.num_rows, dtype=bool)
            self.linked[self.row[self.shared]] = True

    def text(self, i: int) -> bytes:
        return self.raw[self.offsets[i]:self.offsets[i + 1]]

    def chunk(self, k: int) -> bytes:
        return self.raw[self.bounds[k]:self.bounds[k + 1]]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("_text"))


def shared_table(docs: DataFrame, special: regex.Pattern | None) -> bytes:
    """The bits of the chunks that occur at least twice; ``FILTER_BITS`` / 8 bytes whatever the corpus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches, 512):
            x = Batch(b, special)
            yield pa.RecordBatch.from_arrays([pa.array(x.short[~x.is_special])], names=["h"])

    twice = _texts(docs).mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    slot = F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1))
    rows = twice.groupBy(F.shiftright(slot, 15).alias("at")).agg(F.bitmap_construct_agg(slot.bitwiseAND(F.lit(32767))).alias("bits")).collect()
    table = bytearray(FILTER_BITS // 8)
    for r in rows:
        table[r["at"] * 4096:r["at"] * 4096 + 4096] = r["bits"]
    return bytes(table)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids binary) of every row: packed ids of its whole text."""
    spark = docs.sparkSession
    tokenizer = Tokenizer(path)
    special = tokenizer.special_pattern()
    shared = spark.sparkContext.broadcast(tokenizer)
    table = spark.sparkContext.broadcast(shared_table(docs, special))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks that may be shared, with the text's hash; the chunk's text where the task meets it first."""
        bits, seen = np.frombuffer(table.value, dtype=np.uint8), set()
        for b in parts(batches, 512):
            x = Batch(b, special, bits)
            at = np.flatnonzero(x.shared).tolist()
            if len(seen) > 200_000:
                seen.clear()
            doc = {i: xxhash.xxh3_64_intdigest(x.text(i)) - (1 << 63) for i in np.flatnonzero(x.linked).tolist()}
            texts = [None if (h := x.hash[k]) in seen or seen.add(h) else x.chunk(k) for k in at]
            yield pa.RecordBatch.from_arrays([pa.array([doc[i] for i in x.row[at].tolist()], type=pa.int64()), pa.array([x.hash[k] for k in at], type=pa.binary()), pa.array(texts, type=pa.binary())], names=["doc", "h", "text"])

    def chunk_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for b in parts(batches, 4096):
            if len(encoder.known) > PIECES:
                encoder.forget()
            numbers = [encoder.number(encoder.split.findall(t.decode())) for t in b.column("text").to_pylist()]
            encoder.learn()
            yield pa.RecordBatch.from_arrays([b.column("h"), pa.array([encoder.ids(x, mark=True).astype("<u4").tobytes() for x in numbers], type=pa.binary())], names=["h", "packed"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(table.value, dtype=np.uint8)
        for b in parts(batches, 512):
            x = Batch(b, special, bits)
            rows = np.flatnonzero(x.linked)
            doc = pa.array([xxhash.xxh3_64_intdigest(x.text(i)) - (1 << 63) for i in rows.tolist()], type=pa.int64())
            kept = b.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([kept.column("doc_id"), kept.column("_text"), doc], names=["doc_id", "_text", "doc"])

    def encoded(batches: Iterator[pa.RecordBatch], moved: bool) -> Iterator[pa.RecordBatch]:
        """Ids of texts: those that stayed (without shared chunks), or those that moved to the ids of their chunks."""
        encoder, bits = Encoder(shared.value), np.frombuffer(table.value, dtype=np.uint8)
        ids, docs_parts, size = [], [], 0

        def segments(text: bytes) -> list:
            found: list = []
            for k, s in enumerate(special.split(text) if special else [text]):
                if k % 2:
                    found.append(np.array([tokenizer.special[s.decode()]], dtype=np.uint32))
                elif s:
                    found.append(encoder.number(encoder.split.findall(s.decode())))
            return found

        def with_chunks(x: Batch, i: int, known: dict) -> list:
            found: list = []
            lo = hi = 0
            inside: list = []
            first, last = np.searchsorted(x.row, [i, i + 1])
            for k in range(first, last):
                a, b = int(x.bounds[k]), int(x.bounds[k + 1])
                if k == first or x.is_special[k - 1]:
                    lo, inside = a, []
                if x.is_special[k]:
                    found += encoder.repaired(x.raw[lo:a].decode(), inside) if a > lo else []
                    found.append(np.array([tokenizer.special[x.raw[a:b].decode()]], dtype=np.uint32))
                elif (packed := known.get(x.hash[k])) is not None:
                    inside.append((a - lo, b - lo, np.frombuffer(packed, dtype="<u4")))
                hi = b
            if last > first and not x.is_special[last - 1]:
                found += encoder.repaired(x.raw[lo:hi].decode(), inside)
            return found

        def flush() -> pa.RecordBatch:
            encoder.learn()
            packed = [b"".join([(encoder.ids(p) if p.dtype == np.int64 else p).astype("<u4").tobytes() for p in d]) for d in docs_parts]
            return pa.RecordBatch.from_arrays([pa.array(ids, type=pa.int64()), pa.array(packed, type=pa.binary())], names=["doc_id", "ids"])

        for b in parts(batches, 512):
            x = Batch(b, special, bits)
            known = b.column("known").to_pylist() if moved else None
            for i, doc_id in enumerate(b.column("doc_id").to_pylist()):
                if moved:
                    docs_parts.append(with_chunks(x, i, {c["h"]: c["packed"] for c in known[i] or []}))
                elif x.linked[i]:
                    continue
                else:
                    docs_parts.append(segments(x.text(i)))
                ids.append(doc_id)
                size += int(x.offsets[i + 1] - x.offsets[i]) + 100
                if size >= BLOCK:
                    yield flush()
                    ids, docs_parts, size = [], [], 0
                    if len(encoder.known) > PIECES:
                        encoder.forget()
        if ids:
            yield flush()

    texts = _texts(docs)
    found = materialize(texts.mapInArrow(links, "doc long, h binary, text binary"), "chunk-links")
    once = found.where("text is not null").groupBy("h").agg(F.first("text").alias("text")).mapInArrow(chunk_ids, "h binary, packed binary")
    known = (found.select("doc", "h").distinct().join(once, "h").groupBy("doc").agg(F.collect_list(F.struct("h", "packed")).alias("known")))
    moved = texts.mapInArrow(linked, "doc_id long, _text binary, doc long").join(known, "doc", "left").select("doc_id", "_text", "known")
    schema = "doc_id long, ids binary"
    return (texts.mapInArrow(lambda batches: encoded(batches, False), schema)
            .unionByName(moved.mapInArrow(lambda batches: encoded(batches, True), schema)))


def decode(packed: DataFrame, path: str) -> DataFrame:
    """``packed`` (doc_id, ids) with ``decoded``: the text of the ids, special tokens included."""
    tokens = Tokenizer(path).tokens
    table = packed.sparkSession.sparkContext.broadcast([tokens.get(i) for i in range(max(tokens, default=-1) + 1)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = table.value.__getitem__
        for b in parts(batches, 512):
            texts = [b"".join(map(get, np.frombuffer(x, dtype="<u4").tolist())).decode("utf-8", "replace") for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), pa.array(texts, type=pa.string())], names=["doc_id", "ids", "decoded"])

    return packed.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded string")
