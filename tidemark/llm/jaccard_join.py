"""Exact n-gram Jaccard self-join by universe partition with cost-based allocation.

A document's set is its distinct word n-grams, as 64-bit hashes.  Sets fall
into size bands so that a linked pair lies in one band or two adjacent ones;
each band bounds the symmetric difference of a linked pair by k.  Tokens are
hashed into about 1.25 k segments.  A segment may be skipped (it counts 0),
indexed by the hash of its subset (1: the pair may not differ there) or by its
one-deletion neighbourhood (2: the pair may differ there by one token); if the
counts of a set's segments exceed k, every set linked with it meets it at
one of them.

Every set indexes the subsets of its filled segments.  The set of the smaller
band of a pair then looks the other one up, and allocates by cost: how many sets
share a key is counted over all sets first, and of its filled segments it
takes the k + 1 whose lists are shortest.  Empty segments, whose list would hold a
share of the corpus, are never among them.  Bands with k = 1 have one segment
with its one-deletion neighbourhood.  A set with fewer than k + 1 filled segments
(rare and small) gives the one-deletion neighbourhood to its largest segments,
and the sets it may meet there index theirs on demand.

The counts reach the sets as bit tables of fixed size (``LEVELS`` of
``TABLE_BITS``): a key is in a level's table if its list is longer than the level.
A collision makes a list look longer, which costs work and loses nothing.

Equal sets are one class from the start.  Candidates are verified exactly:
first every member of an index list against the list's hub; then, in lists
that still hold several components, members outside the hub's component
against all others, in blocks of ``BLOCK`` by ``BLOCK``, so no list is ever held by one task
and of those pairs only the ones whose parity sketches are close enough for
linked sets become rows, to be verified by their token sets, which are made
from the texts again for those sets alone.

Result rows: one a document, with the size of its set, its class and its
component; pairs are not expanded.

Edge cases: null, empty and blank texts have the empty set, linked with
nothing; a text with fewer words than n has its whole sequence as one token;
very long texts are used whole; repeated rows are linked; rows without an id
are linked like others, and their ids are null where no row of the class or
component has one; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

from .common import WordHashes, add_columns, mix, parts, windows, words_of

BLOCK = 256
#: Bits of the sketch that rules pairs out before their token sets are fetched.
SKETCH = 1024
#: Rows of two longs that are broadcast at most, about 16 MB.
BROADCAST_ROWS = 500_000
#: Index lists over this size are compared in blocks.
LARGE_LIST = 32
#: Further hubs tried in large lists.
HUBS = 2
#: List sizes that the allocation tells apart, and the bits of each size's table (8 MB).
LEVELS, TABLE_BITS = (1, 8, 64), 1 << 26
#: Bits of an index key; equal keys of unlike subsets cost a comparison.
KEY_BITS = 48


class Bands:
    """Size bands of a threshold ``num / den`` and the greatest symmetric difference of a linked pair in each."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.high = num, den, [1 * den // num]

    def of(self, size: int) -> int:
        while self.high[-1] < size:
            low = self.high[-1] + 1
            self.high.append(max(low, low * self.den // self.num))
        return int(np.searchsorted(self.high, size))

    def distance(self, band: int) -> int:
        """For pairs with the smaller set in ``band`` (the larger one may be in the next)."""
        top = self.high[band]
        return (self.den - self.num) * (top + top * self.den // self.num) // (self.den + self.num)


def token_set(text: str, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams."""
    return np.unique(windows(hashes.of(words_of(text)), n))


def segments_of(distance: int) -> int:
    """Segments of a band whose linked pairs differ by ``distance`` tokens at most."""
    return 1 if distance == 1 else distance + distance // 4 + 9


class Segments:
    """A set's tokens dealt to the segments of one band group."""

    def __init__(self, tokens: np.ndarray, group: int, distance: int):
        self.m = segments_of(distance)
        self.mark = np.uint64((group * 2 + 1) * 0x5851F42D4C957F2D % (1 << 64))
        self.segment, self.value = (mix(tokens, 7) % np.uint64(self.m)).astype(np.int64), mix(tokens, 11)
        order = np.argsort(self.segment, kind="stable")
        self.filled, first = np.unique(self.segment[order], return_index=True)
        with np.errstate(over="ignore"):
            self.sums = np.add.reduceat(self.value[order], first)
        self.counts = np.diff(np.append(first, len(tokens)))

    def key(self, segment: np.ndarray, total: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(total ^ mix(segment.astype(np.uint64) + self.mark, 3), 5) >> np.uint64(64 - KEY_BITS)).view(np.int64)

    def subsets(self) -> np.ndarray:
        """Keys of the filled segments."""
        return self.key(self.filled, self.sums)

    def deletions(self, chosen: np.ndarray | None = None) -> np.ndarray:
        """Keys of segments less one token, of all segments or the chosen ones."""
        total = np.zeros(self.m, dtype=np.uint64)
        total[self.filled] = self.sums
        near = slice(None) if chosen is None else np.isin(self.segment, chosen)
        at, value = self.segment[near], self.value[near]
        with np.errstate(over="ignore"):
            return self.key(at, total[at] - value)

    def all_subsets(self) -> np.ndarray:
        """Keys of all segments, empty ones too."""
        total = np.zeros(self.m, dtype=np.uint64)
        total[self.filled] = self.sums
        return self.key(np.arange(self.m), total)

    def neighbourhoods(self, distance: int) -> np.ndarray:
        """Keys of the largest segments with their one-deletions, as many as count more than ``distance``."""
        sizes = np.zeros(self.m, dtype=np.int64)
        sizes[self.filled] = self.counts
        chosen = np.argsort(-sizes, kind="stable")[:distance // 2 + 1]
        return np.concatenate([self.all_subsets()[chosen], self.deletions(chosen)])


def groups_of(tokens: np.ndarray, bands: Bands) -> list[tuple[int, bool]]:
    """The band groups that a set is indexed in, and whether it looks others up there: its own band and the one below."""
    band = bands.of(len(tokens))
    return [(g, g == band) for g in (band, band - 1) if g >= 0 and bands.distance(g) > 0]


def signatures(tokens: np.ndarray, bands: Bands) -> tuple[np.ndarray, int, np.ndarray, np.ndarray]:
    """(own, need, below, short): keys in the own band, of which it looks up ``need`` (the first one where need is 1),
    keys in the band below, and the neighbourhood keys of a set that has too few filled segments."""
    own = below = short = np.empty(0, dtype=np.int64)
    need = 0
    for group, mine in groups_of(tokens, bands):
        distance = bands.distance(group)
        s = Segments(tokens, group, distance)
        keys = np.concatenate([s.subsets(), s.deletions()]) if distance == 1 else s.subsets()
        if not mine:
            below = keys
            continue
        own, need = keys, 1 if distance == 1 else distance + 1
        if len(keys) < need:
            short = s.neighbourhoods(distance)
    return own, need, below, short


def wanted_keys(tokens: np.ndarray, bands: Bands, table: np.ndarray) -> np.ndarray:
    """The keys of a set, one-deletions and empty segments included, that are in a bit table."""
    keys = [np.concatenate([s.all_subsets(), s.deletions()]) for g, _ in groups_of(tokens, bands) for s in [Segments(tokens, g, bands.distance(g))]]
    keys = np.unique(np.concatenate(keys)) if keys else np.empty(0, dtype=np.int64)
    return keys[in_table(keys, table)]


def in_table(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    slot = keys & (TABLE_BITS - 1)
    return ((table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).astype(bool)


def bit_tables(keys: DataFrame) -> dict[int, bytes]:
    """Bit tables by level of (level, key); each has ``TABLE_BITS`` / 8 bytes whatever the number of keys."""
    slot = F.col("key").bitwiseAND(F.lit(TABLE_BITS - 1))
    rows = keys.groupBy("level", F.shiftright(slot, 15).alias("at")).agg(F.bitmap_construct_agg(slot.bitwiseAND(F.lit(32767))).alias("bits")).collect()
    tables: dict[int, bytearray] = {}
    for r in rows:
        tables.setdefault(r["level"], bytearray(TABLE_BITS // 8))[r["at"] * 4096:r["at"] * 4096 + 4096] = r["bits"]
    return {level: bytes(t) for level, t in tables.items()}


def odd_sketch(tokens: np.ndarray) -> np.ndarray:
    """``SKETCH`` bits, each the parity of the tokens hashed to it: two sketches differ in no more bits than the sets differ in tokens."""
    bits = np.bincount((mix(tokens, 31) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def set_id(tokens: np.ndarray) -> int | None:
    """64-bit hash of a set; None for the empty set."""
    if not len(tokens):
        return None
    with np.errstate(over="ignore"):
        return int(mix(mix(tokens, 21).sum(keepdims=True) + np.uint64(len(tokens)), 23).view(np.int64)[0])


def sets(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, sid, sketch, own, need, below, short, n_keys): set size, set hash (null for the empty set), parity sketch, ``signatures`` and their number.

    A task gives the signatures of a set once (in bounded memory: it may forget).
    """
    none = np.empty(0, dtype=np.int64)

    def start():
        hashes, bands, seen = WordHashes(), Bands(num, den), set()

        def keys(tokens: np.ndarray, sid: int | None) -> tuple:
            if sid is None or sid in seen:
                return none, 0, none, none
            if len(seen) >= 200_000:
                seen.clear()
            seen.add(sid)
            return signatures(tokens, bands)

        def run(texts: list[str]) -> dict:
            got = [token_set(t, n, hashes) for t in texts]
            ids = [set_id(s) for s in got]
            own, need, below, short = zip(*[keys(s, i) for s, i in zip(got, ids)]) if got else ((), (), (), ())
            return {"n_shingles": [len(s) for s in got], "sid": ids, "sketch": [odd_sketch(s) for s in got], "own": own, "need": need, "below": below, "short": short,
                    "n_keys": [len(x) + len(y) for x, y in zip(own, below)]}
        return run

    docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return add_columns(docs, ["doc_id", "text_hash"], start, "n_shingles long, sid long, sketch array<long>, own array<long>, need int, below array<long>, short array<long>, n_keys int")


def index_lists(got: DataFrame, docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(key, sid): the index lists that at least two sets share and one of them looks up."""
    spark = docs.sparkSession
    # one row a set, the least that has its keys: the others are told by id and text, and few enough to be broadcast or shuffled without their keys
    holders = got.where("n_keys > 0").select("sid", "doc_id", "text_hash")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))).alias("least")
    first = holders.groupBy("sid").agg(F.count(F.lit(1)).alias("n"), least).where("n > 1").select(F.col("sid").alias("_s"), F.col("least.id").alias("_id"), F.col("least.hash").alias("_hash"))
    others = holders.join(first, F.col("sid") == F.col("_s")).where(~(F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))))
    others = materialize(others.select(F.col("doc_id").alias("_i"), F.col("text_hash").alias("_h")).distinct(), "join-again")
    keyed = got.where("n_keys > 0").join(small(others), F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("text_hash") == F.col("_h")), "left_anti")
    every = keyed.select(F.explode(F.concat("own", "below")).alias("key"))
    counted = every.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    levels = F.filter(F.array(*[F.lit(x) for x in LEVELS]), lambda x: F.col("n") > x)
    tables = spark.sparkContext.broadcast(bit_tables(counted.where(F.col("n") > LEVELS[0]).select("key", F.explode(levels).alias("level"))))

    def allocate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [np.frombuffer(t, dtype=np.uint8) for _, t in sorted(tables.value.items())]
        for b in parts(batches, 512):
            out: list[tuple[np.ndarray, int, np.ndarray]] = []
            for sid, own, need, below in zip(b.column("sid").to_pylist(), b.column("own"), b.column("need").to_pylist(), b.column("below")):
                own, below = (np.asarray(x.values, dtype=np.int64) for x in (own, below))
                cost = sum((in_table(own, t).astype(np.int8) for t in bits), np.zeros(len(own), dtype=np.int8))
                looked_up = np.zeros(len(own), dtype=bool)
                looked_up[:1 if need == 1 else 0] = True
                if need > 1:
                    looked_up[np.argsort(cost, kind="stable")[:need]] = True
                shared = cost > 0
                more = below[in_table(below, bits[0])] if bits else below[:0]
                out.append((np.concatenate([own[shared], more]), sid, np.concatenate([looked_up[shared], np.zeros(len(more), dtype=bool)])))
            sizes = [len(k) for k, _, _ in out]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([k for k, _, _ in out])), pa.array(np.repeat(np.array([s for _, s, _ in out], dtype=np.int64), sizes)),
                                              pa.array(np.concatenate([x for _, _, x in out]))], names=["key", "sid", "looks"])

    rows = materialize(keyed.select("sid", "own", "need", "below").mapInArrow(allocate, "key long, sid long, looks boolean"), "join-keys")
    short = got.where(F.size("short") > 0).select("sid", F.explode("short").alias("key"))
    if not short.isEmpty():
        table = spark.sparkContext.broadcast(bit_tables(short.select("key", F.lit(0).alias("level")))[0])

        def start():
            hashes, bands, bits = WordHashes(), Bands(num, den), np.frombuffer(table.value, dtype=np.uint8)

            def run(texts: list[str]) -> dict:
                made = [token_set(t, n, hashes) for t in texts]
                return {"sid": [set_id(x) for x in made], "keys": [wanted_keys(x, bands, bits) if len(x) else [] for x in made]}
            return run

        met = add_columns(docs, [], start, "sid long, keys array<long>").select(F.explode("keys").alias("key"), "sid", F.lit(False).alias("looks"))
        rows = materialize(rows.unionByName(short.select("key", "sid", F.lit(True).alias("looks"))).unionByName(met), "join-keys")
    # a list is told by its least and greatest member, which aggregate partially; no task holds a list
    alive = rows.groupBy("key").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi"), F.max("looks").alias("looks")).where("lo != hi and looks").select(F.col("key").alias("_k"))
    return materialize(rows.select("key", "sid").join(alive, F.col("key") == F.col("_k")).select("key", "sid").distinct(), "join-lists")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each node's component in the graph of ``edges`` (a, b); nodes without edges are left out.

    Each round points every node to its least neighbour, twice over, and
    contracts the graph; the number of nodes at least halves in a round or so.
    """
    edges = materialize(edges.select("a", "b").where("a != b").distinct(), "cc-edges")
    roots = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        point = materialize(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up")), "cc-points")
        twice = point.select(F.col("node").alias("_n"), F.col("up").alias("_u"))
        point = materialize(point.join(twice, F.col("up") == F.col("_n"), "left").select("node", F.coalesce("_u", "up").alias("up")), "cc-points")
        to = point.select(F.col("node").alias("_n"), F.col("up").alias("_u"))
        roots = point.withColumnRenamed("up", "root") if roots is None else (
            roots.join(to, F.col("root") == F.col("_n"), "left").select("node", F.coalesce("_u", "root").alias("root")))
        roots = materialize(roots, "cc-roots")
        other = point.select(F.col("node").alias("_m"), F.col("up").alias("_v"))
        edges = materialize(edges.join(to, F.col("a") == F.col("_n")).join(other, F.col("b") == F.col("_m"))
                            .select(F.least("_u", "_v").alias("a"), F.greatest("_u", "_v").alias("b")).where("a != b").distinct(), "cc-edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if roots is None else roots


def link_classes(lists: DataFrame, classes: DataFrame, verify: Callable[[DataFrame], DataFrame], num: int, den: int) -> DataFrame:
    """(a, b): verified links that connect every component of candidate classes.

    ``lists`` has (key, sid) for every index key that at least two sets share,
    ``classes`` has (sid, n, sketch); ``verify`` keeps the linked ones of some pairs.
    """
    # every member against its list's hub: the set that lies in most lists, as the original of copies does
    weight = lists.groupBy("sid").agg(F.count(F.lit(1)).alias("weight")).withColumnRenamed("sid", "_s")
    member = lists.join(weight, F.col("sid") == F.col("_s")).select("key", "sid", "weight")
    hubs = materialize(member.groupBy("key").agg(F.max_by("sid", F.struct("weight", "sid")).alias("hub")), "join-hubs")
    pairs = (lists.join(hubs.select(F.col("key").alias("_k"), "hub"), F.col("key") == F.col("_k")).where("sid != hub")
             .select(F.least("hub", "sid").alias("a"), F.greatest("hub", "sid").alias("b")).distinct())
    star = materialize(verify(materialize(close_pairs(pairs, classes, num, den), "join-near")), "join-star")
    root = components(star)

    # large lists: other members as hubs, so that few are left to be compared in blocks
    sized = lists.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LARGE_LIST).select(F.col("key").alias("_k"))
    large = materialize(lists.join(sized, F.col("key") == F.col("_k")).join(hubs.select(F.col("key").alias("_h"), "hub"), F.col("key") == F.col("_h")).select("key", "sid", "hub"), "join-large")
    for turn in range(HUBS):
        if large.isEmpty():
            break
        at, main = root.select(F.col("node").alias("_n"), "root"), root.select(F.col("node").alias("_m"), F.col("root").alias("main"))
        placed = (large.join(at, F.col("sid") == F.col("_n"), "left").join(main, F.col("hub") == F.col("_m"), "left")
                  .select("key", "sid", F.coalesce("root", "sid").alias("root"), F.coalesce("main", "hub").alias("main")))
        placed = materialize(placed, "join-placed")
        second = placed.where("root != main").groupBy("key").agg(F.max_by(F.struct("sid", "root"), F.xxhash64(F.lit(turn), "sid")).alias("_second"))
        pairs = (placed.join(second.withColumnRenamed("key", "_k"), F.col("key") == F.col("_k")).where(F.col("root") != F.col("_second.root"))
                 .select(F.least("sid", "_second.sid").alias("a"), F.greatest("sid", "_second.sid").alias("b")).distinct())
        more = materialize(verify(materialize(close_pairs(pairs, classes, num, den), "join-near")), "join-star")
        if more.isEmpty():
            break
        star = star.union(more)
        root = components(star)

    # lists with several components: members outside the hub's against all others, in large lists by blocks
    named = (lists.join(root, F.col("sid") == F.col("node"), "left").select("key", "sid", F.coalesce("root", "sid").alias("root")))
    hub_root = hubs.join(root, F.col("hub") == F.col("node"), "left").select(F.col("key").alias("_k"), F.coalesce("root", "hub").alias("main"))
    named = materialize(named.join(hub_root, F.col("key") == F.col("_k")).drop("_k").withColumn("out", (F.col("root") != F.col("main")).cast("int")), "join-named")
    mixed = named.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("out").alias("n_out")).where("n_out > 0")
    mixed = materialize(mixed, "join-mixed")
    few = named.join(mixed.where(F.col("n") <= LARGE_LIST).select(F.col("key").alias("_k")), F.col("key") == F.col("_k")).drop("_k")
    out = few.where("out = 1").select(F.col("key").alias("_k"), F.col("sid").alias("_s"), F.col("root").alias("_root"))
    cross = few.join(out, (F.col("key") == F.col("_k")) & (F.col("root") != F.col("_root"))).select(F.least("sid", "_s").alias("a"), F.greatest("sid", "_s").alias("b")).distinct()
    mixed = mixed.where(F.col("n") > LARGE_LIST).select(F.col("key").alias("_k"), F.ceil(F.col("n") / BLOCK).cast("int").alias("rows"), F.ceil(F.col("n_out") / BLOCK).cast("int").alias("cols"))
    cell = F.pmod(F.xxhash64("sid"), F.lit(1 << 30))
    left = named.join(mixed, F.col("key") == F.col("_k"))
    rows = left.select("key", "sid", "root", (cell % F.col("rows")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("j"))
    cols = left.where("out = 1").select("key", "sid", "root", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), (cell % F.col("cols")).cast("int").alias("j"))
    full = classes.select(F.col("sid").alias("_s"), "n", "sketch")
    fields = ("key", "i", "j", "sid", "root", "n", "sketch")
    rows = rows.join(full, F.col("sid") == F.col("_s")).select(*fields)
    cols = cols.join(full, F.col("sid") == F.col("_s")).select(*[F.col(c).alias(f"c_{c}") for c in fields])

    def close(r: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        """Pairs of different components whose sketches are no farther apart than linked sets may be."""
        found = [np.empty((0, 2), dtype=np.int64)]
        if len(r) and len(c):
            mine, ids, roots, sizes = np.stack(r.sketch.to_list()), r.sid.to_numpy(), r.root.to_numpy(), r.n.to_numpy()
            for sid, at, n, sketch in zip(c.c_sid, c.c_root, c.c_n, c.c_sketch, strict=True):
                apart = np.bitwise_count(mine ^ sketch).sum(1, dtype=np.int64)
                ok = ids[((den + num) * apart <= (den - num) * (sizes + n)) & (roots != at)]
                found.append(np.stack([np.minimum(ok, sid), np.maximum(ok, sid)], 1))
        return pd.DataFrame(np.concatenate(found), columns=["a", "b"]).drop_duplicates()

    more = rows.groupBy("key", "i", "j").cogroup(cols.groupBy("c_key", "c_i", "c_j")).applyInPandas(close, "a long, b long")
    return star.union(verify(materialize(more.union(close_pairs(cross, classes, num, den)).distinct(), "join-close")))


def close_pairs(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sketches are no farther apart than linked sets may be."""
    one = sketches.select(F.col("sid").alias("_a"), F.col("n").alias("_m"), F.col("sketch").alias("_x"))
    two = sketches.select(F.col("sid").alias("_b"), F.col("n").alias("_n"), F.col("sketch").alias("_y"))
    apart = F.aggregate(F.zip_with("_x", "_y", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")), F.lit(0), lambda t, x: t + x)
    return (pairs.join(one, F.col("a") == F.col("_a")).join(two, F.col("b") == F.col("_b"))
            .where(F.lit(den + num) * apart <= F.lit(den - num) * (F.col("_m") + F.col("_n"))).select("a", "b"))


def token_sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """(sid, tokens) of the sets in ``pairs``, made from the texts of one row of each."""
    sids = pairs.select(F.col("a").alias("_s")).union(pairs.select("b")).distinct()
    wanted = materialize(classes.join(sids, F.col("sid") == F.col("_s")).select("sid", F.col("class_id").alias("_id"), F.col("class_hash").alias("_hash")), "join-wanted")
    texts = docs.select("doc_id", "text").join(small(wanted), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")))

    def start():
        hashes = WordHashes()

        def run(texts: list[str]) -> dict:
            got = [token_set(t, n, hashes) for t in texts]
            return {"own": [set_id(x) for x in got], "tokens": [x.view(np.int64) for x in got]}
        return run

    # an id may stand before several equal texts: one of them counts
    tokens = materialize(add_columns(texts, ["sid"], start, "own long, tokens array<long>").where("own = sid").drop("own"), "join-tokens")
    return materialize(tokens.dropDuplicates(["sid"]), "join-tokens") if tokens.count() > wanted.count() else tokens


def verified(pairs: DataFrame, tokens: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of ``pairs`` whose sets are linked, by their whole token sets."""
    inter = F.size(F.array_intersect("x", "y"))
    return (pairs.join(tokens.select(F.col("sid").alias("_x"), F.col("tokens").alias("x")), F.col("a") == F.col("_x"))
            .join(tokens.select(F.col("sid").alias("_y"), F.col("tokens").alias("y")), F.col("b") == F.col("_y"))
            .where(F.lit(den) * inter >= F.lit(num) * (F.size("x") + F.size("y") - inter)).select("a", "b"))


def small(rows: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` with a broadcast hint if there are at most ``limit`` (counted); else as they are, for a shuffle join."""
    return F.broadcast(rows) if rows.count() <= limit else rows


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, text_hash, n_shingles, class_id, component_id, root) of every row.

    class_id is the least doc_id with an equal set, component_id the least one
    that links reach; both are the row's own id for the empty set.  ``root``
    tells components apart that have no id; it is null for the empty set.
    """
    made = materialize(sets(docs, n, num, den), "join-sets")
    got = made.select("doc_id", "text_hash", "n_shingles", "sid", "sketch")
    classes = materialize(got.where("sid is not null").groupBy("sid").agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))).alias("least"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
        .select("sid", F.col("least.id").alias("class_id"), F.col("least.hash").alias("class_hash"), "n", "sketch"), "join-classes")
    lists = index_lists(made, docs, n, num, den)

    def verify(pairs: DataFrame) -> DataFrame:
        return verified(pairs, token_sets(docs, classes, pairs, n), num, den)

    root = components(link_classes(lists, classes.select("sid", "n", "sketch"), verify, num, den))
    named = classes.join(root, F.col("sid") == F.col("node"), "left").select("sid", "class_id", F.coalesce("root", "sid").alias("root"))
    least = named.groupBy("root").agg(F.min("class_id").alias("component_id"))
    named = named.join(least, "root").select(F.col("sid").alias("_s"), "class_id", "component_id", "root")
    return (got.join(named, F.col("sid") == F.col("_s"), "left")
            .select("doc_id", "text_hash", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("component_id", "doc_id").alias("component_id"), "root"))


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores before it until no column is called so."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name = f"_{name}"
    return name


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs``, all columns, of which one stays for each component, and one of rows equal in id and text.

    The row with the least id stays, rows without an id last, and of several
    with that id the one with the least hash of its text.  Rows without words
    have no component and stay.  Texts stay where they are: the rows to remove
    are broadcast while they are few, and only ids that occur twice are
    compared as whole rows.
    """
    found = materialize(near_duplicates(docs, n, num, den).select("doc_id", "text_hash", "root"), "join-found")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))).alias("one")
    stays = materialize(found.where(F.col("root").isNotNull()).groupBy("root").agg(one).select(F.col("root").alias("_root"), "one.id", "one.hash"), "join-stays")
    i, h = unused("_id", docs.columns), unused("_hash", docs.columns)
    key = [F.col("doc_id").alias(i), F.col("text_hash").alias(h)]
    same = docs["doc_id"].eqNullSafe(F.col(i)) & (F.xxhash64(docs["text"]) == F.col(h))
    others = ~(F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")))
    gone = materialize(found.join(stays, F.col("root") == F.col("_root")).where(others).select(*key).distinct(), "join-gone")
    kept = docs.join(small(gone), same, "left_anti")
    twice = materialize(found.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "join-twice")
    twice = materialize(twice.join(gone, twice[i].eqNullSafe(gone[i]) & (twice[h] == gone[h]), "left_anti"), "join-twice")
    if twice.isEmpty():
        return kept
    return kept.join(small(twice), same, "left_anti").unionByName(kept.join(small(twice), same, "left_semi").dropDuplicates(["doc_id", "text"]))
