"""Operators over texts against brute force, round trips and edge cases."""

import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, jaccard_join, quality_classifier, quality_rules, sharding, toxicity

ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "word " * 3000), (5, "same text here, twice over"), (6, "same text here, twice over"),
       (None, "a row without an id"), (7, "Ünïcode ßtraße 東京 \U0001f600 it's 12345"), (8, "x" * 5000), (8, "x" * 5000)]


@pytest.fixture(scope="session")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def words(t):
    return re.findall("[^\x20\x09-\x0d]+", t or "")


# -- byte-level BPE ---------------------------------------------------------------------------

def test_bpe_equals_tiktoken_and_decodes_back(spark, documents, ranks):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(1)
    rows = ODD + [(100 + i, "".join(rnd.choice("abcdefg  \n'st0é日&") for _ in range(rnd.randint(0, 400)))) for i in range(60)]
    got = bpe.decode(bpe.encode(documents(rows).repartition(3), ranks, public_tokenizers.PATTERN), ranks).collect()
    want = sorted(((i, enc.encode_ordinary(t or "")) for i, t in rows), key=str)
    assert sorted(((r.doc_id, list(r.ids)) for r in got), key=str) == want
    assert sorted(bytes(r.decoded) for r in got) == sorted((t or "").encode() for _, t in rows)


def test_bpe_empty_table_and_extra_columns(documents, ranks):
    assert bpe.encode(documents([]), ranks, public_tokenizers.PATTERN).count() == 0
    assert bpe.encode(documents([(1, "a b")]).withColumn("ids", F.lit(3)), ranks, public_tokenizers.PATTERN).first().ids == [64, 275]


def test_spark_fold_equals_array_fold(spark, ranks):
    pieces = [w.encode() for w in ("thaterndingha", " Ciónga", "x", "aaaaaaaa", "hello", " über")]
    flat, n = bpe.Merges(ranks).fold(pieces)
    table, size = bpe.pair_literal(ranks)
    df = spark.createDataFrame([(i, [ranks[bytes([c])] for c in w]) for i, w in enumerate(pieces)], "i int, w array<int>")
    got = [r.ids for r in df.select("i", bpe.fold(F.col("w"), table, size).alias("ids")).orderBy("i").collect()]
    assert [x for ids in got for x in ids] == flat.tolist()
    assert [len(x) for x in got] == n.tolist()


# -- Jaccard join -----------------------------------------------------------------------------

def brute_components(rows, n, num, den):
    def shingles(t):
        w = words((t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and den * len(x & y) >= num * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k), i)) for k, (i, s) in enumerate(sets)), key=str)


def near_copies(rnd, groups=12, copies=9):
    vocabulary = [f"w{i}" for i in range(400)]
    rows, i = [], 100
    for g in range(groups):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice((2, 4, 7, 12, 25, 60, 140)))]
        for _ in range(copies):
            t = list(base)
            for _ in range(rnd.randint(0, max(1, len(t) // 12))):
                t[rnd.randrange(len(t))] = rnd.choice(vocabulary)
            if rnd.random() < 0.3:
                t = t[rnd.randint(0, 2):]
            rows.append((i, " ".join(t)))
            i += 1
    return rows


@pytest.mark.parametrize("seed,n,num", [(1, 3, 90), (2, 5, 80), (3, 1, 80)])
def test_join_equals_brute_force(documents, seed, n, num):
    rows = ODD + near_copies(random.Random(seed))
    got = jaccard_join.near_duplicates(documents(rows).repartition(4), n, num, 100)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute_components(rows, n, num, 100)


def test_join_in_small_blocks_equals_brute_force(documents, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    monkeypatch.setattr(jaccard_join, "LARGE_LIST", 3)
    rows = near_copies(random.Random(5), 4, 25)
    got = jaccard_join.near_duplicates(documents(rows), 2, 80, 100)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute_components(rows, 2, 80, 100)


def bits_of(keys):
    table = np.zeros(jaccard_join.TABLE_BITS // 8, dtype=np.uint8)
    for k in keys.tolist():
        slot = k & (jaccard_join.TABLE_BITS - 1)
        table[slot >> 3] |= 1 << (slot & 7)
    return table


@pytest.mark.parametrize("num", [80, 90])
def test_any_allocation_meets_every_linked_set(num):
    """Whatever ``need`` of its own keys a set looks up, each linked set has one of them; too few keys give neighbourhoods that do."""
    rnd, bands = np.random.default_rng(3), jaccard_join.Bands(num, 100)
    for size in [*range(1, 60)] * 12 + [150, 400, 900] * 8:
        a = np.unique(rnd.integers(0, 2**63, size).astype(np.uint64))
        for _ in range(4):
            drop, add = rnd.integers(0, len(a) // 5 + 1), rnd.integers(0, len(a) // 5 + 2)
            b = np.unique(np.concatenate([a[rnd.permutation(len(a))[drop:]], rnd.integers(0, 2**63, add).astype(np.uint64)]))
            same = len(np.intersect1d(a, b))
            if not same or 100 * same < num * (len(a) + len(b) - same) or same == len(a) == len(b):
                continue
            x, y = sorted((a, b), key=lambda t: bands.of(len(t)))
            (own, need, _, short), other = jaccard_join.signatures(x, bands), jaccard_join.signatures(y, bands)
            if bands.of(len(x)) == bands.of(len(y)) and need == 1 and len(y) < len(x):
                (own, need, _, short), other, x, y = other, (own, need, None, short), y, x
                other = jaccard_join.signatures(y, bands)
            keys = np.concatenate([other[0], other[2]])
            if len(short):
                assert np.isin(jaccard_join.wanted_keys(y, bands, bits_of(short)), short).any()
            else:
                looked_up = own[:1] if need == 1 else rnd.permutation(own)[:need]
                assert len(looked_up) == need and np.isin(looked_up, keys).any()


def test_sets_with_few_filled_segments_are_linked(documents, monkeypatch):
    monkeypatch.setattr(jaccard_join, "segments_of", lambda distance: 1 if distance == 1 else distance + 1)  # then many sets have too few
    rows = near_copies(random.Random(8), 10, 8)
    got = jaccard_join.near_duplicates(documents(rows), 1, 80, 100)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute_components(rows, 1, 80, 100)


def test_index_lists_stay_short(spark, monkeypatch):
    """Unlike texts share no list that grows with the corpus, though their segments are as often empty."""
    rnd = random.Random(4)
    rows = [(i, " ".join(f"u{rnd.randrange(10**9)}" for _ in range(rnd.choice((6, 9, 20, 40, 80))))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lists = jaccard_join.index_lists(jaccard_join.sets(docs, 1, 80, 100), docs, 1, 80, 100)
    assert lists.count() == 0


def test_keep_one_and_edge_cases(documents):
    kept = jaccard_join.keep_one(documents([(3, "a b c d e f"), (1, "a b c d e f"), (2, "z y x w v u"), (2, "z y x w v u"), (9, ""), (None, "q")]))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "9", "None"]
    assert jaccard_join.near_duplicates(documents([])).count() == 0
    assert jaccard_join.keep_one(documents([])).count() == 0


def test_keep_one_without_ids_with_repeated_ids_and_clashing_columns(documents):
    text = " ".join(f"w{i}" for i in range(60))
    near, other = text + " w60", " ".join(f"v{i}" for i in range(40))
    rows = [(1, text), (2, text), (None, text), (None, near), (None, other), (None, other), (None, other + " v40"), (5, "same words here again once"), (5, "same words here again once more"), (5, " ".join(["long"] * 3000)), (5, " ".join(["long"] * 3000)), (7, None), (7, None), (8, "")]
    docs = documents(rows).withColumns({"_id": F.lit("x"), "_hash": F.lit(1), "__id": F.lit(2), "sid": F.lit(3), "n": F.lit(4), "root": F.lit(5), "id": F.lit(6), "hash": F.lit(7)})
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r.doc_id), r.text if r.text is None else r.text[:30]) for r in kept.select("doc_id", "text").collect())
    assert [i for i, _ in got] == ["1", "5", "5", "5", "7", "8", "None"] and got[-1][1] == other[:30]


# -- quality rules ----------------------------------------------------------------------------

def brute_counts(t):
    t = t or ""
    w = words(t)
    wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    marked = {j for i, x in enumerate(wins) if wins.count(x) > 1 for j in range(i, i + 5)}
    lines = t.split("\n")
    dup = sum(bool(words(x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(marked)


def test_rule_counts_equal_brute_force(documents):
    rnd = random.Random(4)
    rows = [x for x in ODD if x[0] != 4] + [(50 + i, " ".join(rnd.choice("a b c #x $y é\n \n z|").strip(" ") for _ in range(rnd.randint(0, 90)))) for i in range(40)]
    got = quality_rules.judge(documents(rows), (quality_rules.PRIOR, 0.5)).collect()
    assert sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got) == sorted(str((i, *brute_counts(t))) for i, t in rows)
    assert all(not r.kept for r in got if r.base_failed)
    kept = quality_rules.filter_documents(documents(rows), (quality_rules.PRIOR, 0.5))
    assert kept.count() == sum(r.kept for r in got) and kept.columns == documents([]).columns


def test_viterbi_equals_brute_force():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        s, stay = rnd.normal(size=int(rnd.integers(1, 8))), float(rnd.normal())
        def value(labels):
            return sum(x for x, y in zip(s, labels) if y) + stay * sum(a == b for a, b in zip(labels, labels[1:]))
        best = max(value([bool(m >> i & 1) for i in range(len(s))]) for m in range(2 ** len(s)))
        assert value(quality_rules.viterbi(s, stay).tolist()) == pytest.approx(best)


def test_crf_learns_from_all_of_a_long_document(spark, documents):
    for n in (0, 3, 200, 201, 250, 5000):
        got = quality_rules.runs("text", n, 200)
        assert all(0 <= a <= b <= n for a, b in got) and sum(b - a for a, b in got) == min(n, 200)
        assert n <= 200 or all(n * j // 4 <= a and b <= n * (j + 1) // 4 for j, (a, b) in enumerate(got))
    # good and bad documents begin alike and differ only after the first 200 lines
    head = "\n".join(f"plain words of line {i}" for i in range(200))
    tail = {1: " ".join(chr(97 + j) * 3 for j in range(26)), 0: "short line"}
    rows = [(i, head + "\n" + "\n".join(f"{tail[i % 2]} {k}" for k in range(800))) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    at = quality_rules.FEATURES.index("words")
    learned, blind = (quality_rules.fit(documents(d), labels)[0][at] for d in (rows, [(i, head) for i, _ in rows]))
    assert learned > blind + 0.1


def test_crf_batches_of_like_length_train_as_one():
    rnd = np.random.default_rng(5)
    rows = [(rnd.normal(size=(int(n), len(quality_rules.FEATURES))), i % 2) for i, n in enumerate([*rnd.integers(0, 40, 30), 1, 300])]
    made = quality_rules.batches([r for r in rows if len(r[0])], 120)
    assert len(made) > 3 and sum(int(on.sum()) for _, _, on in made) == sum(len(f) for f, _ in rows)
    whole = quality_rules.batches([r for r in rows if len(r[0])], 10 ** 6)
    w, stay = quality_rules.PRIOR, 0.3
    one, many = quality_rules.expected(*whole[0], w, stay), [quality_rules.expected(*b, w, stay) for b in made]
    assert len(whole) == 1 and one[1] == pytest.approx(sum(g for _, g in many)) and np.allclose(one[0], sum(g for g, _ in many))


def test_crf_training_raises_the_weight_of_what_marks_good_lines():
    good, bad = np.zeros((4, len(quality_rules.FEATURES))), np.zeros((4, len(quality_rules.FEATURES)))
    good[:, 0] = bad[:, 0] = 1
    bad[:, 3] = 0.2
    w, _ = quality_rules.train([(good, 1), (bad, 0)] * 10)
    assert quality_rules.viterbi(good @ w, 0.5).all() and not quality_rules.viterbi(bad @ w, 0.5).any()
    assert (quality_rules.train([])[0] == quality_rules.PRIOR).all()


# -- toxicity and quality classifiers: held-out accuracy ---------------------------------------

@pytest.fixture(scope="module")
def tables(spark):
    d = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


def accuracy(scored, labels, column):
    rows = scored.join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string")) % 4 == 2).select("predicted", column).collect()
    return sum(r[0] == r[1] for r in rows) / len(rows)


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    assert accuracy(toxicity.score(docs, toxicity.fit(docs, labels)), labels, "toxic") >= 0.9


def test_toxicity_without_seeds_learns_from_the_labels_alone(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score(docs, toxicity.fit(docs, labels, seeds=())).join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    rows = scored.select("predicted", "toxic").collect()
    hit = sum(r.predicted and r.toxic for r in rows)
    assert hit >= 0.9 * sum(r.toxic for r in rows) and hit >= 0.9 * sum(r.predicted for r in rows)


def test_grammar_scores_clauses(documents):
    g = toxicity.Grammar({"zzap*": 1.0}, toxicity.PRIOR)
    plain, negated, reported, threat, learned = map(g.score, ("you are an idiot.", "he is not an idiot.", "they said idiot.", "I will kill you.", "you zzapfoo"))
    assert plain > 0.5 > negated and reported < 0.5 and learned > 0.5
    # isolated words are no match, two of them are
    for lone in ("zzapfoo", "The trash is picked up on Monday.", "The clown made the children laugh.", "nobody is an idiot", "destroy the files, they said"):
        assert g.score(lone) < toxicity.THRESHOLD
    assert g.score("zzapfoo. Zzapbar!") > toxicity.THRESHOLD
    assert threat > g.score("I will kill time.") == g.score("") == g.score("Good day.")
    rows = toxicity.score(documents(ODD), g).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(documents([]), g).count() == 0


def test_composed_grammar_equals_its_transducers_one_after_another():
    rnd, table = random.Random(11), toxicity.numbered(toxicity.GRAMMAR)
    for _ in range(300):
        symbols = [rnd.choice(toxicity.CLASSES) for _ in range(rnd.randint(0, 40))]
        tape = symbols
        for m in toxicity.MACHINES:
            state, out = m.start, []
            for x in tape:
                state, y = m.arcs[state, x]
                out.append(y)
            tape = out
        state, composed = 0, []
        for x in symbols:
            state, y = table[state][x]
            composed.append(y)
        assert composed == tape


def brute_features(words):
    """Matches of one clause of (class, weight), by looking at all of it at once."""
    kinds = [k for k, _ in words]
    negated = [toxicity.NEGATION in kinds[max(0, i - toxicity.NEGATION_REACH):i] for i in range(len(kinds))]
    aimed = [i for i, k in enumerate(kinds) if k == toxicity.TARGET]
    reported = toxicity.REPORT in kinds
    out = [0.0] * len(toxicity.EMITS)
    for i, (k, w) in enumerate(words):
        if k == toxicity.INSULT:
            out[3 if reported else 2 if negated[i] else 1 if aimed else 0] += w
        elif k == toxicity.THREAT and not negated[i] and not reported and any(not negated[j] for j in aimed):
            out[4] += 1
    return out


def test_features_equal_brute_force():
    g = toxicity.Grammar({"zzap*": 1.5}, toxicity.PRIOR)
    words = {toxicity.OTHER: "table", toxicity.INSULT: "zzapfoo", toxicity.THREAT: "kill", toxicity.TARGET: "you", toxicity.NEGATION: "not", toxicity.REPORT: "said"}
    rnd = random.Random(12)
    for _ in range(500):
        clauses = [[rnd.choice(list(words)) for _ in range(rnd.randint(0, 9))] for _ in range(rnd.randint(0, 5))]
        found = [brute_features([(k, 1.5) for k in c]) for c in clauses]
        sums = [sum(f[i] for f in found) for i in range(len(toxicity.EMITS))]
        sums[0] = max(0.0, sums[0] - 1.5)
        assert g.features(". ".join(" ".join(words[k] for k in c) for c in clauses)) == pytest.approx([np.log1p(x) for x in sums])


def test_one_direct_threat_rejects_a_document(documents):
    texts = ["I will kill you.", "I will kill every one of you", "you there, tomorrow I shall kill", "fine day. Ich werde euch alle morgen umbringen!",
             "I will not kill you.", "They said I will kill you.", "I will kill time. You wait.", "You wait\nand kill time"]
    # as learned from labelled rows without any threat: the weight of no match falls far below its prior
    clean, toxic = np.zeros((5000, len(toxicity.EMITS))), np.tile([0, np.log(2), 0, 0, 0], (500, 1))
    learned = toxicity.calibrate(np.vstack([clean, toxic]), np.repeat([0.0, 1.0], [5000, 500]))
    assert learned[0] < toxicity.PRIOR[0] - 1
    for weights in (toxicity.PRIOR, learned):
        got = {r.doc_id: r.predicted for r in toxicity.score(documents(list(enumerate(texts))), toxicity.Grammar({}, weights)).collect()}
        assert [got[i] for i in range(len(texts))] == [1] * 4 + [0] * 4


def test_no_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    docs = documents(ODD)
    assert toxicity.score(docs, toxicity.fit(docs, none)).count() == len(ODD)
    assert {r.score for r in quality_classifier.score(docs, quality_classifier.fit(docs, none)).collect()} == {0.5}
    assert (quality_rules.fit(docs, none)[0] == quality_rules.PRIOR).all()


def test_quality_classifier_on_held_out_rows_and_exact_votes(tables, documents):
    docs, labels = tables
    votes = quality_classifier.fit(docs, labels)
    assert accuracy(quality_classifier.score(docs, votes), labels, "quality") >= 0.95
    rows = quality_classifier.score(documents(ODD), votes).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    x = votes.vectors[:3] @ np.zeros((votes.vectors.shape[1], 1))
    assert x.shape == (3, 1) and votes.scores(np.zeros((1, votes.projection.shape[0]), np.float32))[0] == votes.base


@pytest.mark.parametrize("n", [0, 1, 7, quality_classifier.K, 400])
def test_votes_equal_a_plain_loop_over_all_labelled_vectors(n):
    rng = np.random.default_rng(n)
    vectors = rng.normal(size=(n, 6)).astype(np.float32)
    vectors[n // 2:] = vectors[:n - n // 2]  # every vector twice, so the nearest ones tie
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True) if n else 1
    labels = rng.integers(0, 2, n).astype(float)
    labels[n // 2:] = labels[:n - n // 2]  # ties agree, so which of them is among the nearest does not matter
    votes = quality_classifier.Votes(np.eye(6, dtype=np.float32), vectors, labels, 0.25)
    rows = rng.normal(size=(50, 6)).astype(np.float32)
    rows[0] = 0
    got = votes.scores(rows)
    for row, score in zip(rows.astype(float), got):
        norm = math.sqrt(sum(x * x for x in row))
        if not n or not norm:
            assert score == (0.25 if n else 0.5)
            continue
        near = sorted(((sum(a * b for a, b in zip(row, v)) / norm, y) for v, y in zip(vectors.astype(float), labels)), reverse=True)[:quality_classifier.K]
        weights = [min(1.0, max(0.0, sim)) ** quality_classifier.POWER + 1e-9 for sim, _ in near]
        assert score == pytest.approx(sum(w * y for w, (_, y) in zip(weights, near)) / sum(weights), abs=1e-4)


# -- sharding ---------------------------------------------------------------------------------

def test_shards_are_near_equal_and_positions_have_no_gaps(spark, tables, documents):
    docs, _ = tables
    rows = sharding.shard_documents(docs, 16).collect()
    assert len(rows) == docs.count()
    load = {}
    for r in rows:
        load.setdefault(r.shard, []).append((r.slot, r["size"]))
    sizes = [sum(s for _, s in v) for v in load.values()]
    assert len(load) == 16 and max(sizes) - min(sizes) < 0.02 * np.mean(sizes)
    assert all(sorted(i for i, _ in v) == list(range(len(v))) for v in load.values())
    odd = sharding.shard_documents(documents(ODD), 4).collect()
    assert len(odd) == len(ODD) and {r["size"] for r in odd if r.doc_id == 1} == {1}
    assert sharding.shard_documents(documents([]), 4).count() == 0


def test_rebalancing_moves_only_what_it_must():
    even = sharding.even_map(64, 4)
    weight = {s: 1 for s in range(64)}
    assert sharding.rebalance(even, weight, 4) == even
    grown = sharding.rebalance(even, weight, 5)
    assert all(b == a or b == 4 for a, b in zip(even, grown)) and grown.count(4) >= 11


# -- decontamination --------------------------------------------------------------------------

def test_wand_retrieves_what_full_scoring_does(spark, documents):
    rnd = random.Random(2)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(k, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(5, 40))) + ". " + " ".join(rnd.choice(vocabulary) for _ in range(4))) for k in range(120)] + [(500, None), (501, "")]
    index = decontaminate.Index(items)
    for _ in range(200):
        query = sorted(set(rnd.sample(range(len(index.postings)), rnd.randint(1, 80))))
        if rnd.random() < 0.5:
            query = sorted(set(query) | {index.terms[w] for w in index.items[rnd.randrange(120)][1]})
        full = {}
        for t in query:
            for k, x in index.postings[t]:
                full[k] = full.get(k, 0) + x
        want = sorted(k for k, x in full.items() if x >= index.needed[k] and abs(x - index.needed[k]) > 1e-9)
        assert [k for k, _ in sorted(index.retrieve(query))] == want


def test_block_maxima_skip_what_cannot_reach():
    rnd = random.Random(6)
    vocabulary = [f"v{min(rnd.randrange(2000), rnd.randrange(2000))}" for _ in range(4000)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(k, f"{text(rnd.randint(10, 50))}. {text(5)}") for k in range(200)]
    index = decontaminate.Index(items)
    assert all(0 < b - a <= decontaminate.BLOCK for a, b in index.entry_place)
    opened, wand = [], index.wand
    index.wand = lambda cursors: opened.append(len(cursors)) or wand(cursors)
    postings = own = 0
    for k in range(200):
        own += len(set(decontaminate.words(items[k][1])))  # the postings of the item itself have to be added up
        query = sorted({index.terms[w] for w in decontaminate.words(f"{items[k][1]} {text(30)}") if w in index.terms})
        postings += sum(len(index.postings[t]) for t in query)
        assert k in [index.items[m][0] for m, _ in index.retrieve(query)]
    assert len(opened) < 200 * len(index.block_half) / 5 and own <= index.scored < 1.1 * own < postings / 10
    # far from every item no block is opened and no posting is read
    index.scored = 0
    assert index.retrieve(sorted(index.terms[w] for w in sorted(index.terms)[:3])) == [] and index.scored == 0


def test_planted_items_are_found_and_clean_documents_left_alone(spark, documents):
    rnd = random.Random(3)
    item = lambda: " ".join(f"q{rnd.randrange(3000)}" for _ in range(25)) + ". The answer is " + " ".join(f"a{rnd.randrange(3000)}" for _ in range(5)) + "."
    items = [(k, item()) for k in range(30)]
    filler = lambda n: " ".join(f"q{rnd.randrange(3000)}" for _ in range(n))
    rows = [(k, f"{filler(rnd.randrange(900))} {items[k][1].upper()} {filler(rnd.randrange(900))}") for k in range(30)] + [(1000 + k, filler(700)) for k in range(40)] + ODD
    benchmark = spark.createDataFrame(items + [(900, None)], "item_id long, text string")
    got = decontaminate.contaminations(documents(rows), benchmark).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, got)) == [(k, k) for k in range(30)]
    kept = decontaminate.filter_documents(documents(rows), benchmark)
    assert kept.count() == len(rows) - 30
    split = [decontaminate.find(documents(rows), x) for x in decontaminate.indexes(benchmark, 1000)]
    assert len(split) > 1 and sum(x.count() for x in split) == 30
    assert decontaminate.contaminations(documents([]), benchmark).count() == 0
    assert decontaminate.contaminations(documents(rows), benchmark.limit(0)).count() == 0


def test_scores_do_not_depend_on_the_parts(spark, documents):
    rnd = random.Random(4)
    text = lambda n: " ".join(f"q{min(rnd.randrange(400), rnd.randrange(400))}" for _ in range(n))
    items = [(k, f"{text(rnd.randrange(4, 60))}. {text(rnd.randrange(1, 6))}") for k in range(60)] + [(500, text(3000))]
    rows = [(k, f"{text(rnd.randrange(300))} {t} {text(rnd.randrange(300))}") for k, t in items] + [(1000, None), (1001, "")]
    benchmark = spark.createDataFrame(items + [(900, None)], "item_id long, text string")
    whole, parts = decontaminate.indexes(benchmark), decontaminate.indexes(benchmark, 3000)
    assert len(whole) == 1 and len(parts) > 3
    find = lambda some: sorted((d, *m) for d, t in rows for x in some for m in x.matches(t or ""))
    assert find(whole) == find(parts) == find([decontaminate.Index(items + [(900, None)])]) and {(k, k) for k, _ in items} <= {x[:2] for x in find(whole)}


def test_windows_are_all_reached_and_fit_the_item(spark):
    rnd = random.Random(5)
    text = lambda n: " ".join(f"v{rnd.randrange(60)}" for _ in range(n))
    items = [(k, f"{text(rnd.randrange(1, 40))}. {text(rnd.randrange(1, 4))}") for k in range(40)]
    index = decontaminate.Index(items)
    for n in [*range(1, 140), 700]:
        ws = decontaminate.words(text(n))
        ids = np.array([index.terms.get(w, -1) for w in ws])
        want = {(h, s) for h in set(index.halves.tolist()) for s in range(0, max(1, n - h), h) if (index.reachable(decontaminate.known(ids[s:s + 2 * h])) == h).any()}
        got = [(h, s) for h, s, _, _ in index.windows(ids)]
        assert set(got) == want and len(got) == len(want)
    # a long item does not widen the passages of a short one: its triples scattered over 2,000 words are no match
    short = "one two three four five six. seven"
    scattered = " ".join(f"{a} {'x ' * 250}" for a in ("one two three", "three four five", "four five six", "seven"))
    assert decontaminate.Index([(1, short)]).matches(short) and decontaminate.Index([(1, short)]).matches(scattered) == []
    assert decontaminate.Index([(1, short), (2, text(3000))]).matches(scattered) == []


def test_digests_of_queries(spark):
    assert hashlib.sha256(b"64 275").hexdigest() == spark.range(1).select(F.sha2(F.array_join(F.array(F.lit(64), F.lit(275)), " "), 256)).first()[0]
