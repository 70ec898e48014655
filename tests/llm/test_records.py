"""URL filter, WARC and chat formatting against brute force, round trips and edge cases; the pipeline."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import chat, jaccard_join, url_filter, warc
from tidemark.llm.queries import QUERIES
from tidemark.session import scratch_path

SMALL = "/root/testdata/sf0.001"


# -- URL filter -------------------------------------------------------------------------------

URLS = ["http://A.Example.NET/en/1?x=1", "https://example.net/en", "https://example.net/de/x", "http://x.example.com/de/", "http://example.com/den", "http://b.org/fr/1#y",
        "http://org/fr/", "http://notnet/x", "http://net", "no scheme", None, "", "http://", "x://h?q://z/a", "http://cheap-pills.example.com/en/1", "ftp://h\n.net/p\nq#r", "http://myexample.net/en/", "http://é.com/" + "p" * 3000]


def brute_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def brute_rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


@pytest.fixture(scope="module")
def model(spark):
    return url_filter.train(spark)


def test_hosts_paths_rules_and_scores(spark, model):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in url_filter.judge(pages, model).collect()}
    assert len(got) == len(URLS)
    weights, bias = model
    host, path = url_filter.host_path(F.col("url"))
    grams = {r.page_id: r.g for r in pages.select("page_id", url_filter.ngram_buckets(host, path).alias("g")).collect()}
    for i, url in enumerate(URLS):
        r, (h, p) = got[i], brute_host_path(url)
        rule, verdict = brute_rule(h, p)
        score = 1 / (1 + math.exp(-(bias + sum(weights[g] for g in grams[i]))))
        assert (r.host, r.path, r.rule) == (h, p, rule)
        assert r.score == pytest.approx(score)
        assert r.verdict == (verdict or ("block" if score >= 0.5 else "allow"))


def test_model_tells_unwanted_hosts(spark, model):
    rows = [("https://www.cheap-pills.example.com/en/680", 1), ("https://m.free-bets.example.org/de/216.html", 1), ("http://free-pills.example.org/en/9", 1),
            ("http://ththed.example.org/de/252", 0), ("https://www.theres.example.org/en/1", 0), ("https://blog.tiontion.example.com/fr/4", 0)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    assert [r.score >= 0.5 for r in url_filter.judge(pages, model).orderBy("page_id").collect()] == [bool(y) for _, y in rows]
    assert url_filter.judge(pages.limit(0), model).count() == 0
    plan = url_filter.judge(pages, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_words_never_seen_are_told_by_their_ngrams(spark):
    part = lambda words, kept: [w for i, w in enumerate(words) if (i % 4 != 1) == kept]
    seen, unseen = ([part(url_filter.UNWANTED_WORDS, k), part(url_filter.ORDINARY_WORDS, k)] for k in (True, False))
    model = url_filter.train(spark, url_filter.labelled_urls(spark, *seen))
    pages = url_filter.labelled_urls(spark, *unseen).select(F.col("y").alias("page_id"), "url")
    blocked = {r.page_id: r.share for r in url_filter.judge(pages, model).groupBy("page_id").agg(F.avg((F.col("score") >= 0.5).cast("int")).alias("share")).collect()}
    assert blocked[0] < 0.1 and blocked[1] > 0.4
    ordinary = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").where(~F.col("url").rlike("://[^/]*-"))  # hosts of invented words
    assert url_filter.judge(ordinary, model).where("score >= 0.5").count() < 0.05 * ordinary.count()


# -- WARC -------------------------------------------------------------------------------------

def brute_records(rows):
    """(page_id, payload_bytes, digest, type, refers_to, payload) of each row: of equal payloads of 1000 bytes one response."""
    groups, want = {}, []
    for i, url, h in rows:
        groups.setdefault((h or "").encode(), []).append((i is not None, i or 0, url is not None, url or ""))
    for p, members in groups.items():
        digest = hashlib.sha1(p).hexdigest()
        members.sort(reverse=True)
        owner = members[0][1] if members[0][0] else None
        for k, (known, i, _, _) in enumerate(members):
            revisit = len(p) >= 1000 and k > 0
            want.append((i if known else None, len(p), digest, "revisit" if revisit else "response", owner if revisit else None, None if revisit else p))
    return sorted(map(str, want))


def read_back(spark, pages, **options):
    path = scratch_path(spark, "warc")
    warc.write(pages, path, **options)
    rows = warc.read(spark, path).collect()
    return path, sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload))) for r in rows)


def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000 * 1500)  # payloads over 1500 bytes are large
    big, sep = "é" * 600, "x\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nzz" + "y" * 1000
    rows = [(1, "http://a", big), (2, "http://b\r\nWARC-Type: x", big), (9, None, big), (3, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (7, "u", sep), (8, "v", sep), (None, "n", big), (20, "r", sep), (20, "r", sep), (20, "r", sep), (20, None, sep)]
    rows += [(None, "n", "N" * 1000)] * 3 + [(None, None, "N" * 1000)] + [(30, "z", "L" * 5000), (31, None, "L" * 5000), (32, "w", "M" * 200_000)] + [(40, "q", "Q" * 1000)] * 40
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"payload": F.lit(1), "owner": F.lit(2), "found": F.lit(3), "_place": F.lit(4)}).repartition(3)
    path, got = read_back(spark, pages)
    assert got == brute_records(rows)
    ids = [line for r in spark.read.text(f"{path}/*/*.txt.gz").collect() for line in [r.value] if line.startswith("WARC-Record-ID")]
    assert len(ids) == len(set(ids)) == len(rows)
    assert read_back(spark, pages.limit(0))[1] == []


def test_payloads_do_not_move(spark):
    pages = spark.createDataFrame([(i, "u", "x" * 1000 + str(i % 5)) for i in range(50)], "page_id long, url string, html string")
    revisits, responses = warc.resolve(pages)
    for rows in (revisits, responses):
        assert "Exchange hashpartitioning" not in rows._jdf.queryExecution().executedPlan().toString()
    assert "html" not in revisits._jdf.queryExecution().executedPlan().toString()


# -- chat -------------------------------------------------------------------------------------

def brute_best(nodes):
    by = {n[1]: n for n in nodes}
    parents = {n[2] for n in nodes if n[2] in by}
    def path(i):
        out = []
        while i in by:
            out.append(i)
            i = by[i][2]
        return out[::-1]
    paths = [path(n[1]) for n in nodes if n[1] not in parents]
    return sorted(paths, key=lambda p: (-sum(by[i][3] for i in p) / len(p), p[-1]))


def test_trees_give_their_best_paths(spark):
    rnd = random.Random(2)
    rows, want = [], {}
    for t in range(12):
        nodes = [(t, i, rnd.randrange(i) if i and rnd.random() < 0.95 else (None if rnd.random() < 0.5 else 777), float(rnd.randrange(4)), rnd.choice(["user", "assistant"]), f"{t}-{i}") for i in range(rnd.randrange(1, 25))]
        rows += nodes
        want[t] = [[f"{t}-{i}" for i in p] for p in brute_best(nodes)]
    df = spark.createDataFrame(rows, "tree long, node long, parent long, score double, role string, text string")
    for branches in (1, 2, None):
        got = chat.format_trees(df, branches).select("tree", "rank", chat.parse(F.col("formatted")).text.alias("texts")).collect()
        assert {(r.tree, r["rank"]): r.texts for r in got} == {(t, k + 1): p for t, ps in want.items() for k, p in enumerate(ps[:branches])}


def test_cycles_and_long_chains_end(spark):
    rows = [(1, 1, 2, 0.0, "user", "a"), (1, 2, 1, 0.0, "user", "b"), (1, 3, 2, 0.0, "user", "c")] + [(2, i, i - 1 if i else None, 0.0, "user", str(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "tree long, node long, parent long, score double, role string, text string")
    got = {(r.tree, r["rank"]): r.texts for r in chat.format_trees(df, None).select("tree", "rank", chat.parse(F.col("formatted")).text.alias("texts")).collect()}
    assert got[(2, 1)] == [str(i) for i in range(100)]
    assert sorted(x for (t, _), p in got.items() if t == 1 for x in p) == ["a", "b", "c"]


def test_plan_of_long_conversations_stays_small(spark):
    turns = spark.createDataFrame([(c, i, "user", f"{c}-{i}") for c, n in ((1, 2000), (2, 3)) for i in range(n)], "conv_id long, turn long, role string, text string")
    made = chat.format_trees(chat.from_turns(turns))
    assert made._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 6
    got = {r.tree: r.texts for r in made.select("tree", chat.parse(F.col("formatted")).text.alias("texts")).collect()}
    assert got == {c: [f"{c}-{i}" for i in range(n)] for c, n in ((1, 2000), (2, 3))}


def test_repeated_nodes_count_once(spark):
    rows = [(1, 1, None, 1.0, "user", "a"), (1, 1, None, 1.0, "user", "a"), (1, 2, 1, 1.0, "user", "c"), (1, 2, 1, 1.0, "user", "b"), (None, 1, None, 0.0, "user", "n"), (None, 1, None, 0.0, "user", "n")]
    nodes = spark.createDataFrame(rows, "tree long, node long, parent long, score double, role string, text string")
    got = {r.tree: r.texts for r in chat.format_trees(nodes).select("tree", chat.parse(F.col("formatted")).text.alias("texts")).collect()}
    assert got == {1: ["a", "b"], None: ["n"]}


def test_texts_come_back_whatever_they_hold(spark):
    texts = [None, "", "<|im_end|><|im_start|>assistant ok", "%3C|", "%25", "%253C|", "<<||%", "a\n\nb\n", "%0A", "<|im_end|>\n", "x" * 5000, "\U0001f600é"]
    rows = [(5, i, "assistant" if i % 2 else "us%er\n<|", t) for i, t in enumerate(texts)] + [(None, 0, None, "q"), (6, None, "user", "w"), (6, None, "user", "w")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("score", F.lit("clash"))
    got = {r.tree: r.turns for r in chat.format_trees(chat.from_turns(turns)).select("tree", chat.parse(F.col("formatted")).alias("turns")).collect()}
    assert [(t.role, t.text, t.loss) for t in got[5]] == [(r, x or "", r == "assistant") for _, _, r, x in rows[:len(texts)]]
    assert [(t.role, t.text) for t in got[None]] == [("", "q")] and len(got[6]) == 2
    assert chat.format_trees(chat.from_turns(turns.limit(0))).count() == 0


def test_chat_and_url_queries_run_no_python(spark):
    for name in ("op2_url_filter", "op7_chat"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# -- pipeline ---------------------------------------------------------------------------------

def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SMALL).cache()
        assert docs.columns == columns and docs.join(before, "doc_id", "left_anti").isEmpty(), name
        kept.append(docs.count())
    assert kept == sorted(kept, reverse=True) and kept[-1] < kept[0]
    rest = jaccard_join.near_duplicates(docs, 5, 80, 100)
    assert rest.where("doc_id != component_id").isEmpty()
    out = corpus_pipeline.run(spark, SMALL)
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())
