"""URL filters: rules first, then logistic regression on hashed character n-grams of host and path.

Everything runs on DataFrame and SQL functions.  The model is trained by
Spark's own logistic regression on a small labelled URL table; its
``BUCKETS`` weights come back as one array literal, so scoring is a projection
without a join or shuffle.

Edge cases: a null url or one without ``://`` has empty host and path, no rule
and the verdict of the model for no n-grams (its bias); very long urls use all
their n-grams; repeated rows are judged alike; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize

BUCKETS = 4096
N = 4
THRESHOLD = 0.5
#: (verdict, host, path beginning): a rule fits its host and all subdomains; the longest one wins.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: The small labelled table: words of unwanted hosts, by theme (gambling, pharmacy, adult, money, counterfeits, advertising, malware).
UNWANTED_WORDS = ("casino poker bets betting jackpot roulette slots lottery sportsbet blackjack bingo gamble "
                  "pills pharmacy viagra diet weightloss steroid meds rxstore "
                  "porn xxx adult escort camgirls hookup nude sexchat "
                  "payday loans forex bitcoin profit getrich earnmoney cashback binary "
                  "replica fakewatch outlet discount knockoff cheap "
                  "adserver banner popup tracker clicks doubleclick affiliate promo spam bulkmail "
                  "crack keygen warez torrent freedownload hacks phish prize winner").split()
#: Words of ordinary hosts.
ORDINARY_WORDS = ("library university school college museum archive history science physics biology chemistry mathematics "
                  "garden recipes kitchen travel weather railway city council parliament government court police hospital clinic "
                  "news times herald journal magazine radio cinema theatre orchestra music gallery books poetry language dictionary "
                  "software docs developer open data linux python forum wiki blog photo family church village river mountain forest "
                  "football tennis cycling hiking sailing research institute society foundation energy climate ocean nature bird farm "
                  "carpenter bakery hotel restaurant bicycle repair insurance bank post market design studio engineering").split()
#: Paths of unwanted pages, of ordinary ones, and of both.
UNWANTED_PATHS = ("/register/bonus", "/buy-now/order.php", "/click/redirect", "/go/out.php", "/offers/70-off", "/gallery/hot/12.html", "/win/claim-now", "/ad/banner.gif", "/track/pixel", "/free/download.exe")
ORDINARY_PATHS = ("/about", "/articles/2019/05/opening-hours", "/docs/install.html", "/people/staff", "/wiki/Main_Page", "/events/concert", "/publications/report.pdf", "/contact", "/lessons/chapter-4", "/news/local")
NEUTRAL_PATHS = ("/", "", "/en/12", "/de/3456.html", "/fr/78/", "/index.html", "/page/3", "/es/901")
ENDINGS = ("com", "org", "net", "info", "de", "co.uk", "example.com", "example.org", "example.net")
SUBDOMAINS = ("", "www.", "m.", "blog.")


def labelled_urls(spark: SparkSession, unwanted: Sequence[str] = UNWANTED_WORDS, ordinary: Sequence[str] = ORDINARY_WORDS) -> DataFrame:
    """(url, y): y is 1 for unwanted pages.

    Every word gives hosts of its own and joined with another word of its
    class, each once with a path of its class and once with a neutral one;
    endings and subdomains take turns over both classes alike.
    """
    rows = []
    for y, some, paths in ((1, unwanted, UNWANTED_PATHS), (0, ordinary, ORDINARY_PATHS)):
        for i, word in enumerate(some):
            others = [some[(i + step) % len(some)] for step in (7, 19)]
            for j, name in enumerate((word, f"{word}-{others[0]}", f"{others[1]}{word}")):
                for k, choice in enumerate((paths, NEUTRAL_PATHS)):
                    turn = 3 * i + j + 5 * k
                    rows.append((f"https://{SUBDOMAINS[turn % len(SUBDOMAINS)]}{name}.{ENDINGS[turn % len(ENDINGS)]}{choice[turn % len(choice)]}", y))
    return spark.createDataFrame(rows, "url string, y int")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url, both empty without ``://``."""
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3))), F.lit(""))
    host = F.regexp_extract(rest, "(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def ngram_buckets(host: Column, path: Column, n: int = N, buckets: int = BUCKETS) -> Column:
    """Distinct buckets of the character n-grams of host (``h`` before) and path (``p`` before)."""
    def grams(text: Column, mark: str) -> Column:
        text = F.concat(F.lit("^"), text, F.lit("$"))
        last = F.greatest(F.length(text) - F.lit(n - 1), F.lit(1))
        return F.transform(F.sequence(F.lit(1), last), lambda i: F.pmod(F.xxhash64(F.concat(F.lit(mark), F.substr(text, i, F.lit(n)))), F.lit(buckets)).cast("int"))
    return F.array_distinct(F.concat(grams(host, "h"), grams(path, "p")))


def train(spark: SparkSession, labelled: DataFrame | None = None, buckets: int = BUCKETS) -> tuple[list[float], float]:
    """Weights of the buckets and the bias, by Spark's logistic regression on the small labelled table."""
    labelled = labelled_urls(spark) if labelled is None else labelled
    host, path = host_path(F.col("url"))
    grams = ngram_buckets(host, path, buckets=buckets)
    made = materialize(labelled.select(F.col("y").cast("double").alias("label"), grams.alias("g")).coalesce(1), "url-grams")  # else g is computed for every bucket
    dense = F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), lambda i: F.array_contains(F.col("g"), i).cast("double"))
    rows = made.select("label", array_to_vector(dense).alias("features")).coalesce(1)
    model = LogisticRegression(regParam=0.01, maxIter=50, standardization=False).fit(rows)
    return [float(x) for x in model.coefficients], float(model.intercept)


def rule_of(host: Column, path: Column) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    fits = [(F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))), len(h + p)) for v, h, p in RULES]
    return F.coalesce(*[x for x, _ in sorted(fits, key=lambda x: -x[1])])


def judge(pages: DataFrame, model: tuple[list[float], float], threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, score (probability of unwanted by the model)."""
    weights, bias = model
    literal = F.array(*map(F.lit, weights))  # folded to one literal
    host, path = host_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    total = F.aggregate(ngram_buckets(F.col("host"), F.col("path"), buckets=len(weights)), F.lit(bias), lambda a, g: a + F.element_at(literal, g + 1))
    return (rows.withColumn("score", 1 / (1 + F.exp(-total))).withColumn("_r", rule_of(F.col("host"), F.col("path")))
            .select("page_id", "host", "path", F.col("_r.rule").alias("rule"),
                    F.coalesce("_r.verdict", F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"), "score"))
