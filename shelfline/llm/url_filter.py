"""URL filter: rules first, then a logistic regression on hashed character
n-grams of host and path, trained from a small table of labelled URLs. All is
DataFrame operations and the JVM's own learner.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import common

FEATURES = 1 << 12
GRAMS = (3, 4, 5)

# Rules: verdict, host, beginning of the path.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

# Labelled URLs: 1 for pages to block.
BLOCKED = """
https://www.cheap-pills.example.com/en/680
http://cheap-pills.example.org/buy/now.html
https://discount-pharmacy.example.com/pills/order
https://m.casino-win.example.org/en/12
https://www.casino-win.example.com/play/slots
http://online-casino.example.com/jackpot/7
https://blog.free-bets.example.com/es/55
https://free-bets.example.org/fr/18?ref=x
https://bets-online.example.com/odds/today
http://adult-x.example.com/en/41
https://www.adult-x.example.org/videos/9
https://xxx-cams.example.com/live/3
https://ads-track.example.com/click?id=9
http://m.ads-track.example.org/pixel/1
https://tracker-ads.example.com/banner/77
https://spam-farm.example.com/en/900
http://blog.spam-farm.example.org/links/4
https://link-farm.example.com/seo/backlinks
https://replica-watches.example.com/sale/11
https://quick-loans.example.org/apply/now
https://crypto-doubler.example.com/invest/5
https://win-prizes.example.org/claim/2
""".split()
ALLOWED = """
https://www.thonth.example.com/en/120
http://blog.therble.example.com/en/77.html
https://m.tionsh.example.org/es/431
https://theron.example.org/en/52?page=2&ref=x
http://www.ththhe.example.com/fr/192.html
https://thering.example.com/es/8/
https://blog.tiontion.example.com/en/99
https://therer.example.org/de/1045
http://m.thernt.example.com/en/31#top
https://www.ththor.example.org/es/760
https://news.example.com/world/2021/05/story.html
https://docs.example.org/guide/install
http://library.example.org/catalog/item/88
https://university.example.com/courses/history
https://museum.example.org/collections/maps
https://weather.example.com/city/berlin
https://recipes.example.org/soup/onion
https://forum.example.com/thread/1234
https://blog.example.com/2020/11/travel-notes
https://wiki.example.org/article/language
https://gov.example.org/forms/tax
http://m.music.example.org/en/604
https://blog.garden.example.com/de/18.html
https://www.history.example.net/fr/2291
http://travel.example.com/es/77/
https://m.science.example.net/en/3510?page=2&ref=x
https://sports.example.org/de/46#top
http://www.health.example.com/fr/909?utm_source=feed
https://blog.cinema.example.org/es/1204
https://school.example.com/teachers/list
""".split()


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end; A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to "?", "#" or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(u, 1.0) for u in BLOCKED] + [(u, 0.0) for u in ALLOWED],
                                 "url string, label double")


def _grams(text: Column) -> Column:
    """Character n-grams of a text marked at both ends."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))
    return F.flatten(F.array(*(_windows(marked, n) for n in GRAMS)))


def _windows(marked: Column, size: int) -> Column:
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(marked) - size + 1))
    return F.transform(places, lambda i: F.substring(marked, i, size))


def with_grams(urls: DataFrame, host: str, path: str) -> DataFrame:
    return urls.withColumn("host_grams", _grams(F.col(host))).withColumn(
        "path_grams", _grams(F.col(path)))


def train(labelled: DataFrame) -> PipelineModel:
    """Fit to rows (url, label). Hosts and paths have features of their own.
    The table is small by contract; nulls in it are passed over."""
    rows = labelled.dropna().select(
        "label", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return Pipeline(stages=[
        HashingTF(numFeatures=FEATURES, binary=True, inputCol="host_grams", outputCol="host_tf"),
        HashingTF(numFeatures=FEATURES, binary=True, inputCol="path_grams", outputCol="path_tf"),
        VectorAssembler(inputCols=["host_tf", "path_tf"], outputCol="features"),
        LogisticRegression(maxIter=100, regParam=0.01),
    ]).fit(with_grams(rows, "host", "path").coalesce(1))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Of the rules that fit, the one with the longest host and path together
    (the earlier of equal ones), as a struct (verdict, rule); else null."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, of, begin in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(begin)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"),
                                      F.lit(of + begin).alias("rule"))).otherwise(found)
    return found


def judge(pages: DataFrame, model: PipelineModel, rules: list[tuple[str, str, str]] = RULES,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """For each row of `pages`: page_id, host, path, rule (the one that decided,
    or null), verdict (allow or block) and the model's block probability.

    A null url, or one without "://", has an empty host and path, which the
    model judges. Each row is judged by itself: repeated rows, ties and null ids
    need no rule, very long urls are read whole, an empty table gives an empty
    result. Other columns are not read.
    """
    common.prepare(pages.sparkSession)
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        host_of(url).alias("host"), path_of(url).alias("path"))
    scored = model.transform(with_grams(rows, "host", "path")).select(
        "page_id", "host", "path", vector_to_array("probability")[1].alias("score"))
    ruled = scored.withColumn("decided", rule_of(F.col("host"), F.col("path"), rules))
    return ruled.select(
        "page_id", "host", "path", "decided.rule",
        F.coalesce("decided.verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
        .alias("verdict"), "score")
