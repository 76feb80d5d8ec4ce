"""Product resolver: free-text register entries to catalog products.

Each distinct unmatched string is resolved once, by the first rule that knows
it: an alias table, the exact name, the same consonant skeleton, and last a
scored match. What stays unresolved, or is too close to call, is UNKNOWN: a
wrong product is worse than a dropped line.

Score of a string against a product name: the word trigrams they share (taken
on the skeletons) over all of the string's and, at a fifth of the weight since
registers shorten names, those that only the name has. So what the string does
not account for counts against the name. A string that starts with a later word
of a name is taken for another product, as "Coke" is not "Diet Coke".

The scored match is exact without comparing all pairs. Trigrams are put in one
order, rarest in the catalog first. A score is never above the share of the
string's trigrams that the name has, and to share `need` of its n with a name, a string must share at least one of its first n - need + 1, and the first
one they share can have at most need - 1 shared ones behind it on either side.
So only rare trigrams are looked up, and common ones near the end of a name's
list never make a pair. Of the pairs that meet, only those are compared whose marks
(a bit of a long for each trigram) leave few enough of the string's bits unmatched:
each such bit is a trigram that the name lacks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.functions.text import is_product_code, plain_name, skeleton, word_trigrams

UNKNOWN = "UNKNOWN"
THRESHOLD = 0.5
GAP = 0.1
# Weight of a trigram that only the name has.
CHARGE = 0.2
# Start of the search: most strings have a good match, and knowing its score
# lets the full search skip everything that is clearly worse.
SEED_SCORE = 0.7

Scorer = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def _unique_names(products: DataFrame, key: Column) -> DataFrame:
    """key -> product_id for the keys that name one product only."""
    return (
        products.select(key.alias("name_key"), "product_id")
        .where(F.length("name_key") > 0)
        .groupBy("name_key")
        .agg(F.min("product_id").alias("product_id"),
             F.max("product_id").alias("other_id"))
        .where(F.col("product_id") == F.col("other_id"))
        .select("name_key", "product_id")
    )


def rule_matches(identifiers: DataFrame, products: DataFrame,
                 aliases: DataFrame | None = None) -> DataFrame:
    """(identifier, product_id, method) by the equality rules; null product_id
    and method where none applies. Digit strings are codes, not names: only an
    alias may resolve them."""
    spark = identifiers.sparkSession
    if aliases is None:
        aliases = spark.createDataFrame([], schemas.ALIASES)
    catalog = products.select("product_id").distinct()
    alias_map = (
        aliases.groupBy("identifier")
        .agg(F.min("product_id").alias("product_id"), F.max("product_id").alias("other_id"))
        .where(F.col("product_id") == F.col("other_id"))
        .join(catalog, "product_id", "left_semi")
        .select("identifier", F.col("product_id").alias("alias_id"))
    )
    by_name = _unique_names(products, plain_name(F.col("product_name"))) \
        .select(F.col("name_key").alias("plain"), F.col("product_id").alias("name_id"))
    by_skeleton = _unique_names(products, skeleton(F.col("product_name"))) \
        .select(F.col("name_key").alias("bare"), F.col("product_id").alias("skeleton_id"))
    named = ~is_product_code(F.col("identifier"))
    keyed = identifiers.select(
        "identifier",
        F.when(named, plain_name(F.col("identifier"))).alias("plain"),
        F.when(named, skeleton(F.col("identifier"))).alias("bare"),
    )
    found = (
        keyed.join(alias_map, "identifier", "left")
        .join(by_name, "plain", "left")
        .join(by_skeleton, "bare", "left")
    )
    return found.select(
        "identifier",
        F.coalesce("alias_id", "name_id", "skeleton_id").alias("product_id"),
        F.when(F.col("alias_id").isNotNull(), F.lit("alias"))
        .when(F.col("name_id").isNotNull(), F.lit("exact_name"))
        .when(F.col("skeleton_id").isNotNull(), F.lit("skeleton")).alias("method"),
    )


def _need(share: Column) -> Column:
    """Trigrams a name must share to reach `share` of the string's n; the small
    term keeps a product such as 0.9 * 10 from being rounded up to 10."""
    return F.greatest(F.ceil(share * F.col("n") - 1e-9).cast("int"), F.lit(1))


def _ranked_grams(texts: DataFrame, key: str, text: Column, rarity: DataFrame) -> DataFrame:
    """(key, bare, grams, n): each text and its trigrams, rarest first. A text has no
    more of them than letters, so the regrouped list is bounded by one text."""
    return (
        texts.select(key, text.alias("bare"), F.explode(word_trigrams(text)).alias("gram"))
        .join(rarity, "gram", "left")
        .groupBy(key, "bare")
        .agg(F.sort_array(F.collect_list(F.struct(
            F.coalesce("names", F.lit(0)).alias("names"), "gram"))).alias("ranked"))
        .select(key, "bare", F.col("ranked.gram").alias("grams"), F.size("ranked").alias("n"))
        .withColumn("marks", F.expr(
            "aggregate(grams, 0L, (s, g) -> s | shiftleft(1L, cast(xxhash64(g) & 63 AS int)))"))
    )


def _postings(names: DataFrame, rarity: DataFrame) -> DataFrame:
    """A row for each trigram of each name, with those that are left from it on."""
    return _ranked_grams(names, "name_key", F.col("name_key"), rarity).select(
        "name_key", F.col("grams").alias("name_grams"), "n", F.col("marks").alias("name_marks"),
        F.posexplode("grams").alias("place", "name_gram"),
    ).select("name_key", "name_grams", "name_gram", "name_marks",
             (F.col("n") - F.col("place")).alias("name_left"))


def _search_tasks(spark: SparkSession) -> int:
    """As many tasks as shuffles start with, which follows the size of the input
    once `session.size_shuffles` has set it, and no fewer than there are cores."""
    start = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(int(start or spark.conf.get("spark.sql.shuffle.partitions")),
               spark.sparkContext.defaultParallelism)


def _marks_fit() -> Column:
    """Whether the name can have `need` of the string's trigrams, by the marks of both."""
    lacking = F.bit_count(F.col("marks").bitwiseAND(F.bitwise_not(F.col("name_marks"))))
    return lacking <= F.col("n") - F.col("need")


def _meetings(strings: DataFrame, postings: DataFrame) -> DataFrame:
    """The strings' rare trigrams with the names that have them, for the pairs whose
    marks allow `need` shared trigrams."""
    # The search costs much time per byte, so its partitions must not be merged
    # for being small: with a number given they are kept.
    probes = strings.repartition(_search_tasks(strings.sparkSession)).select(
        "identifier", "bare", "grams", "n", "need", "marks",
        F.explode(F.slice("grams", F.lit(1), F.col("n") - F.col("need") + 1)).alias("gram"))
    # Spark takes the postings for as small as the names they are made of, and would
    # broadcast them: a row for every trigram, each with all of its name's.
    return probes.join(
        postings.hint("merge"), (probes.gram == postings.name_gram)
        & (postings.name_left >= probes.need)).where(_marks_fit())


def _candidates(strings: DataFrame, postings: DataFrame) -> DataFrame:
    """(identifier, bare, name_key, score) for all names that share at least
    `need` of the string's trigrams.

    A pair is emitted only at the first trigram it shares, so no pair is emitted
    twice and none is shuffled.
    """
    # Spark would put what is asked of the common ones before the marks.
    common = F.when(_marks_fit(), F.array_intersect("grams", "name_grams"))
    return (
        _meetings(strings, postings)
        .select("identifier", "bare", "n", "gram", "need", "name_key",
                F.size("name_grams").alias("name_n"), common.alias("common"))
        .where((F.size("common") >= F.col("need"))
               & (F.get("common", F.lit(0)) == F.col("gram")))
        .select("identifier", "bare", "name_key", _score(
            F.size("common"), F.col("n"), F.col("name_n")).alias("score"))
    )


def _score(shared: Column, n: Column, name_n: Column) -> Column:
    return shared / (n + F.lit(CHARGE) * (name_n - shared))


def _begins_alike(bare: Column, name: Column) -> Column:
    """Whether the first word of a name has a counterpart in a string: some word
    like it, or a first word that is like none of the name's, and so its form."""
    def alike(word: Column, text: Column) -> Column:
        # In an array, so that both are made once and not for every trigram.
        both = F.array(F.struct(
            F.concat(F.lit("^"), word, F.lit("$")).alias("word"),
            F.concat(F.lit("^"), F.replace(text, F.lit(" "), F.lit("$^")), F.lit("$"))
            .alias("words")))
        return F.exists(both, lambda x: F.exists(
            F.sequence(F.lit(1), F.length(x["word"]) - 2),
            lambda i: F.contains(x["words"], F.substring(x["word"], i, F.lit(3)))))
    first = [F.substring_index(text, " ", 1) for text in (bare, name)]
    return alike(first[1], bare) | ~alike(first[0], name)


def fuzzy_matches(identifiers: DataFrame, products: DataFrame,
                  threshold: float = THRESHOLD, gap: float = GAP) -> DataFrame:
    """(identifier, product_id, score) for the strings whose best product scores
    at least `threshold` and leads every other product by at least `gap`."""
    names = (
        products.select(skeleton(F.col("product_name")).alias("name_key"), "product_id")
        .where(F.length("name_key") > 0)
        .groupBy("name_key")
        .agg(F.min("product_id").alias("product_id"), F.count(F.lit(1)).alias("products"))
    )
    rarity = (
        names.select(F.explode(word_trigrams(F.col("name_key"))).alias("gram"))
        .groupBy("gram").agg(F.count(F.lit(1)).alias("names"))
    )
    postings = _postings(names, rarity)
    # Codes have no trigrams. As a filter, that rule would move down to the feed
    # and make it be read once more.
    words = F.when(~is_product_code(F.col("identifier")), skeleton(F.col("identifier")))
    strings = _ranked_grams(identifiers, "identifier", words, rarity)

    seeds = _candidates(strings.withColumn("need", _need(F.lit(SEED_SCORE))), postings)
    best_seed = seeds.groupBy("identifier").agg(F.max("score").alias("seed_score"))
    # Everything within `gap` of the best, or of the threshold, must be seen.
    floor = F.greatest(F.coalesce("seed_score", F.lit(threshold)), F.lit(threshold))
    searched = (
        strings.join(best_seed, "identifier", "left")
        .withColumn("need", _need(floor - gap))
    )
    scored = _candidates(searched, postings)
    order = Window.partitionBy("identifier").orderBy(F.desc("score"), F.asc("name_key"))
    top_two = (
        scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= 2)
    )
    best = top_two.groupBy("identifier").agg(
        F.max(F.when(F.col("place") == 1, F.col("name_key"))).alias("name_key"),
        F.max(F.when(F.col("place") == 1, F.col("bare"))).alias("bare"),
        F.max(F.when(F.col("place") == 1, F.col("score"))).alias("score"),
        F.max(F.when(F.col("place") == 2, F.col("score"))).alias("second"),
    )
    clear = (F.col("score") >= threshold) & (
        F.col("second").isNull() | (F.col("score") - F.col("second") >= gap - 1e-9))
    return (
        best.where(clear)
        .join(names.where(F.col("products") == 1), "name_key")
        .where(_begins_alike(F.col("bare"), F.col("name_key")))
        .select("identifier", "product_id", "score")
    )


def scorer_matches(residue: DataFrame, products: DataFrame, scorer: Scorer) -> DataFrame:
    """Let a user function resolve what the rules left over.

    `scorer` gets batches with a column `identifier` and yields batches with
    `identifier, product_id, score`. Answers outside the catalog, and all but
    the best per string, are discarded.
    """
    answers = residue.select("identifier").mapInPandas(
        scorer, "identifier string, product_id string, score double")
    return (
        answers.join(products.select("product_id").distinct(), "product_id", "left_semi")
        .groupBy("identifier")
        .agg(F.max_by("product_id", F.struct("score", "product_id")).alias("product_id"),
             F.max("score").alias("score"))
    )


def resolve_products(identifiers: DataFrame, products: DataFrame,
                     aliases: DataFrame | None = None,
                     scorer: Scorer | None = None,
                     threshold: float = THRESHOLD, gap: float = GAP) -> DataFrame:
    """(identifier, product_id, method, score) for every given identifier;
    product_id is UNKNOWN, and method null, where nothing matched."""
    ruled = rule_matches(identifiers, products, aliases)
    residue = ruled.where(F.col("product_id").isNull()).select("identifier")
    fuzzy = fuzzy_matches(residue, products, threshold, gap).withColumn("method", F.lit("fuzzy"))
    if scorer is not None:
        left = residue.join(fuzzy, "identifier", "left_anti")
        fuzzy = fuzzy.unionByName(
            scorer_matches(left, products, scorer).withColumn("method", F.lit("scorer")))
    late = fuzzy.select("identifier", F.col("product_id").alias("late_id"),
                        F.col("method").alias("late_method"), F.col("score").alias("late_score"))
    return ruled.join(late, "identifier", "left").select(
        "identifier",
        F.coalesce("product_id", "late_id", F.lit(UNKNOWN)).alias("product_id"),
        F.coalesce("method", "late_method").alias("method"),
        F.when(F.col("method").isNotNull(), F.lit(1.0)).otherwise(F.col("late_score"))
        .alias("score"),
    )


def drop_unknown(resolution: DataFrame) -> DataFrame:
    """The identifiers that got a product."""
    return resolution.where(F.col("product_id") != UNKNOWN)


def current_aliases(history: DataFrame) -> DataFrame:
    """(identifier, product_id): the last version of each identifier's alias. An
    alias without a product is retired; products that one version has for the
    same identifier contradict each other, and it has none."""
    versions = history.groupBy("identifier", F.coalesce("version", F.lit(0)).alias("version")).agg(
        F.min("product_id").alias("product_id"), F.max("product_id").alias("other_id"),
        F.count_if(F.col("product_id").isNull()).alias("retired"))
    last = versions.groupBy("identifier").agg(F.max_by(
        F.struct("product_id", "other_id", "retired"), "version").alias("last"))
    return last.where(
        (F.col("last.retired") == 0) & (F.col("last.product_id") == F.col("last.other_id"))
    ).select("identifier", "last.product_id")


def save_aliases(resolution: DataFrame, path: str) -> None:
    """Append newly resolved strings to the alias table at `path`, so that later
    runs resolve them by lookup. A string that the table has or had is left as
    it is: only `correct_aliases` changes one."""
    spark = resolution.sparkSession
    learned = drop_unknown(resolution).where(F.col("method") != "alias") \
        .select("identifier", "product_id")
    history = alias_history(spark, path)
    _append_version(learned.join(history, "identifier", "left_anti"), history, path)


def correct_aliases(corrections: DataFrame, path: str) -> None:
    """Append (identifier, product_id) as the next version of these aliases: the
    last writer wins, and a null product retires an alias. Earlier versions stay."""
    history = alias_history(corrections.sparkSession, path)
    _append_version(corrections.select("identifier", "product_id"), history, path)


def _append_version(rows: DataFrame, history: DataFrame, path: str) -> None:
    last = history.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
    rows.withColumn("version", F.lit(last + 1).cast("bigint")).write.mode("append").parquet(path)


def alias_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions of all aliases, empty before the first run."""
    try:
        return spark.read.schema(schemas.ALIAS_HISTORY).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.ALIAS_HISTORY)


def load_aliases(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The aliases that count now, or those that did after a version."""
    history = alias_history(spark, path)
    if version is not None:
        history = history.where(F.coalesce("version", F.lit(0)) <= version)
    return current_aliases(history)
