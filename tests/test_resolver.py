import pytest
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.functions.text import plain_name, skeleton, word_trigrams
from shelfline.operators import resolver

# A grocery catalog, and what registers made of eight of its names.
CATALOG = [
    ("01", "Oreo Original 14.3oz"), ("02", "Oreo Double Stuf 14.3oz"),
    ("03", "Chips Ahoy Original 13oz"), ("04", "Keebler Chips Deluxe 11.3oz"),
    ("05", "Great Value Chocolate Chip 18oz"), ("06", "Lays Classic 8oz"),
    ("07", "Doritos Nacho Cheese 9.25oz"), ("08", "Ruffles Original 8oz"),
    ("09", "Cheetos Crunchy 8.5oz"), ("10", "Tostitos Scoops 10oz"),
    ("11", "Coca-Cola 12pk"), ("12", "Diet Coke 12pk"), ("13", "Sprite 2L"),
    ("14", "Dasani Water 24pk"), ("15", "Minute Maid OJ 59oz"),
    ("16", "Great Value Whole Milk 1gal"), ("17", "Great Value 2% Milk 1gal"),
    ("18", "Horizon Organic Milk 64oz"), ("19", "Yoplait Strawberry 6oz"),
    ("20", "Chobani Greek Vanilla 5.3oz"),
]
ENTRIES = {
    "GV WHL MLK 1GL": "16", "GV 2% MLK 1GL": "17", "OREO CKE 14OZ": "01", "COKE 12PK": "11",
    "LAYS CLSSC 8OZ": "06", "DORITOS NCHO 9Z": "07", "CHPS AHOY 13": "03", "SPRITE 2L": "13",
}


def _catalog(spark, rows):
    return spark.createDataFrame(rows, "product_id string, product_name string")


def _ids(spark, strings):
    return spark.createDataFrame([(s,) for s in strings], "identifier string")


@pytest.fixture(scope="module")
def catalog(spark):
    return _catalog(spark, CATALOG)


def _resolve(spark, strings, catalog, **options):
    df = resolver.resolve_products(_ids(spark, strings), catalog, **options)
    return {r.identifier: r for r in df.collect()}


def test_known_register_entries(spark, catalog):
    got = _resolve(spark, ENTRIES, catalog)
    right = {s for s in ENTRIES if got[s].product_id == ENTRIES[s]}
    assert right == set(ENTRIES) - {"OREO CKE 14OZ", "COKE 12PK"}
    assert all(got[s].product_id == resolver.UNKNOWN for s in set(ENTRIES) - right)
    # Too close to call, so dropped.
    assert got["OREO CKE 14OZ"].product_id == resolver.UNKNOWN
    # Every part of "COKE 12PK" is in "Diet Coke 12pk", but it starts with the second word.
    assert got["COKE 12PK"].product_id == resolver.UNKNOWN
    assert got["SPRITE 2L"].method == "exact_name"
    assert got["LAYS CLSSC 8OZ"].method == "skeleton"


def test_wrong_first_letters_and_lost_words(spark, catalog):
    entries = {"ZHPS AHOY 13": "03", "XORITOS NCHO CHEESE": "07", "BUFFLES ORGNL 8OZ": "08",
               "HORIZON MILK 64OZ": "18", "CHOBANI GREEK 5.3OZ": "20"}
    got = _resolve(spark, [*entries, "VALUE WHL MLK 1GL", "ORGANIC MILK 64OZ"], catalog)
    assert {s: got[s].product_id for s in entries} == entries
    # These may well be other products.
    assert got["VALUE WHL MLK 1GL"].product_id == resolver.UNKNOWN
    assert got["ORGANIC MILK 64OZ"].product_id == resolver.UNKNOWN


def test_words_only_the_name_has_count_against_it(spark):
    names = _catalog(spark, [("1", "Red Lamp"), ("2", "Red Lamp Shade Holder Brass")])
    got = _resolve(spark, ["RED LAMPS"], names)
    assert got["RED LAMPS"].product_id == "1"


def test_alias_corrects_a_mistake(spark, catalog):
    aliases = spark.createDataFrame(
        [("COKE 12PK", "11"), ("SPRITE 2L", "99")], schemas.ALIASES)
    got = _resolve(spark, ENTRIES, catalog, aliases=aliases)
    assert (got["COKE 12PK"].product_id, got["COKE 12PK"].method) == ("11", "alias")
    # An alias to a product that is not in the catalog is no alias.
    assert (got["SPRITE 2L"].product_id, got["SPRITE 2L"].method) == ("13", "exact_name")


def test_codes_and_junk_stay_unknown(spark, catalog):
    got = _resolve(spark, ["049000028911", "", "!!!", "QWXZ", "aeiou"], catalog)
    assert {r.product_id for r in got.values()} == {resolver.UNKNOWN}


def test_equal_names_are_ambiguous(spark):
    twice = _catalog(spark, [("1", "Red Soap"), ("2", "RED soap!"), ("3", "Blue Soap 2kg")])
    got = _resolve(spark, ["red soap", "RD SP", "BLE SP 2K"], twice)
    assert got["red soap"].product_id == resolver.UNKNOWN
    assert got["RD SP"].product_id == resolver.UNKNOWN
    assert got["BLE SP 2K"].product_id == "3"


def test_scorer_sees_only_the_rest_and_is_checked(spark, catalog):
    def scorer(batches):
        for batch in batches:
            assert "SPRITE 2L" not in set(batch["identifier"])
            answer = {"OREO CKE 14OZ": "01", "QWXZ": "made up"}
            yield batch.assign(
                product_id=batch["identifier"].map(answer), score=0.7)
    got = _resolve(spark, [*ENTRIES, "QWXZ"], catalog, scorer=scorer)
    assert (got["OREO CKE 14OZ"].product_id, got["OREO CKE 14OZ"].method) == ("01", "scorer")
    assert got["QWXZ"].product_id == resolver.UNKNOWN


def _brute_force(spark, strings, catalog, threshold, gap):
    """Scores of all pairs, without any index."""
    ids = _ids(spark, strings).select(
        "identifier", skeleton(F.col("identifier")).alias("bare"),
        word_trigrams(skeleton(F.col("identifier"))).alias("grams")) \
        .where(F.size("grams") > 0)
    names = catalog.select(skeleton(F.col("product_name")).alias("name"), "product_id") \
        .groupBy("name").agg(F.min("product_id").alias("product_id"), F.count("*").alias("n")) \
        .withColumn("name_grams", word_trigrams(F.col("name"))).collect()
    out = {}
    for row in ids.collect():
        grams = set(row.grams)
        scored = sorted(
            ((len(grams & set(n.name_grams)) / (len(grams) + 0.2 * len(set(n.name_grams) - grams)), n)
             for n in names), key=lambda s: (-s[0], s[1].name))
        (best, name), second = scored[0], scored[1][0]
        alike = lambda word, text: any(
            f"^{word}$"[i:i + 3] in f"^{w}$" for i in range(len(word)) for w in text.split())
        begins = alike(name.name.split()[0], row.bare) or not alike(row.bare.split()[0], name.name)
        if best >= threshold and best - second >= gap - 1e-9 and name.n == 1 and begins:
            out[row.identifier] = (name.product_id, round(best, 9))
    return out


@pytest.mark.parametrize("threshold, gap", [(0.5, 0.1), (0.3, 0.05), (0.8, 0.06)])
def test_index_search_equals_comparing_everything(spark, threshold, gap):
    colours = ["small red", "large red", "green", "dark green", "shiny blue", "pale blue"]
    things = ["ring", "ringlet", "bolt", "bolts and nuts", "gear box", "lamp", "lampshade"]
    names = [(f"{i:04d}", f"{c} {t} {size}cm") for i, (c, t, size) in enumerate(
        (c, t, s) for c in colours for t in things for s in (5, 15, 25, 125))]
    strings = ([n.upper()[:len(n) - k] for _, n in names for k in (1, 3, 6)]
               + [n[2:] for _, n in names] + ["x" + n[1:] for _, n in names]
               + [n.split(" ", 1)[1] for _, n in names] + [n.replace(" ", "")[:9] for _, n in names]
               + ["ring", "blue", "cm", "zzz", "25cm bolt"])
    strings = sorted(set(strings))
    catalog = _catalog(spark, names)
    got = {r.identifier: (r.product_id, round(r.score, 9)) for r in resolver.fuzzy_matches(
        _ids(spark, strings), catalog, threshold, gap).collect()}
    expected = _brute_force(spark, strings, catalog, threshold, gap)
    assert got == expected
    assert len(got) > 50


def test_text_helpers(spark):
    row = spark.createDataFrame([("  Coca-Cola, 12pk! ",)], "t string").select(
        plain_name(F.col("t")).alias("plain"), skeleton(F.col("t")).alias("bare"),
        word_trigrams(F.lit("ab c")).alias("grams")).first()
    assert (row.plain, row.bare) == ("coca cola 12pk", "cc cl 12pk")
    def packed(gram):
        a, b, c = map(ord, gram)
        return (a << 42) + (b << 21) + c
    assert row.grams == [packed("^ab"), packed("ab$"), packed("^c$")]
    wide = spark.range(1).select(word_trigrams(F.lit("\u00fcber \U00020000x")).alias("g")).first().g
    assert wide == [packed(g) for g in
                    ("^\u00fcb", "\u00fcbe", "ber", "er$", "^\U00020000x", "\U00020000x$")]


def test_alias_table_grows_once(spark, catalog, tmp_path):
    path = str(tmp_path / "product_alias")
    assert resolver.load_aliases(spark, path).count() == 0
    resolution = resolver.resolve_products(_ids(spark, ENTRIES), catalog)
    resolver.save_aliases(resolution, path)
    resolver.save_aliases(resolution, path)
    known = resolver.load_aliases(spark, path)
    assert known.count() == 6
    again = resolver.resolve_products(_ids(spark, ENTRIES), catalog, aliases=known)
    assert {r.method for r in again.collect()} == {"alias", None}


def test_aliases_are_corrected_and_retired(spark, catalog, tmp_path):
    path = str(tmp_path / "product_alias")
    def write(*rows):
        resolver.correct_aliases(spark.createDataFrame(rows, schemas.ALIASES), path)
    def now(version=None):
        return {r.identifier: r.product_id
                for r in resolver.load_aliases(spark, path, version).collect()}
    write(("a", "01"), ("b", "02"), ("c", "03"))
    write(("a", "04"), ("b", None))                       # one corrected, one retired
    write(("c", "05"), ("c", "06"), ("d", "07"), ("d", "07"))
    assert now() == {"a": "04", "d": "07"}                # the writer of c contradicts itself
    assert now(1) == {"a": "01", "b": "02", "c": "03"} and now(2) == {"a": "04", "c": "03"}
    write(("c", "08"), ("b", "09"))
    assert now() == {"a": "04", "b": "09", "c": "08", "d": "07"}
    # What was retired or corrected by hand is not learned again.
    write(("a", None))
    resolver.save_aliases(spark.createDataFrame(
        [("a", "01", "fuzzy", 0.9), ("e", "10", "fuzzy", 0.9), ("f", "11", "alias", 1.0),
         ("g", resolver.UNKNOWN, None, None)],
        "identifier string, product_id string, method string, score double"), path)
    assert now() == {"b": "09", "c": "08", "d": "07", "e": "10"}


def test_an_alias_table_without_versions_is_read(spark, tmp_path):
    path = str(tmp_path / "product_alias")
    spark.createDataFrame([("a", "01")], schemas.ALIASES).write.parquet(path)
    resolver.correct_aliases(spark.createDataFrame([("b", "02")], schemas.ALIASES), path)
    resolver.correct_aliases(spark.createDataFrame([("a", "03")], schemas.ALIASES), path)
    assert {r.identifier: r.product_id for r in resolver.load_aliases(spark, path).collect()} \
        == {"a": "03", "b": "02"}


def test_names_that_differ_by_a_number_are_seldom_compared(spark):
    """Pairs that meet in a trigram of the number are told apart by their marks, and
    every pair with enough trigrams in common is still found."""
    names = _catalog(spark, [(str(i), f"{c} ring #{i}") for i in range(1000, 2500)
                             for c in ("large", "cold")]).select(
        skeleton(F.col("product_name")).alias("name_key"), "product_id")
    rarity = names.select(F.explode(word_trigrams(F.col("name_key"))).alias("gram")) \
        .groupBy("gram").agg(F.count("*").alias("names"))
    postings = resolver._postings(names, rarity).cache()
    ids = _ids(spark, [f"LARG RNGG #{i}" for i in range(1000, 2500, 15)])
    strings = resolver._ranked_grams(
        ids, "identifier", skeleton(F.col("identifier")), rarity).withColumn(
        "need", resolver._need(F.lit(0.7))).cache()
    met = strings.select("need", F.explode(F.expr("slice(grams, 1, n - need + 1)")).alias("g")) \
        .join(postings, (F.col("g") == F.col("name_gram")) & (F.col("name_left") >= F.col("need")))
    assert resolver._meetings(strings, postings).count() < 0.2 * met.count()
    grams = {r.name_key: set(r.name_grams) for r in postings.collect()}
    right = {(s.identifier, name) for s in strings.collect() for name, has in grams.items()
             if len(has & set(s.grams)) >= s.need}
    found = [(r.identifier, r.name_key) for r in resolver._candidates(strings, postings).collect()]
    assert len(found) == len(right) > 0 and set(found) == right
