"""Personal data: fixed patterns, and terms that give protected values away.

The patterns find the protected values. How strongly a term reveals a value is
estimated from their co-occurrence in the corpus: the pointwise mutual information
as a share of the value's own information, log2(N / n), which is what removing
the value should protect. Terms of a document that holds a value and whose share reaches
a threshold are removed from it; beyond a lower threshold they are
generalised. All is DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm import common

# The patterns are those of the contract. Possessive repeats change no match, since
# what follows a repeat never is in its class; a start must not lie within a run that
# has failed already. Both keep the time linear on very long runs.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
# Terms are words of so many letters. What fewer than SUPPORT rows show counts less.
LETTERS = 3
SUPPORT, GENERALISE, REMOVE = 3, 0.8, 0.9
# Matches whose places are found together.
STRETCH = 64
SPAN = "struct<kind:int,s:bigint,e:bigint,value:string>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits from the right, every second doubled, sum to tens."""
    def add(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substring(F.reverse(digits), i, 1)) - 48
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        # Leading zeros aside, more than three digits are more than 255.
        part = lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "")
        return F.forall(F.split(value, r"\."), lambda x: (F.length(part(x)) <= 3)
                        & (F.lpad(part(x), 3, "0") <= "255"))
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _keeps(kind: str) -> Callable[[Column], Column]:
    return lambda span: _valid(kind, span["value"])


def _spans(text: Column, pattern: Column, number: int) -> Column:
    """Matches of a pattern with their places, from the gaps between them."""
    # Bound once: what a lambda names is computed again for each of its elements.
    searched = F.struct(F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"),
                        F.split(text, pattern, -1).alias("gaps"))
    return F.get(F.transform(F.array(searched), lambda x: _placed(x["found"], x["gaps"], number)),
                 F.lit(0))


def _placed(found: Column, gaps: Column, number: int) -> Column:
    """Spans from running sums of lengths, by stretches of matches: the places of
    the stretches first, then those in each. Every step copies what a stretch has
    so far, and never the spans of the whole text."""
    def length(i: Column) -> Column:
        return F.length(F.get(gaps, i)) + F.length(F.get(found, i))

    def numbers(stretch: Column) -> Column:
        low, high = stretch * STRETCH, F.least((stretch + 1) * STRETCH, F.size(found))
        return F.filter(F.sequence(low, high), lambda i: i < high)

    def begin(starts: Column, stretch: Column) -> Column:
        end = F.aggregate(numbers(stretch), F.element_at(starts, -1),
                          lambda at, i: at + length(i))
        return F.concat(starts, F.array(end))

    def spans_of(at: Column, stretch: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            first = state["at"] + F.length(F.get(gaps, i))
            end = first + F.length(F.get(found, i))
            span = F.struct(F.lit(number).alias("kind"), first.alias("s"), end.alias("e"),
                            F.get(found, i).alias("value"))
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))
        start = F.struct(at.alias("at"), F.expr(f"cast(array() as array<{SPAN}>)").alias("out"))
        return F.aggregate(numbers(stretch), start, step, lambda state: state["out"])

    count = F.ceil(F.size(found) / STRETCH).cast("int")
    stretches = F.filter(F.sequence(F.lit(0), count), lambda k: k < count)
    starts = F.aggregate(stretches, F.array(F.lit(0).cast("long")), begin)
    return F.flatten(F.zip_with(F.slice(starts, 1, count), stretches, spans_of))


def with_base_spans(docs: DataFrame) -> DataFrame:
    """Adds `base`: the valid matches in `text`, in the order of the kinds."""
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        # A text without the sign that every match has need not be searched.
        sign = {"email": F.col("text").contains("@"), "phone": F.col("text").contains("+"),
                "ip": F.col("text").rlike(r"[0-9]\.[0-9]"),
                "card": F.col("text").rlike(r"[0-9][\x20-]?[0-9]")}[kind]
        valid = F.filter(_spans(F.col("text"), F.lit(pattern), number), _keeps(kind))
        docs = docs.withColumn(f"_{kind}", F.when(sign, valid).otherwise(none))
    return docs.withColumn("base", F.concat(*(f"_{k}" for k in KINDS))).drop(
        *(f"_{k}" for k in KINDS))


def _terms_of(text: Column) -> Column:
    """The different words of letters in a text, in lower case."""
    return F.array_distinct(F.regexp_extract_all(
        F.lower(text), F.lit(rf"\p{{L}}{{{LETTERS},}}+"), F.lit(0)))


def disclosing_terms(docs: DataFrame, found: DataFrame, support: int = 1,
                     least: float = GENERALISE) -> DataFrame:
    """Rows (text_key, term, share) of the terms of a text that reveal a value in it,
    with the largest share if they reveal several.

    `docs` has the rows (id, text) of the corpus, `found` those of them with a
    span, with `text_key` and `base`. Every row is a context: n of a value, of a term,
    and of both count rows, over the whole corpus, and every term of a row that
    holds a value is a candidate. The pair must have `support` rows; with fewer than
    SUPPORT, one more row is assumed to have the term without the value. A term has
    a share of `least` only if n_term <= n_rows**(1 - least) * n_value**least, since
    n_both <= n_value, so pairs beyond that are not counted.
    """
    n_rows = docs.count()
    # The margin is for rounding alone; the share itself decides in the end.
    bound = f"pow({max(n_rows, 1)}D, {1 - least}D) * pow(n_value, {least}D) * (1 + 1e-9D)"
    valued = common.stash(found.select("text_key", F.explode(F.array_distinct(F.transform(
        "base", lambda x: F.xxhash64(x["kind"], F.lower(x["value"]))))).alias("value_key"))
        .groupBy("text_key", "value_key").agg(F.count(F.lit(1)).alias("copies")))
    values = common.stash(valued.groupBy("value_key").agg(F.sum("copies").alias("n_value"))
                          .where(f"n_value < {n_rows}"))
    highest = values.agg(F.coalesce(F.max("n_value"), F.lit(0)).alias("n_value")).selectExpr(
        f"{bound} AS highest")
    terms = docs.select(F.explode(_terms_of(F.col("text"))).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n_term")).join(F.broadcast(highest)).where(
        "n_term <= highest").drop("highest")
    worded = found.select("text_key", F.explode(_terms_of(F.col("text"))).alias("term")).distinct()
    known = common.stash(worded.join(terms, "term"))
    pairs = common.stash(known.join(
        valued.join(common.broadcast_if_small(values), "value_key"), "text_key").where(
        f"n_term <= {bound}"))
    shared = pairs.groupBy("value_key", "term").agg(
        F.sum("copies").alias("n_both"), F.first("n_value").alias("n_value"),
        F.first("n_term").alias("n_term")).where(F.col("n_both") >= support)
    seen = F.col("n_term") + F.when(F.col("n_both") < SUPPORT, 1).otherwise(0)
    information = F.log2(F.lit(n_rows) / F.col("n_value"))
    mutual = F.log2(F.col("n_both") * F.lit(n_rows) / (F.col("n_value") * seen))
    shares = shared.withColumn("share", F.least(F.lit(1.0), mutual / information)).where(
        F.col("share") >= least).select("value_key", "term", "share")
    return pairs.select("text_key", "value_key", "term").join(
        shares, ["value_key", "term"]).groupBy("text_key", "term").agg(
        F.max("share").alias("share"))


def sanitise(docs: DataFrame, support: int = 1, generalise: float = GENERALISE,
             remove: float = REMOVE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of `docs`: doc_id, `spans` (kind, s, e, value; code points,
    the end exclusive; the kinds in order, then the terms, each by place) and
    `sanitised`, the text with each base span replaced by its kind in brackets,
    each term that reveals a value of this text strongly removed and each that
    does so less strongly replaced by "[term]". Term spans have kind 4, or 5 if
    generalised, and never touch a base span.

    A null text is an empty one. Equal rows are contexts of their own and get
    equal results; ties cannot arise, since spans of a kind don't overlap; where
    base spans of different kinds do, the text of both goes. Null ids are allowed.
    Texts are read whole; other columns are not read. An empty table gives an
    empty result.
    """
    common.prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = with_base_spans(rows).withColumn("text_key", F.xxhash64("text"))
    private = found.where("size(base) > 0")
    terms = disclosing_terms(rows, private, support, generalise)
    listed = common.stash(terms.groupBy("text_key").agg(
        F.sort_array(F.collect_list(F.struct("term", "share"))).alias("terms"))
        .withColumnRenamed("text_key", "of_text").withColumn("strong", F.expr(
            f"transform(filter(terms, t -> t.share >= {remove}D), t -> t.term)")))
    joined = private.join(listed, F.col("text_key") == F.col("of_text"), "left")
    # Terms have letters only, so they can be put into a pattern as they are.
    any_term = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("terms.term", "|"),
                        F.lit(r")(?!\p{L})"))
    share = F.transform("at_terms", lambda x: F.struct(
        F.when(F.array_contains("strong", F.lower(x["value"])), 4).otherwise(5).alias("kind"),
        x["s"].alias("s"), x["e"].alias("e"), x["value"].alias("value")))
    clear = F.filter(share, lambda x: ~F.exists(
        "base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    marked = joined.withColumn(
        "at_terms", F.when(F.col("terms").isNotNull(), _spans(F.col("text"), any_term, 4))
        .otherwise(F.expr(f"cast(array() as array<{SPAN}>)")))
    marked = marked.withColumn("spans", F.concat("base", clear)).withColumn(
        "by_place", F.array_sort("spans", lambda a, b: F.when(a["s"] < b["s"], -1).when(
            a["s"] > b["s"], 1).otherwise(b["e"].cast("int") - a["e"].cast("int"))))
    names = F.array(*(F.lit(f"[{k}]") for k in KINDS), F.lit(""), F.lit("[term]"))
    start = F.struct(F.lit(0).cast("long").alias("at"),
                     F.expr("cast(array() as array<string>)").alias("parts"))

    def step(state: Column, x: Column) -> Column:
        """Text up to a span and its name; a span inside the last adds nothing."""
        between = F.substring(F.col("text"), state["at"].cast("int") + 1,
                              F.greatest(F.lit(0), (x["s"] - state["at"]).cast("int")))
        name = F.when(x["s"] >= state["at"], F.get(names, x["kind"])).otherwise("")
        return F.struct(F.greatest(state["at"], x["e"]).alias("at"),
                        F.concat(state["parts"], F.array(between, name)).alias("parts"))
    whole = F.aggregate("by_place", start, step, lambda state: F.concat(
        F.array_join(state["parts"], ""),
        F.substring(F.col("text"), state["at"].cast("int") + 1, F.length("text"))))
    with_spans = marked.select(F.col("id").alias("doc_id"), "spans", whole.alias("sanitised"))
    rest = found.where("size(base) = 0").select(
        F.col("id").alias("doc_id"), F.col("base").alias("spans"), F.col("text").alias("sanitised"))
    return rest.unionByName(with_spans)


def as_text(spans: Column, names: list[str]) -> Column:
    """kind:start:end by kind and start, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(F.array(*map(F.lit, names)), x["kind"]), x["s"].cast("string"),
        x["e"].cast("string"))), ",")
