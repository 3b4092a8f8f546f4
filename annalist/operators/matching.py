"""Matches of records: names within some edits without a lost pair, and cascades of exact, near and fuzzy stages."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.sources.scratch import materialize

#: Letters in a gram.
GRAM = 2
#: Names up to so long, and with up to so many forms, meet by these forms.
MOST_LETTERS, MOST_FORMS = 64, 300


def _grams(name: Column, most: int) -> Column:
    """The grams of a name with their places; the ends are padded, so each letter is in ``GRAM`` of them."""
    padded = F.concat(F.lit("\x02" * (GRAM - 1)), name, F.lit("\x03" * (GRAM - 1)))
    return F.transform(F.sequence(F.lit(1), F.length(name) + GRAM - 1), lambda n: F.struct(F.substring(padded, n, F.lit(GRAM)).alias("gram"), n.alias("at")))


def _prefixes(names: DataFrame, grams: DataFrame, most: int) -> DataFrame:
    """``name, n, gram, at``: the ``most * GRAM + 1`` rarest grams of each name."""
    ranked = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("often"))
    own = names.select("name", F.inline(_grams(F.col("name"), most))).join(materialize(ranked, "grams"), "gram")
    kept = own.groupBy("name").agg(F.slice(F.array_sort(F.collect_list(F.struct("often", "gram", "at"))), 1, most * GRAM + 1).alias("kept"))
    return kept.select("name", F.length("name").alias("n"), F.inline("kept")).drop("often")


def _forms(names: DataFrame, most: int) -> DataFrame:
    """``name, form, blank, gone, other``: each name with up to ``most`` of its letters blanked or taken out.

    ``blank`` and ``gone`` say how many, ``other`` how many the name that it meets may lack.
    """
    at = lambda f, n, c: F.concat(F.substring(f, F.lit(1), n - 1), F.lit(c), F.substring(f, n + 1, F.length(f)))
    made = lambda form, blank, gone: F.struct(form.alias("form"), blank.alias("blank"), gone.alias("gone"))
    forms = last = F.array(made(F.col("name"), F.lit(0), F.lit(0)))
    places = lambda f: F.when(F.length(f["form"]) > 0, F.sequence(F.lit(1), F.length(f["form"]))).otherwise(F.array().cast("array<int>"))
    blanked = lambda f: F.transform(places(f), lambda n: made(at(f["form"], n, "\x01"), f["blank"] + 1, f["gone"]))
    shortened = lambda f: F.transform(places(f), lambda n: made(at(f["form"], n, ""), f["blank"], f["gone"] + 1))
    for _ in range(most):
        blanks, shorter = F.flatten(F.transform(last, blanked)), F.flatten(F.transform(last, shortened))
        last = F.array_distinct(F.concat(blanks, shorter))
        forms = F.concat(forms, last)
    return names.select("name", F.inline(forms)).select("*", F.explode(F.sequence(F.lit(0), most - F.col("blank") - F.col("gone"))).alias("other"))


def near_names(left: DataFrame, right: DataFrame, most: int = 2) -> DataFrame:
    """``left_name, right_name, distance``: all pairs of the names in ``name`` within ``most`` edits.

    No pair is lost. Names that are not too long meet where they have the same form: letters that
    differ are blank in both, and what one has more is taken out of it; so hardly any but near
    names meet, however alike all names are. An edit spoils ``GRAM`` grams at most, so
    of the rarest ``most * GRAM + 1`` grams of two longer names one is common, at places that
    differ by ``most`` at most; of these only names that share such a gram and nearly the length
    are compared. Names are compared once each; null and repeated names add nothing. Very many
    names that are all near each other have as many pairs.
    """
    forms = lambda n: sum(comb(n, k) * 2**k for k in range(most + 1))
    short = max(n for n in range(MOST_LETTERS + 1) if n <= (most - 1) * GRAM + 1 or forms(n) <= MOST_FORMS)
    named = lambda df: materialize(df.select(F.col("name").cast("string").alias("name")).where("name is not null").distinct(), "names")
    ours = named(left)
    theirs = ours if left is right else named(right)
    # rows are short and their pairs many, so tasks aren't merged by the size of what they read
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near_short, key = F.length("name") <= short + most, ["form", "blank", "gone", "other"]
    c = _forms(ours.where(near_short), most).repartition(tasks, *key)
    d = _forms(theirs.where(near_short), most).select(F.col("name").alias("right"), "form", "blank", F.col("other").alias("gone"), F.col("gone").alias("other")).repartition(tasks, *key)
    # a name meets itself in other forms too
    met = c.join(d, key).where((F.least(F.length("name"), F.length("right")) <= short) & ((F.col("name") != F.col("right")) | (F.col("blank") + F.col("gone") + F.col("other") == 0)))
    short_pairs = _within(met.select("name", F.col("right").alias("other")), most)
    if most > 1:  # names one edit apart share exactly one form
        short_pairs = short_pairs.distinct()
    all_ = ours.union(theirs).where(F.length("name") > short).select("name", F.inline(_grams(F.col("name"), most)))
    lengths = F.explode(F.sequence(F.col("n") - most, F.col("n") + most)).alias("n")
    a = _prefixes(ours.where(F.length("name") > short), all_, most)
    b = _prefixes(theirs.where(F.length("name") > short), all_, most).select(F.col("name").alias("other"), "gram", F.col("at").alias("other_at"), lengths)
    long_pairs = a.repartition(tasks, "gram", "n").join(b.repartition(tasks, "gram", "n"), ["gram", "n"]).where(F.abs(F.col("at") - F.col("other_at")) <= most).select("name", "other").distinct()
    return short_pairs.union(_within(long_pairs, most))


def _within(pairs: DataFrame, most: int) -> DataFrame:
    """``left_name, right_name, distance`` of the pairs ``name, other`` within ``most`` edits."""
    return pairs.select(F.col("name").alias("left_name"), F.col("other").alias("right_name"), F.levenshtein("name", "other", most).alias("distance")).where("distance >= 0")


@dataclass(frozen=True)
class Stage:
    """One stage of a cascade: equal ``keys``, and beside them ``near`` within ``within`` of each other, or ``name`` within ``edits``.

    Only a stage of equal keys that is ``sure`` may merge on its own.
    """

    rule: str
    keys: tuple[str, ...] = ()
    near: str | None = None
    within: float = 0
    name: str | None = None
    edits: int = 0
    sure: bool = True


def _candidates(rest: DataFrame, right: DataFrame, stage: Stage, left_id: str, right_id: str) -> DataFrame:
    """``left_id, right_id, distance`` of one stage; the nearest, then the least id."""
    filled = [c for c in (*stage.keys, stage.near, stage.name) if c is not None]
    has = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in filled])
    ours, theirs = rest.where(has), right.where(has)
    if stage.name is not None:
        pairs = near_names(ours.select(F.col(stage.name).alias("name")), theirs.select(F.col(stage.name).alias("name")), stage.edits)
        named = ours.select(left_id, *stage.keys, F.col(stage.name).alias("left_name")).join(pairs, "left_name")
        # of equal keys and names the least id is as good as any
        best = theirs.groupBy(*stage.keys, F.col(stage.name).alias("right_name")).agg(F.min(right_id).alias(right_id))
        found = named.join(best, [*stage.keys, "right_name"])
    elif stage.near is not None:
        band = lambda c: F.floor(F.col(c) / F.lit(float(stage.within))) if stage.within else F.col(c)
        bands = F.explode(F.array(*[band(stage.near) + n for n in (-1, 0, 1)])) if stage.within else band(stage.near)
        block = [*stage.keys, "_band"]
        one = ours.select(*stage.keys, F.col(stage.near).alias("_l"), band(stage.near).alias("_band"), F.struct(F.col(left_id)).alias("_own"))
        two = theirs.groupBy(*stage.keys, F.col(stage.near)).agg(F.min(right_id).alias(right_id)).select(*stage.keys, F.col(stage.near).alias("_l"), bands.alias("_band"), F.struct(F.col(stage.near).alias("_r"), right_id).alias("_other"))
        # of one block only the next values below and above can be nearest, so its rows don't meet in pairs
        tasks = int(rest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        both = one.unionByName(two, allowMissingColumns=True).repartition(tasks, *block)
        first = F.col("_own").isNotNull()
        next_ = lambda order: F.last("_other", ignorenulls=True).over(Window.partitionBy(*block).orderBy(order, first).rowsBetween(Window.unboundedPreceding, 0))
        beside = both.select("_own", "_l", F.array_compact(F.array(next_(F.asc("_l")), next_(F.desc("_l")))).alias("_near")).where(first)
        found = beside.select(f"_own.{left_id}", "_l", F.inline("_near")).withColumn("distance", F.abs(F.col("_l") - F.col("_r"))).where(F.col("distance") <= stage.within)
    else:
        best = theirs.groupBy(*stage.keys).agg(F.min(right_id).alias(right_id))
        found = ours.join(best, list(stage.keys)).withColumn("distance", F.lit(0))
    nearest = found.groupBy(left_id).agg(F.min(F.struct(F.col("distance").cast("double").alias("distance"), right_id)).alias("b"))
    return nearest.select(left_id, F.col(f"b.{right_id}").alias(right_id), "b.distance")


def cascade(left: DataFrame, right: DataFrame, stages: list[Stage], left_id: str, right_id: str) -> DataFrame:
    """``left_id, right_id, rule, distance, sure``: stages in turn, each on what the earlier ones left unmatched.

    Null keys match nothing; without a match there is no row. A key that very many rows share
    meets one row of the other side for each different value compared.
    """
    found, rest = None, left
    for stage in stages:
        hit = materialize(_candidates(rest, right, stage, left_id, right_id), "matches")
        told = hit.select(left_id, right_id, F.lit(stage.rule).alias("rule"), "distance", F.lit(stage.sure and stage.near is None and stage.name is None).alias("sure"))
        found = told if found is None else found.union(told)
        rest = rest.join(hit.select(left_id), left_id, "left_anti")
    return found


#: The stages of products and of vehicles.
PRODUCTS = [Stage("gtin", ("gtin",)), Stage("brand_mpn", ("brand", "mpn")), Stage("fuzzy_name", ("brand",), name="title", edits=2)]
VEHICLES = [Stage("source_id", ("source_id",)), Stage("vin", ("vin",)), Stage("make_model_year_mileage", ("make", "model", "year"), near="mileage", within=1_000, sure=False)]
