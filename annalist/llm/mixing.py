"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.llm.common import WORD, fresh, id_text, materialize, quoted

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
#: A document of at most its source's mean length weighs so much, a longer one 1.
SHORT_WEIGHT = 2
SEED = "mix-1"


def word_count(column: str = "text") -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row a source: ``source, source_size, n_docs, target``.

    Sources, in code point order with null last, weigh ``weights`` in turn and share the
    total size. A target stops at ``max_repeat`` times its source's size and the excess goes
    to the others by weight. This is the same as one water level: the target is the lesser
    of the cap and level x weight, where the level makes the targets add up to the total.
    A corpus without words has targets of zero.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = by_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(place, F.lit(len(weights))) + 1).cast("double"))
    weighed = weighed.withColumn("cap", F.col("source_size") * float(max_repeat))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    total = F.sum("source_size").over(everything)
    capped = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    level = weighed.withColumn("level", (total - capped) / open_weight)
    level = level.withColumn("water", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)["level"])
    target = F.least("cap", F.coalesce("water", F.lit(0.0)) * F.col("weight"))
    return level.select("source", "source_size", "n_docs", target.alias("target"))


def document_dues(classes: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Adds ``due``, the copies that a document of each class is due, to ``source, target, weight, words``.

    A class is the documents of a source with one weight. Their words add up to the target
    if each is due its weight times the source's level, and at most ``max_repeat``: heavier
    classes reach that first, and the others share what is left.
    """
    heavier = Window.partitionBy("source").orderBy(F.desc("weight"))
    capped = F.coalesce(F.sum(F.col("words") * float(max_repeat)).over(heavier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_ = F.sum(F.col("weight") * F.col("words")).over(heavier.rowsBetween(0, Window.unboundedFollowing))
    level = classes.withColumn("level", F.when(open_ > 0, (F.col("target") - capped) / open_))
    fits = F.when(F.col("level") * F.col("weight") <= float(max_repeat), F.struct(F.col("weight"), "level"))
    level = level.withColumn("own", F.max(fits).over(Window.partitionBy("source"))["level"])
    open_class = F.coalesce("own", F.lit(float(max_repeat))) * F.col("weight")
    return level.withColumn("due", F.when(F.col("target") > 0, F.least(F.lit(float(max_repeat)), open_class)).otherwise(F.lit(0.0))).drop("level", "own")


def _unit(id_col: str, text_col: str, seed: str) -> Column:
    """A number between 0 and 1 from the id; rows without an id draw by their text."""
    own = F.when(F.col(id_col).isNull(), F.concat(F.lit(" "), F.coalesce(F.col(text_col).cast("string"), F.lit("")))).otherwise(id_text(id_col))
    digits = F.substring(F.md5(F.concat(F.lit(seed), own).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, max_repeat: int = MAX_REPEAT, short_weight: int = SHORT_WEIGHT, seed: str = SEED) -> DataFrame:
    """How often the mix takes each document.

    Returns a row for each input row: ``id_col, source, size, source_size, target, copies,
    taken, draw`` (``taken`` = ``copies`` x ``size``; ``draw`` is the row's random number). A document is due copies by its weight (see
    ``document_dues``): one of at most its source's mean length weighs ``short_weight``, a
    longer one 1, so that what is drawn holds more different documents. Whole copies are
    certain. The fraction is the document's probability to be drawn once more: documents of a
    source are ranked by their random odds divided by their inclusion odds, and the ranking's
    longest prefix whose words fit what the target leaves is taken. One closing document of the
    source, the unselected one nearest in size to the words still missing, is added if that
    brings the source nearer to its target. The random numbers come from the id, so reruns
    agree.

    The ranking is cut without sorting a source in one task: words are summed in about
    sqrt(documents) slices of the ranking, and only the slice where the target falls is
    sorted. Every per-source table is small and materialised, so Spark may broadcast it after
    seeing its size.

    Null text, empty text: size 0, no copies drawn, taken 0. Null source: a source of its
    own, the last. Rows with the same id are drawn together, rows without an id by their text. Extra columns are ignored.
    An empty table gives no rows.
    """
    sized = docs.select(F.col(id_col).alias(id_col), F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size"), _unit(id_col, text_col, seed).alias("u"))
    sized = materialize(sized, "sized")
    targets = materialize(source_targets(sized, weights, max_repeat), "targets").withColumnRenamed("source", "of")
    short = F.col("size") * F.col("n_docs") <= F.col("source_size")
    weighed = sized.join(targets, sized["source"].eqNullSafe(targets["of"])).drop("of").withColumn("weight", F.when(short, short_weight).otherwise(1))
    classes = weighed.groupBy("source", "weight").agg(F.sum("size").alias("words"), F.first("target").alias("target"), F.first("source_size").alias("source_size"), F.first("n_docs").alias("n_docs"))
    dues = document_dues(classes, max_repeat).withColumn("whole", F.floor("due")).withColumn("part", F.col("due") - F.col("whole"))
    left = F.col("target") - F.sum(F.col("whole") * F.col("words")).over(Window.partitionBy("source"))
    dues = dues.withColumn("rest", left).withColumn("slices", F.ceil(F.sqrt("n_docs")))
    sources = materialize(dues.select(F.col("source").alias("of"), F.col("weight").alias("of_weight"), "target", "source_size", "n_docs", "whole", "part", "rest", "slices"), "sources")
    # a class by its source and on which side of the source's mean a document is
    bound = F.col("size") * F.col("n_docs") <= F.col("source_size")
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("part") / (1 - F.col("part")))
    own_class = sized["source"].eqNullSafe(sources["of"]) & (sources["of_weight"] == F.when(bound, short_weight).otherwise(1))
    ranked = sized.join(sources, own_class).drop("of", "of_weight")
    ranked = ranked.withColumn("order", F.when((F.col("part") > 0) & (F.col("size") > 0), odds / (1 + odds))).withColumn("tie", id_text(id_col))
    ranked = ranked.withColumn("slice", F.floor(F.col("order") * F.col("slices")))
    drawn = ranked.where("order is not null")
    by_source = Window.partitionBy("source").orderBy("slice")
    slices = drawn.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    slices = slices.withColumn("upto", F.sum("words").over(by_source))
    border = slices.groupBy("source").agg(F.min(F.when(F.col("upto") > F.col("rest"), F.struct("slice", (F.col("upto") - F.col("words")).alias("before")))).alias("b"), F.sum("words").alias("all"), F.first("rest").alias("left"))
    border = materialize(border.select(F.col("source").alias("of"), F.col("b.slice").alias("border"), F.coalesce("b.before", "all").alias("before"), "left"), "border")
    in_order = Window.partitionBy("source").orderBy("order", "tie").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    at = drawn.join(border, drawn["source"].eqNullSafe(border["of"])).where("slice = border")
    at = at.select("source", "order", "tie", "size", "before", "left").withColumn("upto", F.sum("size").over(in_order) + F.col("before")).where("upto <= left")
    cut = at.groupBy("source").agg(F.max(F.struct("order", "tie")).alias("cut"), F.max("upto").alias("upto")).withColumnRenamed("source", "with")
    cuts = border.join(cut, border["of"].eqNullSafe(cut["with"]), "left").select("of", "border", "cut", (F.col("left") - F.coalesce("upto", "before")).alias("missing"))
    cuts = materialize(cuts, "cuts")
    chosen = F.col("order").isNotNull() & (F.col("border").isNull() | (F.col("slice") < F.col("border")) | F.coalesce((F.col("slice") == F.col("border")) & (F.struct("order", "tie") <= F.col("cut")), F.lit(False)))
    marked = ranked.join(cuts, ranked["source"].eqNullSafe(cuts["of"]), "left").drop("of").withColumn("chosen", chosen)
    units = marked.where("order is not null and not chosen").groupBy("source", "order", "tie").agg(F.sum("size").alias("words"), F.first("missing").alias("missing"))
    nearest = units.where(F.abs(F.col("missing") - F.col("words")) < F.abs("missing")).groupBy("source").agg(F.min(F.struct(F.abs(F.col("missing") - F.col("words")), "order", "tie")).alias("near"))
    nearest = materialize(nearest.select(F.col("source").alias("of"), F.col("near.order").alias("near_order"), F.col("near.tie").alias("near_tie")), "nearest")
    marked = marked.join(nearest, marked["source"].eqNullSafe(nearest["of"]), "left").drop("of")
    closing = F.coalesce((F.col("order") == F.col("near_order")) & (F.col("tie") == F.col("near_tie")), F.lit(False))
    copies = F.coalesce(F.col("whole"), F.lit(0)) + F.when(F.col("chosen") | closing, 1).otherwise(0)
    return marked.select(id_col, "source", "size", "source_size", "target", copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"), F.col("u").alias("draw"))


def apply_mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``mix`` takes it, with the same columns.

    Rows of one draw, source and size fare alike, so they find their number by these.
    """
    draw, source, size, n, words, number, copy = fresh(docs.columns, "draw_of", "source_of", "size_of", "copies_of", "words", "number", "copy")
    copies = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    copies = copies.where("copies > 0").groupBy(F.col("draw").alias(draw), F.col("source").alias(source), F.col("size").alias(size)).agg(F.max("copies").alias(n))
    own = docs.withColumn(words, word_count(text_col)).withColumn(number, _unit(id_col, text_col, options.get("seed", SEED)))
    same = (own[number] == copies[draw]) & quoted(source_col).cast("string").eqNullSafe(copies[source]) & (own[words] == copies[size])
    taken = own.join(copies, same).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))))
    return taken.select(*map(quoted, docs.columns))


#: What ``op8_mix_sources`` returns, as DuckDB SQL.
ORACLE_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         (CAST('0x' || substr(md5('{SEED}' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
by_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source COLLATE "binary" ASC NULLS LAST) - 1) % 3] AS DOUBLE) AS weight,
         source_size * 3.0::DOUBLE AS cap FROM by_source),
level AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
water AS (SELECT coalesce(arg_min(level, cap / weight) FILTER (WHERE level * weight <= cap), 0) AS water FROM level),
sources AS (SELECT source, source_size, n_docs, least(cap, water * weight) AS target FROM level, water),
classed AS (
  SELECT sized.*, s.source_size, s.target, CASE WHEN size * s.n_docs <= s.source_size THEN 2 ELSE 1 END AS w FROM sized JOIN sources s ON sized.source IS NOT DISTINCT FROM s.source),
classes AS (SELECT source, w, any_value(target) AS target, CAST(sum(size) AS BIGINT) AS words FROM classed GROUP BY source, w),
levels AS (
  SELECT *, (target - coalesce(sum(words * 3.0::DOUBLE) OVER (PARTITION BY source ORDER BY w DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / nullif(sum(w * words) OVER (PARTITION BY source ORDER BY w DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0)::DOUBLE AS level FROM classes),
own AS (SELECT *, arg_max(level, w) FILTER (WHERE level * w <= 3) OVER (PARTITION BY source) AS own FROM levels),
dues AS (SELECT *, CASE WHEN target > 0 THEN least(3.0::DOUBLE, coalesce(own, 3.0::DOUBLE) * w) ELSE 0 END AS due FROM own),
due AS (SELECT *, floor(due) AS whole, due - floor(due) AS part, target - sum(floor(due) * words) OVER (PARTITION BY source) AS rest FROM dues),
ranked AS (
  SELECT doc_id, c.source, size, u, source_size, c.target, whole, rest,
         CASE WHEN part > 0 AND size > 0 THEN (u / (1 - u)) / (part / (1 - part)) END AS odds
  FROM classed c JOIN due ON c.source IS NOT DISTINCT FROM due.source AND c.w = due.w),
upto AS (
  SELECT *, odds IS NOT NULL AND sum(size) FILTER (WHERE odds IS NOT NULL) OVER (PARTITION BY source ORDER BY odds, doc_id RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= rest AS chosen
  FROM ranked),
missing AS (SELECT *, rest - coalesce(sum(size) FILTER (WHERE chosen) OVER (PARTITION BY source), 0) AS missing FROM upto),
closing AS (
  SELECT source, arg_min(doc_id, (abs(missing - size), odds)) AS close_id FROM missing
  WHERE odds IS NOT NULL AND NOT chosen AND abs(missing - size) < abs(missing) GROUP BY source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN chosen OR (odds IS NOT NULL AND doc_id IS NOT DISTINCT FROM close_id AND close_id IS NOT NULL) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM missing LEFT JOIN closing ON missing.source IS NOT DISTINCT FROM closing.source
"""
