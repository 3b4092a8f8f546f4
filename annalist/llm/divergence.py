"""How the sources of a language differ in their words, by wide term vectors.

Tasks count the terms of their rows; then each term of a language is one row whose array holds the term's count in every source. Higher-order
functions turn such an array into what each pair of sources gains from the term, and partial
aggregates add that up in each task. Equal arrays are met once, with their number.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.llm.common import materialize

#: A term is a maximal run of ASCII letters and characters beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: The same on UTF-8 bytes: A-Z become small, other ASCII becomes blanks.
_AS_WORDS = bytes(c | 32 if chr(c) in ascii_uppercase else c if c > 127 or chr(c) in ascii_lowercase else 32 for c in range(256))
#: Bytes of a text taken apart at once, counts a task holds, rows it hands on at once.
PIECE, HELD, ROWS = 1 << 20, 300_000, 20_000
MIN_DOCS, TOP = 3, 200
#: A language's row is repeated so often for joins, so that its terms fall into so many tasks at least.
SALTS = 32


def _words(data: bytes) -> Iterator[list[bytes]]:
    """A text's terms, as bytes; a long text comes in pieces that end between terms."""
    data = data.translate(_AS_WORDS)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + PIECE)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def _term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents with the term.

    Each task counts its own rows in Arrow batches and hands on what it has whenever that is
    ``HELD`` entries; Spark adds up.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def given() -> Iterator[pa.RecordBatch]:
            for (lang, source), (often, docs_with) in held.items():
                terms = list(often)
                for at in range(0, len(terms), ROWS):
                    part = terms[at : at + ROWS]
                    columns = [pa.array([lang] * len(part)), pa.array([source] * len(part)), pa.array(part, pa.binary()).cast(pa.string()), pa.array([often[t] for t in part], pa.int64()), pa.array([docs_with[t] for t in part], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
            held.clear()

        entries = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                often, docs_with = held.setdefault((lang, source), (Counter(), Counter()))
                seen, before = set(), len(often)
                for words in _words(text):
                    often.update(words)
                    seen.update(words)
                docs_with.update(seen)
                entries += len(often) - before
                if entries > HELD:
                    yield from given()
                    entries = 0
        yield from given()

    rows = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    counted = rows.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _with_language(rows: DataFrame, languages: DataFrame, by: str) -> DataFrame:
    """Join the row of its language to each row; the hash of ``by`` deals a language's rows to several keys."""
    salted = languages.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(salted, ["lang", "salt"]).drop("salt")


def share(n: str, total: str, terms: str) -> str:
    """SQL of 1 + floor(10^9 * (n + 1) / (total + terms)), by long division in steps of 10^3, so that 64 bits hold it up to 9 * 10^15 words."""
    rest, digits = f"({n} + 1)", []
    for step in (1_000_000, 1_000, 1):
        digits.append(f"({rest} * 1000 div ({total} + {terms})) * {step}")
        rest = f"({rest} * 1000 % ({total} + {terms}))"
    return f"(1L + {' + '.join(digits)})"


def gain(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def _ranked(rows: DataFrame, part: str, *, top: int | None = None) -> DataFrame:
    order: list[Column] = [F.desc("value"), F.asc("item")]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def divergence(docs: DataFrame, *, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: other sources by divergence, and the ``top`` terms that a source overuses.

    Null texts, languages and sources count as empty text. Terms match ``TERM``, A-Z in lower
    case. A language keeps the terms that ``min_docs`` of its rows have. A group's share p of a
    term is 1 + floor(10^9 * (count + 1) / (words + terms)), words and terms counting kept terms.
    ``value`` is floor((p - q)^2 / q), against the other source's share q and summed over all kept
    terms (part ``pair``), or against the language's share, for terms that the source has and
    overuses (part ``term``). Ranks are from 1 by falling value; ties go by the item's bytes.
    Repeated rows are documents of their own; a language of one source has no pairs, a group
    without kept terms no terms; an empty table gives no rows. Other columns aren't looked at.

    A term's array is as long as its language has sources, and pairs grow with their square, as
    the result does. All is in 64-bit integers: right up to 9 * 10^15 words and 5 * 10^9 kept
    terms in a language.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    languages = materialize(docs.groupBy("lang").agg(F.sort_array(F.collect_set("source")).alias("sources")), "languages")
    by_term = _term_counts(docs).groupBy("lang", "term").agg(F.map_from_entries(F.collect_list(F.struct("source", "n"))).alias("of"), F.sum("docs").alias("docs"))
    wide = _with_language(by_term.where(F.col("docs") >= min_docs), languages, "term")
    wide = materialize(wide.select("lang", "term", F.expr("transform(sources, s -> coalesce(of[s], 0L))").alias("counts")), "wide-terms")

    words = wide.select("lang", F.posexplode("counts").alias("i", "n")).groupBy("lang", "i").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("terms"))
    totals = words.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "n")))["n"].alias("totals"), F.max("terms").alias("terms"))
    languages = materialize(languages.join(totals, "lang", "left").withColumn("terms", F.coalesce("terms", F.lit(0))), "term-totals")

    vectors = wide.groupBy("lang", "counts").agg(F.count(F.lit(1)).alias("alike"))
    shares = _with_language(vectors, languages.drop("sources"), "counts").select("lang", "alike", F.expr(f"transform(counts, (n, i) -> {share('n', 'totals[i]', 'terms')})").alias("p"))
    gains = shares.select("lang", "alike", F.posexplode(F.expr(f"flatten(transform(p, p1 -> transform(p, p2 -> {gain('p1', 'p2')})))")).alias("at", "f"))
    every = languages.select("lang", F.explode(F.expr("sequence(0, size(sources) * size(sources) - 1)")).alias("at"))
    summed = gains.select("lang", "at", (F.col("f") * F.col("alike")).alias("f")).union(every.withColumn("f", F.lit(0).cast("long"))).groupBy("lang", "at").agg(F.sum("f").alias("value"))
    named = _with_language(summed, languages.select("lang", "sources"), "at").withColumn("many", F.size("sources"))
    pairs = named.select("lang", F.expr("sources[at div many]").alias("source"), F.expr("sources[at % many]").alias("item"), "value").where("source <> item")

    own = _with_language(wide, languages, "term").withColumn("q", F.expr(share("aggregate(counts, 0L, (a, n) -> a + n)", "aggregate(totals, 0L, (a, n) -> a + n)", "terms")))
    over = F.expr(f"filter(transform(counts, (n, i) -> named_struct('source', sources[i], 'n', n, 'p', {share('n', 'totals[i]', 'terms')})), s -> s.n > 0 and s.p > q)")
    terms = own.select("lang", F.col("term").alias("item"), "q", F.inline(over)).select("lang", "source", "item", F.expr(gain("p", "q")).alias("value"))
    return _ranked(pairs, "pair").union(_ranked(terms, "term", top=top))


_P = "(1 + 1000000000::HUGEINT * ({n} + 1) // ({total} + v))::BIGINT"
_F = "({p} - {q})::HUGEINT * ({p} - {q}) // {q}"
#: For the production parameters.
ORACLE_SQL = f"""WITH docs AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
terms AS (SELECT row, lang, source, unnest(regexp_extract_all(translate(text, '{ascii_uppercase}', '{ascii_lowercase}'), '{TERM}')) AS term FROM docs),
kept AS (SELECT lang, term FROM terms GROUP BY lang, term HAVING count(DISTINCT row) >= {MIN_DOCS}),
langs AS (SELECT l.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM docs) l LEFT JOIN kept k ON k.lang = l.lang GROUP BY l.lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
whole AS (SELECT lang, term, n, sum(n) OVER (PARTITION BY lang) AS total FROM (SELECT lang, term, sum(n) AS n FROM dense GROUP BY ALL)),
shares AS (SELECT lang, source, term, n, {_P.format(n="n", total="total")} AS p FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total FROM dense) JOIN langs USING (lang)),
lang_shares AS (SELECT lang, term, {_P.format(n="n", total="total")} AS q FROM whole JOIN langs USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
  SELECT x.lang, x.source, y.source AS item, sum({_F.format(p="x.p", q="y.p")}) AS value FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
  ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
overused AS (SELECT s.lang, source, s.term AS item, {_F.format(p="p", q="q")} AS value FROM shares s JOIN lang_shares l ON s.lang = l.lang AND s.term = l.term WHERE n > 0 AND p > q),
ranked AS (SELECT 'pair' AS part, * FROM pairs UNION ALL SELECT 'term', * FROM overused)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM ranked
QUALIFY part = 'pair' OR rank <= {TOP}"""
