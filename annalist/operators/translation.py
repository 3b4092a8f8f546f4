"""From HTML articles to checked translations: segments, plan, memory, outcome."""

from __future__ import annotations

import html
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from annalist.functions import hashing, markup, preserve, text
from annalist.sources.scratch import materialize

#: Access that comes with a body, and the language of translations.
BODY_ACCESS = ("full", "partial")
TARGET = "uk"
FIELDS = ("title", "lead", "body")
#: Letters of documents, and rows, that a task holds before it hands on what it has.
HELD_LETTERS, HELD_ROWS = 2_000_000, 10_000


def pieces(docs: DataFrame, keys: list[str], html_col: str, *, limit: int | None = None, translated: tuple[str, ...] = ()) -> DataFrame:
    """Each document as rows ``pos, kind, slot, block, lang, html, text``, beside its keys.

    ``literal`` rows stay as they are; ``text`` and ``attribute`` rows are segments. Each row
    has the document's ``root_lang`` and whether a skipped element was left ``unterminated``.
    Null documents give no rows.
    """
    names = [*keys, "pos", "kind", "slot", "block", "lang", "html", "text", "root_lang", "unterminated"]
    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{kinds}, pos int, kind string, slot int, block string, lang string, html string, text string, root_lang string, unterminated boolean"
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _taken_apart(batches, names, arrow.types, limit, translated)

    return docs.select(*keys, F.col(html_col).alias("_html")).mapInArrow(run, schema)


def _taken_apart(batches: Iterator[pa.RecordBatch], names: list[str], types: list[pa.DataType], limit: int | None, translated: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """The pieces of documents, which follow their keys, in batches of bounded size: a batch may come with very many documents."""
    given = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
    for batch in batches:
        rows, size = [], 0
        for n in range(batch.num_rows):
            *own, source = (c[n].as_py() for c in batch.columns)
            if source is None:
                continue
            found = markup.read(source, translated, limit)
            slots = [None] * len(found.pieces) + list(range(len(found.slots)))
            rows += [(*own, at, p.kind, slot, p.block, p.lang, p.html, p.text, found.root_lang, found.unterminated) for at, (p, slot) in enumerate(zip([*found.pieces, *found.slots], slots, strict=True))]
            size += len(source)
            if rows and (size > HELD_LETTERS or len(rows) > HELD_ROWS):
                yield given()
                rows, size = [], 0
        if rows:
            yield given()


def _escaped(value: Column, quotes: bool = False) -> Column:
    for c, entity in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), *([('"', "&quot;"), ("'", "&#x27;")] if quotes else [])]:
        value = F.replace(value, F.lit(c), F.lit(entity))
    return value


def _shown(is_slot: Column, new: Column, html: Column) -> Column:
    """What a piece becomes: its translation, where there is one."""
    return F.when(is_slot, F.coalesce(_escaped(new, quotes=True), html)).otherwise(F.coalesce(new, html))


def _put_together(rows: Column) -> Column:
    """The document of rows ``slot, shown`` in order."""
    body = F.array_join(F.transform(F.filter(rows, lambda r: r["slot"].isNull()), lambda r: r["shown"]), "")
    slots = F.filter(rows, lambda r: r["slot"].isNotNull())
    return F.aggregate(slots, body, lambda out, r: F.replace(out, F.concat(F.lit("\x00"), r["slot"].cast("string"), F.lit("\x00")), r["shown"]))


def reassemble(parts: DataFrame, keys: list[str], translations: DataFrame) -> DataFrame:
    """``html`` of each document: segments give way to ``translated`` (of ``keys, pos``), where there is one.

    Translations of text segments are HTML, those of attributes plain text. Without any, the
    document comes out as it went in.
    """
    new = parts.join(translations.select(*keys, "pos", F.col("translated").alias("_new")), [*keys, "pos"], "left")
    shown = _shown(F.col("kind") == "attribute", F.col("_new"), F.col("html"))
    rows = new.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "slot", shown.alias("shown")))).alias("rows"))
    return rows.select(*keys, _put_together(F.col("rows")).alias("html"))


_PARTS = "struct<field_no: int, field: string, pos: int, kind: string, slot: int, block: string, lang: string, html: string, text: string, root_lang: string, unterminated: boolean>"


def _articles_read(batches: Iterator[pa.RecordBatch], schema: pa.Schema, limit: int | None, translated: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Of each article ``article_id, declared, asks, title, lead, body``: the text if it asks for a language, its root's language, whether something is untranslated, and the pieces of its fields.

    Articles come out in batches of bounded size.
    """
    whole, (*own, parts) = schema.field("parts").type, schema.types
    columns = whole.value_type

    def given(articles: list[tuple], rows: list[tuple], ends: list[int]) -> pa.RecordBatch:
        flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * columns.num_fields, columns, strict=True)], fields=list(columns))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, type=parts)
        return pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(zip(*articles, strict=True), own, strict=True)], lists], schema=schema)

    for batch in batches:
        articles, rows, ends, size = [], [], [0], 0
        for n in range(batch.num_rows):
            key, declared, asks, *fields = (c[n].as_py() for c in batch.columns)
            said, root, open_at_end = [], None, None
            for field_no, (field, source) in enumerate(zip(FIELDS, fields, strict=True)):
                if source is None or not source.strip(" "):
                    continue
                found = markup.read(source, translated, limit)
                slots = [None] * len(found.pieces) + list(range(len(found.slots)))
                pieces_of = [*found.pieces, *found.slots]
                rows += [(field_no, field, at, p.kind, slot, p.block, p.lang, p.html, p.text, found.root_lang, found.unterminated) for at, (p, slot) in enumerate(zip(pieces_of, slots, strict=True))]
                said += [p.text for p in pieces_of if asks and p.kind != "literal"]
                root = found.root_lang if field == "body" else root
                open_at_end = bool(open_at_end) or found.unterminated
                size += len(source)
            ends.append(len(rows))
            articles.append((key, declared, " ".join(said), root, open_at_end))
            if size > HELD_LETTERS or len(rows) > HELD_ROWS:
                yield given(articles, rows, ends)
                articles, rows, ends, size = [], [], [0], 0
        if articles:
            yield given(articles, rows, ends)


def plan(articles: DataFrame, ranking: Callable[[Column], Column], supported: list[str], *, limit: int | None = None, translated: tuple[str, ...] = (), short: int = 30, min_confidence: float = 0.6) -> DataFrame:
    """The pieces of ``article_id, access, declared, title, lead, body_html``, each segment with language and action.

    Title and lead are plain text; the body counts only if the access gives one. ``ranking``
    makes a column of (language, confidence), best first, from a column of texts. Literal rows
    stay among the segments, so that the plan is all that ``execute`` needs.
    """
    tag = text.language_tag
    body = F.when(F.col("access").isin(*BODY_ACCESS), F.col("body_html"))
    # an article is read, and its language decided, in one row: its pieces meet nothing
    wanted = articles.where("article_id is not null").select("article_id", "declared", tag(F.col("declared")).isNull().alias("asks"), _escaped(F.col("title")).alias("title"), _escaped(F.col("lead")).alias("lead"), body.alias("body"))
    schema = f"article_id {articles.schema['article_id'].dataType.simpleString()}, declared string, all_text string, article_root string, untranslated_content boolean, parts array<{_PARTS}>"
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _articles_read(batches, arrow, limit, translated)

    whole = wanted.mapInArrow(run, schema)
    # only articles that don't say their language are read as one text
    unknown = F.when(tag(F.col("declared")).isNull() & tag(F.col("article_root")).isNull(), F.col("all_text"))
    decided = whole.select("article_id", "untranslated_content", text.article_language(F.col("declared"), F.col("article_root"), F.col("all_text"), ranking(unknown), supported, min_confidence=min_confidence).alias("article"), "parts")
    parts = decided.select("article_id", "untranslated_content", "article", F.explode("parts").alias("p"))
    planned = parts.select("article_id", "p.*", "untranslated_content", "article")
    segment = F.col("kind") != "literal"
    # the root's language is the article's, not the segment's
    own = F.when(F.col("lang").eqNullSafe(F.col("root_lang")), None).otherwise(F.col("lang"))
    planned = planned.withColumn("_normal", text.normalize(F.when(segment, F.col("text"))))
    # what needs no classifier isn't read by it
    doubtful = F.when(segment & tag(own).isNull() & ~text.is_small(F.col("_normal"), short), F.col("text"))
    language = text.segment_language(own, F.col("_normal"), ranking(doubtful), F.col("article"), supported, short=short, min_confidence=min_confidence)
    planned = planned.withColumn("language", F.when(segment, language)).drop("_normal")
    return planned.withColumn("action", F.when(segment, text.action(F.col("language.language"), supported, TARGET)))


def quality(planned: DataFrame) -> DataFrame:
    """``article_id, not_required, flags`` of a plan."""
    seen = planned.groupBy("article_id").agg(
        F.bool_or(F.col("action") == "unsupported").alias("unsupported"),
        F.bool_or("language.uncertain").alias("unsure"),
        F.bool_and(F.col("action") == "keep").alias("kept"),
        F.first("untranslated_content").alias("open"),
        F.first("article.language").alias("of"),
    )
    flags = F.array_compact(F.array(F.when(F.col("unsupported"), "language_unsupported"), F.when(F.col("unsure"), "low_language_confidence"), F.when(F.col("open"), "untranslated_content")))
    kept = F.coalesce(F.col("kept"), F.lit(True))
    return seen.select("article_id", F.coalesce((F.col("of") == TARGET) & kept & ~F.col("open"), F.lit(False)).alias("not_required"), flags.alias("flags"))


def kept(planned: DataFrame) -> DataFrame:
    """What ``execute`` needs of a plan, stored: plans are costly to make."""
    language = F.when(F.col("language").isNotNull(), F.struct("language.language", "language.uncertain"))
    return materialize(planned.select("article_id", "field_no", "field", "pos", "kind", "slot", "html", "untranslated_content", F.struct("article.language").alias("article"), language.alias("language"), "action"), "plan", compact=True)


def _masked(glossary: dict[str, dict[str, str]] | None) -> Column:
    """The masks of ``html`` in ``source_language``."""
    masked = preserve.mask(F.col("html"), (glossary or {}).get("*"))
    for language, terms in (glossary or {}).items():
        if language != "*":
            masked = F.when(F.col("source_language") == language, preserve.mask(F.col("html"), {**(glossary or {}).get("*", {}), **terms})).otherwise(masked)
    return masked


def jobs(planned: DataFrame, *, glossary: dict[str, dict[str, str]] | None = None, provider: str, model: str, glossary_version: str) -> DataFrame:
    """The segments to translate, masked, with the key under which a translation is remembered.

    ``glossary`` has terms and what stands for them, by source language and for all under ``*``.
    """
    todo = planned.where("action = 'translate'").withColumn("source_language", F.col("language.language"))
    todo = todo.withColumn("m", _masked(glossary))
    key = hashing.memory_key(F.col("source_language"), F.lit(TARGET), hashing.segment_hash(F.col("m.masked")), F.lit(provider), F.lit(model), F.lit(glossary_version))
    return todo.withColumn("key", key)


def execute(planned: DataFrame, memory: DataFrame, translator: Callable[[DataFrame], DataFrame], *, glossary: dict[str, dict[str, str]] | None = None, provider: str, model: str, glossary_version: str, stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """Outcomes by article, and new entries of the memory.

    ``memory`` holds ``key, translated_text``. ``translator`` gets ``key, source_language,
    masked``, each key once, and returns ``key, translated_text``; a key that it leaves out was
    cut off. A translation counts only if it preserves what was masked. An article is complete
    if all its segments are; sound segments are remembered even where others fail. ``stored``:
    the plan is of ``kept``, so it isn't stored again.
    """
    planned = planned if stored else kept(planned)
    todo = jobs(planned, glossary=glossary, provider=provider, model=model, glossary_version=glossary_version)
    # Segments travel once, to their key, without their masks, which are quickly made again. As
    # the key can't be null and pending takes whole rows, both uses of them share one shuffle.
    todo = todo.select(F.coalesce("key", F.lit("")).alias("key"), "source_language", "article_id", "field_no", "field", "pos", "kind", "slot", "html").repartition("key")
    known = memory.select("key", F.col("translated_text").alias("remembered")).dropDuplicates(["key"])
    todo = todo.join(known, "key", "left")
    pending = todo.where("remembered is null").groupBy("key").agg(F.first(F.struct(*[c for c in todo.columns if c != "key"])).alias("v")).select("key", "v.*")
    fresh = translator(pending.select("key", "source_language", _masked(glossary)["masked"].alias("masked"))).select("key", F.col("translated_text").alias("made"))
    answered = todo.join(fresh, "key", "left").withColumn("answer", F.coalesce("remembered", "made")).withColumn("m", _masked(glossary))
    answered = answered.withColumn("issues", preserve.issues(F.col("html"), F.col("m"), F.col("answer"))).withColumn("final", preserve.unmask(F.col("answer"), F.col("m")))
    ok, hit = F.coalesce(F.size("issues") == 0, F.lit(False)), F.col("remembered").isNotNull()
    checked = answered.select(
        *["article_id", "field_no", "field", "pos", "kind", "slot", "key", "source_language", hit.alias("hit"), F.col("answer").isNull().alias("cut"), ok.alias("ok")],
        F.length("m.masked").alias("n"),
        F.when(ok, F.col("final")).alias("final"),
        F.when(ok & ~hit & (F.col("answer") != F.col("final")), F.col("answer")).alias("entry"),
    )
    todo = materialize(checked, "answers", compact=True)
    sent = F.when(~F.col("hit"), F.struct("key", "n"))
    counted = todo.groupBy("article_id").agg(
        F.bool_and("ok").alias("all_ok"),
        F.bool_or("cut").alias("cut"),
        F.bool_or(~F.col("cut") & ~F.col("ok")).alias("failed"),
        F.count(F.when(F.col("hit"), 1)).alias("memory_hits"),
        F.collect_set(sent).alias("sent"),
    )
    by_article = quality(planned).join(counted, "article_id", "left")
    more = F.array_compact(F.array(F.when(F.col("cut"), "provider_truncated"), F.when(F.col("failed"), "preservation_failed")))
    flags = F.array_sort(F.concat("flags", F.when(F.col("not_required"), F.array().cast("array<string>")).otherwise(F.coalesce(more, F.array().cast("array<string>")))))
    complete = F.col("not_required") | (F.coalesce("all_ok", F.lit(True)) & ~F.array_contains(flags, "language_unsupported"))
    outcome = by_article.select("article_id", "not_required", complete.alias("complete"), flags.alias("quality_flags"), F.coalesce("memory_hits", F.lit(0)).cast("long").alias("memory_hits"), F.coalesce(F.size("sent"), F.lit(0)).cast("long").alias("provider_segments"), F.coalesce(F.aggregate("sent", F.lit(0).cast("long"), lambda n, s: n + s["n"]), F.lit(0)).cast("long").alias("provider_characters"))
    ready = outcome.where("complete and not not_required").select("article_id")
    is_slot = F.col("kind") == "attribute"
    new = F.when(is_slot, _unescape(F.when(is_slot, F.col("final")))).otherwise(F.col("final"))
    # a complete article's segments are all in the answers
    rows = todo.where("ok").select("article_id", "field_no", "pos", "slot", _shown(is_slot, new, F.lit(None).cast("string")).alias("shown"))
    rows = rows.union(planned.where("coalesce(action <> 'translate', true)").select("article_id", "field_no", "pos", "slot", F.col("html").alias("shown")))
    made = rows.join(ready, "article_id", "left_semi").groupBy("article_id").agg(F.array_sort(F.collect_list(F.struct("field_no", "pos", "slot", "shown"))).alias("rows"))

    def field(n: int) -> Column:
        own = F.filter("rows", lambda r: r["field_no"] == n)
        whole = F.when(F.size(own) > 0, _put_together(own))
        return whole if FIELDS[n] == "body" else _unescape(whole)

    columns = made.select("article_id", *[field(n).alias(name) for n, name in enumerate(("title", "lead", "body_html"))])
    entries = todo.where("ok and not hit").groupBy("key").agg(F.first(F.struct("source_language", F.coalesce("entry", "final").alias("translated_text"))).alias("v")).select("key", "v.*")
    return outcome.join(columns, "article_id", "left"), entries


def _unescape(value: Column) -> Column:
    @F.pandas_udf("string")
    def plain(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else html.unescape(v))

    # most texts have no entity and stay in the JVM
    return F.when(F.contains(value, F.lit("&")), plain(F.when(F.contains(value, F.lit("&")), value))).otherwise(value)
