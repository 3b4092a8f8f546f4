"""Registry and glossary files, compressed bodies, and JSON exports."""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.functions import feeds as reading
from annalist.functions.hashing import canonical_text
from annalist.sources.scratch import materialize

ANY_LANGUAGE = "*"
REGISTRY = "id string, kind string, country string, name string, domains array<string>, rating int, research string"


def _load(path: str) -> dict:
    """A YAML or JSON file; JSON needs nothing beyond the standard library."""
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            return json.load(f)
        try:
            import yaml
        except ImportError as missing:
            raise ImportError("YAML registries need the yaml package; JSON ones do not") from missing
        return yaml.safe_load(f)


def source_registry(spark: SparkSession, path: str) -> DataFrame:
    """The sources of a registry file, a small table; an id that comes twice is an error. Other fields are left out."""
    found = _load(path)["sources"]
    ids = [s["id"] for s in found]
    if len(set(ids)) < len(ids):
        raise ValueError(f"ids come twice: {sorted({i for i in ids if ids.count(i) > 1})}")
    names = [field.split()[0] for field in REGISTRY.split(", ")]
    return spark.createDataFrame([tuple(s.get(n) for n in names) for s in found], REGISTRY)


def unknown_sources(df: DataFrame, registry: DataFrame, key: str = "source_id") -> DataFrame:
    """Rows whose source the registry does not have."""
    return df.join(registry.select(F.col("id").alias(key)), key, "left_anti")


def glossary(data: dict, target: str = "uk") -> tuple[str, dict[str, dict[str, str]]]:
    """Version and terms of a glossary: by source language, each term with what stands for it.

    A term has either a ``target`` or ``keep``, and comes once in a language. The version is
    the hash of the content, whatever the file looks like.
    """
    if data.get("schema") != 1 or data.get("target_language") != target:
        raise ValueError("no glossary of schema 1 for this language")
    pairs: dict[str, list[list]] = {}
    for language, items in data["pairs"].items():
        if language != ANY_LANGUAGE and not (len(language) == 2 and language.isascii() and language.islower()):
            raise ValueError(f"no language: {language}")
        for item in items:
            term, goal, keep = str(item["term"]).strip(), item.get("target"), bool(item.get("keep"))
            if not term or keep == (goal is not None):
                raise ValueError(f"{language}: {term!r} wants either a target or keep")
            pairs.setdefault(language, []).append([term, None if keep else str(goal).strip()])
        if len({t for t, _ in pairs.get(language, [])}) < len(pairs.get(language, [])):
            raise ValueError(f"{language}: a term comes twice")

    version = hashlib.sha256(canonical_text(json.dumps({"schema": 1, "target_language": target, "pairs": pairs})).encode()).hexdigest()
    return version, {language: {t: t if goal is None else goal for t, goal in terms} for language, terms in pairs.items()}


def load_glossary(path: str) -> tuple[str, dict[str, dict[str, str]]]:
    return glossary(_load(path))


def glossary_terms(spark: SparkSession, terms: dict[str, dict[str, str]]) -> DataFrame:
    """``language, place, term, replacement``; entries for a language are its own and those of all."""
    rows = [(language, n, t, r) for language, own in terms.items() for n, (t, r) in enumerate(own.items())]
    return spark.createDataFrame(rows, "language string, place int, term string, replacement string")


def decoded_bodies(fetches: DataFrame, *, max_bytes: int = 20_000_000, max_ratio: int = 200, ratio_min_bytes: int = 1 << 20) -> DataFrame:
    """Adds ``data`` and ``error`` to rows with ``body, content_encoding``: what the encodings hold.

    Encodings are undone last to first, a piece at a time, so no body is decoded beyond
    ``max_bytes`` (``body_too_large``) or, above ``ratio_min_bytes``, beyond ``max_ratio``
    times its size (``decompression_bomb``). Unknown encodings and damaged data are
    ``content_decoding_error``.
    """

    def opened(name: str):
        if name in ("gzip", "x-gzip"):
            return zlib.decompressobj(16 + zlib.MAX_WBITS)
        if name == "deflate":
            return zlib.decompressobj()
        raise zlib.error(name)

    def expand(data: bytes, name: str) -> bytes:
        try:
            return limited(data, opened(name), len(data))
        except zlib.error:
            if name != "deflate":
                raise
            return limited(data, zlib.decompressobj(-zlib.MAX_WBITS), len(data))

    def limited(data: bytes, decoder, received: int) -> bytes:
        out, size, rest = [], 0, data
        while rest and not decoder.eof:
            piece = decoder.decompress(rest, 1 << 16)
            rest = decoder.unconsumed_tail
            size += len(piece)
            if size > max_bytes:
                raise OverflowError("body_too_large")
            if size > ratio_min_bytes and size > max_ratio * received:
                raise OverflowError("decompression_bomb")
            if not piece and not rest:
                break
            out.append(piece)
        if not decoder.eof:
            raise zlib.error("cut off")
        return b"".join(out)

    def one(body, encoding) -> tuple[bytes | None, str | None]:
        if body is None:
            return None, None
        data = bytes(body)
        try:
            for name in reversed([n.strip().lower() for n in (encoding or "").split(",")]):
                data = data if name in ("", "identity") else expand(data, name)
        except OverflowError as problem:
            return None, str(problem)
        except zlib.error:
            return None, "content_decoding_error"
        return (None, "body_too_large") if len(data) > max_bytes else (data, None)

    @F.pandas_udf("data binary, error string")
    def decode(bodies: pd.Series, encodings: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(b, e) for b, e in zip(bodies, encodings, strict=True)], columns=["data", "error"], dtype=object)

    return fetches.withColumn("_d", decode("body", "content_encoding")).select(*fetches.columns, "_d.data", "_d.error")


def write_jsonl(df: DataFrame, path: str, sort_cols: list[str]) -> None:
    """JSON lines in sorted files, and a manifest of each file's rows, bytes and digest beside them."""
    spark = df.sparkSession
    df.sortWithinPartitions(*sort_cols).write.option("ignoreNullFields", "false").json(f"{path}/data")
    files = spark.read.format("binaryFile").load(f"{path}/data/*.json")
    lines = F.length(F.decode("content", "UTF-8")) - F.length(F.replace(F.decode("content", "UTF-8"), F.lit("\n"), F.lit("")))
    files.select(F.regexp_extract("path", "([^/]*)$", 1).alias("file"), lines.cast("long").alias("row_count"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256")).write.json(f"{path}/manifest")


def parsed(artifacts: DataFrame, parsers: dict[str, str], schema: str) -> tuple[DataFrame, DataFrame]:
    """Records of JSON artifacts, and the ones that failed, beside the parser's version.

    ``parsers`` gives the version that reads each ``kind``; an artifact without one, or whose
    content does not fit the schema, is a failure with a reason.
    """
    version = F.create_map(*[F.lit(x) for kv in parsers.items() for x in kv])[F.col("kind")]
    read = artifacts.withColumn("parser_version", version).withColumn("record", F.from_json("content", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.when(F.col("parser_version").isNull(), "no_parser").when(F.col("record").isNull() | F.get_json_object("content", "$").isNull(), "malformed")
    read = read.withColumn("error", bad)
    return read.where("error is null").drop("error", "content"), read.where("error is not null").drop("record")


#: Fixed value: how much a packed feed may hold.
MAX_FEED_BYTES = 100 * 1024 * 1024


def feed_items(feeds: DataFrame, *, id_col: str = "source_id", body_col: str = "body", max_bytes: int = MAX_FEED_BYTES) -> DataFrame:
    """``id, kind, url, title, published, error`` of RSS, Atom and sitemap documents, as text or bytes, packed or not.

    ``kind`` is ``item``, ``url`` or ``sitemap`` (an index's entry). Entries without an address are
    left out, and a document that is none of these gives no rows; one that can't be unpacked
    gives one row with its ``error``. Entities are never expanded.
    """

    def rows(key, body) -> Iterator[tuple]:
        try:
            text = reading.unpacked(body or b"", max_bytes).decode("utf-8", errors="replace")
        except reading.Packed as problem:
            yield (key, None, None, None, None, str(problem))
            return
        yield from ((key, *entry, None) for entry in reading.entries(text))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["id", "kind", "url", "title", "published", "error"]
        for batch in batches:
            for key, body in zip(batch["id"], batch["body"], strict=True):
                found = rows(key, body)
                while part := list(islice(found, 10_000)):
                    yield pd.DataFrame(part, columns=columns, dtype=object)

    kind = feeds.schema[id_col].dataType.simpleString()
    read = feeds.select(F.col(id_col).alias("id"), F.col(body_col).cast("binary").alias("body"))
    return read.mapInPandas(run, f"id {kind}, kind string, url string, title string, published string, error string").withColumnRenamed("id", id_col)


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """``feed_items`` of the files at ``path``; Spark reads them, from whatever store, a file or more a task."""
    files = spark.read.format("binaryFile").load(path)
    return feed_items(files.select("path", "content"), id_col="path", body_col="content")


def expanded_sitemaps(roots: DataFrame, documents: DataFrame, *, most_levels: int = 5) -> DataFrame:
    """``root, url, published, level``: what sitemaps list, indexes being followed into the documents that are there.

    ``roots`` has ``root``, the address of a document; ``documents`` has ``url, body``. A document is
    read once for each root, so circles end; at most ``most_levels`` indexes lie above an address.
    """
    level = materialize(roots.select("root", F.col("root").alias("at")).distinct(), "sitemaps")
    seen, out = level, None
    for depth in range(most_levels + 1):
        bodies = documents.join(level.select("at").distinct(), documents["url"] == F.col("at"), "left_semi").select("url", "body")
        found = materialize(level.join(_items_of(bodies), "at").select("root", "kind", "url", "published").distinct(), "listed")
        leaves = found.where("kind <> 'sitemap'").select("root", "url", "published", F.lit(depth).alias("level"))
        out = leaves if out is None else out.union(leaves)
        below = found.where("kind = 'sitemap'").select("root", F.col("url").alias("at")).distinct().join(seen, ["root", "at"], "left_anti")
        level = materialize(below, "sitemaps")
        if level.isEmpty():
            break
        seen = seen.union(level)
    return out


def _items_of(bodies: DataFrame) -> DataFrame:
    """Entries beside the address ``at`` of their document."""
    return feed_items(bodies.select(F.col("url").alias("at"), "body"), id_col="at").where("url is not null").select("at", "kind", "url", "published")


def verified_chunks(chunks: DataFrame, expected: DataFrame, max_bytes: int) -> DataFrame:
    """``key, size, status`` of bodies that are stored in pieces ``key, seq, content``.

    ``expected`` has ``key, sha256, pieces``. A body is read piece by piece, in order, and never
    whole: ``ok``, ``mismatch``, ``incomplete`` (pieces are missing, or come twice), ``too_large``, or
    ``missing``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, size, count, sound = None, hashlib.sha256(), 0, 0, True
        done: list[tuple] = []

        def given() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done, strict=True), (kind, pa.int64(), pa.int64(), pa.bool_(), pa.string()), strict=True)], ["key", "size", "count", "sound", "digest"])
            done.clear()
            return made

        kind, begun = None, False
        for batch in batches:
            kind = batch.schema.field("key").type
            for own, seq, content in zip(*(batch.column(c).to_pylist() for c in ("key", "seq", "content")), strict=True):
                if not begun or own != key:
                    if begun:
                        done.append((key, size, count, sound, digest.hexdigest()))
                    key, digest, size, count, sound, begun = own, hashlib.sha256(), 0, 0, True, True
                sound &= seq == count and content is not None
                size, count = size + len(content or b""), count + 1
                if size <= max_bytes:
                    digest.update(content or b"")
            if len(done) > 5_000:
                yield given()
        if begun:
            done.append((key, size, count, sound, digest.hexdigest()))
        if done:
            yield given()

    kind = chunks.schema["key"].dataType.simpleString()
    ordered = chunks.select("key", F.col("seq").cast("long").alias("seq"), F.col("content").cast("binary").alias("content")).repartition("key").sortWithinPartitions("key", "seq")
    read = ordered.mapInArrow(run, f"key {kind}, size long, count long, sound boolean, digest string")
    joined = expected.join(read, "key", "left")
    status = F.when(F.col("count").isNull(), "missing").when(F.col("size") > max_bytes, "too_large").when(~F.col("sound") | ~F.col("count").eqNullSafe(F.col("pieces")), "incomplete").when(F.col("digest").eqNullSafe(F.col("sha256")), "ok").otherwise("mismatch")
    return joined.select("key", "size", status.alias("status"))
