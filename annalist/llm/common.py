"""Helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.sources.scratch import discard, materialize, scratch_dir

__all__ = ["WORD", "discard", "fresh", "held_out", "id_text", "materialize", "quoted", "sample_order", "scratch_dir", "shards_for", "text_batches"]

#: A word is a maximal run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def fresh(taken: list[str], *names: str) -> list[str]:
    """Column names that no column of ``taken`` has, in any case, one for each of ``names``."""
    known, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in known:
            name += "_"
        known.add(name.lower())
        out.append(name)
    return out


def quoted(column: str):
    """The column of that very name, whatever characters it has."""
    return F.col("`" + column.replace("`", "``") + "`")


def shards_for(rows: int, rows_per_shard: int, spark: SparkSession) -> int:
    """Number of shards that grows with the rows, and is never below the usual parallelism."""
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(1, rows // 200))
    return max(1, least, -(-rows // rows_per_shard))


def id_text(column: str):
    """The id as text; null gives the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(column: str = "doc_id", *, folds: int = 4, fold: int = 2):
    """True for the rows that no model may learn from: crc32 of the id as text, mod ``folds``, is ``fold``."""
    return F.pmod(F.crc32(id_text(column).cast("binary")), F.lit(folds)) == fold


def text_batches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, named ``id`` and ``text`` whatever else there is."""
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def sample_order(column: str, seed: str):
    """A number in 0..1 that depends on the id alone, for bounded samples that reruns repeat."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), id_text(column)).cast("binary")), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**12))
