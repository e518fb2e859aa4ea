"""Lines found in many documents, as compressed keep bitmaps per document.

Each line becomes a 128-bit hash of its key. Hashes are range-partitioned, each partition
is sorted by hash, document and position, and streamed once: a window over that order
marks the first line of every document and of every key. Only positions of lines to drop
go back to the documents, as run lengths; texts do not move with the lines.

A key that a third of all lines share is dealt out by a salt taken from the document, so
its lines spread over many ranges; its totals come from one row per task and key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billweave.llm.native import SPACES, ascii_lower, lines, whole
from billweave.staging import staged

SALTS = 64
_DOC = ["_doc", "_text"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _document() -> list[Column]:
    """Rows with equal id and text are one document."""
    return [F.col("doc_id").alias("_doc"), F.xxhash64(whole(F.col("text"))).alias("_text")]


def _occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    hashed = F.transform(
        F.transform(lines(F.col("text")), line_key),
        lambda key, i: F.struct(
            F.xxhash64(key).alias("h1"),
            F.xxhash64(F.lit(1), key).alias("h2"),
            (F.char_length(key) >= min_chars).alias("counts"),
            i.alias("pos"),
        ),
    )
    found = docs.select(*_document(), F.explode(F.filter(hashed, lambda x: x["counts"])).alias("x"))
    salt = F.pmod(F.xxhash64(*_DOC), F.lit(SALTS)).cast("int").alias("_salt")
    return found.select(*_DOC, "x.h1", "x.h2", "x.pos", salt)


def dropped_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """(_doc, _text, pos) of lines whose key is in at least ``min_docs`` documents.

    With ``keep_first`` the first line of a key, by document and position, stays.
    """
    found = _occurrences(docs, min_chars)
    stream = Window.partitionBy("h1", "h2", "_salt").orderBy(*_DOC, "pos")
    before = F.lag(F.struct(*_DOC)).over(stream)
    opens = ~before.eqNullSafe(F.struct(*_DOC))
    common = (
        found.repartitionByRange("h1", "h2", "_salt")
        .withColumn("_opens", opens)
        .where("_opens")
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*_DOC, "pos")).alias("_first"))
        .where(F.col("_n") >= min_docs)
    )
    # Written, so that both sides of the join are plain and a key with very many lines is split.
    gone = found.join(staged(common.drop("_n"), "common-lines"), ["h1", "h2"])
    if keep_first:
        gone = gone.where(~F.col("_first").eqNullSafe(F.struct(*_DOC, "pos")))
    return gone.select(*_DOC, "pos")


def keep_runs(dropped: Column, n_lines: Column) -> Column:
    """The keep bitmap as runs (start, length) of kept lines, from sorted dropped positions."""
    runs = F.zip_with(
        F.concat(F.array(F.lit(-1)), dropped),
        F.concat(dropped, F.array(n_lines)),
        lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("length")),
    )
    return F.filter(runs, lambda r: r["length"] > 0)


def kept_text(text: Column, keep: Column) -> Column:
    """The kept lines, joined by line feeds."""
    parts = F.flatten(F.transform(keep, lambda r: F.slice(lines(text), r["start"] + 1, r["length"])))
    return F.array_join(parts, "\n")


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """The rows of ``docs`` with ``_lines``, ``_dropped`` and ``_keep`` (runs of kept lines).

    A NULL or empty text is one empty line; an empty line's key has no code points, so it
    stays while ``min_chars`` is at least 1. Rows with equal id and text are one document
    and get equal bitmaps; rows without id are told apart by their texts. All columns of
    ``docs`` are passed through, whatever their names; an empty table gives no rows.
    """
    own = {name: f"_c{i}" for i, name in enumerate(docs.columns)}
    renamed = docs.select(
        *[F.col(f"`{name}`").alias(alias) for name, alias in own.items()], *_document()
    )
    bitmaps = (
        dropped_lines(docs.select("doc_id", "text"), min_docs, min_chars, keep_first)
        .groupBy(*_DOC)
        .agg(F.sort_array(F.collect_set("pos")).alias("_pos"))
        .withColumnsRenamed({name: f"{name}2" for name in _DOC})
    )
    joined = renamed.join(
        bitmaps, F.col("_doc").eqNullSafe(F.col("_doc2")) & (F.col("_text") == F.col("_text2")), "left"
    )
    n = F.size(lines(F.col(own["text"])))
    none = F.array().cast("array<int>")
    pos = F.coalesce("_pos", none)
    return joined.select(
        *[F.col(alias).alias(name) for name, alias in own.items()],
        n.cast("long").alias("_lines"),
        F.size(pos).cast("long").alias("_dropped"),
        keep_runs(pos, n).alias("_keep"),
    )


def without_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with their kept lines as text and its length as n_chars; no row goes."""
    kept = keep_bitmaps(docs, min_docs, min_chars)
    text = F.when(F.col("_dropped") == 0, F.col("text")).otherwise(kept_text(F.col("text"), F.col("_keep")))
    kept = kept.withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(F.col("_dropped") == 0, F.col("n_chars")).otherwise(changed))
    return kept.select(*docs.columns)
