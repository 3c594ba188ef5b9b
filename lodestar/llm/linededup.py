"""Removal of lines that many documents hold.

Lines are exploded with their places, normalised and hashed to 128 bits. The documents of
a hash are counted by their distinct ids, after each task and each id has folded its own rows, so
a line that most documents hold is a few rows in any one task. The places of lines over
the threshold are gathered per text, which is as many numbers as the text has lines, and
the texts are put together again without them. Texts move once, lines never do; joins
on hashes are plain joins of two written tables, which adaptive execution splits where a hash is hot.

Defined cases: null and empty texts are one empty line. Lines end at ``\\n`` alone; ``\\r`` is
white space of its line. Rows that share an id are one document, and all its lines stay where its id is the largest;
equal rows get equal results. A null id counts as no document and never keeps a repeated line.
Other columns pass through unread; columns of the names ``n_lines`` and ``n_dropped`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from lodestar.llm.common import bound_arrow_batches, cut_lineage, small_batches

#: Keys of fewer code points are never dropped.
MIN_CHARS = 20
#: Keys in fewer documents are never dropped.
MIN_DOCS = 3

_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """A line without white space at its ends, with A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(_SPACE)), _UPPER, _LOWER)


def _hash(*columns: str) -> list[Column]:
    """128 bits as two columns."""
    return [F.xxhash64(F.lit(seed), *columns) for seed in (11, 29)]


def _with_row(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row_a, row_b``, which name the id and the text; both nulls have a name."""
    a, b = _hash("doc_id", "text")
    return docs.withColumns({"row_a": a, "row_b": b})


def line_places(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``row_a, row_b, doc_id, pos, key_a, key_b`` of the lines long enough to be dropped."""
    rows = _with_row(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    lines = rows.select("row_a", "row_b", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = lines.withColumn("key", line_key(F.col("line"))).filter(F.char_length("key") >= min_chars)
    a, b = _hash("key")
    return keyed.select("row_a", "row_b", "doc_id", "pos", a.alias("key_a"), b.alias("key_b"))


def frequent_keys(places: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``key_a, key_b, last`` of the keys in ``min_docs`` documents or more; ``last`` is the largest id."""
    held = places.filter("doc_id is not null").groupBy("key_a", "key_b", "doc_id").agg(F.lit(1).alias("one"))
    counted = held.groupBy("key_a", "key_b").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
    return counted.filter(F.col("n") >= min_docs).select("key_a", "key_b", "last")


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        text, gone = batch.column("text"), batch.column("gone")
        lines = pc.split_pattern(text, "\n")
        starts = np.asarray(lines.offsets)
        values = lines.values
        keep = np.ones(len(values), bool)
        n_gone = pc.fill_null(pc.list_value_length(gone), 0).to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(len(text)), n_gone)
        keep[starts[rows] + gone.flatten().to_numpy(zero_copy_only=False)] = False
        kept = np.concatenate([[0], np.cumsum(keep)])[starts].astype(np.int32)
        left = pa.ListArray.from_arrays(pa.array(kept), values.filter(pa.array(keep)))
        out = {
            "text": pc.binary_join(left, "\n").cast(batch.schema.field("text").type),
            "n_lines": pa.array(np.diff(starts).astype(np.int64)),
            "n_dropped": pa.array((np.diff(starts) - np.diff(kept)).astype(np.int64)),
        }
        names = [f for f in batch.schema.names if f not in ("gone", *out)]
        yield pa.RecordBatch.from_arrays([*(batch.column(f) for f in names), *out.values()], [*names, *out])


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the text that is left, ``n_lines`` before and ``n_dropped``.

    A line goes if its key has ``min_chars`` code points and stands in ``min_docs``
    documents, unless its document has the largest id of these. A null text comes back empty.
    """
    bound_arrow_batches(docs.sparkSession)
    places = cut_lineage(line_places(docs, min_chars))
    frequent = cut_lineage(frequent_keys(places, min_docs))
    gone = places.join(frequent, ["key_a", "key_b"]).filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    gone = cut_lineage(gone.groupBy("row_a", "row_b").agg(F.collect_set("pos").alias("gone")))
    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    named = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("others"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    met = _with_row(named).join(gone, ["row_a", "row_b"], "left").select("others", "text", "gone")
    schema = StructType([met.schema["others"], met.schema["text"]]).add("n_lines", "long").add("n_dropped", "long")
    done = met.mapInArrow(_reassemble, schema)
    columns = [F.col(c) if c in ("text", "n_lines", "n_dropped") else F.col(f"others.`{c}`").alias(c) for c in docs.columns]
    return done.select(*columns, *(c for c in ("n_lines", "n_dropped") if c not in docs.columns))
