"""Exact deduplication: counting quotient filters find repeated fingerprints, bytes decide."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaica.llm.common import checkpoint, routed, routing_bitmap, slices, table, text_or_empty

QUOTIENT_BITS = 8  # of a block


def _scan(batches: Iterator[pa.RecordBatch], with_text: bool, route=None) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "t"):
        ids, texts = b.column(0), [t.lower() for t in b.column(1).to_pylist()]  # bytes.lower() changes A-Z only
        sha = [hashlib.sha256(t).digest() for t in texts]
        fp = np.frombuffer(b"".join(x[:8] for x in sha), dtype=">u8").astype(np.uint64)
        cols = [ids, pa.array(fp.view(np.int64)), pa.array([x.hex() for x in sha], pa.string())]
        names = ["id", "fp", "sha"]
        if with_text:
            cols.append(pa.array(texts, pa.binary()))
            names.append("norm")
        out = pa.RecordBatch.from_arrays(cols, names)
        if route is not None:
            out = out.filter(pa.array(routed(fp, route)))
        yield out


# ---- counting quotient filter: one block holds 2**QUOTIENT_BITS quotients ----


def _unsigned(values: np.ndarray, width: int) -> bytes:
    """The values in `width` bytes each, little-endian."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _values(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width if width else 0, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width) if len(data) else 0
    return out.view("<u8").reshape(-1)


def _remainder_bytes(block_bits: int) -> int:
    return -(-(64 - block_bits - QUOTIENT_BITS) // 8)


def build_filter(fp: np.ndarray, counts: np.ndarray, block_bits: int) -> pd.DataFrame:
    """Blocks of a counting quotient filter of sorted distinct fingerprints: occupied bits, run-end bits, sorted remainders, and counts less one, both in
    as few bytes as they need."""
    block = (fp >> np.uint64(64 - block_bits)).astype(np.int64) if block_bits else np.zeros(len(fp), np.int64)
    rows = []
    for at in np.split(np.arange(len(fp)), np.flatnonzero(np.diff(block)) + 1):
        if len(at):
            low = fp[at] << np.uint64(block_bits)
            quotient = (low >> np.uint64(64 - QUOTIENT_BITS)).astype(np.int64)
            occupied = np.zeros(1 << QUOTIENT_BITS, bool)
            occupied[quotient] = True
            run_end = np.append(quotient[1:] != quotient[:-1], True)
            # what block and quotient do not hold; sorted within a run since fp is
            remainder = (low << np.uint64(QUOTIENT_BITS)) >> np.uint64(QUOTIENT_BITS + block_bits)
            more = counts[at].astype(np.uint64) - np.uint64(1)
            width = (int(more.max()).bit_length() + 7) // 8
            rows.append((int(block[at[0]]), np.packbits(occupied).tobytes(), np.packbits(run_end).tobytes(), _unsigned(remainder, _remainder_bytes(block_bits)), width, _unsigned(more, width)))
    return pd.DataFrame(rows, columns=["block", "occupied", "run_end", "remainders", "width", "counts"])


def read_filter(row, block_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints and counts of one block, in order: nothing is lost."""
    remainder = _values(row.remainders, _remainder_bytes(block_bits))
    ends = np.unpackbits(np.frombuffer(row.run_end, np.uint8))[: len(remainder)].astype(bool)
    quotients = np.flatnonzero(np.unpackbits(np.frombuffer(row.occupied, np.uint8))).astype(np.uint64)
    run = np.concatenate(([0], np.cumsum(ends)[:-1])).astype(np.int64)
    fp = ((quotients[run] << np.uint64(64 - QUOTIENT_BITS)) >> np.uint64(block_bits)) | remainder
    if block_bits:
        fp |= np.uint64(row.block) << np.uint64(64 - block_bits)
    more = _values(row.counts, row.width) if row.width else np.zeros(len(fp), np.uint64)
    return fp, more.astype(np.int64) + 1


def merge_sorted(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted runs of distinct fingerprints with counts as one; the counts of equal ones add up."""
    at = np.arange(len(a[0])) + np.searchsorted(b[0], a[0], "left")
    to = np.arange(len(b[0])) + np.searchsorted(a[0], b[0], "right")
    fp, counts = np.empty(len(at) + len(to), np.uint64), np.empty(len(at) + len(to), np.int64)
    fp[at], fp[to], counts[at], counts[to] = a[0], b[0], a[1], b[1]
    first = np.append(True, fp[1:] != fp[:-1])[: len(fp)]
    return fp[first], np.add.reduceat(counts, np.flatnonzero(first)) if len(fp) else counts


def merge_all(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Merge neighbours until one run is left."""
    while len(parts) > 1:
        parts = [merge_sorted(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def _filters(batches: Iterator[pd.DataFrame], block_bits: int) -> Iterator[pd.DataFrame]:
    parts = [np.unique(pdf["fp"].to_numpy(np.int64).view(np.uint64), return_counts=True) for pdf in batches]
    if parts:
        yield build_filter(*merge_all(parts), block_bits)


def _merge(pdf: pd.DataFrame, block_bits: int) -> pd.DataFrame:
    """Merge the blocks of all partitions by their sorted remainders; the fingerprints counted twice or more."""
    fp, counts = merge_all([read_filter(r, block_bits) for r in pdf.itertuples()])
    return pd.DataFrame({"fp": fp[counts > 1].view(np.int64), "n": counts[counts > 1]})


def repeated_fingerprints(scanned: DataFrame) -> DataFrame:
    """(fp, n) of the fingerprints that occur more than once, from the merged filters of all partitions."""
    block_bits = max(4, min(40, int(scanned.count()).bit_length() - 13))
    blocks = scanned.select("fp").mapInPandas(
        lambda it: _filters(it, block_bits), "block long, occupied binary, run_end binary, remainders binary, width int, counts binary"
    )
    return blocks.groupBy("block").applyInPandas(lambda pdf: _merge(pdf, block_bits), "fp long, n long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, keep_id, group_size, kept, text_sha256), one row per input row.

    Texts are equal when they are identical after lower-casing A-Z; null counts as the empty text. The largest id of
    a group stays. Every partition builds a counting quotient filter of 64-bit fingerprints; the filters merge
    by block, and only texts whose fingerprint was counted twice are compared byte for byte (grouped by the whole text, which
    is pre-aggregated, so a hot text moves once per task). Repeated ids are rows of their own: all that hold the largest
    id are kept. A null id is smaller than any other; ids may have any type with an order. An empty table gives an empty result; other columns are ignored.
    """
    raw = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("t"))
    kind = docs.schema[id_col].dataType.simpleString()
    scanned = checkpoint(raw.mapInArrow(lambda it: _scan(it, False), f"id {kind}, fp long, sha string"))
    route = routing_bitmap(checkpoint(repeated_fingerprints(scanned)), "fp")
    candidates = raw.mapInArrow(lambda it: _scan(it, True, route), f"id {kind}, fp long, sha string, norm binary")
    groups = candidates.groupBy("fp", "sha", "norm").agg(F.max("id").alias("keep_id"), F.count("*").alias("n")).where("n > 1")
    joined = scanned.join(groups.select("fp", "sha", "keep_id", "n"), ["fp", "sha"], "left")
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("keep_id", "id").alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.expr("id <=> coalesce(keep_id, id)").alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = {
    "op3_exact_dedup": """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
}
QUERIES = {"op3_exact_dedup": op3_exact_dedup}
