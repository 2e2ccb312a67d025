"""Repeated passages across documents: suffix automata over reference shards, matching statistics, removal of long spans."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaica.llm.common import row_key, slices, stored, table, text_or_empty

WINDOW = 50
GRAM = 8
SHARD_SEGMENTS = 4096  # an automaton holds at most so many segments (some 200 MB); anchors with more go by single windows
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class SuffixAutomaton:
    """Generalised suffix automaton over words. Texts are added in ascending order of their number, so that the
    number kept in a state is the smallest of those whose text holds the state's word sequences."""

    def __init__(self):
        self.next, self.link, self.length, self.first = [{}], [-1], [0], [-1]

    def add(self, words: list, number: int) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w, number)

    def _extend(self, last: int, w, number: int) -> int:
        nxt, link, length, first = self.next, self.link, self.length, self.first
        q = nxt[last].get(w)
        if q is not None:
            return q if length[q] == length[last] + 1 else self._split(last, q, w)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        first.append(number)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, q, w)
        return cur

    def _split(self, p: int, q: int, w) -> int:
        nxt, link, length, first = self.next, self.link, self.length, self.first
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        first.append(first[q])
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = copy
            p = link[p]
        link[q] = copy
        return copy

    def earliest(self, words: list, window: int) -> list[int]:
        """For each window of the words, the smallest number whose text holds it, or -1. Walks the matching statistics,
        cut at the window's length."""
        nxt, link, length, first = self.next, self.link, self.length, self.first
        state, matched, out = 0, 0, []
        for at, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            state = nxt[state].get(w, 0)
            matched = matched + 1 if state else 0
            if matched >= window:
                while length[link[state]] >= window:
                    state = link[state]
                matched = window
            if at >= window - 1:
                out.append(first[state] if matched >= window else -1)
        return out


def _gram_hashes(h: np.ndarray) -> np.ndarray:
    g = np.zeros(len(h) - GRAM + 1, np.uint64)
    for j in range(GRAM):
        g = g * _ODD + h[j : len(h) - GRAM + 1 + j]
    g ^= g >> np.uint64(29)
    g *= _MIX
    return g ^ (g >> np.uint64(32))


def _first_min(g: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum of every `width` neighbours."""
    pos, val, have = np.arange(len(g)), g, 1
    while have < width:
        step = min(have, width - have)
        n = len(val) - step
        left = val[:n] <= val[step:]
        val, pos, have = np.where(left, val[:n], val[step:]), np.where(left, pos[:n], pos[step:]), have + step
    return pos


def anchors_of(text: bytes, window: int) -> tuple:
    """Segments of a document: (anchor, key, start, end). A window's anchor is the word 8-gram of least hash in it, the
    leftmost if several; windows start..end-1 in a row with the same anchor place form a segment, words start..end+window-2.
    Anchor and key (128 bits of the segment's words) depend on the words alone, so equal windows have equal anchors."""
    words = text.split()
    n = len(words)
    if n < window:
        return [], [], [], []
    g = _gram_hashes(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n))
    owner = _first_min(g, window - GRAM + 1)
    cut = np.flatnonzero(np.diff(owner)) + 1
    start, end = np.concatenate(([0], cut)), np.concatenate((cut, [len(owner)]))
    joined, after = b" ".join(words), np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    before = np.concatenate(([0], after))
    keys = [xxhash.xxh3_128_digest(joined[a:b]) for a, b in zip(before[start].tolist(), (after[end + window - 2] - 1).tolist())]
    return g[owner[start]].view(np.int64), keys, start, end


def _batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_ANCHORS = pa.schema([("k", pa.binary()), ("id", pa.int64()), ("anchor", pa.int64()), ("seg", pa.binary()), ("a", pa.int32()), ("b", pa.int32())])


def _anchors(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "t"):
        found = [anchors_of(t, window) for t in b.column(2).to_pylist()]
        n = [len(x[0]) for x in found]
        if any(n):
            at, some = pa.array(np.repeat(np.arange(len(n)), n)), [x for x in found if len(x[0])]
            anchor, start, end = (pa.array(np.concatenate([x[i] for x in some]), _ANCHORS.types[f]) for i, f in ((0, 2), (2, 4), (3, 5)))
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), anchor, pa.array([k for x in some for k in x[1]], pa.binary()), start, end], schema=_ANCHORS)


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Segment texts from the documents that represent them."""
    schema = pa.schema([("anchor", pa.int64()), ("seg", pa.binary()), ("low", pa.int64()), ("n_segs", pa.int64()), ("words", pa.binary())])
    for b in slices(batches, "t"):
        rows: list[list] = [[] for _ in schema]
        for text, wanted in zip(b.column("t").to_pylist(), b.column("wanted").to_pylist()):
            words = text.split()
            for x in wanted:
                for col, v in zip(rows, (x["anchor"], x["seg"], x["low"], x["n_segs"], b" ".join(words[x["a"] : x["b"] + window - 1]))):
                    col.append(v)
        yield _batch(schema, rows)


_FIRSTS = "anchor long, seg binary, firsts array<struct<s:int,e:int,low:long>>"
_RANGES = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("low", pa.int64())]))


def _runs(lows: list[int]) -> list[dict]:
    a = np.array(lows, np.int64)
    cut = np.flatnonzero(np.diff(a)) + 1
    s, e = np.concatenate(([0], cut)), np.concatenate((cut, [len(a)]))
    return [{"s": int(x), "e": int(y), "low": int(a[x])} for x, y in zip(s, e)]


def _stream(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Per anchor: stream each segment through the automaton of the segments of smaller documents, then add it."""
    schema = pa.schema([("anchor", pa.int64()), ("seg", pa.binary()), ("firsts", _RANGES)])
    for b in batches:
        rows: list[list] = [[], [], []]
        for anchor, members in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            automaton = SuffixAutomaton()
            for m in sorted(members, key=lambda m: (m["low"], m["seg"])):
                words = m["words"].split()
                found = automaton.earliest(words, window)
                if -1 in found:
                    automaton.add(words, m["low"])
                for col, v in zip(rows, (anchor, m["seg"], _runs([m["low"] if x == -1 else x for x in found]))):
                    col.append(v)
        yield _batch(schema, rows)


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("anchor", pa.int64()), ("seg", pa.binary()), ("low", pa.int64()), ("i", pa.int32()), ("w", pa.binary())])
    for b in slices(batches, "words"):
        rows: list[list] = [[] for _ in schema]
        for anchor, seg, low, text in zip(*(b.column(c).to_pylist() for c in ("anchor", "seg", "low", "words"))):
            words = text.split()
            for i in range(len(words) - window + 1):
                for col, v in zip(rows, (anchor, seg, low, i, xxhash.xxh3_128_digest(b" ".join(words[i : i + window])))):
                    col.append(v)
        yield _batch(schema, rows)


def _rest(batches: Iterator[pa.RecordBatch], schema: pa.Schema, window: int) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "t"):
        n, gone, sha = [], [], []
        for text, covers in zip(b.column("t").to_pylist(), b.column("covers").to_pylist()):
            words = text.split()
            n.append(len(words))
            if covers:
                keep = np.ones(len(words) + 1, np.int64)
                edge = np.zeros(len(words) + 1, np.int64)
                for c in covers:
                    edge[c["s"]] += 1
                    edge[min(c["e"], len(words))] -= 1
                keep = np.cumsum(edge)[: len(words)] == 0
                words = [words[i] for i in np.flatnonzero(keep).tolist()]
            gone.append(n[-1] - len(words))
            sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha)], schema=schema)


def removed_spans(docs: DataFrame, window: int = WINDOW, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """(k, covers): the word ranges to remove of each document (columns k, id, t) that has any.

    Windows meet by their anchor. Of each anchor that documents share, the distinct segments are the reference shard: its suffix
    automaton is built in order of document number, and every segment is streamed through it. A shard of one distinct segment needs no
    streaming: all its windows first start in its smallest document. Segments count as equal by 128 bits of their words. Anchors with more
    than shard_segments distinct segments are treated window by window instead, grouped by 128 bits of the whole window.
    """
    anchors = stored(docs.select("k", "id", "t").mapInArrow(lambda it: _anchors(it, window), "k binary, id long, anchor long, seg binary, a int, b int"))
    segs = anchors.groupBy("anchor", "seg").agg(F.min(F.struct("id", "k", "a", "b")).alias("rep"), F.max("id").alias("high"))
    shared = segs.groupBy("anchor").agg(F.min("rep.id").alias("lo"), F.max("high").alias("hi"), F.count("*").alias("n_segs")).where("lo < hi").select("anchor", "n_segs")
    segs = stored(segs.join(shared, "anchor").select("anchor", "seg", "rep", "n_segs"))
    alone = segs.where("n_segs = 1").select("anchor", "seg", F.array(F.struct(F.lit(0).alias("s"), F.expr("rep.b - rep.a").alias("e"), F.col("rep.id").alias("low"))).alias("firsts"))
    wanted = segs.where("n_segs > 1").groupBy(F.col("rep.k").alias("k")).agg(
        F.collect_list(F.struct("anchor", "seg", F.col("rep.id").alias("low"), "n_segs", "rep.a", "rep.b")).alias("wanted")
    )
    texts = stored(docs.select("k", "t").join(wanted, "k").dropDuplicates(["k"]).select("t", "wanted").mapInArrow(lambda it: _cut(it, window), "anchor long, seg binary, low long, n_segs long, words binary"))
    shards = texts.where(F.col("n_segs") <= shard_segments).groupBy("anchor").agg(F.collect_list(F.struct("seg", "low", "words")).alias("members"))
    streamed = shards.mapInArrow(lambda it: _stream(it, window), _FIRSTS)
    windows = texts.where(F.col("n_segs") > shard_segments).select("anchor", "seg", "low", "words").mapInArrow(lambda it: _windows(it, window), "anchor long, seg binary, low long, i int, w binary")
    lows = windows.groupBy("w").agg(F.min("low").alias("least"))
    single = windows.join(lows, "w").groupBy("anchor", "seg").agg(F.collect_list(F.struct(F.col("i").alias("s"), F.expr("i + 1").alias("e"), F.col("least").alias("low"))).alias("firsts"))
    firsts = alone.unionByName(streamed).unionByName(single)
    covers = anchors.join(firsts, ["anchor", "seg"]).select(
        "k", F.expr(f"transform(filter(firsts, f -> f.low < id), f -> struct(a + f.s as s, a + f.e + {window - 1} as e))").alias("c")
    )
    return covers.where("size(c) > 0").groupBy("k").agg(F.flatten(F.collect_list("c")).alias("covers"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """(id_col, n_words, n_removed, kept_sha256), one row per input row.

    Words lie between ASCII white space and stay unchanged. A word goes if it is in a window of `window` words that also
    starts in a row with a smaller id; windows are judged on the input. Null and empty texts have no words. Rows that
    share an id never remove each other's words; a null id is smaller than any other. An empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType
    raw = docs.select(
        row_key(id_col, text_or_empty(text_col)).alias("k"),
        F.col(id_col).alias("shown"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"),
        text_or_empty(text_col).cast("binary").alias("t"),
    )
    spans = removed_spans(raw.select("k", "id", "t"), window, shard_segments)
    joined = raw.select("k", "shown", "t").join(spans, "k", "left").select(F.col("shown").alias("id"), "t", "covers")
    arrow = pa.schema([("id", _arrow_type(kind)), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
    return joined.mapInArrow(lambda it: _rest(it, arrow, window), f"id {kind.simpleString()}, n_words long, n_removed long, kept_sha256 string").withColumnRenamed("id", id_col)


def _arrow_type(kind):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


QUERIES = {"op5_substring_dedup": op5_substring_dedup}
ORACLE = {
    "op5_substring_dedup": r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
h AS (SELECT doc_id, i, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS win FROM p),
f AS (SELECT win, min(doc_id) AS first FROM h WHERE i <= n - 49 GROUP BY win),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM h JOIN f USING (win) WHERE i <= n - 49 AND first < doc_id),
k AS (SELECT p.doc_id, count(c.i) AS gone, string_agg(CASE WHEN c.i IS NULL THEN word END, ' ' ORDER BY p.i) AS kept FROM p LEFT JOIN c USING (doc_id, i) GROUP BY p.doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
}
