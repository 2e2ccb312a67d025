"""Packing by non-negative least squares over the histogram of lengths."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from mosaica.llm.common import routed, routing_bitmap, slices, stored, table, text_or_empty

WINDOW = 1024
DEPTH = 3  # lengths that a combination has at most
END_ID = 0  # follows every document
BLOCK_COLUMNS = 64  # combinations that join the solution at a time
MAX_ROUNDS = 60
CACHE_UNITS = 150_000  # in each half of a worker's cache
TEXT_SLICE = 8 << 20


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# ---- token ids ----


class UnitEncoder:
    """Token ids of texts as little-endian unsigned 32-bit values, for byte-level vocabularies whose pre-tokenizer puts a space before the word it precedes.

    A space between other characters always starts a pre-token, so a text is cut there, the distinct units of a slice are encoded once and texts put
    together from them by index, in Arrow. Texts with white space that does not split so, or with special tokens, are encoded whole. Units
    are kept between slices: when the young half of the cache is full it becomes the old half, so frequent units stay. Words of letters, most of what is
    new, go many at a time through a byte-pair encoder on the same vocabulary, whose ids are its merge ranks; all else goes through the tokenizer itself.
    """

    BLANK = r"[\t-\r \x{85}\p{Z}]"
    WHOLE = BLANK + " (" + BLANK + r"|$)|<\|"  # a space between blanks, or at the end after one
    _PART = r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)"  # a word and signs after it: pre-tokens of their own
    WORD, LINE = re.compile(_PART), re.compile(_PART + "\n" + _PART)

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.words = _word_encoder(self.tokenizer)
        self.starts = np.zeros(max(vocabulary.values()) + 1, bool)
        self.starts[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True  # the byte-level sign of a space
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> list[bytes]:
        whole = pc.match_substring_regex(texts, self.WHOLE)
        units = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        distinct = units.flatten().dictionary_encode()
        first = units.offsets.to_numpy()[:-1]
        heads = units.flatten().take(pa.array(first)).dictionary_encode()  # no space stands before them
        values = pa.array(self._units(distinct.dictionary.to_pylist()) + self._each(heads.dictionary.to_pylist()), pa.binary())
        at = distinct.indices.to_numpy().copy()
        at[first] = heads.indices.to_numpy() + len(distinct.dictionary)
        out = pc.binary_join(pa.ListArray.from_arrays(units.offsets, values.take(pa.array(at))), b"").to_pylist()
        rest = np.flatnonzero(whole)
        for i, ids in zip(rest.tolist(), self._each(texts.take(pa.array(rest)).to_pylist())):
            out[i] = ids
        return out

    def _units(self, units: list[str]) -> list[bytes]:
        """Ids of " " + unit for every unit."""
        if len(self.young) > CACHE_UNITS:
            self.young, self.old = {}, self.young
        known, old = self.young, self.old
        word, line = self.WORD.fullmatch, self.LINE.fullmatch
        words, heads, others, parts = set(), set(), [], {}  # heads: words that start a line
        for u in units:
            if u in known:
                continue
            if u in old:
                known[u] = old[u]
                continue
            m = word(u) or line(u)
            if not m:
                others.append(u)
                continue
            own = m.groups()
            words.add(own[0])
            if own[0] != u:
                parts[u] = own
                if len(own) == 4:
                    heads.add(own[2])
        self._learn([w for w in words if w not in known])
        known.update(zip(others, self._each([" " + u for u in others])))
        signs = sorted({p for own in parts.values() for p in own[1::2]})
        ids = dict(zip(signs, self._each(signs)))
        first = self._line_heads(sorted(heads))
        for u, own in parts.items():
            known[u] = known[own[0]] + ids[own[1]] + (first[own[2]] + ids[own[3]] if len(own) == 4 else b"")
        return list(map(known.__getitem__, units))

    def _line_heads(self, words: list[str]) -> dict[str, bytes]:
        """Ids of a line's end and the word after it, many at a time: the end is a token of its own before every word."""
        out, end = {}, self.words("\n")
        for at in range(0, len(words) if len(end) == 1 else 0, 500):
            some = words[at : at + 500]
            ids = np.array(self.words("\n" + "\n".join(some)), "<u4")
            starts, raw = np.flatnonzero(ids == end[0]).tolist(), ids.tobytes()
            out.update((w, raw[4 * a : 4 * b]) for w, a, b in zip(some, starts, [*starts[1:], len(ids)]))
        return out or dict(zip(words, self._each(["\n" + w for w in words])))

    def _learn(self, words: list[str]) -> None:
        """Words of letters, many at a time: a token that starts with a space starts a word."""
        for at in range(0, len(words), 500):
            some = words[at : at + 500]
            ids = np.array(self.words(" " + " ".join(some)), "<u4")
            starts = np.flatnonzero(self.starts[ids]).tolist()
            raw = ids.tobytes()
            self.young.update((w, raw[4 * a : 4 * b]) for w, a, b in zip(some, starts, [*starts[1:], len(ids)]))


def _word_encoder(tokenizer: Tokenizer):
    """Ids of words of letters, each with a space or a line's end before it. A byte-level vocabulary without a normalizer whose merges are numbered in order has its ids as
    merge ranks, and a faster encoder gives the tokenizer's ids; any other goes through the tokenizer."""
    kind = json.loads(tokenizer.to_str())
    model = kind["model"]
    merged = [model["vocab"].get(a + b) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model.get("merges", []))]
    ranked = model["type"] == "BPE" and kind["normalizer"] is None and None not in merged and merged == sorted(merged)
    if not (ranked and kind["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}):
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others are shown from U+0100 on
    byte = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
    special = {t["content"] for t in kind["added_tokens"]}
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    return tiktoken.Encoding("words", pat_str=r"\n| ?[^ \n]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@lru_cache(maxsize=1)
def _encoder(path: str) -> UnitEncoder:
    return UnitEncoder(path)


_MEASURED = [("part", pa.int32()), ("tokens", pa.int64()), ("rest", pa.int64()), ("nth", pa.int64()), ("first_full", pa.int64()), ("crcs", pa.list_(pa.int64())), ("rest_crc", pa.int64()), ("ids", pa.binary())]


def _measured(batches: Iterator[pa.RecordBatch], path: str, window: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Of every text its length in ids, the checksums of its full windows, and the ids of the rest; `nth` numbers the rests of one length, and
    `first_full` the full windows, within the task."""
    end, encoder, part = np.array([END_ID], "<u4").tobytes(), _encoder(path), TaskContext.get().partitionId()
    seen, full = [0] * window, 0
    schema = pa.schema([("id", kind), ("row", pa.int64()), *_MEASURED])
    for b in slices(batches, "t", TEXT_SLICE):
        rows: list[list] = [[] for _ in range(7)]
        for ids in encoder.encode(b.column("t")):
            ids += end
            n = len(ids) // 4
            whole, rest = divmod(n, window)
            crcs = [zlib.crc32(ids[4 * window * k : 4 * window * (k + 1)]) for k in range(whole)]
            tail = ids[4 * window * whole :]
            for col, v in zip(rows, (n, rest, seen[rest], full, crcs, zlib.crc32(tail), tail)):
                col.append(v)
            seen[rest] += 1
            full += whole
        own = [pa.array(np.full(b.num_rows, part, np.int32)), *(pa.array(c, t) for c, (_, t) in zip(rows, _MEASURED[1:]))]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("row"), *own], schema=schema)


# ---- the plan: from a histogram of lengths to intervals of their numbers ----


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Every choice of up to DEPTH of the given lengths (ascending, repeats allowed) that fills the window, one a row, ascending, 0 where shorter."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    out = [np.array([[0, 0, window]], np.int64)] if have[window] else []
    low = lengths[lengths * 2 <= window]
    pairs = np.stack([np.zeros_like(low), low, window - low], axis=1)
    out.append(pairs[have[window - low]])
    for a in lengths[lengths * DEPTH <= window]:
        b = lengths[(lengths >= a) & (2 * lengths <= window - a)]
        c = window - a - b
        out.append(np.stack([np.full(len(b), a), b, c], axis=1)[have[c]])
    return np.concatenate(out) if out else np.zeros((0, DEPTH), np.int64)


def nnls(columns: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which columns, how often): non-negative counts x that minimise |A x - target|, A having for each column a one at every length it names.

    The active-set method of Lawson and Hanson. The columns of steepest descent that name different lengths join together, at most BLOCK_COLUMNS of them; those that
    the least-squares solution turns negative leave on the way to it. A basic solution has no more columns than there are lengths, so counts stay
    large and rounding costs little."""
    size = len(target)
    chosen, x = np.zeros(0, np.int64), np.zeros(0)

    def matrix(which: np.ndarray) -> np.ndarray:
        a = np.zeros((size, len(which)))
        for d in range(columns.shape[1]):
            np.add.at(a, (columns[which, d], np.arange(len(which))), columns[which, d] > 0)
        return a

    block, scale = BLOCK_COLUMNS, max(1.0, float(np.abs(target).max()))
    residual, best = target.astype(float), np.inf
    for _ in range(MAX_ROUNDS):
        padded = residual.copy()
        padded[0] = 0.0
        slope = padded[columns].sum(1)
        slope[chosen] = 0.0
        order = np.argsort(-slope, kind="stable")[: 64 * block]
        taken, new = np.zeros(size, bool), []
        for j in order[slope[order] > 1e-9 * scale].tolist():
            own = columns[j][columns[j] > 0]
            if not taken[own].any():
                taken[own] = True
                new.append(j)
                if len(new) == block:
                    break
        if not new:
            break
        chosen, x = np.concatenate((chosen, np.array(new, np.int64))), np.concatenate((x, np.zeros(len(new))))
        while len(chosen):
            a = matrix(chosen)
            s = np.linalg.solve(a.T @ a + 1e-8 * np.eye(len(chosen)), a.T @ target)
            if (s > 0).all():
                x = s
                break
            falling = s <= 0
            step = np.min(x[falling] / np.maximum(x[falling] - s[falling], 1e-300))
            x = x + step * (s - x)
            stay = ~(falling & (x <= 1e-9 * scale))
            chosen, x = chosen[stay], x[stay]
        residual = target - (matrix(chosen) @ x if len(chosen) else 0.0)
        norm = float((residual[1:] ** 2).sum())
        if norm <= 1e-12 * scale * scale:
            break
        if norm > best * (1 - 1e-3):
            block //= 4
            if not block:
                break
        best = min(best, norm)
    return chosen, x


@dataclass
class Plan:
    """Where the numbered rests of every length go. Interval i holds the numbers from `low` of length `length` up to the next interval's: they lie in sequences from `first` on at
    `offset`, one each, or, where `offset` is -1, end to end from place `first` of the line that is cut into windows from sequence `line` on."""

    keys: np.ndarray  # length << 44 | low, ascending
    low: np.ndarray
    first: np.ndarray
    offset: np.ndarray
    line: int
    window: int
    cuts: np.ndarray  # ends of the last, shorter sequences of the line


def make_plan(histogram: np.ndarray, window: int = WINDOW) -> Plan:
    """histogram[l]: how many rests have l ids. Combinations that fill a window get whole counts: the least-squares solution rounded, and lowered where a
    length would run out. What remains is laid end to end, longest first, and cut where a window ends; the last sequence is cut into powers of two, which need no padding."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    used = np.zeros_like(left)
    intervals: list[tuple[int, int, int, int]] = []
    sequences = 0
    columns = combinations(np.flatnonzero(left), window)
    if len(columns):
        chosen, x = nnls(columns, left.astype(float))
        for j, want in sorted(zip(chosen.tolist(), np.rint(x).astype(np.int64).tolist()), key=lambda v: (-v[1], v[0])):
            own = columns[j][columns[j] > 0]
            names, times = np.unique(own, return_counts=True)
            repeat = int(min(want, (left[names] // times).min()))
            if repeat <= 0:
                continue
            offset = 0
            for length in own.tolist():
                intervals.append((length, int(used[length]), sequences, offset))
                used[length] += repeat
                left[length] -= repeat
                offset += length
            sequences += repeat
    place = 0
    for length in np.flatnonzero(left)[::-1].tolist():
        intervals.append((length, int(used[length]), place, -1))
        place += int(left[length]) * length
    whole, last = divmod(place, window)
    ends = np.cumsum([1 << k for k in range(window.bit_length(), -1, -1) if last >> k & 1], dtype=np.int64) + whole * window
    intervals.sort()
    length, low, first, offset = (np.array(c, np.int64) for c in zip(*intervals)) if intervals else (np.zeros(0, np.int64),) * 4
    return Plan(length << 44 | low, low, first, offset, sequences, window, ends)


def place(plan: Plan, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, ...]:
    """(which, at, size, sequence, offset) of the pieces of the rests with these lengths and numbers; a rest that a window's end cuts has several."""
    i = np.searchsorted(plan.keys, length << 44 | number, "right") - 1
    offset = plan.offset[i]
    alone = np.flatnonzero(offset >= 0)
    out = [(alone, np.zeros(len(alone), np.int64), length[alone], plan.first[i[alone]] + number[alone] - plan.low[i[alone]], offset[alone])]
    line = np.flatnonzero(offset < 0)
    start = plan.first[i[line]] + (number[line] - plan.low[i[line]]) * length[line]
    stop, at = start + length[line], start.copy()
    full = plan.cuts[-1] // plan.window * plan.window if len(plan.cuts) else np.iinfo(np.int64).max
    # Places from `full` on are cut by `cuts`. A last sequence of whole length does not occur there.
    while len(line):
        k = np.searchsorted(plan.cuts, at, "right")
        in_tail = at >= full
        begin = np.where(in_tail, np.where(k > 0, plan.cuts[np.maximum(k - 1, 0)] if len(plan.cuts) else 0, full), at // plan.window * plan.window)
        begin = np.maximum(begin, np.where(in_tail, full, 0))
        end = np.where(in_tail, plan.cuts[np.minimum(k, len(plan.cuts) - 1)] if len(plan.cuts) else 0, begin + plan.window)
        sequence = plan.line + np.where(in_tail, full // plan.window + k if len(plan.cuts) else 0, at // plan.window)
        size = np.minimum(stop, end) - at
        out.append((line, at - start, size, sequence, at - begin))
        at = at + size
        go = at < stop
        line, start, stop, at = line[go], start[go], stop[go], at[go]
    return tuple(np.concatenate(c) for c in zip(*out))


def _placed(batches: Iterator[pa.RecordBatch], plan) -> Iterator[pa.RecordBatch]:
    for b in batches:
        length, number = (b.column(c).to_numpy() for c in ("rest", "number"))
        which, at, size, sequence, offset = place(plan.value, length, number)
        rows = b.select(["id", "row", "tokens", "rest", "rest_crc"]).take(pa.array(which))
        cut = size < length[which]
        yield pa.RecordBatch.from_arrays([*rows.columns, *map(pa.array, (at, size, sequence, offset, cut))], [*rows.schema.names, "at", "length", "sequence_id", "offset", "cut"])


def pack_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, window: int = WINDOW) -> DataFrame:
    """(id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece of a row of docs.

    Every document gives full windows, each a sequence of its own, and a rest. How often each combination of up to three rest lengths fills a window is solved
    by non-negative least squares against the histogram of all rests; the rests it leaves are laid end to end and cut at windows, the last one at
    powers of two. So no sequence has padding, and at most one rest a window of the leftovers is cut. The histogram has `window` cells and the plan some times
    as many intervals, whatever the rows: rests of one length are numbered by (partition, number within it) and a running sum over partitions, so a length that a third of
    all rows share is never in one task.

    A null text counts as empty and gives one piece of length 1 (the end id). Every row is a document of its own, rows equal in id and text too;
    null ids pass through. An empty table gives an empty result; other columns are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark, kind = docs.sparkSession, docs.schema[id_col].dataType
    path, arrow = tokenizer or default_tokenizer(), to_arrow_type(kind)
    raw = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), text_or_empty(text_col).alias("t"))
    schema = f"id {kind.simpleString()}, row long, part int, tokens long, rest long, nth long, first_full long, crcs array<long>, rest_crc long, ids binary"
    measured = stored(raw.mapInArrow(lambda it: _measured(it, path, window, arrow), schema))  # written once, so that numbers stay as they are

    rests = measured.where("rest > 0")
    counts = rests.groupBy("part", "rest").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = stored(counts.select("part", "rest", F.coalesce(before, F.lit(0)).alias("base"), "n"))
    histogram = np.zeros(window + 1, np.int64)
    for length, n in bases.groupBy("rest").agg(F.sum("n")).collect():  # less than `window` rows
        histogram[length] = n
    plan = spark.sparkContext.broadcast(make_plan(histogram, window))

    numbered = rests.join(bases.drop("n"), ["part", "rest"]).select("id", "row", "tokens", "rest", "rest_crc", (F.col("nth") + F.col("base")).alias("number"))
    out = f"id {kind.simpleString()}, row long, tokens long, rest long, rest_crc long, at long, length long, sequence_id long, offset long, cut boolean"
    placed = stored(numbered.mapInArrow(lambda it: _placed(it, plan), out))
    # Of the rests that were cut the ids are fetched where they lie, for the checksums of their pieces.
    severed = placed.where("cut").withColumn("h", F.xxhash64("row"))
    route = routing_bitmap(severed.select("h").distinct(), "h")

    def reached(batches):
        for b in batches:
            yield b.filter(pa.array(routed(b.column("h").to_numpy().view(np.uint64), route))).select(["row", "ids"])

    ids = rests.select("row", "ids", F.xxhash64("row").alias("h")).mapInArrow(reached, "row long, ids binary")
    own = F.crc32(F.substring("ids", (F.col("at") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int")))
    start = (F.col("tokens") - F.col("rest") + F.col("at")).alias("start")
    columns = [F.col("id").alias(id_col), start, "length", "ids_crc32", F.col("tokens").alias("doc_tokens"), "sequence_id", "offset"]
    whole = placed.where("not cut").withColumn("ids_crc32", F.col("rest_crc")).select(*columns)
    cut = severed.join(ids, "row").withColumn("ids_crc32", own).select(*columns)
    number = -1 - (F.shiftleft(F.col("part").cast("long"), 40) + F.col("first_full") + F.col("k"))  # below those of the plan
    full = measured.select("id", "tokens", "part", "first_full", F.posexplode("crcs").alias("k", "ids_crc32")).select(
        F.col("id").alias(id_col), (F.col("k").cast("long") * window).alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32", F.col("tokens").alias("doc_tokens"), number.alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return full.unionByName(whole).unionByName(cut)


def op11_length_packing(spark, sf_dir: str) -> DataFrame:
    return pack_lengths(table(spark, sf_dir, "documents"))


QUERIES = {"op11_length_packing": op11_length_packing}
ORACLE: dict[str, str] = {}
