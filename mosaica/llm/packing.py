"""Packing token sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from mosaica.llm.common import slices, stored, table, text_or_empty

CAPACITY = 2048
END_ID = 0  # follows every document
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 40  # an epoch ends before if an island reaches the lower bound
POPULATION = 8
BLOCK_PIECES = 2048
BUNDLE_SHARE = 64  # pieces shorter than such a part of a sequence are bundled
GROUP_PIECES = 65_536  # short pieces that are put end to end in one group
LEFT_BINS = 4  # least filled sequences of a block that are packed again with those of other blocks
CACHE_PARTS = 200_000  # in each half of a task's cache, some 50 MB in all
TEXT_SLICE = 8 << 20  # bytes of text whose words are encoded together


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Token ids of texts as little-endian unsigned 32-bit values. The vocabulary's pre-tokenizer never joins across white space, so the
    distinct words of a slice are encoded once and its texts put together from them by index, all in Arrow.

    Plain words are cut as the pre-tokenizer cuts them, and the distinct parts of a slice encoded a hundred at a time; the token that ends a
    part is known by its suffix. Parts are kept between slices: when the young half of the cache is full it becomes the old half, so
    frequent parts stay.
    """

    # Fixed pattern of the pre-tokenizer, on lower-case ASCII and Latin-1 letters.
    PARTS = r"('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+)"
    PLAIN = r"^[\x21-;=-~À-ÖØ-öø-ÿ]*$"  # without <, with which special tokens start

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.young, self.old = {}, {}

    def encode(self, texts: pa.Array) -> list[bytes]:
        # The normalizer lower-cases; special tokens, which start with <, are matched before it.
        words = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<"), texts, pc.ascii_lower(texts)))
        distinct = words.flatten().dictionary_encode()
        return _joined(words.offsets, self._words(distinct.dictionary), distinct.indices).to_pylist()

    def _words(self, words: pa.Array) -> pa.Array:
        plain = pc.match_substring_regex(words, self.PLAIN)
        parts = pc.split_pattern(pc.replace_substring_regex(pc.utf8_lower(words.filter(plain)), self.PARTS, "\\1 "), " ")
        distinct = parts.flatten().dictionary_encode()
        ids = _joined(parts.offsets, pa.array(self._parts(distinct.dictionary.to_pylist()), pa.binary()), distinct.indices)
        if len(ids) == len(words):
            return ids
        other = self.tokenizer.encode_batch_fast(words.filter(pc.invert(plain)).to_pylist(), add_special_tokens=False)
        both = pa.concat_arrays([ids, pa.array([np.array(e.ids, "<u4").tobytes() for e in other], pa.binary())])
        at = np.where(plain, np.cumsum(plain) - 1, len(ids) + np.cumsum(pc.invert(plain)) - 1)
        return both.take(pa.array(at))

    def _parts(self, parts: list[str]) -> list[bytes]:
        if len(self.young) > CACHE_PARTS:
            self.young, self.old = {}, self.young
        known, old, new = self.young, self.old, []
        for p in parts:
            if p not in known:
                if p in old:
                    known[p] = old[p]
                elif p:
                    new.append(p)
        known[""] = b""
        for at in range(0, len(new), 100):
            some = new[at : at + 100]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            stops = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(stops) == len(some):
                raw = ids.tobytes()
                known.update((p, raw[4 * a : 4 * b]) for p, a, b in zip(some, [0, *stops], stops))
            else:
                known.update((p, np.array(e.ids, "<u4").tobytes()) for p, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)))
        return list(map(known.__getitem__, parts))


def _joined(offsets: pa.Array, values: pa.Array, at: pa.Array) -> pa.Array:
    """For every list of positions, the values there as one binary value."""
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values.take(at)), b"")


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """One encoder a worker; its cache holds at most some 2 * CACHE_PARTS parts between tasks."""
    return WordEncoder(path)


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    end, encoder = np.array([END_ID], "<u4").tobytes(), _encoder(path)
    schema = pa.schema([("id", kind), ("row", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    for part in slices(batches, "t", TEXT_SLICE):
        rows: list[list] = [[] for _ in range(5)]
        for at, ids in enumerate(encoder.encode(part.column("t"))):
            ids += end
            for piece, cut in enumerate(range(0, len(ids), 4 * capacity)):
                own = ids[cut : cut + 4 * capacity]
                for col, v in zip(rows, (at, piece, cut // 4, len(own) // 4, zlib.crc32(own))):
                    col.append(v)
        at = pa.array(rows[0], pa.int64())
        yield pa.RecordBatch.from_arrays([part.column("id").take(at), part.column("row").take(at), *(pa.array(c, f.type) for c, f in zip(rows[1:], list(schema)[2:]))], schema=schema)


# ---- one island: a population of packings; a packing is a list of bins, a bin a list of item numbers ----


def best_fit(items: list[int], size: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Add the items in their order, each to the fullest bin that takes it."""
    bins = [b[:] for b in bins]
    free = sorted((capacity - sum(map(size.__getitem__, b)), n) for n, b in enumerate(bins))
    for i in items:
        at = bisect_left(free, (size[i], -1))
        if at == len(free):
            bins.append([])
            room, n = capacity, len(bins) - 1
        else:
            room, n = free.pop(at)
        bins[n].append(i)
        insort(free, (room - size[i], n))
    return bins


def largest_first(items: list[int], size: list[int]) -> list[int]:
    return sorted(items, key=lambda i: -size[i])


def fills(bins: list[list[int]], size: list[int]) -> np.ndarray:
    return np.array([sum(map(size.__getitem__, b)) for b in bins])


def fitness(bins: list[list[int]], size: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins are better and, among equally many, a higher mean squared fill."""
    return -len(bins), float(((fills(bins, size) / capacity) ** 2).mean()) if bins else 0.0


def lower_bound(size: list[int], capacity: int) -> int:
    """No packing has fewer bins. For every k: items above capacity - k stand alone, those above half a bin take one each, and what
    the items from k to half a bin do not find room for beside them needs bins of its own."""
    s = np.sort(np.array(size, np.int64))
    sums = np.concatenate(([0], np.cumsum(s)))
    half = np.searchsorted(s, capacity // 2, "right")
    k = np.unique(np.concatenate(([0], s[:half])))
    low, high = np.searchsorted(s, k, "left"), np.searchsorted(s, capacity - k, "right")
    alone, halves, small = len(s) - high, high - half, sums[half] - sums[low]
    room = halves * capacity - (sums[high] - sums[half])
    return int((alone + halves + np.maximum(0, -((room - small) // capacity))).max())


def crossover(a: list, b: list, size: list[int], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """Inject the well-filled bins of b into a (all up to a quantile of their room, drawn below 0.6), drop the bins of a that hold an
    injected item, and best-fit what they leave, largest first."""
    room = capacity - fills(b, size)
    injected = [b[j] for j in np.flatnonzero(room <= np.quantile(room, 0.6 * rng.random()))]
    taken = {i for x in injected for i in x}
    kept, loose = [], []
    for x in a:
        if taken.isdisjoint(x):
            kept.append(x)
        else:
            loose += [i for i in x if i not in taken]
    return best_fit(largest_first(loose, size), size, injected + kept, capacity)


def mutate(a: list, size: list[int], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """Empty some bins, those with more room sooner, and best-fit their items, largest first."""
    room = capacity - fills(a, size) + 0.01
    gone = set(rng.choice(len(a), min(len(a), int(rng.integers(2, 3 + len(a) // 8))), replace=False, p=room / room.sum()).tolist())
    loose = [i for j in gone for i in a[j]]
    return best_fit(largest_first(loose, size), size, [x for j, x in enumerate(a) if j not in gone], capacity)


def evolve(size: list[int], capacity: int, seed, elite: list | None = None, generations: int = GENERATIONS) -> tuple[list[list[int]], int]:
    """One epoch of an island: its best packing, and after how many generations it stood.

    The first people are the elite, or else one that best-fits the items largest first, and others that best-fit them in random order. Two parents
    give a child, the better one's full bins injected into the other; half of the children are mutated; a child of new fitness takes the place of the
    worst. The epoch ends at the lower bound. The best packing so far is never lost.
    """
    rng = np.random.default_rng(seed)
    bound = lower_bound(size, capacity)
    first = elite or best_fit(largest_first(list(range(len(size))), size), size, [], capacity)
    if len(first) <= bound:
        return first, 0
    people = [first] + [best_fit(rng.permutation(len(size)).tolist(), size, [], capacity) for _ in range(POPULATION - 1)]
    ranked = sorted(((fitness(p, size, capacity), p) for p in people), key=lambda x: x[0], reverse=True)
    for generation in range(generations):
        if -ranked[0][0][0] <= bound:
            return ranked[0][1], generation
        better, other = sorted(rng.choice(len(ranked), 2, replace=False).tolist())
        child = crossover(ranked[other][1], ranked[better][1], size, capacity, rng)
        if rng.random() < 0.5:
            child = mutate(child, size, capacity, rng)
        worth = fitness(child, size, capacity)
        if all(worth != r[0] for r in ranked):
            ranked[-1] = (worth, child)
            ranked.sort(key=lambda x: x[0], reverse=True)
    return ranked[0][1], generations


def _islander(capacity: int, epoch: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Evolve one island of a block; the elite of the block arrives as bin numbers."""
        pdf = pdf.sort_values(["row", "piece"], kind="stable").reset_index(drop=True)
        elite = [g.tolist() for g in pdf.groupby("bin").indices.values()] if epoch else None
        best, spent = evolve(pdf["length"].tolist(), capacity, [int(pdf["block"].iloc[0]), int(pdf["island"].iloc[0]), epoch], elite)
        out = np.empty(len(pdf), np.int64)
        for n, members in enumerate(best):
            out[members] = n
        return pdf.assign(bin=out, bins=len(best), generations=spent)

    return run


def evolved_blocks(pieces: DataFrame, blocks: int, capacity: int, salt: int) -> DataFrame:
    """(row, piece, length, block, bin, bins, generations) of pieces (row, piece, length), dealt at random into `blocks` blocks, a bounded group
    each. Several islands evolve a block from different seeds; after an epoch every island of a block receives the elite, the packing
    with the fewest sequences among them, and evolves on; the best of the last epoch stands."""
    dealt = pieces.select("row", "piece", "length", F.pmod(F.xxhash64("row", "piece", F.lit(salt)), F.lit(blocks)).alias("block"))
    islands = F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island")
    schema = "row long, piece int, length long, block long, island int, bin long, bins int, generations int"
    none = [F.lit(None).cast(t).alias(c) for c, t in (("bin", "long"), ("bins", "int"), ("generations", "int"))]
    current = dealt.select("*", islands, *none)
    for epoch in range(EPOCHS):
        evolved = stored(current.groupBy("block", "island").applyInPandas(_islander(capacity, epoch), schema))
        best = evolved.groupBy("block").agg(F.min(F.struct("bins", "island")).alias("best"))
        elite = evolved.join(best, "block").where("island = best.island").drop("island", "best")
        current = elite.select("row", "piece", "length", "block", islands, "bin", "bins", "generations")
    return elite


def bundled(pieces: DataFrame, count: int, unit: int) -> DataFrame:
    """(row, piece, length, lead_row, lead_piece, item_length) of pieces: those shorter than `unit` are put end to end within groups of bounded size and bundled,
    so that every item but one a group is about `unit` long at least and less than twice that; longer pieces are items of their own. The first piece of
    an item names it."""
    group = F.when(F.col("length") < unit, F.pmod(F.xxhash64("row", "piece", F.lit(-1)), F.lit(-(-count // GROUP_PIECES))))
    small = pieces.withColumn("group", group).where("group is not null")
    run = Window.partitionBy("group").orderBy("row", "piece").rowsBetween(Window.unboundedPreceding, -1)
    small = small.withColumn("bundle", F.floor(F.coalesce(F.sum("length").over(run), F.lit(0)) / unit))
    one = Window.partitionBy("group", "bundle")
    lead = F.min(F.struct("row", "piece")).over(one)
    small = small.select("row", "piece", "length", lead.alias("lead"), F.sum("length").over(one).alias("item_length")).select("row", "piece", "length", "lead.row", "lead.piece", "item_length").toDF("row", "piece", "length", "lead_row", "lead_piece", "item_length")
    large = pieces.where(F.col("length") >= unit).select("row", "piece", "length", F.col("row").alias("lead_row"), F.col("piece").alias("lead_piece"), F.col("length").alias("item_length"))
    return large.unionByName(small)


def pack(pieces: DataFrame, capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """(row, piece, sequence_id, offset) of pieces (columns row and piece, which name one, and length, at most capacity).

    Pieces shorter than a BUNDLE_SHARE-th of a sequence are bundled to items of about that length, so that a block of items fills many sequences. Every block leaves
    sequences with room. The LEFT_BINS least filled ones of each block are dealt and evolved again in a further pass over them alone, and so on until
    a pass has one block. A block holds more than half of block_pieces items and so at least some block_pieces / 2 / BUNDLE_SHARE sequences: a pass has a
    quarter of the items of the one before at most. Should a pass not halve them (tiny blocks), all its sequences stand and packing ends.
    """
    bits, settled, at = 20, None, 0
    count, unit = pieces.count(), capacity // BUNDLE_SHARE
    members = None
    if unit > 1 and count:
        members = stored(bundled(pieces, count, unit))
        pieces = members.where("row = lead_row and piece = lead_piece").select("row", "piece", F.col("item_length").alias("length"))
        count = pieces.count()
    while True:
        blocks = max(1, -(-count // block_pieces))
        out = evolved_blocks(pieces, blocks, capacity, at).select("row", "piece", "length", "block", "bin")
        if blocks == 1:
            last = out.withColumn("pass", F.lit(at))
            settled = settled.unionByName(last) if settled is not None else last
            break
        out = stored(out)
        fill = out.groupBy("block", "bin").agg(F.sum("length").alias("fill"))
        rank = F.row_number().over(Window.partitionBy("block").orderBy("fill", "bin"))
        loose = fill.select("block", "bin", rank.alias("rank")).where(F.col("rank") <= LEFT_BINS).drop("rank")
        pieces = stored(out.join(loose, ["block", "bin"], "left_semi").select("row", "piece", "length"))
        left = pieces.count()
        halved = 2 * left <= count
        done = (out.join(loose, ["block", "bin"], "left_anti") if halved else out).withColumn("pass", F.lit(at))
        settled = settled.unionByName(done) if settled is not None else done
        if not halved:
            break
        count, at = left, at + 1
    sequence = F.shiftleft(F.col("pass").cast("long"), 56).bitwiseOR(F.shiftleft("block", bits)).bitwiseOR(F.col("bin"))
    placed = settled.select("row", "piece", "length", sequence.alias("sequence_id"))
    if members is not None:
        placed = placed.select(F.col("row").alias("lead_row"), F.col("piece").alias("lead_piece"), "sequence_id").join(members, ["lead_row", "lead_piece"]).select("row", "piece", "length", "sequence_id")
    before = Window.partitionBy("sequence_id").orderBy("row", "piece").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("row", "piece", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, sequence_id, offset), one row per piece of a row of docs.

    A null text counts as empty and gives one piece of length 1 (the end id). Documents of more than `capacity` ids are cut into
    pieces of that many. Every row is a document of its own, rows equal in id and text too. Null ids pass through. An empty
    table gives an empty result; other columns are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[id_col].dataType
    path = tokenizer or default_tokenizer()
    arrow = to_arrow_type(kind)
    raw = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), text_or_empty(text_col).alias("t"))
    # written once, so that the numbers of the rows stay as they are
    pieces = stored(raw.mapInArrow(lambda it: _pieces(it, path, capacity, arrow), f"id {kind.simpleString()}, row long, piece int, start long, length long, ids_crc32 long"))
    placed = pack(pieces.select("row", "piece", "length"), capacity)
    return pieces.join(placed, ["row", "piece"]).select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op7_best_fit_packing": op7_best_fit_packing}
ORACLE: dict[str, str] = {}
