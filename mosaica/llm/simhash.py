"""SimHash near-duplicate groups through a byte-position inverted index with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaica.llm.common import checkpoint, drop_stored, free_shuffles, partitions, routed, routing_bitmap, slices, stored, table, text_or_empty, written
from mosaica.operators.components import connected_components

BYTES = 8
SEED = 42


def fingerprint(text: bytes, width: int) -> int:
    """64-bit SimHash: a bit is 1 if it is set in over half of the XXH64 values of the word shingles."""
    words = text.lower().split()  # on bytes: lowers A-Z, splits at space and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(width, len(words))
    h = xxhash.xxh64_intdigest
    values = np.fromiter((h(joined[s:e], SEED) for s, e in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())), np.uint64)
    n = len(values)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 255 * 256):
        bits = np.unpackbits(values[at : at + 255 * 256].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        if whole:
            votes += np.add.reduce(bits[:whole].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(0, dtype=np.int64)
        votes += bits[whole:].sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "t"):
        fps = np.fromiter((fingerprint(t, width) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])


def posting_masks(max_bits: int) -> list[int]:
    """Masks of the byte positions that two fingerprints share at least: BYTES - max_bits of them, in every choice."""
    need = BYTES - max_bits
    return [sum(0xFF << (8 * p) for p in chosen) for chosen in combinations(range(BYTES), need)]


def link(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """For the fingerprints of one posting list, the smallest one each is linked to within the list.

    They share all but max_bits bytes, so there are at most 2**(8*max_bits) of them. In short lists the shared positional bytes of every pair
    are tallied, and pairs that reach the guaranteed minimum are verified bit by bit; in long ones, where that would be too many pairs, every pattern of at
    most max_bits changed bits is looked up in a table of the list, with the same result.
    """
    fps = np.sort(fps)
    label = np.arange(len(fps))
    if len(fps) <= 256:
        places = fps.view(np.uint8).reshape(-1, BYTES)
        tally = sum((places[:, p, None] == places[None, :, p]).astype(np.int8) for p in range(BYTES))
        i, j = np.nonzero(tally >= BYTES - max_bits)
        near = np.zeros(tally.shape, bool)
        near[i, j] = np.bitwise_count(fps[i] ^ fps[j]) <= max_bits
        while True:
            new = np.where(near, label[None, :], len(fps)).min(1)
            if (new == label).all():
                return np.stack((fps, fps[label]))
            label = new
    free = np.uint64(np.bitwise_or.reduce(fps ^ fps[0]))
    spots = [i for i in range(64) if int(free) >> i & 1]
    masks = [sum(1 << i for i in c) for k in range(1, max_bits + 1) for c in combinations(spots, k)]
    pairs = []
    for m in masks:
        other = fps ^ np.uint64(m)
        at = np.searchsorted(fps, other).clip(max=len(fps) - 1)
        hit = fps[at] == other
        pairs.append((np.flatnonzero(hit), at[hit]))
    while True:
        new = label.copy()
        for i, j in pairs:
            new[i] = np.minimum(new[i], new[j])
        new = new[new]
        if (new == label).all():
            return np.stack((fps, fps[label]))
        label = new


def _links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [link(np.array(x, np.int64).view(np.uint64), max_bits) for x in b.column(0).to_pylist()]
        both = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.uint64)
        both = both[:, both[0] != both[1]]
        yield pa.RecordBatch.from_arrays([pa.array(both[0].view(np.int64)), pa.array(both[1].view(np.int64))], ["a", "b"])


def fingerprint_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): edges that connect exactly the fingerprints (column fp, distinct) within max_bits bits of each other.

    Two such fingerprints differ in at most max_bits of their eight bytes, so they share at least 8 - max_bits
    positional bytes: the count filter. A posting list of the index belongs to one choice of that many positions with their bytes,
    so every pair on a list has passed the filter and every pair that passes is on a list. A list holds what can differ in max_bits
    bytes, 65,536 fingerprints for two bits, and gives at most one edge a fingerprint.
    """
    masks = posting_masks(max_bits)
    spread = fps.repartition(partitions(fps), "fp")  # a row becomes one for every choice of positions
    index = spread.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)) for m in masks])).alias("at", "shared"))
    lists = index.groupBy("at", "shared").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1").select("fps")
    return lists.mapInArrow(lambda it: _links(it, max_bits), "a long, b long").distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_bits: int = 2) -> DataFrame:
    """(id_col, fingerprint, component_id), one row per input row.

    Lower-cased A-Z, words between ASCII white space, shingles of `width` words with repeats (a shorter text is one
    shingle, a text without words or a null text has fingerprint zero and is linked like any other). Rows whose
    fingerprints differ in at most max_bits bits are linked; component_id is the smallest id reachable. Equal texts
    have one fingerprint and are never paired. Repeated ids give repeated rows; null ids take part and are never a
    component_id unless the whole group has none. An empty table gives an empty result.
    """
    raw = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("t"))
    kind = docs.schema[id_col].dataType.simpleString()
    marked = checkpoint(raw.mapInArrow(lambda it: _fingerprints(it, width), f"id {kind}, fp long"))
    per_fp = marked.groupBy("fp").agg(F.min("id").alias("low"))
    per_fp = checkpoint(per_fp)
    roots = connected_components(fingerprint_links(per_fp.select("fp"), max_bits), "a", "b")
    placed = per_fp.join(roots, per_fp.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = placed.join(lows, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# ---- word shingles at a Jaccard similarity: what 64 SimHash bits cannot decide (a similarity of 0.8 differs in about ten bits) ----

POSITIONS, BAND = 40, 4  # least hashes of a text's shingles, 16 bits of each; positions that make one posting key
SHORT_LIST = 16  # members up to which a list is compared at once; sets up to which an element counts as rare
_ODDS = np.random.default_rng(11).integers(1, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """Distinct 64-bit hashes of the word shingles, sorted; a shorter text is one shingle, a text without words has none."""
    words = text.lower().split()
    if not words:
        return np.array([], np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    k = min(width, len(words))
    g = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        g = g * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - k + 1 + j]
    g ^= g >> np.uint64(29)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(g ^ (g >> np.uint64(32)))


def _signed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "t"):
        sig = []
        for t in b.column(1).to_pylist():
            g = shingle_hashes(t, width)
            sig.append(np.array([(g * a).min() >> np.uint64(48) for a in _ODDS], np.uint64).astype(np.uint16).view(np.int16) if len(g) else None)
        out = pa.RecordBatch.from_arrays([b.column(0), pa.array(sig, pa.list_(pa.int16()))], ["id", "sig"])
        yield out.filter(pa.array([x is not None for x in sig], pa.bool_()))


def _sets(batches: Iterator[pa.RecordBatch], width: int, route) -> Iterator[pa.RecordBatch]:
    """Shingle sets of the rows that the routing bitmap has."""
    for b in slices(batches, "t"):
        b = b.filter(pa.array(routed(b.column("h").to_numpy().view(np.uint64), route)))
        s = [np.unique((shingle_hashes(t, width) >> np.uint64(32)).astype(np.uint32)).view(np.int32) for t in b.column("t").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(s, pa.list_(pa.int32()))], ["id", "s"])


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(id), stored: of the pairs (id, rep) whose sets (id, s) have the Jaccard similarity."""
    both = pairs.join(sets, "id").join(sets.select(F.col("id").alias("rep"), F.col("s").alias("rep_s")), "rep")
    common = F.size(F.array_intersect("s", "rep_s"))
    return stored(both.where(common / (F.size("s") + F.size("rep_s") - common) >= similarity).select("id").distinct())


def _rare_first(sets: DataFrame) -> DataFrame:
    """(id, a, rarity) of the sets (id, s): a has the elements as (n, t), n the number of sets with the element t, rare ones first; rarity, one of
    some 60 classes, grows with the number of elements that few sets have."""
    items = sets.select("id", F.explode("s").alias("t"))
    counts = items.groupBy("t").agg(F.count("*").alias("n"))
    ranked = items.join(counts, "t").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "t"))).alias("a"))
    rare = F.size(F.filter("a", lambda e: e.n <= SHORT_LIST))
    return ranked.select("id", "a", F.floor(4 * F.log2(1.0 + rare)).cast("int").alias("rarity"))


def similar_in_families(sought: DataFrame, sets: DataFrame, ranked: DataFrame, similarity: float, most: int) -> DataFrame:
    """(id): of the ids sought those whose set has the similarity to that of a smaller id, by prefixes; no pair is missed.

    With elements in one order, rare ones first, the first element that two similar sets share has at least the needed overlap at and behind it in both. So it is
    among the first (1 - similarity) of the larger set and the first (1 - similarity) / (1 + similarity) of the smaller one, and sets meet by such
    elements alone: edited copies with more elements of their own than that meet nothing. Sets are held against in steps, drawn by a hash, each about eight times as
    large as the one before (some four of a list of `most` members are the first); rows found leave as the ones sought.
    """
    size, slack = F.size("a"), 1e-6
    begin = F.slice("a", F.lit(1), F.floor(size * (1 - similarity) + slack).cast("int") + 1)
    steps = max(1, (most.bit_length() + 1) // 3)
    draw = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 40)) / float(1 << 40)
    step = F.greatest(F.lit(0), F.lit(steps - 1) - F.floor(-F.log(8.0, draw + 1e-13))).cast("int")
    parts = ranked.select("id", size.alias("size"), step.alias("step"), F.posexplode(begin).alias("at", "e")).where("e.n > 1")
    inner = F.col("at") <= F.col("size") * ((1 - similarity) / (1 + similarity)) + slack
    parts = stored(parts.select("id", "size", "step", (F.col("size") - F.col("at")).alias("rest"), F.col("e.t").alias("t"), F.explode(F.when(inner, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))).alias("smaller")))
    held = parts.select(F.col("id").alias("rep"), F.col("size").alias("rep_size"), "step", F.col("rest").alias("rep_rest"), "t", (~F.col("smaller")).alias("smaller"))
    enough = F.least("rest", "rep_rest") * (1 + similarity) >= similarity * (F.col("size") + F.col("rep_size")) - slack
    sized = F.when(F.col("smaller"), F.col("size") <= F.col("rep_size")).otherwise(F.col("size") > F.col("rep_size"))
    gone = None
    for at in range(steps):
        left = parts.drop("step").join(sought, "id", "left_semi")
        left = left if gone is None else left.join(gone, "id", "left_anti")
        met = left.join(held.where(F.col("step") == at), ["t", "smaller"]).where((F.col("id") > F.col("rep")) & sized & enough)
        found = _similar(met.select("id", "rep").distinct(), sets, similarity)
        gone = found if gone is None else gone.unionByName(found)
    return gone


def similar_to_smaller(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id_col): ids of rows whose shingle set has at least this Jaccard similarity to that of a row with a smaller id, gone itself or not.

    A positional index again: POSITIONS least hashes a text, each BAND neighbouring ones a posting key. First every member of a list is
    held against the list's smallest id, which settles most copies at one pair a member. Members of lists of up to SHORT_LIST that are not found so are
    held against all smaller members at once. Such pairs must share enough positions (the count filter), then the whole shingle sets are compared. A pair at the
    threshold shares a list with a probability of 0.995 and passes the count filter with one of 0.999.
    Members of longer lists do not meet by list: each is held against the smaller member with the fewest rare shingles of each list, which in a family of edited
    copies is near most others, and what is left goes through similar_in_families. So every pair on a list is compared or bounded unless its larger row
    was found already. Texts without words and null ids are never found.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    raw = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("t")).where("id is not null")
    signed = stored(raw.mapInArrow(lambda it: _signed(it, width), f"id {kind}, sig array<smallint>"))
    least = int(POSITIONS * (similarity - 0.2))  # three deviations below what a pair at the threshold shares
    keys = [F.xxhash64(*[F.col("sig")[i + j] for j in range(BAND)]) for i in range(0, POSITIONS, BAND)]
    equal = F.zip_with("sig", "rep_sig", lambda x, y: (x == y).cast("int"))
    shared = F.aggregate(equal, F.lit(0), lambda s, x: s + x)
    whole = F.filter(F.array(*[F.lit(b) for b in range(POSITIONS // BAND)]), lambda b: F.forall(F.slice(equal, b * BAND + 1, F.lit(BAND)), lambda x: x == 1))

    def sets_of(ids: DataFrame) -> DataFrame:
        """(id, s), stored: shingle sets of the ids, and of a few other rows."""
        route = routing_bitmap(ids.select(F.xxhash64("id").alias("h")).distinct(), "h")  # texts stay where they lie
        sets = stored(raw.select("id", "t", F.xxhash64("id").alias("h")).mapInArrow(lambda it: _sets(it, width, route), f"id {kind}, s array<int>"))
        route.unpersist()
        return sets

    def similar(pairs: DataFrame) -> DataFrame:
        """(id) of the pairs (id, rep) whose whole sets are similar. The pairs, a stored table, and the sets go when that is known."""
        mark = written() - 1
        found = _similar(pairs, sets_of(pairs.select("id").unionByName(pairs.select(F.col("rep").alias("id")))), similarity)
        drop_stored(raw.sparkSession, mark, keep=1)
        free_shuffles(raw.sparkSession)
        return found

    banded = signed.select("id", F.posexplode(F.array(*keys)).alias("band", "h"))
    lists = stored(banded.groupBy("band", "h").agg(F.min("id").alias("rep"), F.max("id").alias("top"), F.count("*").alias("n")).where("rep < top"))
    pairs = banded.join(lists.select("band", "h", "rep"), ["band", "h"]).where("id > rep").select("id", "rep").distinct()
    tallied = pairs.join(signed, "id").join(signed.select(F.col("id").alias("rep"), F.col("sig").alias("rep_sig")), "rep")
    gone = similar(stored(tallied.where(shared >= least).select("id", "rep")))

    # What is left: rows with a smaller member on a list besides the one they were held against. In short lists all meet.
    listed = banded.join(lists.where("n > 2").select("band", "h", F.col("rep").alias("low"), "n"), ["band", "h"])
    few = listed.where((F.col("n") <= SHORT_LIST) & (F.col("id") > F.col("low"))).join(signed, "id")
    sought = few.join(gone, "id", "left_anti")
    met = sought.join(few.select(F.col("id").alias("rep"), "band", "h", F.col("sig").alias("rep_sig")), ["band", "h"]).where("id > rep")
    met = met.where((shared >= least) & (F.get(whole, F.lit(0)) == F.col("band")))
    gone = gone.unionByName(similar(stored(met.select("id", "rep").distinct())))

    # In long ones sets meet by their rare shingles.
    many = stored(listed.where(F.col("n") > SHORT_LIST).select("id", "band", "h", "low", "n"))
    most = int(many.agg(F.max("n")).first()[0] or 0)
    if most:
        members = many.select("id").distinct()
        mark = written()
        sets = stored(sets_of(members).join(members, "id", "left_semi"))
        drop_stored(raw.sparkSession, mark, keep=1)
        ranked = stored(_rare_first(sets))
        central = many.join(ranked.select("id", "rarity"), "id").groupBy("band", "h", "rarity").agg(F.min("id").alias("first"))
        central = central.groupBy("band", "h").agg(F.sort_array(F.collect_list(F.struct("rarity", "first"))).alias("central"))
        one = many.join(gone, "id", "left_anti").join(central, ["band", "h"]).withColumn("rep", F.get(F.filter("central", lambda c: c.first < F.col("id")), F.lit(0)).first)
        gone = gone.unionByName(_similar(one.where("rep > low").select("id", "rep").distinct(), sets, similarity))
        gone = gone.unionByName(similar_in_families(members.join(gone, "id", "left_anti"), sets, ranked, similarity, most))
    return gone.select(F.col("id").alias(id_col)).distinct()


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


QUERIES = {"op2_simhash": op2_simhash}
ORACLE: dict[str, str] = {}
