"""Spelling variants by asymmetric chunks: one word of a pair gives disjoint chunks, the other its positional grams."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mosaica.llm.common import slices, stored, table, text_or_empty

LEAST_LENGTH = 7
LEAST_COUNT = 2
DOMINANCE = 10  # a form is at least so many times as frequent as its variant
NOISE = 31  # one run in so many of a document loses a code point
HALVINGS = 2  # first level of the index: how often a word is halved
LONG_LIST = 4096  # pairs of a list beyond which it is split by halving once more
HELD_WORDS = 200_000  # distinct words that a task counts before it hands them on


# ---- words and their counts ----


def noisy(run: bytes, prefix_crc: int) -> bytes:
    """The run, without one code point if NOISE divides the crc32 of prefix and run."""
    h = zlib.crc32(run, prefix_crc)
    if h % NOISE:
        return run
    chars = run.decode()
    at = h % len(chars)
    return (chars[:at] + chars[at + 1 :]).encode()


def _counted(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(word, n) of the whole texts, counted within the task; a word may come more than once."""
    # On UTF-8 bytes: U+00C0 to U+00FF are C3 80 to C3 BF, and C3 never continues another character. Shorter runs cannot give long words.
    runs = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % least)
    held: Counter[bytes] = Counter()

    def out():
        words = [(w, n) for w, n in held.items()]
        held.clear()
        for at in range(0, len(words), 50_000):
            some = words[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], ["word", "n"])

    for b in slices(batches, "t"):
        lowered = pc.ascii_lower(b.column("t")).cast(pa.binary())  # A-Z only
        for key, text in zip(b.column("id").to_pylist(), lowered.to_pylist()):
            prefix = zlib.crc32(f"{key}:".encode())
            for run, n in Counter(runs.findall(text)).items():
                word = noisy(run, prefix)
                if word is run or len(word) - word.count(b"\xc3") >= least:
                    held[word] += n
            if len(held) > HELD_WORDS:
                yield from out()
    yield from out()


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): distinct words of at least least_length code points that occur at least least_count times over all texts.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased, less the code point that the run's noise deletes. Null texts have
    no words; a null id counts as an empty string."""
    raw = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), text_or_empty(text_col).alias("t"))
    counted = raw.mapInArrow(lambda it: _counted(it, least_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ---- pairs at one edit ----


def _halved(rows: DataFrame) -> DataFrame:
    """Every row twice, with the one and the other half of its open region [a, b)."""
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    both = F.explode(F.array(F.struct(F.col("a").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b").alias("b")))).alias("region")
    return rows.withColumn("region", both).select(*[c for c in rows.columns if c not in ("a", "b")], "region.a", "region.b").where("a < b")


def _keyed(rows: DataFrame) -> DataFrame:
    """key: what is left of a word outside the open region, with the region's place. The chunks of a word of `length` are [0, a) and [b, length); a
    word that is longer by one gives the grams of the same sizes, at position 0 and at b + 1."""
    outside = F.xxhash64("length", "a", "b", F.left("word", F.col("a")), F.right("word", F.col("length") - F.col("b")))
    return rows.withColumn("key", outside)


def one_edit(x: Column, y: Column) -> Column:
    return F.levenshtein(x, y, 1) == 1


def near_pairs(words: DataFrame, halvings: int = HALVINGS, long_list: int = LONG_LIST) -> DataFrame:
    """(x, y), once each: the pairs of words (column word, distinct) that differ by one inserted, deleted or replaced code point.

    The shorter word of a pair (of equally long ones any) gives two disjoint chunks, its halves. One edit lies in one half, so the other half stands
    in the longer word as a gram, and its place is shifted by nothing if the edit comes after it and by the difference in length, one at most, if it
    comes before; the longer word gives the grams at those places for every length its partner may have. The half with the edit is again two chunks of
    which one stays, so a posting key takes both chunks that stay (halvings = 2), which leaves a quarter of the word open. Lists of more than long_list
    pairs are not compared but halved once more, down to an open region of one code point, where a list holds what the alphabet allows. Every pair
    on a list is verified by its edit distance; no list is cut.
    """
    length = F.char_length("word")
    whole = words.select("word", length.alias("own"))
    sides = whole.select("word", "own", F.explode(F.array(F.struct(F.col("own").alias("length"), F.lit(True).alias("chunks")), F.struct(F.col("own").alias("length"), F.lit(False).alias("chunks")),
                                                          F.struct((F.col("own") - 1).alias("length"), F.lit(False).alias("chunks")))).alias("s")).select("word", "own", "s.length", "s.chunks")
    rows = sides.where("length > 0").withColumn("a", F.lit(0)).withColumn("b", F.col("length"))
    for _ in range(halvings):
        rows = _halved(rows)
    found = None
    while True:
        keyed = _keyed(rows)
        sizes = keyed.groupBy("key").agg(F.count_if("chunks").alias("c"), F.count_if(~F.col("chunks")).alias("g"), F.max(F.col("b") - F.col("a")).alias("open"))
        long = stored(sizes.where((F.col("c") * F.col("g") > long_list) & (F.col("open") > 1)).select("key"))
        more = not long.isEmpty()
        short = keyed.join(long, "key", "left_anti") if more else keyed
        chunks = short.where("chunks").select("key", F.col("word").alias("x"), F.col("own").alias("x_own"))
        grams = short.where("not chunks").select("key", F.col("word").alias("y"), F.col("own").alias("y_own"))
        pairs = chunks.join(grams, "key").where((F.col("x_own") < F.col("y_own")) | (F.col("x") < F.col("y"))).where(one_edit(F.col("x"), F.col("y"))).select("x", "y")
        found = pairs if found is None else found.unionByName(pairs)
        if not more:
            return found.distinct()
        rows = stored(_halved(keyed.join(long, "key", "left_semi").drop("key")))


# ---- forms and roots ----


def group_variants(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """(word, n, n_near, form, form_n, root), one row per word of (word, n).

    form: the near word of largest n (ties: smallest in code-point order) if its n is at least `dominance` times the word's, else null. root: the last word on the way of forms, the
    word itself if it has none. Since n grows by that factor with every step, the way has few steps, and as many doublings as its logarithm reach its end.
    """
    words = stored(words)
    pairs = stored(near_pairs(words.select("word")))
    both = pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
    near = both.join(words.select(F.col("word").alias("y"), F.col("n").alias("y_n")), "y").groupBy("x")
    best = near.agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("y_n")).alias("n"), F.col("y").alias("word"))).alias("best"))
    placed = words.join(best.withColumnRenamed("x", "word"), "word", "left").withColumn("form_n", -F.col("best.n"))
    strong = F.coalesce(F.col("form_n") >= F.col("n") * dominance, F.lit(False))
    placed = stored(placed.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(strong, F.col("best.word")).alias("form"), F.when(strong, F.col("form_n")).alias("form_n")))
    ways = placed.where("form is not null").select("word", F.col("form").alias("root"))
    top, steps = int(words.agg(F.max("n")).first()[0] or 1), 0
    while top >= dominance:  # steps of the longest way possible
        top, steps = top // max(2, dominance), steps + 1
    for _ in range(steps.bit_length()):
        ahead = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = stored(ways.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return placed.join(ways, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """group_variants() of count_words(): every word of the texts with its near words, form and root. Empty tables, null and empty texts give no
    words; repeated rows count as often as they come; other columns are ignored."""
    return group_variants(count_words(docs, id_col, text_col))


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


SQL = """
with runs as (
    select coalesce(doc_id::varchar, '') || ':' as prefix, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
    from documents),
counted as (select prefix, run, count(*) as n, hex(encode(prefix || run)) as bytes from runs where length(run) >= 7 group by prefix, run),
hashed as (
    select run, n, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length(bytes) // 2),
               lambda i: ((instr('0123456789ABCDEF', substr(bytes, (2 * i + 1)::bigint, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(bytes, (2 * i + 2)::bigint, 1)) - 1)::bigint)),
               lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end))) as h
    from counted),
noisy as (select case when h % 31 = 0 then left(run, (h % length(run))::bigint) || substr(run, (h % length(run) + 2)::bigint) else run end as word, n from hashed),
words as (select word, sum(n)::bigint as n from noisy where length(word) >= 7 group by word having sum(n) >= 2),
less as (select word, n, i, left(word, i - 1) || substr(word, i + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
near as (
    select a.word, b.word as other, b.n as other_n from less a join less b on a.i = b.i and a.rest = b.rest and a.word <> b.word
    union
    select a.word, b.word, b.n from less a join words b on a.rest = b.word
    union
    select b.word, a.word, a.n from less a join words b on a.rest = b.word),
best as (select word, count(*) as n_near, max(other_n) as top from near group by word),
forms as (
    select w.word, w.n, coalesce(b.n_near, 0) as n_near, case when b.top >= 10 * w.n then (select min(x.other) from near x where x.word = w.word and x.other_n = b.top) end as form,
           case when b.top >= 10 * w.n then b.top end as form_n
    from words w left join best b on w.word = b.word),
ways as (
    select word, word as root, 0 as step from forms
    union all
    select w.word, f.form, w.step + 1 from ways w join forms f on w.root = f.word where f.form is not null)
""".replace("with runs", "with recursive runs", 1) + """
select f.word, f.n, f.n_near, f.form, f.form_n, w.root from forms f join (select word, max_by(root, step) as root from ways group by word) w on f.word = w.word
"""

QUERIES = {"op12_spelling_variants": op12_spelling_variants}
ORACLE = {"op12_spelling_variants": SQL}
