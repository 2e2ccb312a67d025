"""Document fingerprints by consistent weighted sampling. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mosaica.llm.common import checkpoint, partitions, row_key, table, text_or_empty

SAMPLES = 32
_SPACE = " \t\n\x0b\x0c\r"


def _uniforms(h: Column) -> tuple[Column, Column]:
    """Two numbers in (0, 1) from the halves of a 64-bit hash."""
    unit = F.lit(2.0**-32)
    return (F.shiftrightunsigned(h, 32) + 0.5) * unit, (h.bitwiseAND(F.lit(0xFFFFFFFF)) + 0.5) * unit


def _sample(term: Column, log_weight: Column, i: int) -> Column:
    """Sortable number of one term for sample i: the high half orders by ln a, the low half names (term, t).

    With r, c from Gamma(2, 1) and b from U(0, 1), all fixed by the term and i: t = floor(ln w / r + b),
    ln a = ln c - r (t - b) - r. The term of least a is the sample, so two texts agree with the probability of their
    generalised Jaccard similarity, sum of least weights over sum of greatest weights.
    """
    h = F.xxhash64(term, F.lit(i))
    u1, u2 = _uniforms(h)
    v1, v2 = _uniforms(F.xxhash64(h))
    b, _ = _uniforms(F.xxhash64(h, F.lit(1)))
    r, log_c = -F.ln(u1 * u2), F.ln(-F.ln(v1 * v2))
    t = F.floor(log_weight / r + b)
    log_a = log_c - r * (t - b) - r
    high = F.shiftleft(((log_a + 192.0) * 16777216.0).cast("long"), 31)  # ln a is within -150 and 60 for weights below 2**64
    return high.bitwiseOR(F.xxhash64(term, t.cast("long")).bitwiseAND(F.lit(0x7FFFFFFF)))


def signatures(texts: DataFrame, keys: list[str], text_cols: list[str], samples: int = SAMPLES, carried: str | None = None) -> DataFrame:
    """(keys, signature_<text column>, ..., carried): `samples` numbers for each text, from its words weighted by how often they occur.

    A text without words has one empty term, so that empty texts agree. Rows with equal keys pool their words. The
    gamma samples of a word are computed once for all texts of a row. `carried` names a column of 64 hexadecimal digits that goes along as four
    numbers beside the words, so that keys stay narrow: the count of words by key is what takes memory. If the rows lie partitioned by some of the
    keys, nothing is shuffled.
    """
    words = [F.split(F.btrim(F.col(c), F.lit(_SPACE)), "[\\x20\\x09-\\x0D]+") for c in text_cols]
    extra = [F.array(*[F.substring(F.col(carried), 1 + 16 * q, 16) for q in range(4)])] if carried else []
    sized = texts.select(*keys, F.concat(*words, *extra).alias("_words"), *[F.size(w).alias(f"_z{v}") for v, w in enumerate(words)])
    # No array is empty. A plain explode would have the optimizer split every text twice more, to filter out empty arrays.
    each = sized.select(*keys, *[f"_z{v}" for v in range(len(words))], F.posexplode_outer("_words").alias("_at", "_w"))
    ends = [sum((F.col(f"_z{v}") for v in range(n)), F.lit(0)) for n in range(len(words) + 1)]
    term = F.when(F.col("_at") < ends[-1], F.xxhash64("_w")).otherwise(F.conv("_w", 16, -10).cast("long"))
    terms = each.select(*keys, term.alias("_term"), *[((F.col("_at") >= ends[v]) & (F.col("_at") < ends[v + 1])).cast("long").alias(f"_i{v}") for v in range(len(words))], (F.col("_at") - ends[-1] + 1).alias("_q"))
    counts = [F.sum(f"_i{v}").alias(f"_n{v}") for v in range(len(words))] + ([F.max("_q").alias("_q")] if carried else [])
    weighted = terms.groupBy(*keys, "_term").agg(*counts)
    logged = weighted.select(*keys, "_term", *[F.when(F.col(f"_n{v}") > 0, F.ln(F.col(f"_n{v}").cast("double"))).alias(f"_l{v}") for v in range(len(words))], *(["_q"] if carried else []))
    least = [F.min(_sample(F.col("_term"), F.col(f"_l{v}"), i)).alias(f"_s{v}_{i}") for i in range(samples) for v in range(len(words))]
    along = [F.max(F.when(F.col("_q") == q, F.col("_term"))).alias(f"_c{q}") for q in range(1, 5)] if carried else []
    out = logged.groupBy(*keys).agg(*least, *along)
    named = [F.array(*[F.col(f"_s{v}_{i}").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int") for i in range(samples)]).alias(f"signature_{c}") for v, c in enumerate(text_cols)]
    return out.select(*keys, *named, *([F.lower(F.concat(*[F.lpad(F.hex(f"_c{q}"), 16, "0") for q in range(1, 5)])).alias(carried)] if carried else []))


def likeness(a: Column, b: Column) -> Column:
    """Share of samples that agree: an unbiased estimate of the generalised Jaccard similarity."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / F.size(a)


def as_text(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def successors(docs: DataFrame) -> DataFrame:
    """(k, id, n, m, next_k): rows (k, id, n, m) in descending id, each with the one that follows, the first after the last.

    Range partitions are numbered inside and shifted by the sizes of those before them; only the sizes, a row a partition, meet in one
    task.
    """
    at = F.monotonically_increasing_id()
    ordered = docs.repartitionByRange(4 * partitions(docs), F.col("id").desc_nulls_last(), "k").sortWithinPartitions(F.col("id").desc_nulls_last(), "k")
    placed = checkpoint(ordered.select("*", at.alias("at")))
    part = F.shiftright("at", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    numbered = placed.withColumn("part", part).join(F.broadcast(before), "part").withColumn("row", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    total = placed.count()
    following = numbered.select(F.col("k").alias("next_k"), F.pmod(F.col("row") - 1, F.lit(max(1, total))).alias("row"))
    return numbered.select("k", "id", "n", "m", "row").join(following, "row").drop("row")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one row per input row.

    A document's edited text has its last floor(n_chars / 2) code points replaced by the first as many of the next
    document in descending id (the first again after the last). A null text counts as empty. Rows with one id are told apart by their text
    and follow each other in the order of its hash; rows equal in both follow each other, so that all but the last have their own text next.
    A null id comes last. An empty table gives an empty result; other columns are ignored.
    """
    raw = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("t")).withColumn("k", row_key("id", F.col("t")))
    order = successors(raw.groupBy("k", "id").agg(F.max(F.char_length("t")).alias("n"), F.count("*").alias("m")))
    order = checkpoint(order.withColumn("h", F.floor(F.col("n") / 2).cast("int")))
    # Both joins read one shuffle of the texts by k, of equal rows the first.
    texts = raw.select("k", "t", F.row_number().over(Window.partitionBy("k").orderBy("k")).alias("copy")).where("copy = 1").drop("copy")
    heads = order.select(F.col("k").alias("to"), "next_k", "h").join(texts, F.col("next_k") == F.col("k")).select("to", F.expr("left(t, h)").alias("head"))
    both = order.join(texts, "k").join(heads, F.col("k") == F.col("to"))
    # Of m equal rows, m - 1 are followed by themselves, the last by the next document.
    followed = F.explode(F.filter(F.array(F.struct(F.lit(0).alias("last"), (F.col("m") - 1).alias("copies")), F.struct(F.lit(1).alias("last"), F.lit(1).cast("long").alias("copies"))), lambda x: x.copies > 0)).alias("f")
    each = both.select("k", "n", "h", "t", "head", followed)
    edited = F.concat(F.expr("left(t, n - h)"), F.when(F.col("f.last") == 1, F.col("head")).otherwise(F.expr("left(t, h)")))
    hashed = each.select("k", "f.last", "t", edited.alias("edited")).withColumn("sha", F.sha2("edited", 256))
    marked = signatures(hashed, ["k", "last"], ["t", "edited"], samples, "sha").withColumnsRenamed({"signature_t": "sig", "signature_edited": "edited_sig"})
    rows = checkpoint(marked.join(order.select("k", "id", "n", "next_k", "m"), "k").withColumn("copies", F.when(F.col("last") == 1, 1).otherwise(F.col("m") - 1)))
    following = rows.where("last = 1").select(F.col("k").alias("next_k"), F.col("sig").alias("next_sig"))
    out = rows.join(following, "next_k").withColumn("next_sig", F.when(F.col("last") == 1, F.col("next_sig")).otherwise(F.col("sig")))
    return out.select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_chars"), F.col("sha").alias("edited_sha256"),
        as_text(F.col("sig")).alias("fingerprint"), as_text(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).drop("copy")


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op1_fingerprints": op1_fingerprints}
ORACLE: dict[str, str] = {}
