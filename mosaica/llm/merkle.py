"""Merkle manifest of a dataset by slot pivots: every parent's children stand in columns of one row."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mosaica.llm.common import partitions, stored, table

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 of the values, each `-` if null, else the bytes of its UTF-8 text, a colon, and the text; null-safe and unambiguous."""
    shown = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*shown).cast("binary"), 256)


def _digest(parts: Column) -> Column:
    return F.sha2(parts.cast("binary"), 256)


def numbered(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, int]:
    """rows with `at`, their place from 0 within their group (null is a group of its own), and `size`, the rows of that group; and the largest size.

    Rows are sorted in ranges of (group, order), so one group fills as many partitions as it needs; only the sizes of (range, group) meet. Nulls
    come first, strings are ordered by their UTF-8 bytes. Rows that are equal in group and order lie in one range and get any order."""
    ranged = rows.repartitionByRange(partitions(rows), group, *order).sortWithinPartitions(group, *order)
    placed = stored(ranged.withColumn("_n", F.monotonically_increasing_id()))  # written once, so that the numbers stay
    place = F.col("_n") - F.shiftleft(F.shiftright("_n", 33), 33)
    placed = placed.withColumn("_range", F.shiftright("_n", 33)).withColumn("_place", place)
    part = placed.groupBy("_range", F.col(group).alias("_group")).agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy("_group")
    before = F.sum("_rows").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    # Stored, so that its true size decides whether it is broadcast.
    part = stored(part.select("_range", "_group", "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_rows").over(whole).alias("size")))
    joined = placed.join(part.withColumnRenamed("_range", "_r"), (F.col("_range") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_group")))
    numbers = joined.select(*rows.columns, (F.col("_place") - F.col("_first") + F.col("_before")).alias("at"), "size")
    return numbers, int(part.agg(F.max("size")).first()[0] or 0)


def _pivot(nodes: DataFrame, group: str, fanout: int, kept: list[str]) -> DataFrame:
    """One row a parent: (group, size, at, c0 .. c<fanout-1>), the children's `kept` columns as one struct a slot, null where the last run ends."""
    slot = F.pmod("at", F.lit(fanout))
    child = F.struct(*kept)
    columns = [F.max(F.when(slot == k, child)).alias(f"c{k}") for k in range(fanout)]
    return nodes.groupBy(group, "size", F.floor(F.col("at") / fanout).cast("long").alias("at")).agg(*columns)


def _joined_digests(fanout: int, but: int | None = None, low: int = 0) -> Column:
    return F.concat_ws("", *[F.col(f"c{k}.digest") for k in range(low, fanout) if k != but])


def forest(leaves: DataFrame, group: str, order: list[str], kept: list[str], fanout: int = FANOUT) -> tuple[DataFrame, DataFrame]:
    """(roots, proofs) of one tree a group over leaves (group, digest, and what `order` and `kept` name).

    roots: (group, digest). proofs: (group, digest, *kept, path), one row a leaf; path has, from the leaf's level up, the joined digests of the
    siblings before and after the node on the leaf's way. Every level is one pivot over the nodes of the level below, so a parent's row has
    all that its children's proofs need; paths are handed down from the top over parents only, never over leaves. Groups of different sizes end at
    different levels; a group of one leaf has its leaf as root and an empty path.
    """
    kept = list(dict.fromkeys(kept))
    nodes, largest = numbered(leaves, group, order)
    # A node of a group that has more than one node at its level gets a parent. Levels are few: the logarithm of the largest group.
    levels: list[DataFrame] = []
    roots = nodes.where("size = 1").select(group, "digest")
    reach, current = 1, nodes
    while reach < largest:
        current = current.where(F.col("size") > reach)
        pivot = stored(_pivot(current, group, fanout, ["digest", *kept] if not levels else ["digest"]))
        levels.append(pivot)
        reach *= fanout
        current = pivot.select(group, "size", "at", _digest(_joined_digests(fanout)).alias("digest"))
        roots = roots.unionByName(current.where(F.col("size") <= reach).select(group, "digest"))
    step = "array<struct<before:string,after:string>>"
    none = F.array().cast(step)
    alone = nodes.where("size = 1").select(group, "digest", *kept, none.alias("path"))
    if not levels:
        return roots, alone
    handed = None  # (group, at, path) of the nodes that are the parents of the level looked at
    for depth in range(len(levels) - 1, -1, -1):
        pivot = levels[depth]
        if handed is None:
            rows = pivot.withColumn("path", none)
        else:
            same = pivot[group].eqNullSafe(handed["_group"]) & (pivot["at"] == handed["_at"])
            rows = pivot.join(handed, same, "left").drop("_group", "_at").withColumn("path", F.coalesce("path", none))
        named = kept if depth == 0 else []
        slots = [
            F.when(F.col(f"c{k}").isNotNull(), F.struct(
                (F.col("at") * fanout + k).alias("at"), F.col(f"c{k}.digest").alias("digest"), *[F.col(f"c{k}.{c}").alias(c) for c in named],
                F.concat_ws("", *[F.col(f"c{j}.digest") for j in range(k)]).alias("before"), _joined_digests(fanout, None, k + 1).alias("after"),
            )) for k in range(fanout)
        ]
        children = rows.select(group, "path", F.explode(F.filter(F.array(*slots), lambda c: c.isNotNull())).alias("c"))
        way = F.concat(F.array(F.struct(F.col("c.before").alias("before"), F.col("c.after").alias("after"))), F.col("path"))
        if depth:
            handed = children.select(F.col(group).alias("_group"), F.col("c.at").alias("_at"), way.alias("path"))
        else:
            found = children.select(group, "c.digest", *[f"c.{c}" for c in kept], way.alias("path"))
    return roots, found.unionByName(alone)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and the path's siblings give."""
    return F.aggregate(path, leaf, lambda acc, s: _digest(F.concat(s["before"], acc, s["after"])))


def manifest(docs: DataFrame, group: str = "lang", id_col: str = "doc_id", fields: tuple[str, ...] = FIELDS, tampering: dict[str, Column] | None = None, where: Column | None = None, fanout: int = FANOUT) -> DataFrame:
    """(id_col, leaf, subroot, root, proof_sha256, folded_root, verified), one row per row of docs.

    A leaf is the digest of the row's `fields`. Leaves of a group ascend by id_col (null first; rows of equal id by leaf, so repeated rows give equal
    results in any order) and form a tree of `fanout`; the trees' roots, ordered by group (null first, UTF-8 bytes), form the tree above. proof_sha256
    is the digest of a leaf's siblings, level by level up to the root. `tampering` replaces columns where `where` holds (nowhere if null), and
    folded_root is what that row's leaf gives with the original siblings; verified tells whether it is the root. Null fields and empty texts have leaves
    of their own. An empty table gives an empty result. Columns that are not named are ignored.
    """
    changed = [(tampering or {}).get(c, F.col(c)) for c in fields]
    touched = F.coalesce(where, F.lit(False)) if where is not None else F.lit(False)
    leaf = leaf_digest([F.col(c) for c in fields])
    seen = F.when(touched, leaf_digest(changed))  # null where nothing is tampered with
    leaves = docs.select(F.col(group).cast("string").alias("_lang"), F.col(id_col).alias("_id"), leaf.alias("digest"), seen.alias("_seen"))
    roots, proofs = forest(leaves, "_lang", ["_id", "digest"], ["_id", "_seen"], fanout)
    tops = stored(roots.select(F.lit(0).alias("_all"), "digest", F.col("_lang").alias("_lang")))
    top, upper = forest(tops, "_all", ["_lang"], ["_lang"], fanout)
    # One row a group: its root, the whole root and the path between them.
    heads = upper.join(top.select("_all", F.col("digest").alias("root")), "_all").select(F.col("_lang").alias("_l"), F.col("digest").alias("subroot"), "root", F.col("path").alias("_up"))
    rows = proofs.join(heads, proofs["_lang"].eqNullSafe(heads["_l"]))
    rows = rows.withColumn("_way", F.concat("path", "_up"))
    siblings = F.array_join(F.transform("_way", lambda s: F.concat(s["before"], s["after"])), "")
    folded = fold(F.coalesce("_seen", "digest"), F.col("_way"))
    out = rows.select(F.col("_id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", _digest(siblings).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return manifest(docs, tampering={"text": F.translate("text", ascii_uppercase, ascii_lowercase)}, where=third)


def _shown(value: str) -> str:
    return f"coalesce(strlen({value})::varchar || ':' || {value}, '-')"


_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii(substr(doc_id::varchar, i::bigint, 1))::bigint)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)))"""

_LEAF = " || ".join(_shown(f"{c}::varchar") for c in FIELDS[:-1])

SQL = f"""
with recursive leaves as (
    select doc_id, lang, sha256({_LEAF} || {_shown("text")}) as leaf,
           sha256({_LEAF} || {_shown("case when (" + _CRC + ") % 3 = 0 then translate(text, '" + ascii_uppercase + "', '" + ascii_lowercase + "') else text end")}) as seen
    from documents),
numbered as (
    select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place, count(*) over (partition by lang) as size from leaves),
tree as (
    select lang, 0 as level, place, leaf as h, size from numbered
    union all
    select lang, level + 1, place // 8, sha256(string_agg(h, '' order by place)), (size + 7) // 8 from tree where size > 1 group by lang, level, place // 8, size),
subroots as (select lang, h, row_number() over (order by lang nulls first) - 1 as place, count(*) over () as size from tree where size = 1),
top as (
    select 0 as level, place, h, size from subroots
    union all
    select level + 1, place // 8, sha256(string_agg(h, '' order by place)), (size + 7) // 8 from top where size > 1 group by level, place // 8, size),
steps as (
    select a.lang, a.level, a.place,
           coalesce(string_agg(b.h, '' order by b.place) filter (where b.place < a.place), '') as before, coalesce(string_agg(b.h, '' order by b.place) filter (where b.place > a.place), '') as after
    from tree a join tree b on a.lang is not distinct from b.lang and a.level = b.level and a.place // 8 = b.place // 8 where a.size > 1 group by a.lang, a.level, a.place),
top_steps as (
    select a.level, a.place,
           coalesce(string_agg(b.h, '' order by b.place) filter (where b.place < a.place), '') as before, coalesce(string_agg(b.h, '' order by b.place) filter (where b.place > a.place), '') as after
    from top a join top b on a.level = b.level and a.place // 8 = b.place // 8 where a.size > 1 group by a.level, a.place),
walk as (
    select doc_id, lang, leaf, place, 0 as level, size, seen as acc, '' as siblings from numbered
    union all
    select w.doc_id, w.lang, w.leaf, w.place // 8, w.level + 1, (w.size + 7) // 8, sha256(s.before || w.acc || s.after), w.siblings || s.before || s.after
    from walk w join steps s on w.lang is not distinct from s.lang and w.level = s.level and w.place = s.place),
climb as (
    select w.doc_id, w.leaf, r.h as subroot, r.place, 0 as level, r.size, w.acc, w.siblings from walk w join subroots r on w.lang is not distinct from r.lang where w.size = 1
    union all
    select c.doc_id, c.leaf, c.subroot, c.place // 8, c.level + 1, (c.size + 7) // 8, sha256(s.before || c.acc || s.after), c.siblings || s.before || s.after
    from climb c join top_steps s on c.level = s.level and c.place = s.place)
select doc_id, leaf, subroot, t.h as root, sha256(siblings) as proof_sha256, acc as folded_root, acc = t.h as verified from climb c join top t on t.size = 1 where c.size = 1
"""

QUERIES = {"op13_merkle_manifest": op13_merkle_manifest}
ORACLE = {"op13_merkle_manifest": SQL}
