"""Methods, limits and query columns of the text operators against independent versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from mosaica.llm import common, exact_dedup, fingerprints, packing, pieces, pii, quality, secrets, simhash, substring, urls

from .helpers import awkward, clashing, empty
from .test_operators import brute_personal, brute_removed, brute_viterbi


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


# ---- shared ----


def test_slices_cover_all_rows():
    b = pa.RecordBatch.from_arrays([pa.array(["a" * n if n else None for n in (0, 5, 0, 40, 3, 3, 3, 100)])], ["t"])
    got = [x.column(0).to_pylist() for x in common.slices(iter([b, b.slice(0, 0), b.slice(3)]), "t", 10)]
    assert [x for part in got for x in part] == b.column(0).to_pylist() + b.column(0).to_pylist()[3:]
    assert all(sum(len(x or "") for x in part) <= 10 or len(part) == 1 for part in got) and len(got[0]) == 3


# ---- 1 ----


def brute_signature(words, samples):
    """Consistent weighted sampling, one word and sample at a time."""
    u = lambda h: ((h >> 32) + 0.5) * 2.0**-32
    low = lambda h: ((h & 0xFFFFFFFF) + 0.5) * 2.0**-32
    long = lambda v: (v & (1 << 64) - 1).to_bytes(8, "little")
    hash_ = lambda data, seed=42: xxhash.xxh64_intdigest(data, seed)
    out = []
    for i in range(samples):
        best = None
        for w, n in Counter(words).items():
            term = hash_(w.encode())
            h = hash_(i.to_bytes(4, "little"), hash_(long(term)))
            h1, h2 = hash_(long(h)), hash_((1).to_bytes(4, "little"), hash_(long(h)))
            r, log_c, b = -math.log(u(h) * low(h)), math.log(-math.log(u(h1) * low(h1))), u(h2)
            t = math.floor(math.log(n) / r + b)
            value = int((log_c - r * (t - b) - r + 192) * 16777216)
            name = hash_(long(t), hash_(long(term))) & 0x7FFFFFFF
            best = min(best or (value, name), (value, name))
        out.append(f"{best[1]:08x}")
    return "".join(out)


def test_fingerprint_columns_brute(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(0, 30)))) for i in range(12)]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (7, "another text"), (None, "no id"), (20, None), (21, "  \n")]
    got = fingerprints.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    key = lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256(((f"={r[0]}" if r[0] is not None else "none") + "\0" + (r[1] or "")).encode()).digest()[:16])
    order = sorted(rows, key=key)
    sign = lambda t: brute_signature(t.split() or [""], 32)
    like = lambda a, b: sum(a[8 * i : 8 * i + 8] == b[8 * i : 8 * i + 8] for i in range(32)) / 32
    want = []
    for n, (i, t) in enumerate(order):
        t, nxt = t or "", order[(n + 1) % len(order)][1] or ""
        h = len(t) // 2
        e = t[: len(t) - h] + nxt[:h]
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), sign(t), sign(e), like(sign(t), sign(e)), like(sign(t), sign(nxt))))
    assert Counter(map(tuple, got)) == Counter(want)


# ---- 2 ----


def test_tally_finds_what_bits_allow():
    rng = np.random.default_rng(2)
    base = int(rng.integers(1 << 62))
    fps = np.unique(np.array([base ^ sum(1 << int(b) for b in rng.choice(16, 3)) for _ in range(60)], np.uint64))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    label = np.arange(len(fps))
    while (new := np.where(near, label, len(fps)).min(1)).tolist() != label.tolist():
        label = new
    assert simhash.link(fps, 2)[1].tolist() == fps[label].tolist()


# ---- 3 ----


def test_string_ids_and_packed_filters(spark):
    rows = [("b", "X y"), ("a", "x Y"), ("c", None), (None, ""), ("d", "z")]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {"b": ("b", 2, True), "a": ("b", 2, False), "c": ("c", 2, True), None: ("c", 2, False), "d": ("d", 1, True)}
    fp = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64))
    for bits in (0, 4, 13, 40):
        for counts in (np.ones(len(fp), np.int64), np.arange(len(fp)) + 1):
            read = [exact_dedup.read_filter(r, bits) for r in exact_dedup.build_filter(fp, counts, bits).itertuples()]
            assert np.concatenate([x[0] for x in read]).tolist() == fp.tolist() and np.concatenate([x[1] for x in read]).tolist() == counts.tolist()
    a, b = exact_dedup.merge_sorted((fp[::2], np.ones(2500, np.int64)), (fp[::3], np.full(1667, 2)))
    want = Counter(fp[::2].tolist()) + Counter(dict.fromkeys(fp[::3].tolist(), 2))
    assert dict(zip(a.tolist(), b.tolist())) == want and a.tolist() == sorted(want)


# ---- 4 ----


def test_pieces_query(spark, sf, docs):
    model = pieces.load_model()
    for r in pieces.op4_sentencepiece(spark, sf).collect():
        ids = brute_viterbi(model, docs[r.doc_id]) if len(docs[r.doc_id]) < 3000 else np.frombuffer(model.encode([docs[r.doc_id]], {})[0], "<u4").tolist()
        if zlib.crc32(np.array(ids, "<u4").tobytes()) != r.ids_crc32:  # another path of the same score
            mine = np.frombuffer(model.encode([docs[r.doc_id]], {})[0], "<u4").tolist()
            assert abs(sum(model.scores[i] for i in mine) - sum(model.scores[i] for i in ids)) < 1e-6 and len(mine) == r.n_tokens
        else:
            assert r.n_tokens == len(ids)
        assert r.round_trip == (model.decode(ids) == docs[r.doc_id])


def test_a_word_of_any_length_goes_one_way():
    model = pieces.load_model()
    words = [("abc日é" * n)[:n].encode() for n in range(1, 90, 4)]
    assert [model.encode_long(w) for w in words] == model.encode_words(words)


def test_decode_awkward(spark):
    rows = [(1, None), (2, []), (None, [5, 6]), (3, [5, 6])]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>").withColumn("x", F.lit("clash")).withColumn("id", F.lit(0))
    got = {r.doc_id: r.text for r in pieces.decode(df).collect()}
    assert got[1] is None and got[2] == "" and got[None] == got[3] and pieces.decode(df.limit(0)).collect() == []


# ---- 5 ----


def test_substring_query(spark, sf, docs):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.op5_substring_dedup(spark, sf).collect()}
    assert got == brute_removed(list(docs.items()), 50)


# ---- 6 ----


def test_quality_gradient_by_finite_differences():
    rng = np.random.default_rng(0)
    p, u = rng.normal(0.5, 1, (40, 6)), rng.normal(0, 1, (50, 6))
    for prior in (0.2, 0.9):
        m = quality.PositiveUnlabelled(p, u, prior)
        x, y = m._normal(p).astype(float), m._normal(u).astype(float)

        def risk():
            loss = lambda x, say: (1 / (1 + np.exp(say * m._forward(x)[1]))).mean()
            rest = loss(y, -1) - prior * loss(x, -1)
            return prior * loss(x, 1) + rest if rest >= 0 else -rest

        for at, i in ((0, (2, 3)), (1, (4,)), (2, (5,)), (3, (0,))):
            got, old = m._gradient(x, y)[at][i], m.w[at][i]
            m.w[at][i] = old + 1e-6
            high = risk()
            m.w[at][i] = old - 1e-6
            low = risk()
            m.w[at][i] = old
            assert abs((high - low) / 2e-6 - got) < 1e-5


@pytest.mark.parametrize("prior", [0.2, 0.5, 0.8])
def test_prior_is_estimated(prior):
    rng = np.random.default_rng(4)
    positive = rng.beta(6, 2, 4000)
    unlabelled = np.where(rng.random(4000) < prior, rng.beta(6, 2, 4000), rng.beta(2, 6, 4000))
    assert abs(quality.estimate_prior(positive, unlabelled) - prior) < 0.08


def test_calibration_meets_the_prior():
    """Probabilities of planted classes with known odds: the mean is the prior, and 0.7 means 0.7."""
    rng = np.random.default_rng(2)
    positive = rng.normal(1, 1, 40_000)
    kind = rng.random(60_000) < 0.6
    unlabelled = np.where(kind, rng.normal(1, 1, 60_000), rng.normal(-1, 1, 60_000))
    a, b = quality.calibrate(positive, unlabelled, 0.6)
    s = 1 / (1 + np.exp(-(a * unlabelled + b)))
    assert abs(s.mean() - 0.6) < 1e-3 and abs(a - 2) < 0.1 and abs(b - np.log(1.5)) < 0.1
    some = (s > 0.65) & (s < 0.75)
    assert abs(kind[some].mean() - 0.7) < 0.03


def test_repeated_ids_do_not_fill_the_sample(spark, sf):
    """One id repeated thousands of times counts once among the rows that the classifier is fitted on."""
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    junk = spark.range(9000).select(F.lit(10**9).alias("doc_id"), F.lit("x x x").alias("text"))
    once = quality.fit_quality(docs.select("doc_id", "text").unionByName(junk.limit(1)), labels, sample=500)
    often = quality.fit_quality(docs.select("doc_id", "text").unionByName(junk), labels, sample=500)
    x = np.array([quality.features(t.encode()) for t in ("Some text of words.", "", "x x x")])
    assert np.allclose(once.score(x), often.score(x))


def test_quality_reads_whole_texts_and_no_other_label(spark):
    lines = [f"line {i}" for i in range(80)] + ["again"] * 70
    a, b = "\n".join(lines).encode(), "\n".join(lines[::-1]).encode()
    assert np.array_equal(quality.features(a), quality.features(b))
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    other = labels.withColumn("quality", F.when((F.col("quality") != 1) | quality.held_out("doc_id"), None).otherwise(F.col("quality")))
    score = lambda x: sorted((r.doc_id, r.score) for r in quality.score_quality(docs, x).collect())
    assert score(labels) == score(other)


# ---- 7 ----


def test_packing_repeated_rows_have_places_of_their_own(spark):
    rows = [(1, "word " * 3000)] * 3 + [(None, None)] * 2 + [(2, "x")]
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.piece) for r in got) == {(1, 0): 3, (1, 1): 3, (None, 0): 2, (2, 0): 1}
    places = [(r.sequence_id, r.offset) for r in got]
    assert len(set(places)) == len(places)


def test_left_over_sequences_are_packed_again(spark):
    rng = np.random.default_rng(8)
    size = rng.integers(1, 900, 3000).tolist()
    df = spark.createDataFrame([(i, 0, s) for i, s in enumerate(size)], "row long, piece int, length long")
    got = packing.pack(df, 2048, block_pieces=100).collect()
    fill: dict = {}
    for r in got:
        fill.setdefault(r.sequence_id, []).append((r.offset, size[r.row]))
    assert len(got) == 3000
    for parts in fill.values():
        ends = np.cumsum([0] + [x[1] for x in sorted(parts)])
        assert [x[0] for x in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= 2048
    bound = -(-sum(size) // 2048)
    assert bound <= len(fill) <= bound + 2


@pytest.mark.parametrize("length", [1, 2, 12, 13])
def test_many_short_pieces_end(spark, monkeypatch, length):
    """10^5 pieces of a few tokens, far beyond one block: few passes, no gaps, sequences within a hundredth of the bound."""
    passes = []
    evolved = packing.evolved_blocks
    monkeypatch.setattr(packing, "evolved_blocks", lambda pieces, blocks, *rest: (passes.append(blocks), evolved(pieces, blocks, *rest))[1])
    kind = F.lit(length) if length < 13 else F.lit(1) + F.col("id") % 13
    df = spark.range(100_000).select(F.col("id").alias("row"), F.lit(0).alias("piece"), kind.cast("long").alias("length"))
    placed = packing.pack(df).join(df, ["row", "piece"])
    fill = placed.groupBy("sequence_id").agg(F.sum("length").alias("fill"), F.max(F.col("offset") + F.col("length")).alias("end"), F.count_distinct("offset").alias("places"), F.count("*").alias("n")).toPandas()
    assert fill["n"].sum() == 100_000 and (fill["fill"] == fill["end"]).all() and (fill["places"] == fill["n"]).all() and fill["fill"].max() <= 2048
    bound = -(-int(fill["fill"].sum()) // 2048)
    assert len(fill) <= bound + max(1, bound // 100) and len(passes) <= 3


def test_passes_that_do_not_shrink_end(spark, monkeypatch):
    """Blocks of so few sequences that all of them are left over."""
    monkeypatch.setattr(packing, "BUNDLE_SHARE", packing.CAPACITY)
    df = spark.range(5000).select(F.col("id").alias("row"), F.lit(0).alias("piece"), F.lit(1).cast("long").alias("length"))
    got = packing.pack(df).groupBy("sequence_id").agg(F.count("*").alias("n"), F.max("offset").alias("top")).collect()
    assert sum(r.n for r in got) == 5000 and all(r.top == r.n - 1 < 2048 for r in got)


def test_genetic_search_beats_best_fit():
    """Triples that fill a bin exactly: best-fit decreasing spoils them."""
    for seed in range(3):
        rng, size = np.random.default_rng(seed), []
        for _ in range(20):
            a = int(rng.integers(380, 490))
            b = int(rng.integers(250, (1000 - a) // 2))
            size += [a, b, 1000 - a - b]
        plain = packing.best_fit(packing.largest_first(list(range(60)), size), size, [], 1000)
        best, spent = packing.evolve(size, 1000, seed, generations=200)
        assert spent and len(best) < len(plain) and packing.lower_bound(size, 1000) <= 20 <= len(best)
        assert sorted(i for x in best for i in x) == list(range(60))


def test_lower_bound_is_one():
    rng = np.random.default_rng(1)

    def fewest(size, bins):
        """By trying every place of every item."""
        if not size:
            return len(bins)
        tried, best = set(), len(bins) + len(size)
        for i, room in enumerate(bins + [10]):
            if room >= size[0] and room not in tried:
                tried.add(room)
                left = bins[:i] + [room - size[0]] + bins[i + 1 :]
                best = min(best, fewest(size[1:], left))
        return best

    for _ in range(60):
        size = rng.integers(1, 11, int(rng.integers(1, 8))).tolist()
        assert packing.lower_bound(size, 10) <= fewest(size, [])


def test_packing_query(spark, sf, docs):
    from tokenizers import Tokenizer

    tok, fill, n = Tokenizer.from_file(packing.default_tokenizer()), {}, Counter()
    ids = {i: np.array(tok.encode(t, add_special_tokens=False).ids + [0], "<u4") for i, t in docs.items()}
    for r in packing.op7_best_fit_packing(spark, sf).collect():
        own = ids[r.doc_id][r.start : r.start + 2048]
        assert (r.start, r.length, r.ids_crc32) == (2048 * r.piece, len(own), zlib.crc32(own.tobytes()))
        n[r.doc_id] += r.length
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert n == {i: len(x) for i, x in ids.items()}
    assert all(sum(x[1] for x in p) <= 2048 for p in fill.values()) and len(fill) <= -(-sum(n.values()) // 2048) + 1


# ---- 8 ----


def brute_base(t):
    out = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def test_secret_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    digest = lambda spans: ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in spans)
    found = 0
    for r in secrets.op8_secret_scan(spark, sf).collect():
        base = brute_base(docs[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in base) for i in range(3))
        assert r.base_sha256 == hashlib.sha256(digest(base).encode()).hexdigest()
        assert ",".join(x for x in r.spans.split(",") if x and not x.startswith("format:")) == digest(base)
        found += len(base)
    assert found


def test_formats_have_precision_and_recall(spark):
    """Credentials without a telling name among words and identifiers: most are found, few others."""
    rng = random.Random(6)
    chars = {"access": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "mixed": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "hex": "0123456789abcdef"}
    make = lambda kind, n: "".join(rng.choice(chars[kind]) for _ in range(n))
    word = lambda: "".join(rng.choice("etaoinshrdlucmfwypvbgk") for _ in range(rng.randint(3, 18)))
    rows, planted = [], {}
    for i in range(300):
        w = [word() for _ in range(60)]
        w[5], w[9], w[13] = f"token={make('mixed', 32)}", "AKIA" + make("access", 16), make("hex", 40)
        w[20], w[30] = "snake_case_" + word(), word() + "." + word()
        planted[i] = make("mixed", 32)
        w[40] = planted[i]
        rows.append((i, " ".join(w)))
    got = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text = dict(rows)
    found = [(r.doc_id, text[r.doc_id][x.start : x.end]) for r in got for x in r.found if x.kind == "format"]
    right = sum(planted[i] == v for i, v in found)
    print("formats: found", right, "of", len(rows), "others", len(found) - right)
    assert right >= 0.9 * len(rows) and right >= 0.9 * len(found)


def test_formats_are_learned_from_all_credentials(spark):
    """Of each kind 400 were taken and of ordinary candidates 2,000, none longer than 256 characters; the distributed fit is that of all distinct values."""
    rng = random.Random(8)
    make = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    rows, values, words = [], {"access": set(), "hex": set(), "assign": set()}, set()
    for i in range(1300):
        own = ["AKIA" + make("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16), make("0123456789abcdef", 300 if i % 10 == 0 else 32), make("ghijklmn", 9 + i % 5) + "Z" * (i % 3 + 1)]
        plain = [make("ghijklmnopqrstu", rng.randint(6, 12)) for _ in range(4)] + ["W" * 400 if i == 3 else "Monday"]
        for k, v in zip(values, own):
            values[k].add(v)
        words |= set(plain)
        rows += [(i, " ".join([own[0], own[1], "token=" + own[2], *plain]))] * (2 if i % 7 == 0 else 1)
    got = secrets.learn_formats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    want = secrets.FormatModel({k: sorted(v) for k, v in values.items()}, sorted(words))
    assert len(words) > 2000 and min(len(v) for v in values.values()) > 2 * secrets.TREE_SHARE
    assert got.background == want.background
    for k in values:
        a, b = got.automata[k], want.automata[k]
        assert (a.states, a.to, a.moves, a.ends) == (b.states, b.to, b.moves, b.ends)
        assert sum(math.exp(p) for _, p in a.moves[0].values()) <= 1 + 1e-9


def test_formats_leave_ordinary_text_alone(spark):
    """Addresses, card and telephone numbers of the given texts, which hold no credential but the labelled ones, are no format."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = secrets.find_secrets(docs).selectExpr("explode(found) x").where("x.kind = 'format'").count()
    assert got == 0


def test_candidates_stick_out_of_base_spans():
    text = "prefix_deadbeefdeadbeefdeadbeef00_suffix token=abcdef123456"
    base = secrets.base_spans(text)
    assert [text[s:e] for s, e, _ in secrets.candidates(text, base)] == ["prefix_deadbeefdeadbeefdeadbeef00_suffix"]


# ---- 9 ----


def test_links_are_resolved(spark):
    page = lambda *tags: "<html><head>" + "".join(tags) + "</head>"
    canonical = lambda x: f'<link rel="canonical" href="{x}">'
    rows = [
        (1, "https://a.fr/dir/page?q=1#frag", page(canonical("../en/9?x=1&amp;y=2"))),
        (2, "https://a.fr/en/9?x=1&y=2", page(canonical("//x.com/en/1"))),
        (3, "https://b.fr/q?id=1", page(canonical("https://y.com/en/2"))),
        (4, "https://b.fr/q?id=2", ""),
        (5, "https://c.fr/", page('<meta content="0; URL=\'/next\'" http-equiv=Refresh>')),
        (6, "https://c.fr/next", page(canonical("https://fine.fr/"), "<link href='https://z.com/en/3' rel='alternate canonical'>")),
        (7, "https://d.fr/x", page('<base href="https://x.com/en/">', canonical("4"))),
        (8, "https://e.fr/x", page(canonical("mailto:a@b"), canonical("#top"), canonical(""))),
        (9, "https://www.b.fr/q?id=1", ""),
        (10, "HTTPS://C.fr", ""),
        (11, "https://f.fr/moved", None),
    ]
    redirects = spark.createDataFrame([("https://f.fr/moved", "/to"), ("https://f.fr/to", "https://q.org/es/1"), (None, "/x")], "from_url string, to_url string")
    got = {r.page_id: r.verdict for r in urls.filter_urls(spark.createDataFrame(rows, "page_id int, url string, html string"), redirects=redirects).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "block", 6: "block", 7: "block", 8: "allow", 9: "allow", 10: "block", 11: "block"}


def test_url_columns_may_clash(spark):
    rows = [(1, "https://a.com/en/1", None), (1, "https://a.com/en/1", None), (None, None, "<link rel=canonical href=x>"), (2, "https://b.fr/", "<link rel=canonical href='https://a.com/en/1'>")]
    df = spark.createDataFrame(rows, "page_id int, url string, html string")
    clash = df
    for name in ("id", "host", "path", "rule", "said", "node", "root", "hit", "a", "b"):
        clash = clash.withColumn(name, F.lit("clash"))
    plain = sorted(map(repr, urls.filter_urls(df).collect()))
    assert plain == sorted(map(repr, urls.filter_urls(clash).collect())) and len(plain) == 4 and sum("block" in r for r in plain) == 3


# ---- 10 ----


@pytest.mark.parametrize(
    "text",
    ["9" * 10**6, "9 " * (5 * 10**5), "a" * 10**6, "a." * 10**5 + "@b" + ".c" * 10**5, "1." * 10**5, "+1" + " (" * 10**5, "x@y.z " * 10**4, "4111 1111 1111 1111, " * 3000, "a@b.c.@d.e 1.2.3.4.5.6.7.8"],
    ids=lambda t: f"{t[:6]}_{len(t)}",
)
def test_long_runs_of_every_kind(spark, text):
    (r,) = pii.find_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    got = [(x.kind, x.start, x.end) for x in r.found]
    if text[:2] == "1.":
        assert got == [("ip", 8 * i, 8 * i + 7) for i in range(len(text) // 8)]
    elif text[0] == "x":
        assert got == [("email", 6 * i, 6 * i + 5) for i in range(10**4)]
    elif text[:2] == "a.":
        assert got == [("email", 0, len(text))]
    elif text[0] in "4a" and "@" in text + "@" * (text[0] == "4") and len(text) < 10**6:
        assert got == brute_personal(text)
    else:  # one run of digits, letters or signs, which the brute-force patterns take hours for
        assert got == []


def test_personal_query_and_context(spark, sf, docs):
    names = ("email", "ip", "card", "phone")
    for r in pii.op10_personal_data(spark, sf).collect():
        base = brute_personal(docs[r.doc_id])
        said = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == n for k, _, _ in base) for n in names)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert ",".join(x for x in r.spans.split(",") if not x.startswith("iban:")) == said
    rows = [(1, "the ship hotel 10.0.0.1"), (2, "my IP 10.0.0.1"), (3, "account DE89370400440532013000"), (4, "+49 DE89370400440532013000"), (5, "+ (4111111111111111")]
    got = {r.doc_id: [(x.kind, x.score) for x in r.found] for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == [("ip", 0.6)] and got[2] == [("ip", 0.75)] and got[3] == [("iban", 0.95)]
    assert got[4] == [] and ("card", 0.7) in got[5]  # what continues a phone number is no account number without a word for it


# ---- pipeline ----


@pytest.mark.parametrize("make", [empty, awkward, clashing])
def test_stages_on_awkward_tables(spark, sf, make):
    import corpus_pipeline as c

    docs = make(spark)
    if make is clashing:
        docs = docs.drop("_none")
    for name, stage in c.STAGES:
        out = stage(spark, docs, sf)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        rows = out.collect()
        if make is empty:
            assert rows == []
        elif name in ("secret_scan", "best_fit_packing"):
            assert Counter(r.doc_id for r in rows if name == "secret_scan" or r.piece == 0) == Counter(r.doc_id for r in docs.collect())
