"""Length packing, spelling variants and the Merkle manifest against brute-force versions, and on awkward tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mosaica.llm import length_packing as lp
from mosaica.llm import merkle, spelling

from .helpers import DOCS, awkward, clashing, empty

OPERATORS = {"lengths": lp.pack_lengths, "words": spelling.spelling_variants, "manifest": merkle.manifest}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_tables(spark, name):
    op = OPERATORS[name]
    got, clash = op(awkward(spark)).collect(), op(clashing(spark)).collect()
    if name == "lengths":  # rests of equal length may change places
        got, clash = ([(r.doc_id, r.doc_tokens) for r in x if r.start == 0] for x in (got, clash))
    assert sorted(map(repr, got)) == sorted(map(repr, clash))
    assert op(empty(spark)).collect() == []
    if name != "words":
        assert len([r for r in got if name != "lengths" or True]) == awkward(spark).count()


# ---- length packing ----


def check_packing(rows, texts, window=1024):
    """Pieces cover every document's ids once, sequences are gapless and need no padding; returns the sequences' lengths."""
    tokenizer = Tokenizer.from_file(lp.default_tokenizer())
    ids = {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for k, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for k, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[k])
            assert r.ids_crc32 == zlib.crc32(np.array(ids[k][at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids[k])
    fills = []
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at == window or at <= window and at & (at - 1) == 0
        fills.append(at)
    return fills


def test_packing_brute(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    fills = check_packing(lp.pack_lengths(docs).collect(), {r.doc_id: r.text for r in docs.collect()})
    assert len(fills) <= sum(fills) // 1024 + 10


@pytest.mark.parametrize("text", ["", "x", "word " * 7, "word " * 599, "a\n" * 511])
def test_packing_of_equal_lengths(spark, text):
    """One length of all rows, which fills no window or all of them."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    check_packing(lp.pack_lengths(docs).collect(), dict.fromkeys(range(3000), text))


def test_units_equal_whole_texts():
    rng = random.Random(3)
    bits = ["a", "word", "Word,", "it's", "'ll", "12", "34x", " ", "  ", "\n", " \n", "\t", " ", " ", "\r\n", "é", "漢字", "😀", "<|endoftext|>", "(x)", "'", "_", "²", "--", "\x85", "ß!", ".\nNext", "\nA", "it.\nÉa,"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(4000)] + ["", " ", "  ", "a ", " a", "a  b", "a \n b"]
    encoder = lp.UnitEncoder(lp.default_tokenizer())
    want = [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(pa.array(texts)) == want
    assert encoder.encode(pa.array(texts)) == want  # from the cache


def test_plan_uses_combinations():
    """Lengths that fill windows in twos and threes are matched by counts, not laid end to end."""
    rng = np.random.default_rng(4)
    histogram = np.zeros(1025, np.int64)
    for _ in range(4000):
        cuts = np.sort(rng.choice(np.arange(1, 1024), 2, replace=False))
        for length in (cuts[0], cuts[1] - cuts[0], 1024 - cuts[1]):
            histogram[length] += 1
    plan = lp.make_plan(histogram)
    total = int((histogram * np.arange(1025)).sum())
    assert plan.line > 0.85 * total / 1024
    length = np.repeat(np.arange(1025), histogram)
    number = np.concatenate([np.arange(n) for n in histogram])
    which, at, size, sequence, offset = lp.place(plan, length, number)
    assert np.bincount(which, size).astype(int).tolist() == length.tolist()
    assert np.bincount(sequence, size).max() == 1024
    spots = np.sort(sequence * 1024 + offset)
    assert len(np.unique(spots)) == len(spots)


def test_nnls_meets_its_conditions():
    """No negative counts, and no column outside whose counts would lessen the error."""
    rng = np.random.default_rng(5)
    for window, columns in ((24, None), (48, None)):
        columns = lp.combinations(np.arange(1, window), window)
        target = rng.integers(0, 500, window + 1).astype(float)
        target[0] = 0
        chosen, x = lp.nnls(columns, target)
        assert (x >= 0).all()
        made = np.zeros(window + 1)
        for d in range(columns.shape[1]):
            np.add.at(made, columns[chosen, d], x * (columns[chosen, d] > 0))
        residual = target - made
        residual[0] = 0
        assert residual[columns].sum(1).max() < 1e-3 * target.max() * 24


# ---- spelling variants ----


def brute_words(rows, least=7, count=2):
    seen = Counter()
    for r in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", r.text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if n >= count and len(w) >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute_variants(words):
    out = {}
    for w, n in words.items():
        near = [x for x in words if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form = best if best and words[best] >= 10 * n else None
        out[w] = [n, len(near), form, words[form] if form else None]
    for w, v in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        v.append(root)
    return out


def test_spelling_brute(spark, sf):
    for docs in (awkward(spark), spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60")):
        want = brute_variants(brute_words(docs.collect()))
        got = {r.word: [r.n, r.n_near, r.form, r.form_n, r.root] for r in spelling.spelling_variants(docs).collect()}
        assert got == want


def test_spelling_long_lists(spark):
    """Lists beyond the bound are halved further and lose no pair; short alphabets and ways of several steps."""
    rng = random.Random(6)
    words = {"".join(rng.choice("ab") for _ in range(rng.randrange(7, 11))): rng.choice((2, 30, 400, 5000)) for _ in range(600)}
    words |= {"prefix" + "".join(rng.choice("xyz") for _ in range(5)) + "suffix": 3 for _ in range(150)} | {"abcdefgh": 2, "abcdefg": 20, "abcdef": 200, "abcde": 2000}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    pairs = {tuple(sorted((a, b))) for a in words for b in words if one_edit(a, b)}
    for bound in (4096, 20):
        got = [tuple(sorted((r.x, r.y))) for r in spelling.near_pairs(frame.select("word"), long_list=bound).collect()]
        assert len(got) == len(set(got)) and set(got) == pairs
    got = {r.word: [r.n, r.n_near, r.form, r.form_n, r.root] for r in spelling.group_variants(frame).collect()}
    assert got == brute_variants(words)
    assert got["abcdefgh"][4] == "abcde"


# ---- Merkle manifest ----


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_manifest(rows, lower):
    """(doc_id, leaf, subroot, root, proof, folded_root, verified) of every row, by one walk a leaf."""

    def digest(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))

    def tree(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
        return levels

    def way(levels, at):
        for level in levels[:-1]:
            low = at // 8 * 8
            yield level[low:at], level[at + 1 : low + 8]
            at //= 8

    langs = defaultdict(list)
    for r in rows:
        langs[r.lang].append(r)
    order = sorted(langs, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in order:
        langs[lang].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, digest(r, r.text)))
        trees[lang] = tree([digest(r, r.text) for r in langs[lang]])
    top = tree([trees[v][-1][0] for v in order])
    out = []
    for n, lang in enumerate(order):
        for at, r in enumerate(langs[lang]):
            tampered = lower and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.text is not None
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text) if tampered else r.text
            node, siblings = digest(r, text), ""
            for before, after in [*way(trees[lang], at), *way(top, n)]:
                node = sha("".join([*before, node, *after]))
                siblings += "".join([*before, *after])
            out.append((r.doc_id, digest(r, r.text), trees[lang][-1][0], top[-1][0], sha(siblings), node, node == top[-1][0]))
    return sorted(map(repr, out))


def test_manifest_brute(spark, sf):
    some = spark.createDataFrame([(i, f"Text {i}", f"l{i % 11}" if i % 11 else None, None, i) for i in range(700)] + [(i, "T", "one", "s", 1) for i in range(513)], DOCS)
    from string import ascii_lowercase, ascii_uppercase

    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    for docs in (awkward(spark), some, awkward(spark).limit(1), spark.read.parquet(f"{sf}/documents.parquet")):
        got = merkle.manifest(docs, tampering={"text": F.translate("text", ascii_uppercase, ascii_lowercase)}, where=third)
        assert sorted(repr(tuple(r)) for r in got.collect()) == brute_manifest(docs.collect(), True)
    assert sorted(repr(tuple(r)) for r in merkle.manifest(some).collect()) == brute_manifest(some.collect(), False)
