"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaica.llm.common import slices, table, text_or_empty

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the model format
UNKNOWN_PENALTY = 10.0
_CACHE_WORDS = 300_000
_LONG = 48  # bytes from which a word is walked alone


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of one protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        shift = value = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, data[at : at + n]
            at += n
        else:
            n = 4 if kind == 5 else 8
            yield tag >> 3, data[at : at + n]
            at += n


class DoubleArray:
    """Trie in two arrays: the child of state s by byte c is base[s] + c if check of that cell is s."""

    def __init__(self, keys: dict[bytes, int]):
        tree: list[dict] = [{}]
        value = [-1]
        for key, v in keys.items():
            node = 0
            for c in key:
                if c not in tree[node]:
                    tree[node][c] = len(tree)
                    tree.append({})
                    value.append(-1)
                node = tree[node][c]
            value[node] = v
        size = 8 * len(tree) + 1024
        base, check, leaf = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        used = bytearray(size)
        used[0] = 1
        todo, start = [(0, 0)], 1
        while todo:
            node, cell = todo.pop()
            labels = sorted(tree[node])
            if not labels:
                continue
            while used[start]:
                start += 1
            at = max(0, start - labels[0])
            while any(used[at + c] for c in labels):
                at += 1
            if at + labels[0] - start > 200:
                start += 100  # leave crowded cells behind
            base[cell] = at
            for c in labels:
                used[at + c] = 1
                check[at + c] = cell
                leaf[at + c] = value[tree[node][c]]
                todo.append((tree[node][c], at + c))
        self.base, self.check, self.leaf = base, check, leaf


class PieceModel:
    """Pieces with log scores and byte fallback, read from a model file's bytes."""

    def __init__(self, data: bytes):
        self.pieces, self.scores, self.types, self.dummy_prefix = [], [], [], True
        for number, value in _fields(data):
            if number == 1:
                f = dict(_fields(value))
                self.pieces.append(f[1].decode("utf-8"))
                self.scores.append(struct.unpack("<f", f[2])[0] if 2 in f else 0.0)
                self.types.append(f.get(3, NORMAL))
            elif number == 3:
                self.dummy_prefix = bool(dict(_fields(value)).get(3, 1))
        # a piece of the user's own outweighs every other way through its bytes
        best = max((s for s, t in zip(self.scores, self.types) if t == NORMAL), default=0.0)
        self.scores = [len(p.encode("utf-8")) * best - 0.1 if t == USER else s for p, s, t in zip(self.pieces, self.scores, self.types)]
        self.score = np.array(self.scores, np.float64)
        self.digest = hashlib.sha256(data).hexdigest()
        known = {p.encode("utf-8"): i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t in (NORMAL, USER)}
        self.trie = DoubleArray(known)
        self.unknown_score = min(s for s, t in zip(self.scores, self.types) if t == NORMAL) - UNKNOWN_PENALTY
        self.unknown = self.types.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == BYTE}
        self.splits = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.pieces)
        self.output = [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == CONTROL else b" \xe2\x81\x87 " if t == UNKNOWN else p.replace(SPACE, " ").encode("utf-8") for p, t in zip(self.pieces, self.types)]
        self._lists = (self.trie.base.tolist(), self.trie.check.tolist(), self.trie.leaf.tolist())

    def words(self, text: str) -> list[str]:
        """The text with white-space markers, cut where no piece can cross."""
        marked = (SPACE if self.dummy_prefix and text else "") + text.replace(" ", SPACE)
        return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", marked) if self.splits else [marked]

    def _fallback(self, char: bytes) -> list[int]:
        return [self.bytes[b] for b in char] if self.bytes else [self.unknown]

    def encode_long(self, word: bytes) -> list[int]:
        """Viterbi of one word in plain Python."""
        base, check, leaf = self._lists
        n = len(word)
        best, back = [-np.inf] * n + [-np.inf], [(0, -1)] * (n + 1)
        best[0] = 0.0
        at = 0
        while at < n:
            width = _char_width(word[at])
            state, single, here = 0, False, best[at]
            for j in range(at, n):
                to = base[state] + word[j]
                if to >= len(check) or check[to] != state or to == 0:
                    break
                state = to
                if leaf[state] >= 0:
                    single |= j + 1 - at == width
                    if here + self.score[leaf[state]] > best[j + 1]:
                        best[j + 1], back[j + 1] = here + self.score[leaf[state]], (at, leaf[state])
            if not single and here + self.unknown_score > best[at + width]:
                best[at + width], back[at + width] = here + self.unknown_score, (at, -1)
            at += width
        return self._path(word, back, n)

    def _path(self, word: bytes, back, n: int) -> list[int]:
        out: list[list[int]] = []
        while n:
            at, piece = back[n]
            out.append([piece] if piece >= 0 else self._fallback(word[at:n]))
            n = at
        return [i for part in reversed(out) for i in part]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Viterbi of many short words at once: every step moves all words that are still on a path of the trie."""
        if not words:
            return []
        trie, n = self.trie, np.array([len(w) for w in words])
        top = int(n.max())
        text = np.zeros((len(words), top + 4), np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        row = np.repeat(np.arange(len(words)), n)
        text[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
        best = np.full((len(words), top + 5), -np.inf)
        best[:, 0] = 0
        start, piece = np.zeros(best.shape, np.int16), np.full(best.shape, -1, np.int32)
        cells = len(trie.check)
        for at in range(top):
            live = np.flatnonzero((n > at) & (best[:, at] > -np.inf))
            if not len(live):
                continue
            lead = text[live, at]
            width = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
            single = np.zeros(len(words), bool)
            on, state, wide = live, np.zeros(len(live), np.int64), width
            for j in range(at, top):
                to = trie.base[state] + text[on, j]
                ok = (to > 0) & (to < cells) & (n[on] > j)
                ok &= trie.check[np.where(ok, to, 0)] == state
                on, state, wide = on[ok], to[ok], wide[ok]
                if not len(on):
                    break
                leaf = trie.leaf[state]
                hit = leaf >= 0
                if hit.any():
                    rows, leaf = on[hit], leaf[hit]
                    single[rows[wide[hit] == j + 1 - at]] = True
                    got = best[rows, at] + self.score[leaf]
                    more = got > best[rows, j + 1]
                    rows = rows[more]
                    best[rows, j + 1], start[rows, j + 1], piece[rows, j + 1] = got[more], at, leaf[more]
            lone = ~single[live]
            rows, to = live[lone], at + width[lone]
            got = best[rows, at] + self.unknown_score
            more = got > best[rows, to]
            rows, to = rows[more], to[more]
            best[rows, to], start[rows, to], piece[rows, to] = got[more], at, -1
        ends, start, piece = n.tolist(), start.tolist(), piece.tolist()
        return [self._path(w, list(zip(s, p)), e) for w, s, p, e in zip(words, start, piece, ends)]

    def encode(self, texts: list[str], known: dict) -> list[bytes]:
        """Ids of each text as little-endian 32-bit values; known keeps words between calls."""
        split = [self.words(t) for t in texts]
        if len(known) > _CACHE_WORDS:
            known.clear()
        new = [w for w in {w for words in split for w in words if w not in known}]
        raw = [w.encode("utf-8") for w in new]
        short = [i for i, w in enumerate(raw) if len(w) < _LONG]
        for low in range(0, len(short), 20_000):
            part = short[low : low + 20_000]
            for i, ids in zip(part, self.encode_words([raw[i] for i in part])):
                known[new[i]] = np.array(ids, "<u4").tobytes()
        for i, w in enumerate(raw):
            if len(w) >= _LONG:
                known[new[i]] = np.array(self.encode_long(w), "<u4").tobytes()
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def decode(self, ids) -> str:
        """Pieces joined, byte pieces as bytes, markers as spaces, without the leading marker that encoding adds."""
        out = b"".join(map(self.output.__getitem__, ids))
        return (out[1:] if self.dummy_prefix and out[:1] == b" " else out).decode("utf-8", "replace")


def _char_width(lead: int) -> int:
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


_words_seen: dict[str, dict] = {}  # the words of one model, by the digest of its file


def _encoded(batches: Iterator[pa.RecordBatch], model, digest: bool, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    m = model.value
    if m.digest not in _words_seen:
        _words_seen.clear()
    known = _words_seen.setdefault(m.digest, {})
    for part in slices(batches, "t"):
        texts = part.column(1).to_pylist()
        ids = [np.frombuffer(x, "<u4") for x in m.encode(texts, known)]
        if digest:
            back = [m.decode(x.tolist()) == t for x, t in zip(ids, texts)]
            cols = [pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()), pa.array(back, pa.bool_())]
            yield pa.RecordBatch.from_arrays([part.column(0), *cols], schema=pa.schema([("id", kind), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("round_trip", pa.bool_())]))
        else:
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))], schema=pa.schema([("id", kind), ("ids", pa.list_(pa.int32()))]))


def _decoded(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if x is None else model.value.decode(x) for x in b.column(1).to_pylist()], pa.string())], ["id", "text"])


def load_model(path: str | None = None) -> PieceModel:
    with open(path or default_model(), "rb") as f:
        return PieceModel(f.read())


def _run(docs: DataFrame, id_col: str, text_col: str, model: PieceModel | None, digest: bool, out: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[id_col].dataType
    arrow = to_arrow_type(kind)
    shared = docs.sparkSession.sparkContext.broadcast(model or load_model())
    raw = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("t"))
    return raw.mapInArrow(lambda it: _encoded(it, shared, digest, arrow), f"id {kind.simpleString()}, {out}").withColumnRenamed("id", id_col)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: PieceModel | None = None) -> DataFrame:
    """(id_col, ids), one row per input row: the piece ids of the best path under the model's log scores.

    Characters that no piece covers become their UTF-8 bytes. A null or empty text has no ids; repeated rows and
    null ids pass through; an empty table gives an empty result.
    """
    return _run(docs, id_col, text_col, model, False, "ids array<int>")


def decode(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: PieceModel | None = None) -> DataFrame:
    """(id_col, text): the texts of id sequences; null stays null, no ids give the empty text."""
    kind = tokens.schema[id_col].dataType.simpleString()
    shared = tokens.sparkSession.sparkContext.broadcast(model or load_model())
    return tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("x")).mapInArrow(lambda it: _decoded(it, shared), f"id {kind}, text string").withColumnRenamed("id", id_col)


def op4_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """n_tokens, CRC-32 of the ids, and whether decoding them gives the text again."""
    return _run(table(spark, sf_dir, "documents"), "doc_id", "text", None, True, "n_tokens long, ids_crc32 long, round_trip boolean")


QUERIES = {"op4_sentencepiece": op4_sentencepiece}
ORACLE: dict[str, str] = {}
