"""Secret scans: fixed credential patterns, and formats learned from them as probabilistic automata."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaica.llm.common import slices, stored, table, text_or_empty

# Fixed patterns and least lengths of the base kinds, in their order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")  # the matches of HEX with 24 characters or more
KINDS = ("assign", "access", "hex", "format")
ORDINARY = "ordinary"  # candidates that no base pattern labels
MIN_ASSIGN, MIN_ACCESS = 6, 20

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")  # from the least length of a labelled credential
TREE_SHARE = 500  # one in so many labelled credentials of a kind, at least one, must begin with a prefix for it to be a node of the kind's tree
DEPTHS = (0, 16, 64, 256)  # the tree grows from each depth to the next in one pass over the credentials
TALLY = 100_000  # counts that a task holds before it hands them on
ALPHA = 0.05
MARGIN = 0.5  # natural log odds a character that a credential must have over ordinary text
EVIDENCE = 12.0  # natural log odds in all that it must have, so that a short one must be the clearer
CACHE_SCORES = 50_000  # decisions by character classes that a task keeps
_FLOOR = 1e-4


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) of the fixed patterns, sorted by start, then kind."""
    low, out = text.lower(), []
    if any(w in low for w in ("password", "passwd", "secret", "token", "api")):
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    out += [(m.start(), 2, m.end(), m[0]) for m in LONG_HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, taken: list) -> Iterator[tuple[int, int, str]]:
    """Runs of credential characters that do not lie inside a base span."""
    at, reach = 0, 0
    for m in CANDIDATE.finditer(text):
        while at < len(taken) and taken[at][0] <= m.start():
            reach = max(reach, taken[at][2])
            at += 1
        if m.end() > reach:
            yield m.start(), m.end(), m[0]


_CLASSES = {c: "d" for c in "0123456789"} | {c: "h" for c in "abcdef"} | {c: "l" for c in "ghijklmnopqrstuvwxyz"} | {c: "H" for c in "ABCDEF"} | {c: "U" for c in "GHIJKLMNOPQRSTUVWXYZ"}
_TO_CLASS = str.maketrans(_CLASSES)
_ALPHABET, _START, _END = "dhlHU+/_.=-", "^", "$"  # classes of credential characters, and the marks around a run
_AFTER = _ALPHABET + _END


def _least(n: int) -> int:
    """How many of n credentials a node of the tree needs."""
    return -(-n // TREE_SHARE)


class FormatAutomaton:
    """Probabilistic automaton over character classes, inferred by merging statistically compatible states
    of the prefix tree of the examples (Hoeffding bound on every outgoing frequency).

    tree: how many examples go on with each class, or end, after a prefix. A prefix that few begin with is no node of its own: a run stays in its state there, and where
    no example went on. The frequencies are those of count(), the passes of all examples through the merged states."""

    def __init__(self, tree: dict[str, dict[str, int]], alpha: float = ALPHA):
        number = {p: i for i, p in enumerate(sorted(tree, key=lambda p: (len(p), p)))}
        self.count = [sum(tree[p].values()) for p in number]
        self.final = [tree[p].get(_END, 0) for p in number]
        self.next = [{c: [number.get(p + c), n] for c, n in tree[p].items() if c != _END} for p in number]
        self._width = math.sqrt(0.5 * math.log(2 / alpha))
        self._infer()
        self.to = {r: {c: to for c, (to, _) in self.next[r].items() if to is not None} for r in self.states}
        del self.count, self.final, self.next

    @classmethod
    def of(cls, examples: list[str]) -> FormatAutomaton:
        """The automaton of a short list of examples."""
        runs = [(x.translate(_TO_CLASS), 1) for x in examples]
        tree: dict[str, dict[str, int]] = {}
        for x, _ in runs:
            for i, c in enumerate(x + _END):
                after = tree.setdefault(x[:i], {})
                after[c] = after.get(c, 0) + 1
        least = _least(len(runs))
        out = cls({p: after for p, after in tree.items() if sum(after.values()) >= least and len(p) < DEPTHS[-1]})
        out.tables(out.passes(runs))
        return out

    def passes(self, runs: Iterable[tuple[str, int]]) -> Counter:
        """How often runs of classes, each so many times, go on with a class, or end, in a state."""
        found: Counter = Counter()
        for x, n in runs:
            state = 0
            for c in x:
                found[state, c] += n
                state = self.to[state].get(c, state)
            found[state, _END] += n
        return found

    def _close(self, x: int, n: int, y: int, m: int) -> bool:
        return not n or not m or abs(x / n - y / m) < self._width * (n**-0.5 + m**-0.5)

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.count[a], self.count[b]
            if not self._close(self.final[a], n, self.final[b], m):
                return False
            for c in {*self.next[a], *self.next[b]}:
                x, y = self.next[a].get(c), self.next[b].get(c)
                if not self._close(x[1] if x else 0, n, y[1] if y else 0, m):
                    return False
                if x and y and x[0] != y[0] and None not in (x[0], y[0]):
                    todo.append((x[0], y[0]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree at b to a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.count[a] += self.count[b]
            self.final[a] += self.final[b]
            for c, (child, n) in self.next[b].items():
                own = self.next[a].setdefault(c, [None, 0])
                own[1] += n
                if own[0] is None:
                    own[0] = child
                elif child is not None:
                    todo.append((own[0], child))

    def _infer(self) -> None:
        red, known = [0], {0}
        while True:
            blue = next(((r, c) for r in red for c, (to, _) in sorted(self.next[r].items()) if to is not None and to not in known), None)
            if blue is None:
                self.states = red
                return
            state = self.next[blue[0]][blue[1]][0]
            into = next((r for r in red if self._compatible(r, state)), None)
            if into is None:
                red.append(state)
                known.add(state)
            else:
                self.next[blue[0]][blue[1]][0] = into
                self._fold(into, state)

    def tables(self, passes: dict[tuple[int, str], int]) -> None:
        """Set the frequencies to those of the passes."""
        total: Counter = Counter()
        for (s, _), n in passes.items():
            total[s] += n
        self.moves: dict[int, dict[str, tuple[int, float]]] = {s: {} for s in self.states}
        for (s, c), n in passes.items():
            if c != _END:
                self.moves[s][c] = (self.to[s].get(c, s), math.log(n / total[s]))
        self.ends = {s: math.log(max(_FLOOR, passes.get((s, _END), 0) / max(1, total[s]))) for s in self.states}

    def log_likelihood(self, classes: str) -> float:
        state, total, floor = 0, 0.0, math.log(_FLOOR)
        for c in classes:
            move = self.moves[state].get(c)
            if move is None:
                total += floor
            else:
                state = move[0]
                total += move[1]
        return total + self.ends[state]


def _pairs(classes: str) -> Iterator[str]:
    return map("".join, pairwise(_START + classes + _END))


class FormatModel:
    """Automata of the base kinds, and a chain of ordinary candidates to hold them against.

    The chain has the frequency of each character class after the one before it, start and end included. So a run of digits, an
    address or a capitalised word is as likely as ordinary text makes it, though its classes alone are rare there.
    """

    def __init__(self, values: dict[str, list[str]], ordinary: list[str]):
        self._fitted({k: FormatAutomaton.of(v) for k, v in values.items() if v}, Counter(xy for o in ordinary for xy in _pairs(o.translate(_TO_CLASS))))

    @classmethod
    def fitted(cls, automata: dict[str, FormatAutomaton], pairs: dict[str, int]) -> FormatModel:
        """The model of known automata and of the counts of two classes, one after the other, in ordinary candidates."""
        out = cls.__new__(cls)
        out._fitted(automata, pairs)
        return out

    def _fitted(self, automata: dict[str, FormatAutomaton], pairs: dict[str, int]) -> None:
        self.automata = automata
        before: Counter = Counter()
        for xy, n in pairs.items():
            before[xy[0]] += n
        self.background = {(x, y): math.log((pairs.get(x + y, 0) + 1) / (before[x] + len(_AFTER))) for x in _START + _ALPHABET for y in _AFTER}

    def log_odds(self, classes: str) -> float:
        """Log odds of the likeliest credential format against ordinary text, for a run of character classes."""
        if not self.automata:
            return -math.inf
        ordinary = sum(self.background[xy] for xy in pairwise(_START + classes + _END))
        return max(a.log_likelihood(classes) for a in self.automata.values()) - ordinary

    def is_secret(self, value: str, known: dict | None = None) -> bool:
        """Whether the log odds are above MARGIN a character and EVIDENCE in all; known keeps decisions between calls."""
        classes = value.translate(_TO_CLASS)
        if known is None or classes not in known:
            odds = self.log_odds(classes)
            said = odds > EVIDENCE and odds > MARGIN * len(classes)
            if known is None:
                return said
            if len(known) > CACHE_SCORES:
                known.clear()
            known[classes] = said
        return known[classes]


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, value): labelled credentials and ordinary candidates; of repeated values few leave the task."""
    seen: set = set()
    for b in slices(batches, "t"):
        new: set = set()
        for t in b.column(0).to_pylist():
            found = base_spans(t)
            new.update((KINDS[k], v) for _, k, _, v in found)
            new.update((ORDINARY, v) for _, _, v in candidates(t, found))
        new -= seen
        if len(seen) > TALLY:
            seen.clear()
        seen |= new
        kinds, values = zip(*new) if new else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string())], ["kind", "value"])


def _rows(b: pa.RecordBatch) -> Iterator[tuple[str, str, int]]:
    return zip(*(b.column(c).to_pylist() for c in ("kind", "classes", "n")))


def _tallied(batches: Iterator[pa.RecordBatch], count) -> Iterator[pa.RecordBatch]:
    """(kind, at, next, n): the sums of what count(kind, classes, n) gives, in parts."""

    def batch():
        keys = list(zip(*tally)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([*(pa.array(k, pa.string()) for k in keys), pa.array(list(tally.values()), pa.int64())], ["kind", "at", "next", "n"])

    tally: Counter = Counter()
    for b in slices(batches, "classes"):
        for row in _rows(b):
            for key, n in count(*row):
                tally[key] += n
            if len(tally) > TALLY:
                yield batch()
                tally.clear()
    yield batch()


def _sums(runs: DataFrame, count) -> DataFrame:
    return runs.mapInArrow(lambda it: _tallied(it, count), "kind string, at string, next string, n long").groupBy("kind", "at", "next").agg(F.sum("n").alias("n"))


def _grow(runs: DataFrame, least: dict[str, int]) -> dict[str, dict[str, dict[str, int]]]:
    """The prefix tree of each kind, down to the last of DEPTHS: what goes on after each prefix that `least` credentials begin with."""
    trees: dict[str, dict] = {k: {} for k in least}
    known = {(k, "") for k in least}
    enough = F.create_map(*[F.lit(x) for kn in least.items() for x in kn])
    for low, high in pairwise(DEPTHS):
        shared = runs.sparkSession.sparkContext.broadcast(known)

        def count(kind, classes, n, low=low, high=high, shared=shared):
            if (kind, classes[:low]) in shared.value:
                for i, c in enumerate((classes + _END)[low:high], low):
                    yield (kind, classes[:i], c), n

        after = _sums(runs, count).groupBy("kind", "at").agg(F.map_from_entries(F.collect_list(F.struct("next", "n"))).alias("after"), F.sum("n").alias("n"))
        for r in after.where(F.col("n") >= enough[F.col("kind")]).select("kind", "at", "after").collect():
            trees[r.kind][r["at"]] = r.after
        known = {(k, p + c) for k, t in trees.items() for p, a in t.items() if len(p) == high - 1 for c, n in a.items() if c != _END and n >= least[k]}
        if not known:
            break
    return trees


def learn_formats(docs: DataFrame, text_col: str = "text") -> FormatModel:
    """Fit the automata on all credentials that the base patterns label and the chain on all ordinary candidates of the table, each distinct one once, whatever its
    length. The texts are read once; the driver gets counts alone: of the prefixes that one in TREE_SHARE credentials of a kind begins with, of the passes through
    the merged states, which all credentials make to their ends, and of pairs of classes."""
    found = docs.select(text_or_empty(text_col).alias("t")).mapInArrow(_values, "kind string, value string").distinct()
    classes = F.translate("value", "".join(_CLASSES), "".join(_CLASSES.values()))
    every = stored(found.groupBy("kind", classes.alias("classes")).agg(F.count("*").alias("n")))
    runs = every.where(F.col("kind") != ORDINARY)
    total = {r.kind: r.n for r in runs.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    automata = {k: FormatAutomaton(t) for k, t in sorted(_grow(runs, {k: _least(n) for k, n in total.items()}).items())} if total else {}
    shared = docs.sparkSession.sparkContext.broadcast(automata)
    passes: dict[str, dict] = {k: {} for k in automata}
    for r in _sums(runs, lambda kind, x, n: (((kind, str(s), c), m) for (s, c), m in shared.value[kind].passes([(x, n)]).items())).collect() if automata else []:
        passes[r.kind][int(r["at"]), r.next] = r.n
    for k, a in automata.items():
        a.tables(passes[k])
    pairs = _sums(every.where(F.col("kind") == ORDINARY), lambda kind, x, n: (((kind, xy[0], xy[1]), n) for xy in _pairs(x)))
    return FormatModel.fitted(automata, {r["at"] + r.next: r.n for r in pairs.collect()})


def all_spans(text: str, model: FormatModel, known: dict | None = None) -> tuple[list, list]:
    """(base, all): lists of (start, kind number, end)."""
    base = base_spans(text)
    added = [(s, 3, e) for s, e, v in candidates(text, base) if model.is_secret(v, known)]
    base = [x[:3] for x in base]
    return base, sorted(base + added)


def _digest(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    known: dict = {}
    for b in slices(batches, "t"):
        counts, sha, spans = [], [], []
        for t in b.column(1).to_pylist():
            base, every = all_spans(t, model.value, known)
            n = Counter(k for _, k, _ in base)
            counts.append((n[0], n[1], n[2]))
            sha.append(hashlib.sha256(_digest(base).encode()).hexdigest())
            spans.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in every])
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([c[i] for c in counts], pa.int64()) for i in range(3)), pa.array(sha, pa.string()), pa.array(spans, span)], ["id", "n_assign", "n_access", "n_hex", "base_sha256", "found"])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: FormatModel | None = None) -> DataFrame:
    """(id_col, n_assign, n_access, n_hex, base_sha256, found), one row per input row; found holds kind, start and end of
    all spans in code points. The kind `format` marks what the learned automata add: any run of credential characters that does not lie
    inside a base span and whose likelihood under a learned format clears MARGIN and EVIDENCE.

    A null text counts as empty and has no spans. Repeated rows give repeated rows, null ids stay null, an empty table
    gives an empty result; without any labelled credential nothing is added.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model or learn_formats(docs, text_col))
    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("t")).mapInArrow(
        lambda it: _scan(it, shared),
        f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, found array<struct<kind:string,start:int,end:int>>",
    ).withColumnRenamed("id", id_col)


def mask(text: str, spans: list) -> str:
    """The text with every span replaced by [secret]; overlapping spans are one."""
    out, at = [], 0
    for s, _, e in spans:
        if e <= at:
            continue
        if s >= at:
            out += [text[at:s], "[secret]"]
        at = e
    return "".join(out) + text[at:]


def _masked(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    known: dict = {}
    for b in slices(batches, "text"):
        texts = [None if t is None else mask(t, all_spans(t, model.value, known)[1]) for t in b.column("text").to_pylist()]
        at = b.schema.get_field_index("text")
        yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))


def mask_secrets(docs: DataFrame) -> DataFrame:
    """The documents (a column `text`, any others) with every secret in the text replaced by [secret]; a null text stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(learn_formats(docs))
    return docs.mapInArrow(lambda it: _masked(it, shared), docs.schema)


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    listed = F.expr("array_join(transform(found, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", listed.alias("spans"))


QUERIES = {"op8_secret_scan": op8_secret_scan}
ORACLE: dict[str, str] = {}
