"""Secret scans by grammar inference (operator 13).

Credentials that announce themselves (an assignment to a password, an access
key's prefix, a long hexadecimal run) are found by patterns; they are the *base*
spans and the labelled examples. From them the formats of credentials are
learned, and candidates that no pattern names are scored by those formats.

* The distinct labelled strings of a kind form a prefix tree: one state per prefix,
  with the number of strings that pass and that end there. A prefix has a state if
  at least one in ``DETAIL`` of the strings begins with it; rarer ones are counted
  where they leave the tree.
* States are merged from the root outwards (red and blue states) if they are
  statistically compatible: the frequencies of ending and of each next symbol
  differ by less than the Hoeffding bound at ``ALPHA``, in them and in all states
  that their merging makes one. What is left is a probabilistic automaton. Where
  rarer prefixes leave it, they go on in states that know the class of the last
  symbol only. All strings are run through it, and its probabilities are the
  frequencies of what they do.
* One automaton is learned per kind and one of ordinary long words. A symbol is
  a character class (lower case, upper case, digit, each mark) or, in the first
  ``PREFIX`` states of a string, the character itself, so that prefixes of a
  format stay what they are.
* Ordinary words are the maximal runs of ``RUN`` characters that meet no base
  span; those of at least ``SHORTEST`` characters are the candidates. (Unknown
  credentials are ordinary words too, but few among them.) Every other string of a
  kind, by its hash, is learned from, the rest is set aside. A string is of a kind's
  format if its log likelihood per symbol is within the range of the labelled
  strings set aside, but for the outermost ``OUTER`` at either end: as likely
  as those are, neither less nor more (a run of one digit is likelier than any
  key). Its score is the greatest, over the kinds whose format it has, of the log
  likelihood less that of ordinary words, per symbol. A candidate becomes a span
  of kind ``format`` if its score is greater than that of all but ``FALSE`` of the
  ordinary words set aside, and above zero.

How rows are dealt: texts are read once, in place; spans and words are written to
the shared checkpoint folder, and the distinct strings of the whole table, half of
them learned from and half set aside, next to it. Every one of them counts: tree
states by an aggregate of prefixes, a few symbols deeper each time and only below
prefixes frequent so far; probabilities by an aggregate of moves; ranges and threshold by
exact ranks of all scores. The driver gets the states of the tree, at most
``DETAIL`` of one depth and kind, with the counts of their next symbols, and merges
them; every candidate of every text is then scored. Nothing depends on how often a
string repeats.

Defined cases: a null or empty text has no spans and the digest of the empty
string; rows of one id are scanned apart; repeated rows give repeated results; a
corpus with fewer than two labelled strings of a kind has no automaton for it, and one
without any automaton, or with fewer than two ordinary words, gets base spans only; an empty table gives an empty result; extra
columns are left behind.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from string import ascii_letters, digits

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import column_batches, cut
from cohortkit.operators.quantiles import quantiles

KINDS = ("assign", "access", "hex", "format")
FORMAT = 3
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Characters that a value, an access key and a hexadecimal run need at least.
LEAST = (6, 20, 24)
HEX = re.compile(r"[0-9a-f]{%d,}" % LEAST[2])  # runs are maximal, so shorter ones need not be matched
RUN = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
SHORTEST = 16
#: A prefix that one in so many strings begin with has a state in the prefix tree.
DETAIL = 2000
#: Symbols that the prefix tree is deep after the first aggregate; each next one doubles its depth.
FIRST = 4
ALPHA = 0.05
PREFIX = 6
#: The share of ordinary words that may score as a credential.
FALSE = 0.002
#: The share of labelled strings at either end of a format's range that are left out.
OUTER = 0.01
#: Documents that are scanned at a time.
ROWS = 500
#: Strings whose scores a worker remembers.
REMEMBER = 100_000


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, labelled string) by start, then kind."""
    out = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "key" in low:
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST[0]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST[1]]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def runs(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, end, string) of the runs that meet no base span."""
    out, at, reach = [], 0, 0
    for m in RUN.finditer(text):
        # base spans that begin before this run ends; reach is the furthest end of them
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][2])
            at += 1
        if reach <= m.start():
            out.append((m.start(), m.end(), m[0]))
    return out


def symbols(string: str) -> list[str]:
    """Characters at first, then their classes."""
    return [c if i < PREFIX else "a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if c.isdigit() else c
            for i, c in enumerate(string)]


#: The character classes, and the place of each symbol's class among them.
CLASSES = "aA0+/_=.-"
CLASS_OF = {c: CLASSES.index(symbols("-" * PREFIX + c)[-1]) for c in ascii_letters + digits + CLASSES[3:]}


class Automaton:
    """A probabilistic automaton, inferred by merging states of a prefix tree:
    that of ``strings``, or ``tree`` with each state's moves, counts of
    next symbols, and ends. A symbol may be counted and have no move."""

    def __init__(self, strings: list[str], alpha: float = ALPHA, tree: tuple[list, list, list] | None = None):
        self.alpha = math.sqrt(0.5 * math.log(2 / alpha))
        self.next: list[dict[str, int]]
        self.seen: list[dict[str, int]]
        self.next, self.seen, self.ends = tree or ([{}], [{}], [0])
        for string in strings:
            state = 0
            for s in symbols(string):
                self.seen[state][s] = self.seen[state].get(s, 0) + 1
                if s not in self.next[state]:
                    self.next[state][s] = len(self.next)
                    self.next.append({}), self.seen.append({}), self.ends.append(0)
                state = self.next[state][s]
            self.ends[state] += 1
        self.n_prefixes = len(self.next)
        self.totals = [e + sum(seen.values()) for e, seen in zip(self.ends, self.seen, strict=True)]
        self._infer()

    def _infer(self) -> None:
        red, marked = [0], {0}
        # the most frequent blue state first: its merge is the best founded
        blue = [(-self.seen[0][s], 0, s) for s in self.next[0]]
        heapq.heapify(blue)
        while blue:
            n, parent, symbol = heapq.heappop(blue)
            state = self.next[parent][symbol]
            if state in marked or -n != self.seen[parent][symbol]:
                continue  # settled, or counted anew
            for r in red:
                if self._compatible(r, state):
                    self.next[parent][symbol] = r
                    grown = self._fold(r, state)
                    break
            else:
                red.append(state)
                marked.add(state)
                grown = [(state, s) for s in self.next[state]]
            for r, s in grown:
                if r in marked and s in self.next[r] and self.next[r][s] not in marked:
                    heapq.heappush(blue, (-self.seen[r][s], r, s))
        self.states = red

    def _differs(self, f1: int, n1: int, f2: int, n2: int, root: float) -> bool:
        return abs(f1 / n1 - f2 / n2) > root

    def _compatible(self, a: int, b: int) -> bool:
        """Whether b (a tree) may be merged into a, by all frequencies on the way."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n1, n2 = self.totals[a], self.totals[b]
            if not n1 or not n2:
                continue
            root = self.alpha * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))
            if self._differs(self.ends[a], n1, self.ends[b], n2, root):
                return False
            for s in self.seen[a].keys() | self.seen[b].keys():
                if self._differs(self.seen[a].get(s, 0), n1, self.seen[b].get(s, 0), n2, root):
                    return False
                if s in self.next[a] and s in self.next[b]:
                    todo.append((self.next[a][s], self.next[b][s]))
        return True

    def _fold(self, a: int, b: int) -> list[tuple[int, str]]:
        """Adds the counts of the tree b to a; returns the moves that were counted anew."""
        todo, grown = [(a, b)], []
        while todo:
            a, b = todo.pop()
            self.ends[a] += self.ends[b]
            self.totals[a] += self.totals[b]
            for s, n in self.seen[b].items():
                self.seen[a][s] = self.seen[a].get(s, 0) + n
                if s not in self.next[b]:
                    pass
                elif s in self.next[a]:
                    todo.append((self.next[a][s], self.next[b][s]))
                else:
                    self.next[a][s] = self.next[b][s]
                grown.append((a, s))
        return grown

    def moves(self) -> list[dict[str, int]]:
        """Per state: the number of the state after each symbol."""
        number = {s: i for i, s in enumerate(self.states)}
        return [{c: number[t] for c, t in self.next[s].items()} for s in self.states]

    def compact(self) -> list[tuple[float, dict[str, tuple[float, int]], float]]:
        return compact(self.moves(), [self.seen[s] for s in self.states], [self.ends[s] for s in self.states])


def compact(moves: list[dict[str, int]], seen: list[dict[str, int]],
            ends: list[int]) -> list[tuple[float, dict[str, tuple[float, int]], float]]:
    """Per state: log probability of ending, of each symbol with its target,
    and of a symbol that was never seen there (one of ``ALPHABET``)."""
    out = []
    for to, counts, end in zip(moves, seen, ends, strict=True):
        n = end + sum(counts.values()) + ALPHABET + 1  # every symbol and the end are seen once more
        out.append((math.log((end + 1) / n), {s: (math.log((c + 1) / n), to[s]) for s, c in sorted(counts.items())}, math.log(1 / n)))
    return out


#: Symbols that a state may be followed by: the characters of ``RUN`` and the classes.
ALPHABET = 67


def log_likelihood(machine: list, string: str) -> float:
    state, total = 0, 0.0
    for s in symbols(string):
        _, moves, never = machine[state]
        move = moves.get(s)
        if move is None:
            total += never  # a symbol that was not seen leads to the root
            state = 0
        else:
            total += move[0]
            state = move[1]
    return total + machine[state][0]


class Scorer:
    """Automata of credentials, each with the range of its format, against that
    of ordinary words."""

    def __init__(self, formats: list[tuple[list, float, float]], ordinary: list, threshold: float = math.inf):
        self.formats, self.ordinary, self.threshold = formats, ordinary, threshold

    def score(self, string: str) -> float:
        size, best = len(string) + 1, -math.inf
        for machine, low, high in self.formats:
            likely = log_likelihood(machine, string) / size
            if low <= likely <= high:
                best = max(best, likely)
        return best if best == -math.inf else best - log_likelihood(self.ordinary, string) / size

    def is_secret(self, string: str) -> bool:
        return self.threshold < math.inf and self.score(string) > self.threshold


_SPANS = "array<struct<kind:int,start:long,end:long,value:string>>"
_FOUND = f"doc_id long, base {_SPANS}, candidates {_SPANS}, words array<string>"


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and candidates of every row. ``words`` has the shorter
    ordinary words of the row, but for those of rows before it in its batch."""
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in column_batches(batches, ROWS):
            base_out, cand_out, words, met = [], [], [], set()
            for text in batch.column(1).to_pylist():
                base = base_spans(text) if text else []
                found = runs(text, base) if text else []
                fresh = {v for a, b, v in found if b - a < SHORTEST} - met
                met |= fresh
                words.append(list(fresh))
                base_out.append([(k, a, b, v) for a, k, b, v in base])
                cand_out.append([(FORMAT, a, b, v) for a, b, v in found if b - a >= SHORTEST])
            names = ("kind", "start", "end", "value")
            wrap = lambda rows: pa.array([[dict(zip(names, s, strict=True)) for s in r] for r in rows], kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), wrap(base_out), wrap(cand_out), pa.array(words, pa.list_(pa.string()))], ["doc_id", "base", "candidates", "words"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _FOUND)


def strings(found: DataFrame) -> DataFrame:
    """kind, value and learned of every distinct string of ``spans``. Every other
    one of a kind, in the order of the hashes, is learned from, beginning with the first."""
    of_kind = found.select(F.explode("base").alias("s")).select("s.kind", "s.value")
    long = found.select(F.explode("candidates").alias("s")).select("s.kind", "s.value")
    short = found.select(F.lit(FORMAT).alias("kind"), F.explode("words").alias("value"))
    every = of_kind.unionByName(long).unionByName(short).distinct().withColumn("_h", F.xxhash64("value"))
    # places within 4,096 ranges of the hashes, then the ranges' sizes
    every = every.withColumn("_range", F.shiftright("_h", 52))
    place = F.row_number().over(Window.partitionBy("kind", "_range").orderBy("_h", "value"))
    every = cut(every.select("kind", "value", "_range", place.alias("_place")), "secrets-strings")
    upto = Window.partitionBy("kind").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = every.groupBy("kind", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("kind", "_range", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    placed = every.join(F.broadcast(before), ["kind", "_range"])
    return cut(placed.select("kind", "value", ((F.col("_before") + F.col("_place")) % 2 == 1).alias("learned")), "secrets-halves")


_PREFIXES = "kind int, id binary, parent binary, symbol string, n long, ends long"


def _prefixes(learned: DataFrame, below: dict[int, set[bytes]], done: int, upto: int) -> DataFrame:
    """The prefixes of more than ``done`` and at most ``upto`` symbols of all strings that
    begin with one of ``below`` (their first ``done`` symbols), with the numbers of strings
    that pass and that end there. A prefix's id is a digest of its symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in column_batches(batches, ROWS):
            passed, ended = Counter(), Counter()
            for kind, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if len(value) <= done:
                    continue
                word = symbols(value[:upto])
                digest = xxhash.xxh3_128("".join(word[:done]))
                at = digest.digest() if done else b""
                if at not in below[kind]:
                    continue
                for s in word[done:]:
                    parent = at
                    digest.update(s)
                    at = digest.digest()
                    passed[kind, at, parent, s] += 1
                if len(value) <= upto:
                    ended[kind, at, parent, s] += 1
            keys = list(passed)
            columns = list(zip(*keys, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.string()),
                 pa.array([passed[k] for k in keys], pa.int64()), pa.array([ended[k] for k in keys], pa.int64())],
                ["kind", "id", "parent", "symbol", "n", "ends"])

    return learned.mapInArrow(run, _PREFIXES).groupBy("kind", "id", "parent", "symbol").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"))


def trees(learned: DataFrame, least: dict[int, int]) -> dict[int, tuple[list, list, list]]:
    """Per kind the prefix tree of the strings: the prefixes that at least ``least`` begin
    with, each with the counts of all symbols after it."""
    out = {k: ([{}], [{}], [0]) for k in least}
    states = {k: {b"": 0} for k in least}
    below, done, upto = {k: {b""} for k in least}, 0, FIRST
    enough = F.element_at(F.create_map(*[F.lit(x) for e in least.items() for x in e]), F.col("kind"))
    while any(below.values()):
        every = cut(_prefixes(learned, below, done, upto), "secrets-prefixes")
        kept = every.filter(F.col("n") >= enough).select("kind", F.col("id").alias("parent"))
        top = learned.sparkSession.createDataFrame([(k, bytearray(i)) for k, ids in below.items() for i in ids], "kind int, parent binary")
        rows = every.join(kept.unionByName(top), ["kind", "parent"], "left_semi").collect()
        children: dict[tuple[int, bytes], list] = {}
        for r in rows:
            children.setdefault((r["kind"], bytes(r["parent"])), []).append((r["symbol"], bytes(r["id"]), r["n"], r["ends"]))
        # level by level, so that the numbers of states follow from the strings alone; only
        # where some string goes on
        level = sorted((k, states[k][i], i) for k, ids in below.items() for i in ids)
        for _ in range(done, upto):
            deeper = []
            for kind, state, at in level:
                moves, seen, ends = out[kind]
                for symbol, i, n, end in sorted(children.get((kind, at), [])):
                    seen[state][symbol] = n
                    if n >= least[kind]:
                        states[kind][i] = moves[state][symbol] = len(moves)
                        if n > end:
                            deeper.append((kind, len(moves), i))
                        moves.append({}), seen.append({}), ends.append(end)
            level = deeper
        below = {k: {i for kind, s, i in level if kind == k} for k in least}
        done, upto = upto, 2 * upto
    return out


_MOVES = "kind int, state int, symbol string, n long"


def frequencies(learned: DataFrame, automata: dict[int, Automaton]) -> dict[int, list]:
    """The automata with the frequencies of what all strings do in them. A symbol
    without a move leads to the state of its class, one of those behind the automaton's own."""
    moves = {k: a.moves() for k, a in automata.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: Counter = Counter()
        for batch in batches:
            for kind, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                to, state = moves[kind], 0
                for s in symbols(value):
                    done[kind, state, s] += 1
                    after = to[state].get(s) if state < len(to) else None
                    state = len(to) + CLASS_OF[s] if after is None else after
                done[kind, state, ""] += 1
        keys = list(done)
        columns = list(zip(*keys, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string()), pa.array([done[k] for k in keys], pa.int64())],
            ["kind", "state", "symbol", "n"])

    counted = learned.mapInArrow(run, _MOVES).groupBy("kind", "state", "symbol").agg(F.sum("n").alias("n")).collect()
    out = {}
    for kind, to in moves.items():
        seen: list[dict[str, int]] = [{} for _ in range(len(to) + len(CLASSES))]
        ends = [0] * len(seen)
        for r in counted:
            if r["kind"] == kind and r["symbol"]:
                seen[r["state"]][r["symbol"]] = r["n"]
            elif r["kind"] == kind:
                ends[r["state"]] = r["n"]
        after = [{s: own.get(s, len(to) + CLASS_OF[s]) for s in counts} for own, counts in zip([*to, *[{}] * len(CLASSES)], seen, strict=True)]
        out[kind] = compact(after, seen, ends)
    return out


def _at_ranks(aside: DataFrame, score: Callable[[int, str], float], ranks: dict[int, list[int]], sizes: dict[int, int]) -> dict[int, list[float]]:
    """Per kind the scores of the given ranks (from 1) among those of all its strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [score(k, v) for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["kind", "score"])

    scored = cut(aside.filter(F.col("kind").isin(list(ranks))).select("kind", "value").mapInArrow(run, "kind int, score double"), "secrets-scores")
    wanted = [(k, (r - 0.5) / sizes[k]) for k, of_kind in ranks.items() for r in of_kind]
    found = quantiles(scored, ["kind"], "score", [p for _, p in wanted], [f"q{i}" for i in range(len(wanted))])
    rows = {r["kind"]: r for r in found.collect()}
    return {k: [rows[k][f"q{i}"] for i, (kind, _) in enumerate(wanted) if kind == k] for k in ranks}


def fit(found: DataFrame, detail: int = DETAIL, false: float = FALSE, outer: float = OUTER) -> Scorer:
    """Learns from all distinct base spans and words of ``spans``."""
    every = strings(found)
    halves = {(r["kind"], r["learned"]): r["count"] for r in every.groupBy("kind", "learned").count().collect()}
    aside_of = {k: halves[k, False] for k in range(FORMAT + 1) if (k, False) in halves}  # of kinds of two strings at least
    if FORMAT not in aside_of or len(aside_of) == 1:
        return Scorer([], [])
    learned = every.filter(F.col("learned") & F.col("kind").isin(list(aside_of))).select("kind", "value")
    aside = every.filter(~F.col("learned"))
    built = trees(learned, {k: max(1, -(-halves[k, True] // detail)) for k in aside_of})
    machines = frequencies(learned, {k: Automaton([], tree=tree) for k, tree in built.items()})
    cut_off = {k: int(outer * n) for k, n in aside_of.items() if k != FORMAT}
    ranges = _at_ranks(aside, lambda k, v: log_likelihood(machines[k], v) / (len(v) + 1),
                       {k: [c + 1, aside_of[k] - c] for k, c in cut_off.items()}, aside_of)
    scorer = Scorer([(machines[k], *ranges[k]) for k in sorted(ranges)], machines[FORMAT])
    # scores below zero do not matter, and those of no format have no number
    rank = max(1, math.ceil((1 - false) * aside_of[FORMAT]))
    scorer.threshold = _at_ranks(aside, lambda _, v: max(0.0, scorer.score(v)), {FORMAT: [rank]}, aside_of)[FORMAT][0]
    return scorer


def _told(rows: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(rows))


def scan(docs: DataFrame, detail: int = DETAIL) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end of
    all spans by start, then kind, joined by commas) and n_format (the spans
    that the learned formats add) of every document."""
    found = cut(spans(docs), "secrets-found")
    scorer = fit(found, detail)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        for batch in column_batches(batches, ROWS):
            counts, digests, told = [], [], []
            for base, more in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = [(s["start"], s["kind"], s["end"]) for s in base]
                added = []
                for s in more:
                    value = s["value"]
                    if value not in known:
                        if len(known) >= REMEMBER:
                            known.clear()
                        known[value] = scorer.is_secret(value)
                    if known[value]:
                        added.append((s["start"], s["kind"], s["end"]))
                kinds = [s[1] for s in own]
                counts.append([kinds.count(0), kinds.count(1), kinds.count(2), len(added)])
                digests.append(hashlib.sha256(_told(own).encode()).hexdigest())
                told.append(_told(own + added))
            columns = np.array(counts, dtype=np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(np.ascontiguousarray(c)) for c in columns[:3]], pa.array(digests, pa.string()), pa.array(told, pa.string()),
                 pa.array(np.ascontiguousarray(columns[3]))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format"])

    return found.select("doc_id", "base", "candidates").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_format long")
