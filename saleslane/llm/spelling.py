"""Spelling variant grouping: words one edit apart, found by composing finite-state acceptors.

The words are those of at least ``min_length`` code points that occur ``min_count`` times in the
corpus.  Two words are near if they differ by exactly one inserted, deleted or replaced code point.
Near pairs are the accepted pairs of A o E o A: the minimised acceptor A of the vocabulary, a
transducer E that copies, edits once and copies on, and the acceptor again.

The composition is enumerated in partitions by initial state.  Let m be the length of the shorter
word of a pair and x its first half.  Either the edit comes after x, so both words lead to the same
state of the acceptor after x; or it comes inside, so both lead to the same state of the acceptor of
the reversed words after the other half.  A word is thus dealt to two initial states for each of
the two lengths that the shorter word of a pair can have, and each pair is accepted in one of
them.  Inside a partition the acceptors of the words of length m and m + 1 are minimised together
(states with equal continuations are one), pairs of states are composed once, and what follows an
edit is the intersection of two states.

An initial state that more than ``STATE_WORDS`` words share is not enumerated: its words move on to
the two states that halve the part of the word in which the edit can be.  Where that part is one
code point, a state holds few words, so this ends, and no pair is lost or capped.

Words are counted per task and text before they are shuffled; a word of a third of all occurrences
is one row per task.

Cases: a null text has no words, a null doc_id is an empty string before the colon.  Texts are walked
match by match whatever their length.  Repeated rows count again.  Of near words with equal counts
the first in code-point order is the form.  Extra columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslane.llm.blocks import in_parts
from saleslane.plans.durable import durable

RUN = "[A-Za-zÀ-ÿ]+"
#: One run in so many, by its hash, loses a code point.
NOISE = 97
#: Distinct words that a task counts before it passes them on.
COUNTED = 200_000
#: Words of one initial state that are composed in one task.
STATE_WORDS = 20_000
#: Rows that a task passes on at once, however many pairs a state has.
BATCH_ROWS = 8192
_FINAL = 0
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def noisy(doc: str, run: str, noise: int = NOISE) -> str:
    """The run, without one code point if the noise divides the hash of document and run."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    if h % noise:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def words(docs: DataFrame, min_length: int = 5, min_count: int = 3, noise: int = NOISE) -> DataFrame:
    """(word, n) of all words of the corpus, with their occurrences."""
    run, group = re.compile(RUN), re.Match.group

    def flush(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in in_parts(batches):
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
                runs: Counter = Counter()
                for found, n in Counter(map(group, run.finditer(text))).items():
                    runs[found if found.islower() and found.isascii() else found.translate(_LOWER)] += n
                for found, n in runs.items():
                    word = noisy(doc, found, noise)
                    if len(word) >= min_length:
                        counts[word] += n
                if len(counts) >= COUNTED:
                    yield flush(counts)
                    counts = Counter()
        yield flush(counts)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    found = rows.mapInArrow(counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


class _Composition:
    """The near pairs among words that share an initial state, by their parts ``short`` and ``long``.

    ``short`` and ``long`` are sorted and without repetition; their members have one length each,
    ``long``'s one code point more.
    """

    def __init__(self) -> None:
        self.register: dict[tuple, int] = {}
        self.arcs: list[tuple[tuple[str, int], ...]] = [()]
        self.spelled: dict[int, list[str]] = {_FINAL: [""]}
        self.met: dict[tuple[int, int], list[str]] = {}
        self.replaced: dict[int, list[tuple[str, str]]] = {_FINAL: []}
        self.inserted: dict[tuple[int, int], list[tuple[str, str]]] = {}

    def minimised(self, parts: list[str], low: int, high: int, depth: int) -> int:
        """The state that accepts what follows the first ``depth`` code points of parts[low:high]."""
        if depth == len(parts[low]):
            return _FINAL
        arcs, at = [], low
        while at < high:
            symbol, end = parts[at][depth], at + 1
            while end < high and parts[end][depth] == symbol:
                end += 1
            arcs.append((symbol, self.minimised(parts, at, end, depth + 1)))
            at = end
        key = tuple(arcs)
        state = self.register.get(key)
        if state is None:
            state = self.register[key] = len(self.arcs)
            self.arcs.append(key)
        return state

    def language(self, state: int) -> list[str]:
        known = self.spelled.get(state)
        if known is None:
            known = self.spelled[state] = [a + z for a, s in self.arcs[state] for z in self.language(s)]
        return known

    def both(self, p: int, q: int) -> list[str]:
        """What two states both accept: the copying part after the edit."""
        if p == q:
            return self.language(p)
        known = self.met.get((p, q))
        if known is None:
            after = dict(self.arcs[q])
            known = [a + z for a, s in self.arcs[p] if a in after for z in self.both(s, after[a])]
            self.met[(p, q)] = known
        return known

    def replacements(self, p: int) -> list[tuple[str, str]]:
        """Accepted pairs of one state with itself that differ in one replaced code point."""
        known = self.replaced.get(p)
        if known is None:
            arcs, known = self.arcs[p], []
            for i, (a, s) in enumerate(arcs):
                known += [(a + u, a + v) for u, v in self.replacements(s)]
                for b, t in arcs[i + 1 :]:
                    known += [(a + z, b + z) for z in self.both(s, t)]
            self.replaced[p] = known
        return known

    def insertions(self, p: int, q: int) -> list[tuple[str, str]]:
        """Accepted pairs of which the second has one more code point, the last of a run of equal ones."""
        known = self.inserted.get((p, q))
        if known is None:
            before, known = dict(self.arcs[p]), []
            for b, t in self.arcs[q]:
                known += [(z, b + z) for z in self.both(p, t) if not z.startswith(b)]
                if b in before:
                    known += [(b + u, b + v) for u, v in self.insertions(before[b], t)]
            self.inserted[(p, q)] = known
        return known


def near_parts(short: list[str], long: list[str]) -> list[tuple[str, str]]:
    """Near pairs inside ``short``, and of one of ``short`` with one of ``long``."""
    made = _Composition()
    first = made.minimised(short, 0, len(short), 0)
    pairs = list(made.replacements(first))
    if long:
        pairs += made.insertions(first, made.minimised(long, 0, len(long), 0))
    return pairs


def _halves(m: int, head: int, tail: int) -> list[tuple[int, int]]:
    """Known code points (first, last) of the two states that halve the free part of a state."""
    free = m - head - tail
    more = (free + 1) // 2
    return [(head + more, tail), (head, tail + free - more)]


#: A row: a word with its count, dealt to the state of its first ``head`` and last ``tail`` code points
#: among words of length m and m + 1.
_DEALT = "m int, head int, tail int, first string, last string, word string, n long"


def _deal(words: DataFrame, min_length: int) -> DataFrame:
    """Each word at its initial states, two for each length of a pair's shorter word."""
    length = F.length("word")
    sizes = F.array_distinct(F.filter(F.array(length, length - 1), lambda m: m >= min_length))
    rows = words.select("word", "n", F.explode(sizes).alias("m"))
    half = F.ceil(F.col("m") / 2).cast("int")
    zero = F.lit(0)
    ends = F.array(F.struct(half.alias("head"), zero.alias("tail")), F.struct(zero.alias("head"), (F.col("m") - half).alias("tail")))
    return _placed(rows.select("word", "n", "m", F.inline(ends)))


def _placed(rows: DataFrame) -> DataFrame:
    first = F.substring("word", F.lit(1), F.col("head"))
    last = F.substring("word", F.length("word") - F.col("tail") + 1, F.col("tail"))
    return rows.select("m", "head", "tail", first.alias("first"), last.alias("last"), "word", "n")


def _enumerated(state_words: int):
    """Pairs (a, a_n, b, b_n) of each whole state; words of a state too large come back with their state."""
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    names = ["a", "a_n", "b", "b_n", "m", "head", "tail"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def pairs(state: tuple, held: dict[str, int]) -> Iterator[tuple]:
        if len(held) < 2:
            return
        m, head, tail = state[:3]
        short = sorted(w for w in held if len(w) == m)
        long = sorted(w for w in held if len(w) > m)
        if not short:
            return
        cut = slice(head, -tail or None)
        first, last = short[0][:head], short[0][m - tail :]
        found = near_parts([w[cut] for w in short], [w[cut] for w in long])
        half = (m + 1) // 2
        for u, v in found:
            a, b = first + u + last, first + v + last
            # A pair that agrees in the first half belongs to the state of that half, and so on down.
            if _home(m, a, b, half, head, tail):
                yield a, held[a], b, held[b], None, None, None

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        state, held, large = None, {}, False
        columns = ("m", "head", "tail", "first", "last", "word", "n")
        for batch in batches:
            for *now, word, n in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if now != state:
                    yield from pairs(state, held)
                    state, held, large = now, {}, False
                held[word] = n
                if len(held) > state_words and now[0] - now[1] - now[2] > 1:
                    large = True
                if large:
                    for w, k in held.items():
                        yield w, k, None, None, *now[:3]
                    held = {}
        yield from pairs(state, held)

    def enumerated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for row in rows_of(batches):
            out.append(row)
            if len(out) == BATCH_ROWS:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    return enumerated


def _home(m: int, a: str, b: str, half: int, head: int, tail: int) -> bool:
    """Whether the pair is enumerated at the state (head, tail) and at no other of its states."""
    at = (half, 0) if a[:half] == b[:half] else (0, m - half)
    while at != (head, tail):
        if at[0] + at[1] > head + tail or m - sum(at) <= 1:
            return False
        left, right = _halves(m, *at)
        at = left if a[: left[0]] == b[: left[0]] else right
    return True


def near_pairs(words: DataFrame, min_length: int = 5, state_words: int = STATE_WORDS) -> DataFrame:
    """(a, a_n, b, b_n): every two near words once, a the shorter one."""
    schema = "a string, a_n long, b string, b_n long, m int, head int, tail int"
    by = ["m", "head", "tail", "first", "last"]
    dealt, found = _deal(words, min_length), None
    while True:
        rows = durable(dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(_enumerated(state_words), schema))
        pairs = rows.filter("b is not null").select("a", "a_n", "b", "b_n")
        found = pairs if found is None else found.union(pairs)
        large = rows.filter("b is null")
        if large.isEmpty():
            return found
        more = F.ceil((F.col("m") - F.col("head") - F.col("tail")) / 2).cast("int")
        left = F.struct((F.col("head") + more).alias("head"), F.col("tail").alias("tail"))
        right = F.struct(F.col("head").alias("head"), (F.col("m") - F.col("head") - more).alias("tail"))
        dealt = _placed(large.select(F.col("a").alias("word"), F.col("a_n").alias("n"), "m", F.inline(F.array(left, right))))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms of each word lead; steps double, so rounds grow with a logarithm."""
    state = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        on = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = durable(state.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        state = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return state


def group(docs: DataFrame, min_length: int = 5, min_count: int = 3, ratio: int = 2, noise: int = NOISE, state_words: int = STATE_WORDS) -> DataFrame:
    """Per word: word, n, n_near, form, form_n and root.

    The form is the near word of largest count, if that is ``ratio`` times the word's or more.
    """
    known = durable(words(docs, min_length, min_count, noise))
    pairs = near_pairs(known, min_length, state_words)
    ways = pairs.union(pairs.select("b", "b_n", "a", "a_n"))
    best = F.min(F.struct((-F.col("b_n")).alias("least"), F.col("b").alias("form"))).alias("best")
    near = ways.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best)
    counted = durable(known.join(near, "word", "left"))
    best_n = -F.col("best.least")
    wins = best_n >= ratio * F.col("n")
    judged = counted.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(wins, F.col("best.form")).alias("form"), F.when(wins, best_n).alias("form_n"),
    )
    roots = _roots(judged.filter("form is not null"))
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
