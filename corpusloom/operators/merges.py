"""Learning byte-pair merges at the size of a real vocabulary.

The word types lie in the shared folder as lists of symbol numbers and are split over tasks; the driver holds the
leading pairs with their exact counts, ``look`` of them and what grew out of them, never all. A round sends a batch of
merges to the tasks. Each task applies them in order to long arrays of symbols, many words at a time, and reports by
how much the counts of pairs change: those of the driver's pairs and of pairs with a new symbol. With the changes the
driver follows its counts.

``exact``: the batch is a guess, the leading pairs in their order, and changes are told per merge. The driver accepts
it up to the first merge that the followed counts do not confirm as the best one at its turn; the rest is dropped and
guessed anew. So the merges are those of a one-by-one loop, in a fraction of its rounds.

Otherwise a round is a rule of its own, the same for every layout of the data: of the ``look`` best pairs by
``(count desc, left, right)`` it takes those that cannot overlap one taken before, down to half the count of the
first pair passed over. Such merges are applied in one pass, and their changes are told together.

All pairs are counted anew only when the leading ones are used up, or when a merge spells a piece that exists.

In the line layout words are whole lines, which hardly ever repeat. Two bytes that stand side by side less often than
the merges in view do are never merged across, so lines are cut between them, and the parts, which repeat as words do,
are what is split over tasks. Pairs that are as frequent as that have their exact counts; where a round could come to
rarer ones, the lines are cut anew at a lower count.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.arrays import small_parts
from ..session import forget, shuffle_partitions, stage

#: Pairs that the driver follows after each full count.
LOOK = 4096
#: Merges that a guess holds at most.
BATCH = 512
#: Merges that tasks replay before the word types are written anew.
REPLAYED = 64
#: Distinct changes that a task adds up before it hands them on.
HELD = 500_000
#: Symbols that a task looks at together, roughly.
RUN = 1 << 18
#: Numbers of symbols are below ``1 << WIDTH``: code points or bytes, then merged pieces.
WIDTH = 21
FIRST_MERGED = 0x110000
Pair = tuple[str, str]
#: Left and right symbol and what they become.
Step = tuple[int, int, int]
#: ``syms``: symbol numbers as little-endian 32-bit integers; what is still bytes is named ``bytes``.
STATE = "syms binary, n bigint"
CHANGES = "step int, l int, r int, cnt bigint"


def symbols_of(word: str, pretok: str) -> list[str]:
    """Characters after a word mark, or with marks for spaces, or bytes in hex."""
    if pretok == "text":
        return list(word.replace(" ", fixed.WORD_MARK))
    return list(fixed.WORD_MARK + word) if pretok == "word" else [f"{b:02X}" for b in word.encode()]


def numbers_of(word: str, pretok: str) -> bytes:
    """The symbols of ``symbols_of`` by number."""
    if pretok == "line":
        return np.frombuffer(word.encode(), "u1").astype("<i4").tobytes()
    return (word.replace(" ", fixed.WORD_MARK) if pretok == "text" else fixed.WORD_MARK + word).encode("utf-32-le")


class _Pieces:
    """Strings of symbol numbers and numbers of strings; the driver's."""

    def __init__(self, pretok: str):
        self.pretok = pretok
        self.merged: list[str] = []
        self.number_of: dict[str, int] = {}

    def number(self, piece: str) -> int:
        if len(piece) == (2 if self.pretok == "line" else 1):
            return int(piece, 16) if self.pretok == "line" else ord(piece)
        if piece not in self.number_of:
            if FIRST_MERGED + len(self.merged) >= 1 << WIDTH:
                raise ValueError("too many merges")
            self.number_of[piece] = FIRST_MERGED + len(self.merged)
            self.merged.append(piece)
        return self.number_of[piece]

    def forget_from(self, n: int) -> None:
        """Only the first ``n`` merged pieces stay."""
        for piece in self.merged[n:]:
            del self.number_of[piece]
        del self.merged[n:]

    def steps(self, merges: Iterable[Pair]) -> list[Step]:
        return [(self.number(a), self.number(b), self.number(a + b)) for a, b in merges]

    def key(self, pair: Pair) -> int:
        return self.number(pair[0]) << WIDTH | self.number(pair[1])


def _spelling(pretok: str, merged: list[str]) -> Callable[[int], str]:
    def piece(number: int) -> str:
        if number >= FIRST_MERGED:
            return merged[number - FIRST_MERGED]
        return f"{number:02X}" if pretok == "line" else chr(number)

    return piece


def numbered(merges: Iterable[Pair], pretok: str) -> tuple[list[Step], Callable[[str], int]]:
    """Merges by numbers of their symbols, and the number of a symbol or merged piece."""
    pieces = _Pieces(pretok)
    return pieces.steps(merges), pieces.number


def word_types(counts: DataFrame, pretok: str) -> DataFrame:
    """``(syms, n)`` of every word type with a pair in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            syms = [numbers_of(w, pretok) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(syms, pa.binary()), batch.column(1)], names=["syms", "n"])

    spread = counts.select("word", F.col("n").cast("bigint")).repartition(shuffle_partitions(counts.sparkSession), "word")
    return spread.mapInArrow(run, STATE).filter(F.octet_length("syms") > 4)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts end to end, and where each text begins and the last one ends."""
    texts = column.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], "<i8", len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", "u1")
    return data[ends[0] : ends[-1]], ends - ends[0]


def weighed(numbers: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """The sum of ``n`` for each of the numbers below ``size``."""
    if len(n) * int(n.max(initial=0)) < 1 << 53:  # so far sums of doubles are exact
        return np.bincount(numbers, n, size).astype("i8")
    total = np.zeros(size, "i8")
    np.add.at(total, numbers, n)
    return total


def _side_by_side(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each byte the number of the pair that it begins, -1 where its text ends."""
    keys = np.full(len(data), -1, "i4")
    keys[:-1] = data[:-1].astype("i4") << 8 | data[1:]
    lasts = ends[1:][np.diff(ends) > 0] - 1
    keys[lasts] = -1
    return keys


def byte_pairs(counts: DataFrame) -> np.ndarray:
    """How often each two bytes stand side by side in the lines: 65,536 numbers, by the first byte, then the second."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, "i8")
        for batch in batches:
            n, at = np.asarray(batch.column(1)), 0
            for lines in small_parts(batch.column(0), 4 * RUN):
                data, ends = bytes_of(lines)
                keys = _side_by_side(data, ends)
                times = np.repeat(n[at : at + len(lines)], np.diff(ends))
                at += len(lines)
                total += weighed(keys[keys >= 0], times[keys >= 0], 1 << 16)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype("i4")), pa.array(total[some])], names=["pair", "n"])

    lines = counts.select("word", F.col("n").cast("bigint"))
    sums = lines.mapInArrow(run, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(1 << 16, "i8")
    for r in sums:
        total[r.pair] = r.n
    return total


def line_parts(counts: DataFrame, often: np.ndarray) -> DataFrame:
    """``(bytes, n)`` of the parts of lines that have a pair in them, cut between any two bytes that are not ``often``
    (a flag for each pair of ``byte_pairs``) side by side."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, at = np.asarray(batch.column(1)), 0
            for lines in small_parts(batch.column(0), 4 * RUN):
                data, ends = bytes_of(lines)
                keys = _side_by_side(data, ends)
                starts = np.flatnonzero(~(often[keys] & (keys >= 0))) + 1  # one past each part
                lengths = np.diff(starts, prepend=0)
                kept = lengths > 1
                bounds = np.concatenate([[0], starts]).astype("i4")
                parts = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
                coded = parts.filter(pa.array(kept)).dictionary_encode()
                of_line = np.searchsorted(ends, bounds[:-1][kept], "right") - 1
                times = n[at : at + len(lines)][of_line]
                at += len(lines)
                sums = weighed(np.asarray(coded.indices), times, len(coded.dictionary))
                yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(sums)], names=["bytes", "n"])

    lines = counts.select("word", F.col("n").cast("bigint"))
    parts = lines.mapInArrow(cut, "bytes binary, n bigint").groupBy("bytes").agg(F.sum("n").alias("n"))
    return parts.repartition(shuffle_partitions(counts.sparkSession), "bytes")


def _merge(symbols: list[str], pair: Pair) -> tuple[list[str], list[int], list[int]]:
    """The pair merged from left to right; where old pairs went, and where new ones came, by their first symbol."""
    left, right = pair
    out: list[str] = []
    gone: list[int] = []
    come: list[int] = []
    i, n = 0, len(symbols)
    while i < n:
        if symbols[i] == left and i + 1 < n and symbols[i + 1] == right:
            for at in (i - 1, i, i + 1):
                if 0 <= at < n - 1 and (not gone or at > gone[-1]):
                    gone.append(at)
            for at in (len(out) - 1, len(out)):
                if at >= 0 and (not come or at > come[-1]):
                    come.append(at)
            out.append(left + right)
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    if come and come[-1] == len(out) - 1:
        come.pop()
    return out, gone, come


def replay(
    symbols: list[str], steps: dict[Pair, list[int]], changed: Callable[[int, Pair, int], None] | None = None, first: int = 0
) -> list[str]:
    """Apply numbered merges in their order to one word; ``changed(step, pair, +1 or -1)`` hears of steps from ``first``
    on. What ``Words`` does to many words, said plainly: the tests hold one against the other."""
    at = -1
    while True:
        best, pair = None, None
        for each in zip(symbols, symbols[1:]):
            for step in steps.get(each, ()):
                if step > at:
                    if best is None or step < best:
                        best, pair = step, each
                    break
        if best is None:
            return symbols
        merged, gone, come = _merge(symbols, pair)
        if changed is not None and best >= first:
            for i in gone:
                changed(best, (symbols[i], symbols[i + 1]), -1)
            for i in come:
                changed(best, (merged[i], merged[i + 1]), 1)
        symbols, at = merged, best


def at_once(steps: list[Step]) -> list[list[Step]]:
    """Consecutive merges of which none touches a symbol that another needs or makes: one pass does each group."""
    out: list[list[Step]] = []
    lefts, rights, made, taken = set(), set(), set(), set()
    for l, r, product in steps:
        if not out or l in rights or r in lefts or l in made or r in made or (l, r) in taken:
            out.append([])
            lefts, rights, made, taken = set(), set(), set(), set()
        out[-1].append((l, r, product))
        lefts.add(l)
        rights.add(r)
        made.add(product)
        taken.add((l, r))
    return out


class Words:
    """Words laid end to end: ``syms`` with -1 after each word, and how often the word of each place occurs."""

    def __init__(self, syms: np.ndarray, lengths: np.ndarray, n: np.ndarray):
        ends = np.cumsum(lengths + 1) - 1
        self.syms = np.full(int(lengths.sum()) + len(lengths), -1, "i4")
        inside = np.ones(len(self.syms), bool)
        inside[ends] = False
        self.syms[inside] = syms
        self.n = np.repeat(n, lengths + 1)

    def pairs(self, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Keys and weights of the pairs that begin at these places, or at all."""
        if at is None:
            left, right, n = self.syms[:-1], self.syms[1:], self.n[:-1]
        else:
            at = at[(at >= 0) & (at < len(self.syms) - 1)]
            left, right, n = self.syms[at], self.syms[at + 1], self.n[at]
        both = (left >= 0) & (right >= 0)
        return left[both].astype("i8") << WIDTH | right[both], n[both]

    def _places(self, steps: list[Step]) -> tuple[np.ndarray, np.ndarray]:
        """Where the pairs of one group stand, and what they become."""
        if len(steps) == 1:
            l, r, product = steps[0]
            at = np.flatnonzero(self.syms[:-1] == l)
            at = at[self.syms[at + 1] == r]
            made = np.full(len(at), product, "i4")
        else:
            wanted = np.array(steps, "i8")
            starts = np.zeros(1 << WIDTH, bool)  # -1 falls on the last number, which no symbol has
            starts[wanted[:, 0]] = True
            ends = np.zeros(1 << WIDTH, bool)
            ends[wanted[:, 1]] = True
            at = np.flatnonzero(starts[self.syms[:-1]] & ends[self.syms[1:]])
            keys = self.syms[at].astype("i8") << WIDTH | (self.syms[at + 1] & ((1 << WIDTH) - 1))
            mine = wanted[:, 0] << WIDTH | wanted[:, 1]
            order = np.argsort(mine)
            mine = mine[order]
            place = np.minimum(np.searchsorted(mine, keys), len(mine) - 1)
            hit = mine[place] == keys
            at, made = at[hit], wanted[order[place[hit]], 2].astype("i4")
        if len(at) > 1 and (np.diff(at) == 1).any():
            # Only a pair of equal symbols can overlap itself: from left to right, every other one.
            run = at - np.arange(len(at))
            first = np.maximum.accumulate(np.where(np.diff(run, prepend=-1) != 0, np.arange(len(at)), 0))
            every = (np.arange(len(at)) - first) % 2 == 0
            at, made = at[every], made[every]
        return at, made

    def _marked(self, *places: np.ndarray) -> np.ndarray:
        """The places in order, each once; one before the first reads as one past the last."""
        marks = np.zeros(len(self.syms) + 1, bool)
        for at in places:
            marks[at] = True
        return np.flatnonzero(marks)

    def apply(self, steps: list[Step], told: bool = False) -> tuple[np.ndarray, np.ndarray] | None:
        """Do the merges of one group of ``at_once``; ``told`` gives keys and changes of the pairs that it touched."""
        at, made = self._places(steps)
        if not len(at):
            return None
        gone = self.pairs(self._marked(at - 1, at, at + 1)) if told else None
        keep = np.ones(len(self.syms), bool)
        keep[at + 1] = False
        self.syms[at] = made
        self.syms, self.n = self.syms[keep], self.n[keep]
        if not told:
            return None
        now = at - np.arange(len(at))
        come = self.pairs(self._marked(now - 1, now))
        return np.concatenate([gone[0], come[0]]), np.concatenate([-gone[1], come[1]])

    def rows(self) -> tuple[pa.Array, np.ndarray]:
        """The words that still hold a pair, as binary rows, and how often each occurs."""
        ends = np.flatnonzero(self.syms < 0)
        lengths = np.diff(ends, prepend=-1) - 1
        kept = lengths > 1
        inside = np.repeat(kept, lengths + 1) & (self.syms >= 0)
        offsets = np.concatenate([[0], np.cumsum(lengths[kept]) * 4]).astype("i4")
        data = pa.py_buffer(np.ascontiguousarray(self.syms[inside], "<i4").tobytes())
        rows = pa.Array.from_buffers(pa.binary(), int(kept.sum()), [None, pa.py_buffer(offsets.tobytes()), data])
        return rows, self.n[ends[kept]]


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """The words of a task, about ``RUN`` symbols at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(0)
        kind, width = ("u1", 1) if batch.schema.names[0] == "bytes" else ("<i4", 4)
        offsets = np.frombuffer(column.buffers()[1], "<i4", len(column) + 1, 4 * column.offset) // width
        data = np.frombuffer(column.buffers()[2], kind, int(offsets[-1]))
        n = np.asarray(batch.column(1))
        run = (offsets[:-1] - offsets[0]) // RUN
        cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(column)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield Words(data[offsets[a] : offsets[b]], np.diff(offsets[a : b + 1]), n[a:b])


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1) != 0)
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


class _Held:
    """Changes that a task adds up; keys hold the step above both symbols."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.limit = 0, 2 * HELD

    def add(self, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((keys, n))
        self.size += len(keys)
        if self.size > self.limit:
            self._sum()
            if self.size > HELD:
                yield from self.close()

    def _sum(self) -> None:
        if self.parts:
            self.parts = [_summed(*(np.concatenate(x) for x in zip(*self.parts)))]
            self.size = len(self.parts[0][0])

    def close(self) -> Iterator[pa.RecordBatch]:
        self._sum()
        for keys, n in self.parts:
            some = n != 0
            keys, n, low = keys[some], n[some], (1 << WIDTH) - 1
            columns = [keys >> 2 * WIDTH, keys >> WIDTH & low, keys & low]
            yield pa.RecordBatch.from_arrays([*(pa.array(c.astype("i4")) for c in columns), pa.array(n)], ["step", "l", "r", "cnt"])
        self.parts, self.size = [], 0


def _changes(state: DataFrame, replayed: list[Step], batch: list[Step], followed: np.ndarray, floor: int, each: bool) -> list:
    """What the batch does to the counts of pairs, per merge (``each``) or together (step 0): all that it takes from
    the ``followed`` pairs (sorted keys), and pairs with a new symbol that reach the floor or lose."""
    before = at_once(replayed)
    groups = [[s] for s in batch] if each else at_once(batch)
    fresh = np.unique(np.array([product for *_, product in batch], "i8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        new = np.zeros(1 << WIDTH, bool)
        new[fresh] = True
        low = (1 << WIDTH) - 1
        for words in _words(batches):
            for group in before:
                words.apply(group)
            for step, group in enumerate(groups):
                told = words.apply(group, told=True)
                if told is None:
                    continue
                keys, n = told
                wanted = new[keys >> WIDTH] | new[keys & low]
                if len(followed):
                    wanted |= followed[np.minimum(np.searchsorted(followed, keys), len(followed) - 1)] == keys
                keys, n = _summed(keys[wanted], n[wanted])
                yield from held.add(keys | (step if each else 0) << 2 * WIDTH, n)
        yield from held.close()

    sums = state.mapInArrow(run, CHANGES).groupBy("step", "l", "r").agg(F.sum("cnt").alias("cnt"))
    return sums.filter((F.col("cnt") < 0) | (F.col("cnt") >= floor) & (F.col("cnt") > 0)).collect()


def _rewritten(state: DataFrame, replayed: list[Step]) -> DataFrame:
    """The word types after these merges; words that are one symbol have no pair left and go."""
    groups = at_once(replayed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _words(batches):
            for group in groups:
                words.apply(group)
            syms, n = words.rows()
            yield pa.RecordBatch.from_arrays([syms, pa.array(n)], names=["syms", "n"])

    return state.mapInArrow(run, STATE)


def _leading(
    state: DataFrame, replayed: list[Step], pieces: _Pieces, least: int, longest: int, look: int, need: int = 1
) -> tuple[dict[Pair, int], int]:
    """The best pairs with their counts, ``need`` or all of them, and the count from which on none is missing."""
    groups = at_once(replayed)
    pretok, merged = pieces.pretok, list(pieces.merged)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for words in _words(batches):
            for group in groups:
                words.apply(group)
            yield from held.add(*_summed(*words.pairs()))
        yield from held.close()

    def spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = _spelling(pretok, merged)
        for batch in batches:
            left, right = ([piece(x) for x in batch.column(k).to_pylist()] for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.string()), pa.array(right, pa.string()), batch.column(2)], ["left", "right", "cnt"]
            )

    sums = state.mapInArrow(run, CHANGES).groupBy("l", "r").agg(F.sum("cnt").alias("cnt")).filter(F.col("cnt") >= least)
    named = sums.mapInArrow(spelt, "left string, right string, cnt bigint")
    counted = named.filter(F.length("left") + F.length("right") <= longest)
    best = counted.orderBy(F.col("cnt").desc(), "left", "right").limit(look + 1).collect()
    if len(best) <= look:
        return {(r.left, r.right): r.cnt for r in best}, least
    # Pairs as frequent as the first one left out may be missing.
    floor = best[-1].cnt + 1
    whole = {(r.left, r.right): r.cnt for r in best if r.cnt >= floor}
    return (whole, floor) if len(whole) >= need else _leading(state, replayed, pieces, least, longest, 4 * look, need)


def _in_order(pairs: dict[Pair, int], most: int) -> list[Pair]:
    return heapq.nsmallest(most, pairs, key=lambda p: (-pairs[p], *p))


def rule_of_a_round(ordered: list[Pair], count: dict[Pair, int], room: int) -> list[Pair]:
    """Pairs in order that cannot overlap one taken before, down to half the count of the first passed over.

    Two pairs overlap where the right symbol of one is the left symbol of the other; sharing a left or a right symbol
    is no conflict, as no occurrence of the one is touched by merging the other.
    """
    return _round(ordered, count, room)[0]


def _round(ordered: list[Pair], count: dict[Pair, int], room: int) -> tuple[list[Pair], int]:
    """The pairs of a round, and the count of the first one passed over (0: none was)."""
    taken: list[Pair] = []
    lefts: set[str] = set()
    rights: set[str] = set()
    passed = 0
    for pair in ordered:
        if len(taken) == room or 2 * count[pair] < passed:
            break
        if pair[0] not in rights and pair[1] not in lefts:
            taken.append(pair)
            lefts.add(pair[0])
            rights.add(pair[1])
        else:
            passed = passed or count[pair]
    return taken, passed


def learn_merges(
    counts: DataFrame, n_merges: int, pretok: str = "word", min_freq: int = fixed.MIN_PAIR_FREQ,
    max_piece: int = fixed.MAX_PIECE_CHARS, look: int = LOOK, exact: bool = True,
) -> list[Pair]:
    """At most ``n_merges`` merges in their order; fewer where no pair occurs ``min_freq`` times."""
    longest = max_piece * (2 if pretok == "line" else 1)
    beside = byte_pairs(counts) if pretok == "line" else None
    # Counts below are left out of the state: in the line layout a guess, lowered where it is too high.
    least = min_freq if beside is None else max(min_freq, int(np.sort(beside)[-min(n_merges, len(beside))]) // 2)
    state = stage(word_types(counts, pretok) if beside is None else line_parts(counts, beside >= least))
    pieces = _Pieces(pretok)
    merges: list[Pair] = []
    spelt: set[str] = set()
    replayed: list[Step] = []
    pairs: dict[Pair, int] = {}
    floor, size, counted = 0, 16, False
    while len(merges) < n_merges:
        room = n_merges - len(merges)
        while True:
            # In the guess a pair may be below the floor only if nothing was left out.
            ahead = {p: c for p, c in pairs.items() if c >= max(floor, min_freq)}
            if exact:
                batch = _in_order(ahead, min(size, room))
                sure = bool(batch)
            else:
                ordered = _in_order(ahead, look)
                batch, passed = _round(ordered, ahead, room)
                # Pairs that are not known come after those that are: would the round go on to them?
                sure = len(batch) == room or len(ordered) == look or 2 * (floor - 1) < passed
            if counted and (sure or floor <= min_freq):
                break
            if counted and floor == least:
                least = max(min_freq, least // 4)
                old, state = state, stage(_rewritten(line_parts(counts, beside >= least), pieces.steps(merges)))
                forget(old)
                replayed = []
            pairs, floor = _leading(state, replayed, pieces, least, longest, look if exact else 2 * look, 1 if exact else look)
            counted = True
        if not batch:
            break
        known = len(pieces.merged)
        steps = pieces.steps(batch)
        followed = np.sort(np.fromiter(map(pieces.key, pairs), "i8", len(pairs)))
        spelling = _spelling(pretok, pieces.merged)
        by_step: list[list[tuple[Pair, int]]] = [[] for _ in batch]
        for r in _changes(state, replayed, steps, followed, floor, exact):
            # Changes told together count after the last merge of the round.
            by_step[r.step if exact else -1].append(((spelling(r.l), spelling(r.r)), r.cnt))
        done, recount = 0, False
        follow = [(-c, *p) for p, c in ahead.items()]
        heapq.heapify(follow)
        for pair, changes in zip(batch, by_step):
            if exact:
                while follow and pairs.get((follow[0][1], follow[0][2])) != -follow[0][0]:
                    heapq.heappop(follow)  # an outdated count
                if not follow or (follow[0][1], follow[0][2]) != pair or -follow[0][0] < floor:
                    break
            done += 1
            product = pair[0] + pair[1]
            recount = recount or product in spelt
            spelt.add(product)
            for key, cnt in changes:
                if key in pairs:
                    pairs[key] += cnt
                elif cnt >= floor and len(key[0]) + len(key[1]) <= longest:
                    pairs[key] = cnt
                else:
                    continue
                if pairs[key] >= floor:
                    heapq.heappush(follow, (-pairs[key], *key))
                else:
                    del pairs[key]
            if recount and exact:
                break
        merges += batch[:done]
        replayed = replayed + steps[:done]
        # Pieces of merges that were not accepted get their numbers anew.
        pieces.forget_from(max([known, *(product - FIRST_MERGED + 1 for *_, product in steps[:done])]))
        size = max(16, min(BATCH, 2 * done))
        if recount:
            pairs, floor, counted = {}, 0, False
        if len(replayed) >= REPLAYED:
            old, state = state, stage(_rewritten(state, replayed))
            forget(old)
            replayed = []
    forget(state)
    return merges
