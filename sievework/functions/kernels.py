"""Work within one document's text that has to know places in it, over Arrow batches.

Spark's regular expressions tell matches but not where they are, and its substrings walk
a text from the start each time. These kernels read each text once, in the row it is in,
and hand on what was found: no text is shuffled or joined back. Patterns are Python's;
offsets are code points from 0.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .patterns import literal, width

#: Characters of what was found that a task holds before it hands them on.
HELD = 4_000_000
#: What ends a line, as in the functions over columns.
LINE_END = re.compile("\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\u2028\u2029]")

Prepare = Callable[[str], str] | None


def _types(rows: DataFrame, keys: list[str], more: str) -> str:
    return ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema], more])


def each(column: pa.Array) -> Iterator[str | None]:
    """The values of a column, one at a time: a batch of texts is in memory once, as Arrow has it."""
    return (x.as_py() for x in column)


class Lines:
    """The lines of a text, found when first asked for."""

    def __init__(self, text: str):
        self.text, self.begins, self.ends = text, None, None

    def _cut(self) -> None:
        if self.begins is None:
            breaks = [m.span() for m in LINE_END.finditer(self.text)]
            self.begins, self.ends = [0, *[b for _, b in breaks]], [*[a for a, _ in breaks], len(self.text)]

    def all(self) -> list[str]:
        """Lines in order; a break at the end makes no further line."""
        self._cut()
        out = [self.text[a:b] for a, b in zip(self.begins, self.ends, strict=True)]
        return out[:-1] if len(out) > 1 and not out[-1] else out

    def first_with(self, target: str) -> str:
        """The first line that holds target, stripped; empty where none does."""
        at = self.text.find(target)
        if at < 0 or LINE_END.search(target):
            return ""
        return self.line_at(at)

    def span_at(self, at: int) -> tuple[int, int]:
        self._cut()
        k = bisect_right(self.begins, at) - 1
        return self.begins[k], self.ends[k]

    def line_at(self, at: int) -> str:
        begin, end = self.span_at(at)
        return self.text[begin:end].strip()

    def firsts(self, targets: list[str]) -> list[str]:
        """first_with of each target; the text is read once where that is less work than a search for each."""
        if len(targets) * len(self.text) < SEARCHED:
            return [self.first_with(t) for t in targets]
        places = first_places(self.text, targets)
        return ["" if places[t] is None or LINE_END.search(t) else self.line_at(places[t]) for t in targets]


#: Characters that are searched again and again at most before an automaton is made.
SEARCHED = 2_000_000


def first_places(text: str, targets: list[str]) -> dict[str, int | None]:
    """Where each target first stands in a text, None where it doesn't: one scan by an automaton of all targets."""
    places: dict[str, int | None] = dict.fromkeys(targets)
    machine = ahocorasick.Automaton()
    for t in places:
        if t:
            machine.add_word(t, t)
        else:
            places[t] = 0
    if len(machine):
        machine.make_automaton()
        for end, t in machine.iter(text):
            if places[t] is None:
                places[t] = end - len(t) + 1
    return places


def lowered(text: str) -> str:
    """Lower case, character by character: letters whose lower case is longer stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def around(text: str, start: int, end: int, reach: int) -> str:
    return text[max(0, start - reach) : end + reach]


def matches(rows: DataFrame, keys: list[str], text: str, pattern: str, reach: int | None = None) -> DataFrame:
    """keys of rows, once for each match of pattern: no (from 0), match, start, and with `reach` its context."""
    finder = re.compile(pattern)
    names = [*keys, "no", "match", "start", *(["context"] if reach is not None else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, no, match, start, context, held = [], [], [], [], [], 0

            def made() -> pa.RecordBatch:
                take = pa.array(row, pa.int32())
                own = [pa.array(no, pa.int32()), pa.array(match, pa.string()), pa.array(start, pa.int64()), *([pa.array(context, pa.string())] if reach is not None else [])]
                return pa.RecordBatch.from_arrays([*[batch.column(i).take(take) for i in range(len(keys))], *own], names=names)

            for i, value in enumerate(each(batch.column(len(keys)))):
                for k, m in enumerate(finder.finditer(value or "")):
                    row.append(i)
                    no.append(k)
                    match.append(m[0])
                    start.append(m.start())
                    held += 16 + m.end() - m.start()
                    if reach is not None:
                        context.append(around(value, m.start(), m.end(), reach))
                        held += len(context[-1])
                    if held > HELD:
                        yield made()
                        row, no, match, start, context, held = [], [], [], [], [], 0
            yield made()

    more = "no int, match string, start long" + (", context string" if reach is not None else "")
    return rows.select(*keys, text).mapInArrow(run, _types(rows, keys, more))


#: Characters of rewritten texts that leave a task together.
PIECE = 1_000_000


def rewritten(rows: DataFrame, keys: list[str], text: str, change: Callable[[str], str]) -> DataFrame:
    """keys and text of rows, the text changed (null stays null).

    Texts leave a task some at a time, so of a batch it holds no more than Spark sent.
    """
    names = [*keys, text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new, size = [], 0
            for i, value in enumerate(each(batch.column(len(keys)))):
                new.append(None if value is None else change(value))
                size += len(value or "")
                if size > PIECE or i + 1 == len(batch):
                    own = [batch.column(k).slice(i + 1 - len(new), len(new)) for k in range(len(keys))]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(new, pa.string())], names=names)
                    new, size = [], 0

    return rows.select(*keys, text).mapInArrow(run, _types(rows, keys, f"`{text}` string"))


class Near:
    """Whether some words stand shortly before or after a sequence in a context, in either case."""

    def __init__(self, before: str, after: str):
        self.before, self.after = re.compile(rf"(?i)\b(?:{before})\W{{0,20}}\Z"), re.compile(rf"(?i)\W{{0,30}}(?:{after})\b")
        self.word = re.compile(r"\w")
        #: characters before a sequence that may count: all of them where the words have no longest form
        self.reach = None if width(before) is None else width(before) + 20

    def of(self, context: str, sequence: str, low: str | None = None) -> tuple[bool, bool]:
        low, target, ahead, behind = low or lowered(context), sequence.lower(), False, False
        i = low.find(target)
        while i >= 0 and not (ahead and behind):
            end = i + len(target)
            if not ahead and not self.word.match(context, end):
                ahead = self.before.search(context, 0 if self.reach is None else max(0, i - self.reach), i) is not None
            if not behind and not (i and self.word.match(context, i - 1)):
                behind = self.after.match(context, end) is not None
            i = low.find(target, i + 1)
        return ahead, behind


_PLACE = pa.struct([("no", pa.int32()), ("start", pa.int64()), ("match", pa.string()), ("context", pa.string()), ("line", pa.string()), ("ahead", pa.bool_()), ("behind", pa.bool_())])


def sequences(rows: DataFrame, keys: list[str], text: str, pattern: str, normal: Callable[[str], str], keep: str, reach: int = 1000, lines: bool = False, near: tuple[str, str] | None = None, prepare: Prepare = None, first: bool = False) -> DataFrame:
    """keys of rows, once for each normalised match that is wholly of the form `keep`: sequence, occurrences, places.

    occurrences counts all matches of the text that are normalised alike. places are in
    order, each with its match, its surroundings and, with `lines`, the first line that
    holds the match; with `near`, whether words of the first pattern stand up to 20
    characters before the sequence, or of the second up to 30 after it, anywhere in the
    surroundings. A place whose surroundings equal an earlier one's adds nothing and is
    left out. prepare rewrites a text before it is searched. first: the first place alone.
    A row holds all places of a sequence in its text: where surroundings are wide and
    texts long, take the first places, or those that `accepted` accepts.
    """
    finder, whole, close = re.compile(pattern), re.compile(keep), Near(*near) if near else None
    names = [*keys, "sequence", "occurrences", "places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, sequence, times, size, flat, held = [], [], [], [0], [[] for _ in _PLACE], 0

            def made() -> pa.RecordBatch:
                struct = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(flat, _PLACE, strict=True)], fields=list(_PLACE))
                take = pa.array(row, pa.int32())
                places = pa.ListArray.from_arrays(pa.array(size, pa.int32()), struct)
                return pa.RecordBatch.from_arrays([*[batch.column(i).take(take) for i in range(len(keys))], pa.array(sequence, pa.string()), pa.array(times, pa.int64()), places], names=names)

            for i, value in enumerate(each(batch.column(len(keys)))):
                value = prepare(value) if prepare and value else value or ""
                own, known = Lines(value), {}
                found: dict[str, list] = {}
                for k, m in enumerate(finder.finditer(value)):
                    name = known.get(m[0])
                    if name is None:
                        name = known[m[0]] = normal(m[0])
                    at = found.get(name)
                    if at is None:
                        found[name] = [1, [(k, m)] if whole.fullmatch(name) else None]
                    else:
                        at[0] += 1
                        if at[1] is not None and not first:
                            at[1].append((k, m))
                for name, (n, places) in found.items():
                    if places is None:
                        continue
                    seen: set[int] = set()
                    for k, m in places:
                        context = around(value, m.start(), m.end(), reach)
                        if len(places) > 1:
                            mark = hash(context)
                            if mark in seen:
                                continue
                            seen.add(mark)
                        for column, v in zip(flat, (k, m.start(), m[0], context, own.first_with(m[0]) if lines else None, *(close.of(context, name) if close else (None, None))), strict=True):
                            column.append(v)
                        held += len(context) + 64
                    row.append(i)
                    sequence.append(name)
                    times.append(n)
                    size.append(len(flat[0]))
                    if held > HELD:
                        yield made()
                        row, sequence, times, size, flat, held = [], [], [], [0], [[] for _ in _PLACE], 0
            yield made()

    places = "array<struct<no:int,start:bigint,match:string,context:string,line:string,ahead:boolean,behind:boolean>>"
    return rows.select(*keys, text).mapInArrow(run, _types(rows, keys, f"sequence string, occurrences long, places {places}"))


# ------------------------------------------------------------------ judging places


#: A gap between two cells of a line, with the characters on its sides.
_CELL_GAP = re.compile(r"(?<=[^ \t\n\x0b\x0c\r\x1c-\x1e\x85\u2028\u2029])(?:\t[ \t]*|[ \t]{2,})(?=[^ \t\n\x0b\x0c\r\x1c-\x1e\x85\u2028\u2029])")


def _everywhere(text: str, word: str) -> np.ndarray:
    out, at = [], text.find(word)
    while at >= 0:
        out.append(at)
        at = text.find(word, at + 1)
    return np.array(out, np.int64)


class Judge:
    """How much the words around a place speak for a sequence there.

    peptide, table: words that count 3 and 5 where they stand in the surroundings, of
    which the latter, or two cells in a line, tell a table (8). genes, peptides: words of
    which some of the first and none of the second speak against any sequence. near:
    words before and after a sequence (6 each). Where the words of a text stand is found
    once, and what lies around each place is looked up among these.
    """

    def __init__(self, peptide: list[str], table: list[str], near: tuple[str, str], genes: list[str], peptides: list[str], gene_name: str, source: int):
        self.peptide, self.table, self.genes, self.peptides = peptide, table, genes, peptides
        self.close, self.gene_name, self.source = Near(*near), re.compile(gene_name), source
        self.words = sorted({*peptide, *table, *genes, *peptides})

    def in_table(self, low: str) -> tuple[int, bool]:
        """(points, about genes) of a whole text in lower case that is known to be a table's."""
        here = {w for w in self.words if w in low}
        points = 8 + 3 * sum(w in here for w in self.peptide) + 5 * sum(w in here for w in self.table)
        return points, not here.isdisjoint(self.genes) and here.isdisjoint(self.peptides)

    def around(self, text: str, low: str, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(points, about genes) of the stretches of a text, and of it in lower case, between begin and end."""
        hits, none = {}, np.zeros(len(begin), bool)
        for w in self.words:
            if w in low:
                hits[w] = self._within(at := _everywhere(low, w), at + len(w), begin, end)
        any_of = lambda words: np.logical_or.reduce([none, *[hits[w] for w in words if w in hits]])
        gaps = [m.span() for m in _CELL_GAP.finditer(text)] if "\t" in text or "  " in text else []
        rows = self._within(np.array([a - 1 for a, _ in gaps], np.int64), np.array([b + 1 for _, b in gaps], np.int64), begin, end)
        points = 8 * (any_of(self.table) | rows)
        for weight, words in ((3, self.peptide), (5, self.table)):
            for w in words:
                if w in hits:
                    points = points + weight * hits[w]
        return points, any_of(self.genes) & ~any_of(self.peptides)

    @staticmethod
    def _within(first: np.ndarray, last: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether any of the spans, which are in order, lies in each stretch."""
        if not len(first):
            return np.zeros(len(begin), bool)
        k = np.searchsorted(first, begin)
        return (k < len(first)) & (last[np.minimum(k, len(first) - 1)] <= end)

    def of_sequence(self, name: str, occurrences: int) -> int:
        """Points that hang on a sequence and its source alone."""
        letters = len(set(name))
        rich = 4 if len(name) >= 20 and letters >= 10 else 2 if len(name) >= 15 and letters >= 8 else 0
        return self.source + 2 * min(max(occurrences - 1, 0), 5) + rich


class Held:
    """Rows of what was found, until there is enough of them for a batch."""

    def __init__(self, types: dict[str, pa.DataType]):
        self.types, self.size = types, 0
        self.rows: list[int] = []
        self.columns: list[list] = [[] for _ in types]

    def add(self, row: int, *values, size: int) -> None:
        self.rows.append(row)
        for column, v in zip(self.columns, values, strict=True):
            column.append(v)
        self.size += size

    def batch(self, keys: list[pa.Array], names: list[str]) -> pa.RecordBatch:
        take = pa.array(self.rows, pa.int32())
        own = [pa.array(c, t) for c, t in zip(self.columns, self.types.values(), strict=True)]
        self.__init__(self.types)
        return pa.RecordBatch.from_arrays([*[k.take(take) for k in keys], *own], names=[*names, *self.types])


_PAIRS = pa.list_(pa.struct([("technique", pa.string()), ("line", pa.string())]))
_ACCEPTED = {"sequence": pa.string(), "start": pa.int64(), "match": pa.string(), "context": pa.string(), "sequence_line": pa.string(), "occurrences": pa.int64(), "score": pa.int32(), "pairs": _PAIRS}
_ACCEPTED_TYPES = "sequence string, start long, match string, context string, sequence_line string, occurrences long, score int, pairs array<struct<technique:string,line:string>>"

Listed = tuple[tuple[tuple[str, tuple[str, ...]], ...], ...]


def listed(*tables: dict[str, list[str]]) -> Listed:
    """Tables of names and their patterns in a form that can be remembered by."""
    return tuple(tuple((n, tuple(own)) for n, own in t.items()) for t in tables)


def accepted(rows: DataFrame, keys: list[str], text: str, pattern: str, normal: Callable[[str], str], keep: str, judge: Judge, least: int | None, evidence: Listed | None = None, reach: int = 1000, prepare: Prepare = None, never: str | None = None) -> DataFrame:
    """keys of rows, once for each normalised match of the form `keep`: its first place with `least` points or more that is not about genes.

    Nothing but the accepted place leaves the worker: sequence, start, match, context,
    sequence_line (the first line that holds the match), occurrences, score, and pairs
    (techniques of `evidence` in the context, each with its sentence). Without least each
    sequence's first place is taken as it is. A text's words and sentences are found once,
    so the work is linear in its length and its matches. never: what no match has that is
    normalised to the form `keep`, to pass over others by.
    """
    finder, whole, without = re.compile(pattern), re.compile(keep), re.compile(never) if never else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, model = Held(_ACCEPTED), _remembered(*evidence) if evidence else None
        for batch in batches:
            for i, value in enumerate(each(batch.column(len(keys)))):
                value = prepare(value) if prepare and value else value or ""
                known: dict[str, list] = {}  # match: what its name has in found
                found: dict[str, list] = {}  # name: times, numbers of its places
                starts, ends = [], []
                for m in finder.finditer(value):
                    match = m[0]
                    if without and without.search(match):
                        continue
                    at = known.get(match)
                    if at is None:
                        name = normal(match)
                        at = found.get(name)
                        if at is None:
                            at = found[name] = [0, [] if whole.fullmatch(name) else None]
                        known[match] = at
                    at[0] += 1
                    if at[1] is not None and (least is not None or not at[1]):
                        at[1].append(len(starts))
                        starts.append(m.start())
                        ends.append(m.end())
                if not starts:
                    continue
                begin, end = np.maximum(np.array(starts, np.int64) - reach, 0), np.minimum(np.array(ends, np.int64) + reach, len(value))
                low = lowered(value)
                points, genes = judge.around(value, low, begin, end)
                points, genes, begin, end = points.tolist(), genes.tolist(), begin.tolist(), end.tolist()
                chosen = []
                for name, (times, places) in found.items():
                    if places is None or least is not None and judge.gene_name.match(name):
                        continue
                    own = judge.of_sequence(name, times)
                    for k in places:
                        if least is not None and (genes[k] or points[k] + own + 12 < least):
                            continue
                        near = judge.close.of(value[begin[k] : end[k]], name, low[begin[k] : end[k]])
                        score = max(points[k] + own + 6 * sum(near), 0)
                        if least is None or score >= least:
                            chosen.append((name, k, times, score))
                            break
                lines = Lines(value).firsts([value[starts[k] : ends[k]] for _, k, _, _ in chosen])
                told = Stretches(model, value) if model else None
                for (name, k, times, score), line in zip(chosen, lines, strict=True):
                    context = value[begin[k] : end[k]]
                    pairs = told.pairs(begin[k], end[k]) if told else None
                    size = 2 * len(context) + len(line) + sum(len(x) for _, x in pairs or ())
                    held.add(i, name, starts[k], value[starts[k] : ends[k]], context, line, times, score, pairs, size=size)
                    if held.size > HELD:
                        yield held.batch(batch.columns[: len(keys)], keys)
            yield held.batch(batch.columns[: len(keys)], keys)

    return rows.select(*keys, text).mapInArrow(run, _types(rows, keys, _ACCEPTED_TYPES))


_WIDE = re.compile(r"\t|\s{2,}")


def cells(line: str) -> list[str]:
    """Cells between tabs or wide gaps; words where there is one cell or none."""
    wide = [c for c in (c.strip() for c in _WIDE.split(line)) if c]
    return wide if len(wide) >= 2 else line.split()


class Remembered:
    """A function of texts whose values are kept, up to so many characters of text."""

    def __init__(self, of: Callable[[str], list], most: int = 4_000_000):
        self.of, self.most, self.size, self.known = of, most, 0, {}

    def __call__(self, text: str) -> list:
        value = self.known.get(text)
        if value is None:
            value = self.of(text)
            if self.size > self.most:
                self.known.clear()
                self.size = 0
            self.known[text] = value
            self.size += len(text) + 64
        return value


_IN_TABLE = {k: v for k, v in _ACCEPTED.items() if k not in ("occurrences", "pairs")}
_IN_TABLE_TYPES = "sequence string, start long, match string, context string, sequence_line string, score int"


def table_matches(rows: DataFrame, key: str, text: str, pattern: str, normal: Callable[[str], str], keep: str, header: str, judge: Judge, reach: int = 19, near: int = 3, prepare: Prepare = None) -> DataFrame:
    """key, once for each sequence in the cells of the `reach` lines below a header line: its first place in a line that is not about genes.

    start is the line's number, context the line with `near` lines on either side,
    sequence_line the first line of the text that holds the match. prepare rewrites a
    cell before it is searched; cells that were seen before are not searched again.
    """
    finder, whole, head = re.compile(pattern), re.compile(keep), re.compile(header)

    def matches_in(cell: str) -> list[tuple[str, str]]:
        pairs = [(m[0], normal(m[0])) for m in finder.finditer(prepare(cell) if prepare else cell)]
        return [(m, name) for m, name in pairs if whole.fullmatch(name) and not judge.gene_name.match(name)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, search = Held(_IN_TABLE), Remembered(matches_in)
        for batch in batches:
            for i, value in enumerate(each(batch.column(1))):
                if not value or not head.search(value):
                    continue
                own, last = Lines(value), None
                every, seen, chosen = own.all(), set(), []
                for ln, line in enumerate(every):
                    if last is not None and ln - last <= reach:
                        new = {}
                        for cell in cells(line):
                            for m, name in search(cell):
                                if name not in seen:
                                    new.setdefault(name, m)
                        if new:
                            context = "\n".join(every[max(0, ln - near) : ln + near + 1])
                            low = lowered(context)
                            points, genes = judge.in_table(low)
                            if not genes:
                                chosen += [(name, ln, m, context, points + 6 * sum(judge.close.of(context, name, low))) for name, m in new.items()]
                                seen.update(new)
                    if head.search(line):
                        last = ln
                lines = own.firsts([m for _, _, m, _, _ in chosen])
                for (name, ln, m, context, points), line in zip(chosen, lines, strict=True):
                    score = max(points + judge.of_sequence(name, 1), 0)
                    held.add(i, name, ln, m, context, line, score, size=len(context) + len(line))
                    if held.size > HELD:
                        yield held.batch(batch.columns[:1], [key])
            yield held.batch(batch.columns[:1], [key])

    return rows.select(key, text).mapInArrow(run, _types(rows, [key], _IN_TABLE_TYPES))


def pages_with(rows: DataFrame, keys: list[str], page: str, text: str, wanted: str, prepare: Prepare = None) -> DataFrame:
    """First of keys, sequence, original_sequence, page: for each of the wanted pairs of a row of which either is in its text.

    Rows with the same keys have the same wanted pairs; where they follow one another the
    automaton is made once. prepare rewrites a text before it is read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pairs, owners, machine = None, [], {}, None
        for batch in batches:
            row, found, held = [], [], 0
            names = list(zip(*[batch.column(k).to_pylist() for k in range(len(keys))], strict=True))

            def made() -> pa.RecordBatch:
                words = [pa.array([p[k] for p in found], pa.string()) for k in ("sequence", "original_sequence")]
                take = pa.array(row, pa.int32())
                return pa.RecordBatch.from_arrays([batch.column(0).take(take), *words, batch.column(len(keys)).take(take)], names=[keys[0], "sequence", "original_sequence", page])

            for i, name in enumerate(names):
                if name != last:
                    last, pairs, owners, machine = name, batch.column(len(keys) + 2)[i].as_py(), {}, ahocorasick.Automaton()
                    for k, p in enumerate(pairs):
                        for word in {p["sequence"], p["original_sequence"]} - {None}:
                            owners.setdefault(word, []).append(k)
                    for word in owners:
                        if word:
                            machine.add_word(word, word)
                    if len(machine):
                        machine.make_automaton()
                body = batch.column(len(keys) + 1)[i].as_py()
                if body is None:
                    continue
                body = prepare(body) if prepare else body
                words = {w for _, w in machine.iter(body)} if len(machine) else set()
                if "" in owners:
                    words.add("")
                for k in {k for w in words for k in owners[w]}:
                    row.append(i)
                    found.append(pairs[k])
                    held += 64
                if held > HELD:
                    yield made()
                    row, found, held = [], [], 0
            yield made()

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select(*keys, page, text, wanted).mapInArrow(run, f"`{keys[0]}` {types[keys[0]]}, sequence string, original_sequence string, `{page}` {types[page]}")


# ------------------------------------------------------------------ evidence

_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


class Evidence:
    """Which patterns each sentence matches, remembered: contexts of one document share most of their sentences."""

    def __init__(self, patterns: tuple[tuple[str, tuple[str, ...]], ...], supersedes: tuple[tuple[str, tuple[str, ...]], ...]):
        self.names = [n for n, _ in patterns]
        self.tries = [(t, k, literal(p), re.compile(p, re.IGNORECASE)) for t, (_, own) in enumerate(patterns) for k, p in enumerate(own)]
        self.supersedes = dict(supersedes)
        self.of = Remembered(self._of)

    def _of(self, sentence: str) -> list[tuple[int, int]]:
        """(technique, pattern) of each pattern that the sentence matches."""
        low = sentence.lower() if sentence.isascii() else None
        return [(t, k) for t, k, sure, p in self.tries if (low is None or sure in low) and p.search(sentence)]

    def lines(self, text: str) -> list[tuple[str, str]]:
        """(technique, line) in lexicon order: of the first pattern that any line matches the first such line, stripped."""
        own, low = Lines(text), text.lower() if text.isascii() else None
        every: list[str] | None = None
        best: dict[int, str] = {}
        for t, _, sure, pattern in self.tries:
            if t in best:
                continue
            if low is not None and sure:  # lines without what each match has are passed over
                at = low.find(sure)
                while at >= 0:
                    begin, end = own.span_at(at)
                    if pattern.search(text[begin:end]):
                        best[t] = text[begin:end].strip()
                        break
                    at = low.find(sure, max(at + 1, end))
                continue
            every = own.all() if every is None else every
            line = next((x for x in every if pattern.search(x)), None)
            if line is not None:
                best[t] = line.strip()
        return [(self.names[t], best[t]) for t in sorted(best)]

    def pairs(self, context: str) -> list[tuple[str, str]]:
        """(technique, sentence) in lexicon order: of the first pattern that any sentence matches the first such sentence; general techniques go where a specific one covers them."""
        best: dict[int, tuple[int, str]] = {}
        for part in _SENTENCE_END.split(context.replace("\n", " ")):
            sentence = part.strip()
            if not sentence:
                continue
            for t, k in self.of(sentence):
                if t not in best or k < best[t][0]:
                    best[t] = k, sentence
        return self.named({t: sentence for t, (_, sentence) in best.items()})

    def named(self, best: dict[int, str]) -> list[tuple[str, str]]:
        covered = {g for t in best for g in self.supersedes.get(self.names[t], ())}
        return [(self.names[t], best[t]) for t in sorted(best) if self.names[t] not in covered]


class Stretches:
    """Evidence.pairs of stretches of one text: its sentences are looked through once, those that a stretch cuts again."""

    def __init__(self, model: Evidence, text: str):
        self.model, self.text = model, text.replace("\n", " ")
        cuts = [m.span() for m in _SENTENCE_END.finditer(self.text)]
        self.begins, self.ends = [0, *[b for _, b in cuts]], [*[a for a, _ in cuts], len(text)]
        #: numbers of the sentences that match each (technique, pattern), found when first asked for
        self.where: dict[tuple[int, int], list[int]] | None = None

    def _sentence(self, k: int) -> str:
        return self.text[self.begins[k] : self.ends[k]].strip()

    def pairs(self, begin: int, end: int) -> list[tuple[str, str]]:
        if self.where is None:
            self.where = {}
            for k in range(len(self.begins)):
                for hit in self.model.of(self._sentence(k)):
                    self.where.setdefault(hit, []).append(k)
        first, last = bisect_right(self.begins, begin) - 1, bisect_right(self.begins, max(begin, end - 1)) - 1
        # a stretch that begins or ends between two sentences cuts none there: what is left of the one is empty
        cut = [] if begin <= self.begins[first] and end >= self.ends[first] else [first]
        if last > first and end < self.ends[last]:
            cut.append(last)
        low, high = first + (first in cut), last + (last not in cut)
        parts = [self.text[max(begin, self.begins[k]) : min(end, self.ends[k])].strip() for k in cut]
        hits = [self.model.of(x) if x else [] for x in parts]
        best: dict[int, str] = {}
        for hit in sorted({*self.where, *[h for own in hits for h in own]}):
            if hit[0] in best:
                continue
            if cut and cut[0] == first and hit in hits[0]:
                best[hit[0]] = parts[0]
                continue
            own = self.where.get(hit, ())
            k = bisect_left(own, low)
            if k < len(own) and own[k] < high:
                best[hit[0]] = self._sentence(own[k])
            elif cut and cut[-1] == last and hit in hits[-1]:
                best[hit[0]] = parts[-1]
        return self.model.named(best)


@lru_cache(maxsize=8)
def _remembered(patterns: tuple, supersedes: tuple) -> Evidence:
    """One a worker, so that what it remembers lasts."""
    return Evidence(patterns, supersedes)


def evidence(context: Column, patterns: dict[str, list[str]], supersedes: dict[str, list[str]]) -> Column:
    """array<struct<technique, line>> of each context (see Evidence.pairs); null for null."""
    return _told(context, listed(patterns, supersedes), Evidence.pairs)


def line_evidence(text: Column, patterns: dict[str, list[str]]) -> Column:
    """array<struct<technique, line>> of each text (see Evidence.lines); null for null."""
    return _told(text, listed(patterns, {}), Evidence.lines)


def _told(text: Column, tables: Listed, of: Callable[[Evidence, str], list[tuple[str, str]]]) -> Column:
    kind = pa.list_(pa.struct([("technique", pa.string()), ("line", pa.string())]))

    @F.arrow_udf("array<struct<technique:string,line:string>>")
    def run(column: pa.Array) -> pa.Array:
        model = _remembered(*tables)
        size, names, lines = [0], [], []
        for value in each(column):
            for name, line in of(model, value or ""):
                names.append(name)
                lines.append(line)
            size.append(len(names))
        struct = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(lines, pa.string())], fields=list(kind.value_type))
        return pa.ListArray.from_arrays(pa.array(size, pa.int32()), struct, mask=column.is_null() if column.null_count else None)

    return run(text)
