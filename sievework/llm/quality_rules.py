"""Quality rules with an n-gram perplexity band per language.

The language model is a modified Kneser-Ney model of UTF-8 byte n-grams, one per
language, counted by Spark over every distinct text of it: tasks pre-count their n-grams
with numpy, Spark adds them up. The smoothed log-probabilities stand in arrays sorted by
hash, with a directory over the leading hash bits, and go to the tasks by broadcast.
That table is checked for size: if the corpus has more than `table` distinct n-grams,
the same model is made by Spark joins. Every n-gram of a text is in it, so a text's score is
a sum over n-grams, and the model is used a table at a time: languages are put together up
to a table's size, a larger one is dealt over several by hash, and each pass reads the
texts of its languages where they are and hands on their sums alone. Where that takes more
than PASSES passes, the n-grams of texts are joined with the model instead. The order is the
same at every size.

A document's log-perplexity is its negative log-probability divided by its number of
words with a letter or digit (bytes of symbols are cheap one by one, so a mean over
bytes would hide them). The accepted band of a language reaches from its lower quartile
less `low` interquartile ranges to its upper quartile plus `high` of them, wider for
short documents, whose means scatter: the ranges are multiplied by 1 + sqrt(40 / words).
Quartiles, like the model, are over distinct texts: copies have one vote together, or a
group of them could make the band its own; every row is then judged.
Both ends reject: text far too predictable (boilerplate, repeats) and text far too
surprising (symbols, noise).

Words and lines are compared by 64-bit hashes of their bytes. Figures of a text are
added up within it, so verdicts hang neither on partitions nor on the order of rows.

Null text is empty; documents without a scorable n-gram, and languages with fewer than
`least` distinct texts, have no band. Null language is a language of its own. Languages
share a model if their 24-bit codes collide. Texts of any length are read whole, a few
megabytes of rows at a time and one row at least. Repeated rows and ties are judged
alike; other columns of docs, whatever their names, play no part; an empty table gives
no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import kernels
from .common import bounded, join_hot, release, row_key, slices, store

ORDER = 5
#: n-grams in a broadcast table at most (12 bytes each).
TABLE = 4_000_000
#: Band ends in interquartile ranges below and above the quartiles; documents for a band.
LOW, HIGH, LEAST = 2.0, 2.0, 50
#: Languages whose bands are broadcast at most.
LANGUAGES = 10_000
#: Passes over texts at most, each with a table of the model.
PASSES = 64
#: Keys of repeated texts that are broadcast at most (8 bytes each).
REPEATED = 2_000_000
_CODE = 24
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def language_code() -> Column:
    return F.xxhash64(F.coalesce(F.col("lang"), F.lit(""))).bitwiseAND((1 << _CODE) - 1)


def grams(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, first): packed language and bytes of every n-gram, and where each text's begin."""
    lengths = np.maximum(np.diff(offsets) - order + 1, 0)
    first = np.append(0, np.cumsum(lengths))
    n = len(data) - order + 1
    if n <= 0 or not first[-1]:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    wide = np.zeros(n, np.uint64)
    for k in range(order):
        wide <<= np.uint64(8)
        wide |= data[k : k + n]
    inside = np.ones(n, bool)
    for k in range(1, order):
        at = offsets[1:-1] - k
        inside[at[(at >= 0) & (at < n)]] = False
    # texts shorter than the order leave no n-gram; marks from neighbours cover them
    keys = wide[inside]
    keys |= np.repeat(codes.astype(np.uint64) << np.uint64(40), lengths)
    return keys, first


def distinct_texts(docs: DataFrame, repeated: int = REPEATED) -> DataFrame:
    """(text, code, vote) of docs, one row for each vote (key of language and text).

    Texts without copies stay where they are; only those with copies move.
    """
    rows = docs.select("text", "code", "vote")
    again = store(rows.groupBy("vote").agg(F.count("*").alias("copies")).where("copies > 1").select("vote"), "again")
    if not bounded(again, repeated):
        return rows.dropDuplicates(["vote"])
    again = F.broadcast(again)
    return rows.join(again, "vote", "left_anti").unionByName(rows.join(again, "vote", "left_semi").dropDuplicates(["vote"])).select("text", "code", "vote")


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, n) over all documents of docs (text, code)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([k for k, _ in held])
            order_ = np.argsort(keys)
            keys, n = keys[order_], np.concatenate([n for _, n in held])[order_]
            at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            return keys[at], np.add.reduceat(n, at)

        for batch in slices(batches, "text"):
            data, offsets = kernels.flat(batch.column(0))
            keys, _ = grams(data, offsets, np.asarray(batch.column(1)), order)
            if len(keys):
                keys.sort()
                at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                held.append((keys[at], np.diff(np.append(at, len(keys)))))
            if len(held) >= 12:
                held = [merged()]
                if len(held[0][0]) > 3_000_000:
                    yield _pairs(*held.pop())
        if held:
            yield _pairs(*merged())

    def _pairs(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])

    return docs.select("text", "code").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def discounts(tallies: list[float]) -> np.ndarray:
    """What is taken from counts of 1, 2, and 3 or more; tallies: how many n-grams have counts 1 to 4."""
    y = tallies[0] / max(1.0, tallies[0] + 2 * tallies[1])
    cuts = np.array([min(c, max(0.0, c - (c + 1) * y * tallies[c] / tallies[c - 1])) if tallies[c - 1] else 0.5 * c for c in (1, 2, 3)])
    return np.clip(cuts, 0.05, [0.95, 1.9, 2.85])


class KneserNey:
    """Interpolated modified Kneser-Ney over packed byte n-grams."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int):
        self.order = order
        levels = [(keys, counts.astype(np.float64))]
        for k in range(order, 1, -1):  # continuation counts: distinct bytes to the left
            shorter, n = np.unique(self._shorter(levels[-1][0], k), return_counts=True)
            levels.append((shorter, n.astype(np.float64)))
        self.seen, self.backoff = [], []
        lower: tuple[np.ndarray, np.ndarray] | None = None
        for k, (own, n) in enumerate(reversed(levels), 1):
            sort = np.argsort(own)
            own, n = own[sort], n[sort]
            context = self._context(own)
            at = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(own) else np.zeros(0, np.int64)
            of = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(own))))
            cuts = discounts([float((n == c).sum()) for c in (1, 2, 3, 4)])
            cut = cuts[np.minimum(n, 3).astype(int) - 1] if len(n) else n
            total = np.add.reduceat(n, at) if len(n) else n
            spare = np.add.reduceat(cut, at) if len(n) else n
            gamma = spare / np.maximum(total, 1e-12)
            base = lower[1][np.searchsorted(lower[0], self._shorter(own, k))] if lower else 1 / 256
            p = (n - cut) / total[of] + gamma[of] * base
            self.seen.append(kernels.HashArrays(own, np.log(p).astype(np.float32), np.nan))
            self.backoff.append(kernels.HashArrays(context[at], np.log(gamma).astype(np.float32), np.nan))
            lower = own, p

    @staticmethod
    def _shorter(keys: np.ndarray, k: int) -> np.ndarray:
        """Without the oldest byte."""
        low = np.uint64((1 << 8 * (k - 1)) - 1)
        return keys & ~np.uint64((1 << 40) - 1) | keys & low

    @staticmethod
    def _context(keys: np.ndarray) -> np.ndarray:
        """Without the newest byte."""
        low = np.uint64((1 << 40) - 1)
        return keys & ~low | (keys & low) >> np.uint64(8)

    def log_p(self, keys: np.ndarray) -> np.ndarray:
        out = self.seen[-1].get(keys)
        missing = np.flatnonzero(np.isnan(out))
        weight, k, rest = np.zeros(len(missing), np.float32), self.order, keys[missing]
        while len(missing):
            weight += np.nan_to_num(self.backoff[k - 1].get(self._context(rest)), nan=0.0)
            k -= 1
            if not k:
                out[missing] = weight - np.log(256.0)
                break
            rest = self._shorter(rest, k + 1)
            p = self.seen[k - 1].get(rest)
            there = ~np.isnan(p)
            out[missing[there]] = weight[there] + p[there]
            missing, weight, rest = missing[~there], weight[~there], rest[~there]
        return out


def fit(counts: DataFrame, order: int = ORDER) -> KneserNey:
    """The model of n-gram counts (key, n)."""
    got = counts.toArrow()
    return KneserNey(got.column("key").to_numpy().view(np.uint64), got.column("n").to_numpy(), order)


def fit_table(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, n, log_p): what KneserNey says of the n-grams of counts (key, n), without a table in memory.

    A context has at most 256 next bytes and an n-gram at most 256 bytes to its left, so
    no key of a window or join has more rows.
    """
    low, key = F.lit((1 << 40) - 1), F.col("key")
    head = key.bitwiseAND(F.lit(~((1 << 40) - 1)))
    shorter = lambda k: head.bitwiseOR(key.bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)))
    levels = [counts]
    for k in range(order, 1, -1):  # continuation counts: distinct bytes to the left
        levels.append(store(levels[-1].groupBy(shorter(k).alias("key")).agg(F.count("*").alias("n")), "level"))
    lower = None
    for k, level in enumerate(reversed(levels), 1):
        cuts = discounts([float(x) for x in level.agg(*[F.count(F.when(F.col("n") == c, 1)) for c in (1, 2, 3, 4)]).first()])
        cut = F.element_at(F.array(*[F.lit(float(c)) for c in cuts]), F.least("n", F.lit(3)).cast("int"))
        context = Window.partitionBy("context")
        own = level.withColumn("context", head.bitwiseOR(F.shiftright(key.bitwiseAND(low), 8))).withColumn("cut", cut)
        own = own.withColumn("total", F.sum("n").over(context)).withColumn("spare", F.sum("cut").over(context))
        if lower is None:
            own = own.withColumn("base", F.lit(1 / 256))
        else:
            own = own.withColumn("shorter", shorter(k)).join(lower.select(key.alias("shorter"), F.col("p").alias("base")), "shorter")
        p = (F.col("n") - F.col("cut")) / F.col("total") + F.col("spare") / F.col("total") * F.col("base")
        lower = store(own.select("key", "n", p.alias("p")), "model")
        release(counts.sparkSession)
    return lower.select("key", "n", F.log("p").cast("float").cast("double").alias("log_p"))


def passes(sizes: dict[int, int], table: int) -> list[tuple[list[int], int, int]]:
    """(languages, part, parts) of each pass, given the n-grams of each language: few languages' tables together, or a part of one language's."""
    out: list[tuple[list[int], int, int]] = []
    together: list[int] = []
    held = 0
    for code, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        if n > table:
            parts = -(-n // table)
            out += [([code], i, parts) for i in range(parts)]
            continue
        if together and held + n > table:
            out.append((together, 0, 1))
            together, held = [], 0
        together.append(code)
        held += n
    return [*out, (together, 0, 1)] if together else out


def text_nats(docs: DataFrame, model: DataFrame, order: int = ORDER, table: int = TABLE) -> DataFrame:
    """(vote, nats) of docs (text, code, vote) by a model that fit_table made of the same texts."""
    spark, language = docs.sparkSession, F.shiftrightunsigned("key", 40)
    sizes = {r[0]: r[1] for r in model.groupBy(language.alias("code")).agg(F.count("*")).limit(LANGUAGES + 1).collect()}
    every = passes(sizes, table)
    if not every or len(sizes) > LANGUAGES or len(every) > PASSES:
        return _joined_nats(docs, model, order)
    sums = []
    for codes, part, parts in every:
        own = model.where(language.isin(codes) & (F.pmod(F.xxhash64("key"), F.lit(parts)) == part)).select("key", "log_p").toArrow()  # a table's size
        keys, log_p = own.column("key").to_numpy().view(np.uint64), own.column("log_p").to_numpy().astype(np.float32)
        shared = spark.sparkContext.broadcast(kernels.HashArrays(keys, log_p, 0.0))  # what another pass has adds nothing
        scored = docs.where(F.col("code").isin(codes)).select("text", "code", "vote").mapInArrow(_adding(shared, order), "vote long, nats double")
        sums.append(store(scored, "sums"))
        shared.unpersist()
    return functools.reduce(DataFrame.unionByName, sums).groupBy("vote").agg(F.sum("nats").alias("nats"))


def _adding(shared, order: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches, "text"):
            data, offsets = kernels.flat(batch.column(0))
            keys, first = grams(data, offsets, np.asarray(batch.column(1)), order)
            scored = np.flatnonzero(np.diff(first))
            nats = -kernels.totals(known.get(keys).astype(np.float64), first)[scored]
            yield pa.RecordBatch.from_arrays([batch.column(2).take(pa.array(scored)), pa.array(nats)], names=["vote", "nats"])

    return run


def _joined_nats(docs: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """text_nats by a join: a row for each distinct n-gram of each text is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = kernels.flat(batch.column(0))
            keys, first = grams(data, offsets, np.asarray(batch.column(1)), order)
            text = np.repeat(np.arange(len(batch)), np.diff(first))
            sort = np.lexsort((keys, text))
            keys, text = keys[sort], text[sort]
            at = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (text[1:] != text[:-1]))) if len(keys) else np.zeros(0, np.int64)
            times = np.diff(np.append(at, len(keys)))
            yield pa.RecordBatch.from_arrays([pa.array(np.asarray(batch.column(2))[text[at]]), pa.array(keys[at].view(np.int64)), pa.array(times.astype(np.int64))], names=["vote", "key", "times"])

    found = docs.select("text", "code", "vote").mapInArrow(run, "vote long, key long, times long")
    return join_hot(found, model, "key", "n", "inner").groupBy("vote").agg((-F.sum(F.col("times") * F.col("log_p"))).alias("nats"))


def base_figures(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    texts = len(offsets) - 1
    starts, ends, first = kernels.words(data, offsets)
    inside = ~kernels.SPACE[data]
    out = {
        "n_words": np.diff(first),
        "word_chars": kernels.totals(inside & (data & 0xC0 != 0x80), offsets),
        "n_symbols": kernels.totals(_SYMBOL[data], offsets),
    }
    letters = np.append(0, np.cumsum(_LETTER[data]))
    out["n_lettered"] = kernels.totals(letters[ends] > letters[starts], first)

    # lines: cut at \n and at text edges; those with a word, less the distinct ones
    breaks = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    line_text = np.sort(np.concatenate([np.arange(texts), np.searchsorted(offsets, breaks, side="right") - 1]))
    line_ends = np.sort(np.concatenate([breaks, offsets[1:]]))
    filled = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    a, b, t = line_starts[filled], line_ends[filled], line_text[filled]
    same = kernels.mix(kernels.range_hashes(data, a, b) ^ kernels.mix(t.astype(np.uint64)))
    _, at = np.unique(same, return_index=True)
    out["n_dup_lines"] = np.bincount(t, minlength=texts) - np.bincount(t[at], minlength=texts)

    # words under an 8-word window that its text has twice or more
    window, where = kernels.windows(kernels.range_hashes(data, starts, ends), first, 8)
    text = np.repeat(np.arange(texts), np.diff(first))
    covered = np.zeros(len(starts) + 1, np.int32)
    if len(window):
        key = kernels.mix(window ^ kernels.mix(text[where].astype(np.uint64)))
        ordered = np.sort(key)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(twice):
            spot = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
            hit = where[twice[spot] == key]
            np.add.at(covered, hit, 1)
            np.add.at(covered, hit + 8, -1)
    out["n_repeat_words"] = kernels.totals(np.cumsum(covered[:-1]) > 0, first)
    return out


_FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, model: KneserNey | None, keep: tuple[str, ...]) -> DataFrame:
    """keep columns of docs (text, code), the base figures, n_lettered, and nats (null: no n-gram, or no model)."""
    source = docs.select("text", "code", *[c for c in keep if c != "code"])
    rest = [c for c in source.columns[1:]]
    shared = source.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm = shared.value
        for batch in slices(batches, "text"):
            data, offsets = kernels.flat(batch.column(0))
            figures = base_figures(data, offsets)
            nats = pa.nulls(len(batch), pa.float64())
            if lm is not None:
                keys, first = grams(data, offsets, np.asarray(batch.column(1)), lm.order)
                sums = kernels.totals(lm.log_p(keys).astype(np.float64), first)
                nats = pa.array(-sums, mask=np.diff(first) == 0)
            made = [*[pa.array(figures[c].astype(np.int64)) for c in (*_FIGURES, "n_lettered")], nats]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], names=[*rest, *_FIGURES, "n_lettered", "nats"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*rest).schema], *[f"{c} long" for c in (*_FIGURES, "n_lettered")], "nats double"])
    return source.mapInArrow(run, schema)


def quartiles(figures: DataFrame) -> DataFrame:
    """(code, _docs, _q1, _q3): distinct texts of each language, and quartiles of their log_ppl.

    Texts are counted by steps of a thousandth of log_ppl (relative, so a language has
    some ten thousand steps at most, however many texts); a quartile is the first step that
    a quarter of the texts have reached. Counts add up alike in any order.
    """
    step = F.floor(1000 * F.log1p("log_ppl")).cast("int").alias("step")
    votes = figures.groupBy("code", "vote").agg(F.min("log_ppl").alias("log_ppl"))
    counts = votes.groupBy("code", step).agg(F.count("*").alias("n"))
    language = Window.partitionBy("code")
    run = counts.withColumn("upto", F.sum("n").over(language.orderBy("step").rowsBetween(Window.unboundedPreceding, 0))).withColumn("_docs", F.sum("n").over(language))
    reached = lambda part: F.expm1(F.min(F.when(F.col("upto") * 4 >= F.col("_docs") * part, F.col("step"))) / 1000)
    return run.groupBy("code").agg(F.first("_docs").alias("_docs"), reached(1).alias("_q1"), reached(3).alias("_q3"))


def judge(docs: DataFrame, order: int = ORDER, table: int = TABLE, low: float = LOW, high: float = HIGH, least: int = LEAST, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep columns of docs (doc_id, text, lang), base figures, log_ppl, base_failed and kept."""
    coded = docs.withColumn("code", language_code()).withColumn("vote", row_key("code", "text"))
    texts = distinct_texts(coded)
    counts = store(count_grams(texts, order), "grams")
    small = counts.count() <= table
    figures = store(measure(coded, fit(counts, order) if small else None, (*keep, "vote")), "figures")
    if not small:
        nats = text_nats(texts, fit_table(counts, order), order, table)
        nats = store(nats.join(figures.groupBy("vote").agg(F.count("*").alias("copies")), "vote"), "nats")
        figures = join_hot(figures.drop("nats"), nats, "vote", "copies", "left")
    figures = figures.withColumn("log_ppl", F.when(F.col("n_lettered") > 0, F.col("nats") / F.col("n_lettered")))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    figures = figures.withColumn("base_failed", failed)
    bands = quartiles(figures.where("log_ppl is not null and not base_failed")).where(F.col("_docs") >= least)
    # languages are few; a language with a third of all documents stays where its rows are
    q1, q3 = F.col("_q1"), F.col("_q3")
    width = F.greatest(q3 - q1, F.lit(0.05)) * (1 + F.sqrt(40 / F.greatest(F.col("n_words"), F.lit(1))))
    inside = F.col("log_ppl").between(q1 - low * width, q3 + high * width)
    bands = F.broadcast(bands) if bounded(bands, LANGUAGES) else bands
    banded = figures.join(bands, "code", "left").withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
    return banded.select(*keep, *_FIGURES, "log_ppl", "base_failed", "kept")
