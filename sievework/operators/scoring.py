"""Scores of sequences against a reference collection, and of contexts against reference vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as lex
from ..functions import text as T
from ..storage import store
from . import blocks

#: Reference sequences in an index at most, and its entries where it is broadcast (24 bytes each).
INDEX_ROWS = 500_000
POSTINGS = 1_000_000
#: References of one block of a larger index; queries that are looked up in it together.
BLOCK, TOGETHER = 20_000, 2_000


def grams(seq: Column, n: int = 3) -> Column:
    """Character n-grams in order; none for shorter texts."""
    low = F.lower(seq)
    return F.when(F.length(low) >= n, F.transform(F.sequence(F.lit(1), F.length(low) - (n - 1)), lambda i: F.substring(low, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def reference_statistics(refs: DataFrame, seq: str = "seq") -> DataFrame:
    """One row: median length, residues in all, and the share of each letter; duplicates count."""
    letters = refs.select(F.explode(F.split(seq, "")).alias("letter")).groupBy("letter").agg(F.count("*").alias("n"))
    shares = letters.agg(F.sum("n").alias("residues"), F.map_from_entries(F.collect_list(F.struct("letter", "n"))).alias("counts"))
    return refs.agg(F.median(F.length(seq)).alias("median_length")).crossJoin(shares)  # one row each


def letter_shares(refs: DataFrame, seq: str = "seq") -> DataFrame:
    """(letter, n, share) over all residues."""
    letters = refs.select(F.explode(F.split(seq, "")).alias("letter")).groupBy("letter").agg(F.count("*").alias("n"))
    total = letters.agg(F.sum("n").alias("total"))
    return letters.crossJoin(F.broadcast(total)).select("letter", "n", (F.col("n") / F.col("total")).alias("share"))  # one row


def capped(refs: DataFrame, seq: str = "seq", rows: int = INDEX_ROWS) -> DataFrame:
    """Distinct references, at most `rows` of them: those of least MD5, the same on every run.

    Counts by the head of the digest (16 bits) tell the head up to which all are wanted;
    only those of the next head are sorted.
    """
    each = refs.select(seq).distinct()
    if each.limit(rows + 1).count() <= rows:
        return each
    each = store(each.withColumn("_md5", F.md5(seq)).withColumn("_head", F.substring("_md5", 1, 4)), "references")
    upto = Window.orderBy("_head").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = each.groupBy("_head").agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(upto))  # 65,536 rows at most
    edge = counts.where(F.col("upto") >= rows).orderBy("_head").first()
    below = each.where(F.col("_head") < edge["_head"]).select(seq)
    last = each.where(F.col("_head") == edge["_head"]).orderBy("_md5", seq).limit(rows - edge["upto"] + edge["n"]).select(seq)
    return below.unionByName(last)


def gram_idf(refs: DataFrame, seq: str = "seq", n: int = 3) -> DataFrame:
    """(gram, df, idf) over distinct references, with smoothed inverse document frequency."""
    each = refs.select(seq).distinct()
    total = each.agg(F.count("*").alias("refs"))
    counts = each.select(F.explode(F.array_distinct(grams(F.col(seq), n))).alias("gram")).groupBy("gram").agg(F.count("*").alias("df"))
    return counts.crossJoin(F.broadcast(total)).select("gram", "df", (F.log((1 + F.col("refs")) / (1 + F.col("df"))) + 1).alias("idf"))  # one row


def weighted(rows: DataFrame, seq: str, idf: DataFrame, n: int = 3) -> DataFrame:
    """(seq, gram, w): unit vectors of tf-idf; grams the references don't have are dropped before the norm."""
    terms = rows.select(seq, F.explode(grams(F.col(seq), n)).alias("gram")).groupBy(seq, "gram").agg(F.count("*").alias("tf"))
    terms = terms.join(idf.select("gram", "idf"), "gram").withColumn("v", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("v") * F.col("v")).over(Window.partitionBy(seq)))
    return terms.select(seq, "gram", (F.col("v") / norm).alias("w"))


def nearest(queries: DataFrame, refs: DataFrame, seq: str = "seq", n: int = 3, postings: int = POSTINGS) -> DataFrame:
    """(seq, nearest) of distinct queries: highest cosine of tf-idf n-grams to any reference; 0 without a shared gram.

    An inverted index. Of at most `postings` entries (counted) it is broadcast as arrays,
    and each query adds up its grams' entries. A larger one is cut into blocks of
    references, each an index of its own with the greatest weight of every gram; blocks of
    queries meet them, and a query's best in a block is found without looking at entries
    that can't change it (see Index.best). No pair of query and reference leaves a task.
    """
    each = queries.select(seq).distinct()
    idf = gram_idf(refs, seq, n)
    index = weighted(refs.select(seq).distinct(), seq, idf, n).select(F.col(seq).alias("ref"), "gram", F.col("w").alias("r"))
    if index.limit(postings + 1).count() <= postings:
        return _nearest_here(each, index, idf, seq, n)
    vectors = lambda rows, key, w: rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("gram", w))).alias("v")).select(key, F.transform("v", lambda x: x["gram"]).alias("grams"), F.transform("v", lambda x: x[w]).alias("weights"))  # noqa: E731  a sequence's own grams
    best = _best_of_blocks(vectors(weighted(each, seq, idf, n), seq, "w"), vectors(index, "ref", "r"), seq)
    return each.join(best, seq, "left").select(seq, F.coalesce(F.greatest("nearest", F.lit(0.0)), F.lit(0.0)).alias("nearest"))


class Index:
    """Entries (gram, reference, weight) by gram, those of a gram in order of reference, with each gram's greatest weight."""

    def __init__(self, grams: list[str], begin: np.ndarray, ref: np.ndarray, weight: np.ndarray):
        self.number, self.begin, self.ref, self.weight = {g: k for k, g in enumerate(grams)}, begin, ref, weight
        self.size = int(ref.max()) + 1 if len(ref) else 0
        self.most = np.maximum.reduceat(weight, begin[:-1]) if len(weight) else np.zeros(0)
        self.sums, self.seen = np.zeros(self.size), np.zeros(self.size, bool)

    @staticmethod
    def build(vectors: list[tuple[list[str], list[float]]]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        gram = pa.array([g for grams_, _ in vectors for g in grams_], pa.string()).dictionary_encode()
        weight = np.array([w for _, own in vectors for w in own])
        ref = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(g) for g, _ in vectors])
        names, at = gram.dictionary.to_pylist(), gram.indices.to_numpy()
        order = np.argsort(at, kind="stable")
        return names, np.searchsorted(at[order], np.arange(len(names) + 1)), ref[order], weight[order]

    def best(self, grams_: list[str], weights: list[float]) -> float:
        """The highest sum of products with any reference.

        Grams go from the one that can add most to the one that can add least. Once those
        still to come can't make up for the best sum so far, no new reference can win:
        from there on only the references seen that can still win are looked up.
        """
        own = [(self.number[g], w) for g, w in zip(grams_, weights, strict=True) if g in self.number]
        if not own:
            return 0.0
        gram, w = np.array([g for g, _ in own]), np.array([x for _, x in own])
        order = np.argsort(-w * self.most[gram])
        gram, w = gram[order], w[order]
        left = np.append(np.cumsum((w * self.most[gram])[::-1])[::-1], 0.0)  # what this gram and those after it can add
        top, k, touched = 0.0, 0, []
        while k < len(gram) and left[k] >= top:
            a, b = self.begin[gram[k]], self.begin[gram[k] + 1]
            ref = self.ref[a:b]
            self.sums[ref] += w[k] * self.weight[a:b]
            touched.append(ref[~self.seen[ref]])
            self.seen[ref] = True
            top = max(top, float(self.sums[ref].max()))
            k += 1
        every = np.concatenate(touched)
        live = np.sort(every)
        while k < len(gram):
            live = live[self.sums[live] + left[k] >= top]
            a, b = self.begin[gram[k]], self.begin[gram[k] + 1]
            if len(live) and a < b:
                at = a + np.searchsorted(self.ref[a:b], live)
                hit = (at < b) & (self.ref[np.minimum(at, b - 1)] == live)
                self.sums[live[hit]] += w[k] * self.weight[at[hit]]
                top = max(top, float(self.sums[live].max()))
            k += 1
        self.sums[every] = 0.0
        self.seen[every] = False
        return top


def _best_of_blocks(queries: DataFrame, refs: DataFrame, seq: str) -> DataFrame:
    """(seq, nearest) of queries and refs (key, grams, weights)."""
    refs = store(refs, "vectors")
    parts = max(1, -(-refs.count() // BLOCK))

    def index(table: pa.Table) -> pa.Table:
        names, begin, ref, weight = Index.build(list(zip(table.column("grams").to_pylist(), table.column("weights").to_pylist(), strict=True)))
        made = [table.column("number")[:1], pa.array([names], pa.list_(pa.string())), *[pa.array([x.astype(t).tobytes()], pa.binary()) for x, t in ((begin, "<i8"), (ref, "<i4"), (weight, "<f8"))]]
        return pa.Table.from_arrays(made, names=["number", "names", "begins", "refs", "entries"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), TOGETHER):
                part = batch.slice(at, TOGETHER)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), c) for c in part.columns], names=["seqs", "grams", "weights"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                seqs, grams_, weights, names, begins, ref, entries = (batch.column(c)[r].as_py() for c in range(7))
                own = Index(names, np.frombuffer(begins, "<i8"), np.frombuffer(ref, "<i4"), np.frombuffer(entries, "<f8"))
                yield pa.RecordBatch.from_arrays([pa.array(seqs, pa.string()), pa.array([own.best(g, w) for g, w in zip(grams_, weights, strict=True)])], names=[seq, "best"])

    # the references of a part are BLOCK, give or take what a hash gives
    dealt = refs.withColumn("number", F.pmod(F.xxhash64("ref"), F.lit(parts)).cast("int"))
    indexed = store(dealt.groupBy("number").applyInArrow(index, "number int, names array<string>, begins binary, refs binary, entries binary"), "index")
    packed = store(queries.mapInArrow(pack, "seqs array<string>, grams array<array<string>>, weights array<array<double>>").withColumn("block", F.monotonically_increasing_id()), "queries")
    met = blocks.meet(packed, indexed, parts).select("seqs", "grams", "weights", "names", "begins", "refs", "entries")
    return met.mapInArrow(look, f"`{seq}` string, best double").groupBy(seq).agg(F.max("best").alias("nearest"))


def _nearest_here(queries: DataFrame, index: DataFrame, idf: DataFrame, seq: str, n: int) -> DataFrame:
    got = index.join(F.broadcast(idf.select("gram", "idf")), "gram").toArrow()
    grams_, gram = np.unique(got.column("gram").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
    refs, ref = np.unique(got.column("ref").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
    order = np.argsort(gram, kind="stable")
    begin = np.searchsorted(gram[order], np.arange(len(grams_) + 1))
    weight = np.zeros(len(grams_))
    weight[gram] = got.column("idf").to_numpy()
    shared = queries.sparkSession.sparkContext.broadcast(({g: k for k, g in enumerate(grams_.tolist())}, weight, begin, ref[order], got.column("r").to_numpy()[order], len(refs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, idf_, begin, ref, r, refs = shared.value
        rows = max(1, 4_000_000 // max(1, refs))
        for whole in batches:
            for at in range(0, len(whole), rows):
                part = whole.slice(at, rows)
                of, known = [], []
                for i, s in enumerate(part.column(0).to_pylist()):
                    low = (s or "").lower()
                    found = [number[g] for g in (low[k : k + n] for k in range(len(low) - n + 1)) if g in number]
                    of += [i] * len(found)
                    known += found
                pair, times = np.unique(np.array(of, np.int64) * max(1, len(idf_)) + np.array(known, np.int64), return_counts=True)
                i, g = pair // max(1, len(idf_)), pair % max(1, len(idf_))
                v = times * idf_[g]
                v /= np.sqrt(np.bincount(i, v * v, len(part)))[i]
                many = begin[g + 1] - begin[g]
                entry = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin[g], many)
                sums = np.bincount(np.repeat(i, many) * refs + ref[entry], np.repeat(v, many) * r[entry], len(part) * refs)
                best = sums.reshape(len(part), refs).max(axis=1) if refs else np.zeros(len(part))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(best)], names=[seq, "nearest"])

    return queries.select(seq).mapInArrow(run, f"`{seq}` string, nearest double")


def length_score(length: Column, median: Column) -> Column:
    return F.greatest(F.lit(0.0), 1 - F.abs(length - median) / F.greatest(median, F.lit(1.0)))


def validity(seq: Column, letters: str = lex.AA) -> Column:
    return F.length(F.regexp_replace(seq, f"[^{letters}]", "")) / F.length(seq)


def composition(seq: Column, counts: Column) -> Column:
    """Cosine of a sequence's letter counts and the references'; 0 if either is empty."""
    own = F.split(seq, "")
    kinds = F.array_distinct(own)
    n = lambda c: F.size(F.filter(own, lambda x: x == c)).cast("double")
    dot = F.aggregate(kinds, F.lit(0.0), lambda a, c: a + n(c) * F.coalesce(F.try_element_at(counts, c).cast("double"), F.lit(0.0)))
    left = F.sqrt(F.aggregate(kinds, F.lit(0.0), lambda a, c: a + n(c) * n(c)))
    right = F.sqrt(F.aggregate(F.map_values(counts), F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")))
    return F.when((left > 0) & (right > 0), dot / (left * right)).otherwise(F.lit(0.0))


def sequence_scores(queries: DataFrame, refs: DataFrame, seq: str = "seq", n: int = 3) -> DataFrame:
    """(seq, exact, nearest, composition, length_score, validity, sequence_score) of distinct queries.

    A query that is a reference scores 1 throughout and stays out of the nearest-neighbour
    search; an empty one scores 0.
    """
    each = queries.select(F.regexp_replace(F.upper(seq), "[^A-Z]", "").alias(seq)).distinct()
    known = refs.select(seq).distinct()
    miss = each.join(known, seq, "left_anti").where(F.length(seq) > 0)
    stats = reference_statistics(refs, seq)
    scored = nearest(miss, capped(refs, seq), seq, n).crossJoin(F.broadcast(stats))  # one row
    scored = scored.select(F.col(seq), F.lit(False).alias("exact"), "nearest", composition(F.col(seq), F.col("counts")).alias("composition"), length_score(F.length(seq).cast("double"), F.col("median_length")).alias("length_score"), validity(F.col(seq)).alias("validity"))
    total = (0.5 * F.col("nearest") + 0.3 * F.col("composition") + 0.2 * F.col("length_score")) * F.col("validity") * F.col("validity")
    one = lambda v: [F.lit(v).alias(c) for c in ("nearest", "composition", "length_score", "validity", "sequence_score")]
    hits = each.join(known, seq, "left_semi").where(F.length(seq) > 0).select(seq, F.lit(True).alias("exact"), *one(1.0))
    empty = each.where(F.length(seq) == 0).select(seq, F.lit(False).alias("exact"), *one(0.0))
    return scored.withColumn("sequence_score", total).unionByName(hits).unionByName(empty)


# ------------------------------------------------------------------ contexts

Encoder = Callable[[list[str]], list[list[float]]]
#: Tokens of a context that an encoder reads.
MOST_TOKENS = 256


def encode(rows: DataFrame, text: str, load: Callable[[], Encoder] | None = None, vector: str = "embedding", batch: int = 16) -> DataFrame:
    """rows with unit vectors of a text column; load makes the encoder once in a worker (see token_encoder, transformer)."""

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = (load or transformer())()
        for texts in batches:
            out: list = []
            for i in range(0, len(texts), batch):
                out += encoder(texts.iloc[i : i + batch].fillna("").tolist())
            yield pd.Series(out)

    return rows.withColumn(vector, run(F.col(text))).withColumn(vector, unit(F.col(vector)))


def unit(vector: Column) -> Column:
    norm = lambda w: F.sqrt(F.aggregate(w, F.lit(0.0), lambda a, x: a + x * x))
    divided = lambda w, n: F.when(n > 0, F.transform(w, lambda x: x / n)).otherwise(w)
    return T.bound(F.transform(vector, lambda x: x.cast("double")), lambda w: T.bound(norm(w), lambda n: divided(w, n)))  # the norm once a vector, not once a number


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def context_scores(rows: DataFrame, key: str, references: DataFrame, vector: str = "embedding", most: int = 4096) -> DataFrame:
    """(key, bio_score) of each row: highest cosine to any reference vector, 0 at least.

    Vectors are multiplied as matrices, in double precision. Up to `most` distinct reference
    vectors (counted) are broadcast, and rows stay where they are. More are cut into
    blocks of that size, which blocks of rows meet by number; of each row only its best in
    a block leaves the task. Vectors that are null, zero, of another length than the
    references' or not finite score 0.
    """
    refs = references.select(F.col(vector).cast("array<double>").alias("r")).where("r is not null").distinct()
    rows = rows.select(key, F.col(vector).cast("array<double>").alias(vector))
    if refs.limit(most + 1).count() <= most:
        return _scored_here(rows, key, refs, vector)
    numbers = -(-refs.count() // most)
    own, other = blocks.packed_rows(rows, key, vector), blocks.packed_references(refs, "r", numbers)
    other = other.withColumnRenamed("width", "_width").withColumnRenamed("matrix", "_matrix")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                block, width, left, width_, right = (batch.column(c)[r].as_py() for c in range(5))
                if width == width_ and width:
                    a, b = (np.frombuffer(x, "<f8").reshape(-1, width) for x in (left, right))
                    yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([_best(a, b).tobytes()], pa.binary())], names=["block", "best"])

    def over_all(table: pa.Table) -> pa.Table:
        best = np.max([np.frombuffer(x, "<f8") for x in table.column("best").to_pylist()], axis=0)
        return pa.Table.from_arrays([table.column("block")[:1], pa.array([best.tolist()], pa.list_(pa.float64()))], names=["block", "scores"])

    met = blocks.meet(own.drop("keys"), other, numbers).select("block", "width", "matrix", "_width", "_matrix").mapInArrow(run, "block long, best binary")
    top = met.groupBy("block").applyInArrow(over_all, "block long, scores array<double>")  # a row of each block of references
    pairs = F.explode(F.arrays_zip("keys", F.coalesce("scores", F.array_repeat(F.lit(0.0), F.size("keys"))).alias("scores")))
    return own.select("block", "keys").join(top, "block", "left").select(pairs.alias("p")).select(F.col("p.keys").alias(key), F.col("p.scores").alias("bio_score"))


def _best(rows: np.ndarray, refs: np.ndarray) -> np.ndarray:
    return np.maximum((rows @ refs.T).max(axis=1, initial=0.0), 0.0)


def _scored_here(rows: DataFrame, key: str, refs: DataFrame, vector: str) -> DataFrame:
    got = refs.toArrow().column("r").combine_chunks()  # counted
    matrix, none = blocks.matrix_of(got)
    shared = rows.sparkSession.sparkContext.broadcast(blocks.units(matrix[~none]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs_ = shared.value
        for whole in batches:
            for at in range(0, len(whole), blocks.ROWS):
                part = whole.slice(at, blocks.ROWS)
                own = blocks.units(blocks.matrix_of(part.column(1), refs_.shape[1])[0])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_best(own, refs_))], names=[key, "bio_score"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, bio_score double")


# ------------------------------------------------------------------ encoders


def pooled(tokens: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Means of the token vectors (text, token, dimension) that the mask shows; zeros where it shows none."""
    shown = mask[:, :, None].astype(np.float64)
    return (tokens * shown).sum(axis=1) / np.maximum(shown.sum(axis=1), 1e-9)


def token_encoder(tokenise: Callable[[str], list[int]], embed: Callable[[np.ndarray, np.ndarray], np.ndarray], most: int = MOST_TOKENS, padding: int = 0) -> Encoder:
    """An encoder of texts out of a tokeniser and a model of token vectors: `most` tokens of a text count, their mean is its vector.

    embed takes ids and mask (text, token), texts filled up to the longest of a batch, and
    gives a vector for each token.
    """

    def run(texts: list[str]) -> list[list[float]]:
        own = [tokenise(t)[:most] for t in texts]
        ids = np.full((len(own), max(1, *map(len, own), 1)), padding, np.int64)
        mask = np.zeros(ids.shape, bool)
        for i, row in enumerate(own):
            ids[i, : len(row)], mask[i, : len(row)] = row, True
        return pooled(np.asarray(embed(ids, mask), np.float64), mask).tolist()

    return run


def transformer(name: str = "allenai/scibert_scivocab_uncased", most: int = MOST_TOKENS) -> Callable[[], Encoder]:
    """A loader of a pretrained encoder by name or folder; needs transformers and torch."""

    def load() -> Encoder:
        import torch
        from transformers import AutoModel, AutoTokenizer

        tokenizer, model = AutoTokenizer.from_pretrained(name), AutoModel.from_pretrained(name).eval()

        def embed(ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
            with torch.no_grad():
                return model(input_ids=torch.from_numpy(ids), attention_mask=torch.from_numpy(mask.astype(np.int64))).last_hidden_state.numpy()

        return token_encoder(lambda t: tokenizer(t, truncation=True, max_length=most)["input_ids"], embed, most, tokenizer.pad_token_id or 0)

    return load
