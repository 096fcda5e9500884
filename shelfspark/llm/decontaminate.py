"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages of 8, 16 or 32 words, each half a passage on from the one before, the length by
the item's own (up to 12 words, up to 24, more), so that a passage is about as long as its item; documents are cut
into passages of each length that items have. Words are weighted by idf over all documents (counted by hash in a table of fixed size, so that
it can be broadcast; words that share a place count together). The item passages make a matrix whose leading
right singular vectors come from a distributed randomised subspace iteration; as many
are kept as leave each passage ENERGY of its weight. Document
passages in which the items' words carry enough weight are projected, and those whose
cosine with an item passage reaches MIN_COSINE are candidates. A candidate counts when the longest
common subsequence of the item with a stretch of the document about as long as the item
holds LCS_SHARE of the item's words, and ANSWER_SHARE of its answer, the last third.

The benchmark is the stated query set. It is dealt into blocks of about RANK passages with a basis
each; BLOCKS_A_PASS blocks are looked up in one pass over the documents, so what goes to the tasks is bounded.

Edge cases: items without words match nothing; null texts are empty; equal
items match alike; repeated documents are matched each time; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, saved, scratch
from .line_dedup import SIGNS
from .words import drop_empty, hash_strings, mixed, offsets_of, slices

#: Words of a passage, with the longest items (in words) that are looked up by it.
CLASSES = ((8, 12), (16, 24), (32, None))
RANK, BLOCKS_A_PASS = 256, 16
#: Share of every item passage's squared length that the kept directions hold, at least.
ENERGY = 0.8
#: Places of the table of document counts.
PLACES = 1 << 19
MIN_COSINE = 0.4
LCS_SHARE, ANSWER_SHARE = 0.7, 0.5

HITS = "item_id long, cosine double, lcs_share double, answer_share double"


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets and words: lower case, no signs at their ends."""
    lists = pc.ascii_split_whitespace(pc.utf8_lower(texts))
    return drop_empty(offsets_of(lists), pc.ascii_trim(lists.flatten(), characters=SIGNS))


def lcs_length(item: list[str], other: list[str]) -> int:
    """Longest common subsequence, a row of the table in the bits of one number."""
    masks: dict[str, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in other:
        if m := masks.get(w):
            hit = row & m
            row = (row + hit | row - hit) & full
    return len(item) - row.bit_count()


def match(item: list[str], words: list[str], start: int, length: int) -> tuple[float, float]:
    """For a passage of length words at start: best share of the item found in order in a stretch of words near start, and the share of its answer there."""
    n = len(item)
    span, answer = n + n // 3 + 1, item[-max(1, n // 3) :]
    low = max(0, start - n)
    high = max(low + 1, min(len(words), start + length + n) - span + 1)
    best = (0.0, 0.0)
    for at in range(low, high, max(1, n // 8)):
        stretch = words[at : at + span]
        if (share := lcs_length(item, stretch) / n) > best[0]:
            best = share, lcs_length(answer, stretch) / len(answer)
    return best


class Space:
    """A block of items: their words, idf weights, passages and, once fitted, the latent basis."""

    def __init__(self, items: list[tuple[int, list[str]]], idf: np.ndarray, length: int = 32):
        """idf: of each place of the table of document counts. length: words of a passage."""
        self.items, self.length, step = items, length, length // 2
        self.vocabulary = sorted({w for _, ws in items for w in ws})
        self.place = {w: i for i, w in enumerate(self.vocabulary)}
        self.idf = idf[_places(hash_strings(pa.array(self.vocabulary, pa.string())))]
        self.passages = [
            (k, at, sorted({self.place[w] for w in ws[at : at + length]}))
            for k, (_, ws) in enumerate(items)
            for at in range(0, max(1, len(ws) - step), step)
        ]

    def rows(self) -> list[tuple[list[int], list[float]]]:
        """The item passages as sparse rows of length one."""
        return [(p, (self.idf[p] / np.sqrt((self.idf[p] ** 2).sum())).tolist()) for _, _, p in self.passages]

    def keep(self, basis: np.ndarray) -> None:
        """Take the leading directions that every passage needs, and the passages' directions there."""
        spots = np.stack([np.asarray(v, np.float64) @ basis[p] for p, v in self.rows()])
        held = np.cumsum(spots**2, axis=1).min(axis=0)
        rank = min(basis.shape[1], int(np.searchsorted(held, ENERGY)) + 1)
        self.basis, spots = basis[:, :rank].astype(np.float32), spots[:, :rank]
        self.queries = (spots / np.sqrt((spots**2).sum(axis=1, keepdims=True))).astype(np.float32)

    def candidates(self, codes: np.ndarray, words: Passages) -> Iterator[tuple[int, int, int, float]]:
        """(text, word where the passage begins, item, cosine) for words coded by vocabulary place or -1."""
        known = codes >= 0
        total, own = words.total, words.mass(np.where(known, words.weight**2, 0.0))
        # The items' words bound the cosine: without this much of the weight it cannot be reached.
        live = np.flatnonzero((own >= MIN_COSINE**2 * total * (1 - 1e-6)) & (own > 0))
        for some in np.array_split(live, max(1, len(live) // 2048)):
            if not len(some):
                continue
            begin, lengths = words.begin[some], words.end[some] - words.begin[some]
            ends = np.cumsum(lengths)
            at = np.repeat(begin - (ends - lengths), lengths) + np.arange(ends[-1])
            # A word counts once in a passage, as in the items' passages.
            row = np.repeat(np.arange(len(some)), lengths)[known[at]]
            row, code = np.divmod(np.unique(row * len(self.idf) + codes[at[known[at]]]), len(self.idf))
            vectors = np.zeros((len(some), self.basis.shape[1]), np.float32)
            filled, first = np.unique(row, return_index=True)
            vectors[filled] = np.add.reduceat(self.basis[code] * self.idf[code][:, None], first, axis=0)
            cosine = vectors @ self.queries.T / np.sqrt(total[some])[:, None]
            for i, q in zip(*np.nonzero(cosine >= MIN_COSINE), strict=True):
                t = int(words.text[some[i]])
                yield t, int(begin[i] - words.offsets[t]), self.passages[q][0], float(cosine[i, q])


class Words:
    """The words of texts with their weights, and the last place before each where its text has the same word (or -1)."""

    def __init__(self, offsets: np.ndarray, hashes: np.ndarray, idf: np.ndarray):
        self.offsets, self.start = offsets, np.repeat(offsets[:-1], np.diff(offsets))
        keys = mixed(hashes ^ mixed(self.start.astype(np.uint64)))
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        self.before = np.full(len(keys), -1, np.int64)
        self.before[order[1:][same]] = order[:-1][same]
        self.weight = idf[_places(hashes)].astype(np.float64)


class Passages:
    """Where the passages of one length begin and end, and the squared weight of their different words."""

    def __init__(self, words: Words, length: int):
        self.offsets, self.weight, n = words.offsets, words.weight, np.diff(words.offsets)
        self.step = step = length // 2
        each = np.where(n > 0, np.maximum(1, (n - 1) // step), 0)
        self.text = np.repeat(np.arange(len(n)), each)
        self.begin = self.offsets[:-1][self.text] + step * (np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each))
        self.end = np.minimum(self.begin + length, self.offsets[1:][self.text])
        # A passage counts a word where the same one before it lies before the passage's begin.
        half = words.start + (np.arange(len(words.start)) - words.start) // step * step
        self.first, self.second = words.before < half, words.before < np.maximum(half - step, words.start)
        self.total = self.mass(self.weight**2)

    def mass(self, squares: np.ndarray) -> np.ndarray:
        """The sum over each passage's different words: each word lies in the first or the second half of its passages."""
        middle = np.minimum(self.begin + self.step, self.end)
        a, b = (np.concatenate([[0.0], np.cumsum(np.where(x, squares, 0.0))]) for x in (self.first, self.second))
        return a[middle] - a[self.begin] + b[self.end] - b[middle]


class Spaces:
    """Blocks that are looked up in one pass over the documents."""

    def __init__(self, spaces: list[Space], idf: np.ndarray):
        self.spaces, self.idf = spaces, idf
        self.vocabulary = sorted({w for s in spaces for w in s.vocabulary})
        # The last entry stands for words of no item.
        self.codes = [np.array([*(s.place.get(w, -1) for w in self.vocabulary), -1], np.int64) for s in spaces]

    def hits(self, texts: pa.Array) -> list[tuple[int, int, float, float, float]]:
        """(text, item_id, cosine, share of the item, share of its answer) of what is confirmed, once a text and item."""
        offsets, flat = words_of(texts)
        codes = pc.index_in(flat, value_set=pa.array(self.vocabulary, pa.string()))
        codes = pc.fill_null(codes, -1).to_numpy(zero_copy_only=False)
        weighed = Words(offsets, hash_strings(flat), self.idf)
        passages = {length: Passages(weighed, length) for length in {s.length for s in self.spaces}}
        out = []
        for space, own in zip(self.spaces, self.codes, strict=True):
            best: dict[tuple[int, int], tuple[float, float, float]] = {}
            words: dict[int, list[str]] = {}
            for t, start, k, cosine in space.candidates(own[codes], passages[space.length]):
                if t not in words:
                    words = {t: flat[int(offsets[t]) : int(offsets[t + 1])].to_pylist()}
                share, answer = match(space.items[k][1], words[t], start, space.length)
                if share >= LCS_SHARE and answer >= ANSWER_SHARE:
                    best[t, k] = max(best.get((t, k), (0.0, 0.0, 0.0)), (share, answer, cosine))
            out += [(t, space.items[k][0], c, s, a) for (t, k), (s, a, c) in sorted(best.items())]
        return out


def _places(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes) & np.uint64(PLACES - 1)).astype(np.int64)


def document_idf(texts: DataFrame) -> np.ndarray:
    """The idf of each place of the table of document counts, over all documents; tables are added up in two steps."""
    stripe = 1 << 15

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        df, n = np.zeros(PLACES, np.int64), 0
        for batch in slices(batches):
            offsets, flat = words_of(batch.column(0))
            text = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            df += np.bincount(np.unique(text * PLACES + _places(hash_strings(flat))) & (PLACES - 1), minlength=PLACES)
            n += batch.num_rows
        if n:
            k = PLACES // stripe
            parts = [df[i * stripe : (i + 1) * stripe].astype("<i4").tobytes() for i in range(k)]
            group = [TaskContext.get().partitionId() % 64] * k
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(k), pa.int32()), pa.array(group, pa.int32()), pa.array(parts, pa.binary()), pa.array([n] + [0] * (k - 1), pa.int64())],
                names=["stripe", "part", "df", "n"],
            )

    def adder(kind: str):
        def add(group: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(x, kind).astype("<i8") for x in group["df"])
            return group.iloc[:1].assign(df=[total.tobytes()], n=group["n"].sum())

        return add

    schema = "stripe int, part int, df binary, n long"
    added = texts.mapInArrow(run, schema).groupBy("stripe", "part").applyInPandas(adder("<i4"), schema)
    added = added.groupBy("stripe").applyInPandas(adder("<i8"), schema)
    df, n = np.zeros(PLACES, np.int64), 0
    for row in added.collect():
        df[row["stripe"] * stripe : (row["stripe"] + 1) * stripe] = np.frombuffer(row["df"], "<i8")
        n += row["n"]
    return np.log((2 + n) / (1 + df)).astype(np.float32)


def randomised_basis(rows: DataFrame, width: int, rank: int, rounds: int = 2, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors (width x rank) of the sparse rows (place array<int>, value array<float>).

    Each round multiplies the matrix and its transpose with a thin block: tasks add up
    their rows' share, shares are summed by stripes of 4096 rows of the block.
    """
    thin = min(width, rank + 10)
    block = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, thin)))[0]
    stripe = 4096

    def product(block: np.ndarray, gram: bool) -> np.ndarray:
        height = thin if gram else width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, some = np.zeros((height, thin)), False
            for batch in batches:
                for place, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    y = np.asarray(value) @ block[place]
                    if gram:
                        total += np.outer(y, y)
                    else:
                        np.add.at(total, place, np.outer(value, y))
                    some = True
            if some:
                n = range(0, height, stripe)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i // stripe for i in n], pa.int32()), pa.array([total[i : i + stripe].tobytes() for i in n], pa.binary())], names=["stripe", "part"]
                )

        def add(group: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"stripe": group["stripe"].iloc[:1], "part": [sum(np.frombuffer(p) for p in group["part"]).tobytes()]})

        parts = rows.mapInArrow(run, "stripe int, part binary").groupBy("stripe").applyInPandas(add, "stripe int, part binary")
        out = np.zeros((height, thin))
        for row in parts.collect():
            got = np.frombuffer(row["part"]).reshape(-1, thin)
            out[row["stripe"] * stripe : row["stripe"] * stripe + len(got)] = got
        return out

    for _ in range(rounds):
        block = np.linalg.qr(product(block, False))[0]
    values, turn = np.linalg.eigh(product(block, True))
    keep = np.argsort(-values)[:rank]
    return block @ turn[:, keep[values[keep] > 1e-9 * values.max()]]


def fit_blocks(docs: DataFrame, benchmark: DataFrame) -> Iterator[Spaces]:
    """The fitted spaces of the benchmark's blocks, as many together as one pass takes."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = F.size(F.split("text", r"\s+"))
    items = items.withColumn("length", F.coalesce(*[F.when(n <= most, length) for length, most in CLASSES if most], F.lit(CLASSES[-1][0])))
    step = F.col("length") / 2
    sizes = items.groupBy("length").agg(F.sum(F.greatest(F.lit(1), F.ceil((n - step) / step))).alias("n")).orderBy("length").collect()
    blocks = [(r["length"], b, -(-r["n"] // RANK)) for r in sizes for b in range(-(-r["n"] // RANK))]
    if not blocks:
        return
    idf = document_idf(docs.select("text"))
    spaces: list[Space] = []
    for k, (length, b, of) in enumerate(blocks):
        rows = items.where((F.col("length") == length) & (F.pmod(F.xxhash64("item_id", "text"), F.lit(of)) == b)).orderBy("item_id", "text").collect()
        offsets, flat = words_of(pa.array([r["text"] for r in rows], pa.string()))
        flat = flat.to_pylist()
        some = [(r["item_id"], flat[a:z]) for r, a, z in zip(rows, offsets[:-1], offsets[1:], strict=True) if z > a]
        if some:
            space = Space(some, idf, length)
            with scratch():
                matrix = spark.createDataFrame(space.rows(), "place array<int>, value array<float>").repartition(spark.sparkContext.defaultParallelism)
                space.keep(randomised_basis(saved(matrix, "item-passages"), len(space.vocabulary), len(space.passages)))
            spaces.append(space)
        if spaces and (len(spaces) == BLOCKS_A_PASS or k == len(blocks) - 1):
            yield Spaces(spaces, idf)
            spaces = []


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, item_id, cosine, lcs_share and answer_share of each confirmed pair."""
    kind = docs.schema[key].dataType
    found = docs.sparkSession.createDataFrame([], f"{key} {kind.simpleString()}, {HITS}")
    for spaces in fit_blocks(docs, benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(spaces)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                if rows := sent.value.hits(batch.column(1)):
                    t, *rest = zip(*rows, strict=True)
                    kinds = [pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(t)), *(pa.array(c, k) for c, k in zip(rest, kinds, strict=True))],
                        names=[key, "item_id", "cosine", "lcs_share", "answer_share"],
                    )

        found = found.unionByName(docs.select(key, "text").mapInArrow(run, found.schema))
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a confirmed passage, with all their columns; nothing is shuffled."""
    filled = free_name(docs.columns, "filled")
    clean = docs.withColumn(filled, F.coalesce("text", F.lit("")))
    schema = clean.schema
    for spaces in fit_blocks(docs, benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(spaces)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, filled):
                good = np.ones(batch.num_rows, bool)
                good[[t for t, *_ in sent.value.hits(batch.column(batch.num_columns - 1))]] = False
                yield batch.filter(pa.array(good))

        clean = clean.mapInArrow(run, schema)
    return clean.drop(filled)


def op5_decontamination(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
