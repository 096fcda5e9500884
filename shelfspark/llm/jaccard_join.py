"""N-gram Jaccard join by rare-first prefixes, grouped to components.

A document's set is its distinct five-word shingles as 64-bit hashes; documents with
equal sets are one class, and classes link at a Jaccard similarity of 0.75. Shingles
are ordered by how common they are (rarest first; the common ones are counted, all
others tie at zero and go by hash), and each class gives its first
n - ceil(0.75 n) + 1 shingles as keys: linked classes share one. Pairs under a key pass
a length filter, a positional filter and a filter on how many keys anyone shares, become distinct, pass a suffix filter on the
sorted sets and are then counted exactly, once a pair.

The table of common shingles is a broadcast of at most MOST_COMMON rows whatever the
input; it only orders keys, so results do not depend on it.

Edge cases: with under five words all words are one shingle; without words the set is
empty, n_shingles is 0 and the document stays by itself; a null doc_id is grouped but
never names a component; rows that repeat come back once each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BitTable, free_name, saved, scratch
from .linking import link, shared
from .words import distinct_sorted, hash_strings, mixed, shingles, slices, split_words, sums

#: Shingles gathered before a task counts which of them come in several documents.
COUNT_AT = 2 << 20
#: Rows of the table of common shingles, at most.
MOST_COMMON = 1 << 17


def _sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, sorted distinct shingles and class number of each text of the batch."""
    offsets, words = split_words(batch.column(batch.schema.get_field_index("text")))
    offsets, items = distinct_sorted(*shingles(offsets, hash_strings(words)))
    n = np.diff(offsets).astype(np.uint64)
    classes = mixed(sums(offsets, mixed(items ^ np.uint64(0xA5A5A5A5A5A5A5A5))) + n * np.uint64(0x9E3779B97F4A7C15))
    return offsets, items, classes


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document (kind 0), and one for each shingle that came twice or more in a stretch (kind 1)."""
    names = ["kind", "doc_id", "node", "n"]
    held: list[np.ndarray] = []
    seen: set[int] = set()

    def common():
        items, counts = np.unique(np.concatenate(held), return_counts=True)
        many = counts > 1
        n = int(many.sum())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ones(n, np.int32)), pa.nulls(n, pa.int64()), _signed(items[many]), pa.array(counts[many].astype(np.int64))], names=names
        )

    size = 0
    for batch in slices(batches):
        offsets, items, classes = _sets(batch)
        k = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(k, np.int32)), batch.column(0), _signed(classes), pa.array(np.diff(offsets).astype(np.int64))], names=names
        )
        for i, c in enumerate(classes.tolist()):
            if c not in seen and offsets[i + 1] > offsets[i]:
                seen.add(c)
                held.append(items[offsets[i] : offsets[i + 1]])
                size += len(held[-1])
        if size >= COUNT_AT:
            yield common()
            held, size = [], 0
            seen.clear()
    if held:
        yield common()


def _common(signed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most common shingles in order of hash, with their counts; at most MOST_COMMON."""
    counts = saved(signed.where("kind = 1").groupBy("node").agg(F.sum("n").alias("n")).where("n >= 8"), "common")
    sizes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("level")).count().collect()
    level, total = 62, 0
    for row in sorted(sizes, key=lambda r: -r["level"]):
        if total + row["count"] > MOST_COMMON:
            break
        level, total = row["level"], total + row["count"]
    rows = counts.where(F.col("n") >= F.lit(1 << level)).collect() if total else []
    items = np.array([r["node"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(items)
    return items[order], np.array([r["n"] for r in rows], np.int64)[order]


def _prefixes(common: np.ndarray, counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keys of each class that this task has not met before."""
        seen: set[int] = set()
        for batch in slices(batches):
            offsets, items, classes = _sets(batch)
            fresh = np.zeros(len(classes), bool)
            for i, c in enumerate(classes.tolist()):
                if c not in seen:
                    seen.add(c)
                    fresh[i] = True
            if len(common):
                at = np.minimum(np.searchsorted(common, items), len(common) - 1)
                rank = np.where(common[at] == items, counts[at], 0)
                hit = sums(offsets, (rank > 0).astype(np.int64)) > 0
                for i in np.flatnonzero(hit & fresh):
                    a, b = offsets[i], offsets[i + 1]
                    order = np.argsort(rank[a:b], kind="stable")
                    items[a:b], rank[a:b] = items[a:b][order], rank[a:b][order]
            n = np.diff(offsets)
            p = np.where(fresh & (n > 0), n - (3 * n + 3) // 4 + 1, 0)
            ends = np.cumsum(p)
            pos = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - p, p)
            keys = items[np.repeat(offsets[:-1], p) + pos]
            # Where the prefix ends in the order of all shingles, coarsely: how common, then the top of the hash.
            last = np.maximum(offsets[:-1] + p - 1, 0)[p > 0]
            end = np.zeros(len(p), np.int32)
            common_there = rank[last] if len(common) else np.zeros(len(last), np.int64)
            # Beyond what the number can hold all places are one, and prefixes that end there count as tied.
            top = np.where(common_there < 32767, (items[last] >> np.uint64(48)).astype(np.int64), 0)
            end[p > 0] = np.minimum(common_there, 32767) << 16 | top
            yield pa.RecordBatch.from_arrays(
                [_signed(keys), _signed(np.repeat(classes, p)), *(pa.array(np.repeat(x, p).astype(np.int32)) for x in (n, end)), pa.array(pos.astype(np.int32))],
                names=["key", "node", "n", "end", "pos"],
            )

    return run


def _wanted_sets(table: BitTable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The set of each class that may be in the table, once a task."""
        seen: set[int] = set()
        for batch in slices(batches):
            offsets, items, classes = _sets(batch)
            nodes, sets = [], []
            for i in np.flatnonzero(table.has(classes)):
                if (c := int(classes[i])) not in seen:
                    seen.add(c)
                    nodes.append(classes[i])
                    sets.append(items[offsets[i] : offsets[i + 1]].tobytes())
            yield pa.RecordBatch.from_arrays([_signed(np.array(nodes, np.uint64)), pa.array(sets, pa.binary())], names=["node", "items"])

    return run


def _suffix_bound(x: np.ndarray, y: np.ndarray, depth: int = 2) -> int:
    """The most items two sorted sets can share, by cutting both at a middle item."""
    if not depth or not len(x) or not len(y):
        return min(len(x), len(y))
    i = len(x) // 2
    j = int(np.searchsorted(y, x[i]))
    k = int(j < len(y) and y[j] == x[i])
    return k + _suffix_bound(x[:i], y[:j], depth - 1) + _suffix_bound(x[i + 1 :], y[j + k :], depth - 1)


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether 100 * shared >= 75 * union for two sorted sets."""
    least = 75 * (len(x) + len(y))
    if 175 * min(len(x), len(y)) < least or 175 * _suffix_bound(x, y) < least:
        return False
    return 175 * len(np.intersect1d(x, y, assume_unique=True)) >= least


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, x, y = batch.columns
        good = [
            similar(np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64))
            for p, q in zip(x, y, strict=True)
        ]
        kept = pa.array(good, pa.bool_())
        yield pa.RecordBatch.from_arrays([a.filter(kept), b.filter(kept)], names=["a", "b"])


def _may(x, y):
    """Length filter, and the positional filter at a shared key: what both have from there on must suffice."""
    room = 1 + F.least(x("n") - x("pos") - 1, y("n") - y("pos") - 1)
    # At the first key that two linked classes share nothing before it counts, so the room bounds their shared items.
    # The prefix that ends first holds all that both share up to there, so only its keys that some
    # other class has too, and what comes after it, can be shared.
    most = (
        F.when(x("end") < y("end"), x("most")).when(x("end") > y("end"), y("most")).otherwise(F.greatest(x("most"), y("most")))
    )
    least = 75 * (x("n") + y("n"))
    return (4 * x("n") >= 3 * y("n")) & (4 * y("n") >= 3 * x("n")) & (175 * room >= least) & (175 * most >= least)


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, node (class number) and component_id of every row of docs."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = source.select("text")
    with scratch():
        signed = saved(source.mapInArrow(_sign, "kind int, doc_id long, node long, n long"), "signatures")
        rows = saved(signed.where("kind = 0").select("doc_id", "node", "n"), "sizes", outer=True)
        keys = texts.mapInArrow(_prefixes(*_common(signed)), "key long, node long, n int, end int, pos int")
        keys = saved(shared(keys).dropDuplicates(["key", "node"]), "shared-keys")
        # The most shingles that a class can share: its shared keys and all beyond its prefix.
        held = keys.groupBy("node").agg(F.count("*").cast("int").alias("held"))
        after = F.floor((3 * F.col("n") + 3) / 4).cast("int") - 1
        keys = saved(keys.join(held, "node").withColumn("most", F.col("held") + after).drop("held"), "prefix-keys")

        def verify(pairs: DataFrame) -> DataFrame:
            # Only the sets of these pairs are built again and moved.
            table = BitTable(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
            sets = texts.mapInArrow(_wanted_sets(table), "node long, items binary")
            sets = saved(sets.groupBy("node").agg(F.first("items").alias("items")), "sets")
            full = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
            full = full.join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b")
            return saved(full.select("a", "b", "x", "y").mapInArrow(_verify, "a long, b long"), "links")

        roots = link(keys, ["n", "end"], "most", _may, verify)
        classes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
        named = classes.join(roots, "node", "left").where("copies > 1 or root is not null")
        named = saved(named.select("node", "first", F.coalesce("root", "node").alias("root")), "classes")
        least = named.groupBy("root").agg(F.min("first").alias("component"))
        named = saved(named.join(least, "root").select("node", "component"), "components", outer=True)
    return rows.join(named, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "node",
        F.when(F.col("n") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents without the near copies: of each group the one with the smallest doc_id stays.

    Documents without words or without a doc_id stay.
    """
    gone = free_name(docs.columns, "gone")
    ids = jaccard_groups(docs).where("component_id <> doc_id").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(saved(ids, "near-copies"), docs["doc_id"].cast("long") == F.col(gone), "left_anti")


def op2_jaccard_join(spark, sf_dir) -> DataFrame:
    return jaccard_groups(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("node")
