r"""Fuzzy line dedup: MinHash keys, edit similarity, one line a group.

Lines (cut at \n) are normalised: lower case, words without signs at their ends, one
blank between. Equal normalised lines are one node. Two nodes link when their edit similarity
(1 - Levenshtein distance / longer length, in characters) is at least 0.9. Pairs are tested when
they share a key: PAIR_KEYS keys of PAIR_ROWS minima each over the hashed pairs of words, and for
lines of at most SHORT characters, where one letter spoils a large part of the words, as many
over the hashed runs of three bytes. A pair whose features have Jaccard similarity J shares
one of k keys of r minima with chance 1 - (1 - J^r)^k, whatever the size of the input.
Of each connected group of lines the occurrence
with the smallest (doc_id, document key, line number) stays; all others go.

Edge cases: lines without a word are never touched; a null text is empty; a null doc_id
comes after all numbers; rows that repeat a doc_id and text are one document; an
empty table gives an empty table. A document whose last line with words goes has
empty text; the filter ``drop_lines`` then leaves it out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BitTable, doc_key, free_name, saved, scratch, worker_tables
from .linking import link, shared
from .words import drop_empty, hash_strings, mixed, offsets_of, slices, sums

#: Least edit similarity of linked lines.
SIMILARITY = 0.9
#: Keys of a line and minima a key, over pairs of words and, up to SHORT characters, over runs of three bytes.
PAIR_KEYS, PAIR_ROWS = 12, 4
RUN_KEYS, RUN_ROWS = 16, 5
SHORT = 64
#: SimHash bits by which two lines under a key may differ in each step of tests: like lines first, at last all.
STEPS = (4, 7, 10, 64)
#: Bins into which the characters of a line are counted.
BINS = 32
#: Text bytes that a worker takes at once.
SLICE_BYTES = 1 << 20
#: Signs that are cut from the ends of words.
SIGNS = ".,;:!?\"'()[]{}<>*#$%&|/\\-_=+~`^@"
LINES = "doc long, doc_id long, line int, node long, sim long, words string, chars int, keys array<long>"

#: Spreads the bits of a byte to eight byte-wide counters.
_LANES = np.array([sum((i >> k & 1) << 8 * k for k in range(8)) for i in range(256)], dtype=np.uint64)


def _lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Offsets of each text's lines, of each line's normalised words, and these words."""
    lists = pc.split_pattern(texts, "\n")
    words = pc.ascii_split_whitespace(pc.utf8_lower(lists.flatten()))
    flat = pc.ascii_trim(words.flatten(), characters=SIGNS)
    return offsets_of(lists), *drop_empty(offsets_of(words), flat)


def _numbers(offsets: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The number of each line, from the hashes of its words and their places."""
    n = np.diff(offsets)
    place = np.arange(len(h), dtype=np.int64) - np.repeat(offsets[:-1], n)
    return mixed(sums(offsets, mixed(h + mixed(place.astype(np.uint64)))) + n.astype(np.uint64))


def simhashes(offsets: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The SimHash of each list of feature hashes; a bit that as many features have as not takes that of the list's first feature."""
    n = np.diff(offsets)
    # Eight counters fit in one 64-bit number as long as no part of a line has over 255 features.
    parts = np.maximum(1, (n + 254) // 255)
    first = np.cumsum(parts) - parts
    cuts = np.repeat(offsets[:-1], parts) + 255 * (np.arange(parts.sum()) - np.repeat(first, parts))
    cuts = np.append(cuts, offsets[-1] if len(offsets) else 0)
    sim = np.zeros(len(n), np.uint64)
    for byte in range(8):
        lanes = sums(cuts, _LANES[(h >> np.uint64(8 * byte)) & np.uint64(255)])
        each = lanes.view(np.uint8).reshape(-1, 8).astype(np.int64)
        ones = np.add.reduceat(each, first, axis=0) if len(first) else each
        own = (h[offsets[:-1]] >> np.uint64(8 * byte))[:, None] >> np.arange(8, dtype=np.uint64) & np.uint64(1)
        bits = (2 * ones + own.astype(np.int64) > n[:, None]) @ (1 << np.arange(8))
        sim |= bits.astype(np.uint64) << np.uint64(8 * byte)
    return sim


#: Odd factors; each puts the same hashes in another order.
_TURNS = np.random.default_rng(10).integers(1 << 62, size=(2, max(PAIR_KEYS * PAIR_ROWS, RUN_KEYS * RUN_ROWS)), dtype=np.uint64) * np.uint64(4) + np.uint64(1)


def _closed(offsets: np.ndarray, items: np.ndarray, ends: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and items with that many zeros after each list."""
    return offsets + ends * np.arange(len(offsets)), np.insert(items, np.repeat(offsets[1:], ends), 0)


def _minima(offsets: np.ndarray, hashes: np.ndarray, keys: int, rows: int, kind: int) -> np.ndarray:
    """MinHash keys (lists x keys) of lists that are not empty."""
    out = np.empty((len(offsets) - 1, keys), np.uint64)
    for k in range(keys):
        key = np.full(len(offsets) - 1, 2 * k + kind, np.uint64)
        for turn in _TURNS[kind, k * rows : (k + 1) * rows]:
            key = mixed(key + np.minimum.reduceat(hashes * turn, offsets[:-1]))
        out[:, k] = key
    return out


def _signatures(offsets: np.ndarray, words: pa.Array, h: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """SimHash, text, characters and MinHash keys of normalised lines that have words."""
    lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), words)
    lines = pc.binary_join(lists, " ")
    chars = pc.utf8_length(lines)
    if not len(lines):
        return pa.array([], pa.int64()), lines, chars, pa.array([], pa.list_(pa.int64()))
    sim = simhashes(offsets, h)
    ends, h = _closed(offsets, h, 1)
    before = np.concatenate([np.zeros(1, np.uint64), h[:-1]])
    pairs = _minima(ends, mixed(mixed(before) + h), PAIR_KEYS, PAIR_ROWS, 0)
    short = chars.to_numpy(zero_copy_only=False) <= SHORT
    size = np.where(short, PAIR_KEYS + RUN_KEYS, PAIR_KEYS)
    place = np.cumsum(size) - size
    flat = np.empty(size.sum(), np.uint64)
    flat[place[:, None] + np.arange(PAIR_KEYS)] = pairs
    if short.any():
        some = lines.filter(pa.array(short))
        at = np.concatenate([[0], np.cumsum(pc.binary_length(some).to_numpy(zero_copy_only=False))]).astype(np.int64)
        raw = np.frombuffer("".join(some.to_pylist()).encode(), np.uint8).astype(np.uint64)
        at, raw = _closed(at, raw, 2)
        padded = np.concatenate([np.zeros(2, np.uint64), raw])
        runs = padded[:-2] << np.uint64(16) | padded[1:-1] << np.uint64(8) | raw
        flat[place[short][:, None] + PAIR_KEYS + np.arange(RUN_KEYS)] = _minima(at, mixed(runs + np.uint64(1)), RUN_KEYS, RUN_ROWS, 1)
    keys = pa.ListArray.from_arrays(pa.array(np.append(place, len(flat)).astype(np.int32)), _signed(flat))
    return _signed(sim), lines, chars, keys


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, doc_id, line, node and sim of every line with words; its words, characters and keys where the task meets it first."""
    worker_tables("lines")
    seen: set[int] = set()
    for batch in slices(batches, limit=SLICE_BYTES):
        per_doc, offsets, words = _lines(batch.column(2))
        docs = np.repeat(np.arange(batch.num_rows), np.diff(per_doc))
        line = np.arange(len(docs)) - np.repeat(per_doc[:-1], np.diff(per_doc))
        full = np.flatnonzero(np.diff(offsets) > 0)
        # Lines without words add nothing to the words, so their offsets can go.
        offsets = np.append(offsets[:-1][full], offsets[-1])
        hashes = hash_strings(words)
        node = _numbers(offsets, hashes)
        new = np.zeros(len(node), bool)
        for i, x in enumerate(node.tolist()):
            if x not in seen:
                seen.add(x)
                new[i] = True
        sim, text, chars, keys = _signatures(*_picked(offsets, words, hashes, new))
        back = np.cumsum(new) - 1
        at = pa.array(np.where(new, back, 0), mask=~new)
        docs = pa.array(docs[full])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(docs), batch.column(1).take(docs), pa.array(line[full].astype(np.int32)), _signed(node),
                sim.take(at), text.take(at), chars.take(at), keys.take(at),
            ],
            names=["doc", "doc_id", "line", "node", "sim", "words", "chars", "keys"],
        )


def _picked(offsets: np.ndarray, words: pa.Array, hashes: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Offsets, words and their hashes of some of the lists."""
    if some.all():
        return offsets, words, hashes
    n = np.diff(offsets)
    each = np.repeat(some, n)
    return np.concatenate([[0], np.cumsum(n[some])]), words.filter(pa.array(each)), hashes[each]


def _counts(texts: pa.Array) -> pa.Array:
    """How many characters of each text fall into each bin, by their code's remainder."""
    codes = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32)
    rows = np.repeat(np.arange(len(texts)), pc.utf8_length(texts).to_numpy(zero_copy_only=False))
    flat = np.bincount(rows * BINS + codes % BINS, minlength=len(texts) * BINS).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BINS, dtype=np.int32)), pa.array(flat))


def _among(table: BitTable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows whose node may be in the table, with their counts of characters."""
        worker_tables("lines")
        for batch in slices(batches, "words", SLICE_BYTES):
            batch = batch.filter(pa.array(table.has(batch.column(0).to_numpy())))
            yield pa.RecordBatch.from_arrays([*batch.columns, _counts(batch.column(1))], names=["node", "words", "counts"])

    return run


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance; equal ends are cut, then a column of the table is kept in the bits of two numbers."""
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    i = 0
    while i < min(len(a), len(b)) and a[-1 - i] == b[-1 - i]:
        i += 1
    a, b = a[: len(a) - i], b[: len(b) - i]
    if not a or not b:
        return len(a) + len(b)
    masks: dict[str, int] = {}
    for k, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << k
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, score = full, 0, len(a)
    for c in b:
        eq = masks.get(c, 0)
        cross = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | ~(cross | up) & full, up & cross
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 | 1, minus << 1
        up, down = (minus | ~((eq | down) | plus)) & full, plus & (eq | down) & full
    return score


#: Cells of a table and letters of lines that are worked on at once, and the distance from which a pair is taken alone.
CELLS, LETTERS, FAR = 1 << 16, 1 << 20, 500


def alike(xs: list[str], ys: list[str], least: float = SIMILARITY) -> np.ndarray:
    """Which pairs of lines reach the edit similarity. Pairs whose words differ in their places only are proven by these words."""
    good, rest = np.zeros(len(xs), bool), []
    for i, (a, b) in enumerate(zip(xs, ys, strict=True)):
        most = int((1 - least) * max(len(a), len(b)) + 1e-9)
        if abs(len(a) - len(b)) > most:
            continue
        x, y = a.split(" "), b.split(" ")
        if len(x) == len(y):  # these changes bound the distance from above
            bound = 0
            for p, q in zip(x, y, strict=True):
                if p != q:
                    bound += edit_distance(p, q)
                    if bound > most:
                        break
            else:
                good[i] = True
                continue
        if most > FAR:
            good[i] = edit_distance(a, b) <= most
        else:
            rest.append((i, *_middles(a, b), most))
    rest.sort(key=lambda r: len(r[1]))
    while rest:
        # Distances grow with lengths, so the last of the first pairs bounds how many go together.
        n = max(1, min(len(rest), CELLS // (2 * max(r[3] for r in rest[: CELLS // 64]) + 1)))
        n = max(1, min(n, LETTERS // max(1, len(rest[n - 1][1]))))
        some, rest = rest[:n], rest[n:]
        good[[r[0] for r in some]] = _within([r[1] for r in some], [r[2] for r in some], np.array([r[3] for r in some]))
    return good


def _middles(a: str, b: str) -> tuple[np.ndarray, np.ndarray]:
    """The code points of two lines without the ends that are equal."""
    x, y = (np.frombuffer(z.encode("utf-32-le"), np.uint32) for z in (a, b))
    n = min(len(x), len(y))
    odd = np.flatnonzero(x[:n] != y[:n])
    k = int(odd[0]) if len(odd) else n
    x, y, n = x[k:], y[k:], n - k
    odd = np.flatnonzero(x[::-1][:n] != y[::-1][:n])
    k = int(odd[0]) if len(odd) else n
    return x[: len(x) - k], y[: len(y) - k]


def _within(xs: list[np.ndarray], ys: list[np.ndarray], most: np.ndarray) -> np.ndarray:
    """Which pairs have at most that edit distance: of each pair's table the band near the diagonal, for all pairs row by row."""
    k = int(most.max())
    la, lb = (np.array([len(x) for x in z]) for z in (xs, ys))
    a = np.zeros((len(xs), la.max()), np.uint32)
    b = np.full((len(xs), la.max() + 2 * k + 1), 0xFFFFFFFF, np.uint32)
    for r, (x, y) in enumerate(zip(xs, ys, strict=True)):
        a[r, : len(x)], b[r, k : k + len(y)] = x, y
    # Cells outside the table count as far, which no row brings into doubt.
    kind = np.int16 if la.max() < 10_000 else np.int32
    step, far = np.arange(2 * k + 1, dtype=kind), kind(20_000 if kind is np.int16 else 1 << 20)
    row = np.broadcast_to(np.where(step >= k, step - k, far).astype(kind), (len(xs), 2 * k + 1)).copy()
    ids = np.arange(len(xs))
    good = (la == 0) & (lb <= most)
    for i in range(la.max()):
        new = row + (b[:, i : i + 2 * k + 1] != a[:, i : i + 1])
        np.minimum(new[:, :-1], row[:, 1:] + 1, out=new[:, :-1])
        row = np.minimum.accumulate(new - step, axis=1) + step
        done = la == i + 1
        if done.any():
            good[ids[done]] = row[done, lb[done] - la[done] + k] <= most[done]
        if done.any() or i % 16 == 15:  # those at their end, and those that cannot come back below, need no more rows
            on = ~done & (row.min(axis=1) <= most)
            if not on.all():
                row, a, b, la, lb, most, ids = row[on], a[on], b[on], la[on], lb[on], most[on], ids[on]
                if not len(ids):
                    break
    return good


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_tables("lines")
    for batch in slices(batches, "x", SLICE_BYTES):
        a, b, x, y = batch.columns
        kept = pa.array(alike(x.to_pylist(), y.to_pylist()))
        yield pa.RecordBatch.from_arrays([a.filter(kept), b.filter(kept)], names=["a", "b"])


def dropped_lines(docs: DataFrame) -> DataFrame:
    """doc (its key), doc_id and drops, the numbers of the lines that go, for documents that lose any; a saved table."""
    with scratch():
        source = docs.select(doc_key().alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), "text")
        lines = saved(source.mapInArrow(_describe, LINES), "lines")
        new = lines.where("keys is not null")
        rows = shared(new.select(F.explode("keys").alias("key"), "node")).dropDuplicates(["key", "node"])
        rows = saved(rows, "shared-keys")
        told = new.select("node", "sim", "chars").dropDuplicates(["node"])
        rows = saved(rows.join(told, "node").select("key", "node", "sim", "chars"), "line-keys")
        table = BitTable(rows.select("node").distinct())
        texts = new.select("node", "words").mapInArrow(_among(table), "node long, words string, counts array<int>")
        texts = saved(texts.dropDuplicates(["node"]), "line-texts")

        def may(x, y):
            return F.abs(x("chars") - y("chars")) <= (1 - SIMILARITY) * F.greatest(x("chars"), y("chars")) + 1e-9

        def may_far(x, y):
            # An edit moves the counts of two bins by one each, or of one bin and the length.
            moved = F.aggregate(F.zip_with(x("counts"), y("counts"), lambda m, n: F.abs(m - n)), F.lit(0), lambda a, n: a + n)
            return moved + F.abs(x("chars") - y("chars")) <= 2 * ((1 - SIMILARITY) * F.greatest(x("chars"), y("chars")) + 1e-9)

        def bits(x, y):
            return F.bit_count(x("sim").bitwiseXOR(y("sim")))

        def verify(pairs: DataFrame) -> DataFrame:
            full = pairs.join(texts.select(F.col("node").alias("a"), F.col("words").alias("x")), "a")
            full = full.join(texts.select(F.col("node").alias("b"), F.col("words").alias("y")), "b")
            return saved(full.select("a", "b", "x", "y").mapInArrow(_verify, "a long, b long"), "line-links")

        roots = link(rows, ["sim"], "sim", may, verify, bits, STEPS, texts.select("node", "counts"), may_far)
        # A null doc_id sorts after every number.
        spot = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc", "line")
        nodes = lines.groupBy("node").agg(F.min(spot).alias("first"), F.count("*").alias("copies"))
        named = nodes.join(roots, "node", "left").where("copies > 1 or root is not null")
        named = saved(named.select("node", "first", F.coalesce("root", "node").alias("root")), "line-groups")
        firsts = named.groupBy("root").agg(F.min("first").alias("keep"))
        named = named.join(firsts, "root").select("node", "keep")
        gone = lines.select("node", "doc", "doc_id", "line").join(named, "node")
        gone = gone.where((F.col("doc") != F.col("keep.doc")) | (F.col("line") != F.col("keep.line")))
        gone = gone.groupBy("doc").agg(F.min("doc_id").alias("doc_id"), F.collect_set("line").alias("drops"))
        return saved(gone, "drops", outer=True)


def _without_drops(docs: DataFrame) -> tuple[DataFrame, str, str, str]:
    """docs with the text that is left, and the names of three new columns: the row as it was, its lines, and how many went."""
    drops = dropped_lines(docs)
    row, gone, n = (free_name(docs.columns, c) for c in ("row", "gone", "n"))
    drops = drops.select(F.col("doc").alias("doc"), F.col("drops").alias(gone))
    rows = docs.select(doc_key().alias("doc"), F.struct(*docs.columns).alias(row)).join(drops, "doc", "left")
    rows = rows.withColumn("cut", F.expr(rf"split(coalesce({row}.text, ''), '\n', -1)"))
    left = f"transform(array_except(sequence(0, size(cut) - 1), {gone}), i -> get(cut, i))"
    text = F.expr(f"if({gone} is null, {row}.text, array_join({left}, '\n'))")
    rows = rows.select(row, text.alias("text"), F.size("cut").cast("long").alias(n), F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(gone))
    return rows, row, n, gone


def deduped(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the text that is left, for every row of docs."""
    rows, row, n, gone = _without_drops(docs)
    return rows.select(F.col(row)["doc_id"].alias("doc_id"), F.col(n).alias("n_lines"), F.col(gone).alias("n_dropped"), "text")


def drop_lines(docs: DataFrame) -> DataFrame:
    """The documents with their repeated lines gone, with all their columns; one that had words and has none left goes."""
    rows, row, _, gone = _without_drops(docs)
    left = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    columns = [F.col("text") if c.lower() == "text" else F.col(row)[c].alias(c) for c in docs.columns]
    return rows.where((F.col(gone) == 0) | left).select(*columns)


def op10_line_dedup(spark, sf_dir) -> DataFrame:
    return deduped(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
