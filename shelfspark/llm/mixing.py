"""Mixing sources to target weights by the cube method.

Targets: sources in code-point order weigh 5, 2, 1, repeating, and share all words; no
source gives more than three times what it has, and what it cannot give is shared out
again by weight. The limits in order of size over weight, with running sums, show in one
pass which sources are full and what the others get a weight.

Documents: each document of a source is wanted target / size times. The whole part is
taken for sure; the fraction is a probability, and the cube method turns these
probabilities into 0 or 1 so that the source's number of words and of documents stay what
they were expected to be. Flight: the longest undecided document and a spread over all
shorter ones make a direction that changes neither total; the probabilities move along it,
up or down by chance, until one is decided. Where the shorter ones cannot balance it in
both totals, the words are kept. Blocks of some thousand documents of one source fly on
their own and leave two undecided, mostly the shortest; those of all blocks of the source and a
block that waited fly again, until one block is left. Landing: in the last block, a document too long for the
shorter ones to balance both ways is decided in a way that they can make up for, so the words come as near to the
target as the documents of the source allow; the last one, a short one, goes to the nearer side.

Edge cases: a null text has no words; documents without words fly like any other, and take
nothing; a null source is a source of its own, the last; rows that repeat a doc_id and a
size are told apart by a running number, since any of them may be taken for another; null
doc_ids are documents; empty tables, and sources without words, take nothing. Only doc_id,
source and text are read. A block is chosen by a hash over documents and running numbers
and the chance by the block, so the result is the same on every run and any cluster.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, scratch
from .prefix_trie import WORDS
from .running import running

WEIGHTS = (5, 2, 1)
#: No document is taken more often.
MOST = 3
#: Documents of one source that fly together, on average.
BLOCK = 512
#: Sources of so many rows at most are broadcast to the documents; more are joined by shuffle.
BROADCAST_SOURCES = 1_000_000
#: A probability this close to 0 or 1 is decided.
CLOSE = 1e-9

_UNIT = "source string, doc_id long, size long, copy long, p double"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, n, source_size, target and full of every source, from rows of (source, size)."""
    totals = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    # Sources are numbered in order over ranges, so there may be any number of them.
    totals = running(totals.withColumns({"one": F.lit(""), "i": F.lit(1).cast("long")}), "one", [F.col("source").asc_nulls_last()], ["i"], name="sources")
    place = ((F.col("i_run") - 1) % len(weights)).cast("int")
    totals = totals.select("one", "source", "n", "source_size", F.get(F.array(*[F.lit(w).cast("long") for w in weights]), place).alias("weight"))
    every = totals.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    size, weight = int(every[0]), int(every[1])
    limit = F.col("source_size") * most
    ranked = totals.withColumns({"limit": limit, "ratio": limit / F.col("weight")})
    ranked = running(ranked, "one", [F.col("ratio"), F.col("source").asc_nulls_last()], ["limit", "weight"], name="limits")
    # What is left, and the weights that share it, if all sources with smaller limits a weight are full.
    wide = lambda c: c.cast("decimal(38,0)")
    left = F.lit(size).cast("decimal(38,0)") - wide(F.col("limit_run") - F.col("limit"))
    share = F.lit(weight).cast("long") - (F.col("weight_run") - F.col("weight"))
    fits = wide(F.col("limit")) * share.cast("decimal(18,0)") >= left * F.col("weight").cast("decimal(18,0)")
    level = ranked.where(fits).agg(F.min_by(F.struct(left.cast("double").alias("left"), share.cast("double").alias("share")), F.struct("ratio", F.col("source").isNull(), "source"))).first()[0]
    rate = level["left"] / level["share"] if level else 0.0
    full = F.col("limit") <= F.col("weight") * F.lit(rate)
    return ranked.select("source", "n", "source_size", F.when(full, F.col("limit").cast("double")).otherwise(F.col("weight") * F.lit(rate)).alias("target"), full.alias("full"))


def _reach(p: np.ndarray, move: np.ndarray) -> tuple[float, float]:
    """How far the probabilities can go along a direction, and against it."""
    move = np.where(move == 0, 1e-300, move)
    to_one, to_zero = (1 - p) / move, -p / move
    return float(np.maximum(to_one, to_zero).min()), float(-np.minimum(to_one, to_zero).max())


def _direction(size: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, float, float]:
    """A direction that moves the first (longest) document by 1 and spreads what balances it over all others, and its reach.

    It keeps words and number of documents. Where the others cannot make up for the first one so (they are of about one
    length), it keeps the words alone; where they have no words, the number.
    """
    a, rest, q, move = size[0], size[1:], p[1:], np.ones(len(p))
    w = q * (1 - q)
    v = w * rest
    w0, w1, w2 = float(w.sum()), float(v.sum()), float(v @ rest)
    if w1 == 0:
        move[1:] = w * (-1 / w0)
        return move, *_reach(p, move)
    det = w0 * w2 - w1 * w1
    if det > 1e-9 * w0 * w2:
        move[1:] = w * ((w1 * a - w2) / det) + v * ((w1 - w0 * a) / det)
        up, down = _reach(p, move)
        if up >= 1 - p[0] and down >= p[0]:
            return move, up, down
    move[1:] = w * (-a / w1)
    return move, *_reach(p, move)


def _landed(size: np.ndarray, p: np.ndarray, chance: random.Random) -> np.ndarray:
    """The first document decided although the others cannot balance both ways; they make up for it as far as they can.

    Of the ways that they can make up for, its probability chooses; if there is none, the nearer one is taken.
    """
    rest, q = size[1:], p[1:]
    more, less = size[0] * (1 - p[0]), size[0] * p[0]  # words to be given up if it is taken, to be taken if not
    give, take = float(rest @ q), float(rest @ (1 - q))
    lack_up, lack_down = max(0.0, more - give), max(0.0, less - take)
    up = chance.random() < p[0] if lack_up == lack_down == 0 else lack_up < lack_down
    if up:
        return np.concatenate([[1.0], q * (1 - min(1.0, more / give)) if give else q])
    return np.concatenate([[0.0], 1 - (1 - q) * (1 - min(1.0, less / take)) if take else q])


def fly(sizes: list[int], p: list[float], chance: random.Random, land: bool = False) -> list[float]:
    """The probabilities after the flight of documents from long to short: at most two are left between 0 and 1; with land, none."""
    out = np.array(p, float)
    left = np.flatnonzero((out > 0) & (out < 1))
    size, now = np.array(sizes, float)[left], out[left]
    held = 0
    while len(now) > (0 if land else max(1, 2 - held)):
        if not land and size[0] > 0 and size[1] == 0:
            # Nothing is left that could balance its words: it waits while the others fly.
            held, left, size, now = held + 1, left[1:], size[1:], now[1:]
            continue
        move, up, down = _direction(size, now) if len(now) > 1 else (None, 0.0, 0.0)
        if size[0] == 0 and len(now) == 1:
            now = np.array([float(chance.random() < now[0])])
        elif land and size[0] > 0 and not (up >= 1 - now[0] and down >= now[0]):
            now = _landed(size, now, chance)
        else:
            now = now + move * (up if chance.random() * (up + down) < down else -down)
        now[now < CLOSE] = 0.0
        now[now > 1 - CLOSE] = 1.0
        out[left] = now
        flying = (now > 0) & (now < 1)
        left, size, now = left[flying], size[flying], now[flying]
    return out.tolist()


def _flight(level: int, seed: int):
    def flight(table: pa.Table) -> pa.Table:
        """One block of a source: long documents first, ties by number and copy. The first of several blocks waits for the next round."""
        rows = sorted(table.to_pylist(), key=lambda r: (-r["size"], r["doc_id"] is not None, r["doc_id"] or 0, r["copy"]))
        first = rows[0]
        chance = random.Random(f"{seed}/{level}/{first['source']!r}/{first['block']}")
        p = [r["p"] for r in rows]
        if first["block"] > 0 or first["blocks"] == 1:
            p = fly([r["size"] for r in rows], p, chance, land=first["blocks"] == 1)
        columns = {c: [r[c] for r in rows] for c in ("source", "doc_id", "size", "copy")} | {"p": p}
        types = [("source", pa.string()), ("doc_id", pa.int64()), ("size", pa.int64()), ("copy", pa.int64()), ("p", pa.float64())]
        return pa.table(columns, schema=pa.schema(types))

    return flight


def _dealt(units: DataFrame, counts: DataFrame, few: bool, level: int) -> DataFrame:
    """units with the number of blocks of their source and their own one."""
    number = F.when(F.col("open") <= 2 * BLOCK, 1).otherwise(F.ceil(F.col("open") / BLOCK)).cast("long")
    named = counts.select(F.col("source").alias("s"), number.alias("blocks"))
    dealt = units.join(F.broadcast(named) if few else named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    return dealt.withColumn("block", F.pmod(F.xxhash64(F.lit(level), "doc_id", "size", "copy"), F.col("blocks")))


def cube(units: DataFrame, seed: int = 0) -> DataFrame:
    """(source, doc_id, size, copy, p) with p decided to 0 or 1 in balance within each source.

    In a round all blocks of a source but one fly and leave at most two undecided documents each; the block that waits
    gives the next round documents of all lengths, with which the left ones can be balanced. The last block lands.
    """
    decided, level = [], 0
    while True:
        counts = saved(units.groupBy("source").agg(F.count("*").alias("open")), "open")
        most, sources = counts.agg(F.max("open"), F.count("*")).first()
        flown = _dealt(units, counts, sources <= BROADCAST_SOURCES, level).groupBy("source", "block").applyInArrow(_flight(level, seed), _UNIT)
        flown = saved(flown, f"flight-{level}")
        decided.append(flown.where("p in (0, 1)"))
        if (most or 0) <= 2 * BLOCK:
            break
        units, level = flown.where("p not in (0, 1)"), level + 1
    total = decided[0]
    for more in decided[1:]:
        total = total.unionByName(more)
    return total


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target and times (how often it is taken) of every row."""
    with scratch():
        size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORDS)).cast("long")
        rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), size.alias("size"))
        rows = rows.withColumns({"copy": F.lit(1).cast("long"), "any": F.monotonically_increasing_id()})
        # Equal rows are numbered; which of them gets which number makes no difference.
        same = F.concat_ws("/", F.coalesce(F.hex("source"), F.lit("-")), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("size").cast("string"))
        rows = running(rows.withColumn("same", same), "same", [F.col("any")], ["copy"], name="documents")
        rows = saved(rows.select("source", "doc_id", "size", F.col("copy_run").alias("copy")), "sizes")
        sources = saved(targets(rows, weights, most), "targets")
        few = sources.count() <= BROADCAST_SOURCES
        named = sources.select(F.col("source").alias("s"), "source_size", "target", "full")
        rows = rows.join(F.broadcast(named) if few else named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
        wanted = F.when(F.col("source_size") == 0, 0.0).when(F.col("full"), float(most)).otherwise(F.col("target") / F.col("source_size"))
        rows = saved(rows.withColumn("sure", F.floor(wanted)).withColumn("p", wanted - F.col("sure")), "wanted")
        # Sources whose documents are all taken a whole number of times have nothing to draw.
        whole = F.col("p").between(CLOSE, 1 - CLOSE)
        drawn = cube(rows.where(whole).select("source", "doc_id", "size", "copy", "p"), seed)
        drawn = drawn.join(F.broadcast(named) if few else named, F.col("source").eqNullSafe(F.col("s")))
        sure = F.floor(F.col("target") / F.col("source_size"))
        out = ["doc_id", "source", "size", "source_size", "target"]
        done = rows.where(~whole).select(*out, (F.col("sure") + F.round("p")).cast("long").alias("times"))
        return saved(done.unionByName(drawn.select(*out, (sure + F.col("p")).cast("long").alias("times"))), "mix", outer=True)


def op12_mixing(spark, sf_dir) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))
