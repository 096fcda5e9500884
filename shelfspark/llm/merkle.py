"""Merkle manifest of a dataset: leaves, roots, inclusion proofs and their verification.

Each source's leaves stand in order of doc_id and are hashed 16 at a time, level by level,
to the source's subroot; the subroots in order of source are hashed likewise to the root.

A superblock is 4096 consecutive nodes, three levels of 16. Going up, every superblock is
reduced to one node in a task of its own, and its node joins the next round; a round shrinks
its input 4096 times. Going down, the nodes of a superblock and the one row of outer nodes
that their proofs need (the path from the superblock's node to the root) are cogrouped by
superblock; ``applyInPandas`` finishes the local reduction, joins the proofs and folds them
in one step. The result of a round is the outer row of each superblock of the round below.

Edge cases: a null field is hashed as ``-``; a null source is a source of its own and the
first; null doc_ids come first in their source; equal doc_ids stand in order of their leaf,
so equal rows keep their own places and may be proved for one another; null and empty text
differ; a single leaf is its source's subroot and a single subroot the root; an empty table
has no manifest. Only doc_id, source, lang, n_chars and text are read. A source of any size
is spread over its superblocks; its leaves are numbered over ranges.
"""

from __future__ import annotations

import hashlib
import string

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, scratch
from .running import running

#: Nodes hashed together, and levels reduced in one superblock.
RUN, LEVELS = 16, 3
SUPER = RUN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODE = "key string, pos long, hash binary"
_PATH = "key string, block long, subroot binary, root binary, path binary, shape binary"


def encoded(columns: dict[str, Column]) -> Column:
    """The fields in order, each as its UTF-8 length, a colon and its value, or a hyphen if null."""
    parts = []
    for name in FIELDS:
        value = columns[name].cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.concat(*parts)


def leaf(docs: DataFrame, text: Column | None = None) -> Column:
    """The leaf of each row as 64 hex digits; with text, that text in place of the row's own."""
    columns = {name: docs[name] for name in FIELDS}
    return F.sha2(encoded(columns | ({"text": text} if text is not None else {})), 256)


def _levels(n: int) -> int:
    """How often n nodes are reduced until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


def _reduce(nodes: list[bytes]) -> list[bytes]:
    return [hashlib.sha256(b"".join(nodes[i : i + RUN])).hexdigest().encode() for i in range(0, len(nodes), RUN)]


def _hexed(hashes) -> list[bytes]:
    return [bytes(h).hex().encode() for h in hashes]


def _tree(frame: pd.DataFrame) -> list[list[bytes]]:
    """The levels of one superblock, whose nodes are sorted.

    Three levels are reduced; only the one superblock of a tree with fewer nodes stops at one node.
    """
    levels = [_hexed(frame["hash"])]
    for _ in range(LEVELS if frame["pos"].iloc[0] >= SUPER else _levels(len(frame))):
        levels.append(_reduce(levels[-1]))
    return levels


def _up(frame: pd.DataFrame) -> pd.DataFrame:
    """One superblock reduced to its node of the next round."""
    frame = frame.sort_values("pos")
    top = _tree(frame)[-1][0]
    return pd.DataFrame({"key": [frame["key"].iloc[0]], "pos": [frame["pos"].iloc[0] // SUPER], "hash": [bytes.fromhex(top.decode())]})


def _paths(frame: pd.DataFrame, outer: pd.Series) -> list[tuple[list[bytes], list[tuple[int, int]]]]:
    """Of each node in order: its siblings from here to the root, and how many stand left and right of the path on each level."""
    levels = _tree(frame)
    above = [outer["path"][i : i + 32].hex().encode() for i in range(0, len(outer["path"]), 32)]
    far = list(zip(outer["shape"][::2], outer["shape"][1::2], strict=True))
    out = []
    for i in range(len(frame)):
        siblings, shape, at = [], [], i
        for level in levels[:-1]:
            low = at - at % RUN
            run = level[low : low + RUN]
            siblings += run[: at - low] + run[at - low + 1 :]
            shape.append((at - low, len(run) - 1 - (at - low)))
            at //= RUN
        out.append((siblings + above, shape + far))
    return out


def fold(node: bytes, siblings: list[bytes], shape: list[tuple[int, int]]) -> bytes:
    """The root that a node and its siblings, all as hex digits, give."""
    at = 0
    for left, right in shape:
        node = hashlib.sha256(b"".join([*siblings[at : at + left], node, *siblings[at + left : at + left + right]])).hexdigest().encode()
        at += left + right
    return node


def _packed(paths) -> dict[str, list[bytes]]:
    return {
        "path": [bytes.fromhex(b"".join(siblings).decode()) for siblings, _ in paths],
        "shape": [bytes(x for pair in shape for x in pair) for _, shape in paths],
    }


def _down(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """The outer row of every superblock whose node is among these."""
    nodes, top = nodes.sort_values("pos"), outer.iloc[0]
    packed = _packed(_paths(nodes, top))
    return pd.DataFrame({"key": nodes["key"], "block": nodes["pos"], "subroot": top["subroot"], "root": top["root"], **packed})


def _prove(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Proof digest and folded root of every leaf of a superblock."""
    leaves, top = leaves.sort_values("pos"), outer.iloc[0]
    held = leaves["tampered"].where(leaves["tampered"].notna(), leaves["hash"])
    paths = _paths(leaves, top)
    root = top["root"].hex()
    folded = [fold(node, *path).decode() for node, path in zip(_hexed(held), paths, strict=True)]
    return pd.DataFrame(
        {
            "doc_id": leaves["doc_id"],
            "leaf": leaves["hash"].map(lambda h: bytes(h).hex()),
            "subroot": top["subroot"].hex(),
            "root": root,
            "proof_sha256": [hashlib.sha256(b"".join(siblings)).hexdigest() for siblings, _ in paths],
            "folded_root": folded,
            "verified": np.array([f == root for f in folded], bool),
        }
    )


def _rounds(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The nodes (key, pos, hash) of every round until each key has one node left."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("pos")).first()[0] or 0) > 0:
        named = rounds[-1].withColumn("block", F.floor(F.col("pos") / SUPER))
        rounds.append(saved(named.groupBy("key", "block").applyInPandas(_up, _NODE), name))
    return rounds


def _descend(rounds: list[DataFrame], outer: DataFrame, name: str) -> DataFrame:
    """One row a node of the last of these rounds: its path to the root. ``outer`` holds the paths of the superblocks of the first."""
    for nodes in rounds:
        named = nodes.withColumn("block", F.floor(F.col("pos") / SUPER))
        outer = saved(named.groupBy("key", "block").cogroup(outer.groupBy("key", "block")).applyInPandas(_down, _PATH), name)
    return outer


def manifest(docs: DataFrame, tamper: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    Where ``tamper`` holds, the leaf that is folded is that of the row with the letters A-Z of its text in lower case.
    """
    changed = F.when(tamper, leaf(docs, F.translate(docs["text"], string.ascii_uppercase, string.ascii_lowercase))) if tamper is not None else F.lit(None).cast("string")
    source = docs["source"].cast("string")
    with scratch():
        rows = docs.select(
            F.coalesce(F.concat(F.lit("s"), source), F.lit("")).alias("key"), docs["doc_id"].cast("long").alias("doc_id"),
            F.unhex(leaf(docs)).alias("hash"), F.unhex(changed).alias("tampered"), F.lit(1).cast("long").alias("pos"),
        )
        leaves = running(rows, "key", [F.col("doc_id").asc_nulls_first(), F.col("hash")], ["pos"], name="leaves")
        # Numbers cross into pandas as text, where nulls would make them floats.
        leaves = saved(leaves.select("key", F.col("doc_id").cast("string").alias("doc_id"), "hash", "tampered", (F.col("pos_run") - 1).alias("pos")), "leaves")
        lower = _rounds(leaves.select("key", "pos", "hash"), "nodes")
        # The last nodes are the subroots; in order of source they are the leaves of the upper tree.
        tops = lower[-1].select(F.lit("").alias("one"), "key", "hash", F.lit(1).cast("long").alias("pos"))
        tops = running(tops, "one", [F.col("key")], ["pos"], name="subroots").select("key", "hash", (F.col("pos_run") - 1).alias("pos"))
        tops = saved(tops, "subroots")
        upper = _rounds(tops.select(F.lit("").alias("key"), "pos", "hash"), "upper-nodes")
        zero, nothing = F.lit(0).cast("long").alias("block"), F.lit(b"")
        root = upper[-1].select("key", zero, nothing.alias("subroot"), F.col("hash").alias("root"), nothing.alias("path"), nothing.alias("shape"))
        outer = _descend(upper[::-1], root, "upper-paths")
        # A subroot's path is the outer row of its source's one last superblock.
        outer = outer.drop("key", "subroot").join(tops.select(F.col("pos").alias("block"), "key", F.col("hash").alias("subroot")), "block")
        outer = outer.select("key", zero, "subroot", "root", "path", "shape")
        outer = _descend(lower[:0:-1], outer, "paths")
        schema = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        named = leaves.withColumn("block", F.floor(F.col("pos") / SUPER))
        proved = named.groupBy("key", "block").cogroup(outer.groupBy("key", "block")).applyInPandas(_prove, schema)
        return saved(proved.withColumn("doc_id", F.col("doc_id").cast("long")), "manifest", outer=True)


def op13_merkle(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return manifest(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
