"""Trie of conversation prefixes by ROLLUP over positional turn-id columns.

Turns get 16-byte ids by content. A conversation is cut into blocks of eight turns, one
row a block with the columns t1..t8. ``GROUP BY block, prior node, ROLLUP (t1..t8)``
aggregates all prefixes of all blocks at once, and grouping_id tells a group's depth. The
prior node of a block is the prefix before it, known by a 128-bit key: the xor of one hash
a turn and position, so it is a running xor and blocks need no order of work.

Sums over subtrees need no recursion either. Let a conversation be the smallest member of
its own nodes only; these are the tail of its path from depth d0 on. A member of a node
other than the smallest shares with smaller conversations exactly the turns before its
own d0, so a second ROLLUP of two numbers a conversation (words before its own nodes; one
if it owns a leaf) gives saved tokens and leaves of every subtree.

Edge cases: rows without a conv_id belong to no conversation and are left out; a null turn
is first; turns with equal numbers stand in the order of their content ids; a null role or
text is empty; a conversation without turns is a member of the root alone; repeated rows
are turns of their own; an empty table has no nodes. Only conv_id, turn, role and text are
read. A conversation of any length, and any number of equal conversations, spread over
tasks: positions and keys run over ranges, members are counted before the shuffle, and the
numbers that end in one node are joined in pieces of at most 64 KB before they are hashed
in a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, scratch
from .running import running

#: Turns a block.
BLOCK = 8
#: Bytes of joined conversation numbers in one piece.
PIECE = 1 << 16
#: Turns that a conversation takes from the first one of its group of so many numbers, in the registered query.
FAMILY, MOST_SHARED = 20, 4

WORDS = r"[^\x20\x09-\x0D]+"
SLOTS = [f"t{i}" for i in range(1, BLOCK + 1)]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1) and id of every turn; an id is an MD5 of role and text with the number of words behind it."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    words = F.unhex(F.lpad(F.hex(F.regexp_count(text, F.lit(WORDS)).cast("long")), 8, "0"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.concat(digest, words).alias("id"))
    rows = rows.withColumn("pos", F.lit(1).cast("long"))
    return running(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("id")], ["pos"], name="turns").select("conv_id", F.col("pos_run").alias("pos"), "id")


def words_of(turn_id: Column) -> Column:
    """Words of a turn, from its id; 0 for none."""
    return F.coalesce(F.conv(F.hex(F.substring(turn_id, 17, 4)), 16, 10).cast("long"), F.lit(0).cast("long"))


def plain(turns: DataFrame) -> DataFrame:
    """conv_id, pos, id, len: turns as they are, to be made a trie."""
    ends = turns.groupBy("conv_id").agg(F.max("pos").alias("len"))
    return turns.join(ends, "conv_id")


def grafted(turns: DataFrame, family: int = FAMILY, most: int = MOST_SHARED) -> DataFrame:
    """conv_id, pos, id, len: each conversation c with its first h turns from conversation c - c % family.

    h is crc32 of c's decimal text, modulo ``most``. Where that conversation has fewer turns all are taken; c's own
    turns behind its first h follow. A conversation left without turns has one row with a null id.
    """
    shared = lambda: F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    heads = turns.where((F.col("conv_id") % family == 0) & (F.col("pos") < most))  # fewer than `most` rows a conversation
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias("ids"))
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("n")).withColumn("h", shared())
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(heads, "base", "left")
    convs = convs.withColumn("ids", F.when(F.col("ids").isNull(), F.array().cast("array<binary>")).otherwise(F.slice("ids", 1, F.col("h").cast("int"))))
    convs = convs.withColumn("k", F.size("ids").cast("long"))
    convs = saved(convs.select("conv_id", "ids", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "conversations")
    first = convs.select("conv_id", F.posexplode("ids").alias("pos", "id"), "len").withColumn("pos", (F.col("pos") + 1).cast("long"))
    own = turns.where(F.col("pos") > shared()).join(convs.select("conv_id", "k", "len"), "conv_id")
    own = own.select("conv_id", (F.col("pos") - shared() + F.col("k")).alias("pos"), "id", "len")
    bare = convs.where("len = 0").select("conv_id", F.lit(1).cast("long").alias("pos"), F.lit(None).cast("binary").alias("id"), "len")
    return first.unionByName(own).unionByName(bare)


def _hashes(at: Column, turn_id: Column) -> tuple[Column, Column]:
    none = F.lit(0).cast("long")
    a, b = F.xxhash64(at, turn_id), F.xxhash64(turn_id, at)
    return F.when(turn_id.isNull(), none).otherwise(a), F.when(turn_id.isNull(), none).otherwise(b)


def _folded(columns: list[Column], add) -> Column:
    total = columns[0]
    for c in columns[1:]:
        total = add(total, c)
    return total


def _xor(columns: list[Column]) -> Column:
    return _folded(columns, lambda a, b: a.bitwiseXOR(b))


def _sum(columns: list[Column]) -> Column:
    return _folded(columns, lambda a, b: a + b)


def _at(i: int) -> Column:
    return F.col("b") * BLOCK + F.lit(i).cast("long")


def blocks_of(turns: DataFrame) -> DataFrame:
    """One row a conversation and block: t1..t8, the prior node's key (k1, k2) and words, the key and words at its end, len."""
    rows = turns.withColumn("b", F.floor((F.col("pos") - 1) / BLOCK)).withColumn("i", F.col("pos") - F.col("b") * BLOCK)
    rows = rows.groupBy("conv_id", "b").agg(F.max("len").alias("len"), *[F.max(F.when(F.col("i") == i, F.col("id"))).alias(t) for i, t in enumerate(SLOTS, 1)])
    pairs = [_hashes(_at(i), F.col(t)) for i, t in enumerate(SLOTS, 1)]
    rows = rows.withColumns({"z1": _xor([p[0] for p in pairs]), "z2": _xor([p[1] for p in pairs]), "w": _sum([words_of(F.col(t)) for t in SLOTS])})
    rows = running(rows, "conv_id", [F.col("b")], ["w"], ["z1", "z2"], "blocks")
    return rows.select(
        "conv_id", "b", "len", *SLOTS, F.col("z1_run").bitwiseXOR(F.col("z1")).alias("k1"), F.col("z2_run").bitwiseXOR(F.col("z2")).alias("k2"),
        (F.col("w_run") - F.col("w")).alias("prior_words"), F.col("z1_run").alias("e1"), F.col("z2_run").alias("e2"), F.col("w_run").alias("words"),
    )


def _prefixes(blocks: DataFrame, aggregates: str) -> DataFrame:
    """One row a trie node: b, k (turns within the block), depth, t1..t8, k1, k2, prior_words and the aggregates.

    Groups whose last turn is missing (the conversation ended before) and the empty prefix of all but the first block are left out.
    """
    spark = blocks.sparkSession
    found = spark.sql(
        f"SELECT b, k1, k2, prior_words, {', '.join(SLOTS)}, {BLOCK} - bit_count(grouping_id()) AS k, {aggregates} "
        f"FROM {{blocks}} GROUP BY b, k1, k2, prior_words, ROLLUP ({', '.join(SLOTS)})",
        blocks=blocks,
    )
    last = F.element_at(F.array(*[F.col(t).isNotNull() for t in SLOTS]), F.greatest("k", F.lit(1)))
    real = F.when(F.col("k") == 0, F.col("b") == 0).otherwise(last)
    before = F.col("prior_words") + _sum([F.when(F.col("k") > i, words_of(F.col(t))).otherwise(0) for i, t in enumerate(SLOTS, 1)])
    return found.where(real).withColumns({"depth": F.col("b") * BLOCK + F.col("k"), "words_before": before})


def _branches(blocks: DataFrame) -> DataFrame:
    """conv_id, len, d0 (depth of its first own node), shared (words before it), owns (1 if it owns a leaf), and its end's key."""
    inside = F.col("len") <= (F.col("b") + 1) * BLOCK
    reach = blocks.withColumn("reach", F.when(inside, F.col("len") - F.col("b") * BLOCK).otherwise(F.lit(BLOCK + 1).cast("long")))
    nodes = _prefixes(reach, "min(conv_id) AS conv_id, max(reach) AS reach")
    own = nodes.groupBy("conv_id").agg(F.min("depth").alias("d0"), F.min("words_before").alias("shared"), F.max((F.col("reach") == F.col("k")).cast("long")).alias("owns"))
    lasts = blocks.where(inside).select("conv_id", "len", "words", "e1", "e2")
    return lasts.join(own, "conv_id", "left").select(
        "conv_id", "len", "e1", "e2", F.coalesce("d0", F.col("len") + 1).alias("d0"), F.coalesce("shared", "words").alias("shared"), F.coalesce("owns", F.lit(0).cast("long")).alias("owns")
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversation numbers of rows in order, joined by commas while the node stays and the piece is short."""
    names = ["depth", "x1", "x2", "first", "ids"]
    node, first, held, size, out = None, None, [], 0, []
    for batch in batches:
        for *key, conv in zip(*(batch.column(c).to_pylist() for c in ("depth", "x1", "x2", "conv_id")), strict=True):
            if key != node or size >= PIECE:
                if held:
                    out.append((*node, first, ",".join(held)))
                node, first, held, size = key, conv, [], 0
            held.append(str(conv))
            size += len(held[-1]) + 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
            out = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*node, first, ",".join(held))], names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces in order, joined by commas; one digest is open at a time."""
    names = ["depth", "x1", "x2", "ends_sha256"]
    node, digest, out = None, None, []
    for batch in batches:
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "x1", "x2", "ids")), strict=True):
            if key == node:
                digest.update(b",")
            else:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256()
            digest.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
            out = []
    if node:
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*node, digest.hexdigest())], names)


def _ends(branches: DataFrame) -> DataFrame:
    """depth, x1, x2 of the nodes in which conversations end, with the digest of their numbers."""
    rows = branches.select(F.col("len").alias("depth"), F.col("e1").alias("x1"), F.col("e2").alias("x2"), "conv_id")
    key = ["depth", "x1", "x2"]
    rows = rows.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    pieces = rows.mapInArrow(_pieces, "depth long, x1 long, x2 long, first long, ids string")
    return pieces.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(_digests, "depth long, x1 long, x2 long, ends_sha256 string")


def _nodes(turns: DataFrame) -> DataFrame:
    """Every node of the trie of conversations given as (conv_id, pos, id, len)."""
    key = ["depth", "x1", "x2"]
    blocks = saved(blocks_of(turns), "trie-blocks")
    branches = saved(_branches(blocks), "branches")
    full = blocks.drop("len", "e1", "e2", "words").join(branches.select("conv_id", "len", "d0", "shared", "owns"), "conv_id")
    nodes = _prefixes(
        full, "count(*) AS n_convs, sum(shared) AS all_shared, sum(owns) AS n_leaves, min_by(shared, conv_id) AS own_shared, min_by(d0, conv_id) AS d0, min_by(len, conv_id) AS len, min(conv_id) AS conv_id"
    )
    pairs = [_hashes(_at(i), F.col(t)) for i, t in enumerate(SLOTS, 1)]
    last = [F.coalesce(*[F.when(F.col("k") == i, p[j]) for i, p in enumerate(pairs, 1)], F.lit(0).cast("long")) for j in (0, 1)]
    nodes = nodes.withColumns({"x1": _xor([F.col("k1"), *[p[0] for p in pairs]]), "x2": _xor([F.col("k2"), *[p[1] for p in pairs]])})
    nodes = nodes.select(
        "conv_id", *key, "n_convs", "n_leaves", (F.col("all_shared") - F.col("own_shared") - (F.col("n_convs") - 1) * F.col("words_before")).alias("saved_tokens"),
        (F.col("depth") == F.col("d0")).alias("top"), (F.col("len") > F.col("depth")).cast("long").alias("goes_on"),
        (F.col("depth") - 1).alias("p0"), F.col("x1").bitwiseXOR(last[0]).alias("p1"), F.col("x2").bitwiseXOR(last[1]).alias("p2"),
    )
    nodes = saved(nodes, "trie-nodes")
    # A node's smallest member is its parent's too, but for the first own node of each conversation.
    parents = nodes.select(F.col("depth").alias("p0"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    tops = nodes.where("top").join(parents, ["p0", "p1", "p2"], "left")
    linked = nodes.where("not top").withColumn("parent_conv_id", F.col("conv_id")).unionByName(tops)
    kids = nodes.where("top and depth > 0").groupBy(F.col("p0").alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(F.count("*").alias("kids"))
    rows = linked.join(kids, key, "left").join(_ends(branches), key, "left")
    none = F.lit(hashlib.sha256().hexdigest())
    rows = rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", (F.coalesce("kids", F.lit(0).cast("long")) + F.col("goes_on")).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
    return rows


def trie(conversations: DataFrame, family: int | None = None, most: int = MOST_SHARED) -> DataFrame:
    """conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    With ``family``, conversations are grafted first: see ``grafted``.
    """
    with scratch():
        turns = turn_rows(conversations)
        return saved(_nodes(grafted(turns, family, most) if family else plain(turns)), "trie", outer=True)


def op11_prefix_trie(spark, sf_dir) -> DataFrame:
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), FAMILY)
