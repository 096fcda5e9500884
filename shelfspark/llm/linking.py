"""Groups from links: connected components, and candidate pairs without all pairs of a group.

Rows (key, node, ...) say that a node has a key; nodes that share a key may be linked.
``link`` first tests each node against two others under each key only, the one before
it in an order that puts like nodes side by side and the weightiest one, and joins
what is linked into components. Then the pairs under a key whose nodes are still in different components are tested;
with steps, the likelier ones of these come first, since what they link saves others the test.
No pair that could join two components is left out, and a large group of copies costs
a chain, not the square of its size. Sides are broadcast only where Spark finds them small at run time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, saved


def components(links: DataFrame) -> DataFrame:
    """node and root (its component's smallest node) for every node in links (a, b), as a saved table.

    Rounds of large-star and small-star; each round is a table in the shared folder, so
    a lost executor repeats no earlier round, and takes the place of the round before it.
    Minima are aggregated before they are joined.
    """
    edges = saved(_clean(links.select("a", "b")), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large-star: every larger neighbour is tied to the smallest of the neighbourhood
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        big = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        big = _clean(big)
        # small-star: the smaller neighbours and the node itself are tied to the smallest one
        least = big.groupBy("a").agg(F.min("b").alias("m"))
        near = big.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = saved(_clean(near.unionByName(least.select("a", F.col("m").alias("b")))), "edges")
        discard(edges)
        edges, before, state = new, state, _state(new)
        if before == state:
            break
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    found = saved(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()), "roots")
    discard(edges)
    return found


def _clean(edges: DataFrame) -> DataFrame:
    """Edges from the larger node to the smaller one, once each."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def shared(rows: DataFrame) -> DataFrame:
    """The rows whose key belongs to at least two different nodes."""
    key = Window.partitionBy("key")
    rows = rows.withColumn("__shared", F.min("node").over(key) < F.max("node").over(key))
    return rows.where("__shared").drop("__shared")


def link(
    rows: DataFrame,
    orders: list[str],
    weight: str,
    may: Callable[[Callable[[str], Column], Callable[[str], Column]], Column],
    verify: Callable[[DataFrame], DataFrame],
    gap: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
    steps: tuple[int, ...] = (),
    about: DataFrame | None = None,
    may_far: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
) -> DataFrame:
    """node and root of every linked node, as a saved table.

    rows: a saved table (key, node, ...) of shared keys, each key and node once. orders: columns that
    put like nodes side by side, one for each round in which neighbours are tested; a round joins groups, so that the next
    and the last step have fewer pairs left. weight: column whose largest value makes a key's hub. may(x, y): a
    filter on two rows of a key; x and y give a column by name. verify: keeps the linked ones of
    distinct pairs (a, b), as a saved table. gap and steps: a number of two rows that tells how unlike they are, and
    its largest value in each step of the pairs that are no neighbours; the last step must take all pairs. With steps a node has so
    few keys that each of its rows can carry them; a pair then comes from the first key that both share, and not from each
    of them. about: a table (node, ...) of further columns for may_far, a filter as may on the pairs that are no neighbours.
    """
    rest = [c for c in rows.columns if c != "key"]
    tried = links = None
    open_ = rows.withColumn("root", F.col("node"))
    for k, order in enumerate(orders):
        held = open_.select("key", F.struct(*rest, "root").alias("y"))
        place = Window.partitionBy("key").orderBy(F.col(f"y.{order}").asc(), F.col("y.node").asc())
        sides = ["before"]
        near = held.withColumn("before", F.lag("y").over(place))
        if not k:
            hub = F.max(F.struct(f"y.{weight}", "y.node", "y")).over(Window.partitionBy("key"))["y"]
            near, sides = near.withColumn("hub", hub), ["before", "hub"]
        near = near.select("y", F.explode(F.array(*sides)).alias("x")).where("x.root <> y.root")
        pairs = _ends(near.where(_on(may)))
        pairs = saved(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "near-pairs")
        found = verify(pairs)
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        roots = components(links)
        open_ = saved(_open(rows, roots), "open-keys")

    if not steps:
        last = saved(_far(open_, _on(may)).join(tried, ["a", "b"], "left_anti"), "far-pairs")
        return components(links.unionByName(verify(last)))
    if about is not None:
        open_ = open_.join(about, "node")
    own = open_.groupBy("node").agg(F.collect_set("key").alias("own"))
    open_ = open_.join(own, "node").withColumn("less", F.expr("filter(own, k -> k < key)")).drop("own")
    open_ = saved(_topped(open_), "open-keys")
    for k, most in enumerate(steps):
        step = _on(may) & (_on(gap) <= most)
        if k:
            step = step & (_on(gap) > steps[k - 1])
        step = step & ~F.arrays_overlap("x.less", "y.less")
        if may_far is not None:
            step = step & _on(may_far)
        pairs = saved(_far(open_, step).join(tried, ["a", "b"], "left_anti"), "far-pairs")
        roots = _merged(roots, verify(pairs))
        discard(pairs)
        if k + 1 < len(steps):
            fewer = saved(_topped(_open(open_.drop("root", "top"), roots)), "open-keys")
            discard(open_)
            open_ = fewer
    return roots


def _open(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows, with their nodes' roots, of keys whose nodes are in different components."""
    named = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # The only pair of a key with two nodes is tested already.
    many = named.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"))
    return named.join(many.where("lo <> hi and n > 2").select("key"), "key")


def _topped(rows: DataFrame) -> DataFrame:
    """The rows, and whether theirs is the root that most nodes of the key have: two such rows are no pair."""
    most = rows.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(F.max(F.struct("n", "root"))["root"].alias("most"))
    return rows.join(most, "key").withColumn("top", F.col("root") == F.col("most")).drop("most")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """roots with the components joined that links (a, b) join, as a saved table; rounds are made over the components linked only."""
    for end in ("a", "b"):
        links = links.join(roots.select(F.col("node").alias(end), F.col("root").alias("r")), end, "left")
        links = links.withColumn(end, F.coalesce("r", end)).drop("r")
    joined = components(links)
    moved = roots.join(joined.select(F.col("node").alias("root"), F.col("root").alias("new")), "root", "left")
    moved = moved.select("node", F.coalesce("new", "root").alias("root"))
    # Nodes that had no link before are in joined alone.
    found = saved(moved.unionByName(joined.join(roots, "node", "left_anti")), "roots")
    discard(joined, roots)
    return found


def _far(rows: DataFrame, may: Column) -> DataFrame:
    """Distinct pairs (a, b) under a key that are in different components and pass the filter of x and y."""
    packed = rows.select("key", F.struct(*[c for c in rows.columns if c != "key"]).alias("y"))
    others, once = packed, F.col("x.node") < F.col("y.node")
    if "top" in rows.columns:
        others, once = packed.where("not y.top"), once | F.col("y.top")
    # The filter stands in the join, so that a pair that fails it never becomes a row.
    return _ends(packed.join(others.withColumnRenamed("y", "x"), "key").where((F.col("x.root") != F.col("y.root")) & once & may))


def _on(may) -> Column:
    return may(lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()
