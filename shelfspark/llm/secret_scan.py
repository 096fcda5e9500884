r"""Secret scan in DataFrame and SQL functions only; one narrow pass, no shuffle.

Three patterns give base spans: an assignment to a secret's name, access keys and
long runs of hex digits. On top, candidate strings (runs of 20 or more characters
of the base-64 alphabet) are slid over by a window of 20 characters. The window's
Shannon entropy is kept by incremental counts: one character enters, one leaves,
and the sum of c*log2(c) changes by table look-ups. Windows whose entropy reaches
the limit of their character class (hex, or mixed letters and digits; a candidate
without a digit or without a letter is of neither and has none) are merged into ``entropy`` spans, unless the whole candidate is on the allow-list. The
allow-list never removes a base span.

Offsets count code points, ends are exclusive. Null or empty text has no spans;
very long texts are scanned whole (the places of matches are prefix sums, so the
cost stays near linear); repeated rows give repeated results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

#: Characters of a candidate; a character's place here is its slot in the counts.
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Runs of windows in one page.
PAGE = 64
#: Bits a character from which a window counts as random, by class.
HEX_BITS, MIXED_BITS = 3.0, 3.8

#: Candidates that are no secrets: UUIDs and sample values. A pattern must not repeat a group: matching one recurses
#: once a repetition, and a long candidate would end the executor.
ALLOWED = (
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
    r".*(?i:example|sample|dummy|placeholder).*",
)
#: Nor are words and short numbers joined by signs: a candidate is cut at the signs and each part is tested.
SIGNS, PART = "[+/_=-]+", "^([A-Za-z]+|[0-9]{1,4})$"


def _matches(text: str, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group))


def _ends(lengths: str) -> str:
    """Prefix sums of an array column by doubling: n log n steps instead of n * n."""
    return (
        f"aggregate(sequence(0, cast(ceil(log2(size({lengths}) + 1)) as int)), {lengths}, "
        "(a, k) -> transform(a, (x, i) -> x + coalesce(get(a, i - shiftleft(1, k)), 0)))"
    )


def _spans(kind: int, found: str, ends: str, keep: str = "true") -> str:
    """Structs (start, kind, end) of the matches in ``found`` whose ends are known."""
    made = (
        f"transform({found}, (m, i) -> named_struct('start', get({ends}, i) - length(m), 'kind', {kind}, "
        f"'end', get({ends}, i), 'keep', {keep}))"
    )
    return f"transform(filter({made}, x -> x.keep), x -> named_struct('start', x.start, 'kind', x.kind, 'end', x.end))"


def _entropy_runs(slots: str, limit: str) -> str:
    """Merged windows of high entropy in an array of alphabet slots, as structs (a, b)."""
    table = "array(" + ",".join(f"{round(1e6 * c * math.log2(c)) if c else 0}L" for c in range(WINDOW + 2)) + ")"
    gone = f"get({slots}, t.i - {WINDOW})"
    f = lambda c: f"get({table}, {c})"
    total = (
        f"t.s + if({gone} <=> k, 0L, {f('get(t.c, k) + 1')} - {f('get(t.c, k)')} + if({gone} is null, 0L, "
        f"{f(f'get(t.c, {gone}) - 1')} - {f(f'get(t.c, {gone})')}))"
    )
    counts = f"transform(t.c, (c, j) -> c + if(j = k, 1, 0) - if(j <=> {gone}, 1, 0))"
    new = f"(t.i >= {WINDOW - 1} and x.s <= {limit})"
    first = f"t.i - {WINDOW - 1}"
    # Runs are kept in pages, so that adding one copies a page and not all of them.
    run, done, full = "named_struct('a', t.a, 'b', t.b)", f"({new} and {first} > t.b and t.b >= 0)", f"(size(t.q) >= {PAGE})"
    merge = (
        f"get(transform(array(named_struct('c', {counts}, 's', {total})), x -> named_struct('c', x.c, 's', x.s, 'i', t.i + 1, "
        f"'a', if({new} and ({first} > t.b), {first}, t.a), 'b', if({new}, t.i + 1, t.b), "
        f"'q', if({done}, if({full}, array({run}), array_append(t.q, {run})), t.q), "
        f"'r', if({done} and {full}, array_append(t.r, t.q), t.r))), 0)"
    )
    zero = (
        f"named_struct('c', array_repeat(0, {len(ALPHABET)}), 's', 0L, 'i', 0, 'a', -1, 'b', -1, "
        "'q', cast(array() as array<struct<a:int,b:int>>), 'r', cast(array() as array<array<struct<a:int,b:int>>>))"
    )
    last = f"t -> flatten(array_append(t.r, if(t.b >= 0, array_append(t.q, {run}), t.q)))"
    return f"aggregate({slots}, {zero}, (t, k) -> {merge}, {last})"


def find_secrets(docs: DataFrame, *keep: str, allowed: tuple[str, ...] = ALLOWED, words: bool = True) -> DataFrame:
    """The columns ``keep`` and spans, an array of structs (start, kind, end) by start, then kind.

    Candidates that one of the patterns ``allowed`` matches whole have no entropy spans; with ``words``, nor have words
    and short numbers joined by signs.
    """
    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("__t"))
    rows = rows.select(
        *keep,
        "__t",
        _matches("__t", ASSIGN).alias("__m0"),
        _matches("__t", ACCESS).alias("__m1"),
        _matches("__t", HEX).alias("__m2"),
        _matches("__t", CANDIDATE).alias("__m3"),
    )
    rows = rows.withColumn("__g", F.when(F.size("__m0") > 0, _matches("__t", ASSIGN, 2)).otherwise(F.array()))
    for i, pattern in enumerate((ASSIGN, ACCESS, HEX, CANDIDATE)):
        between = F.when(F.size(f"__m{i}") > 0, F.split("__t", pattern, -1)).otherwise(F.array())
        rows = rows.withColumn(f"__p{i}", between)
        rows = rows.withColumn(f"__l{i}", F.expr(f"transform(__m{i}, (m, i) -> length(m) + length(get(__p{i}, i)))"))
        rows = rows.withColumn(f"__e{i}", F.expr(f"if(size(__m{i}) = 0, __l{i}, {_ends(f'__l{i}')})"))
    tested = rows.withColumn(
        "__c",
        F.expr(
            "filter(transform(__m3, (m, i) -> named_struct('m', m, 'end', get(__e3, i), 'limit', "
            f"if(m rlike '^[0-9A-Fa-f]+$', {round(1e6 * WINDOW * (math.log2(WINDOW) - HEX_BITS))}L, "
            f"{round(1e6 * WINDOW * (math.log2(WINDOW) - MIXED_BITS))}L))), "
            "x -> x.m rlike '[0-9]' and x.m rlike '[A-Za-z]')"
        ),
    )
    if allowed:
        harmless = F.lit("^(?:" + "|".join(allowed) + ")$")
        tested = tested.withColumn("__c", F.filter("__c", lambda x: ~F.rlike(x["m"], harmless)))
    if words:
        parts = f"split(x.m, '{SIGNS}', -1)"
        plain = f"get({parts}, 0) != '' and forall({parts}, p -> p = '' or p rlike '{PART}')"
        tested = tested.withColumn("__c", F.expr(f"filter(__c, x -> not ({plain}))"))
    tested = tested.withColumn(
        "__c",
        F.expr(
            "transform(__c, x -> named_struct('start', x.end - length(x.m), 'limit', x.limit, "
            f"'slots', transform(filter(split(x.m, ''), c -> c != ''), c -> instr('{ALPHABET}', c) - 1)))"
        ),
    )
    entropy = (
        f"flatten(transform(__c, y -> transform({_entropy_runs('y.slots', 'y.limit')}, "
        "r -> named_struct('start', y.start + r.a, 'kind', 3, 'end', y.start + r.b))))"
    )
    assign = _spans(0, "__m0", "__e0", "length(get(__g, i)) >= 6")
    parts = [assign, _spans(1, "__m1", "__e1"), _spans(2, "__m2", "__e2"), f"if(size(__c) = 0, cast(array() as array<struct<start:int,kind:int,end:int>>), {entropy})"]
    return tested.select(*keep, F.expr(f"sort_array(concat({', '.join(parts)}))").alias("spans"))


def _text(spans: str) -> Column:
    kinds = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(
        f"array_join(transform({spans}, x -> concat(get(array({kinds}), x.kind), ':', x.start, ':', x.end)), ',')"
    )


def op1_secret_scan(spark, sf_dir) -> DataFrame:
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id")
    found = found.withColumn("__base", F.expr("filter(spans, x -> x.kind < 3)"))
    counts = [F.expr(f"cast(size(filter(spans, x -> x.kind = {i})) as bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts[:3], F.sha2(_text("__base"), 256).alias("base_sha256"), _text("spans").alias("spans"), counts[3]
    )
