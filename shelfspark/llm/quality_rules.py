"""Quality rules with host verdicts, in DataFrame and SQL functions only.

A document fails the base rules when it has under ten words or when more than a
fifth of its words stand in five-word windows that occur twice or more in it.
Failures are then counted by host, each host's failure rate is shrunk towards the
corpus by a beta prior fitted to the hosts, and hosts whose shrunk rate passes
``host_limit`` lose all their documents.

Edge cases: null or empty text has no words and fails; a null host has no verdict
of its own, so its documents stand on the base rules; an empty table gives an
empty table. Five-word windows are compared by 64-bit hash within one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, saved

#: Shrunk failure rate above which a whole host goes.
HOST_LIMIT = 0.8
#: Largest number of rejected hosts that is broadcast; more are joined by shuffle.
BROADCAST_HOSTS = 100_000

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the columns ``keep``, the five measures and base_failed; one pass, no shuffle."""
    step = docs.select("doc_id", *keep, F.coalesce("text", F.lit("")).alias("__t"))
    step = step.select(
        "doc_id",
        *keep,
        F.length("__t").alias("__len"),
        F.length(F.translate("__t", "#*$%&|<>", "")).alias("__plain"),
        F.length(F.regexp_replace("__t", f"{SPACES}+", "")).alias("word_chars"),
        F.expr(rf"filter(split(__t, '\n', -1), l -> length(translate(l, ' \t\n\u000B\f\r', '')) > 0)").alias("__lines"),
        F.expr(r"filter(split(__t, '[\\x20\\x09-\\x0D]+', -1), w -> w != '')").alias("__w"),
    )
    step = step.select(
        "doc_id",
        *keep,
        F.size("__w").cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        (F.col("__len") - F.col("__plain")).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "if(size(__w) < 6, cast(array() as array<bigint>), transform(sequence(0, size(__w) - 5), i -> "
            "xxhash64(get(__w, i), get(__w, i + 1), get(__w, i + 2), get(__w, i + 3), get(__w, i + 4))))"
        ).alias("__h"),
    )
    # Only a document with a repeated window sorts its windows: equal ones then stand side by side,
    # and the words that they cover are counted from their places in order.
    step = step.withColumn(
        "__s",
        F.expr(
            "if(size(array_distinct(__h)) = size(__h), null, sort_array(transform(__h, (h, i) -> struct(h, i))))"
        ),
    )
    step = step.withColumn(
        "__at",
        F.expr(
            "sort_array(transform(filter(__s, (x, i) -> coalesce(get(__s, i - 1).h = x.h, false) "
            "or coalesce(get(__s, i + 1).h = x.h, false)), x -> x.i))"
        ),
    )
    step = step.withColumn(
        "n_repeat_words",
        F.expr(
            "coalesce(aggregate(__at, struct(0L as n, -5 as last), "
            "(a, p) -> struct(a.n + least(5, p - a.last) as n, p as last), a -> a.n), 0L)"
        ),
    )
    return step.select("doc_id", *keep, *MEASURES).withColumn(
        "base_failed",
        (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    )


def host_rates(failures: DataFrame, host: str = "source") -> DataFrame:
    """Per host: documents, failures and the shrunk rate (failures + a) / (documents + a + b).

    a and b come from the hosts by the method of moments: their mean rate m, and the
    variance between them beyond what chance explains.
    """
    hosts = saved(
        failures.where(F.col(host).isNotNull())
        .groupBy(host)
        .agg(F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")),
        "hosts",
    )
    t = hosts.agg(
        F.count("*").alias("k"),
        F.sum("n_docs").alias("n"),
        F.sum("n_failed").alias("f"),
        F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("ff"),
    ).first()
    a, b = beta_prior(t["k"], t["n"] or 0, t["f"] or 0, t["ff"] or 0.0)
    return hosts.withColumn("fail_rate", (F.col("n_failed") + F.lit(a)) / (F.col("n_docs") + F.lit(a + b)))


def beta_prior(hosts: int, docs: int, failed: int, weighted: float) -> tuple[float, float]:
    """a and b of the prior; weighted is the sum over hosts of failed * failed / docs."""
    if not docs:
        return 0.0, 0.0
    m = failed / docs
    chance = m * (1 - m)
    between = weighted / docs - m * m - chance * (hosts - 1) / docs
    strength = 1e6 if between <= chance / 1e6 else chance / between - 1
    strength = min(max(strength, 1.0), 1e6)
    return m * strength, (1 - m) * strength


def with_host_verdicts(rows: DataFrame, rates: DataFrame, host: str = "source", host_limit: float = HOST_LIMIT) -> DataFrame:
    """Add kept: the base verdict, and false for every document of a rejected host."""
    bad = rates.where(F.col("fail_rate") > host_limit).select(F.col(host).alias("__bad"))
    if bad.count() <= BROADCAST_HOSTS:
        bad = F.broadcast(bad)
    joined = rows.join(bad, rows[host] == bad["__bad"], "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("__bad").isNull()).drop("__bad")


def quality_rules(docs: DataFrame, host: str = "source", host_limit: float = HOST_LIMIT) -> DataFrame:
    """Per document: doc_id, the measures, base_failed and kept."""
    rows = saved(measure(docs, host), "quality")
    return with_host_verdicts(rows, host_rates(rows, host), host, host_limit).select(
        "doc_id", *MEASURES, "base_failed", "kept"
    )


def keep_good(docs: DataFrame, host: str = "source", host_limit: float = HOST_LIMIT) -> DataFrame:
    """The documents that pass, with all their columns.

    Documents are saved once next to their base verdict, so that the measures are worked
    out once and no text is shuffled.
    """
    again = docs.withColumn("__doc", F.struct(*docs.columns))
    rows = saved(measure(again, host, "__doc").select("__doc", host, "base_failed"), "quality")
    kept = with_host_verdicts(rows, host_rates(rows.select(host, "base_failed"), host), host, host_limit)
    return kept.where("kept").select("__doc.*")


ORACLE_SQL = rf"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
w AS (SELECT doc_id, source, r, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM t),
g AS (SELECT r, i, array_to_string(ws[i:i+4], ' ') AS s FROM w, unnest(range(1, len(ws) - 3)) u(i)),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM g) WHERE c > 1),
c AS (SELECT r, count(DISTINCT i + o) AS n FROM d, unnest(range(0, 5)) v(o) GROUP BY r),
m AS (SELECT doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))
     - len(list_distinct(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN c USING (r)),
b AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM b WHERE source IS NOT NULL GROUP BY source),
s AS (SELECT sum(f) / sum(n)::DOUBLE AS m, sum(f * f / n::DOUBLE) / sum(n) AS q, count(*) AS k, sum(n) AS nn FROM h),
v AS (SELECT m, m * (1 - m) AS ch, q - m * m - m * (1 - m) * (k - 1) / nn AS bt FROM s),
p AS (SELECT m, least(greatest(CASE WHEN bt <= ch / 1e6 THEN 1e6 ELSE ch / bt - 1 END, 1.0), 1e6) AS st FROM v),
x AS (SELECT source FROM h, p WHERE (f + m * st) / (n + st) > {HOST_LIMIT})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND x.source IS NULL) AS kept
FROM b LEFT JOIN x ON b.source = x.source
"""


def op6_quality_rules(spark, sf_dir) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
