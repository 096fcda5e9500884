"""Change feeds by fingerprint, field-level upserts and upload layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import fingerprint, safe_name, strip
from .windows import prefix_sum


def product_key(df: DataFrame) -> DataFrame:
    """Add key: the trimmed ProductCode, or the Barcode where that is blank; rows with neither go."""
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    return df.withColumn("key", F.coalesce(blank("ProductCode"), blank("Barcode"))).where("key is not null")


def ranked(df: DataFrame, order: list[Column]) -> DataFrame:
    """Add place, from 1: each row's number in a total order without ties, found by ranges of the order."""
    return prefix_sum(df.withColumn("__one", F.lit(1).cast("long")), order, "__one", "place").drop("__one")


def ranked_rows(df: DataFrame, order: list[str], out: str = "place") -> DataFrame:
    """df with each row's number in the order of these columns, then of all others; equal rows get numbers in a row.

    Equal rows are one row with their number until the numbers are known, so they need no order among them.
    """
    rows = df.groupBy(*df.columns).agg(F.count("*").alias("__n"))
    total = [F.col(c) for c in [*order, *[c for c in df.columns if c not in order]]]
    rows = prefix_sum(rows, total, "__n", "__run")
    # In two steps, so that no array grows with the number of equal rows beyond its root.
    step = F.greatest(F.ceil(F.sqrt("__n")), F.lit(1)).cast("long")
    rows = rows.withColumn("__from", F.explode(F.sequence(F.col("__run") - F.col("__n") + 1, F.col("__run"), step)))
    places = F.sequence(F.col("__from"), F.least(F.col("__from") + step - 1, F.col("__run")))
    return rows.select(*df.columns, F.explode(places).alias(out))


def doc_id(df: DataFrame, ordinal: str = "ord") -> DataFrame:
    """Add doc_id: the first of ID, SID and Name that is not blank, safe for paths, else row_ and the row's number."""
    tries = [F.nullif(safe_name(F.trim(F.col(c).cast("string"))), F.lit("")) for c in ("ID", "SID", "Name") if c in df.columns]
    return df.withColumn("doc_id", F.coalesce(*tries, F.concat(F.lit("row_"), F.col(ordinal).cast("string"))))


def fingerprints(df: DataFrame, feed: str, columns: list[str], key: str = "key") -> DataFrame:
    return df.select(F.lit(feed).alias("feed"), F.col(key).alias("key"), fingerprint(*columns).alias("md5"))


def changed_rows(df: DataFrame, state: DataFrame, feed: str, columns: list[str] | None = None, exclude=("AvgCost",), key: str = "key", ordinal: str | None = None) -> DataFrame:
    """Rows of df whose fingerprint is new or differs from the feed's state; with their md5.

    Of rows with equal keys the last by ordinal counts. AvgCost alone makes no change.
    """
    if ordinal:
        last = Window.partitionBy(key).orderBy(F.col(ordinal).desc())
        df = df.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")
    names = columns or [c for c in df.columns if c not in {*exclude, key, ordinal}]
    marked = df.withColumn("md5", fingerprint(*names))
    old = state.where(F.col("feed") == feed).select(F.col("key").alias("__key"), F.col("md5").alias("__old"))
    joined = marked.join(old, marked[key] == old["__key"], "left")
    return joined.where(~F.col("md5").eqNullSafe(F.col("__old"))).drop("__key", "__old")


def changed_classification(classes: DataFrame, state: DataFrame, feed: str = "classification") -> DataFrame:
    note = F.col("note") if "note" in classes.columns else F.lit(None).cast("string")
    rows = classes.select(strip("ProductCode").alias("key"), "ProductCode", "ABC_Class", "XYZ_Class", note.alias("note")).where("key <> ''")
    found = changed_rows(rows, state, feed, ["ProductCode", "ABC_Class", "XYZ_Class", "note"])
    return found.select("key", "ABC_Class", "XYZ_Class", "note", "md5")


def changed_min_multiple(guessed: DataFrame, state: DataFrame, feed: str = "min_multiple") -> DataFrame:
    rows = guessed.withColumn("key", strip("ProductCode"))
    return changed_rows(rows, state, feed, ["ProductCode", "guessed_min", "guessed_multiple"])


def merge_upsert(target: DataFrame, updates: DataFrame, key: str = "key") -> DataFrame:
    """target with the updates' fields set, nulls included; fields that updates lack are kept; new keys come in."""
    up = updates.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__u_{c}") for c in updates.columns if c != key])
    joined = target.withColumn("__t", F.lit(1)).join(up, target[key] == up["__k"], "full")
    given = F.col("__k").isNotNull()
    cols = [F.coalesce(F.col(key), F.col("__k")).alias(key)]
    for c in [*target.columns, *[c for c in updates.columns if c not in target.columns]]:
        if c == key:
            continue
        old = F.col(c) if c in target.columns else F.lit(None)
        cols.append((F.when(given, F.col(f"__u_{c}")).otherwise(old) if c in updates.columns else old).alias(c))
    return joined.select(*cols)


def fan_out_classification(products: DataFrame, replenishment: DataFrame, feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    payload = feed.select("key", "ABC_Class", "XYZ_Class", "note")
    return merge_upsert(products, payload), merge_upsert(replenishment, payload)


def plan_upload_rows(df: DataFrame, source: str | None = None) -> DataFrame:
    """ProductCode (or GoodsID) and the whole Target_Stock, from Base_Demand where there is one, rounded half to even."""
    source = source or ("Base_Demand" if "Base_Demand" in df.columns else "Target_Stock")
    code = [F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in ("ProductCode", "GoodsID") if c in df.columns]
    qty = F.coalesce(F.col(source).try_cast("double"), F.lit(0.0))
    rows = df.select(F.coalesce(*code).alias("ProductCode"), F.bround(qty, 0).cast("long").alias("Target_Stock"))
    return rows.where("ProductCode is not null")
