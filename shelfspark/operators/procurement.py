"""Inbound movements, and the order minimum and multiple that they suggest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import divisors, strip


def inbound_movements(moves: DataFrame, as_of: str, years: int = 2) -> DataFrame:
    """Inbound rows of the last `years` times 365 days; BillDate is compared as a number, so the filter reaches the scan."""
    end = F.lit(as_of).cast("date")
    low, high = (F.date_format(d, "yyyyMMdd").cast("int") for d in (F.date_sub(end, 365 * years), end))
    kept = moves.where((F.col("MoveTypeID") == 1) & (F.col("ChQty") > 0) & F.col("BillDate").between(low, high))
    return kept.select("GoodsNo", "ChQty", "BillDate")


def min_multiple(inbound: DataFrame, threshold: float = 0.6) -> DataFrame:
    """ProductCode, guessed_min and guessed_multiple.

    Each inbound quantity votes for all its divisors; the multiple is the largest divisor with
    ceil(n * threshold) votes, the minimum the smallest quantity that it divides. Votes
    are weighted by how often a product has a quantity, and divisors are worked
    out once for each different quantity.
    """
    qty = F.floor(F.col("ChQty").try_cast("double")).cast("long")
    rows = inbound.select(strip("GoodsNo").alias("ProductCode"), qty.alias("q")).where("q > 0 and ProductCode is not null")
    counts = rows.groupBy("ProductCode", "q").agg(F.count("*").alias("w"))
    divided = counts.select("q").distinct().select("q", F.explode(divisors("q")).alias("d"))
    votes = counts.join(divided, "q").groupBy("ProductCode", "d").agg(F.sum("w").alias("v"))
    needed = counts.groupBy("ProductCode").agg(F.sum("w").alias("n"), F.max("q").alias("top"), F.count("*").alias("kinds"))
    least = F.greatest(F.ceil(F.col("n") * F.lit(threshold)), F.lit(1))
    best = votes.join(needed, "ProductCode").where(F.col("v") >= least).groupBy("ProductCode").agg(F.max("d").alias("guessed_multiple"))
    fits = counts.join(best, "ProductCode").where(F.col("q") % F.col("guessed_multiple") == 0)
    return fits.groupBy("ProductCode", "guessed_multiple").agg(F.min("q").alias("guessed_min")).select("ProductCode", "guessed_min", "guessed_multiple")
