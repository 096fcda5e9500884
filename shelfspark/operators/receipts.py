"""Supplier receipts: header, supplier, cleaning, product resolution, mapping and price list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import clean_code, scrub_number, strip


def search_keywords(config: DataFrame) -> DataFrame:
    cols = F.array("barcode_col", "price_col", "qty_col", "name_col")
    return config.select(F.explode(cols).alias("keyword")).where("keyword is not null and trim(keyword) <> ''").distinct()


def find_header(lines: DataFrame, keywords: DataFrame, first: int = 20, least: int = 2) -> DataFrame:
    """file, line and cells of each file's header: of the first 20 lines that are not blank the one with most keywords."""
    words = keywords.agg(F.collect_set(F.lower("keyword")).alias("__kw"))  # one row, as long as the configuration
    text = F.lower(F.array_join("cells", " ", ""))
    rows = lines.where(F.trim(text) != "").withColumn("__n", F.row_number().over(Window.partitionBy("file").orderBy("line")))
    rows = rows.where(F.col("__n") <= first).join(F.broadcast(words)).withColumn("__text", text)
    rows = rows.withColumn("score", F.size(F.filter("__kw", lambda k: F.contains(F.col("__text"), k))))
    best = Window.partitionBy("file").orderBy(F.col("score").desc(), "line")
    rows = rows.where(F.col("score") >= least).withColumn("__r", F.row_number().over(best)).where("__r = 1")
    return rows.select("file", "line", "cells", "score")


def rejected_files(lines: DataFrame, headers: DataFrame) -> DataFrame:
    return lines.select("file").distinct().join(headers, "file", "left_anti")


def identify_supplier(headers: DataFrame, config: DataFrame) -> DataFrame:
    """The first supplier in order whose four header names are all in the file's header; files without one are missing.

    An inverted index: a supplier is looked up under the one of its names that fewest suppliers have, so a file meets
    only suppliers that share such a name with it, and each pair is tested once for the other three.
    """
    norm = lambda c: F.lower(F.trim(c))
    need = config.select(
        F.struct("ord", *[c for c in config.columns if c != "ord"]).alias("__c"),
        F.array_distinct(F.array(*[norm(F.col(c)) for c in ("barcode_col", "price_col", "qty_col", "name_col")])).alias("__need"),
    )
    names = need.select("__c", "__need", F.explode("__need").alias("__name"))
    counts = names.groupBy("__name").agg(F.count("*").alias("__n"))
    rarest = names.join(counts, "__name").groupBy("__c", "__need").agg(F.min(F.struct("__n", "__name")).alias("__r"))
    index = rarest.select("__c", "__need", F.col("__r.__name").alias("__name"))
    have = headers.withColumn("__have", F.transform("cells", norm))
    words = have.select("file", "line", "cells", "__have", F.explode(F.array_distinct("__have")).alias("__name"))
    hit = words.join(index, "__name").where(F.size(F.array_except("__need", "__have")) == 0)
    return hit.groupBy("file").agg(F.min("__c").alias("c"), F.min("line").alias("line"), F.min("cells").alias("cells")).select("file", "line", "cells", "c.*")


def receipt_rows(lines: DataFrame, found: DataFrame) -> DataFrame:
    """Lines below each header as barcode, price, qty, name texts by the supplier's header names."""
    head = found.select("file", F.col("line").alias("__h"), F.transform("cells", lambda c: F.lower(F.trim(c))).alias("__names"), "supplier", "markup_flag", "barcode_col", "price_col", "qty_col", "name_col")
    rows = lines.join(head, "file").where(F.col("line") > F.col("__h"))
    rows = rows.where(F.exists("cells", lambda c: F.trim(c) != ""))
    pick = lambda c: F.get("cells", F.array_position("__names", F.lower(F.trim(F.col(c)))).cast("int") - 1)
    return rows.select("file", "line", "supplier", "markup_flag", *[pick(c).alias(n) for c, n in (("barcode_col", "barcode"), ("price_col", "unit_cost"), ("qty_col", "qty"), ("name_col", "item_name"))])


def clean_receipts(rows: DataFrame, in_date: str, keep_sign: bool = False) -> DataFrame:
    """Canonical receipt lines: clean codes, numbers, markup of 1.2 where the supplier has it, fixed columns, valid lines only."""
    cost = scrub_number("unit_cost", keep_sign)
    marked = F.trim(F.col("markup_flag")).isin(*S.MARKUP_FLAGS)
    rows = rows.select(
        "file",
        "line",
        clean_code("barcode").alias("barcode"),
        F.when(F.coalesce(marked, F.lit(False)), F.bround(cost * 1.2, 2)).otherwise(cost).alias("unit_cost"),
        scrub_number("qty", keep_sign).cast("int").alias("qty"),
        F.col("item_name"),
        "supplier",
        F.lit("S1").alias("shop"),
        F.lit(in_date).alias("in_date"),
        F.lit("").alias("receipt_no"),
        F.lit("001").alias("supplier_no"),
        F.lit("").alias("remark"),
        F.lit("").alias("status"),
    )
    return rows.where((F.col("barcode") != "") & (F.lower("barcode") != "nan") & (F.col("qty") > 0)).withColumn("product_code", F.col("barcode"))


def resolve_products(lines: DataFrame, mapping: DataFrame, stock: DataFrame) -> DataFrame:
    """Lines with product_code, how ('mapping', 'code', 'barcode', 'unknown', 'blank') and reason.

    A mapping of barcode and name comes first, then the barcode as a product code; a shared
    barcode and an unknown one are left to staff. Look-up sides are reduced to one row a key
    before the join, so no line is doubled; blank barcodes never match.
    """
    code = clean_code("barcode")
    rows = lines.withColumn("__b", F.when((code != "") & (F.lower(code) != "nan"), code)).withColumn("__n", strip("item_name"))
    first = Window.partitionBy("__mb", "__mn").orderBy("ord")
    known = mapping.select(clean_code("barcode").alias("__mb"), strip("item_name").alias("__mn"), F.col("product_code").alias("__code"), "ord")
    known = known.withColumn("__r", F.row_number().over(first)).where("__r = 1").drop("__r", "ord")
    codes = stock.select(clean_code("ProductCode").alias("__pc")).where("__pc <> ''").distinct()
    barcodes = stock.select(clean_code("Barcode").alias("__bc")).where("__bc <> ''").distinct()
    rows = rows.join(known, (F.col("__b") == F.col("__mb")) & (F.col("__n") == F.col("__mn")), "left")
    rows = rows.join(codes, F.col("__b") == F.col("__pc"), "left").join(barcodes, F.col("__b") == F.col("__bc"), "left")
    how = (
        F.when(F.col("__b").isNull(), "blank")
        .when(F.col("__code").isNotNull(), "mapping")
        .when(F.col("__pc").isNotNull(), "code")
        .when(F.col("__bc").isNotNull(), "barcode")
        .otherwise("unknown")
    )
    rows = rows.withColumn("how", how)
    reason = F.when(F.col("how") == "barcode", S.REASON_SHARED).when(F.col("how") == "unknown", S.REASON_UNKNOWN).when(F.col("how") == "blank", "")
    found = F.when(F.col("how") == "mapping", F.col("__code")).when(F.col("how") == "code", F.col("__b")).otherwise(F.lit(None).cast("string"))
    return rows.withColumns({"reason": reason, "product_code": found}).drop("__b", "__n", "__mb", "__mn", "__code", "__pc", "__bc")


def matched(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col("how").isin("mapping", "code"))


def unmatched(resolved: DataFrame) -> DataFrame:
    return resolved.where(~F.col("how").isin("mapping", "code"))


def barcode_options(lines: DataFrame, stock: DataFrame) -> DataFrame:
    """barcode and its candidates (ProductCode, Name), sorted, for lines whose barcode several products share."""
    asked = lines.where("how = 'barcode'").select(clean_code("barcode").alias("barcode")).distinct()
    named = stock.select(clean_code("Barcode").alias("barcode"), "ProductCode", "Name")
    options = asked.join(named, "barcode").groupBy("barcode").agg(F.sort_array(F.collect_list(F.struct("ProductCode", "Name"))).alias("options"))
    return options


def reason_counts(resolved: DataFrame) -> DataFrame:
    return unmatched(resolved).groupBy("reason").agg(F.count("*").alias("n"))


def receipt_summary(resolved: DataFrame) -> DataFrame:
    """Lines by outcome for each file, and for the run (file null)."""
    n = lambda *kinds: F.sum(F.col("how").isin(*kinds).cast("long"))
    return resolved.rollup("file").agg(
        F.count("*").alias("total"), n("mapping").alias("by_mapping"), n("code").alias("by_code"), n("barcode").alias("barcode_only"), n("unknown", "blank").alias("unmatched")
    )


def pos_import_layout(lines: DataFrame) -> DataFrame:
    return lines.select(*[(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in lines.columns else F.lit("")).alias(c) for c in S.POS_LAYOUT])


def split_filled(manual: DataFrame) -> tuple[DataFrame, DataFrame]:
    code = F.lower(F.trim(F.coalesce("manual_code", F.lit(""))))
    empty = code.isin("", "nan")
    return manual.where(~empty), manual.where(empty)


def judge_mapping(mapping: DataFrame, manual: DataFrame, stock: DataFrame) -> DataFrame:
    """Filled manual rows with verdict 'ok', 'not in POS' or 'code in use'.

    A code is in use when the mapping gives it to another barcode and name, or an
    earlier row of the batch (by file and line) claims it for another. Rows without barcode or name are left out.
    """
    filled, _ = split_filled(manual)
    rows = filled.select("file", "line", clean_code("barcode").alias("barcode"), strip("item_name").alias("item_name"), clean_code("manual_code").alias("product_code"))
    rows = rows.where("barcode <> '' and lower(barcode) <> 'nan' and item_name <> ''")
    codes = stock.select(clean_code("ProductCode").alias("product_code")).distinct().withColumn("__pos", F.lit(1))
    rows = rows.join(codes, "product_code", "left")
    given = mapping.select(strip("product_code").alias("product_code"), clean_code("barcode").alias("barcode"), strip("item_name").alias("item_name")).distinct()
    rows = rows.join(given.select("product_code").distinct().withColumn("__used", F.lit(1)), "product_code", "left")
    rows = rows.join(given.withColumn("__mine", F.lit(1)), ["product_code", "barcode", "item_name"], "left")
    me = F.struct(F.col("barcode").alias("b"), F.col("item_name").alias("n"))
    taken = F.col("__used").isNotNull() & F.col("__mine").isNull()
    open_ = F.col("__pos").isNotNull() & ~taken
    w = Window.partitionBy("product_code").orderBy("file", "line").rowsBetween(Window.unboundedPreceding, 0)
    claim = F.first(F.when(open_, me), ignorenulls=True).over(w)
    rows = rows.withColumn("__claim", claim)
    verdict = F.when(F.col("__pos").isNull(), "not in POS").when(taken | (F.col("__claim") != me), "code in use").otherwise("ok")
    return rows.withColumn("verdict", verdict).select("file", "line", "barcode", "item_name", "product_code", "verdict")


def upsert_mapping(mapping: DataFrame, manual: DataFrame, stock: DataFrame, supplier: str = "") -> DataFrame:
    """The mapping with accepted manual codes set or added; of several for one barcode and name the last counts."""
    good = judge_mapping(mapping, manual, stock).where("verdict = 'ok'")
    last = Window.partitionBy("barcode", "item_name").orderBy(F.col("file").desc(), F.col("line").desc())
    good = good.withColumn("__r", F.row_number().over(last)).where("__r = 1").select("barcode", "item_name", F.col("product_code").alias("__new"))
    old = mapping.select(clean_code("barcode").alias("barcode"), strip("item_name").alias("item_name"), "product_code", "supplier")
    both = old.join(good, ["barcode", "item_name"], "full")
    return both.select("barcode", "item_name", F.coalesce("__new", "product_code").alias("product_code"), F.when(F.col("__new").isNotNull(), supplier).otherwise(F.col("supplier")).alias("supplier"))


def attach_stock_price(rows: DataFrame, stock: DataFrame) -> DataFrame:
    """CurrStock and RetailPrice as text by product code, from the first match, empty if there is none."""
    look = stock.groupBy(clean_code("ProductCode").alias("__pc")).agg(F.min(F.struct("GoodsID", "CurrStock", "RetailPrice")).alias("__s"))
    text = lambda c: F.coalesce(F.col(f"__s.{c}").cast("string"), F.lit(""))
    out = rows.join(look, F.trim("product_code") == F.col("__pc"), "left")
    return out.withColumns({"curr_stock": text("CurrStock"), "retail_price": text("RetailPrice")}).drop("__pc", "__s")


def _batch(lines: DataFrame, stock: DataFrame, updated_at: str, source: str) -> DataFrame:
    code = F.trim("product_code")
    first = Window.partitionBy("product_code").orderBy("file", "line")
    rows = lines.withColumn("product_code", code).where("product_code <> '' and lower(product_code) <> 'nan'")
    rows = attach_stock_price(rows.withColumn("__r", F.row_number().over(first)).where("__r = 1").drop("__r"), stock)
    return rows.withColumns({"updated_at": F.lit(updated_at), "source_file": F.lit(source)})


def upsert_price_list(prices: DataFrame, lines: DataFrame, stock: DataFrame, updated_at: str, source: str = "") -> DataFrame:
    """The price list with the batch's quantity, cost, stock and price; a check mark and the barcode stay as they were."""
    new = _batch(lines, stock, updated_at, source).select(*[F.trim(F.col(c).cast("string")).alias(f"__{c}") for c in S.PRICE_LIST if c != "check"])
    both = prices.join(new, F.trim(prices["product_code"]) == new["__product_code"], "full")
    given, old = F.col("__product_code").isNotNull(), F.col("product_code").isNotNull()
    take = lambda c: F.when(given, F.col(f"__{c}")).otherwise(F.col(c)).alias(c)
    fill = lambda c: F.when(given & (F.coalesce(f"__{c}", F.lit("")) != ""), F.col(f"__{c}")).otherwise(F.col(c)).alias(c)
    keep = lambda c: F.when(old, F.col(c)).otherwise(F.col(f"__{c}")).alias(c)
    how = {"supplier": fill, "item_name": fill, "barcode": keep, "product_code": keep}
    return both.select(*[F.coalesce("check", F.lit("")).alias("check") if c == "check" else how.get(c, take)(c) for c in S.PRICE_LIST])


def price_list_delta(prices: DataFrame, lines: DataFrame) -> DataFrame:
    """How many codes of a batch are new to the list, and how many are updated; taken before the merge."""
    new = lines.select(F.trim("product_code").alias("c")).where("c <> '' and lower(c) <> 'nan'").distinct()
    old = prices.select(F.trim("product_code").alias("__o")).distinct()
    rows = new.join(old, F.col("c") == F.col("__o"), "left")
    return rows.agg(F.sum(F.col("__o").isNull().cast("long")).alias("added"), F.sum(F.col("__o").isNotNull().cast("long")).alias("updated"))
