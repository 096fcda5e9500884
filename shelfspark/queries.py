"""Registered queries: each applies an operator to the whole derived tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .fixtures import AS_OF, tables
from .functions import columns as C
from .operators import classify as K
from .operators import features, forecast, procurement, publish, receipts, sales, stock, trend, windows
from .sources import buckets
from .sources import tables as sources
from .stable import checkpoint_dir

PUBLISHED = "key string, Name string, CurrStock double"


def _r(df, *names, places=4):
    """df with its doubles rounded."""
    return df.withColumns({n: F.round(n, places) for n in names})


def daily_sales(s, d):
    t = tables(s, d)
    master = t["orders"].select(F.col("o_orderkey").alias("SID"), F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("rDate"))
    goods = t["goods_map"]
    amount = (F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)")
    detail = t["lineitem"].join(goods, F.col("l_partkey") == goods["p_partkey"]).select(F.col("l_orderkey").alias("SalesMasterID"), "GoodsID", F.col("l_quantity").alias("Quantity"), amount.alias("FinalAmt"))
    return sales.daily_sales(detail, master)


def merge_sales(s, d):
    daily = sales.with_month(tables(s, d)["daily"])
    old = daily.where("rDate < date'2001-07-15'").withColumn("TotalQty", F.when(F.col("rDate") >= "2001-07-13", F.col("TotalQty") + 1).otherwise(F.col("TotalQty")))
    return sales.merge_sales(old, daily.where("rDate >= date'2001-07-13'"))


def recent_months(s, d):
    return sales.recent_months(tables(s, d)["daily"])


def sales_summary(s, d):
    return sales.sales_summary(tables(s, d)["daily"])


def month_age(s, d):
    return sales.month_age(tables(s, d)["daily"])


def monthly_sales(s, d):
    return sales.monthly_sales(tables(s, d)["daily"])


def dense_monthly_series(s, d):
    return sales.dense_monthly_series(sales.monthly_sales(tables(s, d)["daily"]))


def stock_master(s, d):
    t = tables(s, d)
    st = t["stock"]
    number = lambda c, n: st.groupBy(F.col(c).alias("Name")).agg(F.min("GoodsID").alias("SID"))
    dept, loc, sup = number("Category", 1), number("InboundLocation", 2), number("Supplier", 3)
    key = lambda dim, c, k: (dim.select(F.col("Name").alias(c), F.col("SID").alias(k)), c)
    goods = st.select(F.col("GoodsID").alias("SID"), F.col("ProductCode").alias("ID"), "Barcode", "Name", "Note", "RetailPrice", "LastInCost", "AvgCost", "Category", "InboundLocation", "Supplier")
    for dim, c, k in ((dept, "Category", "DeptID"), (loc, "InboundLocation", "ProductType1ID"), (sup, "Supplier", "ProductType2ID")):
        goods = goods.join(*key(dim, c, k)).drop(c)
    shops = st.select("GoodsID", F.explode(F.array(F.lit(1), F.lit(2))).alias("ShopID"), "CurrStock").withColumn("CurrStock", F.col("CurrStock") * F.col("ShopID"))
    return stock.stock_master(goods, shops, dept, loc, sup)


def clean_text(s, d):
    return tables(s, d)["stock"].select("GoodsID", C.clean_text("Note").alias("Note"), C.clean_code(F.concat(F.lit(" "), "ProductCode", F.lit(".00 "))).alias("ProductCode"))


def note_parse(s, d):
    return stock.replenishment_view(tables(s, d)["stock"]).select("GoodsID", "FirstOrderQty", "NoteDescription")


def product_columns(s, d):
    return stock.product_columns(tables(s, d)["stock"])


def supplier_dim(s, d):
    st = tables(s, d)["stock"]
    return stock.supplier_dim(st.groupBy(F.col("Supplier").alias("Name")).agg(F.min("GoodsID").alias("SID")))


def inventory_health(s, d):
    t = tables(s, d)
    return _r(stock.inventory_health(t["stock"], t["daily"]), "AvgDailySales", "DaysOfInventory")


def _profit(t):
    return K.with_profit(t["stock"], sales.recent_months(t["daily"]), sales.month_age(t["daily"]))


def adjusted_cost_profit(s, d):
    return _profit(tables(s, d)).select("GoodsID", "Is_Generic", "Month_Age", "SalesDays", "AdjustedCost", "TotalCost", "TotalProfit", "Monthly_Avg_Profit")


def abc_classification(s, d):
    rows = K.abc_classify(_profit(tables(s, d))).select("GoodsID", "ProductCode", "ABC_Class", "ProfitCumulativeRatio")
    return _r(rows, "ProfitCumulativeRatio", places=6)


def xyz_stats(s, d):
    return _r(K.xyz_stats(sales.monthly_sales(tables(s, d)["daily"])), "Mean_Monthly_Qty", "Std_Monthly_Qty", "CV", places=6)


def _classes(t):
    return K.classify(t["stock"], t["daily"])


def abc_xyz_full(s, d):
    rows = _classes(tables(s, d)).select("GoodsID", "ProductCode", "Name", "ABC_Class", "XYZ_Class", "CV", "Mean_Monthly_Qty", "Strategy", "displayname")
    return _r(rows, "CV", "Mean_Monthly_Qty", places=6)


def strategy_labels(s, d):
    return _classes(tables(s, d)).groupBy("ABC_Class", "XYZ_Class", "Strategy").agg(F.count("*").alias("n"))


def class_counts(s, d):
    return K.class_counts(K.abc_classify(_profit(tables(s, d))))


def legacy_abc_v1(s, d):
    t = tables(s, d)
    return K.legacy_abc(t["stock"], t["daily"])


def legacy_abc_v2(s, d):
    t = tables(s, d)
    return K.legacy_abc(t["stock"], t["daily"], new_first=True)


def seasonal_index(s, d):
    t = tables(s, d)
    return _r(forecast.seasonal_index(t["daily"], t["stock"]), "Seasonal_Index")


def run_rate_new(s, d):
    return _r(forecast.run_rate(tables(s, d)["daily"]), "Base")


def _series(t):
    return sales.dense_monthly_series(sales.monthly_sales(t["daily"]))


def trailing_mean(s, d):
    return _r(forecast.trailing_mean(_series(tables(s, d))), "Base")


def z_peak(s, d):
    return forecast.z_peak(_series(tables(s, d)))


def legacy_median6(s, d):
    return forecast.median_last(_series(tables(s, d)))


def legacy_last_weeks(s, d):
    return forecast.last_weeks(tables(s, d)["daily"])


def forecast_next_month(s, d):
    return _r(forecast.forecast_next_month(sales.monthly_sales(tables(s, d)["daily"])), "Base")


def forecast_backtest(s, d):
    return _r(trend.backtest(sales.monthly_sales(tables(s, d)["daily"])), "mae_fit", "mae_mean")


def c_class_target(s, d):
    t = tables(s, d)
    stats = K.xyz_stats(sales.monthly_sales(t["daily"])).select("GoodsID", "Mean_Monthly_Qty")
    first = stock.replenishment_view(t["stock"]).select("GoodsID", F.col("FirstOrderQty").try_cast("double").alias("f"))
    rows = first.join(stats, "GoodsID", "left")
    return rows.select("GoodsID", F.round(C.c_class_target("Mean_Monthly_Qty", "f"), 4).alias("Target_Stock"))


def _plan(t, model=True, boost=False):
    return forecast.target_plan(_classes(t), stock.replenishment_view(t["stock"]), t["daily"], model, boost=boost)


def target_plan(s, d):
    """The plan with the last three months' mean in place of the fitted month."""
    return _plan(tables(s, d), False)


def target_plan_model(s, d):
    return _plan(tables(s, d))


def plan_by_target(s, d):
    """The plan in order of target stock, the largest first; the place is a column, so that the order is compared."""
    return publish.ranked(_plan(tables(s, d)), [F.col("Target_Stock").desc(), F.col("ProductCode")]).select("place", "ProductCode", "Target_Stock")


def price_list_order(s, d):
    rows = tables(s, d)["stock"].select(F.col("Supplier").alias("supplier"), F.col("ProductCode").alias("product_code"))
    return publish.ranked(rows, [F.col("supplier"), F.col("product_code")]).select("place", "supplier", "product_code")


def inbound_order(s, d):
    """All movements by item and day; equal ones follow each other."""
    moves = procurement.inbound_movements(tables(s, d)["inbound"], AS_OF)
    return publish.ranked_rows(moves, ["GoodsNo", "BillDate"]).select("place", "GoodsNo", "BillDate", "ChQty")


def class_order(s, d):
    """New, A, B, C, Excluded; the best monthly profit first, then the item's number."""
    rows = K.abc_classify(_profit(tables(s, d))).select("ABC_Class", "Monthly_Avg_Profit", "GoodsID")
    return publish.ranked(rows, [K.class_rank(), F.col("Monthly_Avg_Profit").desc(), F.col("GoodsID")]).select("place", "ABC_Class", "GoodsID")


def _orders(t):
    return forecast.order_suggestion(_plan(t, boost=True))


def order_suggestion_moq(s, d):
    return _orders(tables(s, d)).select("ProductCode", "ABC_XYZ", F.round("Suggested_Order", 2).alias("Suggested_Order"), F.round("Final_Order", 2).alias("Final_Order"))


def order_list_by_class(s, d):
    """The order list by class, what is missing most first."""
    return publish.ranked(_orders(tables(s, d)), [F.col("ABC_XYZ"), F.col("Suggested_Order").desc(), F.col("ProductCode")]).select("place", "ABC_XYZ", "ProductCode")


def order_list_by_order(s, d):
    return publish.ranked(_orders(tables(s, d)), [F.col("Final_Order").desc(), F.col("ProductCode")]).select("place", "ProductCode", F.round("Final_Order", 2).alias("Final_Order"))


def plan_summary(s, d):
    return _r(forecast.plan_summary(_orders(tables(s, d))), "mean_boost", places=2)


def plan_upload(s, d):
    return publish.plan_upload_rows(_plan(tables(s, d)).withColumn("ProductCode", F.concat(F.lit(" "), "ProductCode")))


def inbound_movements(s, d):
    return procurement.inbound_movements(tables(s, d)["inbound"], AS_OF)


def min_multiple(s, d):
    return procurement.min_multiple(procurement.inbound_movements(tables(s, d)["inbound"], AS_OF))


def _changed(t):
    now = publish.product_key(t["stock"])
    before = now.where("GoodsID % 11 <> 0").withColumns(
        {"CurrStock": F.when(F.col("GoodsID") % 7 == 0, F.col("CurrStock") + 1).otherwise(F.col("CurrStock")), "AvgCost": F.when(F.col("GoodsID") % 5 == 0, F.col("AvgCost") * 2).otherwise(F.col("AvgCost"))}
    )
    names = [c for c in now.columns if c not in ("AvgCost", "key")]
    return publish.changed_rows(now, publish.fingerprints(before, "products", names), "products")


def changed_rows(s, d):
    return _changed(tables(s, d)).select("key", "GoodsID", "CurrStock")


def publish_changes(s, d):
    """The bucketed target after an older stock and then today's were published by fingerprint."""
    now = publish.product_key(tables(s, d)["stock"]).select("key", "Name", "CurrStock")
    older = now.withColumn("CurrStock", F.when(F.length("Name") % 3 == 0, F.col("CurrStock") + 1).otherwise(F.col("CurrStock")))
    folder = f"{checkpoint_dir(s)}/publish-{uuid.uuid4().hex}"
    for df in (older, now):
        buckets.publish_changes(s, df, "products", ["Name", "CurrStock"], f"{folder}/target", f"{folder}/state", PUBLISHED)
    return buckets.read_buckets(s, f"{folder}/target", PUBLISHED)


def merge_upsert(s, d):
    t = tables(s, d)
    target = publish.product_key(t["stock"]).where("GoodsID % 11 <> 0").select("key", "Name", "CurrStock", "Note")
    update = publish.product_key(t["stock"]).where("GoodsID % 7 = 0").select("key", (F.col("CurrStock") + 5).alias("CurrStock"), F.lit(None).cast("string").alias("Note"), "Supplier")
    return publish.merge_upsert(target, update)


def changed_classification(s, d):
    t = tables(s, d)
    rows = K.abc_classify(_profit(t)).withColumn("XYZ_Class", F.lit("X")).withColumnRenamed("Note", "note")
    before = rows.withColumn("ABC_Class", F.when(F.col("GoodsID") % 9 == 0, "C").otherwise(F.col("ABC_Class")))
    marked = before.select("ProductCode", "ABC_Class", "XYZ_Class", "note").withColumn("key", F.trim("ProductCode"))
    state = publish.fingerprints(marked, "classification", ["ProductCode", "ABC_Class", "XYZ_Class", "note"])
    return publish.changed_classification(rows, state).select("key", "ABC_Class", "XYZ_Class", "note")


def changed_min_multiple(s, d):
    guessed = procurement.min_multiple(procurement.inbound_movements(tables(s, d)["inbound"], AS_OF))
    before = guessed.withColumn("guessed_min", F.when(F.col("guessed_min") > 12, F.lit(1).cast("long")).otherwise(F.col("guessed_min"))).withColumn("key", F.col("ProductCode"))
    state = publish.fingerprints(before, "min_multiple", ["ProductCode", "guessed_min", "guessed_multiple"])
    return publish.changed_min_multiple(guessed, state).select("ProductCode", "guessed_min", "guessed_multiple")


def doc_ids(s, d):
    rows = tables(s, d)["stock"].select(F.when(F.col("GoodsID") % 3 == 0, F.col("Barcode")).alias("ID"), F.when(F.col("GoodsID") % 2 == 0, F.concat("Supplier", F.lit("/"), "GoodsID")).alias("Name"), F.col("GoodsID").alias("ord"))
    return publish.doc_id(rows).select("ord", "doc_id")


def calendar_features(s, d):
    """Calendar days with the number of events on each day."""
    t = tables(s, d)
    days = t["events"].groupBy(F.to_date("ts").alias("date")).agg(F.count("*").alias("n_events"))
    return features.calendar_features(s, t["holidays"], 2023, 2025).join(days, "date", "left")


def next_prev_holiday(s, d):
    """The holiday on or after each event, and the days since the one on or before it."""
    t = tables(s, d)
    # The list of holidays is configuration, some ten a year: one sorted array, sent to every task.
    days = t["holidays"].agg(F.sort_array(F.collect_list(F.struct("date", "holiday_name"))).alias("hs"))
    facts = t["events"].select("event_id", F.to_date("ts").alias("day")).join(F.broadcast(days))
    facts = facts.withColumn("next", F.expr("get(filter(hs, x -> x.date >= day), 0)")).withColumn("prev", F.expr("element_at(filter(hs, x -> x.date <= day), -1)"))
    return facts.select(
        "event_id", F.datediff("next.date", "day").alias("days_ahead"), F.col("next.holiday_name").alias("holiday_name"), F.datediff("day", "prev.date").alias("days_since")
    )


def last_purchase(s, d):
    """For each event the user's last purchase at or before it: the keyed as-of join on a large table."""
    ev = tables(s, d)["events"]
    bought = ev.where("event_type = 'purchase'").groupBy("user_id", F.col("ts").alias("bought_at")).agg(F.max("value").alias("paid"))
    return windows.as_of(ev.select("event_id", "user_id", "ts"), bought, "user_id", "ts", "bought_at", ["paid"]).select("event_id", "paid")


def last_purchase_spread(s, d):
    """The same look-up by ranges of user and time, for tables in which one user may hold a large share."""
    ev = tables(s, d)["events"]
    bought = ev.where("event_type = 'purchase'").groupBy("user_id", F.col("ts").alias("bought_at")).agg(F.max("value").alias("paid"))
    return windows.as_of(ev.select("event_id", "user_id", "ts"), bought, "user_id", "ts", "bought_at", ["paid"], spread=True).select("event_id", "paid")


def weather_features(s, d):
    """Daily means of the events' value by event type, every fifth day missing, as stations' temperatures."""
    ev = tables(s, d)["events"]
    day = ev.groupBy(F.col("event_type").alias("station"), F.to_date("ts").alias("date")).agg((F.sum(F.col("value").cast("decimal(18,4)")) / F.count("*")).cast("double").alias("mean_temp"))
    day = day.withColumn("mean_temp", F.when(F.dayofmonth("date") % 5 != 0, F.round("mean_temp", 2)))
    return _r(features.weather_features(day, "2024-01-03", "2024-01-28"), "temp_ma_7", "temp_diff")


def _clean(t):
    return receipts.clean_receipts(t["receipts"], "20011104")


def receipt_clean(s, d):
    return _clean(tables(s, d)).select("file", "line", "barcode", "unit_cost", "qty", "item_name", "supplier", "in_date", "product_code")


def _resolved(t):
    return receipts.resolve_products(_clean(t), t["mapping"], t["stock"])


def resolve_products(s, d):
    return _resolved(tables(s, d)).select("file", "line", "barcode", "how", "reason", "product_code")


def barcode_options(s, d):
    t = tables(s, d)
    return receipts.barcode_options(_resolved(t), t["stock"]).select("barcode", F.expr("array_join(transform(options, o -> concat(o.ProductCode, ':', o.Name)), '|')").alias("options"))


def receipt_summary(s, d):
    return receipts.receipt_summary(_resolved(tables(s, d)))


def reason_counts(s, d):
    return receipts.reason_counts(_resolved(tables(s, d)))


def pos_import_layout(s, d):
    return receipts.pos_import_layout(receipts.matched(_resolved(tables(s, d))))


def _manual(t):
    """Unknown lines in which staff wrote a code: every third item's own code, every seventh one that is not in the POS."""
    rows = t["receipts"].where("barcode like 'X%'")
    n = F.col("l_partkey")
    code = F.when(n % 7 == 0, "99999999").when(n % 3 == 0, F.lpad((10000 + n).cast("string"), 8, "0")).when(n % 3 == 1, "00010004")
    return rows.select("file", "line", "barcode", "item_name", code.alias("manual_code"))


def mapping_verdicts(s, d):
    t = tables(s, d)
    return receipts.judge_mapping(t["mapping"], _manual(t), t["stock"])


def mapping_upsert(s, d):
    t = tables(s, d)
    return receipts.upsert_mapping(t["mapping"], _manual(t), t["stock"], "new")


def _prices(t):
    """A price list of the items with two dozen in stock at least."""
    rows = t["stock"].where("CurrStock >= 24")
    return rows.select("Supplier", "Barcode", "Name", F.lit("1").alias("cs"), F.lit("2").alias("qty"), F.lit("3").alias("rp"), F.when(F.col("GoodsID") % 4 == 0, "v").otherwise("").alias("check"), "ProductCode", F.lit("4").alias("uc"), F.lit("t0").alias("at"), F.lit("f0").alias("src")).toDF(
        "supplier", "barcode", "item_name", "curr_stock", "qty", "retail_price", "check", "product_code", "unit_cost", "updated_at", "source_file"
    )


def price_list_upsert(s, d):
    t = tables(s, d)
    out = receipts.upsert_price_list(_prices(t), receipts.matched(_resolved(t)), t["stock"], "t1", "f1")
    return out.select("product_code", "supplier", "barcode", "item_name", "qty", "unit_cost", "curr_stock", "retail_price", "check", "updated_at", "source_file")


def price_list_delta(s, d):
    t = tables(s, d)
    return receipts.price_list_delta(_prices(t), receipts.matched(_resolved(t)))


def _sheets(t):
    """Receipt sheets from order lines: two title lines, a header in the supplier's words, then the lines."""
    from pyspark.sql import Window

    rows = t["receipts"].withColumn("n", F.row_number().over(Window.partitionBy("file").orderBy("line", "l_partkey", "unit_cost", "qty")) + 3)
    body = rows.select("file", F.col("n").alias("line"), F.array("barcode", "item_name", "qty", "unit_cost").alias("cells"))
    s = F.substring("file", 5, 1)
    files = rows.select("file").distinct()
    head = F.array(F.concat(F.lit(" Code"), s), F.concat(F.lit("ITEM"), s), F.concat(F.lit("Qty"), s), F.concat(F.lit("Price"), s))
    title = files.select("file", F.lit(1).alias("line"), F.array(F.concat(F.lit("Price list of "), "file")).alias("cells"))
    blank = files.select("file", F.lit(2).alias("line"), F.array(F.lit("")).alias("cells"))
    return title.unionByName(blank).unionByName(files.select("file", F.lit(3).alias("line"), head.alias("cells"))).unionByName(body)


def _config(t):
    """One supplier for each kind of sheet but two, from the receipts."""
    s = F.substring("file", 5, 1)
    rows = t["receipts"].select(s.alias("file")).distinct()
    s = F.col("file")
    n = s.cast("int")
    rows = rows.where(n < 5)
    return rows.select(n.alias("ord"), F.concat(F.lit("Supplier "), s).alias("supplier"), F.concat(F.lit("code"), s).alias("barcode_col"), F.concat(F.lit("price"), s).alias("price_col"), F.concat(F.lit("qty"), s).alias("qty_col"), F.concat(F.lit("item"), s).alias("name_col"), F.lit("No").alias("markup_flag"))


def header_discovery(s, d):
    t = tables(s, d)
    found = receipts.find_header(_sheets(t), receipts.search_keywords(_config(t)))
    return found.select("file", "line", "score", F.array_join("cells", "|").alias("cells"))


def _identified(t):
    return receipts.identify_supplier(receipts.find_header(_sheets(t), receipts.search_keywords(_config(t))), _config(t))


def supplier_identify(s, d):
    return _identified(tables(s, d)).select("file", "line", "supplier")


def receipt_rows(s, d):
    t = tables(s, d)
    return receipts.receipt_rows(_sheets(t), _identified(t)).select("file", "line", "supplier", "barcode", "item_name", "qty", "unit_cost")


def station_temperature(s, d):
    """Temperature sheets as text lines, built from the events' days."""
    from pyspark.sql import Window

    day = tables(s, d)["events"].groupBy(F.to_date("ts").alias("d")).agg(F.count("*").alias("n"))
    text = F.concat_ws(",", F.year("d"), F.month("d"), F.when(F.dayofmonth("d") % 9 == 0, "x").otherwise(F.dayofmonth("d").cast("string")), F.when(F.col("n") % 2 == 0, F.col("n").cast("string")).otherwise("***"), F.lit("C"))
    rows = day.select((F.row_number().over(Window.orderBy("d")) + 1).alias("line"), text.alias("value"))
    extra = s.createDataFrame([(0, "station"), (1, "year,month,day,value,completeness"), (99999, "*** unavailable")], "line int, value string")
    return sources.station_temperature(extra.unionByName(rows))


def stream_daily_sales(s, d):
    """The batch twin of the daily-sales stream: sums a user and day over the purchases."""
    ev = tables(s, d)["events"].where("event_type = 'purchase'")
    from .streaming.jobs import stream_daily_sales as job

    rows = ev.select("ts", F.col("user_id").alias("u"), F.lit(1.0).alias("Quantity"), F.col("value").alias("FinalAmt"))
    return job(rows, key="u")


QUERIES = {
    f.__name__: f
    for f in (
        abc_classification, daily_sales, merge_sales, recent_months, sales_summary, month_age, monthly_sales, dense_monthly_series, stock_master, clean_text,
        note_parse, product_columns, supplier_dim, inventory_health, adjusted_cost_profit, xyz_stats, abc_xyz_full, strategy_labels, class_counts,
        legacy_abc_v1, legacy_abc_v2, seasonal_index, run_rate_new, trailing_mean, z_peak, legacy_median6, legacy_last_weeks, forecast_next_month, forecast_backtest, c_class_target,
        target_plan, target_plan_model, plan_by_target, price_list_order, inbound_order, class_order, order_suggestion_moq, order_list_by_class, order_list_by_order, plan_summary, plan_upload, inbound_movements, min_multiple, changed_rows, merge_upsert, publish_changes, changed_classification,
        changed_min_multiple, doc_ids, calendar_features, next_prev_holiday, last_purchase, last_purchase_spread, weather_features, receipt_clean, resolve_products, barcode_options,
        receipt_summary, reason_counts, pos_import_layout, mapping_verdicts, mapping_upsert, price_list_upsert, price_list_delta, header_discovery, supplier_identify,
        receipt_rows, station_temperature, stream_daily_sales,
    )
}
