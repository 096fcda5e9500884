"""Fixed values and schemas of the retail tables."""

# Labels, patterns and layouts that results must carry as they are.
GENERIC_CODE = "202320232023"
GENERIC_NAMES = "五金家品|Deleted|膠袋徵費|塑膠袋"
STRATEGIES = {
    "AX": "自動補貨 (高頻穩定)",
    "AY": "AI 季節性預測 (重點對象)",
    "AZ": "高安全庫存 (利潤高但難抓)",
    "BX": "定期補貨",
    "BY": "季節性補貨",
    "BZ": "觀望/依訂單進貨",
    "CX": "基本品 (低庫存管理)",
    "CY": "季節品 (減少庫存)",
    "CZ": "不建議預測 (考慮汰換)",
}
STRATEGY_NEW, STRATEGY_EXCLUDED, STRATEGY_OTHER = "新品觀察 (手動控貨)", "排除對象", "其他"
GIFT_HOLIDAYS = (
    "Lunar New Year",
    "Chinese New Year",
    "Mid-Autumn",
    "Dragon Boat",
    "Chung Yeung",
    "Qingming",
    "Easter",
    "Christmas",
)
REASON_SHARED = "共用條碼，需人手選擇顏色或大小"
REASON_UNKNOWN = "可能是條碼錯誤或新貨品"
MARKUP_FLAGS = ("是", "Yes", "TRUE", "True", "1")
PRODUCT_COLUMNS = ("ProductCode", "Barcode", "Name", "CurrStock", "RetailPrice", "Category", "Supplier")
POS_LAYOUT = (
    "product_code",
    "barcode",
    "item_name",
    "unit_cost",
    "qty",
    "shop",
    "in_date",
    "receipt_no",
    "supplier_no",
    "supplier",
    "remark",
    "status",
    "system_note",
)
PRICE_LIST = (
    "supplier",
    "barcode",
    "item_name",
    "curr_stock",
    "qty",
    "retail_price",
    "check",
    "product_code",
    "unit_cost",
    "updated_at",
    "source_file",
)

DAILY_SALES = "GoodsID long, rDate date, TotalQty double, TotalAmt double, year string, month string"
SUPPLIER_CONFIG = (
    "ord int, supplier string, barcode_col string, price_col string, qty_col string, name_col string, markup_flag string"
)


def require_columns(df, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
