"""Column expressions: text, number, date, hash and stock rules. All are built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def clean_text(x) -> Column:
    """Runs of line breaks and tabs become one blank; ends are stripped."""
    return strip(F.regexp_replace(_c(x), r"[\n\r\t]+", " "))


def clean_code(x) -> Column:
    """Stripped code without a trailing ``.0``; inner dots and leading zeros stay."""
    return F.regexp_replace(strip(x), r"\.0+$", "")


def scrub_number(x, keep_sign: bool = False) -> Column:
    """The digits and dots of a text as a number, 0 where that is none; the sign is dropped unless asked for."""
    kept = F.regexp_replace(_c(x), r"[^\d.\-]" if keep_sign else r"[^\d.]", "")
    return F.coalesce(kept.try_cast("double"), F.lit(0.0))


def first_order_qty(note) -> Column:
    """The first run of digits that stands alone in a note, as text; null if there is none."""
    return F.nullif(F.regexp_extract(_c(note), r"(?U)(?:^|\s)(\d+)(?:\s|$)", 1), F.lit(""))


def note_description(note) -> Column:
    """The note without its standalone numbers; null when nothing is left."""
    left = F.regexp_replace(_c(note), r"(?U)(?<!\S)\d+(?!\S)", " ")
    return F.nullif(strip(F.regexp_replace(left, r"(?U)\s+", " ")), F.lit(""))


def safe_name(x) -> Column:
    """Characters that paths do not take become underscores."""
    return F.translate(_c(x), '/\\:*?"<>|', "_________")


def yyyymmdd(x) -> Column:
    return F.to_date(F.try_to_timestamp(_c(x).cast("string"), F.lit("yyyyMMdd")))


def is_generic(code, name) -> Column:
    hit = (_c(code) == S.GENERIC_CODE) | _c(name).rlike(S.GENERIC_NAMES)
    return F.when(F.coalesce(hit, F.lit(False)), "Yes").otherwise("No")


def adjusted_cost(amount, qty, cost, ratio: float = 0.8) -> Column:
    """The last cost, or ratio times the mean selling price where the cost is missing, not positive, or a ninth of it."""
    unit = F.when(_c(qty) > 0, _c(amount) / _c(qty)).otherwise(0.0)
    cost = F.coalesce(_c(cost), F.lit(0.0))
    return F.when((cost <= 0) | (F.try_divide(unit, cost) > 9), unit * F.lit(ratio)).otherwise(cost)


def strategy_label(abc, xyz) -> Column:
    cells = F.create_map(*[F.lit(x) for pair in S.STRATEGIES.items() for x in pair])
    named = F.coalesce(F.try_element_at(cells, F.concat(_c(abc), _c(xyz))), F.lit(S.STRATEGY_OTHER))
    return F.when(_c(abc) == "New", S.STRATEGY_NEW).when(_c(abc) == "Excluded", S.STRATEGY_EXCLUDED).otherwise(named)


def holiday_category(name, keywords=S.GIFT_HOLIDAYS) -> Column:
    gift = F.lower(_c(name)).rlike("|".join(k.lower() for k in keywords))
    return F.when(_c(name).isNull(), "None").when(gift, "Traditional_Gift").otherwise("Public_Holiday")


def guard_base(base, abc, mean) -> Column:
    """Base demand of at most three monthly means, and the mean where an A or B item came to nothing."""
    known = F.coalesce(_c(mean) > 0, F.lit(False))
    capped = F.when((_c(abc) != "New") & known, F.least(_c(base), _c(mean) * 3)).otherwise(_c(base))
    return F.when((capped <= 0) & _c(abc).isin("A", "B") & known, _c(mean)).otherwise(capped)


def final_demand(base, abc, xyz, index) -> Column:
    """Base demand times the season's index within 1 and 2, for new and erratic items only."""
    boosted = (_c(abc) == "New") | (_c(xyz) == "Z")
    boost = F.greatest(F.lit(1.0), F.least(F.lit(2.0), F.coalesce(_c(index), F.lit(1.0))))
    return _c(base) * F.when(boosted, boost).otherwise(1.0)


def category_boost(abc, xyz, index) -> Column:
    """The season's index, 2 at most, of new and erratic items; 1 for others and without an index."""
    return F.when((_c(abc) == "New") | (_c(xyz) == "Z"), F.least(F.lit(2.0), F.coalesce(_c(index), F.lit(1.0)))).otherwise(1.0)


def target_stock(demand, abc, cv, mean) -> Column:
    """Demand with safety stock, for items with history at most four monthly means (two pieces at least)."""
    share = F.least(F.when(_c(abc) == "A", 0.5).otherwise(0.3), _c(cv) * 0.5)
    target = _c(demand) + _c(demand) * share
    known = (_c(abc) != "New") & F.coalesce(_c(mean) > 0, F.lit(False))
    return F.when(known, F.least(target, F.greatest(_c(mean) * 4, F.lit(2.0)))).otherwise(target)


def c_class_target(mean, first_order) -> Column:
    mean = F.coalesce(_c(mean), F.lit(0.0))
    order = _c(first_order)
    usual = mean * F.lit(1.2)
    return F.when(mean <= 0, 0.0).when((order > 0) & (order <= mean * 12), order).otherwise(usual)


def moq_order(suggested, moq, abc) -> Column:
    """Order under a minimum: C items take it at once, others only when they need over half of it."""
    need = F.greatest(_c(suggested), _c(moq))
    return F.when(_c(abc) == "C", F.when(_c(suggested) > 0, need).otherwise(0.0)).otherwise(
        F.when(_c(suggested) > _c(moq) / 2, need).otherwise(0.0)
    )


def fingerprint(*names: str) -> Column:
    """md5 of ``name=value`` parts in order of name; a null is the empty value."""
    parts = [F.concat(F.lit(f"{n}="), F.coalesce(F.col(n).cast("string"), F.lit(""))) for n in sorted(names)]
    return F.md5(F.concat_ws("|", *parts))


def divisors(n) -> Column:
    """All divisors of a positive whole number."""
    n = _c(n)
    small = F.filter(F.sequence(F.lit(1).cast("long"), F.floor(F.sqrt(n.cast("double"))).cast("long")), lambda d: n % d == 0)
    return F.array_distinct(F.concat(small, F.transform(small, lambda d: F.floor(n / d).cast("long"))))
