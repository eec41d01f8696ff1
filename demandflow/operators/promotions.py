"""Promotion calendars and the best-discount match.

A promotion applies to a row when its dates overlap the row's period and it names the row's
product or category and the row's store or region. Tested pair by pair that is a nested loop.
Here a sweep over the start and end dates flattens the promotions of one (item, scope) into
disjoint steps with their best discount, kept span by span. A row then needs four equality
lookups, each of which finds at most one span of steps, and no row is ever multiplied.
"""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandflow.functions.calendar import week_start
from demandflow.operators.dimensions import fits_broadcast
from demandflow.schemas import SERIES

# (promotion column, row column) for the two ways to name an item and the two ways to name a scope
ITEM_TARGETS = (("target_sku", "sku"), ("target_category", "category"))
SCOPE_TARGETS = (("target_store_id", "store_id"), ("target_region", "region"))


def explode_promos(promos: DataFrame, grain: str = "week", period: str = "period") -> DataFrame:
    """One row per promotion and day, or per promotion and Monday of a week it touches."""
    usable = promos.where("promo_end_date >= promo_start_date")
    start, end = F.col("promo_start_date"), F.col("promo_end_date")
    if grain == "day":
        days = F.sequence(start, end, F.expr("INTERVAL 1 DAY"))
    elif grain == "week":
        days = F.sequence(week_start(start), week_start(end), F.expr("INTERVAL 7 DAYS"))
    else:
        raise ValueError(f"grain must be 'day' or 'week', not {grain!r}")
    return usable.withColumn(period, F.explode(days))


# Steps are kept by spans of whole weeks, which bounds them: a span has at most 91 days, so at most
# 91 steps, and at most 91 * 92 / 2 different intervals, however many promotions a key has.
SPAN_DAYS = 91
FIRST_MONDAY = date(1900, 1, 1)
# Promotions without an end in sight do not make spans beyond these years.
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2199, 12, 31)


class PromoSteps(NamedTuple):
    """Discount steps, and whether they were measured to be small enough to broadcast: all of them, or those of
    regions, which do not grow with the number of stores."""

    rows: DataFrame
    small: bool = False
    small_regions: bool = False


def span_of(day: Column) -> Column:
    """Number of the span a day is in; a week never straddles two."""
    return F.floor(F.date_diff(day, F.lit(FIRST_MONDAY)) / SPAN_DAYS).cast("int")


def discount_steps(promos: DataFrame, discounts: dict[str, str] | None = None) -> DataFrame:
    """(item_kind, item, scope_kind, scope, span, steps): for every item and scope that promotions name,
    the disjoint date steps of a span, each with the best value of every SQL expression of ``discounts``.

    A promotion becomes one interval per span it touches, cut to the span. Equal intervals are
    reduced to their best values before they are shuffled, so a hot (item, scope) costs no more than
    the dates of a span allow. The sweep over the dates runs inside the row of its span.
    """
    discounts = discounts or {"discount_pct": "discount_pct"}
    start, end = F.greatest("promo_start_date", F.lit(FIRST_DAY)), F.least("promo_end_date", F.lit(LAST_DAY))
    targets = F.explode(F.array(*[
        F.struct(F.lit(i).alias("item_kind"), F.col(item).alias("item"), F.lit(j).alias("scope_kind"), F.col(scope).alias("scope"))
        for i, (item, _) in enumerate(ITEM_TARGETS) for j, (scope, _) in enumerate(SCOPE_TARGETS)
    ]))
    usable = promos.where("promo_end_date >= promo_start_date").select(
        targets.alias("target"), start.alias("first"), end.alias("last"), *[F.expr(v).alias(k) for k, v in discounts.items()]
    )
    keys = ["item_kind", "item", "scope_kind", "scope"]
    named = usable.select("target.*", "first", "last", *discounts).where("item IS NOT NULL AND scope IS NOT NULL AND last >= first")
    spans = named.withColumn("span", F.explode(F.sequence(span_of(F.col("first")), span_of(F.col("last")))))
    opens = F.date_add(F.lit(FIRST_MONDAY), F.col("span") * SPAN_DAYS)
    cut = spans.withColumns({"first": F.greatest("first", opens), "last": F.least("last", F.date_add(opens, SPAN_DAYS - 1))})
    intervals = cut.groupBy(*keys, "span", "first", "last").agg(*[F.max(name).alias(name) for name in discounts])
    gathered = intervals.groupBy(*keys, "span").agg(F.collect_list(F.struct("first", "last", *discounts)).alias("intervals"))
    return gathered.select(*keys, "span", _sweep(F.col("intervals"), list(discounts)).alias("steps"))


def _sweep(intervals: Column, names: list[str]) -> Column:
    """Between two neighbouring boundaries the same intervals run; the step takes their best values."""
    boundaries = F.array_sort(F.array_distinct(F.concat(
        F.transform(intervals, lambda x: x["first"]), F.transform(intervals, lambda x: F.date_add(x["last"], 1))
    )))

    def step(first: Column, at: Column) -> Column:
        running = F.filter(intervals, lambda x: (x["first"] <= first) & (x["last"] >= first))
        best = [F.array_max(F.transform(running, lambda x: x[name])).alias(name) for name in names]
        last = F.date_sub(F.get(boundaries, at + 1), 1)
        return F.struct(first.alias("first"), last.alias("last"), *best)

    steps = F.transform(boundaries, step)
    return F.filter(steps, lambda x: F.coalesce(*[x[name] for name in names]).isNotNull())


def measured(rows: DataFrame) -> PromoSteps:
    """Steps that were written as a table; measuring reads them."""
    small = fits_broadcast(rows)
    return PromoSteps(rows, small, small or fits_broadcast(rows.where("scope_kind = 1")))


def as_steps(promos: DataFrame | PromoSteps, discounts: dict[str, str] | None = None) -> PromoSteps:
    """Promotions are flattened in the plan that uses them; steps are taken as they are."""
    return promos if isinstance(promos, PromoSteps) else PromoSteps(discount_steps(promos, discounts))


def lookup_discounts(df: DataFrame, steps: PromoSteps, period: str, days: int, names: list[str]) -> DataFrame:
    """Add the columns ``names`` of the steps: the best of the steps that touch the ``days`` days from
    ``period`` on. ``df`` needs sku, category, store_id, region; no match gives NULL.

    A period must not straddle two spans: a day, or a week from its Monday. Steps measured
    to be small are broadcast; others are joined by sorting, whatever Spark believes their size to be.
    Every lookup leaves its best values and no steps, so the next shuffle moves numbers only.
    """
    day = F.col(period)

    best = {name: F.array_max(_touching("__steps", day, days)[name]) for name in names}
    spans = steps._replace(rows=steps.rows.withColumnsRenamed({"span": "__span", "steps": "__steps"}))
    return _looked_up(df.withColumn("__span", span_of(day)), spans, ["__span"], ["__steps"], best).select(*df.columns, *names)


def lookup_discounts_ahead(df: DataFrame, steps: PromoSteps, end: Column, weeks: int, names: list[str]) -> DataFrame:
    """Every row of ``df`` once per week after the Monday ``end``, the same for all rows, with ``week`` and the columns ``names``
    as ``lookup_discounts`` finds them for that week.

    The best values of these weeks are taken from the steps first, one row per item and scope, so the rows of ``df``
    are looked up before they are multiplied.
    """
    best = {f"{name}_{i}": F.max(F.array_max(_touching("steps", F.date_add("__end", 7 * i), 7)[name])) for i in range(1, weeks + 1) for name in names}
    near = steps.rows.withColumn("__end", end).where(F.col("span").between(span_of(F.date_add("__end", 7)), span_of(F.date_add("__end", 7 * weeks))))
    ahead = near.groupBy("item_kind", "item", "scope_kind", "scope").agg(*[value.alias(f"__{name}") for name, value in best.items()])
    found = _looked_up(df, steps._replace(rows=ahead), [], [f"__{name}" for name in best], {name: F.col(f"__{name}") for name in best})
    each = F.explode(F.array(*[
        F.struct(F.date_add("__end", 7 * i).alias("week"), *[F.col(f"{name}_{i}").alias(name) for name in names]) for i in range(1, weeks + 1)
    ]))
    return found.withColumn("__end", end).select(*df.columns, each.alias("__each")).select(*df.columns, "__each.*")


class WeekBest(NamedTuple):
    """(item_kind, item, scope_kind, scope, span, weeks): the best value of every week of a span, from its first Monday on,
    with what is known of the size of the steps they come from."""

    rows: DataFrame
    small: bool = False
    small_regions: bool = False


def best_by_week(steps: PromoSteps, name: str) -> WeekBest:
    """The steps are searched once per week of a span, so a row of a week needs no search: it picks one value."""
    opens = F.date_add(F.lit(FIRST_MONDAY), F.col("span") * SPAN_DAYS)
    weeks = F.transform(F.sequence(F.lit(0), F.lit(SPAN_DAYS // 7 - 1)), lambda i: F.array_max(
        _touching("steps", F.date_add(opens, (i * 7).cast("int")), 7)[name]
    ))
    return WeekBest(steps.rows.select("item_kind", "item", "scope_kind", "scope", "span", weeks.alias("weeks")), steps.small, steps.small_regions)


def lookup_weeks(df: DataFrame, series: DataFrame, categories: DataFrame, regions: DataFrame, weeks: WeekBest, name: str) -> DataFrame:
    """``df`` with category, region and the column ``name``: the best value of the Monday ``week``, as ``lookup_discounts`` finds it
    in the steps. ``df`` needs sku, store_id and week, ``series`` its sku and store_id, where more do no harm.

    ``categories`` (sku) and ``regions`` (store_id) are joined here; rows without one stay. Values too large to broadcast are
    gathered by series first, so the rows are joined as their windows left them: they are neither shuffled nor sorted for it.
    """
    described = df.join(categories, "sku", "left")
    if weeks.small or not weeks.small_regions:
        return _week_values(described.join(regions, "store_id", "left"), weeks, name, SCOPE_TARGETS)
    by_item, by_category = (_by_series(weeks.rows.where((F.col("item_kind") == i) & (F.col("scope_kind") == 0))) for i in range(2))
    own = by_item.withColumnsRenamed({"item": "sku", "__spans": "__own"})
    # a product may be listed in several categories
    listed = series.select(*SERIES).distinct().join(categories.select("sku", F.col("category").alias("item")).distinct(), "sku")
    shared = listed.join(by_category.hint("merge"), ["store_id", "item"]).groupBy(*SERIES[::-1]).agg(
        F.map_from_entries(F.collect_list(F.struct("item", "__spans"))).alias("__shared")
    )
    span, at = span_of(F.col("week")), _week_of_span(F.col("week"))
    best = F.greatest(F.get(F.col("__own")[span], at), F.get(F.col("__shared")[F.col("category")][span], at))
    joined = described.join(own.hint("merge"), SERIES[::-1], "left").join(shared.hint("merge"), SERIES[::-1], "left")
    in_store = joined.select(*described.columns, best.alias("__in_store")).join(regions, "store_id", "left")
    found = _week_values(in_store, weeks, name, SCOPE_TARGETS[1:])
    return found.withColumn(name, F.greatest("__in_store", name)).drop("__in_store")


def _by_series(rows: DataFrame) -> DataFrame:
    """(store_id, item, __spans): the weeks of all spans of an item in a store, by the number of the span."""
    spans = F.map_from_entries(F.collect_list(F.struct("span", "weeks"))).alias("__spans")
    return rows.groupBy(F.col("scope").alias("store_id"), "item").agg(spans)


def _week_values(df: DataFrame, weeks: WeekBest, name: str, scopes: tuple) -> DataFrame:
    spans = PromoSteps(weeks.rows.withColumnsRenamed({"span": "__span", "weeks": "__weeks"}), weeks.small, weeks.small_regions)
    placed = df.withColumns({"__span": span_of(F.col("week")), "__at": _week_of_span(F.col("week"))})
    found = _looked_up(placed, spans, ["__span"], ["__weeks"], {name: F.get("__weeks", F.col("__at"))}, scopes)
    return found.select(*df.columns, name)


def _week_of_span(monday: Column) -> Column:
    return F.floor(F.pmod(F.date_diff(monday, F.lit(FIRST_MONDAY)), F.lit(SPAN_DAYS)) / 7).cast("int")


def _touching(steps: str, day: Column, days: int) -> Column:
    return F.filter(steps, lambda x: (x["first"] <= F.date_add(day, days - 1)) & (x["last"] >= day))


def _looked_up(
    df: DataFrame, steps: PromoSteps, also: list[str], carried: list[str], best: dict[str, Column], scopes: tuple = SCOPE_TARGETS
) -> DataFrame:
    """``df`` with the largest value of every expression of ``best`` over the lookups by item, scope and the columns
    ``also``, four unless ``scopes`` names fewer. The expressions read the columns ``carried`` of the steps."""
    out, first = df, True
    for j, scope in [(SCOPE_TARGETS.index(target), target[1]) for target in scopes]:
        for i, (_, item) in enumerate(ITEM_TARGETS):
            side = steps.rows.where((F.col("item_kind") == i) & (F.col("scope_kind") == j)).select(
                *also, F.col("item").alias(item), F.col("scope").alias(scope), *carried
            )
            small = steps.small or (steps.small_regions and scope == "region")
            found = out.join(F.broadcast(side) if small else side.hint("merge"), [*also, item, scope], "left")
            here = {f"__best_{name}": value if first else F.greatest(f"__best_{name}", value) for name, value in best.items()}
            out, first = found.select(*df.columns, *[value.alias(name) for name, value in here.items()]), False
    return out.select(*df.columns, *[F.col(f"__best_{name}").alias(name) for name in best])


def daily_best_discount(df: DataFrame, promos: DataFrame | PromoSteps, day: str, value: str = "discount_pct") -> DataFrame:
    """Best discount running on the row's day, 0.0 when none; ``is_promoted`` when above zero.

    Many sales share a product, store and day: each is looked up once and joined back.
    """
    asked = ["sku", "category", "store_id", "region", day]
    known = lookup_discounts(df.select(*asked).distinct(), as_steps(promos), day, 1, [value])
    answers = known.select(*[F.col(c).alias(f"__{c}") for c in asked], F.coalesce(value, F.lit(0.0)).alias("discount_float"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in asked]
    matched = df.join(answers, same, "left").select(*df.columns, "discount_float")
    return matched.withColumn("is_promoted", (F.col("discount_float") > 0).cast("int"))


def promo_phase_counts(promos: DataFrame, as_of: Column) -> DataFrame:
    """How many promotions lie fully before, around and after ``as_of``."""
    return promos.agg(
        F.count_if(F.col("promo_end_date") < as_of).alias("historical"),
        F.count_if((F.col("promo_start_date") <= as_of) & (F.col("promo_end_date") >= as_of)).alias("active"),
        F.count_if(F.col("promo_start_date") > as_of).alias("future"),
    )
