"""The dimension scorecard: sales against plan and last year, and 23 member metrics.

Each block reads its fact once, and both years, grouped rows and the total row come out of the same
aggregations. Distinct counts are not left to ``count(DISTINCT ...)``, which multiplies rows once per
counted column: lines are reduced to what is counted (an order or member under one value of the
dimension) with a bit per condition it meets, and bits are counted after that.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.calendar import ReportCalendar
from shelfmark.conventions import Conventions
from shelfmark.functions.measures import (
    MONEY_TOTAL,
    growth,
    safe_ratio,
    share_change,
    signed_amount,
    whole_ratio,
)
from shelfmark.functions.windows import LY, PERIODS, TY, ytd_window
from shelfmark.operators import products
from shelfmark.operators.conform import (
    VALID_MEMBER_ORDER,
    attach_city_maturity,
    conform_order_lines,
    matching_key,
)
from shelfmark.operators.lifetime import first_paid_time, order_rank_flags
from shelfmark.sources.shared import relation, shares
from shelfmark.sources.tables import Warehouse


@dataclass(frozen=True)
class Dimension:
    """A key of a scorecard and the expression each block takes it from.

    The rules of ``sales`` and ``kpi`` receive the period, because some keys are defined
    differently for this year and last year.
    """

    name: str
    plan: Callable[[ReportCalendar], str]
    sales: Callable[[ReportCalendar, str], str]
    kpi: Callable[[ReportCalendar, str], str]


@dataclass(frozen=True)
class ScorecardSpec:
    dimensions: Sequence[Dimension]
    # Key whose known values make up the denominator of the sales share.
    share_key: str
    # Columns each block reads beyond the common ones.
    sales_columns: Sequence[str] = ()
    kpi_columns: Sequence[str] = ()
    # SKU attributes joined to the three blocks, and which blocks need them.
    sku_base: str = products.ALL
    zero_price_is_low: bool = False
    sku_blocks: frozenset[str] = frozenset()
    # Descriptive columns reported next to the keys, from the sales block.
    descriptions: Mapping[str, Callable[[ReportCalendar], str]] = field(default_factory=dict)
    # Whether this year's sales stop at ``as_of``, for dimension rows and for the total.
    bound_rows: bool = True
    bound_total: bool = True
    # Whether members who join on or after ``as_of`` do not count as new this year.
    bound_new_members: bool = True
    # No change of the average ticket is reported as NULL rather than 0.
    hide_unchanged_atv: bool = False
    # Repurchase share as a whole number (0 or 1) rather than a fraction.
    whole_repurchase_share: bool = True

    @property
    def keys(self) -> list[str]:
        return [d.name for d in self.dimensions]


@dataclass(frozen=True)
class ExtraCounts:
    """Further distinct counts of this year, and the columns they are made from."""

    counts: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    line_columns: Sequence[str] = ()
    needs_city: bool = False
    bridge_columns: DataFrame | None = None
    # Order ranks with further per-order flags, in place of the plain ones.
    order_flags: DataFrame | None = None


@dataclass(frozen=True)
class Branch:
    """One way a row can count: under a period and its own labels, or in the total."""

    when: str
    period: str
    is_total: bool
    labels: Mapping[str, str]

    def sql(self) -> str:
        fields = {"period": f"'{self.period}'", "is_total": str(self.is_total).lower(), **self.labels}
        struct = ", ".join(f"'{n}', {e}" for n, e in fields.items())
        return f"CASE WHEN {self.when} THEN named_struct({struct}) END"


def branch_rows(rows: DataFrame, branches: Sequence[Branch], carry: Sequence[str]) -> DataFrame:
    """One output row per branch that applies to an input row."""
    variants = ",\n".join(b.sql() for b in branches)
    return rows.selectExpr(*carry, f"inline(array_compact(array({variants})))")


def _total_labels(names: Sequence[str], conv: Conventions) -> dict[str, str]:
    return {n: f"'{conv.total_label}'" for n in names}


@dataclass(frozen=True)
class ScorecardRun:
    """One scorecard over one warehouse and date; the blocks share the SKU attributes."""

    wh: Warehouse
    cal: ReportCalendar
    conv: Conventions
    spec: ScorecardSpec
    extra: ExtraCounts = ExtraCounts()

    def with_attributes(self, rows: DataFrame, block: str) -> DataFrame:
        if block not in self.spec.sku_blocks:
            return rows
        attributes = products.sku_attributes(
            self.wh, self.cal, self.spec.sku_base, self.spec.zero_price_is_low
        )
        return products.attach_sku_attributes(rows, attributes)

    # -- sales ---------------------------------------------------------------------------

    def _sales_lines(self) -> DataFrame:
        spec, cal = self.spec, self.cal
        columns = ["parent_order_id", "sku_id", "sale_date", "sales_qty", "order_amt", *spec.sales_columns]
        ty = ytd_window("sale_date", cal, TY, spec.bound_rows and spec.bound_total)
        lines = self.wh.table("store_sales", list(dict.fromkeys(columns)))
        return self.with_attributes(lines.filter(f"{ty} OR {ytd_window('sale_date', cal, LY)}"), "sales")

    def sales_block(self) -> DataFrame:
        """Net sales and distinct orders per key and in total, this year and last year, and
        the share of sales. Rows without sales this year are left out; a row with an unknown
        key value has no last year."""
        spec, cal = self.spec, self.cal
        lines = self._sales_lines()
        names = [*spec.keys, *spec.descriptions]
        branches = []
        for period in PERIODS:
            labels = {d.name: d.sales(cal, period) for d in spec.dimensions}
            labels |= {n: rule(cal) for n, rule in spec.descriptions.items()}
            own = ytd_window("sale_date", cal, period, spec.bound_rows)
            total = ytd_window("sale_date", cal, period, spec.bound_total)
            branches.append(Branch(own, period, False, labels))
            branches.append(Branch(total, period, True, _total_labels(names, self.conv)))
        carry = ["parent_order_id", f"{signed_amount()} AS net"]
        # One row per order under each value first, then plain sums: no order is counted twice.
        per_order = (
            branch_rows(lines, branches, carry)
            .groupBy("period", "is_total", *names, "parent_order_id")
            .agg(F.expr(f"CAST(sum(net) AS {MONEY_TOTAL}) AS net"), F.expr("count(*) AS n"))
        )
        aggregates = [
            e
            for p in PERIODS
            for e in (
                f"CAST(sum(net) FILTER (WHERE period = '{p}') AS {MONEY_TOTAL}) AS {p}_sales",
                f"count(parent_order_id) FILTER (WHERE period = '{p}') AS {p}_tickets",
                f"coalesce(sum(n) FILTER (WHERE period = '{p}'), 0) AS {p}_rows",
            )
        ]
        counted = per_order.groupBy("is_total", *names).agg(*map(F.expr, aggregates))
        # The denominator of the sales share: one number from the grouped rows, whose exchange is reused.
        in_share = f"NOT is_total AND {spec.share_key} IS NOT NULL AND ty_rows > 0"
        all_sales = counted.filter(in_share).agg(F.expr("sum(ty_sales)")).scalar()
        return self._compare_years(counted).withColumn("all_sales", all_sales)

    def _compare_years(self, counted: DataFrame) -> DataFrame:
        spec = self.spec
        known = " AND ".join(f"{k} IS NOT NULL" for k in spec.keys)
        if not spec.descriptions:
            return counted.filter("ty_rows > 0").selectExpr(
                "is_total",
                *spec.keys,
                "ty_sales",
                "ty_tickets",
                f"CASE WHEN {known} THEN ly_sales END AS ly_sales",
                f"CASE WHEN {known} AND ly_rows > 0 THEN ly_tickets END AS ly_tickets",
            )
        # Described rows: every description of this year meets every one of last year that has
        # the same key. Rows with an unknown key meet nothing.
        keys = ["is_total", *spec.keys]
        last = counted.filter(f"ly_rows > 0 AND {known}").selectExpr(
            *[f"{k} AS last_{k}" for k in keys], "ly_sales", "ly_tickets"
        )
        this = counted.filter("ty_rows > 0").selectExpr(*keys, *spec.descriptions, "ty_sales", "ty_tickets")
        same = " AND ".join(f"{k} = last_{k}" for k in keys)
        return this.join(last, F.expr(same), "left").drop(*[f"last_{k}" for k in keys])

    # -- plan ----------------------------------------------------------------------------

    def plan_block(self) -> DataFrame:
        """Planned sales value per key and in total."""
        spec = self.spec
        plan = self.with_attributes(products.plan_value(self.wh, self.cal, self.conv), "plan")
        branches = [
            Branch("true", TY, False, {d.name: d.plan(self.cal) for d in spec.dimensions}),
            Branch("true", TY, True, _total_labels(spec.keys, self.conv)),
        ]
        return (
            branch_rows(plan, branches, ["plan_value"])
            .groupBy("is_total", *spec.keys)
            .agg(F.expr(f"CAST(sum(plan_value) AS {MONEY_TOTAL}) AS sales_plan"))
        )

    def sales_compare(self) -> DataFrame:
        """Sales of both years next to the plan, per key and in total."""
        return join_on_keys(self.sales_block(), self.plan_block(), ["is_total", *self.spec.keys])

    # -- member metrics ------------------------------------------------------------------

    def member_fact(self) -> DataFrame:
        """Store lines of both periods with member, attribute and order-rank columns."""
        spec, cal, extra = self.spec, self.cal, self.extra
        if extra == ExtraCounts():
            # The same for every scorecard but for its columns; a stored one has those of all.
            columns = MEMBER_FACT if shares(self.wh) else spec.kpi_columns
            lines = relation(self.wh, "member_fact", lambda: self._ranked_lines(columns))
        else:
            lines = self._ranked_lines([*spec.kpi_columns, *(("city", "city_tier") if extra.needs_city else ())])
        lines = self.with_attributes(lines, "kpi")
        if extra.needs_city:
            lines = attach_city_maturity(lines, self.wh)
        new = "new_ty" if spec.bound_new_members else "new_ty_open"
        return lines.withColumn("new_ty", F.col(new)).drop("new_ty_open")

    def _ranked_lines(self, columns: Sequence[str]) -> DataFrame:
        cal, extra = self.cal, self.extra
        bridge = bridge_with(
            self.wh.table("member_bridge", ["id", "member_id"]),
            member_join_flags(self.wh, cal, self.conv),
            *([extra.bridge_columns] if extra.bridge_columns is not None else []),
        )
        paid = "order_paid_date"
        recent = f"({ytd_window(paid, cal, TY, bounded=False)} OR {ytd_window(paid, cal, LY)})"
        wanted = ["sales_qty", "order_amt", "is_member_order", "is_effective", "sku_id", *columns]
        lines = conform_order_lines(self.wh, cal, self.conv, [self.conv.store_channel], wanted, bridge, recent)
        ranked = extra.order_flags
        if ranked is None:
            ranked = order_rank_flags(first_paid_time(valid_store_lines(self.wh, cal, self.conv)))
        own_key = matching_key("parent_order_id", ("sku_id", "order_paid_date", "member_id"))
        return lines.join(ranked, F.expr(f"{own_key} = ranked_order_id"), "left")

    def member_kpis(self, fact: DataFrame | None = None) -> DataFrame:
        """Base counts and sales per key and in total, columns prefixed ``ty_`` and ``ly_``.

        1. Lines are reduced to one row per (period, value, order, member), with the sums and a bit for
           each count whose condition they meet.
        2. A reduced row enters once for each thing that is counted (order, member, canonical member),
           under its value and in the total; equal things merge by or-ing their bits.
        3. What is left is one row per thing and value: bits are counted, sums added up.
        """
        spec, cal, extra = self.spec, self.cal, self.extra
        fact = self.member_fact() if fact is None else fact
        keys = spec.keys
        periods = []
        for period in PERIODS:
            inside = ytd_window("order_paid_date", cal, period, bounded=False)
            labels = {d.name: d.kpi(cal, period) for d in spec.dimensions}
            periods.append(Branch(inside, period, False, {**labels, "is_new": f"coalesce(new_{period}, false)"}))
        carry = [
            *COUNTED,
            f"{signed_amount()} AS net",
            "coalesce(is_member_order, false) AS member_order",
            f"coalesce({VALID_MEMBER_ORDER}, false) AS valid",
            "coalesce(n_first, 0) AS n_first",
            "coalesce(n_repeat, 0) AS n_repeat",
            "greatest(coalesce(n_first + n_repeat, 0), 1) AS fan",
            *extra.line_columns,
        ]
        counts = {**BASE_COUNTS, **extra.counts}
        bits = {n: 1 << i for i, n in enumerate(counts)}
        mask = " | ".join(f"CASE WHEN {test} THEN {bits[n]}L ELSE 0L END" for n, (_, test) in counts.items())
        sales = {n: counted_sales(condition, times) for n, (condition, times) in BASE_SALES.items()}
        reduced = (
            branch_rows(fact, periods, carry)
            .groupBy("period", *keys, *COUNTED)
            .agg(*map(F.expr, [f"bit_or({mask}) AS bits", *[f"{e} AS {n}" for n, e in sales.items()], "count(*) AS lines"]))
        )
        own, total = {k: k for k in keys}, _total_labels(keys, self.conv)
        things = []
        for thing in COUNTED:
            mine = sum(bits[n] for n, (what, _) in counts.items() if what == thing)
            # The sums go with one of the things only.
            sums = [n if thing == COUNTED[0] else f"CAST(NULL AS {MONEY_TOTAL})" for n in sales]
            lines = "lines" if thing == COUNTED[0] else "0L"
            for is_total, labels in (("false", own), ("true", total)):
                fields = {"is_total": is_total, **{f"of_{k}": v for k, v in labels.items()}}
                fields |= {"thing": f"'{thing}'", "id": thing, "own_bits": f"CASE WHEN {thing} IS NULL THEN 0L ELSE bits & {mine}L END"}
                fields |= {f"sum_{n}": e for n, e in zip(sales, sums, strict=True)} | {"n": lines}
                things.append("named_struct({})".format(", ".join(f"'{n}', {e}" for n, e in fields.items())))
        merged = (
            reduced.selectExpr("period", f"inline(array({', '.join(things)}))")
            .groupBy("period", "is_total", *[f"of_{k}" for k in keys], "thing", "id")
            .agg(*map(F.expr, ["bit_or(own_bits) AS bits", *[f"sum(sum_{n}) AS {n}" for n in sales], "sum(n) AS lines"]))
        )
        # Both periods side by side.
        sides = []
        for p in PERIODS:
            for name in counts:
                if p == TY or name not in extra.counts:
                    sides.append(f"count_if(bits & {bits[name]}L <> 0) FILTER (WHERE period = '{p}') AS {p}_{name}")
            sides += [f"CAST(sum({n}) FILTER (WHERE period = '{p}') AS {MONEY_TOTAL}) AS {p}_{n}" for n in sales]
            sides.append(f"sum(lines) FILTER (WHERE period = '{p}') AS {p}_lines")
        return merged.groupBy("is_total", *[F.col(f"of_{k}").alias(k) for k in keys]).agg(*map(F.expr, sides))

    # -- assembly ------------------------------------------------------------------------

    def joined(self) -> DataFrame:
        """Sales, plan and member columns side by side, before the figures are formed."""
        return join_on_keys(self.sales_compare(), self.member_kpis(), ["is_total", *self.spec.keys])

    def report(self) -> DataFrame:
        spec = self.spec
        figures = {**sales_figures(spec), **metric_figures(spec)}
        return self.joined().selectExpr(
            *spec.keys, *spec.descriptions, *[f"{e} AS {n}" for n, e in figures.items()]
        )


def member_join_flags(wh: Warehouse, cal: ReportCalendar, conv: Conventions) -> DataFrame:
    """Per member id (as a number): joined through a store this year (before ``as_of``, or open-ended)
    and last year."""
    ty, ly = ytd_window("join_time", cal, TY), ytd_window("join_time", cal, LY)
    open_ty = ytd_window("join_time", cal, TY, bounded=False)
    return (
        wh.table("member", ["member_detail_id", "join_time", "reg_channel"])
        .filter(f"reg_channel LIKE '{conv.registration_like}' AND ({open_ty} OR {ly})")
        .groupBy(F.expr("try_cast(member_detail_id AS BIGINT) AS member_key"))
        .agg(F.expr(f"max({ty}) AS new_ty"), F.expr(f"max({open_ty}) AS new_ty_open"), F.expr(f"max({ly}) AS new_ly"))
    )


def bridge_with(bridge: DataFrame, *per_member: DataFrame) -> DataFrame:
    """The member bridge widened by per-member columns keyed on ``member_key``.

    Joining the member tables to each other first leaves one join for the order fact.
    """
    for columns in per_member:
        same = "try_cast(CAST(id AS STRING) AS BIGINT) = member_key"
        bridge = bridge.join(columns, F.expr(same), "left").drop("member_key")
    return bridge


def valid_store_lines(
    wh: Warehouse, cal: ReportCalendar, conv: Conventions, columns: Sequence[str] = ()
) -> DataFrame:
    """All store lines of valid member orders up to ``as_of``."""
    wanted = ["order_paid_time", "is_member_order", "is_effective", *columns]
    return conform_order_lines(wh, cal, conv, [conv.store_channel], wanted, where=VALID_MEMBER_ORDER)


# Source columns of the shared fact beyond the common ones: every scorecard's keys.
MEMBER_FACT = ("product_line",)
# What is counted, by id.
COUNTED = ("parent_order_id", "member_detail_id", "member_id")
# Distinct counts the 23 metrics are made of: name -> (what is counted, condition).
BASE_COUNTS: dict[str, tuple[str, str]] = {
    "shoppers": ("member_detail_id", "valid"),
    "new_shoppers": ("member_detail_id", "valid AND is_new"),
    "first_shoppers": ("member_detail_id", "valid AND NOT is_new AND n_first > 0"),
    "repeat_shoppers": ("member_detail_id", "valid AND NOT is_new AND n_repeat > 0"),
    "orders": ("parent_order_id", "valid"),
    "new_orders": ("parent_order_id", "valid AND is_new"),
    "first_orders": ("parent_order_id", "valid AND NOT is_new AND n_first > 0"),
    "repeat_orders": ("parent_order_id", "valid AND NOT is_new AND n_repeat > 0"),
    "buyers": ("member_id", "valid"),
    "initial_buyers": ("member_id", "valid AND n_first > 0"),
    "repurchase_buyers": ("member_id", "valid AND n_repeat > 0"),
}
# Net sales: name -> (condition, how many of the line's ``fan`` rows count). Ranks are per
# order and member, so a line stands for one row per ranked member of its order, and at least
# for one; of these, ``n_first`` have rank 1 and ``n_repeat`` a later rank.
BASE_SALES: dict[str, tuple[str, str]] = {
    "member_sales": ("member_order", "fan"),
    "new_sales": ("member_order AND is_new", "fan"),
    "first_sales": ("member_order AND NOT is_new", "n_first"),
    "repeat_sales": ("member_order AND NOT is_new", "n_repeat"),
}


def counted_sales(condition: str, times: str) -> str:
    """Sum over the rows a line stands for; rows that do not count are 0, so an unknown amount
    stays unknown only where every row counts."""
    amount = f"net * CAST({times} AS DECIMAL(10,0))"
    value = amount if times == "fan" else f"CASE WHEN {times} = fan THEN {amount} ELSE coalesce({amount}, 0) END"
    return f"CAST(sum(CASE WHEN {condition} THEN {value} ELSE 0 END) AS {MONEY_TOTAL})"


def base_count(period: str, name: str) -> str:
    """A base count after the join. The total of the member block exists even when no line
    falls into a period (its counts are 0); dimension rows then have no figure."""
    present = f"coalesce({period}_lines, 0) > 0"
    return f"(CASE WHEN {present} THEN {period}_{name} WHEN is_total THEN 0L END)"


def period_metrics(period: str, whole_repurchase_share: bool) -> dict[str, tuple[str, Callable]]:
    """The 23 metrics of one period: name -> (expression, comparison with last year)."""

    def count(name: str) -> str:
        return base_count(period, name)

    def sales(name: str) -> str:
        return f"{period}_{name}"

    metrics: dict[str, tuple[str, Callable]] = {
        "member_shopper": (f"nullif({count('shoppers')}, 0)", growth),
        "member_sales": (f"CAST({sales('member_sales')} AS DOUBLE)", growth),
        "member_atv": (safe_ratio(sales("member_sales"), count("orders")), growth),
        "member_frequency": (safe_ratio(count("orders"), count("shoppers")), growth),
    }
    for group, prefix in (
        ("new_member", "new"),
        ("existing_0_1_member", "first"),
        ("existing_repurchase_member", "repeat"),
    ):
        own_sales = sales(f"{prefix}_sales")
        own_shoppers, own_orders = count(f"{prefix}_shoppers"), count(f"{prefix}_orders")
        metrics |= {
            f"{group}_shopper": (f"CAST({own_shoppers} AS DOUBLE)", growth),
            f"{group}_shopper_share": (safe_ratio(own_shoppers, count("shoppers")), share_change),
            f"{group}_sales": (f"CAST({own_sales} AS DOUBLE)", growth),
            f"{group}_sales_share": (safe_ratio(own_sales, sales("member_sales")), share_change),
            f"{group}_atv_buying_the_line": (safe_ratio(own_sales, own_orders), growth),
        }
    buyers, initial, repurchase = count("buyers"), count("initial_buyers"), count("repurchase_buyers")
    repurchase_share = whole_ratio if whole_repurchase_share else safe_ratio
    metrics |= {
        "lifetime_initial_member_shopper": (initial, growth),
        "lifetime_initial_member_shopper_share": (safe_ratio(initial, buyers), share_change),
        "lifetime_repurchase_member_shopper": (repurchase, growth),
        "lifetime_repurchase_member_shopper_share": (repurchase_share(repurchase, buyers), share_change),
    }
    return metrics


def metric_figures(spec: ScorecardSpec, renamed: Mapping[str, str] = {}) -> dict[str, str]:
    """The 46 metric columns: each metric followed by its comparison with last year."""
    this = period_metrics(TY, spec.whole_repurchase_share)
    last = period_metrics(LY, spec.whole_repurchase_share)
    figures = {}
    for name, (value, compare) in this.items():
        figures[renamed.get(name, name)] = value
        figures[f"{name}_vs_LY"] = compare(value, last[name][0])
    return figures


def sales_figures(spec: ScorecardSpec) -> dict[str, str]:
    """The nine sales columns over the joined sales and plan columns."""
    atv, last_atv = safe_ratio("ty_sales", "ty_tickets"), safe_ratio("ly_sales", "ly_tickets")
    change = growth(atv, last_atv)
    return {
        "sales_rrp": "ty_sales",
        "sales_plan": "sales_plan",
        "sales_progress": safe_ratio("ty_sales", "sales_plan"),
        "transactions": "ty_tickets",
        "atv": atv,
        "sales_rrp_share": safe_ratio("ty_sales", "all_sales"),
        "sales_vs_LY": growth("ty_sales", "ly_sales"),
        "transactions_vs_LY": growth("ty_tickets", "ly_tickets"),
        "atv_vs_LY": f"nullif({change}, 0)" if spec.hide_unchanged_atv else change,
    }


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on plain equality of the keys: unknown (NULL) values never match."""
    renamed = right.withColumnsRenamed({k: f"r_{k}" for k in keys})
    same = " AND ".join(f"{k} = r_{k}" for k in keys)
    return left.join(renamed, F.expr(same), "left").drop(*[f"r_{k}" for k in keys])


def scorecard(wh: Warehouse, cal: ReportCalendar, conv: Conventions, spec: ScorecardSpec) -> DataFrame:
    """The whole report of one dimension (or pair of dimensions), total row included."""
    return ScorecardRun(wh, cal, conv, spec).report()
