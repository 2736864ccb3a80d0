"""The analytics SQL views agree with the DataFrame builders."""

from __future__ import annotations


from quarterdeck.operators import products
from quarterdeck.plans import catalog as C
from quarterdeck.plans.views import register_views

from __spark_entry__ import SMOKE_DIR


def _same(a, b, cols):
    """Row-for-row equality (exact: views and builders share sums and rounding)."""
    def rows(df):
        return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)

    assert rows(a) == rows(b)


def test_views_match_builders(spark):
    silver = C.silver_sales(spark, SMOKE_DIR)
    gold_d = products.discount_strategy(silver)
    gold_b = products.unit_15_min_profitability(C.event_silver(spark, SMOKE_DIR), C.energy_cost(spark, SMOKE_DIR))
    tables = {
        "silver_sales_line_items_business": silver,
        "gold_discount_strategy": gold_d,
        "gold_unit_quarter_hour_sales": gold_b,
        "silver_dim_unit": C.silver_dim_unit(spark, SMOKE_DIR),
        "silver_dim_product": C.silver_dim_product(spark, SMOKE_DIR),
        "silver_daily_budget_forecast": C.silver_budget_forecast(spark, SMOKE_DIR),
    }
    assert len(register_views(spark, tables)) == 5
    atv = products.average_transaction_value(silver)
    _same(spark.table("vw_enhanced_quantity_atv"), atv, atv.columns)
    actions = products.commercial_action(gold_d)
    _same(spark.table("vw_discount_strategy"), actions, actions.columns)
    be = products.break_even_view(gold_b)
    _same(spark.table("vw_unit_sales_15_min_break_even"), be, be.columns)
    combo = products.combo_price_variance(silver)
    _same(spark.table("vw_combo_analytics"), combo, combo.columns)
    tx = C.q_transactional(spark, SMOKE_DIR)
    _same(spark.table("vw_sales_transactional_from_silver"), tx, tx.columns)


def test_view_thresholds_are_those_of_the_builder():
    from quarterdeck.plans.views import ANALYTICS_VIEWS

    text = ANALYTICS_VIEWS["vw_discount_strategy"]
    for part in (
        f"discount_rate_percent > {products.REVIEW_DISCOUNT_RATE_ABOVE} AND net_sales_per_transaction < {products.REVIEW_NET_PER_TXN_BELOW}",
        f"transaction_count > {products.PROMOTE_TXNS_ABOVE} AND net_sales_per_transaction >= {products.PROMOTE_NET_PER_TXN_AT_LEAST}",
        f"'{products.ACTION_REVIEW}'", f"'{products.ACTION_PROMOTE}'", f"ELSE '{products.ACTION_MONITOR}'",
    ):
        assert part in text
