"""quarterdeck — point-of-sale analytics on Spark.

Layout: ``functions`` (Column expressions), ``operators`` (DataFrame → DataFrame rules and
data products), ``sources`` (file/control-driven ingestion and the test-data adapter),
``streaming`` (Structured Streaming tables and the SCD1 upsert), ``plans`` (SQL views,
registered queries, the medallion job).
"""

from quarterdeck.operators.dedupe import (
    dedupe_reposted_sales_lines,
    latest_master_snapshot,
    superseded_versions,
)
from quarterdeck.operators.products import (
    average_transaction_value,
    combo_price_variance,
    combo_price_with_override,
    commercial_action,
    discount_strategy,
    product_master_controls,
    top_discounts,
    unit_15_min_profitability,
)
from quarterdeck.operators.rules import (
    add_quarter_hour_bucket,
    apply_enhanced_quantity,
    apply_sales_business_rules,
    calculate_net_sales,
    require_columns,
)

__all__ = [
    "add_quarter_hour_bucket",
    "apply_enhanced_quantity",
    "apply_sales_business_rules",
    "average_transaction_value",
    "calculate_net_sales",
    "combo_price_variance",
    "combo_price_with_override",
    "commercial_action",
    "dedupe_reposted_sales_lines",
    "discount_strategy",
    "latest_master_snapshot",
    "product_master_controls",
    "require_columns",
    "superseded_versions",
    "top_discounts",
    "unit_15_min_profitability",
]
