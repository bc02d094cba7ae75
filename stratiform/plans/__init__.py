from stratiform.plans.curated import amount_by_name_gold, sample_curated
from stratiform.plans.graph import read_daily, run_models, selected
from stratiform.plans.layers import quality_report, run_layers
from stratiform.plans.marts import (
    dim_customers,
    enterprise_orders_daily,
    fct_orders_daily,
    int_orders_enriched,
)
from stratiform.plans.staging import (
    src_raw_orders,
    stg_customers,
    stg_orders,
    stg_sales_transactions,
    stg_sample,
)

__all__ = [
    "amount_by_name_gold",
    "dim_customers",
    "enterprise_orders_daily",
    "fct_orders_daily",
    "int_orders_enriched",
    "quality_report",
    "read_daily",
    "run_layers",
    "run_models",
    "sample_curated",
    "selected",
    "src_raw_orders",
    "stg_customers",
    "stg_orders",
    "stg_sales_transactions",
    "stg_sample",
]
