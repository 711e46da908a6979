"""Joins of tables that are laid out by the join key."""

from __future__ import annotations

from dataclasses import replace

from driver_queries import views
from driver_queries.registry import query
from driver_queries.sources import union
from driver_queries.transforms import SQL_LEFT_CUSTOMER_SKEWED, client_sales, skewed_sales
from driver_queries.views import FIRST
from stratalake import config
from stratalake.operators.joins import lookup_join
from stratalake.plans.silver import co_located_parts
from stratalake.sinks.buckets import BucketLayout, put_layout
from stratalake.sinks.tables import create_lake, write_slices

BY_CUSTOMER = (
    BucketLayout(config.ACQUISITIONS, "cliente_id", 8, split_hot=True),
    BucketLayout(config.CUSTOMERS, "client_id", 8),
)


@query("left_join_customer_co_located", SQL_LEFT_CUSTOMER_SKEWED)
def left_join_customer_co_located(spark, sf_dir):
    """Buckets meet buckets without a shuffle; one heavy key and the rows without one lie apart."""
    lake = replace(views.new_lake(spark), rows_per_task=1000)
    create_lake(spark, lake)
    write_slices(spark, lake, config.ACQUISITIONS, skewed_sales(spark, sf_dir), [FIRST])
    write_slices(spark, lake, config.CUSTOMERS, views.clean_customers(spark, sf_dir), [FIRST])
    for layout in BY_CUSTOMER:
        put_layout(spark, lake, layout, FIRST)
    joined = [
        lookup_join(
            client_sales(sales),
            customers.select("client_id", "cpf", "estado", "renda"),
            "client_id",
            hot=plan.hot_customers,
            broadcast_lookup=plan.broadcast_customers,
        )
        for sales, customers, plan in co_located_parts(spark, lake, FIRST, BY_CUSTOMER)
    ]
    return views.finished(union(joined), lake)
