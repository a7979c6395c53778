"""Schemas of the visit log, user and product tables and of the outputs."""

from pyspark.sql import types as T

VISIT_ACTION = T.StructType([
    T.StructField("event_id", T.LongType(), True),  # tie-breaker for ordering
    T.StructField("date", T.StringType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("session_id", T.StringType(), True),
    T.StructField("page_id", T.LongType(), True),
    T.StructField("action_time", T.StringType(), True),
    T.StructField("search_keyword", T.StringType(), True),
    T.StructField("click_category_id", T.LongType(), True),
    T.StructField("click_product_id", T.LongType(), True),
    T.StructField("order_category_ids", T.StringType(), True),
    T.StructField("order_product_ids", T.StringType(), True),
    T.StructField("pay_category_ids", T.StringType(), True),
    T.StructField("pay_product_ids", T.StringType(), True),
    T.StructField("city_id", T.LongType(), True),
])

USER_INFO = T.StructType([
    T.StructField("user_id", T.LongType(), True),
    T.StructField("username", T.StringType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("age", T.IntegerType(), True),
    T.StructField("professional", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("sex", T.StringType(), True),
])

PRODUCT_INFO = T.StructType([
    T.StructField("product_id", T.LongType(), True),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("extend_info", T.StringType(), True),
])

# Columns of the session detail output, in declared order.
SESSION_DETAIL_COLUMNS = [
    "task_id", "user_id", "session_id", "page_id", "action_time", "search_keyword",
    "click_category_id", "click_product_id", "order_category_ids", "order_product_ids",
    "pay_category_ids", "pay_product_ids",
]
