"""Hand-written visit log rows and users, and what tests read of a plan.

A module of its own name: a ``conftest`` in a folder below cannot hide it."""

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"

ACTION_FIELDS = ["event_id", "date", "user_id", "session_id", "page_id", "action_time",
                 "search_keyword", "click_category_id", "click_product_id", "order_category_ids",
                 "order_product_ids", "pay_category_ids", "pay_product_ids", "city_id"]


def action(event_id, session_id, action_time, user_id=1, page_id=0, keyword=None, click=-1,
           order=None, pay=None):
    date = action_time.split(" ")[0] if action_time else "2024-01-01"
    return (event_id, date, user_id, session_id, page_id, action_time, keyword, click,
            -1 if click == -1 else 7, order, None if order is None else "1", pay,
            None if pay is None else "1", 0)


def make_actions(spark, rows):
    """Hand-written visit log rows, typed like a stored log: the text time is
    parsed into ``action_ts`` the way the scan does it."""
    from visitlab.schema import VISIT_ACTION
    from visitlab.functions.time import parse_time_sql
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, VISIT_ACTION)
    return df.withColumn("action_ts", F.expr(parse_time_sql("action_time")))


def make_users(spark, rows):
    from visitlab.schema import USER_INFO
    return spark.createDataFrame(rows, USER_INFO)


def user(user_id, age=30, professional="p0", city="city0", sex="male"):
    return (user_id, f"user{user_id}", f"name{user_id}", age, professional, city, sex)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
