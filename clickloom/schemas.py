"""Input and output row types.

Dates and times are strings at the edges (``yyyy-MM-dd`` and
``yyyy-MM-dd HH:mm:ss``), as in the stored tables; operators parse them to
``timestamp_ntz``. Seconds between times, and the dates of ad clicks, go by
``spark.sql.session.timeZone``; pin it to UTC for results that do not depend on the place.
"""

from __future__ import annotations

from pyspark.sql import types as T


TEXT, INT, BIGINT, TIME = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampType()


def row(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


ACTION = row(
    date=TEXT,
    user_id=BIGINT,
    session_id=TEXT,
    page_id=BIGINT,
    action_time=TEXT,
    search_keyword=TEXT,
    click_category_id=BIGINT,
    click_product_id=BIGINT,
    order_category_ids=TEXT,
    order_product_ids=TEXT,
    pay_category_ids=TEXT,
    pay_product_ids=TEXT,
    city_id=BIGINT,
)

USER = row(
    user_id=BIGINT,
    username=TEXT,
    name=TEXT,
    age=INT,
    professional=TEXT,
    city=TEXT,
    sex=TEXT,
)

PRODUCT = row(product_id=BIGINT, product_name=TEXT, extend_info=TEXT)

CITY = row(city_id=BIGINT, city_name=TEXT, area=TEXT)

# Result tables of the ad stream.
AD_BLACKLIST = row(userid=BIGINT)
AD_USER_CLICK_COUNT = row(date=TEXT, userid=BIGINT, adid=BIGINT, clickCount=BIGINT)
AD_STAT = row(date=TEXT, province=TEXT, city=TEXT, adid=BIGINT, clickCount=BIGINT)
AD_PROVINCE_TOP3 = row(date=TEXT, province=TEXT, adid=BIGINT, clickCount=BIGINT)
AD_CLICK_TREND = row(date=TEXT, hour=TEXT, minute=TEXT, adid=BIGINT, clickCount=BIGINT)
AD_PANES = row(date=TEXT, pane=TIME, adid=BIGINT, clickCount=BIGINT)

# An absent click id is stored as this value or as null.
ABSENT_ID = -1
