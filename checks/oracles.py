"""The same results as ``checks.queries`` in plain SQL, over the same tables."""

from __future__ import annotations

from checks import queries as Q
from clickloom.operators.funnel import flow_pairs
from clickloom.operators.sessions import BUCKETS
from clickloom.params import TaskParams

# Input relations.
_INPUTS = """
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
act AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, user_id,
    concat(CAST(user_id AS VARCHAR), '_', strftime(ts, '%Y-%m-%d')) AS session_id,
    k % 10 AS page_id, date_trunc('second', ts) AS action_time, event_id,
    CASE WHEN event_type = 'view' THEN concat('kw', CAST(k % 10 AS VARCHAR)) END AS search_keyword,
    CASE WHEN event_type = 'click' THEN k % 20 ELSE -1 END AS click_category_id,
    CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_product_id,
    CASE WHEN event_type = 'signup'
      THEN concat(CAST(k % 20 AS VARCHAR), ',', CAST((k + 7) % 20 AS VARCHAR)) END AS order_category_ids,
    CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS order_product_ids,
    CASE WHEN event_type = 'purchase' THEN CAST(k % 20 AS VARCHAR) END AS pay_category_ids,
    CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_product_ids,
    user_id % 25 AS city_id
  FROM ev),
usr AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
    CAST(c_custkey % 60 AS INTEGER) AS age, c_mktsegment AS professional,
    concat('city', CAST(c_nationkey AS VARCHAR)) AS city,
    CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer),
prod AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
    concat('{"product_status": ', CAST(p_partkey % 2 AS VARCHAR), '}') AS extend_info
  FROM part),
cit AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey),
ad AS (
  SELECT e.ts, strftime(e.ts, '%Y-%m-%d') AS date, area AS province, city_name AS city,
    e.user_id AS userid, e.k % 20 AS adid, e.event_id
  FROM ev e JOIN cit ON e.user_id % 25 = city_id),
ses AS (
  SELECT session_id, min(user_id) AS user_id,
    array_to_string(list_sort(list(DISTINCT search_keyword)
      FILTER (WHERE search_keyword <> '')), ',') AS search_keywords,
    array_to_string(list_sort(list(DISTINCT click_category_id)
      FILTER (WHERE click_category_id <> -1)), ',') AS click_category_ids,
    min(action_time) AS start_at,
    date_diff('second', min(action_time), max(action_time)) AS visit_length,
    count(*) AS step_length
  FROM act GROUP BY session_id),
su AS (
  SELECT ses.*, age, professional, city, sex FROM ses JOIN usr ON ses.user_id = usr.user_id)
"""


def _with(body: str, ctes: str = "") -> str:
    return f"WITH {_INPUTS}{', ' + ctes if ctes else ''} {body}"


def _strings(values: str) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values.split(",")) + ")"


def _any(column: str, values: str) -> str:
    return f"coalesce(len(list_intersect(string_split({column}, ','), {list(values.split(','))})) > 0, false)"


def _conditions(p: TaskParams) -> dict[str, str]:
    tests = {}
    if p.start_age is not None and p.end_age is not None:
        tests["age"] = f"coalesce(age BETWEEN {p.start_age} AND {p.end_age}, false)"
    if p.professionals:
        tests["professional"] = f"coalesce(professional IN {_strings(p.professionals)}, false)"
    if p.cities:
        tests["city"] = f"coalesce(city IN {_strings(p.cities)}, false)"
    if p.sex:
        tests["sex"] = f"coalesce(sex = '{p.sex}', false)"
    if p.keywords:
        tests["keywords"] = _any("search_keywords", p.keywords)
    if p.category_ids:
        tests["categories"] = _any("click_category_ids", p.category_ids)
    return tests


def _filtered(p: TaskParams = Q.FILTER) -> str:
    return f"fs AS (SELECT * FROM su WHERE {' AND '.join(_conditions(p).values())})"


_SESSION = """session_id, user_id, search_keywords, click_category_ids,
  strftime(start_at, '%Y-%m-%d %H:%M:%S') AS start_time, visit_length, step_length"""
_SESSION_USER = _SESSION + ", age, professional, city, sex"

_DETAIL = f"""'{Q.TASK}' AS taskid, a.user_id AS userid, a.session_id AS sessionid,
  a.page_id AS pageid, strftime(a.action_time, '%Y-%m-%d %H:%M:%S') AS "actionTime",
  a.search_keyword AS "searchKeyword", a.click_category_id AS "clickCategoryId",
  a.click_product_id AS "clickProductId", a.order_category_ids AS "orderCategoryIds",
  a.order_product_ids AS "orderProductIds", a.pay_category_ids AS "payCategoryIds",
  a.pay_product_ids AS "payProductIds" """


def _bucket(column: str, low: int, high: int | None) -> str:
    return f"{column} >= {low}" if high is None else f"{column} BETWEEN {low} AND {high}"


_COUNTS = "count(*) AS session_count, " + ", ".join(
    f"count(*) FILTER (WHERE {_bucket(c, lo, hi)}) AS {name}" for name, c, lo, hi in BUCKETS
)


def _two(n: str, total: str) -> str:
    """n / total to two decimals, halves up, in whole numbers."""
    return f"coalesce(CAST((200 * {n} + {total}) // (2 * nullif({total}, 0)) AS DOUBLE) / 100, 0)"


_RATIOS = ", ".join(f"{_two(name, 'session_count')} AS {name}_ratio" for name, *_ in BUCKETS)

# Category counts of a relation of actions.


def _category_ctes(source: str) -> str:
    return f"""
cc AS (SELECT click_category_id AS categoryid, session_id FROM {source}
       WHERE click_category_id <> -1),
oc AS (SELECT CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT) AS categoryid
       FROM {source} WHERE order_category_ids IS NOT NULL),
pc AS (SELECT CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT) AS categoryid
       FROM {source} WHERE pay_category_ids IS NOT NULL),
dc AS (SELECT categoryid FROM cc UNION SELECT categoryid FROM oc UNION SELECT categoryid FROM pc),
cnt AS (
  SELECT dc.categoryid, coalesce(c.n, 0) AS "clickCount", coalesce(o.n, 0) AS "orderCount",
    coalesce(p.n, 0) AS "payCount"
  FROM dc LEFT JOIN (SELECT categoryid, count(*) AS n FROM cc GROUP BY 1) c USING (categoryid)
  LEFT JOIN (SELECT categoryid, count(*) AS n FROM oc GROUP BY 1) o USING (categoryid)
  LEFT JOIN (SELECT categoryid, count(*) AS n FROM pc GROUP BY 1) p USING (categoryid)),
top AS (SELECT * FROM cnt
        ORDER BY "clickCount" DESC, "orderCount" DESC, "payCount" DESC, categoryid LIMIT 10)"""


_FILTERED_ACT = (
    _filtered() + ", fa AS (SELECT * FROM act WHERE session_id IN (SELECT session_id FROM fs)), "
)
_BEST = _FILTERED_ACT + _category_ctes("fa") + """,
cs AS (SELECT categoryid, session_id, count(*) AS "clickCount" FROM cc
       WHERE categoryid IN (SELECT categoryid FROM top) GROUP BY 1, 2),
best AS (SELECT * FROM cs QUALIFY row_number() OVER (
  PARTITION BY categoryid ORDER BY "clickCount" DESC, session_id) <= 10)"""

def _quota(source: str) -> str:
    return f"""
sh AS (SELECT *, strftime(start_at, '%Y-%m-%d') AS date, strftime(start_at, '%H') AS hour FROM {source}),
hc AS (SELECT date, hour, count(*) AS hour_count FROM sh GROUP BY 1, 2),
hq AS (
  SELECT date, hour, hour_count, day_quota, day_count,
    least(CAST(floor(hour_count / CAST(day_count AS DOUBLE) * day_quota) AS BIGINT), hour_count) AS quota
  FROM (SELECT *, CAST(sum(hour_count) OVER (PARTITION BY date) AS BIGINT) AS day_count,
          {Q.SAMPLE} // (SELECT count(DISTINCT date) FROM hc) AS day_quota FROM hc)),
sam AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY date, hour
      ORDER BY md5(concat(session_id, '{Q.SEED}')), session_id) AS rn FROM sh)
  JOIN hq USING (date, hour) WHERE rn <= quota)"""


def _pairs(order: str = "action_time, event_id") -> str:
    return f"""
pp AS (
  SELECT session_id, concat(CAST(page_id AS VARCHAR), '_', CAST(nxt AS VARCHAR)) AS pair
  FROM (SELECT session_id, page_id, lead(page_id) OVER (
          PARTITION BY session_id ORDER BY {order}) AS nxt FROM act)
  WHERE nxt IS NOT NULL)"""


_STEPS = ", ".join(f"({i}, '{p}')" for i, p in enumerate(flow_pairs(Q.FLOW), 1))
_START = Q.FLOW.split(",")[0]
_CONVERSION = _pairs() + f""",
steps AS (SELECT * FROM (VALUES {_STEPS}) t(step, pair)),
spv AS (SELECT count(*) AS n FROM act WHERE page_id = {_START}),
pv AS (SELECT step, steps.pair, count(pp.pair) AS pv FROM steps LEFT JOIN pp USING (pair) GROUP BY 1, 2),
rated AS (
  SELECT step, pair, pv, coalesce(lag(pv) OVER (ORDER BY step), (SELECT n FROM spv)) AS prior FROM pv),
rates AS (
  SELECT step, pair, CASE WHEN prior > 0
    THEN CAST((200 * pv + prior) // (2 * prior) AS DOUBLE) / 100 END AS rate FROM rated)"""

_AREA = """
clk AS (SELECT city_id, click_product_id AS product_id FROM act WHERE click_product_id <> -1),
apc AS (
  SELECT area, product_id, count(*) AS click_count,
    string_agg(DISTINCT concat(CAST(city_id AS VARCHAR), ':', city_name), ','
      ORDER BY concat(CAST(city_id AS VARCHAR), ':', city_name)) AS city_infos
  FROM clk JOIN cit USING (city_id) GROUP BY 1, 2),
apf AS (
  SELECT area, product_id, click_count, city_infos, product_name,
    json_extract_string(extend_info, '$.product_status') AS status
  FROM apc JOIN prod USING (product_id))"""

_DAILY = f"""
per AS (SELECT date, userid, adid, count(*) AS n FROM ad GROUP BY 1, 2, 3),
listed AS (SELECT userid, min(date) AS listed_in FROM per WHERE n >= {Q.THRESHOLD} GROUP BY 1)"""

_BATCH = (
    "CASE "
    + " ".join(f"WHEN date < '{end}' THEN {i}" for i, end in enumerate(Q.BATCH_ENDS))
    + f" ELSE {len(Q.BATCH_ENDS)} END"
)
_LOOP = f"""
adb AS (SELECT *, replace(province, ' ', '_') AS prov, {_BATCH} AS batch FROM ad),
per AS (SELECT date, userid, adid, min(batch) AS batch, count(*) AS n FROM adb GROUP BY 1, 2, 3),
listed AS (SELECT userid, min(batch) AS listed_in FROM per WHERE n >= {Q.THRESHOLD} GROUP BY 1),
kept AS (SELECT adb.* FROM adb LEFT JOIN listed USING (userid)
         WHERE listed_in IS NULL OR batch <= listed_in)"""


def _top3(source: str, province: str, partition: str) -> str:
    return f"""SELECT date, province, adid, "clickCount" FROM (
      SELECT date, {province} AS province, adid, count(*) AS "clickCount" FROM {source} GROUP BY 1, 2, 3)
    QUALIFY row_number() OVER (PARTITION BY {partition} ORDER BY "clickCount" DESC, adid, date) <= 3"""


def _stat(source: str, province: str = "province") -> str:
    return f"""SELECT date, {province} AS province, city, adid, count(*) AS "clickCount"
    FROM {source} GROUP BY ALL"""


_SLIDING = f"""
SELECT start_s, start_s + {Q.WINDOW[0]} AS end_s, adid, count(*) AS "clickCount" FROM (
  SELECT adid, unnest(generate_series(
      CAST(floor(epoch(ts)) AS BIGINT) // {Q.WINDOW[1]} * {Q.WINDOW[1]} - {Q.WINDOW[0] - Q.WINDOW[1]},
      CAST(floor(epoch(ts)) AS BIGINT) // {Q.WINDOW[1]} * {Q.WINDOW[1]}, {Q.WINDOW[1]})) AS start_s
  FROM ad) GROUP BY 1, 3"""

def _recent(minutes: int) -> str:
    return f"""SELECT strftime(m, '%Y-%m-%d') AS date, strftime(m, '%H') AS hour,
      strftime(m, '%M') AS minute, adid, count(*) AS "clickCount"
    FROM (SELECT date_trunc('minute', ts) AS m, adid FROM ad)
    WHERE m > (SELECT date_trunc('minute', max(ts)) FROM ad) - INTERVAL {minutes} MINUTE
    GROUP BY ALL"""


_HALVES = f"""
h1 AS (SELECT userid, adid, count(*) AS "clickCount" FROM ad WHERE date < '{Q.SPLIT}' GROUP BY 1, 2),
h2 AS (SELECT userid, adid, count(*) AS "clickCount" FROM ad WHERE date >= '{Q.SPLIT}' GROUP BY 1, 2)"""

_RECORD = """rec AS (SELECT user_id, name, CAST(age AS VARCHAR) AS age, professional, sex FROM usr)"""


def _record(age: str = "age", sex: str = "sex") -> str:
    return f"concat('name=', name, '|empty=|age=', {age}, '|professional=', professional, '|sex=', {sex})"


def _levels() -> str:
    from clickloom.sources.driver_tables import LEVELS

    whens = " ".join(f"WHEN area = '{a}' THEN '{lv}'" for a, lv in LEVELS.items())
    return f"CASE {whens} ELSE 'D Level' END"


_P = _conditions(Q.ALL_SIX)

_V = "CAST(CAST(value / 8 AS VARCHAR) AS DECIMAL(30, 15))"

ORACLES: dict[str, str] = {
    "action_date_range": _with(
        f"""SELECT * REPLACE (strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time) FROM act
        WHERE date BETWEEN '{Q.RANGE.start_date}' AND '{Q.RANGE.end_date}'"""
    ),
    "click_scan": _with("SELECT city_id, click_product_id FROM act WHERE click_product_id <> -1"),
    "user_scan": _with("SELECT * FROM usr"),
    "product_scan": _with("SELECT * FROM prod"),
    "city_scan": _with("SELECT * FROM cit"),
    "table_preview": _with("SELECT * FROM usr ORDER BY user_id LIMIT 20"),
    "session_aggregate": _with(f"SELECT {_SESSION} FROM ses"),
    "session_user_join": _with(f"SELECT {_SESSION_USER} FROM su"),
    "session_filter": _with(f"SELECT {_SESSION_USER} FROM fs", _filtered(Q.ALL_SIX)),
    "predicate_matrix": _with(
        "SELECT count(*) AS age_one_bound, count(*) AS sex_unset, "
        + ", ".join(f"count(*) FILTER (WHERE {test}) AS {name}" for name, test in _P.items())
        + " FROM su"
    ),
    "session_histogram": _with(f"SELECT {_COUNTS} FROM ses"),
    "session_ratio_stat": _with(
        f"SELECT '{Q.TASK}' AS taskid, session_count, {_RATIOS} FROM (SELECT {_COUNTS} FROM fs)",
        _filtered(),
    ),
    "filtered_actions": _with(
        f"SELECT {_DETAIL} FROM act a WHERE session_id IN (SELECT session_id FROM fs)", _filtered()
    ),
    "hour_quota": _with("SELECT * FROM hq", _quota("ses")),
    "session_sample": _with(
        f"""SELECT '{Q.TASK}' AS taskid, session_id AS sessionid,
          strftime(start_at, '%Y-%m-%d %H:%M:%S') AS "startTime",
          search_keywords AS "searchKeywords", click_category_ids AS "clickCategoryIds" FROM sam""",
        _quota("su"),
    ),
    "session_sample_detail": _with(
        f"SELECT {_DETAIL} FROM act a WHERE session_id IN (SELECT session_id FROM sam)", _quota("su")
    ),
    "category_click_count": _with(
        'SELECT categoryid, count(*) AS "clickCount" FROM cc GROUP BY 1', _category_ctes("act")
    ),
    "category_order_count": _with(
        'SELECT categoryid, count(*) AS "orderCount" FROM oc GROUP BY 1', _category_ctes("act")
    ),
    "category_pay_count": _with(
        'SELECT categoryid, count(*) AS "payCount" FROM pc GROUP BY 1', _category_ctes("act")
    ),
    "category_distinct": _with("SELECT categoryid FROM dc", _category_ctes("act")),
    "category_distinct_one_kind": _with(
        """SELECT click_category_id AS categoryid FROM act WHERE click_category_id <> -1
        UNION SELECT CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT) FROM act
          WHERE click_category_id = -1 AND order_category_ids IS NOT NULL
        UNION SELECT CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT) FROM act
          WHERE click_category_id = -1 AND order_category_ids IS NULL
            AND pay_category_ids IS NOT NULL"""
    ),
    "category_counts_joined": _with("SELECT * FROM cnt", _category_ctes("act")),
    "category_counts": _with("SELECT * FROM cnt", _category_ctes("act")),
    "categories_in_order": _with(
        'SELECT * FROM cnt ORDER BY "clickCount" DESC, "orderCount" DESC, "payCount" DESC, categoryid',
        _category_ctes("act"),
    ),
    "top10_category": _with(
        f"SELECT '{Q.TASK}' AS taskid, * FROM top", _FILTERED_ACT + _category_ctes("fa")
    ),
    "category_session_clicks": _with(
        'SELECT categoryid, session_id, count(*) AS "clickCount" FROM cc GROUP BY 1, 2',
        _category_ctes("act"),
    ),
    "clicks_in_top_categories": _with(
        """SELECT event_id, session_id, click_category_id FROM act
        WHERE click_category_id IN (SELECT categoryid FROM top)""",
        _category_ctes("act"),
    ),
    "top10_session": _with(
        f"""SELECT '{Q.TASK}' AS taskid, categoryid, session_id AS sessionid, "clickCount"
        FROM best""",
        _BEST,
    ),
    "top10_session_detail": _with(
        f"SELECT {_DETAIL} FROM act a JOIN best ON a.session_id = best.session_id", _BEST
    ),
    "flow_steps": _with(
        """SELECT CAST(i AS INTEGER) AS step, concat(flow[i], '_', flow[i + 1]) AS pair FROM (
          SELECT flow, unnest(range(1, len(flow))) AS i FROM (
            SELECT string_split(concat_ws(',', page_id, order_category_ids, city_id), ',') AS flow FROM act))"""
    ),
    "page_pairs": _with("SELECT * FROM pp", _pairs()),
    "page_pairs_newest_first": _with(
        "SELECT * FROM pp", _pairs("action_time DESC, event_id DESC")
    ),
    "page_pair_counts": _with(
        f"""SELECT pair, count(*) AS pv FROM pp
        WHERE pair IN {_strings(','.join(flow_pairs(Q.FLOW)))} GROUP BY 1""",
        _pairs(),
    ),
    "start_page_pv": _with(f"SELECT count(*) AS start_pv FROM act WHERE page_id = {_START}"),
    "page_conversion": _with(
        f"""SELECT '{Q.TASK}' AS taskid, pair AS "targetPage2Page",
          CAST(rate AS VARCHAR) AS "convertRate" FROM rates""",
        _CONVERSION,
    ),
    "page_conversion_text": _with(
        f"""SELECT '{Q.TASK}' AS taskid, string_agg(
          concat(pair, '=', coalesce(CAST(rate AS VARCHAR), '')), '|' ORDER BY step)
          AS "convertRate" FROM rates""",
        _CONVERSION,
    ),
    "click_city_join": _with("SELECT city_id, city_name, area, product_id FROM clk JOIN cit USING (city_id)", _AREA),
    "area_product_clicks": _with("SELECT * FROM apc", _AREA),
    "area_product_full": _with(
        """SELECT * EXCLUDE (status),
          CASE WHEN status = '0' THEN '自营' ELSE '第三方' END AS product_status FROM apf""",
        _AREA,
    ),
    "area_top3": _with(
        f"""SELECT '{Q.TASK}' AS taskid, area, {_levels()} AS "areaLevel", product_id AS productid,
          city_infos AS "cityInfos", click_count AS "clickCount", product_name AS "productName",
          CASE WHEN status = '0' THEN 'Self' ELSE 'Third Party' END AS "productStatus"
        FROM apf QUALIFY row_number() OVER (
          PARTITION BY area ORDER BY click_count DESC, product_id) <= 3""",
        _AREA,
    ),
    "kv_get": _with(
        """SELECT user_id, name AS get_name, CAST(NULL AS VARCHAR) AS get_empty, age AS get_age,
          sex AS get_sex, CAST(NULL AS VARCHAR) AS get_fessional FROM rec""",
        _RECORD,
    ),
    "kv_set": _with(
        f"""SELECT user_id, {_record(age="'99'")} AS set_age, {_record(sex="'x'")} AS set_sex,
          {_record()} AS set_absent FROM rec""",
        _RECORD,
    ),
    "date_functions": _with(
        """SELECT event_id, action_time < noon AS is_before, action_time > noon AS is_after,
          date_diff('second', noon, action_time) AS seconds,
          strftime(action_time, '%Y-%m-%d_%H') AS hour_key, date AS day,
          strftime(action_time, '%Y-%m-%d %H:%M:%S') AS full_time,
          strftime(action_time, '%Y%m%d') AS day_key,
          strftime(action_time, '%Y%m%d%H%M') AS minute_key, date AS parsed_day,
          date AS key_date, strftime(action_time, '%H') AS key_hour,
          strftime(action_time, '%M') AS key_minute
        FROM (SELECT *, date_trunc('day', action_time) + INTERVAL 12 HOUR AS noon FROM act)"""
    ),
    "string_functions": _with(
        """SELECT user_id, sex = 'male' AS is_empty, professional <> '' AS is_not_empty,
          sex AS trimmed, city AS untouched, lpad(CAST(age AS VARCHAR), 2, '0') AS padded,
          concat(CAST(age AS VARCHAR), '+', CAST(user_id AS VARCHAR)) AS ids,
          concat(CAST(user_id AS VARCHAR), ':', city) AS id_name FROM usr"""
    ),
    "json_field": _with(
        """SELECT product_id, json_extract_string(extend_info, '$.product_status') AS status,
          json_extract_string(extend_info, '$.absent') AS absent FROM prod"""
    ),
    "number_round": f"""SELECT event_id, CAST(round({_V}, 2) AS DOUBLE) AS two,
        CAST(round({_V}, 1) AS DOUBLE) AS one, CAST(round({_V}, 0) AS DOUBLE) AS "none" FROM events""",
    "sql_functions": _with(
        """SELECT area, product_id, click_count, city_infos, city_infos AS city_infos_again,
          CASE WHEN status = '0' THEN 'Self' ELSE 'Third Party' END AS product_status FROM apf""",
        _AREA,
    ),
    "ad_parse": _with(
        """SELECT epoch_us(ts) // 1000 AS ts, replace(province, ' ', '_') AS province, city, userid, adid
        FROM ad"""
    ),
    "ad_user_click_count": _with(
        'SELECT date, userid, adid, n AS "clickCount" FROM per', _DAILY
    ),
    "ad_current_count": _with(
        f"""SELECT date, userid, adid, CASE WHEN date < '{Q.SPLIT}' THEN n ELSE 0 END
          AS "clickCount" FROM per""",
        _DAILY,
    ),
    "ad_users_over": _with("SELECT userid FROM listed", _DAILY),
    "ad_blacklist": _with("SELECT userid, listed_in FROM listed", _DAILY),
    "ad_filtered_clicks": _with(
        """SELECT event_id, date, province, city, userid, adid FROM ad
        LEFT JOIN listed USING (userid) WHERE listed_in IS NULL OR date <= listed_in""",
        _DAILY,
    ),
    "ad_drop_listed": _with(
        f"""SELECT date, province, city, adid, count(*) AS "clickCount" FROM ad
        WHERE userid NOT IN (
          SELECT userid FROM per WHERE date < '{Q.SPLIT}' AND n >= {Q.THRESHOLD}) GROUP BY ALL""",
        _DAILY,
    ),
    "ad_province_counts": _with(
        'SELECT date, province, adid, count(*) AS "clickCount" FROM ad GROUP BY ALL'
    ),
    "ad_top3_by_province_only": _with(_top3("ad", "province", "province")),
    "ad_trend_recent": _with(_recent(60)),
    "ad_stored_trend_recent": _with(_recent(1440)),
    "ad_sliding_window": _with(_SLIDING),
    "ad_stat": _with(_stat("ad")),
    "ad_province_top3": _with(_top3("ad", "province", "date, province")),
    "ad_click_trend": _with(
        """SELECT date, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute, adid,
          count(*) AS "clickCount" FROM ad GROUP BY ALL"""
    ),
    "ad_job_trend": _with(
        """SELECT date, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute, adid,
          count(*) AS "clickCount" FROM ad GROUP BY ALL"""
    ),
    "ad_job_user_counts": _with('SELECT date, userid, adid, n AS "clickCount" FROM per', _DAILY),
    "ad_sliding_stream": _with(_SLIDING),
    "ad_loop_blacklist": _with("SELECT userid FROM listed", _LOOP),
    "ad_loop_stat": _with(_stat("kept", "prov"), _LOOP),
    "ad_loop_top3": _with(_top3("kept", "prov", "date, province"), _LOOP),
    "upsert_increment": _with(
        'SELECT userid, adid, count(*) AS "clickCount" FROM ad GROUP BY 1, 2'
    ),
    "upsert_overwrite": _with(
        "SELECT * FROM h2 UNION ALL SELECT h1.* FROM h1 ANTI JOIN h2 USING (userid, adid)", _HALVES
    ),
    "upsert_replace_group": _with(
        """SELECT * FROM h2 UNION ALL
        SELECT * FROM h1 WHERE userid NOT IN (SELECT userid FROM h2)""",
        _HALVES,
    ),
    "insert_new_only": _with("SELECT DISTINCT userid, adid FROM ad"),
    "table_replace": _with("SELECT * FROM usr"),
}
