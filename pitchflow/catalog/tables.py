"""Queries of the general operators, straight on the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pitchflow.catalog.derived import SQL_RAW, batting_lines, raw_events, team_log, undotted
from pitchflow.catalog.registry import Tables, query
from pitchflow.functions.pitches import choose_side, null_flag, pre_pitch_count
from pitchflow.functions.text import date_prefix, paste
from pitchflow.operators.calendar import (
    count_bitmaps, distinct_days, id_bitmaps, in_windows, merge_bitmaps, pull_weeks, season_windows, week_counts, window_counts,
)
from pitchflow.operators.nested import class_table, drop_list_columns, explode_path, flatten_documents, flatten_struct
from pitchflow.operators.ordered import attach_forward, fill_up, last_of_group_flag, row_index, running_record, streak
from pitchflow.operators.profile import share_all_levels, share_profile
from pitchflow.operators.relational import (
    code_frequencies, col_range, cols_first, exclude_ids, left_join_suffixed, union_fill,
)
from pitchflow.schemas import c
from pitchflow.sources.feeds import parse_documents
from pitchflow.sources.tables import (
    batting_range, lookup_player, lookup_players, pitcher_range, range_from_totals, running_totals, team_games, with_ratios,
)

# --- shares ------------------------------------------------------------------

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _event_flags():
    return {f"{e}_share": (F.col("event_type") == e).cast("int") for e in EVENT_TYPES}


_EVENT_SHARES = ", ".join(
    f"sum(CASE WHEN event_type = '{e}' THEN 1 ELSE 0 END) / count(*) AS {e}_share" for e in EVENT_TYPES
)


@query("share_by_entity", f"SELECT user_id, count(*) AS events, {_EVENT_SHARES} FROM events GROUP BY user_id")
def share_by_entity(t: Tables):
    return share_profile(t.events, ["user_id"], _event_flags(), count_name="events")


@query(
    "share_with_label",
    f"SELECT user_id, max(event_type) AS last_type, count(*) AS events, {_EVENT_SHARES} FROM events GROUP BY user_id",
)
def share_with_label(t: Tables):
    return share_profile(
        t.events, ["user_id"], _event_flags(), F.col("event_type"), "last_type", "events", category=["event_type"]
    )


def _line_flags():
    return {
        "open_share": (F.col("l_linestatus") == "O").cast("int"),
        "returned_share": F.col("l_returnflag").isin("R").cast("int"),
        "bulk_share": (F.col("l_quantity") >= 25).cast("int"),
    }


_LINE_SHARES = (
    "count(*) AS lines, sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) / count(*) AS open_share, "
    "sum(CASE WHEN l_returnflag IN ('R') THEN 1 ELSE 0 END) / count(*) AS returned_share, "
    "sum(CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END) / count(*) AS bulk_share"
)


@query(
    "share_by_entity_key",
    f"SELECT l_suppkey, l_linenumber, {_LINE_SHARES} FROM lineitem GROUP BY l_suppkey, l_linenumber",
)
def share_by_entity_key(t: Tables):
    return share_profile(t.lineitem, ["l_suppkey", "l_linenumber"], _line_flags(), count_name="lines")


@query(
    "share_by_entity_two_keys",
    f"SELECT l_suppkey, l_linenumber, l_returnflag, {_LINE_SHARES} FROM lineitem "
    "GROUP BY l_suppkey, l_linenumber, l_returnflag",
)
def share_by_entity_two_keys(t: Tables):
    return share_profile(t.lineitem, ["l_suppkey", "l_linenumber", "l_returnflag"], _line_flags(), count_name="lines")


@query(
    "share_all_levels",
    f"""SELECT l_suppkey, l_linenumber, l_returnflag,
  'l_suppkey' || CASE WHEN grouping(l_linenumber) = 0 THEN ',l_linenumber' ELSE '' END
              || CASE WHEN grouping(l_returnflag) = 0 THEN ',l_returnflag' ELSE '' END AS level, {_LINE_SHARES}
FROM lineitem GROUP BY GROUPING SETS ((l_suppkey), (l_suppkey, l_linenumber), (l_suppkey, l_returnflag),
                                      (l_suppkey, l_linenumber, l_returnflag))""",
)
def share_levels(t: Tables):
    return share_all_levels(t.lineitem, "l_suppkey", ["l_linenumber", "l_returnflag"], _line_flags(), count_name="lines")


@query(
    "entity_threshold_filter",
    "SELECT event_id, user_id, event_type, value FROM events "
    "WHERE user_id = 7 AND value >= 20 AND event_type = 'purchase' AND event_type IS NOT NULL",
)
def entity_threshold_filter(t: Tables):
    return t.events.where(
        (F.col("user_id") == 7) & (F.col("value") >= 20) & (F.col("event_type") == "purchase") & F.col("event_type").isNotNull()
    ).select("event_id", "user_id", "event_type", "value")


# The text of the label for other pitches is the one in functions/pitches.py.
# --- expressions -------------------------------------------------------------


@query(
    "count_label",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN l_returnflag = 'A' THEN l_linenumber || '-' || (CAST(l_quantity AS INTEGER) - 1)
       WHEN l_returnflag = 'N' THEN (l_linenumber - 1) || '-' || CAST(l_quantity AS INTEGER)
       WHEN l_linestatus = 'F' THEN l_linenumber || '-' || CAST(l_quantity AS INTEGER)
       ELSE 'Pitch Not a Ball or Strike. Original Count: ' || l_linenumber || '-' || CAST(l_quantity AS INTEGER)
  END AS count_label
FROM lineitem""",
)
def count_label(t: Tables):
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity").cast("int")
    label = pre_pitch_count(flag == "A", flag == "N", F.col("l_linestatus") == "F", F.col("l_linenumber"), quantity)
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", label.alias("count_label"))


@query(
    "paste_missing",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN 'NA' ELSE l_returnflag END "
    "|| '-' || l_linenumber AS pasted, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS missing FROM lineitem",
)
def paste_missing(t: Tables):
    flag = F.when(F.col("l_linestatus") != "O", F.col("l_returnflag"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", paste(flag, F.col("l_linenumber")).alias("pasted"), null_flag(flag).alias("missing")
    )


@query(
    "side_columns",
    """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_linestatus = 'O' THEN l_partkey ELSE l_suppkey END AS batting,
  CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_linestatus = 'O' THEN l_suppkey ELSE l_partkey END AS fielding
FROM lineitem""",
)
def sides(t: Tables):
    half = F.when(F.col("l_returnflag") != "N", F.when(F.col("l_linestatus") == "O", "bottom").otherwise("top"))
    a, b = F.col("l_partkey"), F.col("l_suppkey")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", choose_side(half, a, b).alias("batting"), choose_side(half, b, a).alias("fielding")
    )


@query("date_prefix", "SELECT event_id, substr(CAST(ts AS VARCHAR), 1, 10) AS day FROM events")
def day_text(t: Tables):
    return t.events.select("event_id", date_prefix(F.col("ts")).alias("day"))


@query("column_range", "SELECT substr(CAST(o_orderdate AS VARCHAR), 1, 10) AS o_orderdate, o_custkey, o_orderstatus, o_totalprice FROM orders")
def column_range(t: Tables):
    orders = t.orders.select(*[c(n) for n in col_range(t.orders, "o_custkey", "o_orderdate")])
    return cols_first(orders.withColumn("o_orderdate", date_prefix(F.col("o_orderdate"))), "o_orderdate")


# --- frequencies, distinct values ---------------------------------------------


@query(
    "code_frequencies",
    "SELECT l_returnflag, l_linestatus, count(*) AS cnt FROM lineitem GROUP BY ALL ORDER BY 1 NULLS LAST, 2 NULLS LAST",
)
def line_codes(t: Tables):
    return code_frequencies(t.lineitem, "l_returnflag", "l_linestatus")


@query("category_counts", "SELECT o_orderstatus, count(*) AS cnt FROM orders GROUP BY o_orderstatus")
def order_states(t: Tables):
    return code_frequencies(t.orders, "o_orderstatus", ordered=False)


@query("distinct_days", "SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS game_date FROM events")
def event_days(t: Tables):
    return distinct_days(t.events, "ts").select(F.col("game_date").cast("string").alias("game_date"))


# --- row order -----------------------------------------------------------------

def _piece():
    """event_id is unique: at most 256 rows of any group share a piece, so every table has groups of several pieces."""
    return F.shiftright(F.col("event_id"), 8)


@query(
    "fill_up",
    """SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w AS next_purchase,
  last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER w AS next_signup
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def next_events(t: Tables):
    df = t.events.select(
        "event_id", "user_id",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("next_purchase"),
        F.when(F.col("event_type") == "signup", F.col("event_id")).alias("next_signup"),
    )
    return fill_up(df, ["next_purchase", "next_signup"], ["user_id"], ["event_id"], _piece())


_FLAG_ROWS = f"""WITH {SQL_RAW}, r AS (
  SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CASE WHEN k <> 0 THEN k END AS number FROM raw)
"""


def _numbered(t: Tables):
    return raw_events(t.events).select(
        "event_id", "user_id", F.to_date("ts").cast("string").alias("day"), F.when(F.col("k") != 0, F.col("k")).alias("number")
    )


@query(
    "last_of_group_flag",
    _FLAG_ROWS + """SELECT *, CASE WHEN bool_or(number IS NULL) OVER w THEN NULL
  WHEN number = max(number) OVER w THEN 'true' ELSE 'false' END AS last_flag
FROM r WINDOW w AS (PARTITION BY user_id, day)""",
)
def last_flag(t: Tables):
    return last_of_group_flag(_numbered(t), "number", ["user_id", "day"], "last_flag", segment=_piece())


@query(
    "last_of_group_flag_ignore",
    _FLAG_ROWS + """SELECT *, CASE WHEN number IS NULL THEN NULL
  WHEN number = max(number) OVER w THEN 'true' ELSE 'false' END AS last_flag
FROM r WINDOW w AS (PARTITION BY user_id, day)""",
)
def last_flag_ignore(t: Tables):
    return last_of_group_flag(_numbered(t), "number", ["user_id", "day"], "last_flag", "ignore", segment=_piece())


_LOG = f"""WITH {SQL_RAW}, log AS (
  SELECT event_id AS game_no, CAST(ts AS DATE) AS Date, 'T' || (user_id % 30) AS Tm,
         CASE WHEN k % 2 = 0 THEN 'Home' ELSE '@' END AS Home_Away,
         CASE WHEN value * k % 7 < 4 THEN 'W' ELSE 'L' END AS wl, k AS R FROM raw)
"""


def _log(t: Tables):
    return team_log(t.events).withColumnRenamed("W/L", "wl")


@query(
    "running_record",
    _LOG + """SELECT game_no, Tm, wl, sum(CASE WHEN wl = 'W' THEN 1 ELSE 0 END) OVER w || '-' ||
  sum(CASE WHEN wl = 'L' THEN 1 ELSE 0 END) OVER w AS record
FROM log WINDOW w AS (PARTITION BY Tm ORDER BY game_no ROWS UNBOUNDED PRECEDING)""",
)
def record(t: Tables):
    log = _log(t).select("game_no", "Tm", "wl")
    return running_record(log, "wl", ["Tm"], ["game_no"], "record", segment=F.shiftright("game_no", 8))


@query(
    "streak",
    _LOG + """, runs AS (
  SELECT game_no, Tm, wl, row_number() OVER (PARTITION BY Tm ORDER BY game_no)
         - row_number() OVER (PARTITION BY Tm, wl ORDER BY game_no) AS run FROM log)
SELECT game_no, Tm, wl, CAST((CASE WHEN wl = 'W' THEN 1 ELSE -1 END) *
  row_number() OVER (PARTITION BY Tm, wl, run ORDER BY game_no) AS INTEGER) AS streak FROM runs""",
)
def runs(t: Tables):
    log = _log(t).select("game_no", "Tm", "wl")
    return streak(log, "wl", ["Tm"], ["game_no"], "streak", segment=F.shiftright("game_no", 8))


# The same with pieces that the operators find: two fifths of the users are one group.
_SKEWED = "CASE WHEN user_id % 5 < 2 THEN -1 ELSE user_id END"


@query("row_index", "SELECT row_number() OVER (ORDER BY value DESC, event_id) - 1 AS row, event_id, value FROM events")
def numbered_events(t: Tables):
    falling = t.events.selectExpr("event_id", "value", "-value AS less")
    return row_index(falling, ["less", "event_id"], "row").drop("less")


@query(
    "row_index_by_group",
    f"SELECT 1 + row_number() OVER (PARTITION BY {_SKEWED} ORDER BY ts, event_id) - 1 AS row, event_id, {_SKEWED} AS k FROM events",
)
def numbered_by_group(t: Tables):
    return row_index(t.events.selectExpr("event_id", "ts", f"{_SKEWED} AS k"), ["ts", "event_id"], "row", ["k"], start=1).drop("ts")


@query(
    "fill_up_found",
    f"""SELECT event_id, {_SKEWED} AS k, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w AS next_purchase
FROM events WINDOW w AS (PARTITION BY {_SKEWED} ORDER BY event_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def next_purchase(t: Tables):
    df = t.events.selectExpr("event_id", f"{_SKEWED} AS k", "if(event_type = 'purchase', value, NULL) AS next_purchase")
    return fill_up(df, ["next_purchase"], ["k"], ["event_id"])


@query(
    "last_of_group_flag_found",
    _FLAG_ROWS + f"""SELECT event_id, {_SKEWED} AS k, number, CASE WHEN number IS NULL THEN NULL
  WHEN number = max(number) OVER w THEN 'true' ELSE 'false' END AS last_flag
FROM r WINDOW w AS (PARTITION BY {_SKEWED})""",
)
def last_flag_found(t: Tables):
    df = _numbered(t).selectExpr("event_id", f"{_SKEWED} AS k", "number")
    return last_of_group_flag(df, "number", ["k"], "last_flag", "ignore")


_SKEWED_TEAM = "CASE WHEN Tm IN ('T1', 'T2', 'T3', 'T4', 'T5', 'T6', 'T7', 'T8', 'T9') THEN 'T1' ELSE Tm END"


@query(
    "running_record_found",
    _LOG + f"""SELECT game_no, {_SKEWED_TEAM} AS team, wl, sum(CASE WHEN wl = 'W' THEN 1 ELSE 0 END) OVER w || '-' ||
  sum(CASE WHEN wl = 'L' THEN 1 ELSE 0 END) OVER w AS record
FROM log WINDOW w AS (PARTITION BY {_SKEWED_TEAM} ORDER BY game_no ROWS UNBOUNDED PRECEDING)""",
)
def record_found(t: Tables):
    log = _log(t).selectExpr("game_no", f"{_SKEWED_TEAM} AS team", "wl")
    return running_record(log, "wl", ["team"], ["game_no"], "record")


@query(
    "streak_found",
    _LOG + f""", teams AS (SELECT game_no, {_SKEWED_TEAM} AS team, wl FROM log), runs AS (
  SELECT game_no, team, wl, row_number() OVER (PARTITION BY team ORDER BY game_no)
         - row_number() OVER (PARTITION BY team, wl ORDER BY game_no) AS run FROM teams)
SELECT game_no, team, wl, CAST((CASE WHEN wl = 'W' THEN 1 ELSE -1 END) *
  row_number() OVER (PARTITION BY team, wl, run ORDER BY game_no) AS INTEGER) AS streak FROM runs""",
)
def runs_found(t: Tables):
    log = _log(t).selectExpr("game_no", f"{_SKEWED_TEAM} AS team", "wl")
    return streak(log, "wl", ["team"], ["game_no"], "streak")


_PURCHASES = f"""a AS (SELECT event_id, {_SKEWED} AS k, CASE WHEN event_id % 41 <> 0 THEN date_trunc('minute', ts) END AS at FROM events),
b AS (
  SELECT {_SKEWED} AS k, CASE WHEN event_id % 37 <> 0 THEN date_trunc('minute', ts) END AS bought_at, event_id AS purchase_id
  FROM events WHERE event_type = 'purchase'),
firsts AS (SELECT k, bought_at, min(purchase_id) AS purchase_id FROM b WHERE bought_at IS NOT NULL GROUP BY k, bought_at)
"""


def _sides(t: Tables):
    minute = lambda n: f"if(event_id % {n} <> 0, date_trunc('minute', ts), NULL)"
    left = t.events.selectExpr("event_id", f"{_SKEWED} AS k", f"{minute(41)} AS at")
    right = t.events.where("event_type = 'purchase'").selectExpr(f"{_SKEWED} AS k", f"{minute(37)} AS bought_at", "event_id AS purchase_id")
    return left, right


@query(
    "attach_forward",
    f"""WITH {_PURCHASES} SELECT a.event_id, a.k, strftime(a.at, '%Y-%m-%d %H:%M') AS at, strftime(f.bought_at, '%Y-%m-%d %H:%M') AS bought_at, f.purchase_id
FROM a ASOF LEFT JOIN firsts f ON a.k = f.k AND a.at <= f.bought_at""",
)
def next_bought(t: Tables):
    left, right = _sides(t)
    out = attach_forward(left, right, ["k"], ("at", "bought_at"), ["bought_at", "purchase_id"])
    return out.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm") for n in ("at", "bought_at")})


@query(
    "attach_forward_strict",
    f"""WITH {_PURCHASES} SELECT a.event_id, a.k, f.purchase_id
FROM a ASOF LEFT JOIN firsts f ON a.k = f.k AND a.at < f.bought_at""",
)
def next_bought_later(t: Tables):
    left, right = _sides(t)
    return attach_forward(left, right, ["k"], ("at", "bought_at"), ["bought_at", "purchase_id"], strict=True).select("event_id", "k", "purchase_id")


@query(
    "sort_two_keys",
    "SELECT event_id, user_id, event_type FROM events ORDER BY user_id DESC NULLS LAST, event_type DESC NULLS LAST, event_id",
)
def sort_two_keys(t: Tables):
    return t.events.select("event_id", "user_id", "event_type").orderBy(
        F.desc_nulls_last("user_id"), F.desc_nulls_last("event_type"), "event_id"
    )


@query("head", "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 10")
def head(t: Tables):
    return t.events.select("event_id", "user_id", "value").orderBy(F.desc("value"), "event_id").limit(10)


# --- joins and unions ------------------------------------------------------------


@query(
    "left_join_suffixed",
    """WITH l AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS o_custkey, o_orderkey % 25 AS nation FROM orders),
r AS (SELECT CASE WHEN c_custkey <> 7 THEN c_custkey END AS c_custkey, c_nationkey AS nation, c_mktsegment FROM customer)
SELECT l.o_orderkey, l.o_custkey, l.nation AS nation_x, r.nation AS nation_y, r.c_mktsegment
FROM l LEFT JOIN r ON l.o_custkey IS NOT DISTINCT FROM r.c_custkey""",
)
def orders_customers(t: Tables):
    # One customer has no key, so each order without one meets one row.
    left = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_custkey")).alias("o_custkey"),
        (F.col("o_orderkey") % 25).alias("nation"),
    )
    right = t.customer.select(
        F.when(F.col("c_custkey") != 7, F.col("c_custkey")).alias("c_custkey"), F.col("c_nationkey").alias("nation"),
        "c_mktsegment",
    )
    return undotted(left_join_suffixed(left, right, [("o_custkey", "c_custkey")]))


@query(
    "left_join_hot_keys",
    """WITH l AS (SELECT event_id, CASE WHEN user_id % 50 <> 0 THEN user_id % 10 END AS k FROM events),
r AS (SELECT CASE WHEN s_suppkey % 20 <> 0 THEN s_suppkey % 47 END AS k, s_suppkey, s_name FROM supplier)
SELECT l.event_id, l.k, r.s_suppkey, r.s_name FROM l LEFT JOIN r ON l.k IS NOT DISTINCT FROM r.k""",
)
def errors_suppliers(t: Tables):
    # Every right key counts as frequent here, so all rows take the way of the frequent ones.
    left = t.events.selectExpr("event_id", "if(user_id % 50 <> 0, user_id % 10, NULL) AS k")
    right = t.supplier.selectExpr("if(s_suppkey % 20 <> 0, s_suppkey % 47, NULL) AS k", "s_suppkey", "s_name")
    return left_join_suffixed(left, right, [("k", "k")], hot_right_rows=1)


@query(
    "ids_for_days",
    """SELECT o_orderkey FROM orders JOIN (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem
  WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1996-01-15') d ON CAST(o_orderdate AS DATE) = d.day
WHERE o_orderkey NOT IN (17, 4711)""",
)
def ids_for_days(t: Tables):
    shipped = t.lineitem.where((F.col("l_shipdate") >= "1996-01-01") & (F.col("l_shipdate") < "1996-01-15"))
    days = F.broadcast(distinct_days(shipped, "l_shipdate"))  # two weeks
    orders = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("game_date"))
    return exclude_ids(orders.join(days, "game_date"), "o_orderkey", [17, 4711]).select("o_orderkey")


@query(
    "exclude_id_table",
    "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
)
def exclude_id_table(t: Tables):
    returned = t.lineitem.where("l_returnflag = 'R'").select("l_orderkey")
    return exclude_ids(t.orders.select("o_orderkey"), "o_orderkey", returned)


@query(
    "union_fill",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL::INTEGER AS nation FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier""",
)
def customers_suppliers(t: Tables):
    customers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.select(
        F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    return union_fill(customers, suppliers)


@query(
    "union_strict",
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def names(t: Tables):
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    suppliers = t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return union_fill(customers, suppliers, strict=True)


@query(
    "name_lookup",
    "SELECT p_partkey, p_name, p_brand FROM part WHERE lower(split_part(p_name, ' ', 2)) = 'ring' "
    "AND lower(split_part(p_name, ' ', 1)) = 'small'",
)
def name_lookup(t: Tables):
    words = F.split("p_name", " ")
    parts = t.part.select("p_partkey", "p_name", "p_brand", words[0].alias("first"), words[1].alias("last"))
    return lookup_player(parts, "Ring", "Small").drop("first", "last")


@query(
    "name_lookup_batch",
    """WITH best AS (SELECT lower(p_name) AS n, min(p_partkey) AS p_partkey FROM part GROUP BY 1)
SELECT d.p_name, b.p_partkey FROM (SELECT DISTINCT upper(p_name) AS p_name FROM part) d LEFT JOIN best b ON lower(d.p_name) = b.n""",
)
def name_lookup_batch(t: Tables):
    wanted = t.part.select(F.upper("p_name").alias("p_name")).distinct()
    return lookup_players(wanted, t.part.select("p_name", "p_partkey"), ["p_name"], ["p_partkey"])


# --- weeks and date ranges ---------------------------------------------------------

FIRST, LAST = dt.date(2024, 1, 3), dt.date(2024, 1, 20)
_WEEKS = """grid AS (
  SELECT CAST(row_number() OVER (ORDER BY g) AS INTEGER) AS week, CAST(g AS DATE) AS start_date, CAST(g AS DATE) + 6 AS end_date
  FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-20', INTERVAL 7 DAY)) AS g))"""


@query(
    "week_pull",
    f"""WITH {_WEEKS} SELECT event_id, week, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date
FROM events JOIN grid ON CAST(ts AS DATE) BETWEEN start_date AND end_date""",
)
def week_pull(t: Tables):
    pulled = pull_weeks(t.events, "ts", FIRST, LAST)
    return pulled.select(
        "event_id", "week", F.col("start_date").cast("string").alias("start_date"), F.col("end_date").cast("string").alias("end_date")
    )


@query(
    "week_counts",
    f"""WITH {_WEEKS} SELECT week, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
  count(event_id) AS number_rows, CASE WHEN count(event_id) > 0 THEN 'ok' ELSE 'empty' END AS status
FROM grid LEFT JOIN events ON CAST(ts AS DATE) BETWEEN start_date AND end_date GROUP BY ALL""",
)
def weeks(t: Tables):
    counts = week_counts(t.events, "ts", FIRST, LAST)
    return counts.withColumns({n: F.col(n).cast("string") for n in ("start_date", "end_date")})


# Two seasons with a gap, and one across both.
SEASONS = [(dt.date(2024, 1, 2), dt.date(2024, 1, 12)), (dt.date(2024, 1, 23), dt.date(2024, 2, 5)), (dt.date(2024, 1, 10), dt.date(2024, 1, 25))]
_SEASONS = """seasons AS (SELECT * FROM (VALUES (1, DATE '2024-01-02', DATE '2024-01-12'), (2, DATE '2024-01-23', DATE '2024-02-05'),
  (3, DATE '2024-01-10', DATE '2024-01-25')) AS v(season, a, b)),
windows AS (
  SELECT season, CAST(i + 1 AS INTEGER) AS week, a + CAST(7 * i AS INTEGER) AS start_date, a + CAST(7 * i + 6 AS INTEGER) AS end_date
  FROM (SELECT *, unnest(range((b - a) // 7 + 1)) AS i FROM seasons))"""


@query(
    "window_pull",
    f"""WITH {_SEASONS} SELECT event_id, season, week, CAST(start_date AS VARCHAR) AS start_date
FROM events JOIN windows ON CAST(ts AS DATE) BETWEEN start_date AND end_date""",
)
def window_pull(t: Tables):
    pulled = in_windows(t.events, "ts", season_windows(t.spark, SEASONS))
    return pulled.select("event_id", "season", "week", F.col("start_date").cast("string").alias("start_date"))


@query(
    "window_counts",
    f"""WITH {_SEASONS}, failed AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE event_type = 'error' AND value > 199)
SELECT season, week, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, n AS number_rows,
  CASE WHEN bad > 0 THEN 'error' WHEN n > 0 THEN 'ok' ELSE 'empty' END AS status
FROM (SELECT w.*, (SELECT count(*) FROM events WHERE CAST(ts AS DATE) BETWEEN w.start_date AND w.end_date) AS n,
  (SELECT count(*) FROM failed WHERE day BETWEEN w.start_date AND w.end_date) AS bad FROM windows w)""",
)
def window_states(t: Tables):
    """The windows of events far above the others count as failed pulls."""
    failed = t.events.where("event_type = 'error' AND value > 199").select("ts")
    counts = window_counts(t.events, "ts", season_windows(t.spark, SEASONS), failed)
    return counts.withColumns({n: F.col(n).cast("string") for n in ("start_date", "end_date")})


@query(
    "distinct_ids_by_week",
    "SELECT CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week, count(DISTINCT user_id) AS users, count(DISTINCT event_id) AS games FROM events GROUP BY 1",
)
def ids_by_week(t: Tables):
    weekly = t.events.selectExpr("CAST(to_date(date_trunc('week', ts)) AS STRING) AS week", "user_id", "event_id")
    counts = [count_bitmaps(id_bitmaps(weekly, n, ["week"]), ["week"], name) for n, name in (("user_id", "users"), ("event_id", "games"))]
    return counts[0].join(counts[1], "week")


@query("distinct_ids_merged", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def ids_merged(t: Tables):
    """Counted by week and kind, then merged over the weeks: the weeks' users are not added up but joined."""
    weekly = id_bitmaps(t.events.selectExpr("weekofyear(ts) AS week", "event_type", "user_id"), "user_id", ["week", "event_type"])
    return count_bitmaps(merge_bitmaps(weekly, ["event_type"]), ["event_type"], "users")


@query(
    "pitcher_range",
    "SELECT event_id, user_id AS pitcher, CAST(CAST(ts AS DATE) AS VARCHAR) AS game_date, value FROM events "
    "WHERE user_id = 8 AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-19'",
)
def one_pitcher(t: Tables):
    pitches = t.events.select("event_id", F.col("user_id").alias("pitcher"), F.col("ts").alias("game_date"), "value")
    out = pitcher_range(pitches, "2024-01-05", "2024-01-19", 8)
    return out.withColumn("game_date", date_prefix(F.col("game_date")))


@query(
    "batting_range",
    """WITH s AS (SELECT l_suppkey AS mlb_ID, sum(CAST(l_quantity AS INTEGER)) AS AB, sum(l_linenumber) AS H,
  sum(l_partkey % 3) AS b2, sum(l_partkey % 2) AS b3, sum(l_orderkey % 2) AS HR, sum(l_orderkey % 4) AS BB,
  sum(l_linenumber % 2) AS HBP, sum(l_orderkey % 3) AS SF
  FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1998-09-30' GROUP BY l_suppkey),
r AS (SELECT *, CAST(H AS DOUBLE) / AB AS BA, CAST(H + BB + HBP AS DOUBLE) / (AB + BB + HBP + SF) AS OBP,
  CAST(H + b2 + 2 * b3 + 3 * HR AS DOUBLE) / AB AS SLG FROM s)
SELECT mlb_ID, CAST(AB AS BIGINT) AS AB, CAST(H AS BIGINT) AS H, CAST(b2 AS BIGINT) AS "2B", CAST(b3 AS BIGINT) AS "3B",
  CAST(HR AS BIGINT) AS HR, CAST(BB AS BIGINT) AS BB, CAST(HBP AS BIGINT) AS HBP, CAST(SF AS BIGINT) AS SF,
  BA, OBP, SLG, OBP + SLG AS OPS FROM r""",
)
def batting(t: Tables):
    counting = ["AB", "H", "2B", "3B", "HR", "BB", "HBP", "SF"]
    return batting_range(batting_lines(t.lineitem), "1996-03-01", "1998-09-30", counting=counting, digits=None)


@query(
    "batting_range_from_totals",
    """WITH s AS (SELECT l_suppkey AS mlb_ID, sum(CAST(l_quantity AS INTEGER)) AS AB, sum(l_linenumber) AS H,
  sum(l_partkey % 3) AS b2, sum(l_partkey % 2) AS b3, sum(l_orderkey % 2) AS HR, sum(l_orderkey % 4) AS BB,
  sum(l_linenumber % 2) AS HBP, sum(l_orderkey % 3) AS SF
  FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-03-20' GROUP BY l_suppkey),
r AS (SELECT *, CAST(H AS DOUBLE) / AB AS BA, CAST(H + BB + HBP AS DOUBLE) / (AB + BB + HBP + SF) AS OBP,
  CAST(H + b2 + 2 * b3 + 3 * HR AS DOUBLE) / AB AS SLG FROM s)
SELECT mlb_ID, CAST(AB AS BIGINT) AS AB, CAST(H AS BIGINT) AS H, CAST(b2 AS BIGINT) AS "2B", CAST(b3 AS BIGINT) AS "3B",
  CAST(HR AS BIGINT) AS HR, CAST(BB AS BIGINT) AS BB, CAST(HBP AS BIGINT) AS HBP, CAST(SF AS BIGINT) AS SF,
  BA, OBP, SLG, OBP + SLG AS OPS FROM r""",
)
def batting_totals(t: Tables):
    counting = ["AB", "H", "2B", "3B", "HR", "BB", "HBP", "SF"]
    totals = running_totals(batting_lines(t.lineitem), ["mlb_ID"], "Date", counting)
    return with_ratios(range_from_totals(totals, ["mlb_ID"], "Date", "1996-03-01", "1996-03-20", counting), digits=None)


@query(
    "team_season",
    _LOG + "SELECT game_no, CAST(Date AS VARCHAR) AS Date, Tm, Home_Away, wl, R FROM log WHERE Tm = 'T7' AND year(Date) = 2024",
)
def team_season(t: Tables):
    return team_games(_log(t), "T7", season=2024).withColumn("Date", F.col("Date").cast("string"))


@query(
    "team_dates",
    _LOG + "SELECT game_no, CAST(Date AS VARCHAR) AS Date, Tm, Home_Away, wl, R FROM log "
    "WHERE Tm = 'T7' AND Date BETWEEN DATE '2024-01-06' AND DATE '2024-01-12'",
)
def team_dates(t: Tables):
    return team_games(_log(t), "T7", first="2024-01-06", last="2024-01-12").withColumn("Date", F.col("Date").cast("string"))


# --- nested data ---------------------------------------------------------------------


@query("json_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_field(t: Tables):
    return parse_documents(t.events, "props", "k INT", keep=("event_id",)).select("event_id", "k")


@query(
    "flatten_found",
    """SELECT event_id, CASE WHEN event_id % 100 = 7 THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN event_id % 100 <> 7 THEN event_type END AS kind,
  CASE WHEN event_id % 100 <> 7 AND event_type = 'purchase' THEN value END AS sale_value,
  CASE WHEN event_id % 100 <> 7 AND event_type = 'purchase' THEN user_id END AS sale_to_user,
  CASE WHEN event_id % 100 <> 7 AND event_type = 'error' THEN props END AS text
FROM events""",
)
def flatten_found(t: Tables):
    """Documents whose fields differ by kind, some cut off; nobody names the fields."""
    sale = "named_struct('value', value, 'to', named_struct('user', user_id))"
    document = f"""to_json(named_struct('kind', event_type, 'sale', if(event_type = 'purchase', {sale}, NULL), 'text', if(event_type = 'error', props, NULL)))"""
    texts = t.events.selectExpr("event_id", f"{document} AS d").selectExpr("event_id", "if(event_id % 100 = 7, left(d, length(d) - 3), d) AS d")
    out = undotted(flatten_documents(texts, "d", ["event_id"]))
    return out.withColumn("sale_value", F.col("sale_value").cast("double"))


@query(
    "flatten_struct",
    'SELECT o_orderkey, o_custkey AS customer_key, o_orderstatus AS state_now_status, o_orderpriority AS state_now_priority FROM orders',
)
def flatten(t: Tables):
    nested = t.orders.select(
        "o_orderkey", F.struct(F.col("o_custkey").alias("key")).alias("customer"),
        F.struct(F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).alias("now")).alias("state"),
    )
    return undotted(flatten_struct(nested))


@query(
    "explode_path",
    "SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos_0, CAST(unnest(embedding) AS DOUBLE) AS element FROM embeddings",
)
def vector_elements(t: Tables):
    out = explode_path(t.embeddings, ["embedding"], keep=["vec_id"], positions=True)
    return out.withColumn("element", F.col("element").cast("double"))


@query(
    "class_table",
    """SELECT 'vec_id' AS variable, 'bigint' AS value, count(vec_id) AS present FROM embeddings
UNION ALL SELECT 'embedding', 'list', count(embedding) FROM embeddings UNION ALL SELECT 'label', 'int', count(label) FROM embeddings""",
)
def column_classes(t: Tables):
    """The class of every column, and in how many rows it is present."""
    names = t.embeddings.columns
    present = t.embeddings.agg(*[F.count(c(n)).alias(n) for n in names]).unpivot([], [c(n) for n in names], "variable", "present")
    return class_table(t.embeddings).join(present, "variable")


@query("drop_list_columns", "SELECT vec_id, label FROM embeddings")
def scalar_columns(t: Tables):
    return drop_list_columns(t.embeddings)
