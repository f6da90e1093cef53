"""Extensions: relational queries that the corpus has no counterpart for. No parity is claimed for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapidar.sources import sink
from lapidar.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

GAP = 1800
"""Seconds without an event that end a session."""


def query(sql: str) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql.strip()
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(name: str):
    """Money as an exact number: sums don't depend on their order."""
    return F.col(name).cast("decimal(18,2)")


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
count(DISTINCT l_orderkey) AS n_orders FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def ext_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(cents("l_quantity")).cast("double").alias("quantity"),
                                                            F.sum(cents("l_extendedprice")).cast("double").alias("price"), F.countDistinct("l_orderkey").alias("n_orders"))


@query("""SELECT n_name, r_name, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS price FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def ext_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by customer are added up before the small tables are joined."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum(cents("o_totalprice")).alias("price"))
    found = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    found = found.groupBy("c_nationkey").agg(F.sum("n").alias("n_orders"), F.sum("price").alias("price"))
    found = found.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return found.select("n_name", "r_name", "n_orders", F.col("price").cast("double").alias("price"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def ext_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(orders, "c_custkey", "left_anti")


@query("""SELECT * FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders) WHERE place <= 3""")
def ext_top_of_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", place.cast("long").alias("place")).where("place <= 3")


@query("""SELECT o_orderkey, lag(o_orderkey) OVER w AS before_key, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) AS last_three
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def ext_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.lag("o_orderkey").over(w).alias("before_key"),
                                                 F.sum(cents("o_totalprice")).over(w.rowsBetween(-2, 0)).cast("double").alias("last_three"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def ext_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("""SELECT n_nationkey AS nation FROM nation EXCEPT (SELECT c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 7 = 0
INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal < 0 AND c_custkey % 3 = 0)""")
def ext_set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    both = customer.where("c_mktsegment = 'BUILDING' and c_custkey % 7 = 0").select("c_nationkey").intersect(customer.where("c_acctbal < 0 and c_custkey % 3 = 0").select("c_nationkey"))
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation")).subtract(both)


@query("""(SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier) EXCEPT ALL
(SELECT c_nationkey FROM customer WHERE c_acctbal < 5000 INTERSECT ALL SELECT c_nationkey FROM customer WHERE c_mktsegment <> 'BUILDING')""")
def ext_set_operations_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets in which a row counts as often as it stands."""
    customer = table(spark, sf_dir, "customer")
    every = customer.select(F.col("c_nationkey").alias("nation")).unionAll(table(spark, sf_dir, "supplier").select("s_nationkey"))
    both = customer.where("c_acctbal < 5000").select("c_nationkey").intersectAll(customer.where("c_mktsegment <> 'BUILDING'").select("c_nationkey"))
    return every.exceptAll(both)


@query("""SELECT l_returnflag, l_linestatus, l_shipdate >= TIMESTAMP '1995-01-01' AS late, grouping(l_returnflag) AS all_flags, count(*) AS n FROM lineitem
GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_shipdate >= TIMESTAMP '1995-01-01'), ())""")
def ext_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("late", F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp"))
    sets = [[F.col("l_returnflag"), F.col("l_linestatus")], [F.col("late")], []]
    return rows.groupingSets(sets, "l_returnflag", "l_linestatus", "late").agg(F.grouping("l_returnflag").cast("long").alias("all_flags"), F.count("*").alias("n"))


BAND = 600
"""Seconds within which an event counts as near a purchase."""


@query(f"""SELECT p.event_id, count(e.event_id) AS n_near FROM (SELECT * FROM events WHERE event_type = 'purchase') p
LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') e ON epoch_us(e.ts) BETWEEN epoch_us(p.ts) - {BAND * 1_000_000} AND epoch_us(p.ts) + {BAND * 1_000_000} GROUP BY p.event_id""")
def ext_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks of anyone within a band of time around each purchase: an equi-join on slots as wide as the band, of which a purchase meets three."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    wide = BAND * 1_000_000
    slot = F.floor(F.col("at") / wide)
    # counted by instant first, so that a busy one is a single row
    clicks = events.where("event_type = 'click'").groupBy(F.col("at").alias("click_at")).agg(F.count("*").alias("n")).withColumn("slot", F.floor(F.col("click_at") / wide))
    bought = events.where("event_type = 'purchase'").select("event_id", "at", F.explode(F.array(slot - 1, slot, slot + 1)).alias("slot"))
    near = F.when(F.abs(F.col("click_at") - F.col("at")) <= wide, F.col("n")).otherwise(0)
    return bought.join(clicks, "slot", "left").groupBy("event_id").agg(F.coalesce(F.sum(near), F.lit(0)).alias("n_near"))


@query("""SELECT c_custkey, CAST(floor(abs(c_acctbal)) AS BIGINT) AS whole, CAST(sign(c_acctbal) AS BIGINT) AS side, CAST(greatest(c_custkey % 7, c_nationkey) AS BIGINT) AS larger,
CAST(floor(sqrt(c_custkey)) AS BIGINT) AS root, CAST(c_custkey & 255 AS BIGINT) AS low_bits FROM customer""")
def ext_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance, key = F.col("c_acctbal"), F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.floor(F.abs(balance)).alias("whole"), F.signum(balance).cast("long").alias("side"), F.greatest(key % 7, F.col("c_nationkey")).cast("long").alias("larger"),
        F.floor(F.sqrt(key)).alias("root"), key.bitwiseAND(F.lit(255)).alias("low_bits"))


@query("""SELECT c_nationkey, count(*) FILTER (c_mktsegment = 'BUILDING') AS building, count(DISTINCT c_mktsegment) AS n_segments,
max(c_mktsegment) AS last_segment FROM customer GROUP BY c_nationkey""")
def ext_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by segment as a map of each nation; the segments are few and fixed."""
    counts = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    maps = counts.groupBy("c_nationkey").agg(F.map_from_entries(F.collect_list(F.struct("c_mktsegment", "n"))).alias("by_segment"))
    return maps.select("c_nationkey", F.coalesce(F.try_element_at("by_segment", F.lit("BUILDING")), F.lit(0)).alias("building"),
                       F.size("by_segment").cast("long").alias("n_segments"), F.array_max(F.map_keys("by_segment")).alias("last_segment"))


@query("""WITH spent AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY o_custkey)
SELECT c_custkey, CAST(total AS DOUBLE) AS total FROM customer JOIN spent ON c_custkey = o_custkey WHERE total > (SELECT avg(total) FROM spent)""")
def ext_sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the SQL surface: tables are arguments, not names of the session."""
    return spark.sql("""WITH spent AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM {orders} GROUP BY o_custkey)
        SELECT c_custkey, CAST(total AS DOUBLE) AS total FROM {customer} JOIN spent ON c_custkey = o_custkey WHERE total > (SELECT avg(total) FROM spent)""",
                     orders=table(spark, sf_dir, "orders"), customer=table(spark, sf_dir, "customer"))


HOUR = 3600


@query(f"""WITH w AS (SELECT event_type, epoch_us(ts) // {HOUR * 1_000_000} AS hour, count(*) AS n FROM events GROUP BY ALL)
SELECT event_type, CAST(hour AS BIGINT) AS hour, n FROM w WHERE (hour + 1) * {HOUR * 1_000_000} <= (SELECT max(epoch_us(ts)) FROM events) - {HOUR * 1_000_000}""")
def ext_stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by hour as a stream: a window is written once the watermark, an hour behind the latest event, has passed it."""
    return ingest.windowed_counts(spark, f"{sf_dir}/events.parquet", sink.shared_path(spark, "windows"), sink.shared_path(spark, "state"), "ts", "event_type", HOUR, HOUR).select(
        "event_type", F.floor(F.unix_seconds("began") / HOUR).alias("hour"), "n")


@query(f"""SELECT user_id, session, count(*) AS n_events, min(ts) AS began, max(ts) AS ended FROM (SELECT user_id, ts, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session FROM (
SELECT user_id, ts, event_id, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) <= {GAP * 1_000_000} THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY ALL""")
def ext_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = table(spark, sf_dir, "events").withColumn("micros", micros)
    fresh = F.when(F.col("micros") - F.lag("micros").over(w) <= GAP * 1_000_000, 0).otherwise(1)
    rows = rows.withColumn("fresh", fresh).withColumn("session", F.sum("fresh").over(w))
    return rows.groupBy("user_id", "session").agg(F.count("*").alias("n_events"), F.min("ts").alias("began"), F.max("ts").alias("ended"))


@query("""SELECT p.event_id, max_by(e.event_id, (e.ts, e.event_id)) AS signup_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p
LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') e ON p.user_id = e.user_id AND e.ts <= p.ts GROUP BY p.event_id""")
def ext_as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each purchase the user's latest signup so far: one sort by user and time, no join of all pairs."""
    rows = table(spark, sf_dir, "events").where("event_type in ('purchase', 'signup')")
    is_purchase = F.col("event_type") == "purchase"
    w = Window.partitionBy("user_id").orderBy("ts", is_purchase, "event_id").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("signup_id", F.last(F.when(~is_purchase, F.col("event_id")), ignorenulls=True).over(w))
    return found.where(is_purchase).select("event_id", "signup_id")


@query("""SELECT event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS k, count(*) AS n FROM events GROUP BY ALL""")
def ext_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.from_json("props", "k int")["k"] % 10
    return table(spark, sf_dir, "events").groupBy("event_type", k.alias("k")).agg(F.count("*").alias("n"))


@query("""SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n, count(*) FILTER (o_orderstatus = 'O') AS n_open FROM orders GROUP BY ALL""")
def ext_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").cast("long").alias("year"), F.month("o_orderdate").cast("long").alias("month")).agg(
        F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "O").alias("n_open"))
