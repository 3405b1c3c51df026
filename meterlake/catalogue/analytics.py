"""Questions on the combined trips table and the joins they rest on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.catalogue import query
from meterlake.catalogue.sqltext import dollars, ratio, rdiv, sql
from meterlake.functions.exact import exact_sum, round_ratio
from meterlake.operators import joins, spatial
from meterlake.operators.distinct import distinct_counts
from meterlake.plans import analytics as A
from meterlake.sources import masters
from meterlake.sources import testtables as T

WEATHER_SQL = """w AS (SELECT DISTINCT CAST(ts AS DATE) AS date, (day(ts) * 7) % 11 AS tenths
  FROM events WHERE ts < '2024-01-30')"""


@query(
    "an_cab_type",
    sql(
        "trips",
        """SELECT CASE cab_type_id WHEN 1 THEN 'yellow' ELSE 'green' END AS cab_type, count(*) AS trip_count
        FROM trips GROUP BY 1""",
    ),
)
def an_cab_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.by_cab_type(T.trips(spark, sf_dir), masters.cab_types(spark))


@query(
    "an_payment_avg",
    sql(
        "trips",
        f"""SELECT CAST(payment_type AS BIGINT) AS payment_type, count(*) AS trips,
          {rdiv('sum(fare_c)', '100 * count(*)', 2)} AS avg_fare, {rdiv('sum(tip_c)', '100 * count(*)', 2)} AS avg_tip,
          round(avg(CAST(tip_c AS DOUBLE) / fare_c) * 100, 1) AS tip_pct
        FROM trips WHERE fare_c > 0 GROUP BY 1""",
    ),
)
def an_payment_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.by_payment(T.trips(spark, sf_dir))


@query(
    "an_neighbourhood",
    sql(
        "trips",
        """SELECT n_name AS neighborhood, count(*) AS pickups FROM trips JOIN nation ON pulocationid = n_nationkey
        GROUP BY 1 ORDER BY pickups DESC, neighborhood LIMIT 20""",
    ),
)
def an_neighbourhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.top_neighbourhoods(T.trips(spark, sf_dir), T.neighbourhoods(spark, sf_dir))


@query(
    "an_hour_weather",
    sql(
        "trips",
        f""", {WEATHER_SQL}
        SELECT CAST(hour(tpep_pickup_datetime) AS BIGINT) AS hour_of_day, count(*) AS trips,
          {ratio('sum(tenths)', '10 * count(tenths)')} AS avg_precip
        FROM trips LEFT JOIN w ON CAST(tpep_pickup_datetime AS DATE) = w.date GROUP BY 1""",
    ),
)
def an_hour_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.by_hour_with_weather(T.trips(spark, sf_dir), T.weather(spark, sf_dir))


@query(
    "jn_date_expr",
    sql(
        "trips",
        f""", {WEATHER_SQL}
        SELECT trip_id, CAST(CAST(tpep_pickup_datetime AS DATE) AS VARCHAR) AS trip_date,
          CAST(tenths AS DOUBLE) / 10 AS precipitation
        FROM trips LEFT JOIN w ON CAST(tpep_pickup_datetime AS DATE) = w.date""",
    ),
)
def jn_date_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = T.trips(spark, sf_dir).select("trip_id", F.to_date("tpep_pickup_datetime").alias("trip_date"))
    observed = T.weather(spark, sf_dir).select(F.col("date").alias("_date"), "precipitation")
    return joins.lookup_join(dated, observed, [("trip_date", "_date")]).drop("_date")


@query(
    "an_daily_trend",
    sql(
        "trips",
        """SELECT CAST(CAST(tpep_pickup_datetime AS DATE) AS VARCHAR) AS trip_date, count(*) AS daily_trips
        FROM trips WHERE tpep_pickup_datetime BETWEEN '2024-01-05' AND '2024-01-20 12:00:00' GROUP BY 1""",
    ),
)
def an_daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.daily_trend(T.trips(spark, sf_dir), "2024-01-05 00:00:00", "2024-01-20 12:00:00")


@query(
    "an_fare_year",
    f"""SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS trips,
         {ratio('sum(CAST(round(o_totalprice * 100) AS BIGINT))', '100 * count(*)')} AS avg_fare
       FROM orders GROUP BY 1""",
)
def an_fare_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stand in for trips here, because they span several years."""
    fares = T.table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("tpep_pickup_datetime"), F.col("o_totalprice").alias("fare_amount")
    )
    return A.fare_by_year(fares)


# --- joins ---------------------------------------------------------------------------------

LINE_VERSIONS = """
WITH v AS (SELECT s_suppkey, 1 AS version_number, s_name AS supplier_name, TIMESTAMP '1900-01-01' AS b,
    CASE WHEN s_suppkey % 10 = 0 THEN TIMESTAMP '1998-01-01' ELSE TIMESTAMP '9999-12-31 23:59:59' END AS e FROM supplier
  UNION ALL SELECT s_suppkey, 2, s_name || ' v2', TIMESTAMP '1998-01-01',
    CASE WHEN s_suppkey % 30 = 0 THEN TIMESTAMP '2000-01-01' ELSE TIMESTAMP '9999-12-31 23:59:59' END
    FROM supplier WHERE s_suppkey % 10 = 0
  UNION ALL SELECT s_suppkey, 3, s_name || ' v3', TIMESTAMP '2000-01-01', TIMESTAMP '9999-12-31 23:59:59'
    FROM supplier WHERE s_suppkey % 30 = 0)
SELECT l.l_suppkey, CAST(version_number AS BIGINT) AS version_number, supplier_name, count(*) AS n_lines,
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS revenue
FROM lineitem l LEFT JOIN v ON l.l_suppkey = v.s_suppkey AND l_shipdate >= b AND l_shipdate < e
GROUP BY 1, 2, 3"""


def _lines_by_version(spark: SparkSession, sf_dir: str, small: bool | None) -> DataFrame:
    lines = T.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice"
    )
    versions = T.versioned_suppliers(spark, sf_dir)
    joined = joins.asof_join(
        lines,
        versions,
        [("l_suppkey", "s_suppkey")],
        "l_shipdate",
        "effective_start_date",
        "effective_end_date",
        small,
    )
    return joined.groupBy("l_suppkey", "version_number", "supplier_name").agg(
        F.count(F.lit(1)).alias("n_lines"),
        (F.sum(F.floor(F.col("l_extendedprice") * 100 + 0.5)) / F.lit(100.0)).alias("revenue"),
    )


@query("jn_asof_interval", LINE_VERSIONS)
def jn_asof_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines_by_version(spark, sf_dir, None)


@query("jn_asof_interval_large", LINE_VERSIONS)
def jn_asof_interval_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions carried forward in time, as for a dimension too large to broadcast."""
    return _lines_by_version(spark, sf_dir, False)


@query(
    "jn_lookup_large",
    """SELECT o_orderpriority, n_name, count(*) AS n_orders FROM orders
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""",
)
def jn_lookup_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension treated as too large to broadcast: shuffled, with the facts salted."""
    orders = T.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = T.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = T.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = joins.lookup_join(orders, customer, [("o_custkey", "c_custkey")], "inner", small=False, salts=8)
    counted = joined.groupBy("o_orderpriority", "c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    named = joins.lookup_join(counted, nation, [("c_nationkey", "n_nationkey")], "inner")
    return named.groupBy("o_orderpriority", "n_name").agg(F.sum("n").alias("n_orders"))


@query(
    "jn_anti",
    """SELECT CAST(l_partkey AS BIGINT) AS l_partkey, count(*) AS n_lines FROM lineitem
       WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY 1""",
)
def jn_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose part is not among the listed ones, counted per part before the join."""
    counted = T.table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n_lines"))
    listed = T.table(spark, sf_dir, "part").filter("p_size > 10")
    return joins.unmatched(counted, listed, [("l_partkey", "p_partkey")])


@query(
    "jn_semi_in",
    """SELECT c_custkey, c_name FROM customer
       WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""",
)
def jn_semi_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = T.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    buyers = T.table(spark, sf_dir, "orders").filter("o_totalprice > 300000").select("o_custkey").distinct()
    return joins.lookup_join(customer, buyers, [("c_custkey", "o_custkey")], "left_semi")


@query(
    "jn_star",
    f"""SELECT r_name, p_type, CAST(year(l_shipdate) AS BIGINT) AS ship_year, count(*) AS n_lines,
         {dollars('sum(CAST(round(l_extendedprice * 100) AS BIGINT))')} AS revenue
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""",
)
def jn_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = T.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_shipdate", "l_extendedprice")
    place = (
        T.table(spark, sf_dir, "supplier")
        .join(T.table(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey"))
        .join(T.table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
        .select("s_suppkey", "r_name")
    )
    part = T.table(spark, sf_dir, "part").select("p_partkey", "p_type")
    joined = joins.lookup_join(lines, place, [("l_suppkey", "s_suppkey")], "inner")
    joined = joins.lookup_join(joined, part, [("l_partkey", "p_partkey")], "inner")
    return joined.groupBy("r_name", "p_type", F.year("l_shipdate").alias("ship_year")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        (F.sum(F.floor(F.col("l_extendedprice") * 100 + 0.5)) / F.lit(100.0)).alias("revenue"),
    )


@query(
    "jn_spatial",
    sql(
        "trips",
        """, p AS (SELECT trip_id, ((trip_id * 13) % 520) / 100.0 + 0.005 AS x,
             ((trip_id * 29) % 520) / 100.0 + 0.003 AS y FROM trips)
        SELECT trip_id, CASE WHEN x < 5 AND y < 5 THEN CAST(floor(x) + 5 * floor(y) AS BIGINT) END AS zone_id,
          CASE WHEN x < 5 AND y < 5 THEN CASE WHEN (x - floor(x)) > (y - floor(y)) THEN 'lower' ELSE 'upper' END END AS half
        FROM p""",
    ),
)
def jn_spatial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips located in triangular zones: each nation owns a unit square, cut in two."""
    points = T.trips(spark, sf_dir).selectExpr(
        "trip_id",
        "((trip_id * 13) % 520) / 100.0D + 0.005D AS x",
        "((trip_id * 29) % 520) / 100.0D + 0.003D AS y",
    )
    corner = T.table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS zone_id",
        "cast(n_nationkey % 5 AS double) AS a",
        "cast(n_nationkey div 5 AS double) AS b",
    )
    polygons = corner.selectExpr(
        "zone_id",
        "inline(array(struct('lower' AS half, array(struct(a AS x, b AS y), struct(a + 1 AS x, b AS y),"
        " struct(a + 1 AS x, b + 1 AS y)) AS ring),"
        " struct('upper' AS half, array(struct(a AS x, b AS y), struct(a + 1 AS x, b + 1 AS y),"
        " struct(a AS x, b + 1 AS y)) AS ring)))",
    )
    located = spatial.locate(points, polygons, cell=0.5)
    return located.select("trip_id", "zone_id", "half")


# --- single primitives -----------------------------------------------------------------------


@query(
    "so_topk",
    f"""SELECT o_custkey, {dollars('sum(CAST(round(o_totalprice * 100) AS BIGINT))')} AS spent FROM orders GROUP BY 1
       ORDER BY spent DESC, o_custkey LIMIT 20""",
)
def so_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty customers that spent most: each task keeps twenty candidates."""
    orders = T.table(spark, sf_dir, "orders")
    spent = orders.groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("spent"))
    return spent.orderBy(F.desc("spent"), "o_custkey").limit(20)


@query(
    "ag_list",
    """SELECT o_custkey, o_orderkey // 2000 AS block, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS order_ids
       FROM orders GROUP BY 1, 2""",
)
def ag_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order ids per customer in blocks of 2,000 consecutive ids, so a customer with any
    number of orders gives bounded texts."""
    ids = T.table(spark, sf_dir, "orders").selectExpr("o_custkey", "o_orderkey", "o_orderkey div 2000 AS block")
    listed = F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda v: v.cast("string"))
    return ids.groupBy("o_custkey", "block").agg(F.array_join(listed, ",").alias("order_ids"))


@query(
    "ag_distinct",
    """SELECT l_returnflag, count(*) AS n_lines, count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT l_suppkey) AS n_suppliers
       FROM lineitem GROUP BY 1""",
)
def ag_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct counts per flag. Three flags hold all rows; keys are counted as bitmaps where they lie close together."""
    lines = T.table(spark, sf_dir, "lineitem")
    counted = distinct_counts(lines, ["l_orderkey", "l_suppkey"], ["l_returnflag"])
    return counted.withColumnsRenamed({"n": "n_lines", "n_l_orderkey": "n_orders", "n_l_suppkey": "n_suppliers"})


@query(
    "ag_cond",
    """SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished,
         count(*) FILTER (WHERE o_totalprice > 200000) AS large,
         CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') = 0 THEN NULL
              ELSE CAST((2 * 10000 * count(*) FILTER (WHERE o_orderstatus = 'F') + count(*)) // (2 * count(*)) AS DOUBLE) / 100 END AS finished_pct
       FROM orders GROUP BY 1""",
)
def ag_cond(spark: SparkSession, sf_dir: str) -> DataFrame:
    finished, n = F.count_if(F.col("o_orderstatus") == "F"), F.count(F.lit(1))
    return T.table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        finished.alias("finished"),
        F.count_if(F.col("o_totalprice") > 200000).alias("large"),
        round_ratio(finished * 100, n, 2).alias("finished_pct"),
    )


@query(
    "st_union",
    """SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal < 0 UNION SELECT s_nationkey FROM supplier""".replace(
        "c_nationkey AS nationkey", "CAST(c_nationkey AS BIGINT) AS nationkey"
    ),
)
def st_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = T.table(spark, sf_dir, "customer").filter("c_acctbal < 0").selectExpr("c_nationkey AS nationkey")
    suppliers = T.table(spark, sf_dir, "supplier").selectExpr("s_nationkey AS nationkey")
    return customers.union(suppliers).distinct()


@query(
    "wn_prev_version",
    f"""WITH v AS ({LINE_VERSIONS.split('WITH v AS (')[1].split('SELECT l.l_suppkey')[0].rstrip()[:-1]})
      SELECT s_suppkey, CAST(version_number AS BIGINT) AS version_number, supplier_name,
        lag(supplier_name) OVER (PARTITION BY s_suppkey ORDER BY version_number) AS previous_name FROM v""",
)
def wn_prev_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each version beside the one before, by a join on (key, version): no key is sorted whole."""
    versions = T.versioned_suppliers(spark, sf_dir).select("s_suppkey", "version_number", "supplier_name")
    before = versions.select(
        F.col("s_suppkey").alias("_key"),
        (F.col("version_number") + 1).alias("_next"),
        F.col("supplier_name").alias("previous_name"),
    )
    return joins.lookup_join(versions, before, [("s_suppkey", "_key"), ("version_number", "_next")]).drop("_key", "_next")


@query(
    "ag_reagg",
    f"""WITH d AS (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS c
        FROM orders GROUP BY 1, 2)
      SELECT CAST(y AS BIGINT) AS year, CAST(sum(n) AS BIGINT) AS n_orders, {ratio('sum(c)', '100 * sum(n)')} AS weighted_avg,
        round(avg(CAST(c AS DOUBLE) / (100 * n)), 6) AS avg_of_avgs FROM d GROUP BY 1""",
)
def ag_reagg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary summed up again: the mean weighted by rows beside the mean of means."""
    per_customer = (
        T.table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor(F.col("o_totalprice") * 100 + 0.5)).alias("c"))
    )
    return per_customer.groupBy("year").agg(
        F.sum("n").alias("n_orders"),
        (F.sum("c") / (F.sum("n") * F.lit(100.0))).alias("weighted_avg"),
        F.round(F.avg(F.col("c") / (F.col("n") * F.lit(100.0))), 6).alias("avg_of_avgs"),
    )
