"""Reading, roll-up and join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandloom.catalog.registry import query
from demandloom.catalog.tables import (
    HOLIDAY_NAME,
    PANEL,
    PROMOTIONS,
    SALES,
    SCORED,
    SCORED_ALL,
    TRAFFIC,
    panel,
    promotions,
    sales,
    scored,
    table,
    traffic,
)
from demandloom.operators import rollup
from demandloom.sources import audit, panel as files

PRODUCT_DAY = (
    "date:d store_id:s product_id:s category:s quantity_sold:4 sales:4 cost:4 profit:4"
    " discount_percent:6 unit_price:4"
)

ROLLUP = f"""{SALES},
daily AS (
  SELECT date, store_id, product_id, category, sum(quantity_sold) AS quantity_sold,
         sum(revenue) AS sales, sum(cost) AS cost, sum(profit) AS profit,
         avg(discount_percent) AS discount_percent, avg(unit_price) AS unit_price
  FROM sales GROUP BY ALL)"""

PROMO = f"""{PROMOTIONS},
promo AS (
  SELECT CAST(date AS DATE) AS date, product_id, max(discount_percent) AS max_discount,
         1 AS has_promotion
  FROM promotions GROUP BY 1, 2)"""

VISITS = f"""{TRAFFIC},
visit AS (
  SELECT date, store_id, sum(customer_traffic) AS customer_traffic, max(is_holiday) AS is_holiday
  FROM traffic GROUP BY 1, 2)"""


@query("daily_product_rollup", PRODUCT_DAY, f"{ROLLUP} => SELECT * FROM daily")
def daily_product_rollup(spark, folder):
    return rollup.daily_product_rollup(sales(spark, folder))


@query("promo_summary", "date:d product_id:s max_discount:4 has_promotion:i",
       f"{PROMO} => SELECT * FROM promo")
def promo_summary(spark, folder):
    return rollup.promo_summary(promotions(spark, folder))


@query("traffic_summary", "date:d store_id:s customer_traffic:i is_holiday:i",
       f"{VISITS} => SELECT * FROM visit")
def traffic_summary(spark, folder):
    return rollup.traffic_summary(traffic(spark, folder))


@query("daily_with_promotions", "date:d store_id:s product_id:s sales:4 has_promotion:i",
       f"""{ROLLUP}, {PROMO} =>
       SELECT d.*, coalesce(p.has_promotion, 0) AS has_promotion
       FROM daily d LEFT JOIN promo p USING (date, product_id)""")
def daily_with_promotions(spark, folder):
    summary = rollup.promo_summary(promotions(spark, folder))
    return rollup.with_promotions(rollup.daily_product_rollup(sales(spark, folder)), summary)


@query("store_day_panel",
       "date:d store_id:s sales:4 quantity_sold:4 profit:4 has_promotion:6 customer_traffic:0"
       " is_holiday:0",
       f"""{ROLLUP}, {PROMO}, {VISITS} =>
       SELECT date, store_id, sum(sales) AS sales, sum(quantity_sold) AS quantity_sold,
              sum(profit) AS profit, avg(coalesce(has_promotion, 0)) AS has_promotion,
              max(customer_traffic) AS customer_traffic, max(is_holiday) AS is_holiday
       FROM daily LEFT JOIN promo USING (date, product_id) LEFT JOIN visit USING (date, store_id)
       GROUP BY 1, 2""")
def store_day_panel(spark, folder):
    return rollup.training_panel(
        sales(spark, folder), promotions(spark, folder), traffic(spark, folder)
    )


@query("daily_series",
       "date:d sales:2 dayofweek:i month:i day:i weekofyear:i quarter:i is_weekend:i",
       f"""{PANEL} =>
       SELECT date, sum(sales) AS sales, isodow(date) - 1 AS dayofweek, month(date) AS month,
              day(date) AS day, week(date) AS weekofyear, quarter(date) AS quarter,
              CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend
       FROM panel GROUP BY date""")
def daily_series(spark, folder):
    return rollup.daily_series(panel(spark, folder))


@query("first_event_impact", "date:d store_id:s sales:2 impact:2",
       f"""{PANEL},
       event AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS store_id,
                        arg_min(o_custkey % 5, o_orderkey) / -10.0 AS impact
                 FROM orders GROUP BY 1, 2) =>
       SELECT p.date, p.store_id, p.sales, coalesce(impact, 0.0) AS impact
       FROM panel p LEFT JOIN event USING (date, store_id)""")
def first_event_impact(spark, folder):
    events = table(spark, folder, "orders").select(
        F.to_date("o_orderdate").alias("date"),
        F.col("o_orderpriority").alias("store_id"),
        "o_orderkey",
        (F.col("o_custkey") % 5 / -10.0).alias("impact"),
    )
    keys = ["date", "store_id"]
    return rollup.first_match(panel(spark, folder), events, keys, "o_orderkey", "impact", 0.0)


@query("product_attributes", "l_partkey:i n_lines:i p_retailprice:2 p_type:s",
       """lines AS (SELECT l_partkey, count(*) AS n_lines FROM lineitem GROUP BY 1) =>
       SELECT l_partkey, n_lines, p_retailprice, p_type
       FROM lines LEFT JOIN part ON l_partkey = p_partkey""")
def product_attributes(spark, folder):
    lines = table(spark, folder, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n_lines"))
    products = table(spark, folder, "part").withColumnRenamed("p_partkey", "l_partkey")
    priced = rollup.lookup_value(lines, products, ["l_partkey"], "p_retailprice")
    return rollup.lookup_value(priced, products, ["l_partkey"], "p_type")


@query("unsold_products", "p_partkey:i year:i",
       """years AS (SELECT unnest(range(min(year(l_shipdate)), max(year(l_shipdate)) + 1)) AS year FROM lineitem) =>
       SELECT p_partkey, y.year FROM part, years y
       WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND year(l_shipdate) = y.year)""")
def unsold_products(spark, folder):
    """Products without any line in a year, for every year of the table."""
    lines = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.year("l_shipdate").alias("year"))
    years = lines.agg(F.sequence(F.min("year"), F.max("year")).alias("years")).scalar()
    spine = table(spark, folder, "part").select("p_partkey", F.explode(years).alias("year"))
    return rollup.unmatched(spine, lines, ["p_partkey", "year"])


@query("known_store_rows", "date:d store_id:s sales:2",
       f"""{PANEL} => SELECT * FROM panel
       WHERE store_id IN (SELECT o_orderpriority FROM orders GROUP BY 1
                          HAVING sum(o_totalprice) > (SELECT sum(o_totalprice) / 5 FROM orders))""")
def known_store_rows(spark, folder):
    rows = panel(spark, folder)
    fifth = rows.agg((F.sum("sales") / 5).alias("x")).scalar()
    large = rows.groupBy("store_id").agg(F.sum("sales").alias("__s")).where(F.col("__s") > fifth)
    return rollup.known_only(rows, large, ["store_id"])


@query("prediction_residuals", "date:d store_id:s model:s residual:2",
       f"{SCORED} => SELECT date, store_id, model, actual - prediction AS residual FROM scored")
def prediction_residuals(spark, folder):
    keys = ["date", "store_id"]
    actuals = panel(spark, folder).select(*keys, F.col("sales").alias("actual"))
    return rollup.residuals(scored(spark, folder).drop("actual"), actuals, keys)


@query("aligned_predictions", "model:s n_rows:i n_missing:i",
       f"""{SCORED_ALL} =>
       SELECT model, count(*) AS n_rows,
              count(*) FILTER (WHERE prediction IS NULL) AS n_missing
       FROM scored GROUP BY model""")
def aligned_predictions(spark, folder):
    keys = ["date", "store_id"]
    actuals = panel(spark, folder).select(*keys, F.col("sales").alias("actual"))
    made = scored(spark, folder, complete=False).where("prediction IS NOT NULL").drop("actual")
    return rollup.aligned_scores(actuals, made, keys).groupBy("model").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("prediction").isNull()).alias("n_missing")
    )


@query("entity_spine_gaps", "store_id:s n_missing:i",
       f"""{PANEL}, ends AS (SELECT store_id, min(date) AS a, max(date) AS b FROM panel GROUP BY 1),
       spine AS (SELECT store_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date
                 FROM ends) =>
       SELECT store_id, count(*) AS n_missing
       FROM spine ANTI JOIN panel USING (store_id, date) GROUP BY 1""")
def entity_spine_gaps(spark, folder):
    rows = panel(spark, folder)
    spine = rollup.entity_spine(rows, ["store_id"])
    absent = rollup.unmatched(spine, rows, ["store_id", "date"])
    return absent.groupBy("store_id").agg(F.count("*").alias("n_missing"))


@query("combined_sources", "source:s n_rows:i amount:2 n_priority:i",
       """both_tables AS (
         SELECT 'orders' AS source, o_totalprice AS amount, o_orderpriority AS priority FROM orders
         UNION ALL SELECT 'lines', l_extendedprice, NULL FROM lineitem) =>
       SELECT source, count(*) AS n_rows, sum(amount) AS amount, count(priority) AS n_priority
       FROM both_tables GROUP BY source""")
def combined_sources(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.lit("orders").alias("source"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("priority"),
    )
    lines = table(spark, folder, "lineitem").select(
        F.lit("lines").alias("source"), F.col("l_extendedprice").alias("amount")
    )
    return files.combine([orders, lines]).groupBy("source").agg(
        F.count("*").alias("n_rows"),
        F.sum("amount").alias("amount"),
        F.count("priority").alias("n_priority"),
    )


@query("panel_read_filtered", "o_orderstatus:s n_orders:i total:2",
       """=> SELECT o_orderstatus, count(*) AS n_orders, sum(o_totalprice) AS total FROM orders
       WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_totalprice BETWEEN 1000 AND 400000
       GROUP BY 1""")
def panel_read_filtered(spark, folder):
    wanted = (F.col("o_orderdate") >= "1998-01-01") & F.col("o_totalprice").between(1000, 400000)
    rows = files.read_panel(spark, f"{folder}/orders.parquet", where=wanted)
    return rows.groupBy("o_orderstatus").agg(
        F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("total")
    )


@query("dataset_metadata",
       "n_rows:i start_date:d end_date:d n_stores:i n_products:i column_names:s",
       f"""{SALES} =>
       SELECT count(*) AS n_rows, min(date) AS start_date, max(date) AS end_date,
              count(DISTINCT store_id) AS n_stores, count(DISTINCT product_id) AS n_products,
              'date,store_id,product_id,category,quantity_sold,unit_price,discount_percent,'
              || 'revenue,cost,profit' AS column_names
       FROM sales""")
def dataset_metadata(spark, folder):
    one = files.dataset_metadata(
        sales(spark, folder), "date", n_stores="store_id", n_products="product_id"
    )
    return one.withColumn("column_names", F.array_join("columns", ","))


@query("missing_artifacts", "artifact:s",
       """found AS (SELECT p_name AS path FROM part) =>
       SELECT artifact FROM (VALUES ('part_1'), ('Brand'), ('a'), ('no such fragment')) e(artifact)
       WHERE NOT EXISTS (SELECT 1 FROM found WHERE contains(path, artifact))""")
def missing_artifacts(spark, folder):
    listing = table(spark, folder, "part").select(F.col("p_name").alias("path"))
    return audit.missing_artifacts(listing, ["part_1", "Brand", "a", "no such fragment"])


@query("file_audit", "total:i valid_count:i corrupted_count:i")
def file_audit(spark, folder):
    return audit.audit_counts(audit.audit_files(audit.list_files(spark, folder), deep=True))


@query("holiday_sales", "holiday_name:s n_orders:i total:2",
       f"""days AS (SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice FROM orders),
       named AS (SELECT *, {HOLIDAY_NAME} AS holiday_name FROM days) =>
       SELECT holiday_name, count(*) AS n_orders, sum(o_totalprice) AS total
       FROM named WHERE holiday_name IS NOT NULL GROUP BY 1""")
def holiday_sales(spark, folder):
    from demandloom.functions.calendar import holiday_name

    named = table(spark, folder, "orders").withColumn(
        "holiday_name", holiday_name(F.to_date("o_orderdate"))
    )
    return named.where("holiday_name IS NOT NULL").groupBy("holiday_name").agg(
        F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("total")
    )
