"""Validation, profile, drift and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandloom.catalog.registry import query
from demandloom.catalog.tables import CUBE, PANEL, SALES, contacts, daily, panel, sales, table
from demandloom.config import CvConfig, SplitConfig, TableContract
from demandloom.operators import metrics, prep, quantiles, rollup, scoring, split, staffing, validate
from demandloom.plans.tables import new_folder
from demandloom.sources import panel as files

MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _long(columns, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM {source}" for c in columns
    )


ORDER_COLUMNS = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
)
ORDER_NUMBERS = ("o_orderkey", "o_custkey", "o_totalprice")

OUTLIERS_SQL = """
fences AS (SELECT col, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3
           FROM long GROUP BY col),
bounds AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound
           FROM fences),
outliers AS (
  SELECT col, q1, q3, lower_bound, upper_bound,
         count(*) FILTER (WHERE v < lower_bound OR v > upper_bound) AS n_outliers,
         count(*) AS n, min(v) FILTER (WHERE v < lower_bound OR v > upper_bound) AS min_outlier,
         max(v) FILTER (WHERE v < lower_bound OR v > upper_bound) AS max_outlier
  FROM long JOIN bounds USING (col) GROUP BY ALL)"""


@query("column_profile",
       "column:s n_rows:i null_count:i null_percentage:4 unique_values:i mean:2 std:2 min:2 max:2"
       " outliers:0",
       f"""long AS ({_long(ORDER_NUMBERS, "orders")}), {OUTLIERS_SQL},
       counts AS ({" UNION ALL ".join(
           f"SELECT '{c}' AS col, count(*) AS n_rows, count(*) - count({c}) AS null_count,"
           f" count(DISTINCT {c}) AS unique_values FROM orders" for c in ORDER_COLUMNS)}),
       moments AS (SELECT col, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min, max(v) AS max
                   FROM long GROUP BY col) =>
       SELECT col AS "column", n_rows, null_count, null_count / n_rows * 100 AS null_percentage,
              unique_values, mean, std, min, max, n_outliers AS outliers
       FROM counts LEFT JOIN moments USING (col) LEFT JOIN outliers USING (col)""")
def column_profile(spark, folder):
    return validate.column_profile(table(spark, folder, "orders").select(*ORDER_COLUMNS))


@query("duplicate_rows", "n_rows:i duplicate_rows:i",
       """different AS (SELECT DISTINCT * FROM lineitem) =>
       SELECT n_rows, n_rows - (SELECT count(*) FROM different) AS duplicate_rows
       FROM (SELECT count(*) AS n_rows FROM lineitem)""")
def duplicate_rows(spark, folder):
    return validate.duplicate_rows(table(spark, folder, "lineitem"))


@query("iqr_outliers",
       "column:s q1:6 q3:6 lower_bound:6 upper_bound:6 n_outliers:i pct_outliers:4 min_outlier:4"
       " max_outlier:4",
       f"""long AS ({_long(MEASURES, "lineitem")} UNION ALL {_long(["c_acctbal"], "customer")}),
       {OUTLIERS_SQL} =>
       SELECT col AS "column", q1, q3, lower_bound, upper_bound, n_outliers,
              n_outliers / n * 100 AS pct_outliers, min_outlier, max_outlier FROM outliers""")
def iqr_outliers(spark, folder):
    lines = validate.iqr_outliers(table(spark, folder, "lineitem"), MEASURES)
    return lines.unionByName(validate.iqr_outliers(table(spark, folder, "customer"), ["c_acctbal"]))


@query("exact_quantiles", "store_id:s share:2 quantile:4",
       f"""{PANEL}, shares AS (SELECT unnest([0.1, 0.5, 0.9]) AS share) =>
       SELECT store_id, share, CASE share WHEN 0.1 THEN a WHEN 0.5 THEN b ELSE c END AS quantile
       FROM (SELECT store_id, quantile_cont(sales, 0.1) AS a, quantile_cont(sales, 0.5) AS b,
                    quantile_cont(sales, 0.9) AS c FROM panel GROUP BY 1), shares""")
def exact_quantiles(spark, folder):
    return quantiles.exact_quantiles(panel(spark, folder), "sales", (0.1, 0.5, 0.9), ["store_id"])


@query("zscore_outliers", "column:s n_outliers:i",
       f"""long AS ({_long(MEASURES, "lineitem")}),
       stats AS (SELECT col, avg(v) AS m, stddev_samp(v) AS s FROM long GROUP BY col) =>
       SELECT col AS "column", count(*) FILTER (WHERE abs((v - m) / s) > 1.5) AS n_outliers
       FROM long JOIN stats USING (col) GROUP BY col""")
def zscore_outliers(spark, folder):
    return validate.zscore_outliers(table(spark, folder, "lineitem"), MEASURES, limit=1.5)


ORDER_CONTRACT = TableContract(
    required=("o_orderkey", "o_totalprice", "o_channel"),
    types={"o_orderpriority": "double", "o_totalprice": "double", "o_orderdate": "date"},
    ranges={"o_totalprice": (1000.0, 400000.0), "o_custkey": (0.0, None)},
)


@query("schema_violations", "column:s rule:s violations:i",
       """=> SELECT 'o_channel' AS "column", 'required' AS rule, 1 AS violations
       UNION ALL SELECT 'o_orderpriority', 'type', count(*) FROM orders
       WHERE o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS DOUBLE) IS NULL""")
def schema_violations(spark, folder):
    return validate.schema_violations(table(spark, folder, "orders"), ORDER_CONTRACT)


@query("range_violations", "column:s rule:s bound:2 extreme:2 violations:i",
       """=> SELECT 'o_totalprice' AS "column", 'minimum' AS rule, 1000.0 AS bound,
              min(o_totalprice) AS extreme, count(*) FILTER (WHERE o_totalprice < 1000) AS violations
       FROM orders HAVING violations > 0
       UNION ALL SELECT 'o_totalprice', 'maximum', 400000.0, max(o_totalprice),
              count(*) FILTER (WHERE o_totalprice > 400000) AS violations
       FROM orders HAVING violations > 0""")
def range_violations(spark, folder):
    return validate.range_violations(table(spark, folder, "orders"), ORDER_CONTRACT)


@query("coerced_columns", "event_id:i user_code:0 kind_code:0",
       """=> SELECT event_id, TRY_CAST(right(CAST(user_id AS VARCHAR), 2) AS DOUBLE) AS user_code,
                    TRY_CAST(event_type AS DOUBLE) AS kind_code FROM events""")
def coerced_columns(spark, folder):
    raw = table(spark, folder, "events").select(
        "event_id",
        F.right(F.col("user_id").cast("string"), F.lit(2)).alias("user_code"),
        F.col("event_type").alias("kind_code"),
    )
    contract = TableContract(required=(), types={"user_code": "double", "kind_code": "double"}, ranges={})
    return validate.conform(raw, contract)


@query("sales_file_checks",
       "source:s n_rows:i negative_quantity_sold:i negative_revenue:i missing_columns:s",
       f"""{SALES} =>
       SELECT 'year=' || year(date) || '/week=' || week(date) AS source, count(*) AS n_rows,
              count(*) FILTER (WHERE quantity_sold < 0) AS negative_quantity_sold,
              count(*) FILTER (WHERE revenue < 0) AS negative_revenue, '' AS missing_columns
       FROM sales GROUP BY 1
       UNION ALL SELECT 'year=1900/week=1', 0, 0, 0, ''""")
def sales_file_checks(spark, folder):
    """The sales as files of weeks, with one more file that is empty: a row for every file's place."""
    place = new_folder(spark, "sales-files")
    rows = sales(spark, folder)
    files.write_partitioned(rows, place, layout="week")
    rows.limit(0).coalesce(1).write.parquet(f"{place}/year=1900/week=1")
    read = files.read_panel(spark, place)
    checks = validate.file_checks(read, listing=spark.read.format("binaryFile").load(f"{place}/*/*/*.parquet"))
    week = F.regexp_extract("source", "(year=[0-9]+/week=[0-9]+)/", 1)
    sums = [F.sum(c).alias(c) for c in ("n_rows", "negative_quantity_sold", "negative_revenue")]
    return checks.groupBy(week.alias("source")).agg(*sums, F.max("missing_columns").alias("missing_columns"))


@query("written_panel", "date:d store_id:s sales:2", f"{PANEL} => SELECT date, store_id, sales FROM panel")
def written_panel(spark, folder):
    """The panel written in directories of weeks and read back through the partition columns."""
    place = new_folder(spark, "panel-weeks")
    files.write_partitioned(panel(spark, folder), place, layout="week")
    return files.read_panel(spark, place, where="year >= 0")


@query("written_csv", "date:d sales:2", f"{PANEL} => SELECT date, round(sum(sales), 2) AS sales FROM panel GROUP BY 1")
def written_csv(spark, folder):
    """The daily series written as CSV and read back as a forecast history."""
    place = new_folder(spark, "history-csv")
    files.write_csv(daily(spark, folder).withColumn("sales", F.round("sales", 2)), place)
    return files.read_history_csv(spark, place)


@query("date_range", "first_date:d last_date:d days:i",
       f"""{PANEL} => SELECT min(date) AS first_date, max(date) AS last_date,
       max(date) - min(date) AS days FROM panel""")
def date_range(spark, folder):
    return validate.date_range(panel(spark, folder)).withColumnsRenamed(
        {"start": "first_date", "end": "last_date"}
    )


@query("date_gaps", "store_id:s gap_start:d gap_end:d gap_days:i",
       f"""{PANEL}, steps AS (SELECT store_id, date, lag(date) OVER (PARTITION BY store_id
                              ORDER BY date) AS before FROM panel) =>
       SELECT store_id, before AS gap_start, date AS gap_end, date - before AS gap_days
       FROM steps WHERE date - before > 1""")
def date_gaps(spark, folder):
    return validate.date_gaps(panel(spark, folder), ["store_id"])


@query("gap_summary", "store_id:s gap_count:i max_gap_days:i",
       f"""{SALES}, days AS (SELECT DISTINCT store_id, date FROM sales),
       steps AS (SELECT store_id, date - lag(date) OVER (PARTITION BY store_id ORDER BY date) AS gap
                 FROM days) =>
       SELECT store_id, count(*) AS gap_count, max(gap) AS max_gap_days
       FROM steps WHERE gap > 1 GROUP BY 1""")
def gap_summary(spark, folder):
    return validate.gap_summary(sales(spark, folder), ["store_id"])


@query("calendar_missing", "store_id:s date:d",
       """days AS (SELECT DISTINCT o_orderpriority AS store_id, CAST(o_orderdate AS DATE) AS date
                   FROM orders),
       spine AS (SELECT store_id,
                        CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
                 FROM days GROUP BY store_id) =>
       SELECT store_id, date FROM spine ANTI JOIN days USING (store_id, date)""")
def calendar_missing(spark, folder):
    return validate.calendar_gaps(panel(spark, folder), keys=["store_id"])


@query("hourly_missing", "channel:s timestamp:t",
       """hours AS (SELECT DISTINCT event_type AS channel, date_trunc('hour', ts) AS timestamp FROM events),
       spine AS (SELECT channel,
                        unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 1 HOUR)) AS timestamp
                 FROM hours GROUP BY channel) =>
       SELECT channel, timestamp FROM spine ANTI JOIN hours USING (channel, timestamp)""")
def hourly_missing(spark, folder):
    cube = staffing.demand_cube(contacts(spark, folder))
    return validate.calendar_gaps(cube, "timestamp", "1 hour", ["channel"])


@query("duplicate_times", "duplicate_timestamps:i",
       """cells AS (SELECT o_orderdate, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2) =>
       SELECT sum(n - 1) AS duplicate_timestamps FROM cells""")
def duplicate_times(spark, folder):
    return validate.duplicate_times(
        table(spark, folder, "orders"), "o_orderdate", ["o_orderpriority"]
    )


@query("interval_length", "channel:s interval_seconds:i",
       f"""{CUBE}, steps AS (
         SELECT channel, epoch(timestamp)
                - epoch(lag(timestamp) OVER (PARTITION BY channel ORDER BY timestamp)) AS delta
         FROM cube) =>
       SELECT channel, CAST(floor(median(delta)) AS BIGINT) AS interval_seconds
       FROM steps GROUP BY channel""")
def interval_length(spark, folder):
    cube = staffing.demand_cube(contacts(spark, folder))
    return validate.interval_seconds(cube, keys=["channel"])


EARLY = "date < DATE '1998-01-01'"


@query("drift_mean_shift",
       "column:s train_mean:2 train_std:2 new_mean:2 drifted:i",
       f"""{PANEL}, long AS (SELECT 'sales' AS col, sales AS v, date FROM panel
         UNION ALL SELECT 'quantity_sold', quantity_sold, date FROM panel),
       old AS (SELECT col, avg(v) AS train_mean, stddev_samp(v) AS train_std FROM long
               WHERE {EARLY} GROUP BY 1),
       new AS (SELECT col, avg(v) AS new_mean FROM long WHERE NOT ({EARLY}) GROUP BY 1) =>
       SELECT col AS "column", train_mean, train_std, new_mean,
              CAST(abs(new_mean - train_mean) > 3 * train_std AS INTEGER) AS drifted
       FROM old JOIN new USING (col)""")
def drift_mean_shift(spark, folder):
    rows = panel(spark, folder)
    return validate.mean_drift(
        rows.where(EARLY), rows.where(f"NOT ({EARLY})"), ["sales", "quantity_sold"]
    )


KS_GAPS = f"""lines AS (SELECT CAST(l_shipdate AS DATE) AS date, * FROM lineitem),
       long AS ({" UNION ALL ".join(
           f"SELECT '{c}' AS col, {c} AS v, {EARLY} AS early FROM lines" for c in MEASURES)}),
       counts AS (SELECT col, v, count(*) FILTER (WHERE early) AS a,
                         count(*) FILTER (WHERE NOT early) AS b FROM long GROUP BY 1, 2),
       running AS (SELECT col, sum(a) OVER w / sum(a) OVER (PARTITION BY col) AS fa,
                          sum(b) OVER w / sum(b) OVER (PARTITION BY col) AS fb
                   FROM counts WINDOW w AS (PARTITION BY col ORDER BY v)),
       gaps AS (SELECT col, max(abs(fa - fb)) AS ks FROM running GROUP BY 1)"""


@query("drift_ks", "column:s ks:6 drifted:i",
       f"""{KS_GAPS} => SELECT col AS "column", ks, CAST(ks > 0.1 AS INTEGER) AS drifted FROM gaps""")
def drift_ks(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("date", F.to_date("l_shipdate"))
    ks = quantiles.two_sample_ks(lines.where(EARLY), lines.where(f"NOT ({EARLY})"), MEASURES)
    return validate.drift_alerts(ks)


@query("drift_binned", "column:s drifted:i within:i",
       f"""{KS_GAPS} => SELECT col AS "column", CAST(ks > 0.1 AS INTEGER) AS drifted, 1 AS within FROM gaps""")
def drift_binned(spark, folder):
    """Drift against stored bins; ``within`` says that the whole statistic lies between the bounds."""
    lines = table(spark, folder, "lineitem").withColumn("date", F.to_date("l_shipdate"))
    early, late = lines.where(EARLY), lines.where(f"NOT ({EARLY})")
    found = quantiles.binned_drift(quantiles.reference_bins(early, MEASURES), late, 0.1, early)
    whole = quantiles.two_sample_ks(early, late, MEASURES)
    within = F.col("ks").between(F.col("ks_low") - 1e-9, F.col("ks_high") + 1e-9).cast("int")
    return found.join(whole, "column").select("column", "drifted", within.alias("within"))


NUMBERED = f"""{PANEL},
numbered AS (SELECT *, row_number() OVER (ORDER BY date, store_id) - 1 AS position,
                    count(*) OVER () AS n FROM panel),
parts AS (
  SELECT *, CASE WHEN position < floor(n * (1 - 0.2::DOUBLE - 0.1::DOUBLE)) THEN 'train'
                 WHEN position < floor(n * (1 - 0.2::DOUBLE - 0.1::DOUBLE)) + floor(n * 0.1::DOUBLE)
                 THEN 'val' ELSE 'test' END AS split
  FROM numbered)"""


def parts(spark, folder):
    return split.chronological_split(panel(spark, folder))


@query("chronological_split", "date:d store_id:s split:s",
       f"{NUMBERED} => SELECT date, store_id, split FROM parts")
def chronological_split(spark, folder):
    return parts(spark, folder)


@query("split_by_date", "split:s start:d n_rows:i",
       f"""{NUMBERED}, firsts AS (SELECT *, min(position) OVER (PARTITION BY date) AS head FROM parts),
       cut AS (SELECT date, CASE WHEN head < floor(n * 0.7::DOUBLE) THEN 'train'
                 WHEN head < floor(n * 0.7::DOUBLE) + floor(n * 0.2::DOUBLE) THEN 'val'
                 ELSE 'test' END AS split FROM firsts) =>
       SELECT split, min(date) AS start, count(*) AS n_rows FROM cut GROUP BY split""")
def split_by_date(spark, folder):
    config = SplitConfig(test_size=0.1, validation_size=0.2)
    cut = split.chronological_split(panel(spark, folder), config=config, by="date")
    return cut.groupBy("split").agg(F.min("date").alias("start"), F.count("*").alias("n_rows"))


@query("panel_positions", "date:d store_id:s position:i",
       f"{NUMBERED} => SELECT date, store_id, position FROM numbered")
def panel_positions(spark, folder):
    return split.panel_positions(panel(spark, folder))


@query("early_stopping_slice", "date:d store_id:s is_validation:s",
       f"""{NUMBERED} => SELECT date, store_id,
       CASE WHEN position >= n - greatest(1, floor(n * 0.1::DOUBLE)) THEN 'true' ELSE 'false' END
         AS is_validation FROM numbered""")
def early_stopping_slice(spark, folder):
    return split.early_stopping_slice(panel(spark, folder))


@query("rolling_origin_folds",
       "store_id:s fold_id:i train_end:i test_start:i test_end:i horizon:i train_size:i",
       f"""{PANEL}, sizes AS (SELECT store_id, count(*) AS n FROM panel GROUP BY 1),
       origins AS (SELECT store_id, n, unnest(range(0, 5)) AS i FROM sizes),
       placed AS (SELECT store_id, n, i, n - 30 - (4 - i) * 30 AS origin FROM origins),
       kept AS (SELECT * FROM placed
                WHERE origin >= greatest(60, n - 150, CAST(floor(n * 0.4::DOUBLE) AS BIGINT))) =>
       SELECT store_id, row_number() OVER (PARTITION BY store_id ORDER BY i) - 1 AS fold_id,
              origin AS train_end, origin AS test_start, origin + 30 AS test_end, 30 AS horizon,
              origin AS train_size FROM kept""")
def rolling_origin_folds(spark, folder):
    sizes = split.fold_sizes(panel(spark, folder), ["store_id"])
    return split.rolling_origin_folds(sizes, CvConfig())


@query("scaler_state", "column:s mean:4 scale:4",
       f"""{NUMBERED}, train AS (SELECT * FROM parts WHERE split = 'train') =>
       SELECT 'sales' AS "column", avg(sales) AS mean, stddev_pop(sales) AS scale FROM train
       UNION ALL SELECT 'quantity_sold', avg(quantity_sold), stddev_pop(quantity_sold) FROM train""")
def scaler_state(spark, folder):
    train = parts(spark, folder).where("split = 'train'")
    return prep.scaler_state(train, ["sales", "quantity_sold"])


@query("label_encoding", "o_orderkey:i o_orderpriority:i",
       """codes AS (SELECT o_orderpriority, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS code
                    FROM (SELECT DISTINCT o_orderpriority FROM orders
                          WHERE o_orderpriority <> '3-MEDIUM')) =>
       SELECT o_orderkey, coalesce(code, 0) AS o_orderpriority
       FROM orders LEFT JOIN codes USING (o_orderpriority)""")
def label_encoding(spark, folder):
    orders = table(spark, folder, "orders")
    codes = prep.label_codes(orders.where("o_orderpriority <> '3-MEDIUM'"), "o_orderpriority")
    return prep.encode_labels(orders, codes, "o_orderpriority", unseen="zero")


@query("feature_matrix", "date:d split:s store_id:6 quantity_sold:6",
       f"""{NUMBERED}, train AS (SELECT * FROM parts WHERE split = 'train'),
       codes AS (SELECT store_id, dense_rank() OVER (ORDER BY store_id) - 1 AS code
                 FROM (SELECT DISTINCT store_id FROM train)),
       stats AS (SELECT avg(code) AS mc, stddev_pop(code) AS sc, avg(quantity_sold) AS mq,
                        stddev_pop(quantity_sold) AS sq FROM train JOIN codes USING (store_id)) =>
       SELECT date, split, (code - mc) / sc AS store_id, (quantity_sold - mq) / sq AS quantity_sold
       FROM parts JOIN codes USING (store_id), stats""")
def feature_matrix(spark, folder):
    return prep.feature_matrix(parts(spark, folder), ["quantity_sold"], ["store_id"])


@query("split_shift", "split:s mean:2 std:2 n:i mean_shift:6 shifted:i",
       f"""{NUMBERED}, stats AS (SELECT split, avg(sales) AS mean, stddev_samp(sales) AS std,
                                        count(sales) AS n FROM parts GROUP BY 1),
       base AS (SELECT mean AS m FROM stats WHERE split = 'train') =>
       SELECT split, mean, std, n, abs(mean - m) / m AS mean_shift,
              CAST(abs(mean - m) / m > 0.2 AS INTEGER) AS shifted FROM stats, base""")
def split_shift(spark, folder):
    return metrics.split_shift(parts(spark, folder))


@query("leakage_correlation", "feature:s correlation:6 leaks:i",
       f"""{PANEL}, f AS (SELECT sales, quantity_sold, month(date) AS month, sales * 2 + 1 AS doubled,
                                 lag(sales) OVER (PARTITION BY store_id ORDER BY date) AS sales_lag_1
                          FROM panel),
       r AS (SELECT 'quantity_sold' AS feature, corr(quantity_sold, sales) AS correlation FROM f
             UNION ALL SELECT 'month', corr(month, sales) FROM f
             UNION ALL SELECT 'doubled', corr(doubled, sales) FROM f
             UNION ALL SELECT 'sales_lag_1', corr(sales_lag_1, sales) FROM f) =>
       SELECT *, CAST(abs(correlation) > 0.95 AS INTEGER) AS leaks FROM r""")
def leakage_correlation(spark, folder):
    from demandloom.operators.features import lag_features

    rows = lag_features(panel(spark, folder), lags=(1,)).withColumns(
        {"month": F.month("date"), "doubled": F.col("sales") * 2 + 1}
    )
    return metrics.leakage(rows, ["quantity_sold", "month", "doubled", "sales_lag_1"])


@query("regressor_choice", "column:s variance:2",
       f"""=> SELECT col AS "column", var_samp(v) AS variance
       FROM ({_long(MEASURES, "lineitem")}) GROUP BY col HAVING var_samp(v) > 0
       ORDER BY variance DESC LIMIT 3""")
def regressor_choice(spark, folder):
    return metrics.regressor_choice(table(spark, folder, "lineitem"), MEASURES, top=3)


DENSE = NUMBERED.replace(PANEL, f"""{PANEL},
ends AS (SELECT store_id, min(date) AS a, max(date) AS b FROM panel GROUP BY 1),
spine AS (SELECT store_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM ends),
dense AS (SELECT s.date, s.store_id, coalesce(sales, 0) AS sales, coalesce(quantity_sold, 0) AS quantity_sold
          FROM spine s LEFT JOIN panel USING (store_id, date))""").replace("AS n FROM panel)", "AS n FROM dense)")


@query("recommendations", "topic:s value:6",
       f"""{DENSE}, stats AS (SELECT split, avg(sales) AS mean FROM parts GROUP BY 1),
       base AS (SELECT mean AS m FROM stats WHERE split = 'train'),
       train AS (SELECT count(*) AS n, count(*) FILTER (WHERE sales = 0) AS zeros,
                        CAST(abs(corr(quantity_sold, sales)) > 0.95 AS INTEGER) + 1 AS leaks
                 FROM parts WHERE split = 'train') =>
       SELECT 'small_training_set' AS topic, n AS value FROM train WHERE n < 1000
       UNION ALL SELECT 'many_zero_targets', zeros FROM train WHERE zeros > n * 0.1
       UNION ALL SELECT 'possible_leakage', leaks FROM train WHERE leaks > 0
       UNION ALL SELECT 'distribution_shift_' || split, abs(mean - m) / m FROM stats, base
       WHERE split <> 'train' AND abs(mean - m) / m > 0.2""")
def recommendations(spark, folder):
    """Days without orders count as days without sales; the net value leaks the target."""
    rows = panel(spark, folder)
    spine = rollup.entity_spine(rows, ["store_id"])
    dense = spine.join(rows, ["store_id", "date"], "left").na.fill(0, ["sales", "quantity_sold"])
    tagged = split.chronological_split(dense).withColumn("net_sales", F.col("sales") * 0.9)
    return metrics.recommendations(tagged, ["quantity_sold", "net_sales"])


@query("sampled_rows", "o_orderkey:i o_totalprice:2")
def sampled_rows(spark, folder):
    orders = table(spark, folder, "orders")
    return scoring.deterministic_sample(orders, 1000, ["o_orderkey"])


def _measures(section: str, subject: str, source: str, names) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {subject} AS subject, '{n}' AS measure,"
        f" CAST({n} AS DOUBLE) AS value FROM {source}"
        for n in names
    )


@query("validation_report", "section:s subject:s measure:s value:3",
       f"""{PANEL}, long AS ({_long(["sales", "quantity_sold"], "panel")}), {OUTLIERS_SQL},
       counts AS ({" UNION ALL ".join(
           f"SELECT '{c}' AS col, count(*) - count({c}) AS null_count,"
           f" count(DISTINCT {c}) AS unique_values FROM panel"
           for c in ("date", "store_id", "sales", "quantity_sold"))}),
       moments AS (SELECT col, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min, max(v) AS max
                   FROM long GROUP BY col),
       profile AS (SELECT *, n_outliers AS outliers FROM counts LEFT JOIN moments USING (col)
                   LEFT JOIN outliers USING (col)),
       high AS (SELECT count(*) FILTER (WHERE sales > 1000000) AS violations, max(sales) AS extreme
                FROM panel HAVING violations > 0),
       copies AS (SELECT sum(n) AS n_rows, sum(n - 1) AS duplicate_rows
                  FROM (SELECT count(*) AS n FROM panel
                        GROUP BY date, store_id, sales, quantity_sold)),
       span AS (SELECT max(date) - min(date) AS days FROM panel),
       steps AS (SELECT store_id, date - lag(date) OVER (PARTITION BY store_id ORDER BY date) AS gap
                 FROM panel),
       gaps AS (SELECT store_id, count(*) AS gap_count, max(gap) AS max_gap_days FROM steps
                WHERE gap > 1 GROUP BY 1),
       report AS (
         {_measures("profile", "col", "profile",
                    ("null_count", "unique_values", "mean", "std", "min", "max", "outliers"))}
         UNION ALL {_measures("range", "'sales:maximum'", "high", ("violations", "extreme"))}
         UNION ALL {_measures("duplicates", "'table'", "copies", ("n_rows", "duplicate_rows"))}
         UNION ALL {_measures("dates", "'date'", "span", ("days",))}
         UNION ALL {_measures("gaps", "store_id", "gaps", ("gap_count", "max_gap_days"))}) =>
       SELECT * FROM report WHERE value IS NOT NULL""")
def validation_report(spark, folder):
    contract = TableContract(required=("date", "store_id"), types={"sales": "double"},
                             ranges={"sales": (0.0, 1_000_000.0)})
    return validate.validation_report(panel(spark, folder), contract, ["store_id"])
