"""Quality gate queries."""

from __future__ import annotations

from demandloom.catalog.registry import query
from demandloom.catalog.tables import SCORED_ALL, scored
from demandloom.config import CHECKS, QualityThresholds
from demandloom.operators import quality

LIMITS = QualityThresholds()


def _grade(value: str, name: str) -> str:
    warn, fail = getattr(LIMITS, f"{name}_warn"), getattr(LIMITS, f"{name}_fail")
    return f"CASE WHEN {value} >= {fail} THEN 2 WHEN {value} >= {warn} THEN 1 ELSE 0 END"


QUALITY = f"""{SCORED_ALL},
span AS (SELECT model, max(date) - min(date) + 1 - count(DISTINCT date) AS holes
         FROM scored GROUP BY 1),
copies AS (SELECT model, sum(n - 1) AS duplicates
           FROM (SELECT model, date, store_id, count(*) AS n FROM scored GROUP BY 1, 2, 3) GROUP BY 1),
measured AS (
  SELECT model, count(*) FILTER (WHERE actual < 0) AS negative_actuals,
         count(*) FILTER (WHERE prediction < 0) AS negative_predictions,
         count(*) FILTER (WHERE prediction IS NULL) / count(*) AS missing_share,
         avg(prediction - actual) AS bias, sqrt(avg((prediction - actual) ** 2)) AS rmse,
         avg(abs(prediction - actual)) AS mae,
         sum(abs(prediction - actual)) / sum(abs(actual)) FILTER (WHERE prediction IS NOT NULL) * 100
           AS wape,
         avg(abs(actual)) FILTER (WHERE prediction IS NOT NULL) AS size
  FROM scored GROUP BY 1),
facts AS (SELECT * FROM measured JOIN span USING (model) JOIN copies USING (model)),
checks AS (
  SELECT model, 'missing_timestamps' AS "check", {_grade("holes", "missing_timestamp")} AS code,
         holes::DOUBLE AS metric_value FROM facts
  UNION ALL SELECT model, 'duplicate_timestamps', {_grade("duplicates", "duplicate_timestamp")},
         duplicates FROM facts
  UNION ALL SELECT model, 'negative_volumes', {_grade("negative_actuals", "negative_volume")},
         negative_actuals FROM facts
  UNION ALL SELECT model, 'negative_predictions',
         {_grade("negative_predictions", "negative_prediction")}, negative_predictions FROM facts
  UNION ALL SELECT model, 'missing_predictions', {_grade("missing_share", "missing_prediction")},
         missing_share FROM facts
  UNION ALL SELECT model, 'excessive_bias', greatest({_grade("abs(bias)", "bias")},
         {_grade("abs(bias) / size", "relative_bias")}), bias FROM facts
  UNION ALL SELECT model, 'abnormal_errors', greatest({_grade("rmse", "rmse")},
         {_grade("mae", "mae")}, {_grade("wape", "wape")},
         {_grade("rmse / size", "relative_rmse")}), rmse FROM facts),
report AS (
  SELECT model, max(code) AS code, count(*) FILTER (WHERE code = 0) AS n_pass,
         count(*) FILTER (WHERE code = 1) AS n_warning, count(*) FILTER (WHERE code = 2) AS n_fail
  FROM checks GROUP BY 1)"""

NAMED = "['PASS', 'WARNING', 'FAIL'][code + 1]"


def checks(spark, folder):
    return quality.quality_checks(scored(spark, folder, complete=False), entity=["store_id"])


@query("quality_checks", "model:s check:s code:i status:s metric_value:4",
       f"{QUALITY} => SELECT *, {NAMED} AS status FROM checks")
def quality_checks(spark, folder):
    return checks(spark, folder)


@query("quality_report", "model:s code:i status:s n_pass:i n_warning:i n_fail:i",
       f"{QUALITY} => SELECT *, {NAMED} AS status FROM report")
def quality_report(spark, folder):
    return quality.quality_report(checks(spark, folder))


@query("quality_summary", "model:s check:s status:s metric_value:4 model_summary:s",
       f"""{QUALITY}, named AS (SELECT model, {NAMED} AS status FROM report),
       worst AS (SELECT max(code) AS code FROM report) =>
       SELECT model, "check", {NAMED.replace("code", "c.code")} AS status, metric_value,
              named.status AS model_summary FROM checks c JOIN named USING (model)
       UNION ALL SELECT model, 'SUMMARY', status, NULL, status FROM named
       UNION ALL SELECT 'ALL', 'OVERALL', {NAMED}, NULL, {NAMED} FROM worst""")
def quality_summary(spark, folder):
    return quality.quality_summary(checks(spark, folder))


@query("quality_flat", "key:s value:4",
       f"""{QUALITY} =>
       SELECT 'fq_' || model || '_status' AS key, code::DOUBLE AS value FROM report
       UNION ALL SELECT 'fq_' || model || '_n_pass', n_pass FROM report
       UNION ALL SELECT 'fq_' || model || '_n_warning', n_warning FROM report
       UNION ALL SELECT 'fq_' || model || '_n_fail', n_fail FROM report
       UNION ALL SELECT 'fq_' || model || '_' || "check" || '_status', code FROM checks
       UNION ALL SELECT 'fq_' || model || '_' || "check" || '_value', metric_value FROM checks
       UNION ALL SELECT 'fq_overall_status', max(code) FROM report""")
def quality_flat(spark, folder):
    return quality.quality_metrics(checks(spark, folder))


@query("quality_text", "model:s place:i line:s",
       f"""{QUALITY},
       texts AS (
         SELECT model, 'missing_timestamps' AS "check",
                printf('Found %d missing timestamps', holes::BIGINT) AS message FROM facts
         UNION ALL SELECT model, 'duplicate_timestamps',
                printf('Found %d duplicate timestamps', duplicates::BIGINT) FROM facts
         UNION ALL SELECT model, 'negative_volumes',
                printf('Found %d negative actual volumes', negative_actuals::BIGINT) FROM facts
         UNION ALL SELECT model, 'negative_predictions',
                printf('Found %d negative predictions', negative_predictions::BIGINT) FROM facts
         UNION ALL SELECT model, 'missing_predictions',
                printf('Missing/non-finite predictions: share %.4f', missing_share) FROM facts
         UNION ALL SELECT model, 'excessive_bias',
                printf('Forecast bias=%.4f (relative=%.4f)', bias, abs(bias) / size) FROM facts
         UNION ALL SELECT model, 'abnormal_errors',
                printf('Errors RMSE=%.4f, MAE=%.4f, WAPE=%.2f%%, rel_RMSE=%.4f', rmse, mae, wape,
                       rmse / size) FROM facts) =>
       SELECT model, 0 AS place, '[' || {NAMED} || '] ' || model AS line FROM report
       UNION ALL SELECT model, list_position([{", ".join(f"'{c}'" for c in CHECKS)}], "check"),
         '  - ' || {NAMED} || ': ' || "check" || ' - ' || message
       FROM checks JOIN texts USING (model, "check")""")
def quality_text(spark, folder):
    return quality.quality_text(checks(spark, folder))
