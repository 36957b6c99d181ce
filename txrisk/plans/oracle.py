"""The queries in DuckDB's SQL, over its ``orders`` view. Scores of a fitted model have none, only what must hold for them."""

from __future__ import annotations

_VIEWS = """
WITH keyed AS (
  SELECT o_orderkey,
         'txn' || o_orderkey AS "transactionId",
         o_custkey AS "userId",
         o_totalprice / 50.0::DOUBLE AS amount,
         (['NY','CA','TX','FL','NJ','WA','IL','MA'])[o_orderkey % 8 + 1] AS location,
         (['Mobile','Web','ATM','POS'])[(o_orderkey // 8) % 4 + 1] AS device,
         (['Grocery','Electronics','Travel','Clothing','Restaurants','Fuel'])
           [(o_orderkey // 32) % 6 + 1] AS merchant,
         o_orderdate AS "timestamp",
         ((o_orderkey * 1103515245 + 12345) % 2147483648) / 2147483648.0::DOUBLE AS u,
         ((o_orderkey * 22695477 + 1) % 4294967296) / 4294967296.0::DOUBLE AS u2,
         ((o_orderkey * 1597334677 + 7) % 4294967296) / 4294967296.0::DOUBLE AS u3
  FROM orders
), risky AS (
  SELECT *,
         ln(1 + amount) AS amount_log,
         least(0.05::DOUBLE
               + CASE WHEN amount > 7000 THEN 0.20::DOUBLE
                      WHEN amount > 3000 THEN 0.10::DOUBLE ELSE 0.0::DOUBLE END
               + CASE WHEN device IN ('Mobile','ATM') THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END
               + CASE WHEN merchant IN ('Electronics','Travel') THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END
               + CASE WHEN location IN ('TX','FL') THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END,
               0.85::DOUBLE) AS p
  FROM keyed
), tx AS (
  SELECT *,
         CAST(u < p AS BIGINT) AS label,
         CASE WHEN u2 < p THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM risky
), explained AS (
  SELECT *,
         concat_ws(',',
           CASE WHEN device IN ('Mobile','ATM') THEN 'RiskyDevice' END,
           CASE WHEN merchant IN ('Electronics','Travel') THEN 'RiskyMerchant' END,
           CASE WHEN location IN ('TX','FL') THEN 'RiskyLocation' END) AS codes,
         concat_ws(',', CASE WHEN amount_log > 7000 THEN 'HighAmount' END, nullif(codes, '')) AS log_codes,
         concat_ws(',', CASE WHEN amount > 7000 THEN 'HighAmount' END, nullif(codes, '')) AS raw_codes
  FROM tx
), pred AS (
  SELECT "transactionId", "userId", amount_log AS amount, amount AS raw_amount,
         location, device, merchant, prediction,
         CASE WHEN prediction = 1 THEN coalesce(nullif(log_codes, ''), 'ModelDetected')
              ELSE 'Normal' END AS fraud_reason,
         CASE WHEN prediction = 1 THEN coalesce(nullif(raw_codes, ''), 'ModelDetected')
              ELSE 'Normal' END AS fraud_reason_raw
  FROM explained
), indexed AS (
  SELECT "column", value,
         CAST(row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, value) - 1 AS DOUBLE)
           AS "index"
  FROM (SELECT 'location' AS "column", location AS value FROM tx
        UNION ALL SELECT 'device', device FROM tx
        UNION ALL SELECT 'merchant', merchant FROM tx)
  GROUP BY "column", value
), ranked AS (
  SELECT "transactionId", "userId", amount, location, device, merchant, fraud_reason,
         rank() OVER (PARTITION BY "userId" ORDER BY amount DESC NULLS FIRST) AS fraud_rank
  FROM pred WHERE prediction = 1
), top3 AS (SELECT * FROM ranked WHERE fraud_rank <= 3
), exposure AS (
  SELECT merchant, sum(amount) AS total, sum(raw_amount) AS raw_total
  FROM pred WHERE prediction = 1 GROUP BY merchant
), places AS (
  SELECT location, count(*) AS fraud_count FROM pred WHERE prediction = 1 GROUP BY location
)
"""

_PREDICTIONS = """
SELECT "transactionId", "userId", round(amount, 6) AS amount, location, device, merchant,
       prediction, fraud_reason
FROM pred
"""

_ALERTS = """
SELECT "transactionId", "userId", round(amount, 6) AS amount, fraud_reason,
       'Fraud Alert!' AS subject,
       'Fraud detected! Transaction: ' || "transactionId" || ', User: ' || "userId"
         || ', Amount: ' || round(amount, 6) || ', Reason: ' || fraud_reason AS body
FROM pred WHERE prediction = 1
"""

# Labelled rows with a fault per merchant.
_DAMAGED = """
, damaged AS (
  SELECT "transactionId",
         CASE WHEN merchant IN ('Electronics', 'Travel') OR lost THEN 0 ELSE label END AS positive,
         label,
         CASE merchant WHEN 'Electronics' THEN 'label outside 0 and 1'
                       WHEN 'Travel' THEN 'no label'
                       WHEN 'Clothing' THEN 'no user'
                       WHEN 'Restaurants' THEN 'no amount'
                       WHEN 'Fuel' THEN 'amount is infinite'
                       ELSE CASE WHEN lost THEN 'unreadable line' WHEN location = 'IL' THEN 'no transaction' END END AS cause
  FROM (SELECT *, merchant = 'Grocery' AND location = 'NY' AS lost FROM tx)
)
"""

_SELECTS = {
    "transactions": """
SELECT "transactionId", "userId", amount, location, device, merchant, "timestamp", label FROM tx
""",
    "json_roundtrip": """
SELECT "transactionId", "userId", amount, location, device, merchant, "timestamp", label FROM tx
""",
    "json_inferred": """
SELECT "transactionId", "userId", amount, location, device, merchant, "timestamp", label FROM tx
""",
    "kafka_envelope": """
SELECT "transactionId" AS message_key, "transactionId", "userId", amount, location, device,
       merchant, "timestamp"
FROM tx
""",
    "quarantine": """
SELECT "transactionId" AS message_key, 'garbage' AS raw, 'unreadable message' AS cause
FROM tx WHERE o_orderkey % 100 = 0
""",
    "quarantine_causes": """
SELECT CASE merchant
         WHEN 'Electronics' THEN 'unreadable message'
         WHEN 'Travel' THEN 'empty message'
         WHEN 'Clothing' THEN 'no user'
         WHEN 'Restaurants' THEN 'no amount'
         WHEN 'Fuel' THEN 'amount has no log'
         ELSE CASE location WHEN 'NY' THEN 'no transaction'
                            WHEN 'IL' THEN 'unreadable field'
                            WHEN 'FL' THEN 'amount is infinite'
                            ELSE 'accepted' END END AS cause,
       count(*) AS "count"
FROM tx GROUP BY 1
""",
    "log_amount": """
SELECT "transactionId", amount, round(amount_log, 6) AS amount_log FROM tx
""",
    "amount_rounded": """
SELECT "transactionId", CAST(round(CAST(amount AS DECIMAL(18,6)), 2) AS DOUBLE) AS amount FROM tx
""",
    "age_timestamps": """
SELECT "transactionId",
       TIMESTAMP '2024-01-01 00:00:00' - to_minutes(CAST(floor(u * 43200) AS INTEGER)) AS event_time
FROM tx
""",
    "rule_risk_score": """SELECT "transactionId", p AS risk FROM tx""",
    "label_draw": """
SELECT "transactionId", u AS draw, CAST(u < p AS INTEGER) AS label FROM tx
""",
    "label_balance": """SELECT label, count(*) AS "count" FROM tx GROUP BY label""",
    "class_weights": """
SELECT "transactionId", label,
       CASE WHEN label = 1 THEN (n - ones) / n::DOUBLE ELSE ones / n::DOUBLE END AS weight
FROM tx, (SELECT count(*) AS n, count(*) FILTER (WHERE label = 1) AS ones FROM tx)
""",
    "train_test_split": """
SELECT "transactionId", CASE WHEN u3 < 0.8 THEN 'train' ELSE 'test' END AS split FROM tx
""",
    "category_index": """SELECT "column", value, "index" FROM indexed""",
    "features": """
SELECT "transactionId", CAST("userId" AS DOUBLE) AS "f_userId",
       round(amount_log, 6) AS f_amount_log,
       l."index" AS f_location_idx, d."index" AS f_device_idx, m."index" AS f_merchant_idx
FROM tx
JOIN indexed l ON l."column" = 'location' AND l.value = tx.location
JOIN indexed d ON d."column" = 'device' AND d.value = tx.device
JOIN indexed m ON m."column" = 'merchant' AND m.value = tx.merchant
""",
    "confusion": """
SELECT CAST(label AS INTEGER) AS label, CAST(prediction AS INTEGER) AS prediction,
       count(*) AS "count"
FROM tx GROUP BY ALL
""",
    "metrics": """
, cells AS (
  SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0)::DOUBLE AS tn,
         count(*) FILTER (WHERE label = 0 AND prediction = 1)::DOUBLE AS fp,
         count(*) FILTER (WHERE label = 1 AND prediction = 0)::DOUBLE AS fn,
         count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE AS tp
  FROM tx
), rates AS (
  SELECT *, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1
  FROM cells
)
SELECT round((tn + tp) / (tn + fp + fn + tp), 9) AS accuracy,
       round(p0, 9) AS precision_0, round(r0, 9) AS recall_0,
       round(p1, 9) AS precision_1, round(r1, 9) AS recall_1,
       round((2 * p0 * r0 / (p0 + r0) * (tn + fp) + 2 * p1 * r1 / (p1 + r1) * (fn + tp))
             / (tn + fp + fn + tp), 9) AS f1,
       round((r1 + r0) / 2, 9) AS auroc_hard
FROM rates
""",
    "fraud_reason": """SELECT "transactionId", prediction, fraud_reason FROM pred""",
    "fraud_reason_raw": """
SELECT "transactionId", prediction, fraud_reason_raw AS fraud_reason FROM pred
""",
    "predictions": _PREDICTIONS,
    "alerts": _ALERTS,
    "report_summary": """
SELECT prediction, merchant, device, location, fraud_reason, count(*) AS row_count,
       round(sum(amount), 4) AS amount_sum, count(amount) AS amount_count
FROM pred GROUP BY prediction, merchant, device, location, fraud_reason
""",
    "report_merchant_exposure": """SELECT merchant, round(total, 4) AS "sum" FROM exposure""",
    "report_merchant_exposure_raw": """SELECT merchant, round(raw_total, 4) AS "sum" FROM exposure""",
    "report_fraud_transactions": _PREDICTIONS + "WHERE prediction = 1",
    "report_user_top3": """
SELECT "transactionId", "userId", round(amount, 6) AS amount, location, device, merchant,
       fraud_reason, fraud_rank
FROM top3
""",
    "report_device_counts": """
SELECT device, count(*) AS transaction_count FROM pred GROUP BY device
ORDER BY transaction_count DESC NULLS FIRST, device
""",
    "report_merchant_contribution": """
SELECT merchant, round(total, 4) AS fraud_amount FROM exposure
ORDER BY fraud_amount DESC NULLS FIRST, merchant
""",
    "report_merchant_contribution_raw": """
SELECT merchant, round(raw_total, 4) AS fraud_amount FROM exposure
ORDER BY fraud_amount DESC NULLS FIRST, merchant
""",
    "report_prediction_counts": """
SELECT prediction, count(*) AS total_transactions FROM pred GROUP BY prediction
""",
    "report_reason_breakdown": """
SELECT fraud_reason, count(*) AS "count" FROM pred WHERE prediction = 1 GROUP BY fraud_reason
ORDER BY "count" DESC NULLS FIRST, fraud_reason
""",
    "report_avg_amount": """
SELECT prediction, round(avg(amount), 4) AS avg_amount FROM pred GROUP BY prediction
""",
    "report_avg_amount_raw": """
SELECT prediction, round(avg(raw_amount), 4) AS avg_amount FROM pred GROUP BY prediction
""",
    "report_location_counts": """
SELECT location, fraud_count FROM places ORDER BY fraud_count DESC NULLS FIRST, location
""",
    "report_merchant_share": """
SELECT merchant, round(total, 4) AS fraud_amount,
       round(total / (SELECT sum(total) FROM exposure), 6) AS share
FROM exposure
""",
    "report_location_share": """
SELECT location, fraud_count,
       round(fraud_count / (SELECT sum(fraud_count) FROM places)::DOUBLE, 6) AS share
FROM places
""",
    "report_last_not_null": """
, last_top AS (
  SELECT "userId", amount, fraud_rank FROM top3
  ORDER BY "userId" DESC, fraud_rank DESC, "transactionId" DESC LIMIT 1
), last_prediction AS (
  SELECT prediction, count(*) AS n, avg(amount) AS mean FROM pred
  GROUP BY prediction ORDER BY prediction DESC LIMIT 1
)
SELECT panel, field, round(value::DOUBLE, 4) AS value FROM (
  SELECT 'user_top3' AS panel, 'userId' AS field, "userId"::DOUBLE AS value FROM last_top
  UNION ALL SELECT 'user_top3', 'amount', amount FROM last_top
  UNION ALL SELECT 'user_top3', 'fraud_rank', fraud_rank FROM last_top
  UNION ALL SELECT 'prediction_counts', 'prediction', prediction FROM last_prediction
  UNION ALL SELECT 'prediction_counts', 'total_transactions', n FROM last_prediction
  UNION ALL SELECT 'average_amount', 'prediction', prediction FROM last_prediction
  UNION ALL SELECT 'average_amount', 'avg_amount', mean FROM last_prediction
)
""",
    "report_merchant_legend": """
SELECT round(min(total), 4) AS "min", round(arg_max(total, merchant), 4) AS "last",
       round(avg(total), 4) AS "mean"
FROM exposure
""",
    "category_index_wide": """
SELECT 'userId' AS "column", CAST("userId" AS VARCHAR) AS value,
       CAST(row_number() OVER (ORDER BY count(*) DESC, CAST("userId" AS VARCHAR)) - 1 AS DOUBLE) AS "index"
FROM tx GROUP BY "userId"
""",
    "exact_split": """
, placed AS (
  SELECT "transactionId", row_number() OVER (ORDER BY u3) AS place, count(*) OVER () AS n FROM tx
)
SELECT "transactionId", CASE WHEN place <= floor(0.8::DOUBLE * n + 0.5) THEN 'train' ELSE 'test' END AS split FROM placed
""",
    "exact_split_counts": """
SELECT split, CASE split WHEN 'train' THEN train ELSE n - train END AS "count",
       CASE split WHEN 'train' THEN train ELSE n - train END AS ids
FROM (SELECT count(*) AS n, floor(0.8::DOUBLE * count(*) + 0.5)::BIGINT AS train FROM tx), (VALUES ('train'), ('test')) sides(split)
""",
    "score_ranks": """
, placed AS (SELECT amount, row_number() OVER (ORDER BY amount) AS place FROM tx)
SELECT amount, count(*) AS n, sum(place)::DOUBLE / count(*)::DOUBLE AS rank FROM placed GROUP BY amount
""",
    "score_auroc": """
, placed AS (SELECT label, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS rank FROM tx
), sums AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE label = 1) AS ones, sum(rank) FILTER (WHERE label = 1) AS ranks FROM placed
)
SELECT n AS "rows", ones AS positives, round((ranks - ones * (ones + 1) / 2) / (ones * (n - ones)), 9) AS auroc_score FROM sums
""",
    "features_wide": """
, users AS (
  SELECT "userId", CAST(row_number() OVER (ORDER BY count(*) DESC, CAST("userId" AS VARCHAR)) - 1 AS DOUBLE) AS "index"
  FROM tx GROUP BY "userId"
)
SELECT "transactionId", users."index" AS "userId_idx", l."index" AS location_idx, d."index" AS device_idx, m."index" AS merchant_idx
FROM tx JOIN users USING ("userId")
JOIN indexed l ON l."column" = 'location' AND l.value = location
JOIN indexed d ON d."column" = 'device' AND d.value = device
JOIN indexed m ON m."column" = 'merchant' AND m.value = merchant
""",
    "gbt_tree_checks": """
SELECT "transactionId", true AS same_margin, true AS same_prediction, true AS at_leaves, CAST(100 AS BIGINT) AS trees,
       CAST(5 AS BIGINT) AS depth
FROM tx WHERE u3 >= 0.8
""",
    "training_rejects": _DAMAGED + """
SELECT cause, count(*) AS "count" FROM damaged WHERE cause IS NOT NULL GROUP BY cause
""",
    "training_weights": _DAMAGED + """
SELECT "transactionId", label,
       CASE WHEN label = 1 THEN (n - ones) / n::DOUBLE ELSE ones / n::DOUBLE END AS weight
FROM damaged, (SELECT count(*) AS n, sum(positive) AS ones FROM damaged)
WHERE cause IS NULL
""",
    "batch_totals": """
SELECT count(*) AS row_count, count(*) FILTER (WHERE o_orderkey % 100 <> 0) AS accepted,
       count(*) FILTER (WHERE o_orderkey % 100 = 0) AS rejected
FROM tx
""",
    "gbt_score_checks": """
SELECT "transactionId", label, true AS in_range, true AS by_half FROM tx WHERE u3 >= 0.8
""",
    "gbt_reload_checks": """SELECT "transactionId", true AS same FROM tx WHERE u3 >= 0.8""",
    "stream_gbt_checks": """
SELECT "transactionId", round(amount_log, 6) AS amount, true AS same FROM tx
""",
    "gbt_metrics_checks": """
SELECT count(*) AS test_rows, count(*) FILTER (WHERE label = 1) AS positives, true AS beats_chance, true AS near_best
FROM tx WHERE u3 >= 0.8
""",
    "gbt_layout": """
SELECT count(*) AS test_rows, CAST(0 AS BIGINT) AS changed FROM tx WHERE u3 >= 0.8
""",
    "stream_uncommitted": """
SELECT 'predictions' AS "table", count(*) AS "rows" FROM tx WHERE o_orderkey % 4 IN (0, 1)
UNION ALL SELECT 'alerts', count(*) FILTER (WHERE prediction = 1) FROM tx WHERE o_orderkey % 4 IN (0, 1)
UNION ALL SELECT 'quarantine', 0 UNION ALL SELECT 'batch_counts', 2
UNION ALL SELECT 'summaries', count(*) FROM tx WHERE o_orderkey % 4 IN (0, 1)
""",
    "day_predictions": """
SELECT CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS event_day, "transactionId", "userId", round(amount_log, 6) AS amount, location,
       device, merchant, prediction,
       CASE WHEN prediction = 1 THEN coalesce(nullif(log_codes, ''), 'ModelDetected') ELSE 'Normal' END AS fraud_reason
FROM explained WHERE CAST("timestamp" AS DATE) = (SELECT min(CAST("timestamp" AS DATE)) FROM tx)
""",
    "console_rows": _PREDICTIONS + """ORDER BY "transactionId" LIMIT 20
""",
    "stream_replay": _PREDICTIONS,
    "stream_compacted": _PREDICTIONS,
    "stream_score_table": _PREDICTIONS,
    "stream_alerts": _ALERTS,
    "batch_counts": """
SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS row_count, count(*) AS accepted,
       CAST(0 AS BIGINT) AS rejected
FROM tx
""",
}

_SELECTS["stream_quarantine"] = _SELECTS["quarantine"]
for _panel in ("merchant_exposure", "fraud_transactions", "user_top3", "device_counts", "merchant_contribution",
               "prediction_counts", "reason_breakdown", "avg_amount", "location_counts"):
    _SELECTS[f"report_stored_{_panel}"] = _SELECTS[f"report_{_panel}"]

for _panel in ("merchant_exposure", "device_counts", "merchant_contribution", "prediction_counts", "reason_breakdown",
               "avg_amount", "location_counts"):
    _SELECTS[f"report_added_{_panel}"] = _SELECTS[f"report_{_panel}"]
_SELECTS["report_leaders_user_top3"] = _SELECTS["report_user_top3"]

ORACLES = {name: _VIEWS + select for name, select in _SELECTS.items()}
