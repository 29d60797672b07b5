"""The expected result of every query in the registry, as SQL on the raw tables.

The statements are written independently of the DataFrame operators: plain grouped
selects, windows and literal joins. Amounts are added as decimals; ``rounded`` rounds
the shortest decimal form of a double half up, as Spark's ``round`` does.
"""

from __future__ import annotations


def rounded(expr: str, digits: int) -> str:
    exact = f"CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18))"
    return f"CAST(ROUND({exact}, {digits}) AS DOUBLE)"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def score_mean(col: str) -> str:
    return f"CAST(SUM(CAST({col} AS DECIMAL(20,10))) AS DOUBLE) / COUNT({col})"


TOTAL = dbl("SUM(amount)")
MEAN = f"{TOTAL} / COUNT(*)"
MEAN_2 = rounded(MEAN, 2)
FRAUD = big("SUM(isFraud)")


def rate(part: str, whole: str, digits: int = 4) -> str:
    return rounded(f"100.0 * {dbl(part)} / {whole}", digits)


# --- inputs -----------------------------------------------------------------------

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    CTES[name] = (needs, body)


cte("t0", """
    SELECT o_orderkey AS txnId, o_orderstatus AS st, o_orderdate AS od,
        CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 1 AS INTEGER) AS step,
        CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'TRANSFER' WHEN '2' THEN 'CASH_OUT'
            WHEN '3' THEN 'PAYMENT' WHEN '4' THEN 'CASH_IN' WHEN '5' THEN 'DEBIT' END AS type,
        CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
        (CASE WHEN o_custkey % 10 = 9 THEN 'M' ELSE 'C' END) || o_custkey AS nameOrig,
        (SELECT COUNT(*) FROM customer) AS nc
    FROM orders""")
cte("t1", """
    SELECT *, type IN ('PAYMENT', 'DEBIT') AS shop,
        CAST(amount + txnId % 1000 AS DECIMAL(18,2)) AS ob,
        CASE WHEN type IN ('PAYMENT', 'DEBIT') THEN 0 ELSE txnId % 5000 END AS db
    FROM t0""", "t0")
cte("t", """
    SELECT txnId, step, type, amount, nameOrig, ob AS oldbalanceOrg,
        CAST(CASE WHEN type = 'CASH_IN' THEN ob + amount ELSE ob - amount END AS DECIMAL(18,2))
            AS newbalanceOrig,
        CASE WHEN shop THEN 'M' || (txnId % 100) ELSE 'C' || ((txnId * 31 + 7) % nc) END AS nameDest,
        CAST(db AS DECIMAL(18,2)) AS oldbalanceDest,
        CAST(CASE WHEN shop OR st = 'F' THEN 0 ELSE db + amount END AS DECIMAL(18,2)) AS newbalanceDest,
        CAST(type IN ('TRANSFER', 'CASH_OUT') AND st = 'F' AND txnId % 10 <> 0 AS INTEGER) AS isFraud,
        CAST(type = 'TRANSFER' AND amount > 400000 AS INTEGER) AS isFlaggedFraud,
        CAST(epoch_ms(od) + txnId % 1000 AS BIGINT) AS ingestedAt
    FROM t1""", "t1")
cte("c", """
    SELECT 'C' || c_custkey AS customerId, c_name AS name,
        CAST(18 + c_custkey % 61 AS INTEGER) AS age, c_mktsegment AS segment,
        list_sort(['savings', 'current', 'mortgage', 'credit_card', 'personal_loan', 'car_loan',
            'fixed_deposit', 'investment_fund'])[1 : 1 + c_custkey % 4] AS products,
        CASE WHEN c_custkey % 100 < 92 THEN 'verified' WHEN c_custkey % 100 < 96 THEN 'pending'
            ELSE 'expired' END AS kyc_status,
        (c_custkey * 37 % 100) / CAST(100 AS DOUBLE) AS risk_score,
        (c_custkey * 53 % 100) / CAST(100 AS DOUBLE) AS churn_probability,
        (2005 + c_custkey % 20) || '-' || lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0') || '-'
            || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') AS account_opened,
        ['mobile', 'web', 'branch', 'atm', 'phone'][c_nationkey % 5 + 1] AS preferred_channel
    FROM customer""")
cte("s0", """
    SELECT event_id AS txnId,
        CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 3600000000.0) + 1 AS INTEGER) AS step,
        CASE event_type WHEN 'purchase' THEN 'PAYMENT' WHEN 'signup' THEN 'DEBIT'
            WHEN 'view' THEN 'CASH_IN' WHEN 'click' THEN 'CASH_OUT' WHEN 'error' THEN 'TRANSFER' END AS type,
        CAST(value * 4000 AS DECIMAL(18,2)) AS amount,
        'C' || user_id AS nameOrig,
        CAST(CASE WHEN event_id % 3 = 0 THEN 100 ELSE 5000 END AS DECIMAL(18,2)) AS newbalanceOrig,
        'C' || json_extract_string(props, '$.k') AS nameDest,
        epoch_us(ts) // 1000 AS ingestedAt
    FROM events""")
cte("s", """
    SELECT txnId, step, type, amount, nameOrig,
        CAST(newbalanceOrig + amount AS DECIMAL(18,2)) AS oldbalanceOrg, newbalanceOrig, nameDest,
        CAST(0 AS DECIMAL(18,2)) AS oldbalanceDest,
        CASE WHEN txnId % 2 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE amount END AS newbalanceDest,
        CAST(type IN ('TRANSFER', 'CASH_OUT') AND amount > 200000
            AND (txnId % 2 = 0 OR amount = 0) AND txnId % 10 <> 0 AS INTEGER) AS isFraud,
        0 AS isFlaggedFraud, ingestedAt
    FROM s0""", "s0")

RULE = "type IN ('TRANSFER', 'CASH_OUT') AND amount > 200000 AND newbalanceDest = 0"
REASON = "'type=' || type || ' + amount>200,000 + newbalanceDest=0' AS fraudReason"
cte("fs", f"""
    SELECT *, {REASON}, flaggedAt - ingestedAt AS detectionLatencyMs,
        CAST((step - 1) // 24 + 1 AS INTEGER) AS day
    FROM (SELECT *, (ingestedAt // 5000 + 1) * 5000 AS flaggedAt FROM s WHERE {RULE})""", "s")
cte("ft", f"SELECT *, {REASON} FROM t WHERE {RULE}", "t")
cte("mx", "SELECT MAX(step) AS mx, greatest(0, MAX(step) - 168) AS ws FROM t", "t")

# --- reports ----------------------------------------------------------------------

cte("comp", f"""
    SELECT *, CASE WHEN fraud_rate_pct >= 10 THEN 'HIGH' WHEN fraud_rate_pct >= 2 THEN 'MEDIUM'
        ELSE 'LOW' END AS risk_classification
    FROM (SELECT type AS transaction_type, COUNT(*) AS txn_count, {TOTAL} AS total_volume,
            {MEAN_2} AS avg_amount, {dbl('MAX(amount)')} AS max_amount, {FRAUD} AS fraud_count,
            {big('SUM(isFlaggedFraud)')} AS system_flagged_count,
            {dbl('SUM(CASE WHEN isFraud = 1 THEN amount ELSE 0 END)')} AS fraud_volume,
            {rate('SUM(isFraud)', 'COUNT(*)')} AS fraud_rate_pct,
            ANY_VALUE(ws) AS window_start_step, ANY_VALUE(mx) AS window_end_step
        FROM t, mx WHERE step > ws AND step <= mx GROUP BY type)""", "t", "mx")
ACTIVITY = f"""
    SELECT nameOrig AS customerId, COUNT(*) AS txn_count, {TOTAL} AS total_amount,
        {MEAN_2} AS avg_amount, {FRAUD} AS fraud_count,
        {rate('SUM(isFraud)', 'COUNT(*)')} AS fraud_rate_pct,
        COUNT(DISTINCT nameDest) AS unique_destinations, COUNT(DISTINCT type) AS distinct_types,
        MIN(step) AS first_active_step, MAX(step) AS last_active_step
    FROM {{source}} GROUP BY nameOrig"""
cte("act", ACTIVITY.format(source="t"), "t")
cte("stream_act", ACTIVITY.format(source="s"), "s")
cte("dorm", """
    SELECT customerId, last_active_step, first_active_step, txn_count, total_amount, avg_amount,
        fraud_count, mx AS dataset_max_step, mx - last_active_step AS steps_inactive,
        CASE WHEN mx - last_active_step > 120 THEN 'Severely Dormant' ELSE 'Dormant' END
            AS dormancy_severity
    FROM act, mx
    WHERE customerId LIKE 'C%' AND mx - last_active_step > 72 AND txn_count >= 5""", "act", "mx")
cte("daily", f"""
    SELECT type, step, COUNT(*) AS txn_volume, {TOTAL} AS total_amount, {MEAN_2} AS avg_amount,
        {FRAUD} AS fraud_count, {rate('SUM(isFraud)', 'COUNT(*)')} AS fraud_rate_pct
    FROM t GROUP BY type, step""", "t")
cte("clv", f"""
    SELECT *, {rounded('volumeScore * 0.3::DOUBLE + frequencyScore * 0.25::DOUBLE'
        ' + diversityScore * 0.25::DOUBLE + recencyScore * 0.2::DOUBLE', 4)} AS clv_score
    FROM (SELECT *, mx - last_active_step AS idle,
            CASE WHEN MAX(total_amount) OVER () <= 0 THEN 0
                ELSE total_amount / MAX(total_amount) OVER () END AS volumeScore,
            {dbl('txn_count')} / MAX(txn_count) OVER () AS frequencyScore,
            distinct_types / 5.0::DOUBLE AS diversityScore,
            CASE WHEN mx - last_active_step > 48 THEN 0
                ELSE (48 - (mx - last_active_step)) / 48.0::DOUBLE END AS recencyScore
        FROM act, mx)""", "act", "mx")
CLV_TIER = """CASE WHEN clv_score > 0.70 THEN 'High Value'
    WHEN clv_score >= 0.40 THEN 'Growth Potential' ELSE 'At Risk' END"""
cte("feat", f"""
    SELECT nameOrig AS customerId, COUNT(*) AS txnCount, {TOTAL} AS totalAmount,
        COALESCE({dbl("SUM(amount) FILTER (type = 'TRANSFER')")}
            / NULLIF(COUNT(*) FILTER (type = 'TRANSFER'), 0), 0) AS avgTransferAmount,
        {dbl("COUNT(*) FILTER (type = 'CASH_OUT')")} / COUNT(*) AS cashOutRatio,
        COUNT(DISTINCT nameDest) AS uniqueDestinations, {FRAUD} AS fraudCount,
        ANY_VALUE(ws) AS windowStartStep, ANY_VALUE(mx) AS windowEndStep
    FROM t, mx WHERE step > ws GROUP BY nameOrig""", "t", "mx")


def minmax(col: str) -> str:
    lo, hi = f"MIN({col}) OVER ()", f"MAX({col}) OVER ()"
    return f"CASE WHEN {hi} <= {lo} THEN 0.0::DOUBLE ELSE ({dbl(col)} - {lo}) / ({dbl(hi)} - {lo}) END"


cte("risk", f"""
    SELECT *, CASE WHEN risk_score < 0.25 THEN 'Low' WHEN risk_score <= 0.60 THEN 'Medium'
        ELSE 'High' END AS risk_tier
    FROM (SELECT * EXCLUDE (a, b, d, e), {rounded('a * 0.25::DOUBLE + b * 0.3::DOUBLE'
        ' + d * 0.25::DOUBLE + e * 0.2::DOUBLE', 4)} AS risk_score
        FROM (SELECT *, {minmax('txnCount')} AS a, {minmax('avgTransferAmount')} AS b,
                {minmax('cashOutRatio')} AS d, {minmax('uniqueDestinations')} AS e FROM feat))""", "feat")
cte("base", f"""
    SELECT nameOrig AS customerId, {MEAN} AS baselineAvgAmount,
        COUNT(*) / (greatest(1, (SELECT MAX(step) - MIN(step) + 1 FROM s)) / 12.0::DOUBLE)
            AS baselineFreqPer12
    FROM s GROUP BY nameOrig""", "s")
MART = f"""
    SELECT nameOrig AS customerId, step, COUNT(*) AS txn_count, {TOTAL} AS total_amount,
        {MEAN_2} AS avg_amount, {dbl('MAX(amount)')} AS max_amount, {FRAUD} AS fraud_count,
        string_agg(DISTINCT type, ',' ORDER BY type) AS txn_types,
        {dbl('MAX(CASE WHEN rn = 1 THEN newbalanceOrig END)')} AS last_balance
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY nameOrig, step
            ORDER BY ingestedAt DESC, amount DESC, newbalanceOrig DESC) AS rn FROM {{source}})
    GROUP BY nameOrig, step"""
cte("mart", MART.format(source="t"), "t")
cte("stream_mart", MART.format(source="s"), "s")
# Whole sixtieths of a cent, so that a sum of shares that ends on half a cent is exact
# and can be rounded up in integers.
cte("shares", """
    SELECT customerId, step, avg_amount, max_amount, trim(kind) AS transaction_type,
        CAST(CAST(total_amount AS DECIMAL(18,2)) * 100 AS BIGINT) * (60 // n) AS cents60, txn_count * (60 // n) AS txns60,
        fraud_count * (60 // n) AS fraud60
    FROM (SELECT *, len(string_split(txn_types, ',')) AS n, unnest(string_split(txn_types, ',')) AS kind
        FROM mart)""", "mart")
cte("summ", f"""
    SELECT transaction_type, step, CAST((2 * SUM(cents60) + 60) // 120 AS DOUBLE) / 100 AS total_volume,
        {big('ROUND(CAST(SUM(txns60) AS DECIMAL(38,6)) / 60)')} AS txn_count,
        {rounded(dbl('SUM(CAST(avg_amount AS DECIMAL(18,2)))') + ' / COUNT(*)', 2)} AS avg_amount,
        MAX(max_amount) AS max_amount,
        {big('ROUND(CAST(SUM(fraud60) AS DECIMAL(38,6)) / 60)')} AS fraud_count,
        COUNT(DISTINCT customerId) AS customers,
        {rate('SUM(fraud60)', 'SUM(txns60)', 2)} AS fraud_rate_pct
    FROM shares WHERE step BETWEEN 1 AND 168 GROUP BY transaction_type, step""", "shares")

# --- customer 360 -----------------------------------------------------------------

cte("blend", f"""
    SELECT *, CASE WHEN composite_risk_score <= 2 THEN 'Low' WHEN composite_risk_score <= 6
        THEN 'Medium' ELSE 'High' END AS risk_band
    FROM (SELECT c.customerId, name, age, segment, kyc_status, preferred_channel,
            CAST(len(products) AS INTEGER) AS product_count,
            array_to_string(products, ', ') AS products, account_opened,
            COALESCE(act.txn_count, 0) AS txn_count, COALESCE(act.total_amount, 0) AS total_amount,
            COALESCE(act.avg_amount, 0) AS avg_amount, COALESCE(act.fraud_count, 0) AS fraud_count,
            COALESCE(act.fraud_rate_pct, 0) AS fraud_rate_pct,
            COALESCE(act.unique_destinations, 0) AS unique_destinations,
            COALESCE(act.last_active_step, 0) AS last_active_step, risk_score, churn_probability,
            {rounded('COALESCE(act.fraud_rate_pct, 0) * 0.6::DOUBLE + churn_probability * 0.4::DOUBLE', 4)}
                AS composite_risk_score,
            COALESCE(clv.clv_score, 0) AS clv_score,
            CASE WHEN clv.customerId IS NULL THEN 'No Activity' ELSE {CLV_TIER} END AS clv_tier,
            COALESCE(dormancy_severity, 'Active') AS dormancy_severity,
            COALESCE(steps_inactive, 0) AS steps_inactive,
            dormancy_severity IS NOT NULL AS is_dormant
        FROM c LEFT JOIN act ON act.customerId = c.customerId
            LEFT JOIN clv ON clv.customerId = c.customerId
            LEFT JOIN dorm ON dorm.customerId = c.customerId)""", "c", "act", "clv", "dorm")

# --- churn ------------------------------------------------------------------------

cte("win", f"""
    SELECT nameOrig AS customerId, ws AS windowStart, ws + INTERVAL 24 HOUR AS windowEnd,
        COUNT(*) AS txnCount, {MEAN} AS windowAvgAmount,
        string_agg(DISTINCT type, '|' ORDER BY type) AS txnTypes,
        {big('SUM(CASE WHEN newbalanceOrig < 500 THEN 1 ELSE 0 END)')} AS lowBalanceEvents,
        bool_or(type = 'CASH_OUT') AND NOT bool_or(type IN ('PAYMENT', 'DEBIT')) AS cashOutOnly
    FROM (SELECT *, TIMESTAMP '2024-01-01' + to_hours(step) - to_hours(unnest(range(0, 24))) AS ws FROM s)
    GROUP BY nameOrig, ws""", "s")
cte("sig", """
    SELECT *, list_filter([
            CASE WHEN txnCount / 2.0 < 1 AND baselineFreqPer12 > 3 THEN 'FREQUENCY_COLLAPSE' END,
            CASE WHEN windowAvgAmount < baselineAvgAmount * 0.2::DOUBLE THEN 'SPEND_COLLAPSE' END,
            CASE WHEN cashOutOnly THEN 'CASH_OUT_LIQUIDATION' END,
            CASE WHEN lowBalanceEvents >= 2 THEN 'BALANCE_DRAIN' END], lambda x: x IS NOT NULL) AS fired
    FROM win LEFT JOIN base USING (customerId)""", "win", "base")

# --- graph ------------------------------------------------------------------------

TXN = "printf('TXN%06d', txnId)"
KIND = "CASE WHEN {0} LIKE 'M%' THEN 'MERCHANT' ELSE 'CUSTOMER' END"
cte("e", f"SELECT {TXN} AS txn, nameOrig AS src, nameDest AS dst, step, type, amount, newbalanceDest, isFraud FROM t", "t")
cte("acc", "SELECT nameOrig AS accountId FROM t UNION SELECT nameDest FROM t", "t")
cte("mules", f"""
    SELECT dst AS muleAccount, COUNT(DISTINCT src) AS distinctSenders, COUNT(*) AS inboundTxns,
        {TOTAL} AS totalInboundAmount, {FRAUD} AS fraudulentInbound, {KIND.format('dst')} AS accountType
    FROM e GROUP BY dst HAVING COUNT(DISTINCT src) > 3""", "e")
cte("rings", """
    SELECT a.dst AS mule1, b.dst AS mule2, COUNT(DISTINCT a.src) AS sharedSenderCount,
        array_to_string(list_sort(list(DISTINCT a.src))[1:5], '|') AS sampleSenders
    FROM e a JOIN e b ON a.src = b.src AND a.dst < b.dst
    WHERE a.isFraud = 1 OR b.isFraud = 1
    GROUP BY a.dst, b.dst HAVING COUNT(DISTINCT a.src) >= 2""", "e")
cte("layers", """
    SELECT x.dst AS layeringAccount, COUNT(DISTINCT x.src) AS inboundSources,
        COUNT(DISTINCT y.dst) AS onwardTargets
    FROM e x JOIN e y ON x.dst = y.src AND x.src <> y.dst AND x.txn <> y.txn
    GROUP BY x.dst HAVING COUNT(DISTINCT x.src) > 2 AND COUNT(DISTINCT y.dst) > 1""", "e")


def sql(body: str, *needs: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + "\n" + body


MONEY_COLUMNS = "oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest"
TXN_ROW = (
    "step, type, amount::DOUBLE AS amount, nameOrig, oldbalanceOrg::DOUBLE AS oldbalanceOrg, "
    "newbalanceOrig::DOUBLE AS newbalanceOrig, nameDest, oldbalanceDest::DOUBLE AS oldbalanceDest, "
    "newbalanceDest::DOUBLE AS newbalanceDest, isFraud, isFlaggedFraud"
)
VALUE = dbl("SUM(amount)")

ORACLE: dict[str, str] = {
    "scan_transactions": sql(f"SELECT txnId, {TXN_ROW}, ingestedAt FROM t", "t"),
    "scan_customers": sql("SELECT * REPLACE (array_to_string(products, '|') AS products) FROM c", "c"),
    "json_decode": sql(f"SELECT {TXN_ROW}, ingestedAt FROM s", "s"),
    "kv_json": sql("""
        SELECT nameOrig AS key, '{"nameOrig":"' || nameOrig || '","nameDest":"' || nameDest
            || '","type":"' || type || '","amount":' || amount::DOUBLE || ',"step":' || step
            || ',"flaggedAt":' || flaggedAt || '}' AS value FROM fs""", "fs"),
    **{name: sql("""
        SELECT step, type, amount::DOUBLE AS amount, nameOrig, nameDest,
            newbalanceDest::DOUBLE AS newbalanceDest, isFraud, fraudReason, detectionLatencyMs
        FROM fs ORDER BY flaggedAt DESC, step DESC, amount DESC, nameOrig, nameDest LIMIT 250""", "fs")
       for name in ("live_feed", "newest_feed")},
    **{f"live_feed_{name}": sql(f"""
        SELECT step, type, amount::DOUBLE AS amount, nameOrig, nameDest,
            newbalanceDest::DOUBLE AS newbalanceDest, isFraud, fraudReason, detectionLatencyMs
        FROM fs WHERE isFraud = {label}
        ORDER BY flaggedAt DESC, step DESC, amount DESC, nameOrig, nameDest LIMIT 250""", "fs")
       for name, label in (("confirmed", 1), ("false_positive", 0))},
    **{name: sql(f"SELECT {TXN_ROW}, detectionLatencyMs, flaggedAt, fraudReason FROM fs", "fs")
       for name in ("fraud_flagged", "folded_batches")},
    "confirmed_fraud": sql(f"SELECT {TXN_ROW} FROM t WHERE isFraud = 1", "t"),
    "event_time": sql(
        "SELECT txnId, step, TIMESTAMP '2024-01-01' + to_hours(step) AS eventTime FROM s", "s"),
    "rolling_window": sql(
        "SELECT txnId, step, amount::DOUBLE AS amount FROM t, mx WHERE step > ws AND step <= mx", "t", "mx"),
    "latest_balance": sql("SELECT customerId, step, last_balance FROM mart", "mart"),
    "minmax_normalise": sql(f"""
        SELECT customerId, age, risk_score, {minmax('age')} AS age_norm,
            {minmax('risk_score')} AS risk_score_norm FROM c""", "c"),
    "max_normalise": sql("""
        SELECT customerId, total_amount, txn_count, total_amount / MAX(total_amount) OVER () AS volume_share,
            txn_count::DOUBLE / MAX(txn_count) OVER () AS count_share FROM act""", "act"),
    "compliance_summary": sql("SELECT * FROM comp", "comp"),
    "customer_fraud_summary": sql("""
        SELECT customerId, txn_count, total_amount, avg_amount, fraud_count, fraud_rate_pct,
            unique_destinations, last_active_step FROM act""", "act"),
    "dormancy_report": sql("SELECT * FROM dorm", "dorm"),
    "daily_summary": sql("SELECT * FROM daily", "daily"),
    "distinct_accounts": sql("SELECT accountId FROM acc", "acc"),
    "risk_scores": sql("SELECT * FROM risk", "risk"),
    "clv_scores": sql(f"""
        SELECT customerId, clv_score, {CLV_TIER} AS clv_tier, volumeScore, frequencyScore,
            diversityScore, recencyScore, total_amount AS totalAmount, txn_count AS txnCount,
            distinct_types AS distinctTypes, last_active_step AS lastActiveStep,
            idle AS stepsSinceLastTxn FROM clv""", "clv"),
    "customer_baseline": sql("SELECT * FROM base", "base"),
    **{name: sql(f"""
        SELECT * EXCLUDE (fraud_rate_pct), CAST(customerId LIKE 'C%' AS INTEGER) AS is_customer FROM {source}""", source)
       for name, source in (("customer_activity", "act"), ("activity_merged", "act"), ("stored_activity", "stream_act"))},
    "stored_mart": sql("SELECT * FROM stream_mart", "stream_mart"),
    "activity_slices": sql(f"""
        SELECT nameOrig AS customerId, CAST((step - 1) // 168 AS INTEGER) AS slice, COUNT(*) AS txn_count,
            COUNT(amount) AS amounts, {big('SUM(amount * 100)')} AS total_cents, {FRAUD} AS fraud_count,
            bit_or(CAST(CASE type WHEN 'PAYMENT' THEN 1 WHEN 'TRANSFER' THEN 2 WHEN 'CASH_OUT' THEN 4
                WHEN 'CASH_IN' THEN 8 WHEN 'DEBIT' THEN 16 END AS BIGINT)) AS types,
            MIN(step) AS first_active_step, MAX(step) AS last_active_step
        FROM t GROUP BY 1, 2""", "t"),
    "activity_counterparties": sql(
        "SELECT DISTINCT nameOrig AS customerId, CAST((step - 1) // 168 AS INTEGER) AS slice, nameDest FROM t", "t"),
    "baseline_merged": sql("SELECT * FROM base", "base"),
    "txn_summary_mart": sql("SELECT * FROM mart", "mart"),
    "mart_inventory": sql(f"""
        SELECT COUNT(*) AS mart_rows, COUNT(DISTINCT customerId) AS customers, MIN(step) AS min_step,
            MAX(step) AS max_step, {big('SUM(fraud_count)')} AS total_fraud FROM mart""", "mart"),
    "transaction_summary": sql("SELECT * FROM summ", "summ"),
    "transaction_summary_daily": sql(f"""
        SELECT type AS transaction_type, step, total_amount AS total_volume, txn_volume AS txn_count,
            avg_amount, fraud_count, {rate('fraud_count', 'txn_volume', 2)} AS fraud_rate_pct
        FROM daily WHERE step BETWEEN 1 AND 168""", "daily"),
    "summary_by_type": sql(f"""
        SELECT transaction_type, COUNT(DISTINCT step) AS steps, {big('SUM(txn_count)')} AS txn_count,
            {dbl('SUM(CAST(total_volume AS DECIMAL(18,2)))')} AS total_volume,
            {big('SUM(fraud_count)')} AS fraud_count,
            {rate('SUM(fraud_count)', 'SUM(txn_count)', 2)} AS fraud_rate_pct
        FROM summ GROUP BY transaction_type""", "summ"),
    "customer_risk_blend": sql("SELECT * FROM blend", "blend"),
    "segment_rollup": sql(f"""
        SELECT segment, COUNT(customerId) AS customers,
            {rounded(score_mean('risk_score'), 4)} AS avg_risk_score,
            {rounded(score_mean('churn_probability'), 4)} AS avg_churn_probability,
            {rounded(score_mean('composite_risk_score'), 4)} AS avg_composite_risk,
            {rounded(score_mean('clv_score'), 4)} AS avg_clv,
            {big('SUM(fraud_count)')} AS total_fraud,
            {big('SUM(CASE WHEN is_dormant THEN 1 ELSE 0 END)')} AS dormant_accounts
        FROM blend GROUP BY segment""", "blend"),
    "customer_slice": sql("""
        SELECT customerId, segment, preferred_channel, kyc_status, risk_band FROM blend
        WHERE segment IN ('BUILDING', 'MACHINERY') AND preferred_channel IN ('mobile', 'web')
            AND kyc_status IN ('verified')""", "blend"),
    "flagged_enriched": sql(f"""
        SELECT {TXN_ROW}, fraudReason, name, segment, kyc_status, risk_band, clv_tier
        FROM ft LEFT JOIN blend ON nameOrig = customerId""", "ft", "blend"),
    "segment_distribution": sql(f"""
        SELECT segment, COUNT(*) AS customers, {score_mean('risk_score')} AS avg_risk,
            {score_mean('churn_probability')} AS avg_churn FROM c GROUP BY segment""", "c"),
    "portfolio_kpis": sql(f"""
        SELECT COUNT(*) AS customers, COUNT(*) FILTER (kyc_status = 'verified') AS verified,
            {score_mean('risk_score')} AS avg_risk, {score_mean('churn_probability')} AS avg_churn,
            {dbl('SUM(len(products))')} / COUNT(*) AS avg_products FROM c""", "c"),
    "kpi_customer_360": sql(f"""
        SELECT COUNT(*) AS total_customers, COUNT(*) FILTER (kyc_status = 'verified') AS verified,
            {score_mean('risk_score')} AS avg_risk, {score_mean('churn_probability')} AS avg_churn,
            {dbl('SUM(product_count)')} / COUNT(*) AS avg_products,
            {score_mean('composite_risk_score')} AS avg_composite_risk FROM blend""", "blend"),
    "segment_bars": sql(f"""
        SELECT segment, COUNT(customerId) AS customers, {score_mean('risk_score')} AS avg_risk
        FROM blend GROUP BY segment""", "blend"),
    "churn_heatmap": sql("SELECT segment, " + ", ".join(
        f"CAST(SUM(CAST(churn_probability AS DECIMAL(20,10))) FILTER (preferred_channel = '{ch}') AS DOUBLE)"
        f" / COUNT(*) FILTER (preferred_channel = '{ch}') AS {ch}"
        for ch in ("mobile", "web", "branch", "atm", "phone")) + " FROM blend GROUP BY segment", "blend"),
    "clv_tier_counts": sql("SELECT clv_tier, COUNT(*) AS customers FROM blend GROUP BY clv_tier", "blend"),
    "risk_churn_quadrant": sql(f"""
        SELECT customerId, segment, risk_score, churn_probability,
            CASE WHEN risk_score > r THEN 'high risk' ELSE 'low risk' END || ' / '
            || CASE WHEN churn_probability > h THEN 'high churn' ELSE 'low churn' END AS quadrant
        FROM blend, (SELECT {score_mean('risk_score')} AS r, {score_mean('churn_probability')} AS h FROM blend)
        """, "blend"),
    "risk_band_counts": sql("SELECT risk_band, COUNT(*) AS customers FROM blend GROUP BY risk_band", "blend"),
    "top_priority_customers": sql("""
        SELECT customerId, name, segment, kyc_status, preferred_channel, product_count, risk_score,
            churn_probability, composite_risk_score, risk_band, clv_score, clv_tier,
            dormancy_severity, fraud_count
        FROM blend ORDER BY composite_risk_score DESC, customerId LIMIT 50""", "blend"),
    "kpi_fraud_board": sql(f"""
        SELECT *, 100.0::DOUBLE * (flagged_today - flagged_yesterday) / flagged_yesterday AS dod_pct,
            value_today - daily_avg_value AS value_vs_avg,
            100.0::DOUBLE * false_positives / flagged_total AS false_positive_pct,
            100.0::DOUBLE * false_positives / flagged_total - 62.0::DOUBLE AS false_positive_vs_legacy_pp
        FROM (SELECT ANY_VALUE(last) AS latest_day, COUNT(*) FILTER (day = last) AS flagged_today,
                COUNT(*) FILTER (day = last - 1) AS flagged_yesterday,
                {dbl('SUM(amount) FILTER (day = last)')} AS value_today,
                {dbl('SUM(amount)')} / COUNT(DISTINCT day) AS daily_avg_value,
                COUNT(*) AS flagged_total, COUNT(*) FILTER (isFraud = 0) AS false_positives
            FROM fs, (SELECT MAX(day) AS last FROM fs)),
            (SELECT 100.0::DOUBLE * SUM(isFraud) / COUNT(*) AS fraud_rate_pct,
                100.0::DOUBLE * SUM(isFraud) FILTER (step > m) / COUNT(*) FILTER (step > m)
                - 100.0::DOUBLE * SUM(isFraud) FILTER (step <= m) / COUNT(*) FILTER (step <= m)
                    AS fraud_rate_change_pp
            FROM s, (SELECT MAX(step) / 2.0 AS m FROM s))""", "s", "fs"),
    "flagged_by_day": sql(f"""
        SELECT day, COUNT(*) AS flagged_count, {VALUE} AS value,
            COUNT(*) FILTER (isFraud = 0) AS false_positives FROM fs GROUP BY day""", "fs"),
    "flagged_by_step": sql(f"""
        SELECT step, type, COUNT(*) AS flagged_count, {VALUE} AS value FROM fs GROUP BY step, type""", "fs"),
    "flagged_by_type": sql(f"""
        SELECT type, COUNT(*) AS flagged, {FRAUD} AS confirmed, {VALUE} AS value
        FROM fs GROUP BY type""", "fs"),
    "latency_sla": sql("""
        SELECT COUNT(*) AS records, median(detectionLatencyMs) AS median_latency_ms,
            median(detectionLatencyMs) <= 2000 AS within_sla FROM fs""", "fs"),
    "fraud_batch_metric": sql(f"""
        SELECT CAST(0 AS BIGINT) AS batchId, COUNT(*) AS totalCount, COUNT(*) FILTER ({RULE}) AS flaggedCount,
            100.0::DOUBLE * COUNT(*) FILTER ({RULE}) / COUNT(*) AS fraudRatePct FROM s""", "s"),
    "kpi_compliance": sql(f"""
        SELECT {big('SUM(txn_count)')} AS total_txns,
            {dbl('SUM(CAST(total_volume AS DECIMAL(18,2)))')} AS total_volume,
            {big('SUM(fraud_count)')} AS total_fraud,
            100.0::DOUBLE * SUM(fraud_count) / SUM(txn_count) AS fraud_rate_pct,
            (SELECT COUNT(*) FROM dorm) AS dormant_accounts,
            (SELECT COUNT(*) FROM dorm WHERE dormancy_severity = 'Severely Dormant') AS severely_dormant,
            MIN(window_start_step) AS window_start_step, MAX(window_end_step) AS window_end_step
        FROM comp WHERE transaction_type IN ('TRANSFER', 'CASH_OUT', 'PAYMENT')""", "comp", "dorm"),
    "audit_table": sql("""
        SELECT transaction_type, txn_count, total_volume, avg_amount, max_amount, fraud_count,
            fraud_volume, fraud_rate_pct, system_flagged_count, risk_classification FROM comp""", "comp"),
    "fraud_rate_trend": sql("""
        SELECT *, rolling_rate_pct > 8 AS breach
        FROM (SELECT *, CAST(SUM(CAST(fraud_rate_pct AS DECIMAL(20,10))) OVER w AS DOUBLE)
                / COUNT(*) OVER w AS rolling_rate_pct
            FROM (SELECT step, CAST(SUM(txn_count) AS BIGINT) AS txn_count,
                    CAST(SUM(fraud_count) AS BIGINT) AS fraud_count,
                    100.0::DOUBLE * SUM(fraud_count) / greatest(SUM(txn_count), 1) AS fraud_rate_pct
                FROM summ GROUP BY step)
            WINDOW w AS (ORDER BY step ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))""", "summ"),
    "dormancy_tier_counts": sql(
        "SELECT dormancy_severity, COUNT(*) AS accounts FROM dorm GROUP BY dormancy_severity", "dorm"),
    "longest_dormant": sql("""
        SELECT customerId, dormancy_severity, steps_inactive, last_active_step, txn_count, total_amount
        FROM dorm ORDER BY steps_inactive DESC, customerId LIMIT 25""", "dorm"),
    "risk_tier_counts": sql("SELECT risk_tier, COUNT(*) AS customers FROM risk GROUP BY risk_tier", "risk"),
    "graph_nodes": sql(f"""
        SELECT accountId AS nodeId, 'Account' AS label, {KIND.format('accountId')} AS accountType,
            CAST(NULL AS INTEGER) AS step, CAST(NULL AS VARCHAR) AS type, CAST(NULL AS DOUBLE) AS amount,
            CAST(NULL AS INTEGER) AS isFraud FROM acc
        UNION ALL SELECT {TXN}, 'Transaction', NULL, step, type, amount::DOUBLE, isFraud FROM t""", "acc", "t"),
    "graph_edges": sql(f"""
        SELECT nameOrig AS startId, {TXN} AS endId, 'SENT' AS edgeType, amount::DOUBLE AS amount,
            step AS timestamp, type AS transactionType, CAST(NULL AS DOUBLE) AS newbalanceDest,
            CAST(NULL AS INTEGER) AS isFraud FROM t
        UNION ALL SELECT {TXN}, nameDest, 'RECEIVED_BY', NULL, NULL, NULL, newbalanceDest::DOUBLE,
            isFraud FROM t""", "t"),
    **{name: sql("""
        SELECT txn AS txnId, src, dst, amount::DOUBLE AS amount, step, type,
            newbalanceDest::DOUBLE AS newbalanceDest, isFraud FROM e""", "e")
       for name in ("graph_paths", "stored_graph_paths")},
    "graph_upsert_all": sql(f"""
        SELECT {TXN} AS txnId, step, type, (amount + isFraud)::DOUBLE AS amount, isFraud FROM t""", "t"),
    "graph_edges_valid": sql(f"""
        SELECT nameOrig AS accountId, {TXN} AS txnId, amount::DOUBLE AS amount, step AS timestamp,
            type AS transactionType FROM t
        WHERE nameOrig IN (SELECT 'C' || c_custkey FROM customer)""", "t"),
    "received_edges_valid": sql(f"""
        SELECT {TXN} AS txnId, nameDest AS accountId, newbalanceDest::DOUBLE AS newbalanceDest, isFraud FROM t
        WHERE nameDest IN (SELECT 'C' || c_custkey FROM customer)""", "t"),
    "graph_upsert": sql(f"""
        SELECT {TXN} AS txnId, step, type, (amount + CASE WHEN step % 2 = 0 THEN 1 ELSE 0 END)::DOUBLE AS amount, isFraud
        FROM t WHERE step % 3 <> 0 OR step % 2 = 0""", "t"),
    "account_degrees": sql("""
        SELECT accountId, COUNT(*) FILTER (own) AS sent, COUNT(*) FILTER (NOT own) AS received
        FROM (SELECT nameOrig AS accountId, true AS own FROM t UNION ALL SELECT nameDest, false FROM t)
        GROUP BY accountId""", "t"),
    "graph_inventory": sql(f"""
        SELECT (SELECT COUNT(*) FROM acc) AS accounts, COUNT(*) AS transactions,
            {FRAUD} AS fraudTransactions, COUNT(nameOrig) AS sentEdges, COUNT(nameDest) AS receivedEdges,
            COUNT(nameOrig) + COUNT(nameDest) AS totalEdges FROM t""", "t", "acc"),
    "money_mules": sql("""
        SELECT * FROM mules ORDER BY fraudulentInbound DESC, distinctSenders DESC, muleAccount
        LIMIT 20""", "mules"),
    "fraud_rings": sql(
        "SELECT * FROM rings ORDER BY sharedSenderCount DESC, mule1, mule2 LIMIT 15", "rings"),
    "fraud_rings_all": sql("SELECT * FROM rings", "rings"),
    "top_fraud_paths": sql(f"""
        SELECT src AS fromAccount, txn AS transaction, type AS transactionType, amount::DOUBLE AS amount,
            step, dst AS toAccount, {KIND.format('dst')} AS destType
        FROM e WHERE isFraud = 1 ORDER BY e.amount DESC, txn LIMIT 20""", "e"),
    "layering_accounts": sql("""
        SELECT * FROM layers ORDER BY inboundSources DESC, onwardTargets DESC, layeringAccount
        LIMIT 15""", "layers"),
    "layering_accounts_all": sql("SELECT * FROM layers", "layers"),
    "churn_windows": sql("SELECT * EXCLUDE (cashOutOnly) FROM win", "win"),
    "churn_alerts": sql("""
        SELECT customerId, windowStart, windowEnd, array_to_string(fired, '|') AS signals,
            CAST(len(fired) AS INTEGER) AS signalCount, txnCount, windowAvgAmount, baselineAvgAmount,
            baselineFreqPer12, lowBalanceEvents, cashOutOnly FROM sig WHERE len(fired) >= 2""", "sig"),
    "churn_signal_counts": sql("""
        SELECT signal, COUNT(*) AS windows FROM (SELECT unnest(fired) AS signal FROM sig)
        GROUP BY signal""", "sig"),
    "dq_segment_mix": sql(f"""
        SELECT segment, COUNT(*) AS customers, (SELECT COUNT(*) // 5 FROM c) AS expected,
            {score_mean('risk_score')} AS avg_risk, {score_mean('churn_probability')} AS avg_churn,
            COUNT(*) = (SELECT COUNT(*) // 5 FROM c) AS matches FROM c GROUP BY segment""", "c"),
    "dq_unique_keys": sql(f"""
        SELECT dataset, key, {big('SUM(n)')} AS rows, COUNT(v) AS distinct_keys,
            COUNT(*) FILTER (n > 1) AS duplicated_keys, {big('COALESCE(SUM(n) FILTER (v IS NULL), 0)')} AS null_keys
        FROM (SELECT dataset, key, v, COUNT(*) AS n FROM (
            SELECT 'customers' AS dataset, 'customerId' AS key, customerId AS v FROM c
            UNION ALL SELECT 'edges', 'edge', 'SENT|' || nameOrig || '|' || {TXN} FROM t
            UNION ALL SELECT 'edges', 'edge', 'RECEIVED_BY|' || {TXN} || '|' || nameDest FROM t
            UNION ALL SELECT 'transactions', 'txnId', {TXN} FROM t
            UNION ALL SELECT 'stream', 'nameOrig', nameOrig FROM s) GROUP BY dataset, key, v)
        GROUP BY dataset, key""", "c", "t", "s"),
    "dq_orphans": sql("""
        SELECT customerId AS accountId FROM c
        EXCEPT (SELECT nameOrig FROM t UNION SELECT nameDest FROM t)""", "c", "t"),
    "dq_mule_floor": sql("""
        SELECT 'graph' AS dataset, 'mule accounts' AS "check", COUNT(*)::DOUBLE AS actual,
            5.0::DOUBLE AS expected, CASE WHEN COUNT(*) >= 5 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM mules""", "mules"),
}


def _checks() -> str:
    """The 35 checks as (dataset, check, actual, expected, tolerance or floor) rows."""
    flag = "(SELECT CAST(bool_and({}) AS INTEGER) FROM {})"
    one = "(SELECT {} FROM {})"
    rows = [
        ("transactions", "transaction count", one.format("COUNT(*)", "t"), one.format("SUM(txn_volume)", "daily"), 0),
        ("transactions", "distinct accounts", one.format("COUNT(*)", "acc"), one.format("COUNT(*)", "acc"), 0),
        ("transactions", "confirmed fraud", one.format("SUM(isFraud)", "t"), one.format("SUM(fraud_count)", "daily"), 0),
        ("transactions", "total volume", one.format("SUM(amount)", "t"),
         one.format("SUM(CAST(total_amount AS DECIMAL(28,2)))", "daily"), 0.01),
        ("transactions", "fraud rate pct", one.format("100.0::DOUBLE * SUM(isFraud) / COUNT(*)", "t"),
         one.format("100.0::DOUBLE * SUM(fraud_count) / SUM(txn_volume)", "daily"), 0.05),
        ("transactions", "max step", one.format("MAX(step)", "t"), one.format("MAX(step)", "daily"), 0),
        ("graph", "account nodes", one.format("COUNT(*)", "acc"), one.format("COUNT(*)", "acc"), 0),
        ("graph", "transaction nodes", one.format("COUNT(*)", "t"), one.format("COUNT(*)", "t"), 0),
        ("graph", "relationship edges", one.format("COUNT(nameOrig) + COUNT(nameDest)", "t"),
         one.format("2 * COUNT(*)", "t"), 0),
        ("graph", "mule accounts", one.format("COUNT(*)", "mules"), "5", None),
        ("customers", "customer documents", one.format("COUNT(*)", "c"), one.format("COUNT(*)", "customer"), 0),
        ("customers", "distinct segments", one.format("COUNT(DISTINCT segment)", "c"), "5", 0),
        ("customers", "verified share",
         one.format("CAST(COUNT(*) FILTER (kyc_status = 'verified') AS DOUBLE) / COUNT(*)", "c"), "0.92", 0.005),
        ("customers", "avg risk score", one.format(score_mean("risk_score"), "c"), "0.495", 0.005),
        ("customers", "avg churn probability", one.format(score_mean("churn_probability"), "c"), "0.495", 0.005),
        ("customers", "avg products held", one.format("CAST(SUM(len(products)) AS DOUBLE) / COUNT(*)", "c"), "2.5", 0.005),
    ]
    for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"):
        share = one.format(f"CAST(COUNT(*) FILTER (segment = '{s}') AS DOUBLE) / COUNT(*)", "c")
        rows.append(("customers", f"segment share: {s}", share, "0.2", 0.02))
    rows += [
        ("dormancy", "dormant accounts", one.format("COUNT(*)", "dorm"),
         one.format("COUNT(*) FILTER (is_dormant)", "blend"), 0),
        ("dormancy", "severely dormant", one.format("COUNT(*) FILTER (steps_inactive > 120)", "dorm"),
         one.format("COUNT(*) FILTER (dormancy_severity = 'Severely Dormant')", "blend"), 0),
        ("dormancy", "min transaction history", one.format("MIN(txn_count)", "dorm"), "5", None),
        ("dormancy", "customer accounts only", flag.format("customerId LIKE 'C%'", "dorm"), "1", 0),
        ("compliance", "transaction types covered", one.format("COUNT(*)", "comp"), "5", 0),
        ("compliance", "compliance volume", one.format("SUM(CAST(total_volume AS DECIMAL(28,2)))", "comp"),
         one.format("SUM(amount)", "t, mx WHERE step > ws AND step <= mx"), 1),
        ("compliance", "compliance fraud", one.format("SUM(fraud_count)", "comp"),
         one.format("SUM(isFraud)", "t, mx WHERE step > ws AND step <= mx"), 0),
        ("flagged", "flagged types", flag.format("type IN ('TRANSFER', 'CASH_OUT')", "fs"), "1", 0),
        ("flagged", "flagged amounts", flag.format("amount > 200000", "fs"), "1", 0),
        ("flagged", "flagged balances", flag.format("newbalanceDest = 0", "fs"), "1", 0),
        ("blend", "blend row count", one.format("COUNT(*)", "blend"), one.format("COUNT(*)", "c"), 0),
        ("blend", "composite formula", one.format(
            "MAX(abs(composite_risk_score - "
            + rounded("fraud_rate_pct * 0.6::DOUBLE + churn_probability * 0.4::DOUBLE", 4) + "))", "blend"), "0", 1e-6),
        ("summary", "steps in range", flag.format("step BETWEEN 1 AND 168", "summ"), "1", 0),
        ("summary", "summary fraud", one.format("SUM(fraud_count)", "summ"),
         one.format("SUM(isFraud)", "t WHERE step BETWEEN 1 AND 168"), 0),
    ]
    selects = []
    for dataset, check, actual, expected, tolerance in rows:
        a, e = dbl(actual), dbl(expected)
        met = f"{a} >= {e}" if tolerance is None else f"abs({a} - {e}) <= {tolerance}"
        selects.append(
            f"SELECT '{dataset}' AS dataset, '{check}' AS \"check\", {a} AS actual, {e} AS expected, "
            f"CASE WHEN {a} IS NULL OR {e} IS NULL THEN 'SKIP' WHEN {met} THEN 'PASS' ELSE 'FAIL' END AS status"
        )
    return "\nUNION ALL ".join(selects)


ORACLE["dq_gated"] = ORACLE["dq_expectations"] = sql(
    _checks(), "t", "daily", "acc", "mules", "c", "dorm", "blend", "comp", "mx", "fs", "summ"
)
