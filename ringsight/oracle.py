"""The same results in plain SQL, written from the definitions: self joins for windows, all pairs for links and correlations,
a recursive closure for components. Small data only; it is the yardstick, not the engine."""

from __future__ import annotations

# name -> (tables it reads, text)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "accounts": (
        (),
        """
    SELECT 'a' || user_id AS account_id,
      TIMESTAMP '2023-01-01' + to_minutes(CAST(
        CASE WHEN user_id % 25 < 5 THEN (user_id // 5) * 7919 % 525600 + (user_id % 5) * 11
             ELSE user_id * 104729 % 525600 END AS INT)) AS created_at,
      CASE WHEN user_id % 25 < 5 THEN user_id % 5 = 0 ELSE user_id % 10 <> 9 END AS kyc_verified,
      CASE WHEN user_id % 25 < 5 THEN 'dr' || (user_id // 5)
           WHEN user_id % 25 BETWEEN 10 AND 12 THEN 'df' || (user_id // 25)
           ELSE 'd' || user_id END AS registration_device_id,
      CASE WHEN user_id % 25 < 5 THEN '10.1.' || ((user_id // 5) % 256) || '.' || (user_id % 5)
           WHEN user_id % 25 BETWEEN 10 AND 12 THEN '10.2.' || ((user_id // 25) % 256) || '.7'
           ELSE '10.' || (3 + user_id // 256) || '.' || (user_id % 256) || '.9' END AS registration_ip,
      CAST(30 + user_id % 40 AS DOUBLE) AS historical_avg_amount,
      user_id % 25 < 5 AS label_ring_member,
      CASE WHEN user_id % 25 < 5 THEN 'ring_' || (user_id // 25) END AS ring_id,
      user_id % 25 BETWEEN 10 AND 12 AS is_ambiguous
    FROM (SELECT DISTINCT user_id FROM events)""",
    ),
    "transactions": (
        ("accounts",),
        """
    SELECT 't' || (event_id * 100 + i) AS txn_id, a.account_id,
      ts + to_seconds(i * 5) AS "timestamp",
      CASE WHEN event_type = 'error' AND k < 5 THEN least(value, 5.0) ELSE value END AS amount,
      'm' || (k // 2) AS merchant_id, event_type AS merchant_category,
      CASE WHEN event_type = 'error' AND k < 5 THEN 'pt' || event_id
           WHEN a.label_ring_member AND k < 30 THEN 'pr' || (user_id // 5)
           ELSE 'p' || user_id || '_' || (k % 3) END AS payment_instrument_id,
      CASE WHEN k >= 90 THEN 'dn' || event_id ELSE a.registration_device_id END AS device_id,
      CASE WHEN k >= 90 THEN '172.' || (event_id % 256) || '.' || (event_id // 256 % 256) || '.1'
           ELSE a.registration_ip END AS ip_address,
      CASE WHEN k >= 90 THEN 'city' || k ELSE 'city' || (user_id % 40) END AS geo_location,
      CASE WHEN event_type = 'error' THEN 'failed'
           WHEN event_type = 'purchase' AND k < 20 THEN 'refunded'
           WHEN event_type = 'purchase' AND k < 25 THEN 'disputed' ELSE 'success' END AS status,
      (event_type = 'error' AND k < 5) OR (k >= 90 AND value > 120)
        OR (a.label_ring_member AND k < 10) AS label_fraud
    FROM (SELECT e.*, unnest(range(CASE WHEN event_type = 'error' AND k < 5 THEN 8 ELSE 1 END)) AS i
          FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events) e) x
    JOIN accounts a ON a.account_id = 'a' || x.user_id""",
    ),
    "t": (("transactions",), """SELECT *, epoch_us("timestamp") AS us FROM transactions"""),
    # every row with every row of its account up to itself
    "counted": (
        ("t",),
        """
    SELECT a.txn_id,
      count(*) FILTER (b.us > a.us - 60000000) AS velocity_1min,
      count(*) FILTER (b.us > a.us - 3600000000) AS velocity_1hr,
      count(*) FILTER (b.us > a.us - 86400000000) AS velocity_24hr,
      count(*) - 1 AS before,
      count(*) FILTER (b.merchant_category = a.merchant_category) AS category_seen,
      count(*) FILTER (hour(b."timestamp") = hour(a."timestamp")) - 1 AS same_hour,
      count(*) FILTER (b.geo_location = a.geo_location AND b.device_id = a.device_id) AS pair_seen,
      min(b.amount) FILTER (b.txn_id <> a.txn_id) AS low, max(b.amount) FILTER (b.txn_id <> a.txn_id) AS high,
      stddev_samp(b.amount) FILTER (b.txn_id <> a.txn_id) AS sd
    FROM t a JOIN t b ON a.account_id = b.account_id AND (b.us < a.us OR (b.us = a.us AND b.txn_id <= a.txn_id))
    GROUP BY a.txn_id""",
    ),
    "retried": (
        ("t",),
        """
    SELECT txn_id, account_id, us, coalesce(status0 = 'failed' AND us - us0 <= 300000000, false) AS retry
    FROM (SELECT *, lag(status) OVER w AS status0, lag(us) OVER w AS us0
          FROM t WINDOW w AS (PARTITION BY account_id ORDER BY us, txn_id))""",
    ),
    "retries": (
        ("retried",),
        """
    SELECT a.txn_id, count(*) FILTER (b.retry) AS n
    FROM retried a JOIN retried b ON a.account_id = b.account_id AND b.us > a.us - 86400000000
      AND (b.us < a.us OR (b.us = a.us AND b.txn_id <= a.txn_id))
    GROUP BY a.txn_id""",
    ),
    # the usual pair at a row: of the pairs seen so far, the one whose count was first to reach the highest count
    "usual": (
        ("t", "counted"),
        """
    SELECT a.txn_id, arg_min(b.pair, (-b.pair_seen, b.us, b.txn_id)) AS pair
    FROM t a JOIN (SELECT t.account_id, t.us, t.txn_id, c.pair_seen, (t.geo_location, t.device_id)::VARCHAR AS pair
                   FROM t JOIN counted c USING (txn_id)) b
      ON a.account_id = b.account_id AND (b.us < a.us OR (b.us = a.us AND b.txn_id <= a.txn_id))
    GROUP BY a.txn_id""",
    ),
    "features": (
        ("t", "accounts", "counted", "retries", "usual"),
        """
    SELECT t.*, c.velocity_1min::DOUBLE AS velocity_1min, c.velocity_1hr::DOUBLE AS velocity_1hr,
      c.velocity_24hr::DOUBLE AS velocity_24hr,
      (t.amount - a.historical_avg_amount) / CASE WHEN c.before < 2 OR c.low = c.high THEN 1.0 ELSE c.sd END AS amount_zscore,
      c.category_seen = 1 AS is_new_merchant_category,
      u.pair = (t.geo_location, t.device_id)::VARCHAR AS geo_device_consistency,
      CASE WHEN c.before = 0 THEN false ELSE c.same_hour / c.before < 0.05 END AS is_unusual_hour,
      r.n / c.velocity_24hr AS failure_retry_ratio
    FROM t LEFT JOIN accounts a USING (account_id) JOIN counted c USING (txn_id) JOIN retries r USING (txn_id)
    JOIN usual u USING (txn_id)""",
    ),
    "ruled": (
        ("features",),
        """
    SELECT *, CASE WHEN card_testing_flag = 1 THEN 1.0
                   ELSE least(1.0, 0.8 * high_deviation_flag + 0.6 * odd_hour_new_category_flag) END::DOUBLE AS rule_score,
      list_filter([CASE WHEN card_testing_flag = 1 THEN 'card_testing_flag' END,
                   CASE WHEN high_deviation_flag = 1 THEN 'high_deviation_flag' END,
                   CASE WHEN odd_hour_new_category_flag = 1 THEN 'odd_hour_new_category_flag' END],
                  lambda x: x IS NOT NULL) AS triggered_rules
    FROM (SELECT *, (velocity_1min > 5 AND amount < 50)::BIGINT AS card_testing_flag,
            coalesce(amount_zscore > 4 AND NOT geo_device_consistency, false)::BIGINT AS high_deviation_flag,
            (is_unusual_hour AND is_new_merchant_category)::BIGINT AS odd_hour_new_category_flag FROM features)""",
    ),
    # of every label the fifth with the least hashes
    "held": (
        ("t",),
        """
    SELECT *, row_number() OVER (PARTITION BY label_fraud ORDER BY md5(txn_id))
                <= (count(*) OVER (PARTITION BY label_fraud) * 20 + 50) // 100 AS held_out FROM t""",
    ),
    "long_inputs": (
        ("ruled",),
        """
    SELECT txn_id, place, feature, value FROM (
      SELECT txn_id, unnest([0,1,2,3,4,5,6,7,8,9,10]) AS place,
        unnest(['velocity_1min','velocity_1hr','velocity_24hr','amount_zscore','is_new_merchant_category',
                'geo_device_consistency','is_unusual_hour','failure_retry_ratio',
                'card_testing_flag','high_deviation_flag','odd_hour_new_category_flag']) AS feature,
        unnest([velocity_1min, velocity_1hr, velocity_24hr, amount_zscore, is_new_merchant_category::INT::DOUBLE,
                geo_device_consistency::INT::DOUBLE, is_unusual_hour::INT::DOUBLE, failure_retry_ratio,
                card_testing_flag::DOUBLE, high_deviation_flag::DOUBLE, odd_hour_new_category_flag::DOUBLE]) AS value
      FROM ruled)""",
    ),
    "pulls": (
        ("long_inputs",),
        """
    SELECT i.*, (place + 1) / 66 * abs((value - m) / CASE WHEN s = 0 OR s IS NULL THEN 1.0 ELSE s END) AS pull
    FROM long_inputs i JOIN (SELECT feature, avg(value) AS m, stddev_samp(value) AS s FROM long_inputs GROUP BY feature)
    USING (feature)""",
    ),
    "tops": (
        ("pulls",),
        """
    SELECT txn_id, rk - 1 AS place, feature, value,
      CASE WHEN pull > 0.5 THEN 'high' WHEN pull > 0.1 THEN 'medium' ELSE 'low' END AS contribution
    FROM (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY pull DESC, place DESC) AS rk FROM pulls) WHERE rk <= 2""",
    ),
    "layer1": (
        ("ruled",),
        """
    SELECT txn_id, account_id, label_fraud, us, triggered_rules,
      round(CASE WHEN rule_score >= 1 THEN greatest(0.9, p) ELSE 0.4 * rule_score + 0.6 * p END, 4)::DOUBLE AS layer1_score
    FROM (SELECT *, (('0x' || substr(md5(txn_id), 9, 4))::BIGINT % 1001 / 1000)::DOUBLE AS p FROM ruled)""",
    ),
    "member": (
        ("accounts", "t"),
        """
    SELECT origin, kind, v, account_id, us FROM (
      SELECT 'registration' AS origin, 'device' AS kind, registration_device_id AS v, account_id, epoch_us(created_at) AS us FROM accounts
      UNION ALL SELECT 'registration', 'subnet', registration_ip, account_id, epoch_us(created_at) FROM accounts
      UNION ALL SELECT 'transaction', 'device', device_id, account_id, us FROM t
      UNION ALL SELECT 'transaction', 'subnet', ip_address, account_id, us FROM t
      UNION ALL SELECT 'transaction', 'payment_instrument', payment_instrument_id, account_id, us FROM t)""",
    ),
    "grouped": (
        ("member",),
        """
    SELECT DISTINCT origin, kind, v2 AS v, account_id, max(us) OVER (PARTITION BY origin, kind, v2) AS us
    FROM (SELECT *, CASE WHEN kind = 'subnet' AND len(string_split(v, '.')) = 4
                         THEN array_to_string(string_split(v, '.')[1:3], '.') || '.0/24' ELSE v END AS v2 FROM member)""",
    ),
    "id_pairs": (
        ("grouped",),
        """
    SELECT a.account_id AS src, b.account_id AS dst, a.origin, a.kind, max(a.us) AS us
    FROM grouped a JOIN grouped b ON a.origin = b.origin AND a.kind = b.kind AND a.v = b.v AND a.account_id < b.account_id
    GROUP BY ALL""",
    ),
    "near_pairs": (
        ("accounts",),
        """
    SELECT a.account_id AS src, b.account_id AS dst, greatest(epoch_us(a.created_at), epoch_us(b.created_at)) AS us
    FROM accounts a JOIN accounts b ON a.account_id < b.account_id
      AND abs(epoch_us(a.created_at) - epoch_us(b.created_at)) <= 21600000000""",
    ),
    "latest": (
        ("accounts", "t"),
        "SELECT max(us) AS now FROM (SELECT us FROM t UNION ALL SELECT epoch_us(created_at) FROM accounts)",
    ),
    "edges": (
        ("id_pairs", "near_pairs", "latest"),
        """
    SELECT src, dst, kinds AS shared_types,
      1.0 * list_contains(kinds, 'device')::INT + 1.0 * list_contains(kinds, 'payment_instrument')::INT
        + 1.0 * list_contains(kinds, 'subnet')::INT + 0.1 * list_contains(kinds, 'reg_proximity')::INT
        + greatest(0.0, 0.5 * (1 - greatest(0, now - us) / 86400000000.0 / 30)) AS weight
    FROM (SELECT src, dst, list_sort(list(DISTINCT kind)) AS kinds, max(us) AS us
          FROM (SELECT src, dst, kind, us FROM id_pairs UNION ALL SELECT src, dst, 'reg_proximity', us FROM near_pairs)
          GROUP BY src, dst), latest""",
    ),
    "neighbours": (("edges",), "SELECT src AS a, dst AS b FROM edges UNION ALL SELECT dst, src FROM edges"),
    "reach": (
        ("accounts", "neighbours"),
        "SELECT account_id AS a, account_id AS b FROM accounts UNION SELECT r.a, e.b FROM reach r JOIN neighbours e ON r.b = e.a",
    ),
    "mapping": (("reach",), "SELECT a AS account_id, min(b) AS cluster_id FROM reach GROUP BY a"),
    "summary": (
        ("mapping", "edges"),
        """
    SELECT cluster_id, size, members, coalesce(kinds, []) AS shared_types
    FROM (SELECT cluster_id, count(*) AS size, list_sort(list(account_id)) AS members FROM mapping GROUP BY cluster_id)
    LEFT JOIN (SELECT cluster_id, list_sort(list(DISTINCT kind)) AS kinds
               FROM (SELECT m.cluster_id, unnest(e.shared_types) AS kind FROM edges e JOIN mapping m ON e.src = m.account_id
                     JOIN mapping n ON e.dst = n.account_id AND m.cluster_id = n.cluster_id) GROUP BY cluster_id)
    USING (cluster_id)""",
    ),
    "age": (
        ("mapping", "accounts"),
        """
    SELECT cluster_id, coalesce(exp(-stddev_samp(epoch_us(created_at) / 3600000000.0) / 12), 0) AS age_homogeneity,
      1 - avg(kyc_verified::INT) AS kyc_lack
    FROM mapping JOIN accounts USING (account_id) GROUP BY cluster_id""",
    ),
    "hourly": (
        ("mapping", "t"),
        """
    SELECT m.cluster_id, t.account_id, date_trunc('hour', t."timestamp") AS h, count(*) AS n
    FROM t JOIN mapping m USING (account_id) GROUP BY ALL""",
    ),
    # members by active hours with zeros filled in, then the correlation of every two members
    "grid": (
        ("hourly", "mapping"),
        """
    SELECT g.cluster_id, g.h, m.account_id, coalesce(x.n, 0) AS n
    FROM (SELECT DISTINCT cluster_id, h FROM hourly) g JOIN mapping m USING (cluster_id)
    LEFT JOIN hourly x ON x.account_id = m.account_id AND x.h = g.h""",
    ),
    "sync": (
        ("grid",),
        """
    SELECT cluster_id, greatest(0, least(1, avg(r))) AS synchrony
    FROM (SELECT a.cluster_id, a.account_id, b.account_id, corr(a.n, b.n) AS r
          FROM grid a JOIN grid b ON a.cluster_id = b.cluster_id AND a.h = b.h AND a.account_id < b.account_id
          GROUP BY ALL HAVING min(a.n) < max(a.n) AND min(b.n) < max(b.n))
    GROUP BY cluster_id""",
    ),
    "money": (
        ("mapping", "t"),
        """
    SELECT cluster_id, greatest(0, least(1, (rate / CASE WHEN base = 0 THEN 0.01 ELSE base END - 1) / 4)) AS financial_behavior
    FROM (SELECT cluster_id, avg((status IN ('failed', 'refunded', 'disputed'))::INT) AS rate
          FROM t JOIN mapping USING (account_id) GROUP BY cluster_id),
         (SELECT avg((status IN ('failed', 'refunded', 'disputed'))::INT) AS base FROM t)""",
    ),
    "scored": (
        ("summary", "age", "sync", "money"),
        """
    SELECT *, round(0.2 * age_homogeneity + 0.3 * synchrony + 0.2 * identifier_density + 0.15 * kyc_lack
                    + 0.15 * financial_behavior, 4) AS ring_score,
      list_filter([CASE WHEN age_homogeneity > 0.8 THEN 'synchronized_registration' END,
                   CASE WHEN synchrony > 0.7 THEN 'high_behavioral_synchrony' END,
                   CASE WHEN identifier_density > 0.7 THEN 'dense_identifier_sharing' END,
                   CASE WHEN kyc_lack > 0.8 THEN 'low_kyc_verification' END,
                   CASE WHEN financial_behavior > 0.8 THEN 'concentrated_refund_activity' END],
                  lambda x: x IS NOT NULL) AS flags
    FROM (SELECT cluster_id, size, members, shared_types, age_homogeneity, kyc_lack,
            coalesce(synchrony, 0)::DOUBLE AS synchrony, coalesce(financial_behavior, 0)::DOUBLE AS financial_behavior,
            least(1.0, len(shared_types) / 4) AS identifier_density
          FROM summary LEFT JOIN age USING (cluster_id) LEFT JOIN sync USING (cluster_id) LEFT JOIN money USING (cluster_id))""",
    ),
    "fused": (
        ("layer1", "mapping", "scored"),
        """
    SELECT *, CASE WHEN final_score >= 0.5 THEN 'flag_for_review' ELSE 'log_only' END AS action
    FROM (SELECT l.*, m.cluster_id AS ring_membership, s.ring_score, s.size, s.shared_types, s.flags,
            greatest(l.layer1_score, coalesce(s.ring_score, 0)) AS final_score
          FROM layer1 l LEFT JOIN mapping m USING (account_id) LEFT JOIN scored s USING (cluster_id))""",
    ),
    "log": (
        ("fused", "tops"),
        """
    SELECT *, CASE WHEN coalesce(ring_score, 0) >= layer1_score AND size IS NOT NULL THEN
        'Transaction ' || verb || ': account belongs to ' || ring_membership || ' (' || size || ' accounts sharing '
        || CASE WHEN len(shared_types) > 0 THEN array_to_string(shared_types, ', ') ELSE 'weak proximity signals' END || '; '
        || CASE WHEN len(flags) > 0 THEN array_to_string(flags, ', ') ELSE 'general suspicious synchrony' END || ').'
      ELSE own END AS explanation
    FROM (SELECT f.*, verb, 'Transaction ' || verb || ': '
            || CASE WHEN len(triggered_rules) > 0 THEN 'Triggered hard rules (' || array_to_string(triggered_rules, ', ') || ')'
                    ELSE 'Suspicious behavior detected by ML model' END
            || '. Top contributing features were ' || said || '.' AS own
          FROM fused f JOIN (SELECT txn_id, string_agg(feature || ' (' || contribution || ')', ', ' ORDER BY place) AS said
                             FROM tops GROUP BY txn_id) USING (txn_id)
          JOIN (VALUES ('flag_for_review', 'flagged for review'), ('log_only', 'logged')) v(action, verb) USING (action))""",
    ),
    "recovered": (
        ("accounts", "mapping", "scored"),
        """
    SELECT ring_id, members, found, clusters,
      CASE WHEN found = members AND clusters = 1 THEN 'full' WHEN found > 0 THEN 'partial' ELSE 'missed' END AS outcome
    FROM (SELECT ring_id, count(*) AS members, count(*) FILTER (ring_score >= 0.5) AS found,
            count(DISTINCT cluster_id) FILTER (ring_score >= 0.5) AS clusters
          FROM accounts JOIN mapping USING (account_id) JOIN scored USING (cluster_id)
          WHERE label_ring_member GROUP BY ring_id)""",
    ),
    "tiers": (
        ("log",),
        """
    SELECT tier, CASE WHEN flagged = 0 THEN 0 ELSE tp / flagged END AS precision,
      CASE WHEN frauds = 0 THEN 0 ELSE tp / frauds END AS recall,
      CASE WHEN flagged + frauds = 0 THEN 0 ELSE 2 * tp / (flagged + frauds) END AS f1
    FROM (SELECT tier, count(*) FILTER (layer1_score >= cut AND label_fraud) AS tp,
            count(*) FILTER (layer1_score >= cut) AS flagged, count(*) FILTER (label_fraud) AS frauds
          FROM log, (VALUES ('block', 0.85), ('review', 0.5)) v(tier, cut) GROUP BY tier)""",
    ),
    "auc": (
        ("log",),
        """
    SELECT (sum(rk) FILTER (label_fraud) - p * (p + 1) / 2) / (p * n) AS roc_auc
    FROM (SELECT label_fraud, rank() OVER (ORDER BY layer1_score) + (count(*) OVER (PARTITION BY layer1_score) - 1) / 2 AS rk FROM log),
         (SELECT count(*) FILTER (label_fraud) AS p, count(*) FILTER (NOT label_fraud) AS n FROM log) GROUP BY p, n""",
    ),
    "friction": (
        ("log", "accounts"),
        """
    SELECT count(*) AS legit_rows, count(*) FILTER (final_score >= 0.5) AS flagged_rows,
      CASE WHEN count(*) = 0 THEN 0 ELSE count(*) FILTER (final_score >= 0.5) / count(*) * 100 END AS friction_percent
    FROM log JOIN accounts USING (account_id) WHERE is_ambiguous AND NOT label_fraud""",
    ),
}

_LOG = """txn_id, layer1_score, array_to_string(triggered_rules, ',') AS layer1_triggers, ring_membership, ring_score,
  final_score, action AS action_taken, explanation"""
_LOG_ROWS = (("log",), f"SELECT {_LOG} FROM log")
_TOTALS = (("fused",), "SELECT action AS action_taken, count(*) AS decisions FROM fused GROUP BY action")
_BINS = (("layer1",), "SELECT least(floor(layer1_score * 50), 49)::BIGINT AS bin, count(*) AS decisions FROM layer1 GROUP BY ALL")
_MINUTES = (
    ("fused",),
    "SELECT us // 60000000 * 60000000 AS minute_us, action AS action_taken, count(*) AS decisions FROM fused GROUP BY ALL",
)
_CLUSTERS = """SELECT cluster_id, size, ring_score, array_to_string(flags, ',') AS flags FROM scored"""
_LOOKUP = (("mapping", "scored"), "SELECT account_id, cluster_id AS ring_membership, ring_score FROM mapping JOIN scored USING (cluster_id)")
_UPLIFT = (
    ("log",),
    """SELECT count(*) FILTER (label_fraud) AS total_fraud_test_set,
  count(*) FILTER (label_fraud AND layer1_score >= 0.5) AS caught_layer1,
  count(*) FILTER (label_fraud AND layer1_score < 0.5 AND final_score >= 0.5) AS caught_layer2_only,
  count(*) FILTER (NOT label_fraud AND layer1_score < 0.5 AND final_score >= 0.5) AS false_positives_layer2 FROM log""",
)


def _id_pairs(origin: str, kind: str):
    return (("id_pairs",), f"SELECT src, dst, max(us) AS us FROM id_pairs WHERE origin = '{origin}' AND kind = '{kind}' GROUP BY ALL")


def _layer2_text(verb: str) -> str:
    return f"""'Transaction {verb}: account belongs to ' || cluster_id || ' (' || size || ' accounts sharing '
  || CASE WHEN len(shared_types) > 0 THEN array_to_string(shared_types, ', ') ELSE 'weak proximity signals' END || '; '
  || CASE WHEN len(flags) > 0 THEN array_to_string(flags, ', ') ELSE 'general suspicious synchrony' END || ').'"""


QUERIES: dict[str, tuple[tuple[str, ...], str]] = {
    "accounts_table": (("accounts",), "SELECT * EXCLUDE (created_at), epoch_us(created_at) AS created_us FROM accounts"),
    "transactions_table": (("t",), 'SELECT * EXCLUDE ("timestamp") FROM t'),
    "audit_log_table": _LOG_ROWS,
    "cluster_table": (
        ("scored",),
        """SELECT cluster_id, size, array_to_string(members, ',') AS member_accounts, ring_score,
  array_to_string(shared_types, ',') AS shared_signals, array_to_string(flags, ',') AS flags FROM scored""",
    ),
    "metrics_table": _UPLIFT,
    "used_columns": (("t",), "SELECT account_id, device_id, ip_address, payment_instrument_id FROM t"),
    "subnets": (
        ("accounts", "t"),
        """SELECT ip, CASE WHEN len(string_split(ip, '.')) = 4 THEN array_to_string(string_split(ip, '.')[1:3], '.') || '.0/24'
  ELSE ip END AS subnet FROM (SELECT registration_ip AS ip FROM accounts UNION SELECT ip_address FROM t)""",
    ),
    "transaction_hours": (
        ("t",),
        """SELECT txn_id, hour("timestamp") AS hour_of_day, epoch_us(date_trunc('hour', "timestamp")) AS hour_bin_us FROM t""",
    ),
    "account_age_days": (
        ("accounts", "latest"),
        "SELECT account_id, round(greatest(0, now - epoch_us(created_at)) / 86400000000.0, 6) AS age_days FROM accounts, latest",
    ),
    "geo_device_pairs": (("t",), "SELECT geo_location, device_id, count(*) AS n FROM t GROUP BY ALL"),
    "bad_outcomes": (
        ("t",),
        "SELECT status, status IN ('failed', 'refunded', 'disputed') AS is_bad, count(*) AS n FROM t GROUP BY ALL",
    ),
    "transactions_of_flagged_clusters": (
        ("t", "mapping", "scored"),
        """SELECT txn_id, account_id, status FROM t WHERE account_id IN
  (SELECT account_id FROM mapping JOIN scored USING (cluster_id) WHERE ring_score >= 0.5)""",
    ),
    "account_averages": (("t", "accounts"), "SELECT txn_id, historical_avg_amount FROM t LEFT JOIN accounts USING (account_id)"),
    "velocity": (("features",), "SELECT txn_id, velocity_1min, velocity_1hr, velocity_24hr FROM features"),
    "amount_zscore": (("features",), "SELECT txn_id, round(amount_zscore, 6) AS amount_zscore FROM features"),
    "new_merchant_category": (("features",), "SELECT txn_id, is_new_merchant_category FROM features"),
    "geo_device_consistency": (("features",), "SELECT txn_id, geo_device_consistency FROM features"),
    "unusual_hour": (("features",), "SELECT txn_id, is_unusual_hour FROM features"),
    "failure_retry_ratio": (("features",), "SELECT txn_id, round(failure_retry_ratio, 6) AS failure_retry_ratio FROM features"),
    "card_testing": (("ruled",), "SELECT txn_id, account_id, amount FROM ruled WHERE card_testing_flag = 1"),
    "high_deviation": (("ruled",), "SELECT txn_id, account_id, amount FROM ruled WHERE high_deviation_flag = 1"),
    "odd_hour_new_category": (("ruled",), "SELECT txn_id, account_id, amount FROM ruled WHERE odd_hour_new_category_flag = 1"),
    "rule_scores": (
        ("ruled",),
        "SELECT txn_id, round(rule_score, 6) AS rule_score, array_to_string(triggered_rules, ',') AS triggered_rules FROM ruled",
    ),
    "rule_flags": (("ruled",), "SELECT txn_id, card_testing_flag, high_deviation_flag, odd_hour_new_category_flag FROM ruled"),
    "model_inputs": (
        ("ruled",),
        """SELECT txn_id, velocity_1min, velocity_1hr, velocity_24hr, round(amount_zscore, 6) AS amount_zscore,
  is_new_merchant_category::INT::DOUBLE AS is_new_merchant_category, geo_device_consistency::INT::DOUBLE AS geo_device_consistency,
  is_unusual_hour::INT::DOUBLE AS is_unusual_hour, round(failure_retry_ratio, 6) AS failure_retry_ratio,
  card_testing_flag::DOUBLE AS card_testing_flag, high_deviation_flag::DOUBLE AS high_deviation_flag,
  odd_hour_new_category_flag::DOUBLE AS odd_hour_new_category_flag, label_fraud::INT::DOUBLE AS label FROM ruled""",
    ),
    "holdout_split": (
        ("held",),
        """SELECT held_out, label_fraud, count(*) AS n, sum(('0x' || substr(md5(txn_id), 1, 8))::UBIGINT)::BIGINT AS id_sum
  FROM held GROUP BY ALL""",
    ),
    "model_checks": (
        ("held",),
        "SELECT label_fraud, count(*) AS n, TRUE AS within_range, TRUE AS same_when_loaded FROM held WHERE held_out GROUP BY ALL",
    ),
    "model_quality": (
        ("held",),
        "SELECT count(*) AS held_out_rows, count(*) FILTER (label_fraud) AS frauds, TRUE AS auc_reached FROM held WHERE held_out",
    ),
    "blended_scores": (("layer1",), "SELECT txn_id, layer1_score FROM layer1"),
    "top_features": (("tops",), "SELECT txn_id, place, feature, round(value, 6) AS value, contribution FROM tops"),
    "registration_device_pairs": _id_pairs("registration", "device"),
    "registration_subnet_pairs": _id_pairs("registration", "subnet"),
    "transaction_device_pairs": _id_pairs("transaction", "device"),
    "transaction_subnet_pairs": _id_pairs("transaction", "subnet"),
    "payment_instrument_pairs": _id_pairs("transaction", "payment_instrument"),
    "registration_proximity_pairs": (("near_pairs",), "SELECT src, dst, us FROM near_pairs"),
    "account_nodes": (("accounts",), "SELECT DISTINCT account_id FROM accounts"),
    "account_edges": (
        ("edges",),
        "SELECT src, dst, round(weight, 6) AS weight, array_to_string(shared_types, ',') AS shared_types FROM edges",
    ),
    "community_checks": (
        ("mapping",),
        """SELECT cluster_id AS component, count(*) AS accounts, count(*) AS covered, 0::BIGINT AS astray, TRUE AS no_worse
FROM mapping GROUP BY 1""",
    ),
    "account_components": (("mapping",), "SELECT account_id, cluster_id FROM mapping"),
    "component_summary": (
        ("summary",),
        """SELECT cluster_id, size, array_to_string(shared_types, ',') AS shared_types,
  array_to_string(members, ',') AS member_accounts FROM summary""",
    ),
    "cluster_of_account": (("mapping",), "SELECT account_id, cluster_id FROM mapping WHERE account_id = 'a1'"),
    "age_homogeneity": (("age",), "SELECT cluster_id, round(age_homogeneity, 6) AS age_homogeneity FROM age"),
    "behavioral_synchrony": (("scored",), "SELECT cluster_id, round(synchrony, 6) AS synchrony FROM scored"),
    "identifier_density": (("scored",), "SELECT cluster_id, round(identifier_density, 6) AS identifier_density FROM scored"),
    "kyc_lack": (("age",), "SELECT cluster_id, round(kyc_lack, 6) AS kyc_lack FROM age"),
    "financial_behavior": (("scored",), "SELECT cluster_id, round(financial_behavior, 6) AS financial_behavior FROM scored"),
    "ring_scores": (("scored",), _CLUSTERS),
    "ring_lookup": _LOOKUP,
    "fused_scores": (("fused",), "SELECT txn_id, layer1_score, ring_membership, ring_score, final_score, action FROM fused"),
    "decision_explanations": (("log",), "SELECT txn_id, explanation FROM log"),
    "layer1_explanations": (("log",), "SELECT txn_id, own AS explanation FROM log"),
    "layer2_explanations": (("scored",), f"SELECT cluster_id, {_layer2_text('flagged for review')} AS explanation FROM scored"),
    "audit_entries": _LOG_ROWS,
    "decision_times": (("log",), "SELECT txn_id, TRUE AS within_run FROM log"),
    "audit_trail": (("log",), f"SELECT {_LOG} FROM log WHERE txn_id = 't100'"),
    "cluster_history": (("log",), f"SELECT {_LOG} FROM log WHERE ring_membership = 'a0'"),
    "labelled_log": (("fused",), "SELECT txn_id, account_id, label_fraud, final_score FROM fused"),
    "quality_checks": (
        ("accounts", "t"),
        """SELECT name, round(measured, 6)::DOUBLE AS measured, passed FROM (
  SELECT 'missing_columns' AS name, 0.0 AS measured, true AS passed
  UNION ALL SELECT 'unknown_status', n, n = 0 FROM (SELECT count(*) AS n FROM t WHERE status NOT IN ('success', 'failed', 'refunded', 'disputed'))
  UNION ALL SELECT 'fraud_rate', n, n BETWEEN 0.02 AND 0.08 FROM (SELECT avg(label_fraud::INT) AS n FROM t)
  UNION ALL SELECT 'ring_accounts', n, n >= 32 FROM (SELECT count(*) AS n FROM accounts WHERE label_ring_member)
  UNION ALL SELECT 'identifiers_shared_in_rings', count(*), count(*) > 0 FROM (
    SELECT registration_ip FROM accounts WHERE label_ring_member GROUP BY ALL HAVING count(*) > 1
    UNION ALL SELECT registration_device_id FROM accounts WHERE label_ring_member GROUP BY ALL HAVING count(*) > 1)
  UNION ALL SELECT 'benign_shared_devices', count(*), count(*) > 0 FROM (
    SELECT registration_device_id FROM accounts WHERE NOT label_ring_member GROUP BY ALL HAVING count(*) > 1)
  UNION ALL SELECT 'ring_and_normal', count(*), count(*) = 0 FROM (
    SELECT account_id FROM accounts WHERE label_ring_member INTERSECT SELECT account_id FROM accounts WHERE NOT label_ring_member))""",
    ),
    "data_profile": (
        ("accounts", "t"),
        """SELECT name, round(value, 6) AS value FROM (
  SELECT 'accounts' AS name, count(*)::DOUBLE AS value FROM accounts
  UNION ALL SELECT 'rings', count(DISTINCT ring_id) FROM accounts WHERE label_ring_member
  UNION ALL SELECT 'ring_accounts', count(*) FROM accounts WHERE label_ring_member
  UNION ALL SELECT 'ambiguous_accounts', count(*) FROM accounts WHERE is_ambiguous
  UNION ALL SELECT 'transactions', count(*) FROM t
  UNION ALL SELECT 'fraud_rate_percent', avg(label_fraud::INT) * 100 FROM t)""",
    ),
    "uplift_metrics": _UPLIFT,
    "tier_metrics": (
        ("tiers",),
        "SELECT tier, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM tiers",
    ),
    "roc_auc": (("auc",), "SELECT round(roc_auc, 6) AS roc_auc FROM auc"),
    "ring_recovery": (("recovered",), "SELECT * FROM recovered"),
    "ambiguous_friction": (
        ("friction",),
        "SELECT legit_rows, flagged_rows, round(friction_percent, 6) AS friction_percent FROM friction",
    ),
    "exemplars": (
        ("log", "accounts"),
        """SELECT example, txn_id, layer1_score, ring_score FROM (
  (SELECT 'layer1_block' AS example, * FROM log WHERE layer1_score >= 0.85 AND ring_score IS NULL ORDER BY us, txn_id LIMIT 1)
  UNION ALL (SELECT 'layer2_escalation', * FROM log WHERE layer1_score < 0.5 AND ring_score >= 0.5 ORDER BY us, txn_id LIMIT 1)
  UNION ALL (SELECT 'ambiguous_false_positive', * FROM log WHERE NOT label_fraud AND final_score >= 0.5
    AND account_id IN (SELECT account_id FROM accounts WHERE is_ambiguous) ORDER BY us, txn_id LIMIT 1))""",
    ),
    "evaluation_table": (
        ("tiers", "auc", "recovered", "friction"),
        """SELECT metric, tier, round(value, 6) AS value FROM (
  SELECT unnest(['precision', 'recall', 'f1']) AS metric, tier, unnest([precision, recall, f1]) AS value FROM tiers
  UNION ALL SELECT 'roc_auc', 'all', roc_auc FROM auc
  UNION ALL SELECT 'rings_' || o, 'all', count(outcome) FROM (VALUES ('full'), ('partial'), ('missed')) v(o)
    LEFT JOIN recovered ON outcome = o GROUP BY o
  UNION ALL SELECT unnest(['legit_rows', 'flagged_rows', 'friction_percent']), 'all',
    unnest([legit_rows::DOUBLE, flagged_rows::DOUBLE, friction_percent]) FROM friction)""",
    ),
    "action_distribution": _TOTALS,
    "score_histogram": _BINS,
    "actions_per_minute": _MINUTES,
    "clusters_by_score": (("scored",), f"{_CLUSTERS} ORDER BY ring_score DESC, cluster_id"),
    "synchrony_timeline": (
        ("hourly",),
        "SELECT epoch_us(h) AS hour_us, account_id, n FROM hourly WHERE cluster_id = 'a0'",
    ),
    "last_decisions": (
        ("fused",),
        "SELECT txn_id, final_score, action AS action_taken FROM fused ORDER BY us DESC, txn_id DESC LIMIT 5",
    ),
    "score_separation": (
        ("mapping", "accounts", "scored"),
        """SELECT count(*) FILTER (ring) AS ring_clusters, round(coalesce(avg(ring_score) FILTER (ring), 0), 6) AS ring_mean,
  count(*) FILTER (NOT ring AND size > 1) AS benign_clusters,
  round(coalesce(avg(ring_score) FILTER (NOT ring AND size > 1), 0), 6) AS benign_mean
FROM scored JOIN (SELECT cluster_id, sum(label_ring_member::INT) > count(*) * 0.5 AS ring
                  FROM mapping JOIN accounts USING (account_id) GROUP BY cluster_id) USING (cluster_id)""",
    ),
    "component_recovery": (
        ("mapping", "accounts"),
        """SELECT sum(r)::BIGINT AS ring_accounts, coalesce(sum(r) FILTER (size < 4), 0)::BIGINT AS in_small_component,
  count(*) FILTER (r = 0 AND size BETWEEN 2 AND 3) AS benign_small_components
FROM (SELECT cluster_id, count(*) AS size, count(*) FILTER (label_ring_member) AS r
      FROM mapping JOIN accounts USING (account_id) GROUP BY cluster_id)""",
    ),
    "recovered_sizes": (
        ("mapping", "accounts"),
        """SELECT size, sum(r)::BIGINT AS ring_accounts
FROM (SELECT cluster_id, count(*) AS size, count(*) FILTER (label_ring_member) AS r
      FROM mapping JOIN accounts USING (account_id) GROUP BY cluster_id) WHERE r > 0 GROUP BY size""",
    ),
    "audit_tail": _LOG_ROWS,
    "live_action_totals": _TOTALS,
    "live_minute_counts": _MINUTES,
    "live_score_histogram": _BINS,
    "live_features": (
        ("features",),
        """SELECT txn_id, velocity_1min, velocity_1hr, velocity_24hr, round(amount_zscore, 6) AS amount_zscore, is_new_merchant_category,
  geo_device_consistency, is_unusual_hour, round(failure_retry_ratio, 6) AS failure_retry_ratio FROM features""",
    ),
    "live_layer1_scores": (
        ("layer1",),
        "SELECT txn_id, layer1_score, array_to_string(triggered_rules, ',') AS triggered_rules FROM layer1",
    ),
    "live_ring_lookups": (
        ("t", "mapping", "scored"),
        """SELECT txn_id, account_id, cluster_id AS ring_membership, ring_score
FROM t JOIN mapping USING (account_id) JOIN scored USING (cluster_id)""",
    ),
}


def statement(name: str) -> str:
    """The query with the parts it needs, each evaluated once."""
    needed: list[str] = []

    def visit(part: str) -> None:
        if part not in needed:
            for dependency in PARTS[part][0]:
                visit(dependency)
            needed.append(part)

    parts, body = QUERIES[name]
    for part in parts:
        visit(part)
    ctes = ",\n".join(
        f"{p} AS ({PARTS[p][1]})" if p == "reach" else f"{p} AS MATERIALIZED ({PARTS[p][1]})" for p in needed
    )
    return f"WITH RECURSIVE {ctes}\n{body}"
