"""The registered queries in plain SQL, over the same tables."""

from __future__ import annotations

from checks.queries import BATCH_US, CHECK_SALT, WORDS
from tidemark.functions.masking import key_pads
from tidemark.profiles import CLINICAL, HEALTH_TECH, MANUFACTURING, ROBOTICS, Profile

_INNER, _OUTER = (pad.hex() for pad in key_pads(CHECK_SALT))


def _hmac(text: str) -> str:
    return (
        f"sha256(unhex('{_OUTER}') || unhex(sha256(unhex('{_INNER}') || encode({text}))))"
    )


def _mask(text: str) -> str:
    return f"('masked_sha256:' || substr({_hmac(text)}, 1, 16))"


def _pick(values: tuple[str, ...], number: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"(CASE {number} % {len(values)} " + " ".join(
        f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)
    ) + " END)" if listed else "NULL"


# --- Bronze -------------------------------------------------------------------
PLC_RAW = """
plc_raw AS (
  SELECT l_shipdate AS "timestamp",
    CASE WHEN l_linestatus = 'O' THEN 'Texas_Giga_01' ELSE 'Berlin_Giga_02' END AS facility_id,
    'REG-' || l_suppkey AS register_id,
    (10 + 0.15 * l_quantity)::FLOAT AS measured_voltage,
    (70 + 300 * l_discount)::FLOAT AS temperature_c,
    (6 + 50 * l_tax)::FLOAT AS pressure_bar,
    l_returnflag = 'R' AS anomaly_flag
  FROM lineitem)"""
PLC = PLC_RAW + f""",
plc AS (SELECT * REPLACE ({_mask('register_id')} AS register_id) FROM plc_raw)"""
SILVER_PLC = PLC + """,
silver AS (
  SELECT *, NOT (measured_voltage BETWEEN 12 AND 16 AND temperature_c <= 95
                 AND pressure_bar <= 9.5) AS sla_breach
  FROM plc WHERE facility_id IS NOT NULL)"""

BIO = f"""
bio AS (
  SELECT ts AS "timestamp", {_mask("'PAT-' || user_id")} AS patient_id_hashed,
    floor(value)::INTEGER AS heart_rate_variability, (value / 100)::FLOAT AS sleep_efficiency,
    {_pick(('NA', 'EU', 'APAC'), 'user_id')} AS region
  FROM events)"""
SILVER_BIO = BIO + """,
silver AS (
  SELECT "timestamp", patient_id_hashed,
    if(heart_rate_variability < 5 OR heart_rate_variability > 200, NULL, heart_rate_variability)
      AS heart_rate_variability,
    if(sleep_efficiency < 0 OR sleep_efficiency > 1, NULL, sleep_efficiency) AS sleep_efficiency,
    region
  FROM bio WHERE patient_id_hashed IS NOT NULL)"""

ECRF = f"""
ecrf AS (
  SELECT ts AS "timestamp", {_mask("'PAT-' || user_id")} AS patient_id_hashed,
    {_pick(('ONC-204', 'CARD-118', 'NEU-330'), 'event_id')} AS study_id,
    {_pick(('18-29', '30-45', '46-65', '66+'), 'user_id')} AS age_bracket,
    {_pick(('NA', 'EU', 'APAC'), 'user_id')} AS region,
    event_type = 'error' AS adverse_event_flag
  FROM events)"""

SUBS_RAW = f"""
subs_raw AS (
  SELECT o_orderdate AS "timestamp", 'CUST-' || o_custkey AS customer_id_hashed,
    {_pick(('FREE', 'PRO', 'ENTERPRISE'), 'o_custkey')} AS plan_tier,
    {_pick(('NA', 'EU', 'APAC'), 'o_custkey')} AS region,
    (o_totalprice / 1000)::FLOAT AS monthly_revenue,
    (o_orderkey % 60 + 1)::INTEGER AS tenure_months,
    o_orderstatus = 'F' AS churned_flag
  FROM orders)"""
SUBS = SUBS_RAW + f""",
subs AS (SELECT * REPLACE ({_mask('customer_id_hashed')} AS customer_id_hashed) FROM subs_raw)"""
SILVER_SUBS = SUBS + """,
silver AS (
  SELECT *, round(monthly_revenue * tenure_months, 2)::FLOAT AS lifetime_value
  FROM subs WHERE customer_id_hashed IS NOT NULL)"""

ROBOT = f"""
robot AS (
  SELECT TIMESTAMP '2026-01-01' + to_microseconds(vec_id * 20000) AS "timestamp",
    {_mask("'serial-' || (vec_id % 8)")} AS robot_id,
    {_pick(('Figure-01', 'Optimus-Gen2', 'Atlas-Next', 'Apollo-1'), 'label')} AS robot_model_id,
    embedding AS joint_positions,
    'frames/' || lpad(vec_id::VARCHAR, 9, '0') || '.jpg' AS camera_frame_uri,
    CASE WHEN vec_id % 5 <> 0 THEN 'NO_FAILURE' ELSE
      {_pick(('GRASP_FAIL', 'OVER_TORQUE', 'VISION_OCCLUSION', 'PATH_PLAN_TIMEOUT', 'MOTOR_OVERHEAT'), 'label')}
    END AS failure_type_tag,
    vec_id % 5 <> 0 AS success_flag
  FROM embeddings)"""
SILVER_ROBOT = ROBOT + """,
silver AS (
  SELECT *, list_max(joint_positions) AS peak_joint_pos FROM robot WHERE robot_id IS NOT NULL)"""

GOLD_ACCOUNT = """
  SELECT plan_tier, count(*) AS account_count,
    round(avg(monthly_revenue), 2) AS avg_monthly_revenue,
    round(avg(lifetime_value), 2) AS avg_lifetime_value,
    count(*) FILTER (WHERE churned_flag) AS churned_count,
    round(count(*) FILTER (WHERE churned_flag) / count(*), 3) AS churn_rate
  FROM silver GROUP BY ALL"""

DIRTY = """
dirty AS (
  SELECT l_shipdate AS "timestamp",
    CASE WHEN l_linenumber = 7 THEN NULL
         WHEN l_linenumber = 6 AND l_quantity > 45 THEN 'Elsewhere_09'
         WHEN l_linestatus = 'O' THEN 'Texas_Giga_01' ELSE 'Berlin_Giga_02' END AS facility_id,
    l_suppkey::VARCHAR AS "REGISTER_ID", l_orderkey AS order_key,
    CASE WHEN l_returnflag <> 'N' THEN l_returnflag = 'R' END AS anomaly_flag
  FROM lineitem)"""
UNKNOWN_FACILITY = (
    "coalesce(sum((facility_id NOT IN ('Texas_Giga_01', 'Berlin_Giga_02'))::INT), 0)::BIGINT"
)
REPEATED_KEYS = """(SELECT count(*) FROM (SELECT order_key FROM dirty
    WHERE order_key IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"""

# --- frames -------------------------------------------------------------------
HRV = """
hrv AS (SELECT event_type, ts, event_id, floor(value)::INTEGER AS hrv FROM events)"""
PLACED = HRV + """,
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) // 17 AS frame
  FROM hrv WHERE hrv IS NOT NULL)"""
COUNT_FRAMES = PLACED + """,
framed AS (
  SELECT event_type, frame, 'HEALTH_TECH' AS profile, 'mean_hrv_ms' AS label,
    round(sum(hrv)::DOUBLE / count(*), 4) AS metric_value, count(*) AS sample_count,
    'streaming' AS status
  FROM placed GROUP BY event_type, frame)"""
HOURLY = HRV + """,
range AS (SELECT date_trunc('hour', min(ts)) AS first, date_trunc('hour', max(ts)) AS last FROM events),
grid AS (
  SELECT t.event_type, g.start
  FROM (SELECT DISTINCT event_type FROM events) t,
       (SELECT unnest(generate_series((SELECT first FROM range), (SELECT last FROM range),
               INTERVAL 1 HOUR)) AS start) g),
hourly AS (
  SELECT grid.event_type,
    (epoch_us(grid.start) - epoch_us((SELECT first FROM range))) // 3600000000 AS frame,
    grid.start AS frame_start, 'HEALTH_TECH' AS profile, 'mean_hrv_ms' AS label,
    CASE WHEN count(hrv) > 0 THEN round(sum(hrv)::DOUBLE / count(hrv), 4) ELSE 0.0 END
      AS metric_value,
    count(hrv) AS sample_count,
    CASE WHEN count(hrv) > 0 THEN 'streaming' ELSE 'idle' END AS status
  FROM grid LEFT JOIN hrv
    ON hrv.event_type = grid.event_type AND date_trunc('hour', hrv.ts) = grid.start
  GROUP BY grid.event_type, grid.start)"""
WATERMARK = "(SELECT (max(epoch_us(ts)) - 600000000) // 1000 * 1000 FROM events)"
CLOSED = f"epoch_us(ts) // 600000000 * 600000000 + 600000000 <= {WATERMARK}"
ALERT = "CASE WHEN bool_or(status = 'idle') OVER ({}) THEN 'ALERT_PENDING' ELSE 'AUTONOMOUS' END"


# --- retrieval ----------------------------------------------------------------
def _first_term(text: str, terms: tuple[str, ...]) -> str:
    edge = r"[^\p{L}\p{N}_]"
    cases = " ".join(
        f"WHEN regexp_matches({text}, '(?i)(^|{edge}){t}($|{edge})') THEN '{t}'" for t in terms
    )
    return f"(CASE {cases} END)"


CHUNKS = SUBS + """,
texts AS (
  SELECT *, '[COMMERCIAL] customer_id_hashed=' || customer_id_hashed || ', plan_tier=' || plan_tier
    || ', region=' || region || ', monthly_revenue=' || monthly_revenue::DOUBLE::VARCHAR
    || ', tenure_months=' || tenure_months || ', churned_flag='
    || CASE WHEN churned_flag THEN 'True' ELSE 'False' END AS text
  FROM subs),
named AS (
  SELECT 'COMMERCIAL-' || substr(sha256(epoch_us("timestamp") || '|' || text), 1, 32) AS base, * FROM texts),
copies AS (SELECT row_number() OVER (PARTITION BY base) AS copy, * FROM named),
chunks AS (
  SELECT base || CASE WHEN copy > 1 THEN '-' || copy ELSE '' END AS id, text, plan_tier, region,
    'COMMERCIAL' AS profile
  FROM copies)"""


#: Every row twice, and rows of one customer in sixteen three times.
REPEATED = CHUNKS.replace(
    "  FROM subs),\nnamed",
    """  FROM (SELECT * FROM subs UNION ALL SELECT * FROM subs
    UNION ALL SELECT * FROM subs WHERE customer_id_hashed LIKE '%0')),
named""",
)


def _shown(name: str, kind: str) -> str:
    """A Bronze value as a chunk's text shows it."""
    if kind == "boolean":
        text = f"CASE WHEN {name} THEN 'True' WHEN NOT {name} THEN 'False' END"
    elif kind == "float":
        text = f"{name}::DOUBLE::VARCHAR"
    elif kind.startswith("array"):
        text = f"'[' || array_to_string(list_transform({name}, lambda x: x::DOUBLE::VARCHAR), ', ') || ']'"
    else:
        text = f"{name}::VARCHAR"
    return f"coalesce({text}, 'None')"


def _profile_chunks(profile: Profile, bronze: str, part: str) -> str:
    """Chunks of a profile whose last column is missing in every ninth row."""
    fields = [(f.name, f.dataType.simpleString()) for f in profile.schema.fields if f.name != "timestamp"]
    text = " || ', ' || ".join(f"'{name}=' || {_shown(name, kind)}" for name, kind in fields)
    found = ", ".join(f"'{field}=' || {field}" for field in profile.vocabulary)
    last = profile.schema.names[-1]
    return f"""
        SELECT base || CASE WHEN copy > 1 THEN '-' || copy ELSE '' END AS id, text, metadata FROM (
          SELECT *, row_number() OVER (PARTITION BY base) AS copy FROM (
            SELECT *, '{profile.name}-' || substr(sha256(epoch_us("timestamp"::TIMESTAMP) || '|' || text), 1, 32) AS base
            FROM (
              SELECT "timestamp", '[{profile.name}] ' || {text} AS text,
                array_to_string(list_sort(list_filter([{found}, 'profile={profile.name}'],
                  lambda x: x IS NOT NULL)), ',') AS metadata
              FROM (SELECT * REPLACE (CASE WHEN {part}("timestamp") % 9 <> 4 THEN {last} END AS {last})
                    FROM {bronze}))))"""


def _measures(product: str, key: str, gold: str) -> str:
    """A Gold product's SQL as one row per key and measure."""
    return f"""
        SELECT '{product}' AS product, {key} AS key, measure, value
        FROM (UNPIVOT (SELECT {key}, COLUMNS(* EXCLUDE ({key}))::DOUBLE FROM ({gold}))
              ON COLUMNS(* EXCLUDE ({key})) INTO NAME measure VALUE value)"""


def _buckets(relation: str, key: str, text: str) -> str:
    """(key, bucket, tf) of the hashed words of a relation's text."""
    return f"""
  SELECT {key}, bucket, count(*)::DOUBLE AS tf FROM (
    SELECT {key}, ('0x' || substr(md5(w), 1, 8))::BIGINT % 256 AS bucket FROM (
      SELECT {key}, unnest(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}_]+')) AS w
      FROM {relation}) WHERE w <> '')
  GROUP BY ALL"""


def _retrieve(chunks: str) -> str:
    return f"""
WITH {CHUNKS},
questions AS (
  SELECT n_name || '/' || c_mktsegment AS question_id,
    'which ' || CASE n_nationkey % 4 WHEN 0 THEN 'FREE' WHEN 1 THEN 'pro' WHEN 2 THEN 'Enterprise'
      ELSE 'revenue' END
    || ' accounts in ' || CASE n_nationkey % 3 WHEN 0 THEN 'NA' WHEN 1 THEN 'EU' ELSE 'anywhere' END
    || ' churned_flag=True like ' || n_name || ' ' || c_mktsegment AS question
  FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer) JOIN nation
    ON c_nationkey = n_nationkey),
asked AS (
  SELECT *, {_first_term('question', ('FREE', 'PRO', 'ENTERPRISE'))} AS plan_tier,
    {_first_term('question', ('NA', 'EU', 'APAC'))} AS region
  FROM questions),
indexed AS ({chunks}),
numbered AS (SELECT row_number() OVER () AS n, * FROM indexed),
c_words AS ({_buckets('numbered', 'n', 'text')}),
q_words AS ({_buckets('asked', 'question_id', 'question')}),
c_norm AS (SELECT n, sqrt(sum(tf * tf)) AS norm FROM c_words GROUP BY 1),
q_norm AS (SELECT question_id, sqrt(sum(tf * tf)) AS norm FROM q_words GROUP BY 1),
dots AS (SELECT question_id, n, sum(q.tf * c.tf) AS dot FROM q_words q JOIN c_words c USING (bucket)
         GROUP BY 1, 2),
scored AS (
  SELECT a.question_id, c.id,
    round(coalesce(d.dot, 0) / (cn.norm * qn.norm), 10) AS score
  FROM asked a JOIN numbered c
    ON (a.plan_tier IS NULL OR a.plan_tier = c.plan_tier) AND (a.region IS NULL OR a.region = c.region)
  JOIN c_norm cn ON cn.n = c.n JOIN q_norm qn ON qn.question_id = a.question_id
  LEFT JOIN dots d ON d.question_id = a.question_id AND d.n = c.n),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, id) AS rank FROM scored),
hits AS (
  SELECT question_id, string_agg(id, ',' ORDER BY rank) AS matched_ids, count(*) AS n
  FROM ranked WHERE rank <= 5 GROUP BY 1),
matches AS (
  SELECT a.question_id, s.*,
    row_number() OVER (PARTITION BY a.question_id ORDER BY s."timestamp", s.customer_id_hashed,
      s.plan_tier, s.region, s.monthly_revenue, s.tenure_months, s.churned_flag) AS place
  FROM asked a JOIN subs s
    ON (a.plan_tier IS NULL OR a.plan_tier = s.plan_tier) AND (a.region IS NULL OR a.region = s.region)),
rows AS (
  SELECT question_id, count(*)::INTEGER AS row_count,
    string_agg(concat_ws('/', epoch_us("timestamp"), customer_id_hashed, plan_tier, region,
      round(monthly_revenue::DOUBLE * 100)::BIGINT, tenure_months, churned_flag), ',' ORDER BY place)
      AS matched_rows
  FROM matches WHERE place <= 20 GROUP BY 1)
SELECT a.question_id, a.plan_tier, a.region, coalesce(h.matched_ids, '') AS matched_ids,
  coalesce(r.row_count, 0)::INTEGER AS row_count, coalesce(r.matched_rows, '') AS matched_rows,
  'Profile ''COMMERCIAL'' brief for: ''' || a.question || '''' || chr(10) || '  Applied filter: '
  || CASE WHEN a.plan_tier IS NULL AND a.region IS NULL THEN 'no specific filter'
     ELSE concat_ws(', ', 'plan_tier=' || a.plan_tier, 'region=' || a.region) END
  || chr(10) || '  Retrieved ' || coalesce(h.n, 0) || ' matching record(s) from the lakehouse.' AS answer
FROM asked a LEFT JOIN hits h USING (question_id) LEFT JOIN rows r USING (question_id)"""


# --- flywheel -----------------------------------------------------------------
SCORED = """
sums AS (
  SELECT vec_id, label, list_sum(embedding::DOUBLE[]) AS total, len(embedding) AS n FROM embeddings),
scored AS (
  SELECT *, least(0.99::DOUBLE, greatest(0.01::DOUBLE,
      0.5::DOUBLE + 0.45::DOUBLE * tanh(total / n * 4))) AS confidence FROM sums),
tagged AS (
  SELECT *, confidence < 0.55::DOUBLE AS is_failure,
    CASE WHEN confidence < 0.55::DOUBLE THEN (['GRASP_FAIL', 'OVER_TORQUE', 'VISION_OCCLUSION',
      'PATH_PLAN_TIMEOUT', 'MOTOR_OVERHEAT'])[floor(abs(total * 1000))::BIGINT % 5 + 1] END AS tag
  FROM scored)"""
LIVE = f"""
WITH {SCORED}
SELECT 'inf-' || substr(sha256('policy_v1|ep-' || vec_id || '|{BATCH_US}'), 1, 32) AS inference_id,
  'ep-' || vec_id AS episode_id, label::VARCHAR AS robot_model_id, 'policy_v1' AS model_version,
  {BATCH_US}::BIGINT AS ts_us, round(confidence, 9) AS policy_confidence, is_failure,
  tag AS failure_type_tag, 'simulation' AS deployment_env
FROM tagged"""

COSTS = """
results AS (
  SELECT event_id, 0 AS position, event_type AS node,
    CASE WHEN user_id % 7 = 0 THEN '?' ELSE 'success' END AS status, value / 1000 AS seconds
  FROM events
  UNION ALL
  SELECT event_id, 1, '?', 'error', 0.0::DOUBLE FROM events WHERE user_id % 5 = 0),
costs AS (
  SELECT event_id, 'HEALTH_TECH' AS data_product, position, status, node,
    round(seconds, 4) AS execution_time_s, round(seconds * 0.05::DOUBLE, 4) AS estimated_cost_usd
  FROM results)"""


def oracle() -> dict[str, str]:
    joints = ", ".join(f"joint_positions[{i}]::DOUBLE AS joint_{i}" for i in range(1, 8))
    hidden = 'NULL::VARCHAR AS customer_id_hashed'
    contract = [
        ("register_id", "missing", "string", None),
        ("measured_voltage", "missing", "float", None),
        ("temperature_c", "missing", "float", None),
        ("pressure_bar", "missing", "float", None),
        ("sla_breach", "missing", "boolean", None),
        ("REGISTER_ID", "extra", None, "string"),
        ("order_key", "extra", None, "bigint"),
    ]
    contract_rows = ", ".join(
        "(" + ", ".join("NULL" if v is None else f"'{v}'" for v in row) + ")" for row in contract
    )
    own = {
        "silver_robot_signals": f"""WITH {SILVER_ROBOT}
            SELECT * EXCLUDE (joint_positions), {joints} FROM silver""",
        "silver_robot_joints": f"""WITH {SILVER_ROBOT}
            SELECT "timestamp", robot_id, unnest(range(len(joint_positions))) AS place,
              unnest(joint_positions)::DOUBLE AS value FROM silver""",
        "silver_plc_registers": f"WITH {SILVER_PLC} SELECT * FROM silver",
        "silver_wearable_biometrics": f"""WITH {SILVER_BIO}
            SELECT * REPLACE (heart_rate_variability::DOUBLE AS heart_rate_variability) FROM silver""",
        "silver_subscription_events": f"WITH {SILVER_SUBS} SELECT * FROM silver",
        "silver_ecrf_observations": f"WITH {ECRF} SELECT * FROM ecrf",
        "gold_robot_health": f"""WITH {SILVER_ROBOT}
            SELECT robot_model_id, count(*) AS episode_count,
              count(*) FILTER (WHERE success_flag) AS success_count,
              count(*) FILTER (WHERE NOT success_flag) AS failure_count,
              round(count(*) FILTER (WHERE success_flag) / count(*), 3) AS success_rate
            FROM silver GROUP BY ALL""",
        "gold_facility_health": f"""WITH {SILVER_PLC}
            SELECT facility_id, count(*) AS sample_count,
              round(avg(measured_voltage), 3) AS avg_voltage,
              round(avg(temperature_c), 3) AS avg_temperature_c,
              round(avg(pressure_bar), 3) AS avg_pressure_bar,
              count(*) FILTER (WHERE anomaly_flag) AS anomaly_count,
              count(*) FILTER (WHERE sla_breach) AS sla_breach_count
            FROM silver GROUP BY ALL""",
        "gold_cohort_summary": f"""WITH {SILVER_BIO}
            SELECT region, count(DISTINCT patient_id_hashed) AS patient_count,
              round(avg(heart_rate_variability), 2) AS avg_hrv,
              round(avg(sleep_efficiency), 3) AS avg_sleep_efficiency,
              count(*) FILTER (WHERE heart_rate_variability < 35) AS low_hrv_readings
            FROM silver GROUP BY ALL""",
        "gold_account_health": f"WITH {SILVER_SUBS} {GOLD_ACCOUNT}",
        "gold_study_safety": f"""WITH {ECRF}
            SELECT study_id, count(DISTINCT patient_id_hashed) AS patient_count,
              count(*) AS observation_count,
              count(*) FILTER (WHERE adverse_event_flag) AS adverse_event_count,
              round(count(*) FILTER (WHERE adverse_event_flag) / count(*), 4) AS adverse_event_rate
            FROM ecrf GROUP BY ALL""",
        "align_to_schema": """
            SELECT NULL::TIMESTAMP AS "timestamp", c_custkey::VARCHAR AS customer_id_hashed,
              c_mktsegment AS plan_tier, NULL::VARCHAR AS region,
              c_acctbal::FLOAT AS monthly_revenue, c_nationkey::INTEGER AS tenure_months,
              NULL::BOOLEAN AS churned_flag
            FROM customer""",
        "drop_null_identifier": f"WITH {DIRTY} SELECT * FROM dirty WHERE facility_id IS NOT NULL",
        "null_out_of_range": """
            SELECT event_id, CASE WHEN value BETWEEN 5 AND 200 THEN value END AS value,
              CASE WHEN user_id BETWEEN 10 AND 100 THEN user_id END::DOUBLE AS user_id
            FROM events""",
        "threshold_breach": """
            SELECT l_orderkey, l_linenumber, l_quantity,
              (l_quantity < 3 OR l_quantity >= 49 OR l_tax <= 0) AS breach
            FROM lineitem""",
        "append_product": f"WITH {PLC} SELECT * FROM plc UNION ALL SELECT * FROM plc",
        "overwrite_product": "SELECT * FROM customer WHERE c_acctbal >= 0",
        "upsert_product": "SELECT * REPLACE (greatest(c_acctbal, 0.0::DOUBLE) AS c_acctbal) FROM customer",
        "export_parquet": f"WITH {ECRF} SELECT * FROM ecrf",
        "enforce": f"WITH {SILVER_SUBS} {GOLD_ACCOUNT}",
        "first_available": f"""WITH {PLC},
            placed AS (
              SELECT *, (row_number() OVER (PARTITION BY facility_id
                ORDER BY "timestamp", register_id, measured_voltage) - 1) // 17 AS frame FROM plc)
            SELECT facility_id, frame, 'MANUFACTURING' AS profile, 'mean_voltage_v' AS label,
              round(avg(measured_voltage::DOUBLE), 4) AS metric_value, count(*) AS sample_count,
              'streaming' AS status
            FROM placed GROUP BY facility_id, frame""",
        "mask_sensitive": f"""
            SELECT c_custkey, {_mask('c_name')} AS customer_id_hashed, c_mktsegment FROM customer""",
        "mask_column": f"""
            SELECT c_custkey, {_mask('c_name')} AS token, 'masked_sha256:' || {_hmac('c_name')} AS long_token,
              {_mask('c_name')} AS for_others, c_name AS for_security FROM customer""",
        "masked_join": f"""
            SELECT o_orderkey, {_mask('o_custkey::VARCHAR')} AS masked_id, c_name, c_mktsegment
            FROM orders JOIN customer ON o_custkey = c_custkey""",
        "secure_view_hmac": f"""WITH {SUBS_RAW}
            SELECT * REPLACE ({_hmac('customer_id_hashed')} AS customer_id_hashed) FROM subs_raw""",
        "secure_view_null": f"""WITH {SUBS_RAW}
            SELECT * EXCLUDE (customer_id_hashed), {hidden} FROM subs_raw""",
        "row_security_filter": f"""WITH {SUBS_RAW}
            SELECT 'operations' AS holder, * FROM subs_raw
            UNION ALL BY NAME
            SELECT 'admins' AS holder, * EXCLUDE (customer_id_hashed), {hidden} FROM subs_raw""",
        "secure_view_deny": f"WITH {SUBS_RAW} SELECT * EXCLUDE (customer_id_hashed) FROM subs_raw",
        "publish_tiers": f"""WITH {SILVER_ROBOT}
            SELECT 'silver.silver_robot_signals' AS table_name, count(*) AS row_count FROM silver
            UNION ALL SELECT 'gold.gold_robot_health', count(DISTINCT robot_model_id) FROM silver
            UNION ALL SELECT 'silver.silver_plc_registers', count(*) FROM lineitem
            UNION ALL SELECT 'gold.gold_facility_health', count(DISTINCT l_linestatus) FROM lineitem
            UNION ALL SELECT 'silver.silver_wearable_biometrics', count(*) FROM events
            UNION ALL SELECT 'gold.gold_cohort_summary', count(DISTINCT user_id % 3) FROM events
            UNION ALL SELECT 'silver.silver_subscription_events', count(*) FROM orders
            UNION ALL SELECT 'gold.gold_account_health', count(DISTINCT o_custkey % 3) FROM orders
            UNION ALL SELECT 'silver.silver_ecrf_observations', count(*) FROM events
            UNION ALL SELECT 'gold.gold_study_safety', count(DISTINCT event_id % 3) FROM events""",
        "test_not_null": f"""WITH {DIRTY}
            SELECT sum((anomaly_flag IS NULL)::INT)::BIGINT AS failing FROM dirty""",
        "test_accepted_values": f"WITH {DIRTY} SELECT {UNKNOWN_FACILITY} AS failing FROM dirty",
        "test_unique": f"WITH {DIRTY} SELECT {REPEATED_KEYS} AS failing",
        "test_no_sensitive_columns": f"""WITH {DIRTY}
            SELECT 'REGISTER_ID' AS column_name WHERE EXISTS (SELECT "REGISTER_ID" FROM dirty)""",
        "check_contract": f"""
            SELECT column_name, problem, expected, actual
            FROM (VALUES {contract_rows}) v(column_name, problem, expected, actual)""",
        "quality_report": f"""WITH {DIRTY}
            SELECT 'not_null:timestamp' AS test, sum(("timestamp" IS NULL)::INT)::BIGINT AS failing FROM dirty
            UNION ALL SELECT 'not_null:facility_id', sum((facility_id IS NULL)::INT)::BIGINT FROM dirty
            UNION ALL SELECT 'not_null:anomaly_flag', sum((anomaly_flag IS NULL)::INT)::BIGINT FROM dirty
            UNION ALL SELECT 'accepted:facility_id', {UNKNOWN_FACILITY} FROM dirty
            UNION ALL SELECT 'unique:order_key', {REPEATED_KEYS}""",
        "assign_frames": f"WITH {PLACED} SELECT * FROM placed",
        "drop_nulls_in_signal": f"WITH {HRV} SELECT * FROM hrv WHERE hrv BETWEEN 5 AND 200",
        "signal_downsample": f"WITH {COUNT_FRAMES} SELECT * FROM framed",
        "signal_downsample_max": """WITH placed AS (
              SELECT label AS model, list_max(embedding)::DOUBLE AS peak,
                (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) // 17 AS frame
              FROM embeddings)
            SELECT model, frame, 'ROBOTICS' AS profile, 'peak_torque_nm' AS label,
              round(max(peak), 4) AS metric_value, count(*) AS sample_count, 'streaming' AS status
            FROM placed GROUP BY model, frame""",
        "idle_frames": f"WITH {HOURLY} SELECT * FROM hourly",
        "frame_history": f"""WITH {HOURLY}
            SELECT *, count(*) OVER recent AS history_count, min(metric_value) OVER recent AS history_min,
              max(metric_value) OVER recent AS history_max,
              round(avg(metric_value) OVER recent, 10) AS history_avg,
              {ALERT.format('PARTITION BY event_type ORDER BY frame')} AS hardware_status
            FROM hourly
            WINDOW recent AS (PARTITION BY event_type ORDER BY frame ROWS 119 PRECEDING)""",
        "frame_history_resets": f"""WITH {HOURLY},
            marked AS (
              SELECT event_type, frame, status,
                max(CASE WHEN status = 'idle' THEN frame END) OVER upto AS last_idle,
                max(CASE WHEN frame % 5 = 2 THEN frame END) OVER before AS last_reset
              FROM hourly
              WINDOW upto AS (PARTITION BY event_type ORDER BY frame),
                before AS (PARTITION BY event_type ORDER BY frame
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
            SELECT event_type, frame, status,
              CASE WHEN last_idle > coalesce(last_reset, -1) THEN 'ALERT_PENDING' ELSE 'AUTONOMOUS' END
                AS hardware_status
            FROM marked""",
        "latest_history": f"""WITH {HOURLY},
            newest AS (SELECT event_type, max(frame) AS latest_frame, bool_or(status = 'idle') AS alert
                       FROM hourly GROUP BY 1)
            SELECT event_type, latest_frame, count(*)::INTEGER AS points,
              sum(round(metric_value * 10000)::BIGINT)::BIGINT AS total,
              arg_max(metric_value, frame) AS newest,
              CASE WHEN any_value(alert) THEN 'ALERT_PENDING' ELSE 'AUTONOMOUS' END AS hardware_status
            FROM hourly JOIN newest USING (event_type)
            WHERE frame > latest_frame - 120 GROUP BY 1, 2""",
        "stream_downsample_time": f"""WITH {HRV},
            windows AS (
              SELECT event_type, make_timestamp(epoch_us(ts) // 600000000 * 600000000) AS frame_start,
                'HEALTH_TECH' AS profile, 'mean_hrv_ms' AS label,
                round(sum(hrv)::DOUBLE / count(*), 4) AS metric_value, count(*) AS sample_count,
                'streaming' AS status
              FROM hrv GROUP BY 1, 2)
            SELECT * FROM windows""",
        # Streams give out what the last watermark, ten minutes before the newest row, has passed.
        "stream_count_frames": f"""WITH {COUNT_FRAMES.replace("WHERE hrv IS NOT NULL", f"WHERE hrv IS NOT NULL AND {CLOSED}")}
            SELECT * FROM framed WHERE sample_count = 17""",
        "stream_idle_frames": f"""WITH {HOURLY}
            SELECT * FROM hourly WHERE epoch_us(frame_start) + 3600000000 <= {WATERMARK}""",
        "stream_frame_history": f"""WITH {HOURLY},
            marked AS (
              SELECT event_type, frame, frame_start, metric_value,
                count(*) OVER recent AS history_count, min(metric_value) OVER recent AS history_min,
                max(metric_value) OVER recent AS history_max,
                round(avg(metric_value) OVER recent, 10) AS history_avg,
                max(CASE WHEN status = 'idle' THEN frame END) OVER upto AS last_idle,
                max(CASE WHEN frame % 5 = 2 THEN frame END) OVER before AS last_reset,
                max(epoch_us(frame_start) + CASE WHEN frame % 5 = 2 THEN 1800000000 ELSE 0 END) OVER () AS newest
              FROM hourly
              WINDOW recent AS (PARTITION BY event_type ORDER BY frame ROWS 119 PRECEDING),
                upto AS (PARTITION BY event_type ORDER BY frame),
                before AS (PARTITION BY event_type ORDER BY frame
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
            SELECT event_type, frame, metric_value, history_count, history_min, history_max, history_avg,
              CASE WHEN last_idle > coalesce(last_reset, -1) THEN 'ALERT_PENDING' ELSE 'AUTONOMOUS' END
                AS hardware_status
            FROM marked WHERE epoch_us(frame_start) + 3600000000 <= newest - 2 * 86400000000""",
        "stream_bronze_ingest": f"""
            SELECT ts AS "timestamp", {_mask("'PAT-' || user_id")} AS patient_id_hashed,
              event_type AS study_id, NULL::VARCHAR AS age_bracket, NULL::VARCHAR AS region,
              event_type = 'error' AS adverse_event_flag
            FROM events""",
        "extract_terms": f"""
            SELECT source_id, {_first_term('text', WORDS['region'])} AS region,
              {_first_term('text', WORDS['connective'])} AS connective
            FROM (SELECT 'd' || doc_id AS source_id, text FROM documents
                  UNION ALL SELECT 'c-' || conv_id || '-' || turn, text FROM conversations)""",
        "build_chunks": f"WITH {CHUNKS} SELECT * FROM chunks",
        "build_chunks_repeated": f"WITH {REPEATED} SELECT * FROM chunks",
        "filter_by_terms": f"""WITH {SUBS}
            SELECT * FROM subs WHERE plan_tier = 'PRO' AND region = 'EU'
            ORDER BY "timestamp", customer_id_hashed, monthly_revenue LIMIT 20""",
        "metadata_prefilter": f"""WITH {SUBS}
            SELECT * FROM subs WHERE plan_tier = 'ENTERPRISE' AND region = 'APAC'""",
        "limit_rows": """
            SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id LIMIT 64""",
        "embed_text": _buckets("documents", "doc_id", "text").replace("% 256", "% 64"),
        "vector_topk": """WITH parts AS (
              SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS place
              FROM embeddings),
            centres AS (
              SELECT label, list(v ORDER BY place) AS centre
              FROM (SELECT label, place, avg(v::DOUBLE) AS v FROM parts GROUP BY 1, 2) GROUP BY 1),
            scored AS (
              SELECT label AS query_id, vec_id,
                list_cosine_similarity(embedding::DOUBLE[], centre) AS score
              FROM embeddings JOIN centres USING (label)),
            ranked AS (
              SELECT query_id, vec_id, score, row_number() OVER (
                PARTITION BY query_id ORDER BY round(score, 10) DESC, vec_id)::INTEGER AS rank
              FROM scored)
            SELECT query_id, rank, vec_id, round(score, 6) AS score FROM ranked WHERE rank <= 5""",
        "vector_topk_blocks": """WITH scored AS (
              SELECT q.vec_id AS query_id, e.vec_id,
                list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS score
              FROM embeddings e JOIN embeddings q ON q.vec_id % 50 = 0),
            ranked AS (
              SELECT *, row_number() OVER (
                PARTITION BY query_id ORDER BY round(score, 10) DESC, vec_id)::INTEGER AS rank
              FROM scored)
            SELECT query_id, rank, vec_id, round(score, 6) AS score FROM ranked WHERE rank <= 5""",
        "vector_index_topk": """WITH scored AS (
              SELECT q.vec_id AS query_id, e.vec_id,
                list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS score
              FROM embeddings e JOIN embeddings q ON q.vec_id % 50 = 0 AND (q.vec_id % 100 <> 0 OR q.label = e.label)),
            ranked AS (
              SELECT *, row_number() OVER (
                PARTITION BY query_id ORDER BY round(score, 10) DESC, vec_id)::INTEGER AS rank
              FROM scored)
            SELECT query_id, rank, vec_id, round(score, 6) AS score FROM ranked WHERE rank <= 5""",
        "retrieve": _retrieve("SELECT * FROM chunks"),
        "ask": _retrieve("SELECT * FROM chunks"),
        "digest_embedding": """WITH bytes AS (
              SELECT doc_id, i AS place,
                ('0x' || substr(sha256(text), 2 * (i % 32) + 1, 2))::INTEGER / 255.0::DOUBLE AS b
              FROM documents, range(128) t(i)),
            norms AS (SELECT doc_id, sqrt(sum(b * b)) AS norm FROM bytes GROUP BY 1)
            SELECT doc_id, place, round((b / (norm + 1e-8))::FLOAT::DOUBLE, 6) AS v
            FROM bytes JOIN norms USING (doc_id)""",
        "embed_episodes": f"""WITH {SILVER_ROBOT},
            numbered AS (SELECT *, row_number() OVER (
              ORDER BY "timestamp", robot_id, camera_frame_uri) - 1 AS n FROM silver)
            SELECT robot_id || '-' || CASE WHEN n < 10000 THEN lpad(n::VARCHAR, 5, '0')
                ELSE n::VARCHAR END AS episode_id,
              robot_model_id, failure_type_tag, success_flag, 128::INTEGER AS feature_dim,
              'digest/sha256' AS backbone
            FROM numbered""",
        "score_episodes": f"""WITH {SCORED}
            SELECT 'ep-' || vec_id AS episode_id, round(confidence, 9) AS policy_confidence,
              is_failure, tag AS scored_tag FROM tagged""",
        "closed_loop": LIVE,
        "append_scores": LIVE,
        "write_training_shards": """WITH placed AS (
              SELECT 'ep-' || vec_id AS episode_id, row_number() OVER (
                ORDER BY sha256('42:ep-' || vec_id), 'ep-' || vec_id) - 1 AS n
              FROM embeddings)
            SELECT n // 64 AS shard, episode_id, (n % 64)::INTEGER AS place,
              count(*) OVER (PARTITION BY n // 64) AS samples FROM placed""",
        "read_run_results": f"""WITH {COSTS},
            given AS (
              SELECT position, CASE WHEN position = 0 THEN node END AS unique_id,
                nullif(status, '?') AS status, CASE WHEN position = 0 THEN seconds END AS seconds
              FROM results)
            SELECT 'HEALTH_TECH' AS data_product, position, unique_id, status, count(*) AS results,
              count(seconds) AS timed, max(seconds) AS longest
            FROM given GROUP BY ALL""",
        "cost_attribution": f"WITH {COSTS} SELECT * FROM costs",
        "sort_by_cost": f"""WITH {COSTS}
            SELECT event_id, position, node, execution_time_s,
              row_number() OVER (ORDER BY execution_time_s DESC, event_id, position) - 1 AS place
            FROM costs""",
        "order_by_key": f"""WITH {SILVER_ROBOT},
            robots AS (SELECT robot_model_id AS key FROM silver), {PLC}, {BIO}, {SUBS}, {ECRF},
            keys AS (
              SELECT DISTINCT 'robot_model_id' AS product, key FROM robots
              UNION SELECT 'nameless', nullif(key, 'Optimus-Gen2') FROM robots
              UNION SELECT 'facility_id', facility_id FROM plc
              UNION SELECT 'region', region FROM bio
              UNION SELECT 'plan_tier', plan_tier FROM subs
              UNION SELECT 'study_id', study_id FROM ecrf)
            SELECT product, key,
              row_number() OVER (PARTITION BY product ORDER BY key NULLS LAST) - 1 AS place FROM keys""",
        "total_cost": f"""WITH {COSTS}
            SELECT data_product, node, round(sum(estimated_cost_usd), 4) AS total_cost_usd
            FROM costs GROUP BY 1, 2""",
    }
    keys = {
        "gold_robot_health": "robot_model_id", "gold_facility_health": "facility_id", "gold_cohort_summary": "region",
        "gold_account_health": "plan_tier", "gold_study_safety": "study_id",
    }
    others = [(ROBOTICS, "robot", "second"), (MANUFACTURING, "plc", "day"), (HEALTH_TECH, "bio", "second"),
              (CLINICAL, "ecrf", "second")]
    return own | {
        "enforce_profiles": " UNION ALL ".join(_measures(name, key, own[name]) for name, key in keys.items()),
        "masked_join_stored": own["masked_join"],
        "test_unique_tokens": own["test_unique"],
        "stream_index_chunks": own["build_chunks_repeated"],
        "build_chunks_profiles": f"WITH {ROBOT}, {PLC}, {BIO}, {ECRF} "
        + " UNION ALL ".join(_profile_chunks(*other) for other in others),
        "asset_chain": f"""SELECT *, (SELECT count(*) FROM orders) AS ingested,
              (SELECT count(*) FROM orders) AS indexed, (SELECT count(*) FROM orders) AS silver_rows,
              (SELECT count(DISTINCT o_custkey % 3) FROM orders) AS gold_rows
            FROM ({own["ask"]})""",
        "gold_patient_sketches": f"""WITH {ECRF},
            keyed AS (SELECT study_id AS key, * FROM ecrf UNION ALL SELECT 'all', * FROM ecrf)
            SELECT key, count(DISTINCT patient_id_hashed) AS exact, count(*) AS observation_count,
              true AS within_bound FROM keyed GROUP BY 1""",
        "stream_run_results_good": own["read_run_results"].replace(
            "FROM results)", "FROM results WHERE event_id % 11 <> 3 AND event_id % 13 <> 5)"
        ),
        "stream_run_results_quarantine": """WITH documents AS (
              SELECT event_id, '{"results":[{"unique_id":"' || event_type || '"' ||
                CASE WHEN user_id % 7 = 0 THEN '' ELSE ',"status":"success"' END ||
                ',"execution_time":' || (value / 1000)::VARCHAR || '}' ||
                CASE WHEN user_id % 5 = 0 THEN ',{"status":"error"}' ELSE '' END || ']}' AS document
              FROM events),
            bad AS (
              SELECT 'malformed' AS reason, substr(document, 1, length(document) - 5) AS document
              FROM documents WHERE event_id % 11 = 3
              UNION ALL
              SELECT 'no results', '{"run": ' || event_id || '}' FROM documents
              WHERE event_id % 13 = 5 AND event_id % 11 <> 3)
            SELECT reason, count(*) AS documents, count(*) AS with_file,
              sum(length(regexp_replace(document, '[0-9.eE-]', '', 'g')))::BIGINT AS characters
            FROM bad GROUP BY 1""",
    }
