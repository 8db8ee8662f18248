"""The same queries as SQL for DuckDB, written against the base tables only."""

from __future__ import annotations

VIEWS = """
WITH raw_log AS (
 SELECT event_id,
  CASE WHEN event_id % 101 = 0 THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts_raw,
  concat('10.0.', CAST(user_id % 7 AS VARCHAR), '.', CAST(user_id AS VARCHAR)) AS src_ip,
  CAST(1024 + user_id AS VARCHAR) AS src_port_raw,
  CAST(1 + k AS VARCHAR) AS dst_port_raw,
  CASE WHEN event_id % 61 = 0 THEN NULL WHEN k % 3 = 0 THEN 'TCP' WHEN k % 3 = 1 THEN 'UDP' ELSE 'ICMP' END AS protocol,
  CASE WHEN event_id % 89 = 0 THEN '' ELSE CAST(64 + user_id * 9 AS VARCHAR) END AS packet_raw,
  CASE WHEN k % 2 = 0 THEN 'Data' ELSE 'Control' END AS packet_type,
  CASE WHEN user_id % 3 = 0 THEN 'HTTP' WHEN user_id % 3 = 1 THEN 'DNS' ELSE 'FTP' END AS traffic_type,
  CASE WHEN event_id % 97 = 0 THEN 'bad' ELSE CAST(value AS VARCHAR) END AS anomaly_raw,
  CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_type END AS attack_type,
  CASE WHEN value >= 100 THEN 'High' WHEN value >= 30 THEN 'Medium' ELSE 'Low' END AS severity
 FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) e),
sec_all AS (
 SELECT event_id, TRY_CAST(ts_raw AS TIMESTAMP) AS ts, src_ip, TRY_CAST(src_port_raw AS DOUBLE) AS src_port,
  TRY_CAST(dst_port_raw AS DOUBLE) AS dst_port, protocol, TRY_CAST(packet_raw AS BIGINT) AS packet_len,
  packet_type, traffic_type, TRY_CAST(anomaly_raw AS DOUBLE) AS anomaly, attack_type, severity FROM raw_log),
sec_log AS (SELECT * FROM sec_all WHERE attack_type IS NOT NULL),
sec_complete AS (
 SELECT * FROM sec_log WHERE protocol IS NOT NULL AND packet_type IS NOT NULL AND traffic_type IS NOT NULL
  AND severity IS NOT NULL AND src_port IS NOT NULL AND dst_port IS NOT NULL AND packet_len IS NOT NULL AND anomaly IS NOT NULL)
"""

KPIS = """
SELECT COUNT(*) AS total_logs, COUNT(DISTINCT attack_type) AS attack_types,
 CAST(SUM(CASE WHEN severity = 'High' THEN 1 ELSE 0 END) AS BIGINT) AS high_severity, ROUND(AVG(anomaly), 3) AS avg_anomaly
FROM sec_all"""

TOP_SOURCES = """
SELECT src_ip, COUNT(*) AS event_count FROM {rows} GROUP BY src_ip ORDER BY event_count DESC, src_ip LIMIT 10"""

SHARE = """
SELECT g.{key}, g.cnt, ROUND(CAST(g.cnt AS DOUBLE) / t.n, 6) AS share
FROM (SELECT {key}, COUNT(*) AS cnt FROM sec_all GROUP BY {key}) g CROSS JOIN (SELECT COUNT(*) AS n FROM sec_all) t"""

HISTOGRAM = """
WITH b AS (SELECT MIN(anomaly) AS lo, MAX(anomaly) AS hi FROM sec_all)
SELECT CAST(LEAST(39, FLOOR((anomaly - lo) / ((hi - lo) / 40))) AS INT) AS bin, COUNT(*) AS cnt
FROM sec_all CROSS JOIN b WHERE anomaly IS NOT NULL GROUP BY 1"""

PROTOCOL_COUNTS = "SELECT protocol, COUNT(*) AS cnt FROM sec_all WHERE protocol IS NOT NULL GROUP BY protocol"

RULE_SCORED = """
WITH p AS (SELECT attack_type AS y, CASE severity WHEN 'High' THEN 'error' WHEN 'Medium' THEN 'click' ELSE 'view' END AS yh FROM sec_log),
 s AS (SELECT y AS cls, COUNT(*) AS support, CAST(SUM(CASE WHEN y = yh THEN 1 ELSE 0 END) AS DOUBLE) AS tp FROM p GROUP BY y),
 h AS (SELECT yh AS cls, CAST(COUNT(*) AS DOUBLE) AS predicted FROM p GROUP BY yh),
 c AS (SELECT s.cls, s.support, s.tp, COALESCE(s.tp / h.predicted, 0) AS prec, s.tp / s.support AS rec,
  2 * s.tp / (s.support + COALESCE(h.predicted, 0)) AS f1 FROM s LEFT JOIN h ON s.cls = h.cls)"""

#: The log with some scores that are not a number, which count as missing.
NAN_LOG = """
WITH nan_all AS (SELECT * REPLACE (CASE WHEN event_id % 103 = 0 THEN NULL ELSE anomaly END AS anomaly) FROM sec_all)"""

#: What four parts of the log hold, twenty events to a stamp; the stamp is the events' number in seconds.
PARTS = """
WITH parts AS (SELECT *, event_id % 4 AS part, strftime(make_timestamp((event_id // 20) * 1000000), '%Y-%m-%d %H:%M:%S') AS stamp,
 TRY_CAST(anomaly_raw AS DOUBLE) AS anomaly FROM raw_log)"""

RECENT = PARTS + """
SELECT event_id, stamp, src_ip, attack_type, anomaly FROM parts ORDER BY stamp DESC, part DESC, event_id DESC LIMIT 15"""

#: The grid: the smallest power of two, from 2 ** -20 on, with which the scores lie within 4096 cells numbered below 2 ** 52.
GRID = """
WITH ends AS (SELECT MIN(anomaly) AS lo, MAX(anomaly) AS hi FROM sec_all),
 widths AS (SELECT e, FLOOR(lo / POWER(2.0::DOUBLE, e)) AS first, FLOOR(hi / POWER(2.0::DOUBLE, e)) AS last FROM ends, (SELECT UNNEST(RANGE(-20, 1000)) AS e)),
 fine AS (SELECT * FROM widths WHERE last - first < 4096 AND GREATEST(ABS(first), ABS(last)) < POWER(2.0::DOUBLE, 52) ORDER BY e LIMIT 1),
 placed AS (SELECT CAST(((FLOOR(anomaly / POWER(2.0::DOUBLE, e)) - first)::BIGINT * 40) // (last - first + 1)::BIGINT AS INT) AS bin, first, last, e
  FROM sec_all, fine WHERE anomaly IS NOT NULL)
SELECT bin, (first + CEIL(bin * (last - first + 1) / 40)) * POWER(2.0::DOUBLE, e) AS bin_start, COUNT(*) AS cnt FROM placed GROUP BY bin, first, last, e"""

#: The first 60 bits of an id's MD5, by which exact splits go.
LONG_HASH = "CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 15)) AS BIGINT)"

HASH_TRAIN = "CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 80"

CATEGORIES = {"protocol": 3, "packet_type": 2, "traffic_type": 3, "severity": 3}


def _frequency_index(column: str) -> str:
    return (
        f"i_{column} AS (SELECT {column} AS v, ROW_NUMBER() OVER (ORDER BY c DESC, {column}) - 1 AS idx "
        f"FROM (SELECT {column}, COUNT(*) AS c FROM sec_complete GROUP BY {column}) t)"
    )


def _value_code(column: str) -> str:
    return (
        f"i_{column} AS (SELECT v, CAST(ROW_NUMBER() OVER (ORDER BY v) - 1 AS INT) AS code "
        f"FROM (SELECT DISTINCT COALESCE({column}, 'Unknown') AS v FROM sec_all) t)"
    )


def _feature_vector() -> str:
    columns = [*CATEGORIES, "attack_type"]
    slots = ["s.src_port", "s.dst_port", "CAST(s.packet_len AS DOUBLE)", "s.anomaly"]
    slots += [f"CASE WHEN i_{c}.idx = {i} THEN 1.0 ELSE 0.0 END" for c, n in CATEGORIES.items() for i in range(n)]
    numbers = range(len(slots))
    return (
        "WITH " + ",\n".join(_frequency_index(c) for c in columns) + ",\n"
        "x AS (SELECT s.event_id, CAST(i_attack_type.idx AS DOUBLE) AS label, "
        + ", ".join(f"CAST({slot} AS DOUBLE) AS x{i}" for i, slot in enumerate(slots))
        + " FROM sec_complete s "
        + " ".join(f"JOIN i_{c} ON s.{c} = i_{c}.v" for c in columns)
        + "),\nd AS (SELECT "
        + ", ".join(f"STDDEV_SAMP(x{i}) AS s{i}" for i in numbers)
        + f" FROM x)\nSELECT x.event_id, x.label, CAST(UNNEST(RANGE({len(slots)})) AS INT) AS slot, UNNEST(["
        + ", ".join(f"ROUND(CASE WHEN s{i} = 0 THEN 0 ELSE x{i} / s{i} END, 4)" for i in numbers)
        + "]) AS value FROM x CROSS JOIN d"
    )


def _first_vectors() -> str:
    return f"SELECT * FROM ({_feature_vector()}) v WHERE event_id IN (SELECT event_id FROM sec_complete ORDER BY event_id LIMIT 5)"


def _exact_test(rows: str) -> str:
    """The hold-out rows of an exact split: the fifth with the smallest hashes, rounded up."""
    return f"""
SELECT * FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY {LONG_HASH}) AS place, COUNT(*) OVER () AS n FROM {rows}) t
WHERE place <= (n * 20 + 99) // 100"""


def _category_codes() -> str:
    columns = [*CATEGORIES, "attack_type"]
    names = {**{c: f"{c}_enc" for c in CATEGORIES}, "attack_type": "label"}
    return (
        "WITH " + ",\n".join(_value_code(c) for c in columns) + "\nSELECT s.event_id, "
        + ", ".join(f"i_{c}.code AS {names[c]}" for c in columns)
        + " FROM sec_all s "
        + " ".join(f"JOIN i_{c} ON COALESCE(s.{c}, 'Unknown') = i_{c}.v" for c in columns)
    )


def _report_text() -> str:
    titles = [
        "[1] Attack Type Distribution",
        "[2] Severity Level Breakdown",
        "[3] Protocol Distribution (avg packet length)",
        "[4] Avg Anomaly Score per Attack Type",
        "[5] Top-10 Source IPs by Event Count",
        "[6] Severity x Protocol Cross-Tab",
        "[7] Hourly Event Trend",
    ]
    rule = "=" * 60
    headings = [(n, place, words) for n, t in enumerate(titles, 1) for place, words in ((-4, ""), (-3, rule), (-2, t), (-1, rule))]
    headings += [(8, -4, ""), (8, -3, "[DONE] Batch processing complete.")]
    values = ", ".join(f"({n}, {place}, '{words}')" for n, place, words in headings)

    def section(number: int, limit: int, cells: list[str], order: str, inner: str) -> str:
        line = " || ' | ' || ".join(f"COALESCE(CAST({c} AS VARCHAR), 'NULL')" for c in cells)
        return (
            f"SELECT {number}, CAST(rn AS INT), '  ' || {line} FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) AS rn "
            f"FROM ({inner}) g{number}) r{number} WHERE rn <= {limit}"
        )

    def grouped(keys: str, more: str = "") -> str:
        return f"SELECT {keys}, COUNT(*) AS cnt{more} FROM sec_log GROUP BY {keys}"

    return "\nUNION ALL ".join(
        [
            "SELECT CAST(0 AS INT) AS section, CAST(1 AS INT) AS ord, '' AS line WHERE false",
            "SELECT 0, 0, '[OK] Total records loaded: ' || format('{:,}', COUNT(*)) FROM sec_log",
            f"SELECT * FROM (VALUES {values}) v(section, ord, line)",
            section(1, 10, ["attack_type", "cnt"], "cnt DESC, attack_type", grouped("attack_type")),
            section(2, 10, ["severity", "cnt"], "cnt DESC, severity NULLS FIRST", grouped("severity")),
            section(3, 10, ["protocol", "cnt", "a"], "cnt DESC, protocol NULLS FIRST",
                    grouped("protocol", ", ROUND(AVG(packet_len), 6) AS a")),
            section(4, 10, ["attack_type", "a"], "m DESC NULLS LAST, attack_type",
                    grouped("attack_type", ", ROUND(AVG(anomaly), 6) AS a, AVG(anomaly) AS m")),
            section(5, 10, ["src_ip", "cnt"], "cnt DESC, src_ip", grouped("src_ip")),
            section(6, 20, ["severity", "protocol", "cnt"], "severity NULLS FIRST, cnt DESC, protocol NULLS FIRST",
                    grouped("severity, protocol")),
            section(7, 24, ["h", "cnt"], "h", "SELECT hour(ts) AS h, COUNT(*) AS cnt FROM sec_log WHERE ts IS NOT NULL GROUP BY 1"),
        ]
    )


CSV_SCAN = """
SELECT event_id, src_ip, TRY_CAST(src_port_raw AS INT) AS src_port, TRY_CAST(packet_raw AS INT) AS packet_len,
 TRY_CAST(anomaly_raw AS DOUBLE) AS anomaly,
 concat('{"k": ', CAST(CAST(dst_port_raw AS INT) - 1 AS VARCHAR), '},', chr(10), severity) AS payload FROM raw_log"""

STORED = "SELECT event_id, src_ip, attack_type, severity FROM raw_log"

BODIES = {
    "q_total": "SELECT COUNT(*) AS total FROM sec_log",
    "q_attack_distribution": "SELECT attack_type, COUNT(*) AS cnt FROM sec_log GROUP BY attack_type",
    "q_severity_breakdown": "SELECT severity, COUNT(*) AS cnt FROM sec_log GROUP BY severity",
    "q_protocol_packets": "SELECT protocol, COUNT(*) AS cnt, ROUND(AVG(packet_len), 6) AS avg_packet_length FROM sec_log GROUP BY protocol",
    "q_anomaly_by_attack": "SELECT attack_type, ROUND(AVG(anomaly), 6) AS avg_anomaly_score FROM sec_log GROUP BY attack_type",
    "q_top_source_ips": TOP_SOURCES.format(rows="sec_log"),
    "q_severity_protocol": """
SELECT severity, protocol, COUNT(*) AS cnt FROM sec_log GROUP BY severity, protocol ORDER BY severity, cnt DESC, protocol LIMIT 20""",
    "q_hourly_trend": "SELECT CAST(hour(ts) AS INT) AS hour, COUNT(*) AS events FROM sec_log WHERE ts IS NOT NULL GROUP BY 1",
    "q_kpis": KPIS,
    "q_kpis_missing_columns": """
SELECT COUNT(*) AS total_logs, COUNT(DISTINCT attack_type) AS attack_types, CAST(0 AS BIGINT) AS high_severity, CAST(0 AS DOUBLE) AS avg_anomaly
FROM sec_all""",
    "q_value_counts": PROTOCOL_COUNTS,
    "q_severity_counts": "SELECT severity, COUNT(*) AS cnt FROM sec_all WHERE severity IS NOT NULL GROUP BY severity",
    "q_category_share": SHARE.format(key="traffic_type"),
    "q_attack_share": SHARE.format(key="attack_type"),
    "q_anomaly_histogram": HISTOGRAM,
    "q_recent": "SELECT event_id, src_ip, attack_type, severity, protocol, anomaly FROM sec_all ORDER BY event_id DESC LIMIT 15",
    "q_clean_cast": "SELECT event_id, anomaly, packet_len FROM sec_all",
    "q_complete_cases": "SELECT event_id, src_port, dst_port, packet_len, anomaly FROM sec_complete",
    "q_fill_policy": """
SELECT event_id, COALESCE(anomaly, 0) AS anomaly, COALESCE(packet_len, 0) AS packet_len,
 COALESCE(protocol, 'Unknown') AS protocol, COALESCE(attack_type, 'Unknown') AS attack_type FROM sec_all""",
    "q_quality_counts": """
SELECT COUNT(*) AS loaded, COUNT(attack_type) AS with_target, COUNT(ts) AS with_ts,
 (SELECT COUNT(*) FROM sec_complete) AS complete_rows FROM sec_all""",
    "q_unseen_fallback": """
SELECT event_id, CASE WHEN COALESCE(protocol, 'Unknown') IN ('TCP', 'UDP') THEN protocol ELSE 'TCP' END AS protocol_known FROM sec_all""",
    "q_nan_fill": NAN_LOG + " SELECT event_id, COALESCE(anomaly, 0) AS anomaly FROM nan_all",
    "q_nan_kpis": NAN_LOG + KPIS.replace("sec_all", "nan_all"),
    "q_nan_quality": NAN_LOG + """
SELECT COUNT(*) AS loaded, COUNT(attack_type) AS with_target, COUNT(ts) AS with_ts,
 (SELECT COUNT(*) FROM sec_complete WHERE event_id % 103 <> 0) AS complete_rows FROM nan_all""",
    "q_report_lines": """
SELECT 'severity_protocol' AS section,
 concat_ws(' | ', COALESCE(severity, 'NULL'), COALESCE(protocol, 'NULL'), CAST(COUNT(*) AS STRING)) AS line
FROM sec_log GROUP BY severity, protocol""",
    "q_report_text": _report_text(),
    "q_csv_scan": CSV_SCAN,
    "q_csv_by_name": CSV_SCAN,
    "q_csv_inferred": """
SELECT event_id, CAST(src_port_raw AS BIGINT) + CAST(dst_port_raw AS BIGINT) AS ports, attack_type FROM raw_log""",
    "q_csv_na_tokens": """
SELECT event_id, NULLIF(ts_raw, 'n/a') AS ts_text, NULLIF(packet_raw, '') AS packet_text, protocol FROM raw_log""",
    "q_stream_ingest": STORED,
    "q_stream_by_name": STORED,
    "q_stream_restart": "SELECT event_id, CAST(1 AS BIGINT) AS times, CAST(1 AS BIGINT) AS streams FROM raw_log",
    "q_batch_counts": PARTS + """
SELECT part AS batch_id, COUNT(*) AS rows, MIN(stamp) AS first_stamp, MAX(stamp) AS last_stamp FROM parts GROUP BY part""",
    "q_store_recent": RECENT,
    "q_live_recent": RECENT,
    "q_live_grid": GRID,
    "q_live_counts": "SELECT severity, COUNT(*) AS cnt, ROUND(AVG(anomaly), 6) AS avg_anomaly FROM sec_all GROUP BY severity",
    "q_live_kpis": KPIS,
    "q_live_attack_share": SHARE.format(key="attack_type"),
    "q_live_protocol_counts": PROTOCOL_COUNTS,
    "q_live_top_sources": TOP_SOURCES.format(rows="sec_all"),
    "q_live_histogram": HISTOGRAM,
    "q_freq_index": """
SELECT protocol, CAST(ROW_NUMBER() OVER (ORDER BY c DESC, protocol) - 1 AS DOUBLE) AS idx
FROM (SELECT protocol, COUNT(*) AS c FROM sec_complete GROUP BY protocol) t""",
    "q_label_index": f"""
WITH {_frequency_index("attack_type")}
SELECT s.event_id, CAST(i.idx AS DOUBLE) AS label FROM sec_complete s JOIN i_attack_type i ON s.attack_type = i.v""",
    "q_lex_index": """
SELECT p AS protocol, CAST(ROW_NUMBER() OVER (ORDER BY p) - 1 AS DOUBLE) AS code
FROM (SELECT DISTINCT COALESCE(protocol, 'Unknown') AS p FROM sec_all) t""",
    "q_many_labels": """
SELECT event_id, CAST(ROW_NUMBER() OVER (ORDER BY CAST(event_id AS VARCHAR)) - 1 AS DOUBLE) AS id_idx, CAST(idx AS DOUBLE) AS ip_idx
FROM sec_all JOIN (SELECT src_ip, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, src_ip) - 1 AS idx FROM sec_all GROUP BY src_ip) i USING (src_ip)""",
    "q_category_codes": _category_codes(),
    "q_code_names": "SELECT event_id, COALESCE(attack_type, 'Unknown') AS name FROM sec_all",
    "q_stored_codes": """
SELECT event_id, CAST(CASE WHEN protocol = 'TCP' THEN 1 ELSE 0 END AS INT) AS protocol_enc, CAST(0 AS INT) AS severity_enc FROM sec_all""",
    "q_one_hot": """
WITH i AS (SELECT protocol, ROW_NUMBER() OVER (ORDER BY c DESC, protocol) - 1 AS idx
 FROM (SELECT protocol, COUNT(*) AS c FROM sec_complete GROUP BY protocol) t)
SELECT s.event_id, CAST(j.idx AS INT) AS slot, CAST(CASE WHEN i.idx = j.idx THEN 1 ELSE 0 END AS DOUBLE) AS value
FROM sec_complete s JOIN i ON s.protocol = i.protocol CROSS JOIN i j""",
    "q_scaled_measure": """
SELECT s.event_id, ROUND(s.anomaly / m.sd, 4) AS anomaly_scaled
FROM sec_complete s CROSS JOIN (SELECT STDDEV_SAMP(anomaly) AS sd FROM sec_complete) m""",
    "q_feature_vector": _feature_vector(),
    "q_saved_pipeline": _feature_vector(),
    "q_feature_sample": _first_vectors(),
    "q_random_split": "SELECT event_id, CAST(1 AS BIGINT) AS sides FROM sec_complete",
    "q_exact_split": f"""
WITH test AS ({_exact_test("sec_complete")})
SELECT event_id, CASE WHEN event_id IN (SELECT event_id FROM test) THEN 'test' ELSE 'train' END AS split FROM sec_complete""",
    "q_forest_spark": f"""
WITH i AS (SELECT attack_type, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, attack_type) - 1 AS idx FROM sec_complete
 WHERE {HASH_TRAIN} GROUP BY attack_type)
SELECT event_id, CAST(idx AS DOUBLE) AS label, true AS known_class FROM sec_complete JOIN i USING (attack_type) WHERE NOT {HASH_TRAIN}""",
    "q_forest_codes": f"""
SELECT event_id, COALESCE(attack_type, 'Unknown') AS attack_type, true AS known_class FROM ({_exact_test("sec_all")}) t""",
    "q_forest_report": f"""
WITH c AS (SELECT attack_type, COUNT(*) AS support FROM sec_complete WHERE NOT {HASH_TRAIN} GROUP BY attack_type)
SELECT 'class' AS kind, support, true AS in_range FROM c
UNION ALL SELECT 'average', CAST(SUM(support) AS BIGINT), true FROM c, (SELECT UNNEST([1, 2, 3]) AS line) GROUP BY line""",
    "q_scored_events": """
SELECT event_id, COALESCE(protocol, 'Unknown') AS protocol, true AS known_class, true AS in_range FROM sec_all""",
    "q_scored_stream": "SELECT event_id, protocol, true AS known_class, true AS in_range FROM sec_all",
    "q_hash_split": """
SELECT event_id, CASE WHEN CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS split
FROM sec_complete""",
    "q_class_report": RULE_SCORED + """
SELECT cls, ROUND(prec, 6) AS precision_, ROUND(rec, 6) AS recall_, ROUND(f1, 6) AS f1, support FROM c""",
    "q_class_summary": RULE_SCORED + """
SELECT ROUND(SUM(tp) / SUM(support), 6) AS accuracy, ROUND(AVG(f1), 6) AS macro_f1, ROUND(SUM(f1 * support) / SUM(support), 6) AS weighted_f1 FROM c""",
    "q_printed_report": RULE_SCORED + """
SELECT 'class' AS kind, cls AS name, ROUND(prec, 6) AS precision_, ROUND(rec, 6) AS recall_, ROUND(f1, 6) AS f1, support FROM c
UNION ALL SELECT 'average', 'accuracy', ROUND(SUM(tp) / SUM(support), 6), ROUND(SUM(tp) / SUM(support), 6), ROUND(SUM(tp) / SUM(support), 6),
 CAST(SUM(support) AS BIGINT) FROM c
UNION ALL SELECT 'average', 'macro avg', ROUND(AVG(prec), 6), ROUND(AVG(rec), 6), ROUND(AVG(f1), 6), CAST(SUM(support) AS BIGINT) FROM c
UNION ALL SELECT 'average', 'weighted avg', ROUND(SUM(prec * support) / SUM(support), 6), ROUND(SUM(rec * support) / SUM(support), 6),
 ROUND(SUM(f1 * support) / SUM(support), 6), CAST(SUM(support) AS BIGINT) FROM c""",
    "q_unscored": "SELECT event_id, protocol, anomaly FROM sec_all",
    "q_scoring_error": """SELECT event_id, 'Error' AS "Predicted_Attack", CAST(0 AS DOUBLE) AS "Confidence_Pct" FROM sec_all""",
}


def oracle_statements() -> dict[str, str]:
    """Every body behind the views; a body with its own WITH continues their list."""
    statements = {}
    for name, body in BODIES.items():
        body = body.strip()
        joined = f"{VIEWS.strip()},\n{body[5:]}" if body.upper().startswith("WITH ") else f"{VIEWS.strip()}\n{body}"
        statements[name] = joined
    return statements
