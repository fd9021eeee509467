"""Common table expressions shared by the SQL counterparts; all start from the given tables."""

LINES = """lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS conversationId,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS sessionId,
    'agent-' || l_suppkey AS agentId, 'queue-' || (l_partkey % 25) AS queueId,
    CASE WHEN l_returnflag <> 'N' THEN 'code-' || (l_partkey % 10) END AS wrapUpCode,
    CASE l_returnflag WHEN 'A' THEN 'voice' WHEN 'R' THEN 'chat' ELSE 'email' END AS mediaType,
    CASE WHEN l_linestatus = 'O' THEN 'outbound' ELSE 'inbound' END AS originatingDirection,
    t0 AS segmentStart, t0 + to_seconds(qty * 10) AS talkEnd, t0 + to_seconds(qty * 10 + 30) AS segmentEnd,
    qty AS quantity, CAST(round(l_discount * 100) AS BIGINT) AS discountPct,
    CAST(round(l_tax * 100) AS BIGINT) AS taxPct, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
    l_linenumber AS lineNumber, l_returnflag AS returnFlag
  FROM (SELECT *, CAST(l_quantity AS INTEGER) AS qty,
          l_shipdate + to_seconds((l_partkey * 37 + l_linenumber * 613) % 86400) AS t0 FROM lineitem))"""

SESSIONS = LINES + """, sessions AS (
  SELECT *, 'customer' AS purpose, '-c' AS suffix, NULL AS userId, segmentStart AS sStart, talkEnd AS sEnd,
    NULL AS firstQueue, NULL AS lastCode, NULL AS lastNote FROM lines
  UNION ALL SELECT *, 'acd', '-q', NULL, segmentStart, segmentStart + to_seconds(discountPct), queueId, NULL, NULL
    FROM lines WHERE lineNumber < 4
  UNION ALL SELECT *, 'agent', '-a', agentId, segmentStart, segmentEnd, queueId, wrapUpCode,
    CASE WHEN returnFlag = 'R' THEN 'note ' || lineNumber END FROM lines),
segments AS (
  SELECT *, sStart AS gStart, sEnd AS gEnd, CASE purpose WHEN 'customer' THEN 'ivr' ELSE 'interact' END AS segmentType,
    NULL AS code FROM sessions WHERE purpose <> 'agent'
  UNION ALL SELECT *, segmentStart, talkEnd, 'interact', NULL FROM sessions WHERE purpose = 'agent'
  UNION ALL SELECT *, talkEnd, segmentEnd, 'wrapup', wrapUpCode FROM sessions WHERE purpose = 'agent'),
metrics AS (
  SELECT s.*, m.name, CAST(m.value AS BIGINT) AS value, m.at AS emitDate FROM sessions s, LATERAL (
    SELECT unnest(CASE purpose
      WHEN 'customer' THEN [{'name': 'nConnected', 'value': 1, 'at': segmentStart},
        {'name': 'tIvr', 'value': taxPct * 1000, 'at': segmentStart}]
      WHEN 'acd' THEN [{'name': 'nOffered', 'value': 1, 'at': segmentStart},
        {'name': 'tAcd', 'value': discountPct * 1000, 'at': segmentStart}]
      ELSE [{'name': 'nConnected', 'value': 1, 'at': segmentStart},
        {'name': 'tHandle', 'value': quantity * 10000 + 30000, 'at': segmentStart},
        {'name': 'tTalkComplete', 'value': quantity * 10000, 'at': segmentStart},
        {'name': 'tHeldComplete', 'value': discountPct * 1000, 'at': segmentStart},
        {'name': 'tAcw', 'value': taxPct * 1000, 'at': segmentEnd},
        {'name': 'nTransferred', 'value': CASE WHEN returnFlag = 'R' THEN 1 END, 'at': segmentEnd}] END) AS m))"""

EVENTS = """ev AS (
  SELECT event_id AS eventId, date_trunc('second', ts) AS ts, 'u' || user_id AS userId, user_id AS userNo,
    event_type AS eventType, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    CAST(round(value * 100) AS BIGINT) AS cents, event_id // 5 AS conversationId,
    'queue-' || (user_id % 20) AS queueId,
    CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 WHEN 0 THEN 'voice' WHEN 1 THEN 'chat' ELSE 'email' END AS mediaType
  FROM events)"""

INTERVALS = EVENTS + """, iv AS (
  SELECT eventId, userId, eventType AS status, ts AS startTime, ts + to_seconds(k * 60) AS endTime, k, userNo FROM ev)"""

TURNS = """turns AS (
  SELECT conv_id AS conversationId, turn + 1 AS line, role AS participant, text AS phrase,
    TIMESTAMP '2024-01-01' + to_seconds(conv_id * 60 + turn) AS startTime,
    TIMESTAMP '2024-01-01' + to_seconds(conv_id * 60 + turn + 1) AS endTime
  FROM conversations)"""

USERS = """zones(region, timeZone) AS (VALUES ('AFRICA', 'Africa/Johannesburg'), ('AMERICA', 'America/New_York'),
  ('ASIA', 'Asia/Kolkata'), ('EUROPE', 'Europe/Berlin'), ('MIDDLE EAST', 'Asia/Dubai')),
users AS (
  SELECT 'u' || c_custkey AS userId, c_custkey AS userNo, c_name AS userName, c_mktsegment AS department,
    n_name AS groupName, r_name AS region, timeZone, 'u' || (c_custkey // 10 * 10) AS managerId,
    CASE WHEN c_acctbal < 0 THEN 'inactive' ELSE 'active' END AS state,
    CAST(round(c_acctbal * 100) AS BIGINT) AS balanceCents
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN zones ON zones.region = r_name)"""

PHRASES = """phrases AS (
  SELECT conv_id, turn, CAST(conv_id AS VARCHAR) AS conversationId, conv_id || '-' || turn AS communicationId,
    CASE WHEN turn % 2 = 0 THEN 'call' ELSE 'message' END AS mediaType,
    CASE role WHEN 'user' THEN 'external' WHEN 'assistant' THEN 'internal' ELSE 'acd' END AS purpose,
    1704067200000 + conv_id * 60000 + turn * 1000 AS base, i - 1 AS phraseIndex, parts[i] AS text
  FROM (SELECT *, string_split(text, chr(10)) AS parts FROM conversations), LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i))"""


def with_(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "

MART = LINES + """, oc AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS conversationId, o_orderkey, o_custkey, o_orderdate AS conversationStart, o_orderdate + INTERVAL 1 HOUR AS conversationEnd,
    CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS conversationStartDateId, CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS originatingDirectionId,
    CASE o_orderkey % 3 WHEN 0 THEN 5 WHEN 1 THEN 1 ELSE 2 END AS mediaTypeId, 'site ' || (o_custkey % 4) AS location FROM orders),
prt AS (SELECT conversationId, sessionId AS participantId, CASE WHEN lineNumber % 2 = 1 THEN 'agent' ELSE 'acd' END AS purpose,
    CASE WHEN lineNumber % 2 = 1 THEN agentId END AS userId FROM lines),
seg AS (SELECT conversationId, sessionId AS participantId, queueId, segmentStart, segmentEnd,
    CASE WHEN wrapUpCode IS NOT NULL THEN 'wrapup' ELSE 'interact' END AS segmentType, wrapUpCode AS wrapUpCodeId FROM lines),
met AS (SELECT * FROM (SELECT conversationId, sessionId AS participantId, segmentEnd AS eventTime, m.name, CAST(m.value AS BIGINT) AS value FROM lines, LATERAL (SELECT unnest([
    {'name': 'tHandle', 'value': quantity * 1000}, {'name': 'tTalkComplete', 'value': quantity * 700},
    {'name': 'tHeldComplete', 'value': CASE WHEN discountPct > 0 THEN discountPct * 1000 END}, {'name': 'tHeld', 'value': CASE WHEN discountPct > 0 THEN discountPct * 1000 END},
    {'name': 'tAcw', 'value': CASE WHEN taxPct > 0 THEN taxPct * 1000 END}, {'name': 'nBlindTransferred', 'value': CASE WHEN returnFlag = 'R' AND taxPct > 4 THEN 1 END},
    {'name': 'nConsultTransferred', 'value': CASE WHEN returnFlag = 'A' AND taxPct > 6 THEN 1 END}, {'name': 'nConsult', 'value': CASE WHEN returnFlag = 'A' AND taxPct > 3 THEN 1 END}]) AS m)) WHERE value IS NOT NULL),
ins AS (SELECT CAST(o_orderkey AS VARCHAR) AS conversationId, CASE o_orderstatus WHEN 'F' THEN 'Resolved' WHEN 'P' THEN 'Partially Resolved' ELSE 'not resolved' END AS resolved,
    CASE substring(o_orderpriority, 1, 1) WHEN '5' THEN 'lowest' WHEN '4' THEN 'low' WHEN '3' THEN 'medium' WHEN '2' THEN 'High' ELSE 'highest' END AS satisfaction,
    CASE WHEN o_orderkey % 4 = 0 THEN 'Yes' ELSE 'no' END AS additional_service, 'process ' || (o_custkey % 6) AS process_name FROM orders WHERE o_orderkey % 6 <> 0),
rea AS (SELECT CAST(o_orderkey AS VARCHAR) AS conversationId, 'reason ' || (o_custkey % 5) AS contactReason, 'inquiry ' || (o_custkey % 7) AS mainInquiry,
    'cause ' || (o_custkey % 3) AS rootCause FROM orders WHERE o_orderkey % 5 <> 0),
que AS (SELECT DISTINCT 'queue-' || (p_partkey % 25) AS queueId, 'Queue ' || (p_partkey % 25) AS queueName, CASE WHEN p_partkey % 25 % 2 = 0 THEN 'English' ELSE 'German' END AS language,
    (['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'])[p_partkey % 25 % 5 + 1] AS region,
    (['Africa/Johannesburg', 'America/New_York', 'Asia/Kolkata', 'Europe/Berlin', 'Asia/Dubai'])[p_partkey % 25 % 5 + 1] AS timeZone FROM part WHERE p_partkey % 25 <> 24),
cod AS (SELECT DISTINCT 'code-' || (p_partkey % 10) AS wrapUpCodeId, 'Code ' || (p_partkey % 10) AS wrapUpCode, p_partkey % 10 < 3 AS sales, p_partkey % 10 < 6 AS decisionMakerContact
    FROM part WHERE p_partkey % 10 <> 9),
zon(region, timeZone) AS (VALUES ('AFRICA', 'Africa/Johannesburg'), ('AMERICA', 'America/New_York'), ('ASIA', 'Asia/Kolkata'), ('EUROPE', 'Europe/Berlin'), ('MIDDLE EAST', 'Asia/Dubai')),
agt AS (SELECT 'agent-' || s_suppkey AS userId, s_name AS userName, n_name AS teamName, r_name AS region, timeZone, s_acctbal > 0 AS active, s_suppkey AS userNo
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN zon ON zon.region = r_name),
fq AS (SELECT conversationId, queueId FROM seg WHERE queueId IS NOT NULL QUALIFY row_number() OVER (PARTITION BY conversationId ORDER BY segmentEnd DESC, participantId DESC) = 1),
fc AS (SELECT conversationId, wrapUpCodeId AS finalWrapupCode, participantId FROM seg WHERE wrapUpCodeId IN (SELECT wrapUpCodeId FROM cod)
    QUALIFY row_number() OVER (PARTITION BY conversationId ORDER BY segmentEnd DESC, participantId DESC) = 1)"""
