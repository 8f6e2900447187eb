"""The same results as SQL over the given tables, for checking (DuckDB dialect).

Written independently of the Spark plans: brute force where Spark prunes, recursion where Spark
works in rounds. ``sql(key)`` puts the needed views in front of a query.
"""

from __future__ import annotations

_VIEWS: dict[str, tuple[list[str], str]] = {}
_QUERIES: dict[str, tuple[list[str], str]] = {}


def _view(name: str, needs: list[str], body: str) -> None:
    _VIEWS[name] = (needs, body)


def _query(key: str, needs: list[str], body: str) -> None:
    _QUERIES[key] = (needs, body)


def sql(key: str) -> str:
    needs, body = _QUERIES[key]
    ordered: list[str] = []

    def add(name: str) -> None:
        for n in _VIEWS[name][0]:
            add(n)
        if name not in ordered:
            ordered.append(name)

    for n in needs:
        add(n)
    if not ordered:
        return body.strip()
    views = ",\n".join(f"{n} AS ({_VIEWS[n][1].strip()})" for n in ordered)
    return f"WITH RECURSIVE {views}\n{body.strip()}"


def all_sql() -> dict[str, str]:
    return {k: sql(k) for k in _QUERIES}


# ---------------------------------------------------------------- base views
_view("prices", [], """
SELECT provider, model, CAST(p AS DOUBLE) AS p, CAST(c AS DOUBLE) AS c FROM (VALUES
 ('openai','gpt-4',0.03,0.06), ('openai','gpt-4-turbo-preview',0.01,0.03),
 ('openai','gpt-3.5-turbo',0.0015,0.002), ('openai','gpt-4o-mini',0.00015,0.0006),
 ('gemini','gemini-pro',0.0005,0.0015), ('gemini','gemini-pro-vision',0.001,0.002),
 ('gemini','gemini-1.5-pro',0.00125,0.005), ('gemini','gemini-1.5-flash',0.000075,0.0003),
 ('gemini','gemini-2.5-flash-lite',0.000075,0.0003)) v(provider, model, p, c)
""")
_view("raw_requests", [], """
SELECT id, user_id, request_timestamp, provider, model, prompt_tokens, completion_tokens,
       prompt_tokens + completion_tokens AS total_tokens, duration_ms, cache_hit, pii_detected, status
FROM (SELECT event_id AS id, user_id, CAST(ts AS TIMESTAMP) AS request_timestamp,
        CASE WHEN event_id % 3 = 0 THEN 'gemini' ELSE 'openai' END AS provider,
        CASE event_id % 9 WHEN 0 THEN 'gemini-1.5-pro' WHEN 3 THEN 'gemini-1.5-flash'
             WHEN 6 THEN 'gemini-2.5-flash-lite' WHEN 1 THEN 'gpt-4' WHEN 2 THEN 'gpt-4-turbo-preview'
             WHEN 4 THEN 'gpt-3.5-turbo' WHEN 5 THEN 'unpriced-model' ELSE 'gpt-4o-mini' END AS model,
        20 + 13 * CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS prompt_tokens,
        CAST(floor(value * 10) AS INT) AS completion_tokens,
        50 + CAST(floor(value * 20) AS INT) AS duration_ms,
        event_id % 5 = 0 AS cache_hit, event_id % 7 = 0 AS pii_detected,
        CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'blocked'
             ELSE 'completed' END AS status
      FROM events) t
""")
_view("requests", ["prices", "raw_requests"], """
SELECT r.*, prompt_tokens / 1000.0::DOUBLE * coalesce(p, 0::DOUBLE)
     + completion_tokens / 1000.0::DOUBLE * coalesce(c, 0::DOUBLE) AS cost_usd
FROM raw_requests r LEFT JOIN prices USING (provider, model)
""")
_view("pii_probe", [], """
SELECT o_orderkey AS doc_id,
  concat('id ', tckn, ' iban TR',
         lpad(CAST(98 - (o_orderkey * 1000000 + 292700) % 97 AS VARCHAR), 2, '0'),
         lpad(CAST(o_orderkey AS VARCHAR), 22, '0'),
         ' paid ', CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR), ' TRY') AS text
FROM (SELECT o_orderkey, o_totalprice,
   concat(CAST(b AS VARCHAR), CAST(d10 AS VARCHAR),
          CAST((s9 + d10 + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END) % 10 AS VARCHAR)) AS tckn
 FROM (SELECT *, (7 * od - ev + 70) % 10 AS d10, od + ev AS s9 FROM (SELECT *,
   (b//100000000)%10 + (b//1000000)%10 + (b//10000)%10 + (b//100)%10 + b%10 AS od,
   (b//10000000)%10 + (b//100000)%10 + (b//1000)%10 + (b//10)%10 AS ev
   FROM (SELECT o_orderkey, o_totalprice, 100000000 + (o_orderkey * 7919) % 900000000 AS b FROM orders) x) y) z) w
""")
_view("texts", ["pii_probe"], """
SELECT doc_id, text FROM documents UNION ALL SELECT -1 - doc_id, text FROM pii_probe
""")
_view("budgets", [], """
SELECT DISTINCT user_id, 0.5::DOUBLE + 0.1::DOUBLE * (user_id % 5) AS limit_usd,
       CASE user_id % 3 WHEN 0 THEN 'daily' WHEN 1 THEN 'weekly' ELSE 'monthly' END AS period
FROM events WHERE user_id % 7 <> 0
""")

# ---------------------------------------------------------------- spans
_FOUND = """
SELECT doc_id, {pos} AS ord, '{type}' AS type, m AS entity,
       CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g)))
          + coalesce(list_sum(list_transform(ms[1:i-1], lambda g: length(g))), 0) AS INT) AS span_start, m_len
FROM (SELECT doc_id, gaps, ms, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, length(unnest(ms)) AS m_len
      FROM (SELECT doc_id, regexp_extract_all(text, '{re}') AS ms, string_split_regex(text, '{re}') AS gaps
            FROM {src} WHERE regexp_matches(text, '{re}')) x) y
"""
_RE = {
    "TCKN": r"\b\d{11}\b",
    "PHONE": r"(?:\+90\s?)?(?:\(?\d{3}\)?[\s.-]?)?\d{3}[\s.-]?\d{2}[\s.-]?\d{2}\b",
    "EMAIL": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "IBAN": r"\bTR\d{2}\s?\d{4}\s?\d{4}\s?\d{4}\s?\d{4}\s?\d{4}\s?\d{2}\b",
    "CREDIT_CARD": r"\b\d{4}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}\b",
    "AMOUNT": r"(?i)\b\d+[.,]\d{2}\s*(?:TL|TRY|USD|EUR|GBP)\b",
}
_DIGIT = "CAST(substr(entity, {i}, 1) AS INT)"
_TCKN_ODD = " + ".join(_DIGIT.format(i=i) for i in (1, 3, 5, 7, 9))
_TCKN_EVEN = " + ".join(_DIGIT.format(i=i) for i in (2, 4, 6, 8))
_VALID = {
    "TCKN": f"({_TCKN_ODD} + {_TCKN_EVEN} + {_DIGIT.format(i=10)}) % 10 = {_DIGIT.format(i=11)} "
            f"AND (7 * ({_TCKN_ODD}) - ({_TCKN_EVEN}) + 70) % 10 = {_DIGIT.format(i=10)}",
    "IBAN": "CAST(substr(replace(entity, ' ', ''), 5) || '2927' || substr(replace(entity, ' ', ''), 3, 2) AS HUGEINT) % 97 = 1",
    "CREDIT_CARD": "list_sum(list_transform(range(1, 17), lambda k: CASE WHEN k % 2 = 0 "
                   "THEN CAST(substr(regexp_replace(entity, '[\\s-]', '', 'g'), k, 1) AS INT) "
                   "ELSE (2 * CAST(substr(regexp_replace(entity, '[\\s-]', '', 'g'), k, 1) AS INT)) % 10 "
                   "+ (2 * CAST(substr(regexp_replace(entity, '[\\s-]', '', 'g'), k, 1) AS INT)) // 10 END)) % 10 = 0",
}
_TYPES = ["TCKN", "PHONE", "EMAIL", "IBAN", "CREDIT_CARD", "AMOUNT"]


def _spans(source: str, types=tuple(_TYPES)) -> str:
    parts = []
    for t in types:
        found = _FOUND.format(pos=_TYPES.index(t), type=t, re=_RE[t], src=source)
        parts.append(
            f"SELECT doc_id, ord, type, entity, span_start, CAST(span_start + m_len AS INT) AS span_end "
            f"FROM ({found}) f WHERE {_VALID.get(t, 'true')}"
        )
    return "\nUNION ALL\n".join(parts)


_view("spans", ["texts"], _spans("texts"))
_view("doc_spans", [], _spans("documents"))
_SPAN_COLUMNS = "doc_id, type, entity, span_start, span_end, CAST(1.0 AS DOUBLE) AS confidence"
for _i, _t in enumerate(["TCKN", "PHONE", "EMAIL", "IBAN", "CREDIT_CARD", "AMOUNT"], start=1):
    _view(f"spans_{_t.lower()}", ["texts"], _spans("texts", (_t,)))
    _query(f"d{_i}", [f"spans_{_t.lower()}"], f"SELECT {_SPAN_COLUMNS} FROM spans_{_t.lower()}")
_view("word_spans", [], _FOUND.format(pos=0, type="NUMBER", re=r"\d+", src="documents"))
_query("d7", ["word_spans"], """
SELECT doc_id, type, entity, span_start, CAST(span_start + m_len AS INT) AS span_end, CAST(1.0 AS DOUBLE) AS confidence
FROM word_spans""")
_query("d8", ["spans"], f"SELECT {_SPAN_COLUMNS} FROM spans")
_query("d9", [], """
SELECT doc_id, CASE WHEN regexp_matches(text, '[çğıöşüÇĞIİÖŞÜ]') THEN 'tr' ELSE 'en' END AS guess,
  CASE WHEN regexp_matches(text, '[ğışĞİŞ]') THEN 'tr' ELSE 'en' END AS strict_guess FROM documents""")
_view("ner", [], """
SELECT doc_id, ['PERSON','ORG','GPE','LOC','MONEY','DATE','NORP'][CAST(doc_id % 7 + 1 AS INT)] AS label,
  substr(text, CAST(doc_id % 50 + 1 AS INT), 8) AS entity,
  CAST(doc_id % 50 AS INT) AS span_start, CAST(doc_id % 50 + 8 AS INT) AS span_end FROM documents
UNION ALL
SELECT doc_id, ['PERSON','ORG','GPE','LOC','MONEY','DATE','NORP'][CAST(ord % 7 + 1 AS INT)], entity,
  CAST(greatest(span_start - doc_id % 3, 0) AS INT), CAST(span_end + doc_id % 4 AS INT) FROM doc_spans
""")
_view("labels_dim", [], """
SELECT * FROM (VALUES ('PERSON','PERSON',0.8::DOUBLE), ('ORG','ORGANIZATION',0.8::DOUBLE),
 ('GPE','LOCATION',0.9::DOUBLE), ('LOC','LOCATION',0.9::DOUBLE), ('MONEY','AMOUNT',0.9::DOUBLE),
 ('DATE','DATE',0.9::DOUBLE)) v(label, type, confidence)""")
_view("mapped", ["doc_spans", "ner", "labels_dim"], """
SELECT doc_id, label, type, entity, span_start, span_end, confidence FROM ner JOIN labels_dim USING (label)""")
_query("d10", ["mapped"], "SELECT doc_id, label, type, entity, span_start, span_end, confidence FROM mapped")
_view("unsuppressed", ["mapped"], """
SELECT * FROM mapped n WHERE NOT EXISTS (SELECT 1 FROM doc_spans r WHERE r.doc_id = n.doc_id AND
  ((r.span_start <= n.span_start AND n.span_start < r.span_end)
   OR (r.span_start < n.span_end AND n.span_end <= r.span_end)))""")
_query("d11", ["unsuppressed"], "SELECT doc_id, type, entity, span_start, span_end FROM unsuppressed")
_MERGE = """
SELECT doc_id, k, type, entity, span_start, span_end, confidence, false AS closed,
  CAST(NULL AS VARCHAR) AS c_type, CAST(NULL AS VARCHAR) AS c_entity, CAST(NULL AS INT) AS c_start, CAST(NULL AS INT) AS c_end
FROM {src} WHERE k = 1
UNION ALL
SELECT s.doc_id, s.k,
  CASE WHEN s.span_start >= m.span_end OR s.confidence > m.confidence THEN s.type ELSE m.type END,
  CASE WHEN s.span_start >= m.span_end OR s.confidence > m.confidence THEN s.entity ELSE m.entity END,
  CASE WHEN s.span_start >= m.span_end OR s.confidence > m.confidence THEN s.span_start ELSE m.span_start END,
  CASE WHEN s.span_start >= m.span_end OR s.confidence > m.confidence THEN s.span_end ELSE m.span_end END,
  CASE WHEN s.span_start >= m.span_end OR s.confidence > m.confidence THEN s.confidence ELSE m.confidence END,
  s.span_start >= m.span_end, m.type, m.entity, m.span_start, m.span_end
FROM {merged} m JOIN {src} s ON s.doc_id = m.doc_id AND s.k = m.k + 1
"""
_KEPT = """
SELECT doc_id, c_type AS type, c_entity AS entity, c_start AS span_start, c_end AS span_end FROM {merged} WHERE closed
UNION ALL
SELECT doc_id, type, entity, span_start, span_end FROM {merged} QUALIFY k = max(k) OVER (PARTITION BY doc_id)
"""
_view("detailed", ["unsuppressed"], """
SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY span_start, grp, ord, span_end, type, entity, confidence) AS k FROM (
 SELECT doc_id, type, entity, span_start, span_end, 1.0::DOUBLE AS confidence, 0 AS grp, ord FROM doc_spans
 UNION ALL SELECT doc_id, type, entity, span_start, span_end, confidence, 1, 0 FROM unsuppressed) u""")
_view("detailed_merge", ["detailed"], _MERGE.format(src="detailed", merged="detailed_merge"))
_view("detailed_kept", ["detailed_merge"], _KEPT.format(merged="detailed_merge"))
_query("d12", ["detailed_kept"], "SELECT doc_id, type, entity, span_start, span_end FROM detailed_kept")
_view("word_list", [], """
SELECT * FROM (VALUES ('Is','ORG'), ('That','PERSON'), ('Le','GPE'), ('El','LOC'), ('Die','DATE'), ('the','PERSON')) v(word, label)""")
_WORD_RE = r"[\w\p{L}\p{M}\p{N}''-]+"
_view("words", [], f"""
SELECT doc_id, m AS entity, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS INT) AS span_end
FROM (SELECT doc_id, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap
      FROM (SELECT doc_id, regexp_extract_all(text, '{_WORD_RE}') AS ms, string_split_regex(text, '{_WORD_RE}') AS gaps FROM documents) x) y""")
_query("d13", ["words", "word_list"], """
SELECT w.doc_id, g.label, w.entity, CAST(w.span_end - length(w.entity) AS INT) AS span_start, w.span_end
FROM words w JOIN word_list g ON g.word = w.entity""")
_query("d14", ["spans"], """
SELECT t.doc_id, count(s.type) > 0 AS pii_detected, CAST(count(s.type) AS INT) AS entity_count, """ + ", ".join(
    f"CAST(count(*) FILTER (s.type = '{t}') AS INT) AS n_{t.lower()}" for t in _TYPES
) + " FROM texts t LEFT JOIN spans s USING (doc_id) GROUP BY t.doc_id")

# ---------------------------------------------------------------- masking
_view("ordered_spans", ["spans"], """
SELECT doc_id, type, entity, span_start, span_end, 1.0::DOUBLE AS confidence,
  row_number() OVER (PARTITION BY doc_id ORDER BY span_start, ord) AS k FROM spans""")
_view("span_merge", ["ordered_spans"], _MERGE.format(src="ordered_spans", merged="span_merge"))
_view("kept", ["span_merge"], _KEPT.format(merged="span_merge"))
_view("tokens", ["kept"], """
SELECT *, type || '_' || CAST(row_number() OVER (PARTITION BY doc_id ORDER BY span_start DESC) - 1 AS VARCHAR) AS entity_id,
  'session_' || md5(CAST(doc_id AS VARCHAR)) AS session_id,
  coalesce(lag(span_end) OVER (PARTITION BY doc_id ORDER BY span_start), 0) AS gap_start FROM kept""")
_view("masked", ["tokens"], """
SELECT t.doc_id, coalesce(m.session_id, '') AS session_id, coalesce(m.masked || substr(t.text, m.tail + 1), t.text) AS masked_text,
  CAST(coalesce(m.n, 0) AS INT) AS n_masked
FROM texts t LEFT JOIN (
  SELECT k.doc_id, min(k.session_id) AS session_id, max(k.span_end) AS tail, count(*) AS n,
    string_agg(substr(x.text, k.gap_start + 1, k.span_start - k.gap_start)
      || '<' || k.type || ':' || k.session_id || ':' || k.entity_id || '>', '' ORDER BY k.span_start) AS masked
  FROM tokens k JOIN texts x USING (doc_id) GROUP BY k.doc_id) m USING (doc_id)""")
_query("m1", ["masked"], "SELECT doc_id, session_id, masked_text, n_masked FROM masked")
_query("m2", ["tokens"], """
SELECT session_id, entity_id, type, entity AS original, TIMESTAMP '2024-01-01 00:00:00' AS created_at,
  TIMESTAMP '2024-01-01 01:00:00' AS expires_at FROM tokens""")
_query("m3", ["masked"], """
SELECT t.doc_id, t.text AS restored, m.masked_text AS after_expiry FROM texts t JOIN masked m USING (doc_id)""")
_query("j6", ["texts"], "SELECT doc_id, text FROM texts")
_query("x6", ["texts"], "SELECT doc_id, text FROM texts")
_view("turn_texts", [], """SELECT conv_id * 100000 + turn AS doc_id, conv_id, turn, role, text
  || CASE WHEN (conv_id + turn) % 3 = 0 THEN ' Write to u' || turn || '@example.com.' ELSE '' END
  || CASE WHEN (conv_id + turn) % 5 = 0 THEN ' Card 4111-1111-1111-1111.' ELSE '' END AS text FROM conversations""")
_view("turn_spans", ["turn_texts"], _spans("turn_texts"))
_view("turn_ordered", ["turn_spans"], _VIEWS["ordered_spans"][1].replace("FROM spans", "FROM turn_spans"))
_view("turn_merge", ["turn_ordered"], _MERGE.format(src="turn_ordered", merged="turn_merge"))
_view("turn_kept", ["turn_merge"], _KEPT.format(merged="turn_merge"))
_view("turn_tokens", ["turn_kept"], _VIEWS["tokens"][1].replace("FROM kept", "FROM turn_kept").replace(
    "md5(CAST(doc_id AS VARCHAR))", "md5(CAST(doc_id // 100000 AS VARCHAR) || ':' || CAST(doc_id % 100000 AS VARCHAR))"))
_view("turn_masked", ["turn_tokens", "turn_texts"], _VIEWS["masked"][1].replace("texts", "turn_texts").replace("FROM tokens", "FROM turn_tokens"))
_query("m4", ["turn_masked"], """
SELECT conv_id, turn, role, session_id, masked_text, n_masked FROM turn_masked JOIN turn_texts USING (doc_id)""")

# ---------------------------------------------------------------- guardrails and screening
_view("broken", ["spans"], """
SELECT t.doc_id, t.text,
  coalesce(s.n, 0) AS n_entities, s.hard, s.soft,
  regexp_matches(t.text, '(?i)violence|hate') AS content
FROM texts t LEFT JOIN (
  SELECT doc_id, count(*) AS n,
    '[' || string_agg('''' || type || '''', ', ' ORDER BY ord, span_start) FILTER (type IN ('TCKN','CREDIT_CARD','IBAN')) || ']' AS hard,
    '[' || string_agg('''' || type || '''', ', ' ORDER BY ord, span_start) FILTER (type IN ('EMAIL','PHONE')) || ']' AS soft
  FROM spans GROUP BY doc_id) s USING (doc_id)""")
_view("violations", ["broken"], """
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY r) - 1 AS INT) AS position, rule_name, severity, action, message FROM (
 SELECT doc_id, 1 AS r, 'no_pii_in_output' AS rule_name, 'error' AS severity, 'block' AS action, 'PII detected: ' || hard AS message FROM broken WHERE hard IS NOT NULL
 UNION ALL SELECT doc_id, 2, 'content_filter', 'warning', 'log', 'Content matches filtered patterns' FROM broken WHERE content
 UNION ALL SELECT doc_id, 4, 'custom_pii_detection', 'warning', 'log', 'PII detected: ' || soft FROM broken WHERE soft IS NOT NULL) v""")
_SPAN_JSON = ("'{\"type\":\"' || type || '\",\"text\":\"' || entity || '\",\"start\":' || span_start || ',\"end\":' || span_end || ',\"confidence\":1.0}'")
_query("s3", ["violations"], f"""
SELECT v.doc_id, v.position, v.rule_name, v.severity, v.action,
  '{{"message":"' || v.message || CASE WHEN v.rule_name = 'content_filter' THEN '","patterns":[".*violence.*",".*hate.*"]}}'
   ELSE '","entities":[' || e.body || ']}}' END AS details
FROM violations v LEFT JOIN (
  SELECT doc_id, CASE WHEN type IN ('TCKN','CREDIT_CARD','IBAN') THEN 'no_pii_in_output' ELSE 'custom_pii_detection' END AS rule_name,
    string_agg({_SPAN_JSON}, ',' ORDER BY ord, span_start) AS body
  FROM spans WHERE type <> 'AMOUNT' GROUP BY 1, 2) e ON e.doc_id = v.doc_id AND e.rule_name = v.rule_name""")
_QUERIES["s3_append"] = _QUERIES["s3"]
_query("s6", ["violations"], """
SELECT CAST(v.position AS INT) AS position, name, type, enabled, v.severity, v.action, coalesce(n.violations, 0) AS violations FROM (VALUES
 (0,'max_tokens','threshold',true,'error','block'), (1,'no_pii_in_output','pii',true,'error','block'),
 (2,'content_filter','content',true,'warning','log'), (3,'custom_max_cost','threshold',true,'error','block'),
 (4,'custom_pii_detection','pii',true,'warning','log'), (5,'custom_content_safety','content',false,'warning','log'))
 v(position, name, type, enabled, severity, action)
LEFT JOIN (SELECT rule_name, count(*) AS violations FROM violations GROUP BY 1) n ON n.rule_name = v.name""")
_query("g1", ["requests"], """
SELECT id, CASE WHEN total_tokens > 2000 THEN 'Token count ' || total_tokens || ' exceeds threshold 2000' END AS message,
  CASE WHEN total_tokens > 2000 THEN '{"message":"Token count ' || total_tokens || ' exceeds threshold 2000","tokens":' || total_tokens || ',"threshold":2000}' END AS details
FROM requests""")
_query("g2", ["requests"], """
SELECT id, CASE WHEN cost_usd > 0.05::DOUBLE THEN 'Cost $' || printf('%.4f', cost_usd) || ' exceeds threshold $0.0500' END AS message FROM requests""")
_query("g3", ["broken"], """
SELECT doc_id, 'PII detected: ' || hard AS message FROM broken WHERE hard IS NOT NULL""")
_query("g4", [], """
SELECT doc_id, regexp_matches(text, '(?i)violence|hate') AS matched FROM documents""")
_query("g4_patterns", [], """
SELECT doc_id, regexp_matches(text, '(?i)ee|ss') AS doubled, regexp_matches(text, '(?i)that') AS lazy,
  regexp_matches(text, '(?i)whst') AS possessive FROM documents""")
_query("g5", ["violations"], """
SELECT t.doc_id, CAST(count(v.rule_name) AS INT) AS n_violations, count(v.rule_name) = 0 AS passed,
  count(*) FILTER (v.severity = 'error') > 0 AS should_block,
  coalesce(string_agg(v.rule_name, ',' ORDER BY v.position), '') AS broken_rules
FROM texts t LEFT JOIN violations v USING (doc_id) GROUP BY t.doc_id""")
_query("g6", ["requests"], """
SELECT id, duration_ms > 1000 AS gt, duration_ms >= 1000 AS gte, duration_ms < 1000 AS lt, duration_ms <= 1000 AS lte,
  duration_ms = 1000 AS eq, false AS unknown FROM requests""")
_query("g7", ["spans"], """
SELECT t.doc_id, count(*) FILTER (s.type IN ('PHONE','EMAIL')) >= 2 AS two_contacts, count(s.type) >= 1 AS any_entity
FROM texts t LEFT JOIN spans s USING (doc_id) GROUP BY t.doc_id""")
_view("pairs", [], """
SELECT a.conv_id, a.turn, a.text AS prompt, b.text AS completion FROM conversations a
LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 AND b.role = 'assistant' WHERE a.role = 'user'""")
_view("both_sides", ["broken"], """
SELECT a.doc_id, a.text AS prompt, b.text AS completion, a.hard IS NOT NULL AS in_block,
  CAST((a.hard IS NOT NULL)::INT + a.content::INT + (a.soft IS NOT NULL)::INT AS INT) AS in_n,
  coalesce(b.n_entities, 0) > 0 AS out_pii, b.hard IS NOT NULL AS out_hard,
  CAST(coalesce((b.hard IS NOT NULL)::INT + b.content::INT + (b.soft IS NOT NULL)::INT, 0) AS INT) AS out_n
FROM broken a LEFT JOIN broken b ON b.doc_id = a.doc_id + 1""")
_query("g8", ["both_sides"], """
SELECT doc_id, in_n AS in_violations, CASE WHEN out_pii THEN out_n ELSE 0 END AS out_violations,
  in_block OR (out_pii AND out_hard) AS blocked FROM both_sides""")
_view("turn_flags", ["turn_texts", "turn_spans"], """
SELECT t.doc_id, t.conv_id, t.turn, t.role, count(s.type) > 0 AS pii, count(*) FILTER (s.type IN ('TCKN','CREDIT_CARD','IBAN')) > 0 AS hard,
  CAST((count(*) FILTER (s.type IN ('TCKN','CREDIT_CARD','IBAN')) > 0)::INT + (count(*) FILTER (s.type IN ('EMAIL','PHONE')) > 0)::INT
   + regexp_matches(any_value(t.text), '(?i)violence|hate')::INT AS INT) AS n
FROM turn_texts t LEFT JOIN turn_spans s USING (doc_id) GROUP BY ALL""")
_query("g8_turns", ["turn_flags"], """
SELECT a.conv_id, a.turn, a.n AS in_violations, CAST(CASE WHEN b.pii THEN b.n ELSE 0 END AS INT) AS out_violations,
  a.hard OR coalesce(b.pii AND b.hard, false) AS blocked
FROM turn_flags a LEFT JOIN turn_flags b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 AND b.role = 'assistant' WHERE a.role = 'user'""")
_view("planes", [], """
SELECT b.band, list(CASE WHEN ascii(md5('7:' || b.band || ':' || p.bit || ':' || d.dim)) % 2 = 0 THEN 1.0 ELSE -1.0 END ORDER BY d.dim) AS plane, p.bit
FROM range(20) b(band), range(4) p(bit), range(64) d(dim) GROUP BY b.band, p.bit""")
_view("codes", ["planes"], """
SELECT e.vec_id, p.band, CAST(sum(CASE WHEN list_sum(list_transform(list_zip(e.embedding, p.plane), lambda z: z[1] * z[2])) > 0
  THEN 1 << p.bit ELSE 0 END) AS BIGINT) AS code FROM embeddings e, planes p GROUP BY e.vec_id, p.band""")
_query("c7", [], """
SELECT doc_id, CAST(256 AS INT) AS dim, CASE WHEN trim(text) = '' THEN 0::DOUBLE ELSE 1::DOUBLE END AS length FROM documents""")
_query("g9", [], """
SELECT doc_id, CASE WHEN length(text) > 2000 THEN 'Text of ' || length(text) || ' characters' END AS message FROM documents""")
_SCREEN = """
SELECT m.doc_id, CAST(b.n_entities AS INT) AS n_entities, coalesce(v.names, '') AS broken_rules, v.names IS NULL AS passed,
  coalesce(v.hard, false) AS should_block, m.n_masked, m.masked_text
FROM masked m JOIN broken b USING (doc_id) LEFT JOIN (
  SELECT doc_id, string_agg(rule_name, ',' ORDER BY position) AS names, bool_or(severity = 'error') AS hard
  FROM violations GROUP BY doc_id) v USING (doc_id)"""
_query("x1", ["masked", "violations"], _SCREEN)
_query("x5", ["masked", "violations"], """
SELECT CAST(m.doc_id AS VARCHAR) AS id, v.names IS NULL AS passed, coalesce(v.hard, false) AS should_block,
  replace(m.masked_text, 'session_' || md5(CAST(m.doc_id AS VARCHAR)), 'session_' || md5(CAST(m.doc_id AS VARCHAR))) AS masked_text
FROM masked m LEFT JOIN (
  SELECT doc_id, string_agg(rule_name, ',' ORDER BY position) AS names, bool_or(severity = 'error') AS hard
  FROM violations GROUP BY doc_id) v USING (doc_id)""")

# ---------------------------------------------------------------- log, filters, reports
_LOG = """SELECT id, user_id, request_timestamp, provider, model, prompt_tokens, completion_tokens, total_tokens,
  round(cost_usd, 9) AS cost_usd, duration_ms, cache_hit, pii_detected, status FROM requests"""
_query("s1", ["requests"], _LOG)
_query("s2", ["requests"], f"SELECT * REPLACE (CAST(id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id) FROM ({_LOG}) l "
       "WHERE request_timestamp >= TIMESTAMP '2024-01-10' AND request_timestamp <= TIMESTAMP '2024-01-20'")
_query("s4", ["raw_requests"], "SELECT CAST(id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, request_timestamp FROM raw_requests")
_query("s5", [], "SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
_query("s7", ["prices", "requests"], """
SELECT p.provider, p.model, p.p AS prompt_price, p.c AS completion_price, count(r.id) AS requests
FROM prices p LEFT JOIN requests r USING (provider, model) GROUP BY ALL""")
_RECENT = """SELECT id, provider, model, total_tokens AS tokens, round(cost_usd, 9) AS cost, duration_ms, cache_hit,
 pii_detected, status, request_timestamp AS "timestamp" FROM requests"""
_query("p1", ["requests"], _RECENT)
_query("p2", ["requests"], _LOG + " WHERE request_timestamp >= TIMESTAMP '2024-01-05' AND request_timestamp <= TIMESTAMP '2024-01-12 12:00:00'")
_query("p3", ["requests"], _LOG + " WHERE user_id = 7 AND provider = 'openai'")
_query("p4", ["requests"], """
SELECT id, request_timestamp - INTERVAL 3 HOUR AS from_istanbul, request_timestamp + INTERVAL 5 HOUR AS from_new_york FROM requests""")
_query("p5", ["requests"], _LOG + " WHERE request_timestamp >= TIMESTAMP '2024-01-13' AND request_timestamp <= TIMESTAMP '2024-01-20 23:59:59'")
_query("p5_24h", ["requests"], _LOG + " WHERE request_timestamp >= TIMESTAMP '2024-01-19' AND request_timestamp <= TIMESTAMP '2024-01-20 23:59:59'")
_query("p5_30d", ["requests"], _LOG + " WHERE request_timestamp >= TIMESTAMP '2024-01-11' AND request_timestamp <= TIMESTAMP '2024-02-10 23:59:59'")
_query("p6", ["requests"], _LOG + " WHERE id = 777")
_view("hooks", [], """
SELECT n_nationkey AS webhook_id, 'https://' || lower(replace(n_name, ' ', '-')) || '.example.org/hook' AS url,
  'secret-' || n_nationkey AS secret, n_nationkey % 4 <> 3 AS is_active, ev AS event FROM nation,
 (VALUES (0,'request.completed'), (1,'request.failed'), (2,'budget.exceeded'), (3,'guardrail.violated')) e(k, ev)
WHERE (n_nationkey + k) % 3 <> 0""")
_query("p7", ["hooks"], "SELECT webhook_id, url FROM hooks WHERE is_active AND event = 'request.failed'")
_GROUP = """count(*) AS total_requests, CAST(coalesce(sum(total_tokens), 0) AS BIGINT) AS total_tokens,
 round(coalesce(sum(cost_usd), 0), 9) AS total_cost, round(coalesce(avg(duration_ms), 0), 9) AS avg_duration_ms"""
_OVERVIEW = """count(*) AS total_requests, CAST(coalesce(sum(prompt_tokens), 0) AS BIGINT) AS total_prompt_tokens,
 CAST(coalesce(sum(completion_tokens), 0) AS BIGINT) AS total_completion_tokens, CAST(coalesce(sum(total_tokens), 0) AS BIGINT) AS total_tokens,
 round(coalesce(sum(cost_usd), 0), 9) AS total_cost, round(coalesce(avg(duration_ms), 0), 9) AS avg_duration_ms,
 CAST(coalesce(sum(cache_hit::INT), 0) AS BIGINT) AS cache_hits, CAST(coalesce(sum(pii_detected::INT), 0) AS BIGINT) AS pii_detections"""
_query("a1", ["requests"], f"SELECT {_OVERVIEW} FROM requests")
_query("a2", ["requests"], f"SELECT provider, {_GROUP} FROM requests GROUP BY provider")
_query("a3", ["requests"], f"SELECT user_id, {_GROUP} FROM requests GROUP BY user_id ORDER BY total_requests DESC, user_id LIMIT 100")
_query("a4", ["requests"], " UNION ALL ".join(
    f"SELECT '{g}' AS granularity, date_trunc('{g}', request_timestamp)::TIMESTAMP AS time_bucket, {_GROUP} FROM requests GROUP BY 2"
    for g in ("hour", "day", "week", "month")))
_query("a5", ["requests"], "SELECT count(*) AS requests FROM requests WHERE user_id = 3 AND provider = 'openai' AND request_timestamp >= TIMESTAMP '2024-01-05'")
_query("a6", ["requests"], """
SELECT total_requests, round(100.0 * cache_hits / total_requests, 1) AS cache_hit_rate, round(100.0 * pii_detections / total_requests, 1) AS pii_rate
FROM (SELECT count(*)::DOUBLE AS n, count(*) AS total_requests, count(*) FILTER (cache_hit)::DOUBLE AS cache_hits, count(*) FILTER (pii_detected)::DOUBLE AS pii_detections FROM requests) t""")
_query("a7", ["requests"], f"SELECT {_OVERVIEW} FROM requests WHERE request_timestamp >= TIMESTAMP '2024-01-15 11:00:00' AND request_timestamp <= TIMESTAMP '2024-01-15 12:00:00'")
_query("a8", ["requests"], "SELECT provider, model, status, count(*) AS requests FROM requests GROUP BY ALL")
_query("a9", ["requests"], "SELECT status AS error_type, provider, count(*) AS errors FROM requests WHERE status <> 'completed' GROUP BY ALL")
_query("a10", ["requests"], "SELECT count(*) FILTER (cache_hit) AS cache_hits FROM requests")
_query("a11", ["spans"], "SELECT type AS pii_type, count(*) AS detections FROM spans GROUP BY type")
_query("a12", ["violations"], "SELECT rule_name, severity, count(*) AS violations FROM violations GROUP BY ALL")


def _hist(value: str, bounds: list[str], keys: str, source: str) -> str:
    les = ", ".join(f"('{b}', {b}::DOUBLE)" for b in bounds) + ", ('+Inf', 'infinity'::DOUBLE)"
    return f"""
SELECT {keys}, b.le, count(*) FILTER (v <= b.bound) AS cumulative, round(sum(v), 9) AS value_sum, count(*) AS value_count
FROM (SELECT {keys}, {value} AS v FROM {source}) s, (VALUES {les}) b(le, bound) GROUP BY {keys}, b.le"""


_query("a13", ["requests"], _hist("duration_ms / 1000.0::DOUBLE", ["0.1", "0.5", "1.0", "2.5", "5.0", "10.0", "30.0", "60.0"], "provider, model", "requests"))
_query("a14", ["requests"], _hist("tokens", ["100.0", "500.0", "1000.0", "2000.0", "5000.0", "10000.0", "20000.0"], "token_type",
       "(SELECT 'prompt' AS token_type, prompt_tokens::DOUBLE AS tokens FROM requests UNION ALL SELECT 'completion', completion_tokens::DOUBLE FROM requests)")
       .replace("round(sum(v), 9)", "CAST(sum(v) AS BIGINT)"))
_query("a15", ["requests"], _hist("cost_usd", ["0.001", "0.01", "0.05", "0.1", "0.5", "1.0", "5.0"], "provider, model", "requests"))
_query("a16", ["requests"], """
SELECT t AS "at", CAST(sum(step) OVER (ORDER BY t) AS BIGINT) AS active FROM (
 SELECT t, sum(step) AS step FROM (
  SELECT request_timestamp AS t, 1 AS step FROM requests
  UNION ALL SELECT request_timestamp + to_milliseconds(duration_ms), -1 FROM requests) m GROUP BY t) x""")
_query("a16_peak", [], "SELECT max(active) AS peak FROM (" + _QUERIES["a16"][1] + ") y")
_QUERIES["a16_peak"] = (_QUERIES["a16"][0], _QUERIES["a16_peak"][1])
_view("entries", [], """
SELECT vec_id, embedding::DOUBLE[] AS embedding, TIMESTAMP '2024-01-01' + to_seconds(vec_id * 10) AS created_at,
  TIMESTAMP '2024-01-01' + to_seconds(vec_id * 10 - 5) AS asked_at FROM embeddings""")
_query("a17", ["entries"], """
SELECT count(*) AS cache_size FROM entries WHERE created_at > TIMESTAMP '2024-01-01 01:10:00' - INTERVAL 1 HOUR AND created_at <= TIMESTAMP '2024-01-01 01:10:00'""")
_view("status_now", ["budgets", "requests"], """
SELECT b.user_id, b.period, b.limit_usd, b.lo AS period_start, b.hi AS period_end,
  coalesce(sum(r.cost_usd), 0) AS spend_usd
FROM (SELECT *, CASE period WHEN 'daily' THEN TIMESTAMP '2024-01-17' WHEN 'weekly' THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2024-01-01' END AS lo,
             CASE period WHEN 'daily' THEN TIMESTAMP '2024-01-18' WHEN 'weekly' THEN TIMESTAMP '2024-01-22' ELSE TIMESTAMP '2024-02-01' END AS hi FROM budgets) b
LEFT JOIN requests r ON r.user_id = b.user_id AND r.request_timestamp >= b.lo AND r.request_timestamp < b.hi GROUP BY ALL""")
_query("j3", ["status_now"], "SELECT user_id, round(limit_usd, 9) AS limit_usd, period, period_start, period_end, round(spend_usd, 9) AS spend_usd FROM status_now")
_query("a18", ["status_now"], """
SELECT user_id, period, round(spend_usd, 9) AS spend_usd, round(limit_usd, 9) AS limit_usd, round(spend_usd / limit_usd, 9) AS usage_ratio FROM status_now""")
_query("t1", ["requests"], _LOG + " WHERE user_id = 5 ORDER BY request_timestamp DESC, id LIMIT 10")
_query("t1_all_users", ["requests"], "SELECT user_id, id, request_timestamp, CAST(row_number() OVER w AS INT) AS rank FROM requests WINDOW w AS (PARTITION BY user_id ORDER BY request_timestamp DESC, id) QUALIFY rank <= 3")
_query("t2", ["requests"], _RECENT + " ORDER BY request_timestamp DESC, id LIMIT 25")
_query("t3", ["requests"], _LOG + " WHERE user_id = 5 AND provider = 'openai' ORDER BY request_timestamp DESC, id LIMIT 10 OFFSET 10")
_view("violation_log", ["requests"], """
SELECT id AS request_id, user_id, CASE r WHEN 0 THEN 'max_tokens' ELSE 'custom_max_cost' END AS rule_name, 'error' AS severity, 'block' AS action,
  CAST(CASE WHEN r = 0 THEN 0 ELSE (CASE WHEN total_tokens > 2000 THEN 1 ELSE 0 END) END AS INT) AS position, request_timestamp AS "timestamp"
FROM requests, (VALUES (0), (1)) v(r) WHERE (r = 0 AND total_tokens > 2000) OR (r = 1 AND cost_usd > 0.05::DOUBLE)""")
_VLOG = 'SELECT request_id, user_id, "timestamp", position, rule_name, severity, action FROM violation_log'
_query("t4", ["violation_log"], _VLOG + ' ORDER BY "timestamp" DESC, request_id, position LIMIT 100')
_query("t5", ["violation_log"], _VLOG + " WHERE rule_name = 'custom_max_cost' ORDER BY \"timestamp\" DESC, request_id, position LIMIT 50")
_query("t6", ["requests"], """
SELECT id, request_timestamp, total, CAST(2 AS INT) AS page, CAST(20 AS INT) AS page_size, CAST(ceil(total / 20.0) AS BIGINT) AS pages
FROM (SELECT *, count(*) OVER () AS total FROM requests WHERE user_id = 5) t ORDER BY request_timestamp DESC, id LIMIT 20 OFFSET 20""")
_query("r7", ["requests"], """
SELECT date_trunc('day', request_timestamp)::TIMESTAMP AS time_bucket, round(sum(total_tokens)::DOUBLE * 0.6::DOUBLE, 9) AS prompt,
  round(sum(total_tokens)::DOUBLE * 0.4::DOUBLE, 9) AS completion, CAST(sum(total_tokens) AS BIGINT) AS total FROM requests GROUP BY 1""")

# ---------------------------------------------------------------- joins
_query("j1", ["requests"], "SELECT id, provider, model, round(cost_usd, 9) AS cost_usd FROM requests")
_view("loose", ["raw_requests"], """
SELECT id AS violation_id, user_id, request_timestamp - to_seconds(id % 90) AS "timestamp" FROM raw_requests WHERE status = 'blocked'""")
_query("j2", ["loose"], """
SELECT v.violation_id, v.user_id, v."timestamp", (SELECT arg_min(r.id, (r.request_timestamp, r.id)) FROM raw_requests r
  WHERE r.user_id = v.user_id AND r.request_timestamp >= v."timestamp" AND r.request_timestamp <= v."timestamp" + INTERVAL 60 SECOND) AS request_id
FROM loose v""")
_view("hook_events", ["raw_requests"], """
SELECT id, user_id, request_timestamp, CASE WHEN status = 'completed' THEN 'request.completed' ELSE 'request.failed' END AS event FROM raw_requests""")
_query("j4", ["hook_events", "hooks"], """
SELECT h.webhook_id, e.event, CAST(e.id AS VARCHAR) AS event_id FROM hook_events e JOIN hooks h ON h.event = e.event AND h.is_active""")
_view("visible", ["entries"], """
SELECT q.vec_id AS query_id, e.vec_id AS entry_id, e.created_at,
  list_dot_product(q.embedding, e.embedding) / (sqrt(list_dot_product(q.embedding, q.embedding)) * sqrt(list_dot_product(e.embedding, e.embedding))) AS similarity
FROM entries q JOIN entries e ON e.created_at <= q.asked_at AND q.asked_at < e.created_at + INTERVAL 3600 SECOND""")
_view("best", ["visible"], """
SELECT query_id, arg_max(entry_id, (similarity, created_at, entry_id)) AS entry_id, max(similarity) AS similarity FROM visible GROUP BY query_id""")
_query("j5", ["best"], "SELECT query_id, entry_id, round(similarity, 9) AS similarity FROM best WHERE similarity > 0 AND similarity >= 0.35")
_query("c5", ["visible", "codes"], """
SELECT query_id, arg_max(entry_id, (similarity, created_at, entry_id)) AS entry_id, round(max(similarity), 9) AS similarity FROM visible v
WHERE similarity > 0 AND similarity >= 0.35
  AND EXISTS (SELECT 1 FROM codes a JOIN codes b USING (band, code) WHERE a.vec_id = v.query_id AND b.vec_id = v.entry_id) GROUP BY query_id""")
_query("j7", ["raw_requests", "prices"], """
SELECT id, requested_provider, requested_model, served_provider,
  CASE WHEN served_provider IS NULL THEN NULL WHEN served_provider = requested_provider THEN coalesce(requested_model, dflt)
       WHEN EXISTS (SELECT 1 FROM prices p WHERE p.provider = served_provider AND p.model = requested_model) THEN requested_model ELSE dflt END AS served_model,
  CASE WHEN served_provider IS NULL THEN 'failed' ELSE 'completed' END AS status, served_provider <> requested_provider AS fell_back
FROM (SELECT *, CASE served_provider WHEN 'openai' THEN 'gpt-4o-mini' WHEN 'gemini' THEN 'gemini-2.5-flash-lite' END AS dflt FROM (
  SELECT id, provider AS requested_provider, CASE WHEN id % 4 = 0 THEN NULL WHEN id % 4 = 1 THEN 'gemini-1.5-pro' ELSE model END AS requested_model,
    CASE WHEN id % 10 <> 0 THEN provider WHEN id % 100 <> 0 THEN CASE provider WHEN 'openai' THEN 'gemini' ELSE 'openai' END END AS served_provider
  FROM raw_requests) a) b""")

# ---------------------------------------------------------------- ordered state
_query("w1", ["raw_requests"], """
SELECT user_id, id, request_timestamp,
  count(*) OVER (PARTITION BY user_id ORDER BY request_timestamp RANGE BETWEEN INTERVAL 60 SECOND PRECEDING AND CURRENT ROW) AS last_minute,
  count(*) OVER (PARTITION BY user_id ORDER BY request_timestamp RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW) AS last_hour
FROM raw_requests""")
_view("tight_tier", ["raw_requests"], """
SELECT user_id, id, request_timestamp, epoch_us(request_timestamp) AS us, 1 AS per_minute,
  CASE WHEN user_id % 2 = 0 THEN 2 ELSE 1 END AS per_hour,
  row_number() OVER (PARTITION BY user_id ORDER BY request_timestamp, id) AS k FROM raw_requests""")
_view("rate_fold", ["tight_tier"], """
SELECT user_id, id, k, 0 AS outcome, [us] AS stamps FROM tight_tier WHERE k = 1
UNION ALL
SELECT user_id, id, k, outcome, CASE WHEN outcome = 0 THEN list_append(live, us) ELSE live END FROM (
 SELECT t.user_id, t.id, t.k, t.us, list_filter(f.stamps, lambda s: s >= t.us - 3600000000) AS live,
  CASE WHEN len(list_filter(f.stamps, lambda s: s >= t.us - 60000000)) >= t.per_minute THEN 1
       WHEN len(list_filter(f.stamps, lambda s: s >= t.us - 3600000000)) >= t.per_hour THEN 2 ELSE 0 END AS outcome
 FROM rate_fold f JOIN tight_tier t ON t.user_id = f.user_id AND t.k = f.k + 1) n""")
_view("rated", ["rate_fold"], """
SELECT t.user_id, t.id, t.request_timestamp, f.outcome = 0 AS allowed, CASE f.outcome WHEN 1 THEN 'minute' WHEN 2 THEN 'hour' END AS limited_by,
  CAST(CASE f.outcome WHEN 1 THEN (60000000 - t.us % 60000000) // 1000000 + 1 WHEN 2 THEN (3600000000 - t.us % 3600000000) // 1000000 + 1 END AS INT) AS retry_after,
  CASE f.outcome WHEN 1 THEN 'Rate limit exceeded: ' || t.per_minute || ' requests per minute'
     WHEN 2 THEN 'Rate limit exceeded: ' || t.per_hour || ' requests per hour' END AS message
FROM tight_tier t JOIN rate_fold f USING (user_id, k)""")
_query("w2", ["rated"], "SELECT * FROM rated")
_query("x4", ["rated"], "SELECT user_id, id, allowed, limited_by FROM rated")
_query("x4_late", ["raw_requests"], """
SELECT user_id, id FROM raw_requests WHERE id % 7 = 0
 AND epoch_us(request_timestamp) < (SELECT max(epoch_ms(request_timestamp)) - 3600000 FROM raw_requests WHERE id % 7 <> 0) * 1000""")
_query("w3", ["raw_requests"], """
SELECT id, CASE id % 3 WHEN 0 THEN 'premium' WHEN 1 THEN 'gold' END AS tier, CAST(CASE WHEN id % 3 = 0 THEN 300 ELSE 60 END AS INT) AS per_minute,
  CAST(CASE WHEN id % 3 = 0 THEN 10000 ELSE 1000 END AS INT) AS per_hour FROM raw_requests""")
_query("w4", ["raw_requests"], """
SELECT id, CAST((60000000 - epoch_us(request_timestamp) % 60000000) // 1000000 + 1 AS INT) AS retry_minute,
  CAST((3600000000 - epoch_us(request_timestamp) % 3600000000) // 1000000 + 1 AS INT) AS retry_hour FROM raw_requests""")
_view("spent", ["budgets", "requests"], """
SELECT *, CAST(sum(units) OVER (PARTITION BY user_id, period_start ORDER BY request_timestamp, id ROWS UNBOUNDED PRECEDING) AS BIGINT) / 1e10::DOUBLE AS spend_usd FROM (
 SELECT r.user_id, r.id, r.request_timestamp, coalesce(b.period, 'monthly') AS period, coalesce(b.limit_usd, 1000::DOUBLE) AS limit_usd,
  CAST(date_trunc(CASE coalesce(b.period, 'monthly') WHEN 'daily' THEN 'day' WHEN 'weekly' THEN 'week' ELSE 'month' END, r.request_timestamp) AS TIMESTAMP) AS period_start,
  CAST(round(r.cost_usd * 1e10::DOUBLE) AS BIGINT) AS units, r.prompt_tokens
 FROM requests r LEFT JOIN budgets b USING (user_id)) t""")
_query("w5", ["spent"], "SELECT user_id, id, request_timestamp, period, period_start, round(limit_usd, 9) AS limit_usd, round(spend_usd, 9) AS spend_usd FROM spent")
_BUDGET_FOLD = """
SELECT user_id, period_start, id, k, 0::BIGINT AS before, est <= lim AS allowed, CASE WHEN est <= lim THEN units ELSE 0 END AS spend FROM {src} WHERE k = 1
UNION ALL
SELECT t.user_id, t.period_start, t.id, t.k, f.spend, f.spend + t.est <= t.lim, f.spend + CASE WHEN f.spend + t.est <= t.lim THEN t.units ELSE 0 END
FROM {fold} f JOIN {src} t ON t.user_id = f.user_id AND t.period_start = f.period_start AND t.k = f.k + 1"""
_view("budget_rows", ["spent"], """
SELECT *, CAST(round(prompt_tokens * 0.000002::DOUBLE * 1e10::DOUBLE) AS BIGINT) AS est, CAST(round(limit_usd * 1e10::DOUBLE) AS BIGINT) AS lim,
  row_number() OVER (PARTITION BY user_id, period_start ORDER BY request_timestamp, id) AS k FROM spent""")
_view("budget_fold", ["budget_rows"], _BUDGET_FOLD.format(src="budget_rows", fold="budget_fold"))
_query("w6", ["budget_fold"], """
SELECT r.user_id, r.id, r.request_timestamp, r.period_start, round(r.limit_usd, 9) AS limit_usd, round(f.before / 1e10::DOUBLE, 9) AS spend_before_usd, f.allowed,
  CASE WHEN NOT f.allowed THEN 'Budget exceeded: $' || printf('%.2f', f.before / 1e10::DOUBLE) || ' / $' || printf('%.2f', r.limit_usd) END AS message
FROM budget_rows r JOIN budget_fold f USING (user_id, period_start, k)""")
_query("w7", ["spent"], """
SELECT user_id, period, period_start, threshold, min(request_timestamp) AS crossed_at
FROM spent, (VALUES (0.5::DOUBLE), (0.75::DOUBLE), (0.9::DOUBLE)) v(threshold) WHERE spend_usd / limit_usd >= threshold GROUP BY ALL""")
_query("w8", ["status_now"], """
SELECT user_id, CASE WHEN u >= 0.9 THEN 'critical' WHEN u >= 0.75 THEN 'high' WHEN u >= 0.5 THEN 'elevated' ELSE 'normal' END AS band,
  round(least(u * 100, 100), 9) AS percent FROM (SELECT user_id, spend_usd / limit_usd AS u FROM status_now) t""")

# ---------------------------------------------------------------- cache
_view("neighbours", ["entries"], "SELECT a.vec_id, a.embedding AS a, b.embedding AS b FROM entries a JOIN entries b ON b.vec_id = a.vec_id + 1")
_COS = "list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b)))"
_query("c1", ["neighbours"], f"SELECT vec_id, round({_COS}, 9) AS cosine FROM neighbours")
_query("c2", ["neighbours"], f"SELECT vec_id, {_COS} >= 0.1 AS similar FROM neighbours")
_query("c3", [], """
SELECT md5(text) AS cache_key, text, max(created_at) AS created_at, arg_max(turn_id, created_at) AS response FROM (
 SELECT text, conv_id * 1000 + turn AS turn_id, TIMESTAMP '2024-01-01' + to_seconds(conv_id * 1000 + turn) AS created_at FROM conversations) t GROUP BY text""")
_query("c4", ["entries"], """
SELECT vec_id AS entry_id, created_at FROM entries WHERE created_at <= TIMESTAMP '2024-01-01 01:10:00' AND TIMESTAMP '2024-01-01 01:10:00' < created_at + INTERVAL 3600 SECOND""")
_query("c6", ["requests", "best"], """
SELECT r.id, b.query_id IS NOT NULL AS cache_hit, b.entry_id AS cached_from, round(CASE WHEN b.query_id IS NULL THEN r.cost_usd ELSE 0 END, 9) AS cost_usd, b.query_id IS NULL AS needs_budget
FROM requests r LEFT JOIN (SELECT * FROM best WHERE similarity >= 0.4) b ON b.query_id = r.id""")

# ---------------------------------------------------------------- routing, tokens, chat
_WORDS = "len(list_filter(string_split_regex({c}, '\\s+'), lambda w: w <> ''))"
_query("r1", [], f"SELECT doc_id, CAST({_WORDS.format(c='text')} AS INT) AS words, round({_WORDS.format(c='text')} * 1.3::DOUBLE * 0.000002::DOUBLE, 9) AS estimated_usd FROM documents")
_query("r2", [], f"SELECT conv_id, CAST(sum(3 + ({_WORDS.format(c='role')} * 13 + 9) // 10 + ({_WORDS.format(c='text')} * 13 + 9) // 10) + 3 AS BIGINT) AS chat_tokens FROM conversations GROUP BY conv_id")
_view("points", ["requests"], """
SELECT *, (CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 10000) / 100.0::DOUBLE AS point FROM requests""")
_view("assigned", ["points"], """
SELECT *, CASE WHEN point <= 50 THEN 'openai_gpt4' ELSE 'gemini_pro' END AS variant FROM points""")
_query("r3", ["assigned"], """
SELECT id, variant, CASE WHEN variant = 'openai_gpt4' THEN 'openai' ELSE 'gemini' END AS provider,
  CASE WHEN variant = 'openai_gpt4' THEN 'gpt-4' ELSE 'gemini-pro' END AS model FROM assigned""")
_query("r4", ["assigned"], f"SELECT variant, {_OVERVIEW} FROM assigned GROUP BY variant")
_query("r5", ["raw_requests"], """
SELECT id, coalesce(p, 'openai') AS provider, CASE WHEN p IS NULL THEN 'gpt-4o-mini' WHEN m IS NOT NULL THEN m WHEN p = 'gemini' THEN 'gemini-2.5-flash-lite' ELSE 'gpt-4o-mini' END AS model
FROM (SELECT id, CASE WHEN id % 4 <> 0 THEN provider END AS p, CASE WHEN id % 3 <> 0 THEN model END AS m FROM raw_requests) t""")
_query("r6", [], """
SELECT conv_id, min(turn) AS turn, CASE WHEN arg_min(role, turn) IN ('user', 'system') THEN 'user' ELSE 'model' END AS role, string_agg(text, chr(10) ORDER BY turn) AS text
FROM (SELECT *, coalesce(max(CASE WHEN role <> 'system' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn), -1) AS head FROM conversations) t GROUP BY conv_id, head""")

# ---------------------------------------------------------------- dates and texts
_query("f1", ["raw_requests"], " UNION ALL ".join(
    f"SELECT id, '{p}' AS period, CAST(date_trunc('{u}', request_timestamp) AS TIMESTAMP) AS period_start, CAST(date_trunc('{u}', request_timestamp) + INTERVAL {i} AS TIMESTAMP) AS period_end FROM raw_requests"
    for p, u, i in (("daily", "day", "1 DAY"), ("weekly", "week", "7 DAY"), ("monthly", "month", "1 MONTH"))))
_query("f2", ["raw_requests"], """
SELECT id, CAST(date_trunc('day', request_timestamp) + INTERVAL 1 DAY AS TIMESTAMP) AS daily_reset, CAST(date_trunc('week', request_timestamp) + INTERVAL 7 DAY AS TIMESTAMP) AS weekly_reset,
  CAST(date_trunc('month', request_timestamp) + INTERVAL 1 MONTH AS TIMESTAMP) AS monthly_reset FROM raw_requests""")
_query("f3", ["raw_requests"], """
SELECT id, CASE WHEN ms < 1000 THEN ms || 'ms' WHEN ms < 60000 THEN printf('%.2f', ms / 1000.0::DOUBLE) || 's'
  ELSE (ms // 60000) || 'm ' || printf('%.2f', (ms % 60000) / 1000.0::DOUBLE) || 's' END AS duration_text FROM (SELECT id, CAST(duration_ms AS BIGINT) * (1 + id % 40) AS ms FROM raw_requests) t""")
_query("f4", ["requests"], """
SELECT id, '$' || CASE WHEN c < 0.01 THEN printf('%.4f', c) WHEN c < 1 THEN printf('%.3f', c) ELSE printf('%.2f', c) END AS cost_text FROM (SELECT id, cost_usd * (1 + id % 30) AS c FROM requests) t""")
_query("f5", ["raw_requests"], """
SELECT id, CASE WHEN n < 1000 THEN n || '' WHEN n < 1000000 THEN printf('%.1f', n / 1000.0::DOUBLE) || 'K' ELSE printf('%.2f', n / 1000000.0::DOUBLE) || 'M' END AS token_text
FROM (SELECT id, CAST(total_tokens AS BIGINT) * (1 + id % 1500) AS n FROM raw_requests) t""")

# ---------------------------------------------------------------- events
_view("events_out", ["requests"], """
SELECT CASE WHEN status = 'completed' THEN 'request.completed' ELSE 'request.failed' END AS event, CAST(id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
  request_timestamp AS "timestamp", CASE WHEN status = 'completed' THEN provider END AS provider, CASE WHEN status = 'completed' THEN model END AS model,
  CASE WHEN status = 'completed' THEN CAST(total_tokens AS BIGINT) END AS tokens, CASE WHEN status = 'completed' THEN cost_usd END AS cost,
  CASE WHEN status <> 'completed' THEN status END AS error, CAST(NULL AS VARCHAR) AS rule_name, CAST(NULL AS VARCHAR) AS severity FROM requests""")
_view("all_events", ["events_out", "violation_log", "budget_fold"], """
SELECT * FROM events_out
UNION ALL SELECT 'guardrail.violated', request_id || '-' || rule_name, CAST(user_id AS VARCHAR), "timestamp", NULL, NULL, NULL, NULL, NULL, rule_name, severity FROM violation_log
UNION ALL SELECT 'budget.exceeded', CAST(r.id AS VARCHAR), CAST(r.user_id AS VARCHAR), r.request_timestamp, NULL, NULL, NULL, NULL,
  'Budget exceeded: $' || printf('%.2f', f.before / 1e10::DOUBLE) || ' / $' || printf('%.2f', r.limit_usd), NULL, NULL
  FROM budget_rows r JOIN budget_fold f USING (user_id, period_start, k) WHERE NOT f.allowed""")
_query("h1", ["all_events"], 'SELECT event, event_id, user_id, "timestamp", provider, model, tokens, round(cost, 9) AS cost, error, rule_name, severity FROM all_events')
_view("bodies", ["events_out"], """
SELECT *, '{"event":"' || event || '","timestamp":' || sec || ',"data":{"request_id":"' || event_id || '","user_id":"' || user_id || '"'
 || coalesce(',"provider":"' || provider || '"', '') || coalesce(',"model":"' || model || '"', '') || coalesce(',"tokens":' || tokens, '')
 || coalesce(',"cost":' || micro // 1000000 || '.' || lpad(CAST(micro % 1000000 AS VARCHAR), 6, '0'), '') || coalesce(',"error":"' || error || '"', '') || ',"timestamp":' || sec || '}}' AS payload
FROM (SELECT *, (CAST(round(cost * 1e10::DOUBLE) AS BIGINT) + 5000) // 10000 AS micro, CAST(epoch_us("timestamp") // 1000000 AS VARCHAR) || '.' || lpad(CAST(epoch_us("timestamp") % 1000000 AS VARCHAR), 6, '0') AS sec FROM events_out) t""")
_query("h2", ["bodies"], "SELECT event_id, event, payload FROM bodies")
_query("h5", ["hook_events", "hooks"], """
SELECT h.webhook_id, e.event, CAST(e.id AS VARCHAR) AS event_id, CAST(a AS INT) AS attempt, e.request_timestamp + to_microseconds(CAST((pow(2, a) - 1) * 1000000 AS BIGINT)) AS due_at
FROM hook_events e JOIN hooks h ON h.event = e.event AND h.is_active, range(3) r(a)""")
_view("keys", ["hooks"], """
SELECT *, CAST(rpad(secret, 64, chr(0)) AS BLOB) AS block FROM hooks""")
_view("signers", ["keys"], """
SELECT *, CAST(xor(CAST(block AS BIT), CAST(unhex(repeat('36', 64)) AS BIT)) AS BLOB) AS ipad,
  CAST(xor(CAST(block AS BIT), CAST(unhex(repeat('5C', 64)) AS BIT)) AS BLOB) AS opad FROM keys""")
_query("h3", ["bodies", "signers"], """
SELECT h.webhook_id, b.event_id, sha256(h.opad || unhex(sha256(h.ipad || encode(b.payload)))) AS signature
FROM bodies b JOIN signers h ON h.event = b.event AND h.is_active""")
_query("h4", ["bodies", "signers"], """
SELECT h.webhook_id, h.url, b.event, b.event_id, b."timestamp", b.payload, sha256(h.opad || unhex(sha256(h.ipad || encode(b.payload)))) AS signature,
  'application/json' AS content_type FROM bodies b JOIN signers h ON h.event = b.event AND h.is_active""")

# ---------------------------------------------------------------- replay and streams
_DAY_US = 86_400_000_000
_view("replay_in", ["requests", "doc_spans", "rated"], """
SELECT r.user_id, r.id, r.request_timestamp, epoch_us(r.request_timestamp) AS us, r.cost_usd, NOT a.allowed AS limited,
  EXISTS (SELECT 1 FROM doc_spans s WHERE s.doc_id = r.id AND s.type IN ('TCKN','CREDIT_CARD','IBAN'))
   OR r.total_tokens > 10000 OR r.cost_usd > 0.10::DOUBLE AS blocked,
  EXISTS (SELECT 1 FROM documents o WHERE o.doc_id = r.id + 1) AND (r.id % 11 = 0
    OR EXISTS (SELECT 1 FROM doc_spans s WHERE s.doc_id = r.id + 1 AND s.type IN ('TCKN','CREDIT_CARD','IBAN'))
    OR (EXISTS (SELECT 1 FROM doc_spans s WHERE s.doc_id = r.id + 1) AND (r.total_tokens > 10000 OR r.cost_usd > 0.10::DOUBLE))) AS out_blocked,
  coalesce(""" + _WORDS.format(c="d.text") + """, 0) AS words
FROM requests r JOIN rated a USING (id) LEFT JOIN documents d ON d.doc_id = r.id""")
_view("replay_rows", ["replay_in", "budgets"], """
SELECT *, row_number() OVER (ORDER BY us, id) AS k, dense_rank() OVER (ORDER BY user_id, period_start) AS purse FROM (
 SELECT r.user_id, r.id, r.us, r.id % 500 AS vec, CAST(date_trunc(CASE coalesce(b.period, 'monthly') WHEN 'daily' THEN 'day' WHEN 'weekly' THEN 'week' ELSE 'month' END, r.request_timestamp) AS TIMESTAMP) AS period_start,
  CAST(round(CASE WHEN r.out_blocked THEN 0 ELSE r.cost_usd END * 1e10::DOUBLE) AS BIGINT) AS units, CAST(round(words * 1.3::DOUBLE * 0.000002::DOUBLE * 1e10::DOUBLE) AS BIGINT) AS est,
  CAST(round(coalesce(b.limit_usd, 1000::DOUBLE) * 1e10::DOUBLE) AS BIGINT) AS lim
 FROM replay_in r LEFT JOIN budgets b USING (user_id) WHERE NOT limited AND NOT blocked) t""")
_view("alike", ["entries"], """
SELECT * FROM (SELECT a.vec_id AS a, b.vec_id AS b, list_dot_product(a.embedding, b.embedding) / (sqrt(list_dot_product(a.embedding, a.embedding)) * sqrt(list_dot_product(b.embedding, b.embedding))) AS similarity
 FROM entries a JOIN entries b ON a.vec_id < 500) t WHERE similarity >= 0.35""")
_view("replay_near", ["replay_rows", "alike", "entries"], f"""
SELECT q.k, q.id, q.us, q.purse, q.units, q.est, q.lim, coalesce(n.near, []) AS near FROM replay_rows q LEFT JOIN (
 SELECT k, list({{'similarity': similarity, 'us': us, 'name': name, 'id': id}}) AS near FROM (
  SELECT q.k, s.similarity, p.us + 1 AS us, 'r' || p.id AS name, p.id FROM replay_rows q JOIN alike s ON s.a = q.vec
   JOIN replay_rows p ON p.vec = s.b AND p.us + 1 <= q.us AND q.us < p.us + 1 + {_DAY_US}
  UNION ALL SELECT q.k, s.similarity, epoch_us(e.created_at), 'g' || e.vec_id, NULL FROM replay_rows q JOIN alike s ON s.a = q.vec
   JOIN entries e ON e.vec_id = s.b AND epoch_us(e.created_at) <= q.us AND q.us < epoch_us(e.created_at) + {_DAY_US}) m GROUP BY k) n USING (k)""")
# One request after the other: what is cached (for a day) and what each purse has spent go along.
_view("replay_walk", ["replay_near"], f"""
SELECT 0::BIGINT AS k, NULL::BIGINT AS id, NULL::STRUCT(similarity DOUBLE, us BIGINT, name VARCHAR, id BIGINT) AS source, false AS admitted,
  []::STRUCT(id BIGINT, us BIGINT)[] AS cached, (SELECT list_transform(range(max(purse)), lambda x: 0::BIGINT) FROM replay_near) AS spent
UNION ALL
SELECT k, id, source, admitted,
  CASE WHEN source IS NULL AND admitted THEN list_append(list_filter(cached, lambda c: c.us + {_DAY_US} > now), {{'id': id, 'us': now + 1}}) ELSE cached END,
  CASE WHEN source IS NULL AND admitted THEN list_concat(list_append(spent[1:purse - 1], spent[purse] + units), spent[purse + 1:]) ELSE spent END
FROM (SELECT n.k, n.id, n.us AS now, n.purse, n.units, w.cached, w.spent, w.spent[n.purse] + n.est <= n.lim AS admitted,
   list_max(list_filter(n.near, lambda e: e.id IS NULL OR list_contains(list_transform(w.cached, lambda c: c.id), e.id))) AS source
  FROM replay_walk w JOIN replay_near n ON n.k = w.k + 1) t""")
_query("x2", ["replay_walk", "replay_in"], """
SELECT id, user_id, request_timestamp,
  CASE reason WHEN 'rate_limit' THEN 'failed' WHEN 'budget' THEN 'budget_exceeded' WHEN 'guardrail' THEN 'blocked' WHEN 'output_guardrail' THEN 'blocked' ELSE 'completed' END AS status,
  reason AS failure_reason, reason IS NULL AND hit AS cache_hit, CASE WHEN reason IS NULL AND hit THEN CAST(substr(source.name, 2) AS BIGINT) END AS cached_from,
  round(CASE WHEN reason IS NULL AND NOT hit THEN cost_usd ELSE 0 END, 9) AS cost_usd
FROM (SELECT r.id, r.user_id, r.request_timestamp, r.cost_usd, w.source, w.source IS NOT NULL AS hit,
  CASE WHEN r.limited THEN 'rate_limit' WHEN r.blocked THEN 'guardrail' WHEN w.source IS NULL AND NOT w.admitted THEN 'budget'
    WHEN CASE WHEN w.source IS NULL THEN r.out_blocked ELSE coalesce(o.out_blocked, false) END THEN 'output_guardrail' END AS reason
  FROM replay_in r LEFT JOIN replay_walk w ON w.id = r.id LEFT JOIN replay_in o ON o.id = w.source.id) t""")
_query("x3_sliding", ["requests"], """
SELECT CAST(w AS TIMESTAMP) AS window_start, CAST(w + INTERVAL 1 HOUR AS TIMESTAMP) AS window_end, count(*) AS total_requests,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens
FROM (SELECT *, time_bucket(INTERVAL 20 MINUTE, request_timestamp, TIMESTAMP '2000-01-01') - k * INTERVAL 20 MINUTE AS w FROM requests, range(3) r(k)) GROUP BY w""")
_query("x3", ["requests"], f"""
SELECT CAST(date_trunc('hour', request_timestamp) AS TIMESTAMP) AS window_start, CAST(date_trunc('hour', request_timestamp) + INTERVAL 1 HOUR AS TIMESTAMP) AS window_end, {_OVERVIEW}
FROM requests GROUP BY 1, 2""")
