"""DuckDB SQL for the queries of ``registry.py``, written independently of the Spark code.

Identity rules are checked by brute force: the SQL compares every pair of records.
"""

from __future__ import annotations

from leadlake.plans.fixtures import LEADS_SQL

CLOCK = "TIMESTAMP '2026-06-15 00:00:00'"
_WS = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '||chr(133)||chr(160)"


def _case_scores(domain: str, filled: str = "{} IS NOT NULL") -> str:
    has = lambda c: "(" + filled.format(c) + ")"
    return f"""
    CASE WHEN seniority IN ('c_suite','vp') THEN 40 WHEN seniority='director' THEN 30 WHEN seniority='manager' THEN 20
         WHEN seniority='senior' THEN 10 ELSE 5 END AS seniority_score,
    CASE WHEN employee_count>=1000 THEN 30 WHEN employee_count>=200 THEN 25 WHEN employee_count>=50 THEN 15
         WHEN employee_count>=10 THEN 10 ELSE 5 END AS company_size_score,
    CASE WHEN industry IN ('software','technology','saas','fintech','information technology') THEN 20
         WHEN industry IN ('finance','banking','healthcare') THEN 15 ELSE 5 END AS industry_score,
    CASE WHEN {has('email')} THEN 3 ELSE 0 END + CASE WHEN {has('company_name')} THEN 2 ELSE 0 END
      + CASE WHEN {has('job_title')} THEN 2 ELSE 0 END + CASE WHEN {has(domain)} THEN 3 ELSE 0 END AS completeness_score"""


def _levels(table: str) -> str:
    return f"""SELECT *,
    CASE WHEN lead_score>=80 THEN 'hot' WHEN lead_score>=60 THEN 'warm' WHEN lead_score>=40 THEN 'cool' ELSE 'cold' END
      AS intent_level,
    CASE WHEN lead_score>=80 THEN 'schedule_demo' WHEN lead_score>=60 THEN 'send_case_study'
         WHEN lead_score>=40 THEN 'add_to_nurture' ELSE 'enrich_data' END AS recommended_action
    FROM (SELECT *, seniority_score+company_size_score+industry_score+completeness_score AS lead_score FROM {table}) t"""


_TRUTHY = "coalesce({},'') <> ''"

CTES = {
    "leads": LEADS_SQL,
    "bronze": """SELECT lead_id, source, first_name, last_name, email, job_title, seniority, company_name, company_domain,
        industry, CAST(employee_count AS INTEGER) AS employee_count, CAST(apollo_score AS DOUBLE) AS apollo_score,
        CAST(ingested_at AS TIMESTAMP) AS ingested_at
        FROM leads WHERE lead_id IS NOT NULL AND lead_id <> 'None'""",
    "cleaned": """SELECT lead_id, source, trim(first_name)||' '||trim(last_name) AS full_name, lower(trim(email)) AS email,
        split_part(lower(trim(email)),'@',2) AS email_domain, lower(trim(job_title)) AS job_title,
        lower(coalesce(nullif(seniority,'None'),'unknown')) AS seniority, trim(company_name) AS company_name,
        lower(trim(company_domain)) AS company_domain, lower(coalesce(nullif(industry,'None'),'unknown')) AS industry,
        employee_count, apollo_score, ingested_at
        FROM bronze WHERE email IS NOT NULL AND email <> 'None'""",
    "silver": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY email
        ORDER BY ingested_at DESC NULLS FIRST, lead_id) AS rn FROM cleaned) t WHERE rn = 1""",
    "scored": f"SELECT lead_id, source, full_name, email, email_domain, job_title, seniority, company_name, industry, employee_count, {_case_scores('email_domain')} FROM silver",
    "gold": _levels("scored"),
    # rules of the stream
    "stream_clean": """SELECT lead_id, source, concat_ws(' ', trim(first_name), trim(last_name)) AS full_name,
        lower(trim(email)) AS email, regexp_extract(lower(trim(email)),'@(.+)$',1) AS email_domain, job_title,
        CASE WHEN seniority IS NULL THEN 'unknown' ELSE lower(trim(seniority)) END AS seniority,
        trim(company_name) AS company_name, company_domain,
        CASE WHEN industry IS NULL THEN 'unknown' ELSE lower(trim(industry)) END AS industry, employee_count, lead_status,
        ingested_at FROM leads WHERE email IS NOT NULL OR lead_id IS NOT NULL""",
    "stream_silver": """SELECT * EXCLUDE (rn, ingested_at) FROM (SELECT *, row_number() OVER (PARTITION BY email, source
        ORDER BY lead_id, ingested_at) AS rn FROM stream_clean) t WHERE rn = 1""",
    "stream_scored": f"SELECT *, {_case_scores('company_domain')} FROM stream_silver",
    "stream_gold": _levels("stream_scored"),
    # rules of the local flow
    "local_clean": f"""SELECT lead_id, coalesce(source,'unknown') AS source,
        trim(trim(coalesce(first_name,''), {_WS})||' '||trim(coalesce(last_name,''), {_WS}), {_WS}) AS full_name,
        trim(lower(email), {_WS}) AS email,
        CASE WHEN contains(trim(lower(email), {_WS}),'@') THEN string_split(trim(lower(email), {_WS}),'@')[2] ELSE '' END AS email_domain,
        trim(lower(coalesce(job_title,'')), {_WS}) AS job_title,
        trim(lower(CASE WHEN coalesce(seniority,'')='' THEN 'unknown' ELSE seniority END), {_WS}) AS seniority,
        trim(coalesce(company_name,''), {_WS}) AS company_name, trim(lower(coalesce(company_domain,'')), {_WS}) AS company_domain,
        trim(lower(CASE WHEN coalesce(industry,'')='' THEN 'unknown' ELSE industry END), {_WS}) AS industry,
        employee_count, lead_status, ingested_at FROM leads WHERE coalesce(email,'') <> ''""",
    "local_silver": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY email
        ORDER BY lead_id, ingested_at) AS rn FROM local_clean) t WHERE rn = 1""",
    "local_scored": f"SELECT *, {_case_scores('email_domain', _TRUTHY)} FROM local_silver",
    "local_gold": _levels("local_scored"),
}
_NEEDS = {
    "leads": (), "bronze": ("leads",), "cleaned": ("bronze",), "silver": ("cleaned",), "scored": ("silver",),
    "gold": ("scored",), "stream_clean": ("leads",), "stream_silver": ("stream_clean",), "stream_scored": ("stream_silver",),
    "stream_gold": ("stream_scored",), "local_clean": ("leads",), "local_silver": ("local_clean",),
    "local_scored": ("local_silver",), "local_gold": ("local_scored",),
}


def _with(select: str, *names: str, more: str = "", recursive: bool = False) -> str:
    """A query over the named common tables and everything they need."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in _NEEDS[name]:
            visit(need)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    tables = ",\n".join(f"{name} AS ({CTES[name]})" for name in order)
    return f"WITH {'RECURSIVE ' if recursive else ''}{tables}{(',' + more) if more else ''}\n{select}"


# ------------------------------------------------------------------------------------------------ identity

def _lcs(a: str, b: str) -> str:
    """Longest common subsequence of two texts of at most 100 characters, one bit per character of the first."""
    one, full = "1::HUGEINT", f"((1::HUGEINT << length({a})::INT) - 1)::HUGEINT"
    masks = (f"list_transform(string_split({b}, ''), lambda c: list_sum(list_transform(range(length({a})), lambda i: "
             f"CASE WHEN substr({a}, (i + 1)::INT, 1) = c THEN ({one} << i::INT) ELSE 0::HUGEINT END))::HUGEINT)")
    step = f"lambda v, m: (((v + (v & m)) | (v - (v & m)))::HUGEINT & {full})::HUGEINT"
    return f"bit_count((~list_reduce(list_prepend({full}, {masks}), {step}))::HUGEINT & {full})::BIGINT"


def _similarity(a: str, b: str) -> str:
    total = f"(length({a}) + length({b}))"
    return f"((1::DOUBLE - ({total} - 2 * {_lcs(a, b)})::DOUBLE / {total}::DOUBLE) * 100::DOUBLE)"


def _class_count(column: str) -> str:
    """How many characters of a text have code i modulo 21, at most 3."""
    return f"least(3, len(list_filter(string_split({column}, ''), lambda ch: unicode(ch) % 21 = i)))"


def _tokens(column: str) -> str:
    plain = f"replace(replace(trim(lower(coalesce(nullif({column},'None'),'')), {_WS}),'.',''),',','')"
    return f"array_to_string(list_sort(list_filter(string_split({plain}, ' '), lambda w: w <> '')), ' ')"


def _forms(table: str) -> str:
    return f"""(SELECT *, CASE WHEN contains(e,'@') THEN string_split(e,'@')[2] ELSE '' END AS d FROM (
        SELECT *, row_number() OVER (ORDER BY lead_id, source) AS rid,
          trim(lower(coalesce(nullif(email,'None'),'')), {_WS}) AS e, {_tokens('full_name')} AS n,
          {_tokens('company_name')} AS c FROM {table}) t)"""


# Every pair of records with the first rule that matches it.
MATCHES = f"""
forms AS MATERIALIZED {_forms('cleaned')},
name_pairs AS MATERIALIZED (SELECT DISTINCT least(a.n,b.n) AS x, greatest(a.n,b.n) AS y FROM forms a JOIN forms b
    ON a.rid < b.rid AND a.n <> '' AND b.n <> '' AND levenshtein(a.n, b.n) <= 0.15 * (length(a.n) + length(b.n)) + 0.000001),
name_sim AS MATERIALIZED (SELECT x, y, {_similarity('x', 'y')} AS s FROM name_pairs),
firms AS MATERIALIZED (SELECT DISTINCT c FROM forms WHERE c <> ''),
firm_sim AS MATERIALIZED (SELECT a.c AS x, b.c AS y, {_similarity('a.c', 'b.c')} AS s FROM firms a, firms b),
matches AS MATERIALIZED (SELECT * FROM (
    SELECT a.rid AS i, b.rid AS j, a.e AS e1, a.d AS d1, a.n AS n1, a.c AS c1, b.n AS n2, b.c AS c2, s.s AS name_score,
      CASE WHEN a.e <> '' AND a.e = b.e THEN 1
           WHEN a.d <> '' AND a.d = b.d AND s.s >= 85 THEN 2
           WHEN s.s >= 90 AND f.s >= 90 THEN 3 END AS rule
    FROM forms a JOIN forms b ON a.rid < b.rid
      AND (a.e = b.e OR (a.n <> '' AND b.n <> ''
           AND levenshtein(a.n, b.n) <= 0.15 * (length(a.n) + length(b.n)) + 0.000001))
    LEFT JOIN name_sim s ON s.x = least(a.n,b.n) AND s.y = greatest(a.n,b.n)
    LEFT JOIN firm_sim f ON f.x = a.c AND f.y = b.c) t WHERE rule IS NOT NULL)
"""
LOG = """
logged AS (SELECT CASE rule WHEN 1 THEN 'exact_email' WHEN 2 THEN 'domain_name_fuzzy' ELSE 'company_name_fuzzy' END AS match_type,
    CASE rule WHEN 1 THEN 100 WHEN 2 THEN CAST(floor(name_score * 0.9::DOUBLE) AS INTEGER) ELSE 75 END AS confidence,
    CASE rule WHEN 1 THEN e1 WHEN 2 THEN d1||'|'||n1 ELSE n1||'|'||c1 END AS k1,
    CASE rule WHEN 1 THEN e1 WHEN 2 THEN d1||'|'||n2 ELSE n2||'|'||c2 END AS k2 FROM matches),
match_log AS (SELECT match_type, confidence, least(k1,k2) AS key_1, greatest(k1,k2) AS key_2, count(*) AS pair_count
    FROM logged GROUP BY ALL)
"""
REACH = """
links AS (SELECT i, j FROM matches WHERE {where} UNION ALL SELECT j, i FROM matches WHERE {where}),
reach(id, root) AS (SELECT rid, rid FROM forms UNION SELECT l.j, r.root FROM reach r JOIN links l ON l.i = r.id),
cluster AS (SELECT id, min(root) AS cid FROM reach GROUP BY id)
"""
_GOLDEN_TEXT = ("full_name", "email", "email_domain", "job_title", "seniority", "company_name", "company_domain", "industry")


def _golden(where: str) -> str:
    first = lambda f, ok: (f"first({f} ORDER BY -coalesce(apollo_score,0), lead_id, {f}) FILTER (WHERE {ok})")
    cols = [f"{first(f, f'{f} IS NOT NULL AND {f} NOT IN (' + chr(39)*2 + ',' + repr('None') + ',' + repr('nan') + ')')} AS {f}"
            for f in _GOLDEN_TEXT]
    cols += [f"{first(f, f'{f} IS NOT NULL AND {f} <> 0')} AS {f}" for f in ("employee_count", "apollo_score")]
    return REACH.format(where=where) + f""",
merged AS (SELECT cid, {', '.join(cols)}, CAST(NULL AS VARCHAR) AS lead_status,
    array_to_string(list_sort(list(DISTINCT source)), ',') AS sources, CAST(count(DISTINCT source) AS INTEGER) AS source_count,
    count(*) AS record_count FROM forms JOIN cluster ON rid = id GROUP BY cid),
golden AS (SELECT 'gid_'||substr(md5(coalesce(email,'')||':'||coalesce(email_domain,'')),1,12) AS global_id,
    * EXCLUDE (cid) REPLACE (coalesce(email,'') AS email) FROM merged)
"""


def _identity(select: str, golden_where: str | None = None, log: bool = False) -> str:
    more = MATCHES + ("," + LOG if log else "") + ("," + _golden(golden_where) if golden_where else "")
    return _with(select, "cleaned", more=more, recursive=bool(golden_where))


# ------------------------------------------------------------------------------------------------- quality

def _check(table: str, layer: str, no: int, kind: str, column: str | None = None, *, values: tuple = (),
           min_rows: int | None = None, absent: bool = False) -> str:
    """One check as one SELECT."""
    label = {"null": "expect_column_no_nulls", "unique": "expect_column_unique", "set": "expect_values_in_set",
             "rows": "expect_row_count_above", "future": "expect_no_future_dates", "email": "expect_email_format"}[kind]
    quoted = ",".join(f"'{v}'" for v in values)
    bad = "NULL" if absent else {
        "null": f"count(*) FILTER (WHERE {column} IS NULL)",
        "unique": f"count(*) - count(DISTINCT {column})",
        "set": f"count(*) FILTER (WHERE {column} IS NULL OR {column} NOT IN ({quoted or 'NULL'}))",
        "rows": "count(*)",
        "future": f"count(*) FILTER (WHERE TRY_CAST({column} AS TIMESTAMP) > {CLOCK})",
        "email": f"count(*) FILTER (WHERE {column} IS NULL OR NOT regexp_matches({column}, '^[^@]+@[^@]+\\.[^@]+$'))",
    }[kind]
    fail = {
        "null": f"bad || ' nulls found in {column}'", "unique": f"bad || ' duplicates in {column}'",
        "set": "bad || ' rows with invalid values'", "rows": f"'only ' || bad || ' rows, expected >= {min_rows}'",
        "future": "bad || ' future dates'", "email": "bad || ' invalid emails'",
    }[kind]
    ok = f"bad >= {min_rows}" if kind == "rows" else "bad = 0"
    if absent:
        status = "SKIP" if kind == "future" else "FAIL"
        ok, status_sql = ("true" if status == "SKIP" else "false"), f"'{status}'"
        message = f"'{status} — column {column} not found'"
    else:
        status_sql = f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END"
        message = f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL — ' || {fail} END"
    only = lambda *kinds: "bad" if kind in kinds else "CAST(NULL AS BIGINT)"
    pct = "CASE WHEN total > 0 THEN round_even(100.0::DOUBLE * bad / total, 2) ELSE 0 END" if kind == "null" else "CAST(NULL AS DOUBLE)"
    name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    valid = "'" + ",".join(values) + "'" if values else "CAST(NULL AS VARCHAR)"
    rows = f"CAST({min_rows} AS BIGINT)" if min_rows is not None else "CAST(NULL AS BIGINT)"
    return f"""SELECT '{layer}' AS layer, {no} AS check_no, '{label}' AS expectation, {name} AS "column", {status_sql} AS status,
    {ok} AS passed, {message} AS message, total AS total_rows, {only('null')} AS null_count, {pct} AS null_pct,
    {only('unique')} AS duplicate_count, {rows} AS min_rows, {only('future')} AS future_count,
    {only('set', 'email')} AS invalid_count, {valid} AS valid_values
    FROM (SELECT count(*) AS total, {bad} AS bad FROM {table}) t"""


def _checks(table: str, layer: str, *specs) -> str:
    return "\nUNION ALL\n".join(_check(table, layer, i, *(s[:2]), **(s[2] if len(s) > 2 else {})) for i, s in enumerate(specs, 1))


_SOURCES = ("apollo", "hubspot", "salesforce", "unknown")
SUITE = "\nUNION ALL\n".join([
    _checks("leads", "BRONZE", ("rows", None, {"min_rows": 1}), ("null", "lead_id"), ("null", "source"), ("null", "ingested_at")),
    _checks("silver", "SILVER", ("rows", None, {"min_rows": 1}), ("null", "lead_id"), ("null", "email"), ("unique", "email"),
            ("email", "email"), ("set", "source", {"values": _SOURCES}), ("future", "ingested_at")),
    _checks("gold", "GOLD", ("rows", None, {"min_rows": 1}), ("null", "lead_id"), ("null", "lead_score"),
            ("set", "intent_level", {"values": ("hot", "warm", "cool", "cold")}),
            ("set", "recommended_action", {"values": ("schedule_demo", "send_case_study", "add_to_nurture", "enrich_data")})),
])

# ------------------------------------------------------------------------------------------------ insights

_BODY = """'Hi '||coalesce(full_name,'None')||',' || chr(10)||chr(10) || 'I saw you''re working on initiatives in your area. We''d love to share a brief idea that has helped similar teams.' || chr(10)||chr(10) || 'Best,' || chr(10) || 'Sales Team'"""
_SUBJECT = "'Quick question about '||coalesce(company_name,'None')"
_CADENCE = """'["Email day 0","Follow-up day 3","Final attempt day 7"]'"""
_ENRICHED = """'Unable to enrich' AS company_summary, 'unknown' AS company_stage, '[]' AS likely_tech_stack, '[]' AS pain_points,
    'unknown' AS buying_readiness, 'email' AS best_contact_channel, 0 AS enrichment_confidence"""
_INTENT_FALLBACK = {"intent_score": "50", "intent_level": "'cool'", "urgency": "'medium'", "deal_size_estimate": "'smb'",
                    "next_best_action": "'Send introductory email'", "ai_reasoning": "'Unable to assess intent'"}
ACTIVE = f""" active AS (SELECT lead_id, full_name, email, company_name, job_title, intent_level, lead_score AS intent_score,
    CASE WHEN intent_level='hot' THEN 'critical' ELSE 'medium' END AS urgency, 'smb' AS deal_size_estimate,
    recommended_action AS next_best_action, {_SUBJECT} AS email_subject, {_BODY} AS email_body, 'score' AS ai_reasoning
    FROM gold WHERE intent_level IN ('hot','warm')),
alerts AS (SELECT lead_id, (CASE intent_level WHEN 'hot' THEN '🔥' ELSE '☀️' END)||' Hot Lead Alert — '||coalesce(full_name,'None') AS header,
    '*Company:*'||chr(10)||coalesce(company_name,'None') AS company, '*Title:*'||chr(10)||coalesce(job_title,'None') AS title,
    '*Intent Score:*'||chr(10)||intent_score||'/100' AS score,
    '*Urgency:*'||chr(10)||(CASE urgency WHEN 'critical' THEN '🚨' ELSE '📌' END)||' '||urgency AS urgency,
    '*Deal Size:*'||chr(10)||deal_size_estimate AS deal_size, '*Email:*'||chr(10)||email AS email,
    '*🎯 Next Best Action:*'||chr(10)||next_best_action AS action,
    '*📧 Suggested Email Subject:*'||chr(10)||'_'||email_subject||'_' AS subject,
    '*🤖 AI Reasoning:*'||chr(10)||ai_reasoning AS reasoning FROM active),
deliveries AS (SELECT sha256(channel||chr(31)||lead_id||chr(31)||email) AS delivery_id, lead_id, channel, intent_level
    FROM active, (VALUES ('slack'),('n8n')) c(channel))
"""

GOLD_17 = """lead_id, source, full_name, email, company_name, industry, seniority, employee_count, lead_score, seniority_score,
    company_size_score, industry_score, completeness_score, intent_level, recommended_action, 'gold' AS layer"""
_STAMP = "strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at"


def _pick(kind: str, choices: int) -> str:
    return f"CAST('0x'||substr(md5('{kind}:7:'||c_custkey),1,8) AS BIGINT) % {choices}"


ORACLES: dict[str, str] = {
    "scan_leads": _with("SELECT * FROM leads", "leads"),
    "union_sources": _with("""SELECT lead_id, source, email, CASE WHEN source='apollo' THEN employee_count END AS employee_count,
        CASE WHEN source='apollo' THEN apollo_score END AS apollo_score, CASE WHEN source='hubspot' THEN lead_status END AS lead_status
        FROM leads""", "leads"),
    "latest_snapshot": _with("""SELECT lead_id, source, substr(ingested_at,1,10) AS run_id FROM leads
        WHERE substr(ingested_at,1,10) = (SELECT max(substr(ingested_at,1,10)) FROM leads)""", "leads"),
    "flatten_people": _with("""SELECT lead_id, 'apollo' AS source, first_name, last_name, email, job_title, seniority, company_name,
        CASE WHEN company_name IS NOT NULL THEN company_domain END AS company_domain,
        CASE WHEN company_name IS NOT NULL THEN industry END AS industry,
        CASE WHEN company_name IS NOT NULL THEN employee_count END AS employee_count, apollo_score FROM leads""", "leads"),
    "flatten_contacts": _with("""SELECT lead_id, 'hubspot' AS source, first_name, last_name, email, company_name, job_title,
        CAST(NULL AS VARCHAR) AS phone, lead_status, ingested_at AS created_at, 'contact_sync' AS event_type FROM leads""", "leads"),
    "filter_titles_size": _with("""SELECT lead_id, email, job_title, employee_count FROM leads
        WHERE job_title IN ('CEO','CTO','VP of Engineering','Head of Data') AND employee_count BETWEEN 1 AND 500""", "leads"),
    "to_key_value": _with("""SELECT lead_id AS key, CAST(to_json({'lead_id': lead_id, 'source': source, 'email': email,
        'employee_count': employee_count}) AS VARCHAR) AS value FROM leads""", "leads"),
    "generated_leads": f"""
        SELECT 'lead_'||CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 4 THEN lpad(CAST(c_custkey AS VARCHAR),4,'0')
            ELSE CAST(c_custkey AS VARCHAR) END AS lead_id,
          CASE k.so WHEN 0 THEN 'apollo' ELSE 'hubspot' END AS source, p.f AS first_name, p.l AS last_name,
          lower(p.f)||'.'||lower(p.l)||c_custkey||'@'||c.d AS email, p.t AS job_title, p.s AS seniority,
          'https://linkedin.com/in/'||lower(p.f)||c_custkey AS linkedin_url, c.n AS company_name, c.d AS company_domain,
          c.i AS industry, c.z AS employee_count, 50 + sc / 100::DOUBLE AS apollo_score,
          CASE st WHEN 0 THEN 'new' WHEN 1 THEN 'contacted' ELSE 'qualified' END AS lead_status, 'lead_created' AS event_type
        FROM (SELECT c_custkey, {_pick('person', 8)} AS pi, {_pick('company', 5)} AS ci, {_pick('source', 2)} AS so,
              {_pick('status', 3)} AS st, {_pick('score', 4901)} AS sc FROM customer) k
        JOIN (VALUES (0,'Alice','Johnson','VP of Engineering','vp'),(1,'Bob','Smith','CTO','c_suite'),
              (2,'Carol','Williams','Director of Data','director'),(3,'David','Brown','Senior Engineer','senior'),
              (4,'Emma','Davis','Data Manager','manager'),(5,'Frank','Miller','Software Engineer','individual'),
              (6,'Grace','Wilson','CEO','c_suite'),(7,'Henry','Moore','Head of Analytics','director')) p(id,f,l,t,s) ON p.id = pi
        JOIN (VALUES (0,'TechCorp','techcorp.com','software',500),(1,'DataSoft','datasoft.io','saas',200),
              (2,'FinanceHub','financehub.com','fintech',1500),(3,'HealthPlus','healthplus.org','healthcare',300),
              (4,'RetailMax','retailmax.com','retail',50)) c(id,n,d,i,z) ON c.id = ci""",
    "bronze_parse": """SELECT CAST(event_id AS VARCHAR) AS kafka_key, event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
        event_id AS "offset", strftime(ts, '%Y-%m-%d %H:%M:%S') AS kafka_timestamp, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
        false AS is_corrupt, 'bronze' AS layer FROM events""",
    "bronze_leads": _with(f"SELECT * REPLACE ({_STAMP}) FROM bronze", "bronze"),
    "silver_leads": _with(f"SELECT * REPLACE ({_STAMP}) FROM silver", "silver"),
    "silver_stream_filter": _with("SELECT * EXCLUDE (ingested_at) FROM stream_clean", "stream_clean"),
    "silver_stream": _with("SELECT * FROM stream_silver", "stream_silver"),
    "silver_local": _with("SELECT * FROM local_silver", "local_silver"),
    "gold_scores": _with("SELECT * FROM gold", "gold"),
    "gold_stream": _with(f"SELECT {GOLD_17} FROM stream_gold", "stream_gold"),
    "gold_local": _with(f"SELECT {GOLD_17} FROM local_gold", "local_gold"),
    "completeness_variants": _with("""SELECT lead_id, email, 3 * (email IS NOT NULL)::INT + 2 * (company_name IS NOT NULL)::INT
          + 2 * (job_title IS NOT NULL)::INT + 3 * (company_domain IS NOT NULL)::INT AS by_company_domain,
        3 * (email IS NOT NULL)::INT + 2 * (company_name IS NOT NULL)::INT + 2 * (job_title IS NOT NULL)::INT
          + 3 * (email_domain IS NOT NULL)::INT AS by_email_domain,
        3 * (email <> '')::INT + 2 * (company_name <> '')::INT + 2 * (job_title <> '')::INT + 3 * (email_domain <> '')::INT
          AS by_filled_text FROM local_clean""", "local_clean"),
    "email_domain_variants": _with(f"""SELECT lead_id, email, regexp_extract(lower(trim(email)),'@(.+)$',1) AS after_first_at,
        split_part(lower(trim(email)),'@',2) AS part_two,
        split_part(trim(lower(coalesce(nullif(email,'None'),'')), {_WS}),'@',2) AS normal_domain FROM leads""", "leads"),
    "full_name_variants": _with(f"""SELECT lead_id, concat_ws(' ', trim(first_name), trim(last_name)) AS skip_nulls,
        trim(first_name)||' '||trim(last_name) AS null_if_any,
        trim(trim(coalesce(first_name,''), {_WS})||' '||trim(coalesce(last_name,''), {_WS}), {_WS}) AS stripped FROM leads""", "leads"),
    "normalize_enums": _with("SELECT lead_id, " + ", ".join(f"""
        CASE WHEN {c} IS NULL THEN 'unknown' ELSE lower(trim({c})) END AS {c}_stream,
        lower(coalesce(nullif({c},'None'),'unknown')) AS {c}_warehouse,
        lower(trim(coalesce(nullif({c},''),'unknown'))) AS {c}_local""" for c in ("seniority", "industry")) + " FROM leads", "leads"),
    "score_distribution": _with("""SELECT intent_level, count(lead_id) AS lead_count, avg(lead_score) AS avg_score
        FROM gold GROUP BY intent_level""", "gold"),
    "intent_share": _with("""SELECT level_order, l.intent_level, count(g.lead_id) AS lead_count,
        CASE WHEN total > 0 THEN round_even(100::DOUBLE * count(g.lead_id) / total, 1) ELSE 0 END AS share_pct,
        repeat('█', 50 * count(g.lead_id) // greatest(total, 1)) AS bar
        FROM (VALUES (1,'hot'),(2,'warm'),(3,'cool'),(4,'cold')) l(level_order, intent_level)
        CROSS JOIN (SELECT count(*) AS total FROM gold) n LEFT JOIN gold g ON g.intent_level = l.intent_level
        GROUP BY level_order, l.intent_level, total""", "gold"),
    "score_stats": _with("SELECT avg(lead_score) AS avg_score, max(lead_score) AS max_score, min(lead_score) AS min_score FROM gold", "gold"),
    "top_leads": _with(f"""SELECT lead_id, email, lead_score FROM (SELECT *, row_number() OVER (PARTITION BY email
          ORDER BY lead_score DESC, lead_id) AS rn FROM all_levels) t WHERE rn = 1 ORDER BY lead_score DESC, lead_id LIMIT 10""",
        "cleaned", more=f"all_scored AS (SELECT *, {_case_scores('email_domain')} FROM cleaned), all_levels AS ({_levels('all_scored')})"),
    "top5_leads": _with("""SELECT lead_id, full_name, company_name, lead_score, intent_level, recommended_action FROM gold
        ORDER BY lead_score DESC, lead_id LIMIT 5""", "gold"),
    "layer_counts": _with(" UNION ALL ".join(f"SELECT '{n}' AS layer, count(*) AS row_count FROM {t}" for n, t in (
        ("raw", "leads"), ("bronze", "bronze"), ("silver", "silver"), ("gold", "gold"), ("lineitem", "lineitem"), ("events", "events"))), "gold"),
    "idr_normalize": _with("SELECT lead_id, source, e AS m_email, d AS m_domain, n AS m_name, c AS m_company FROM "
                           + _forms("(SELECT * EXCLUDE (ingested_at) FROM stream_clean)"), "stream_clean"),
    "global_id": _with("SELECT lead_id, 'gid_'||substr(md5(email||':'||email_domain),1,12) AS global_id FROM silver", "silver"),
    "idr_exact_email_groups": _with(f"""SELECT e AS email, count(*) AS record_count, CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) AS pair_count
        FROM {_forms('cleaned')} WHERE e <> '' GROUP BY e HAVING count(*) > 1""", "cleaned"),
    "idr_domain_candidates": _with(f"""SELECT domain, name_1, name_2 FROM (
        SELECT *, most - (most + difference) % 2 AS budget FROM (
          SELECT DISTINCT a.d AS domain, a.n AS name_1, b.n AS name_2, abs(length(a.n) - length(b.n)) AS difference,
            CAST(floor(0.15 * (length(a.n) + length(b.n)) + 0.000000001) AS BIGINT) AS most
          FROM forms a JOIN forms b ON a.d = b.d AND a.n < b.n WHERE a.d <> '' AND a.n <> '') p) t
        WHERE difference <= budget AND levenshtein(name_1, name_2) <= budget
          AND list_sum(list_transform(range(21), lambda i: abs({_class_count('name_1')} - {_class_count('name_2')}))) <= budget""",
        "cleaned", more=f"forms AS {_forms('cleaned')}"),
    "idr_domain_pairs": _with(f"""SELECT domain, name_1, name_2, s AS score, CAST(floor(s * 0.9::DOUBLE) AS INTEGER) AS confidence FROM (
        SELECT *, {_similarity('name_1', 'name_2')} AS s FROM (SELECT DISTINCT a.d AS domain, a.n AS name_1, b.n AS name_2
          FROM forms a JOIN forms b ON a.d = b.d AND a.n < b.n WHERE a.d <> '' AND a.n <> '') p) t WHERE s >= 85""",
        "cleaned", more=f"forms AS {_forms('cleaned')}"),
    "idr_company_pairs": _with("""SELECT DISTINCT CASE WHEN a.k < b.k THEN a.n ELSE b.n END AS name_1, CASE WHEN a.k < b.k THEN a.c ELSE b.c END AS company_1,
        CASE WHEN a.k < b.k THEN b.n ELSE a.n END AS name_2, CASE WHEN a.k < b.k THEN b.c ELSE a.c END AS company_2
        FROM (SELECT DISTINCT n, c, n||chr(31)||c AS k FROM forms) a JOIN (SELECT DISTINCT n, c, n||chr(31)||c AS k FROM forms) b ON a.k < b.k
        JOIN name_sim s ON s.x = least(a.n,b.n) AND s.y = greatest(a.n,b.n) JOIN firm_sim f ON f.x = a.c AND f.y = b.c
        WHERE s.s >= 90 AND f.s >= 90""", "cleaned", more=MATCHES),
    "idr_match_log": _identity("SELECT * FROM match_log", log=True),
    "idr_pair_priority": _identity("""SELECT match_type, confidence, CAST(sum(pair_count) AS BIGINT) AS pair_count, count(*) AS node_pairs
        FROM match_log GROUP BY match_type, confidence""", log=True),
    "connected_components": _with("""SELECT id, min(root) AS component FROM reach GROUP BY id""", "cleaned", recursive=True, more="""
        links AS (SELECT a.lead_id AS i, b.lead_id AS j FROM cleaned a JOIN cleaned b ON a.lead_id <> b.lead_id AND
          (a.email = b.email OR (a.full_name = b.full_name AND a.company_domain = b.company_domain))),
        reach(id, root) AS (SELECT i, i FROM links UNION SELECT l.j, r.root FROM reach r JOIN links l ON l.i = r.id)"""),
    "golden_records": _identity("SELECT * FROM golden", "true"),
    "idr_incremental": _identity("SELECT * FROM golden", "true"),
    "golden_records_strict": _identity("SELECT * FROM golden", "rule = 1"),
    "idr_multi_source": _identity("""SELECT global_id, full_name, email, sources, source_count, record_count FROM golden
        WHERE source_count > 1""", "true"),
    "idr_stats": _identity("""SELECT CAST(sum(record_count) AS BIGINT) AS input_records, count(*) AS golden_records,
        CAST(sum(record_count) - count(*) AS BIGINT) AS duplicates_merged, count(*) FILTER (WHERE source_count > 1) AS multi_source_ids,
        round_even(100::DOUBLE * (sum(record_count) - count(*)) / sum(record_count), 1) AS reduction_pct FROM golden""", "true"),
    "dq_no_nulls": _with(_checks("silver", "SILVER", *[("null", c) for c in ("lead_id", "email", "full_name", "company_name", "employee_count")]), "silver"),
    "dq_unique": _with(_checks("cleaned", "CLEANED", *[("unique", c) for c in ("lead_id", "email", "company_name")]), "cleaned"),
    "dq_values_in_set": _with(_checks("silver", "SILVER", ("set", "source", {"values": _SOURCES}),
        ("set", "seniority", {"values": ("c_suite", "vp", "director", "manager")}),
        ("set", "no_such_column", {"values": ("x",), "absent": True})), "silver"),
    "dq_invalid_values": _with("""SELECT seniority AS invalid_value, count(*) AS row_count FROM leads
        WHERE seniority IS NULL OR seniority NOT IN ('c_suite','director','manager') GROUP BY seniority""", "leads"),
    "dq_row_count": _checks("lineitem", "LINEITEM", ("rows", None, {"min_rows": 1}), ("rows", None, {"min_rows": 10**9})),
    "dq_no_future_dates": _with(_checks("leads", "RAW", ("future", "ingested_at"), ("future", "absent_at", {"absent": True})), "leads"),
    "dq_email_format": _with(_checks("leads", "RAW", ("email", "email")), "leads"),
    "dq_suite": _with(SUITE, "gold"),
    "dq_failures": _with(f'SELECT layer, expectation, "column", message FROM ({SUITE}) r WHERE NOT passed', "gold"),
    "dq_summary": _with(f"""SELECT count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed,
        count(*) FILTER (WHERE status = 'SKIP') AS skipped, round_even(100::DOUBLE * count(*) FILTER (WHERE passed) / count(*), 1) AS pass_rate
        FROM ({SUITE}) r""", "gold"),
    "dq_summary_halves": """SELECT CAST(16 AS BIGINT) AS total_checks, CAST(13 AS BIGINT) AS passed, CAST(3 AS BIGINT) AS failed,
        CAST(0 AS BIGINT) AS skipped, round_even(100::DOUBLE * 13 / 16, 1) AS pass_rate
        FROM (SELECT count(*) AS n FROM lineitem) t WHERE n >= 1""",
    "json_report_latest": """SELECT 'ORDERS' AS layer, check_no, expectation, status, passed, (SELECT count(*) FROM orders) AS total_rows
        FROM (VALUES (1, 'expect_row_count_above', 'FAIL', false), (2, 'expect_column_no_nulls', 'PASS', true))
        t(check_no, expectation, status, passed)""",
    "dq_lineitem": _checks("lineitem", "LINEITEM", ("rows", None, {"min_rows": 1}), ("null", "l_orderkey"), ("unique", "l_orderkey"),
                           ("set", "l_returnflag", {"values": ("A", "N")}), ("null", "l_shipdate")),
    "dq_documents": _checks("documents", "DOCUMENTS", ("rows", None, {"min_rows": 1}), ("null", "text"),
                            ("set", "lang", {"values": ("en", "de")}), ("unique", "doc_id")),
    "metrics_snapshot": _with("""SELECT 'record_count' AS metric, 'bronze' AS label, CAST(count(*) AS DOUBLE) AS value FROM bronze
        UNION ALL SELECT 'record_count', 'silver', count(*) FROM silver UNION ALL SELECT 'record_count', 'gold', count(*) FROM gold
        UNION ALL SELECT 'leads_by_level', l, count(g.lead_id) FROM (VALUES ('hot'),('warm'),('cool'),('cold')) v(l)
          LEFT JOIN gold g ON g.intent_level = l GROUP BY l
        UNION ALL SELECT 'avg_lead_score', 'all', round_even(avg(lead_score), 2) FROM gold
        UNION ALL SELECT 'pipeline_runs_total', 'all', 1""", "gold"),
    "layer_health": " UNION ALL ".join(
        f"SELECT '{t}' AS layer, 'OK' AS status, CAST(1 AS BIGINT) AS files, count(*) AS rows FROM {t}" for t in ("customer", "orders", "lineitem", "events")
    ) + " UNION ALL SELECT 'absent', 'EMPTY', 0, 0",
    "insights_fallback": _with(f"""SELECT * EXCLUDE (intent_level), intent_level AS score_intent_level, {_ENRICHED},
        '[]' AS intent_signals, {', '.join(f'{v} AS {k}' for k, v in _INTENT_FALLBACK.items())}, {_SUBJECT} AS email_subject,
        {_BODY} AS email_body, {_CADENCE} AS cadence, '1.0' AS pipeline_version FROM gold""", "gold"),
    "arrays_to_json": _with(f"SELECT lead_id, {_CADENCE} AS cadence FROM gold", "gold"),
    "insights_parse": _with(f"""SELECT lead_id, intent_level = 'hot' AS parsed,
        CASE WHEN intent_level = 'hot' THEN lead_score ELSE 50 END AS intent_score,
        CASE WHEN intent_level = 'hot' THEN NULL ELSE 'cool' END AS intent_level,
        CASE WHEN intent_level = 'hot' THEN 'high' ELSE 'medium' END AS urgency,
        {', '.join(f"CASE WHEN intent_level <> 'hot' THEN {_INTENT_FALLBACK[k]} END AS {k}" for k in ('deal_size_estimate', 'next_best_action', 'ai_reasoning'))},
        CASE WHEN intent_level <> 'hot' THEN '[]' END AS intent_signals FROM gold WHERE intent_level <> 'cold'""", "gold"),
    "insights_merge": _with(f"""SELECT lead_id, lead_score, CASE WHEN intent_level = 'hot' THEN lead_score ELSE 50 END AS intent_score,
        CASE WHEN intent_level = 'hot' THEN 'hot' ELSE 'cool' END AS intent_level,
        CASE WHEN intent_level = 'hot' THEN 'high' ELSE 'medium' END AS urgency,
        {', '.join(f"CASE WHEN intent_level <> 'hot' THEN {_INTENT_FALLBACK[k]} END AS {k}" for k in ('deal_size_estimate', 'next_best_action', 'ai_reasoning'))}
        FROM gold""", "gold"),
    "insights_merge_duplicates": _with("""SELECT lead_id, CASE WHEN intent_level = 'hot' THEN 10 ELSE 50 END AS intent_score
        FROM gold""", "gold"),
    "insights_overlay_extra": _with("""SELECT lead_id, CASE WHEN intent_level = 'hot' THEN 'new@example.com' ELSE email END AS email,
        CASE WHEN intent_level = 'hot' THEN 7 ELSE employee_count END AS employee_count,
        CASE WHEN intent_level = 'hot' THEN 'high' ELSE 'medium' END AS urgency,
        CASE WHEN intent_level = 'hot' THEN '{"note":"call","tags":"[\\"a\\",\\"b\\"]"}' ELSE '{}' END AS extra FROM gold""", "gold"),
    "insights_rejected": _with("SELECT lead_id, '[1, 2]' AS response FROM gold WHERE intent_level = 'cool'", "gold"),
    "insights_select": _with(f"""SELECT lead_id AS "LEAD_ID", full_name AS "FULL_NAME", email AS "EMAIL", company_name AS "COMPANY_NAME",
        industry AS "INDUSTRY", seniority AS "SENIORITY", lead_score AS "LEAD_SCORE", 50 AS "INTENT_SCORE", 'cool' AS "INTENT_LEVEL",
        'medium' AS "URGENCY", 'smb' AS "DEAL_SIZE_ESTIMATE", 'Send introductory email' AS "NEXT_BEST_ACTION",
        'Unable to enrich' AS "COMPANY_SUMMARY", 'unknown' AS "COMPANY_STAGE", 'unknown' AS "BUYING_READINESS",
        'email' AS "BEST_CONTACT_CHANNEL", {_SUBJECT} AS "EMAIL_SUBJECT", {_BODY} AS "EMAIL_BODY",
        'Unable to assess intent' AS "AI_REASONING" FROM gold""", "gold"),
    "prompt_render": _with("""SELECT lead_id, concat_ws(chr(10), 'Lead', 'Name: '||full_name, 'Job title: Unknown', 'Seniority: '||seniority,
        'Company: '||company_name, 'Industry: '||industry, 'Employee count: '||coalesce(CAST(employee_count AS VARCHAR),'None'),
        'Email domain: Unknown', 'Answer in JSON.') AS user_prompt FROM local_gold""", "local_gold"),
    "activation_leads": _with("SELECT * FROM active", "gold", more=ACTIVE),
    "activation_ranked": _with("""SELECT lead_id, intent_score, row_number() OVER (ORDER BY intent_score DESC, lead_id) AS rank
        FROM active""", "gold", more=ACTIVE),
    "alert_text": _with("SELECT * FROM alerts", "gold", more=ACTIVE),
    "alert_payload": _with("""SELECT lead_id, CAST(to_json({'blocks': [
          to_json({'type': 'header', 'text': {'type': 'plain_text', 'text': header}}),
          to_json({'type': 'section', 'fields': [{'type': 'mrkdwn', 'text': company}, {'type': 'mrkdwn', 'text': title},
            {'type': 'mrkdwn', 'text': score}, {'type': 'mrkdwn', 'text': urgency}, {'type': 'mrkdwn', 'text': deal_size},
            {'type': 'mrkdwn', 'text': email}]}),
          to_json({'type': 'section', 'text': {'type': 'mrkdwn', 'text': action}}),
          to_json({'type': 'section', 'text': {'type': 'mrkdwn', 'text': subject}}),
          to_json({'type': 'section', 'text': {'type': 'mrkdwn', 'text': reasoning}}),
          to_json({'type': 'divider'})]}) AS VARCHAR) AS payload FROM alerts""", "gold", more=ACTIVE),
    "workflow_payload": _with("""SELECT lead_id, CAST(to_json({'workflow_type': 'hot_lead', 'triggered_at': '2026-06-15 00:00:00', 'lead':
        {'lead_id': lead_id, 'full_name': full_name, 'email': email, 'company_name': company_name, 'job_title': job_title,
         'intent_level': intent_level, 'intent_score': intent_score, 'urgency': urgency, 'next_best_action': next_best_action,
         'email_subject': email_subject, 'email_body': email_body, 'linkedin_message': NULL, 'key_value_prop': NULL}}) AS VARCHAR)
        AS payload FROM active""", "gold", more=ACTIVE),
    "outbox": _with("""SELECT delivery_id, lead_id, channel, 'pending' AS status FROM deliveries
        WHERE NOT (channel = 'slack' AND intent_level = 'hot')""", "gold", more=ACTIVE),
    "delivery_summary": _with("""SELECT count(DISTINCT lead_id) AS total, count(*) FILTER (WHERE channel = 'slack' AND intent_level = 'hot') AS slack,
        count(*) FILTER (WHERE channel = 'n8n') AS n8n, count(*) FILTER (WHERE channel = 'slack' AND intent_level <> 'hot') AS failed
        FROM deliveries""", "gold", more=ACTIVE),
    "warehouse_prepare": _with("SELECT " + ", ".join(
        f"nullif({c},'None') AS \"{c.upper()}\"" for c in ("lead_id", "source", "first_name", "last_name", "email", "job_title", "seniority",
                                                         "company_name", "company_domain", "industry", "lead_status", "ingested_at")
    ) + ', employee_count AS "EMPLOYEE_COUNT", apollo_score AS "APOLLO_SCORE" FROM leads', "leads"),
    "warehouse_prepare_unified": _with('SELECT lead_id AS "LEAD_ID", email AS "EMAIL", seniority AS "SENIORITY", industry AS "INDUSTRY" FROM leads', "leads"),
    "warehouse_roundtrip": _with("""SELECT nullif(lead_id,'None') AS lead_id, nullif(email,'None') AS email, lead_score, intent_level
        FROM gold""", "gold"),
    "batch_pipeline": _with(f"""SELECT c.*, gold_rows, gold_score FROM (
        SELECT count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed,
        count(*) FILTER (WHERE status = 'SKIP') AS skipped, round_even(100::DOUBLE * count(*) FILTER (WHERE passed) / count(*), 1) AS pass_rate
        FROM ({SUITE}) r) c, (SELECT count(*) AS gold_rows, CAST(sum(lead_score) AS BIGINT) AS gold_score FROM gold) g""", "gold"),
    "landed_messages": _with("""SELECT CASE source WHEN 'apollo' THEN 'apollo_leads' ELSE 'crm_events' END AS topic, lead_id AS key
        FROM leads""", "leads"),
    "stream_restart": _with("SELECT lead_id, source, email, 'leads' AS topic FROM leads", "leads"),
    "stream_bronze": _with("SELECT *, lead_id AS kafka_key, 'leads' AS topic, false AS is_corrupt, 'bronze' AS layer FROM leads", "leads"),
    "stream_silver": _with("""SELECT email, source, email_domain, 'silver' AS layer FROM stream_silver""", "stream_silver"),
    "stream_silver_table": _with("""SELECT email, source, email_domain, 'silver' AS layer FROM stream_silver""", "stream_silver"),
    "stream_silver_index": _with("""SELECT email, source, email_domain, 'silver' AS layer FROM stream_silver""", "stream_silver"),
    "insights_cached": _with("""SELECT sha256(user_prompt) AS prompt_sha256, count(*) AS leads,
        CAST(length(user_prompt) % 101 AS INTEGER) AS enrichment_confidence, CAST(CASE WHEN seniority IN ('vp','director') THEN 2 ELSE 1 END AS BIGINT) AS asks,
        CASE WHEN seniority IN ('vp','director') THEN '2' ELSE '1' END AS last_run FROM (
        SELECT *, concat_ws(chr(10), 'Lead', 'Name: '||full_name, 'Job title: Unknown', 'Seniority: '||seniority,
        'Company: '||company_name, 'Industry: '||industry, 'Employee count: '||coalesce(CAST(employee_count AS VARCHAR),'None'),
        'Email domain: Unknown', 'Answer in JSON.') AS user_prompt FROM local_gold) p GROUP BY user_prompt, seniority""", "local_gold"),
    "delivery_ledger": _with("""SELECT delivery_id, channel, CAST(CASE kind WHEN 'never' THEN 3 WHEN 'once' THEN 2 ELSE 1 END AS BIGINT) AS tries,
        CASE kind WHEN 'never' THEN 'dead' ELSE 'sent' END AS status,
        CASE kind WHEN 'never' THEN '2026-06-15 00:03:20' WHEN 'once' THEN '2026-06-15 00:01:00' ELSE '2026-06-15 00:00:00' END AS last_try,
        CAST(NULL AS VARCHAR) AS next_try, CASE kind WHEN 'never' THEN 'timeout' END AS error FROM (SELECT *, CASE
        WHEN delivery_id < '4' AND channel = 'slack' THEN 'never' WHEN delivery_id >= '4' AND delivery_id < '8' THEN 'once' ELSE 'at first' END
        AS kind FROM deliveries) d""", "gold", more=ACTIVE),
}
