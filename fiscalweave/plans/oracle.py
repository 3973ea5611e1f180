"""Logical views in plain SQL, written apart from the Spark plans, for checking their results.

The statements follow the textbook form of each rule (a UNION of one SELECT per tag, a row number
for the latest owner, a nested sub-query per measure) rather than the form the Spark code runs.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2000-06-15'"


def fy(d: str) -> str:
    return f"CAST(year({d}) + CASE WHEN month({d}) >= 8 THEN 1 ELSE 0 END AS INTEGER)"


def qtr(d: str) -> str:
    return f"CAST(floor(((month({d}) + 4) % 12) / 3) + 1 AS INTEGER)"


def week(d: str) -> str:
    start = f"make_date({fy(d)} - 1, 8, 1)"
    return (f"CAST(floor((date_diff('day', {start}, {d}) + dayofweek({start})) / 7) + 1 "
            "AS INTEGER)")


def qtr_start(d: str) -> str:
    return (f"CAST(date_trunc('month', {d}) - to_months(CAST((month({d}) + 4) % 12 % 3 AS INTEGER))"
            " AS DATE)")


def begin(d: str) -> str:
    return f"({d} - CAST(dayofweek({d}) AS INTEGER))"


def week_age(d: str) -> str:
    return f"CAST(date_diff('day', {begin(d)}, {begin(AS_OF)}) // 7 AS INTEGER)"


def region(country: str) -> str:
    return (f"CASE WHEN {country} IN ('NATION_1', 'NATION_6', 'NATION_11', 'NATION_16', "
            f"'NATION_21') THEN 'LATAM' WHEN {country} = 'NATION_3' THEN 'NATION_3' "
            "ELSE 'Other' END")


def norm(name: str) -> str:
    bare = f"replace(replace(coalesce({name}, ''), '''', ''), '’', '')"
    spaced = f"replace(replace({bare}, ',', ' '), '.', ' ')"
    return f"lower(trim(regexp_replace({spaced}, '\\s+', ' ', 'g')))"


def tokens(name: str) -> str:
    return f"array_to_string(list_sort(string_split({norm(name)}, ' ')), ' ')"


def number(text: str) -> str:
    bare = f"regexp_replace({text}, '[,%$\\s]', '', 'g')"
    return (f"CASE WHEN regexp_matches({bare}, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') "
            f"THEN CAST({bare} AS DOUBLE) END")


def ratio(num: str, den: str) -> str:
    return (f"coalesce(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0), 0.0)")


def index(num: str, den: str) -> str:
    return f"(100.0::DOUBLE * CAST({num} AS DOUBLE)) / nullif(CAST({den} AS DOUBLE), 0)"


# Conditions per tag on v_bookings.
_SALES = "event_type = 'new' AND offering = 'CORE' AND category = 'F'"
_FIRM = "NOT (firm_id IN (7, 13))"
_A = f"event_type = 'new' AND offer_name LIKE '%gear%' AND offer_name LIKE '%hot%' AND {_FIRM}"
_B = f"event_type = 'new' AND offer_name LIKE '%gear%' AND offer_name LIKE '%blue%' AND {_FIRM}"
TAGS = {
    "SALES": _SALES,
    "PAYROLL": "event_type = 'new' AND offering = 'PAY'",
    "ADV": f"{_SALES} AND product = 'PROMO'",
    "ADV_SALES": f"{_SALES} AND product = 'PROMO'",
    "ADV_UPGRADES": "event_type = 'upgrade' AND category = 'O' AND product = 'PROMO'",
    "SIGNUP": "event_type = 'signup' AND offering = 'PMT'",
    "PKG_ANY": f"{_SALES} AND lower(offer_name) LIKE '%widget%' AND {_FIRM}",
    "PKG_A": f"{_A} AND product <> 'MEDIUM'",
    "PKG_A_ADV": f"{_A} AND product = 'PROMO'",
    "PKG_A_ESS": f"{_A} AND product = 'ECONOMY'",
    "PKG_B": f"{_B} AND product <> 'MEDIUM'",
    "PKG_B_ADV": f"{_B} AND product = 'PROMO'",
    "PKG_B_ESS": f"{_B} AND product = 'ECONOMY'",
    "PKG_C": f"event_type = 'new' AND offer_name LIKE '%gear%' AND offer_name LIKE '%large%' "
             f"AND {_FIRM}",
    "PKG_LEDGER": f"event_type = 'new' AND offer_name LIKE '%gear%' AND product = 'MEDIUM' "
                  f"AND {_FIRM}",
}
TEAMS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

EVENT_KEYS = ("fy, qtr, week, event_date, super_channel, channel, country, team_raw, full_name, "
         "event_type, account_id, firm_id, product, offer_name, offering")

CONTRACT = ("fy, qtr, fweek, event_date, super_channel, channel, region, team_raw, account_owner, "
            "event, account_id, firm_id, sku, offer_name, product, cnt, table_type")


def _digits(k: str) -> str:
    return f"lpad(CAST({k} AS VARCHAR), 9, '0')"


_D = "CAST(o_orderdate AS DATE)"

VIEWS: dict[str, str] = {
    "v_bookings": f"""
        SELECT l_partkey AS offer_key, l_orderkey, l_suppkey AS firm_id, l_suppkey AS agent_id,
            CASE l_returnflag WHEN 'N' THEN 'new' WHEN 'A' THEN 'upgrade' WHEN 'R' THEN 'signup' END
                AS event_type,
            l_linestatus AS category, o_custkey AS account_id, {_D} AS event_date,
            o_orderpriority AS channel,
            CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'DIRECT'
                ELSE 'PARTNER' END AS super_channel,
            c_mktsegment AS team_raw, c_mktsegment AS division_l3,
            'L4_' || CAST(c_nationkey % 5 AS VARCHAR) AS division_l4,
            CASE WHEN c_nationkey % 2 = 0 THEN 'NATIONALS' ELSE 'PARTNERS' END AS division_name,
            n_name AS country, p_type AS product, p_brand AS product_family, p_name AS offer_name,
            CASE WHEN p_size <= 30 THEN 'CORE' WHEN p_size <= 40 THEN 'PAY' ELSE 'PMT' END
                AS offering
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN part ON l_partkey = p_partkey""",
    "v_days": f"""
        SELECT CAST(unnest(generate_series(min({_D}), greatest(max({_D}), DATE '2001-07-31'),
            INTERVAL 1 DAY)) AS DATE) AS date
        FROM orders""",
    "v_span": """
        SELECT CAST(unnest(generate_series(DATE '1994-08-01', DATE '2002-07-31', INTERVAL 1 DAY))
            AS DATE) AS date""",
    "v_place": f"""
        SELECT date, {fy('date')} AS fy, {qtr('date')} AS qtr,
            {fy(AS_OF)} - {fy('date')} AS fiscal_year_age FROM v_span""",
    "v_cal": f"""
        SELECT date, {fy('date')} AS fy, {qtr('date')} AS qtr, {week('date')} AS week FROM v_days""",
    "v_ext": f"""
        SELECT date, fy, qtr, week, {qtr_start('date')} AS qtr_start,
            CAST({qtr_start('date')} + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS qtr_end,
            {fy(AS_OF)} - fy AS fiscal_year_age,
            CAST({fy(AS_OF)} * 4 + {qtr(AS_OF)} - (fy * 4 + qtr) AS INTEGER) AS fiscal_qtr_age,
            {week_age('date')} AS week_age
        FROM v_cal""",
    "v_weeks": """
        SELECT fy, qtr, week, min(date) AS week_start_date, max(date) AS week_end_date,
            CAST(count(DISTINCT date) AS INTEGER) AS day_count_in_qtr
        FROM v_cal WHERE fy BETWEEN 1999 AND 2001 GROUP BY fy, qtr, week""",
    "v_agents": f"""
        SELECT s_suppkey AS agent_id, {_digits('s_suppkey')} || ', Supplier' AS full_name,
            CASE WHEN s_suppkey % 29 = 3 THEN 'Hub Integration ' || {_digits('s_suppkey')}
                 WHEN s_suppkey % 31 = 5 THEN 'Visitor ' || {_digits('s_suppkey')}
                 WHEN s_suppkey % 6 = 1 THEN {_digits('s_suppkey')} || ', Supplier'
                 ELSE 'Supplier ' || {_digits('s_suppkey')} END AS name,
            CASE (s_nationkey + v) % 4 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING'
                WHEN 2 THEN 'FURNITURE' ELSE 'HOUSEHOLD' END AS division_l3,
            'L4_' || CAST((s_nationkey + v) % 5 AS VARCHAR) AS division_l4, rec_start, rec_end
        FROM supplier, (VALUES (0, DATE '1995-01-01', DATE '1998-06-30'),
                               (1, DATE '1998-07-01', DATE '2999-12-31')) AS t(v, rec_start, rec_end)
        """,
    "v_accounts": """
        SELECT c_custkey AS id, c_custkey AS company_id, c_custkey - c_custkey % 10 AS parent_id
        FROM customer""",
    "v_history": f"""
        SELECT o_custkey AS account, o_orderkey % 100 AS user_id,
            CASE WHEN o_orderpriority = '5-LOW' THEN 'Team' ELSE 'Owner' END AS type,
            {_D} AS start_date,
            CASE WHEN o_orderstatus <> 'O' THEN {_D} + 90 END AS end_date,
            o_orderkey % 11 = 0 AS isdeleted
        FROM orders""",
    "v_users": """
        SELECT s_suppkey AS id, CASE WHEN s_suppkey % 7 = 0 THEN 'x' ELSE '' END
            || CAST(s_suppkey AS VARCHAR) AS federation_id
        FROM supplier""",
    "v_names": f"""
        SELECT u.id AS user_id, a.name AS agent_name
        FROM v_users u LEFT JOIN v_agents a
          ON TRY_CAST(u.federation_id AS BIGINT) = a.agent_id AND a.rec_end > {AS_OF}""",
    "v_account_status": f"""
        SELECT o_orderkey AS account_id, {_D} AS first_login,
            CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey END AS firm_id,
            CASE WHEN o_orderkey % 17 <> 0 THEN {_D} END AS sold_date
        FROM orders""",
    "v_company_status": """
        SELECT o_orderkey AS account_id, n_name AS country,
            CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'DIRECT'
                ELSE 'PARTNER' END AS super_channel,
            o_orderpriority AS channel,
            CASE WHEN o_orderkey % 19 = 0 THEN 'Trial' WHEN o_orderkey % 23 <> 0 THEN 'Paid' END
                AS subscription_type,
            last_ship AS cancel_date
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS last_ship FROM lineitem GROUP BY 1)
          ON l_orderkey = o_orderkey
        WHERE o_orderstatus = 'F'""",
    "v_activations": f"""
        SELECT s.account_id, o_custkey AS firm_id,
            'Supplier ' || {_digits('o_orderkey % 100')} AS account_owner,
            c_mktsegment AS division, s.country, s.cancel_date
        FROM v_company_status s JOIN orders ON s.account_id = o_orderkey
        JOIN customer ON o_custkey = c_custkey""",
    "v_roster": f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS row_no,
            CASE s_nationkey % 4 WHEN 0 THEN 'nat' WHEN 1 THEN ' Regional ' WHEN 2 THEN ''
                ELSE 'grow' END AS Segment,
            CASE WHEN s_suppkey % 37 = 36 THEN '  '
                 WHEN s_suppkey % 5 = 0 THEN {_digits('named')} || ' Supplier'
                 ELSE 'Supplier ' || {_digits('named')} END AS Agent,
            CASE s_nationkey % 6 WHEN 0 THEN 'L3 ALPHA' WHEN 1 THEN ' L3  BETA '
                WHEN 2 THEN 'L3 GAMMA' WHEN 3 THEN 'L3 DELTA' WHEN 4 THEN ''
                ELSE 'L3 ELSEWHERE' END AS L3,
            {_digits('s_suppkey')} || CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE '_supplier@x.org' END
                AS AgentEmail
        FROM (SELECT *, s_suppkey - CASE WHEN s_suppkey % 10 = 9 THEN 1 ELSE 0 END AS named
              FROM supplier)""",
    "v_offers": """
        SELECT CAST(p_partkey AS VARCHAR) AS offer_id,
            CASE WHEN p_size < 10 THEN 'AGENT' WHEN p_size <= 45 THEN 'SELF' END AS signup_category,
            'PROMO_' || CAST(p_size % 3 AS VARCHAR) AS promotion,
            CASE WHEN p_size % 2 = 0 THEN 'RETAIL' ELSE 'WHOLESALE' END AS use
        FROM part WHERE p_partkey % 8 <> 0""",
    "v_opps": f"""
        SELECT *, stage IN ('Closed Won', 'Closed Lost') AS isclosed, stage = 'Closed Won' AS iswon
        FROM (SELECT o_orderkey AS id, o_orderkey % 100 AS owner_id, o_custkey AS account_id,
                CASE WHEN o_orderstatus = 'F' THEN 'Closed Won' WHEN o_orderstatus = 'O'
                     THEN 'Commit' WHEN o_orderkey % 2 = 0 THEN 'Closed Lost' ELSE 'Value' END AS stage,
                o_totalprice AS amount, CAST(o_orderkey % 10 AS DOUBLE) / 10 AS probability,
                {_D} + 30 AS close_date, {_D} AS created_date
              FROM orders)""",
    "v_lines": """
        SELECT l_orderkey AS opp_id, l_quantity AS quantity, l_extendedprice AS total,
            CASE WHEN l_linenumber = 7 THEN TRUE WHEN l_linenumber < 6 THEN FALSE END AS isdeleted,
            CASE WHEN p_partkey % 9 <> 0 THEN p_name END AS price_name
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "v_wide": f"""
        SELECT CASE WHEN week % 17 <> 0 THEN CAST(fy AS VARCHAR) ELSE ' ' END AS year_fy,
            CAST(qtr AS VARCHAR) AS quarter_fy, CAST(week AS VARCHAR) AS week_fy,
            CAST(a AS VARCHAR) AS a,
            CASE WHEN week % 10 = 0 THEN 'abc' ELSE CAST(b AS VARCHAR) END AS b,
            CAST(f AS VARCHAR) AS f, CAST(h AS VARCHAR) AS h, CAST(m AS VARCHAR) AS m
        FROM (SELECT {fy(_D)} + 1 AS fy, {qtr(_D)} AS qtr, {week(_D)} AS week,
                nullif(count(*) FILTER (c_mktsegment = 'AUTOMOBILE'), 0) AS a,
                nullif(count(*) FILTER (c_mktsegment = 'BUILDING'), 0) AS b,
                nullif(count(*) FILTER (c_mktsegment = 'FURNITURE'), 0) AS f,
                nullif(count(*) FILTER (c_mktsegment = 'HOUSEHOLD'), 0) AS h,
                nullif(count(*) FILTER (c_mktsegment = 'MACHINERY'), 0) AS m
              FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)""",
    "v_forecast": """
        SELECT CAST(year_fy AS INTEGER) AS fy, CAST(quarter_fy AS INTEGER) AS qtr,
            CAST(week_fy AS INTEGER) AS week, team,
            coalesce(TRY_CAST(cell AS DOUBLE), 0.0) AS forecast
        FROM (SELECT year_fy, quarter_fy, week_fy, 'AUTOMOBILE' AS team, a AS cell FROM v_wide
              UNION ALL SELECT year_fy, quarter_fy, week_fy, 'BUILDING', b FROM v_wide
              UNION ALL SELECT year_fy, quarter_fy, week_fy, 'FURNITURE', f FROM v_wide
              UNION ALL SELECT year_fy, quarter_fy, week_fy, 'HOUSEHOLD', h FROM v_wide
              UNION ALL SELECT year_fy, quarter_fy, week_fy, 'MACHINERY', m FROM v_wide)
        WHERE length(trim(year_fy)) > 0""",
    # -- events ------------------------------------------------------------------------------------
    "v_dated": """
        SELECT b.*, c.fy, c.qtr, c.week, a.full_name
        FROM v_bookings b LEFT JOIN v_cal c ON b.event_date = c.date
        JOIN v_agents a ON a.agent_id = b.agent_id
        WHERE a.rec_end = DATE '2999-12-31' AND c.fy = 2000""",
    "v_weekly": "SELECT fy, qtr, week AS fweek, event_date, super_channel, channel, "
                + region("country") + """ AS region, team_raw, full_name AS account_owner,
            event_type AS event, CAST(account_id AS VARCHAR) AS account_id,
            CAST(firm_id AS VARCHAR) AS firm_id, product AS sku, offer_name, offering AS product,
            1 AS cnt, table_type FROM ("""
                + " UNION ALL ".join(
                    f"SELECT DISTINCT {EVENT_KEYS}, '{tag}' AS table_type FROM v_dated WHERE {cond}"
                    for tag, cond in TAGS.items()) + ")",
    "v_counts": """
        SELECT fy, qtr, fweek, coalesce(team_raw, '') AS team, table_type, count(*) AS n
        FROM v_weekly GROUP BY 1, 2, 3, 4, 5
        UNION ALL
        SELECT fy, qtr, fweek, '*', table_type, count(*) FROM v_weekly GROUP BY 1, 2, 3, 5""",
    "v_teams": "SELECT * FROM v_counts WHERE team <> '*'",
    "v_series": "SELECT table_type, fy, qtr, fweek, n FROM v_counts WHERE team = '*'",
    "v_snapshot": f"""
        SELECT c.fy, c.qtr, c.week AS fweek, s.cancel_date AS event_date,
            CAST(NULL AS VARCHAR) AS super_channel, CAST(NULL AS VARCHAR) AS channel,
            {region('s.country')} AS region, s.division AS team_raw, s.account_owner,
            'active_cancel' AS event, CAST(s.account_id AS VARCHAR) AS account_id,
            CAST(s.firm_id AS VARCHAR) AS firm_id, CAST(NULL AS VARCHAR) AS sku,
            CAST(NULL AS VARCHAR) AS offer_name, CAST(NULL AS VARCHAR) AS product, 1 AS cnt,
            'CANCELS' AS table_type
        FROM v_activations s LEFT JOIN v_cal c ON s.cancel_date = c.date
        WHERE s.cancel_date IS NOT NULL AND s.cancel_date <= {AS_OF} AND c.fy = 2000""",
    "v_eligible": f"""
        SELECT q.account_id, q.first_login, q.firm_id, q.sold_date, s.cancel_date, s.country
        FROM v_account_status q JOIN v_company_status s ON q.account_id = s.account_id
        WHERE s.country IN ('NATION_1', 'NATION_6', 'NATION_11', 'NATION_16', 'NATION_21',
                            'NATION_3', 'NATION_8', 'NATION_13')
          AND s.super_channel = 'DIRECT' AND s.channel IN ('1-URGENT', '2-HIGH')
          AND s.subscription_type <> 'Trial' AND q.firm_id IS NOT NULL
          AND s.cancel_date IS NOT NULL AND q.first_login < s.cancel_date
          AND s.cancel_date <= {AS_OF}""",
    "v_owned": """
        SELECT e.account_id, e.firm_id, e.cancel_date, e.country,
            coalesce(n.agent_name, 'Unmanaged') AS account_owner,
            row_number() OVER (PARTITION BY e.account_id
                ORDER BY CASE WHEN h.end_date IS NULL THEN DATE '2999-12-31' ELSE h.end_date END DESC,
                    h.start_date DESC NULLS LAST, h.user_id DESC NULLS LAST,
                    n.agent_name DESC NULLS LAST) AS rn
        FROM v_eligible e
        LEFT JOIN v_accounts a ON e.firm_id = a.company_id
        LEFT JOIN v_history h ON a.id = h.account AND h.type = 'Owner' AND h.isdeleted = FALSE
        LEFT JOIN v_names n ON n.user_id = h.user_id
        WHERE e.sold_date IS NOT NULL""",
    "v_cancels": f"""
        SELECT c.fy, c.qtr, c.week AS fweek, o.cancel_date AS event_date,
            CAST(NULL AS VARCHAR) AS super_channel, CAST(NULL AS VARCHAR) AS channel,
            {region('o.country')} AS region, CAST(NULL AS VARCHAR) AS team_raw, o.account_owner,
            'active_cancel' AS event, CAST(o.account_id AS VARCHAR) AS account_id,
            CAST(o.firm_id AS VARCHAR) AS firm_id, CAST(NULL AS VARCHAR) AS sku,
            CAST(NULL AS VARCHAR) AS offer_name, CAST(NULL AS VARCHAR) AS product, 1 AS cnt,
            'CANCELS' AS table_type
        FROM v_owned o LEFT JOIN v_cal c ON o.cancel_date = c.date WHERE o.rn = 1 AND c.fy = 2000""",
    # -- owners ------------------------------------------------------------------------------------
    "v_roster_names": """
        SELECT pos, variant, name, team FROM (
            SELECT CAST(row_no AS BIGINT) AS pos, 0 AS variant, trim(Agent) AS name, team
            FROM v_roster_teams
            UNION ALL
            SELECT CAST(row_no AS BIGINT), 1,
                replace(split_part(trim(AgentEmail), '@', 1), '_', ' '), team
            FROM v_roster_teams WHERE AgentEmail LIKE '%@%')
        WHERE team IS NOT NULL""",
    "v_roster_teams": """
        SELECT *, coalesce(
            CASE trim(regexp_replace(L3, '\\s+', ' ', 'g')) WHEN 'L3 ALPHA' THEN 'Alpha'
                WHEN 'L3 BETA' THEN 'Beta' WHEN 'L3 GAMMA' THEN 'Gamma' WHEN 'L3 DELTA' THEN 'Delta'
                END,
            CASE upper(trim(Segment)) WHEN 'NAT' THEN 'Alpha' WHEN 'REGIONAL' THEN 'Beta'
                WHEN 'GROW' THEN 'Echo' END) AS team
        FROM v_roster WHERE length(trim(Agent)) > 0""",
    "v_exact": f"""
        SELECT key, team FROM (
            SELECT {norm('name')} AS key, team, row_number() OVER (
                PARTITION BY {norm('name')} ORDER BY pos DESC, variant DESC) AS rn
            FROM v_roster_names) WHERE rn = 1""",
    "v_token": f"""
        SELECT {tokens('name')} AS key, min(team) AS team FROM v_roster_names
        GROUP BY 1 HAVING count(DISTINCT team) = 1""",
    "v_classified": f"""
        SELECT s.*, CASE
            WHEN {norm('account_owner')} = 'supplier 000000014' THEN NULL
            WHEN {norm('account_owner')} = 'supplier 000000012' THEN 'Gamma'
            WHEN {norm('account_owner')} = 'hub integration 000000003' THEN 'Delta'
            WHEN e.team IS NOT NULL THEN e.team
            WHEN t.team IS NOT NULL THEN t.team
            WHEN {norm('account_owner')} = 'unmanaged'
              OR {norm('account_owner')} LIKE '%integration%'
              OR {norm('account_owner')} LIKE '%placeholder%' THEN 'Unmanaged' END AS team
        FROM v_cancels s
        LEFT JOIN v_exact e ON e.key = {norm('s.account_owner')}
        LEFT JOIN v_token t ON t.key = {tokens('s.account_owner')}""",
    "v_outcomes": """
        SELECT *, CASE WHEN team IS NULL THEN 'dropped' WHEN team = 'Unmanaged' THEN 'unmanaged'
            ELSE 'matched' END AS outcome
        FROM v_classified""",
    # -- freeze ------------------------------------------------------------------------------------
    "v_fresh": "SELECT * FROM v_snapshot WHERE qtr = 4",
    "v_store": """
        SELECT * FROM v_snapshot
        WHERE (qtr = 4 AND fweek NOT IN (44, 45) AND CAST(account_id AS BIGINT) % 5 <> 0)
           OR (qtr = 3 AND CAST(account_id AS BIGINT) % 2 = 0)""",
    "v_frozen": """
        SELECT * FROM v_store WHERE qtr = 4 AND fweek < 46
        UNION ALL
        SELECT * FROM v_fresh WHERE fweek < 46
            AND fweek NOT IN (SELECT fweek FROM v_store WHERE qtr = 4)
        UNION ALL
        SELECT * FROM v_fresh WHERE fweek >= 46""",
    # -- grid state --------------------------------------------------------------------------------
    "v_grid": """
        SELECT section, table_type, team AS label, fy, qtr,
            CASE WHEN week <> 53 THEN week END AS week, forecast AS value,
            CASE WHEN week <= 42 THEN 'actual' ELSE 'forecast' END AS state,
            team = 'MACHINERY' AS is_manual
        FROM v_forecast, (VALUES ('Sales', 'SALES'), ('Upgrades', 'ADV_UPGRADES'))
            AS s(section, table_type)
        WHERE fy = 2000 AND qtr = 4 AND week IS NOT NULL""",
    "v_now": f"""
        SELECT fy, qtr, week FROM v_weeks WHERE week_start_date <= {AS_OF}
        ORDER BY CASE WHEN week_end_date >= {AS_OF} THEN 0 ELSE 1 END, week_start_date DESC
        LIMIT 1""",
    "v_caps": """
        SELECT DISTINCT w.fy, w.qtr,
            CAST(CASE WHEN n.fy * 10 + n.qtr > w.fy * 10 + w.qtr THEN 9999
                 WHEN n.fy * 10 + n.qtr < w.fy * 10 + w.qtr THEN -1 ELSE n.week END AS INTEGER)
                AS cap, TRUE AS reliable
        FROM v_weeks w, v_now n""",
    "v_resolved": """
        SELECT section, table_type, label, fy, qtr, week,
            CASE WHEN touch = 'count' THEN CAST(n AS DOUBLE) ELSE value END AS value,
            CASE WHEN touch = 'count' THEN 'actual' WHEN touch = 'future' THEN 'forecast'
                ELSE state END AS state,
            is_manual, touch = 'count' AND state = 'forecast' AS changed,
            touch IN ('none', 'count') AS resolved
        FROM (SELECT g.*, coalesce(c.n, 0) AS n,
                CASE WHEN g.week IS NULL OR g.is_manual THEN 'none'
                     WHEN g.week > 46 THEN 'future'
                     WHEN g.state = 'forecast' AND coalesce(c.n, 0) = 0
                          AND g.table_type <> 'ADV_UPGRADES' THEN 'wait'
                     ELSE 'count' END AS touch
              FROM v_grid g LEFT JOIN v_teams c ON c.fy = g.fy AND c.qtr = g.qtr
                AND c.fweek = g.week AND c.team = g.label AND c.table_type = g.table_type)""",
    # -- sales base and summary --------------------------------------------------------------------
    "v_motion": f"""
        SELECT b.*, a.parent_id AS parent_company_id, CAST(b.offer_key AS VARCHAR) AS offer_id,
            o.signup_category, o.promotion, o.use, {fy('b.event_date')} AS fy,
            {qtr('b.event_date')} AS qtr, {week('b.event_date')} AS week,
            {week_age('b.event_date')} AS week_age,
            CASE WHEN b.division_name = 'NATIONALS'
                      AND CAST(b.offer_key AS VARCHAR) IN ('3', '11', '19', '27', '35', '43')
                 THEN 'Agent Added'
                 WHEN b.division_name = 'NATIONALS' AND CAST(b.offer_key AS VARCHAR)
                      NOT IN ('3', '11', '19', '27', '35', '43') THEN 'Runrate'
                 WHEN b.division_name <> 'NATIONALS' AND o.signup_category <> 'AGENT' THEN 'Runrate'
                 ELSE 'Agent Added' END AS motion
        FROM v_bookings b JOIN v_accounts a ON b.account_id = a.company_id
        JOIN v_accounts p ON a.parent_id = p.id
        JOIN part pp ON b.offer_key = pp.p_partkey
        LEFT JOIN v_offers o ON CAST(b.offer_key AS VARCHAR) = o.offer_id""",
    "v_base": """
        SELECT *, division_l3 AS team,
            CASE WHEN product = 'PROMO' THEN 1 ELSE 0 END AS advanced_flag,
            CASE WHEN product_family = 'Brand#3' THEN 1 ELSE 0 END AS core_flag
        FROM v_motion
        WHERE event_type = 'new' AND super_channel = 'DIRECT' AND fy = 2000 AND week_age > 0
          AND division_l4 IN ('L4_0', 'L4_1', 'L4_2')""",
    "v_sales": """
        SELECT *, CASE WHEN product_family IN ('Brand#7', 'Brand#9') THEN 1 ELSE 0 END AS payroll_flag
        FROM v_base WHERE qtr = 4""",
    "v_recent": """
        SELECT *, CASE WHEN product_family = 'Brand#7' THEN 1 ELSE 0 END AS payroll_flag
        FROM v_base WHERE week_age BETWEEN 1 AND 13""",
    "v_runrate": " UNION ALL ".join(
        f"""SELECT team, '{name}' AS rr_type,
            count(DISTINCT CASE WHEN motion = 'Runrate' THEN account_id END) AS rr_sales,
            count(DISTINCT account_id) AS total_sales
            FROM v_recent WHERE {flag} = 1 GROUP BY team"""
        for name, flag in (("Core", "core_flag"), ("Advanced", "advanced_flag"),
                           ("Payroll", "payroll_flag"))),
    "v_pipeline": f"""
        SELECT DISTINCT o.id, o.account_id, p.company_id AS parent_company_id, o.stage, o.amount,
            o.probability, o.close_date, o.isclosed, o.iswon, o.created_date, a.agent_id,
            a.division_l3 AS team,
            CASE WHEN o.stage IN ('Closed Won', 'Closed Lost') THEN 'Closed' ELSE 'Open' END
                AS opp_status,
            CASE WHEN date_diff('day', o.created_date, {AS_OF}) BETWEEN 0 AND 60 THEN 'Y' ELSE 'N'
                END AS created_0_60_flag,
            l.quantity, l.total, cc.fy AS close_fy, cc.qtr AS close_qtr,
            cc.fiscal_year_age AS close_year_age,
            CASE WHEN regexp_matches(l.price_name, 'widget|ring') THEN 'Advanced'
                 WHEN l.price_name LIKE 'red %' THEN 'Payroll'
                 WHEN l.price_name IS NULL THEN 'No Product Line'
                 WHEN l.price_name LIKE '%gear' THEN 'Hardware' ELSE 'Core' END AS product_group,
            CASE WHEN o.stage IN ('Commit', 'Value') THEN 1 ELSE 0 END AS latestage_flag
        FROM v_opps o
        JOIN v_users u ON o.owner_id = u.id
        JOIN v_accounts c ON o.account_id = c.company_id
        JOIN v_accounts p ON c.parent_id = p.id
        JOIN v_place cc ON o.close_date = cc.date
        JOIN v_place dd ON o.created_date = dd.date
        LEFT JOIN v_lines l ON o.id = l.opp_id
        JOIN v_agents a ON TRY_CAST(u.federation_id AS BIGINT) = a.agent_id
          AND o.close_date BETWEEN a.rec_start AND a.rec_end
        WHERE dd.fiscal_year_age IN (0, 1) AND a.division_l4 IN ('L4_0', 'L4_1', 'L4_2')
          AND (l.isdeleted = FALSE OR l.isdeleted IS NULL)
          AND lower(l.price_name) NOT LIKE '%cold%'""",
    "v_conv": f"""
        SELECT team, CAST(sum(CASE WHEN iswon THEN 1 ELSE 0 END) AS DOUBLE)
            / greatest(sum(CASE WHEN isclosed THEN 1 ELSE 0 END), 1) AS opp_conv_rate
        FROM v_pipeline WHERE close_date >= {AS_OF} - 60 GROUP BY team""",
    "v_measures": """
        WITH s AS (SELECT team, count(DISTINCT account_id) AS qtd_sales,
                    count(DISTINCT CASE WHEN motion = 'Runrate' THEN account_id END)
                        AS qtd_runrate_sales FROM v_sales GROUP BY team),
             f AS (SELECT team, coalesce(sum(forecast) FILTER (week <= 46), 0) AS qtd_forecast,
                    sum(forecast) AS total_finance_fcst
                   FROM v_forecast WHERE fy = 2000 AND qtr = 4 GROUP BY team),
             r AS (SELECT team, rr_sales / 13.0::DOUBLE AS avg_weekly_rr,
                    CAST(rr_sales AS DOUBLE) / nullif(total_sales, 0) AS rr_rate
                   FROM v_runrate WHERE rr_type = 'Core'),
             o AS (SELECT team, count(DISTINCT id) AS qtg_open_opps FROM v_pipeline
                   WHERE opp_status = 'Open' GROUP BY team),
             t AS (SELECT team FROM s UNION SELECT team FROM f UNION SELECT team FROM r
                   UNION SELECT team FROM o UNION SELECT team FROM v_conv)
        SELECT t.team, CAST(coalesce(qtd_sales, 0) AS DOUBLE) AS qtd_sales,
            CAST(coalesce(qtd_runrate_sales, 0) AS DOUBLE) AS qtd_runrate_sales,
            CAST(coalesce(qtd_forecast, 0) AS DOUBLE) AS qtd_forecast,
            CAST(coalesce(total_finance_fcst, 0) AS DOUBLE) AS total_finance_fcst,
            CAST(coalesce(avg_weekly_rr, 0) AS DOUBLE) AS avg_weekly_rr,
            CAST(coalesce(rr_rate, 0) AS DOUBLE) AS rr_rate,
            CAST(coalesce(opp_conv_rate, 0) AS DOUBLE) AS opp_conv_rate,
            CAST(coalesce(qtg_open_opps, 0) AS DOUBLE) AS qtg_open_opps
        FROM t LEFT JOIN s USING (team) LEFT JOIN f USING (team) LEFT JOIN r USING (team)
        LEFT JOIN v_conv USING (team) LEFT JOIN o USING (team)""",
    "v_summary": f"""
        SELECT team, qtd_sales, qtd_forecast, {ratio('qtd_sales', 'qtd_forecast')} AS qtd_itf,
            qtd_runrate_sales, qtd_pipeline_sales,
            {ratio('qtd_runrate_sales', 'qtd_sales')} AS qtd_rr_pct,
            {ratio('qtd_runrate_forecast', 'qtd_forecast')} AS qtd_forecast_rr_pct,
            qtd_runrate_forecast,
            {ratio('qtd_runrate_sales', 'qtd_runrate_forecast')} AS qtd_runrate_itf,
            qtd_pipeline_forecast,
            {ratio('qtd_pipeline_sales', 'qtd_pipeline_forecast')} AS qtd_pipeline_itf,
            total_finance_fcst - qtd_sales AS qtg_sales, qtg_open_opps, opp_conv_rate,
            avg_weekly_rr, qtg_fcst_runrate, qtg_fcst_opps, qtg_fcst_sales, total_finance_fcst,
            qtd_sales + qtg_fcst_sales AS total_fcst_sales,
            qtd_sales + qtg_fcst_sales - total_finance_fcst AS fcst_gap,
            {ratio('qtd_sales + qtg_fcst_sales', 'total_finance_fcst')} AS fcst_itf
        FROM (SELECT *, qtd_forecast - qtd_runrate_forecast AS qtd_pipeline_forecast,
                qtg_fcst_runrate + qtg_fcst_opps AS qtg_fcst_sales
              FROM (SELECT *, round_even(qtd_forecast * rr_rate, 0) AS qtd_runrate_forecast,
                        qtd_sales - qtd_runrate_sales AS qtd_pipeline_sales,
                        round_even(avg_weekly_rr * (date_diff('day', {AS_OF}, DATE '2000-07-31')
                            / 7.0::DOUBLE), 0) AS qtg_fcst_runrate,
                        round_even(qtg_open_opps * opp_conv_rate, 0) AS qtg_fcst_opps
                    FROM v_measures))""",
    # -- indexes -----------------------------------------------------------------------------------
    "v_metric_cells": """
        SELECT metric, fy, qtr, team, week, sum(actual) AS actual, sum(forecast) AS forecast,
            sum(prior) AS prior
        FROM (SELECT CASE table_type WHEN 'SALES' THEN 'sales' WHEN 'ADV' THEN 'advanced'
                    WHEN 'ADV_UPGRADES' THEN 'upgrades' ELSE 'payroll' END AS metric, fy, qtr, team,
                fweek AS week, CAST(n AS DOUBLE) AS actual, NULL AS forecast, NULL AS prior
              FROM v_teams WHERE table_type IN ('SALES', 'ADV', 'ADV_UPGRADES', 'PAYROLL')
              UNION ALL
              SELECT m, fy, qtr, team, week, NULL, forecast, NULL
              FROM v_forecast, (VALUES ('sales'), ('upgrades')) AS t(m) WHERE fy = 2000
              UNION ALL
              SELECT 'sales', fy + 1, qtr, team_raw, week, NULL, NULL, CAST(count(*) AS DOUBLE)
              FROM (SELECT DISTINCT b.event_date, b.account_id, b.firm_id, b.product, b.offer_name,
                        b.team_raw, b.country, b.channel, b.super_channel, c.fy, c.qtr, c.week
                    FROM v_bookings b JOIN v_cal c ON b.event_date = c.date
                    WHERE c.fy = 1999 AND event_type = 'new' AND offering = 'CORE'
                      AND category = 'F')
              GROUP BY 2, 3, 4, 5)
        GROUP BY 1, 2, 3, 4, 5""",
    "v_metric_some": """
        SELECT metric, fy, qtr, team, week, coalesce(actual, 0) AS actual, forecast, prior
        FROM v_metric_cells
        UNION ALL
        SELECT metric, fy, qtr, 'TOTAL', week, coalesce(sum(actual), 0), sum(forecast), sum(prior)
        FROM v_metric_cells GROUP BY metric, fy, qtr, week""",
    "v_metric_total": """
        SELECT * FROM v_metric_some
        UNION ALL
        SELECT k.metric, k.fy, k.qtr, k.team, w.week, 0, NULL, NULL
        FROM (SELECT DISTINCT metric, fy, qtr, team FROM v_metric_some) k
        JOIN v_weeks w ON w.fy = k.fy AND w.qtr = k.qtr
        WHERE NOT EXISTS (SELECT 1 FROM v_metric_some s WHERE s.metric = k.metric AND s.fy = k.fy
            AND s.qtr = k.qtr AND s.team = k.team AND s.week = w.week)""",
    "v_index": f"""
        SELECT metric, fy, qtr, team, week, actual, forecast, actual - forecast AS variance,
            {index('actual', 'forecast')} AS itf, {index('actual', 'prior')} AS itpy,
            actual_qtd, forecast_qtd, actual_qtd - forecast_qtd AS variance_qtd,
            {index('actual_qtd', 'forecast_qtd')} AS itf_qtd,
            {index('actual_qtd', 'prior_qtd')} AS itpy_qtd
        FROM (SELECT *, sum(actual) OVER w AS actual_qtd, sum(forecast) OVER w AS forecast_qtd,
                sum(prior) OVER w AS prior_qtd
              FROM v_metric_total
              WINDOW w AS (PARTITION BY metric, fy, qtr, team ORDER BY week
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    "v_qtd_qtg": """
        SELECT section, label, fy, qtr,
            coalesce(sum(coalesce(value, 0)) FILTER (week <= 46), 0.0) AS qtd,
            coalesce(sum(coalesce(value, 0)) FILTER (week > 46), 0.0) AS qtg,
            sum(coalesce(value, 0)) AS quarter_total,
            coalesce(coalesce(sum(coalesce(value, 0)) FILTER (week <= 46), 0.0)
                / nullif(CAST(count(*) FILTER (week <= 46) AS DOUBLE), 0), 0.0) AS qtd_average
        FROM v_resolved WHERE week IS NOT NULL GROUP BY 1, 2, 3, 4""",
    # -- labels ------------------------------------------------------------------------------------
    "v_headers": """
        SELECT 'FY' || CAST(fy AS VARCHAR) || ' Q' || CAST(qtr AS VARCHAR) AS sheet, pos,
            CASE WHEN week % 12 = 0 THEN '' WHEN week % 7 = 0 THEN 'WK' || CAST(week AS VARCHAR)
                 WHEN week % 7 = 1 THEN 'w ' || CAST(week AS VARCHAR) || ' May 1-2'
                 WHEN week % 11 = 0 THEN 'QTD' ELSE 'W' || CAST(week AS VARCHAR) END AS label
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY fy, qtr ORDER BY week) AS INTEGER)
              AS pos FROM v_weeks)""",
    "v_texts": """
        SELECT o_orderkey AS id,
            CASE o_orderkey % 12
                WHEN 0 THEN '$' || CAST(o_orderkey % 900 + 1 AS VARCHAR) || ',020.50'
                WHEN 1 THEN CAST(o_orderkey % 130 AS VARCHAR) || '%'
                WHEN 2 THEN 'n/a' WHEN 3 THEN '' WHEN 4 THEN '12abc' WHEN 5 THEN '-'
                WHEN 6 THEN CAST(CAST(o_orderkey % 16 AS DOUBLE) / 8 AS VARCHAR)
                WHEN 7 THEN CAST(o_orderkey % 25 + 80 AS VARCHAR)
                WHEN 8 THEN '#DIV/0!' WHEN 9 THEN CAST(o_orderkey * 37 AS VARCHAR)
                WHEN 10 THEN CAST(CAST(o_orderkey % 256 AS DOUBLE) / 16 - 8 AS VARCHAR)
                END AS txt
        FROM orders""",
}


def statement(body: str) -> str:
    """The body preceded by the views it mentions, directly or through other views."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"\bv_\w+\b", text)) & VIEWS.keys():
            if name not in needed:
                needed.add(name)
                visit(VIEWS[name])

    visit(body)
    if not needed:
        return body
    ordered: list[str] = []

    def place(name: str) -> None:
        for dep in sorted(set(re.findall(r"\bv_\w+\b", VIEWS[name])) & VIEWS.keys()):
            if dep != name and dep not in ordered:
                place(dep)
        if name not in ordered:
            ordered.append(name)

    for name in sorted(needed):
        place(name)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered)
    own = re.match(r"\s*WITH\s", body)
    return f"WITH {ctes},\n{body[own.end():]}" if own else f"WITH {ctes}\n{body}"
