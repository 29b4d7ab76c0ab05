"""The catalog's queries as ANSI SQL over the same tables, written independently of the operators.

Plain joins, row numbers and subqueries are used on purpose: they state what a result means, not
how the operators compute it.
"""

from __future__ import annotations

import re


def _choose(column: str, pairs: dict) -> str:
    quote = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return f"CASE {column} " + " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in pairs.items()) + " END"


def _half_up(expression: str, digits: int) -> str:
    """Decimal half-up rounding of a double's shortest text form."""
    return f"CAST(ROUND(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


_SEGMENT = {"AUTOMOBILE": "O-", "BUILDING": "A+", "FURNITURE": "B-", "HOUSEHOLD": "O+", "MACHINERY": "AB-"}
_PRIORITY = {"1-URGENT": "O-", "2-HIGH": "AB-", "3-MEDIUM": "B-", "4-NOT SPECIFIED": "A-", "5-LOW": "O+"}
_EVENT = {"signup": "O-", "click": "AB-", "error": "B-", "purchase": "A+", "view": "O+"}
_STATUS = {"N": "Completed", "A": "Cancelled", "R": "Rejected"}
_COMPONENT = {"N": "RBC", "A": "Plasma", "R": "Platelets"}
_LINE_GROUP = {"O": "O-", "F": "A+"}
_MOVEMENT = {1: "DONATION", 2: "ISSUE", 3: "TRANSFER_IN", 4: "TRANSFER_OUT", 5: "DONATION", 6: "EXPIRY", 7: "ADJUSTMENT"}
_ELIGIBLE = {0: "Eligible", 1: "Temporarily Ineligible", 2: "Inactive", 3: "Unknown", 4: "On Leave"}
_SPELLING = {1: " pos ", 2: " Positive", 3: "+", 4: " NEG", 5: "negative", 6: " - ", 7: "POS"}
_SHELF = {"RBC": 42, "Plasma": 365, "Platelets": 5}
_SEVERITY = {"OUT_OF_STOCK": 3, "CRITICAL": 2, "LOW": 1, "AVAILABLE": 0}
_TIER_BASE = {"CRITICAL": 100, "LOW": 75, "MODERATE": 40, "GOOD": 10}
_TIER_ACTION = {
    "CRITICAL": "Urgent donor mobilization required", "LOW": "Targeted donation campaign recommended",
    "MODERATE": "Continue monitoring", "GOOD": "No immediate action required",
}
_PRIORITY_ACTION = {
    "EMERGENCY": "Urgent donor mobilization and inter-bank transfer required immediately.",
    "CRITICAL": "Initiate transfer from a nearby bank with surplus and launch a targeted donation campaign.",
    "LOW": "Schedule a targeted donation campaign within the next few days.",
    "MONITOR": "Continue monitoring; no immediate action required.",
    "HEALTHY": "No action required.",
}
_AS_OF = "DATE '2001-11-05'"
_WATCH = "('O-', 'AB-', 'B-', 'A-')"
_GROUPS = "('A+', 'A-', 'B+', 'B-', 'AB+', 'AB-', 'O+', 'O-')"
_STATUSES = "('Completed', 'Cancelled', 'Pending', 'Rejected')"


def _tier(u: str) -> str:
    return f"CASE WHEN {u} IS NULL THEN NULL WHEN {u} <= 2 THEN 'CRITICAL' WHEN {u} <= 5 THEN 'LOW' WHEN {u} <= 10 THEN 'MODERATE' ELSE 'GOOD' END"


def _out(u: str) -> str:
    return f"CASE WHEN {u} IS NULL THEN NULL WHEN {u} = 0 THEN 'OUT_OF_STOCK' WHEN {u} <= 5 THEN 'CRITICAL' WHEN {u} <= 10 THEN 'LOW' ELSE 'AVAILABLE' END"


def _strict(u: str) -> str:
    return f"CASE WHEN {u} = 0 THEN 'OUT_OF_STOCK' WHEN {u} < 5 THEN 'CRITICAL' WHEN {u} < 10 THEN 'LOW' ELSE 'AVAILABLE' END"


def _record(u: str) -> str:
    return f"CASE WHEN {u} <= 0 THEN 'CRITICAL' WHEN {u} <= 5 THEN 'LOW' WHEN {u} <= 20 THEN 'NORMAL' ELSE 'GOOD' END"


def _astray(key: str, by: str, step: int) -> str:
    return f"CASE {by} % {step} WHEN 7 THEN {key} + 1000000000 WHEN 8 THEN NULL ELSE {key} END"


# Shared building blocks; a query pulls in the ones it names, with everything they name in turn.
_BLOCKS: dict[str, str] = {
    "donors": f"""
        SELECT c_custkey AS donor_id, c_name AS full_name, CASE WHEN c_nationkey < 20 THEN 'Female' END AS gender,
               CAST(CAST(floor(abs(c_acctbal)) AS INTEGER) % 55 + 15 AS INTEGER) AS age,
               {_choose('c_mktsegment', _SEGMENT)} AS blood_group, n_name AS city, r_name AS state,
               DATE '1995-01-01' + CAST(CAST(floor(abs(c_acctbal)) AS INTEGER) % 2000 AS INTEGER) AS registration_date,
               DATE '1995-01-01' + CAST(CAST(floor(abs(c_acctbal)) AS INTEGER) % 2000 AS INTEGER)
                   + CAST(c_custkey % 400 - 20 AS INTEGER) AS last_donation_date,
               {_choose('c_nationkey % 5', _ELIGIBLE)} AS eligibility_status
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "banks": """
        SELECT s_suppkey AS blood_bank_id, s_name AS blood_bank_name, n_name AS city, r_name AS state,
               s_acctbal / 100 AS latitude, CAST(s_nationkey * 15 - 180 AS DOUBLE) AS longitude,
               CAST(floor(s_acctbal) AS INTEGER) AS storage_capacity
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "camps": """
        SELECT p_partkey AS camp_id, p_name AS camp_name, p_brand AS organizer, p_type AS city,
               DATE '1995-01-01' + p_size AS camp_date FROM part""",
    "lines": f"""
        SELECT l_orderkey, l_linenumber, {_astray('l_suppkey', 'l_partkey', 41)} AS blood_bank_id,
               CASE WHEN l_partkey % 3 <> 0 THEN l_partkey END AS camp_id, CAST(l_shipdate AS DATE) AS donation_date,
               CAST(l_quantity AS INTEGER) AS units_donated, {_choose('l_returnflag', _STATUS)} AS donation_status
        FROM lineitem""",
    "unique_lines": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY donation_date, blood_bank_id, camp_id NULLS FIRST, units_donated, donation_status) AS rn
            FROM lines) WHERE rn = 1""",
    "raw_donations": f"""
        SELECT l_orderkey * 8 + l_linenumber AS donation_id, {_astray('o_custkey', 'o_orderkey', 50)} AS donor_id, blood_bank_id, camp_id, donation_date,
               {_choose('o_orderpriority', _PRIORITY)} AS blood_group, units_donated, donation_status
        FROM lines JOIN orders ON l_orderkey = o_orderkey""",
    "donations": f"""
        SELECT l_orderkey * 8 + l_linenumber AS donation_id, {_astray('o_custkey', 'o_orderkey', 50)} AS donor_id, blood_bank_id, camp_id, donation_date,
               {_choose('o_orderpriority', _PRIORITY)} AS blood_group, units_donated, donation_status
        FROM unique_lines JOIN orders ON l_orderkey = o_orderkey""",
    "completed": "SELECT * FROM donations WHERE donation_status = 'Completed'",
    "inventory": f"""
        SELECT *, blood_bank_id || '-' || blood_group AS inventory_id, {_record('available_units')} AS inventory_status
        FROM (SELECT CASE l_suppkey WHEN 2 THEN 1000000002 ELSE l_suppkey END AS blood_bank_id, blood_group,
                     CAST(CASE WHEN blood_group NOT IN ('AB-', 'B-', 'A-') THEN CAST(sum(l_quantity) AS BIGINT) % 17
                               WHEN l_suppkey = 1 THEN {_choose('blood_group', {"AB-": 4, "B-": 8, "A-": 0})} ELSE 0 END AS INTEGER)
                         AS available_units,
                     max(l_shipdate) AS last_updated
              FROM (SELECT *, {_choose('o_orderpriority', _PRIORITY)} AS blood_group FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
              GROUP BY l_suppkey, blood_group)""",
    "watch_stock": f"""
        SELECT i.*, b.blood_bank_name, b.city, b.state, b.latitude, b.longitude, b.storage_capacity
        FROM inventory i LEFT JOIN banks b USING (blood_bank_id) WHERE i.blood_group IN {_WATCH}""",
    "watch_summary": f"""
        SELECT blood_group, CAST(sum(available_units) AS BIGINT) AS total_available_units,
               count(DISTINCT blood_bank_id) AS number_of_blood_banks,
               count(DISTINCT CASE WHEN available_units > 0 THEN blood_bank_id END) AS number_of_banks_with_stock,
               count(DISTINCT CASE WHEN available_units = 0 THEN blood_bank_id END) AS number_of_banks_out_of_stock,
               {_half_up('sum(available_units) / count(DISTINCT blood_bank_id)', 2)} AS average_units_per_bank,
               {_out('sum(available_units)')} AS availability_status
        FROM watch_stock GROUP BY blood_group""",
    "tiers": f"""
        SELECT *, CAST(greatest({_choose('availability_status', _TIER_BASE)} - least(number_of_centers, 10), 0) AS INTEGER)
                   AS priority_score
        FROM (SELECT blood_group, CAST(sum(available_units) AS BIGINT) AS total_available_units,
                     count(DISTINCT CASE WHEN available_units > 0 THEN blood_bank_id END) AS number_of_centers,
                     sum(available_units) / nullif(count(DISTINCT CASE WHEN available_units > 0 THEN blood_bank_id END), 0)
                         AS average_units_per_center,
                     min(available_units) AS minimum_units, max(available_units) AS maximum_units,
                     {_tier('sum(available_units)')} AS availability_status
              FROM watch_stock GROUP BY blood_group)""",
    "bank_watch": """
        SELECT blood_bank_id, CAST(sum(available_units) AS BIGINT) AS rare_blood_units,
               count(DISTINCT CASE WHEN available_units > 0 THEN blood_group END) AS rare_blood_types_available
        FROM watch_stock GROUP BY blood_bank_id""",
    "bank_perf": """
        SELECT blood_bank_id, blood_bank_name, city, state,
               coalesce(n, 0) AS total_donations_received, coalesce(u, 0) AS total_units_received,
               coalesce(d, 0) AS unique_donors, coalesce(rare_blood_units, 0) AS rare_blood_units,
               coalesce(rare_blood_types_available, 0) AS rare_blood_types_available
        FROM banks LEFT JOIN (SELECT blood_bank_id, count(*) AS n, CAST(sum(units_donated) AS BIGINT) AS u,
                                     count(DISTINCT donor_id) AS d FROM completed GROUP BY 1) USING (blood_bank_id)
        LEFT JOIN bank_watch USING (blood_bank_id)""",
    "camp_perf": """
        SELECT camp_id, camp_name, city, coalesce(n, 0) AS total_donations, coalesce(u, 0) AS total_units_collected,
               coalesce(d, 0) AS unique_donors
        FROM camps LEFT JOIN (SELECT camp_id, count(*) AS n, CAST(sum(units_donated) AS BIGINT) AS u,
                                     count(DISTINCT donor_id) AS d FROM completed GROUP BY 1) USING (camp_id)""",
    "roster": f"""
        SELECT donor_id, full_name AS name, blood_group, city, coalesce(n, 0) AS total_donations,
               coalesce(u, 0) AS total_units_donated, first_donation_date, g.last_donation_date,
               blood_group IN {_WATCH} AS is_rare_blood_donor
        FROM donors LEFT JOIN (SELECT donor_id, count(*) AS n, CAST(sum(units_donated) AS BIGINT) AS u,
                                      min(donation_date) AS first_donation_date, max(donation_date) AS last_donation_date
                               FROM completed GROUP BY 1) g USING (donor_id)""",
    "daily": """
        SELECT donation_date, count(*) AS total_donations, CAST(sum(units_donated) AS BIGINT) AS total_units_donated,
               count(DISTINCT donor_id) AS unique_donors, count(DISTINCT blood_bank_id) AS active_blood_banks
        FROM completed GROUP BY donation_date""",
    "monthly": """
        SELECT CAST(year(donation_date) AS INTEGER) AS year, CAST(month(donation_date) AS INTEGER) AS month,
               monthname(donation_date) AS month_name, count(*) AS total_donations,
               CAST(sum(units_donated) AS BIGINT) AS total_units_donated, count(DISTINCT donor_id) AS unique_donors
        FROM completed GROUP BY 1, 2, 3""",
    "shares": f"""
        SELECT blood_group, n AS total_donations, u AS total_units_donated,
               {_half_up('u / (SELECT sum(units_donated) FROM completed) * 100', 2)} AS percentage_of_total
        FROM (SELECT blood_group, count(*) AS n, CAST(sum(units_donated) AS BIGINT) AS u FROM completed GROUP BY 1)""",
    "live": f"""
        SELECT event_id - CASE WHEN event_id % 3 = 1 THEN 1 ELSE 0 END AS donation_id, {_astray('user_id', 'event_id', 90)} AS donor_id,
               {_astray("TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)", 'event_id', 80)} AS blood_bank_id,
               CASE WHEN event_type <> 'view' THEN CAST(floor(value * 10) AS BIGINT) END AS camp_id,
               CASE WHEN value > 0.5 AND event_id % 4 <> 2 THEN CAST(ts AS DATE) END AS donation_date,
               {_choose('event_type', _EVENT)} AS blood_group, CAST(floor(value / 20) AS INTEGER) AS units_donated,
               CASE WHEN value < 200 THEN 'Completed' ELSE 'Deferred' END AS donation_status,
               CASE WHEN value > 0.25 AND event_id % 7 <> 3 THEN ts END AS event_time, 'live' AS source, 'blood_donation' AS event_type
        FROM events""",
    "mixed": """
        SELECT donation_id, donor_id, blood_bank_id, camp_id, donation_date, blood_group, units_donated, donation_status,
               CAST(NULL AS TIMESTAMP) AS event_time, 'historical_batch' AS source, 'blood_donation' AS event_type
        FROM raw_donations
        UNION ALL
        SELECT donation_id, donor_id, blood_bank_id, camp_id, donation_date, blood_group, units_donated, donation_status,
               event_time, source, event_type FROM live""",
    "mixed_unique": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY donation_id ORDER BY source NULLS FIRST, donor_id NULLS FIRST,
                blood_bank_id NULLS FIRST, camp_id NULLS FIRST, donation_date NULLS FIRST, blood_group NULLS FIRST,
                units_donated NULLS FIRST, donation_status NULLS FIRST, event_time NULLS FIRST) AS rn
            FROM mixed) WHERE rn = 1""",
    "codes": f"""
        SELECT donation_id,
               regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper(trim(raw_code)),
                   'POSITIVE', '+', 'g'), '\\bPOS\\b', '+', 'g'), 'NEGATIVE', '-', 'g'), '\\bNEG\\b', '-', 'g'), '\\s+', '', 'g')
                   AS blood_group,
               CASE WHEN upper(trim(raw_status)) IN ('COMPLETED', 'COMPLETE', 'SUCCESSFUL', 'SUCCESS') THEN 'Completed'
                    WHEN upper(trim(raw_status)) IN ('CANCELLED', 'CANCELED') THEN 'Cancelled'
                    WHEN upper(trim(raw_status)) = 'PENDING' THEN 'Pending'
                    WHEN upper(trim(raw_status)) = 'REJECTED' THEN 'Rejected'
                    WHEN upper(trim(raw_status)) = 'ON HOLD' THEN 'On Hold' END AS donation_status,
               coalesce(nullif(trim(raw_note), ''), 'Unknown') AS note
        FROM (SELECT l_orderkey * 8 + l_linenumber AS donation_id,
                     ' ' || lower(l_returnflag) || {_choose('l_linenumber', _SPELLING)} AS raw_code,
                     CASE WHEN l_linestatus = 'O' THEN lower({_choose('l_returnflag', _STATUS)})
                          WHEN l_tax > 0.01 THEN '  SUCCESS ' ELSE 'on HOLD' END AS raw_status,
                     CASE WHEN l_discount > 0.05 THEN ' line ' || l_linenumber || ' ' WHEN l_discount > 0.01 THEN '  ' END AS raw_note
              FROM lineitem)""",
    "ledger": f"""
        SELECT l_orderkey * 8 + l_linenumber AS transaction_id, l_suppkey AS blood_bank_id,
               {_choose('l_linestatus', _LINE_GROUP)} AS blood_group, {_choose('l_returnflag', _COMPONENT)} AS component_type,
               {_choose('l_linenumber', _MOVEMENT)} AS transaction_type,
               CAST(ceil(l_quantity / 10) - CASE WHEN l_linenumber = 7 THEN 3 ELSE 0 END AS DOUBLE) AS units,
               l_shipdate AS transaction_timestamp, l_orderkey, l_partkey
        FROM lineitem""",
    "signed": """
        SELECT *, CASE WHEN transaction_type IN ('DONATION', 'TRANSFER_IN', 'ADJUSTMENT') THEN units ELSE -units END AS delta
        FROM ledger""",
    "balances": """
        SELECT blood_bank_id, blood_group, component_type, CAST(round(sum(delta)) AS BIGINT) AS available_units,
               max(transaction_timestamp) AS last_updated,
               max(CASE WHEN transaction_type = 'DONATION' THEN transaction_timestamp END) AS last_donation_at,
               sum(CASE WHEN transaction_type = 'EXPIRY' THEN units ELSE 0 END) AS lifetime_expired_units
        FROM signed GROUP BY 1, 2, 3""",
    "aged": f"""
        SELECT *, CASE WHEN last_donation_at IS NULL THEN 'VALID' WHEN days_left <= 0 THEN 'EXPIRED'
                       WHEN days_left <= 3 THEN 'EXPIRING_SOON' ELSE 'VALID' END AS expiry_status
        FROM (SELECT *, {_choose('component_type', _SHELF)}
                        - date_diff('day', CAST(last_donation_at AS DATE), {_AS_OF}) AS days_left FROM balances)""",
    "issue_window": """
        SELECT CAST(greatest(1, date_diff('second', min(transaction_timestamp), max(transaction_timestamp)) // 86400 + 1)
                    AS INTEGER) AS days
        FROM ledger WHERE transaction_type = 'ISSUE'""",
    "demand": f"""
        SELECT *, {_half_up('average_daily_demand * 7', 2)} AS average_weekly_demand,
               {_half_up('average_daily_demand * 30', 2)} AS average_monthly_demand
        FROM (SELECT blood_bank_id, blood_group, component_type, sum(units) AS total_units_issued,
                     count(*) AS issue_event_count, any_value(days) AS observation_window_days,
                     {_half_up('sum(units) / any_value(days)', 3)} AS average_daily_demand
              FROM ledger, issue_window WHERE transaction_type = 'ISSUE' GROUP BY 1, 2, 3)""",
    "covered": f"""
        SELECT a.*, coalesce(average_daily_demand, 0) AS daily, average_weekly_demand, average_monthly_demand,
               CASE WHEN coalesce(average_daily_demand, 0) > 0
                    THEN {_half_up('available_units / greatest(average_daily_demand, 0.1)', 1)} END AS coverage_days
        FROM aged a LEFT JOIN demand USING (blood_bank_id, blood_group, component_type)""",
    "trend": """
        SELECT *, CASE WHEN recent_donation_units = 0 THEN 100 WHEN prior_donation_units = 0 THEN 50
                       WHEN recent_donation_units / prior_donation_units >= 1 THEN 0
                       WHEN recent_donation_units / prior_donation_units >= 0.5 THEN 30 ELSE 70 END AS donation_trend_sub_score
        FROM (SELECT blood_bank_id, blood_group, component_type,
                     coalesce(sum(CASE WHEN transaction_timestamp >= t.latest - INTERVAL 30 DAY THEN d END), 0)
                         AS recent_donation_units,
                     coalesce(sum(CASE WHEN transaction_timestamp < t.latest - INTERVAL 30 DAY
                                        AND transaction_timestamp >= t.latest - INTERVAL 60 DAY THEN d END), 0)
                         AS prior_donation_units
              FROM (SELECT *, CASE WHEN transaction_type = 'DONATION' THEN units END AS d FROM ledger),
                   (SELECT max(transaction_timestamp) AS latest FROM ledger) t
              GROUP BY 1, 2, 3)""",
    "scored": """
        SELECT c.*, donation_trend_sub_score,
               CASE WHEN available_units = 0 THEN 100 WHEN available_units <= 5 THEN 90 WHEN available_units <= 10 THEN 60
                    WHEN available_units <= 20 THEN 30 ELSE 10 END AS inventory_level_sub_score,
               CASE WHEN NOT daily > 0 THEN 50 WHEN coverage_days < 1 THEN 100 WHEN coverage_days < 3 THEN 70
                    WHEN coverage_days < 7 THEN 35 ELSE 10 END AS coverage_sub_score,
               CASE expiry_status WHEN 'EXPIRED' THEN 100 WHEN 'EXPIRING_SOON' THEN 60 ELSE 0 END AS expiry_sub_score
        FROM covered c JOIN trend USING (blood_bank_id, blood_group, component_type)""",
    "state": f"""
        SELECT *, {_choose('priority_level', _PRIORITY_ACTION)} AS recommended_action
        FROM (SELECT *, CASE WHEN shortage_score <= 20 THEN 'HEALTHY' WHEN shortage_score <= 40 THEN 'MONITOR'
                             WHEN shortage_score <= 60 THEN 'LOW' WHEN shortage_score <= 80 THEN 'CRITICAL'
                             ELSE 'EMERGENCY' END AS priority_level
              FROM (SELECT blood_bank_id, blood_group, component_type, available_units, expiry_status,
                           lifetime_expired_units, daily > 0 AS has_demand_data, daily AS average_daily_demand,
                           average_weekly_demand, average_monthly_demand, coverage_days, inventory_level_sub_score,
                           coverage_sub_score, expiry_sub_score, donation_trend_sub_score,
                           CAST(greatest(0, least(100, round(
                               inventory_level_sub_score * CAST(0.40 AS DOUBLE) + coverage_sub_score * CAST(0.30 AS DOUBLE)
                               + expiry_sub_score * CAST(0.15 AS DOUBLE) + donation_trend_sub_score * CAST(0.15 AS DOUBLE))))
                               AS INTEGER) AS shortage_score, last_updated
                    FROM scored))""",
    "moves": f"""
        SELECT l_orderkey * 8 + l_linenumber AS transfer_id, l_suppkey AS source_bank_id, l_partkey AS destination_bank_id,
               {_choose('l_linestatus', _LINE_GROUP)} AS blood_group, {_choose('l_returnflag', _COMPONENT)} AS component_type,
               l_quantity - 2 AS units, CAST(l_shipdate AS DATE) AS transfer_date, 'COMPLETED' AS status
        FROM lineitem""",
    "checked_moves": """
        SELECT *, units > 0 AND source_bank_id <> destination_bank_id
                  AND source_bank_id IN (SELECT s_suppkey FROM supplier)
                  AND destination_bank_id IN (SELECT s_suppkey FROM supplier) AS is_valid
        FROM moves""",
    "pairs": """
        SELECT *, CASE WHEN in_legs = 0 THEN 'MISSING_IN' WHEN out_legs = 0 THEN 'MISSING_OUT'
                       WHEN in_legs > 1 OR out_legs > 1 THEN 'REPEATED_LEG'
                       WHEN units_out = units_in THEN 'PAIRED' ELSE 'UNEQUAL_UNITS' END AS pair_status
        FROM (SELECT l_orderkey AS transfer_id, count(*) FILTER (transaction_type = 'TRANSFER_OUT') AS out_legs,
                     count(*) FILTER (transaction_type = 'TRANSFER_IN') AS in_legs,
                     sum(units) FILTER (transaction_type = 'TRANSFER_OUT') AS units_out,
                     sum(units) FILTER (transaction_type = 'TRANSFER_IN') AS units_in
              FROM ledger WHERE transaction_type IN ('TRANSFER_OUT', 'TRANSFER_IN') GROUP BY 1)""",
    "reconciled": """
        SELECT blood_bank_id, blood_group, component_type, greatest(p.available_units, 0) AS available_units,
               p.available_units AS recomputed_units,
               CASE WHEN p.available_units >= 0 THEN 'MATCH' ELSE 'MISMATCH' END AS reconciliation_status
        FROM balances p""",
    "flagged": f"""
        SELECT *, blood_group IN {_GROUPS} AS is_valid_blood_group,
               units_donated IS NOT NULL AND coalesce(units_donated BETWEEN 1 AND 5, false) AS is_valid_donation_quantity,
               donation_date IS NOT NULL AND coalesce(donation_date <= {_AS_OF}, false) AS is_valid_donation_date,
               donation_status IN {_STATUSES} AS is_valid_donation_status, blood_group IN {_WATCH} AS is_rare_blood,
               CASE WHEN blood_group IN {_GROUPS} AND units_donated BETWEEN 1 AND 5 AND donation_date <= {_AS_OF}
                         AND donation_status IN {_STATUSES} THEN 'VALID' ELSE 'REVIEW' END AS overall_data_quality_status
        FROM @facts@""",
    "wide": """
        SELECT f.*, d.full_name AS donor_name, d.age AS donor_age, d.gender AS donor_gender, d.city AS donor_city,
               d.blood_group AS donor_blood_group, d.eligibility_status AS donor_eligibility_status,
               b.blood_bank_name, b.city AS blood_bank_city, b.state AS blood_bank_state, b.latitude, b.longitude,
               b.storage_capacity, c.camp_name, c.city AS camp_city, c.organizer, c.camp_date,
               i.available_units AS current_available_units, i.last_updated AS inventory_last_updated,
               d.donor_id IS NOT NULL AS donor_exists, b.blood_bank_id IS NOT NULL AS blood_bank_exists,
               i.blood_bank_id IS NOT NULL AS inventory_record_exists,
               CASE WHEN f.camp_id IS NOT NULL THEN c.camp_id IS NOT NULL END AS camp_exists,
               CASE WHEN d.blood_group IS NOT NULL THEN f.blood_group = d.blood_group END AS blood_group_match
        FROM @facts@ f LEFT JOIN donors d ON f.donor_id = d.donor_id LEFT JOIN banks b ON f.blood_bank_id = b.blood_bank_id
        LEFT JOIN camps c ON f.camp_id = c.camp_id
        LEFT JOIN inventory i ON f.blood_bank_id = i.blood_bank_id AND f.blood_group = i.blood_group""",
    "ledger_checks": f"""
        SELECT 'ledger' AS section, 'movements' AS check_name, true AS positive, count(*) AS value FROM ledger
        UNION ALL SELECT 'ledger', 'unknown_types', NULL, count(*) FILTER (transaction_type IS NULL) FROM ledger
        UNION ALL SELECT 'ledger', 'types_never_used', NULL, 6 - count(DISTINCT transaction_type) FROM ledger
        UNION ALL SELECT 'ledger', 'non_positive_units', NULL,
                         count(*) FILTER (transaction_type <> 'ADJUSTMENT' AND NOT units > 0) FROM ledger
        UNION ALL SELECT 'ledger', 'unknown_components', NULL, count(*) FILTER (component_type IS NULL) FROM ledger
        UNION ALL SELECT 'ledger', 'keys_without_state', NULL, count(*) FROM (
            SELECT blood_bank_id, blood_group, component_type FROM ledger
            EXCEPT SELECT blood_bank_id, blood_group, component_type FROM state)
        UNION ALL SELECT 'reconciliation', 'mismatched_keys', NULL, count(*) FROM state JOIN balances
            USING (blood_bank_id, blood_group, component_type) WHERE state.available_units <> balances.available_units
        UNION ALL SELECT 'reconciliation', 'keys_not_published', NULL, 0
        UNION ALL SELECT 'reconciliation', 'keys_not_in_ledger', NULL, 0
        UNION ALL SELECT 'reconciliation', 'negative_balances', NULL, count(*) FILTER (available_units < 0) FROM state
        UNION ALL SELECT 'stock_state', 'score_out_of_range', NULL, count(*) FILTER (NOT shortage_score BETWEEN 0 AND 100) FROM state
        UNION ALL SELECT 'stock_state', 'band_disagrees', NULL, 0
        UNION ALL SELECT 'stock_state', 'coverage_without_demand', NULL,
                         count(*) FILTER ((coverage_days IS NOT NULL) <> has_demand_data) FROM state
        UNION ALL SELECT 'stock_state', 'no_action', NULL, count(*) FILTER (recommended_action IS NULL) FROM state
        UNION ALL SELECT 'stock_state', 'unknown_expiry', NULL,
                         count(*) FILTER (expiry_status NOT IN ('VALID', 'EXPIRING_SOON', 'EXPIRED')) FROM state
        UNION ALL SELECT 'stock_state', 'unknown_priority', NULL, count(*) FILTER (priority_level NOT IN
                         ('EMERGENCY', 'CRITICAL', 'LOW', 'MONITOR', 'HEALTHY')) FROM state
        UNION ALL SELECT 'stock_state', 'negative_demand', NULL, count(*) FILTER (average_daily_demand < 0) FROM state
        UNION ALL SELECT 'stock_state', 'negative_expired', NULL, count(*) FILTER (lifetime_expired_units < 0) FROM state
        UNION ALL SELECT 'stock_state', 'watch_groups_absent', NULL,
                         4 - count(DISTINCT CASE WHEN blood_group IN {_WATCH} THEN blood_group END) FROM state
        UNION ALL SELECT 'transfer_legs', 'transfers', false, count(*) FROM pairs
        UNION ALL SELECT 'transfer_legs', 'missing_in', NULL, count(*) FILTER (pair_status = 'MISSING_IN') FROM pairs
        UNION ALL SELECT 'transfer_legs', 'missing_out', NULL, count(*) FILTER (pair_status = 'MISSING_OUT') FROM pairs
        UNION ALL SELECT 'transfer_legs', 'repeated_leg', NULL, count(*) FILTER (pair_status = 'REPEATED_LEG') FROM pairs
        UNION ALL SELECT 'transfer_legs', 'unequal_units', NULL, count(*) FILTER (pair_status = 'UNEQUAL_UNITS') FROM pairs
        UNION ALL SELECT 'transfers', 'valid_to_itself', NULL,
                         count(*) FILTER (is_valid AND source_bank_id = destination_bank_id) FROM checked_moves
        UNION ALL SELECT 'transfers', 'valid_without_units', NULL, count(*) FILTER (is_valid AND NOT units > 0) FROM checked_moves""",
    "donor_counters": f"""
        SELECT count(*) FILTER (NOT coalesce(age BETWEEN 18 AND 65, false)) AS age_out_of_range,
               count(*) FILTER (eligibility_status NOT IN ('Eligible', 'Temporarily Ineligible', 'Inactive', 'Unknown'))
                   AS unknown_eligibility,
               count(*) FILTER (NOT coalesce(blood_group IN {_GROUPS}, false)) AS invalid_group,
               count(*) FILTER (last_donation_date < registration_date) AS donated_before_registration
        FROM donors""",
    "graded": """
        SELECT section, check_name, CASE WHEN positive AND value > 0 THEN 'PASS' WHEN positive = false THEN 'PASS'
                                         WHEN positive IS NULL AND value = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
               CAST(value AS BIGINT) AS value, CAST(NULL AS VARCHAR) AS detail
        FROM @checks@""",
}
# Ids of files are texts, and so is their order.
_BLOCKS["filed_unique"] = re.sub(r"\b(donor_id|blood_bank_id|camp_id) NULLS FIRST", r"CAST(\1 AS VARCHAR) NULLS FIRST", _BLOCKS["mixed_unique"])
_BLOCKS["arrived"] = _BLOCKS["live"].replace("SELECT ", "SELECT event_id, ts, event_id % 3 = 1 AS repeated, ", 1)


def _sql(select: str, **variables: str) -> str:
    """A query with the building blocks it needs in front, each defined before it is used."""
    ordered: list[str] = []

    def fill(text: str) -> str:
        for name, value in variables.items():
            text = text.replace(f"@{name}@", value)
        return text

    def need(text: str) -> None:
        for name in _BLOCKS:
            if name not in ordered and re.search(rf"\b(FROM|JOIN)\s+{name}\b|,\s*{name}\b(?=\s+(WHERE|GROUP))", text):
                need(fill(_BLOCKS[name]))
                if name not in ordered:
                    ordered.append(name)

    body = fill(select)
    need(body)
    if not ordered:
        return body.strip()
    return "WITH " + ",\n".join(f"{name} AS ({fill(_BLOCKS[name])})" for name in ordered) + "\n" + body.strip()


def _counter_rows(section: str, source: str, rules: dict[str, str]) -> str:
    """One-row counters as check rows."""
    test = {"zero": "{c} = 0", "positive": "{c} > 0", "report": "true"}
    parts = [
        f"SELECT '{section}' AS section, '{c}' AS check_name, CASE WHEN {test[r].format(c=c)} THEN 'PASS' ELSE 'FAIL' END"
        f" AS status, CAST({c} AS BIGINT) AS value, CAST(NULL AS VARCHAR) AS detail FROM {source}"
        for c, r in rules.items()
    ]
    return " UNION ALL ".join(parts)


_STATE = (
    "blood_bank_id, blood_group, component_type, available_units, expiry_status, lifetime_expired_units, has_demand_data, "
    "average_daily_demand, average_weekly_demand, average_monthly_demand, coverage_days, inventory_level_sub_score, "
    "coverage_sub_score, expiry_sub_score, donation_trend_sub_score, shortage_score, priority_level, recommended_action, "
    "last_updated"
)
_KEY = "blood_bank_id, blood_group, component_type"
_BANK_STOCK = (
    f"SELECT blood_bank_id, blood_bank_name, city, state, blood_group, available_units, {_out('available_units')} AS "
    "availability_status, latitude, longitude, last_updated FROM watch_stock"
)
_DETAIL = (
    f"SELECT blood_bank_id, blood_bank_name, city, state, blood_group, available_units, storage_capacity, "
    f"{_out('available_units')} AS availability_status, last_updated, latitude, longitude FROM watch_stock"
)
_ALERT = """CASE availability_status WHEN 'OUT_OF_STOCK' THEN 'OUT OF STOCK: ' || blood_group || ' currently has no available units.'
    WHEN 'CRITICAL' THEN 'CRITICAL: ' || blood_group || ' has only ' || {u} || ' units available.'
    WHEN 'LOW' THEN 'LOW: ' || blood_group || ' has ' || {u} || ' units available.' END"""
_CITY = f"""SELECT city, state, blood_group, CAST(sum(available_units) AS BIGINT) AS total_available_units,
    count(DISTINCT blood_bank_id) AS number_of_blood_banks,
    count(DISTINCT CASE WHEN available_units > 0 THEN blood_bank_id END) AS banks_with_stock,
    {_out('sum(available_units)')} AS availability_status FROM watch_stock GROUP BY 1, 2, 3"""
_IN_BANKS = "IN (SELECT blood_bank_id FROM banks)"
_GIVEN = """(SELECT count(*) FILTER (units_donated IS NULL) AS null_units, count(*) FILTER (units_donated = 0) AS zero_units,
    count(*) FILTER (units_donated < 0) AS negative_units, count(*) FILTER (units_donated > 5) AS unusually_large_units
    FROM donations)"""
_FK = """(SELECT (SELECT count(*) FROM live WHERE donor_id IS NULL OR donor_id NOT IN (SELECT donor_id FROM donors)) AS donor,
    (SELECT count(*) FROM live WHERE blood_bank_id IS NULL OR blood_bank_id NOT IN (SELECT blood_bank_id FROM banks)) AS bank,
    (SELECT count(*) FROM live WHERE camp_id NOT IN (SELECT camp_id FROM camps)) AS camp,
    (SELECT count(*) FROM inventory WHERE blood_bank_id NOT IN (SELECT blood_bank_id FROM banks)) AS inventory_bank)"""
_FAULT = f"""CASE WHEN d.donor_id IS NULL THEN 'Unknown donor_id' WHEN b.blood_bank_id IS NULL THEN 'Unknown blood_bank_id'
        WHEN e.camp_id IS NOT NULL AND c.camp_id IS NULL THEN 'Unknown camp_id'
        WHEN e.blood_group IS DISTINCT FROM d.blood_group THEN 'blood_group mismatch'
        WHEN NOT coalesce(e.units_donated > 0, false) THEN 'Invalid units_donated'
        WHEN NOT coalesce(e.donation_status IN {_STATUSES}, false) THEN 'Invalid donation_status'
        WHEN e.event_time IS NULL THEN 'Missing event_time' WHEN e.donation_date IS NULL THEN 'Missing donation_date'
    END"""
_FAULT_TABLES = """FROM live e LEFT JOIN donors d ON e.donor_id = d.donor_id LEFT JOIN banks b ON e.blood_bank_id = b.blood_bank_id
    LEFT JOIN camps c ON e.camp_id = c.camp_id"""
_ADMISSION = f"""SELECT donation_id, reason IS NULL AS admitted, reason AS reject_reason FROM (
    SELECT donation_id, CASE WHEN stored OR place > min(CASE WHEN fault IS NULL THEN place END) OVER (PARTITION BY donation_id)
        THEN 'Duplicate donation_id' ELSE fault END AS reason
    FROM (SELECT e.donation_id, e.donation_id IN (SELECT l_orderkey * 8 + l_linenumber FROM lineitem) AS stored,
        row_number() OVER (PARTITION BY e.donation_id ORDER BY e.event_time NULLS FIRST, e.donor_id NULLS FIRST,
            e.blood_bank_id NULLS FIRST, e.camp_id NULLS FIRST, e.donation_date NULLS FIRST, e.blood_group NULLS FIRST,
            e.units_donated NULLS FIRST, e.donation_status NULLS FIRST) AS place,
        {_FAULT} AS fault
    {_FAULT_TABLES}))"""
_REJECTED = f"""SELECT donation_id, reason AS reject_reason, CASE reason WHEN 'Duplicate donation_id' THEN CAST(donation_id AS VARCHAR)
        WHEN 'Unknown donor_id' THEN CAST(donor_id AS VARCHAR) WHEN 'Unknown blood_bank_id' THEN CAST(blood_bank_id AS VARCHAR)
        WHEN 'Unknown camp_id' THEN CAST(camp_id AS VARCHAR)
        WHEN 'blood_group mismatch' THEN coalesce(blood_group, 'none') || ' against ' || coalesce(donor_group, 'none')
        WHEN 'Invalid units_donated' THEN CAST(units_donated AS VARCHAR) WHEN 'Invalid donation_status' THEN donation_status END AS rejected_value
    FROM (SELECT *, CASE WHEN stored OR place > min(CASE WHEN fault IS NULL THEN place END) OVER (PARTITION BY donation_id)
        THEN 'Duplicate donation_id' ELSE fault END AS reason
    FROM (SELECT e.*, d.blood_group AS donor_group, e.donation_id IN (SELECT l_orderkey * 8 + l_linenumber FROM lineitem) AS stored,
        row_number() OVER (PARTITION BY e.donation_id ORDER BY e.event_time NULLS FIRST, e.donor_id NULLS FIRST,
            e.blood_bank_id NULLS FIRST, e.camp_id NULLS FIRST, e.donation_date NULLS FIRST, e.blood_group NULLS FIRST,
            e.units_donated NULLS FIRST, e.donation_status NULLS FIRST) AS place,
        {_FAULT} AS fault
    {_FAULT_TABLES})) WHERE reason IS NOT NULL"""
# Two arrivals: an id that the first one admitted is a duplicate in the second, whatever else is wrong.
_STREAMED = f"""SELECT donation_id, reason IS NULL AS admitted, reason AS reject_reason FROM (
    SELECT donation_id, CASE WHEN repeated AND bool_or(NOT repeated AND fault IS NULL) OVER (PARTITION BY donation_id)
        THEN 'Duplicate donation_id' ELSE fault END AS reason
    FROM (SELECT e.donation_id, e.repeated, {_FAULT} AS fault {_FAULT_TABLES.replace('live', 'arrived')}))"""
_POSTED = f"transaction_id, {_KEY}, transaction_type, units, transaction_timestamp"
_MATRIX = {"A+": "a_pos", "A-": "a_neg", "B+": "b_pos", "B-": "b_neg", "AB+": "ab_pos", "AB-": "ab_neg", "O+": "o_pos", "O-": "o_neg"}
_CLOCKED = "(SELECT *, event_time + to_seconds(donation_id % 13) AS _ingested_at FROM live)"
_ROLLUP = """SELECT coalesce(section, 'OVERALL') AS section, CASE WHEN count(*) FILTER (status = 'FAIL') > 0 THEN 'FAIL'
        WHEN count(*) FILTER (status <> 'SKIPPED') = 0 THEN 'SKIPPED' ELSE 'PASS' END AS status,
        count(*) AS checks, count(*) FILTER (status = 'FAIL') AS failures,
        coalesce(string_agg(CASE WHEN status = 'FAIL' THEN check_name END, ', ' ORDER BY check_name), '') AS failed_checks
    FROM (SELECT * FROM graded UNION ALL {donors}) GROUP BY ROLLUP (section)"""
_DONOR_RULES = _counter_rows("donors", "donor_counters", dict.fromkeys(
    ["age_out_of_range", "unknown_eligibility", "invalid_group", "donated_before_registration"], "zero"))
_WATERMARKED = """(SELECT *, CASE WHEN second THEN (SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL 1 DAY FROM halves WHERE NOT second) END AS low_water
    FROM halves WHERE event_time IS NOT NULL)"""
_HALVES = """SELECT *, event_id > (SELECT max(event_id) // 2 FROM events) {astray} AS second FROM arrived"""


def _halved(select: str, astray: bool) -> str:
    """A query over ``halves``: live events and whether they come with the second arrival."""
    return _sql(select.replace("@marked@", _WATERMARKED).replace("FROM halves", "FROM (" + _HALVES.format(astray="OR event_id % 10 = 4" if astray else "") + ") halves"))


def _final(time: str, astray: bool) -> str:
    """A window that the last watermark has closed."""
    return f"{time} <= (SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL 1 DAY FROM halves)"


_SIX_HOURS = "time_bucket(INTERVAL 6 HOURS, event_time, TIMESTAMP '1970-01-01')"

_METRICS = """SELECT (SELECT count(*) FROM lineitem) AS historical_donations,
        (SELECT count(*) FROM events) AS streaming_donations,
        (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM events) AS combined_donations,
        (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM events) - (SELECT count(*) FROM mixed_unique)
            AS duplicates_removed,
        valid_donations, records_requiring_review, rare_blood_donations, missing_donor_matches,
        missing_blood_bank_matches, missing_inventory_matches
        FROM (SELECT count(*) FILTER (q.overall_data_quality_status = 'VALID') AS valid_donations,
                     count(*) FILTER (q.overall_data_quality_status = 'REVIEW') AS records_requiring_review,
                     count(*) FILTER (q.is_rare_blood) AS rare_blood_donations FROM flagged q),
             (SELECT count(*) FILTER (NOT donor_exists) AS missing_donor_matches,
                     count(*) FILTER (NOT blood_bank_exists) AS missing_blood_bank_matches,
                     count(*) FILTER (NOT inventory_record_exists) AS missing_inventory_matches FROM wide)"""
_RAW = {"donors": "donors", "blood_banks": "banks", "blood_inventory": "inventory", "donation_camps": "camps", "donations": "raw_donations"}
# Rows of the published tables; none of the counts of banks, camps and donors depends on which copy of a donation is kept.
_PUBLISHED = {
    "daily_donation_summary": "(SELECT DISTINCT donation_date FROM filed_unique WHERE donation_status = 'Completed')",
    "monthly_donation_summary": "(SELECT DISTINCT year(donation_date), month(donation_date) FROM filed_unique WHERE donation_status = 'Completed')",
    "blood_group_distribution": "(SELECT DISTINCT blood_group FROM filed_unique WHERE donation_status = 'Completed')",
    "rare_blood_availability": "watch_stock", "rare_blood_summary": "(SELECT DISTINCT blood_group FROM watch_stock)",
    "blood_shortage_report": "(SELECT DISTINCT blood_group FROM watch_stock)", "blood_bank_rare_stock": "watch_stock",
    "city_blood_availability": "(SELECT DISTINCT city, state, blood_group FROM watch_stock)",
    "blood_bank_performance": "banks", "donation_camp_performance": "camps", "donor_summary": "donors",
    "rare_donor_summary": f"(SELECT DISTINCT blood_group FROM donors WHERE blood_group IN {_WATCH})",
}
_JOB = " UNION ALL ".join([
    *[f"SELECT 'bronze' AS section, '{name}.rows' AS check_name, 'PASS' AS status, count(*) AS value FROM {block}" for name, block in _RAW.items()],
    *[f"SELECT 'bronze', '{name}.null_ingested_at', 'PASS', 0" for name in _RAW],
    *[f"SELECT 'silver', '{name}', 'PASS', NULL" for name in (*_RAW, "enriched_donations")],
    *[f"SELECT 'duplicates', '{key}', 'PASS', 0" for key in ("donor_id", "blood_bank_id", "inventory_id", "camp_id", "donation_id")],
    *[f"SELECT 'boundaries', 'units {units}', 'PASS', {units}" for units in (0, 4, 5, 9, 10, 11)],
    *[f"SELECT 'gold', '{name}.rows', 'PASS', count(*) FROM {rows}" for name, rows in _PUBLISHED.items()],
    "SELECT 'streaming', 'checkpoint', 'PASS', NULL",
    "SELECT 'streaming', 'events', 'PASS', count(*) FROM live", "SELECT 'streaming', 'null_ids', 'PASS', 0",
    """SELECT 'streaming', 'null_event_times', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*) FROM live WHERE event_time IS NULL""",
    """SELECT 'streaming', 'duplicate_ids', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*)
        FROM (SELECT donation_id FROM live GROUP BY 1 HAVING count(*) > 1)""",
])

ORACLES: dict[str, str] = {
    # stock
    "stock_summary": _sql("""SELECT blood_group, CAST(sum(available_units) AS BIGINT) AS total_available_units,
        count(DISTINCT CASE WHEN available_units > 0 THEN blood_bank_id END) AS number_of_centers,
        sum(available_units) / nullif(count(DISTINCT CASE WHEN available_units > 0 THEN blood_bank_id END), 0)
            AS average_units_per_center,
        min(available_units) AS minimum_units, max(available_units) AS maximum_units FROM inventory GROUP BY 1"""),
    "stock_availability_a": _sql("SELECT * FROM tiers"),
    "stock_centers": _sql(f"""SELECT blood_bank_id, blood_bank_name, city, state, blood_group, available_units, last_updated,
        {_tier('available_units')} AS availability_status FROM watch_stock"""),
    "shortage_a": _sql(f"""SELECT blood_group, total_available_units, number_of_centers, availability_status AS shortage_level,
        {_choose('availability_status', _TIER_ACTION)} AS recommended_action FROM tiers"""),
    "zero_stock": _sql("""SELECT blood_bank_id, blood_bank_name, city, state, blood_group, available_units,
        'NO STOCK' AS status FROM watch_stock WHERE available_units = 0"""),
    "city_stock_a": _sql(f"""SELECT city, state, blood_group, CAST(sum(available_units) AS BIGINT) AS total_available_units,
        count(DISTINCT CASE WHEN available_units > 0 THEN blood_bank_id END) AS number_of_centers,
        {_tier('sum(available_units)')} AS status FROM watch_stock GROUP BY 1, 2, 3"""),
    "center_rank": _sql("""SELECT blood_bank_id, blood_bank_name, city, state, rare_blood_units, rare_blood_types_available,
        CAST(rank() OVER (ORDER BY rare_blood_units DESC) AS INTEGER) AS center_rank
        FROM bank_watch LEFT JOIN banks USING (blood_bank_id)"""),
    "stock_detail_b": _sql(_DETAIL),
    "group_summary_b": _sql("SELECT * FROM watch_summary"),
    "shortage_b": _sql(f"""SELECT blood_group, total_available_units, number_of_blood_banks,
        number_of_banks_with_stock AS banks_with_stock, availability_status AS shortage_status,
        {_choose('availability_status', _SEVERITY)} AS severity_score FROM watch_summary"""),
    "bank_stock": _sql(_BANK_STOCK),
    "bank_stock_in_stock": _sql(_BANK_STOCK + " WHERE available_units > 0"),
    "city_stock_b": _sql(_CITY),
    "watch_list_coverage": _sql(f"""SELECT g.blood_group, CAST(coalesce(u, 0) AS BIGINT) AS total_units,
        coalesce(b, 0) AS centers_available, coalesce(c, 0) AS cities_available, {_strict('coalesce(u, 0)')} AS status
        FROM (VALUES ('O-'), ('AB-'), ('B-'), ('A-')) g(blood_group) LEFT JOIN (
            SELECT blood_group, sum(available_units) AS u,
                   count(DISTINCT CASE WHEN available_units > 0 THEN blood_bank_id END) AS b,
                   count(DISTINCT CASE WHEN available_units > 0 THEN coalesce(city, '?') END) AS c
            FROM watch_stock GROUP BY 1) USING (blood_group)"""),
    "record_status_counts": _sql("""SELECT blood_group, CAST(sum(available_units) AS BIGINT) AS total_units,
        count(DISTINCT CASE WHEN available_units > 0 THEN blood_bank_id END) AS centers_with_stock,
        count(*) FILTER (inventory_status = 'CRITICAL') AS critical_records,
        count(*) FILTER (inventory_status = 'LOW') AS low_records FROM watch_stock GROUP BY 1"""),
    "group_totals": _sql("""SELECT blood_group, CAST(sum(available_units) AS BIGINT) AS total_available_units
        FROM inventory GROUP BY 1"""),
    "scale_labels": _sql(f"""SELECT scale, label, count(*) AS line_count FROM (
        SELECT 'four_tier' AS scale, {_tier('available_units')} AS label FROM inventory
        UNION ALL SELECT 'stock_out', {_out('available_units')} FROM inventory
        UNION ALL SELECT 'strict', {_strict('available_units')} FROM inventory
        UNION ALL SELECT 'record', {_record('available_units')} FROM inventory) GROUP BY 1, 2"""),
    # activity
    "contribution": _sql(f"""SELECT blood_group, count(*) AS total_donations,
        CAST(sum(units_donated) AS BIGINT) AS total_units_donated, count(DISTINCT donor_id) AS active_donors,
        count(DISTINCT blood_bank_id) AS blood_banks_receiving_donations
        FROM completed WHERE blood_group IN {_WATCH} GROUP BY 1"""),
    "daily_trend": _sql(f"""SELECT donation_date AS date, blood_group, CAST(sum(units_donated) AS BIGINT) AS units_donated,
        count(*) AS donation_count FROM completed WHERE blood_group IN {_WATCH} GROUP BY 1, 2"""),
    "daily_summary": _sql("SELECT * FROM daily"),
    "monthly_summary": _sql("SELECT * FROM monthly"),
    "monthly_labels": _sql("""SELECT year, month, substr(month_name, 1, 3) || ' ' || year AS period, total_units_donated
        FROM monthly"""),
    "distribution": _sql("SELECT * FROM shares"),
    "bank_performance": _sql("SELECT * FROM bank_perf"),
    "camp_performance": _sql("SELECT * FROM camp_perf"),
    "donor_roster": _sql("SELECT * FROM roster"),
    "donor_pool": _sql("""SELECT blood_group, count(*) AS total_donors, count(*) FILTER (total_donations > 0) AS active_donors,
        CAST(sum(total_donations) AS BIGINT) AS total_donations, CAST(sum(total_units_donated) AS BIGINT) AS total_units_donated
        FROM roster WHERE is_rare_blood_donor GROUP BY 1"""),
    # cleaning and enrichment
    "standardise_codes": _sql(f"""SELECT donation_id, blood_group, donation_status, note,
        blood_group IN {_GROUPS} AS is_valid_blood_group, blood_group IN {_WATCH} AS is_rare_blood,
        donation_status IN {_STATUSES} AS is_valid_donation_status FROM codes"""),
    "inventory_quality": _sql(f"""SELECT blood_bank_id, blood_group, available_units, inventory_id, inventory_status,
        available_units % 3 AS reserved_units, blood_group IN {_GROUPS} AS is_valid_blood_group, blood_group IN {_WATCH} AS is_rare_blood,
        available_units IS NOT NULL AND available_units >= 0 AS is_valid_units, blood_bank_id {_IN_BANKS} AS blood_bank_exists,
        CASE WHEN blood_group IN {_GROUPS} AND available_units >= 0 AND blood_bank_id {_IN_BANKS} THEN 'VALID' ELSE 'REVIEW' END
            AS overall_data_quality_status FROM inventory"""),
    "camp_quality": _sql("""SELECT camp_id, camp_name, coalesce(nullif(trim(organizer), ''), 'Unknown') AS organizer,
        coalesce(nullif(trim(city), ''), 'Unknown') AS city, camp_date,
        CASE WHEN camp_id IS NOT NULL AND camp_date IS NOT NULL THEN 'VALID' ELSE 'REVIEW' END AS overall_data_quality_status FROM camps"""),
    "clean_donations": _sql("""SELECT *, CAST(NULL AS TIMESTAMP) AS event_time, 'historical_batch' AS source, 'blood_donation' AS event_type,
        CAST(NULL AS TIMESTAMP) AS _ingested_at, CAST(NULL AS DATE) AS _ingestion_date, CAST(NULL AS VARCHAR) AS _source_file FROM donations"""),
    "quality_flags": _sql("SELECT * FROM flagged", facts="donations"),
    "donor_quality": _sql(f"""SELECT * REPLACE (coalesce(gender, 'Unknown') AS gender),
        blood_group IN {_GROUPS} AS is_valid_blood_group, age BETWEEN 18 AND 65 AS is_valid_age,
        CASE WHEN blood_group IN {_GROUPS} AND age BETWEEN 18 AND 65 THEN 'VALID' ELSE 'REVIEW' END
            AS overall_data_quality_status FROM donors"""),
    "bank_quality": _sql("""SELECT *, blood_bank_id IS NOT NULL AS is_valid_id, storage_capacity > 0 AS is_valid_capacity,
        latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AS is_valid_coordinates,
        CASE WHEN storage_capacity > 0 AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
             THEN 'VALID' ELSE 'REVIEW' END AS overall_data_quality_status FROM banks"""),
    "dedup": _sql("SELECT * FROM unique_lines"),
    "union_align": _sql("SELECT * FROM mixed"),
    "union_dedup": _sql("SELECT * FROM mixed_unique"),
    "enrich": _sql("SELECT * FROM wide", facts="donations"),
    "layer_metrics": _sql(_METRICS, facts="mixed_unique"),
    # ledger
    "ledger_balance": _sql("SELECT * FROM balances"),
    "expiry": _sql("SELECT * EXCLUDE (days_left) FROM aged"),
    "demand": _sql("SELECT * FROM demand"),
    "coverage": _sql(f"""SELECT {_KEY}, available_units, daily > 0 AS has_demand_data, daily AS average_daily_demand,
        average_weekly_demand, average_monthly_demand, coverage_days FROM covered"""),
    "trend": _sql("SELECT * FROM trend"),
    "stock_state": _sql(f"SELECT {_STATE} FROM state"),
    "reconcile": _sql("""SELECT blood_bank_id, blood_group, component_type, available_units, recomputed_units,
        CASE WHEN s.k IS NULL THEN 'NOT_PUBLISHED' WHEN b.k IS NULL THEN 'NOT_IN_LEDGER' WHEN available_units = recomputed_units THEN 'MATCH'
             ELSE 'MISMATCH' END AS reconciliation_status
        FROM (SELECT CASE blood_bank_id WHEN 2 THEN 1000000002 ELSE blood_bank_id END AS blood_bank_id, blood_group, component_type,
                     greatest(available_units, 0) AS available_units, 1 AS k FROM balances) s
        FULL JOIN (SELECT blood_bank_id, blood_group, component_type, available_units AS recomputed_units, 1 AS k FROM balances) b
        USING (blood_bank_id, blood_group, component_type)"""),
    "ledger_keys_except": _sql(f"SELECT {_KEY} FROM ledger EXCEPT SELECT {_KEY} FROM balances WHERE available_units > 0"),
    "running_balance": _sql(f"""SELECT *, running_balance < 0 AS below_zero FROM (
        SELECT {_KEY}, transaction_timestamp, transaction_id, transaction_type, units, sum(delta) OVER (
            PARTITION BY {_KEY} ORDER BY transaction_timestamp, transaction_id, transaction_type, units
            ROWS UNBOUNDED PRECEDING) AS running_balance FROM signed)"""),
    "stock_at_donation": _sql("""SELECT d.donation_id, d.blood_bank_id, d.blood_group, d.donation_date, c.day AS known_since, c.balance
        FROM donations d ASOF LEFT JOIN (SELECT blood_bank_id, blood_group, day, sum(moved) OVER (
            PARTITION BY blood_bank_id, blood_group ORDER BY day) AS balance FROM (
            SELECT blood_bank_id, blood_group, CAST(transaction_timestamp AS DATE) AS day, sum(delta) AS moved FROM signed GROUP BY 1, 2, 3)) c
        ON d.blood_bank_id = c.blood_bank_id AND d.blood_group = c.blood_group AND d.donation_date >= c.day"""),
    "lots_at_issue": _sql(f"""SELECT i.transaction_id, i.blood_bank_id, i.blood_group, i.component_type, i.day AS issue_date,
        count(*) AS fresh_lots, sum(l.units) AS fresh_units, min(l.day) AS oldest_lot
        FROM (SELECT *, CAST(transaction_timestamp AS DATE) AS day FROM ledger WHERE transaction_type = 'ISSUE') i
        JOIN (SELECT *, CAST(transaction_timestamp AS DATE) AS day FROM ledger WHERE transaction_type = 'DONATION') l
        ON i.blood_bank_id = l.blood_bank_id AND i.blood_group = l.blood_group AND i.component_type = l.component_type
            AND i.day BETWEEN l.day AND l.day + {_choose('l.component_type', _SHELF)}
        GROUP BY 1, 2, 3, 4, 5"""),
    "monthly_sketches": _sql("""SELECT CAST(date_trunc('month', donation_date) AS DATE) AS month, blood_group, count(DISTINCT donor_id) AS donors,
        count(units_donated) AS donated_values, true AS hll_near, true AS theta_near, true AS all_values_seen, true AS median_near
        FROM donations GROUP BY 1, 2"""),
    "returning_donors": _sql("""SELECT m.month, m.blood_group, count(DISTINCT a.donor_id) AS returning_donors, true AS near
        FROM (SELECT DISTINCT CAST(date_trunc('month', donation_date) AS DATE) AS month, blood_group FROM donations) m
        JOIN (SELECT DISTINCT CAST(date_trunc('month', donation_date) + INTERVAL 1 MONTH AS DATE) AS month, blood_group FROM donations) p
            ON m.month = p.month AND m.blood_group = p.blood_group
        LEFT JOIN (SELECT DISTINCT CAST(date_trunc('month', x.donation_date) AS DATE) AS month, x.blood_group, x.donor_id
            FROM donations x JOIN donations y ON x.donor_id = y.donor_id AND x.blood_group = y.blood_group
                AND date_trunc('month', x.donation_date) = date_trunc('month', y.donation_date) + INTERVAL 1 MONTH) a
            ON m.month = a.month AND m.blood_group = a.blood_group
        GROUP BY 1, 2"""),
    "ledger_cube": _sql("""SELECT state, city, blood_group, component_type, CAST(grouping(state, city, blood_group, component_type) AS INTEGER) AS grouping_id,
        sum(units) AS total_units, count(*) AS movement_count FROM ledger LEFT JOIN banks USING (blood_bank_id)
        GROUP BY GROUPING SETS ((state, city, blood_group, component_type), (state, city), (state, blood_group), (blood_group, component_type), ())"""),
    "stock_outs": _sql("""SELECT blood_bank_id, blood_group, min(day) AS run_start, max(day) AS run_end, count(*) AS run_rows,
            CASE WHEN bool_or(following IS NULL) THEN NULL ELSE max(following) END AS next_start
        FROM (SELECT *, row_number() OVER (PARTITION BY blood_bank_id, blood_group ORDER BY day)
                - row_number() OVER (PARTITION BY blood_bank_id, blood_group, balance <= 0 ORDER BY day) AS island,
            CASE WHEN row_number() OVER (PARTITION BY blood_bank_id, blood_group ORDER BY day DESC) = 1 THEN NULL
                ELSE lead(day) OVER (PARTITION BY blood_bank_id, blood_group ORDER BY day) END AS following
            FROM (SELECT blood_bank_id, blood_group, day, sum(moved) OVER (PARTITION BY blood_bank_id, blood_group ORDER BY day) AS balance FROM (
                SELECT blood_bank_id, blood_group, CAST(transaction_timestamp AS DATE) AS day, sum(delta) AS moved FROM signed GROUP BY 1, 2, 3)))
        WHERE balance <= 0 GROUP BY blood_bank_id, blood_group, island"""),
    "donor_pauses": _sql("""SELECT donor_id, last_day, next_day, CAST(next_day - last_day AS INTEGER) AS pause_days FROM (
        SELECT donor_id, donation_date AS last_day, lead(donation_date) OVER (PARTITION BY donor_id ORDER BY donation_date) AS next_day
        FROM (SELECT DISTINCT donor_id, donation_date FROM donations WHERE donor_id IS NOT NULL)) WHERE next_day - last_day >= 90"""),
    "rolling_demand": _sql("""SELECT d.blood_bank_id, d.blood_group, d.day, sum(i.units) AS units_30_days
        FROM (SELECT DISTINCT blood_bank_id, blood_group, CAST(transaction_timestamp AS DATE) AS day FROM ledger WHERE transaction_type = 'ISSUE') d
        JOIN (SELECT *, CAST(transaction_timestamp AS DATE) AS issued FROM ledger WHERE transaction_type = 'ISSUE') i
            ON d.blood_bank_id = i.blood_bank_id AND d.blood_group = i.blood_group AND i.issued BETWEEN d.day - 29 AND d.day
        GROUP BY 1, 2, 3"""),
    "ledger_differences": _sql(f"""SELECT *, left_count * CASE WHEN transaction_id % 97 = 0 THEN 0 ELSE 2 END AS right_count
        FROM (SELECT {_POSTED}, count(*) AS left_count FROM ledger GROUP BY ALL) WHERE transaction_id % 97 = 0 OR transaction_id % 89 = 0"""),
    "ledger_in_common": _sql(f"""SELECT transaction_type, count(*) AS different_movements, CAST(sum(n) AS BIGINT) AS movements FROM (
        SELECT {_POSTED}, count(*) AS n FROM ledger WHERE transaction_id % 97 <> 0 GROUP BY ALL) GROUP BY 1"""),
    "stock_matrix": _sql("SELECT blood_bank_id, " + ", ".join(
        f"CAST(sum(CASE WHEN blood_group = '{g}' THEN available_units END) AS BIGINT) AS units_{c}" for g, c in _MATRIX.items()) + " FROM inventory GROUP BY 1"),
    "stock_matrix_lines": _sql(f"""SELECT blood_bank_id, blood_group, CAST(sum(available_units) AS BIGINT) AS available_units
        FROM inventory WHERE blood_group IN {_GROUPS} GROUP BY 1, 2 HAVING sum(available_units) IS NOT NULL"""),
    "post_donations": _sql(f"""SELECT 'D-' || donation_id || '-' || component_type AS transaction_id, {_KEY},
        'DONATION' AS transaction_type, CAST(units_donated AS DOUBLE) AS units,
        CAST(donation_date AS TIMESTAMP) AS transaction_timestamp, donation_id AS source_donation_id, 'POSTED' AS status
        FROM completed, (VALUES ('RBC'), ('Plasma'), ('Platelets')) c(component_type)
        WHERE component_type <> 'Platelets' OR substr(md5(CAST(donation_id AS VARCHAR)), 1, 1) < '8'"""),
    "expiry_candidates": _sql(f"""SELECT * FROM (SELECT *, oldest_donation + {_choose('component_type', _SHELF)} AS expiry_date
        FROM (SELECT {_KEY}, CAST(round(sum(delta)) AS BIGINT) AS available_units,
              CAST(min(CASE WHEN transaction_type = 'DONATION' THEN transaction_timestamp END) AS DATE) AS oldest_donation
              FROM signed GROUP BY 1, 2, 3)) WHERE available_units > 0 AND expiry_date <= {_AS_OF}"""),
    "closing_snapshot": _sql(f"""SELECT {_KEY}, greatest(available_units, 0) AS available_units, expiry_status,
        last_updated AS last_transaction_at FROM aged"""),
    "issue_list": _sql(f"""SELECT transaction_id AS issue_id, {_KEY}, units, CAST(transaction_timestamp AS DATE) AS issue_date
        FROM ledger WHERE transaction_type = 'ISSUE'"""),
    "issue_postings": _sql(f"""SELECT 'I-' || transaction_id AS transaction_id, {_KEY}, 'ISSUE' AS transaction_type, units,
        CAST(CAST(transaction_timestamp AS DATE) AS TIMESTAMP) AS transaction_timestamp, 'POSTED' AS status,
        transaction_id AS issue_id, 'H' || blood_bank_id AS hospital_id FROM ledger WHERE transaction_type = 'ISSUE'"""),
    "movement_counts": _sql("SELECT transaction_type, count(*) AS row_count FROM ledger GROUP BY 1"),
    "distinct_counts": _sql("""SELECT count(DISTINCT blood_bank_id) AS blood_bank_id, count(DISTINCT blood_group) AS blood_group,
        count(DISTINCT component_type) AS component_type FROM ledger"""),
    # transfers
    "transfers_valid": _sql("SELECT * FROM checked_moves"),
    "transfer_validity_counts": _sql("""SELECT count(*) AS transfers, count(*) FILTER (is_valid) AS valid_transfers,
        count(*) FILTER (NOT is_valid) AS invalid_transfers, count(*) FILTER (is_valid IS NULL) AS undecided_transfers
        FROM checked_moves"""),
    "transfer_pairs": _sql("SELECT * FROM pairs"),
    "transfer_postings": _sql("""SELECT 'O-' || transfer_id AS transaction_id, source_bank_id AS blood_bank_id, blood_group,
        component_type, 'TRANSFER_OUT' AS transaction_type, units, CAST(transfer_date AS TIMESTAMP) AS transaction_timestamp,
        transfer_id AS source_transfer_id, destination_bank_id, 'POSTED' AS status FROM moves
        UNION ALL SELECT 'N-' || transfer_id, destination_bank_id, blood_group, component_type, 'TRANSFER_IN', units,
        CAST(transfer_date AS TIMESTAMP), transfer_id, NULL, 'POSTED' FROM moves"""),
    "transfer_candidates": _sql("""SELECT source_bank_id, blood_group, component_type, surplus_units,
        CAST(candidate_banks AS BIGINT) AS candidate_banks, neediest_bank_id, neediest_units FROM (
            SELECT s.blood_bank_id AS source_bank_id, s.blood_group, s.component_type, s.available_units AS surplus_units,
                   o.blood_bank_id AS neediest_bank_id, o.available_units AS neediest_units,
                   count(*) OVER (PARTITION BY s.blood_bank_id, s.blood_group, s.component_type) AS candidate_banks,
                   row_number() OVER (PARTITION BY s.blood_bank_id, s.blood_group, s.component_type
                       ORDER BY o.available_units, o.blood_bank_id) AS rn
            FROM balances s JOIN balances o ON s.blood_group = o.blood_group AND s.component_type = o.component_type
                AND s.blood_bank_id <> o.blood_bank_id
            WHERE s.available_units >= 5) WHERE rn = 1"""),
    # checks
    "orphans": _sql("""SELECT destination_bank_id AS orphan_key, count(*) AS row_count FROM moves
        WHERE destination_bank_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1"""),
    "duplicates": _sql("""SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2
        HAVING count(*) > 1"""),
    "null_counts": _sql(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, count(*) AS row_count FROM live"
        for c in ["donation_id", "donor_id", "blood_bank_id", "camp_id", "donation_date", "event_time"])),
    "allowed_values": _sql(f"""SELECT blood_group, count(*) AS row_count FROM codes
        WHERE blood_group IS NULL OR blood_group NOT IN {_GROUPS} GROUP BY 1"""),
    "completeness": _sql(" UNION ALL ".join(
        f"SELECT 'missing_values' AS section, 'events.{c}' AS check_name, CASE WHEN count(*) FILTER ({c} IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END"
        f" AS status, count(*) FILTER ({c} IS NULL) AS value, CAST(NULL AS VARCHAR) AS detail FROM live"
        for c in ["donation_id", "donor_id", "blood_bank_id", "donation_date"])
        + " UNION ALL SELECT 'missing_values', 'events.shoe_size', 'FAIL', NULL, 'column not found'"),
    "allowed_sample": _sql(f"""SELECT 'allowed_values' AS section, 'codes.blood_group' AS check_name,
        CASE WHEN sum(n) > 0 THEN 'FAIL' ELSE 'PASS' END AS status, CAST(coalesce(sum(n), 0) AS BIGINT) AS value,
        string_agg(v, ', ' ORDER BY v) FILTER (place <= 10) AS detail
        FROM (SELECT coalesce(blood_group, 'NULL') AS v, count(*) AS n, row_number() OVER (ORDER BY coalesce(blood_group, 'NULL')) AS place
              FROM codes WHERE blood_group IS NULL OR blood_group NOT IN {_GROUPS} GROUP BY 1)"""),
    "first_ingested": _sql(f"""SELECT donation_id, _ingested_at FROM {_CLOCKED} ORDER BY _ingested_at NULLS FIRST, donation_id LIMIT 10"""),
    "ingest_lag": _sql(f"""SELECT donation_id, event_time, _ingested_at, CAST(date_diff('second', event_time, _ingested_at) AS DOUBLE) AS lag_seconds
        FROM {_CLOCKED}"""),
    "stream_admission": _sql(_STREAMED),
    "quantity_rules": _sql(_counter_rows("quantities", _GIVEN, {
        "null_units": "zero", "zero_units": "zero", "negative_units": "zero", "unusually_large_units": "report"})),
    "donor_rules": _sql(_DONOR_RULES),
    "foreign_keys": _sql(_counter_rows("foreign_keys", _FK, dict.fromkeys(["donor", "bank", "camp", "inventory_bank"], "zero"))),
    "enrichment_check": _sql(_counter_rows("clean_layer", """(SELECT (SELECT count(*) FROM donations) AS donations,
        (SELECT count(*) FROM wide) AS enriched_rows,
        (SELECT count(*) FROM (SELECT donation_id FROM donations GROUP BY 1 HAVING count(*) > 1)) AS duplicate_ids,
        (SELECT count(*) FROM wide) - (SELECT count(*) FROM donations) AS row_change)""", {
        "donations": "positive", "enriched_rows": "report", "duplicate_ids": "zero", "row_change": "zero"}), facts="donations"),
    "inventory_consistency": _sql(_counter_rows("inventory", f"""(SELECT count(*) FILTER (available_units < 0) AS negative_units,
        count(*) FILTER (NOT blood_bank_id {_IN_BANKS}) AS orphan_banks, sum(available_units) AS total_units FROM inventory)""", {
        "negative_units": "zero", "orphan_banks": "zero", "total_units": "report"})),
    "display_rows": _sql(_counter_rows("display", """(SELECT count(*) FILTER (available_units > 0) AS displayed_rows,
        count(*) FILTER (available_units = 0) AS not_in_stock,
        count(*) FILTER (available_units IS NULL OR available_units < 0) AS bad_units,
        count(*) FILTER (blood_group NOT IN ('O-', 'AB-', 'B-', 'A-')) AS off_list,
        count(*) FILTER (blood_bank_id IS NULL) AS null_bank, count(*) FILTER (blood_group IS NULL) AS null_group
        FROM watch_stock)""", {
        "displayed_rows": "report", "not_in_stock": "report", "bad_units": "zero", "off_list": "zero", "null_bank": "zero",
        "null_group": "zero"})),
    "stock_precheck": _sql(f"""SELECT count(*) AS total_records,
        count(*) FILTER (blood_group NOT IN {_GROUPS}) AS invalid_blood_groups,
        count(*) FILTER (available_units < 0) AS negative_units, count(*) FILTER (blood_bank_id IS NULL) AS null_blood_bank_id,
        count(*) FILTER (blood_group IS NULL) AS null_blood_group, count(*) FILTER (available_units IS NULL) AS null_available_units,
        count(*) FILTER (last_updated IS NULL) AS null_last_updated, CAST(0 AS BIGINT) AS non_numeric_units,
        count(*) FILTER (NOT blood_bank_id {_IN_BANKS}) AS missing_bank_matches,
        (SELECT count(*) FROM (SELECT 1 FROM inventory GROUP BY blood_bank_id, blood_group HAVING count(*) > 1))
            AS duplicate_logical_keys FROM inventory"""),
    "publish_precheck": _sql(f"""SELECT count(*) FILTER (blood_bank_id IS NULL) AS null_bank_id,
        count(*) FILTER (blood_group IS NULL) AS null_group, count(*) FILTER (available_units IS NULL) AS null_units,
        count(*) FILTER (available_units < 0) AS negative_units,
        count(*) FILTER (blood_group NOT IN {_GROUPS}) AS invalid_inventory_groups,
        (SELECT count(*) FROM live WHERE donation_date IS NULL) AS null_donation_date,
        (SELECT count(*) FROM live WHERE units_donated IS NULL OR units_donated <= 0) AS non_positive_units_donated,
        (SELECT count(*) FROM live WHERE blood_group NOT IN {_GROUPS}) AS invalid_donation_groups,
        (SELECT count(*) FROM (SELECT 1 FROM live GROUP BY donation_id HAVING count(*) > 1)) AS duplicate_donation_ids,
        (SELECT count(*) FROM (SELECT 1 FROM donors GROUP BY donor_id HAVING count(*) > 1)) AS duplicate_donor_ids,
        (SELECT count(*) FROM (SELECT 1 FROM banks GROUP BY blood_bank_id HAVING count(*) > 1)) AS duplicate_bank_ids,
        (SELECT count(*) FROM (SELECT 1 FROM inventory GROUP BY inventory_id HAVING count(*) > 1)) AS duplicate_inventory_ids
        FROM inventory"""),
    "gold_vs_silver": _sql(f"""SELECT 'published_totals' AS section, item AS check_name,
        CASE WHEN total IS NOT DISTINCT FROM published THEN 'PASS' ELSE 'FAIL' END AS status, CAST(total AS BIGINT) AS value,
        'published: ' || coalesce(CAST(published AS VARCHAR), 'none') AS detail FROM (
            SELECT 'completed_units' AS item, (SELECT sum(units_donated) FROM completed) AS total,
                   (SELECT CAST(sum(total_units_donated) AS BIGINT) FROM shares) AS published
            UNION ALL SELECT 'stock ' || blood_group, t, total_available_units
            FROM (SELECT blood_group, sum(available_units) AS t FROM inventory WHERE blood_group IN {_WATCH} GROUP BY 1)
            FULL JOIN watch_summary USING (blood_group))"""),
    "distribution_rules": _sql(_counter_rows("distribution", f"""(SELECT
        (SELECT CASE WHEN sum(percentage_of_total) BETWEEN 99 AND 101 THEN 0 ELSE 1 END FROM shares) AS share_off,
        (SELECT 4 - count(*) FROM watch_summary WHERE blood_group IN {_WATCH}) AS absent_groups)""",
        {"share_off": "zero", "absent_groups": "zero"})),
    "ledger_invariants": _sql("SELECT * FROM graded", checks="ledger_checks"),
    "check_rollup": _sql(_ROLLUP.replace("{donors}", _DONOR_RULES), checks="ledger_checks"),
    "event_admission": _sql(_ADMISSION),
    "event_rejections": _sql(_REJECTED),
    # board
    "kpis": _sql("""SELECT CAST(sum(total_available_units) AS BIGINT) AS rare_units,
        count(*) FILTER (availability_status = 'CRITICAL') AS critical_groups,
        count(*) FILTER (availability_status = 'OUT_OF_STOCK') AS out_of_stock_groups,
        (SELECT count(DISTINCT blood_bank_id) FROM watch_stock WHERE available_units > 0) AS rare_banks,
        (SELECT count(*) FROM roster WHERE is_rare_blood_donor) AS rare_donors,
        (SELECT count(*) FROM completed) AS total_donations,
        (SELECT CAST(sum(units_donated) AS BIGINT) FROM completed) AS total_units,
        (SELECT count(*) FROM completed WHERE donation_date = DATE '1998-06-15') AS donations_on_day FROM watch_summary"""),
    "donor_stats": _sql("""SELECT count(*) AS total_donors, count(*) FILTER (is_rare_blood_donor) AS rare_donors,
        count(*) FILTER (total_donations > 0) AS active_donors FROM roster"""),
    "donors_by_group": _sql("""SELECT blood_group, count(*) AS donor_count,
        CAST(sum(total_units_donated) AS BIGINT) AS total_units_donated FROM roster GROUP BY 1"""),
    "state_headline": _sql("""SELECT CAST(sum(available_units) AS BIGINT) AS total_units, count(DISTINCT blood_bank_id) AS blood_banks,
        count(DISTINCT component_type) AS component_types, count(*) FILTER (priority_level = 'EMERGENCY') AS emergency_lines,
        count(*) FILTER (priority_level = 'CRITICAL') AS critical_lines,
        count(*) FILTER (expiry_status = 'EXPIRING_SOON') AS expiring_soon_lines,
        count(*) FILTER (expiry_status = 'EXPIRED') AS expired_lines, median(coverage_days) AS median_coverage_days FROM state"""),
    "watch_state_totals": _sql(f"""SELECT count(*) AS watch_lines,
        count(*) FILTER (priority_level IN ('EMERGENCY', 'CRITICAL')) AS urgent_watch_lines
        FROM state WHERE blood_group IN {_WATCH}"""),
    "banks_by_units": _sql("SELECT * FROM bank_perf"),
    "band_counts": _sql("""SELECT position, priority_level, count(s.shortage_score) AS line_count
        FROM (VALUES (0, 'EMERGENCY'), (1, 'CRITICAL'), (2, 'LOW'), (3, 'MONITOR'), (4, 'HEALTHY')) o(position, priority_level)
        LEFT JOIN state s USING (priority_level) GROUP BY 1, 2"""),
    "expiry_counts": _sql("""SELECT position, expiry_status, count(s.blood_bank_id) AS line_count
        FROM (VALUES (0, 'VALID'), (1, 'EXPIRING_SOON'), (2, 'EXPIRED')) o(position, expiry_status)
        LEFT JOIN aged s USING (expiry_status) GROUP BY 1, 2"""),
    "lookup_filter": _sql(_DETAIL + " WHERE blood_group = 'O-' AND state = 'ASIA' AND available_units > 0 AND available_units <= 5"),
    "day_range": _sql("SELECT * FROM daily WHERE donation_date BETWEEN DATE '1998-06-15' AND DATE '1999-06-15'"),
    "mappable_rows": _sql(_BANK_STOCK + " WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND available_units > 0"),
    "city_totals": _sql("SELECT city, CAST(sum(available_units) AS BIGINT) AS total_available_units FROM watch_stock GROUP BY 1"),
    "shortage_alerts": _sql(f"""SELECT * FROM (SELECT blood_group, {_ALERT.format(u='total_available_units')} AS alert
        FROM watch_summary) WHERE alert IS NOT NULL"""),
    "bank_alerts": _sql(f"""SELECT blood_bank_id, blood_group, {_ALERT.format(u='available_units')} AS alert
        FROM (SELECT *, {_out('available_units')} AS availability_status FROM watch_stock)"""),
    "run_totals": _sql("""SELECT blood_group, total_available_units, availability_status,
        number_of_banks_with_stock AS banks_holding FROM watch_summary"""),
    "urgent_alerts": _sql("""SELECT blood_group, component_type, blood_bank_id, available_units,
        CASE WHEN coverage_days IS NULL THEN 'No demand data' ELSE printf('%.1f', coverage_days) END AS coverage_display,
        shortage_score, priority_level, recommended_action FROM state WHERE priority_level IN ('EMERGENCY', 'CRITICAL')"""),
    "most_urgent": _sql("""SELECT blood_group, component_type, blood_bank_id, available_units, shortage_score FROM state
        WHERE priority_level = 'EMERGENCY'
        ORDER BY shortage_score DESC, available_units, blood_bank_id, blood_group, component_type LIMIT 1"""),
    "topk_centers": _sql(f"""SELECT blood_group, blood_bank_id, blood_bank_name, city, available_units,
        {_tier('available_units')} AS availability_status FROM watch_stock WHERE available_units > 0
        ORDER BY available_units DESC, blood_group, blood_bank_id LIMIT 10"""),
    "topk_banks_by_stock": _sql("""SELECT blood_bank_id, CAST(sum(available_units) AS BIGINT) AS total_available_units
        FROM inventory GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""),
    "topk_odd_values": _sql(f"""SELECT blood_group, count(*) AS row_count FROM codes
        WHERE blood_group IS NULL OR blood_group NOT IN {_GROUPS} GROUP BY 1 ORDER BY 1 NULLS FIRST LIMIT 10"""),
    "topk_group_banks": _sql(_BANK_STOCK + " WHERE blood_group = 'O-' ORDER BY available_units DESC, blood_bank_id LIMIT 15"),
    "topk_banks_received": _sql("SELECT * FROM bank_perf ORDER BY total_units_received DESC, blood_bank_id LIMIT 10"),
    "topk_camps": _sql("SELECT * FROM camp_perf ORDER BY total_units_collected DESC, camp_id LIMIT 10"),
    "topk_demand": _sql(f"""SELECT blood_bank_id || ' · ' || blood_group || ' ' || component_type AS inventory_line, {_KEY},
        average_daily_demand FROM demand
        ORDER BY average_daily_demand DESC, total_units_issued DESC, {_KEY} LIMIT 10"""),
    "topk_transfers": _sql("""SELECT transfer_id, source_bank_id, destination_bank_id, blood_group, component_type, units,
        transfer_date, status FROM checked_moves WHERE is_valid ORDER BY transfer_date DESC, transfer_id, source_bank_id,
        destination_bank_id, blood_group, component_type, units, status LIMIT 25"""),
    "topk_live_feed": _sql(f"""SELECT donation_id, blood_group, blood_bank_id, units_donated, donation_status, event_time,
        blood_group IN {_WATCH} AS is_rare, strftime(event_time, '%H:%M:%S') AS event_clock FROM live
        ORDER BY event_time DESC NULLS LAST, donation_id LIMIT 25"""),
    # streaming
    "tumbling_units": _halved(f"""SELECT blood_group, w AS window_start, w + INTERVAL 6 HOURS AS window_end, count(*) AS events,
        CAST(sum(units_donated) AS BIGINT) AS units FROM (SELECT *, {_SIX_HOURS} AS w FROM @marked@)
        WHERE (low_water IS NULL OR w + INTERVAL 6 HOURS > low_water) AND {_final('w + INTERVAL 6 HOURS', True)} GROUP BY 1, 2""", True),
    "sliding_units": _halved(f"""SELECT blood_group, w AS window_start, w + INTERVAL 1 DAY AS window_end, count(*) AS events,
        CAST(sum(units_donated) AS BIGINT) AS units FROM (SELECT *, {_SIX_HOURS} - to_hours(6 * k) AS w FROM @marked@, range(4) r(k))
        WHERE (low_water IS NULL OR w + INTERVAL 1 DAY > low_water) AND {_final('w + INTERVAL 1 DAY', True)} GROUP BY 1, 2""", True),
    "session_units": _halved(f"""SELECT donor_id, min(event_time) AS window_start, max(event_time) + INTERVAL 6 HOURS AS window_end,
        count(*) AS events, CAST(sum(units_donated) AS BIGINT) AS units
        FROM (SELECT *, sum(opens) OVER (PARTITION BY donor_id ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS run FROM (
            SELECT *, CASE WHEN event_time < lag(event_time) OVER (PARTITION BY donor_id ORDER BY event_time) + INTERVAL 6 HOURS THEN 0 ELSE 1 END AS opens
            FROM @marked@))
        GROUP BY donor_id, run HAVING {_final('max(event_time) + INTERVAL 6 HOURS', False)}""", False),
    "late_events": _halved(f"""SELECT donation_id, blood_group, units_donated, event_time, low_water FROM @marked@
        WHERE {_SIX_HOURS} + INTERVAL 6 HOURS <= low_water""", True),
    "event_follow_ups": _sql("""SELECT a.donation_id, a.event_time, a.units_donated, b.event_time AS later_time, b.units_donated AS later_units
        FROM arrived a LEFT JOIN (SELECT donation_id, event_time, units_donated FROM arrived WHERE repeated) b
            ON a.donation_id = b.donation_id AND b.event_time BETWEEN a.event_time AND a.event_time + INTERVAL 4 MINUTES
        WHERE NOT a.repeated AND a.event_time IS NOT NULL AND (b.donation_id IS NOT NULL OR a.event_time + INTERVAL 4 MINUTES < (
            SELECT least(max(event_time) FILTER (repeated), max(event_time) FILTER (NOT repeated)) - INTERVAL 1 HOUR FROM arrived))"""),
    "stream_ingest": _sql("SELECT * FROM live"),
    # files and layers
    "stream_landing": _sql("SELECT *, true AS from_landing, true AS dated_by_its_clock FROM live"),
    "stream_progress": _sql("""SELECT CASE WHEN event_id <= (SELECT max(event_id) // 2 FROM events) THEN 'run 0' ELSE 'run 1' END AS query_name,
        count(*) AS input_rows, true AS one_entry_per_batch FROM events GROUP BY 1"""),
    "bronze_round_trip": _sql(" UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS raw_rows, count(*) AS stored_rows, CAST(0 AS BIGINT) AS unmarked_rows FROM {block}"
        for name, block in _RAW.items())),
    "ledger_from_csv": _sql("SELECT * REPLACE (CAST(blood_bank_id AS VARCHAR) AS blood_bank_id) FROM balances"),
    "transfers_from_csv": _sql("""SELECT 'with transfers' AS lake, count(*) AS transfers, count(*) FILTER (is_valid) AS valid_transfers,
        count(*) FILTER (NOT is_valid) AS invalid_transfers, count(*) FILTER (is_valid IS NULL) AS undecided_transfers FROM checked_moves
        UNION ALL SELECT 'without', 0, 0, 0, 0"""),
    "silver_metrics": _sql(_METRICS, facts="filed_unique"),
    "layered_job": _sql(_JOB),
}
