"""The registered queries in DuckDB SQL, over the driver's tables.

Written independently of the Spark plans: amounts are added as decimals, the
ledger is aggregated once for movement and once per driver, monthly losses are
joined instead of carried along.
"""

from __future__ import annotations

import re

_CUSTOMER = "CAST(o_custkey AS VARCHAR) AS customer_id"


def _id_list(column: str) -> str:
    ordered = f"list_sort(list({column}), 'ASC', 'NULLS LAST')"
    return f"array_to_string(list_transform({ordered}, lambda x: coalesce(x, 'NULL')), ',')"


def _money(expression: str, condition: str = "") -> str:
    kept = f" FILTER (WHERE {condition})" if condition else ""
    return f"CAST(sum(CAST({expression} AS DECIMAL(18, 4))){kept} AS DOUBLE)"


def _share(driver: str) -> str:
    return f"""CASE WHEN abs_diff > 0
        THEN round_even(abs({driver} / abs_diff) * 100, 0) ELSE 0 END"""


_QUARTER = "BETWEEN DATE '1997-10-01' AND DATE '1997-12-31'"
_PREV1 = "BETWEEN DATE '1997-07-01' AND DATE '1997-09-30'"
_PREV2 = "BETWEEN DATE '1997-04-01' AND DATE '1997-06-30'"
_HALF_YEAR = "BETWEEN DATE '1997-04-01' AND DATE '1997-09-30'"

# The labels in these relations are those of the report.
_RELATIONS = {
    "spine": """
        SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name FROM customer""",
    "booking_lines": f"""
        SELECT {_CUSTOMER}, CAST(o_orderkey AS VARCHAR) AS opportunity_id,
            CAST(o_orderdate AS DATE) AS closed, o_totalprice AS usd,
            'USD ' || format('{{:,.2f}}', o_totalprice) AS local_text
        FROM orders WHERE o_orderstatus <> 'F'""",
    "loss_lines": f"""
        SELECT {_CUSTOMER}, CAST(o_orderkey AS VARCHAR) AS opportunity_id,
            CAST(o_orderdate AS DATE) AS lost, -o_totalprice AS baseline,
            format('{{:,.2f}}', -o_totalprice) AS usd_text
        FROM orders WHERE o_orderstatus = 'F'""",
    "sold_lines": f"""
        SELECT {_CUSTOMER}, lineitem.*, CAST(l_shipdate AS DATE) AS shipped
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "ledger": """
        SELECT customer_id, shipped AS snapshot_date,
            l_returnflag || l_linestatus AS bridge_account,
            CASE l_returnflag WHEN 'R' THEN -1 ELSE 1 END * l_extendedprice
                * (1 - l_discount) AS usd,
            CASE l_returnflag WHEN 'R' THEN -1 ELSE 1 END * l_extendedprice AS lcu
        FROM sold_lines""",
    "refs": """
        SELECT customer_id, CAST(l_suppkey AS VARCHAR) AS reference_number,
            CAST(nullif(l_linenumber, 7) AS VARCHAR) AS contract_id
        FROM sold_lines""",
    "booked": f"""
        SELECT customer_id, {_money('usd')} AS booking_usd,
            {_money("replace(trim(substr(local_text, 4)), ',', '')")} AS booking_lcu,
            max(closed) AS start_date, {_id_list('opportunity_id')} AS opportunity_id
        FROM booking_lines WHERE closed {_QUARTER} GROUP BY customer_id""",
    "lost": f"""
        SELECT customer_id, {_money("replace(usd_text, ',', '')")} AS loss_usd,
            {_money('baseline')} AS loss_lcu, {_id_list('opportunity_id')} AS opportunity_id
        FROM loss_lines WHERE lost {_QUARTER} GROUP BY customer_id""",
    "booked_before": f"""
        SELECT customer_id, {_money('usd', 'closed ' + _PREV1)} AS prev1_usd,
            {_money('usd', 'closed ' + _PREV2)} AS prev2_usd
        FROM booking_lines WHERE closed {_HALF_YEAR} GROUP BY customer_id""",
    "lost_before": f"""
        SELECT customer_id, {_money('baseline', 'lost ' + _PREV1)} AS prev1_usd,
            {_money('baseline', 'lost ' + _PREV2)} AS prev2_usd
        FROM loss_lines WHERE lost {_HALF_YEAR} AND baseline < 0 GROUP BY customer_id""",
    "moved": f"""
        SELECT customer_id, {_money('usd')} AS arr_usd, {_money('lcu')} AS arr_lcu
        FROM ledger WHERE snapshot_date {_QUARTER} GROUP BY customer_id""",
    "driven": f"""
        SELECT customer_id,
            coalesce({_money('usd', "bridge_account = 'NO'")}, 0) AS migration,
            coalesce({_money('usd', "bridge_account = 'AO'")}, 0) AS winback,
            coalesce({_money('usd', "bridge_account = 'NF'")}, 0) AS price_ramp,
            coalesce({_money('usd', "bridge_account = 'AF'")}, 0) AS price_uplift,
            coalesce({_money('usd', "bridge_account = 'RF'")}, 0) AS downsell_migration,
            coalesce({_money('usd', "bridge_account = 'RO'")}, 0) AS reversal
        FROM ledger WHERE snapshot_date {_QUARTER} GROUP BY customer_id""",
    "lost_by_month": f"""
        SELECT customer_id, CAST(month(snapshot_date) AS INTEGER) AS month,
            {_money('usd')} AS month_arr_usd
        FROM ledger WHERE snapshot_date {_HALF_YEAR} AND usd < 0 GROUP BY ALL""",
    "booking_gap": """
        SELECT *, abs(diff) AS abs_diff FROM (
            SELECT spine.customer_id, name, booking_usd, coalesce(booking_lcu, 0) AS booking_lcu,
                start_date, arr_usd, arr_lcu, migration, winback, price_ramp, price_uplift,
                coalesce(arr_usd, 0) AS arr_filled, coalesce(booking_usd, 0) AS crm_filled,
                coalesce(arr_usd, 0) - coalesce(booking_usd, 0) AS diff,
                CASE WHEN (booking_usd IS NULL) <> (arr_usd IS NULL)
                    THEN 'Need to label' ELSE 'both present' END AS presence
            FROM spine LEFT JOIN booked USING (customer_id)
                LEFT JOIN moved USING (customer_id) LEFT JOIN driven USING (customer_id))
        WHERE greatest(arr_filled, crm_filled) > 0""",
    "booking_first": """
        SELECT *, CASE
            WHEN least(arr_filled, crm_filled) > 0 AND abs_diff < 25000 THEN 'Immaterial'
            WHEN start_date >= DATE '1997-12-15' AND arr_filled = 0
                THEN 'Booked now, starts later'
            ELSE 'N' END AS label
        FROM booking_gap""",
    "booking_second": """
        SELECT * REPLACE (CASE
            WHEN label = 'N' AND crm_filled = 0 AND arr_usd > 0
                AND ((prev1_usd > 0 AND abs(arr_usd - prev1_usd) <= 25000)
                    OR (prev2_usd > 0 AND abs(arr_usd - prev2_usd) <= 25000))
            THEN 'Booked previously, starts now    ' ELSE label END AS label)
        FROM (
            SELECT booking_first.*, coalesce(prev1_usd, 0) AS prev1_usd,
                coalesce(prev2_usd, 0) AS prev2_usd
            FROM booking_first LEFT JOIN booked_before USING (customer_id))""",
    "booking_third": f"""
        SELECT * REPLACE (CASE
            WHEN label <> 'N' THEN label
            WHEN {_share('migration')} BETWEEN 90 AND 110 THEN 'Migration'
            WHEN {_share('price_ramp')} BETWEEN 90 AND 110 THEN 'Price Ramp'
            WHEN {_share('price_uplift')} BETWEEN 90 AND 110 THEN 'Price Uplift'
            WHEN {_share('winback')} BETWEEN 90 AND 110 THEN 'Winback'
            WHEN presence = 'Need to label'
                AND (price_ramp + price_uplift + winback + migration) / nullif(diff, 0) * 100
                    BETWEEN 90 AND 110
            THEN ['Price Ramp', 'Price Uplift', 'Winback', 'Upsell & Cross-sell Migration'][
                list_position([price_ramp, price_uplift, winback, migration],
                    greatest(price_ramp, price_uplift, winback, migration))]
            ELSE 'Need to label' END AS label)
        FROM booking_second""",
    "booking_branch": """
        SELECT customer_id, name, opportunity_id, arr_usd, arr_lcu, t.booking_usd, t.start_date,
            diff, t.booking_lcu, prev1_usd, prev2_usd, migration, price_ramp, price_uplift,
            winback, label
        FROM booking_third t
            LEFT JOIN (SELECT customer_id, opportunity_id FROM booked) USING (customer_id)""",
    "loss_gap": """
        SELECT *, abs(diff) AS abs_diff FROM (
            SELECT spine.customer_id, name, loss_usd, coalesce(loss_lcu, 0) AS loss_lcu,
                arr_usd, arr_lcu, downsell_migration, reversal,
                coalesce(arr_usd, 0) AS arr_filled, coalesce(loss_usd, 0) AS crm_filled,
                coalesce(arr_usd, 0) - coalesce(loss_usd, 0) AS diff
            FROM spine LEFT JOIN lost USING (customer_id)
                LEFT JOIN moved USING (customer_id) LEFT JOIN driven USING (customer_id))
        WHERE least(arr_filled, crm_filled) < 0""",
    "loss_first": """
        SELECT *, CASE WHEN greatest(arr_filled, crm_filled) < 0 AND abs_diff < 25000
            THEN 'Immaterial' ELSE 'N' END AS label
        FROM loss_gap""",
    "loss_second": """
        SELECT loss_first.* REPLACE (CASE
                WHEN label = 'N' AND (prev1_usd / nullif(diff, 0) * 100 BETWEEN 80 AND 120
                    OR prev2_usd / nullif(diff, 0) * 100 BETWEEN 80 AND 120)
                THEN 'SF Loss in prior period' ELSE label END AS label),
            prev1_usd, prev2_usd
        FROM loss_first LEFT JOIN lost_before USING (customer_id)""",
    "loss_third": f"""
        SELECT * REPLACE (coalesce(prev1_usd, 0) AS prev1_usd,
            coalesce(prev2_usd, 0) AS prev2_usd,
            CASE WHEN label <> 'N' THEN label
                WHEN {_share('downsell_migration')} BETWEEN 90 AND 110 THEN 'Migration'
                WHEN {_share('reversal')} BETWEEN 90 AND 110 THEN 'Reversal'
                ELSE 'Need to label' END AS label)
        FROM loss_second""",
    "loss_fourth": """
        SELECT loss_third.* REPLACE (CASE
                WHEN (abs(reversal) + abs(downsell_migration)) / nullif(abs_diff, 0) * 100
                    BETWEEN 90 AND 110
                THEN CASE WHEN abs(reversal) >= abs(downsell_migration)
                    THEN 'Reversal' ELSE 'Migration' END
                WHEN crm_filled <> 0 AND (arr_filled = 0 OR abs(crm_filled) > abs(arr_filled))
                    AND abs(month_arr_usd) / nullif(abs_diff, 0) * 100 BETWEEN 80 AND 100
                    AND label IN ('N', 'Need to label', '')
                THEN 'DWH loss in prior period' ELSE label END AS label),
            month, month_arr_usd
        FROM loss_third LEFT JOIN lost_by_month USING (customer_id)""",
    "loss_branch": """
        SELECT customer_id, name, opportunity_id, arr_usd, arr_lcu, t.loss_usd, diff, t.loss_lcu,
            prev1_usd, prev2_usd, downsell_migration, reversal, label
        FROM loss_fourth t
            LEFT JOIN (SELECT customer_id, opportunity_id FROM lost) USING (customer_id)""",
    "merged": """
        SELECT coalesce(b.customer_id, c.customer_id) AS customer_id,
            coalesce(b.name, c.name) AS name,
            coalesce(b.arr_usd, c.arr_usd, 0) AS arr_usd,
            coalesce(c.loss_usd, 0) AS loss_usd, coalesce(c.diff, 0) AS loss_variance_usd,
            coalesce(b.booking_usd, 0) AS booking_usd,
            coalesce(b.diff, 0) AS booking_variance_usd,
            coalesce(b.arr_lcu, c.arr_lcu, 0) AS arr_lcu,
            coalesce(c.loss_lcu, 0) AS loss_lcu,
            coalesce(c.arr_lcu - c.loss_lcu, 0) AS loss_variance_lcu,
            coalesce(b.booking_lcu, 0) AS booking_lcu,
            coalesce(b.arr_lcu - b.booking_lcu, 0) AS booking_variance_lcu,
            b.start_date, coalesce(b.opportunity_id, c.opportunity_id) AS opportunity_id,
            coalesce(reversal, 0) AS reversal, coalesce(migration, 0) AS upsell_migration,
            coalesce(downsell_migration, 0) AS downsell_migration,
            coalesce(price_ramp, 0) AS price_ramp, coalesce(price_uplift, 0) AS price_uplift,
            coalesce(winback, 0) AS winback,
            coalesce(c.prev1_usd, 0) AS loss_prev1_usd, coalesce(c.prev2_usd, 0) AS loss_prev2_usd,
            coalesce(b.prev1_usd, 0) AS booking_prev1_usd,
            coalesce(b.prev2_usd, 0) AS booking_prev2_usd,
            c.label AS loss_label, b.label AS booking_label
        FROM booking_branch b FULL JOIN loss_branch c ON b.customer_id = c.customer_id""",
    "audited": f"""
        SELECT merged.*, {_id_list('DISTINCT reference_number')} AS reference_number,
            {_id_list('DISTINCT contract_id')} AS contract_id
        FROM merged LEFT JOIN refs USING (customer_id) GROUP BY ALL""",
}


def _query(select: str) -> str:
    """``select`` with the relations it needs, in definition order."""
    needed: set[str] = set()
    text = select
    for name in reversed(_RELATIONS):
        if re.search(rf"\b{name}\b", text):
            needed.add(name)
            text += _RELATIONS[name]
    chosen = [f"{name} AS ({sql})" for name, sql in _RELATIONS.items() if name in needed]
    return f"WITH {', '.join(chosen)} {select}"


_DRIVER_CASE = """CASE bridge_account WHEN 'NO' THEN 'migration' WHEN 'AO' THEN 'winback'
    WHEN 'NF' THEN 'price_ramp' WHEN 'AF' THEN 'price_uplift' END"""

# Headers of the report.
_REPORT = """SELECT customer_id AS "MCID", name AS "Name",
    arr_usd AS "ARR USD TTL Customer Movement", loss_usd AS "SF Loss USD",
    loss_variance_usd AS "Loss Variance USD", booking_usd AS "SF Bookings USD",
    booking_variance_usd AS "Bookings Variance USD",
    arr_lcu AS " ARR LCU TTL Customer Movement ", loss_lcu AS "SF Loss LCU",
    loss_variance_lcu AS "Loss Variance LCU", booking_lcu AS "SF Bookings LCU",
    booking_variance_lcu AS "Bookings Variance LCU", reference_number AS "Reference number",
    contract_id AS "Salesforce Contract ID", start_date AS "Celigo Start Date",
    opportunity_id AS "Opportunity ID", reversal AS "Reversal",
    upsell_migration AS "(Upsell & Cross-sell Migration)",
    downsell_migration AS "(Downsell & Downgrade Migration)", price_ramp AS "Ramp",
    price_uplift AS "Price Uplift", winback AS "Win-Back",
    loss_prev1_usd AS "Loss in PrevQ1", loss_prev2_usd AS "Loss in PrevQ2",
    booking_prev1_usd AS "Bookings in PrevQ1", booking_prev2_usd AS "Bookings in PrevQ2",
    loss_label AS "Final Loss Recon Category", booking_label AS "Final Bookings Recon Category"
    FROM audited"""

_REJECTED = [
    ("booking_lines", "recurring_revenue", "o_orderstatus <> 'F' AND o_orderkey % 11 = 0", "format('{:.2f}d', o_totalprice)"),
    ("booking_lines", "recurring_revenue", "o_orderstatus <> 'F' AND o_orderkey % 11 <> 0 AND o_orderkey % 13 = 0", "''"),
    ("booking_lines", "amount_local_text", "o_orderstatus <> 'F' AND o_orderkey % 17 = 0", "'USD'"),
    ("booking_lines", "start_date", "o_orderstatus <> 'F' AND o_orderkey % 19 = 0", "strftime(o_orderdate, '%m/%d/%Y')"),
    ("loss_lines", "amount_text", "o_orderstatus = 'F' AND o_orderkey % 23 = 0", "'(5.00)'"),
]


def _by_months(sql: str) -> str:
    """A query of the bookings with the months of each quarter, in any year, as its period."""
    months = {_QUARTER: "IN (10, 11, 12)", _PREV1: "IN (7, 8, 9)", _PREV2: "IN (4, 5, 6)", _HALF_YEAR: "BETWEEN 4 AND 9"}
    for window, numbers in months.items():
        sql = sql.replace(f"closed {window}", f"month(closed) {numbers}")
    return sql


ORACLE_SQL: dict[str, str] = {
    "id_list_quoting": r"""
        WITH ids AS (
            SELECT CAST(o_custkey AS VARCHAR) AS customer_id, CASE o_orderkey % 8
                WHEN 0 THEN 'a ' || o_orderkey WHEN 1 THEN '' WHEN 2 THEN 'null' WHEN 3 THEN 'q"' || o_orderkey
                WHEN 4 THEN 'b\' || o_orderkey WHEN 5 THEN '{' || o_orderkey || ',}'
                WHEN 7 THEN CAST(o_orderkey AS VARCHAR) END AS id
            FROM orders
        ),
        shown AS (
            SELECT customer_id, id, CASE WHEN id IS NULL THEN 'NULL'
                WHEN id = '' OR lower(id) = 'null' OR regexp_matches(id, '[\s,{}"\\]')
                THEN '"' || translate(replace(replace(id, '\', '\\'), '"', '\"'), '{}', '') || '"'
                ELSE id END AS element
            FROM ids
        )
        SELECT customer_id, string_agg(element, ',' ORDER BY id ASC NULLS LAST) AS reference_number
        FROM shown GROUP BY customer_id""",
    "signed_amounts": """
        SELECT CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
            CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2)) * CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END) AS DOUBLE) AS amount
        FROM orders GROUP BY 1""",
    "share_ties": """
        SELECT order_id, CASE WHEN gap > 0 THEN round_even(ramp / gap * 100, 0) ELSE 0 END AS share,
            CASE WHEN ramp >= uplift AND ramp >= winback THEN 'ramp' WHEN uplift >= winback THEN 'uplift' ELSE 'winback' END AS largest
        FROM (
            SELECT o_orderkey AS order_id, CAST(o_orderkey % 400 AS DOUBLE) AS ramp, CAST(o_custkey % 400 AS DOUBLE) AS uplift,
                CAST(greatest(o_orderkey % 400, o_custkey % 400) - o_orderkey % 2 AS DOUBLE) AS winback,
                CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE 200 END AS gap
            FROM orders
        )""",
    "rejected_values": " UNION ALL ".join(
        f"""SELECT '{role}' AS role, '{column}' AS "column", {text} AS text, count(*) AS count
            FROM orders WHERE {rows} GROUP BY ALL HAVING count(*) > 0"""
        for role, column, rows, text in _REJECTED
    ),
    "reconcile_bookings_by_months": _by_months(_query("SELECT * FROM booking_branch")),
    "amount_parse": _query(
        """SELECT opportunity_id,
                TRY_CAST(replace(trim(substr(local_text, 4)), ',', '') AS DOUBLE) AS amount
            FROM booking_lines
            UNION ALL
            SELECT opportunity_id, TRY_CAST(replace(usd_text, ',', '') AS DOUBLE) FROM loss_lines"""
    ),
    "period_filter": _query(
        f"""SELECT customer_id, opportunity_id, lost AS contract_start,
                CAST(replace(usd_text, ',', '') AS DOUBLE) AS loss_usd,
                lost {_QUARTER} AS in_window
            FROM loss_lines
            WHERE month(lost) IN (10, 11, 12) AND CAST(replace(usd_text, ',', '') AS DOUBLE) < 0"""
    ),
    "category_map": _query(
        f"""SELECT customer_id, snapshot_date, bridge_account, {_DRIVER_CASE} AS booking_driver,
                CASE bridge_account WHEN 'RF' THEN 'downsell_migration'
                    WHEN 'RO' THEN 'reversal' END AS loss_driver
            FROM ledger"""
    ),
    "booking_rollup": _query("SELECT * FROM booked"),
    "loss_rollup": _query("SELECT * FROM lost"),
    "prior_period_rollup": _query("SELECT * FROM booked_before"),
    "loss_history_rollup": _query("SELECT * FROM lost_before"),
    "ledger_rollup": _query("SELECT * FROM moved JOIN driven USING (customer_id)"),
    "ledger_monthly_losses": _query("SELECT * FROM lost_by_month"),
    "id_list_text": _query(
        f"""SELECT customer_id, {_id_list('reference_number')} AS reference_number,
                {_id_list('contract_id')} AS contract_id
            FROM refs GROUP BY customer_id"""
    ),
    "id_list_distinct_text": _query(
        f"""SELECT customer_id, {_id_list('DISTINCT reference_number')} AS reference_number,
                {_id_list('DISTINCT contract_id')} AS contract_id
            FROM refs GROUP BY customer_id"""
    ),
    "spine_variance": _query("SELECT * FROM booking_gap"),
    "bookings_stage1": _query("SELECT * FROM booking_first"),
    "bookings_stage2": _query("SELECT * FROM booking_second"),
    "bookings_stage3": _query("SELECT * FROM booking_third"),
    "reconcile_bookings": _query("SELECT * FROM booking_branch"),
    "losses_stage1": _query("SELECT * FROM loss_first"),
    "losses_stage2": _query("SELECT * FROM loss_second"),
    "losses_stage3": _query("SELECT * FROM loss_third"),
    "losses_stage4": _query("SELECT * FROM loss_fourth"),
    "reconcile_losses": _query("SELECT * FROM loss_branch"),
    "merge_branches": _query("SELECT * FROM merged"),
    "attach_audit_refs": _query("SELECT * FROM audited"),
    "reconciliation": _query(_REPORT),
    "calendar_filter": _query(
        """SELECT customer_id, opportunity_id, lost AS contract_start, CAST(replace(usd_text, ',', '') AS DOUBLE) AS loss_usd
            FROM loss_lines WHERE month(lost) IN (10, 11, 12) AND CAST(replace(usd_text, ',', '') AS DOUBLE) < 0"""
    ),
    "ledger_store_rollup": _query("SELECT * FROM moved JOIN driven USING (customer_id)"),
    "ledger_store_monthly_losses": _query("SELECT * FROM lost_by_month"),
    "drivers_by_table": _query("SELECT * FROM moved JOIN driven USING (customer_id)"),
    "id_list_chunks": _query(
        f"""SELECT customer_id, {_id_list('reference_number')} AS reference_number, {_id_list('contract_id')} AS contract_id
            FROM refs GROUP BY customer_id"""
    ),
    "report_by_period": _query(
        _REPORT.replace('" ARR LCU TTL Customer Movement "', '"ARR LCU TTL Customer Movement"').replace("SELECT ", "SELECT '1997Q4' AS period, ", 1)
    ),
}
