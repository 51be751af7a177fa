"""DuckDB twin of :mod:`claimflow.sources.fixtures`.

The same mapping of the driver's TPC-H-like tables onto the claims object
model, written as SQL common table expressions.  Oracle queries are built as
``WITH <entity CTEs>, <query CTEs> SELECT ...`` over the pre-registered views
``region nation customer orders lineitem events``.  Every expression here has
a one-to-one counterpart in ``fixtures.py``; keep the two in step.
"""

from __future__ import annotations

from ..operators.predicates import EXCLUDED_CLOSED_REASONS as _REASONS
from .fixtures import BENEFIT_BY_PRIORITY, REP_END, REP_START

_PRIORITY_CASE = " ".join(
    f"WHEN '{prio}' THEN '{name}'" for prio, name in BENEFIT_BY_PRIORITY
)
_PRIORITY_LIST = ", ".join(f"'{prio}'" for prio, _ in BENEFIT_BY_PRIORITY)

_PAY_ID = ("concat_ws('-', 'P', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
           "strftime(l_shipdate, '%Y%m%d'))")

ENTITY_CTES: dict[str, str] = {
    "organisation": """
        SELECT CAST(CAST(r_regionkey AS BIGINT) AS VARCHAR) AS id, r_name AS name FROM region""",
    "scheme": """
        SELECT CAST(CAST(n_nationkey AS BIGINT) AS VARCHAR) AS id,
               'SCH' || lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS number,
               n_name AS name,
               CAST(CAST(n_regionkey AS BIGINT) AS VARCHAR) AS organisation_id
        FROM nation""",
    "crm_user": """
        SELECT CAST(CAST(n_nationkey AS BIGINT) AS VARCHAR) AS id, 'User ' || n_name AS name FROM nation""",
    "policy": """
        SELECT CAST(c_custkey AS VARCHAR) AS id,
               'POL' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS name,
               CASE WHEN c_custkey % 3 = 0 THEN NULL
                    ELSE 'L' || CAST(c_custkey AS VARCHAR) END AS legacy_member_number,
               'M' || CAST(c_custkey AS VARCHAR) AS member_number,
               'P' || CAST(c_custkey AS VARCHAR) AS pas_member_id,
               CAST(DATE '1990-01-01' + CAST(c_custkey % 3650 AS INTEGER) AS VARCHAR)
                   AS date_joined_fund,
               CASE WHEN c_acctbal >= 0 THEN 'Yes' ELSE 'No' END AS in_super,
               CAST(CAST(c_nationkey AS BIGINT) AS VARCHAR) AS scheme_id
        FROM customer""",
    "claimant": """
        SELECT CAST(c_custkey AS VARCHAR) AS id,
               'First' || CAST(c_custkey AS VARCHAR) AS first_name,
               'Last' || CAST(c_custkey AS VARCHAR) AS last_name,
               CAST(DATE '1950-01-01' + CAST((c_custkey * 37) % 15000 AS INTEGER) AS VARCHAR)
                   AS birthdate,
               CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender
        FROM customer""",
    "claim": """
        SELECT CAST(c_custkey AS VARCHAR) AS id,
               c_name AS name,
               CASE WHEN c_custkey % 20 = 5 THEN 'Incomplete'
                    WHEN c_custkey % 20 = 6 THEN NULL
                    ELSE 'Open' END AS status,
               CASE WHEN c_custkey % 10 = 0 THEN 'Enquiry'
                    WHEN c_custkey % 10 = 1 THEN 'Post Claim'
                    ELSE 'Claim' END AS claim_type,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Retail' ELSE 'Group' END
                   AS business_type,
               CASE WHEN c_custkey % 7 = 0 THEN NULL
                    ELSE DATE '1995-01-01' + CAST(c_custkey % 2500 AS INTEGER) END
                   AS form_received,
               'Team ' || CAST(c_custkey % 4 + 1 AS VARCHAR) AS team,
               CAST(c_custkey AS VARCHAR) AS policy_id,
               CAST(c_custkey AS VARCHAR) AS claimant_id,
               CAST(c_custkey % 25 AS VARCHAR) AS owner_id
        FROM customer""",
    "benefit": f"""
        SELECT prio || '|' || seg AS id,
               CASE prio {_PRIORITY_CASE} END AS name,
               seg AS category
        FROM (SELECT seg, unnest([{_PRIORITY_LIST}]) AS prio
              FROM (SELECT DISTINCT c_mktsegment AS seg FROM customer))""",
    "benefit_claimed": f"""
        SELECT CAST(o.o_orderkey AS VARCHAR) AS id,
               CASE WHEN o.o_orderkey % 101 = 5 THEN 'Shared ' || CAST(o.o_orderkey % 13 AS VARCHAR)
                    WHEN o.o_orderkey % 103 = 7 THEN NULL
                    ELSE CAST(o.o_orderkey AS VARCHAR) END AS name,
               'Variant ' || CAST(o.o_orderkey % 7 AS VARCHAR) AS product_name,
               CASE WHEN o.o_orderkey % 50 = 7 THEN 'Suspended'
                    WHEN o.o_orderkey % 50 = 8 THEN NULL
                    WHEN o.o_orderstatus = 'F' THEN 'Closed'
                    WHEN o.o_orderstatus = 'P' THEN 'Open'
                    WHEN o.o_orderstatus = 'O' THEN 'Approved' END AS status,
               CASE WHEN o.o_orderkey % 25 = 3 THEN '{_REASONS[0]}'
                    WHEN o.o_orderkey % 25 = 4 THEN '{_REASONS[1]}'
                    WHEN o.o_orderkey % 25 = 5 THEN ''
                    WHEN o.o_orderkey % 25 = 6 THEN 'Withdrawn' END AS closed_reason,
               CASE WHEN o.o_orderstatus = 'F' THEN 'Finalised' ELSE 'Active' END
                   AS benefit_status_recorded,
               CASE WHEN o.o_orderkey % 40 = 9 THEN NULL
                    ELSE CAST(date_trunc('year', o.o_orderdate) AS DATE) END
                   AS date_of_disability,
               CAST(o.o_orderdate AS DATE) + 10 AS notification_date,
               CASE WHEN o.o_orderkey % 4 = 0 THEN NULL
                    ELSE CAST(o.o_orderdate AS DATE) + 20 END AS initial_under_assessment,
               CASE WHEN o.o_orderkey % 3 = 0 THEN NULL
                    ELSE CAST(o.o_orderdate AS DATE) + 400 END AS closure_date,
               CASE WHEN o.o_orderkey % 11 = 0 THEN CAST(o.o_orderdate AS DATE) + 200 END
                   AS reopened_date,
               CASE WHEN o.o_orderkey % 17 = 0 THEN CAST(o.o_orderdate AS DATE) + 300 END
                   AS date_of_reoccurrence,
               CAST((o.o_orderkey % 4) * 30 AS DOUBLE) AS waiting_period,
               CASE WHEN o.o_orderkey % 6 = 1 THEN NULL
                    ELSE CAST((o.o_orderkey % 3) * 15 AS DOUBLE) END AS waiting_period_extension,
               'Days' AS waiting_units,
               CASE WHEN o.o_orderkey % 60 = 11 THEN NULL ELSE o.o_totalprice END
                   AS coverage_amount,
               CASE WHEN o.o_orderkey % 3 = 0 THEN '2 Years'
                    WHEN o.o_orderkey % 3 = 1 THEN '5 Years'
                    ELSE 'To Age 65' END AS benefit_period,
               CAST(CAST(o.o_orderdate AS DATE) + 365 AS VARCHAR) AS indexation_date,
               CASE WHEN o.o_orderkey % 11 = 0 THEN 'true' ELSE 'false' END AS reopened,
               CASE WHEN o.o_orderkey % 11 = 0 THEN 'Data Update' END AS reopened_reason,
               CAST(CAST(o.o_orderdate AS DATE) + 730 AS VARCHAR) AS expected_closure,
               CAST(CAST(o.o_orderdate AS DATE) + 1825 AS VARCHAR) AS end_of_benefit_period,
               CAST(o.o_custkey AS VARCHAR) AS claim_id,
               o.o_orderpriority || '|' || c.c_mktsegment AS benefit_id,
               CAST(o.o_orderkey % 25 AS VARCHAR) AS modified_by_id
        FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey""",
    "payment_contribution": f"""
        SELECT 'PC-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
                   AS name,
               l_linenumber AS line_number,
               CASE WHEN l_partkey % 500 = 1 THEN NULL
                    WHEN l_orderkey % 997 = 3 THEN CAST('NaN' AS DOUBLE)
                    WHEN l_orderkey % 1009 = 4 AND l_linenumber = 1 THEN CAST(1e17 AS DOUBLE)
                    WHEN l_orderkey % 211 = 6 THEN CAST(0.005 AS DOUBLE)
                    ELSE l_extendedprice END AS amount,
               CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_shipdate AS DATE) - 30 END
                   AS start,
               CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_shipdate AS DATE) - 1 END
                   AS through,
               CAST(l_orderkey AS VARCHAR) AS benefit_claimed_id,
               {_PAY_ID} AS payment_id
        FROM lineitem""",
    "payment": f"""
        SELECT {_PAY_ID} AS id,
               'PAY-' || CAST(l_orderkey AS VARCHAR) || '-' || strftime(l_shipdate, '%Y%m%d')
                   AS name,
               CASE WHEN l_returnflag = 'N' THEN 'Pending' ELSE 'Processed' END AS status,
               CAST(l_shipdate AS DATE) AS release,
               CAST(CAST(l_shipdate AS DATE) - 30 AS VARCHAR) AS start,
               'PAS' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS pas_reference,
               CASE WHEN l_orderkey % 10 <> 2
                    THEN CAST(date_trunc('month', l_shipdate) AS DATE) END AS release_month
        FROM lineitem""",
    "journal": """
        SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_custkey AS VARCHAR) AS claim_id FROM customer""",
    "diagnosis": """
        SELECT 'DX-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS name,
               json_extract_string(props, '$.k') AS medical_code,
               CASE WHEN event_id % 5 = 0 THEN NULL
                    ELSE 'Condition ' || json_extract_string(props, '$.k') END AS description,
               CASE WHEN event_id % 4 = 0 THEN NULL
                    ELSE 'Factor ' || CAST(event_id % 7 AS VARCHAR) END AS duration_factor,
               CASE WHEN event_type = 'purchase' THEN 'Primary'
                    WHEN event_type = 'signup' THEN 'Cause of Death'
                    ELSE 'Secondary' END AS type,
               CASE WHEN event_id % 3 = 0 THEN NULL
                    ELSE CAST(ts AS DATE) - CAST(event_id % 90 AS INTEGER) END AS start,
               CAST(ts AS DATE) AS created,
               CAST(user_id AS VARCHAR) AS journal_id
        FROM events""",
}

PARAMS_SQL = f"DATE '{REP_START.isoformat()}'", f"DATE '{REP_END.isoformat()}'"


def with_entities(*query_ctes: tuple[str, str], select: str) -> str:
    """Assemble ``WITH <entities>, <query ctes> <select>`` for DuckDB."""
    parts = [f"{name} AS ({body}\n)" for name, body in ENTITY_CTES.items()]
    parts += [f"{name} AS ({body}\n)" for name, body in query_ctes]
    return "WITH " + ",\n".join(parts) + "\n" + select
