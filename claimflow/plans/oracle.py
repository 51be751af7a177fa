"""DuckDB oracle SQL for every registered query.

Written independently of the Spark plans: plain left joins along the
relationship paths, ``row_number()`` windows for the top-1 picks, ``LIKE``
patterns for the benefit classes, ``NOT EXISTS`` for the orphan test.  Column
names match the Spark queries exactly.
"""

from __future__ import annotations

from ..sources.fixture_sql import PARAMS_SQL, with_entities
from ..operators.predicates import EXCLUDED_CLOSED_REASONS
from ..operators.relate import RELATIONSHIPS
from .acr import ACR_COLUMNS
from .ocr import OCR_COLUMNS

S, E = PARAMS_SQL
_REASONS = "(" + ", ".join(f"'{r}'" for r in EXCLUDED_CLOSED_REASONS) + ")"


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


# Null-safe benefit-name classes (a missing name matches no pattern).
IP = "coalesce(benefit_name LIKE '%Income Protection%', false)"
SC = "coalesce(benefit_name LIKE 'Super Contribution%', false)"
SC_ANY = "coalesce(benefit_name LIKE '%Super Contribution%', false)"
SCADD = "coalesce(benefit_name LIKE '%Additional Super Contribution%', false)"
ADD_ANY = "coalesce(benefit_name LIKE 'Additional%', false)"
ADD = ("coalesce(benefit_name LIKE 'Additional %' "
       "AND benefit_name NOT LIKE 'Additional Super Contribution%', false)")
PRIMARY = f"(NOT {SC_ANY} AND NOT {SCADD} AND NOT {ADD_ANY})"

CTE = {
    "payments": f"""
        SELECT bc.name AS benefit_claimed_name, pc.name AS contribution_name, pc.amount,
               pc.start, pc.through, pm.release, cl.name AS claim_name,
               pc.line_number
        FROM payment_contribution pc
        LEFT JOIN payment pm ON pm.id = pc.payment_id
        LEFT JOIN benefit_claimed bc ON bc.id = pc.benefit_claimed_id
        LEFT JOIN claim cl ON cl.id = bc.claim_id
        WHERE cl.business_type = 'Group' AND pm.status = 'Processed'
          AND pm.release <= {E}""",
    "rollup": """
        SELECT benefit_claimed_name,
               CASE WHEN count(amount) = count(*)
                    THEN CASE WHEN bool_or(isnan(amount)) THEN CAST('NaN' AS DOUBLE)
                              ELSE CAST(sum(CASE WHEN NOT isnan(amount) THEN CAST(
                                       CAST(amount AS VARCHAR) AS DECIMAL(28,8)) END) AS DOUBLE)
                         END END AS total_paid,
               CASE WHEN count(coalesce(start, release)) = count(*)
                    THEN min(coalesce(start, release)) END AS first_payment,
               CASE WHEN count(coalesce(through, release)) = count(*)
                    THEN max(coalesce(through, release)) END AS last_payment,
               CASE WHEN count(release) = count(*)
                    THEN max(CASE WHEN rn = 1 THEN amount END) END AS last_amount,
               CASE WHEN count(release) = count(*) THEN max(release) END
                   AS eff_date_last_payment
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY benefit_claimed_name
                  ORDER BY release DESC, line_number ASC NULLS LAST, amount ASC NULLS LAST) AS rn
              FROM payments)
        GROUP BY benefit_claimed_name""",
    "dx": """
        SELECT d.name, d.medical_code, d.description, d.duration_factor, d.type,
               cl.name AS claim_name, d.start, d.created
        FROM diagnosis d
        LEFT JOIN journal j ON j.id = d.journal_id
        LEFT JOIN claim cl ON cl.id = j.claim_id
        WHERE d.type IN ('Primary', 'Cause of Death') AND cl.business_type = 'Group'""",
    "latest": """
        SELECT claim_name, medical_code, description, duration_factor
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY claim_name
                  ORDER BY coalesce(start, created) DESC, name ASC NULLS LAST) AS rn
              FROM dx WHERE coalesce(start, created) IS NOT NULL)
        WHERE rn = 1""",
    "ocr_base": f"""
        SELECT bc.product_name, sc.number AS scheme_number, sc.name AS scheme_name,
               org.name AS organisation, po.legacy_member_number, po.name AS policy_name,
               po.member_number, po.pas_member_id, ct.first_name, ct.last_name, ct.birthdate,
               po.date_joined_fund, b.category AS benefit_category, ct.gender,
               bc.date_of_disability, bc.waiting_period, bc.waiting_period_extension,
               bc.waiting_units, bc.coverage_amount, bc.benefit_status_recorded, bc.status,
               bc.closed_reason, cl.status AS claim_status, ow.name AS claim_owner,
               bc.notification_date, bc.benefit_period, bc.indexation_date, bc.reopened,
               bc.expected_closure, mb.name AS last_modified_by, bc.end_of_benefit_period,
               bc.name, cl.name AS claim_name, bc.reopened_reason, bc.closure_date,
               bc.reopened_date, b.name AS benefit_name, bc.date_of_reoccurrence,
               cl.team AS claim_team
        FROM benefit_claimed bc
        LEFT JOIN claim cl ON cl.id = bc.claim_id
        LEFT JOIN policy po ON po.id = cl.policy_id
        LEFT JOIN scheme sc ON sc.id = po.scheme_id
        LEFT JOIN organisation org ON org.id = sc.organisation_id
        LEFT JOIN claimant ct ON ct.id = cl.claimant_id
        LEFT JOIN crm_user ow ON ow.id = cl.owner_id
        LEFT JOIN benefit b ON b.id = bc.benefit_id
        LEFT JOIN crm_user mb ON mb.id = bc.modified_by_id
        WHERE cl.business_type = 'Group'
          AND cl.claim_type IN ('Claim', 'Post Claim')
          AND cl.status IS DISTINCT FROM 'Incomplete'
          AND bc.status IS DISTINCT FROM 'Suspended'
          AND (cl.form_received <= {E} OR bc.initial_under_assessment <= {E}
               OR bc.notification_date <= {E})
          AND (bc.closed_reason IS NULL OR bc.closed_reason = ''
               OR bc.closed_reason NOT IN {_REASONS})""",
    "ocr_typed": """
        SELECT *, date_of_disability AS date_incurred,
               waiting_period + waiting_period_extension AS waiting_period_total,
               coalesce(claim_name, 'NA') || '-' || coalesce(CAST(date_of_disability AS VARCHAR), 'NA')
                   || '-' || coalesce(benefit_category, 'NA') AS sc_key
        FROM ocr_base""",
    "ocr_open": f"""
        SELECT * FROM ocr_typed
        WHERE status <> 'Closed' OR closure_date IS NULL OR closure_date > {E}""",
    "ocr_clean": """
        SELECT o.*, r.total_paid, r.first_payment, r.last_payment, r.last_amount,
               r.eff_date_last_payment, l.medical_code, l.description, l.duration_factor
        FROM ocr_open o
        LEFT JOIN rollup r ON o.name IS NOT DISTINCT FROM r.benefit_claimed_name
        LEFT JOIN latest l ON o.claim_name IS NOT DISTINCT FROM l.claim_name""",
    "folded": f"""
        SELECT p.*, s.benefit_sc, s.total_paid_sc, a.benefit_sc_add, a.total_paid_sc_add,
               d.benefit_add, d.total_paid_add
        FROM (SELECT * FROM ocr_clean WHERE {PRIMARY}) p
        LEFT JOIN (SELECT sc_key, coverage_amount AS benefit_sc, total_paid AS total_paid_sc
                   FROM ocr_clean WHERE {SC}) s ON s.sc_key = p.sc_key
        LEFT JOIN (SELECT sc_key, coverage_amount AS benefit_sc_add,
                          total_paid AS total_paid_sc_add
                   FROM ocr_clean WHERE {SCADD}) a ON a.sc_key = p.sc_key
        LEFT JOIN (SELECT sc_key, coverage_amount AS benefit_add, total_paid AS total_paid_add
                   FROM ocr_clean WHERE {ADD}) d ON d.sc_key = p.sc_key""",
    "sc_open": f"""
        SELECT c.*, r.benefit_sc, r.total_paid_sc
        FROM (SELECT * FROM ocr_clean WHERE {SC}) c
        LEFT JOIN (SELECT sc_key, coverage_amount AS benefit_sc, total_paid AS total_paid_sc
                   FROM ocr_clean WHERE NOT {SC}) r ON r.sc_key = c.sc_key""",
    "add_open": f"""
        SELECT c.*, r.benefit_sc_add, r.total_paid_sc_add
        FROM (SELECT * FROM ocr_clean WHERE {SCADD}) c
        LEFT JOIN (SELECT sc_key, coverage_amount AS benefit_sc_add,
                          total_paid AS total_paid_sc_add
                   FROM ocr_clean WHERE NOT {SCADD}) r ON r.sc_key = c.sc_key""",
    "sc_add_open": f"""
        SELECT c.*, r.benefit_add, r.total_paid_add
        FROM (SELECT * FROM ocr_clean WHERE {ADD_ANY}) c
        LEFT JOIN (SELECT sc_key, coverage_amount AS benefit_add, total_paid AS total_paid_add
                   FROM ocr_clean WHERE NOT {ADD}) r ON r.sc_key = c.sc_key""",
    "orphans": f"""
        SELECT m.* FROM (
            SELECT * FROM sc_open
            UNION ALL BY NAME SELECT * FROM add_open
            UNION ALL BY NAME SELECT * FROM sc_add_open) m
        WHERE NOT EXISTS (SELECT 1 FROM ocr_clean p
                          WHERE {PRIMARY.replace('benefit_name', 'p.benefit_name')}
                            AND p.claim_name IS NOT DISTINCT FROM m.claim_name)""",
    "combined": """
        SELECT * FROM folded UNION ALL BY NAME SELECT * FROM orphans""",
    "measured1": f"""
        SELECT * REPLACE (benefit_sc * CAST({IP} AS INTEGER) AS benefit_sc) FROM combined""",
    "measured2": f"""
        SELECT *, coverage_amount AS sum_insured,
               (coverage_amount + coalesce(benefit_add, 0) + coalesce(benefit_sc, 0)
                + coalesce(benefit_sc_add, 0)) * (CASE WHEN {IP} THEN 12 ELSE 1 END)
                   AS sum_insured_combined
        FROM measured1""",
    "measured": f"""
        SELECT * REPLACE (total_paid + coalesce(total_paid_sc, 0) AS total_paid),
               coalesce(description, duration_factor, medical_code) AS source_of_claim,
               CASE WHEN {IP} THEN first_payment END AS gsc_start,
               CASE WHEN {IP} THEN last_payment END AS gsc_end,
               CASE WHEN {IP} THEN CAST(date_diff('day', first_payment, last_payment) AS DOUBLE)
                    END AS gsc_days,
               {E} AS report_run_date
        FROM measured2""",
    "acr_base": f"""
        SELECT bc.product_name, sc.number AS scheme_number, sc.name AS scheme_name,
               org.name AS organisation, po.legacy_member_number, po.name AS policy_name,
               po.member_number, po.pas_member_id, ct.first_name, ct.last_name, ct.birthdate,
               b.category AS benefit_category, ct.gender, bc.date_of_disability,
               bc.waiting_period, bc.waiting_units, bc.coverage_amount, bc.notification_date,
               bc.benefit_period, bc.expected_closure, bc.end_of_benefit_period,
               bc.closure_date, po.in_super, cl.name AS claim_name, b.name AS benefit_name,
               pc.name AS contribution_name, pc.amount, pc.start, pc.through,
               pm.start AS payment_start, pm.release AS payment_release,
               pm.status AS payment_status, pm.pas_reference AS payment_pas_reference
        FROM payment_contribution pc
        LEFT JOIN payment pm ON pm.id = pc.payment_id
        LEFT JOIN benefit_claimed bc ON bc.id = pc.benefit_claimed_id
        LEFT JOIN claim cl ON cl.id = bc.claim_id
        LEFT JOIN policy po ON po.id = cl.policy_id
        LEFT JOIN scheme sc ON sc.id = po.scheme_id
        LEFT JOIN organisation org ON org.id = sc.organisation_id
        LEFT JOIN claimant ct ON ct.id = cl.claimant_id
        LEFT JOIN benefit b ON b.id = bc.benefit_id
        WHERE cl.business_type = 'Group'
          AND cl.claim_type IN ('Claim', 'Post Claim')
          AND cl.status IS DISTINCT FROM 'Incomplete'
          AND pm.release >= {S}""",
    "acr_frame": f"""
        SELECT a.* REPLACE (CAST(a.date_of_disability AS VARCHAR) AS date_of_disability,
                            CAST(a.payment_release AS VARCHAR) AS payment_release,
                            CAST(a.start AS VARCHAR) AS start,
                            CAST(a.through AS VARCHAR) AS through,
                            CAST(a.closure_date AS VARCHAR) AS closure_date),
               l.medical_code, l.description, l.duration_factor,
               a.coverage_amount * (CASE WHEN {IP.replace('benefit_name', 'a.benefit_name')}
                                         THEN 12 ELSE 1 END) AS annual_sum_insured,
               coalesce(l.description, l.duration_factor, l.medical_code) AS source_of_claim,
               CAST(a.date_of_disability AS VARCHAR) AS date_incurred
        FROM acr_base a
        LEFT JOIN latest l ON a.claim_name IS NOT DISTINCT FROM l.claim_name""",
    "numbered_pc": "SELECT row_number() OVER () AS rowid_, * FROM payment_contribution",
    "keyed": f"""
        SELECT sc_key, count(*) FILTER ({SC}) AS sc, count(*) FILTER ({SCADD}) AS a, count(*) FILTER ({ADD}) AS d
        FROM ocr_clean GROUP BY sc_key""",
    "typed_text": """
        SELECT name AS contribution_name, line_number,
               CASE WHEN amount IS NULL THEN NULL
                    WHEN k % 7 = 0 THEN 'abc' WHEN k % 7 = 1 THEN '' WHEN k % 7 = 2 THEN '12d'
                    WHEN k % 7 = 3 THEN 'NaN' WHEN k % 7 = 4 THEN ' 1.5e3 '
                    WHEN NOT isnan(amount)
                    THEN CAST(CAST(CAST(amount AS VARCHAR) AS DECIMAL(28,2)) AS VARCHAR) END
                   AS amount_text,
               CASE (k + line_number) % 6
                    WHEN 0 THEN strftime(release, '%Y-%m-%d')
                    WHEN 1 THEN strftime(release, '%Y/%m/%d')
                    WHEN 2 THEN strftime(release, '%Y%m%d')
                    WHEN 3 THEN strftime(release, '%Y-%m-%d') || 'T23:30:00.000Z'
                    WHEN 4 THEN 'junk' END AS release_text
        FROM (SELECT pc.name, pc.line_number, pc.amount, pm.release,
                     CAST(pc.benefit_claimed_id AS BIGINT) AS k
              FROM payment_contribution pc LEFT JOIN payment pm ON pm.id = pc.payment_id)""",
}


def _sql(select: str, *ctes: str) -> str:
    return with_entities(*[(c, CTE[c]) for c in ctes], select=select)


_ROLLUP = ("payments", "rollup")
_LATEST = ("dx", "latest")
_OCR_CLEAN = (*_ROLLUP, *_LATEST, "ocr_base", "ocr_typed", "ocr_open", "ocr_clean")
_OCR_ALL = (*_OCR_CLEAN, "folded", "sc_open", "add_open", "sc_add_open", "orphans", "combined",
            "measured1", "measured2", "measured")
_ACR = (*_LATEST, "acr_base", "acr_frame")

_OCR_SELECT = ", ".join(f"{src} AS {_q(out)}" for out, src in OCR_COLUMNS)
_ACR_SELECT = ", ".join(f"{src} AS {_q(out)}" for out, src in ACR_COLUMNS)

_DATE_PARSE = """
    CASE WHEN regexp_matches(release_text, '^[0-9]{4}-[0-9]{2}-[0-9]{2}')
              THEN TRY_CAST(left(release_text, 10) AS DATE)
         WHEN regexp_matches(release_text, '^[0-9]{4}/[0-9]{2}/[0-9]{2}')
              THEN CAST(try_strptime(left(release_text, 10), '%Y/%m/%d') AS DATE)
         WHEN regexp_matches(release_text, '^[0-9]{8}$')
              THEN CAST(try_strptime(release_text, '%Y%m%d') AS DATE) END"""

_SUPP = ("benefit_sc, total_paid_sc, benefit_sc_add, total_paid_sc_add, benefit_add, "
         "total_paid_add")


_NUMBER = "'[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?'"
_ALONE = "coalesce(benefit_sc, total_paid_sc, benefit_sc_add, total_paid_sc_add, benefit_add, total_paid_add) IS NULL"
# matches per left row, counted key by key
_FOLD = """(SELECT greatest(1, sc) * greatest(1, a) * greatest(1, d) AS n FROM ocr_clean p
            LEFT JOIN keyed k ON k.sc_key = p.sc_key WHERE """ + PRIMARY + ")"


def _audit_sql() -> str:
    no_orphan_claim = f"""NOT EXISTS (SELECT 1 FROM ocr_clean p WHERE {PRIMARY.replace('benefit_name', 'p.benefit_name')}
                          AND p.claim_name IS NOT DISTINCT FROM c.claim_name)"""
    branch = lambda left, right: (
        f"CASE WHEN {left.replace('benefit_name', 'c.benefit_name')} THEN greatest(1, (SELECT count(*) FROM ocr_clean r "
        f"WHERE r.sc_key = c.sc_key AND NOT {right.replace('benefit_name', 'r.benefit_name')})) ELSE 0 END")
    lone = f"""(SELECT {branch(SC, SC)} + {branch(SCADD, SCADD)} + {branch(ADD_ANY, ADD)} AS n FROM ocr_clean c
               WHERE ({SC} OR {SCADD} OR {ADD_ANY}) AND {no_orphan_claim})"""
    rows = [
        ("typed_casts", "rows", "SELECT count(*) FROM typed_text"),
        ("typed_casts", "amount_cast_nulls", f"""SELECT count(*) FROM typed_text WHERE trim(amount_text) <> ''
            AND NOT regexp_full_match(trim(amount_text), {_NUMBER})"""),
        ("typed_casts", "release_cast_nulls", f"""SELECT count(*) FROM typed_text WHERE trim(release_text) <> ''
            AND ({_DATE_PARSE}) IS NULL"""),
        ("payments_extract", "rows_in", "SELECT count(*) FROM payment_contribution"),
        ("payments_extract", "fan_out", """SELECT max(n) FROM (SELECT pc.rowid_, count(*) AS n FROM numbered_pc pc
            LEFT JOIN payment pm ON pm.id = pc.payment_id LEFT JOIN benefit_claimed bc ON bc.id = pc.benefit_claimed_id
            GROUP BY pc.rowid_)"""),
        ("payments_extract", "rows", "SELECT count(*) FROM payments"),
        ("payments_extract", "unmatched", """SELECT count(*) FROM payment_contribution pc
            LEFT JOIN payment pm ON pm.id = pc.payment_id LEFT JOIN benefit_claimed bc ON bc.id = pc.benefit_claimed_id
            WHERE pm.id IS NULL OR bc.id IS NULL"""),
        ("payments_extract", "cast_nulls", "SELECT 0"),
        ("payment_rollup", "rows", "SELECT count(*) FROM rollup"),
        ("acr_report", "rows_in", "SELECT count(*) FROM payment_contribution"),
        ("acr_report", "fan_out", """SELECT max(n) FROM (SELECT pc.rowid_, count(*) AS n FROM numbered_pc pc
            LEFT JOIN payment pm ON pm.id = pc.payment_id GROUP BY pc.rowid_)"""),
        ("acr_report", "rows", "SELECT count(*) FROM acr_frame"),
        ("acr_report", "no_diagnosis",
         "SELECT count(*) FROM acr_frame WHERE source_of_claim IS NULL"),
        ("benefit_claimed", "rows", "SELECT count(*) FROM benefit_claimed"),
        ("ocr_base", "rows", "SELECT count(*) FROM ocr_base"),
        ("ocr_base", "cast_nulls", "SELECT 0"),
        ("open_at", "rows", "SELECT count(*) FROM ocr_open"),
        ("ocr_with_payments", "rows_in", "SELECT count(*) FROM ocr_open"),
        ("ocr_with_payments", "fan_out", """SELECT max(n) FROM (SELECT count(*) AS n FROM rollup
            GROUP BY benefit_claimed_name)"""),
        ("ocr_with_payments", "rows", "SELECT count(*) FROM ocr_clean"),
        ("ocr_with_payments", "unmatched",
         "SELECT count(*) FROM ocr_clean WHERE eff_date_last_payment IS NULL"),
        ("diagnosis_extract", "rows_in", "SELECT count(*) FROM diagnosis"),
        ("diagnosis_extract", "fan_out", "SELECT max(n) FROM (SELECT count(*) AS n FROM journal GROUP BY id)"),
        ("diagnosis_extract", "rows", "SELECT count(*) FROM dx"),
        ("diagnosis_extract", "unmatched", """SELECT count(*) FROM diagnosis d LEFT JOIN journal j ON j.id = d.journal_id
            WHERE j.id IS NULL"""),
        ("diagnosis_extract", "cast_nulls", "SELECT 0"),
        ("latest_diagnosis", "rows", "SELECT count(*) FROM latest"),
        ("supplement_fold", "rows_in", f"SELECT count(*) FROM ocr_clean WHERE {PRIMARY}"),
        ("supplement_fold", "fan_out", f"SELECT max(n) FROM {_FOLD}"),
        ("supplement_fold", "rows", "SELECT count(*) FROM folded"),
        ("supplement_fold", "unmatched", f"SELECT count(*) FROM folded WHERE {_ALONE}"),
        ("orphan_supplements", "rows_in", f"SELECT count(*) FROM {lone}"),
        ("orphan_supplements", "fan_out", f"SELECT max(n) FROM {lone}"),
        ("orphan_supplements", "rows", "SELECT count(*) FROM orphans"),
        ("orphan_supplements", "unmatched", f"SELECT count(*) FROM orphans WHERE {_ALONE}"),
        ("ocr_report", "rows", "SELECT count(*) FROM measured"),
    ]
    body = "\nUNION ALL ".join(
        f"SELECT '{s}' AS stage, '{m}' AS metric, CAST(coalesce(({q}), 0) AS BIGINT) AS value"
        for s, m, q in rows)
    return _sql(body, *_OCR_ALL, "acr_base", "acr_frame", "typed_text", "numbered_pc", "keyed")


_REJECTS_SQL = [
    ("payment_contribution", "name", "amount",
     "CASE WHEN k % 7 = 0 THEN 'abc' WHEN k % 7 = 2 THEN '12d' WHEN k % 7 <> 1 AND isnan(amount) THEN 'NaN' END",
     "(SELECT *, CAST(benefit_claimed_id AS BIGINT) AS k FROM payment_contribution)"),
    ("payment_contribution", "name", "start", "CASE WHEN (k + line_number) % 11 = 0 THEN '2020-13-45' END",
     "(SELECT *, CAST(benefit_claimed_id AS BIGINT) AS k FROM payment_contribution)"),
    ("payment", "id", "release", "CASE day(release) WHEN 7 THEN 'junk' WHEN 9 THEN strftime(release, '%d/%m/%Y') END", "payment"),
    ("benefit_claimed", "id", "coverage_amount", "CASE WHEN CAST(id AS BIGINT) % 17 = 3 THEN '1,000.00' END", "benefit_claimed"),
    ("benefit_claimed", "id", "closure_date", "CASE WHEN CAST(id AS BIGINT) % 19 = 4 THEN 'open' END", "benefit_claimed"),
]


_BROKEN = {
    "payment_contribution": """(SELECT * REPLACE (CASE line_number WHEN 6 THEN NULL WHEN 7 THEN 'X' || benefit_claimed_id
        ELSE benefit_claimed_id END AS benefit_claimed_id) FROM payment_contribution)""",
    "benefit_claimed": """(SELECT * REPLACE (CASE WHEN CAST(id AS BIGINT) % 31 = 3 THEN NULL
        WHEN CAST(id AS BIGINT) % 37 = 4 THEN 'nowhere' ELSE claim_id END AS claim_id) FROM benefit_claimed)""",
    "scheme": "(SELECT * FROM scheme WHERE CAST(id AS BIGINT) % 5 <> 2)",
    "policy": "(SELECT * FROM policy UNION ALL SELECT * FROM policy WHERE CAST(id AS BIGINT) % 40 = 7)",
    "payment": "(SELECT * FROM payment WHERE day(release) <> 13)",
    "user": "crm_user",
}


def _hops_sql() -> str:
    parts = []
    for child, relationships in RELATIONSHIPS.items():
        for rel, (fk, parent) in relationships.items():
            held = f"(SELECT id, count(*) AS m FROM {_BROKEN.get(parent, parent)} GROUP BY id)"
            parts.append(f"""
        SELECT '{child}' AS object, '{rel}' AS relationship, '{parent}' AS parent, count(*) AS rows,
               count(*) FILTER (c.{fk} IS NULL) AS null_keys,
               count(*) FILTER (c.{fk} IS NOT NULL AND p.id IS NULL) AS dangling_rows,
               count(DISTINCT CASE WHEN p.id IS NULL THEN c.{fk} END) AS dangling_keys,
               count(DISTINCT CASE WHEN m > 1 THEN c.{fk} END) AS ambiguous_keys
        FROM {_BROKEN.get(child, child)} c LEFT JOIN {held} p ON p.id = c.{fk}""")
    return with_entities(select="\nUNION ALL".join(parts))


ORACLE_SQL: dict[str, str] = {
    "hop_integrity": _hops_sql(),
    "relate_paths": with_entities(select="""
        SELECT pc.name AS contribution_name, pm.name AS payment_name, bc.name AS benefit_claimed_name,
               cl.name AS claim_name, po.name AS policy_name, sc.number AS scheme_number,
               org.name AS organisation, b.name AS benefit_name,
               ct.last_name AS claimant_last_name, ow.name AS claim_owner
        FROM payment_contribution pc
        LEFT JOIN payment pm ON pm.id = pc.payment_id
        LEFT JOIN benefit_claimed bc ON bc.id = pc.benefit_claimed_id
        LEFT JOIN claim cl ON cl.id = bc.claim_id
        LEFT JOIN policy po ON po.id = cl.policy_id
        LEFT JOIN scheme sc ON sc.id = po.scheme_id
        LEFT JOIN organisation org ON org.id = sc.organisation_id
        LEFT JOIN claimant ct ON ct.id = cl.claimant_id
        LEFT JOIN crm_user ow ON ow.id = cl.owner_id
        LEFT JOIN benefit b ON b.id = bc.benefit_id"""),
    "payments_extract": _sql("SELECT * FROM payments", "payments"),
    "diagnosis_extract": _sql("SELECT * FROM dx", "dx"),
    "ocr_base": _sql("SELECT * FROM ocr_base", "ocr_base"),
    "acr_base": _sql("SELECT * FROM acr_base", "acr_base"),
    "typed_casts": _sql(f"""
        SELECT contribution_name, line_number, amount_text,
               CASE WHEN regexp_full_match(trim(amount_text), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
                    THEN TRY_CAST(trim(amount_text) AS DOUBLE) END AS amount, release_text,
               {_DATE_PARSE} AS release
        FROM typed_text""", "typed_text"),
    "prior_month_end": with_entities(select="""
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
               last_day(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH) AS prior_month_end
        FROM orders"""),
    "reported_by": with_entities(select=f"""
        SELECT bc.name, cl.form_received, bc.initial_under_assessment, bc.notification_date
        FROM benefit_claimed bc LEFT JOIN claim cl ON cl.id = bc.claim_id
        WHERE cl.form_received <= {E} OR bc.initial_under_assessment <= {E}
              OR bc.notification_date <= {E}"""),
    "closed_reason": with_entities(select=f"""
        SELECT name, closed_reason FROM benefit_claimed
        WHERE closed_reason IS NULL OR closed_reason = ''
              OR closed_reason NOT IN {_REASONS}"""),
    "open_at": _sql("SELECT name, status, closure_date FROM ocr_open",
                    "ocr_base", "ocr_typed", "ocr_open"),
    "benefit_class": with_entities(select=f"""
        SELECT name, benefit_name,
               {PRIMARY} AS is_primary, {SC} AS is_super_contribution,
               {SCADD} AS is_additional_super_contribution, {ADD} AS is_additional_benefit,
               {ADD_ANY} AS starts_additional, {IP} AS is_income_protection,
               CASE WHEN coalesce(benefit_name LIKE '%Additional%', false)
                    THEN 'add' ELSE 'nonadd' END AS add_aux
        FROM (SELECT bc.name, b.name AS benefit_name FROM benefit_claimed bc
              LEFT JOIN benefit b ON b.id = bc.benefit_id)"""),
    "merge_key": _sql("SELECT name, sc_key FROM ocr_typed", "ocr_base", "ocr_typed"),
    "payment_rollup": _sql("SELECT * FROM rollup", *_ROLLUP),
    "payment_rollup_months": _sql("SELECT * FROM rollup", *_ROLLUP),
    "ocr_with_payments": _sql("""
        SELECT name, total_paid, first_payment, last_payment, last_amount,
               eff_date_last_payment FROM ocr_clean""", *_OCR_CLEAN),
    "latest_diagnosis": _sql("SELECT * FROM latest", *_LATEST),
    "latest_diagnosis_join": _sql("""
        SELECT contribution_name, claim_name, medical_code, description, duration_factor
        FROM acr_frame""", *_ACR),
    "source_of_claim": _sql("SELECT contribution_name, source_of_claim FROM acr_frame", *_ACR),
    "waiting_total": _sql("""
        SELECT name, waiting_period, waiting_period_extension, waiting_period_total
        FROM ocr_typed""", "ocr_base", "ocr_typed"),
    "annual_sum_insured": _sql("""
        SELECT contribution_name, benefit_name, coverage_amount, annual_sum_insured
        FROM acr_frame""", *_ACR),
    "supplement_fold": _sql(f"SELECT name, sc_key, {_SUPP} FROM folded",
                            *_OCR_CLEAN, "folded"),
    "orphan_supplements": _sql(f"""
        SELECT name, sc_key, claim_name, benefit_name, {_SUPP} FROM orphans""",
                               *_OCR_CLEAN, "sc_open", "add_open", "sc_add_open", "orphans"),
    "sum_insured": _sql("""
        SELECT name, benefit_name, sum_insured, benefit_sc, sum_insured_combined
        FROM measured""", *_OCR_ALL),
    "total_payg": _sql("SELECT name, total_paid AS total_payg FROM measured", *_OCR_ALL),
    "gsc_days": _sql("SELECT name, gsc_start, gsc_end, gsc_days FROM measured", *_OCR_ALL),
    "stage_audit": _audit_sql(),
    "cast_rejects": with_entities(select="\nUNION ALL ".join(
        f"""SELECT '{o}' AS object, {key} AS id, '{c}' AS "column", raw FROM (SELECT *, {raw} AS raw FROM {source}) WHERE raw IS NOT NULL"""
        for o, key, c, raw, source in _REJECTS_SQL)),
    "csv_roundtrip": _sql(f"SELECT {_ACR_SELECT} FROM acr_frame", *_ACR),
    "acr_report": _sql(f"SELECT {_ACR_SELECT} FROM acr_frame", *_ACR),
    "ocr_report": _sql(f"SELECT {_OCR_SELECT} FROM measured", *_OCR_ALL),
}
