"""End-to-end on hand-made objects: expected report values worked out by hand."""

from claimflow.plans.acr import acr_report
from claimflow.plans.ocr import ocr_report
from helpers import D, make_tables

REP_START, REP_END = D("2020-01-01"), D("2020-12-31")


def _tables(spark):
    bc = dict(claim_id=1, notification_date=D("2020-03-01"), waiting_period=30.0,
              waiting_period_extension=15.0, date_of_disability=D("2020-01-01"),
              modified_by_id=7)
    return make_tables(
        spark,
        organisation=[{"id": 1, "name": "Org A"}],
        scheme=[{"id": 1, "number": "S1", "name": "Scheme One", "organisation_id": 1}],
        policy=[{"id": 1, "name": "POL1", "scheme_id": 1, "in_super": "Yes"}],
        claimant=[{"id": 1, "first_name": "Ann", "last_name": "Lee", "gender": "Female"}],
        user=[{"id": 7, "name": "Assessor"}],
        claim=[{"id": 1, "name": "CASE-1", "status": "Open", "claim_type": "Claim",
                "business_type": "Group", "policy_id": 1, "claimant_id": 1, "owner_id": 7},
               {"id": 2, "name": "CASE-2", "status": None, "claim_type": "Post Claim",
                "business_type": "Group", "policy_id": 1, "claimant_id": 1},
               {"id": 3, "name": "CASE-3", "status": "Open", "claim_type": "Claim",
                "business_type": "Retail", "policy_id": 1, "claimant_id": 1}],
        benefit=[{"id": "IP", "name": "Income Protection", "category": "GS"},
                 {"id": "SC", "name": "Super Contribution", "category": "GS"},
                 {"id": "ASC", "name": "Additional Super Contribution", "category": "GS"}],
        benefit_claimed=[
            {**bc, "id": 10, "name": "BC10", "benefit_id": "IP", "status": "Open",
             "coverage_amount": 1000.0},
            {**bc, "id": 11, "name": "BC11", "benefit_id": "SC", "status": "Open",
             "coverage_amount": 100.0},
            # closed before period end: not open
            {**bc, "id": 12, "name": "BC12", "benefit_id": "IP", "status": "Closed",
             "closure_date": D("2020-06-30"), "coverage_amount": 5.0},
            # claim 2: only an Additional Super Contribution (orphan, enters twice)
            {**bc, "id": 20, "name": "BC20", "claim_id": 2, "benefit_id": "ASC",
             "status": "Open", "coverage_amount": 50.0},
            # retail claim: out of scope
            {**bc, "id": 30, "name": "BC30", "claim_id": 3, "benefit_id": "IP",
             "status": "Open", "coverage_amount": 9.0},
        ],
        payment_contribution=[
            {"name": "PC1", "line_number": 1, "amount": 10.0, "start": D("2020-02-01"),
             "through": D("2020-02-29"), "benefit_claimed_id": 10,
             "payment_release": D("2020-03-05"), "payment_status": "Processed",
             "payment_release_month": D("2020-03-01")},
            {"name": "PC2", "line_number": 2, "amount": 20.0, "start": D("2020-03-01"),
             "through": None, "benefit_claimed_id": 10,
             "payment_release": D("2020-04-05"), "payment_status": "Processed",
             "payment_release_month": D("2020-04-01")},
            {"name": "PC3", "line_number": 1, "amount": 4.0, "start": None, "through": None,
             "benefit_claimed_id": 11, "payment_release": D("2020-04-05"),
             "payment_status": "Processed", "payment_release_month": D("2020-04-01")},
            # pending: not in the rollup, but in the payments report
            {"name": "PC4", "line_number": 1, "amount": 99.0, "benefit_claimed_id": 10,
             "payment_release": D("2020-05-05"), "payment_status": "Pending",
             "payment_release_month": D("2020-05-01")},
            # released before the period start: not in the payments report
            {"name": "PC5", "line_number": 1, "amount": 7.0, "benefit_claimed_id": 10,
             "payment_release": D("2019-12-05"), "payment_status": "Processed",
             "payment_release_month": D("2019-12-01")},
        ],
        journal=[{"id": 1, "claim_id": 1}],
        diagnosis=[
            {"name": "DX1", "medical_code": "M54", "description": None,
             "duration_factor": "Long", "type": "Primary", "start": D("2020-02-01"),
             "created": D("2020-02-02"), "journal_id": 1},
            {"name": "DX2", "medical_code": "F32", "description": "Depression",
             "type": "Secondary", "start": D("2020-05-01"), "journal_id": 1},
        ],
    )


def test_open_claims_report_by_hand(spark):
    rows = {}
    for r in ocr_report(_tables(spark), REP_END).collect():
        rows.setdefault(r["BC"], []).append(r.asDict())
    assert set(rows) == {"BC10", "BC20"}          # BC11 folded, BC12 closed, BC30 retail
    ip = rows["BC10"][0]
    assert ip["BenefitSC"] == 100.0                  # SC cover counts on an IP row
    assert ip["Sum Insured Combined"] == (1000.0 + 100.0) * 12
    assert ip["Total PAYG"] == (10.0 + 20.0 + 7.0) + 4.0   # own processed + SC payments
    assert ip["Total Claim Start Day (GSC)"] == D("2019-12-05")  # PC5: no start -> release
    assert ip["Total Claim End Day (GSC)"] == D("2020-04-05")    # PC2: no through -> release
    assert ip["No. of Days on Claim (GSC)"] == 122.0
    assert ip["Effective Date of Latest Payment"] == D("2020-04-05")
    assert ip["Latest payment amount"] == 20.0
    assert ip["Source of Claim"] == "Long" and ip["ICD10"] == "M54"  # Primary only
    assert ip["Waiting Period Total"] == 45.0 and ip["Case Status"] == "Open"
    assert ip["Organisation"] == "Org A" and ip["Claim Assessor"] == "Assessor"
    assert ip["report run date"] == REP_END and ip["Date Received"] == D("2020-03-01")
    orphan = sorted(r["Sum Insured Combined"] for r in rows["BC20"])
    assert orphan == [50.0, 100.0]                    # two branches, one self-match
    assert all(r["Case Status"] is None for r in rows["BC20"])   # missing status kept


def test_payments_report_by_hand(spark):
    got = {r["Payment Contribution"]: r.asDict()
           for r in acr_report(_tables(spark), REP_START, REP_END).collect()}
    assert set(got) == {"PC1", "PC2", "PC3", "PC4"}  # PC5 released before the start
    assert got["PC1"]["Annual Sum Insured"] == 12000.0
    assert got["PC3"]["Annual Sum Insured"] == 100.0
    assert got["PC4"]["Payment Status"] == "Pending"  # no status filter in this report
    assert got["PC2"]["Payment End"] is None and got["PC1"]["Payment Start"] == "2020-02-01"
    assert got["PC1"]["Date Incurred"] == "2020-01-01"   # left as text
    assert got["PC1"]["Source of Claim"] == "Long" and got["PC1"]["Super/Non Super"] == "Yes"
