from millrace.operators.validation import accepted, check_records, quarantined


def test_valid_record_passes(records):
    row = check_records(records()).first()
    assert row.is_valid and row.failed_fields == []


def test_unknown_category_is_rejected(records):
    row = check_records(records({"contract_type": "not_a_real_contract"})).first()
    assert not row.is_valid and row.failed_fields == ["contract_type"]


def test_ranges_nulls_and_nan(records):
    bad = records(
        {"customer_id": "a", "tenure_months": -1},
        {"customer_id": "b", "tenure_months": 101},
        {"customer_id": "c", "monthly_charges": float("nan")},
        {"customer_id": "d", "total_charges": None, "partner": 2},
        {"customer_id": None},
        {"customer_id": "f", "tech_support": "yes"},
        {"customer_id": "g", "tenure_months": 100, "monthly_charges": 0.0},
    )
    failed = [r.failed_fields for r in check_records(bad).orderBy("customer_id").collect()]
    assert failed == [
        ["customer_id"],
        ["tenure_months"],
        ["tenure_months"],
        ["monthly_charges"],
        ["total_charges", "partner"],
        ["tech_support"],
        [],
    ]


def test_absent_column_fails_every_row(records):
    row = check_records(records(without=("partner",))).first()
    assert row.failed_fields == ["partner"]


def test_every_row_goes_one_way(records):
    checked = check_records(records({"customer_id": "a"}, {"customer_id": "b", "partner": 3}))
    assert [r.customer_id for r in accepted(checked).collect()] == ["a"]
    assert [r.customer_id for r in quarantined(checked).collect()] == ["b"]
