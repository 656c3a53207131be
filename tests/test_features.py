from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.cleaning import clean_customers
from millrace.functions.features import engineer_features, tenure_bucket, to_model_matrix


def test_derived_columns_exist(records):
    derived = {
        "tenure_bucket",
        "charges_per_tenure_month",
        "monthly_rate_deviation",
        "num_addon_services",
        "is_month_to_month",
        "high_value_customer",
        "internet_service_encoded",
        "payment_method_encoded",
    }
    assert derived <= set(engineer_features(records()).columns)


def test_derived_values_of_the_standard_record(records):
    row = engineer_features(records()).first()
    assert row.num_addon_services == 3
    assert row.is_month_to_month == 1
    assert row.high_value_customer == 1
    assert row.internet_service_encoded == 2
    assert row.payment_method_encoded == 1
    assert row.charges_per_tenure_month == 70.0
    assert row.monthly_rate_deviation == 14.0


def test_contract_and_charge_thresholds(records):
    rows = engineer_features(
        records(
            {"customer_id": "a", "contract_type": "two_year", "monthly_charges": 80.0},
            {"customer_id": "b", "contract_type": None, "monthly_charges": 80.01},
        )
    ).orderBy("customer_id").collect()
    assert [r.is_month_to_month for r in rows] == [0, 0]
    assert [r.high_value_customer for r in rows] == [0, 1]


def test_internet_and_payment_codes(records):
    values = ["none", "dsl", "fiber_optic", "satellite", None]
    rows = records(*({"customer_id": str(i), "internet_service": v} for i, v in enumerate(values)))
    coded = engineer_features(rows).orderBy("customer_id").collect()
    codes = [r.internet_service_encoded for r in coded]
    assert codes == [0, 1, 2, 0, 0]
    methods = ["electronic_check", "mailed_check", "bank_transfer", "credit_card", "cash", None]
    rows = records(*({"customer_id": str(i), "payment_method": v} for i, v in enumerate(methods)))
    coded = engineer_features(rows).orderBy("customer_id").collect()
    codes = [r.payment_method_encoded for r in coded]
    assert codes == [0, 1, 2, 3, -1, -1]


def test_buckets_are_closed_on_the_right(spark):
    months = [-1, 0, 6, 7, 12, 13, 24, 25, 48, 49, 10_000, 10_001]
    rows = spark.createDataFrame([(float(m),) for m in months], "tenure_months double")
    got = [r.b for r in rows.select("tenure_months", tenure_bucket().alias("b")).collect()]
    assert got == [None, 0, 0, 1, 1, 2, 2, 3, 3, 4, 4, None]


def test_matrix_has_only_model_columns_without_nulls(records):
    matrix = to_model_matrix(records())
    assert matrix.columns == schemas.MODEL_FEATURES
    assert None not in matrix.first()


def test_partial_input_is_filled(spark):
    partial = spark.createDataFrame([("C2", 10)], "customer_id string, tenure_months int")
    row = to_model_matrix(partial).first()
    assert None not in row
    assert (row.tenure_bucket, row.payment_method_encoded, row.total_charges) == (1, -1, 0.0)


def test_null_and_nan_numbers_read_as_zero(records):
    row = engineer_features(
        records({"monthly_charges": float("nan"), "total_charges": None, "partner": None})
    ).first()
    assert (row.monthly_charges, row.total_charges, row.partner) == (0.0, 0.0, 0)


def test_tenure_minus_one_gives_null_not_an_error(records):
    row = engineer_features(records({"tenure_months": -1})).first()
    assert row.tenure_bucket is None
    assert row.charges_per_tenure_month is None


def test_cleaning_blank_total_and_unknown_categories(spark):
    raw_types = schemas.RAW_CUSTOMER

    def raw(**changes):
        base = {
            "customerID": "1",
            "tenure": 0,
            "MonthlyCharges": 20.5,
            "TotalCharges": " ",
            "Contract": "Month-to-month",
            "PaymentMethod": "Credit card (automatic)",
            "InternetService": "No",
            "MultipleLines": "No phone service",
            "SeniorCitizen": 1,
            "Partner": "Yes",
            "Churn": None,
        }
        base.update(changes)
        return tuple(base.get(name, "No") for name in raw_types.names)

    rows = spark.createDataFrame(
        [raw(), raw(customerID="2", TotalCharges="12.5", Contract="Month to month", Churn="Yes")],
        raw_types,
    ).withColumn("gender", F.lit("x"))
    first, second = clean_customers(rows).orderBy("customer_id").collect()
    assert clean_customers(rows).columns == schemas.CUSTOMER_COLUMNS
    assert first.total_charges == 20.5
    assert (first.contract_type, first.payment_method, first.internet_service) == (
        "month_to_month",
        "credit_card",
        "none",
    )
    assert (first.multiple_lines, first.partner, first.dependents, first.churn) == (0, 1, 0, 0)
    assert (second.total_charges, second.contract_type, second.churn) == (12.5, None, 1)
