"""The hospital admissions model: raw extract, quality rules, star and expectations."""

from __future__ import annotations

from ledgerstar.contracts import Contract, Field
from ledgerstar.operators.quality import at_least_zero, present
from ledgerstar.operators.star import Attribute, Dimension, Star

# Names and types of the extract's fifteen columns, in file order.
RAW_ADMISSIONS = Contract(
    name="raw_admissions",
    fields=(
        Field("Name", "string"),
        Field("Age", "int"),
        Field("Gender", "string"),
        Field("Blood Type", "string"),
        Field("Medical Condition", "string"),
        Field("Date of Admission", "date"),
        Field("Doctor", "string"),
        Field("Hospital", "string"),
        Field("Insurance Provider", "string"),
        Field("Billing Amount", "double"),
        Field("Room Number", "int"),
        Field("Admission Type", "string"),
        Field("Discharge Date", "date"),
        Field("Medication", "string"),
        Field("Test Results", "string"),
    ),
)

INGESTED_ADMISSIONS = Contract(
    name="admissions",
    fields=(Field("row_hash", "string"), *RAW_ADMISSIONS.fields),
    key=("row_hash",),
)

BILLING_RULES = (
    present("Billing Amount", reason="missing"),
    at_least_zero("Billing Amount", reason="negative"),
)

# The star's table and column names.
ADMISSIONS_STAR = Star(
    fact="fact_admissions",
    fact_key="admission_id",
    members=(
        Attribute("patient_name", "string", "Name"),
        Attribute("age", "int", "Age"),
        Dimension("dim_gender", "gender_id", "gender", "Gender"),
        Dimension("dim_blood_type", "blood_type_id", "blood_type", "Blood Type"),
        Dimension("dim_medical_condition", "condition_id", "condition_name", "Medical Condition"),
        Attribute("date_of_admission", "date", "Date of Admission"),
        Attribute("doctor", "string", "Doctor"),
        Attribute("hospital", "string", "Hospital"),
        Dimension("dim_insurance_provider", "insurance_id", "provider_name", "Insurance Provider"),
        Attribute("billing_amount", "double", "Billing Amount"),
        Attribute("room_number", "int", "Room Number"),
        Dimension("dim_admission_type", "admission_type_id", "admission_type", "Admission Type"),
        Attribute("discharge_date", "date", "Discharge Date"),
        Attribute("medication", "string", "Medication"),
        Dimension("dim_test_results", "test_result_id", "test_result", "Test Results"),
    ),
)

# Member counts each dimension is expected to have.
EXPECTED_MEMBERS = {
    "dim_gender": 2,
    "dim_blood_type": 8,
    "dim_medical_condition": 6,
    "dim_insurance_provider": 5,
    "dim_admission_type": 3,
    "dim_test_results": 3,
}
