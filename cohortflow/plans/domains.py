"""Domain configuration: fields, keys, codes and patterns. Data only."""

from __future__ import annotations

from dataclasses import dataclass

# Measure codes and description patterns.
OBSERVATION_CODES = {
    "bmi": "39156-5",
    "systolic_bp": "8480-6",
    "diastolic_bp": "8462-4",
    "hba1c": "4548-4",
    "glucose": "2339-0",
    "creatinine": "38483-4",
    "egfr": "33914-3",
}
HIGH_RISK_MEDICATION_PATTERN = (
    "insulin|warfarin|heparin|fentanyl|morphine|oxycodone|hydrocodone|"
    "prednisone|amiodarone|clopidogrel|nitroglycerin|cisplatin"
)
ANTIMICROBIAL_PATTERN = "amoxicillin|azithromycin|ciprofloxacin|doxycycline|clindamycin"
MAJOR_PROCEDURE_PATTERN = (
    "surgery|replacement|repair|insertion|removal|biopsy|dialysis|catheter|ventilation"
)
CHRONIC_CAREPLAN_PATTERN = "diabetes|respiratory|smoking|diet|exercise|therapy"
SEVERE_ALLERGY_PATTERN = "peanut|shellfish|bee|drug|latex"
PREVENTIVE_IMMUNIZATION_PATTERN = "influenza|pneumococcal|td|dtap|hepatitis|hep b"


@dataclass(frozen=True)
class Domain:
    """Fields a record must carry, the fields that identify it, and its log partitions."""

    required: tuple[str, ...]
    natural_key: tuple[str, ...]
    date_column: str
    partitions: int = 1

    def __post_init__(self):
        if not self.natural_key:
            raise ValueError("a domain needs natural key fields")


# Required fields and natural keys per domain.
DOMAINS = {
    "encounters": Domain(("ID", "PATIENT", "DATE"), ("ID",), "DATE", 4),
    "patients": Domain(("ID", "BIRTHDATE"), ("ID",), "BIRTHDATE", 2),
    "conditions": Domain(
        ("PATIENT", "ENCOUNTER", "DESCRIPTION", "START"),
        ("PATIENT", "ENCOUNTER", "CODE", "START"),
        "START",
        3,
    ),
    "medications": Domain(
        ("PATIENT", "DESCRIPTION", "START"),
        ("PATIENT", "ENCOUNTER", "CODE", "START"),
        "START",
        3,
    ),
    "observations": Domain(
        ("PATIENT", "ENCOUNTER", "DESCRIPTION", "DATE"),
        ("PATIENT", "ENCOUNTER", "CODE", "DATE"),
        "DATE",
        4,
    ),
    "procedures": Domain(
        ("PATIENT", "ENCOUNTER", "DESCRIPTION", "DATE"),
        ("PATIENT", "ENCOUNTER", "CODE", "DATE"),
        "DATE",
        2,
    ),
    "careplans": Domain(("PATIENT", "ENCOUNTER", "DESCRIPTION", "START"), ("ID",), "START", 2),
    "allergies": Domain(
        ("PATIENT", "DESCRIPTION", "START"), ("PATIENT", "CODE", "START"), "START"
    ),
    "immunizations": Domain(
        ("PATIENT", "DESCRIPTION", "DATE"), ("PATIENT", "CODE", "DATE"), "DATE", 2
    ),
}


def topics(prefix: str, dead_letters: str = "dlq") -> dict[str, int]:
    """Topic names and partition counts for all domains and the dead-letter topic."""
    return {f"{prefix}.{n}": d.partitions for n, d in DOMAINS.items()} | {
        f"{prefix}.{dead_letters}": 1
    }
