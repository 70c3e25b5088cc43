"""Thresholds and fixed vocabularies shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class OpsConfig:
    # Capacity, targets and thresholds.
    bed_capacity: int = 500
    random_state: int = 42
    high_risk_threshold: float = 0.65
    monitor_threshold: float = 0.35
    readmission_target: float = 0.10
    readmission_ceiling: float = 0.25
    collection_target: float = 0.70
    occupancy_target_pct: float = 80.0
    wait_ceiling_minutes: float = 90.0


CONFIG = OpsConfig()

# Lists whose order decides the derived dimension values.
DEPARTMENTS = (
    "Cardiology",
    "Emergency",
    "Orthopedics",
    "Neurology",
    "General Medicine",
    "Pediatrics",
    "Oncology",
    "Surgery",
)
MEDICINES = ("MET", "AML", "ATO", "PAN", "CEF", "INS", "PCM", "LOS")
GENDERS = ("Female", "Male", "Other")
DOCTORS_PER_DEPARTMENT = 5
DOCTOR_NAMES = (
    "Dr. A. Sharma",
    "Dr. R. Patel",
    "Dr. V. Kumar",
    "Dr. N. Singh",
    "Dr. P. Mehta",
    "Dr. S. Iyer",
    "Dr. K. Reddy",
    "Dr. M. Joshi",
    "Dr. T. Rao",
    "Dr. D. Gupta",
)
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
AGE_BANDS = ((18, "0-18"), (35, "19-35"), (50, "36-50"), (65, "51-65"), (120, "66+"))
BILLING_LABELS = ("Low", "Medium", "High", "Very High")
VALID_CLAIM_STATUSES = ("Paid", "Denied", "Pending")

GOVERNED_LINK = "governed_encounter_key"
SURROGATE_LINK = "deterministic_surrogate_no_shared_source_key"
