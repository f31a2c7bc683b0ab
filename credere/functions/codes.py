"""Fixed code tables: ordinal buckets, code-to-text decodes, input domains.

All maps are applied as JVM-side ``CASE``/map-literal expressions, so they
need no join and no Python at run time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the original job's for equal results.
# Applicant / co-applicant age text -> ordinal code (first match wins).
AGE_BUCKETS = [
    ("<25", 0),
    ("25-34", 1),
    ("35-44", 2),
    ("45-54", 3),
    ("55-64", 4),
    ("65-74", 5),
    (">74", 6),
    ("8888", 9),
    ("9999", 9),
]

# Debt-to-income text -> ordinal code (first match wins, anything else -> 20).
# "43%" appears twice; the second entry (17) can never match.
DTI_BUCKETS = [
    ("<20%", 0),
    ("20%-<30%", 1),
    ("30%-<36%", 2),
    ("36%", 3),
    ("37%", 4),
    ("38%", 5),
    ("39%", 6),
    ("40%", 7),
    ("41%", 8),
    ("42%", 9),
    ("43%", 10),
    ("44%", 11),
    ("45%", 12),
    ("46%", 13),
    ("47%", 14),
    ("48%", 15),
    ("49%", 16),
    ("43%", 17),
    ("50%-60%", 18),
    (">60%", 19),
]
DTI_OTHER = 20

# Code -> text shown by the scoring form.
LOAN_TYPE_TEXT = {1: "Conventional", 2: "FHA Insured", 3: "VA Guaranteed", 4: "RHS or FSA Guaranteed"}
LOAN_PURPOSE_TEXT = {1: "Home Purchase", 2: "Home Improvement", 31: "Refinancing",
                     32: "Cash-out Refinancing", 4: "Other Purpose"}
APPLICANT_SEX_TEXT = {1: "Male", 2: "Female", 4: "NA"}
OCCUPANCY_TEXT = {1: "Principal Residence", 2: "Second Residence", 3: "Investment Property"}

# Input domains of the scoring form: allowed sets and numeric ranges.
AGE_TEXT = ["<25", "25-34", "35-44", "45-54", "55-64", "65-74", ">74", "NA"]
LOAN_DOMAINS = {
    "loan_type": {"in": [1, 2, 3, 4]},
    "loan_purpose": {"in": [1, 2, 31, 32, 4]},
    "loan_amount": {"range": (0.0, 10000000.0)},
    "interest_rate": {"range": (0.0, 20.0)},
    "loan_term": {"range": (0, 480)},
    "income": {"range": (0.0, 1000000.0)},
    "applicant_age": {"in": AGE_TEXT},
    "applicant_sex": {"in": [1, 2, 4]},
    "applicant_credit_score_type": {"range": (1, 10)},
    "co_applicant_age": {"in": AGE_TEXT},
    "co_applicant_credit_score_type": {"range": (1, 10)},
    "derived_msa_md": {"range": (0, 100000)},
    "property_value": {"range": (0.0, 10000000.0)},
    "total_units": {"range": (1, 1000)},
    "occupancy_type": {"in": [1, 2, 3]},
}
# ---------------------------------------------------------------------------


def ordinal_bucket(c: Column | str, buckets, otherwise: Column | str | int | None = "keep") -> Column:
    """``CASE`` chain over (text, code) pairs; first match wins.

    ``otherwise="keep"`` keeps the input text (the age rule); any other value is
    used as the default code (the debt-to-income rule). All branches are text
    when the input is kept, so the result stays a string under ANSI and the
    caller decides the final type (``guarded_cast``).
    """
    c = F.col(c) if isinstance(c, str) else c
    keep = isinstance(otherwise, str) and otherwise == "keep"
    expr = None
    for text, code in buckets:
        value = F.lit(str(code)) if keep else F.lit(code)
        expr = F.when(c == F.lit(text), value) if expr is None else expr.when(c == F.lit(text), value)
    return expr.otherwise(c if keep else F.lit(otherwise))


def age_bucket(c: Column | str) -> Column:
    """Age text -> code text; unknown text (e.g. 'NA') is kept for a later int cast."""
    return ordinal_bucket(c, AGE_BUCKETS, "keep")


def dti_bucket(c: Column | str) -> Column:
    """Debt-to-income text -> 0..19, anything else and NULL -> 20."""
    return ordinal_bucket(c, DTI_BUCKETS, DTI_OTHER)


def decode(c: Column | str, mapping: dict, default: str | None = None) -> Column:
    """Code -> text through a literal map (no join, no Python)."""
    c = F.col(c) if isinstance(c, str) else c
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    looked = F.try_element_at(F.create_map(*pairs), c)
    return looked if default is None else F.coalesce(looked, F.lit(default))
