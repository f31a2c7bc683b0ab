"""The end-to-end job on a small loan-shaped delimited file (invented rows)."""

import os
import random

import pytest
from pyspark.sql import functions as F

from credere.plans.cleaning import clean_table, split_by_bucket, typed_table
from credere.plans.job import run_job
from credere.profile import LOAN
from credere.sources.delimited import read_delimited

_AGES = ["<25", "25-34", "35-44", "45-54", "55-64", "65-74", ">74", "NA"]


def _loan_file(path, n=600, seed=7):
    rnd = random.Random(seed)
    cols = ["activity_year"] + LOAN.names + ["debt_to_income_ratio"]
    lines = ["|".join(cols)]
    for i in range(n):
        income = rnd.choice(["", "NA", str(rnd.randint(20, 400))])
        approved = rnd.random() < 0.6
        row = {
            "activity_year": "2020", "lei": f"L{rnd.randint(1, 12):03d}", "loan_type": str(rnd.choice([1, 2, 3, 4])),
            "loan_purpose": str(rnd.choice([1, 2, 31, 32, 4])), "loan_amount": str(rnd.randint(50, 900) * 1000),
            "interest_rate": rnd.choice(["NA", "Exempt", f"{rnd.uniform(2, 7):.3f}"]),
            "loan_term": rnd.choice(["360", "180", "NA", "360.0"]), "action_taken": "1" if approved else "3",
            "income": income, "applicant_age": rnd.choice(_AGES), "applicant_sex": str(rnd.choice([1, 2, 4])),
            "applicant_credit_score_type": str(rnd.randint(1, 4)), "co_applicant_age": rnd.choice(_AGES + ["9999"]),
            "co_applicant_credit_score_type": str(rnd.randint(1, 4)), "derived_msa_md": str(rnd.randint(1, 30)),
            "state_code": rnd.choice(["CA", "TX", "NY", "NA"]), "county_code": rnd.choice(["06037", "48201", "NA"]),
            "property_value": rnd.choice(["0", str(rnd.randint(100, 900) * 1000)]),
            "total_units": rnd.choice(["1", "2", "5-24", "1"]), "occupancy_type": str(rnd.choice([1, 2, 3])),
            "debt_to_income_ratio": rnd.choice(["43%", ">60%", "NA"]),
        }
        lines.append("|".join(row[c] for c in cols))
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_job_end_to_end(spark, tmp_path):
    src = tmp_path / "loans.txt"
    _loan_file(src)
    out = str(tmp_path / "out")
    res = run_job(spark, str(src), out, models=("Logistic Regression", "Decision Tree"), tune=True,
                  grid={"maxDepth": [2, 3], "maxIter": [3]})
    for name in ("Logistic Regression", "Decision Tree"):
        assert 0.0 <= res["models"][name]["accuracy"] <= 1.0
    assert 0.0 <= res["tuned"]["areaUnderROC"] <= 1.0
    for sub in ("cleaned_dataset", "reports/census", "models/features/labels", "tracking/runs", "tuned_models/GBT"):
        assert os.path.isdir(os.path.join(out, sub)), sub
    cleaned = spark.read.parquet(os.path.join(out, "cleaned_dataset"))
    assert cleaned.filter("state_code = 'NA' OR county_code = 'NA' OR property_value = 0 OR total_units = 0").count() == 0
    assert set(r.action_taken for r in cleaned.select("action_taken").distinct().collect()) <= {0, 1}
    assert cleaned.filter("income IS NULL OR interest_rate IS NULL").count() == 0


def test_no_row_changes_sides_after_cleaning(spark, tmp_path):
    src = tmp_path / "loans.txt"
    _loan_file(src, n=900)
    raw = read_delimited(spark, str(src))
    typed = typed_table(raw, LOAN, bucket=True)
    assert typed.filter("split_bucket < 80").count() not in (0, 900)
    # a training side fitted on its own statistics: changing a held-out outcome or income moves nothing
    one = clean_table(raw, LOAN, fit_on="train", relative_error=0.0)
    moved = raw.withColumn("action_taken", F.lit("1"))
    two = clean_table(moved, LOAN, fit_on="train", relative_error=0.0)
    assert one.impute == two.impute
    kept = clean_table(raw, LOAN, bucket=True).df
    side = {r.split_bucket for r in kept.select("split_bucket").distinct().collect()} - {r.split_bucket for r in typed.select("split_bucket").distinct().collect()}
    train, test = split_by_bucket(kept)
    assert not side and train.count() + test.count() == kept.count() and "split_bucket" not in train.columns


def test_grid_below_the_arity_is_an_error(spark, tmp_path):
    src = tmp_path / "loans.txt"
    _loan_file(src)
    with pytest.raises(ValueError, match="derived_msa_md"):
        run_job(spark, str(src), str(tmp_path / "out"), models=(), tune=True, grid={"maxBins": [8, 64]})
