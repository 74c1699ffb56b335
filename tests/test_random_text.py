"""Result reading on random text, against the SQL statements."""

from __future__ import annotations

import random

import duckdb
import pytest

from cohortloom.operators.results import hepatitis_results, hiv_results
from cohortloom.rules.code_sets import HEPATITIS_CODES, HIV_CODES
from oracle.statements import results_of_table

from .helpers import by, day, labs

PIECES = (
    "NON", "REACTIVE", "NOT", "DETECTED", "Detected", "Target Not", "<", "<1", "<2", ">", "=", ",",
    ".", "1", "5", "15", "1a", "7b", "N", "R", "P", "n", "r", "p", "REPEATEDLY", "repeatedly",
    "Repeatedly", "CONFIRMATION", "LESS THAN", "GREATER THAN", "less than", "INVALID", "INDETER",
    "TNP", "EQ", "Invalid", " ", "  ", "\n", "$", "-", "+", "e", "E", "d", "NaN", "x", "É", "%",
    "_", "\\", "99999999999",
)
STATUSES = ("Completed", "Completed", "Completed", "Completed  ", "Canceled", "completed", None)


def some_text(rng: random.Random) -> str | None:
    if rng.random() < 0.1:
        return None
    return rng.choice(("", " ")).join(rng.choices(PIECES, k=rng.randint(0, 4)))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(20)
    codes = [c for sets in (HEPATITIS_CODES, HIV_CODES) for g in sets.values() for c in g] + [999]
    return [
        {
            "PAT_ID": i % 50,
            "ORDER_PROC_ID": i,
            "ORDER_INST": day("2020-01-01"),
            "SPECIMN_TAKEN_TIME": None,
            "RESULT_TIME": day("2020-01-02"),
            "COMPONENT_ID": rng.choice(codes),
            "ORD_VALUE": some_text(rng),
            "COMPONENT_COMMENT": some_text(rng),
            "ORDER_STATUS_NM": rng.choice(STATUSES),
            "COMPONENT_NM": None,
        }
        for i in range(20_000)
    ]


@pytest.mark.parametrize("kind, function", [("hcv", hepatitis_results), ("hiv", hiv_results)])
def test_random_text(spark, rows, tmp_path, kind, function):
    df = labs(spark, rows)
    df.write.parquet(str(tmp_path / "labs"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW labs AS SELECT * FROM '{tmp_path}/labs/*.parquet'")
    found = con.execute(results_of_table(kind))
    columns = [c[0] for c in found.description if c[0] != "COMPONENT_NM"]
    got = by(function(df), *columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({results_of_table(kind)})").fetchall()
    want = sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])
    assert len(want) > 1000
    assert {r[columns.index("TEST_RESULT")] for r in want} == {"Positive", "Negative", None}
    for g, w in zip(got, want, strict=True):
        assert g == w
