"""Golden values: the vote tally of FIXTURES.md section 2 and the f1 /
"""

import os

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from fundlens.operators.evaluate import accuracy, confusion, weighted_f1
from fundlens.operators.votes import vote_tally
from fundlens.session import shared_dir
from fundlens.sources.files import read_csv, write_table

# The golden tally, per column, count per sponsor (ascending).
GOLDEN_TALLY = {
    1: "CIL4SYS 1; UBISOFT 2; IDEMIA 4; SAFRAN 5; Airbus D&S 8; VEEPEE 9; ENGIE 11; IBM 14",
    2: "AXYS 1; Delta Dore 1; Karavel 1; VALEO 1; IBM 2; Ministère des Armées 3; Airbus D&S 4; "
       "SAFRAN 4; UBISOFT 4; ENGIE 5; TECNIP 5; IDEMIA 11; VEEPEE 12",
    3: "Delta Dore 1; BEARING POINT 2; TECNIP 2; AXYS 3; ENGIE 3; UBISOFT 3; Ministère des Armées 4; "
       "SAFRAN 4; VALEO 5; VEEPEE 5; IBM 6; IDEMIA 7; Airbus D&S 9",
    4: "BEARING POINT 1; CIL4SYS 1; TECNIP 1; VEEPEE 1; AXYS 2; SAFRAN 2; UBISOFT 2; "
       "Ministère des Armées 3; Karavel 4; Airbus D&S 5; ENGIE 6; IDEMIA 8; VALEO 8; IBM 10",
    5: "AXYS 1; GROUPE HN 1; TECNIP 1; Delta Dore 2; Ministère des Armées 2; SAFRAN 2; Airbus D&S 3; "
       "BEARING POINT 3; Karavel 3; UBISOFT 3; CIL4SYS 4; VEEPEE 4; IDEMIA 5; ENGIE 6; VALEO 6; IBM 8",
}


def _parse(text):
    out = []
    for item in text.split("; "):
        name, n = item.rsplit(" ", 1)
        out.append((name, int(n)))
    return out


def test_vote_tally_golden(spark, tmp_path):
    # 54 ballots whose columns have exactly the golden counts; written as a
    # CSV with the original header and read back with inferred types.
    columns = {k: [s for s, n in _parse(v) for _ in range(n)] for k, v in GOLDEN_TALLY.items()}
    assert {len(v) for v in columns.values()} == {54}
    path = os.path.join(tmp_path, "votes.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(",".join(f"Choix {k}" for k in range(1, 6)) + "\n")
        for row in zip(*(columns[k] for k in range(1, 6))):
            f.write(",".join(row) + "\n")
    df = read_csv(spark, path, infer_schema=True)
    assert df.count() == 54 and len(df.columns) == 5
    tally = vote_tally(df, [f"Choix {k}" for k in range(1, 6)]).collect()
    got = {}
    for r in tally:
        got.setdefault(r["choice_rank"], []).append((r["sponsor"], r["count"]))
    for k, v in GOLDEN_TALLY.items():
        assert got[k] == _parse(v), k


def test_single_file_sink(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id")
    path = write_table(df.groupBy("k").count(), shared_dir(spark, "single"), "csv", single_file=True)
    parts = [p for p in os.listdir(path) if p.startswith("part-")]
    assert len(parts) == 1
    with pytest.raises(Exception):  # default mode refuses an existing target
        write_table(df, path, "csv")


def _expand(spark, table):
    rows = [(float(lab), float(pred)) for (lab, pred), n in table.items() for _ in range(n)]
    return spark.createDataFrame(rows, "final_status double, predictions double")


@pytest.mark.parametrize("table,f1,acc", [
    ({(1, 0): 1049, (0, 1): 2899, (1, 1): 2361, (0, 0): 4493}, 0.647367360180229, 0.63451),
    ({(1, 0): 1003, (0, 1): 2740, (1, 1): 2427, (0, 0): 4623}, 0.6650475698419106, 0.65320),
])
def test_f1_accuracy_golden(spark, table, f1, acc):
    df = _expand(spark, table)
    ours = weighted_f1(df, "final_status", "predictions").first()["f1"]
    ml = MulticlassClassificationEvaluator(metricName="f1", labelCol="final_status",
                                           predictionCol="predictions").evaluate(df)
    assert ours == pytest.approx(f1, abs=1e-12)
    assert ml == pytest.approx(f1, abs=1e-12)
    got_acc = accuracy(df, "final_status", "predictions").first()["accuracy"]
    assert round(got_acc, 5) == acc
    conf = {(r[0], r[1]): r[2] for r in confusion(df, "final_status", "predictions").collect()}
    assert conf == {(float(a), float(b)): n for (a, b), n in table.items()}
