import random

import pytest

from riskmart.__main__ import FILES, main
from riskmart.operators import modeling
from riskmart.schemas import SOURCES
from riskmart.sources import store


@pytest.fixture(scope="module")
def data(tmp_path_factory):
    """Source files as text, with dirt, columns in an order of their own."""
    folder = tmp_path_factory.mktemp("data")
    rng = random.Random(2)
    months = ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"]
    for name, types in SOURCES.items():
        columns = sorted(types)
        lines = [",".join(columns)]
        for month in months:
            for i in range(60):
                row = {c: "" if rng.random() < 0.05 else f"{rng.randrange(1, 90)}{rng.choice(['', '_'])}" for c in columns}
                row |= {"Customer_ID": f"c{i}", "snapshot_date": month}
                if name == "loans":
                    row = {c: rng.randrange(1, 90) for c in columns} | {
                        "loan_id": f"l{i}", "Customer_ID": f"c{i}", "snapshot_date": month, "installment_num": 6,
                        "loan_start_date": "2023-07-01", "due_amt": 50, "overdue_amt": 40 if i % 3 else 0,
                    }
                if name == "clickstream":
                    row |= {f"fe_{k}": rng.randrange(-5, 200) for k in range(1, 21)}
                lines.append(",".join(str(row[c]) for c in columns))
        (folder / FILES[name]).write_text("\n".join(lines) + "\n")
    return folder


def test_jobs_end_to_end(spark, data, tmp_path, capsys, monkeypatch):
    monkeypatch.setitem(modeling.SEARCH_GRID, "maxIter", [2])
    root = str(tmp_path / "mart")
    main(["ingest", "--root", root, "--source", "loans", "--path", str(data / FILES["loans"]), "--snapshotdate", "2024-01-01"])
    assert "60" in capsys.readouterr().out
    main(["labels", "--root", root, "--data", str(data)])
    main(["features", "--root", root, "--data", str(data), "--start", "2024-01-01", "--end", "2024-04-01"])
    assert store.read_table(spark, f"{root}/gold/label_store").count() == 240
    # 4 click rows per customer, each with 4 static snapshots
    assert store.read_table(spark, f"{root}/gold/feature_store").count() == 60 * 4 * 4
    main(["train", "--root", root, "--snapshotdate", "2024-05-01", "--draws", "1"])
    main(["score", "--root", root, "--snapshotdate", "2024-04-01", "--modelname", "credit_model_2024_05_01"])
    scores = store.read_table(spark, f"{root}/gold/model_predictions")
    assert scores.count() == 60 and scores.filter("model_predictions between 0 and 1").count() == 60
