import pytest

from gearwatch import jobs
from gearwatch.plans.store import Store
from gearwatch.sources.files import read_csv


def line(engine, cycle):
    return " ".join([str(engine), str(cycle), *[f"{(engine * 7 + cycle * 13 + i) % 50}" for i in range(24)]])


def test_whole_round_by_command_line(spark, tmp_path, capsys):
    data, wire, store = tmp_path / "train_FD001.txt", str(tmp_path / "wire"), str(tmp_path / "store")
    data.write_text("".join(line(e, c) + " \n" for e in range(1, 13) for c in range(1, 26)))
    jobs.main(["publish", "fd001", "--folder", str(tmp_path), "--limit", "200", "--out", wire])
    assert "rows=200" in capsys.readouterr().out
    jobs.main(["ingest", "--store", store, "--messages", wire])
    jobs.main(["score", "--store", store])
    jobs.main(["publish", "fd001", "--folder", str(tmp_path), "--start-row", "201", "--out", wire])
    jobs.main(["ingest", "--store", store, "--messages", wire])
    jobs.main(["score", "--store", store, "--window-cycles", "10"])
    jobs.main(["score", "--store", store])
    out = capsys.readouterr().out
    assert "'raw_rows_used': 100" in out and "'raw_rows_used': 0" in out
    exported = str(tmp_path / "processed.csv")
    jobs.main(["export", "--store", store, "--output", exported, "--order-by", "raw_id"])
    assert "rows=300" in capsys.readouterr().out and read_csv(spark, exported).count() == 300
    model = str(tmp_path / "model")
    jobs.main(["train", "--csv", exported, "--model", model, "--kind", "forest"])
    jobs.main(["score", "--store", store, "--use-trained-model", "--model", model])
    capsys.readouterr()
    jobs.main(["report", "--store", store, "counts"])
    assert "raw_rows" in capsys.readouterr().out
    for name in ("levels", "status", "latest", "runs", "alerts", "sources", "raw", "checkpoint"):
        assert jobs.report(Store(spark, store), name).count() > 0 or name == "alerts"
    with pytest.raises(ValueError):
        jobs.table(Store(spark, store), "nothing")
