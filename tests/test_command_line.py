import pytest

from casemill.__main__ import main, parse
from casemill.plans.cycle import read_status
from casemill.sources.store import Store

HEAD = "Número petición»Asunto»Fecha ingreso»Fecha registro\n"


def test_jobs_end_to_end(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    rows = ["1»Maltrato animal en la calle 5»2026-03-01»2026-03-02", "2»»2026-03-04»2026-03-04",
            "3»Otros: ruido por vecinos»2026-04-01»2026-04-02"]
    (tmp_path / "in" / "a.csv").write_text(HEAD + "\n".join(rows) + "\n", encoding="utf-8")
    store = ["--store", str(tmp_path / "store")]

    def job(name, *options):
        main([name, *store, *options], spark)
        return capsys.readouterr().out

    out = str(tmp_path / "out")
    assert "inserted=3" in job("run", "--source", str(tmp_path / "in"), "--snapshots", str(tmp_path / "snap"))
    first = Store(spark, store[1]).latest_tag()
    assert "changed=False" in job("run", "--source", str(tmp_path / "in"))
    assert "Maltrato Animal" in job("metrics")
    assert "Sin fecha" not in job("shares", "--domain", "salud")
    job("monthly", "--out", out)
    monthly = spark.read.option("header", True).csv(f"{out}/monthly")
    assert monthly.filter("domain = 'maltrato_animal' AND year_month = '2026-03'").head().classified_pct == "50.0000%"
    assert "positive" in job("progress", "--period", "2026-03")
    job("export", "--period", "2026-04", "--out", f"{out}/export")
    assert len(list((tmp_path / "out/export").glob("*.csv"))) == 1
    job("sample", "--out", f"{out}/sample")
    assert spark.read.json(f"{out}/sample/json").count() == 3
    job("evaluate", "--out", f"{out}/evaluation")
    assert spark.read.option("header", True).csv(f"{out}/evaluation/agreement").head().total == "3"
    job("reset", "--period", "2026-03", "--domain", "salud")
    assert read_status(Store(spark, store[1])).filter("NOT processed").count() == 2
    assert job("classify", "--domain", "salud").strip() == "{'salud': 0}"
    job("purge", "--period", "2026-03")
    Store(spark, store[1]).tag("later")
    job("difference", "--since", first, "--out", f"{out}/difference")
    changed = spark.read.option("header", True).csv(f"{out}/difference/cases")
    assert {tuple(r) for r in changed.collect()} == {("1", "removed"), ("2", "removed")}
    assert spark.read.option("header", True).csv(f"{out}/difference/status").count() == 6
    assert read_status(Store(spark, store[1])).count() == 3


@pytest.mark.parametrize("argv", [["run", "--store", "s"], ["export", "--store", "s", "--out", "o"], ["purge", "--store", "s"]])
def test_missing_options_are_refused(argv):
    with pytest.raises(SystemExit):
        parse(argv)
