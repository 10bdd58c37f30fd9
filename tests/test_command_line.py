import pytest

from tallyline.__main__ import main
from tests.test_daily_run import SOURCE1, SOURCE2


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("cli")
    (root / "data.csv").write_bytes(SOURCE1.encode("latin-1"))
    (root / "online.csv").write_bytes(SOURCE2.encode("utf-8"))
    return root


def test_commands(spark, folder, capsys):
    sources = ["--source1", str(folder / "data.csv"), "--source2", str(folder / "online.csv")]
    main(["catalogue", *sources, "--out", str(folder / "catalogue")])
    main(["run", *sources, "--warehouse", str(folder / "wh"), "--run-id", "r1", "--date", "2011-12-09",
          "--catalogue", str(folder / "catalogue")])
    assert "inserted=7" in capsys.readouterr().out
    main(["report", "q1", "--warehouse", str(folder / "wh")])
    assert "2010-12" in capsys.readouterr().out
    main(["sql", "SELECT category, count(*) AS n FROM dim_products GROUP BY category", "--warehouse", str(folder / "wh")])
    assert "Electronica" in capsys.readouterr().out  # labels of the catalogue
    for name in ("null_report", "quantity_histogram", "date_profile", "sample", "nonnumeric_codes"):
        main(["profile", name, *sources])
    assert "POST" in capsys.readouterr().out
