from __future__ import annotations

import csv
import random
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from maskloom.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def own_tables() -> str:
    """A folder with small tables: three kinds of flower, and patients with their visits."""
    folder, rng = Path(tempfile.mkdtemp(prefix="maskloom-tests-")), random.Random(11)

    def write(name, header, rows):
        with open(folder / name, "w", newline="") as file:
            csv.writer(file).writerows([header, *rows])

    centres = {"Setosa": (5.0, 3.4, 1.5, 0.3), "Versicolor": (5.9, 2.8, 4.3, 1.3), "Virginica": (6.6, 3.0, 5.6, 2.0)}
    write("iris.csv", ["sepal.length", "sepal.width", "petal.length", "petal.width", "variety"], [
        (*[round(max(0.1, rng.gauss(m, 0.3)), 1) for m in centre], name)
        for name, centre in centres.items() for _ in range(50)])
    write("patient.csv", ["p_id", "gender", "height", "age", "weight"], [
        (i, rng.choice(["f", "m"]), round(rng.gauss(170, 9), 1), rng.randint(18, 90), round(rng.gauss(72, 12), 1))
        for i in range(130)])
    write("visit.csv", ["visit_id", "patient_id", "doctor_id", "day_visit", "exam"], [
        (i, rng.randrange(130), rng.randrange(50), rng.choice(["mon", "tue", "wed", "thu", "fri"]),
         rng.choice(["blood", "scan", "none"])) for i in range(300)])
    return str(folder)


FIXTURES = own_tables()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", master="local[4]", shuffle_partitions=4, extra={
        "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """DataFrame from columns, with a row key ``k`` in row order."""

    def build(schema: str, key: bool = True, **columns):
        names = list(columns)
        rows = list(zip(*columns.values()))
        if key:
            rows = [(*row, i) for i, row in enumerate(rows)]
            schema += ", k bigint"
        assert len(names) + int(key) == len(schema.split(","))
        return spark.createDataFrame(rows, schema)

    return build


def rows_of(df, key="k"):
    """Values by row key order, without the key."""
    names = [c for c in df.columns if c != key]
    return {c: [r[c] for r in df.orderBy(key).collect()] for c in names}
