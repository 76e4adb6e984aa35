import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from riskmart.session import get_spark
    s = get_spark("local[2]", 4, app_name="riskmart-tests",
                  extra={"spark.sql.adaptive.coalescePartitions.enabled": "true"})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def write_csv(folder, name, header, rows):
    import csv
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        if header is not None:
            w.writerow(header)
        for r in rows:
            w.writerow(["" if v is None else v for v in r])
    return path
