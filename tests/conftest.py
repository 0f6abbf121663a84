import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from inkspan.session import session

    base = tmp_path_factory.mktemp("spark")
    s = session("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": f"file://{base}/warehouse", "spark.checkpoint.dir": f"file://{base}/shared", "spark.sql.session.timeZone": "UTC"})
    s.sparkContext.setLogLevel("ERROR")
    return s


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF).exists():
        pytest.skip("no test tables")
    return SF
