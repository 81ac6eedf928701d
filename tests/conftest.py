import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from spendstar.session import build_session

    scratch = tempfile.mkdtemp(prefix="spendstar-tests-")
    session = build_session(
        "local[*]",
        app_name="spendstar-tests",
        extra={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
            # tests set their own shared folder; a cluster names one in its config
            "spark.checkpoint.dir": scratch + "/checkpoints",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
