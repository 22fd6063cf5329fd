import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from copyaudit.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="copyaudit-warehouse-")     # tests only: managed tables
    s = build_session("local[4]", app_name="copyaudit-tests", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": warehouse})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, request):
    from copyaudit.session import scratch_path
    path = scratch_path(spark, "test-" + request.node.name.replace("[", "-").replace("]", ""))
    return path.replace("file:", "")
