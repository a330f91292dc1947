import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesmart.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", app="salesmart-tests", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false"})
    # Tests only: a scratch checkpoint folder when the session names none.
    if not (s.sparkContext.getCheckpointDir() or s.conf.get("spark.checkpoint.dir", None)):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="salesmart-tests-"))
    yield s
