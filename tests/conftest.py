import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from statlens.session import build_session, ensure_checkpoint_dir  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("local[4]", app_name="statlens-tests", shuffle_partitions=8)
    # Tests are the one place where the library sets its own checkpoint folder.
    ensure_checkpoint_dir(s, str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples of the given columns, sorted."""
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
