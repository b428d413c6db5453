"""Each registered training-text query that SQL can express, against its SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakesteps.llm.queries import QUERIES, SQL  # noqa: E402
from oracle import connect, frame_differences  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    problems = frame_differences(df, connect(SF_DIR), SQL[name])
    assert not problems, "\n".join(problems)
