from __future__ import annotations

import pytest

from saleslake.session import tuning

PARTITIONS = "spark.sql.shuffle.partitions"


def test_partitions_follow_the_data():
    assert PARTITIONS not in tuning()
    assert tuning(0)[PARTITIONS] == "1"
    assert tuning(1_000_000_000)[PARTITIONS] == "8"
    assert tuning(10**12)[PARTITIONS] == "7451"
    with pytest.warns(UserWarning, match="4768 MB each"):
        assert tuning(10**15)[PARTITIONS] == "200000"


def test_adaptive_execution_is_on(spark):
    assert all(spark.conf.get(key) == value for key, value in tuning().items())
