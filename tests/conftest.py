import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from milepost.session import build_session
    s = build_session("local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small(spark):
    from milepost.plans.catalog import load
    return load(spark, SF_SMALL).materialize()  # one journey table for the whole session


@pytest.fixture(scope="session")
def tiny_cfg():
    from milepost.config import Config, GBTPreset
    tiny = GBTPreset(max_iter=3, step_size=0.5)
    return Config(direct=tiny, structured=tiny)
