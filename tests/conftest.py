import os

import pytest

from leadspark.session import session

os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session("local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="3g", spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}", spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()] if order else sorted(tuple(r) for r in df.collect())
