import pytest

from playstats.session import get_spark


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = get_spark("playstats-tests", cpus=4, shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return s
