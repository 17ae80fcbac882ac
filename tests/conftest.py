import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from churnlens.schemas import PROFILE, REPO  # noqa: E402

AS_OF = "2024-01-01T00:00:00Z"


@pytest.fixture(scope="session")
def spark():
    from churnlens.session import get_session
    s = get_session("local[4]", app="churnlens-tests", shuffle_partitions=8,
                    extra={"spark.driver.memory": "6g"})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="churnlens-ckpt-"))
    yield s
    s.stop()


def profile_row(login, **kw):
    base = {"login": login, "type": "User", "public_repos": 1, "public_gists": 0, "followers": 1, "following": 1,
            "created_at": "2020-01-01T00:00:00Z", "updated_at": "2023-12-01T00:00:00Z", "bio": None,
            "blog": None, "company": None, "email": None, "hireable": None}
    base.update(kw)
    return tuple(base[f.name] for f in PROFILE.fields)


@pytest.fixture
def profiles(spark):
    def make(rows):
        return spark.createDataFrame([profile_row(**r) for r in rows], PROFILE)
    return make


@pytest.fixture
def repos(spark):
    def make(rows):
        return spark.createDataFrame([(r["owner"], r.get("pushed_at"), r.get("language")) for r in rows], REPO)
    return make
