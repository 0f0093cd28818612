import collections

import pytest

from susurrus.operators import skew
from susurrus.sources import tables


@pytest.mark.parametrize("bound", [0, 300_000])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_join(spark, monkeypatch, bound, how):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", bound)
    monkeypatch.setattr(skew, "HOT_ONE_IN", 4)
    rows = [("hot", i) for i in range(60)] + [(f"k{i % 30}", i) for i in range(60)] + [(None, -1), ("absent", -2)]
    left = spark.createDataFrame(rows, "k string, i int")
    right = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"v{i}") for i in range(40)], "k string, v string")
    got = collections.Counter((r.k, r.i, r.v) for r in skew.hot_join(left, right, "k", how).collect())
    of = {"hot": "H"} | {f"k{i}": f"v{i}" for i in range(40)}
    assert got == collections.Counter((k, i, of.get(k)) for k, i in rows if how == "left" or k in of)
    assert skew.hot_join(left.limit(0), right, "k", how).count() == 0
    assert skew.hot_join(left, right.limit(0), "k", how).count() == (len(rows) if how == "left" else 0)


def test_shared_folder_and_release(spark, monkeypatch, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    a, b = tables.cut(spark.range(3)), tables.cut(spark.range(4))
    assert spark.conf.get("spark.checkpoint.dir", None) == before
    folder = lambda df: df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    pa, pb = folder(a), folder(b)
    import os

    assert os.path.isdir(pa) and os.path.isdir(pb)
    tables.release(a)
    assert not os.path.isdir(pa) and os.path.isdir(pb)
    tables.release_all(spark)
    assert not os.path.isdir(pb)

    class Far:
        conf = spark.conf

        class sparkContext:  # noqa: N801
            master, applicationId = "spark://far:7077", "x"
            getConf = staticmethod(spark.sparkContext.getConf)

    if not before and not spark.sparkContext.getConf().get("spark.checkpoint.dir"):
        with pytest.raises(ValueError, match="executors share"):
            tables.shared_folder(Far)
