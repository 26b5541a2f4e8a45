"""Intermediate tables and their removal."""

from squall.llm import work
from squall.session import path_exists


def test_clean_removes_what_the_session_has_written(spark):
    work.clean(spark)
    df = work.written(spark.range(5).toDF("id"), "some")
    again = work.written(work.masks(df, "id"), "masks")
    paths = [f.rpartition("/")[0] for d in (df, again) for f in d.inputFiles()]
    assert df.count() == 5 and paths and all(path_exists(spark, p) for p in paths)
    assert work.clean(spark) == 2
    assert not any(path_exists(spark, p) for p in paths)
    assert work.clean(spark) == 0
