"""Scratch tables belong to scopes."""

from pyspark.sql import functions as F

from custseg.session import materialise, release_scratch, scratch_scope


def test_releasing_a_scope_leaves_all_other_tables(spark):
    outside = materialise(spark.range(5), "outside")
    with scratch_scope("one"):
        one = materialise(spark.range(7), "one")
        with scratch_scope("two"):
            two = materialise(one.where(F.col("id") > 3), "two")
        back = materialise(spark.range(2), "one_again")
    after = materialise(spark.range(3), "after")
    release_scratch(spark, "one")
    assert outside.count() == 5 and two.count() == 3 and after.count() == 3
    for gone in (one, back):
        assert len(gone.inputFiles()) > 0
        folder = spark._jvm.org.apache.hadoop.fs.Path(gone.inputFiles()[0])
        assert not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    release_scratch(spark, "one")       # nothing left to delete
    release_scratch(spark, "never opened")


def test_a_scope_closes_after_an_error(spark):
    try:
        with scratch_scope("failing"):
            raise KeyError("x")
    except KeyError:
        pass
    kept = materialise(spark.range(4), "kept")
    release_scratch(spark, "failing")
    assert kept.count() == 4
