"""What a cut leaves behind."""

import glob
import time

from pyspark.sql import functions as F

from corpusmill.llm import common


def shuffles(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in folders for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}


def test_a_cut_leaves_no_shuffle_files(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffles(spark), spark.conf.get(name, None)
    rows = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    counted = common.cut(rows.groupBy("k").agg(F.count("*").alias("n")))
    joined = common.cut(rows.join(counted, "k").groupBy("n").agg(F.sum("id").alias("s")))
    assert [tuple(r) for r in joined.collect()] == [(100, 499500)] and len(counted.collect()) == 10
    ends = time.time() + 15
    while shuffles(spark) - before and time.time() < ends:
        time.sleep(0.2)
    assert not shuffles(spark) - before and spark.conf.get(name, None) == setting
