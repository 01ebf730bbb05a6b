"""Tables that operators write leave no shuffle files behind."""

import time

from pyspark.sql import functions as F

from quarry.llm.common import written
from quarry.operators.graph import _ckpt
from quarry.session import CLEAN_SHUFFLES


def _shuffle_blocks(spark) -> int:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return sum(blocks.apply(i).isShuffle() for i in range(blocks.size()))


def test_written_tables_leave_no_shuffle_files(spark):
    def left(make):
        before = _shuffle_blocks(spark)
        df = spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count()
        out = make(df.join(df.withColumnRenamed("count", "c"), "k").repartition(5, "c"))
        for _ in range(100):   # files are removed in the background
            if (n := _shuffle_blocks(spark) - before) <= 0:
                break
            time.sleep(0.1)
        assert out.count() == 100
        return n
    setting = spark.conf.get(CLEAN_SHUFFLES, None)
    assert left(lambda df: written(df, "test-shuffles")) <= 0
    assert left(_ckpt) <= 0
    assert spark.conf.get(CLEAN_SHUFFLES, None) == setting
