import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
}
#: names that operators use inside themselves
CLASH = ("size", "h", "d", "dh", "v", "n", "s", "pos", "tid", "kind", "start", "end", "spans", "target", "taken",
         "features", "probability", "label", "score", "token", "core", "first", "last", "shard", "digest", "host", "rank")


class Tables:
    """A folder of Parquet tables, as the queries expect one."""

    def __init__(self, spark, folder):
        self.spark, self.dir = spark, str(folder)

    def put(self, name, rows, clash=True):
        df = self.spark.createDataFrame(rows, SCHEMAS[name])
        if clash:
            for i, c in enumerate(CLASH):
                if c not in df.columns:
                    from pyspark.sql import functions as F
                    df = df.withColumn(c, F.lit(f"x{i}"))
        df.repartition(3).write.mode("overwrite").parquet(f"{self.dir}/{name}.parquet")
        return self

    def sql(self, text):
        con = duckdb.connect()
        for name in SCHEMAS:
            if os.path.exists(f"{self.dir}/{name}.parquet"):
                con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{self.dir}/{name}.parquet/*.parquet')")
        rel = con.sql(text)
        return sorted((dict(zip(rel.columns, r)) for r in rel.fetchall()), key=repr)


def rows_of(df, names=None):
    names = names or df.columns
    return sorted(({c: r[c] for c in names} for r in df.collect()), key=repr)


def same(got, want):
    """Equal rows whatever the order of columns."""
    key = lambda r: repr(sorted(r.items()))
    assert sorted(map(key, got)) == sorted(map(key, want))


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, tmp_path)
