"""What a Python worker holds at a time."""

from pyspark.sql import functions as F

from loquent.llm import bpe
from loquent.llm.common import map_columns


def test_python_sees_few_rows_at_a_time(spark):
    """Pipeline: whole batches of 10,000 texts were Python values at once."""

    def make():
        return lambda texts: [[len(texts)] * len(texts)]

    rows = spark.range(3000).withColumn("text", F.lit("x")).coalesce(1)
    got = map_columns(rows, ["text"], "n INT", make).collect()
    assert [r["id"] for r in got] == list(range(3000))
    assert max(r["n"] for r in got) <= 512
    assert map_columns(rows.limit(0), ["text"], "n INT", make).count() == 0
    assert bpe.KEPT_WORDS <= 1 << 15
