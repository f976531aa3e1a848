import os

import pytest
from pyspark.sql import functions as F

from quarterline.llm.common import shared_input, shared_output, smallest


@pytest.mark.parametrize("n", [1, 50, 5000])
def test_bounded_sample_is_the_smallest_hashes(spark, n):
    df = spark.range(3000).withColumn("h", F.xxhash64("id"))
    want = [r.id for r in df.orderBy("h", "id").limit(n).collect()]
    assert [r.id for r in smallest(df, "h", n, "id").collect()] == want
    assert smallest(df.limit(0), "h", n, "id").count() == 0


def test_shared_files_appear_whole_or_not_at_all(tmp_path):
    path = f"file://{tmp_path}/x/y.bin"
    with pytest.raises(RuntimeError), shared_output(path) as f:
        f.write(b"half")
        raise RuntimeError
    assert not os.path.exists(f"{tmp_path}/x/y.bin")
    for data in (b"one", b""):
        with shared_output(path) as f:
            f.write(data)
        with shared_input(path) as m:
            assert bytes(m[:]) == data
