import ctypes
import re

import pyarrow as pa
from tariffa.llm import minhash


def test_freed_memory_goes_back(spark):
    """A reused worker doesn't keep what its earlier tasks have freed."""

    def kept(batches):
        own = lambda: sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", open("/proc/self/smaps_rollup").read()))) // 1024
        before = own()
        ctypes.CDLL(None).malloc_trim(0)
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([before - own()])], ["mb"])

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    minhash._signed(docs, minhash.Hashing(), "doc_id", "text").write.format("noop").mode("overwrite").save()
    n = spark.sparkContext.defaultParallelism
    assert max(r.mb for r in spark.range(0, n, numPartitions=n).mapInArrow(kept, "mb long").collect()) < 15
