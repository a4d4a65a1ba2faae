"""What operators leave behind on disk."""

import time

from sheafline.llm.components import components
from sheafline.llm.staging import clean


def test_components_leave_no_files_of_their_rounds(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    chain = spark.createDataFrame([(n, n + 1) for n in range(40)], "a long, b long")
    clean(spark)
    time.sleep(2)
    before = disk.getAllFiles().size()
    found = components(chain)
    until = time.time() + 10
    while (more := disk.getAllFiles().size() - before) > 50 and time.time() < until:
        time.sleep(0.2)
    assert {tuple(r) for r in found.collect()} == {(n, 0) for n in range(41)}
    assert more <= 50
