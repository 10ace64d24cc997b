"""What Spark sends to Python workers at once is bounded by bytes, so that the pipeline's memory beside the heap doesn't grow with its file splits."""

import public_tokenizers
import pyarrow as pa
import pytest
from helpers import hard

from tapeloom.llm import langid, packing, toxicity

ROW, BATCH_BOUND = 200_000, "spark.sql.execution.arrow.maxBytesPerBatch"


def largest(spark) -> int:
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    return spark.range(0, 100, 1, 1).selectExpr(f"repeat(cast(id % 10 AS string), {ROW}) AS text").mapInArrow(sizes, "n long").agg({"n": "max"}).first()[0]


@pytest.mark.parametrize("stage", [
    lambda d: packing.pack(d, public_tokenizers.path("word_bpe_49k.json")),
    lambda d: toxicity.keep_clean(d, toxicity.Model(toxicity.Settings())),
    lambda d: langid.keep_known(d, langid.Model(langid.Settings())),
])
def test_texts_go_to_workers_in_small_batches(spark, stage):
    spark.conf.unset(BATCH_BOUND)
    stage(hard(spark))
    assert largest(spark) <= (4 << 20) + 2 * ROW
    spark.conf.set(BATCH_BOUND, "1m")
    stage(hard(spark))
    assert spark.conf.get(BATCH_BOUND) == "1m"
    spark.conf.unset(BATCH_BOUND)
