"""What queries leave in the shared folder: no more than the tables that their results read."""

import os

import corpus_pipeline
from kinfold.llm import queries

FOLDER = "/root/testdata/sf0.001"


def there(spark):
    return {f for f in os.listdir(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) if f.startswith("kinfold-")}


def test_pipeline_leaves_the_table_of_its_last_stage_alone(spark):
    before = there(spark)
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
    assert len(there(spark) - before) == 1


def test_new_operators_leave_their_result_alone(spark):
    for name in ("op11_divergence", "op12_spelling", "op13_lines"):
        before = there(spark)
        assert queries.QUERIES[name](spark, FOLDER).count() > 0
        assert len(there(spark) - before) <= 1, name
