"""Releases are tallied once, whatever phases follow."""

from kinfold.operators import propagate


def test_phases_follow_from_one_written_tally(spark):
    """Nulls, families of one row and members of several families; no phase reads the members themselves again."""
    old = spark.createDataFrame([("a", "o1"), ("b", "o1"), ("c", "o2"), ("d", "o2"), ("e", "o2"), ("f", "alone"), ("g", None), (None, "o1"), ("a", "o2")], "md5 string, fam string")
    new = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", 2), ("e", 3), ("e", 4), ("x", 3), ("f", 5), ("g", 5), ("y", 6), (None, 6), ("z", 7), ("w", None)], "md5 string, fam long")
    one, two, three = (phase(old, new) for phase in (propagate.phase1, propagate.phase2, propagate.phase3))
    assert sorted(map(tuple, one.collect())) == [("o1", 1, 2, "NOW", 1), ("o2", 2, 2, "SPLIT", 1), ("o2", 3, 1, "SPLIT", 2)]
    assert sorted(map(tuple, two.collect())) == [(6, "NEW", None, 0)]
    assert three.collect() == []
    assert sorted(map(tuple, propagate.overlap(old, new).collect())) == [("o1", 1, 2), ("o2", 2, 2), ("o2", 3, 1)]
    for df in (one, two, three):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "md5" not in plan and "LogicalRDD" not in plan and "LocalRelation" not in plan
