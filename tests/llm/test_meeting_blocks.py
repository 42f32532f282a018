from brickrow.llm.jaccard_join import meeting


def test_records_meet_blocks_of_equal_buckets_once(spark):
    """Forty records in thirty buckets that all have members of four blocks, and two in a bucket of their own."""
    rows = [(bucket, node, node % 4, node % 3 == 0) for bucket in range(30) for node in range(40)]
    rows += [(99, 7, 3, True), (99, 100, 8, False)]
    inside = spark.createDataFrame(rows, "bucket long, node long, block long, probe boolean")
    met = [tuple(r) for r in meeting((inside.where("probe"), inside)).collect()]
    there = inside.select("bucket", "block").distinct()
    plain = inside.where("probe").select("bucket", "node").join(there, "bucket").select("node", "block")
    assert set(met) == {tuple(r) for r in plain.distinct().collect()}
    # 14 records ask 4 blocks each, and record 7 those of bucket 99; joined by bucket they are thirty times as many.
    assert len(met) == 14 * 4 + 2 and plain.count() == 30 * 14 * 4 + 2


def test_both_kinds_of_asking_meet_a_set_once(spark):
    """Every record probes in some buckets and is found in others; both kinds of buckets have the same blocks."""
    rows = [(bucket, node, node % 4, node % 2 == bucket % 2) for bucket in range(8) for node in range(16)]
    inside = spark.createDataFrame(rows, "bucket long, node long, block long, probe boolean")
    probing, found = inside.where("probe"), inside.where("not probe")
    met = [tuple(r) for r in meeting((probing, inside), (found, probing)).collect()]
    plain = [(a, b.select("bucket", "block").distinct()) for a, b in ((probing, inside), (found, probing))]
    expected = {tuple(r) for a, b in plain for r in a.select("bucket", "node").join(b, "bucket").select("node", "block").collect()}
    assert set(met) == expected
    assert len(met) <= 16 * (4 + 2)
