"""SILVER is computed once where a query reads it several times."""

import pytest

from brickrow.proof import queries


@pytest.mark.parametrize("name", ["gate_outcomes", "silver_csv"])
def test_silver_is_computed_once(spark, tmp_path, monkeypatch, name):
    rows = [(i, 1000 + i % 40, 200_000.0 + 1000 * i) for i in range(1, 401)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    made = spark.sparkContext.accumulator(0)
    silver = queries._silver

    def counting(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    def counted(*args):
        table = silver(*args)
        return table.mapInArrow(counting, table.schema)

    n_rows = silver(spark, str(tmp_path)).count()
    monkeypatch.setattr(queries, "_silver", counted)
    assert queries.QUERIES[name](spark, str(tmp_path)).count() > 0
    assert made.value == n_rows > 0
