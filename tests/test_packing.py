from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.operators import packing


def run_pack(spark, rows, block, batch_rows, dense):
    data = [(0 if dense else i, i, r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "k long, pos long, input_ids array<int>")
    order = ["k", "pos"]
    got = packing.pack_blocks(df, order, block, batch_rows=batch_rows, dense_inner=dense)
    return [list(r.input_ids) for r in got.orderBy("batch_id", "block_no").collect()]


def check_packed(got, rows, block, batch_rows):
    """Per batch of rows: its ids up to the last whole block, in blocks; all its ids if they fill no block."""
    left = list(got)
    for first in range(0, len(rows), batch_rows):
        ids = [x for row in rows[first:first + batch_rows] for x in row]
        n_blocks = len(ids) // block or (1 if ids else 0)
        mine, left = left[:n_blocks], left[n_blocks:]
        assert [x for b in mine for x in b] == ids[:max(len(ids) - len(ids) % block, min(len(ids), block))]
        assert all(len(b) == block for b in mine) or (len(mine) == 1 and len(ids) < block)
    assert not left


def test_golden_cases(spark):
    # two batches of two rows: five ids (the tail of one is dropped), seven ids (three dropped)
    rows = [[1, 2, 3], [4, 5], [], [6, 7, 8, 9, 10, 11, 12]]
    assert run_pack(spark, rows, 4, 2, False) == [[1, 2, 3, 4], [6, 7, 8, 9]]
    assert run_pack(spark, [[1, 2]], 4, 10, False) == [[1, 2]]  # only block, short, kept
    assert run_pack(spark, [[1, 2, 3, 4]], 4, 10, True) == [[1, 2, 3, 4]]
    assert run_pack(spark, [[]], 4, 10, False) == []


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.integers(3, 300), min_size=0, max_size=20), min_size=1, max_size=40),
       st.integers(2, 16), st.integers(1, 7))
def test_packing_matches_rule(spark, rows, block, batch_rows):
    got = run_pack(spark, rows, block, batch_rows, True)
    check_packed(got, rows, block, batch_rows)


def test_same_result_for_1_and_8_partitions(spark):
    rows = [[i] * (i % 7) for i in range(200)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = run_pack(spark, rows, 8, 16, False)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        b = run_pack(spark, rows, 8, 16, False)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b
    check_packed(a, rows, 8, 16)


def test_exact_split_count(spark):
    df = spark.range(0, 1000).selectExpr("cast(id as string) as key")
    out = packing.split_exact(df, "key", 0.05)
    assert out.filter("split = 'eval'").count() == 50
    h = packing.split_by_hash(df, "key", 0.05)
    assert h.count() == 1000
