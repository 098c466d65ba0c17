import duckdb
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import batching, permute

SIZES = [1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 99, 100, 101, 2500, 4097]


def _places(spark, sizes, seed=0):
    rows = spark.createDataFrame([(n,) for n in sizes], "n long").withColumn("i", F.explode(F.expr("sequence(0L, n - 1)")))
    out = {}
    for r in permute.with_place(rows, F.col("i"), F.col("n"), "p", seed).collect():
        out.setdefault(r.n, {})[r.i] = r.p
    return out


def test_every_place_is_taken_once(spark):
    for seed in (0, 1):
        got = _places(spark, SIZES, seed)
        assert all(sorted(got[n].values()) == list(range(n)) for n in SIZES)
    assert got[2500] != _places(spark, [2500], 2)[2500]


def test_sql_gives_the_same_places(spark):
    c = duckdb.connect()
    c.execute(f"CREATE TABLE s AS SELECT unnest(range(n)) AS i, n FROM (SELECT unnest({SIZES}) AS n)")
    for seed in (0, 3):
        want = {(n, i): p for i, n, p in c.execute(permute.place_sql("s", "i", "n", seed)).fetchall()}
        assert want == {(n, i): p for n, at in _places(spark, SIZES, seed).items() for i, p in at.items()}


def test_places_look_shuffled(spark):
    n = 2500
    at = _places(spark, [n])[n]
    assert sum(at[i + 1] > at[i] for i in range(n - 1)) == pytest.approx(n / 2, abs=130)  # ups and downs
    assert sum(at[i] == i for i in range(n)) < 10  # places that stay
    first = [at[i] for i in range(250)]  # a tenth of the rows lies over all tenths
    assert all(8 <= sum(v * 10 // n == t for v in first) <= 45 for t in range(10))


def test_large_counts_and_nulls(spark):
    n = (1 << 40) + 12345
    df = spark.range(2000).select((F.col("id") * 549755813 % n).alias("i"))
    got = [r.p for r in permute.with_place(df, F.col("i"), F.lit(n), "p").collect()]
    assert len(set(got)) == 2000 and all(0 <= p < n for p in got)
    assert permute.with_place(spark.range(1), F.lit(None), F.lit(5), "p").first().p is None


def _filled(lengths, chunks):
    """The rule by search: the lightest chunk with room, the first on ties."""
    share, load, size, out = len(lengths) // chunks, [0] * chunks, [0] * chunks, []
    for x in lengths:
        c = min((c for c in range(chunks) if size[c] < share), key=lambda c: (load[c], c))
        out.append((c, size[c]))
        load[c] += x or 0
        size[c] += 1
    return out


def test_chunks_equal_the_rule_over_batch_borders(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(g, i, (i * i * 31 + g) % 17 if i % 5 else None) for g in range(9) for i in range(24)]
        mb = spark.createDataFrame([(g, i, v, r + 1, 24) for g in range(9)
                                    for r, (_, i, v) in enumerate(sorted((x for x in rows if x[0] == g), key=lambda x: (-(x[2] or 0), x[1])))],
                                   "mb long, k long, len long, rank int, mb_size long")
        for chunks in (1, 4, 24):
            got = batching.even_chunks(mb, "k", "len", chunks).collect()
            assert len(got) == len(rows)
            for g in range(9):
                mine = sorted((r for r in got if r.mb == g), key=lambda r: r["rank"])
                assert [(r.chunk, r.chunk_pos) for r in mine] == _filled([r.len for r in mine], chunks)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_large_megabatch_is_linear_log(spark):
    n, chunks = 100_000, 1000
    mb = spark.range(n).select(F.lit(0).alias("mb"), "id", (n - F.col("id")).alias("len"), (F.col("id") + 1).alias("rank"),
                               F.lit(n).alias("mb_size"))
    out = batching.even_chunks(mb, "id", "len", chunks)
    got = out.groupBy("chunk").agg(F.count("*").alias("n"), F.sum("len").alias("load")).collect()
    assert len(got) == chunks and {r.n for r in got} == {n // chunks}
    loads = [r.load for r in got]
    assert max(loads) - min(loads) <= n  # within one row's weight


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, length long")
    assert batching.length_grouped(none, "conv_id", "length", 2, 2).count() == 0
