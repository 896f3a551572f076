import random

from reelsieve.operators import merge


def test_nearest_vector_in_blocks(spark):
    rnd = random.Random(2)
    base = [(i, [rnd.random() for _ in range(4)]) for i in range(300)]
    wanted = [(i, [rnd.random() for _ in range(4)]) for i in range(90)]
    queries, rows = spark.createDataFrame(wanted, "q_id long, v array<double>"), spark.createDataFrame(base, "b_id long, v array<double>")
    want = {i: min((round(sum((x - y) ** 2 for x, y in zip(v, w)) ** 0.5, 6), b) for b, w in base) for i, v in wanted}
    for block in (7, 256):
        got = merge.nearest_vector(queries, rows, "q_id", "b_id", "v", block)
        assert {r.q_id: (r.dist, r.b_id) for r in got.collect()} == want
    assert merge.nearest_vector(queries.limit(0), rows, "q_id", "b_id", "v").count() == 0
