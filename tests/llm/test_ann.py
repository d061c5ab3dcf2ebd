import numpy as np
import pytest
from conftest import TESTDATA
from helpers import rows
from pyspark.sql import functions as F

from jobtide.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"
QUERY = "vec_id % 20 = 0"


def brute(table, k=20):
    good = [(i, np.array(v, np.float64)) for i, v in table if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, v in good:
        if q % 20 == 0:
            found = sorted((-float(np.dot(v, w)), i) for i, w in good if i != q)[:k]
            out[q] = [(i, -s) for s, i in found]
    return out


def found(df, **options):
    out = {}
    for q, rank, i, score in sorted(rows(ann.search(df, F.expr(QUERY), **options))):
        out.setdefault(q, []).append((i, score))
        assert len(out[q]) == rank
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def test_recall_on_embeddings(spark):
    df = spark.read.parquet(f"{TESTDATA}/sf0.1/embeddings.parquet")
    table = rows(df.select("vec_id", "embedding"))
    got, want = found(df, enough=200), brute(table)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    vectors = {i: np.array(v, np.float64) for i, v in table}
    for q, best in got.items():
        assert len(best) == 20 and best == sorted(best, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - np.dot(vectors[q], vectors[i])) < 1e-12 for i, s in best)


def test_all_cells_are_exact(spark):
    rng = np.random.default_rng(2)
    table = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    table += [(i, [1.0] * 8) for i in range(300, 360)]  # copies tie: smaller ids first
    table += [(400, None), (420, [0.0] * 8), (440, [1.0] * 7 + [None]), (460, [float("nan")] * 8), (480, [float("inf")] * 8), (500, [1.0] * 3), (None, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, None) for i, v in table], SCHEMA).repartition(3)
    got = found(df, share=1.0, per_block=16)
    want = brute([t for t in table if t[0] != 500])
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12, rtol=0)


def test_few_rows_and_empty_table(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [-1.0, 0.0], 1)], SCHEMA)
    assert found(few) == {0: [(1, 0.5), (2, -1.0)]}
    assert found(few.filter("vec_id = 0")) == {} and found(few.limit(0)) == {}
    single = spark.createDataFrame([(0, [2.0], 1), (1, [3.0], 1)], SCHEMA)
    assert found(single) == {0: [(1, 6.0)]}


def test_cells_come_in_order_of_summed_distance():
    rng = np.random.default_rng(1)
    a, b = rng.random(6), rng.random(5)
    sizes = {(i, j): 1 for i in range(6) for j in range(5) if (i + j) % 3}
    got = ann.cells_in_order(a, b, sizes, 10**9)
    assert got == sorted(sizes, key=lambda c: a[c[0]] + b[c[1]])
    assert len(ann.cells_in_order(a, b, sizes, 4)) == 4


@pytest.mark.parametrize("sigma", [0.5, 1.0])
def test_recall_where_lengths_differ(spark, sigma):
    """Inner products favour long vectors, wherever they lie."""
    rng = np.random.default_rng(int(sigma * 10))
    v = rng.normal(size=(6000, 24))
    v *= (rng.lognormal(0, sigma, 6000) / np.linalg.norm(v, axis=1))[:, None]
    table = [(i, x.tolist()) for i, x in enumerate(v)]
    df = spark.createDataFrame([(i, x, None) for i, x in table], "vec_id long, embedding array<double>, label int").filter("vec_id % 3 > 0 OR vec_id % 60 = 0")
    got = found(df, enough=200)
    want = brute([(i, x) for i, x in table if i % 3 or i % 60 == 0])
    assert got.keys() == want.keys() and recall(got, want) >= 0.9


def test_numbers_of_components_are_searched_apart(spark):
    rng = np.random.default_rng(3)
    table = [(i, (rng.normal(size=2 + i % 2) * 10.0 ** (i % 5)).tolist()) for i in range(240)]
    table += [(i, (v * 1e150).tolist()) for i, v in ((1000 + 20 * j, rng.normal(size=7)) for j in range(9))]
    df = spark.createDataFrame([(i, v, None) for i, v in table], "vec_id long, embedding array<double>, label int")
    got = found(df, share=1.0)
    for n in (2, 3, 7):
        want = brute([t for t in table if len(t[1]) == n])
        for q, best in want.items():
            assert [i for i, _ in got[q]] == [i for i, _ in best]
