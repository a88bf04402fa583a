from __future__ import annotations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewmill.llm import negatives
from reviewmill.llm.queries import LLM_ORACLES, LLM_QUERIES


def _brute(rows, anchor, positives=5, n_negatives=10, scale=256):
    """Rows (id, label, vector) against each other, as the contract words it."""
    seen = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(c is None or not np.isfinite(c) for c in v):
            continue
        x = tuple(int(np.floor(scale * c)) for c in v)
        seen[(i, label, x)] = None
    width = max((len(x) for _, _, x in seen), default=0)
    points = [(i, label, np.array(x + (0,) * (width - len(x)), object)) for i, label, x in dict.fromkeys(seen)]
    out = []
    for a in points:
        if not anchor(a[0]):
            continue
        scored = [(int(a[2] @ b[2]) if width else 0, b) for b in points if b is not a]
        scored.sort(key=lambda s: (-s[0], s[1][0]))
        for p, b in [s for s in scored if s[1][1] == a[1]][:positives]:
            found = [(s, c) for s, c in scored if c[1] != a[1] and 30 * p <= 100 * s <= 90 * p][:n_negatives]
            out += [(a[0], b[0], rank + 1, c[0], p, s) for rank, (s, c) in enumerate(found)]
    return sorted(out)


def _found(frame):
    return sorted(map(tuple, frame.collect()))


def _shard(x, ids=None):
    turn = negatives.rotations(x.shape[1])
    ids = pa.array(range(len(x))) if ids is None else ids
    return turn, negatives.Shard(ids, x, *negatives.encode(x, turn))


@pytest.mark.parametrize("width", [1, 3, 64, 100])
@pytest.mark.parametrize("reach", [0, 1, 50, 10**6])
def test_products_lie_in_their_interval(width, reach):
    pick = np.random.default_rng(width + reach)
    x = pick.integers(-reach, reach + 1, (200, width))
    turn, shard = _shard(x)
    low, high = shard.bounds(x[:40], turn)
    true = x @ x[:40].T
    assert (low <= true).all() and (true <= high).all()


def test_intervals_narrow_with_every_code():
    x = np.random.default_rng(1).normal(0, 40, (500, 64)).astype(int)
    widths = []
    for layers in (1, 2, 4):
        turn = negatives.rotations(64, layers)
        shard = negatives.Shard(pa.array(range(500)), x, *negatives.encode(x, turn))
        low, high = shard.bounds(x[:5], turn)
        widths.append((high - low).mean())
    assert widths[1] < 0.8 * widths[0] and widths[2] < 0.5 * widths[0]


def test_few_rows_are_scored():
    pick = np.random.default_rng(2)
    x = pick.normal(0, 32, (20_000, 64)).astype(int)
    turn, shard = _shard(x)
    low, high = shard.bounds(x[:1], turn)
    scored = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            scored.append(len(self))
            return np.asarray(self) @ other

    shard.vectors = x.view(Counted)
    eligible = np.ones(len(x), bool)
    [(places, scores)] = shard.best(x[0], low[:, 0], high[:, 0], eligible, [(-(2**63), 2**63 - 1)], 5)
    true = x @ x[0]
    assert places.tolist() == np.lexsort((np.arange(len(x)), -true))[:5].tolist() and (scores == true[places]).all()
    assert sum(scored) < 2000


@pytest.mark.parametrize("shards", [1, 5])
def test_against_brute_force_with_odd_rows(spark, shards):
    pick = np.random.default_rng(3)
    nan, inf = float("nan"), float("inf")
    centres = pick.normal(size=(4, 8))
    rows = [(i, int(i % 3), [float(c) for c in centres[i % 4] + pick.normal(0, 0.5, 8)]) for i in range(300)]
    rows += [(i, i % 3, rows[20][2]) for i in range(300, 420)]  # a vector many rows share, all of them ties
    rows += [rows[20], rows[20], rows[50]]  # repeated rows
    rows += [(40, 2, rows[41][2]), (40, 1, rows[42][2])]  # one id, other rows
    rows += [(None, 1, rows[0][2]), (500, None, rows[0][2]), (520, 1, None), (540, 1, [nan] * 8), (560, 1, [1.0, None]), (580, 1, [inf] * 8)]
    rows += [(600, 1, []), (620, 2, [1.5, -2.0]), (640, 77, rows[3][2])]  # empty, short, alone with its label
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<double>, Rank string").repartition(3)
    found = negatives.hard_negatives(df, F.col("vec_id") % 20 == 0, least_shards=shards)
    expected = _brute(rows, lambda i: i % 20 == 0)
    assert _found(found) == expected and len(expected) > 200


def test_other_kinds_of_ids_and_labels(spark):
    pick = np.random.default_rng(4)
    rows = [(f"v{i:03d}", "ab"[i % 2], [float(c) for c in pick.normal(size=70)]) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, l string, e array<float>")
    rows = [(r.k, r.l, r.e) for r in df.collect()]
    found = negatives.hard_negatives(df, F.col("k").endswith("0"), "k", "l", "e", positives=3, negatives=4, least_shards=2)
    assert _found(found) == _brute(rows, lambda i: i.endswith("0"), 3, 4)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).count() == 0


def test_scores_beyond_a_long_raise(spark):
    df = spark.createDataFrame([(i, 1, [5e6] * 64) for i in range(3)], "vec_id long, label int, embedding array<double>")
    with pytest.raises(Exception, match="do not fit a long"):
        negatives.hard_negatives(df, F.col("vec_id") == 0).count()


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_query_against_sql(spark, size):
    folder = f"/root/testdata/{size}"
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
        expected = sorted(con.execute(LLM_ORACLES["op12_hard_negatives"]).fetchall())
    assert _found(LLM_QUERIES["op12_hard_negatives"](spark, folder)) == expected and expected
