from __future__ import annotations

import random

import numpy as np
import pytest

from riskstream.llm import topk

TOP = (1 << 63) - 1  # scores are held to the range of long
SCALES = {"bytes": 1.0, "shorts": 100.0, "singles": 30_000.0, "doubles": 3e6, "long": 4e8}


def _rows(size: float, n: int = 400, width: int = 7) -> list[tuple[int, list[float]]]:
    """Vectors with many equal scores, some shorter than others, some ids twice."""
    draw = random.Random(5)
    rows = [(i, [size * draw.randrange(-3, 4) / 3 for _ in range(draw.choice((width, width, 3)))]) for i in range(n)]
    return rows + [(i, rows[i + 1][1]) for i in range(1, n, 90)]


def _brute(rows: list, k: int) -> dict[int, list[tuple[int, int]]]:
    whole = [(i, [int(x) for x in np.floor(np.array(v) * 64)]) for i, v in rows]
    best = {}
    for i, v in whole:
        if i % 20 == 0:
            scored = [(-max(-TOP, min(TOP, sum(a * b for a, b in zip(v, w, strict=False)))), j) for j, w in whole if j != i]
            best[i] = [(j, -s) for s, j in sorted(scored)[:k]]
    return best


def _found(rows) -> dict[int, list[tuple[int, int]]]:
    found: dict[int, list[tuple[int, int]]] = {}
    for at, r in enumerate(sorted(rows, key=lambda r: (r.query_id, r.rank))):
        mine = found.setdefault(r.query_id, [])
        mine.append((r.vec_id, r.score))
        assert r.rank == len(mine)
    return found


@pytest.mark.parametrize("kind", sorted(SCALES))
def test_topk_in_many_pieces_by_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(topk, "GROUP", 60)
    monkeypatch.setattr(topk, "CHUNK", 9)
    monkeypatch.setattr(topk, "PIECE_BYTES", 4_000)
    rows = _rows(SCALES[kind])
    frame = spark.createDataFrame(rows, "vec_id long, vector array<double>").repartition(3)
    assert _found(topk.top_k(frame.where("vec_id % 20 = 0"), frame, k=6).collect()) == _brute(rows, 6)


def test_topk_over_many_blocks_by_brute_force():
    draw = np.random.default_rng(3)
    rows = draw.integers(-9, 10, size=(3_000, 5))
    ids = np.arange(len(rows)) // 2  # each id twice
    best = topk.Best(ids[:400:20], rows[:400:20].astype("i1"), 10)
    for at in range(0, len(rows), 1_100):
        best.search(ids[at:at + 1_100], rows[at:at + 1_100].astype("i1"))
    got = best.rows().groupby("query_id")[["vec_id", "score"]].apply(lambda x: list(map(tuple, x.to_numpy().tolist()))).to_dict()
    for q, own in zip(ids[:400:20], rows[:400:20], strict=True):
        scored = sorted((-int(s), int(i)) for s, i in zip(rows @ own, ids, strict=True) if i != q)
        assert got[q] == [(i, -s) for s, i in scored[:10]]


def test_topk_copies_no_queries_and_broadcasts_nothing(spark):
    """Copies of the queries, one for each slot, were broadcast: a row that stands for them is small, its copies are not."""
    frame = spark.createDataFrame(_rows(1.0), "vec_id long, vector array<double>")
    plan = topk.top_k(frame.where("vec_id % 20 = 0"), frame)._jdf.queryExecution().toString()
    assert "Broadcast" not in plan and "Generate" not in plan
    assert "MapInPandas" in plan
