"""Collisions are counted in one pass over bytes, and the turn a query ends in does not depend on the one before it."""

import numpy as np

from daybook.llm import collision_ann as ann


def index(n=500, dim=8):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((n, dim))
    return ann.Index(np.arange(n), vectors, float(np.sqrt((vectors**2).sum(1)).max()), seed=5), rng.standard_normal((20, dim))


def test_cells_are_bytes_and_counts_are_exact():
    made, queries = index()
    assert made.cells.dtype == np.uint8 and made.cells.shape == (ann.LINES, 500)
    for centre in made.centres(queries):
        for turn in (0, 3, 9):
            half = ann.WIDTH * ann.WIDEN**turn
            low, high = made.cell(centre - half)[:, None], made.cell(centre + half)[:, None]
            assert (made.collisions(centre, turn) == ((made.cells >= low) & (made.cells <= high)).sum(0)).all()


def test_candidates_are_those_of_the_first_turn_with_enough():
    made, queries = index()
    for centre in made.centres(queries):
        turn = 0
        while (made.collisions(centre, turn) >= ann.THRESHOLD).sum() < 60:
            turn += 1
        first = np.flatnonzero(made.collisions(centre, turn) >= ann.THRESHOLD)
        for start in (0, turn, turn + 7):
            made.round = start
            assert made.candidates(centre, 60).tolist() == first.tolist()
        assert len(made.candidates(centre, 500)) == 500


def test_the_quick_product_loses_no_tie():
    vectors = np.tile([[1.0, 2.0], [2.0, 1.0]], (50, 1))
    made = ann.Index(np.arange(100)[::-1].copy(), vectors, 5**0.5, seed=5)
    query = np.array([1.0, 1.0])
    ids, scores = made.best(7, query, made.centres(query[None])[0], 5, 100)
    assert ids.tolist() == [0, 1, 2, 3, 4] and scores.tolist() == [3.0] * 5
