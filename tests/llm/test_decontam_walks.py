import random

import numpy as np
import pyarrow as pa
import pytest

from inkspan.llm import decontam as D
from inkspan.llm import kernel as K


def found_share(n, spoil, items=80, module=D):
    """Share of items of n words found, each in a document of its own that holds it with its e edits."""
    rng = random.Random(n)
    texts = [[f"w{rng.randrange(10**9)}" for _ in range(n)] for _ in range(items)]
    e = D.edits_allowed(n)
    docs = [" ".join([f"a{rng.randrange(10**9)}" for _ in range(30)] + spoil(rng, list(t), e) + [f"z{rng.randrange(10**9)}" for _ in range(30)]) for t in texts]
    finder = module.Finder(module.build_index([(i, " ".join(t)) for i, t in enumerate(texts)]))
    for i, _, buf, offs in K.chunks(pa.array(docs)):
        finder.screen(i, buf, offs)
    found = finder.found()
    assert all(d == i and k <= e for d, i, k, _, _ in found)
    return len(found) / items


def spread(rng, t, e):
    for _ in range(e):
        p, kind = rng.randrange(len(t)), rng.randrange(3)
        t[p : p + (kind != 1)] = [] if kind == 2 else [f"n{rng.randrange(10**9)}"]
    return t


def early(rng, t, e):
    """All edits in the first 24 words."""
    return spread(rng, t[:24], e) + t[24:]


def inserted(rng, t, e):
    """Words inserted into the first 12."""
    for _ in range(e):
        t.insert(rng.randrange(1, 12), f"n{rng.randrange(10**9)}")
    return t


def run(rng, t, e):
    """A run of inserted words in the middle."""
    return t[: len(t) // 2] + [f"n{rng.randrange(10**9)}" for _ in range(e)] + t[len(t) // 2 :]


@pytest.mark.parametrize("n", [39, 59])
@pytest.mark.parametrize("spoil", [spread, early, inserted, run])
def test_recall_wherever_the_edits_lie(n, spoil):
    assert found_share(n, spoil) >= D.TARGET_RECALL


def test_distances_in_a_band_against_dictionaries():
    from tests.llm.test_decontam import distance

    rng = np.random.default_rng(3)
    for n, e in ((2, 0), (5, 1), (12, 2), (20, 4)):
        items, windows = (rng.integers(1, 5, (60, w), dtype=np.uint64) for w in (n, n + e))
        windows[:30, :n] = items[:30]
        windows[:30, n // 2] = 9
        length = rng.integers(n - e, n + e + 1, 60)
        got = D.distances(items, windows, e, length)
        for k in range(60):
            row = distance(list(items[k]), list(windows[k][: length[k]]))
            least = min(row[n - e : n + e + 1], default=n)
            assert got[k] == (least if least <= e else n + e + 1)


def test_repetitions_do_not_claim_what_they_miss():
    """As many as are returned find the target share of fresh pairs of each kind; where too few are allowed, none are."""
    n, e, sampled = 55, 11, 3
    most = D.repetitions(n, e, sampled, 0.98)
    if most:
        rng = np.random.default_rng(77)
        for kind in D.KINDS:
            a = rng.integers(1, 1 << 62, (100, n), dtype=np.uint64)
            b = D.ended(np.stack([D.spoiled(x, e, rng, *kind) for x in a]))
            a, hit = D.ended(a), np.zeros(100, bool)
            for s in range(most):
                c = D.coordinates(n, s, sampled)
                hit |= D.key_of(a, D.walk(a, s, 2 * n)[c], n) == D.key_of(b, D.walk(b, s, 2 * n)[c], n)
            assert hit.mean() >= 0.93
    assert D.repetitions(n, e, sampled, 0.98, 8) is None


def test_lengths_beyond_all_repetitions_are_verified_exhaustively(monkeypatch):
    monkeypatch.setattr(D, "repetitions", lambda *a: None)
    for spoil in (spread, early, inserted, run):
        assert found_share(39, spoil) == 1
