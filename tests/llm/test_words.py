import random

import numpy as np
import pyarrow as pa

from riverloom.llm import words


def test_hashes_of_runs():
    """Equal runs hash alike wherever they lie, others do not."""
    rng = np.random.default_rng(3)
    values = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    values[3000:3100] = values[200:300]
    starts = np.array([200, 3000, 200, 201, 0, 0, 4999, 4999])
    ends = np.array([300, 3100, 299, 300, 5000, 4999, 4999, 5000])
    h = words.range_hashes(values, starts, ends)
    assert h[0] == h[1] and len(set(h.tolist())) == 7
    assert words.range_hashes(values[:0], np.zeros(2, int), np.zeros(2, int)).tolist() == [h[6]] * 2


def test_runs_that_only_differ_in_number():
    same = np.full(64, 7, np.uint64)
    h = words.range_hashes(same, np.zeros(65, int), np.arange(65))
    assert len(set(h.tolist())) == 65


def test_words_of_equal_polynomials():
    """A pattern and its complement are alike for any polynomial modulo a power of two."""
    for n in (1024, 4096):
        bits = [bin(i).count("1") & 1 for i in range(n)]
        texts = ["".join("ab"[b ^ flip] for b in bits) for flip in (0, 1)]
        ((_, _, t),) = words.pieces(pa.array(texts))
        assert len(t.hashes) == 2 and t.hashes[0] != t.hashes[1]
        runs = [" ".join("ab"[b ^ flip] for b in bits) for flip in (0, 1)]
        ((_, _, t),) = words.pieces(pa.array(runs))
        _, windows = t.windows(n)
        assert len(windows) == 2 and windows[0] != windows[1]


def test_hashes_against_bytes():
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abé", k=rng.randrange(1, 5))) for _ in range(rng.randrange(50))) for _ in range(300)]
    known = {}
    for _, _, t in words.pieces(pa.array(texts), limit=700):
        for i, h in enumerate(t.hashes.tolist()):
            assert known.setdefault(t.word(i), h) == h
    assert len(set(known.values())) == len(known)


def test_runs_beyond_a_block(monkeypatch):
    """Hashes do not depend on where blocks end."""
    values = np.random.default_rng(7).integers(0, 2**63, 3000, dtype=np.uint64)
    starts, ends = np.array([0, 5, 100, 999, 1000, 2999, 3000]), np.array([3000, 2100, 101, 1001, 1000, 3000, 3000])
    want = words.range_hashes(values, starts, ends)
    words._powers.cache_clear()
    monkeypatch.setattr(words, "BLOCK", 256)
    assert words.range_hashes(values, starts, ends).tolist() == want.tolist()
    words._powers.cache_clear()


def test_distinct_as_unique():
    for values in (np.array([], np.int64), np.array([3]), np.random.default_rng(1).integers(0, 50, 500)):
        assert words.distinct(values).tolist() == sorted(set(values.tolist()))


def test_trimmed_words():
    rng = random.Random(8)
    texts = ["".join(rng.choices("a.(),-é7 ", k=rng.randrange(40))) for _ in range(400)] + ["....", "(((((a)))))", ".a."]

    def plain(word):
        signs = lambda c: c < 127 and not chr(c).isalnum()
        lo, hi = 0, len(word)
        for _ in range(3):
            lo += signs(word[lo]) and lo < hi - 1
            hi -= signs(word[hi - 1]) and lo < hi - 1
        return word[lo:hi]

    for _, _, t in words.pieces(pa.array(texts), limit=500):
        starts, ends = t.trimmed()
        got = [t.data[s:e].tobytes() for s, e in zip(starts, ends)]
        assert got == [plain(t.word(i)) for i in range(len(t.starts))]
