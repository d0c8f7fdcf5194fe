"""Block keys of lines travel as compressed runs and leave no table; edits of many pairs are told at once."""

import os

import numpy as np

from gridlore.llm import kernels, line_dedup
from gridlore.session import CHECKPOINT_KEY


def _written(spark):
    top = f"{spark.conf.get(CHECKPOINT_KEY)}/gridlore"
    return sum(os.path.getsize(os.path.join(d, x)) for d, _, names in os.walk(top) for x in names)


def test_lines_alone_leave_less_than_their_keys(spark):
    """Of lines that share nothing no table holds the keys: once eight bytes a word were written, beside as many and more in the shuffle."""
    rng = np.random.default_rng(8)
    words = [["".join(chr(97 + int(d)) for d in str(n)) for n in rng.integers(10**8, 10**9, 150)] for _ in range(2000)]
    docs = spark.createDataFrame([(i, " ".join(line)) for i, line in enumerate(words)], "doc_id long, text string")
    before = _written(spark)
    got = line_dedup.line_groups(docs)
    assert got.filter("n_removed > 0").isEmpty()
    assert _written(spark) - before < 4 * 2000 * 150


def test_packed_runs(spark):
    rng = np.random.default_rng(2)
    keys, codes = rng.integers(-2**63, 2**63, 5000), rng.integers(0, 2**32, 5000).astype(np.uint64)
    keys[:2000] = keys[2000:4000]
    for buckets in (1, 7, 300):
        runs = line_dedup._runs_of(keys, codes, buckets)
        got = [(int(v) for v in line_dedup.unpacked(x.as_buffer())) for x in runs.column(1)]
        bucket = [(int(k) % 2**64 >> 32) * buckets >> 32 for k in keys]
        assert sorted((b, v) for b, run in zip(runs.column(0).to_pylist(), got) for v in run) == sorted(
            {(b, int(k) % 2**32 << 32 | int(c)) for b, k, c in zip(bucket, keys, codes)})
    assert not len(line_dedup.unpacked(line_dedup.packed(np.zeros(0, np.uint64))))


def test_meetings_settle_or_keep_every_pair():
    """Every pair of a key's lines in the same band or the next is a pair to compare, or both its rows are kept."""
    rng = np.random.default_rng(4)
    for _ in range(200):
        size = int(rng.integers(0, 60))
        key, band, code = (rng.integers(0, n, size).astype(np.uint64) for n in (4, 32 if size % 2 else 5, 20))
        values = np.unique(key << np.uint64(32) | band << np.uint64(line_dedup.CODE_BITS) | code)
        pairs, rest = (set(x.tolist()) for x in line_dedup.meetings(values)[:2])
        for i, x in enumerate(values.tolist()):
            for y in values.tolist()[:i]:
                if x >> 32 == y >> 32 and abs((x >> line_dedup.CODE_BITS & 31) - (y >> line_dedup.CODE_BITS & 31)) <= 1:
                    a, b = sorted((x % 2**32, y % 2**32))
                    assert a << 32 | b in pairs or {x, y} <= rest


def test_spares_leave_a_key_in_common():
    """However keys are ordered, lines within the edits have one in common among those that both keep."""
    rng = np.random.default_rng(12)
    left_out = 0
    for size in (5, 6, 8, 9, 10, 11, 12, 13, 15, 16, 17, 18, 20, 25, 30, 60, 100):
        for _ in range(60):
            x = rng.integers(0, int(rng.choice([8, 2**62])), size).tolist()
            y = list(x)
            for _ in range(size // 5):
                at, word = int(rng.integers(0, len(y))), int(rng.integers(2**62))
                y[at:at + 1] = [[word], [y[at], word], []][int(rng.integers(3))]
            x, y = (kernels.mix(np.array(line, np.uint64)) for line in (x, y))
            if len(y) < 5 or not line_dedup.within_edits(x, y, max(len(x), len(y)) // 5):
                continue
            sides = []
            for line in (x, y):
                one = np.array([0]), np.array([len(line)])
                spare, keys = int(line_dedup.spares(line, *one)[0]), np.unique(line_dedup.block_keys(line, *one, None)[1])
                sides.append((spare, keys))
                left_out += spare
            common = np.intersect1d(sides[0][1], sides[1][1])
            rank = lambda keys: np.lexsort((keys, ~np.isin(keys, common)))  # noqa: E731 those in common first: the worst order
            kept = [keys[rank(keys)][spare:] for spare, keys in sides]
            assert np.isin(kept[0], kept[1]).any(), size
    assert left_out > 1000


def test_codes_of_lines_within_the_edits():
    sizes = np.arange(5, 20_000)
    band = line_dedup._codes(np.zeros(len(sizes), np.int64), sizes) >> line_dedup.CODE_BITS
    shorter = sizes - sizes // 5
    near = shorter >= 5
    assert (np.abs(band[near].astype(int) - band[shorter[near] - 5].astype(int)) <= 1).all()
    assert band.min() == 0 and band.max() == 31


def test_edits_of_many_pairs(monkeypatch):
    """As one by one, whether tables are worked out side by side or not."""
    rng = np.random.default_rng(6)
    left, right = [], []
    for _ in range(600):
        x = rng.integers(0, int(rng.choice([3, 30, 2**62])), int(rng.integers(1, 40))).tolist()
        y = list(x)
        for _ in range(int(rng.integers(0, len(x) // 5 + 3))):
            at, word = int(rng.integers(0, len(y))), int(rng.integers(2**62))
            y[at:at + 1] = [[word], [y[at], word], [] if len(y) > 1 else [word]][int(rng.integers(3))]
        if rng.integers(2):
            y.insert(0, y.pop())
        left.append(kernels.mix(np.array(x, np.uint64)))
        right.append(kernels.mix(np.array(y, np.uint64)))
    sizes = [np.array([len(x) for x in side]) for side in (left, right)]
    for similar in (80, 90):
        one_by_one = [line_dedup.within_edits(x, y, (100 - similar) * max(len(x), len(y)) // 100) for x, y in zip(left, right)]
        assert 100 < sum(one_by_one) < 590
        for words in (256, 12):
            monkeypatch.setattr(line_dedup, "TABLE_WORDS", words)
            got = line_dedup.all_within_edits(np.concatenate(left), sizes[0], np.concatenate(right), sizes[1], similar)
            assert got.tolist() == one_by_one
