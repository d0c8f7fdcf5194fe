"""Long lines that agree in few blocks are found all the same."""

import numpy as np

from gridlore.llm import line_dedup


def _missed_pairs(wanted):
    """Pairs of lines of 20 words with four changed that agree in no block of a limited choice."""
    rng, pairs = np.random.default_rng(3), []
    while len(pairs) < wanted:
        x = [f"w{i}" for i in rng.integers(0, 10**9, 20)]
        x = ["".join(chr(97 + int(d)) for d in w[1:]) for w in x]
        y = list(x)
        for k in (4, 8, 12, 16):
            y[k] = "z" + x[k]
        text = "\n".join([" ".join(x), " ".join(y)])
        column = line_dedup.pa.array([text])
        hashes, lines = next((h, n) for _, _, h, n in line_dedup._lines(column))
        line, key = line_dedup.block_keys(*line_dedup._runs(hashes, lines), line_dedup.BLOCKS)
        if not np.isin(key[line == 0], key[line == 1]).any():
            pairs.append((" ".join(x), " ".join(y)))
    return pairs


def test_no_pair_of_long_lines_is_missed(spark):
    pairs = _missed_pairs(20)
    rows = [(2 * i + side, text) for i, pair in enumerate(pairs) for side, text in enumerate(pair)]
    got = {r["doc_id"]: r["removed"] for r in line_dedup.line_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {doc: [] if doc % 2 == 0 else [0] for doc, _ in rows}
