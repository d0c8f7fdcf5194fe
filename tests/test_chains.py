"""Chains of next links against a walk page by page."""

import random

import pytest

from gridlore.operators.chains import cycle_pages, landed_links, page_chains


def walk(links, limit, starts=None):
    following = {}
    for page, target in links:
        if page is not None:
            old = following.get(page)
            following[page] = target if old is None else old if target is None else min(old, target)
    led_to = {t for p, t in following.items() if t in following and t != p}

    def run(start, most):
        seen = [start]
        while True:
            target = following[seen[-1]]
            if target not in following:
                return seen, "fin" if target is None else "ausente"
            if target in seen:
                return seen, "ciclo"
            if most is not None and len(seen) >= most:
                return seen, "limite"
            seen.append(target)

    if starts is None:
        starts = set(following) - led_to
        reached = {p for s in starts for p in run(s, None)[0]}
        for page in sorted(following):
            if page not in reached:
                starts.add(page)
                reached.update(run(page, None)[0])
    out = []
    for start in set(starts) & set(following):
        pages, why = run(start, limit)
        out += [(start, i, p, why if i == len(pages) - 1 else None) for i, p in enumerate(pages)]
    return sorted(out, key=str)


def random_links(n, seed):
    rng = random.Random(seed)
    names = [f"p{i:03d}" for i in range(n)]
    links = [(p, rng.choice([None, "nowhere", p] + names + names[max(0, i - 3):i + 3] * 3)) for i, p in enumerate(names)]
    links += [(f"line{i:03d}", f"line{i + 1:03d}") for i in range(70)]  # a long chain, open
    links += [(f"ring{i:03d}", f"ring{(i + 1) % 21:03d}") for i in range(21)]  # a cycle nothing leads to
    links += [(f"six{i}", f"six{(i + 1) % 6}") for i in range(6)] + [("tail", "six4")]
    links += [(f"fan{i:03d}", "p001") for i in range(40)]  # many chains pass one page
    return links + [(None, "p001"), ("p002", None), ("p003", "p004"), ("p003", "p001")]


@pytest.mark.parametrize("limit", [1, 3, None])
def test_chains_are_the_walks(spark, limit):
    links = random_links(60, 5)
    frame = spark.createDataFrame(links, "pagina string, siguiente string")
    got = sorted((tuple(r) for r in page_chains(frame, limit).collect()), key=str)
    assert got == walk(links, limit)


def test_given_starts_and_no_rows(spark):
    links = random_links(30, 6)
    frame = spark.createDataFrame(links, "pagina string, siguiente string")
    starts = spark.createDataFrame([("ring005",), ("absent",), ("line060",), ("ring005",)], "inicio string")
    got = sorted((tuple(r) for r in page_chains(frame, None, starts).collect()), key=str)
    assert got == walk(links, None, {"ring005", "absent", "line060"})
    assert page_chains(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        page_chains(frame, 0)


def test_cycles_are_named_by_their_least_page(spark):
    links = [("b", "c"), ("c", "a"), ("a", "b"), ("x", "x"), ("t", "b"), ("u", "t"), ("e", None), ("d", "e")]
    pages = landed_links(spark.createDataFrame(links, "pagina string, siguiente string"))
    assert sorted(tuple(r) for r in cycle_pages(pages).collect()) == [("a", "a"), ("b", "a"), ("c", "a"), ("x", "x")]
