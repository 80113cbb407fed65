"""Simple tree matching and the vote against plain definitions."""

import random

from lexitally.llm import htmltext
from lexitally.llm.htmltext import Block


def tree(rng, depth):
    block = Block(rng.choice("ab"))
    if depth and rng.random() < 0.7:
        block.children = [tree(rng, depth - 1) for _ in range(rng.randrange(5))]
    if not block.children:
        block.text = rng.choice(["", "x", "y", "z"])
    return block


def heaviest(a, b):
    """Weight of the best matching, by the definition."""
    if a.tag != b.tag:
        return 0
    best = {}
    for i in range(len(a.children) + 1):
        for j in range(len(b.children) + 1):
            best[i, j] = max(best[i - 1, j], best[i, j - 1], best[i - 1, j - 1] + heaviest(
                a.children[i - 1], b.children[j - 1])) if i and j else 0
    return 1 + (a.text != "" and a.text == b.text) + best[len(a.children), len(b.children)]


def paths(root):
    found, stack = {id(root): ()}, [root]
    while stack:
        block = stack.pop()
        for i, child in enumerate(block.children):
            found[id(child)] = (*found[id(block)], i)
            stack.append(child)
    return found


def test_matching_is_valid_and_heaviest(monkeypatch):
    for seed in range(300):
        rng = random.Random(seed)
        a, b = tree(rng, 3), tree(rng, 3)
        for few, known in ((1 << 14, 1 << 20), (0, 1 << 20), (0, 0)):
            monkeypatch.setattr(htmltext, "FEW", few)
            monkeypatch.setattr(htmltext, "KNOWN", known)
            pairs = htmltext.match(a, b)
            assert sum(1 + (x.text != "" and x.text == y.text) for x, y in pairs) == heaviest(a, b)
            pa, pb = paths(a), paths(b)
            places = [(pa[id(x)], pb[id(y)]) for x, y in pairs]
            assert all(x.tag == y.tag for x, y in pairs) and len({p for p, _ in places}) == len({q for _, q in places}) == len(pairs)
            # Parents are matched with parents, and order is kept.
            assert all(not p or (p[:-1], q[:-1]) in places for p, q in places)
            for p, q in places:
                for r, s in places:
                    if p and r and p[:-1] == r[:-1]:
                        assert (p[-1] < r[-1]) == (q[-1] < s[-1])


def test_deep_and_broad_trees():
    def deep(n):
        top = at = Block("div")
        for _ in range(n):
            at.children = [Block("div")]
            at = at.children[0]
        at.text = "x"
        return top

    assert len(htmltext.match(deep(1200), deep(1200))) == 1201

    def broad(n, own):
        top = Block("div")
        for i in range(n):
            block = Block("p")
            block.text = f"same {i}" if i % 3 else f"{own} {i}"
            top.children.append(block)
        return top

    pairs = htmltext.match(broad(4000, "a"), broad(4000, "b"))
    assert len(pairs) == 4001 and sum(x.text == y.text != "" for x, y in pairs) == 4000 - 1334


def test_templates_of_deep_pages(spark):
    page = lambda i: "<div>" * 1200 + f"<p>menu of all pages</p><p>own words of page {i}, {i * 7}</p>" + "</div>" * 1200
    rows = [(i, "http://deep/", page(i)) for i in range(8)]
    found = htmltext.main_text(spark.createDataFrame(rows, "page_id INT, url STRING, html STRING"))
    assert {r.page_id: r.text for r in found.collect()} == {i: f"own words of page {i}, {i * 7}" for i in range(8)}


def test_vote_against_its_definition():
    rng = random.Random(4)
    for _ in range(200):
        page, typical = htmltext._numbered(tree(rng, 3)), htmltext._numbered(tree(rng, 3))
        places, same, own = htmltext.votes(page, typical)
        texts = [b.text for b in page.all() if b.text]
        if not places:
            continue
        by_number = {b.number: b for b in typical.all()}
        assert set(same) <= set(places) and all(by_number[i].text for i in places)
        repeated = sorted(by_number[i].text for i in same)
        assert sorted(own + repeated) == sorted(texts)
