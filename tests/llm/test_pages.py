"""Main text of pages: articles keep what stories share, deep and long markup, matching against brute force."""
import random
import time

from tarmac.llm import html_text as H

PAGES = "page_id long, url string, html string"


def texts(spark, rows):
    return {r["page_id"]: r["text"] for r in H.main_text(spark.createDataFrame(rows, PAGES)).collect()}


def test_near_copies_keep_their_article(spark):
    same = "".join(f"<p>Paragraph {k} stands in every edition.</p>" for k in range(3))
    rows = [(i, f"http://h.example/{i}", f"<header>Daily</header><article>{same}<p>Edit {i}.</p></article><footer>End</footer>")
            for i in range(12)]
    want = "\n\n".join(f"Paragraph {k} stands in every edition." for k in range(3))
    assert texts(spark, rows) == {i: f"{want}\n\nEdit {i}." for i in range(12)}


def test_shared_sentence_stays_in_articles(spark):
    said = "The minister declined to comment."
    rows = [(i, f"http://h.example/{i}", f"<div><p>Acme Daily</p></div><article><h1>Story {i}</h1><p>What happened {i}.</p><p>{said}</p>"
             f"</article>") for i in range(3)]
    assert texts(spark, rows) == {i: f"Story {i}\n\nWhat happened {i}.\n\n{said}" for i in range(3)}


def test_constant_of_many_articles_is_template(spark):
    rows = [(i, f"http://h.example/{i}", f"<article><h1>Story {i}</h1><p>What happened {i}.</p><h4>Read our app</h4></article>")
            for i in range(20)]
    assert texts(spark, rows) == {i: f"Story {i}\n\nWhat happened {i}." for i in range(20)}


def test_deep_markup(spark):
    deep = "<div>" * 10_000 + "Deep <b>text</b>.<p>Second.</p><nav>Menu</nav>Third." + "</div>" * 10_000 + "<p>After.</p>"
    open_only = "<div><i>" * 5_000 + "x"
    rows = [(1, "http://a.example/", deep), (2, "http://b.example/", "<ul><li>" * 3_000 + "Item"),
            (3, "http://c.example/", open_only), (4, "http://a.example/2", deep.replace("Deep", "Deeper"))]
    got = texts(spark, rows)
    assert got[1] == "Deep text.\n\nSecond.\n\nThird.\n\nAfter." and got[4].startswith("Deeper text.")
    assert got[2] == "Item" and got[3] == "x"


def test_long_pages(spark):
    def page(k):
        return "".join(f"<p>Para {k} {i}</p>" if (i * k) % 7 else f"<div><h2>Title {k} {i}</h2><p>x {i}</p></div>" for i in range(30_000))

    began = time.time()
    got = texts(spark, [(k, "http://h.example/", page(k)) for k in (1, 2, 3)])
    assert time.time() - began < 90
    assert all(got[k].count("Para") == page(k).count("Para") for k in got)


def tree(rng, depth):
    n = H.Node(rng.choice("ab"))
    n.label = (n.tag,)
    n.kids = [tree(rng, depth - 1) for _ in range(rng.randrange(4))] if depth else []
    return n


def brute(a, b):
    """Simple tree matching as defined: the best matching of the children in order, by a full table."""
    if a.label != b.label:
        return 0
    t = [[0] * (len(b.kids) + 1) for _ in range(len(a.kids) + 1)]
    for i, p in enumerate(a.kids):
        for j, q in enumerate(b.kids):
            t[i + 1][j + 1] = max(t[i][j + 1], t[i + 1][j], t[i][j] + brute(p, q))
    return 1 + t[-1][-1]


def named(n, shapes):
    for k in n.kids:
        named(k, shapes)
    return shapes.name(n)


def test_matching_is_largest():
    rng = random.Random(2)
    for _ in range(300):
        a, b = tree(rng, 4), tree(rng, 4)
        b.label = a.label
        shapes = H.Shapes()
        named(a, shapes), named(b, shapes)
        numbers, _ = H._number(b)
        assert shapes.size(a, b) == brute(a, b) == H.match(a, b, numbers, shapes)
        got = []

        def walk(n):
            if n.slot >= 0:
                got.append(n.slot)
            for k in n.kids:
                walk(k)

        walk(a)
        assert len(got) == brute(a, b) and sorted(set(got)) == got   # every match once, in page order


def test_long_lists_match_like_short_ones(monkeypatch):
    def pairs_of(seed):
        rng, shapes = random.Random(seed), H.Shapes()
        def kids(n):
            return [named(tree(rng, 2), shapes) for _ in range(n)]
        return shapes.matched(kids(rng.randrange(2, 40)), kids(rng.randrange(2, 40)))

    want = [pairs_of(k) for k in range(60)]
    for most in (1, 7, 50):
        monkeypatch.setattr(H, "MOST_PAIRS", most)
        monkeypatch.setattr(H, "MOST_SIZES", most)
        assert [pairs_of(k) for k in range(60)] == want


def test_lists_beyond_the_table_are_matched_best():
    shapes = H.Shapes()

    def leaf(tag):
        n = H.Node(tag)
        n.label = (tag,)
        return shapes.name(n)

    n = 3_000   # n * n pairs are more than MOST_PAIRS
    a, c = leaf("a"), leaf("c")
    total, found = shapes.matched([c] + [a] * n, [a] * n + [c])
    assert total == n and sorted(found) == [(i + 1, i) for i in range(n)]


def test_few_and_many_hosts_give_the_same(spark, monkeypatch):
    rows = [(i, f"http://h{i % 3}.example/{i}", f"<div><p>Site {i % 3}</p></div><div><h1>Story {i}</h1><p>What happened {i}.</p></div>")
            for i in range(12)]
    want = texts(spark, rows)
    assert want[5] == "Story 5\n\nWhat happened 5."
    monkeypatch.setattr(H, "SMALL_HOSTS", 0)
    assert texts(spark, rows) == want
