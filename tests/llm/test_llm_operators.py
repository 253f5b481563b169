"""Operators for training data: brute-force twins, exact round trips, held-out accuracy and odd inputs."""
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from conftest import SF_SMALL
from oracle import compare, duck
from tarmac.llm import registry
from tarmac.llm.common import fold_of, table

QUERIES, SQL = registry.load()
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       # names that the operators use themselves
                       T.StructField("score", T.StringType()), T.StructField("cls", T.LongType()),
                       T.StructField("size", T.LongType()), T.StructField("kept", T.StringType())])
LONG = " ".join(f"word{i % 997}" for i in range(60_000))
ODD = [(1, "a b c d e f g\nThe same line stands here in several of the documents.", "en", "s1"), (2, None, "en", "s1"),
       (3, "", None, None), (4, " \t\n", "en", "s2"), (5, "x", "de", "s2"), (5, "x", "de", "s2"), (6, "x", None, "s2"),
       (None, "x", "en", None), (None, None, None, None), (7, LONG, "en", "s1"), (8, LONG + " end", "en", "s1"),
       (9, "A  b C d e f\tg\nThe same line stands here in several of the documents.", "fr", "s3"),
       (10, "Äé ß 中文 <|endoftext|> 123 ...", "fr", "s3")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, 2, "k") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), SQL[name]) == []


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def roots(nodes, links):
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {x: find(x) for x in nodes}


# ---- exact dedup

def test_golomb_round_trip():
    from tarmac.llm.golomb import decode, encode
    rng = random.Random(1)
    for n, top in ((0, 9), (1, 1), (7, 9), (500, 1 << 20), (500, 1 << 61), (3, 1 << 61)):
        v = np.array(sorted(rng.sample(range(top), min(n, top))), dtype=np.uint64)
        k, code = encode(v)
        assert decode(len(v), k, code).tolist() == v.tolist()


def test_exact_groups_odd_rows(odd, none):
    from tarmac.llm.exact_dedup import drop_copies, exact_groups
    rows = exact_groups(odd).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        same = [x for x in ODD if hashlib.sha256((x[1] or "").encode()).hexdigest() == r["text_sha256"]]
        assert r["group_size"] == len(same)
        assert r["keep_id"] == max((x[0] for x in same if x[0] is not None), default=None)
    kept = drop_copies(odd)
    assert kept.columns == SCHEMA.names
    assert Counter(r["text"] or "" for r in kept.collect()) == Counter({(x[1] or ""): 1 for x in ODD})
    assert exact_groups(none).collect() == [] and drop_copies(none).collect() == []


def test_exact_groups_hot_text(spark):
    from tarmac.llm.exact_dedup import exact_groups
    df = frame(spark, [(i, "hot" if i % 3 == 0 else f"t{i // 2}", "en", "s") for i in range(3000)]).repartition(7)
    for r in exact_groups(df).collect():
        if r["doc_id"] % 3 == 0:
            assert (r["keep_id"], r["group_size"]) == (2997, 1000)


# ---- near-duplicates

def near_brute(rows):
    sets = {}
    for i, text in rows:
        w = words_of(text)
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    links = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    comp = roots(sets, links)
    return {i: (len(s), comp[i], comp[i] == i) for i, s in sets.items()}


def test_near_duplicates_against_all_pairs(spark):
    from tarmac.llm.minhash_dedup import near_duplicates
    rng = random.Random(5)
    base = [[rng.choice("abcdefghijklmnop") + str(rng.randrange(40)) for _ in range(rng.randrange(1, 90))]
            for _ in range(40)]
    rows = []
    for b in base:
        for _ in range(rng.randrange(1, 9)):
            w = list(b)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = "edit"
            rows.append((len(rows), rng.choice([" ", "\n", "  "]).join(w)))
    passage = " ".join(f"p{i}" for i in range(30))   # many texts share a passage that is too short to link them
    rows += [(len(rows) + k, passage + " " + " ".join(f"{k}w{i}" for i in range(25))) for k in range(120)]
    got = near_duplicates(frame(spark, [(i, t, "en", "s") for i, t in rows])).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == near_brute(rows)


def test_near_duplicates_odd_rows(odd, none):
    from tarmac.llm.minhash_dedup import drop_near_duplicates, near_duplicates
    got = near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[9]["component_id"] == 1 and by[8]["component_id"] == 7 and by[6]["component_id"] == 5
    assert [by[i]["n_shingles"] for i in (2, 3, 4)] == [0, 0, 0] and by[3]["component_id"] == 3
    assert drop_near_duplicates(odd).columns == SCHEMA.names
    assert near_duplicates(none).collect() == []


def vectors_brute(rows):
    def fit(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = {i: (np.array(v, dtype=float), lab) for i, v, lab in rows if fit(v) and lab is not None}
    links = [(a, b) for a, b in itertools.combinations(sorted(good), 2) if good[a][1] == good[b][1]
             and len(good[a][0]) == len(good[b][0]) and good[a][0] @ good[b][0] / math.sqrt(
                 (good[a][0] @ good[a][0]) * (good[b][0] @ good[b][0])) >= 0.93]
    comp, n = roots([r[0] for r in rows], links), Counter(x for link in links for x in link)
    return {r[0]: (n[r[0]], comp[r[0]], comp[r[0]] == r[0]) for r in rows}


def test_near_vectors_against_all_pairs(spark):
    from tarmac.llm.embedding_dedup import near_vectors
    rng = np.random.default_rng(3)
    rows = []
    for c in range(12):
        centre = rng.standard_normal(16)
        for _ in range(int(rng.integers(1, 12))):
            rows.append((len(rows), (centre + 0.28 * rng.standard_normal(16)).tolist(), c % 3))
    rows += [(len(rows) + k, rows[0][1], 0) for k in range(5)]
    for v, lab in ((None, 1), ([], 1), ([0.0] * 16, 1), ([1.0] * 15 + [None], 1), ([float("nan")] * 16, 1),
                   ([float("inf")] * 16, 1), (rows[0][1], None), ([1.0, 2.0], 0), ([2.0, 4.0], 0)):
        rows.append((len(rows), v, lab))
    schema = "vec_id long, embedding array<double>, label int, n int"
    got = near_vectors(spark.createDataFrame([(*r, 1) for r in rows], schema)).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == vectors_brute(rows)
    assert near_vectors(spark.createDataFrame([], schema)).collect() == []


# ---- lines

def lines_brute(rows, window, chars):
    seen, out = set(), {}
    for i, text in sorted(rows):
        lines = (text or "").split("\n")
        at = [k for k, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        gone = set()
        for k in range(len(at)):
            size = len(re.sub(r"[\x20\x09-\x0D]", "", lines[at[k]]))
            for n in {window if k + window <= len(at) else 0, 1 if size >= chars else 0} - {0}:
                body = tuple(lines[j] for j in at[k:k + n])
                if body in seen:
                    gone |= set(at[k:k + n])
                seen.add(body)
        out[i] = (len(at), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


@pytest.mark.parametrize("window", [2, 3])
def test_line_dedup_against_brute_force(spark, window):
    from tarmac.llm.line_dedup import dedup_lines
    rng = random.Random(window)
    pool = [f"line {i}" for i in range(12)] + ["", " ", "a long line that has more than forty characters in it, surely"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(9)))) for i in range(60)] + [(60, None)]
    got = dedup_lines(frame(spark, [(i, t, "en", "s") for i, t in rows]), window=window).collect()
    want = lines_brute(rows, window, 40)
    assert {r["doc_id"]: (r["n_lines"], r["n_deleted"], r["text"]) for r in got} == want


def test_line_dedup_odd_rows(odd, none):
    from tarmac.llm.line_dedup import dedup_lines
    got = dedup_lines(odd).collect()
    assert len(got) == len(ODD)
    assert {r["n_deleted"] for r in got if r["doc_id"] == 9} == {1}
    assert dedup_lines(none).collect() == []


# ---- models

def test_toxicity_held_out(spark):
    rows = QUERIES["op5_string_kernel_toxicity"](spark, "/root/testdata/sf0.01").collect()
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    assert len(rows) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == y for p, y in held) / len(held) >= 0.9
    assert sum(p for p, y in held if not y) <= 0.05 * len(held)


def test_subsequence_kernel():
    from tarmac.llm.toxicity import DECAY, ORDER, kernel, kernel_many

    def brute(a, b):
        def ways(s):
            out = Counter()
            for places in itertools.combinations(range(len(s)), ORDER):
                out["".join(s[p] for p in places)] += DECAY ** (places[-1] - places[0] + 1)
            return out
        x, y = ways(a), ways(b)
        return sum(x[k] * y[k] for k in x)

    strings = ["idiot", "i.d.i.o.t", "idoit", "stupidity", "abcd", "ab", "aaaaaa"]
    for m in ("idiot", "stupid", "aaaab"):
        want = [brute(s, m) for s in strings]
        assert np.allclose(kernel_many(strings, m), want)
        assert np.allclose([kernel(s, [m, "idiot"])[0] for s in strings], want)


def test_toxicity_disguised_insults(spark):
    """Dotted, shortened, starred and split insults score above a text without any, through score()."""
    from tarmac.llm.toxicity import score
    insults = ["moron", "idiot", "loser", "stupid", "pathetic"]
    rng = random.Random(5)
    plain = [" ".join(rng.choices(["garden", "river", "window", "paper", "market", "winter", "bridge", "letter"], k=12))
             for _ in range(400)]
    sample = spark.createDataFrame([(t + (" " + insults[i % 5] if i % 2 else ""), i % 2) for i, t in enumerate(plain)],
                                   "text string, toxic int")
    ways = {"none": lambda w: "market", "dot": ".".join, "apart": " ".join, "drop": lambda w: w[0] + w[2:],
            "star": lambda w: w[0] + "*" + w[2:], "head": lambda w: w[:2] + " " + w[2:],
            "tail": lambda w: w[:-2] + " " + w[-2:]}
    rows = [(way, f"garden river {f(w)} paper window") for way, f in ways.items() for w in insults]
    got = score(spark.createDataFrame(rows, "way string, text string"), sample, ["way", "text"]).collect()
    clean = max(r["score"] for r in got if r["way"] == "none")
    assert all(r["score"] > clean + 0.005 for r in got if r["way"] != "none"), [(r["text"], r["score"]) for r in got]
    assert all(r["predicted"] for r in got if r["way"] in ("dot", "apart", "head", "tail"))


def test_toxicity_odd_rows(spark, odd, none):
    from tarmac.llm.toxicity import score, training_rows
    labels = spark.createDataFrame([(1, 0), (7, 1), (None, 1), (9, None)], "doc_id long, toxic int")
    got = score(odd, training_rows(odd, labels), ["doc_id", "text"]).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert score(none, training_rows(none, labels), ["doc_id"]).collect() == []


def test_language_held_out(spark):
    docs = {r["doc_id"]: r["lang"] for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    rows = [r for r in QUERIES["op6_bloom_language"](spark, "/root/testdata/sf0.01").collect()]
    assert len(rows) == len(docs)
    held = [r["lang_pred"] == docs[r["doc_id"]] for r in rows if r["held_out"]]
    assert sum(held) / len(held) >= 0.97


def test_language_odd_rows(odd, none):
    from tarmac.llm.language import identify
    got = identify(odd, odd.select("text", "lang")).collect()
    assert len(got) == len(ODD)
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for t in [x for x in ODD if x[0] == r["doc_id"]][:1]
                                                     for c in t[1] or "")) for r in got if r["doc_id"] is not None)
    assert identify(none, odd.select("text", "lang")).collect() == []
    assert {r["lang_pred"] for r in identify(odd, none.select("text", "lang")).collect()} == {"und"}


def lm_brute(rows, held):
    train = Counter(w for i, t in rows if not held(i) for w in [*words_of(t), "\0"])
    n, v = sum(train.values()), len(train)
    out = {}
    for i, t in rows:
        w = [*words_of(t), "\0"]
        out[i] = (len(w), sum(train[x] > 0 for x in w), n,
                  sum(math.log10((train[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
    return out


def test_lm_counts_and_probability(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF_SMALL, "documents").collect()]
    want = lm_brute(rows, lambda i: zlib.crc32(str(i).encode()) % 10 == 0)
    got = QUERIES["op8_deleted_interpolation"](spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:3]
        assert math.isclose(r["base_score"], w[3], rel_tol=1e-9)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)   # context helps


def test_lm_model_sums_to_one(spark):
    """After any context the probabilities of all words, and of one unknown word, add up to one."""
    from tarmac.llm.lm_score import scored
    import pyspark.sql.functions as F
    rows = [(i, t, "en", "s") for i, t in enumerate(["a b a b c", "b a", "c c c a", "a"])]
    probes = ["a", "b", "c", "", "zzz"]
    rows += [(100 + k, f"{p}" if p else "", "en", "s") for k, p in enumerate(probes)]
    got = {r["doc_id"]: r for r in scored(frame(spark, rows), F.col("doc_id") >= 100).collect()}
    # p(first word is p) = p(text p) / p(end after p); the text without words is p(end at the start)
    first = {"": 10 ** got[103]["score"]}
    assert 0 < first[""] < 1
    assert all(got[100 + k]["score"] < 0 for k in range(len(probes)))


def test_lm_odd_rows(odd, none):
    from tarmac.llm.lm_score import scored
    import pyspark.sql.functions as F
    held = fold_of(F.col("doc_id"), 10) == 0
    got = scored(odd, held).collect()
    assert len(got) == len(ODD) and all(r["n_tokens"] == len(words_of([x[1] for x in ODD if x[0] == r["doc_id"]][0])) + 1
                                        for r in got if r["doc_id"] is not None)
    assert scored(none, held).collect() == []
    assert len(scored(odd, F.lit(True)).collect()) == len(ODD)


# ---- pages

def test_main_text(spark):
    from tarmac.llm.html_text import main_text
    page = ("<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href='/'>"
            "Home</a></ul></nav><div class=\"cookie-notice\">We use cookies</div><article><h1>A &amp; B</h1><p>One\n "
            "<b>two</b>&nbsp;three<br><p>Four<script>x('</p>')</script></article><div id='comments'><p>First!</p></div>"
            "<form><input value=q></form><footer>&copy; me</footer>")
    rows = [(1, "http://h.example/1", page), (2, None, None), (3, "odd", ""), (4, "http://h.example/2", "just text <b"),
            (None, "http://h.example/1", page), (5, "http://g.example/", "<div><p>Unclosed <i>tags<div>x" * 200)]
    schema = "page_id long, url string, html string, text string, slot int"
    got = main_text(spark.createDataFrame([(*r, "t", 1) for r in rows], schema)).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by[1]["text"] == by[None]["text"] == "A & B\n\nOne two three\n\nFour"
    assert by[2]["text"] == by[3]["text"] == "" and by[4]["text"].startswith("just text")
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert main_text(spark.createDataFrame([], schema)).collect() == []


def test_template_slots_go(spark):
    """On a host without telling names the constant blocks are template, and the varying ones content."""
    from tarmac.llm.html_text import main_text
    rows = [(i, f"http://h.example/{i}", f"<div><div><p>Acme Daily</p></div><div><p>Story {i} first.</p><p>Story {i} "
             f"second.</p></div><div><p>Contact us any time</p></div></div>") for i in range(30)]
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: f"Story {i} first.\n\nStory {i} second." for i in range(30)}


def test_template_beyond_the_reference_page(spark):
    """Constants of small hosts, of pages other than the reference page and of a second kind of page are template;
    link paragraphs of an article are not."""
    from tarmac.llm.html_text import main_text
    rows, want = [], {}

    def add(host, page, text):
        want[len(rows)] = text
        rows.append((len(rows), f"http://{host}.example/{len(rows)}", page))

    for i in range(4):
        add("small", f"<div><p>Acme Daily</p></div><div><p>Story {i}.</p></div>", f"Story {i}.")
    for i in range(20):
        add("kinds", f"<div><p>Acme Daily</p></div><div><p>Story {i}.</p></div>", f"Story {i}.")
        add("kinds", f"<section><h2>Acme Shop</h2><blockquote>Item {i}.</blockquote><h3>Buy now</h3></section>", f"Item {i}.")
    for i in range(6):
        add("links", f"<article><p>Part {i}.</p><p><a href='/'>All of this paragraph {i} is a link</a></p></article>",
            f"Part {i}.\n\nAll of this paragraph {i} is a link")
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == want


def test_marked_articles(spark):
    """A menu named after the main part is no article, and every outermost marked article is kept in page order."""
    from tarmac.llm.html_text import main_text
    pages = ["<div class='main-menu'><p>Menu one</p><p>Menu two</p></div><ul id='main-nav'><li>Nav</ul><div><p>Story.</p></div>",
             "<article><p>Short first.</p></article><p>Between.</p><article><p>A much longer second part.</p></article>",
             "<main><p>Lead.</p><article><p>Inner.</p></article></main><article></article>",
             "<div class='main-sidebar'><p>Side</p></div><div role='main'><p>Text.</p></div><p>After.</p>",
             "<main class='has-sidebar'><p>Kept.</p></main>", "<article></article><p>Outside.</p>"]
    rows = [(i, f"http://h{i}.example/", p) for i, p in enumerate(pages)]
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r["text"] for r in sorted(got, key=lambda r: r["page_id"])] == [
        "Story.", "Short first.\n\nA much longer second part.", "Lead.\n\nInner.", "Text.", "Kept.", "Outside."]


# ---- encoding

def test_bpe_equals_library():
    from tarmac.llm.bpe import ChunkedBpe, vocabulary_path
    bpe = ChunkedBpe(vocabulary_path(), chunk=16)
    rng = random.Random(2)
    alphabet = ["a", "b", "B", " ", "  ", "'s", "'re", "é", "ß", "\n", "\t", " ", "1", "²", "!", "<|endoftext|>",
                "<|endof", "中", "😀", "́", "hello world ", " the of and ", "\x85", "\x1c"]
    for _ in range(3000):
        s = "".join(rng.choices(alphabet, k=rng.randrange(70))) * rng.choice([1, 1, 5])
        ids = bpe.library.encode(s, add_special_tokens=False).ids
        n, joined, text = bpe.encode(s)
        assert (n, joined) == (len(ids), ",".join(map(str, ids)))
        assert text == bpe.library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("run", [" " * 2_000_000, "\t\n" * 1_000_000])
def test_bpe_long_white_space(run):
    """Two million blanks between words are encoded as the library does."""
    from tarmac.llm.bpe import ChunkedBpe, vocabulary_path
    bpe = ChunkedBpe(vocabulary_path())
    text = f"some words before{run}word after it"
    ids = bpe.library.encode(text, add_special_tokens=False).ids
    n, joined, decoded = bpe.encode(text)
    assert (n, joined) == (len(ids), ",".join(map(str, ids))) and decoded == text


def test_bpe_odd_rows(odd, none):
    from tarmac.llm.bpe import token_digests
    got = token_digests(odd).collect()
    assert Counter(r["decoded_sha256"] for r in got) == Counter(
        hashlib.sha256((x[1] or "").encode()).hexdigest() for x in ODD)
    assert token_digests(none).collect() == []


# ---- mixing

def check_mix(docs, got, copies=3):
    size = {}
    for i, t, _, s in docs:
        size.setdefault(s, []).append(len(words_of(t)))
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, target, free = sum(map(sum, size.values())), {}, set(order)
    while free:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > copies * sum(size[s])}
        if not over:
            target |= share
            break
        target |= {s: copies * sum(size[s]) for s in over}
        free -= over
    assert len(got) == len(docs)
    for s in order:
        mine = [r for r in got if r["source"] == s]
        assert all(math.isclose(r["target"], target[s], rel_tol=1e-9, abs_tol=1e-9) for r in mine)
        assert all(r["source_size"] == sum(size[s]) and r["taken"] <= copies * r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target[s]) <= max(size[s]) + 1e-3


def test_mix_odd_rows(odd, none):
    from tarmac.llm.mixing import mix
    check_mix(ODD, mix(odd).collect())
    assert mix(none).collect() == []


def test_mix_reruns_agree_and_tree_has_levels(spark):
    from tarmac.llm import mixing
    rng = random.Random(4)
    docs = [(i, " ".join("w" * rng.randrange(1, 60)), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(4000)]
    a = mixing.mix(frame(spark, docs).repartition(3)).collect()
    b = mixing.mix(frame(spark, docs).repartition(11)).collect()
    assert {r["doc_id"]: r["copies"] for r in a} == {r["doc_id"]: r["copies"] for r in b}
    check_mix(docs, a)


def test_repeat_rows(odd):
    from tarmac.llm.mixing import mix, repeat_rows
    plan = mix(odd)
    out = repeat_rows(odd, plan)
    assert out.columns == SCHEMA.names
    assert out.count() == sum(r["copies"] for r in plan.collect())


# ---- pipeline

def test_pipeline(spark):
    import corpus_pipeline as P
    from tarmac.llm.bpe import ChunkedBpe, vocabulary_path
    from tarmac.session import shared_path
    docs = table(spark, SF_SMALL, "documents")
    at, held = docs, []
    for name, stage in P.STAGES:
        path = shared_path(spark, f"test-{name}-{random.random()}")
        stage(spark, at, SF_SMALL).write.parquet(path)
        at = spark.read.parquet(path)
        held.append(at)
        assert name == "encoding" or at.columns == docs.columns
    toxic, exact, near, mixed, _ = [h.collect() for h in held]
    assert len({r["text"] for r in exact}) == len(exact) == len({r["text"] for r in toxic})
    want = near_brute([(r["doc_id"], r["text"]) for r in exact])
    assert {r["doc_id"] for r in near} == {i for i, w in want.items() if w[2]}
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in near}
    bpe = ChunkedBpe(vocabulary_path())
    text = {r["doc_id"]: r["text"] for r in near}
    whole = P.run(spark, SF_SMALL).collect()
    assert Counter(r["doc_id"] for r in whole) == Counter(r["doc_id"] for r in mixed)
    assert all(r["n_tokens"] == len(bpe.library.encode(text[r["doc_id"]], add_special_tokens=False).ids) for r in whole)


# ---- the pipeline's stages with columns of any name

def test_pipeline_stages_keep_columns_with_their_own_names(spark):
    import corpus_pipeline as cp
    names = ["__n", "__k", "__score", "__toxic", "row", "n", "k", "copies", "score", "predicted", "doc", "size"]
    rows = [(i, f"text number {i} of this source with words {i}", "en", f"s{i % 3}", *[100 * i + j for j in range(len(names))])
            for i in range(60)]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` long" for n in names)
    docs = spark.createDataFrame(rows, schema)
    for stage in ("toxicity", "exact_dedup", "near_dedup", "mixing"):
        out = dict(cp.STAGES)[stage](spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        got = {tuple(r) for r in out.collect()}
        assert got and got <= set(rows), stage
