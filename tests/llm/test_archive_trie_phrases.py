"""WARC archive, prefix trie and phrase mining against brute force, with odd rows, hot groups and empty tables."""
import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarmac.llm import phrases as ph
from tarmac.llm import prefix_trie as pt
from tarmac.llm import warc
from tarmac.llm.common import Scratch

PAGES = "page_id long, url string, html string, digest string, header string, n int"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], PAGES)


ODD_PAGES = [(3, "http://a/1", "<p>one</p>"), (1, "http://a/2", "<p>one</p>"), (1, "http://a/3", "<p>one</p>"),
             (7, None, None), (2, "http://a/\r\nX: y", ""), (None, "http://b", "<p>one</p>"), (None, None, "ä中"),
             (None, "u", "ä中"), (9, "http://long", "z" * 400_000), (10, "http://w", "WARC/1.1\r\n\r\n\r\nContent-Length: 5\r\n\r\n")]


def sha1_32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_archive_odd_rows(spark):
    back = warc.parsed(warc.records(warc.archive(pages_of(spark, ODD_PAGES)))).collect()
    assert len(back) == len(ODD_PAGES)
    groups = defaultdict(list)
    for i, _, html in ODD_PAGES:
        groups[html or ""].append(i)
    for html, ids in groups.items():
        got = [r for r in back if bytes(r["payload"]) == html.encode()]
        assert sorted((r["page_id"] is None, r["page_id"] or 0) for r in got) == sorted((i is None, i or 0) for i in ids)
        least = min((i for i in ids if i is not None), default=None)
        lead = [r for r in got if r["record_type"] == "response"]
        assert len(lead) == 1 and lead[0]["page_id"] == least and bytes(lead[0]["block"]) == html.encode()
        for r in got:
            assert r["payload_digest"] == sha1_32(html)
            if r["record_type"] == "revisit":
                assert (r["refers_to"], r["refers_to_id"], bytes(r["block"])) == (least, lead[0]["record_id"], b"")
    assert len({r["record_id"] for r in back}) == len(back)
    assert {r["uri"] for r in back} == {"http://a/1", "http://a/2", "http://a/3", None, "http://a/%0D%0AX: y", "http://b", "u",
                                        "http://long", "http://w"}


def test_archive_small_payloads_and_empty_table(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    back = warc.parsed(warc.records(warc.archive(pages_of(spark, rows), min_bytes=3))).collect()
    assert {r["page_id"]: r["record_type"] for r in back} == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.records(warc.archive(pages_of(spark, []))).collect() == []


def test_archive_stores_a_hot_payload_once(spark):
    rows = [(i, "u", "hot" if i % 3 == 0 else f"page {i}") for i in range(1500)]
    store = warc.archive(pages_of(spark, rows).repartition(7))
    assert store.payloads.count() == 1001
    back = warc.parsed(warc.records(store)).filter("record_type = 'revisit'").collect()
    assert len(back) == 499 and {r["refers_to"] for r in back} == {0}


def test_damaged_payload_is_found(spark):
    store = warc.archive(pages_of(spark, [(1, "u", "abc")]))
    bad = store._replace(payloads=store.payloads.withColumn("payload", F.lit(b"abd")))
    with pytest.raises(Exception, match="does not have its digest"):
        warc.records(bad).collect()


@pytest.mark.parametrize("codec", [None, "gzip"])
def test_files_round_trip(spark, tmp_path, codec):
    found = warc.records(warc.archive(pages_of(spark, ODD_PAGES))).cache()
    warc.write_files(found, str(tmp_path / "w"), codec, file_records=2)
    back = warc.read_files(spark, str(tmp_path / "w"))
    assert Counter(bytes(r[0]) for r in back.collect()) == Counter(bytes(r["record"]) for r in found.collect())
    assert warc.parsed(back).filter("content_length <> octet_length(block)").count() == 0
    found.unpersist()


# ---- prefix trie

def trie_brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            r, x = role or "", text or ""
            d = hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, d, (r, x)))
    own = {c: [t[3] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        home = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        built[c] = tuple(own.get(home, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    kids = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += kids[n] == 0
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1]) if n else 0
    return sorted((min(m), len(n), -1 if not n else min(members[n[:-1]]), len(m), kids[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(n)))).encode()).hexdigest())
                  for n, m in members.items())


CONV = "conv_id long, turn long, role string, text string, len int, rep string, a long"


def trie_rows(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], CONV).repartition(5)
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"],
                   r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"])
                  for r in pt.conversation_trie(df).collect())


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 40), *range(100, 130), *range(205, 215), -3, -100, -107]:
        for t in range(rng.choice([1, 2, 3, 5, 6, 7, 9])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice("ab")))
    return rows


def test_trie_matches_brute_force(spark):
    rows = conversations(1)
    assert trie_rows(spark, rows) == trie_brute(rows)


def test_trie_odd_rows(spark):
    rows = [(1, None, None, None), (1, None, "user", ""), (1, 0, "user", None), (1, 0, "user", None), (1, 5, None, "é中" * 9),
            (None, 1, "user", "lost"), (2, 7, "u", "x"), (2, 7, "a", "x"), (2, 7, "ux", ""), (2, None, "u", "x"),
            *((300, t, "user", f"long {t}") for t in range(70)), *((301, t, "user", f"long {t}") for t in range(71)),
            *((400, t, "u", "x" * 50_000) for t in range(2)), (499, 0, "u", "only")]
    assert trie_rows(spark, rows) == trie_brute(rows)
    assert trie_rows(spark, []) == []


def test_trie_hot_conversation(spark):
    """A third of all conversations are equal; the ends of one node fill several pieces."""
    rows = [(100 * i, 0, "u", "same" if i % 3 else f"t{i}") for i in range(1, 1500)] + [(100 * 70_000, 0, "u", "same")]
    assert trie_rows(spark, rows) == trie_brute(rows)


# ---- phrases

DOC = "doc_id long, text string, lang string, s string, word long, a long, n long"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, 2, 3) for r in rows], DOC)


def phrases_brute(rows, top=ph.TOP):
    f, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate({c: c + 32 for c in range(65, 91)})):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, *w[i:i + k]] += 1
    found = {p: n for p, n in f.items() if len(p) > 2 and n >= 10}
    out = defaultdict(list)
    for (lang, *w), a in found.items():
        if len(w) == 2 and any(len(q) == 4 and q[0] == lang and tuple(w) in (q[1:3], q[2:4]) and 100 * n >= 50 * a
                               for q, n in found.items()):
            continue
        cuts = [(10**6 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k) for k in range(1, len(w))]
        s, k = min(cuts)
        out[lang].append((-s, -a, " ".join(w).encode(), f[lang, *w[:k]], f[lang, *w[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, total[lang], -s) for lang, v in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(v)[:top], 1))


def phrase_rows(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def texts(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(6)] + ["Ünder", "ABC", "a" * 40, "中文"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\x0b", "; "]
    rows = []
    for i in range(200):
        words = []
        for _ in range(rng.randrange(60)):
            words += [rng.choice(vocabulary), rng.choice(marks)]
            if rng.random() < 0.2:
                words += ["New", " ", "York", " ", rng.choice(["City", "State"]), rng.choice(marks)]
        rows.append((i, "".join(words), rng.choice(["en", "de", None])))
    return rows + [(1, None, "en"), (None, "", None), (2, "x", "fr"), (3, " \t..", "de"), (4, "go " * 30_000, "en"), (4, "go " * 30_000, "en")]


@pytest.mark.parametrize("trie_bytes", [ph.TRIE_BYTES, 0])
def test_phrases_match_brute_force(spark, trie_bytes):
    rows = texts(3)
    got = phrase_rows(ph.collocations(docs_of(spark, rows).repartition(4), trie_bytes=trie_bytes))
    assert got == phrases_brute(rows) and len(got) > 20


def test_phrases_top_and_empty(spark):
    rows = texts(4)
    assert phrase_rows(ph.collocations(docs_of(spark, rows), top=3)) == phrases_brute(rows, 3)
    assert ph.collocations(docs_of(spark, [])).collect() == []
    assert ph.collocations(docs_of(spark, [(1, None, None), (2, "a b", "en")])).collect() == []


def test_trie_and_shuffle_count_alike_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(ph, "SHARD", 16)
    df = docs_of(spark, texts(5))
    a = ph.counts_of(df, Scratch(spark, "t"))[1].collect()
    b = ph.counts_of(df, Scratch(spark, "t"), trie_bytes=0)[1].collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) > 64


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_windows_do_not_depend_on_slices(monkeypatch, size):
    monkeypatch.setattr(ph, "SLICE", size)
    rows = [r[1] or "" for r in texts(6)][:60]
    batches = [pa.RecordBatch.from_arrays([pa.array(rows[i:i + 9]), pa.array([5] * len(rows[i:i + 9]))], ["text", "lang_key"])
               for i in range(0, 60, 9)]
    got = Counter(w for s in ph.windows(batches, 0) for w in zip(*(x.tolist() for x in s)))
    words, want = {}, Counter()
    for text in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text.translate({c: c + 32 for c in range(65, 91)})):
            w = re.findall(r"[^\x20\x09]+", piece) + ["", ""]
            want.update(zip(w, w[1:], w[2:-0 or None]) if len(w) > 2 else [])
    assert sum(got.values()) == sum(want.values()) and sorted(got.values()) == sorted(want.values())


def test_double_array_against_a_dictionary():
    rng = np.random.default_rng(1)
    for n in (1, 3, 400, 5000):
        c = rng.zipf(1.3, (n, 3)) % 300 + 1
        c[rng.random(n) < 0.4, 2] = 0
        c = np.unique(np.concatenate((c, np.column_stack((c[:, :2], np.zeros(n, dtype=c.dtype))))), axis=0)
        base, check, state = ph.double_array(c[:, 0], c[:, 1], c[:, 2])
        assert len(set(state.tolist())) == len(c) and base.dtype == check.dtype == np.int32
        probe = rng.integers(1, 301, (20_000, 3))
        probe[:len(c)] = np.where(c[:20_000] == 0, 300, c[:20_000])
        s = probe.astype(np.uint64) * 3
        s3 = s[:, 2].copy()
        symbols = np.unique(c[c > 0]).astype(np.uint64) * 3
        codes = np.where(c == 0, 0, np.searchsorted(symbols, c.astype(np.uint64) * 3) + 1)
        trie = (symbols, *ph.double_array(*codes.T)[:2])
        states = ph.double_array(*codes.T)[2]
        counts = ph.advance(trie, s[:, 0], s[:, 1], s3)
        want = Counter()
        held = set(map(tuple, c.tolist()))
        for x in probe.tolist():
            for p in ((x[0], x[1], 0), tuple(x)):
                want[p] += p in held
        assert [int(counts[t]) for t in states] == [want[tuple(p)] for p in c.tolist()]


def test_tries_have_few_empty_places():
    rng = np.random.default_rng(2)
    c = np.unique(np.minimum(rng.zipf(1.2, (20_000, 3)), 30_000), axis=0)
    c = np.unique(np.concatenate((c, np.column_stack((c[:, :2], np.zeros(len(c), dtype=c.dtype))))), axis=0)
    _, check, state = ph.double_array(*c.T)
    assert len(set(state.tolist())) == len(c) and len(check) < 3 * len(c)   # one step a word left most places empty


def test_candidates_travel_without_keys(spark):
    s = [np.array(x, dtype=np.uint64) for x in ([5, 6], [7, 8], [0, 9])]
    batch = pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in s], ["s1", "s2", "s3"])
    [got] = ph._keyed(np.uint64(0xFFFF))([batch])
    k2 = ph.pair_key(s[0], s[1])
    want = np.array([k2[0], ph.triple_key(*s)[1]]) & np.uint64(0xFFFF)
    assert got.column("k").to_pylist() == want.tolist()
    assert got.column("k2").to_pylist() == k2.view(np.int64).tolist()
