"""The operators on awkward rows, each against a brute-force version."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obsengine.llm import compression, decontam, licenses, lm, packing, probminhash, queries, secrets, tokenids, viterbi, winnow

from .conftest import LONG, TEXTS

EMPTY = hashlib.sha256(b"").hexdigest()


def test_secrets(docs, none):
    got = secrets.secrets_digest(docs).collect()
    want = []
    for i, t in TEXTS:
        t = t or ""
        spans = [
            (m.start(), 0, f"assign:{m.start()}:{m.end()}")
            for m in re.finditer(secrets.RULES[0].pattern, t, re.I | re.A) if len(m[2]) >= 12
        ]
        spans += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        spans += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        text = ",".join(s for *_, s in sorted(spans))
        n = [sum(k == j for _, k, _ in spans) for j in range(3)]
        want.append((i, *n, hashlib.sha256(text.encode()).hexdigest()))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    assert sum(r.n_hex for r in got) and sum(r.n_assign for r in got)
    assert secrets.secrets_digest(none).count() == 0
    clash = docs.withColumn("secrets", F.lit(1))
    out, name = secrets.scan_secrets(clash)
    assert name == "secrets_" and out.count() == len(TEXTS)


def test_trigram_queries():
    assert secrets.trigram_query("[0-9a-f]+") == []
    assert secrets.trigram_query("abcd[x-z]+efg?") == [frozenset({frozenset({b"abc", b"bcd"})})]
    either = secrets.trigram_query("(foo|bard)+x")[0]
    assert either == frozenset({frozenset({b"foo"}), frozenset({b"bar", b"ard"})})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 60000) | st.just(7), max_size=400))
def test_word_aligned_round_trip(ids):
    ids = np.array(ids, np.uint64)
    words, blocks = tokenids.encode_ids(ids)
    assert (tokenids.decode_ids(words, blocks, len(ids)) == ids).all()


def exact_ids(name, text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_file(name))
    return t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_ids(docs, none):
    out = tokenids.read_token_ids(
        tokenids.write_token_ids(docs, queries.tokenizer_file(queries.BYTE_BPE)), with_ids=True
    ).orderBy("start").collect()
    at = 0
    for r in out:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == crc(r.ids)
        at += r.n_tokens
    ids = [r.doc_id for r in out]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    want = collections.Counter((i, tuple([*exact_ids(queries.BYTE_BPE, t), 2])) for i, t in TEXTS)
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in out) == want
    assert tokenids.token_id_digest(none, queries.tokenizer_file(queries.BYTE_BPE)).count() == 0


@pytest.mark.parametrize("open_windows", [1, 3, 128])
def test_packing(docs, none, open_windows):
    path = queries.tokenizer_file(queries.WORD_BPE)
    out = packing.pack_documents(docs, path, capacity=256, open_windows=open_windows).collect()
    places = collections.defaultdict(list)
    pieces = collections.defaultdict(list)
    for r in out:
        places[r.sequence_id].append((r.offset, r.length))
        assert r.ids_crc32 == crc(r.ids) and len(r.ids) == r.length
        pieces[(r.doc_id, r.doc_tokens)].append((r.start, r.ids))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end and length > 0
            end += length
        assert end <= 256
    total = sum(len(exact_ids(queries.WORD_BPE, t)) + 1 for _, t in TEXTS)
    assert sum(r.length for r in out) == total
    one = sorted(pieces[(8, len(exact_ids(queries.WORD_BPE, LONG)) + 1)], key=lambda p: p[0])
    assert [i for _, ids in one for i in ids] == [*exact_ids(queries.WORD_BPE, LONG), 1]
    assert packing.pack_documents(none, path).count() == 0


def test_best_fit_rule():
    w = packing.OpenWindows(10, 2)
    assert [w.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    assert w.emitted == {0, 1}
    w = packing.OpenWindows(10, 2)
    assert [w.place(n)[0] for n in (6, 7, 8)] == [0, 1, 2] and w.emitted == {1}  # the fullest goes


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_matches_definition(docs, order):
    mass = 50.0
    got = lm.score_texts(docs, order=order, mass=mass, block_bytes=2000).collect()
    words = lambda t: [w.decode() for w in (t or "").encode().lower().split()]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    counts = [collections.Counter() for _ in range(order + 1)]
    for i, t in TEXTS:
        if not held(i):
            s = ["<s>", *words(t), "</s>"]
            for m in range(1, order + 1):
                counts[m].update(tuple(s[k : k + m]) for k in range(len(s) - m + 1))
    single = {k[0]: c for k, c in counts[1].items() if k[0] != "<s>"}
    n, v = sum(single.values()), len(single)

    def p(h, w):
        if not h:
            return (single.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))
        return (counts[len(h) + 1][(*h, w)] + mass * p(h[1:], w)) / (counts[len(h)][h] + mass)

    want = []
    for i, t in TEXTS:
        s = ["<s>", *words(t), "</s>"]
        score = sum(math.log10(p(tuple(s[max(0, k - order + 1) : k]), s[k])) for k in range(1, len(s)))
        base = sum(math.log10(p((), w)) for w in s[1:])
        want.append((str(i), held(i), len(s) - 1, sum(w in single for w in s[1:]), n, round(base, 6), round(score, 6)))
    rows = [
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
        for r in got
    ]
    assert sorted(rows) == sorted(want)


def test_lm_empty(none):
    assert lm.score_texts(none).count() == 0


def test_licenses(docs, none):
    out = {(r.doc_id, r.n_paragraphs): r for r in licenses.license_report(docs).collect()}
    assert out[(None, 2)].families == "CC-BY-NC" and out[(None, 2)].n_confirmed == 1
    assert all(r.n_confirmed == 0 for k, r in out.items() if k[0] is not None)
    assert licenses.license_report(none).count() == 0


def test_license_classifier_on_held_out_variants():
    model = licenses.train(["the river ran down to the sea", "some words of ordinary prose here"] * 50)
    right = 0
    cases = [(f, "and so on " + t + " more of it") for f, ts in licenses.TEMPLATES.items() for t in ts]
    for family, text in cases:
        hits = licenses.scan_texts(model, [text.encode()])[1][0]
        right += any(h["family"] == family and h["confirmed"] for h in hits)
    assert right >= 0.9 * len(cases)
    assert not any(h["confirmed"] for d in licenses.DECOYS for h in licenses.scan_texts(model, [d.encode()])[1][0])


def test_license_hits_far_apart_and_side_by_side():
    model = licenses.train(["the river ran down to the sea", "some words of ordinary prose here"] * 50)
    scan = lambda t: [h for h in licenses.scan_texts(model, [t.encode()])[1][0] if h["confirmed"]]
    notice = {f: ts[0] for f, ts in licenses.TEMPLATES.items()}
    far = scan(notice["GPL"] + " river sea" * 5000 + " " + notice["GPL"] + " river sea" * 50)
    assert [h["family"] for h in far] == ["GPL", "GPL"] and far[1]["first_word"] - far[0]["first_word"] > 9000
    long = scan("river sea " * 12 + licenses.TEMPLATES["GPL"][1] + " river sea" * 40)
    assert [h["family"] for h in long] == ["GPL"]
    pairs = [("MIT", "Apache-2.0"), ("GPL", "MIT"), ("BSD", "Apache-2.0"), ("Apache-2.0", "MIT"), ("MPL-2.0", "GPL")]
    for a, b in pairs:
        assert {h["family"] for h in scan(notice[a] + " " + notice[b])} == {a, b}, (a, b)
    for family, templates in licenses.TEMPLATES.items():
        for t in templates:
            assert {h["family"] for h in scan(t)} <= {family}, t
    lgpl = licenses.TEMPLATES["LGPL"][1] + ", either version 2.1 of the License, or (at your option) any later version."
    assert {h["family"] for h in scan(lgpl)} == {"LGPL"}


def test_license_sample_reads_whole_texts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(licenses, "train", lambda ordinary: seen.extend(ordinary))
    long = "front " * 5000 + "\n" + "word " * 60 + "tail of the text"
    rows = [(1, long), (2, "a copyright line\nplain line"), (3, None), (4, "")]
    licenses.fit_on(spark.createDataFrame(rows, "doc_id long, text string"))
    assert any("tail of the text" in p for p in seen) and "plain line" in seen
    assert max(len(p.split()) for p in seen) <= licenses.SEGMENT
    assert not any("copyright" in p for p in seen)


def test_decontamination(spark, docs, none):
    items = [(1, " ".join(f"WORD{i}" for i in range(20, 35))), (2, "lazy... dog"), (3, None), (4, "!!"), (None, "it's"), (5, "no such words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found, name = decontam.decontaminate(docs, bench)
    rows = found.select("doc_id", "text", f"{name}.*").collect()

    def words(t):
        lower = (t or "").translate({c: c + 32 for c in range(65, 91)})
        return [(m[0], m.span()) for m in re.finditer("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)]

    for r in rows:
        own = words(r.text)
        hit, names = set(), set()
        for i, t in items:
            w = [x for x, _ in words(t)]
            for a in range(max(1, len(w) - 9)) if w else ():
                win = w[a : a + 10]
                for k in range(len(own) - len(win) + 1):
                    if [x for x, _ in own[k : k + len(win)]] == win:
                        hit |= set(range(k, k + len(win)))
                        names.add("null" if i is None else str(i))
        assert (r.n_words, r.n_hit, r["items"]) == (len(own), len(hit), sorted(names))
        for h in r.hits:
            assert (h.start, h.end) == (own[h.first_word][1][0], own[h.last_word][1][1])
    # several automata give the same
    parts, name = decontam.decontaminate(docs, bench, automaton_bytes=40)
    assert sorted(str(x.leaks) for x in parts.select(F.col(name).alias("leaks")).collect()) == sorted(
        str(x.leaks) for x in found.select(F.col("leaks")).collect()
    )
    assert decontam.leaks_digest(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontam.leaks_digest(none, bench).count() == 0


def test_quality(docs, none):
    rows = compression.quality_rules(docs)[0].select("text", "quality.*").collect()
    for r in rows:
        t = r.text or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        win = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        rep = {i + k for i in range(len(w) - 2) if win[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 50 or 100 * len(rep) > 50 * len(w))
        assert not (r.base_failed and r.kept)
    assert compression.quality_digest(none).count() == 0
    kept = compression.keep_quality(docs)
    verdicts = compression.quality_digest(docs).where("kept").count()
    assert kept.columns == docs.columns and kept.count() == verdicts


def test_compression_band_rejects_what_the_base_rules_pass(spark):
    rng = np.random.default_rng(1)
    prose = " ".join("".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(700))
    noise = " ".join(f"{x:032x}" for x in rng.integers(0, 2**62, 300))
    table = " ".join(f"row{i:04d} aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" for i in range(300))
    docs = spark.createDataFrame([(1, prose), (2, table), (3, noise)], "doc_id long, text string")
    got = {r.doc_id: r for r in compression.quality_digest(docs).collect()}
    assert got[1].kept and not got[2].base_failed and not got[2].kept


PROSE = (
    "When the harbour froze in the second week of January, nobody expected the ferry to run, yet Captain Moll "
    "lit the boiler before dawn and sent the boy for bread. Three passengers stood on the quay: a surveyor with "
    "brass instruments, an old woman carrying seed potatoes, and somebody's cousin who wouldn't say where he was "
    "going. Ice knocked along the hull like furniture being moved upstairs. By noon they had covered four miles, "
    "eaten most of the bread, and argued about taxes, weather, opera and whether herons feel cold. The surveyor "
    "measured everything twice; his notebook shows a coast that differs from every printed chart. Later historians "
    "found the potatoes more important. They were a blight-resistant kind, unknown on the islands, and within ten "
    "years they fed six parishes. Nothing is recorded about the cousin except that he paid in foreign silver and "
    "left his umbrella behind. It hangs today in the customs office, next to a faded photograph of the vessel, a "
    "list of drowned sailors, and the bell that used to warn fishermen off Gull Rock whenever fog rolled down the "
    "valley. Visitors may ring it on Sundays. Children usually do, loudly, until the keeper emerges from behind her "
    "newspaper and threatens, without much conviction, to fetch a constable from the mainland. "
)


def natural(n):
    """``n`` bytes of prose: the sentences above, then 4,000 words in Zipf's proportion."""
    rng = np.random.default_rng(3)
    letters = rng.choice(list("etaoinshrdlucmfwypvbgk"), (4000, 12), p=np.arange(22, 0, -1) / 253)
    words = np.array(["".join(w[:k]) for w, k in zip(letters, rng.integers(2, 11, 4000), strict=True)])
    weight = 1 / (np.arange(4000) + 5)
    return (PROSE + " ".join(rng.choice(words, n // 4, p=weight / weight.sum())))[:n]


def noise(alphabet, n, width=16):
    rng = np.random.default_rng(4)
    letters = "".join(rng.choice(list(alphabet), n))
    return " ".join(letters[i : i + width] for i in range(0, n, width))[:n]


BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def verdicts(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    return [r for r in compression.quality_digest(docs).orderBy("doc_id").collect()]


def test_compression_bands_reject_noise_and_keep_prose(spark):
    junk = [noise(BASE64, n) for n in (1000, 1500, 2040, 3000, 4096, 6000, 20000, 50000)]
    junk += [noise(BASE64[26:52], n) for n in (1800, 2500, 4096, 6000, 20000, 50000)]
    junk += [noise("0123456789abcdef", n) for n in (5200, 6000, 20000, 50000)]
    junk += [noise([chr(c) for c in range(33, 127)], n) for n in (1000, 2040, 6000)]
    for r, t in zip(verdicts(spark, junk), junk, strict=True):
        assert not r.base_failed and not r.kept, (len(t), r.ratio, t[:20])
    prose = [PROSE[:n] for n in (350, 450, 600, 800, 1024, len(PROSE))]
    prose += [natural(n) for n in (1800, 2500, 3500, 4500, 6000, 10000, 40000)]
    for r, t in zip(verdicts(spark, prose), prose, strict=True):
        assert not r.base_failed and r.kept, (len(t), r.ratio)


def test_wide_text_has_its_own_lower_limit(spark):
    rng = np.random.default_rng(5)
    weight = 1 / (np.arange(2500) + 10)
    signs = "".join(chr(0x4E00 + 7 * k) for k in rng.choice(2500, 1300, p=weight / weight.sum()))
    (r,) = verdicts(spark, [" ".join(signs[i : i + 9] for i in range(0, 1300, 9))])
    assert r.ratio < 1.78 and not r.base_failed and r.kept, r.ratio


def test_chunks_cover_the_whole_text(spark):
    advert = "Buy the best kettle in town at half the price today only! " * 100
    base = natural(8192)
    texts = [base + advert[:4095], base[:4096] + advert[:2000], base + advert[:1024], base + natural(900), base[:3000], ""]
    got = verdicts(spark, texts)
    assert [r.n_chunks for r in got] == [3, 2, 3, 3, 1, 0]
    assert [r.n_bad_chunks for r in got] == [1, 1, 1, 0, 0, 0]
    assert [r.kept for r in got] == [False, False, True, True, True, False]
    assert not any(r.base_failed for r in got[:5])


def test_token_counts_match_the_exact_tokenizer(docs, none):
    path = queries.tokenizer_file(queries.PIECES)
    exact = viterbi.exact_tokenizer(viterbi.vocabulary(path))
    rows = viterbi.count_tokens(docs, path)[0].select("text", "tokens.n_tokens").collect()
    for r in rows:
        assert r.n_tokens == len(exact.encode(r.text or "", add_special_tokens=False).ids), r.text
    assert viterbi.token_counts(none, path).count() == 0


def shingles(t):
    w = [x.decode() for x in (t or "").encode().lower().split()]
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def probability_jaccard(a, b):
    return sum(
        1 / sum(max(a[y] / a[x], b[y] / b[x]) for y in a.keys() | b.keys()) for x in a.keys() & b.keys()
    )


def test_probability_jaccard():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a = {int(k): int(rng.integers(1, 5)) for k in rng.integers(0, 30, 15)}
        b = {int(k): int(rng.integers(1, 5)) for k in rng.integers(0, 30, 15)}
        arrays = [np.array(x) for d in (a, b) for x in (sorted(d), [d[k] for k in sorted(d)])]
        ca, cb = collections.Counter(a), collections.Counter(b)
        assert probminhash.probability_jaccard(*arrays) == pytest.approx(probability_jaccard(ca, cb))


def test_signatures_estimate_probability_jaccard():
    a = {k: 1 + k % 3 for k in range(200)}
    b = {k: 1 + k % 2 for k in range(40, 240)}
    doc = np.array([0] * len(a) + [1] * len(b))
    value = np.array([*a, *b], np.uint64) + np.uint64(10**9)
    weight = np.array([*a.values(), *b.values()])
    s = probminhash.signatures(doc, value, weight, 2, 4096)
    want = probability_jaccard(collections.Counter(a), collections.Counter(b))
    assert (s[0] == s[1]).mean() == pytest.approx(want, abs=0.04)


def groups(texts):
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [shingles(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and probability_jaccard(sets[i], sets[j]) >= 0.8:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(texts))]


def test_near_duplicates(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in rng.integers(0, 5000, 120)]
    texts = [t for _, t in TEXTS]
    for n in range(60):  # a group of near copies that fills more than one small bucket
        w = list(base)
        for at in rng.integers(0, len(w), n % 4):
            w[at] = f"x{n}{at}"
        texts.append(" ".join(w))
    rows = [(i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in probminhash.near_duplicates(frame).collect()}
    assert [got[i] for i in range(len(texts))] == groups(texts)


def test_one_of_each_group_stays(docs, none):
    kept = probminhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    classes = groups([t for _, t in TEXTS])
    own = {x: c for x, c in zip(TEXTS, classes)}  # a repeated row is one document
    assert sorted(own[x] for x in rows) == sorted({own[x] for x in TEXTS})
    clash = docs.select("*", *(F.lit("mine").alias(c) for c in ("_k", "_h", "_h_own")))
    again = probminhash.keep_one(clash)
    assert again.columns == clash.columns and again.where("_h_own = 'mine'").count() == len(rows)
    assert probminhash.near_duplicates(none).count() == 0


def test_blocks_find_all_groups(spark, monkeypatch):
    monkeypatch.setattr(probminhash, "SMALL", 2)
    monkeypatch.setattr(probminhash, "BLOCK", 7)
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in rng.integers(0, 5000, 80)]
    texts = []
    for n in range(70):
        w = list(base)
        for at in rng.integers(0, len(w), n % 5):
            w[at] = f"x{n}{at}"
        texts.append(" ".join(w))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in probminhash.near_duplicates(frame).collect()}
    assert [got[i] for i in range(len(texts))] == groups(texts)


def cut_lines(rows, least):
    """Lines covered by a run of ``least`` words that occurs earlier, by trying all runs."""
    lines = {}
    for key, t in rows:
        lines[key] = [] if t is None else t.split("\n")
    seen, cut = {}, collections.defaultdict(set)
    runs = []
    for key in sorted(lines):
        own = [(i, x, len(re.findall("[^\x20\x09-\x0d]+", x))) for i, x in enumerate(lines[key])]
        own = [x for x in own if x[2]]
        for a in range(len(own)):
            total = 0
            for b in range(a, len(own)):
                total += own[b][2]
                if total >= least:
                    runs.append((key, own[a][0], own[b][0], tuple(x for _, x, _ in own[a : b + 1])))
    for key, a, b, run in sorted(runs, key=lambda r: (r[0], r[1])):
        if run in seen:
            cut[key] |= set(range(a, b + 1))
        else:
            seen[run] = (key, a)
    return {k: [x for i, x in enumerate(v) if i not in cut[k]] for k, v in lines.items()}


def test_line_dedup_against_all_runs(spark):
    rng = np.random.default_rng(4)
    pool = [" ".join(f"p{k}w{j}" for j in range(int(n))) for k, n in enumerate(rng.integers(0, 9, 12))]
    rows = [(i, "\n".join(pool[k] for k in rng.integers(0, 12, rng.integers(0, 14)))) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in winnow.dedup_lines(frame, min_words=12).collect()}
    for i, left in cut_lines(rows, 12).items():
        text = "\n".join(left)
        whole = dict(rows)[i]
        want = text if text == whole or text.split() else ""
        assert got[i].text == want and got[i].n_cut == len(whole.split("\n")) - len(left)


def test_line_dedup_awkward_rows(docs, none):
    out = winnow.dedup_lines(docs.withColumn("n_cut", F.lit(9)))
    assert out.columns == [*docs.columns, "n_cut", "n_lines", "n_cut_"]
    rows = out.collect()
    assert len(rows) == len(TEXTS)
    assert [r.text for r in rows if r.doc_id == 2] == [None]
    assert {r.text for r in rows if r.doc_id == 8} == {""}  # LONG is a line of 5
    assert winnow.dedup_lines(none).count() == 0


def test_line_dedup_keeps_columns_with_its_own_names(docs):
    names = ("_lines", "_kept", "_runs", "_cut_doc", "_cut_hash", "text_hash")
    clash = docs.select("*", *(F.lit("mine").alias(c) for c in names))
    got = winnow.dedup_lines(clash)
    assert got.columns == [*clash.columns, "n_lines", "n_cut"]
    assert got.where(" AND ".join(f"{c} = 'mine'" for c in names)).count() == len(TEXTS)


def test_quality_columns_in_order(docs):
    assert compression.quality_digest(docs).columns[:8] == [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    ]


def test_whole_texts_are_worked_in_slices(spark):
    """A slice holds about so many bytes of text, whatever the batch holds."""
    from pyspark.sql import types as T

    from obsengine.llm.common import with_struct

    rows = spark.createDataFrame([(i, "x" * 6) for i in range(12)], "doc_id long, text string").coalesce(1)
    fields = T.StructType([T.StructField("n", T.LongType())])
    out, name = with_struct(rows, "s", fields, "text", lambda: lambda part: [[part.num_rows] * part.num_rows], limit=18)
    assert [r[name]["n"] for r in out.collect()] == [3] * 12
