"""The training-data operators against brute force, and on awkward tables."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from hypso.llm import ann, bpe_chunks, bytesvec, dedup_exact, langid, minhash, packing, quality, queries, sharding, tokencount, urlfilter, wordbpe
from hypso.llm.shared import file_bytes, scratch, table

DATA = "/root/testdata/sf0.001"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOW = str.maketrans(UPPER, UPPER.lower())
SPEC = file_bytes(queries.WORD_BPE)
ODD = "doc_id long, text string, lang string, source string, n_chars long, bucket string, component string, kept string, best string, n string, id string"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in table(spark, DATA, "documents").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, repeated rows, equal texts, columns with clashing names."""
    rng = np.random.default_rng(0)
    long = " ".join("".join(rng.choice(list("abcdeü"), 5)) for _ in range(60_000))
    texts = [None, "", " ", "one", "ONE", "a b c d e f g h", "A b c d e f g h", "a b c d e f g i", "!!! 123", "é É ß\u0301", "日本語", long, long + " x", "a" * 70_000, "x\0y <|endoftext|> z", "same", "same", "  two  spaces ▁ "]
    rows = [(i, t, ("en", None)[i % 2], None, None, "b", "c", "k", "1", "2", "3") for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "null id", "en", "s", 1, *"abcdef"), (None, None, None, None, None, *[None] * 6)]
    return spark.createDataFrame(rows, ODD)


LONE = ["aB3é" * 700_000, "some words É " + "日本語" * 350_000 + " and x1\nmore " + "Ab" * 1_200_000 + " end"]


@pytest.mark.parametrize("text", LONE)
def test_long_words_equal_whole_hashes(text):
    """Words of more than a block's size, hashed in pieces, are what one pass over the whole text makes of them."""
    doc = text.encode()
    b, _ = bytesvec.joined([doc])
    starts, ends = bytesvec.word_spans(b)
    whole = bytesvec.span_hashes(bytesvec.LOWER[b], starts, ends)
    (_, n, got), = bytesvec.words([doc], 2)
    assert n.tolist() == [len(doc.split())] and all((g == w).all() for g, w in zip(got, whole, strict=True))
    word, shape = quality._long(doc)
    assert (word == whole[0]).all() and (shape == quality._shapes(b, starts, ends)).all()
    (_, counts), = quality.features([doc])
    assert counts.sum() == 3 * len(doc.split())


def test_long_words_in_op9_and_op10(spark):
    df = spark.createDataFrame([(1, LONE[0]), (2, LONE[0]), (3, LONE[1]), (4, "a short text of some words")], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (5, 3), 4: (2, 4)}
    model = quality.learn(df, spark.createDataFrame([(i, i % 2) for i in range(1, 5)], "doc_id long, quality int"))
    told = {r.doc_id: r.score for r in quality.score(df, model).collect()}
    assert len(told) == 4 and told[1] == told[2]


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def test_memo_and_hashes():
    rng = np.random.default_rng(1)
    memo = bytesvec.Memo(12)
    h, c = rng.integers(0, 2**64, 2000, dtype=np.uint64), rng.integers(0, 2**64, 2000, dtype=np.uint64)
    assert (memo.find(h, c) == -1).all()
    rows = memo.add(h[:1500], c[:1500])
    assert (memo.find(h[:1500], c[:1500]) == rows).all() and (memo.find(h[1500:], c[1500:]) == -1).all()
    assert (memo.find(h[:1500], c[:1500] + np.uint64(1)) == -1).all()
    words = [b"Ab c", b"", b"ab  C\t" + b"x" * 10]
    got = [(i, n.tolist(), w) for i, n, (w,) in bytesvec.words(words)]
    assert got[0][1] == [2, 0, 3] and got[0][2][0] == got[0][2][2] and got[0][2][1] == got[0][2][3]
    whole = b" ".join(b"%d" % i for i in range(500_000))
    (_, n, (h1,)), = bytesvec.words([whole])
    assert n.tolist() == [500_000] and len(np.unique(h1)) == 500_000


def test_word_bpe_equals_library(docs, odd):
    import random

    random.seed(5)
    signs = "ab'sStTmMdDrReEvVlL é É ß1 2!<|>.,\n\t\r\x0b\x0c\x1c\x7f"
    cases = ["", "It's the 'sword's '' ''s \"'s x'lld'rev''ve", "<|endoftext|> x", "ΣΑΣ", "naïve—dash", "1234 a1b2!!?? ÉCOLE ÀÖß×÷ ÿ Ÿ"]
    cases += ["".join(random.choice(signs) for _ in range(random.randint(0, 40))) for _ in range(1500)]
    cases += [d.text for d in list(docs.values())[:60]]
    encoder = wordbpe.WordBpe(SPEC, memo_bits=15)  # small, so that it is emptied on the way
    library = encoder.whole
    for start in range(0, len(cases), 100):
        own = cases[start : start + 100]
        ids, n = encoder.encode([c.encode() for c in own])
        parts = np.split(ids, np.cumsum(n)[:-1])
        for c, x in zip(own, parts, strict=True):
            expected = library.encode(c, add_special_tokens=False).ids
            assert expected == x.tolist(), c
            assert library.decode(expected, skip_special_tokens=False) == encoder.decode(x)


def test_op1_held_out_accuracy(spark, docs):
    rows = queries.op1_language(spark, DATA).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if r.held_out}
    assert np.mean([docs[r.doc_id].lang == r.lang_pred for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_op1_sample_has_every_language(spark):
    """Long texts give a share, texts without letters don't count, and one eligible text among many rows is learned."""
    rows = [(i, "the cat sat on the mat " * 2000, "en") for i in range(12)]
    rows += [(100 + i, "... " * 10_000 + "der Hund lief in den Wald " * 1500, "de") for i in range(12)]
    rows += [(i, (None, "", "12 34", "!" * 40_000)[i % 4], "fr") for i in range(1000, 41_000)]
    rows += [(i, "le chat dort sur la table", "fr") for i in range(50_000, 50_003)]
    rows += [(60_000, "el perro duerme", "es")] * 500
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    assert {r[2] for r in held} == {"en", "de", "fr", "es"} and any(r[0] >= 50_000 and r[2] == "fr" for r in held)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.sample(df, "doc_id", "text", "lang")
    assert set(got) == {"en", "de", "fr", "es"}
    texts = collections.Counter(len(t) for t in got["en"].split("\n"))
    assert sum(n * k for n, k in texts.items()) == langid.MAX_CHARS and max(texts) <= langid.MAX_CHARS
    assert "Hund" in got["de"] and "chat" in got["fr"] and "perro" in got["es"]
    told = {r.doc_id: r.lang_pred for r in langid.identify(df.where("lang in ('en', 'de') or doc_id >= 50000"), got).collect()}
    assert all(told[i] == "en" for i in range(12)) and all(told[100 + i] == "de" for i in range(12)) and told[50_001] == "fr" and told[60_000] == "es"


def test_op1_shares_fill_the_room():
    long, short = "x" * langid.MAX_CHARS, "y" * 10
    assert [len(t) for t in langid.filled([long])] == [langid.MAX_CHARS]
    assert [len(t) for t in langid.filled([long, short])] == [langid.MAX_CHARS - 10, 10]
    assert [len(t) for t in langid.filled([long] * 20)] == [langid.MAX_CHARS // langid.SHARES] * langid.SHARES
    assert [len(t) for t in langid.filled([long] * 20, 80)] == [10] * 8 and langid.room_for(4) == langid.MAX_CHARS and langid.room_for(100) == 4000


def brute_parse(sample, text):
    """Phrases and literals of a text's segments, by looking for ever longer pieces in the sample."""
    known, codes, phrases, literals = langid.symbols(sample).tobytes(), langid.symbols(text).tobytes(), 0, 0
    for start in range(0, len(codes), langid.SEGMENT):
        raw, i = codes[start : start + langid.SEGMENT], 0
        while i < len(raw):
            size = 0
            while i + size < len(raw) and raw[i : i + size + 1] in known:
                size += 1
            phrases, literals, i = phrases + (size > 0), literals + (size == 0), i + max(size, 1)
    return phrases, literals


def test_op1_parse_and_score_equal_brute_force(monkeypatch):
    monkeypatch.setattr(langid, "SEGMENT", 16)
    samples = {"a": "abracadabra alakazam", "b": "the rain in spain", "ru": "дождь идёт", "c": "z"}
    model = langid.Model({k: langid.compact(v) for k, v in samples.items()})
    texts = ["abra spain cadabram in", "Идёт ли дождь? В Spain!", "qqq", "x" * 50, "ÀÉ the rain", "zzz z"]
    phrases, literals = model.parsed([langid.symbols(t)[:16] for t in texts])
    langs, scores = model.judge(texts)
    for i, text in enumerate(texts):
        size, cost = len(langid.symbols(text)), {}
        for k, lang in enumerate(model.langs):
            head = brute_parse(samples[lang], text[:0] + text) if size <= 16 else None
            assert head is None or head == (phrases[i, k], literals[i, k])
            p, q = brute_parse(samples[lang], text)
            cost[lang] = (p * (np.log2(max(2, len(langid.symbols(samples[lang])))) + langid.CODE) + q * langid.LITERAL) / size
        best = min(sorted(cost), key=cost.get)
        assert langs[i] == best
        assert abs(scores[i] - 1 / sum(2 ** ((cost[best] - c) * min(size, 32)) for c in cost.values())) < 1e-9


def test_op1_scripts_and_many_languages(spark):
    """No letter, script or language is left out: five scripts, rare letters of a large one, 70 languages."""
    samples = {
        "en": "the quick brown fox jumps over the lazy dog and runs home again", "ru": "съешь же ещё этих мягких французских булок да выпей чаю",
        "el": "ξεσκεπάζω την ψυχοφθόρα βδελυγμία και τρέχω πάλι", "ja": "いろはにほへと ちりぬるを わかよたれそ つねならむ", "zh": "天地玄黄 宇宙洪荒 日月盈昃 辰宿列张 寒来暑往 秋收冬藏",
    }
    rng = np.random.default_rng(3)
    own = {}
    for k in range(70):
        own[f"l{k:02}"] = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 7))) for _ in range(40)]
    rows = [(t, lang) for lang, t in samples.items()] + [(" ".join(rng.choice(w, 300)), lang) for lang, w in own.items()]
    df = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate([r for r in rows for _ in range(12)])], "doc_id long, text string, lang string")
    got = langid.sample(df, "doc_id", "text", "lang")
    assert set(got) == {lang for _, lang in rows}
    asked = [("いろはにほへと", "ja"), ("秋收冬藏", "zh"), ("ψυχοφθόρα", "el"), ("булок", "ru"), ("QUICK BROWN FOX", "en")] + [(" ".join(w[:8]), lang) for lang, w in own.items()]
    told = langid.identify(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(asked)], "doc_id long, text string"), got)
    assert {r.doc_id: r.lang_pred for r in told.collect()} == {i: lang for i, (_, lang) in enumerate(asked)}


def test_op1_awkward(spark, odd, none):
    got = langid.identify(odd, {"en": "one two three", "de": "drei vier"}).collect()
    assert len(got) == odd.count()
    assert langid.identify(odd.withColumnsRenamed({"bucket": "told", "best": "score", "n": "lang_pred"}), {"en": "one"}).count() == odd.count()
    by = {r.doc_id: r.lang_pred for r in got if r.doc_id is not None}
    assert {by[0], by[1], by[2], by[8]} == {"und"} and by[3] == "en"
    assert langid.identify_documents(none).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, {}).collect()} == {"und"}


def exact_top(ids, x, q, k):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = unit @ unit[q]
    order = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:k]
    return [int(ids[i]) for i in order], s


@pytest.mark.parametrize("data", ["sf0.01", "sf0.1"])
def test_op2_recall_and_scores(spark, data):
    data = f"/root/testdata/{data}"
    rows = sorted((r.vec_id, r.embedding) for r in table(spark, data, "embeddings").collect())
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    got = collections.defaultdict(list)
    for r in queries.op2_neighbours(spark, data).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    hits = 0
    asked = np.flatnonzero(ids % 50 == 0)
    for q in asked:
        best, s = exact_top(ids, x, q, 5)
        mine = got[ids[q]]
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert all(abs(m[2] - s[np.searchsorted(ids, m[1])]) < 1e-12 for m in mine)
        hits += len({m[1] for m in mine} & set(best))
    assert hits / (5 * len(asked)) >= 0.9


def test_op2_candidates_are_a_falling_share():
    """The share of the vectors that a query meets, on random ones, and the recall of the best five of them."""
    rng, before = np.random.default_rng(5), 1.0
    for n in (1000, 8000):
        x = rng.standard_normal((n, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        rotations, probes = ann.plan(n, 64)
        seen = np.zeros((40, n), bool)
        for t in range(ann.TABLES):
            first, rest = ann.own_bucket(x, t, rotations, 7)
            f, r = ann.probed(x[:40], t, rotations, probes, 7)
            for q in range(40):
                seen[q] |= np.isin(first * 2**20 + rest, f[q] * 2**20 + r[q])
        score = x[:40] @ x.T
        score[np.arange(40), np.arange(40)] = -1
        top = np.argsort(-score, axis=1)[:, :5]
        assert np.take_along_axis(seen, top, 1).mean() >= 0.9 and seen.mean() < min(0.35, before)
        before = seen.mean()
    assert ann.plan(10**9, 64)[0] > ann.plan(10**5, 64)[0] and ann.plan(10**6, 64)[1] < ann.plan(10**4, 64)[1]


def brute_search(rows, every, k):
    """(query, rank, id) by exact cosines; of several vectors of one id the best counts."""
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = []
    for q in sorted({i for i, _ in ok if i % every == 0}):
        best = {}
        for i, y in (r for r in ok if r[0] == q):
            for j, x in ok:
                if j != q and len(x) == len(y):
                    c = (x * y).sum() / np.sqrt((x * x).sum()) / np.sqrt((y * y).sum())
                    best[j] = max(best.get(j, -2.0), round(c, 12))
        out += [(q, r + 1, j) for r, (j, _) in enumerate(sorted(best.items(), key=lambda e: (-e[1], e[0]))[:k])]
    return out


@pytest.mark.parametrize("n", [1, 2, 5, 6, 50])
def test_op2_small_tables_are_complete(spark, n):
    rng = np.random.default_rng(n)
    ids = [0, 1, 2, 3, 50, *range(60, 60 + n)][:n]
    rows = [(i, [float(v) for v in rng.standard_normal(64)]) for i in ids]
    got = ann.search_table(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == brute_search(rows, 50, 5)


def test_op2_ties_widths_and_repeated_ids(spark):
    rng = np.random.default_rng(9)
    v, w = rng.standard_normal(24), rng.standard_normal(24)
    rows = [(100 - k, (v * 2.0**k).tolist()) for k in range(12)] + [(150, v.tolist()), (200, (-v).tolist()), (7, w.tolist()), (7, v.tolist()), (250, w.tolist()), (250, (v + w).tolist())]
    rows += [(i, rng.standard_normal(5).tolist()) for i in (300, 301, 302)] + [(303, [1e-200] * 5), (350, [1e200] * 5), (400, [1.0] * 3)]
    got = ann.search_table(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    told = sorted((r.query_id, r["rank"], r.vec_id) for r in got)
    expected = [t for t in brute_search([r for r in rows if r[0] not in (303, 350)], 50, 5) if t[0] < 300]
    assert [t for t in told if t[0] < 300] == expected
    assert [t for t in told if t[0] == 150] == [(150, k + 1, i) for k, i in enumerate((7, 89, 90, 91, 92))]
    assert [t[2] for t in told if t[0] == 350][0] == 303 and not [t for t in told if t[0] == 400]


def test_op2_awkward(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((30, 6))
    rows = [(i, [float(v) for v in base[i % 30]]) for i in range(200)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 6), (1003, [float("nan")] * 6), (1004, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1005, [1.0] * 5), (None, [1.0] * 6), rows[4], (1050, [float("inf")] * 6)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, bucket string")
    got = ann.search_table(df).orderBy("query_id", "rank").collect()
    assert {r.query_id for r in got} == {0, 50, 100, 150}
    for q in (0, 50, 100, 150):
        equal = [i for i in range(200) if i % 30 == q % 30 and i != q][:5]
        assert [r.vec_id for r in got if r.query_id == q] == equal
    assert ann.search_table(df.where("false")).count() == 0


def pieces(docs):
    library = wordbpe.WordBpe(SPEC).whole
    out = {}
    for i, t in docs:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for p, s in enumerate(range(0, len(ids), 2048)):
            out[i, p] = (s, len(ids[s : s + 2048]), zlib.crc32(np.array(ids[s : s + 2048], "<u4").tobytes()))
    return out


def check_packing(rows, size=2048):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_op3(spark, docs):
    rows = queries.op3_packing(spark, DATA).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == pieces([(i, d.text) for i, d in docs.items()])
    assert check_packing(rows) <= 1.02 * math.ceil(sum(r.length for r in rows) / 2048) + 1


def test_op3_awkward(spark, odd, none):
    rows = packing.pack_documents(odd, SPEC).collect()
    check_packing(rows)
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    expected = collections.Counter()
    for i, t in texts:
        expected.update({(i, k[1], *v): 1 for k, v in pieces([(i, t)]).items()})
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    assert packing.pack_documents(none, SPEC).count() == 0


def fewest_bins(items, size):
    """Exact minimum by search, for small instances."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= size and bins[k] not in bins[:k]:
                go(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1 :]])
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(60))
def test_reduction_loses_no_optimum(seed):
    rng = np.random.default_rng(seed)
    size = 20
    items = rng.integers(1, size + 1, rng.integers(1, 11)).tolist()
    fixed, rest = packing.reduce_instance(dict(collections.Counter(items)), size)
    used = collections.Counter()
    for lengths, times in fixed:
        assert sum(lengths) <= size
        for w in lengths:
            used[w] += times
    used.update(rest)
    assert used == collections.Counter(items)
    left = [w for w, n in rest.items() for _ in range(n)]
    assert sum(t for _, t in fixed) + (fewest_bins(left, size) if left else 0) == fewest_bins(items, size)
    runs, n = packing.plan(dict(collections.Counter(items)), size)
    assert n >= fewest_bins(items, size)


def test_op4(spark, docs):
    rows = queries.op4_sharding(spark, DATA).collect()
    check_shards(rows, 24)
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == {(i, len(d.text.encode()) + 8, zlib.crc32(d.text.encode())) for i, d in docs.items()}
    again = queries.op4_sharding(spark, DATA).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, again), key=repr)
    shuffled = sharding.shard_rows(table(spark, DATA, "documents").repartition(7, "source"), 24).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in shuffled} == {(r.doc_id, r.shard, r.slot) for r in rows}


def check_shards(rows, shards):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by.get(k, ())) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_op4_awkward(spark, odd, none):
    rows = sharding.shard_rows(odd, 5).collect()
    assert len(rows) == odd.count()
    check_shards(rows, 5)
    assert all(r.size == 8 and r.text_crc32 == 0 for r in rows if r.doc_id in (0, 1))
    assert sharding.shard_rows(none, 5).count() == 0


def test_op4_repeated_rows_and_many_buckets(spark, monkeypatch):
    """A row that half of the table repeats gets as many numbers; buckets and runs of copies change no law."""
    monkeypatch.setattr(sharding, "RUN", 100)
    df = spark.range(0, 4000, 1, 5).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("text"), F.lit(1).alias("number"), F.lit(2).alias("_copies"))
    rows = sharding.shard_rows(df, 7).collect()
    assert len(rows) == 4000 and sum(r.doc_id == 7 for r in rows) == 2001
    check_shards(rows, 7)
    some, n = sharding.numbered(df.select("doc_id", "text"), ["doc_id", "text"], least=3, each=50)
    got = some.collect()
    assert n == 4000 and sorted(r.number for r in got) == list(range(4000))
    other, _ = sharding.numbered(df.repartition(3, "doc_id").select("doc_id", "text"), ["doc_id", "text"], least=3, each=50)
    assert sorted((r.doc_id, r.number) for r in other.collect()) == sorted((r.doc_id, r.number) for r in got)


def test_op3_hot_length(spark):
    """A length that most pieces share is ranked in many buckets, repeated rows too."""
    rows = [(i % 40, 0, 0, 2048 if i % 3 else 5 + i % 7, 99) for i in range(3000)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    for each in (37, 100_000):
        got = packing.pack(pieces.repartition(5), each=each).collect()
        assert collections.Counter((r.doc_id, r.length) for r in got) == collections.Counter((r[0], r[3]) for r in rows)
        assert check_packing(got) == 2000 + math.ceil(sum(r[3] for r in rows if r[3] < 2048) / 2048)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 12, 97, 1000, 4099])
def test_permutation(spark, n):
    got = spark.range(n).select(sharding.permuted(F.col("id"), n, 3).alias("p")).collect()
    assert sorted(r.p for r in got) == list(range(n))
    if n > 90:
        assert [r.p for r in got] != list(range(n))


def test_op5_awkward(spark, odd, none):
    rows = dedup_exact.exact_dedup(odd).collect()
    assert len(rows) == odd.count()
    group = collections.defaultdict(list)
    for r in odd.collect():
        group[hashlib.sha256((r.text or "").translate(LOW).encode()).hexdigest()].append(r.doc_id)
    kept = collections.Counter()
    for r in rows:
        own = group[r.text_sha256]
        assert r.group_size == len(own) and r.keep_id == max((i for i in own if i is not None), default=None)
        if r.kept:
            kept[r.text_sha256] += 1
            assert r.doc_id == r.keep_id
    assert kept == {k: 1 for k in group}
    assert dedup_exact.exact_dedup(none).count() == 0
    left = dedup_exact.keep_first(odd)
    assert left.columns == odd.columns and left.count() == len(group)


def test_op5_hot_digest(spark):
    df = spark.range(0, 3000, 1, 6).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Hot").otherwise(F.concat(F.lit("t"), F.col("id") % 700)).alias("text"))
    texts = {i: "hot" if i % 3 == 0 else f"t{i % 700}" for i in range(3000)}
    size, best = collections.Counter(texts.values()), {}
    for i, t in texts.items():
        best[t] = max(best.get(t, 0), i)
    for r in dedup_exact.exact_dedup(df, tracked=64).collect():
        t = texts[r.doc_id]
        assert (r.keep_id, r.group_size, r.kept) == (best[t], size[t], r.doc_id == best[t])


def test_op6_rules_and_awkward(spark):
    urls = ["https://A.Example.com/en/7?x=/de", "http://example.net/de/81", "http://x.net/de/", "http://xnet/de/", "ftp://org/es/#a", "https://u@H.com:80/en/", None, "no host", "://", "http://h.com?q://x", "http://com/en"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(None, None, None), (0, urls[0], "x")], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, spark.createDataFrame([(1, 1), (2, None)], "page_id long, bad int")).collect()}
    assert got[0] == ("a.example.com", "/en/7", "example.com/en/7", "allow")
    assert got[1] == ("example.net", "/de/81", "example.net/de/8", "block")
    assert got[2] == ("x.net", "/de/", "net/de/", "allow")
    assert got[3] == ("xnet", "/de/", None, "allow")
    assert got[4] == ("org", "/es/", "org/es/", "block")
    assert got[5] == ("u@h.com:80", "/en/", None, "allow")
    assert got[6] == got[7] == got[8] == got[None] == ("", "", None, "allow")
    assert got[9] == ("h.com", "", None, "allow") and got[10] == ("com", "/en", None, "allow")
    assert urlfilter.judge(pages.where("false"), spark.createDataFrame([], "page_id long, bad int")).count() == 0


def test_op6_reputation(spark):
    rows = [(i, f"http://h{i % 4}.site{i % 2}.com/{i}", int(i % 4 == 3 or i % 17 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string, bad int")
    got = urlfilter.judge(df.select("page_id", "url"), df.select("page_id", "bad").where("page_id < 300")).collect()
    assert {r.host for r in got if r.verdict == "block"} == {"h3.site1.com"}


def test_op7(spark, docs):
    library = tokencount.sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_BPE)
    for r in queries.op7_token_counts(spark, DATA).collect():
        n = len(library.encode(docs[r.doc_id].text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].text.encode()), n, n > 4096)


def test_op7_cache_and_awkward(spark, odd, none):
    model = file_bytes(queries.PIECE_BPE)
    library = tokencount.sentencepiece.SentencePieceProcessor(model_proto=model)
    path = scratch(spark, "cache")
    assert tokencount.count_tokens(none, model, path).count() == 0
    text = {r.doc_id: r.text or "" for r in odd.collect() if r.doc_id is not None}
    for _ in range(2):
        rows = tokencount.count_tokens(odd.withColumnsRenamed({"bucket": "key", "best": "n_tokens", "n": "first"}), model, path).collect()
        assert len(rows) == odd.count()
        for r in rows:
            if r.doc_id is not None:
                assert r.n_tokens == len(library.encode(text[r.doc_id])), repr(text[r.doc_id])[:40]
        cache = tokencount.read_cache(spark, path)
        assert cache.count() == cache.select("key").distinct().count() == odd.select(F.coalesce("text", F.lit(""))).distinct().count()
    more = odd.select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit(" new")).alias("text")).unionByName(odd.select("doc_id", "text"))
    before = cache.count()
    tokencount.count_tokens(more, model, path).count()
    assert tokencount.read_cache(spark, path).count() > before


def test_op7_repeated_keys_in_the_cache(spark):
    """Two writers, or a repeated append: still one row a document, and no text is encoded again."""
    model, path = file_bytes(queries.PIECE_BPE), scratch(spark, "cache")
    df = spark.createDataFrame([(1, "one two three"), (2, "four")], "doc_id long, text string")
    first = sorted(map(tuple, tokencount.count_tokens(df, model, path).collect()))
    tokencount.read_cache(spark, path).write.mode("append").parquet(f"{path}-more")
    spark.read.parquet(f"{path}-more").write.mode("append").parquet(path)
    assert tokencount.read_cache(spark, path).count() == 4
    assert sorted(map(tuple, tokencount.count_tokens(df, model, path).collect())) == first
    assert tokencount.read_cache(spark, path).count() == 4


def test_op7_hits_come_from_the_cache(spark):
    model, path = file_bytes(queries.PIECE_BPE), scratch(spark, "cache")
    df = spark.createDataFrame([(1, "one two three"), (2, "four"), (3, "four")], "doc_id long, text string")
    version = hashlib.sha256(model).hexdigest()
    spark.createDataFrame([(hashlib.sha256(b"four").hexdigest(), version, 77), (hashlib.sha256(b"one two three").hexdigest(), "other", 5)], tokencount.CACHE).write.parquet(path)
    assert {r.doc_id: r.n_tokens for r in tokencount.count_tokens(df, model, path).collect()} == {1: 3, 2: 77, 3: 77}


def test_op7_spaces():
    counter = tokencount.PieceCounter(file_bytes(queries.PIECE_BPE), memo_bits=12)
    import random

    random.seed(3)
    cases = ["".join(random.choice("ab  é.\n\t1日") for _ in range(random.randint(0, 30))) for _ in range(3000)]
    assert counter.split
    for i in range(0, len(cases), 200):
        own = cases[i : i + 200]
        assert counter.counts([c.encode() for c in own]).tolist() == [len(counter.library.encode(c)) for c in own]


def test_op7_more_segments_than_the_table_holds():
    counter = tokencount.PieceCounter(file_bytes(queries.PIECE_BPE), memo_bits=8)
    text = " ".join(f"w{i}" for i in range(2000))
    assert counter.counts([text.encode(), b"a  b ", text[::-1].encode()]).tolist() == [len(counter.library.encode(t)) for t in (text, "a  b ", text[::-1])]


@pytest.mark.parametrize("gap", [" ", "   ", "\n"])
def test_op7_long_text_in_slices(monkeypatch, gap):
    """Cuts fall before runs of spaces, also where a run lies across the place of a cut or the text ends in one."""
    monkeypatch.setattr(bytesvec, "BLOCK", 50)
    counter = tokencount.PieceCounter(file_bytes(queries.PIECE_BPE), memo_bits=12)
    assert counter.split
    texts = [gap.join(f"n{i}" for i in range(300)) + "x" * n + end for n in range(60) for end in ("", " ", "  ", " y")]
    texts += [" " * 400, "a" * 300 + " " * 300 + "b", "one two " + "é" * 400 + " three"]
    assert counter.counts([t.encode() for t in texts]).tolist() == [len(x) for x in counter.library.encode(texts)]


def test_op7_millions_of_different_words():
    counter = tokencount.PieceCounter(file_bytes(queries.PIECE_BPE))
    text = " ".join(map(str, range(1_400_000)))
    assert counter.counts([text.encode()]).tolist() == [len(counter.library.encode(text))]


def test_op8(spark, docs, odd, none):
    library = wordbpe.WordBpe(SPEC).whole

    def told(t):
        ids = library.encode(t or "", add_special_tokens=False).ids
        return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()

    for r in queries.op8_bpe(spark, DATA).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == told(docs[r.doc_id].text)
    expected = collections.Counter((r.doc_id, *told(r.text)) for r in odd.collect())
    assert collections.Counter(tuple(r) for r in bpe_chunks.encode(odd, SPEC, digests=True).collect()) == expected
    assert bpe_chunks.encode(none, SPEC).count() == 0


def test_op8_chunks_are_content_defined_and_reused():
    rng = np.random.default_rng(4)
    passage = "".join(rng.choice(list("abc dé'."), 20_000))
    docs = [("x" * k + passage + "y" * k).encode() for k in range(5)]
    encoder = bpe_chunks.ChunkEncoder(SPEC)
    got = encoder.encode(docs)
    for d, ids in zip(docs, got, strict=True):
        assert encoder.words.whole.encode(d.decode(), add_special_tokens=False).ids == ids.tolist()
    assert sum(map(len, encoder.store)) < 2 * len(docs[0])


class CrossingWords:
    """A toy encoder whose tokens cross white space: of a chunk's odd bytes it makes one number each, of "new york" one."""

    def __call__(self, pieces):
        found = [re.findall(rb"new york|\S", p) for p in pieces]
        return [np.array([zlib.crc32(t) % 2**31 for t in f], np.int32) for f in found]


def test_op8_windows_grow_until_they_agree(monkeypatch):
    monkeypatch.setattr(bpe_chunks, "LEAST", 4)
    monkeypatch.setattr(bpe_chunks, "AVERAGE_BITS", 3)
    encoder = bpe_chunks.ChunkEncoder(SPEC)
    encoder._ids = CrossingWords()
    wider = []
    plain = encoder._wider
    monkeypatch.setattr(encoder, "_wider", lambda *a: wider.append(plain(*a)) or wider[-1], raising=False)
    rng = np.random.default_rng(1)
    docs = [" ".join(rng.choice(["alpha", "beta", "gammadeltaepsilon", "x"], 60)).encode() for _ in range(30)]
    for d, ids in zip(docs, encoder.encode(docs), strict=True):
        assert ids.tolist() == encoder._ids([d])[0].tolist()
    raw = b"one two three four five"
    space = np.flatnonzero(bytesvec.SPACE[np.frombuffer(raw + b"\n", np.uint8)])
    assert plain(space, [0, 10, len(raw)], 8, 13) == (4, 18) and plain(space, [0, 10, len(raw)], 4, 18) == (0, len(raw))
    # Chunks whose ids disagree with the fragments': the window becomes the text, and the text's ids stand.
    chunks, word = [np.array([1, 9]), np.array([8, 2])], np.array([5])
    out = encoder._mended(raw + b"\n", space, [0, 10, len(raw)], chunks, [(8, 13, word, np.array([7]), np.array([7]))])
    assert np.concatenate(out).tolist() == encoder._ids([raw])[0].tolist() and len(wider) >= 2


def brute_components(texts, width, percent):
    sets = {}
    for i, t in texts.items():
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOW))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    parent = {i: i for i in texts}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 100 >= percent * max(len(sets[a]), len(sets[b])):
                same = len(sets[a] & sets[b])
                if 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def test_op9(spark, docs):
    component, sizes = brute_components({i: d.text for i, d in docs.items()}, 4, 80)
    rows = queries.op9_near_duplicates(spark, DATA).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {i: (sizes[i], c, i == c) for i, c in component.items()}


def test_op9_ids_of_several_texts(spark):
    """Rows that repeat an id are one document, linked with whatever any of its texts is near to."""
    words = [f"w{k}" for k in range(300)]
    a, b, c = (" ".join(words[k : k + 90]) for k in (0, 100, 200))
    rows = [(5, a), (5, b), (7, a + " x"), (9, b), (11, c), (12, c + " y"), (12, "lone"), (13, "lone"), (14, "apart")]
    got = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80).collect()}
    assert got == {(5, 5), (7, 5), (9, 5), (11, 11), (12, 11), (13, 11), (14, 14)}


def test_op9_digest_of_words():
    text = "A b\tC \x0b d" + " long" * 200_000
    assert minhash.words_digest(text.encode()) == hashlib.sha256(" ".join(text.lower().split()).encode()).hexdigest()
    assert minhash.words_digest(b"x" * 3_000_000 + b" Y") == hashlib.sha256(b"x" * 3_000_000 + b" y").hexdigest()


def test_op9_chains_in_one_bucket(spark):
    """Members that the bucket's smallest id doesn't reach are linked all the same, through each other."""
    rng = np.random.default_rng(6)
    words = [f"w{k}" for k in range(4000)]
    texts, i = {}, 0
    for family in range(12):
        base = rng.choice(words, 60).tolist()
        for step in range(10):
            base = base[1:] + [str(rng.choice(words))] if step else base
            texts[i] = " ".join(base)
            i += 1
    component, _ = brute_components(texts, 4, 80)
    df = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id long, text string, bucket string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, 4, 80).collect()}
    assert got == component and len(set(got.values())) == 12


def test_op9_awkward(spark, odd, none):
    rows = minhash.near_duplicates(odd, 4, 80).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[0].n_shingles == by[1].n_shingles == by[2].n_shingles == 0 and by[0].kept and by[1].kept
    assert by[4].component_id == 3 and by[6].component_id == 5 and by[16].component_id == 15 and by[12].component_id == 11
    assert by[None].component_id is None and not by[None].kept
    assert minhash.near_duplicates(none, 4, 80).count() == 0


def test_op9_pruning_bounds():
    """A pair goes on with the fewest matches that leave the threshold a probability of ``miss`` or more."""
    for miss in (minhash.MISS, 1e-3):
        steps = minhash.fewest(80, miss)
        assert [n for n, _ in steps] == list(range(minhash.BATCH, minhash.BANDS * minhash.ROWS + 1, minhash.BATCH))
        for n, need in steps:
            tail = [sum(math.comb(n + 1, m) * 0.8**m * 0.2 ** (n + 1 - m) for m in range(k)) for k in (need, need + 1)]
            assert tail[0] < miss <= tail[1]


def pruning_loss(similarity, steps):
    """The probability that a pair whose hashes agree independently is pruned at one of the steps."""
    alive, done, lost = {0: 1.0}, 0, 0.0
    for n, need in steps:
        after = collections.defaultdict(float)
        for m, p in alive.items():
            for k in range(n - done + 1):
                after[m + k] += p * math.comb(n - done, k) * similarity**k * (1 - similarity) ** (n - done - k)
        lost += sum(p for m, p in after.items() if m < need)
        alive, done = {m: p for m, p in after.items() if m >= need}, n
    return lost


def test_op9_pruning_loses_less_than_the_bands():
    bands = (1 - 0.8**minhash.ROWS) ** minhash.BANDS
    assert pruning_loss(0.8, minhash.fewest(80)) < bands / 100


@pytest.mark.parametrize("block", [700, minhash.BLOCK])
def test_op9_blocks_of_a_bucket(spark, monkeypatch, block):
    """Buckets with many components give the same links however they are cut into blocks."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = np.random.default_rng(7)
    passage = [f"p{k}" for k in range(45)]
    texts = {}
    for family in range(14):  # all share the passage: candidates of each other, at about 0.6, and linked to few
        base = passage + [f"f{family}w{k}" for k in range(15)]
        for i in range(3):
            own = list(base)
            own[int(rng.integers(45, 60))] = f"x{family}y{i}"
            texts[family * 3 + i] = " ".join(own)
    component, _ = brute_components(texts, 4, 80)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, 4, 80).collect()}
    assert got == component and 14 <= len(set(got.values())) < 42


def test_op9_hashed_sets(spark):
    """Sets of hashes link just as the sets of shingles do, at the threshold too."""
    words = [f"w{k}" for k in range(40)]
    texts = {0: " ".join(words), 1: " ".join(words[:33]), 2: " ".join(words[:32]), 3: "w0 w1", 4: "W0  w1", 5: " ".join(words * 3)}
    rows = minhash.hashed_sets(spark.createDataFrame(list(texts.items()), "id long, text string"), 4).collect()
    got = {r.id: np.frombuffer(r.set, np.uint64) for r in rows}
    sets = {i: minhash.shingle_set(t.encode(), 4) for i, t in texts.items()}
    assert {i: len(v) for i, v in got.items()} == {i: len(v) for i, v in sets.items()}
    for a in texts:
        told = minhash.linked(got[a], [got[b] for b in texts], 80).tolist()
        assert told == [100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for b in texts]


def test_components(spark):
    rng = np.random.default_rng(8)
    links = [(i, i + 1) for i in range(40)] + [(int(a), int(b)) for a, b in rng.integers(100, 400, (150, 2))] + [(500, k) for k in range(501, 560)]
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in minhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {a: find(a) for a, b in links for a in (a, b) if any(x != y and a in (x, y) for x, y in links)}


def test_op10_held_out(spark):
    data = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in table(spark, data, "labels").collect()}
    rows = [r for r in queries.op10_quality(spark, data).collect() if r.held_out and r.doc_id in label]
    assert np.mean([r.predicted == label[r.doc_id] for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_op10_equals_brute_force(spark):
    """Features counted word by word, frequencies over all documents, and each vote, by plain Python."""
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    model = quality.learn(docs, labels)
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    seen, every = quality.frequencies(docs)
    counts = np.concatenate([c for t in texts for _, c in quality.features([t.encode()])])
    assert every == len(texts) and (seen == (counts > 0).sum(axis=0)).all()
    assert np.allclose(model["idf"], np.log((1 + every) / (1 + seen)) + 1.0)
    for c, t in zip(counts, texts, strict=True):
        words = t.encode().split()
        shape = [re.sub(rb"(.)\1+", rb"\1", bytes(quality._kinds(np.frombuffer(w + b"\n", np.uint8))[:-1]), flags=re.S) for w in words]
        assert c.sum() == 3 * len(words) and np.count_nonzero(c[quality.WORDS : quality.WORDS + quality.SHAPES]) <= len(set(shape))
    scores = quality.vote(model, [t.encode() for t in texts])
    for c, s in zip(counts, scores, strict=True):
        x = np.log1p(c) * model["idf"]
        v = (x / np.linalg.norm(x)) @ model["project"]
        near = model["vectors"] @ (v / np.linalg.norm(v))
        top = sorted(range(len(near)), key=lambda i: (-round(near[i], 6), i))[: quality.NEIGHBOURS]
        w = np.maximum(near[top], 1e-6) ** 4
        assert abs((w * model["labels"][top]).sum() / w.sum() - s) < 0.02


def test_op10_ties_go_to_the_smaller_id():
    near = np.round(np.array([[0.5, 0.9, 0.5, 0.5, 0.1], [0.2, 0.2, 0.2, 0.2, 0.2]]), 9)
    assert quality.chosen(near, 3).tolist() == [[True, True, True, False, False], [True, True, True, False, False]]
    assert quality.chosen(near, 9).all()
    rng = np.random.default_rng(1)
    known = rng.standard_normal((30, 4))
    known = np.repeat(known / np.linalg.norm(known, axis=1, keepdims=True), 20, axis=0)  # each vector twenty times
    model = {"idf": np.ones(quality.FEATURES), "project": rng.standard_normal((quality.FEATURES, 4)).astype(np.float32), "vectors": known, "labels": (np.arange(600) % 20 < 15).astype(float), "prior": 0.5}
    docs = [f"word{k} text{k % 7}".encode() for k in range(300)]
    together, alone = quality.vote(model, docs), [quality.vote(model, [d])[0] for d in docs]
    assert together.tolist() == alone and (together > 0.99).all()


def test_op10_sample_knows_its_documents(spark):
    """Labels of absent documents take no room; of an id's several texts and labels the smallest count."""
    df = spark.createDataFrame([(i, f"text number {i} of some words") for i in range(40)] + [(3, "a smaller text")] * 5, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(5000)] + [(4, 1)], "doc_id long, quality int")
    model = quality.learn(df, labels, sample=20)
    held = {i for i in range(40) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert len(model["labels"]) == min(20, 40 - len(held))


def test_op10_awkward(spark, odd, none):
    labels = spark.createDataFrame([(3, 1, 0), (5, None, 0), (8, 0, 0), (8, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality.score_documents(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.score_documents(none, labels).count() == 0
    assert {r.score for r in quality.score_documents(odd, labels.where("false")).collect()} == {0.5}
