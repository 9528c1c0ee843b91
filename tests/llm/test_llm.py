"""Each operator against brute force on small tables with nulls, empty and long texts, ties, repeated rows, clashing columns, and on empty tables."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from variantloom.llm import common, components, dedup, idfiles, lm, mixing, packing, pii, quality, rules, setjoin, tokens, urls
from variantloom.llm.queries import tokenizer

DOCS = "doc_id long, text string, source string, shard int, n long, row long, hash long"
CUT = [" ", "\t", "\n", "\x0b", "\f", "\r"]


def documents(spark, rows):
    """Beside text, columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, s, 1, 2, 3, 4) for i, t, s in rows], DOCS)


def corpus(seed=0, n=60):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(40)] + ["Ä", "the", "THE"]
    base = [" ".join(rng.choice(words, int(rng.integers(1, 60)))) for _ in range(n)]
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(base)]
    for k in range(n):  # copies with a word changed or white space added
        w = base[k].split()
        if k % 3 == 0 and len(w) > 30:
            w[int(rng.integers(len(w)))] = "changed"
            rows.append((n + k, " ".join(w), "s0"))
        if k % 4 == 0:
            rows.append((2 * n + k, "\n " + base[k].replace(" ", "\r\x0b"), None))
    long = " ".join(rng.choice(words, 3000))
    return rows + [(900, None, "s1"), (901, "", None), (902, " \n\t", "s2"), (903, "one", "s2"), (904, "One", "s2"), (905, "two words", "s2"), (906, long, "big"), (906, long, "big"), (None, "no id here at all", "s1"), (907, "a b c", "s1")]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return documents(spark, rows).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])


def split(t):
    return (t or "").encode().lower().split()


def test_language_model_against_counts(docs, rows, none):
    for order in (2, 3):
        got = collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 8), round(r.score, 8)) for r in lm.score_texts(docs, order=order, block_bytes=3000, shard_bytes=5000).collect())
        learn = [[*split(t), "end"] for i, t, _ in rows if common.crc(i) % 10]
        c = collections.Counter(tuple(w[i : i + k]) for w in learn for k in range(1, order + 1) for i in range(len(w) - k + 1))
        n, v = sum(map(len, learn)), sum(len(g) == 1 for g in c)

        def p(g):
            if len(g) == 1:
                return (c[g] + 0.1) / (n + 0.1 * (v + 1))
            if not c[g[:-1]]:
                return p(g[1:])
            m = lm.MASS[len(g) - 1]
            return (c[g] + m * p(g[1:])) / (c[g[:-1]] + m)

        want = collections.Counter()
        for i, t, _ in rows:
            w = [*split(t), "end"]
            score = sum(math.log10(p(tuple(w[max(0, k - order + 1) : k + 1]))) for k in range(len(w)))
            want[(i, len(w), sum(c[(x,)] > 0 for x in w), n, round(sum(math.log10(p((x,))) for x in w), 8), round(score, 8))] += 1
        assert got == want
    assert lm.score_texts(none).count() == 0


def test_lanes_agree():
    table = pa.table({"doc_id": pa.array([1, 2, 4, 5]), "text": pa.array(["a b a c a b", "b a", "c c c a", "a b " * 700]), "block": pa.array([0] * 4, pa.int32())})
    answers = lm._answer(3)(lm._ask(2, 3, 10)(table))
    ref = lm._score(3, 10, lm.MASS)(table, answers)["score"].to_numpy()
    before = lm.walk.__defaults__
    try:
        lm.walk.__defaults__ = (7,)
        assert lm._score(3, 10, lm.MASS)(table, answers)["score"].to_numpy() == pytest.approx(ref)
    finally:
        lm.walk.__defaults__ = before


def brute_links(rows):
    sets = []
    for i, t, _ in rows:
        w = split(t)
        sets.append(frozenset() if not w else frozenset([tuple(w)]) if len(w) < 3 else frozenset(tuple(w[j : j + 3]) for j in range(len(w) - 2)))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = collections.defaultdict(list)
    for k in range(len(sets)):
        if rows[k][0] is not None:
            least[find(k)].append(rows[k][0])
    return collections.Counter((rows[k][0], len(sets[k]), min(least[find(k)], default=None)) for k in range(len(sets)))


@pytest.mark.parametrize("pieces", [3_000_000, 120])
def test_shingle_join_against_all_pairs(docs, rows, none, pieces):
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in setjoin.link_texts(docs, block_bytes=4000, shard_bytes=6000, family_shingles=pieces).collect())
    assert got == brute_links(rows)
    assert setjoin.link_texts(none).count() == 0


def test_family_derives_and_skips():
    rng = np.random.default_rng(4)
    base = rng.permutation(10_000)[:300].astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(300) > 0.04], rng.integers(20_000, 90_000, 4).astype(np.uint64)])) for _ in range(60)]
    sets += [np.unique(rng.integers(0, 400, int(rng.integers(20, 300))).astype(np.uint64)) for _ in range(60)]
    f = setjoin.Family(sets)
    root = f.run()
    label = list(range(len(sets)))
    plain = [set(s.tolist()) for s in sets]
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(plain[a] & plain[b]) >= 90 * len(plain[a] | plain[b]):
                label = [label[b] if x == label[a] else x for x in label]
    assert [root[a] == root[b] for a in range(120) for b in range(a)] == [label[a] == label[b] for a in range(120) for b in range(a)]
    assert f.derived > 0 and f.skipped > 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (200, 150), (7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 150: 100, 200: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_dedup(docs, rows, none):
    import hashlib

    groups = collections.defaultdict(list)
    for i, t, _ in rows:
        t = t or ""
        groups["".join(c for c in t if c not in CUT)].append((-len(t), math.inf if i is None else i))
    want = collections.Counter()
    for norm, g in groups.items():
        g.sort()
        for k, (_, i) in enumerate(g):
            want[(None if i == math.inf else i, None if g[0][1] == math.inf else g[0][1], len(g), k == 0, hashlib.sha256(norm.encode()).hexdigest())] += 1
    got = collections.Counter(tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in dedup.groups(docs).collect())
    assert got == want
    assert dedup.groups(none).count() == 0
    kept = dedup.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_filter_passes_single_rows(docs):
    hashed = dedup.hashed_rows(docs)
    alone, again = dedup.Repeated(hashed).split(hashed)
    assert alone.count() + again.count() == docs.count() and alone.count() > 0
    assert alone.join(again, "text_sha256").count() == 0
    one_word = dedup.Repeated(hashed, most_words=1)  # a filter far too small only lets more rows shuffle
    assert one_word.split(hashed)[1].count() >= again.count()


def test_urls(spark):
    cases = [("http://a.example.com/en/70?x", "example.com/en/7", "allow"), ("http://EXAMPLE.com/en/1", "com/en/", "block"), ("https://x.net/de/8", "net/de/", "allow"), ("https://b.example.net/de/81", "example.net/de/8", "block"),
             ("ftp://q.org/es/", "org/es/", "block"), ("http://q.org/ES/", None, "allow"), ("http://www.cheap-pills.example.com/fr/1", None, "block"), ("http://www.cheap-pills.example.com/en/7", "example.com/en/7", "allow"), ("http://spam-farm.example.org/es/3", "org/es/", "block"),
             ("no scheme/com/en/", None, "allow"), (None, None, "allow"), ("", None, "allow"), ("http://com?/en/", None, "allow"), ("http://notcom/en/", None, "allow"), ("http://h.com/en", None, "allow"), ("http://" + "x" * 5000 + ".com/en/", "com/en/", "block")]
    df = spark.createDataFrame([(i, c[0], "x", "y") for i, c in enumerate(cases * 2)], "page_id long, url string, host string, rule string")
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge(df).collect()}
    assert [got[i] for i in range(len(cases) * 2)] == [c[1:] for c in cases] * 2
    assert urls.judge(df.limit(0)).count() == 0
    first = urls.judge(df).where("page_id = 0").first()
    assert (first.host, first.path) == ("a.example.com", "/en/70")
    with pytest.raises(ValueError):
        urls.rule_table(spark, (urls.word_rule("x"),))


def test_mixing(docs, rows, none):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for i, t, s in rows:
        sizes[s] += len(split(t))
    order = [*sorted(s for s in sizes if s is not None), None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            free.discard(s)
    source = {(i, len(split(t))): s for i, t, s in rows}
    taken, largest = collections.Counter(), collections.Counter()
    for r in got:
        s = source[(r.doc_id, r.size)]
        assert r.target == pytest.approx(target[s], abs=1e-5) and r.source_size == sizes[s] and r.taken in [k * r.size for k in range(4)]
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] * (2 if s == "big" else 1) for s in order)  # a repeated row shares its hash
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(docs.repartition(5)).collect()))
    assert mixing.mix(none).count() == 0
    assert mixing.take(docs).groupBy().count().first()[0] == sum(r.taken // r.size if r.size else 1 for r in got)


def test_quality_rules(spark, docs, rows, none):
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rules.judge(docs).collect())
    want = collections.Counter()
    for i, t, _ in rows:
        t = t or ""
        w = [x.decode() for x in t.encode().split()]
        g = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        again = {j for k in range(len(w) - 4) if g[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
        lines = [x for x in t.split("\n") if x.encode().split()]
        want[(i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again), len(w) < 10 or 100 * len(again) > 20 * len(w))] += 1
    assert got == want and rules.judge(none).count() == 0
    clean = "This is a plain sentence of some words.\nHere is another one, also long enough."
    bad = "Home | About | Contact\nBUY!! NOW!! HERE!! AND!! THEN!! MORE!! GO!! ON!! YES!! NO!!"
    kept = {r.doc_id: (r.kept, r.text) for r in rules.judge(documents(spark, [(1, clean, None), (2, bad, None), (3, clean + "\nAll rights reserved.", None)])).collect()}
    assert kept[1] == (True, clean) and not kept[2][0] and kept[3] == (True, clean)


def test_encoders_against_the_library():
    import random

    random.seed(1)
    bits = ["a", "B", "é", " ", "  ", "\n", "\t", "'s", "'", "1", "23", "!", "…", " ", "　", "é", "日", "Don't", "<|endoftext|>", "\x1c", "😀", "word"]
    texts = ["".join(random.choices(bits, k=random.randint(0, 12))) for _ in range(3000)] + [None, ""]
    for name, drops in (("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)):
        e = tokens.Encoder(tokenizer(name), drops, most=500)
        for _ in range(2):
            ids, at = e.encode(pa.array(texts))
            for i, t in enumerate(texts):
                assert ids[at[i] : at[i + 1]].tolist() == e.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_encoder_remembers_no_more_ids_than_it_may():
    texts = [f"¿{'word ' * 200}{i}" for i in range(60)]  # each is one piece, for its first mark
    e = tokens.Encoder(tokenizer("byte_bpe_50k.json"), False, most_ids=1000)
    for i in range(0, 60, 3):
        ids, at = e.encode(pa.array(texts[i : i + 3]))
        for k in range(3):
            assert ids[at[k] : at[k + 1]].tolist() == e.tokenizer.encode(texts[i + k], add_special_tokens=False).ids
        assert len(e.flat) <= 1000 + at[-1]


def plain_ids(name, text):
    e = tokens.encoder(tokenizer(name), name.startswith("word"))
    return e.tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_packing(docs, rows, none):
    got = packing.pack(docs, tokenizer("byte_bpe_50k.json"), window=64, shard_bytes=4000).collect()
    whole, windows = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length
        whole[(r.doc_id, r.doc_tokens)].append((r.start, ids.tolist()))
        windows[r.sequence_id].append((r.offset, r.length))
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at
            at += length
        assert at <= 64
    want = collections.defaultdict(list)
    for i, t, _ in rows:
        ids = plain_ids("byte_bpe_50k.json", t)
        want[(i, len(ids))] += [(k, ids[k : k + 64]) for k in range(0, len(ids), 64)]
    assert {k: sorted(v) for k, v in whole.items()} == {k: sorted(v) for k, v in want.items()}
    assert packing.digest(packing.pack(none, tokenizer("byte_bpe_50k.json"))).count() == 0


def test_best_fit_is_tightest():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 65, 500)
    where, offset = packing.best_fit(lengths, 64)
    room = []
    for i in np.argsort(-lengths, kind="stable"):
        fits = [w for w in range(len(room)) if room[w] >= lengths[i]]
        want = min(room[w] for w in fits) if fits else 64
        if where[i] == len(room):
            room.append(64)
        assert room[where[i]] == want and offset[i] == 64 - room[where[i]]
        room[where[i]] -= lengths[i]
    least = max(-(-int(lengths.sum()) // 64), int((lengths > 32).sum()))
    assert len(room) <= 11 / 9 * least + 1  # what best fit decreasing is known to keep to


def test_id_files(spark, docs, rows, none, tmp_path):
    path = str(tmp_path / "ids")
    idfiles.write(docs, path, tokenizer("word_bpe_49k.json"), part_bytes=3000)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in idfiles.digest(idfiles.read(spark, path)).collect()]
    want, at = [], 0
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain_ids("word_bpe_49k.json", t)
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    some = idfiles.read(spark, path).where("doc_id = 906")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,906)]" in some._jdf.queryExecution().executedPlan().toString() and some.count() == 2
    idfiles.write(none, str(tmp_path / "none"), tokenizer("word_bpe_49k.json"))
    assert idfiles.digest(idfiles.read(spark, str(tmp_path / "none"))).count() == 0


def test_surrogates(spark, none):
    texts = ["write the.72@mail3.example.com or THE.72@MAIL3.EXAMPLE.COM!!", "+1 (974) 555-3436 and 974-555-3436", "4111 1111 1111 1111, 4952935900253052.", "ip 235.58.234.215. 1.43.173.185!!",
             'token = "abe29cfcdae4f03e1e339fcaa4c5bb6c83baff71" x', "Mrs. Anna Smith and Frau Anna, г-жа Ольга Петрова", "nothing here, 12345 of 2019 and 3.14", None, "", "x " * 20000 + "a@b.example.com"]
    df = documents(spark, [(i, t, None) for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in pii.surrogates(df).collect()}
    first = got[0].text.split()
    assert first[1].upper() == first[3].rstrip("!") and "the.72" not in got[0].text and first[1].endswith(".example.com")
    assert got[1].text[4:18].translate(str.maketrans("", "", "() -")) == got[1].text[-12:].replace("-", "")
    card = got[2].text.split(",")[0].replace(" ", "")
    assert pii._luhn(card[:-1]) == int(card[-1]) and card != "4111111111111111" and got[2].n_entities == 2
    assert all(0 <= int(x) < 256 for x in got[3].text.split()[1].rstrip(".").split(".")) and got[3].n_entities == 2
    assert len(got[4].text) == len(texts[4]) and "abe29" not in got[4].text
    names = [r.surrogate for r in got[5].entities]
    assert names[0].split()[0] == names[1] and names[0].split()[0].lower() in pii.NAMES[("f", "latin")] and names[2].split()[0].lower() in pii.NAMES[("f", "cyrillic")]
    assert got[6].text == texts[6] and got[7].text is None and got[8].text == "" and "a@b." not in got[9].text
    assert pii.collisions(df).count() == 0 and pii.surrogates(none).count() == 0


def test_surrogates_are_one_to_one():
    for kind, values in (("ssn", [f"{i:03d}-00-0000" for i in range(1000)]), ("name", [f"{a}{b}{c}" for a in "BCD" for b in "aei" for c in "xyz"] + [n.title() for g in pii.NAMES.values() for n in g])):
        new = [pii.surrogate(kind, v) for v in values]
        assert len(set(new)) == len(values)
    all_two = {tuple(pii.permute((i // 10, i % 10), (10, 10), b"k", b"t")) for i in range(100)}
    assert len(all_two) == 100


def test_classifier(spark, none):
    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 4))
    rows = [(i, " ".join(word() + ("***" if i % 3 == 0 else "") for _ in range(30)), "s") for i in range(300)] + [(None, None, None), (1000, "", None), (1, "again", None)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(300)] + [(0, None), (None, 1), (5, 7)], "doc_id long, quality int")
    w = quality.fit(docs, labels)
    got = quality.score(docs, w).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and 1 < r.doc_id < 300]
    assert held and all(r.predicted == (r.doc_id % 3 != 0) for r in held) and all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (quality.fit(docs, turned) == w).all()  # held-out labels are never read
    assert quality.score(none, w).count() == 0 and (quality.fit(docs, labels.limit(0)) == 0).all()
    assert quality.keep_good(docs, w).columns == docs.columns


def test_byte_helpers():
    texts = ["Ab c", None, "", " x\x0b\ty ", "é" * 100 + " É", "z" * 300]
    h, at = common.words(pa.array(texts))
    assert np.diff(at).tolist() == [len(split(t)) for t in texts]
    assert h[0] == common.words(pa.array(["q AB"]))[0][1] and len(set(h.tolist())) == len({w for t in texts for w in split(t)})
    keys = np.sort(np.random.default_rng(0).integers(0, 2**64, 50, dtype=np.uint64))
    out, _ = common.unpack_sorted(common.pack_sorted(keys, np.arange(50)), 1)
    assert (out[0] == keys).all() and (out[1] == np.arange(50)).all()
