"""Each operator against a plain statement of its rule, and on odd rows and empty tables."""

import hashlib
import random
import re
from collections import Counter
from math import log10

import numpy as np
import pytest

from shelfprice.llm import (decontaminate, fingerprints, html_extract, jaccard_join, lm_score, mixing, quality, secrets,
                            suffix_dedup, url_filter)
from shelfprice.llm.common import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(spark):
    return {r.doc_id: r.text or "" for r in documents(spark).collect()}


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sets(texts, k):
    out = {}
    for i, t in texts.items():
        w = WORD.findall(low(t or ""))
        out[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    return out


def linked_components(texts, k, percent):
    s = sets(texts, k)
    least = {i: i for i in s}
    ids = sorted(s)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:]
             if s[a] and s[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b])]
    while True:
        before = dict(least)
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
        if before == least:
            return least


def test_components(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, 7), (7, 50), (3, 3)]
    got = dict(tuple(r) for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 10 for i in range(10, 41)}, 100: 7, 7: 7, 50: 7}


def family(n, edits, seed):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(5000)}" for _ in range(60)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_jaccard_components(spark, k, percent, monkeypatch):
    texts = {i: t for i, t in enumerate([t for f in range(6) for t in family(25, 4, f)] + ["", "one", "one", "a b", "A  b", None])}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = linked_components(texts, k, percent)
    for block in (256, 4):                           # whole groups in one tile, and in many
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
        got = jaccard_join.join_components(spark, df, shingle=k, percent=percent).collect()
        assert {r.id: r.component_id for r in got} == want
    monkeypatch.setattr(jaccard_join, "ROW_COST", 0)   # segments are exchanged for one-deletion neighbourhoods
    monkeypatch.setattr(jaccard_join, "DELETION_FACTOR", 0.5)
    monkeypatch.setattr(jaccard_join, "MAX_BROADCAST", 0)
    assert {r.id: r.component_id for r in jaccard_join.join_components(spark, df, shingle=k, percent=percent).collect()} == want


def test_suffix_dedup(spark):
    rnd = random.Random(3)
    pieces = ["".join(rnd.choices("abcdefgh ", k=60)) for _ in range(12)]
    texts = {i: "".join(rnd.choices(pieces, k=rnd.randrange(1, 14))) for i in range(40)} | {90: "ab" * 100, 91: "é" * 70, 92: None, 93: ""}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    n = 80
    data = {i: (t or "").encode() for i, t in texts.items()}
    seen = Counter(b[i:i + n] for b in data.values() for i in range(len(b) - n + 1))
    for limit in (2048, 2):
        for r in suffix_dedup.dedup(spark, df, length=n, anchor=24, max_contexts=limit).collect():
            b, gone = data[r.id], set()
            for i in range(len(b) - n + 1):
                if seen[b[i:i + n]] > 1:
                    gone.update(range(i, i + n))
            assert bytes(r.kept) == bytes(c for i, c in enumerate(b) if i not in gone)
            assert r.n_bytes == len(b) and sum(s.end - s.start for s in r.removed) == len(gone)


def test_secret_links(spark):
    far = "x " * 300
    texts = {1: "me@site.example password=abcdef", 2: "me@site.example " + far + " password=abcdef", 3: "me@site.example",
             4: "password: token:abcdefgh", 5: "AKIA" + "A" * 16 + " " + "xy1" * 12 + "Z", 6: "xy1" * 12 + "Z", 7: None}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.id: [tuple(s) for s in r.spans] for r in secrets.scan(spark, df).collect()}
    assert got[1] == [("login", 0, 15), ("assign", 16, 31)]
    assert [k for k, *_ in got[2]] == ["assign"] and got[3] == [] and got[4] == [] and got[7] == []
    assert [k for k, *_ in got[5]] == ["access", "opaque"] and got[6] == []
    red = {r.doc_id: r.text for r in secrets.redact(spark, df).collect()}
    assert red[1] == "[secret] [secret]" and red[3] == texts[3] and red[7] is None


def test_secret_base_spans(spark):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    rules = [("assign", assign, lambda m: len(m[2]) >= 6), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
             ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
    texts = texts_of(spark)
    for r in secrets.op1_secrets(spark, SF).collect():
        spans = sorted((m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, rx, ok) in enumerate(rules)
                       for m in rx.finditer(texts[r.doc_id]) if ok(m))
        assert r.base_sha256 == hashlib.sha256(",".join(s for _, _, s in spans).encode()).hexdigest()


def test_fingerprints(spark):
    texts = texts_of(spark)
    ids = sorted(texts, reverse=True)
    rows = {r.doc_id: r for r in fingerprints.op6_fingerprints(spark, SF).collect()}
    for a, b in zip(ids, ids[1:] + ids[:1]):
        t, n = texts[a], len(texts[a])
        edited = t[:n - n // 2] + texts[b][:n // 2]
        assert rows[a].n_chars == n and rows[a].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        x, y = int(rows[a].fingerprint, 16), int(rows[b].fingerprint, 16)
        assert rows[a].near_next == 1 - bin(x ^ y).count("1") / 64
    assert len({(texts[i], rows[i].fingerprint) for i in ids}) == len(set(texts.values()))


def test_near_fingerprints(spark):
    rnd = random.Random(1)
    base = [rnd.getrandbits(64) - (1 << 63) for _ in range(60)]
    near = [b ^ (1 << rnd.randrange(62)) ^ (1 << rnd.randrange(62)) for b in base]
    f = sorted({*base, *near})
    got = {(r.a, r.b) for r in fingerprints.near_fingerprints(
        spark, spark.createDataFrame([(x,) for x in f + f], "fingerprint long")).collect()}
    assert got == {(a, b) for i, a in enumerate(f) for b in f[i + 1:] if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 3}


def test_lm_probabilities_add_up(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a b a b a c", "b a b", "a a b d", "c a b a b"] * 5)], "doc_id long, text string")
    rows = lm_score.with_fold(df, "doc_id", "text")
    _, a, total = lm_score.train(spark, rows)
    words = np.append(a.words, np.uint64(12345))      # one unknown word stands for all of them
    for state in range(len(a.states) + 1):
        p = 0.0
        for w in words:
            place = a.place(np.array([w], np.uint64))[0]
            at, arc = lm_score.lookup(a.arcs, np.array([state * (len(a.states) + 2) + place]))
            p += 10 ** a.arc_cost[at[0]] if place >= 0 and arc[0] else a.left[state] * 10 ** a.base(np.array([w], np.uint64))[0][0]
        assert abs(p - 1) < 1e-9
    scored = lm_score.score(spark, df).collect()
    counts = Counter(w for r in scored if not r.held_out for w in [*df.filter(f"doc_id = {r.id}").first().text.split(), "END"])
    for r in scored[:4]:
        tokens = [*df.filter(f"doc_id = {r.id}").first().text.split(), "END"]
        want = sum(log10((counts[w] + 1) / (total + len(counts) + 1)) for w in tokens)
        assert abs(r.base_score - want) < 1e-9 and r.n_tokens == len(tokens)


@pytest.mark.parametrize("share", [4e-6, 0.03, 2])
def test_lm_scores_equal_all_n_grams(spark, share, monkeypatch):
    """Whole model of order 3 in plain Python; with all, some and no n-grams held in the tasks."""
    monkeypatch.setattr(lm_score, "HEAD_SHARE", share)
    rnd = random.Random(11)
    texts = {i: " ".join(rnd.choice("abcdefgh") + rnd.choice(["", "", "x", "y"]) for _ in range(rnd.randrange(0, 30))) for i in range(60)}
    texts |= {100 + i: texts[i] for i in range(0, 60, 9)}
    scored = lm_score.score(spark, spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    count = [Counter() for _ in range(4)]
    runs = {r.id: ["START", *texts[r.id].split(), "END"] for r in scored}
    for r in scored:
        t = runs[r.id]
        for k in (1, 2, 3):
            count[k].update(tuple(t[j:j + k]) for j in range(k == 1, len(t) - k + 1) if not r.held_out)
    count[1]["START",] = count[1]["END",]
    total = sum(n for g, n in count[1].items() if g != ("START",))
    floor = total + len(count[1])                            # START is no word, the unknown word is one

    def p(gram):
        if len(gram) == 1:
            return (count[1][gram] + 1) / floor
        mass, k = count[len(gram) - 1][gram[:-1]], len(gram)
        used = sum(n - 0.75 for g, n in count[k].items() if g[:-1] == gram[:-1] and n > 1) if mass else 0
        own = (count[k][gram] - 0.75) / mass if count[k][gram] > 1 else 0
        return own + (1 - used / mass if mass else 1) * p(gram[1:])

    for r in scored:
        t = runs[r.id]
        want = sum(log10(p(tuple(t[max(0, j - 2):j + 1]))) for j in range(1, len(t)))
        assert abs(r.score - want) < 1e-8 and r.n_tokens == len(t) - 1
        assert r.n_known == sum(count[1][w,] > 0 for w in t[1:]) and r.train_tokens == total


def test_kneser_ney_is_a_distribution():
    rnd = np.random.default_rng(0)
    top = np.zeros(quality.SYMBOLS ** 4, np.int64)
    top[rnd.integers(0, len(top), 3000)] = rnd.integers(1, 9, 3000)
    p = (10 ** quality.kneser_ney(top).astype(np.float64)).reshape(-1, quality.SYMBOLS).sum(-1)
    assert np.allclose(p, 1, atol=1e-4)


def test_quality_separates_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r.accepted for r in quality.op9_quality(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    good = [got[r.doc_id] for r in labels if r.quality == 1]
    bad = [got[r.doc_id] for r in labels if r.quality == 0]
    assert sum(good) > 0.95 * len(good) and sum(bad) < 0.4 * len(bad)


def test_quality_of_many_languages_and_whole_quantiles(spark):
    rnd = random.Random(4)
    letters = {f"l{k}": rnd.sample("abcdefghijklmnopqrstuvwxyz", 5) for k in range(11)}
    rows = [(f"l{k}", " ".join("".join(rnd.choices(letters[f"l{k}"], k=5)) for _ in range(30))) for k in range(11) for _ in range(130 if k < 8 else 120)]
    junk = [(lang, " ".join("".join(rnd.choices(letters["l0"], k=5)) for _ in range(30))) for lang in ("l8", "l9", "l10")]
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows + junk)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(rows))], "doc_id long, quality int, toxic int")
    model = quality.fit(spark, df, labels)
    assert set(model.thresholds) == {*letters, quality.POOLED}
    got = {r.id: r for r in quality.classify(spark, df, labels).collect()}
    assert sum(got[i].accepted for i in range(len(rows))) > 0.95 * len(rows)
    assert not any(got[len(rows) + i].accepted for i in range(len(junk)))
    few = quality.fit(spark, df, labels, max_trusted=40, quantile=0.5)      # about 30 train a model, all others set its threshold
    scored = df.filter(f"doc_id < {len(rows)}").withColumn("ppl", quality.scorer(spark, few)("text", "lang")).collect()
    for lang, t in few.thresholds.items():
        if lang != quality.POOLED:
            share = np.mean([r.ppl <= t for r in scored if r.lang == lang])
            assert 0.45 < share < 0.75


def test_alignment():
    a = np.arange(10, 30).astype(np.uint64)
    assert decontaminate.align(a, a) == (40, 20)
    text = np.concatenate([[1, 2], a[:8], [99], a[9:15], a[16:], [3]]).astype(np.uint64)     # one changed, one left out
    assert decontaminate.align(a, text) == (2 * 18 - 1 - 1, 21)


def test_decontamination(spark):
    rnd = random.Random(5)
    items = {i: " ".join(f"w{rnd.randrange(3000)}" for _ in range(30)) for i in range(6)}
    filler = " ".join(f"f{rnd.randrange(3000)}" for _ in range(200))
    edited = items[2].split()
    edited[5], edited[15], edited[20:21] = "zzz", "yyy", []
    docs = [(0, filler), (1, f"{filler} {items[1].upper()} {filler}"), (2, f"{filler} {' '.join(edited)} {filler}"), (3, None)]
    docs += [(100 + i, f"{i} {items[3]} {filler}") for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([*items.items(), (9, "too short"), (10, None)], "item_id long, text string")
    got = {(r.id, r.item_id) for r in decontaminate.contaminated(spark, df, bench).collect()}
    assert got == {(1, 1), (2, 2), *((100 + i, 3) for i in range(50))}
    assert {r.doc_id for r in decontaminate.keep_clean(spark, df, bench).collect()} == {0, 3}


def test_decontamination_of_copies_with_spread_edits(spark):
    rnd = random.Random(7)
    items = {i: [f"w{rnd.randrange(3000)}" for _ in range(30 + i // 6)] for i in range(12)}
    filler = [f"f{rnd.randrange(3000)}" for _ in range(150)]
    docs = [(100 + i, filler + w + filler) for i, w in items.items() if i % 2]  # a whole copy keeps all 3-grams in the corpus
    for i, w in items.items():
        step = 4 + i % 3
        edited = [f"e{rnd.randrange(10 ** 6)}" if j % step == step - 1 else x for j, x in enumerate(w)]
        docs.append((1000 + i, filler + edited + filler))
        docs.append((2000 + i, filler + w[:6] + filler + w[-6:]))               # seeds, but no copy
    docs.append((3000, filler[:40] + sum(([*w[:4], *filler[:3]] for w in items.values()), [])))
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    code: dict = {}
    number = (lambda w: np.array([code.setdefault(x, len(code)) for x in w], np.uint64))
    want = {}
    for d, text in docs:
        for i, w in items.items():
            score, _ = decontaminate.align(number(w), number(text))
            if score >= len(w):
                want[d, i] = score / (2 * len(w))
    got = {(r.id, r.item_id): r.similarity for r in decontaminate.contaminated(spark, df, bench).collect()}
    assert len(want) >= 6 + len(items) and got == want


def test_html_blocks():
    page = ("<title>t</title><nav><a>menu</a></nav><div class='cookie-notice'>ok?</div><article><header><h1>A &amp; B</h1></header>"
            "<p>one <b>two\n three<br>four<p>five<aside>no</aside><form>no</form><script>if (a<b) x('</p>')</script>"
            "<section id=comments><p>no</p></section></article><footer>no</footer>")
    assert [t for t, role in html_extract.blocks(page) if role == "in"] == ["A & B", "one two three four", "five"]


def test_html_host_runs_decide_without_structure(spark):
    pages = [(i, f"http://h.example/{i}", f"<div>terms of use apply to all of this</div><p>page {i} has own words a{i} b{i} c{i}</p>") for i in range(4)]
    pages += [(9, None, None), (10, "x", "")]
    got = {r.id: r.text for r in html_extract.extract(spark, spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {**{i: f"page {i} has own words a{i} b{i} c{i}" for i in range(4)}, 9: "", 10: ""}


def test_html_copied_pages_and_large_hosts_keep_their_prose(spark):
    rnd = random.Random(2)
    phrases = [" ".join(f"v{rnd.randrange(4000)}" for _ in range(4)) for _ in range(120)]
    notice, short = "all offers end without any further word of ours", "call us any day"

    def prose():
        return " ".join(rnd.choice(phrases) + f" u{rnd.randrange(10 ** 9)}" for _ in range(12))

    body = {i: prose() for i in range(90)}                                  # four-word phrases recur on other pages
    pages = [(i, f"http://big.example/{i}", f"<div>{notice}</div><p>{t}</p><div>{short}</div><p>end u{i}</p>") for i, t in body.items()]
    pages += [(100, "http://a.example/1", "<p>one page told here in its own ten plain words</p><p>and more of it below</p>")]
    pages += [(101, "http://a.example/2", pages[-1][2]), (102, "http://b.example/", pages[-1][2]), (103, "http://b.example/", pages[-1][2])]
    got = {r.id: r.text for r in html_extract.extract(spark, spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    copied = "one page told here in its own ten plain words\nand more of it below"
    assert got == {**{i: f"{t}\nend u{i}" for i, t in body.items()}, **dict.fromkeys(range(100, 104), copied)}


def test_url_rules(spark):
    rows = [(1, "http://a.b.org/en/1x"), (2, "https://Example.ORG/en/14?q"), (3, "http://x.example.org/es/"), (4, "http://c.com/de/1"),
            (5, "http://c.com"), (6, None), (7, "no scheme"), (8, "http://myorg/"), (9, "http://c.com/fr/?x")]
    got = {r.id: (r.rule, r.verdict) for r in url_filter.judge(spark, spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got == {1: ("org/", "allow"), 2: ("example.org/en/1", "block"), 3: ("example.org/es/", "block"), 4: ("com/de/", "block"),
                   5: (None, "allow"), 6: (None, "allow"), 7: (None, "allow"), 8: (None, "allow"), 9: ("com/fr/", "allow")}


def test_odd_rows(spark, odd_docs):
    n = odd_docs.count()
    bench = spark.createDataFrame([(1, None), (2, "")], "item_id long, text string")
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (None, 1, 0), (5, None, 0), (9, 1, None)], "doc_id long, quality int, toxic int")
    assert secrets.scan(spark, odd_docs).count() == n
    assert secrets.redact(spark, odd_docs).columns == odd_docs.columns
    assert decontaminate.contaminated(spark, odd_docs, bench).count() == 0
    j = jaccard_join.join_components(spark, odd_docs, shingle=3, percent=90).collect()
    assert len(j) == n and {r.component_id for r in j if r.id in (6, 7)} == {6} and {r.id for r in j if r.n_shingles == 0} == {1, 2, 3}
    assert jaccard_join.keep_one(spark, odd_docs).count() == n - 3      # the copies of 4 and 6
    assert fingerprints.with_next(spark, odd_docs.selectExpr("doc_id id", "coalesce(text, '') text", "xxhash64(coalesce(text, '')) text_key")).count() == n
    assert lm_score.score(spark, odd_docs).count() == n
    assert suffix_dedup.dedup(spark, odd_docs).count() == n
    assert [r.accepted for r in quality.classify(spark, odd_docs, labels).filter("id <= 2").collect()] == [False, False]
    m = mixing.mix(spark, odd_docs).collect()
    assert len(m) == n and all(r.taken <= 2 * r.size for r in m)
    assert mixing.mixed(spark, odd_docs).columns == [*odd_docs.columns, "mix_times"]


def test_empty_tables(spark, odd_docs):
    none = odd_docs.filter("false")
    bench = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for df in (secrets.scan(spark, none), decontaminate.contaminated(spark, none, bench), jaccard_join.join_components(spark, none),
               lm_score.score(spark, none), suffix_dedup.dedup(spark, none), quality.classify(spark, none, labels), mixing.mix(spark, none),
               fingerprints.with_next(spark, none.selectExpr("doc_id id", "text", "xxhash64(text) text_key")),
               url_filter.judge(spark, none, id_col="doc_id", url_col="text"),
               html_extract.extract(spark, none, "doc_id", "text", "text")):
        assert df.count() == 0
    assert decontaminate.contaminated(spark, odd_docs, bench.filter("false")).count() == 0


def test_pipeline_stages_keep_columns(spark):
    import corpus_pipeline

    docs = documents(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(spark, stage(spark, docs, SF), name)
        assert docs.columns == columns
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.count() > 0 and out.filter("mix_times < 1 or mix_times > 2").count() == 0
    whole = linked_components({r.doc_id: r.text for r in docs.collect()}, 5, 80)
    assert all(i == c for i, c in whole.items())        # no two of what is left are near copies
