"""Quality classifier, embeddings, PII, secrets, HTML and the pipeline: brute force, held-out accuracy, edge cases."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"
ENTRY = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- quality
def test_kneser_ney_probabilities_match_the_textbook_recursion(spark):
    from millrace.llm.quality import ALPHABET, BITS, ORDER, _probabilities

    rng = random.Random(1)
    seen = collections.Counter(tuple(rng.choice([0, 2, 3, 5]) for _ in range(ORDER)) for _ in range(400))
    asked = set(seen) | {tuple(rng.choice([0, 2, 3, 5, 9]) for _ in range(ORDER)) for _ in range(80)}

    def code(g):
        return sum(x << BITS * (len(g) - 1 - i) for i, x in enumerate(g))

    counts = {ORDER: seen}
    for k in range(ORDER - 1, 0, -1):
        counts[k] = collections.Counter(g[1:] for g in counts[k + 1])

    def discounts(c):
        n = collections.Counter(c.values())
        if not (n[1] and n[2] and n[3]):
            return 0.5, 0.75, 0.9
        y = n[1] / (n[1] + 2 * n[2])
        d = 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]
        return [min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1)]

    def p(g):
        if not g:
            return 1 / ALPHABET
        c, d = counts[len(g)], discounts(counts[len(g)])
        same = {h: n for h, n in c.items() if h[:-1] == g[:-1]}
        total = sum(same.values())
        if not total:
            return p(g[1:])
        less = lambda n: d[min(n, 3) - 1]
        return (c[g] - less(c[g]) if g in c else 0) / total + sum(map(less, same.values())) / total * p(g[1:])

    rows = spark.createDataFrame([(code(g), seen.get(g, 0)) for g in asked], "gram long, n long")
    got = {r.gram: r.p for r in _probabilities(rows).collect()}
    assert got == {code(g): pytest.approx(p(g), rel=1e-9) for g in asked}


def test_quality_classifier_rejects_junk_and_keeps_trusted_text(spark):
    from millrace.llm.quality import classify, fit

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = classify(fit(docs, labels), docs).join(labels, "doc_id")
    rows = scored.selectExpr("quality", "toxic", "cast(kept as int) as kept").groupBy("quality", "toxic").avg("kept").collect()
    rate = {(r[0], r[1]): r[2] for r in rows}
    assert rate[(1, 0)] > 0.95 and rate[(0, 0)] < 0.4


def test_quality_thresholds_follow_the_length_in_every_language(spark):
    from pyspark.sql import functions as F

    from millrace.llm.quality import classify, fit

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = classify(fit(docs, labels), docs).join(labels, "doc_id").withColumn("chars", F.length("text")).where("chars > 0")
    longer = scored.selectExpr("lang", "chars", "lag(chars) over (partition by lang order by chars) as less",
                               "threshold", "lag(threshold) over (partition by lang order by chars) as above")
    assert scored.select("lang").distinct().count() >= 4  # most with fewer than 50 held-out documents
    assert longer.where("chars > less and not threshold < above").isEmpty()
    rate = {(r[0], r[1]): r[2] for r in scored.groupBy("quality", "toxic").agg(F.avg(F.col("kept").cast("int"))).collect()}
    print("rejected of (quality, toxic):", {k: round(1 - v, 3) for k, v in sorted(rate.items())})
    assert rate[(1, 0)] > 0.95 and rate[(1, 1)] < 0.55


def test_quality_classifier_edge_cases(spark):
    from millrace.llm.quality import classify, fit

    rng = random.Random(2)
    good = [" ".join(rng.choice(["the", "of", "and", "river", "stone"]) for _ in range(60)) for _ in range(60)]
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(good)]
    rows += [(100, "#### @@@@ %%%% ~~~~ " * 20, "en", "x", 1), (101, None, "en", None, None), (102, "", None, None, None), (103, good[0], None, None, 1),
             (103, good[0], None, None, 1), (None, good[1], "xx", None, 1)]
    docs = spark.createDataFrame([(*r, 5.0) for r in rows], DOC + ", perplexity double")
    labels = spark.createDataFrame([*[(i, 1, 0) for i in range(60)], (3, 0, 0), (None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")
    out = classify(fit(docs, labels), docs)
    assert out.columns == [*docs.columns[:5], "perplexity", "threshold", "kept"]
    kept = collections.Counter((r.doc_id, r.kept) for r in out.collect())
    assert kept[(100, False)] == kept[(101, False)] == kept[(102, False)] == 1 and kept[(103, True)] == 2 and kept[(None, True)] == 1
    none = classify(fit(docs, labels.where("false")), docs)
    assert none.where("kept").count() == len(rows) - 2
    assert classify(fit(docs.where("false"), labels), docs.where("false")).count() == 0


def test_every_character_has_a_code_of_its_own():
    from millrace.llm.quality import ALPHABET, ORDER, _class_table, _grams

    size, symbols = table = _class_table("etaoin")
    code = sum(symbols[k].astype(np.int64) * ALPHABET ** k for k in range(len(symbols)))
    assert len(np.unique(code)) == 0x110000 and (size == (symbols > 0).sum(0)).all()
    leads = set(symbols[0][size > 1])
    assert leads.isdisjoint(symbols[0][size == 1]) and all(len(set(size[symbols[0] == s])) == 1 for s in leads)  # read one way only
    texts = ["te\u4e2d", "\U0001F600", "a"]
    g, own, starts = _grams(texts, table)
    lengths = [sum(size[ord(c)] for c in t) for t in texts]
    want = []
    for t in texts:
        s = [0] * (ORDER - 1) + [int(symbols[k][ord(c)]) for c in t for k in range(size[ord(c)])]
        want += [sum(x * ALPHABET ** (ORDER - 1 - i) for i, x in enumerate(s[j:j + ORDER])) for j in range(len(s) - ORDER + 1)]
    assert g[own].tolist() == want and [int(own[:a].sum()) for a in starts] == [0, lengths[0], lengths[0] + lengths[1]]


def test_quality_tells_rare_characters_apart(spark):
    from millrace.llm.quality import classify, fit

    rng = random.Random(3)
    common = "".join(chr(c) for c in range(0x100, 0x100 + 70))  # more characters than symbols
    good, bad = "\u4e00\u4e01", "\u4e02\u4e03"  # both rarer than all of them
    text = lambda rare: "".join(rng.choice(common) for _ in range(300)) + rare * 10
    rows = [(i, text(good), "xx", "a", 1) for i in range(60)]
    tail = text("")
    rows += [(100, tail + good * 10, "xx", "a", 1), (101, tail + bad * 10, "xx", "a", 1)]
    docs = spark.createDataFrame(rows, DOC)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    p = {r.doc_id: r.perplexity for r in classify(fit(docs, labels), docs).where("doc_id >= 100").collect()}
    assert p[101] > 1.05 * p[100]


def test_word_probabilities_match_the_textbook_recursion(spark):
    from millrace.llm.quality import _Hashed, _terms, _word_model

    START, END = "start", "end"
    _pieces = lambda t: [*t.replace("\n", " \n ").split(" "), END]

    rng = random.Random(4)
    draw = lambda words: " ".join(rng.choice(words) for _ in range(rng.randrange(1, 12)))
    trusted = [draw(["a", "b", "c", "d", "e", ""]) for _ in range(60)] + ["a b\nc"] * 3
    trusted = [t for t in trusted if t]
    asked = list({draw(["a", "b", "c", "new", "other", ""]) for _ in range(60)} - {""}) + ["\n", trusted[0]]
    spelling = lambda w: -1.5 - len(w)

    def spellings(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(0).to_pylist()
            hashed = _Hashed(texts)
            words = [w for t in texts for w in _pieces(t)]
            assert [w if w != "\uffff " else END for w in hashed.words(hashed.at)] == words
            yield pa.RecordBatch.from_arrays([pa.array(hashed.h[hashed.at].view(np.int64)), pa.array([float(spelling(w)) for w in words])], names=["w", "spelling"])

    counts = {3: collections.Counter(g for t in trusted for w in [[START, START, *_pieces(t)]] for g in zip(w, w[1:], w[2:]))}
    for k in (2, 1):
        counts[k] = collections.Counter(g[1:] for g in counts[k + 1])

    def discounts(c):
        n = collections.Counter(c.values())
        if not (n[1] and n[2] and n[3]):
            return 0.5, 0.75, 0.9
        y = n[1] / (n[1] + 2 * n[2])
        d = 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]
        return [min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1)]

    def p(g):
        c, d = counts[len(g)], discounts(counts[len(g)])
        same = {h: n for h, n in c.items() if h[:-1] == g[:-1]}
        lower = p(g[1:]) if len(g) > 1 else math.exp(spelling(g[0]))
        total = sum(same.values())
        if not total:
            return lower
        less = lambda n: d[min(n, 3) - 1]
        return (c[g] - less(c[g]) if g in c else 0) / total + sum(map(less, same.values())) / total * lower

    docs = spark.createDataFrame([(t,) for t in [*asked, asked[0], asked[0], None, ""]], "text string")  # copies count once
    for chars in (1, 10 ** 8):  # in one turn, in several
        model = _word_model(spark.createDataFrame([(t,) for t in trusted], "text string"), spellings, chars)
        got = {r.id: r._term for r in _terms(docs, model, model.turns).withColumnRenamed("text", "id").collect()}
        ids = {r.text: r.id for r in docs.where("text <> ''").selectExpr("text", "xxhash64(text) as id").collect()}
        assert set(got) == set(ids.values()) and END in {g[2] for g in counts[3]}
        for t in asked:
            words = [START, START, *_pieces(t)]
            want = sum(math.log(p(g)) for g in zip(words, words[1:], words[2:]))
            have = got[ids[t]] + sum(map(spelling, words[2:])) + model.spelling * len(words[2:])
            assert have == pytest.approx(want, abs=1e-4)
        assert spark.table(model.name).count() > 0


def test_quality_classifier_knows_words(spark):
    from millrace.llm.quality import classify, fit

    rng = random.Random(5)
    known, new = ["lontariska", "ventarismu"], ["lontarismu", "ventariska"]  # of the same four-character n-grams
    text = lambda words: " ".join(rng.choice(words) for _ in range(200))
    rows = [(i, text(known), "xx", "a", 1) for i in range(60)] + [(100 + i, text(new if i else known), "xx", "a", 1) for i in range(2)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, DOC)
    got = {r.doc_id: r for r in classify(fit(docs, labels), docs).where("doc_id >= 100").collect()}
    assert not got[101].kept and got[101].perplexity > 1.05 * got[100].perplexity


# ---------------------------------------------------------------- embeddings
def test_embedding_links_match_brute_force(spark):
    from millrace.llm.embeddings import embedding_near_duplicates

    rng = np.random.default_rng(7)
    rows, i = [], 0
    for _ in range(150):
        rows.append((i, rng.standard_normal(10).tolist(), int(rng.integers(0, 3))))
        i += 1
    for c in range(6):  # groups around a centre, of several tightnesses
        centre = rng.standard_normal(10)
        for _ in range(40):
            rows.append((i, (centre * rng.uniform(0.5, 2) + rng.standard_normal(10) * (0.05 + 0.06 * c)).tolist(), c % 3))
            i += 1
    rows += [(i + k, rows[0][1], rows[0][2]) for k in range(5)]
    i += 5
    odd = [None, [], [0.0] * 10, [1.0, None] + [0.0] * 8, [float("nan")] * 10, [float("inf")] + [0.0] * 9, rows[0][1][:7]]
    rows += [(i + k, v, rows[0][2]) for k, v in enumerate(odd)]
    i += len(odd)
    rows += [(i, rows[0][1], None), (i + 1, rows[0][1], None)]
    df = spark.createDataFrame([(a, b, c, "clash") for a, b, c in rows], "vec_id long, embedding array<float>, label int, copies string")
    valid = [(a, np.array(b, np.float32).astype(float), c) for a, b, c in rows
             if c is not None and b and None not in b and np.isfinite(b).all() and any(b)]
    links, parent = collections.Counter(), {a: a for a, _, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x, l), (b, y, m) in itertools.combinations(valid, 2):
        if l == m and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
            links[a] += 1
            links[b] += 1
            parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_near_duplicates(df).collect()}
    assert len(got) == len(rows)
    assert sum(v[0] for v in got.values()) >= 0.99 * sum(links.values()) > 500
    assert all(got[a][0] <= links[a] for a in got)
    same = sum(got[a][1] == root(a) for a in got)
    assert same >= 0.99 * len(rows) and all(v[2] == (a == v[1]) for a, v in got.items())
    assert embedding_near_duplicates(df.where("false")).count() == 0


def test_blocks_of_a_full_list_give_the_same_links(spark, monkeypatch):
    from millrace.llm import embeddings

    rng = np.random.default_rng(3)
    centre = rng.standard_normal(8)
    df = spark.createDataFrame([(i, (centre + 0.02 * rng.standard_normal(8)).tolist(), 1) for i in range(90)], "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rows = embeddings.embedding_near_duplicates(df).collect()
    assert {r.n_links for r in rows} == {89} and {r.component_id for r in rows} == {0}


# ---------------------------------------------------------------- PII
def _luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        s += x - 9 * (x > 9)
    return s % 10 == 0


def _base(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for k, pattern, low, high in ((2, r"[0-9]([\x20-]?[0-9])+", 12, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m[0])
            if low <= len(d) <= high and (k == 3 or _luhn(d)):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii_base_spans_match_brute_force(spark):
    from millrace.llm.pii import KINDS, pii_report

    rng = random.Random(11)
    parts = ["a@b.c", "x.y%z@d-e.f.g", "@", ".", "..", "1.2.3.4", "256.1.1.1", "001.02.3.4", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (743) 555-3824", "+12", "é", "😀", "\n", " ", "-", "4", "79927398713" * 2, "a@b", "a@b.c%x@d.e", "1234567890123456789012", "日本"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(400)] + [None, "", "9" * 3000, "a" * 3000 + "@", "1." * 2000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii_report(docs).collect()}
    for i, t in enumerate(texts):
        spans = _base(t or "")
        said = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)], t
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest(), t
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))
    assert pii_report(docs.where("false")).count() == 0


def test_pii_patterns_discover_unseen_identifiers(spark):
    from millrace.llm.pii import pii_report, redact

    rows = [(i, f"please write to user{i}@mail.example today", None, None, 40) for i in range(30)]
    rows += [(100, "please write to agent-77x today", None, None, 1), (101, "they saw 12345 birds and agent-78x there", None, None, 1), (101, None, None, None, None)]
    docs = spark.createDataFrame([(*r, "k") for r in rows], DOC + ", _base string")
    got = {r.doc_id: r for r in pii_report(docs).where("spans != ''").collect()}
    assert got[100].spans == "id:16:25" and got[100].n_discovered == 1 and 101 not in got
    clean = redact(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    text = {r.doc_id: (r.text, r.n_chars) for r in clean.where("text is not null").collect()}
    assert text[0] == ("please write to [EMAIL] today", 29) and text[100][0] == "please write to [ID] today"
    assert text[101] == (rows[-2][1], 1)


# ---------------------------------------------------------------- secrets
def test_forest_finds_held_out_secrets(spark):
    from millrace.llm import secrets

    rng = random.Random(5)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = []
    for i in range(160):
        value = hexes(40) if i % 2 else "".join(rng.choice(["stone", "river", "tion", "ment", "house"]) for _ in range(6))
        rows.append((i, f"river stone house token = \"{value}\" stone house" if i % 2 else f"river {value} house stone", "a/b.py", 1))
    rows += [(500, None, None, 1), (501, "", "x", 1), (None, f"river secret: {hexes(32)} house", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, label long")
    found = secrets.findings(docs)
    model = secrets.fit(found.where("pmod(xxhash64(value), 3) != 0"))
    held = model.transform(found.where("pmod(xxhash64(value), 3) = 0 and label is not null")).selectExpr("label = prediction as ok").collect()
    assert len(held) > 20 and sum(r.ok for r in held) >= 0.95 * len(held)
    scanned = secrets.secret_scan(docs).collect()
    assert {r.doc_id for r in scanned if r.secret} >= {*range(1, 160, 2)} and None in {r.doc_id for r in scanned}
    assert not any(r.secret for r in scanned if r.doc_id is not None and r.doc_id % 2 == 0)
    assert secrets.secret_scan(docs.where("doc_id % 2 = 0")).where("secret").count() == 0  # one class: no forest
    assert secrets.secret_scan(docs.where("false")).count() == 0


def test_dictionary_coverage(spark):
    from millrace.llm.secrets import coverage

    found = spark.createDataFrame([(1, "stoneXX"), (2, "qqqqqq"), (3, "riverstone")], "finding long, value string")
    words = spark.createDataFrame([("stone",), ("river",), ("ers",)], "word string")
    assert {r.finding: r.coverage for r in coverage(found, words).collect()} == {1: pytest.approx(5 / 7), 3: 1.0}


# ---------------------------------------------------------------- HTML
def test_minimum_cut_is_the_cheapest_labelling():
    from millrace.llm.html_text import minimum_cut

    rng = random.Random(8)
    for _ in range(60):
        n = rng.randint(1, 7)
        content, boiler = ([rng.uniform(0, 3) for _ in range(n)] for _ in range(2))
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a) if rng.random() < 0.5]

        def cost(y):
            return sum(content[i] if y[i] else boiler[i] for i in range(n)) + sum(w for a, b, w in edges if y[a] != y[b])

        assert cost(minimum_cut(content, boiler, edges)) == pytest.approx(min(map(cost, itertools.product([False, True], repeat=n))))


def test_settled_blocks_agree_with_the_whole_cut():
    from millrace.llm import html_text as H

    page = "<body><div class=menu><a href=x>Home page</a><a href=y>Other</a></div><div><p>Some words of running text, quite a few of them, that go on.<p>Short.<p>More " \
        "running text that is long enough to count as content here.<li>x</li></div><div>lone words</div>"
    blocks = H.blocks_of(page)
    z = [H.log_odds(b, False) for b in blocks]
    best = None
    for y in itertools.product([False, True], repeat=len(blocks)):
        last, cost = {}, sum(math.log1p(math.exp(-z[i])) if y[i] else math.log1p(math.exp(z[i])) for i in range(len(y)))
        for i, b in enumerate(blocks):
            cost += H.ADJACENT * (i > 0 and y[i] != y[i - 1])
            cost += H.SAME_PARENT * (b.parent in last and y[i] != y[last.get(b.parent, i)])
            last[b.parent] = i
        if best is None or cost < best[0]:
            best = cost, list(y)
    assert H.label(blocks) == best[1]


def test_html_main_text():
    from millrace.llm.html_text import main_text

    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar"><header><h1>Site</h1></header>
    <nav><ul><li><a href="/a">A</a></li></ul></nav><div class="cookie-notice">We use cookies.</div><article><h1>Title &amp; more</h1><p>One  two
    three&nbsp;four.<br>five</p><div class="ad">Buy</div><aside>Side</aside><form><label>Name</label><input></form><p>Six <b>sev</b>en, <a href="y">eight</a> &lt;x&gt; a < b.
    <p>Nine<!-- no --> ten</p><section id="comments"><p>Nice post, I agree with everything in it!</p></section></article><footer>c</footer></body></html>"""
    assert main_text(page) == "Title & more\nOne two three four. five\nSix seven, eight <x> a < b.\nNine ten"
    assert main_text("<article><p>cut &am") == "cut &am" and main_text("<article><p>cut</p></art") == "cut"
    assert main_text(None) == main_text("") == main_text("<script>never closed") == ""
    assert main_text("<article>" + "<p>word</p>" * 5000) == "\n".join(["word"] * 5000)


def test_html_extraction_frame(spark):
    from millrace.llm.html_text import extract

    pages = spark.createDataFrame([(1, "u", "<article><p>é 😀</p></article>", 1), (1, "u", "<article><p>é 😀</p></article>", 2), (None, None, None, 3)],
                                  "page_id long, url string, html string, text long")
    assert sorted(map(tuple, extract(pages).collect()), key=str) == sorted([(1, "u", "é 😀", 3), (1, "u", "é 😀", 3), (None, None, "", 0)], key=str)
    assert extract(pages.where("false")).count() == 0


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{ENTRY}/documents.parquet")
    sizes = [docs.count()]
    from millrace.llm.common import stored
    current = docs
    for name, stage in pipeline.STAGES[:-1]:
        current = stored(stage(spark, current, ENTRY), "test")
        assert current.columns == docs.columns, name
        sizes.append(current.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4] > 0.5 * sizes[0]
    pieces = pipeline.STAGES[-1][1](spark, current, ENTRY)
    assert pieces.where("start = 0").count() == sizes[-1]
    empty = docs.where("false")
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, ENTRY).count() == 0


def test_pipeline_run_and_odd_rows(spark, scratch):
    import shutil

    import corpus_pipeline as pipeline

    odd = spark.createDataFrame([(None, None, None, None, None), (7, "", "en", "s", 0), (7, "", "en", "s", 0), (8, "word " * 20000, "de", None, 1)], DOC)
    spark.read.parquet(f"{ENTRY}/documents.parquet").unionByName(odd).write.parquet(f"{scratch}/documents.parquet")
    for t in ("labels", "benchmark"):
        shutil.copy(f"{ENTRY}/{t}.parquet", f"{scratch}/{t}.parquet")
    assert pipeline.run(spark, scratch).count() > 100


def test_html_left_open_and_words_among_others_lose_no_text():
    from millrace.llm.html_text import main_text

    said = "The river rose over its banks in the night, and by the morning all of the lower fields stood under water."
    p = f"<p>{said}</p>"
    assert main_text(f"<html><head><title>t</title><body><article>{p}</article></body></html>") == said
    assert main_text(f"<html><head><meta charset=x><title>t<body><article>{p}</article></body></html>") == said
    for tag in ("noscript", "object", "svg", "iframe", "canvas", "script"):
        page = f"<body><main><article>{p}<div><{tag}>x</div>{p}</article></main></body>"
        assert main_text(page) == f"{said}\n{said}", tag
        page = f"<body><main>{p}<div><{tag}><b>x</b></{tag}></div>{p}</main></body>"
        assert main_text(page) == f"{said}\n{said}", tag
    assert main_text(f"<body><article><p>{said} <svg><g><text>x</text>{p}</article></body>") == f"{said}\n{said}"
    assert main_text(f"<article><p>{said} <math><mi>k</mi></math> is large.</p></article>") == f"{said} k is large."
    for name in ("layout has-sidebar", "post with-comments"):
        assert main_text(f'<body><div class="{name}"><article>{p}</article></div></body>') == said
        assert main_text(f'<body><div class="{name}"><p>{" ".join([said] * 6)}</p></div></body>') == " ".join([said] * 6)
    assert main_text(f'<body><article>{p}</article><div class="comments">{p}</div></body>') == said
    assert main_text(f'<body><article>{p}<div class="post-comments">{p}</div></article></body>') == said


def test_discovery_needs_one_side_only_and_goes_on_from_what_it_found(spark):
    from millrace.llm.pii import pii_report

    texts = [f"write to user{i}@example.org. Row {i} ends." for i in range(90)] + ["please write to agent-77x.", "write to agent-78x"]
    texts += ["the first was agent-10y of all"]
    # found after 'write to', then known: six of them make 'badge' a pattern, which finds another
    texts += [f"write to agent-{k}z" for k in range(80, 86)] + [f"her badge agent-{k}z, shown" for k in range(80, 86)] + ["his badge keeper-99q"]
    texts += ["write to " + "x" * 60 + "-123"]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)], DOC)
    found = {texts[r.doc_id]: [s.split(":") for s in r.spans.split(",") if s] for r in pii_report(docs).collect()}
    ids = {t: [t[int(a):int(b)] for k, a, b in v if k == "id"] for t, v in found.items()}
    assert ids["please write to agent-77x."] == ["agent-77x"] and ids["write to agent-78x"] == ["agent-78x"]
    assert ids["his badge keeper-99q"] == ["keeper-99q"]
    assert ids["write to " + "x" * 60 + "-123"] == ["x" * 60 + "-123"]
    assert ids["the first was agent-10y of all"] == []
