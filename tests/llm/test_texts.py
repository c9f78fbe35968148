"""Tokens, quality, templates, languages, pages, preferences and licences, and the pipeline."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import regex
import tiktoken
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import DATA
from oracle import connect, same
from tideframe.llm import bpe, langid, licences, pages, preferences, quality, queries, templates

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PATTERN = regex.compile(public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abstrevmldD'' \n\t\r 1½é!?.　\x85\x1c中😀ⅷ")), max_size=6))
def test_pre_tokens(texts):
    tokens, counts = bpe.pre_tokens(texts)
    at = 0
    for text, n in zip(texts, counts):
        assert tokens[at : at + n] == PATTERN.findall(text)
        at += n


def token_row(i, text):
    ids = LIBRARY.encode_ordinary(text or "")
    return i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_round_trip(spark):
    docs = [(1, "It's 'so' they'll!  2 words\n\n"), (1, "It's 'so' they'll!  2 words\n\n"), (None, "a" * 5000), (2, None), (3, ""), (4, " "), (5, "éü 中文 😀 <|endoftext|>")]
    df = spark.createDataFrame([(i, t, b"x") for i, t in docs], "doc_id long, text string, ids binary")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert sorted(map(tuple, bpe.digests(spark, df, path).collect()), key=repr) == sorted((token_row(*d) for d in docs), key=repr)
    assert bpe.digests(spark, df.limit(0), path).count() == 0
    rows = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, queries.QUERIES["op1_bpe_round_trip"](spark, f"{DATA}/sf0.001").collect())) == sorted(token_row(*r) for r in rows)


def bucket(*words):
    own = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in words]
    h = own[0]
    if len(own) > 1:
        h = 42
        for x in own:
            h = xxhash.xxh64_intdigest(x.to_bytes(8, "little"), seed=h)
    return (h - 2**64 if h >= 2**63 else h) % quality.BUCKETS


def plain_quality(docs, trusted):
    rows, total, target = [], collections.Counter(), collections.Counter()
    for i, text in docs:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        inside = {j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
        seen, again = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                again += line in seen
                seen.add(line)
        failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
        grams = [bucket(x) for x in w] + [bucket(x, y) for x, y in zip(w, w[1:])]
        total.update(grams)
        if i in trusted:
            target.update(grams)
        rows.append(((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, len(inside), failed), grams))
    share = sum(target.values()) / max(1, sum(total.values()))

    def weight(b):
        e = total[b] * share
        gap = (target[b] - e) ** 2
        return gap and math.log((target[b] + quality.PRIOR) / (e + quality.PRIOR)) * gap / (gap + quality.SURE**2 * e * (1 - share))

    out = []
    for base, grams in rows:
        score = sum(map(weight, grams)) / (len(grams) + quality.SHRINK) if grams else 0.0
        out.append((*base, not base[-1] and score >= quality.THRESHOLD))
    return sorted(out, key=repr)


def test_quality(spark):
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    docs = [(1, None), (2, ""), (3, "a b\na b\n \n \n#x $y"), (None, "one two three four five six seven eight nine ten"), (5, "u v w x y " * 6), (5, "u v w x y " * 6), (6, " lead and trail\v"), (7, "long text of words " * 20_000), (8, "x" * 100_000)]
    df = spark.createDataFrame([(i, t, 9) for i, t in docs], "doc_id long, text string, n_words int")
    labels = spark.createDataFrame([(5, 1, 0), (5, 1, 0), (None, 1, 0), (3, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    assert sorted((tuple(r) for r in quality.verdicts(df, labels).select(cols).collect()), key=repr) == plain_quality(docs, {5})
    assert quality.verdicts(df.limit(0), labels).count() == 0
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    good = {r.doc_id for r in spark.read.parquet(f"{DATA}/sf0.001/labels.parquet").filter("quality = 1 AND toxic = 0").collect()}
    got = queries.QUERIES["op9_quality_rules"](spark, f"{DATA}/sf0.001").select(cols)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_quality(rows, good)


def test_templates(spark):
    item = "When Anna has 12 apples and gives Bob 5 of the apples she had in 3 days"
    bench = spark.createDataFrame([(10, item), (11, None), (12, "9 8 7 6 5 4 3 2 1 0"), (13, "")], "item_id long, text string")
    other = "Then Carl has 99 apples and gives {} 7 of the apples she had in 8 days"
    docs = [(1, f"Noise. {item}."), (1, f"Noise. {item}."), (2, other.format("Dora")), (3, other.format("Carl")), (4, None), (5, ""), (6, "1 2 3 4 5 6 7 8 9 10 11"), (None, item)]
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item_id int")
    got = {(r.doc_id, r.item_id, r.copied, r.reparameterised) for r in templates.report(df, bench).collect()}
    assert got == {(1, 10, True, False), (2, 10, False, True), (None, 10, True, False)}
    assert templates.report(df.limit(0), bench).count() == templates.report(df, bench.limit(0)).count() == 0


def test_templates_find_what_stands_word_by_word(spark, monkeypatch):
    monkeypatch.setattr(templates, "PASS", 500)  # several passes
    sf = f"{DATA}/sf0.01"

    def norm(t):
        return f" {' '.join(re.findall(r'\w+', t.lower()))} "

    items = [(r.item_id, norm(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {(r.doc_id, i) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for i, t in items if t in norm(r.text)}
    assert {(r.doc_id, r.item_id) for r in queries.QUERIES["op4_template_decontamination"](spark, sf).collect()} == want


def plain_template(words):
    """Plain and template words, and which are slots, word by word."""
    plain, out, slots, before = [], [], [], None
    for word in words:
        bare = word.strip(".,;:!?\"'()[]{}…“”„«»¿¡")
        low = bare.lower()
        kind = "num" if regex.fullmatch(r"[-+$€£]?\p{N}[\p{N}.,/:]*%?", bare) else "unit" if low in templates.UNITS else "cap" if bare[:1].isupper() and bare[1:] == low[1:] else None
        slot = kind == "num" or kind == "unit" and before is not None and before[0] == "num" or kind == "cap" and before is not None and not before[1]
        plain.append(low)
        out.append((kind,) if slot else low)
        slots.append(slot)
        before = kind, word.rstrip("\"')]}”»")[-1:] in (".", "!", "?", ":")
    return plain, out, slots


def plain_leaks(docs, items, width=8):
    """By class of items that differ in their slots' values only: (doc, item, windows, matched, copied, reparameterised, items)."""
    classes = collections.defaultdict(list)
    for item, text in dict.fromkeys(items):
        words = (text or "").split()
        if not words:
            continue
        k = min(width, len(words))
        plain, out, slots = plain_template(words)
        kind = plain_template(["x", words[0]])[1][1] if plain_template(["1", words[0]])[1][1] != ("unit",) else ("unit",)
        windows = [(i, out[i : i + k], slots[i : i + k]) for i in range(len(words) - k + 1)]
        if isinstance(kind, tuple) and kind != ("num",) and not slots[0]:
            windows.append((0, [kind, *out[1:k]], [True, *slots[1:k]]))
        windows = [(i, plain[i : i + k] if all(s) else o, [plain_value(w) for w, x in zip(words[i : i + k], s) if x]) for i, o, s in windows]
        values = [plain_value(w) for w, x in zip(words, slots) if x]
        pattern = [[v.index(x) for x in v] for v in (values, [plain_value(words[0]), *values] if len(windows) > len(words) - k + 1 else [])]
        classes[repr((k, [w[:2] for w in windows], pattern))].append((item, windows))
    found = {}
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    for members in classes.values():
        total = len({i for i, *_ in members[0][1]})
        for doc, body in docs:
            own = (body or "").split()
            dplain, dout, dslots = plain_template(own)
            k = len(members[0][1][0][1])
            lined = collections.defaultdict(list)
            for j in range(len(own) - k + 1):
                s = dslots[j : j + k]
                key = dplain[j : j + k] if all(s) else dout[j : j + k]
                for w, (i, have, values) in enumerate(members[0][1]):
                    if have == key:
                        lined[j - i].append((i, w, values, [plain_value(x) for x, y in zip(own[j : j + k], s) if y]))
            fits = []
            for hits in lined.values():
                pairs, n = {p for _, _, v, d in hits for p in zip(v, d)}, len({h[0] for h in hits})
                if len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs) and (n >= total / 2 or n >= 20):
                    copied = all(any(m[1][w][2] == d for m in members) for _, w, _, d in hits)
                    exact = [m[0] for m in members if n == total and all(m[1][w][2] == d for _, w, _, d in hits)]
                    fits.append((n, copied, exact))
            if fits:
                ids = least([i for *_, e in fits for i in e])
                ids = least([m[0] for m in members]) if ids is None else ids
                row = [total, max(n for n, *_ in fits), any(c for _, c, _ in fits), not any(c for _, c, _ in fits), len(members)]
                have = found.setdefault((doc, ids), row)
                have[:] = [max(have[0], row[0]), max(have[1], row[1]), have[2] or row[2], have[3] and row[3], max(have[4], row[4])]
    return {(*k, *v) for k, v in found.items()}


def plain_value(word):
    return word.strip(".,;:!?\"'()[]{}").lower()


def test_templates_against_a_plain_version(spark):
    rng = random.Random(9)
    verbs, names = "takes gives sells buys counts finds".split(), "Anna Bob Carl Dora Emil".split()

    def question(n):
        out = []
        for _ in range(n):
            out += [rng.choice(names), rng.choice(verbs), str(rng.randint(1, 30)), rng.choice(["kg", "km", "apples", "pears of it."]), rng.choice(["and then", "in", "for the"])]
        return " ".join(out)

    items = [(i, question(rng.randint(1, 7))) for i in range(60)] + [(60, "Find the next: 2 4 8 16 32 64 128 256"), (61, "May I ask?"), (62, None), (62, "10 km"), (None, question(3))]
    items += [(70 + j, re.sub(r"\d+", lambda m: str(int(m[0]) + 40 * j), text)) for _, text in items[:4] for j in range(3)]  # some of one template
    docs = []
    for i, (_, text) in enumerate(items):
        if text:
            docs.append((len(docs), f"{rng.choice(['', 'Some words', '5', 'He said.'])} {text} {question(1)}"))
            other = re.sub(r"\d+", lambda m: str(int(m[0]) + 31), text) if i % 2 else text.replace("Anna", "Zoe").replace("Bob", "Yan")
            docs.append((len(docs), f"{question(1)} {other}"))
            docs.append((len(docs), re.sub(r"\d+", lambda m: str(rng.randint(1, 9)), text)))
            docs.append((len(docs), " ".join(text.split()[: rng.randint(1, 40)])))
    docs += [(None, docs[0][1]), (1, docs[5][1]), (900, " ".join(question(400) for _ in range(3)))]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in templates.report(df, bench).collect()}
    want = plain_leaks([d for d in docs if d[0] != 1], items) | plain_leaks([docs[1]], items) | plain_leaks([docs[-2]], items)
    assert got == want and sum(r[4] for r in want) > 50 and sum(r[5] for r in want) > 50 and max(r[6] for r in want) > 1


def test_items_of_one_template_are_one_class(spark):
    """No rows of every document with every item, and a document names the item whose values it has."""
    text = lambda k: f"A train leaves with {k} people at noon and after {k + 7} minutes there are {3 * k} of them left in it"
    bench = spark.range(600).select(F.col("id").alias("item_id"), F.expr("concat('A train leaves with ', id + 100, ' people at noon and after ', id + 107, ' minutes there are ', 3 * (id + 100), ' of them left in it')").alias("text"))
    docs = [(i, text(100 + i)) for i in range(300)] + [(i, text(2000 + i)) for i in range(300, 500)] + [(500, text(100).replace("107", "100")), (501, " ".join(text(150).split()[:14]))]
    got = {r.doc_id: r for r in templates.report(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert len(got) == 501 and {r.n_items for r in got.values()} == {600} and 500 not in got  # slots of two values can't both be 100
    assert all(got[i].item_id == i and got[i].copied for i in range(300))
    assert all(got[i].item_id == 0 and got[i].reparameterised for i in range(300, 500))
    assert got[501].copied and got[501].n_matched < got[501].n_windows
    assert {r["class"] for r in templates.item_classes(bench).collect()} == {0} and templates.item_classes(bench).count() == 600


def test_languages(spark):
    sf = f"{DATA}/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op10_language_id"](spark, sf).collect()
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert sum(held) >= 0.98 * len(held)
    odd = spark.createDataFrame([(1, None, "en"), (2, "12 !?", "en"), (3, "", None), (None, "only text here", None), (4, "words of english", "en"), (4, "words of english", "en")], "doc_id long, text string, lang string")
    got = sorted(((r.doc_id, r.lang_pred) for r in langid.identify(odd).collect()), key=repr)
    assert got == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "en")]
    assert {r.lang_pred for r in langid.identify(odd.withColumn("lang", odd["lang"].substr(9, 0)).filter("doc_id = 3")).collect()} == {"und"}
    assert langid.identify(odd.limit(0)).count() == 0


def plain_fit(rows, idf):
    """Languages, weights and temperature, number by number: FTRL with elastic net, then the temperature of least loss."""
    langs = sorted({lang for *_, lang in rows})
    data = []
    for at, n, lang in rows:
        x = {b: (1 + math.log(k)) * idf[b] for b, k in zip(at.tolist(), n.tolist())}
        norm = math.sqrt(sum(v * v for v in x.values())) or 1.0
        data.append(({b: v / norm for b, v in x.items()}, langs.index(lang)))
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(b, c):
        if abs(z[b, c]) <= langid.L1:
            return 0.0
        return -(z[b, c] - math.copysign(langid.L1, z[b, c])) / ((langid.BETA + math.sqrt(n[b, c])) / langid.ALPHA + langid.L2)

    def probabilities(logits, t=1.0):
        e = [math.exp((v - max(logits)) / t) for v in logits]
        return [v / sum(e) for v in e]

    own = [d for i, d in enumerate(data) if i % 5] if len(data) >= 50 else data
    aside = data[::5] if len(data) >= 50 else data
    order = np.random.default_rng(7)
    for _ in range(langid.EPOCHS):
        for i in order.permutation(len(own)).tolist():
            x, label = own[i]
            w = {(b, c): weight(b, c) for b in x for c in range(len(langs))}
            p = probabilities([sum(v * w[b, c] for b, v in x.items()) for c in range(len(langs))])
            for b, v in x.items():
                for c in range(len(langs)):
                    g = v * (p[c] - (c == label))
                    sigma = (math.sqrt(n[b, c] + g * g) - math.sqrt(n[b, c])) / langid.ALPHA
                    z[b, c] += g - sigma * w[b, c]
                    n[b, c] += g * g
    logits = [([sum(v * weight(b, c) for b, v in x.items()) for c in range(len(langs))], label) for x, label in aside]
    grid = [math.exp(math.log(0.02) + i * (math.log(20) - math.log(0.02)) / 299) for i in range(300)]
    return langs, weight, min(grid, key=lambda t: sum(-math.log(probabilities(v, t)[label] + 1e-300) for v, label in logits))


def test_sparse_weights():
    rng = random.Random(3)
    idf = np.random.default_rng(1).uniform(0.5, 5, langid.BUCKETS)
    words = {"en": "the cat and dog of a house".split(), "de": "der hund und die katze im haus".split(), "fr": "le chat et un chien dans la maison".split()}
    rows = [(*langid.features(" ".join(rng.choice(words[lang]) for _ in range(rng.randint(1, 8)))), lang) for lang in sorted(words) * 25]
    langs, w, t = langid.fit(rows, idf)
    plain_langs, weight, plain_t = plain_fit(rows, idf)
    assert langs == plain_langs == ["de", "en", "fr"] and 0 < (w != 0).mean() < 0.05 and abs(t - plain_t) < 1e-9
    assert all(abs(w[b, c] - weight(b, c)) < 1e-9 for b in {b for at, *_ in rows for b in at.tolist()} for c in range(3))


def test_document_frequencies(spark):
    texts = [("the cat", "en"), ("the dog", "en"), ("12", "en"), (None, "en"), ("unseen words", None)]
    _, idf, w, _ = langid.train(spark.createDataFrame(texts, "text string, lang string"))
    counts = collections.Counter(b for t, lang in texts if t and lang and langid.features(t) for b in langid.features(t)[0].tolist())
    assert np.allclose(idf, [math.log(3 / (1 + counts[b])) + 1 for b in range(langid.BUCKETS)]) and w.shape[1] == 1


def test_pages(spark):
    page = (
        "<html><head><title>T</title><script>if (a < b) {}</script></head><body><header>Site <a href=x>Home</a></header><div class='cookie-notice'>We use cookies</div>"
        "<div id=menu><a>One</a> <a>Two</a></div><div><h2>Head &amp; line</h2><p>First par<b>agraph</b> has quite a lot of text that goes on\nand on for a while.<p>Second<br>line.</div>"
        "<form>Mail <input></form><div class=comments><p>I like this a lot, a reader says at length, with many, many words.</p></div><p><a href=1>more</a> <a>links</a></p></body></html>"
    )
    text = "Head & line\n\nFirst paragraph has quite a lot of text that goes on and on for a while.\n\nSecond line."
    assert pages.main_text(page) == text and pages.main_text(None) == pages.main_text("") == pages.main_text("<p>") == ""
    assert pages.main_text("<article>a<!-- x --><aside>no</aside> b &lt;c&gt;</article>") == "a\n\nb <c>"
    assert len(pages.main_text("<article>" + "<p>word word</p>" * 5000 + "</article>")) == 5000 * 11 - 2
    assert pages.main_text("<article><p class=ad>buy<div>stay<p>too</div></article>") == "stay\n\ntoo"
    df = spark.createDataFrame([(1, "u", page, 1), (1, "u", page, 1), (None, None, None, 1)], "page_id long, url string, html string, text int")
    assert sorted(map(tuple, pages.extract(df).collect()), key=repr) == [(1, "u", text, len(text))] * 2 + [(None, None, "", 0)]
    assert pages.extract(df.limit(0)).count() == 0


def test_pages_without_marks():
    """What the windows of lines decide, where no element marks the main part."""
    story = "<h2>Head</h2><p>" + "first long text here. " * 20 + "</p>{}<p>" + "closing words " * 10 + "</p><p>So it is.</p>"
    advert = "<div class=ad><p>Buy</p><p>more</p></div>"
    comments = "<div class='comments-area'><p>" + "I think so too, a reader says. " * 20 + "</p></div>"
    for top in ("<div><a href=1>Site</a></div>", "<div class=masthead>Site</div>", "<p>Site</p><br><div></div><div></div><div></div><nav>a</nav>"):
        got = pages.main_text(f"<body>{top}<div class=x>{story.format(advert)}</div>{comments}</body>")
        assert got.startswith("Head\n\nfirst") and got.endswith("closing words\n\nSo it is.") and "Buy" not in got
    assert pages.main_text("<body><div><a href=1>Site</a></div><div>Tiny text.</div></body>") == "Tiny text."
    assert pages.main_text("<div class=notice>All there is.</div>") == "All there is."
    teaser = pages.main_text("<article class=card><p>Another story</p></article><div><p>" + "Body of it. " * 40 + "</p></div>")
    assert teaser.endswith("Body of it.") and len(teaser) > 400
    for name, stays in (("tags-explained", True), ("legal-analysis", True), ("post-content", True), ("user-opinions", False), ("cta-box", False), ("related-posts", False), ("newsletterSignup", False)):
        assert ("more words" in pages.main_text(f"<main><p>Text of it</p><div class='{name}'>{'more words ' * 20}</div></main>")) == stays, name


def test_broken_pages_take_linear_time():
    import time

    for piece in ('<a "', "<div>", '<a ">x', "<!", "<", "<p class='", "<!--", "<script>", "<li>x", "</b><b>", "<p \"a'>", "<![CDATA[", "</div>", "<p>x<div>", "&#38"):
        began = time.time()
        pages.main_text(piece * (1_000_000 // len(piece)))
        pages.main_text(piece * (1_000_000 // len(piece)) + ">")
        assert time.time() - began < 20, piece


def test_pages_without_their_marks_are_read_alike(spark):
    for r in spark.read.parquet(f"{DATA}/sf0.01/pages.parquet").collect():
        assert pages.main_text(r.html) == pages.main_text(re.sub("</?article>", "", r.html)) == pages.main_text(re.sub("article>", "div>", r.html))


def test_pages_of_the_table(spark):
    import html

    sf = f"{DATA}/sf0.01"
    source = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.QUERIES["op3_html_main_text"](spark, sf).collect():
        inner = re.search(r"<article>(.*)</article>", source[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?(b|i|em)>", "", re.sub("<br>", " ", x))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_preferences(spark, tmp_path):
    sf = f"{DATA}/sf0.001"
    got = queries.QUERIES["op5_preference_pairs"](spark, sf)
    same(got, connect(sf), preferences.ORACLE)
    assert got.filter("n_prompt_turns > 0 AND prompt <> '' AND chosen <> rejected").count() >= 0.7 * got.count()
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "yo"), (0, 2, "user", "bye"), (1, 0, "user", "hi"), (1, 1, "assistant", "no"), (1, 2, "user", "k"), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "assistant", None), (4, 0, "user", "x"), (4, 1, "assistant", "z"), (None, 0, "user", "z"), (-2, 0, "user", "m"), (-1, None, None, "m"), (-1, None, None, "m"), (-1, 7, "assistant", "é😀"), (-1, 8, "assistant", "last"), (9, 1, "assistant", "r"), (8, 1, "assistant", "r")]
    rows += [(20, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(3000)] + [(21, 0, "assistant", "long " * 30000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, n int")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    same(preferences.swapped_replies(df), con, preferences.ORACLE)
    got = {r.pair_id: r for r in preferences.swapped_replies(df).collect()}
    assert set(got) == {0, 1, 2, 3, 4, -1, -2, 8, 9, 20, 21} and got[0].prompt == "<|user|>\nhi<|end|>\n" and got[0].chosen == "<|assistant|>\nyo<|end|>\n<|user|>\nbye<|end|>\n" and got[0].chosen_spans == "14:24" and got[0].n_prompt_turns == 1
    assert got[0].rejected.startswith("<|assistant|>\nno<|end|>") and got[4].rejected_id is None and got[4].rejected == "<|assistant|>\n<|end|>\n" and got[2].chosen == "" and got[8].rejected == ""
    assert got[20].n_prompt_turns == 2999 and len(got[20].rejected) == 150022 and got[-1].n_prompt_turns == 3
    pairs = spark.createDataFrame([(7, 1, 0), (8, 1, 99), (9, None, 1), (10, 20, 20)], "pair_id long, chosen_id long, rejected_id long")
    assert sorted((r.pair_id, r.n_prompt_turns, r.chosen_spans, r.rejected) for r in preferences.paired(df, pairs).collect()) == [(7, 1, "14:24", "<|assistant|>\nyo<|end|>\n<|user|>\nbye<|end|>\n"), (10, 3000, "", "")]
    assert preferences.swapped_replies(df.limit(0)).count() == 0


def plain_licences(text):
    best = {}
    lines = text.split("\n")
    units = [(line, i, i) for i, line in enumerate(lines)]
    start = 0
    for i, line in enumerate([*lines, ""]):
        if not line.strip():
            if i - start > 1:
                units.append((" ".join(lines[start:i]), start, i - 1))
            start = i + 1
    filled = [i for i, x in enumerate(lines) if x.strip()]
    if any(b - a > 1 for a, b in zip(filled, filled[1:])):
        units.append((" ".join(lines), filled[0], filled[-1]))
    for unit, lo, hi in units:
        own, scores = licences.bigrams(unit), []
        for k, (name, template) in enumerate(licences.TEMPLATES):
            t = licences.bigrams(template)
            if own:
                scores.append((-2 * (own & t).total() / (own.total() + t.total()), k, name))
        if scores and -min(scores)[0] >= licences.THRESHOLD:
            d, _, name = min(scores)
            have = best.setdefault(name, [(d, lo, hi), 0])
            have[0] = min(have[0], (d, lo, hi))
            have[1] += 1
    return {(name, -d, n, lo, hi) for name, ((d, lo, hi), n) in best.items()}


def test_licences(spark):
    rng = random.Random(2)
    mit = next(t for n, t in licences.TEMPLATES if n == "MIT" and len(t) > 200)
    broken = "\n".join(mit[i : i + 80] for i in range(0, len(mit), 80))
    texts = [None, "", "All rights reserved.", "all RIGHTS   reserved!\n\nReleased under the MIT License.\nReleased under the MIT license", f"Title\n\n{broken}\n\nRest", mit[:600], " ".join(rng.choice(mit.split()) for _ in range(200))]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(None, texts[2], 0)], "doc_id long, text string, dice int")
    want = {(i, *x) for i, t in [*enumerate(texts), (None, texts[2])] for x in plain_licences(t or "")}
    assert set(map(tuple, licences.scan(df).collect())) == want and {x[1] for x in want} == {"MIT", "all-rights-reserved"}
    assert licences.scan(df.limit(0)).count() == 0
    rows = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").collect()
    assert set(map(tuple, queries.QUERIES["op8_license_scan"](spark, f"{DATA}/sf0.01").collect())) == {(r.doc_id, *x) for r in rows for x in plain_licences(r.text)}


def test_pipeline(spark):
    """run() against plain versions of the stages."""
    import corpus_pipeline
    from test_advice import plain_near

    sf = f"{DATA}/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1 AND toxic = 0").collect()}
    kept = {r[0] for r in plain_quality([tuple(r) for r in rows], good) if r[-1]}
    docs = [(r.doc_id, r.text) for r in rows if r.doc_id in kept]
    first = plain_near(docs)
    docs = [d for d in docs if d[0] in first]
    seen = collections.Counter(t[k : k + 200] for t in (x.encode() for _, x in docs) for k in range(len(t) - 199))
    cut = []
    for i, text in docs:
        raw = text.encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 199):
            if seen[raw[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        cut.append((i, bytes(c for c, g in zip(raw, gone) if not g).decode(errors="replace")))
    frame = spark.createDataFrame(cut, "doc_id long, text string")
    leaked = {r.doc_id for r in templates.leaks(frame, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    got = sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()))
    assert got == sorted(token_row(i, t) for i, t in cut if i not in leaked)


def test_stages_bear_odd_rows(spark):
    import corpus_pipeline

    sf = f"{DATA}/sf0.001"
    base = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "", None, None, 0), (1, None, "en", "s", None), (1, "x " * 500, "en", None, 5), (1, "x " * 500, "en", None, 5)], base.schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for df in (odd, base.limit(0), odd.selectExpr("*", "1 AS h", "2 AS kept", "3 AS n_words", "4 AS _d", "5 AS _h", "6 AS _text_hash", "7 AS row", "8 AS keep", "9 AS own_id", "'x' AS carry", "1.5 AS data", "7 AS `a.b`", "8 AS `c``d`", "9 AS `e f`", "10 AS start")):
            out = stage(spark, df, sf)
            assert out.columns == df.columns and out.count() <= df.count()
    assert corpus_pipeline.STAGES[-1][1](spark, odd, sf).count() == 5
