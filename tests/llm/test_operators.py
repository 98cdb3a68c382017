"""The training-data operators against plain versions, on the smallest tables and on awkward rows."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import bpe, chat, fingerprints, html, langid, lines, minhash, mixing, suffixes, vptree
from tallyframe.llm.components import components
from tests.llm import brute

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
KIND = "doc_id long, text string, lang string, source string, n_chars long, size long, rank int, kept string"
LONG = "the quick brown fox jumps over the lazy dog and runs away " * 400
AWKWARD = [
    (1, None, "en", "a", 0, 1, 1, "x"), (2, "", None, "a", 0, 1, 1, "x"), (3, "   \n\t", "en", None, 0, 1, 1, "x"),
    (4, "one", "en", "a", 0, None, None, None), (5, "one two", "en", "b", 0, 1, 1, "x"),
    (6, "one two", "en", "b", 0, 1, 1, "x"), (7, LONG, "en", "b", 0, 1, 1, "x"), (8, LONG + "x", "de", "c", 0, 1, 1, "x"),
    (9, LONG.upper(), "de", "c", 0, 1, 1, "x"), (10, "éà 日本語 ünï\nthe same line that is repeated here", "fr", "a", 0, 1, 1, "x"),
    (11, "the same line that is repeated here\nthe same line that is repeated hers\nshort", "fr", "a", 0, 1, 1, "x"),
    (12, "a" * 300, "es", "b", 0, 1, 1, "x"), (13, "b" + "a" * 200, "es", "b", 0, 1, 1, "x"),
    (14, "12 34 !?", "es", None, 0, 1, 1, "x"), (15, "the same line that is repeated here", "fr", "d", 0, 1, 1, "x"),
]
NULL_ID = (None, "the same line that is repeated here and more of it to fill fifty bytes", "en", "a", 0, 1, 1, "x")


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([*AWKWARD, NULL_ID], KIND)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KIND)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


ALL = [lambda d: mixing.in_training_order(mixing.mix(d)), mixing.mixed_documents, fingerprints.edited_fingerprints,
       lambda d: minhash.near_duplicates(d, 2), minhash.keep_one, langid.predict_languages, langid.keep_identified,
       lines.line_report, lines.without_repeated_lines, suffixes.without_repeats,
       lambda d: bpe.encoded(d, VOCABULARY)]
VOCABULARY = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@pytest.mark.parametrize("i", range(len(ALL)))
def test_empty_and_repeated(empty, awkward, i):
    assert ALL[i](empty).count() == 0
    twice = awkward.unionByName(awkward)
    found = ALL[i](twice).collect()
    assert found
    if i not in (1, 4, 6, 8):
        assert len(found) == 2 * (len(AWKWARD) + 1)


@pytest.mark.parametrize("stage", (mixing.mixed_documents, minhash.keep_one, langid.keep_identified,
                                   lines.without_repeated_lines))
def test_stages_keep_columns(awkward, stage):
    assert stage(awkward).columns == awkward.columns


@pytest.mark.parametrize("which", ("awkward", "documents"))
def test_mix(request, which):
    docs = request.getfixturevalue(which)
    found = mixing.mix(docs).collect()
    sizes = {}
    for d, text, source in rows_of(docs, "doc_id", "text", "source"):
        sizes[source] = sizes.get(source, 0) + len(brute.words(text))
    want = brute.targets(sizes)
    for source, target in want.items():
        mine = [r for r in found if r["source"] == source]
        assert all(abs(r["target"] - target) < 1e-6 and r["source_size"] == sizes[source] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target) <= 0.51
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    assert all((r["position"] is None) == (r["taken"] == 0) for r in found)
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix(docs).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in found}


def test_mixed_documents(documents):
    plan = {r["doc_id"]: -(-r["taken"] // r["size"]) if r["size"] else 0 for r in mixing.mix(documents).collect()}
    copies = {r["doc_id"]: r["count"] for r in mixing.mixed_documents(documents).groupBy("doc_id").count().collect()}
    assert copies == {d: n for d, n in plan.items() if n}


@pytest.mark.parametrize("which", ("awkward", "documents"))
def test_fingerprints(request, which):
    docs = request.getfixturevalue(which)
    rows = rows_of(docs, "doc_id", "text")
    want = brute.edited(rows)
    found = by_id(fingerprints.edited_fingerprints(docs))
    prints = {}
    for i, (d, text) in enumerate(rows):
        n, edited, j = want[i]
        assert (found[d]["n_chars"], found[d]["edited_sha256"]) == (n, brute.sha(edited))
        assert prints.setdefault(text or "", found[d]["fingerprint"]) == found[d]["fingerprint"]
        own, new, following = (fingerprints.fingerprint_vectors([x]) for x in (text or "", edited, rows[j][1] or ""))
        assert found[d]["edited_fingerprint"] == fingerprints.as_text(*new)[0]
        assert abs(found[d]["near_edited"] - fingerprints.likeness(*own, *new)[0]) < 1e-9
        assert abs(found[d]["near_next"] - fingerprints.likeness(*own, *following)[0]) < 1e-9


def test_fingerprint_algebra():
    vectors = fingerprints.fingerprint_vectors(["a b c d\nsecond one here", "second one here\n\na b c d", "a b c d",
                                                "second one here"])
    for part in vectors:
        assert (part[0] == part[1]).all() and (part[0] - part[3] == part[2]).all()


@pytest.mark.parametrize("which,size", (("awkward", 2), ("documents", 2), ("documents", 5)))
def test_near_duplicates(request, which, size):
    docs = request.getfixturevalue(which).where("doc_id is not null")
    want = brute.near_components(rows_of(docs, "doc_id", "text"), size)
    found = by_id(minhash.near_duplicates(docs, size))
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in found.items()} == want
    assert all(r["kept"] == (d == r["component_id"]) for d, r in found.items())


def test_near_duplicates_of_a_crowd(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(150):  # many variants of one text: some links, many near misses
        text = list(base)
        for p in rng.choice(120, rng.integers(1, 12), replace=False):
            text[p] = f"x{rng.integers(10 ** 6)}"
        rows.append((d, " ".join(text)))
    found = by_id(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2))
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in found.items()} == brute.near_components(rows, 2)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 50), (50, 70), (7, 7)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 50: 50, 70: 50, 100: 50}


def test_language(documents, awkward):
    found = by_id(langid.predict_languages(documents))
    lang = dict(rows_of(documents, "doc_id", "lang"))
    held = [d for d in found if brute.held_out(d)]
    assert all(found[d]["held_out"] == brute.held_out(d) for d in found)
    assert np.mean([found[d]["lang_pred"] == lang[d] for d in held if found[d]["lang_pred"] != "und"]) > 0.95
    odd = by_id(langid.predict_languages(awkward))
    assert [odd[d]["lang_pred"] for d in (1, 2, 3, 14)] == ["und"] * 4 and odd[14]["score"] == 0
    assert {r["lang_pred"] for r in langid.predict_languages(awkward.withColumn("lang", F.lit(None).cast("string"))
                                                             ).collect()} == {"und"}
    assert langid.keep_identified(documents).count() == sum(r["lang_pred"] != "und" and r["score"] >= .5
                                                            for r in found.values())


def test_every_label_is_learned(spark, monkeypatch):
    rows = [(i, chr(0x4e00 + i) * 5, f"l{i}") for i in range(1700)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(4))
    learned = [r for r in rows if not brute.held_out(r[0])]
    assert len(learned) > 1000 and model.languages == sorted(r[2] for r in learned)
    some = [r[1] for r in learned[:20]]
    told, score = model.score(some)
    assert sum(x == r[2] for x, r in zip(told, learned)) >= 15
    monkeypatch.setattr(langid, "SCORES", 3 * len(learned))
    again, same = model.score(some)
    assert again == told and (same == score).all()


def _vectors(spark, n=700, dim=12, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(n, dim)))]
    for i in range(100, 180):
        rows[i] = (i, rows[50][1])  # many equal vectors
    rows += [(n, None), (n + 50, [0.0] * dim), (n + 100, [float("nan")] * dim), (n + 150, [None] + [1.0] * (dim - 1)),
             (n + 200, []), (n + 250, [float("inf")] + [1.0] * (dim - 1))]
    return rows


@pytest.mark.parametrize("factor", (1.0, vptree.FACTOR))
def test_neighbours(spark, factor):
    rows = _vectors(spark)
    df = spark.createDataFrame([(*r, 0, 0.0) for r in rows], "vec_id long, embedding array<double>, rank int, score double")
    found = vptree.nearest(df, factor=factor).collect()
    want = brute.nearest([r[0] for r in rows], [r[1] for r in rows])
    hit = total = 0
    for q, near in want.items():
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [r[0] for r in mine] == [1, 2, 3, 4, 5]
        hit += len({r[1] for r in mine} & {v for v, _ in near})
        total += 5
        if factor == 1.0:
            assert [r[1] for r in mine] == [v for v, _ in near]
            assert np.allclose([r[2] for r in mine], [s for _, s in near], atol=1e-12)
    assert hit / total >= (1.0 if factor == 1.0 else 0.9)
    assert {r["query_id"] for r in found} == set(want)
    assert vptree.nearest(df.limit(0)).count() == 0


@pytest.mark.parametrize("which,chars", (("awkward", 20), ("documents", 20)))
def test_lines(request, which, chars):
    docs = request.getfixturevalue(which).where("doc_id is not null")
    rows = [(d, t) for d, t in rows_of(docs, "doc_id", "text")]
    if which == "documents":
        rows = [(d, "\n".join(x[:30 + len(x) % 60] for x in t.split("\n"))) for d, t in rows if d % 5 == 0]
        docs = docs.sparkSession.createDataFrame(rows, "doc_id long, text string")
    want = brute.repeated_lines(rows, chars, 2)
    found = by_id(lines.line_report(docs, chars))
    assert {d: list(r["dropped"]) for d, r in found.items() if r["dropped"]} == want
    kept = {r["doc_id"]: r["text"] for r in lines.without_repeated_lines(docs, chars).collect()}
    for d, text in rows:
        if not want.get(d) and text is not None and len(set(text.split("\n"))) == len(text.split("\n")):
            assert kept[d] == text


def test_line_edits(spark):
    rng = np.random.default_rng(1)
    base = "".join(rng.choice(list("abcdef gh"), 40))
    rows = []
    for d in range(120):
        line = list(base)
        for _ in range(rng.integers(0, 4)):
            p = rng.integers(len(line))
            line[p:p + 1] = rng.choice(["", "x", "xy"], 1)[0]
        rows.append((d, "".join(line)))
    found = by_id(lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")))
    want = brute.repeated_lines(rows, 20, 2)
    assert {d: list(r["dropped"]) for d, r in found.items() if r["dropped"]} == want


def test_short_lines(spark):
    """Exact repeats of short lines are reported; a text loses those of two words or more that are no sentence."""
    rows = []
    for d in range(60):
        text = [f"Own line {d} " + "xyzw"[d % 4] * (d + 9)]
        text += ["Read more"] * (d % 3 == 0) + ["\u8fd9\u662f\u4e00\u53e5\u8bdd\u3002"] * (d < 8) + ["Yes."] * (d % 6 == 0)
        text += ["", "All rights reserved."[1:]] + ["Rare words"] * (d in (3, 4)) + ["Read more"] * (d == 9)
        rows.append((d, "\n".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    report, kept = by_id(lines.line_report(docs)), by_id(lines.without_repeated_lines(docs))
    seen = set()
    for d, text in rows:
        distinct = list(dict.fromkeys(text.split("\n")))
        short = [x for x in distinct if 0 < len(x) < 20]
        assert [distinct[i] for i in report[d]["repeated_short"]] == [x for x in short if x in seen]
        gone = {"Read more", "Rare words"} & seen
        own = distinct[0] not in kept[d]["text"]
        assert [x for x in kept[d]["text"].split("\n")] == [x for x in text.split("\n") if x not in gone][own:]
        seen |= set(short)


def test_main_text(spark):
    texts = ["A first line of prose, long enough to be read.\nAnother one, with & and more.\nShort.\nThe last of them is here."] * 5
    model = html.fit(texts)
    body = "<p>A paragraph of some length, with words in it.</p><p>Short one.</p><p><b>Open bold.<br><p>x &lt; y &amp z &#233;</p>"
    page = ('<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><ul><li>'
            '<a href="/">Home</a></li><li><a href="/b">About</a></li></ul></nav><div class="ad">Buy this now, it is cheap.</div>'
            f'<article><h1>A   title\n here</h1>{body}</article><div class="comments"><div class="comment"><p>I do not agree '
            'with this at all.</p></div></div><form><label>Your mail</label><input></form><aside class="sidebar"><p>Most read '
            'stories of the week.</p></aside><div class="cookie-notice"><p>We use cookies on this site.</p></div>'
            '<footer>&copy; site.example</footer>')
    want = ("A title here\n\nA paragraph of some length, with words in it.\n\nShort one.\n\nOpen bold.\n\nx < y & z é")
    deep = "<div>" * 3000 + "<p>Deep but plain prose, long enough to be read.</p>"
    df = spark.createDataFrame([(1, "u", page, "x"), (2, None, None, "x"), (3, "u", "", "x"), (4, "u", deep, "x"),
                                (5, "u", "<p>cut <b", "x"), (1, "u", page, "x")],
                               "page_id long, url string, html string, text string")
    found = html.extracted(df, model).collect()
    assert len(found) == 6
    assert [r["text"] for r in found if r["page_id"] == 1] == [want, want]
    assert [(r["text"], r["n_chars"]) for r in found if r["page_id"] in (2, 3)] == [("", 0)] * 2
    assert html.extracted(df.limit(0), model).count() == 0


@pytest.mark.parametrize("page,want", (
    ("<html><head><title>T</title><body><p>Some prose.</p>", ["Some prose."]),
    ("<head><meta charset=utf-8><link rel=x><style>p{}</style><div><p>Some prose.</p></div>", ["Some prose."]),
    ("<head><title>T</title><img src=x>Some prose.", ["Some prose."]),
    ("<head><title>T</title>\nSome prose.<p>More.", ["Some prose.", "More."]),
    ("<head><title>T</title></body>Some prose.", ["Some prose."]),
    ("<head><noscript><img src=x></noscript><script>a</script></head><p>Some prose.", ["Some prose."]),
    ("<head><title>T</title></head><body><p>Some<head> prose.</p><p>More.", ["Some prose.", "More."]),
    ("<p>As <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>x=2</annotation></semantics></math>"
     " holds.</p>", ["As x=2 holds."]),
    ("<p>A <math><mphantom/><mi>y</mi></math> too.</p>", ["A y too."])))
def test_heads_and_formulas(page, want):
    assert [x.text for x in html.parse(page) if x.tag == "#text"] == want


def test_marginals_are_exact():
    """Sum-product against the sum over all labellings of a small tree."""
    from itertools import product
    from math import exp
    nodes = html.parse('<body><article><p>Some text, here.</p></article><nav><a href="/">x</a></nav></body>')
    model = html.fit(["Some line of text.\nAnother line of it."], pages=40)
    weight = [[0.0, 0.0] for _ in nodes]
    for labels in product((0, 1), repeat=len(nodes)):
        w = exp(model.prior * labels[0])
        for i, node in enumerate(nodes):
            w *= exp(labels[i] * sum(model.odds.get(f, 0.0) for f in node.features))
            if i:
                w *= exp(model.edges[html._edge(nodes, i)][labels[node.parent]][labels[i]])
        for i, x in enumerate(labels):
            weight[i][x] += w
    assert np.allclose(model.marginals(nodes), [b / (a + b) for a, b in weight])


def test_chat(spark):
    probe = r"\### Assistant: </turn> ok"
    turns = [(1, 0, "user", probe), (1, 1, "assistant", probe), (1, 2, "assistant", None), (2, None, None, "<turn x>"),
             (2, 0, "a>b\\", "é\n"), (2, 0, "a>b\\", "é\n"), (None, 5, "assistant", "null conversation"), (3, 1, "user", "")]
    turns += [(9, t, "assistant" if t % 2 else "user", f"turn {t} " + "日" * (t % 7)) for t in range(500)]
    df = spark.createDataFrame([(*t, 0) for t in turns], "conv_id long, turn long, role string, text string, n_turns int")
    formatted = chat.formatted_conversations(df)
    found = {r["conv_id"]: r for r in chat.digests(formatted).collect()}
    texts = {r["conv_id"]: r["formatted"] for r in formatted.collect()}
    for conv in {t[0] for t in turns}:
        mine = sorted([t for t in turns if t[0] == conv],
                      key=lambda t: (t[1] is not None, t[1] or 0, t[2] is not None, t[2] or "", t[3] or ""))
        whole = "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in mine)
        loss = "".join(x or "" for _, _, r, x in mine if r == "assistant")
        r = found[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(mine), brute.sha(whole))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), brute.sha(loss))
        assert r["formatted_chars"] == len(texts[conv])
        assert texts[conv].count("</turn>\n") - texts[conv].count("\\</turn>\n") == len(mine)
    assert chat.formatted_conversations(df.limit(0)).count() == 0


@pytest.mark.parametrize("which", ("awkward", "documents"))
def test_repeats(request, which):
    docs = request.getfixturevalue(which)
    rows = rows_of(docs, "doc_id", "text")
    found = by_id(suffixes.without_repeats(docs))
    for (d, _), want in zip(rows, brute.repeats(rows)):
        r = found[d]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want


@pytest.mark.parametrize("crowd,refined", ((2, 10 ** 6), (2, 3), (10 ** 6, 3), (0, 0)))
def test_repeats_of_crowded_grams(spark, crowd, refined):
    """Buckets dealt out by cover, refined as strings, and both, against the plain version."""
    rng = np.random.default_rng(8)
    passage, rows = "a passage that every other document has, " * 2, []
    for d in range(60):
        noise = ["".join(rng.choice(list("abc "), int(n))) for n in rng.integers(0, 60, 3)]
        rows.append((d // 2 if d < 8 else d, noise[0] + passage[:60 + d % 9] + noise[1] + "-" * int(rng.integers(40, 90)) + noise[2]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    gone = {}
    for r in suffixes.duplicate_strings(docs, 500, crowd, refined).collect():
        gone.setdefault((r["doc_id"], r["tag"]), []).append((r["start"], r["n"]))
    for (d, t), want in zip(rows, brute.repeats(rows)):
        starts, ns = np.array(gone.get((d, suffixes._tag(t.encode())), np.zeros((0, 2), np.int64))).T
        removed, spans, kept = suffixes._cut(t.encode(), starts, ns)
        assert (len(t.encode()), removed, spans, kept) == want
    assert suffixes._partitions(docs, 500) == -(-sum(len(t) for _, t in rows) // 500)


def test_common_passage_does_not_meet_in_one_partition(spark):
    """Of a passage in every document, the block sends one document's entries to be judged."""
    rng = np.random.default_rng(9)
    passage = "".join(rng.choice(list("abcdefgh "), 300))
    docs = spark.createDataFrame([(d, passage) for d in range(500)], "doc_id long, text string")
    [out] = suffixes._anchors(4)(iter(docs.toArrow().combine_chunks().to_batches()))
    sent = [np.frombuffer(b, "<i8", 3) for b in out.column("block").to_pylist()]
    assert sum(n for n, _, kind in sent if kind != suffixes.SETTLED) * 500 == sum(n for n, _, _ in sent)


def test_repeats_across_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 100)
    rng = np.random.default_rng(2)
    passage = "".join(rng.choice(list("abc "), 400))
    texts = ["".join(rng.choice(list("abc "), int(n))) for n in rng.integers(0, 300, 20)]
    rows = [(i, t[:i * 3] + passage[i * 5:i * 5 + 40 + 4 * i] + t[i * 3:]) for i, t in enumerate(texts)]
    held = [p for p in suffixes._pieces(iter(spark.createDataFrame(rows, "doc_id long, text string").toArrow().to_batches()))]
    assert max(len(x[3]) for h in held for x in h) <= 149
    found = by_id(suffixes.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")))
    for (d, _), want in zip(rows, brute.repeats(rows)):
        assert (found[d]["n_bytes"], found[d]["n_removed"], found[d]["n_spans"], bytes(found[d]["kept"])) == want


def test_bpe(documents, awkward):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(VOCABULARY)
    strange = ["a'll <|endoftext|>don't <|startoftext|>x 12½ ΣΑΣ Éa\x1cb \u3000 aaaaaaaaa", "e\u0301 İ ² Ⅷ 🙂 \u00ad x"]
    docs = documents.select("doc_id", "text").unionByName(awkward.select("doc_id", "text")).unionByName(
        awkward.sparkSession.createDataFrame([(-1, strange[0]), (-2, strange[1])], "doc_id long, text string"))
    texts = sorted((t or "") for _, t in rows_of(docs, "doc_id", "text"))
    want = sorted((x.ids, library.decode(x.ids, skip_special_tokens=False))
                  for x in library.encode_batch(texts, add_special_tokens=False))
    found = bpe.encoded(docs, VOCABULARY).collect()
    assert sorted((np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in found) == want
    vocabulary = bpe.Vocabulary(open(VOCABULARY, encoding="utf-8").read())
    assert all(bpe.decode(vocabulary, bytes(r["ids"])) == r["decoded"] and r["n_tokens"] * 4 == len(r["ids"]) for r in found)
