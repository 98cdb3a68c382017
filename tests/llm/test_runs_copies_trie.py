"""Periodic runs, exact copies and the prefix trie against plain versions."""

import hashlib
import os
import random
import re
import zlib

import pytest

from tallyframe.llm import cuckoo, periodic, prefix_trie
from tools.compare import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- periodic runs

def plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def plain_report(doc_id, text, edited=True):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if edited and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for s, length, q in runs:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def random_words(rng):
    kind = rng.randrange(5)
    if kind == 0:
        return [str(rng.randrange(rng.choice((1, 2, 3, 60)))) for _ in range(rng.randrange(300))]
    if kind == 1:  # a string full of repetitions
        a, b = ["x"], ["x", "y"]
        for _ in range(rng.randrange(11)):
            a, b = b, b + a
        return b[:400] * rng.randrange(1, 4)
    out = [str(rng.randrange(30)) for _ in range(rng.randrange(20))]
    for _ in range(rng.randrange(1, 4)):
        unit = ([str(rng.randrange(3)) for _ in range(rng.randrange(1, 5))] * rng.randrange(1, 20)
                + [str(rng.randrange(40)) for _ in range(rng.randrange(30))])
        length = rng.choice((3 * len(unit), 3 * len(unit) + rng.randrange(len(unit)), rng.randrange(6 * len(unit))))
        start = rng.randrange(len(unit))
        out += [unit[(start + i) % len(unit)] for i in range(length)]
        out += [str(rng.randrange(30)) for _ in range(rng.randrange(10))]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    texts = [random_words(rng) for _ in range(60)]
    found = periodic.runs_of_texts([[w.encode() for w in t] for t in texts])
    for text, runs in zip(texts, found):
        assert [tuple(map(int, r)) for r in runs] == plain_runs(text)


def test_runs_edges():
    cycle = [str(i) for i in range(50)]
    cases = [[], ["a"], ["a"] * 23, ["a"] * 24, ["a", "b"] * 12, cycle * 3, (cycle * 3)[:-1], ["x"] + cycle * 3 + ["y"],
             ["a"] * 40 + ["b"] + ["a"] * 40 + ["b"] + ["a"] * 40 + ["b"]]
    for words, runs in zip(cases, periodic.runs_of_texts([[w.encode() for w in c] for c in cases])):
        assert [tuple(map(int, r)) for r in runs] == plain_runs(words)


def test_run_over_a_long_text():
    unit = [b"%d" % i for i in range(70_000)]
    runs = periodic.runs_of_texts([[b"z"], unit * 3 + [b"end"], [b"k", b"l"] * 200_000])
    assert [r.tolist() for r in runs] == [[], [[0, 210_000, 70_000]], [[0, 400_000, 2]]]


KIND = "doc_id long, text string, runs string, collapsed string, best int, row long, lead string"
ROWS = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "la " * 30), (6, "la " * 30), (7, "a b c d \x1f e\x0bf\x0cg " * 9),
        (8, "éà 日本 " * 40 + "end"), (None, "na " * 25), (None, "na " * 25), (20, "w1 w2 w3 w4 " * 30 + "tail of it"),
        (14, " ".join(str(i) for i in range(200)))]
ROWS += [(i, " ".join(str((i * k * k) % 97) for k in range(i % 83))) for i in range(100, 160)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(d, t, "x", "y", 1, 2, "z") for d, t in ROWS + ROWS[3:8]], KIND)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KIND)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("which", ("awkward", "documents"))
def test_runs_report(request, which):
    docs = request.getfixturevalue(which)
    found = periodic.digests(periodic.periodic_runs(docs, periodic.repeated_tail))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                             "collapsed_sha256"]
    want = [plain_report(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want))
    assert any(w[1] for w in want)


def test_runs_without_edit(awkward):
    found = {r["doc_id"]: r for r in periodic.periodic_runs(awkward).collect()}
    assert [tuple(x) for x in found[5]["runs"]] == [(0, 30, 1)] and found[5]["collapsed"] == "la"


def test_empty_tables(empty, spark):
    assert periodic.digests(periodic.periodic_runs(empty)).count() == 0
    assert cuckoo.exact_duplicates(empty).count() == 0
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.rebuilt_trie(none).count() == 0
    assert prefix_trie.conversation_trie(none).count() == 0


# ---- exact copies

def plain_copies(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault("".join(WORD.findall(t or "")), []).append((-len(t or ""), d is None, d or 0, d))
    out = []
    for text, members in groups.items():
        members.sort(key=lambda m: m[:3])
        out += [(m[3], members[0][3], len(members), i == 0, sha(text)) for i, m in enumerate(members)]
    return out


@pytest.mark.parametrize("which", ("awkward", "documents"))
def test_exact_copies(request, which):
    docs = request.getfixturevalue(which)
    found = cuckoo.exact_duplicates(docs)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    want = plain_copies([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want))


def test_hot_group_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(cuckoo, "CHUNK_ROWS", 16)
    rows = [(i, "the same" + " " * (i % 7) if i % 3 else f"own {i // 9}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted(map(tuple, cuckoo.exact_duplicates(docs).collect()))
    assert found == sorted(plain_copies(rows))


def digest(i):
    return hashlib.sha256(str(i).encode()).digest()


def test_cuckoo_index_grows_and_forgets():
    index = cuckoo.CuckooIndex(buckets=1)
    for i in range(3000):
        index.insert(digest(i), cuckoo.best_of(5, i, i))
    assert index.resizes > 3 and len(index) == 3000
    assert all(digest(i) in index for i in range(3000))
    for i in range(0, 3000, 2):
        assert index.delete(digest(i))
    assert not index.delete(digest(0)) and len(index) == 1500
    assert [digest(i) in index for i in range(3000)] == [i % 2 == 1 for i in range(3000)]
    assert sum(1 for s in index.slots if s) == 1500
    for i in range(0, 3000, 2):  # places of deleted digests are used again
        index.insert(digest(i), cuckoo.best_of(5, i, i))
    assert len(index.digests) == 3000 and all(digest(i) in index for i in range(3000))
    again = cuckoo.CuckooIndex.restored(index.slots.tobytes(), list(index.live()))
    assert len(again) == 3000 and all(digest(i) in again for i in range(3000)) and digest(-1) not in again


def test_cuckoo_false_hits_are_verified():
    index = cuckoo.CuckooIndex()
    one = digest(1)
    other = one[:8] + digest(2)[8:]  # the same fingerprint and buckets
    index.insert(one, cuckoo.best_of(1, 1, 1))
    assert other not in index and index.false_hits == 1
    index.insert(other, cuckoo.best_of(1, 2, 2))
    assert index.delete(one) and other in index and one not in index
    for k in range(7):  # as many equal fingerprints as two buckets hold
        index.insert(one[:8] + digest(100 + k)[8:], cuckoo.best_of(1, k, k))
    assert len(index) == 8


def test_index_between_runs(spark):
    def docs(*rows):
        return spark.createDataFrame(list(rows), "doc_id long, text string")

    index = cuckoo.stored(cuckoo.updated_index(None, docs((1, "a b"), (2, "ab "), (3, "c"), (4, None))))
    assert index.where("slots is not null").count() <= cuckoo.SHARDS_AT_LEAST

    def live(of, *rows):
        return {r["doc_id"]: (r["live"], r["keep_id"]) for r in cuckoo.live_in(of, docs(*rows)).collect()}

    asked = ((10, "a  b"), (11, "c"), (12, "d"), (13, " "))
    assert live(index, *asked) == {10: (True, 1), 11: (True, 3), 12: (False, None), 13: (True, 4)}
    index = cuckoo.stored(cuckoo.updated_index(index, inserted=docs((12, "d")), deleted=docs((3, "c"), (1, "ab"))))
    assert live(index, *asked) == {10: (True, 1), 11: (False, None), 12: (True, 12), 13: (True, 4)}
    index = cuckoo.stored(cuckoo.updated_index(index, deleted=docs((2, "ab"))))
    assert live(index, *asked)[10] == (False, None)


# ---- prefix trie

def plain_trie(rows, rebuilt=True):
    told = {}
    for c, turn, role, text in rows:
        if c is not None:
            told.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    told = {c: [t[2:] for t in sorted(turns)] for c, turns in told.items()}
    if rebuilt:
        h = {c: zlib.crc32(str(c).encode()) % 6 for c in told}
        told = {c: told.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h[c]] + turns[h[c]:] for c, turns in told.items()}
    members = {}
    for c, turns in told.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] = leaves.get(node[:d], 0) + (node not in children)
            saved[node[:d]] = saved.get(node[:d], 0) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(children.get(n, ())), leaves[n], saved[n],
                   sha(",".join(map(str, sorted(c for c in m if len(told[c]) == len(n)))))) for n, m in members.items())


def found_trie(frame):
    assert frame.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                             "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in frame.collect())


TURNS = "conv_id long, turn long, role string, text string, key string, depth int, above int, own string, chars int"


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, "o", 3) for r in rows], TURNS)


def awkward_turns():
    rng = random.Random(4)
    rows = [(7, None, None, None), (7, None, "user", "x"), (7, 3, "user", None), (8, 1, "user", "same"), (8, 1, "user", "same"),
            (None, 1, "user", "nobody's"), (-7, 0, "user", "a"), (-107, 0, "user", "b"), (-100, 0, "user", "c")]
    for c in range(90, 340):
        if c == 200:
            continue  # no head for its hundred
        rows += [(c, t, "user" if t % 2 else "assistant", f"{rng.randrange(2)} ü" if t < 4 else f"{c} {t}")
                 for t in range(rng.randrange(1, 9))]
    return rows


@pytest.mark.parametrize("height", (None, 1, 2, 3))
def test_trie_of_awkward_turns(spark, height):
    rows = awkward_turns()
    assert found_trie(prefix_trie.rebuilt_trie(turns_of(spark, rows), height)) == plain_trie(rows)


def test_trie_of_deep_and_hot_conversations(spark):
    rows = [(c, t, "user", "hello" if t < 60 else f"{c % 3}-{t}") for c in range(1, 5) for t in range(150)]
    rows += [(c, 0, "user", "hello") for c in range(1000, 1400)]  # one text for most conversations
    assert found_trie(prefix_trie.conversation_trie(turns_of(spark, rows))) == plain_trie(rows, rebuilt=False)


def test_ends_over_several_pieces(spark, monkeypatch):
    rows = [(c, 0, "user", "hello") for c in range(1, 700)]
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    assert found_trie(prefix_trie.conversation_trie(turns_of(spark, rows))) == plain_trie(rows, rebuilt=False)


def test_trie_of_the_table(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert found_trie(prefix_trie.rebuilt_trie(turns)) == plain_trie(rows)


@pytest.mark.parametrize("name", ("op12_exact", "op13_trie"))
def test_query_against_sql(spark, name):
    from __spark_entry__ import oracle_sql, queries
    problem, rows, _ = compare(spark, connect(SF), queries()[name], oracle_sql()[name], SF)
    assert not problem and rows > 0


def test_runs_query(spark, documents):
    from __spark_entry__ import queries
    want = [plain_report(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert sorted(map(repr, map(tuple, queries()["op11_runs"](spark, SF).collect()))) == sorted(map(repr, want))
