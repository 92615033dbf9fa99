"""Merkle manifest, fill-in-middle and repeated substrings against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from commitfold.llm import fim, merkle, queries, repeats

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# --- fill-in-middle ----------------------------------------------------------------


def expected_fim(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    units = [int(sha(f"42:{'' if doc_id is None else doc_id}")[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(units[i] % (len(tokens) + 1) for i in range(2))
    p, m, s = ("".join(tokens[x:y]) for x, y in ((0, a), (a, b), (b, None)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or units[2] % 100 >= 50:
        return doc_id, len(tokens), "plain", None, None, text, text
    if units[3] % 100 < 80:
        return doc_id, len(tokens), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, len(tokens), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def test_fill_in_middle(spark):
    rng = random.Random(1)
    parts = ["a", "bc", "é", "日本", " ", "  ", "\n", "<", "<P", "x" * 40]
    made = ["".join(rng.choice(parts) for _ in range(rng.randrange(3000))) for _ in range(120)]
    texts = [None, "", " \n", "word", "<P> x", "a <M>", " lead and trail ", *made, made[3] * 40, "y" * 20_000, "z z " * 9000, "\n" * 9000]
    rows = [(None if i == 3 else i, t, "own", "mine") for i, t in enumerate(texts)] + [(20, texts[20], "own", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, output string, restored string").repartition(3)
    got = fim.restored(fim.transform(df)).collect()
    assert Counter(tuple(r) for r in got) == Counter(expected_fim(r[0], r[1]) for r in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fim.restored(fim.transform(df.where("false"))).count() == 0


def test_chunks_do_not_depend_on_where_they_stand(monkeypatch):
    rng = random.Random(2)
    raw = bytes(rng.choice(b"abcdefgh \n") for _ in range(50_000))
    ends = fim.chunk_ends(raw)
    assert ends[-1] == len(raw) and ends == sorted(set(ends))
    moved = [e - 777 for e in fim.chunk_ends(bytes(777) + raw)]
    assert len(set(ends) & set(moved)) > 0.9 * len(ends)
    monkeypatch.setattr(fim, "SEGMENT", 1000)
    assert fim.chunk_ends(raw) == ends
    chunks = fim.Chunks()
    assert fim.Cuts(raw * 3, chunks).n == len(TOKEN.findall((raw * 3).decode()))
    assert len(chunks.kept) < 1.5 * len(ends)


def test_cuts_at_every_token():
    text = "  one two\n\nthree  é日 four " * 40
    tokens, cuts = TOKEN.findall(text), fim.Cuts(text.encode(), fim.Chunks())
    assert [cuts.after(i) for i in range(cuts.n + 1)] == [len("".join(tokens[:i]).encode()) for i in range(len(tokens) + 1)]


# --- Merkle manifest -----------------------------------------------------------------


def brute_tree(nodes, fanout):
    paths, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        new, below = [], []
        for i in range(0, len(nodes), fanout):
            run = nodes[i : i + fanout]
            for j in range(len(run)):
                for x in groups[i + j]:
                    paths[x] += run[:j] + run[j + 1 :]
            new.append(sha("".join(run)))
            below.append(sum(groups[i : i + fanout], []))
        nodes, groups = new, below
    return nodes[0], paths


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_manifest(rows, fanout):
    """(doc_id, lang, leaf, subroot, root, siblings) of rows (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0], sha("".join(map(field, r)))))
    for leaves in trees.values():
        leaves.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    langs = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    subs = [brute_tree([x[1] for x in trees[v]], fanout) for v in langs]
    root, above = brute_tree([s[0] for s in subs], fanout)
    for lang, (subroot, paths), top in zip(langs, subs, above, strict=True):
        for (doc_id, leaf), path in zip(trees[lang], paths, strict=True):
            yield doc_id, lang, leaf, subroot, root, tuple(path + top)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


@pytest.mark.parametrize("fanout, height", [(2, 1), (2, 3), (3, 1), (2, 10)])
def test_merkle(spark, fanout, height):
    rng = random.Random(height)
    rows = [(rng.choice([None, *range(100)]), f"s{i % 3}", rng.choice([None, "a", "é", "b", "b", "b"]), rng.choice([None, 5]), rng.choice([None, "", "日"])) for i in range(137)]
    rows += [rows[0]] * 3 + [(7, "s", "alone", 1, "x" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars int, text string").repartition(3)
    df = df.withColumn("root", F.lit("own")).withColumn("tree", F.lit("mine"))
    made = merkle.manifest(df, merkle.leaf(COLUMNS), "lang", "doc_id", fanout, height)
    assert {"tree", "text", "source", "leaf", "path"} <= set(made.columns)
    siblings, fold = merkle.siblings(F.col("path")), merkle.folded(F.col("leaf"), F.col("path"))
    got = made.select("doc_id", "lang", "leaf", "subroot", "root", siblings.alias("s"), fold.alias("fold"), "tree").collect()
    assert Counter((*r[:5], tuple(r["s"])) for r in got) == Counter(brute_manifest(rows, fanout))
    assert all(r["fold"] == r["root"] and r["tree"] == "mine" for r in got)


def test_merkle_of_nothing_and_of_one(spark):
    df = spark.createDataFrame([(1, None, None, None, None)], "doc_id bigint, source string, lang string, n_chars int, text string")
    assert merkle.manifest(df.where("false"), merkle.leaf(COLUMNS), "lang", "doc_id").count() == 0
    one = merkle.manifest(df, merkle.leaf(COLUMNS), "lang", "doc_id").first()
    assert one["leaf"] == one["subroot"] == one["root"] == sha("1:1----") and one["path"] == []


def test_tampering_is_found(spark, folder):
    got = queries.op11_merkle_butterfly(spark, folder).collect()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count() and len({r["root"] for r in got}) == 1
    assert all(r["verified"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 != 0) for r in got)


# --- repeated substrings -----------------------------------------------------------------


def removed(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, sha of what is left, what is left) per row."""
    raws, seen = [(r[1] or "").encode() for r in rows], Counter()
    for raw in raws:
        seen.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    for r, raw in zip(rows, raws, strict=True):
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, y in zip(raw, gone, strict=True) if not y)
        yield r[0], len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept), kept


def documents(rng, length):
    base = ["".join(rng.choice("abcdefgh é日") for _ in range(rng.randrange(length // 2, length * 6))) for _ in range(8)]
    texts = [None, "", "x" * (5 * length), "ab" * (3 * length), base[0], base[0], base[1][: length - 1], base[1][: length - 1]]
    for _ in range(40):
        text = ""
        for _ in range(rng.randrange(1, 4)):
            b = rng.choice(base)
            at = rng.randrange(len(b))
            text += b[at : at + rng.randrange(len(b))] + "".join(rng.choice("pqrs") for _ in range(rng.randrange(length)))
        texts.append(text)
    rows = [(i if i != 9 else None, t, "own") for i, t in enumerate(texts)]
    return [*rows, rows[4], rows[15]]


@pytest.mark.parametrize("length, most", [(400, 64), (20, 64), (20, 3), (8, 1)])
def test_repeats(spark, monkeypatch, length, most):
    rows = documents(random.Random(length + most), length)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, hi string").repartition(3)
    got = Counter((*r[:5], bytes(r["kept"])) for r in repeats.cut(df, length, most).collect())
    assert got == Counter(removed(rows, length))
    narrow = repeats.cut(df, length, most, with_kept=False)
    assert Counter(tuple(r) for r in narrow.collect()) == Counter(k[:5] for k in got.elements())
    assert repeats.cut(df.where("false"), length, most).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("repeats")]


@pytest.mark.parametrize("many", [4096, 2])
def test_strings_around_a_core_are_not_all_moved(spark, monkeypatch, many):
    """Parts around a core are compared by the bytes beside it; strings go by digest only
    where too many parts share one, with the same result."""
    length, made = 40, []
    monkeypatch.setattr(repeats, "MANY", many)
    monkeypatch.setattr(repeats, "_strings", lambda *a, whole=repeats._strings: made.append(1) or whole(*a))
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("ab") for _ in range(n))
    shared = "".join(rng.choice("cdefgh") for _ in range(length - 3))
    rows = [(i, word(30) + shared + word(30)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = Counter((*r[:5], bytes(r["kept"])) for r in repeats.cut(df, length, 3).collect())
    want = Counter(removed(rows, length))
    assert got == want and any(r[2] for r in want) and bool(made) == (many == 2)


def shared_words(rows, words):
    """(doc_id, words in runs of `words` words that another row has, too) per row."""
    texts = [(r[1] or "").encode().split() for r in rows]
    own = [[tuple(t[i : i + words]) for i in range(len(t) - words + 1)] for t in texts]
    seen = Counter(w for windows in own for w in set(windows))
    for r, windows in zip(rows, own, strict=True):
        yield r[0], len({j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + words)})


@pytest.mark.parametrize("words, piece", [(51, 1 << 17), (20, 10), (6, 1 << 17), (6, 10), (1, 10)])
def test_passages_by_words(spark, monkeypatch, words, piece):
    monkeypatch.setattr(repeats, "PIECE", piece)
    rng = random.Random(words + piece)
    word = lambda n: [rng.choice(["a", "é", "cat", "日"]) + str(rng.randrange(900)) for _ in range(n)]
    line, base = word(words), [word(rng.randrange(words, 4 * words)) for _ in range(5)]
    texts = [None, "", " \t\n", "one", " ".join(word(words) * 3), " ".join(base[0]), " ".join(base[0]), " ".join(line[:-1]), " ".join(line[:-1])]
    for _ in range(60):
        own = []
        for _ in range(rng.randrange(1, 4)):
            b = rng.choice([*base, line])
            at = rng.randrange(len(b))
            own += b[at : at + rng.randrange(2 * words)] + word(rng.randrange(words)) + (line if rng.random() < 0.3 else [])
        texts.append("".join(w + rng.choice([" ", "  ", "\n", "\t\x0b"]) for w in own))
    rows = [(i if i != 9 else None, t) for i, t in enumerate(texts)]
    rows += [rows[20], rows[21]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = repeats.cut(df, with_kept=False, words=words)
    assert Counter((r["doc_id"], r["n_shared_words"]) for r in got.collect()) == Counter(shared_words(rows, words))
    bare = repeats.cut(df, with_kept=False)
    assert Counter(map(tuple, bare.collect())) == Counter(map(tuple, got.drop("n_shared_words").collect()))
    assert repeats.cut(df.where("false"), words=words).count() == 0


def test_short_passage_of_two_documents_is_seen(spark, tmp_path):
    """A passage of over 50 words is under 400 bytes: nothing is removed, but it is counted."""
    rng = random.Random(12)
    word = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    passage = word(55)
    rows = [(i, f"{word(80)} {passage} {word(80)}" if i < 2 else word(200)) for i in range(6)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_removed"], r["n_shared_words"]) for r in queries.op13_prefix_intervals(spark, str(tmp_path)).collect()}
    assert got == {i: (0, 55 if i < 2 else 0) for i in range(6)}


def test_strings_shared_around_a_core():
    rng = random.Random(6)
    for step in (1, 2, 5):
        word = lambda: bytes(rng.choice(b"ab") for _ in range(rng.randrange(step)))
        sides = sorted({(rng.randrange(2), word(), word()) for _ in range(12)})
        strings = [
            {d: (core, left[len(left) - d :], right[: step - 1 - d]) for d in range(step) if d <= len(left) and step - 1 - d <= len(right)}
            for core, left, right in sides
        ]
        seen = Counter((d, s) for own in strings for d, s in own.items())
        want = [[d for d, s in own.items() if seen[d, s] > 1] for own in strings]
        assert repeats.shared_strings(sides, step) == want


def test_repeat_groups_have_all_occurrences(spark):
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    shared, tail = word(60), word(40)
    texts = [word(30) + shared + tail + word(10), "p" + shared + tail + "q", "r" + shared + "s" * 3, word(50)]
    df = spark.createDataFrame(enumerate(texts), "doc_id bigint, text string")
    found = repeats.groups(df, 50)
    digests = df.select("doc_id", "text", *repeats._digest())
    got = found.join(digests, ["hi", "lo"]).collect()
    members = {}
    for r in got:
        assert r["repeat"] == hashlib.sha256(texts[r["doc_id"]].encode()[r["start"] : r["start"] + r["size"]]).digest()[:16]
        members.setdefault(r["repeat"], set()).add(r["doc_id"])
    assert {0, 1, 2} in members.values() and {0, 1} in members.values()
    cover = {d: set() for d in range(4)}
    for r in got:
        cover[r["doc_id"]] |= set(range(r["start"], r["start"] + r["size"]))
    assert cover == {0: set(range(30, 130)), 1: set(range(1, 101)), 2: set(range(1, 61)), 3: set()}


def test_intervals_of_a_suffix_array():
    rng = random.Random(4)
    for _ in range(50):
        shared = [rng.randrange(6) for _ in range(rng.randrange(12))]
        expected = set()
        for i in range(len(shared)):
            for j in range(i, len(shared)):
                low = min(shared[i : j + 1])
                edge = (i == 0 or shared[i - 1] < low) and (j + 1 == len(shared) or shared[j + 1] < low)
                if low >= 2 and edge:
                    expected.add((low, i, j + 1))
        assert set(repeats.intervals(shared, 2)) == expected


def test_long_texts_by_segments(monkeypatch):
    rng = random.Random(6)
    raw = bytes(rng.choice(b"abcd") for _ in range(5000))
    whole = repeats._by_text([raw, b"", raw[:50], raw[:900]], 60, repeats.Hashes())
    monkeypatch.setattr(repeats, "SEGMENT", 500)
    parts = repeats._by_text([raw, b"", raw[:50], raw[:900]], 60, repeats.Hashes())
    assert [a.tolist() for a, _ in whole] == [a.tolist() for a, _ in parts]
    assert [k.tolist() for _, k in whole] == [k.tolist() for _, k in parts]


@pytest.mark.parametrize("some", [[1, 2, 3, 8, 9, 1, 40, 500], [1, 2, 3], [40], [1]])
def test_gradient_sums_of_short_and_long_runs(some):
    import numpy as np

    from commitfold.llm import maxent

    n = np.array(some)
    made = np.random.default_rng(3)
    order, begin = made.permutation(n.sum()), np.cumsum(n) - n
    gradient = made.normal(size=(len(order), 33)).astype(np.float32)
    want = [gradient[order[b : b + k]].astype(np.float64).sum(0) for b, k in zip(begin, n)]
    assert np.allclose(maxent._sums(gradient, order, begin, n), want, atol=1e-4)
