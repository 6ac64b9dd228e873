"""Periodic runs, byte-level BPE and the Merkle manifest against brute force, the library, and odd rows."""

import hashlib
import os
import random
import time
import zlib

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, runs string, ids string, leaf string"
ODD = [
    (1, None, None, None, None, "r", "i", "l"), (2, "", "en", "a", 0, "r", None, None), (3, "   \n\t\n ", "en", "a", 6, None, None, None), (4, "word", None, None, 4, None, None, None),
    (5, "a b c " * 40, "en", "b", 0, None, None, None), (6, "x y x y x y x y x y x z " * 3, "fr", "b", 0, None, None, None), (8, "word " * 30_000, "de", "c", 0, None, None, None),
    (9, "é😀中文 ﬁ\x00 <|endoftext|> it's  \r\n\xa0  x", "de", "c", 0, None, None, None), (10, "Same Text twice", "es", "c", 0, None, None, None), (10, "Same Text twice", "es", "c", 0, None, None, None),
    (None, "no id here", None, "c", 0, None, None, None), (None, "no id here", None, "c", 0, None, None, None), (11, "tie tie tie tie tie tie and so so so so so so", "es", "c", 0, None, None, None),
]
TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd_rows(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small_docs(spark):
    if not os.path.isdir(TESTDATA):
        pytest.skip("no test tables")
    return spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


# periodic runs


def naive_runs(words, least_words=6, least_exponent=4):
    """By every period and place; a run with a shorter period is left out."""
    n, found = len(words), []
    for q in range(1, n // least_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least_words, least_exponent * q):
                own = words[i : i + size]
                if not any(own[d:] == own[: size - d] for d in range(1, q)):
                    found.append((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def naive_words(text, doc_id):
    words = [w.decode() for w in (text or "").encode().split()]
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def naive_run_row(doc_id, text):
    words = naive_words(text, doc_id)
    runs = naive_runs(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (
        doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def word_list(rnd, n):
    """Words with a periodic end, and sometimes a break in it."""
    words = [rnd.choice("abcdefgh"[: rnd.choice([1, 2, 3, 8])]) for _ in range(n)]
    if n > 3 and rnd.random() < 0.7:
        a = rnd.randrange(n)
        p = 1 + rnd.randrange(max(1, (n - a) // 3))
        words[a:] = [words[a + (i - a) % p] for i in range(a, n)]
        if rnd.random() < 0.4:
            words[rnd.randrange(n)] = "z"
    return words


@pytest.mark.parametrize("exponent", [2, 3, 4])
def test_runs_by_brute_force(exponent):
    from quarrylight.llm.periodic_runs import runs_of_texts

    rnd = random.Random(exponent)
    for _ in range(60):
        texts = [" ".join(word_list(rnd, rnd.randint(0, rnd.choice([10, 60, 200])))) for _ in range(rnd.randint(1, 6))]
        for text, (_, _, start, length, period) in zip(texts, runs_of_texts(texts, None, 6, exponent), strict=True):
            assert list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True)) == naive_runs(text.split(), 6, exponent)


def test_runs_of_long_texts_are_found_in_time():
    from quarrylight.llm.periodic_runs import runs_of_texts

    began = time.time()
    a, b = "a", "b"
    while len(b) < 100_000:
        a, b = b, b + a
    texts = ["the " * 300_000, " ".join(str(i % 20_011) for i in range(200_000)), " ".join(b), " ".join(str(random.Random(1).randrange(9)) for _ in range(1000)) + " x" * 100_000]
    found = [list(zip(s.tolist(), n.tolist(), p.tolist(), strict=True)) for _, _, s, n, p in runs_of_texts(texts)]
    assert found[0] == [(0, 300_000, 1)] and found[1] == [(0, 200_000, 20_011)] and found[2] == [] and (1000, 100_000, 1) in found[3]
    assert time.time() - began < 60  # a quadratic search takes hours


def test_op11_by_brute_force(spark, small_docs):
    from quarrylight.llm.periodic_runs import op11_periodic_runs

    want = [naive_run_row(r.doc_id, r.text) for r in small_docs]
    assert any(w[1] for w in want)
    assert sorted(map(tuple, op11_periodic_runs(spark, TESTDATA).collect())) == sorted(want)


def test_periodic_runs_on_odd_rows(odd_rows, no_rows):
    from quarrylight.llm.periodic_runs import periodic_runs

    found = periodic_runs(odd_rows, plant_col="doc_id")
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "leaf", "n_words", "runs", "collapsed_text"]
    rows = found.collect()
    assert len(rows) == len(ODD) and sorted(str((r.doc_id, r.text)) for r in rows) == sorted(str(x[:2]) for x in ODD)
    for r in rows:
        words = naive_words(r.text, r.doc_id)
        runs = naive_runs(words) if len(words) < 1000 else [tuple(x) for x in r.runs]
        assert r.n_words == len(words) and [tuple(x) for x in r.runs] == runs and r.collapsed_text is not None
    assert next(r for r in rows if r.doc_id == 8).runs == [(0, 30_000, 1)] and next(r for r in rows if r.doc_id == 8).collapsed_text == "word"
    assert periodic_runs(no_rows).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(odd_rows, least_exponent=1)


# byte-level BPE


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers as P
    import tiktoken

    from quarrylight.llm.byte_bpe import ByteCodec, plain_pattern
    from quarrylight.llm.token_counts import read_ranks

    ranks = read_ranks(P.path("byte_bpe_50k.tiktoken"))
    return ranks, ByteCodec(ranks, P.PATTERN, plain_pattern(P.PATTERN)), ByteCodec(ranks, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bytes_equal_the_library(vocabulary):
    _, fast, plain, library = vocabulary
    rnd = random.Random(5)
    kinds = ["a", "ab", "abc", " ", "  \n", "é", "中文😀", "abcdefghijklmnopqrstuvwxyz", "-=_.'", "0123456789", " \t\r\n\x0b\x0c\x1c\x85\xa0 　", "'s'll"]
    for _ in range(3000):
        text = "".join(rnd.choice(rnd.choice(kinds)) for _ in range(rnd.randint(0, rnd.choice([5, 40, 200])))) if rnd.random() < 0.6 else rnd.choice("a=-_ .*0e\n中") * rnd.randint(1, 300)
        want = library.encode_ordinary(text)
        assert fast.encode(text).tolist() == want and plain.encode(text).tolist() == want
        assert fast.decode(fast.encode(text)) == text.encode()


def test_any_white_space_cuts_as_the_library_does(vocabulary):
    _, fast, _, library = vocabulary
    for c in [*map(chr, range(0x3100)), "﻿", "￿", "\U0001f600"]:
        text = f"x{c}{c}y 1{c} {c}z"
        assert fast.encode(text).tolist() == library.encode_ordinary(text), hex(ord(c))


def test_backtracking_equals_merging(vocabulary):
    ranks, fast, _, _ = vocabulary
    rnd = random.Random(6)
    for _ in range(2000):
        match = "".join(rnd.choice("etaoin shrdlu.-=é"[: rnd.choice([2, 6, 17])]) for _ in range(rnd.randint(1, 120))).encode().decode("latin-1")
        assert fast.divided(match) == fast.merged(match)
    assert all(fast.stands[i] for i in rnd.sample(sorted(ranks.values()), 500))


def test_long_matches_take_linear_time(vocabulary):
    _, fast, _, _ = vocabulary
    began = time.time()
    rnd = random.Random(7)
    text = "".join(rnd.choice("abcdefghij") for _ in range(300_000)) + "ab" * 100_000
    assert fast.decode(fast.encode(text)) == text.encode() and time.time() - began < 60


def test_a_vocabulary_without_a_byte_is_an_error():
    from quarrylight.llm.byte_bpe import ByteCodec

    with pytest.raises(ValueError):
        ByteCodec({bytes([b]): b for b in range(255)}, r"\S+|\s+")


def test_op12_equals_the_library(spark, small_docs, vocabulary):
    from quarrylight.llm.byte_bpe import op12_byte_bpe

    def row(r):
        ids = vocabulary[3].encode_ordinary(r.text or "")
        return r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha((r.text or "").encode())

    assert sorted(map(tuple, op12_byte_bpe(spark, TESTDATA).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == sorted(map(row, small_docs))


def test_byte_columns(odd_rows, no_rows, vocabulary):
    import public_tokenizers as P

    from quarrylight.llm.byte_bpe import decode_bytes, encode_bytes

    file = P.path("byte_bpe_50k.tiktoken")
    coded = encode_bytes(odd_rows, file, P.PATTERN)
    assert coded.columns == ["doc_id", "text", "lang", "source", "n_chars", "runs", "leaf", "ids"]
    rows = decode_bytes(coded, file, P.PATTERN, text_col="back").collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert list(r.ids) == vocabulary[3].encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode() and r.back == (r.text or "")
    assert encode_bytes(no_rows, file, P.PATTERN).count() == 0
    ids = odd_rows.sparkSession.createDataFrame([(1, None), (2, []), (3, [220, 447])], "k int, ids array<int>")
    assert {r.k: (bytes(r.decoded), r.t) for r in decode_bytes(ids, file, P.PATTERN, text_col="t").collect()} == {1: (b"", ""), 2: (b"", ""), 3: (vocabulary[1].decode(__import__("numpy").array([220, 447])), " �")}


# Merkle manifest


def framed(values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def naive_tree(leaves):
    """(root, siblings of each leaf level by level as (before, after) pairs)."""
    level, at, paths = leaves, list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for k, i in enumerate(at):
            first = i // 8 * 8
            paths[k].append(("".join(level[first:i]), "".join(level[i + 1 : first + 8])))
        level, at = [sha("".join(level[i : i + 8])) for i in range(0, len(level), 8)], [i // 8 for i in at]
    return level[0], paths


def naive_manifest(rows):
    """Rows of doc_id, source, lang, n_chars, text."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0], sha(framed(r)), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = naive_tree([x[1] for x in groups[g]])
    root, upper = naive_tree([trees[g][0] for g in names])
    out = []
    for g, above in zip(names, upper, strict=True):
        for (doc_id, leaf, r), path in zip(groups[g], trees[g][1], strict=True):
            steps, h = [*path, *above], leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                lowered = None if r[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
                h = sha(framed([*r[:4], lowered]))
            for before, after in steps:
                h = sha(before + h + after)
            out.append((doc_id, leaf, trees[g][0], root, sha("".join(b + a for b, a in steps)), h, h == root))
    return out


def as_rows(found):
    return sorted(repr(tuple(r)) for r in found.collect())


@pytest.fixture(scope="module")
def manifest_of(spark, tmp_path_factory):
    from quarrylight.llm.manifest import op13_merkle_manifest

    def run(rows, parts=3):
        path = str(tmp_path_factory.mktemp("docs"))
        spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(parts).write.mode("overwrite").parquet(f"{path}/documents.parquet")
        return as_rows(op13_merkle_manifest(spark, path))

    return run


def test_op13_by_brute_force(spark, small_docs):
    from quarrylight.llm.manifest import op13_merkle_manifest

    want = naive_manifest([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in small_docs])
    assert {w[-1] for w in want} == {True, False}
    assert as_rows(op13_merkle_manifest(spark, TESTDATA)) == sorted(map(repr, want))


def test_manifest_on_odd_rows(manifest_of):
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in ODD]
    assert manifest_of(rows) == sorted(map(repr, naive_manifest(rows)))
    assert manifest_of([]) == []
    assert manifest_of(rows[:1]) == sorted(map(repr, naive_manifest(rows[:1])))


def test_manifest_of_groups_at_the_edges_of_runs(manifest_of):
    rows = [(100 * k + i, "s", g, i, f"Text {i} of {g}") for k, (g, n) in enumerate({"a": 1, "b": 8, "c": 9, "é": 65, None: 2, "": 3, "z": 73, "B": 7, "q": 64}.items()) for i in range(n)]
    random.Random(1).shuffle(rows)
    want = sorted(map(repr, naive_manifest(rows)))
    assert manifest_of(rows, 1) == want and manifest_of(rows, 7) == want


def test_equal_rows_are_leaves_of_their_own(manifest_of):
    rows = [(7, "s", "en", 1, "Copy")] * 100 + [(i, "s", "en", 1, "Other") for i in range(20)]
    assert manifest_of(rows) == sorted(map(repr, naive_manifest(rows)))


def test_many_groups(manifest_of):
    rows = [(i, "s", f"g{i % 77}", 1, "T") for i in range(150)]
    assert manifest_of(rows) == sorted(map(repr, naive_manifest(rows)))
