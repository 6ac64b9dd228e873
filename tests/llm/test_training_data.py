"""Each operator against a brute-force version, and on null, empty, tied, repeated and clashing rows."""

import collections
import hashlib
import math
import os
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, score double"
ODD = [
    (1, None, None, None, None, "k", 0.5), (2, "", "en", "a", 0, "k", None), (3, "   \n\t\n ", "en", "a", 6, None, None), (4, "word", None, None, 4, None, None),
    (5, "one two three four five six seven eight nine ten\nshared line of the text number one\n" * 3, "en", "b", 0, None, None),
    (6, "One two, three four five six seven eight nine ten!\nShared line of the text number one  ", "en", "b", 0, None, None),
    (7, "  shared LINE of the text number one\nsomething else here entirely, about nothing", "fr", "b", 0, None, None),
    (8, "word " * 30_000, "de", "c", 0, None, None), (9, "é😀中文 ﬁ\x00 <s> ▁x\r\n", "de", "c", 0, None, None),
    (10, "same text twice", "es", "c", 0, None, None), (10, "same text twice", "es", "c", 0, None, None), (None, "no id here but the same words as any", None, "c", 0, None, None),
]
TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    if not os.path.isdir(TESTDATA):
        pytest.skip("no test tables")
    return spark.read.parquet(f"{TESTDATA}/documents.parquet").cache()


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{TESTDATA}/labels.parquet")


def same_ids(found, docs):
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(map(str, (r.doc_id for r in docs.select("doc_id").collect())))


# quality rules


def naive_measures(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit)


def test_measures_by_brute_force(docs):
    from quarrylight.llm.quality_rules import measure

    rng = random.Random(1)
    texts = [r.text for r in docs.collect()] + [None, "", " a\x1cb c", *("".join(rng.choice(["a", "b", " ", "\n", "#", "é", "\x0b", " "]) for _ in range(60)) for _ in range(300))]
    for t in texts:
        assert measure(t)[:5] == naive_measures(t), repr(t)


def test_weak_quality_on_odd_rows(odd, empty):
    from quarrylight.llm.quality_rules import weak_quality

    rows = weak_quality(odd.select("doc_id", "text", "lang", "n_chars")).collect()
    same_ids(rows, odd)
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
    assert weak_quality(empty.select("doc_id", "text")).count() == 0


def test_em_finds_planted_accuracies():
    from quarrylight.llm.quality_rules import fit_em

    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.7
    accuracy = [0.9, 0.8, 0.7, 0.85]
    votes = np.stack([np.where(rng.random(len(good)) < 0.2, 0, np.where((rng.random(len(good)) < a) == good, 1, -1)) for a in accuracy], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, log = fit_em(patterns, counts.astype(float))
    assert abs(share - 0.7) < 0.05
    for r, a in enumerate(accuracy):
        assert abs(np.exp(log[1, r, 2]) - 0.8 * a) < 0.05


def test_posterior_by_brute_force(docs):
    from quarrylight.llm.quality_rules import fit_em, measured, rules, weak_quality

    named = rules()
    votes = {r.doc_id: [r[k] for k in named] for r in measured(docs.select("doc_id", "text")).select("doc_id", *[v.alias(k) for k, v in named.items()]).collect()}
    rows = weak_quality(docs.select("doc_id", "text")).collect()
    seen = collections.Counter(tuple(votes[r.doc_id]) for r in rows if not r.base_failed)
    patterns = sorted(seen)
    share, log = fit_em(np.array(patterns), np.array([float(seen[p]) for p in patterns]))
    for r in rows:
        good, bad = share, 1 - share
        for k, v in enumerate(votes[r.doc_id]):
            good, bad = good * np.exp(log[1, k, v + 1]), bad * np.exp(log[0, k, v + 1])
        assert abs(r.p_quality - good / (good + bad)) < 1e-9
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and good / (good + bad) >= 0.5)


def test_weak_quality_keeps_clean_documents(docs, labels):
    from quarrylight.llm.quality_rules import weak_quality

    rows = weak_quality(docs.select("doc_id", "text")).join(labels, "doc_id").filter("quality = 1 and not base_failed").collect()
    assert rows and sum(r.kept for r in rows) >= 0.97 * len(rows)


# pieces


def test_pieces_equal_the_library(docs):
    import sentencepiece

    from quarrylight.llm.pieces import Codec, model_path, read_vocabulary

    lib, own = sentencepiece.SentencePieceProcessor(model_file=model_path()), Codec(read_vocabulary(model_path()))
    rng = random.Random(2)
    parts = ["a", "the", " ", "  ", "\n", "é", "中", "▁", "\t", "12", "😀", "ing", "##", "́", "ﬁ", "　", "<s>", "\x00", "x" * 40, " " * 17, " " * 40, "http://"]
    texts = [r.text for r in docs.collect()] + [x[1] or "" for x in ODD] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    for t in texts:
        ids = lib.encode(t)
        assert own.encode(t).tolist() == ids, repr(t[:80])
        assert own.decode(np.array(ids, np.int32)) == lib.decode(ids)
    for _ in range(3000):
        ids = [rng.choice([rng.randint(0, 300), rng.randint(0, 31999)]) for _ in range(rng.randint(0, 12))]
        assert own.decode(np.array(ids, np.int32)) == lib.decode(ids), ids


def test_piece_columns(odd, empty):
    import sentencepiece

    from quarrylight.llm.pieces import decode_pieces, encode_pieces, model_path, piece_digests

    lib = sentencepiece.SentencePieceProcessor(model_file=model_path())
    both = decode_pieces(encode_pieces(odd, model_path()), model_path())
    assert set(both.columns) == {*odd.columns, "ids", "decoded"}
    for r in both.collect():
        assert list(r.ids) == lib.encode(r.text or "") and r.decoded == lib.decode(list(r.ids))
    rows = piece_digests(odd.select("doc_id", "text"), model_path()).collect()
    want = sorted(hashlib.sha256(",".join(map(str, lib.encode(x[1] or ""))).encode()).hexdigest() for x in ODD)
    assert sorted(r.ids_sha256 for r in rows) == want
    assert piece_digests(empty.select("doc_id", "text"), model_path()).count() == 0


# token counts


def test_token_spans_by_brute_force():
    import public_tokenizers as P

    from quarrylight.llm.token_counts import RULES, Counter, read_ranks

    counter, rng = Counter(read_ranks(P.path("byte_bpe_50k.tiktoken")), P.PATTERN), random.Random(0)
    for _ in range(150):
        t = "".join(rng.choice(["a", " the", "\n", "\n\n", "é", "😀", "中", " foo", "\t"]) for _ in range(30))
        cuts = sorted(rng.sample(range(len(t) + 1), 4))
        starts, stops = np.array(cuts[::2]), np.array(cuts[1::2])
        a, b = counter.spans(t)
        for rule in RULES:
            counts, total, crossing, outside = counter.count(t, starts, stops, rule)
            want, none, cross = [0, 0], 0, 0
            for s, e in zip(a, b, strict=True):
                over = [max(0, min(e, q) - max(s, p)) for p, q in zip(starts, stops, strict=True)]
                touched = [k for k in (0, 1) if over[k]]
                none += not touched
                cross += bool(touched) and not any(p <= s and e <= q for p, q in zip(starts, stops, strict=True))
                if touched:
                    want[{"majority": int(np.argmax(over)), "first": touched[0], "last": touched[-1]}[rule]] += 1
            assert counts.tolist() == want and (total, crossing, outside) == (len(a), cross, none)


def test_empty_sections_count_nothing():
    import public_tokenizers as P

    from quarrylight.llm.token_counts import RULES, Counter, read_ranks

    counter, text = Counter(read_ranks(P.path("byte_bpe_50k.tiktoken")), P.PATTERN), "the whole text here"
    for rule in RULES:
        for spans in ([(0, 2), (4, 4), (5, 30)], [(2, 2)], [(0, 0), (0, 30)], [(0, 4), (4, 4), (4, 30), (30, 30)]):
            starts, stops = (np.array(x) for x in zip(*spans, strict=True))
            counts, total, _, outside = counter.count(text, starts, stops, rule)
            assert all(c == 0 for c, (a, b) in zip(counts, spans, strict=True) if a == b)
            assert counts.sum() + outside == total


def test_token_counts_on_odd_rows(odd, empty):
    import public_tokenizers as P
    import tiktoken

    from quarrylight.llm.token_counts import count_field_tokens, count_tokens, read_ranks

    path = P.path("byte_bpe_50k.tiktoken")
    plain = tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    rows = count_tokens(odd, path, P.PATTERN).collect()
    same_ids(rows, odd)
    for r in rows:
        assert r.n_tokens == len(plain.encode_ordinary(r.text or "")) == sum(r.section_tokens)
    fields = count_field_tokens(odd.select("doc_id", "lang", "text"), path, P.PATTERN, ["lang", "text"]).collect()
    assert all(sum(r.section_tokens) + r.n_unassigned == r.n_tokens for r in fields)
    assert count_tokens(empty, path, P.PATTERN).count() == 0
    with pytest.raises(ValueError):
        count_tokens(odd, path, P.PATTERN, rule="none")


# classifiers


def crc(i):
    return zlib.crc32(str(i).encode())


def test_quality_classifier_held_out(spark, labels):
    from quarrylight.llm.quality_classifier import op4_quality_classifier

    d = "/root/testdata/sf0.01"
    rows = op4_quality_classifier(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    pos, neg = [r.score for r in held if r.quality], [r.score for r in held if not r.quality]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.95 and np.mean([p >= 0.3 for p in pos]) > 0.95
    assert np.mean([n < 0.3 for n in neg]) > 0.8 and len(neg) > 5
    assert np.mean([r.score < 0.3 for r in rows if not r.quality]) > 0.8


def test_calibration_of_scores():
    from quarrylight.llm.quality_classifier import calibrate

    rng = np.random.default_rng(4)
    z = rng.normal(0, 2, 4000)
    label = rng.random(4000) < 1 / (1 + np.exp(-(1.5 * z - 0.7)))
    slope, offset = calibrate(z[label], z[~label])
    assert abs(slope - 1.5) < 0.15 and abs(offset + 0.7) < 0.15
    # far apart: still finite, and the middle lies between the two
    slope, offset = calibrate(np.array([5.0, 6.0, 7.0]), np.array([1.0, 2.0]))
    assert np.isfinite([slope, offset]).all() and slope * 2 + offset < 0 < slope * 5 + offset
    assert calibrate(np.array([1.0]), np.zeros(0)) == (1.0, 0.0) and calibrate(np.array([0.0, 1.0]), np.array([5.0, 6.0])) == (1.0, 0.0)


def test_quality_classifier_on_odd_rows(odd, empty, spark):
    from quarrylight.llm.quality_classifier import fit_quality, score_quality

    labels = spark.createDataFrame([(5, 1), (6, 1), (8, 0), (None, 1), (7, None), (99, 1)], "doc_id bigint, quality int")
    model = fit_quality(odd, labels)
    rows = score_quality(odd, model).collect()
    same_ids(rows, odd)
    assert all(0 <= r.score <= 1 for r in rows)
    assert score_quality(odd, fit_quality(odd, labels.limit(0))).count() == len(ODD)
    assert score_quality(empty, fit_quality(empty, labels)).count() == 0


def test_language_held_out(spark):
    from quarrylight.llm.language_id import op8_language_id

    d = "/root/testdata/sf0.01"
    rows = op8_language_id(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (crc(r.doc_id) % 3 == 1) for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in rows if r.held_out]) > 0.97


def test_language_on_odd_rows(odd, empty):
    from quarrylight.llm.language_id import codewords, fit_languages, predict_language

    rows = predict_language(odd, fit_languages(odd)).collect()
    same_ids(rows, odd)
    by = {r.doc_id: r for r in rows}
    assert by[1].lang_pred == by[2].lang_pred == by[3].lang_pred == "und" and by[1].score == 0
    assert all(r.lang_pred in ("en", "fr", "de", "es", "und") for r in rows)
    assert predict_language(odd, fit_languages(empty)).filter("lang_pred <> 'und'").count() == 0
    assert {r.lang_pred for r in predict_language(odd, fit_languages(odd.filter("lang = 'de'"))).collect()} == {"de", "und"}
    for n in (2, 3, 4, 7, 20):
        code = codewords(n)
        assert len(code) == n and len({tuple(x) for x in code.tolist()}) == n


def test_nnpu_risk_and_direction_by_brute_force():
    from quarrylight.llm.quality_classifier import nnpu_step

    rng = np.random.default_rng(1)
    p, u = rng.normal(0.5, 1, (30, 4)), rng.normal(0, 1, (50, 4))
    log = lambda z: np.log(1 + np.exp(z))
    signs = set()
    for k in range(20):
        x = rng.normal(0, 3 if k % 2 else 0.3, 5)
        prior = [0.3, 0.9][k % 2]
        ones, negative, g = nnpu_step(x, p, u, prior, 0.01)
        risk = lambda x: (prior * np.mean([log(-(r @ x[:-1] + x[-1])) for r in p]) + 0.005 * x[:-1] @ x[:-1], np.mean([log(r @ x[:-1] + x[-1]) for r in u]) - prior * np.mean([log(r @ x[:-1] + x[-1]) for r in p]))  # noqa: E731, B023
        assert np.allclose(risk(x), (ones, negative), atol=1e-5)
        signs.add(negative < 0)
        # a negative part under zero is climbed instead, under the penalty
        aim = (lambda x: -risk(x)[1] + 0.005 * x[:-1] @ x[:-1]) if negative < 0 else (lambda x: sum(risk(x)))  # noqa: B023
        eye = np.eye(5) * 1e-5
        assert np.allclose([(aim(x + e) - aim(x - e)) / 2e-5 for e in eye], g, atol=1e-4)
    assert signs == {True, False}


def test_prior_from_positives_and_unlabelled_rows():
    from quarrylight.llm.quality_classifier import estimate_prior

    rng = np.random.default_rng(2)
    for prior in (0.2, 0.5, 0.85):
        draw = lambda n, good: rng.normal(1.5 if good else -1.5, 1, (n, 6)).astype(np.float32)
        k = int(4000 * prior)
        unlabelled = rng.permutation(np.concatenate([draw(k, True), draw(4000 - k, False)]))
        assert abs(estimate_prior(draw(2000, True), unlabelled) - prior) < 0.06


def test_decoding_of_codewords_by_brute_force():
    import math

    from quarrylight.llm.language_id import MARGIN, codewords, decode

    rng = np.random.default_rng(3)
    for n in (2, 4, 9):
        code = codewords(n)
        bit = rng.random(code.shape[1])
        for _ in range(50):
            margins = rng.normal(0, 2, code.shape[1])
            loss = [sum(b * math.log1p(math.exp(-c * m)) for b, c, m in zip(bit, row, margins, strict=True)) for row in code]
            best = min(range(n), key=lambda k: loss[k])
            share = sorted((math.exp(-x) / sum(math.exp(-y) for y in loss) for x in loss), reverse=True)
            k, score, doubt = decode(margins, code, bit)
            assert k == best and abs(score - share[0]) < 1e-9 and doubt == (share[0] - share[1] < MARGIN)


def test_ordinal_loss_by_brute_force():
    import math

    from quarrylight.llm.toxicity import ordinal_loss

    rng = np.random.default_rng(4)
    rows = [{int(i): float(rng.random()) for i in rng.choice(5, 3, replace=False)} for _ in range(40)]
    grades, each = rng.integers(0, 4, 40), rng.random(40)
    at, idx, val = np.repeat(np.arange(40), 3), np.array([i for r in rows for i in r]), np.array([v for r in rows for v in r.values()])
    for _ in range(5):
        x = rng.normal(0, 1, 8)

        def loss(x):
            theta = [x[5], x[5] + math.exp(x[6]), x[5] + math.exp(x[6]) + math.exp(x[7])]
            total = 0.01 * sum(x[:5] ** 2) / 2
            for r, y, e in zip(rows, grades, each, strict=True):
                above = [1.0, *(1 / (1 + math.exp(t - sum(x[i] * v for i, v in r.items()))) for t in theta), 0.0]
                total -= e * math.log(above[y] - above[y + 1])
            return total

        found, gradient = ordinal_loss(x, 5, at, idx, val, grades, each, 0.01)
        assert abs(found - loss(x)) < 1e-9
        assert np.allclose([(loss(x + e) - loss(x - e)) / 2e-6 for e in np.eye(8) * 1e-6], gradient, atol=1e-6)


def test_severity_is_that_of_the_densest_passage():
    from quarrylight.llm.toxicity import PASSAGE, Scorer, grades_of_marks

    scorer = Scorer([("bad", 3.0), ("bad*", 3.0), ("worse", 3.0)])
    plain = "plain word here " * 40
    for text in ("bad bad worse", plain + "bad bad worse", (plain + "bad bad worse ") * 5, "bad " + plain + "bad bad worse " + plain):
        values, marks = scorer.values(text)
        assert marks == 3 and values == pytest.approx({0: math.log1p(2), 1: math.log1p(2), 2: math.log1p(1), 3: math.log1p(3)})
    rng = random.Random(8)
    for _ in range(100):  # against every passage
        words = [rng.choice(["bad", "x", "y", "worse", "z", "q", "v"]) if rng.random() < 0.2 else "n" for _ in range(rng.randint(0, 200))]
        marked = [w in ("bad", "worse") for w in words]
        assert scorer.values(" ".join(words))[1] == max((sum(marked[i : i + PASSAGE]) for i in range(len(words))), default=0)
    assert scorer.values(None) == ({}, 0)
    assert grades_of_marks(np.array([True, True, True, False]), np.array([1, 4, 9, 9])).tolist() == [1, 2, 3, 0]


def test_given_grades(odd, spark):
    from quarrylight.llm.toxicity import fit_toxicity, score_toxicity

    schema, text = "doc_id bigint, toxic int, grade int", "bad words stand here "
    docs = spark.createDataFrame([(k, text * (1 + k % 3) if k % 2 else f"plain text of number {k}") for k in range(40)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2, (1 + k % 3) * (k % 2)) for k in range(36)] + [(37, 1, None), (None, 1, 3), (1, 1, 2)], schema)
    rows = {r.doc_id: r for r in score_toxicity(docs, fit_toxicity(docs, labels, grade_col="grade")).collect()}
    assert all(r.toxic == bool(k % 2) for k, r in rows.items())
    with pytest.raises(ValueError):
        fit_toxicity(docs, labels.unionByName(spark.createDataFrame([(39, 1, 4)], schema)), grade_col="grade")


def test_toxicity_held_out(spark):
    from quarrylight.llm.toxicity import op9_toxicity

    d = "/root/testdata/sf0.01"
    rows = op9_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet").withColumnRenamed("toxic", "y"), "doc_id").filter("held_out").collect()
    assert np.mean([r.toxic == bool(r.y) for r in rows]) > 0.9
    assert all(0 <= r.expected_severity <= 3 for r in rows)
    # labels are flipped now and then; of what has marked words at all, nearly everything is caught
    every = op9_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet").withColumnRenamed("toxic", "y"), "doc_id").filter("held_out").collect()
    assert np.mean([r.toxic for r in every if r.y]) > 0.9 and np.mean([r.toxic for r in every if not r.y]) < 0.02


def test_toxicity_on_odd_rows(odd, empty, spark):
    from quarrylight.llm.toxicity import fit_ordinal, fit_toxicity, score_toxicity

    labels = spark.createDataFrame([(5, 1), (6, 1), (7, 1), (8, 0), (10, 0), (None, 1), (4, None)], "doc_id bigint, toxic int")
    rows = score_toxicity(odd, fit_toxicity(odd, labels)).collect()
    same_ids(rows, odd)
    assert not any(r.toxic for r in score_toxicity(odd, fit_toxicity(odd, labels.filter("toxic = 0"))).collect())
    assert score_toxicity(empty, fit_toxicity(empty, labels)).count() == 0
    w, theta = fit_ordinal([{0: 1.0 * k} for k in range(4)] * 20, np.array([0, 1, 2, 3] * 20), 1)
    assert w[0] > 0 and list(theta) == sorted(theta)


# mixing


def test_mixing_bisection():
    from quarrylight.llm.mixing import bisect_alpha, cover_budget, entropy, weights

    tokens = [10, 100, 1000]
    a = bisect_alpha(tokens, max_repeat=2.0)
    q = weights(tokens, a)
    repeat = [x * cover_budget(tokens, q) / t for x, t in zip(q, tokens, strict=True)]
    assert abs(max(repeat) - 2) < 1e-9 and abs(min(repeat) - 1) < 1e-9
    a = bisect_alpha(tokens, target_entropy=0.8)
    assert abs(entropy(weights(tokens, a)) - 0.8) < 1e-9
    assert bisect_alpha([5, 5], max_repeat=1.0) == 0 and bisect_alpha([], 2.0) == 0
    assert bisect_alpha(tokens, max_repeat=1.0) == pytest.approx(1.0)


def test_mixing_limits_hold_together_or_raise(docs):
    from quarrylight.llm.mixing import bisect_alpha, cover_budget, entropy, mix_plan, weights

    tokens = [3, 300_000, 200_000]
    a = bisect_alpha(tokens, max_repeat=2.0, target_entropy=1.0)
    q = weights(tokens, a)
    assert entropy(q) <= 1.0 + 1e-9 and max(x * cover_budget(tokens, q) / t for x, t in zip(q, tokens, strict=True)) <= 2 + 1e-9
    for limits in ({"max_repeat": 2, "budget": 100_000.0}, {"target_entropy": 0.1}, {"max_repeat": 0.5}):
        with pytest.raises(ValueError, match="no exponent"):
            bisect_alpha([100, 1000, 10_000], **limits)
    with pytest.raises(ValueError, match="no exponent"):
        mix_plan(docs, target_entropy=0.0)


def test_mixing_covers_and_follows_the_weights(docs):
    from quarrylight.llm.mixing import mix_documents, mix_plan

    rows = mix_plan(docs).collect()
    seen = collections.Counter(r.__getitem__("__id") for r in rows)
    assert set(seen) == {r.doc_id for r in docs.collect()} and max(seen.values()) <= 2
    tokens, share = collections.Counter(), {}
    for r in rows:
        tokens[r["__source"]] += r["__tokens"]
        share[r["__source"]] = r["target_share"]
    total, longest = sum(tokens.values()), max(r["__tokens"] for r in rows)
    assert all(abs(tokens[s] - share[s] * total) <= longest + 0.02 * total for s in tokens)
    assert mix_documents(docs).count() == len(rows)


def test_mixing_budget_below_the_corpus(docs):
    from quarrylight.llm.mixing import mix_plan

    rows = mix_plan(docs, budget=5000.0, max_repeat=1.5).collect()
    assert 0.5 * 5000 < sum(r["__tokens"] for r in rows) < 5000 + 20 * max(r["__tokens"] for r in rows)
    assert all(0 <= r.slot < 1 for r in rows)


def test_mixing_on_odd_rows(odd, empty):
    from quarrylight.llm.mixing import mix_documents

    rows = mix_documents(odd).collect()
    assert {str(r.doc_id) for r in rows} == {str(x[0]) for x in ODD}
    assert sum(r.doc_id == 10 for r in rows) % 2 == 0
    assert mix_documents(empty).count() == 0


# fingerprints


def naive_signatures(text, stops, chain=2):
    import re

    words = re.findall(r"[^\W_]+", (text or "").lower())
    spots = set()
    for i, w in enumerate(["", *words]):
        if not i or w in stops or len(w) % 4 == 0:
            rest = [x for x in words[i:] if x not in stops][:chain]
            if rest:
                spots.add(" ".join(rest))
    return spots or {" ".join(words)}


def test_spotsigs_by_brute_force(spark, docs):
    from quarrylight.llm.common import STOP_WORDS
    from quarrylight.llm.spotsigs import compare_edits

    stops = {w for line in STOP_WORDS for w in line.split()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = {r.doc_id: r for r in compare_edits(docs).collect()}
    ids = sorted(texts, reverse=True)
    assert sorted(rows) == sorted(texts)
    for i, k in enumerate(ids):
        t, n = texts[k], texts[ids[(i + 1) % len(ids)]]
        h = len(t) // 2
        edited = t[: len(t) - h] + n[:h]
        assert rows[k].edited == edited and rows[k].n_chars == len(t)
        a, b, c = naive_signatures(t, stops), naive_signatures(edited, stops), naive_signatures(n, stops)
        assert abs(rows[k].near_edited - len(a & b) / len(a | b)) < 1e-9
        assert abs(rows[k].near_next - len(a & c) / len(a | c)) < 1e-9
    assert np.mean([r.near_edited for r in rows.values()]) > np.mean([r.near_next for r in rows.values()]) + 0.2


def test_spotsigs_of_runs_of_common_words_take_linear_time(spark):
    from quarrylight.llm.spotsigs import fingerprint_documents

    began = time.time()
    found = fingerprint_documents(spark.createDataFrame([(1, "the " * 1_300_000 + "ending here"), (2, "x the ending here"), (3, "of the and " * 500_000)], "doc_id int, text string")).collect()
    assert {r.doc_id: len(r.signatures) for r in found} == {1: 1, 2: 2, 3: 1} and time.time() - began < 30
    assert set(found[0].signatures) < set(found[1].signatures)


def test_compared_edits_keep_other_columns(odd):
    from quarrylight.llm.spotsigs import compare_edits

    found = compare_edits(odd)
    assert found.columns[:5] == ["doc_id", "lang", "source", "kept", "score"] and "n_chars" in found.columns and "text" not in found.columns
    assert sorted(str((r.doc_id, r.source, r.kept)) for r in found.collect()) == sorted(str((x[0], x[3], x[5])) for x in ODD)


def test_spotsigs_ranges(spark):
    from quarrylight.llm import spotsigs

    ids = random.Random(3).sample(range(-1000, 10**12), 200)
    order = sorted(ids, reverse=True)
    for kind, name in (("bigint", int), ("string", lambda i: f"id, '{i:+015d}\"")):
        df = spark.createDataFrame([(name(i), f"t{i}") for i in ids], f"doc_id {kind}, text string")
        want = {name(k): f"t{order[(i + 1) % 200]}" for i, k in enumerate(order)}
        if kind == "string":
            strings = sorted(want, reverse=True)
            texts = dict(zip(map(name, ids), (f"t{i}" for i in ids), strict=True))
            want = {k: texts[strings[(i + 1) % 200]] for i, k in enumerate(strings)}
        rows = spotsigs.with_next(df, "doc_id", {"text": "next"}, F.lit(0), 30).collect()
        assert {r.doc_id: r.next for r in rows} == want


def test_spotsigs_on_odd_rows(odd, empty, spark):
    from quarrylight.llm.spotsigs import compare_edits, fingerprint_documents, likeness, similar_pairs

    rows = compare_edits(odd).collect()
    same_ids(rows, odd)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    prints = {}
    for r in fingerprint_documents(odd).collect():
        assert prints.setdefault(r.text, r.fingerprint) == r.fingerprint
    assert compare_edits(empty).count() == 0 and similar_pairs(empty).count() == 0
    assert {r.a for r in similar_pairs(odd).collect()} <= {x[0] for x in ODD}
    one = compare_edits(spark.createDataFrame([(1, "the cat sat on the mat")], "doc_id bigint, text string")).collect()
    assert one[0].near_next == 1.0
    pruned = spark.range(1).select(likeness(F.array(*map(F.lit, range(10))), F.array(F.lit(1)), 0.8).alias("x")).first()
    assert pruned.x == 0


def test_a_lost_anchor_costs_its_own_signature_only(spark):
    from quarrylight.llm.spotsigs import compare_edits

    body = [f"w{i:02d}xx" for i in range(100)]
    for n in (3, 4, 5):  # however few the anchors are
        text = " ".join(w for i in range(n) for w in ["the", *body[20 * i : 20 * i + 20]])
        rows = compare_edits(spark.createDataFrame([(2, text), (1, text.removeprefix("the "))], "doc_id bigint, text string")).collect()
        assert next(r for r in rows if r.doc_id == 2).near_next >= (n - 1) / n


def test_similar_pairs_by_brute_force(spark, docs, monkeypatch):
    from quarrylight.llm import spotsigs
    from quarrylight.llm.common import STOP_WORDS

    stops = {w for line in STOP_WORDS for w in line.split()}
    rng, base = random.Random(4), [f"w{k}xx" if k % 2 else "the" for k in range(180)]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # a group of near copies, copies of one of them, and longer and shorter texts around them
    rows += [(10_000 + k, " ".join(w if w == "the" or rng.random() > 0.02 else f"y{k}" for w in base[: 140 + k % 9])) for k in range(40)] + [(20_000 + k, rows[0][1]) for k in range(3)]
    sets = {}
    for i, t in sorted(rows):
        sets.setdefault(frozenset(naive_signatures(t, stops)), i)
    items = sorted((i, x) for x, i in sets.items())
    want = {(i, j): len(x & y) / len(x | y) for k, (i, x) in enumerate(items) for j, y in items[k + 1 :] if len(x & y) >= 0.8 * len(x | y) - 1e-12}
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for hot in (512, 3):
        monkeypatch.setattr(spotsigs, "HOT", hot)
        found = {(r.a, r.b): r.likeness for r in spotsigs.similar_pairs(df).collect()}
        assert found.keys() == want.keys() and len(want) > 20
        assert all(abs(found[k] - want[k]) < 1e-9 for k in want)
    with pytest.raises(ValueError):
        spotsigs.similar_pairs(df, threshold=0.4)


# line dedup


def naive_line_dedup(rows):
    key = lambda x: "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    holders = collections.defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                holders[key(x)].add(i)
    lost = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    return {i: "\n".join(x for x in (t or "").split("\n") if lost.get(key(x), i) == i) for i, t in rows}


def test_line_dedup_by_brute_force(docs, odd, empty):
    from quarrylight.llm.line_dedup import dedup_lines

    for df in (docs.select("doc_id", "text", "source"), odd.filter("doc_id is not null")):
        want = naive_line_dedup([(r.doc_id, r.text) for r in df.collect()])
        rows = dedup_lines(df).collect()
        same_ids(rows, df)
        for r in rows:
            assert r.kept_text == want[r.doc_id]
            assert r.n_lines == len((r.text or "").split("\n"))
    rows = {r.doc_id: r for r in dedup_lines(odd).collect()}
    assert rows[5].n_dropped == 3 and rows[6].n_dropped == 1 and rows[7].n_dropped == 0
    assert rows[None].n_dropped == 0
    assert dedup_lines(empty).count() == 0


def test_line_dedup_long_documents(spark):
    from quarrylight.llm.line_dedup import dedup_lines

    shared = [f"a line that is long enough {k}" for k in range(300)]
    df = spark.createDataFrame([(i, "\n".join(shared + [f"own line of document {i} {k} here" for k in range(50)])) for i in range(4)], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in dedup_lines(df).collect()}
    assert [rows[i].n_dropped for i in range(4)] == [300, 300, 300, 0]
    assert all(rows[i].kept_text.count("\n") == 49 for i in range(3))


# n-gram Jaccard join


def naive_classes(rows, threshold=0.8):
    import re

    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        k = min(5, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    ids = sorted(sets)
    top, links = {i: i for i in ids}, collections.Counter()

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(ids)):
        for b in range(a + 1, len(ids)):
            x, y = sets[ids[a]], sets[ids[b]]
            if x and y and len(x & y) >= threshold * len(x | y) - 1e-12:
                links[ids[a]] += 1
                links[ids[b]] += 1
                p, q = find(ids[a]), find(ids[b])
                top[max(p, q)] = min(p, q)
    return {i: (find(i), links[i]) for i in ids}


def near_copies(spark, monkeypatch=None, n=60):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join(base[: 60 + k % 3] + [f"x{k}"] + base[60 + k % 3 :])) for k in range(n)]
    rows += [(1000 + k, " ".join(rng.choice(base) for _ in range(80))) for k in range(20)]
    rows += [(2000 + k, rows[0][1]) for k in range(5)]
    return rows


def test_near_copies_by_brute_force(spark, docs, monkeypatch):
    from quarrylight.llm import ngram_join

    monkeypatch.setattr(ngram_join, "BLOCK_NODES", 16)
    for rows in (near_copies(spark), [(r.doc_id, r.text) for r in docs.collect()]):
        want = naive_classes(rows)
        found = ngram_join.jaccard_classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
        assert {r.doc_id: (r.class_id, r.n_links) for r in found} == want


def test_near_copies_on_odd_rows(odd, empty):
    from quarrylight.llm.ngram_join import choose_bands, jaccard_classes

    rows = jaccard_classes(odd).collect()
    same_ids(rows, odd)
    by = {r.doc_id: r for r in rows}
    assert by[1].class_id == 1 and by[2].n_links == 0 and by[3].class_size == 1
    assert by[10].class_id == 10 and by[10].n_links == 1 and by[None].class_id is None
    assert jaccard_classes(empty).count() == 0
    bands, length = choose_bands(0.8, 0.999)
    assert 1 - (1 - 0.8**length) ** bands >= 0.999


def test_texts_under_one_id_keep_their_own_classes(spark):
    from quarrylight.llm.ngram_join import jaccard_classes, one_of_each_class

    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    for rows in ([(1, a), (1, b), (2, a + " more")], [(1, b), (1, a), (2, a + " more")], [(2, a + " more"), (1, b), (1, a)]):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
        found = {(r.doc_id, r.text): (r.class_id, r.n_links, r.class_size) for r in jaccard_classes(df).collect()}
        assert found == {(1, a): (1, 1, 2), (1, b): (1, 0, 1), (2, a + " more"): (1, 1, 2)}
        assert sorted((r.doc_id, r.text) for r in one_of_each_class(df).collect()) == [(1, a), (1, b)]
    # a repeated row goes, a near copy under the same id too
    df = spark.createDataFrame([(1, a, "x"), (1, a, "y"), (1, a + " more", "x"), (None, a, "x"), (None, a, "x")], "doc_id bigint, text string, lang string")
    kept = one_of_each_class(df).collect()
    assert sum(r.doc_id == 1 for r in kept) == 1 and sum(r.doc_id is None for r in kept) == 2


def half_alike(n=60):
    # chains of texts of which neighbours share half of their shingles
    words = [f"v{k}" for k in range(90 + 30 * n)]
    return [(k, " ".join(words[30 * k : 30 * k + 90])) for k in range(n)]


def test_half_alike_texts_are_not_verified(spark, monkeypatch):
    from quarrylight.llm import ngram_join

    seen = []
    plain = ngram_join.in_blocks
    monkeypatch.setattr(ngram_join, "in_blocks", lambda df: (seen.append(df), plain(df))[1])
    rows = half_alike()
    found = ngram_join.jaccard_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert all(r.class_id == r.doc_id and r.n_links == 0 for r in found)
    assert seen[0].count() <= 0.1 * len(rows)


def test_large_buckets_and_blocks(spark, monkeypatch):
    from quarrylight.llm import ngram_join

    monkeypatch.setattr(ngram_join, "BUCKET", 8)
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", 8)
    rng, base = random.Random(6), [f"w{k}" for k in range(150)]
    # a drifting group: neighbours are linked, ends are not
    rows = [(k, " ".join(base[k : k + 80])) for k in range(60)] + [(100 + k, " ".join(base[:40] + [f"y{k}"] + base[40:80])) for k in range(40)]
    rng.shuffle(rows)
    want = naive_classes(rows)
    found = ngram_join.jaccard_classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in found} == want


def test_recall_of_planted_pairs(spark):
    from quarrylight.llm.ngram_join import jaccard_classes

    rng, rows = random.Random(7), []
    for k in range(400):
        words = [f"{k}_{i}" for i in range(rng.randint(60, 200))]
        near = list(words)
        for _ in range(len(words) // 55):  # each changed word changes five shingles
            near[rng.randrange(len(near))] = f"{k}_new{rng.random()}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(near))]
    want = naive_classes_by_pairs(rows)
    found = {r.doc_id: r.class_id for r in jaccard_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert sum(want) > 300
    assert sum(found[2 * k] == found[2 * k + 1] for k in range(400) if want[k]) >= 0.99 * sum(want)
    assert not any(found[2 * k] == found[2 * k + 1] for k in range(400) if not want[k])


def naive_classes_by_pairs(rows, threshold=0.8):
    grams = lambda t: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)}
    return [len(a & b) >= threshold * len(a | b) - 1e-12 for a, b in ((grams(rows[k][1]), grams(rows[k + 1][1])) for k in range(0, len(rows), 2))]


def test_components_of_a_chain(spark):
    from quarrylight.llm.graph import connected_components

    chain = list(range(50))
    random.Random(1).shuffle(chain)
    edges = spark.createDataFrame([(chain[i], chain[i + 1]) for i in range(49)] + [(100, 101), (5, 5), (None, 3)], "a bigint, b bigint")
    found = {r.node: r.component for r in connected_components(edges).collect()}
    assert {found[k] for k in chain} == {0} and found[101] == 100


# the pipeline


def test_pipeline_by_brute_force(spark, docs):
    import corpus_pipeline
    import sentencepiece

    from quarrylight.llm.pieces import model_path

    stages = dict(corpus_pipeline.STAGES)
    d = TESTDATA
    clean = stages["toxicity"](spark, docs, d).cache()
    lines = stages["line_dedup"](spark, clean, d).cache()
    want = naive_line_dedup([(r.doc_id, r.text) for r in clean.collect()])
    assert {r.doc_id: r.text for r in lines.collect()} == want
    unique = stages["ngram_jaccard_join"](spark, lines, d).cache()
    classes = naive_classes([(r.doc_id, r.text) for r in lines.collect()])
    assert sorted(r.doc_id for r in unique.collect()) == sorted(i for i, (c, _) in classes.items() if c == i)
    mixed = stages["mixing"](spark, unique, d).cache()
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in unique.collect()}
    lib = sentencepiece.SentencePieceProcessor(model_file=model_path())
    coded = stages["sentencepiece"](spark, mixed, d).collect()
    texts = {r.doc_id: r.text for r in mixed.collect()}
    for r in coded:
        ids = lib.encode(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert all(list(x.columns) == list(corpus_pipeline.COLUMNS) for x in (clean, lines, unique, mixed))
    assert corpus_pipeline.run(spark, d).count() == len(coded)


def test_stages_on_odd_rows(spark, odd):
    import corpus_pipeline

    if not os.path.isdir(TESTDATA):
        pytest.skip("no test tables")
    df = odd.select(*corpus_pipeline.COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, TESTDATA).cache()
        assert df.count() > 5
        if name == "ngram_jaccard_join":
            ids = [r.doc_id for r in df.collect()]
            assert len(ids) == len(set(ids)) and {1, 2, 3, None} <= set(ids)
