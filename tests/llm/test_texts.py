"""Token files, byte BPE, fingerprints and toxicity against brute force on small tables."""

import base64
import hashlib
import json
import random
import tracemalloc
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer, pre_tokenizers

from lexmill.llm import bpe, fingerprints, queries, token_files, toxicity

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "a", "\n\n \t x  y", "naïve café — “quoted” 東京 한국어 😀 é", "don't we'll I'VE 123 4567  !!!", "x" * 3000, "   a\u0085b\x1cc\x1fd", "<|endoftext|> y", "ab" * 500 + " 0" * 200, "﻿‍", "éèêü" * 50]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, part int, ids string, start string, score double")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, 1, "clash", None, None) for i, t in enumerate(ODD)]
    return docs_of(spark, [*rows, (99, None, None, None, None, None), (3, ODD[3], 1, "clash", None, None), (None, "no id", 1, None, None, None)])


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_gives_what_the_library_gives(spark, odd):
    ref, ranks = reference(), bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for frame in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        got = bpe.encode_documents(frame, ranks, public_tokenizers.PATTERN)
        texts = sorted(((r.doc_id is None, r.doc_id or 0), r.text or "") for r in frame.select("doc_id", "text").collect())
        ids = sorted(((r.doc_id is None, r.doc_id or 0), list(r.ids)) for r in got.collect())
        assert sorted((k, ref.encode_ordinary(t)) for k, t in texts) == ids
        back = bpe.decode_documents(got, ranks, public_tokenizers.PATTERN).collect()
        assert sorted(((r.doc_id is None, r.doc_id or 0), r.text) for r in back) == texts


def test_transducer_on_random_bytes():
    ref, c = reference(), bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    rng = random.Random(5)
    for _ in range(3000):
        alphabet = rng.choice(["ab", "thean ", "aeioué", "0123", "=-_*", "あ一x"])
        word = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))).encode()
        assert list(c.machine.encode(word)) == ref._encode_single_piece(word)
    small = bpe.Transducer(c.machine.ranks, most_states=50)  # states are forgotten and found again
    for word in (b"retheanation", b"thereinaftertheth", b"zzzzqqqq"):
        assert list(small.encode(word)) == ref._encode_single_piece(word)


def test_utf8_machine_across_tokens_and_on_invalid_bytes():
    rng = random.Random(7)
    for _ in range(2000):
        data = bytes(rng.choice([0x41, 0x80, 0xBF, 0xC2, 0xE0, 0xA0, 0xED, 0xF0, 0x90, 0xF4, 0x8F, 0xFF, rng.randrange(256)]) for _ in range(rng.randint(0, 12)))
        state, out = b"", ""
        for byte in data:
            text, state = bpe.Utf8Machine.feed(state, bytes((byte,)))
            out += text
        assert out + ("�" if state else "") == data.decode("utf-8", "replace")


def test_op10_query(spark):
    ref = reference()
    got = {r.doc_id: r for r in queries.op10_byte_bpe(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = ref.encode_ordinary(r.text)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, odd, tmp_path, encoding):
    path = public_tokenizers.path("byte_bpe_50k.json")
    ref = Tokenizer.from_file(path)
    for k, frame in enumerate((odd, spark.read.parquet(f"{SF}/documents.parquet"), odd.limit(0))):
        out = f"{tmp_path}/{encoding}{k}"
        token_files.write_tokens(frame, out, open(path).read(), encoding=encoding)
        got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.checksums(token_files.read_tokens(spark, out)).collect()]
        want, at = [], 0
        for doc_id, text in sorted(((r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
            ids = [*ref.encode(text, add_special_tokens=False).ids, 0]
            want.append((doc_id, at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
            at += len(ids)
        assert sorted(got, key=lambda x: x[1]) == want
        assert sorted(token_files.read_metadata(spark, out).collect(), key=lambda x: x[1]) == [w[:3] for w in want]
    one = token_files.read_tokens(spark, f"{tmp_path}/{encoding}1", [17]).collect()
    assert [r.doc_id for r in one] == [17]


def test_library_encoder_agrees_on_single_characters():
    path = public_tokenizers.path("byte_bpe_50k.json")
    ref, enc = Tokenizer.from_file(path), token_files.encoder(open(path).read())
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}" for c in range(256)]
    rng = random.Random(17)  # blanks beside white space of every kind, marks of special tokens, and other scripts
    texts += ["".join(rng.choice([" ", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "\u0085", "\x1c", "\u3000", "\u200b", "a", "é", "あ", "1", "'s", "!", "<|endoftext|>", "😀"]) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    assert enc.cuts
    long = " ".join(texts * (1 + (5 * token_files.LONG // 2) // sum(map(len, texts))))
    assert len(list(enc.parts(long))) > 2 and "".join(enc.parts(long)) == long
    texts.append(long)
    for text, ids in zip(texts, enc.encode(texts), strict=True):
        assert ids == b"".join(i.to_bytes(4, "little") for i in ref.encode(text, add_special_tokens=False).ids)


def test_texts_as_bytes_give_the_ids_of_the_given_tokenizer():
    path = public_tokenizers.path("byte_bpe_50k.json")
    told, ref = json.loads(open(path).read()), Tokenizer.from_file(path)
    enc = token_files.encoder(open(path).read())
    assert sorted(token_files.stand_ins().values()) == sorted(pre_tokenizers.ByteLevel.alphabet())
    assert all(not token_files.UNKNOWN.search(c) for c in token_files.KNOWN) and token_files.UNKNOWN.search("a\u0800") and token_files.UNKNOWN.search("\u2070")
    rng = random.Random(23)
    some = [" ", " ", "\n", "\t", "a", "s", "ll", "'", "'re", "1", "é", "×", "\u00a0", "\u0085", "\u2003", "’", "Ж", "٣", "²", "\x00", "<|endoftext|>", "!"]
    texts = [f"a{c}b {c}{c} 1{c}'{c} {c}" for c in token_files.KNOWN]
    texts += ["".join(rng.choice(some if rng.random() < 0.7 else token_files.KNOWN) for _ in range(rng.randint(0, 25))) for _ in range(5000)]
    for text in texts:
        assert enc.bytewise.encode(text.encode().decode("latin-1"), add_special_tokens=False).ids == ref.encode(text, add_special_tokens=False).ids
    assert "tokenizer" not in vars(token_files.LibraryEncoder(json.dumps(told)))  # made for texts of other characters only
    beside = told | {"added_tokens": [told["added_tokens"][0] | {"lstrip": True}]}  # looks at what stands beside it: texts go as they are
    other = token_files.LibraryEncoder(json.dumps(beside))
    text = "a  <|endoftext|> b é"
    assert other.bytewise is None
    assert other.encode([text, ""]) == [array("I", Tokenizer.from_str(json.dumps(beside)).encode(text, add_special_tokens=False).ids).tobytes(), b""]


def test_fingerprints(spark, odd):
    for frame in (odd, spark.read.parquet(f"{SF}/documents.parquet"), odd.limit(1), odd.limit(0)):
        rows = sorted(((r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
        got = fingerprints.fingerprint_edits(frame).collect()
        want = []
        for i, (doc_id, text) in enumerate(rows):
            following = rows[(i + 1) % len(rows)][1]
            k = len(text) // 3
            edited = text[: len(text) - k] + following[:k]
            prefix = next((j for j, (a, b) in enumerate(zip(text, edited)) if a != b), min(len(text), len(edited)))
            want.append((str(doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest(), prefix))
        assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.kept_prefix) for r in got) == sorted(want)
        by_text = {}
        for r in got:
            text = {t for d, t in rows if str(d) == str(r.doc_id)}.pop()
            assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert len({*by_text.values()}) == len(by_text)


def slow_fingerprint(text, s):
    """Hashes of prefixes and spans, each summed up from its code points."""
    f = fingerprints

    def one(span, base, prime):
        return sum((ord(c) + 1) * pow(base, j, prime) for j, c in enumerate(span)) % prime

    def mixed(h):
        h = (h ^ (h >> 31)) * 0x9E3779B97F4A7C15 % (1 << 64)
        return (h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 % (1 << 64) >> 32

    k = min(len(text), s.span)
    points = [g for e in range(40) for g in ([1 << e] if e < 2 else [(1 << e) * q // 4 for q in (4, 5, 6, 7)]) if g < len(text)]
    points = sorted({*points, *(g for g in range(1, min(8, len(text))))})
    spans = sorted({mixed(one(text[i : i + k], f.B1, f.P1)) for i in range(len(text) - k + 1)})[: s.kept] if text else []
    return len(text), points, [mixed(one(text[:g], f.B1, f.P1) << 31 | one(text[:g], f.B2, f.P2)) for g in points], spans


def test_fingerprints_and_likeness_by_brute_force():
    """Short, middle and long texts, and pairs of very unlike lengths, are all compared."""
    rng, s = random.Random(9), fingerprints.Settings()
    texts = ["", "a", "b", "ab" * 30, "x" * 400, *("".join(rng.choice("abcd é") for _ in range(n)) for n in (3, 7, 8, 9, 40, 95, 96, 97, 383, 384, 900))]
    texts += [t[: len(t) - len(t) // 3] + "".join(rng.choice("abcd") for _ in range(len(t) // 3)) for t in texts] + [texts[-1][:90]]
    found = [(fingerprints.Fingerprint.of(fingerprints.PrefixHash(t)), slow_fingerprint(t, s)) for t in texts]
    for f, (n, points, prefixes, spans) in found:
        assert (f.n, list(f.prefixes), list(f.spans), fingerprints.grid(n)) == (n, prefixes, spans, points)
    for (f, (n, points, _, spans)), a in zip(found, texts):
        for (g, (m, _, _, others)), b in zip(found, texts):
            want = 1.0
            if a != b:
                union = sorted({*spans, *others})[: s.kept]
                same = max((p for p in points if p < m and a[:p] == b[:p]), default=0)
                want = max(len({*spans} & {*others} & {*union}) / len(union), same / max(n, m))
            assert f.likeness(g) == want == g.likeness(f)
    long = "".join(rng.choice("abcdefgh ") for _ in range(70_000))  # over several blocks, from its start and from a head
    other = long[:50_000] + long[:20_000]
    head = fingerprints.PrefixHash(long)
    grown, whole = fingerprints.PrefixHash(other, head, 50_000), fingerprints.PrefixHash(other)
    assert all((x == y).all() for x, y in zip(grown.prefix, whole.prefix)) and (grown.all_spans(8) == whole.all_spans(8)).all()
    assert head.common_extension(0, 0, grown) >= 50_000 and head.common_extension(0, 50_000, grown) == 20_000


def test_prefix_hashes():
    rng = random.Random(3)
    for _ in range(200):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(1, 60)))
        b = "".join(rng.choice("ab") for _ in range(rng.randint(1, 60)))
        x, y = fingerprints.PrefixHash(a), fingerprints.PrefixHash(b)
        i, j = rng.randrange(len(a)), rng.randrange(len(b))
        n = 0
        while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
            n += 1
        assert x.common_extension(i, j, y) == n
        f = fingerprints.Fingerprint.of(x)
        assert fingerprints.Fingerprint.parse(str(f)) == f


def test_toxicity(spark, odd):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = queries.op7_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    caught = [r.predicted for r in held if r.toxic == 1]
    false = [r.predicted for r in held if r.toxic == 0]
    assert sum(caught) >= 0.8 * len(caught) and sum(false) <= 0.03 * len(false)
    model = toxicity.fit_documents(docs.limit(300), labels)
    scores = toxicity.score_documents(odd, model).collect()
    assert len(scores) == odd.count() and all(0 <= r.score <= 1 for r in scores)
    assert all(r.score < 0.5 for r in scores if r.doc_id in (0, 1, 99))
    assert toxicity.score_documents(odd.limit(0), model).count() == 0
    assert toxicity.fit_documents(odd, labels.limit(0)).bias < 0
    assert toxicity.keep_clean(odd, model).columns == odd.columns


def test_unseen_misspellings_and_runs_of_words(spark):
    """Words bent in ways the sample has not are still toxic, a run of words is the mean of its words, and columns of any
    name and type stay."""
    rng = random.Random(21)
    bad, letters = ["grumblewort", "snarkfiend", "blatherskite"], "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(3, 9)))
    common = [word() for _ in range(300)]

    def bent(w):
        i = rng.randrange(1, len(w) - 1)
        return rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1 :], w[:i] + rng.choice("*@013") + w[i + 1 :], w[:i] + w[i] * 3 + w[i + 1 :]])

    def text(toxic):
        words = [rng.choice(common) for _ in range(rng.randint(5, 120))]
        for _ in range(2 * toxic):
            words.insert(rng.randrange(len(words)), bent(rng.choice(bad)))
        return " ".join(words)

    train = [(text(i % 2), i % 2) for i in range(400)]
    model = toxicity.fit([t for t, _ in train], np.array([y for _, y in train]), toxicity.Settings(min_docs=3))
    seen = {w for t, _ in train for w in t.split()}
    tests = [(t, y) for t, y in ((text(i % 2), i % 2) for i in range(900)) if not y or not any(w in seen and w not in common for w in t.split())]
    scores = model.scores([t for t, _ in tests], toxicity.word_scores(model.table, model.settings))
    wrong = [(y, x >= 0.5) for (_, y), x in zip(tests, scores) if y != (x >= 0.5)]
    assert sum(y for _, y in tests) > 30 and len(wrong) <= 0.1 * len(tests)
    memo, size = toxicity.word_scores(model.table, model.settings), model.settings.window
    for t in ["one", *(t for t, _ in tests[:40])]:
        v = [memo[w] for w in t.lower().split()]
        n = min(size, len(v))
        runs = [sum(v[a : a + n]) / n for a in range(len(v) - n + 1)]
        assert abs(1 / (1 + np.exp(-max(runs) - model.bias)) - model.scores([t], memo)[0]) < 1e-9
    rows = [(t, 1, "x", (1,)) for t, _ in tests]
    frame = spark.createDataFrame(rows, "text string, `meta.lang` int, `a``b` string, __gone struct<`x y`: int>")
    kept = toxicity.keep_clean(frame, model)
    assert kept.schema == frame.schema and sorted(r.text for r in kept.collect()) == sorted(t for (t, _), x in zip(tests, scores) if x < 0.5)


def test_toxicity_sample_keeps_both_classes(spark):
    """Long clean texts leave the toxic class its half of the words, whatever text comes first."""
    s = toxicity.Settings(sample=40, sample_words=2_000)
    for long in range(0, 60, 7):  # one text of more words than all may have, early or late in order of the hash
        rows = [(i, ("w " * (5_000 if i == long else 100 if i % 3 else 20)).strip()) for i in range(60)]
        docs = spark.createDataFrame([*rows, rows[1]], "doc_id long, text string")
        labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
        texts, ys = toxicity.training_rows(docs, labels, s)
        sizes = [len(x.split()) for x in texts]
        assert (ys == 1).sum() == 20 - (long % 3 == 0) and max(sizes) == 100  # 400 words: all that fit
        assert 1_500 <= sum(n for n, y in zip(sizes, ys, strict=True) if y == 0) <= 1_600  # and what they leave
    one = docs.where("doc_id IN (1, 56)")  # 56 is long
    assert sorted(toxicity.training_rows(one, spark.createDataFrame([(1, 0), (56, 1)], "doc_id long, toxic int"), s)[1]) == [0, 0, 1]


def test_toxicity_fit_against_plain_loops():
    """The fitted table against gradients of single n-grams, words, runs and texts, one after the other."""
    rng = random.Random(31)
    words = ["good", "day", "idiot", "idoit", "fine", "vile", "tree", "a", "vvile"]
    texts = [" ".join(rng.choice(words[:2] + words[4:5] + words[6:8] if k % 2 else words) for _ in range(rng.randint(1, 7))) for k in range(24)] + [""]
    labels = np.array([1 - k % 2 for k in range(24)] + [0])
    s = toxicity.Settings(buckets=64, dim=3, min_docs=2, epochs=3)
    got = toxicity.fit_table(texts, labels, s)
    gen = np.random.default_rng(s.seed)
    vectors, diff, bias = gen.normal(0, 0.1, (s.buckets, s.dim)), gen.normal(0, 1, s.dim), -1.0
    docs = [[toxicity.grams(w, s) for w in t.lower().split()] for t in texts]
    spread = {g: sum(any(g in w for w in d) for d in docs) for g in range(s.buckets)}
    live = {g for g in range(s.buckets) if spread[g] >= s.min_docs}
    moments = [np.zeros((s.buckets, s.dim)), np.zeros((s.buckets, s.dim)), np.zeros(s.dim), np.zeros(s.dim)]
    rows = [i for i, d in enumerate(docs) if d]
    for epoch in range(1, s.epochs + 1):
        sharp = s.sharp * min(1.0, epoch / (s.epochs / 2))
        by_gram, errors = np.zeros(s.buckets), 0.0
        for i in rows:
            value = [sum(vectors[g] @ diff for g in w if g in live) / len(w) for w in docs[i]]
            size = min(s.window, len(value))
            runs = [sum(value[a : a + size]) / size for a in range(len(value) - size + 1)]
            e = np.exp(sharp * (np.array(runs) - max(runs)))
            whole = max(runs) + np.log(e.sum() / len(runs)) / sharp
            error = (1 / (1 + np.exp(-(whole + bias))) - labels[i]) * 0.5 / (labels[rows] == labels[i]).sum()
            errors += error
            for a, share in enumerate(e / e.sum()):
                for w in docs[i][a : a + size]:
                    for g in w:
                        by_gram[g] += error * share / size / len(w) * (g in live)
        for m, v, grad, param in ((moments[0], moments[1], by_gram[:, None] * diff, vectors), (moments[2], moments[3], vectors.T @ by_gram, diff)):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad**2 - v)
            step = s.rate * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.999**epoch)) + s.floor)
            if param is vectors:
                before = step
            else:
                for g in live:
                    vectors[g] -= before[g] + s.rate * s.decay * vectors[g]
                diff = diff - step
        bias -= 2.0 * errors
    want = np.array([vectors[g] @ diff if g in live else 0.0 for g in range(s.buckets)])
    assert np.allclose(got.table, want, atol=1e-5) and np.abs(want).max() > 0.01


def test_toxicity_runs_begin_at_every_word():
    s = toxicity.Settings(buckets=1 << 12)
    texts = ["so it is and so it goes on", "you vile idoit go away"] * 40
    model = toxicity.fit(texts, np.array([0, 1] * 40), s)
    memo = toxicity.word_scores(model.table, s)
    plain, moved = "one two three you vile idoit four five six seven", "zero one two three you vile idoit four five six seven"
    a, b = model.scores([plain, moved], memo)
    assert a == b and a >= 0.5
    values = [memo[w] for w in plain.split()]
    best = max((x + y) / 2 for x, y in zip(values, values[1:]))
    assert abs(a - 1 / (1 + np.exp(-(best + model.bias)))) < 1e-9
    assert toxicity.cut(np.array([0.0, 1.0, 2.0, 3.0]), np.array([0, 0, 1, 1])) == 1.5


def test_toxicity_words_are_worked_out_together(monkeypatch):
    """All new words of a batch at once, each with the mean over its distinct pieces, also when few values are held."""
    rng, gen = random.Random(41), np.random.default_rng(41)
    s = toxicity.Settings(buckets=1 << 12)
    table = gen.normal(0, 1, s.buckets).astype(np.float32)
    words = ["", "a", "...", "<<>>", "aaaa", "ababab", "éé", "日本語日本語", "😀a😀b", "\ud800x\ud800x", "xyz" * 2_000]
    words += ["".join(rng.choice("abc<>.é日😀\ud800") for _ in range(rng.randint(0, 12))) for _ in range(3_000)]
    want = {w: np.mean([float(table[b]) for b in toxicity.grams(w, s)]) for w in words}
    single, pieces = [], toxicity.pieces
    monkeypatch.setattr(toxicity, "pieces", lambda w, s: single.append(w) or pieces(w, s))
    for most in (10, 500, 100_000):
        monkeypatch.setattr(toxicity, "WORDS", 300)
        memo = toxicity.word_scores(table, s, most)
        got = memo.values(words * 2)
        assert np.allclose(got, [want[w] for w in words * 2], atol=1e-12) and (got[: len(words)] == got[len(words) :]).all()
    seen = set(single)
    single.clear()
    toxicity.word_scores(table, s).values(words)
    assert {"xyz" * 2_000, "aaaa"} <= seen and len(single) < 0.3 * len(set(words))
    assert all(len({w[i : i + 3] for i in range(len(w) - 2)}) < len(w) - 2 for w in map(toxicity.marks, single))
    model = toxicity.Model(table, -1.0, s)
    scores = model.scores(["", "one two three", "one", " ", "one two three"], memo)
    assert scores[1] == scores[4] == model.scores(["one two three"], memo)[0] and scores[0] == scores[3] == 1 / (1 + np.exp(1.0))


def test_toxicity_fit_keeps_little_of_its_pieces():
    """The driver fits: beside the buckets of all pieces it holds blocks of them, not several numbers for each (107 MB before)."""
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=9)) for _ in range(250)) for _ in range(400)]
    tracemalloc.start()
    try:
        toxicity.fit_table(texts, np.arange(400) % 2, toxicity.Settings(buckets=1 << 14, dim=4, epochs=1))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 75e6
