"""Column functions against literal expectations and plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lexmill.functions import ids, text, urls
from lexmill.functions.numbering import mark_number
from lexmill.operators import chunking, segment


def value(spark, column, x, kind="string"):
    return spark.createDataFrame([(x,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("f", "x", "want"),
    [
        (text.clean_line, "a  NBSP b\n\tc ", "a b c"),
        (text.clean_line, "a &nbsp; b", "a & ; b"),
        (text.clean_line, "가NBSP나", "가NBSP나"),
        (text.clean_line, None, ""),
        (text.clean_block, " a \t b \n\n\n\n c nbsp d\n ", "a b\n\nc d"),
        (text.clean_statute, "［가］ （나）", "[가] (나)"),
        (text.unwrap_brackets, " [ x y ] ", "x y"),
        (text.unwrap_brackets, "a [x]", "a [x]"),
        (text.drop_brackets, "a [x] b", "a x b"),
        (text.drop_brackets, "[a] [x]", "a] [x"),
        (text.normal_lines, " a \r\n\n \tb　\n", "a\nb"),
        (text.ocr_lead, " x 본문", "본문"),
        (text.html_to_text, "<p>a<br>b</p>&lt;c&gt; &middot;", "a b <c> ·"),
        (lambda c: text.clean_spaces(c, quotes=False), '"a"  b\n\n\n\nc', "a b\n\nc"),
    ],
)
def test_cleaners(spark, f, x, want):
    assert value(spark, f, x) == want


def test_noise_tokens_references(spark):
    for x, noise in [("연혁", True), ("가", True), ("문의 02-123-4567", True), ("●●", True), ("제1조", False), ("", True), (None, True), ("12", False)]:
        assert value(spark, text.is_noise, x) is noise
    assert [value(spark, text.token_estimate, "x" * n) for n in (0, 1, 2, 5, 12)] == [1, 1, 1, 2, 4]
    got = value(spark, text.references, "「근로기준법」 제17조와 「 민법 」제 3 조")
    assert [(r.law, r.article) for r in got] == [("근로기준법", 17), ("민법", 3)]
    assert value(spark, text.short_title, "<h2>x (약칭: 근로법)</h2>") == "근로법"


def test_numbers(spark):
    want = {"③": 3, "⑳": 20, "제3항": 3, "다.": 3, "10.": 10, "각.": None, "": None, None: None, " 제 12 항": 12}
    for x, n in want.items():
        assert value(spark, mark_number, x) == n


def test_urls(spark):
    base = "https://portal.example/doc"
    link = "lsReturnSearch('x','20240101','232959')"
    assert value(spark, lambda c: urls.detail_url(c, urls.STATUTE, base), link) == f"{base}/lsInfoP.do?lsiSeq=232959&efYd=20240101"
    assert value(spark, lambda c: urls.detail_url(c, urls.STATUTE, base), "lsReturnSearch('x','20240101')") is None
    twice = "lsReturnSearch('20240101','20240101')"
    assert value(spark, lambda c: urls.detail_url(c, urls.STATUTE, base), twice) == f"{base}/lsInfoP.do?lsiSeq=20240101&efYd=20240101"
    assert value(spark, lambda c: urls.detail_url(c, urls.STATUTE, base, every=True), twice) is None
    assert value(spark, lambda c: urls.detail_url(c, urls.RULE, base), "admRulReturnSearch('2100000123456')") == f"{base}/admRulInfoP.do?admRulSeq=2100000123456"
    assert value(spark, lambda c: urls.query_value(c, "lsiSeq"), "http://a/b?x=1&lsiSeq=9%20가#z") == "9 가"
    assert value(spark, lambda c: urls.document_id(c, F.lit("Act 12 가"), ("lsiSeq",)), "http://a/b") == "Act12"
    assert value(spark, urls.safe_name, ' a/b:c?"<d>| ') == "abcd"
    assert value(spark, urls.page_counter, "총 (3 / 14)").last == 14
    assert value(spark, lambda c: urls.following_pages(F.lit(1), c, 5), 9, "int") == [2, 3, 4, 5]
    assert value(spark, lambda c: urls.following_pages(F.lit(1), c, 5), 1, "int") == []
    assert value(spark, lambda c: urls.following_pages(F.lit(3), c, 9, from_first=False), 5, "int") == [4, 5]
    for rel, want in [("../x", "http://h/a/../x"), ("/x", "http://h/x"), ("?q", "http://h/a/b?q"), ("//o/x", "http://o/x"), ("", "http://h/a/b?z#f")]:
        assert value(spark, lambda c: urls.absolute(c, F.lit("http://h/a/b?z#f")), rel) == want
    got = spark.range(1).select(urls.case_links(F.array(F.lit("/LSW/precInfoP.do?a=1"), F.lit("/other")), F.array(F.lit("go('precInfoP.do?a=1')")), F.lit("http://h/p")).alias("y")).first().y
    assert got == ["http://h/LSW/precInfoP.do?a=1"]


def test_ids(spark):
    import hashlib

    assert value(spark, ids.blake2s(8), "근로") == hashlib.blake2s("근로".encode(), digest_size=8).hexdigest()
    none = F.lit(None).cast("int")
    assert value(spark, lambda c: ids.logical_key(c, F.lit(None), none, F.lit(3), none, none), "7") == "law:7:None:ch0:art3:para0:item0"
    assert value(spark, lambda c: ids.line_id(c, F.lit(None), none, F.lit(3), none), None) == "law:NA:NA:ch0:art3:para0"
    assert value(spark, lambda c: ids.breadcrumbs(F.lit(1), c, F.lit(2), F.lit("목적"), F.lit(0), F.lit(3)), "총칙") == ["제1장 총칙", "제2조(목적)", "3호"]
    assert int(value(spark, ids.seed_of, "a")) == int(hashlib.sha256(b"a").hexdigest()[:16], 16)


def test_paragraphs_items(spark):
    got = value(spark, segment.paragraphs, "머리\n① 하나\n제2항 둘 \n③ ")
    assert [(r.no, r.text) for r in got] == [(1, "하나"), (2, "둘")]
    assert [(r.no, r.text) for r in value(spark, lambda c: segment.paragraphs(c, True), "머리\n① 하나")] == [(None, "머리"), (1, "하나")]
    assert [(r.no, r.text) for r in value(spark, segment.paragraphs, " 그냥 ")] == [(None, "그냥")]
    assert [(r.no, r.text) for r in value(spark, segment.items, "앞\n 1. 하나\n 나. 둘\n각. 셋")] == [(1, "하나"), (2, "둘"), (None, "셋")]
    assert value(spark, segment.plain_paragraphs, " ") == []


def pack(sents, target=900, most=1400):
    """The packing rule, one sentence at a time."""
    chunks, held = [], None
    for s in sents:
        if held and len(held) + len(s) < target:
            held = f"{held} {s}"
        else:
            if held:
                chunks.append(held[:most])
            held = s
    return chunks + ([held] if held else [])


def overlap(sents, size=1200, carry=200):
    chunks, held = [], []
    weigh = lambda xs: sum(map(len, xs)) + len(xs)
    for s in sents:
        if weigh([*held, s]) <= size:
            held = [*held, s]
        elif held:
            chunks.append(" ".join(held))
            keep = []
            for x in reversed(held):
                if weigh(keep) >= carry:
                    break
                keep.insert(0, x)
            held = [*keep, s]
        else:
            chunks.append(s[:size])
            held = [s[size - carry :]] if len(s) > size else []
    return chunks + ([" ".join(held)] if held else [])


def test_folds_on_random_sentences(spark):
    rng = random.Random(4)
    cases = [["x" * rng.choice([1, 5, 80, 190, 201, 500, 899, 900, 1199, 1200, 1201, 1500, 3000]) for _ in range(rng.randint(0, 12))] for _ in range(120)]
    df = spark.createDataFrame([(c,) for c in cases], "s array<string>")
    got = df.select(chunking.greedy_chunks(F.col("s")).alias("a"), chunking.overlapping_chunks(F.col("s")).alias("b"), "s").collect()
    for r in got:
        assert r.a == pack(r.s)
        assert r.b == overlap(r.s)
    lens = lambda n: [len(x) for x in value(spark, chunking.overlapping_chunks, ["x" * n], "array<string>")]
    assert lens(1199) == [1199] and lens(1200) == [1200] and lens(3000) == [1200, 2000]


def test_sentences(spark):
    assert value(spark, chunking.case_sentences, "가다.나. b! c") == ["가다.", "나.", "b!", "c"]
    assert value(spark, chunking.statute_sentences, "한다. 본다.그대로 말함. 끝") == ["한다.", "본다.그대로 말함.", "끝"]


def sections(raw):
    """Marks in exact order, walked one by one."""
    t = re.sub(r"^[xX]\s*", "", raw.strip()).strip()
    cuts, want = [], 1
    for m in re.finditer(r"\s(\d+)\.\s", t):
        n = int(m[1])
        if n == want:
            cuts.append(m.start())
            want += 1
        elif want > 1 and n > want:
            break
    edges = [0, *cuts, len(t)]
    return [(i, t[a:b].strip()) for i, (a, b) in enumerate(zip(edges, edges[1:])) if i or t[a:b].strip()]


def test_ordered_sections(spark):
    rng = random.Random(9)
    for _ in range(60):
        raw = " ".join(rng.choice(["1. ", "2. ", "3. ", "4. ", "9. ", "2024. 8. 5.", "말", "x"]) for _ in range(rng.randint(0, 14)))
        got = value(spark, segment.ordered_sections, raw)
        assert [r.no for r in got] == [n for n, _ in sections(raw)], raw
    got = value(spark, segment.ordered_sections, "X 머리말 1. 적용 여부 그렇다 2. 지급 방법: 월 4. 남음")
    assert [(r.no, r.title, r.text) for r in got] == [(0, "서문", "머리말"), (1, "1. 적용 여부", "그렇다"), (2, "2. 지급 방법", ": 월 4. 남음")]
