"""Pages, pipelines, queue, input and output, and the worker."""

import random
import tracemalloc
from html.parser import HTMLParser

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexmill import sources
from lexmill.functions import urls
from lexmill.operators import html, queue, segment, vectors
from lexmill.plans import pipelines
from lexmill.streaming import VectorStore, start_worker

BASE = "https://portal.example/doc"
STATUTE = """<html><div id="conTop"><h2> 근로법 </h2></div><div class="ct_sub">[시행 2024. 1. 1.]</div><div id="conScroll">
<div class="pgroup"><p class="gtit">제1장 총칙</p></div>
<div class="pgroup"><span class="bl"><label>제1조(목적)</label></span><p> 이 법은 <a href="#">「민법」</a>을 따른다.<br>둘째 줄</p></div>
<div class="pgroup"><p class="gtit">제2절 무시</p><span class="bl"><label>제10조의2(뜻)</label></span><p>뜻</p></div>
<div class="pgroup"><p>이름 없는 조</p></div></div></html>"""
RULE = """<div id="conTop"><h2>고시</h2></div><div class="pgroup"><p class="gtit">총칙 "가"</p><span class="bl"><label>제3조(범위)</label></span><div class="lawcon"><p>본문 하나</p><p>둘</p></div></div>"""
SECTIONS = """<div id="conTop"><h2>공고</h2></div><div class="lawcon"><p>알림</p><p>Ⅰ. 개요</p><p>가</p><p>나</p><p>Ⅱ. 끝</p></div>"""
CASE = """<h2 data-brl-use="PH/H1">손해배상</h2><div class="subtit1">[대법원 <b>2020</b>]</div><div>
<h4 data-brl-use="PH/H2">【판시사항】</h4><p>첫 쟁점이다.</p><p>둘째</p><span>아님</span><h4 data-brl-use="PH/H2">【전문】</h4><h5>【주문】</h5><p>기각한다.</p><h5>【이유】</h5><p>까닭이다.</p><ul><li>하나</li></ul></div>"""


@pytest.fixture(scope="module")
def lists(spark):
    link = lambda n, d, seq: f"""<a href="#" onclick="lsReturnSearch('','{d}','{seq}')">{n}</a>"""
    rows = [(1, link("근로법", "20230101", 11111) + link("다른/법", "20230101", 22222)), (2, link("근로법", "20240101", 33333) + "<a>없음</a>"), (9, link("먼 법", "20240101", 44444))]
    return spark.createDataFrame(rows, "page_no int, html string")


def test_statute_run(spark, lists):
    config = pipelines.RunConfig(urls.STATUTE, BASE)
    front = {r.name: r.url for r in pipelines.frontier(lists, config).collect()}
    assert front == {"근로법": f"{BASE}/lsInfoP.do?lsiSeq=33333&efYd=20240101", "다른법": f"{BASE}/lsInfoP.do?lsiSeq=22222&efYd=20230101"}
    pages = spark.createDataFrame([(front["근로법"], STATUTE), (front["다른법"], "<p>빈</p>")], "url string, html string")
    documents, chunks = pipelines.statutes(lists, pages, config)
    assert [(r.doc_id, r.title, r.subtitle) for r in documents.collect()] == [("33333", "근로법", "[시행 2024. 1. 1.]")]
    got = {r.chunk_id: r for r in chunks.collect()}
    assert set(got) == {"doc:33333:article_1", "doc:33333:article_102"}
    assert got["doc:33333:article_1"].text == "제1조(목적) 이 법은 「민법」을 따른다.\n둘째 줄"
    assert {r.metadata.chapter for r in got.values()} == {"제1장 총칙"}
    assert html.has_links(lists, urls.STATUTE) and not html.has_links(lists, urls.RULE)


def test_rule_run(spark):
    link = lambda n, seq: f"""<a onclick="admRulReturnSearch('{seq}')">{n}</a>"""
    lists = spark.createDataFrame([(1, link("고시", 11111) + link("공고", 22222) + link("그림", 33333))], "page_no int, html string")
    at = lambda seq: f"{BASE}/admRulInfoP.do?admRulSeq={seq}"
    pages = spark.createDataFrame([(at(11111), RULE), (at(22222), SECTIONS), (at(33333), '<div id="conTop"><h2>그림</h2></div><iframe class="fancybox-iframe"></iframe>')], "url string, html string")
    ocr = spark.createDataFrame([("33333", 2, "둘 2. 지급 방법: 월"), ("33333", 1, "x 머리 1. 대상 여부 모두"), ("33333", 3, "")], "doc_id string, page_no int, text string")
    _, chunks = pipelines.rules(lists, pages, ocr, pipelines.RunConfig(urls.RULE, BASE))
    got = {r.chunk_id: (r.title, r.text, r.metadata.chapter, r.metadata.source_type) for r in chunks.collect()}
    assert got["doc:11111:article_3"] == ("제3조(범위)", "본문 하나\n둘", "총칙 가", None)
    assert got["doc:22222:preamble"] == ("공고", "알림", "공고", None)
    assert got["doc:22222:section_1"] == ("Ⅰ. 개요", "가\n나", "공고", None)
    assert "doc:22222:section_2" not in got
    assert got["doc:33333:section_1_ocr"] == ("1. 대상 여부", "모두\n둘", "그림", "pdf_ocr")
    assert {"doc:33333:preamble_ocr", "doc:33333:section_2_ocr"} <= set(got)


def test_case_run(spark):
    got = pipelines.case_queue(spark.createDataFrame([("http://h/c", CASE)], "url string, html string")).collect()
    assert [(r.chunk_no, r.status, r.title) for r in got] == [(1, "pending", "손해배상")]
    assert got[0].chunk == "손해배상 ([대법원 2020 ]) [판시사항] 첫 쟁점이다. 둘째 [전문] [주문] 기각한다. [이유] 까닭이다. 하나"


def test_rich_chunks(spark):
    body = "연혁\n제1장 총칙\n제1조(목적)\n① 이 법은 「민법」 제2조를 따른다.\n② 다음과 같다.\n1. 하나\n2. 둘째\n3. 셋\n제2조\n그냥 글이다. 더 있다."
    rows = spark.createDataFrame([("http://h/p?lsiSeq=5&efYd=20240101#x", "법", body)], "url string, title string, body string")
    got = {(r.article_no, r.paragraph_no, r.item_no): r for r in pipelines.rich_chunks(rows).collect()}
    assert set(got) == {(1, 1, None), (1, 2, 1), (1, 2, 2), (2, None, None)}
    r = got[1, 1, None]
    assert r.display_text == "제1장 총칙 > 제1조(목적) > 1항 — 이 법은 「민법」 제2조를 따른다." and r.logical_key == "law:5:20240101:ch1:art1:para1:item0"
    assert [(x.law, x.article) for x in r.links_out] == [("민법", 2)] and r.source_url == "http://h/p?lsiSeq=5&efYd=20240101"
    assert got[2, None, None].chapter_no == 1 and got[1, 2, 2].text == "둘째"


def test_statute_articles_prologue(spark):
    rows = [(1, i, t) for i, t in enumerate(["머리", "제1조(가)", "본문", "더", "제2장 끝", "꼬리", "제2조", "글"])]
    df = spark.createDataFrame(rows, "d int, ord int, line string")
    got = {(r.chapter_no, r.article_no): (r.article_title, r.body) for r in segment.statute_articles(df, ["d"], "ord", "line").collect()}
    assert got == {(None, 0): ("서문", "머리"), (None, 1): ("가", "본문\n\n더"), (2, 0): ("서문", "꼬리"), (2, 2): (None, "글")}


def test_dom(spark):
    page = "<div><p>a<p>b<b>c</b><br>d</div><script>var x='</p>'</script><!-- n --><i>&copy;&nbsp;e</i><p>"
    rows = html.nodes_of(page)
    assert [r["tag"] for r in rows] == ["div", "p", "p", "b", "br", "script", "i", "p"]
    assert rows[0]["text"].split("\n") == ["a", "b", "c", "d"] and rows[5]["text"] == "" and rows[6]["text"] == "© e"
    assert html.nodes_of(None) == [] == html.nodes_of(" \n")
    assert [(r["tag"], r["depth"], r["text"]) for r in html.nodes_of("plain text <b>x</b> tail<div>d</div>")] == [("p", 0, "plain text\nx\ntail"), ("b", 1, "x"), ("div", 0, "d")]
    lists = html.nodes_of("<ul><li>a<ul><li>b</ul><li>c</ul><dl><dt>L<dd>v<dt>M</dl><table><tr><th>h<td>d<tr><td>e<table><tr><td>f</table><td>g</table><select><option>x<option>y</select>")
    assert [(r["tag"], r["depth"]) for r in lists] == [
        ("ul", 0), ("li", 1), ("ul", 2), ("li", 3), ("li", 1), ("dl", 0), ("dt", 1), ("dd", 1), ("dt", 1), ("table", 0), ("tr", 1), ("th", 2), ("td", 2), ("tr", 1), ("td", 2), ("table", 3), ("tr", 4), ("td", 5), ("td", 2), ("select", 0), ("option", 1), ("option", 1),
    ]
    table = "<dl><dt>사건</dt><dd>가</dd></dl><table><tr><th>선고 일</th><td>나</td></tr></table><h4>법원</h4><p>다</p><p title='판사 이름'>라</p>"
    df = spark.createDataFrame([(table,)], "h string").select(html.parse(F.col("h")).alias("nodes"))
    got = df.select(*(html.labelled_block(F.col("nodes"), x).alias(x) for x in ("사건", "선고", "법원", "판사", "없음"))).first()
    assert tuple(got) == ("가", "나", "다", "라", "")


def test_pages_of_many_groups_take_time_in_proportion(spark):
    import time

    def page(n):
        groups = "".join(f'<div class="pgroup">{"<p class=gtit>제%d장 총칙</p>" % (i // 20 + 1) if i % 20 == 0 else ""}<span class="bl"><label>제{i + 1}조(목적)</label></span><div class="lawcon"><p>가 <a>나</a> {i}<br>다</p></div></div>' for i in range(n))
        sections = "".join(f"<p>Ⅰ. x{i}</p><p>a</p><p>b</p>" for i in range(n))
        return [("statute", f'<div id="conTop"><h2>법</h2></div><div id="conScroll">{groups}</div>'), ("sections", f'<div id="conTop"><h2>법</h2></div><div class="lawcon">{sections}</div>')]

    def run(n):
        df = spark.createDataFrame(page(n), "url string, html string")
        began = time.time()
        headers = html.document_header(df, urls.STATUTE)
        counts = [f(headers.where(F.col("source_url") == kind)).count() for f, kind in ((html.statute_chunks, "statute"), (html.rule_chunks, "statute"), (html.section_chunks, "sections"))]
        assert counts == [n, n, n]
        return time.time() - began

    run(100)
    assert run(1600) < min(15, 4.5 * max(2.0, run(400)))


def test_groups_within_groups_and_chapters_after_the_first(spark):
    page = """<div id="conTop"><h2>법</h2></div><div id="conScroll"><div class="pgroup"><span class="bl"><label>제1조</label></span>a<div class="pgroup"><p class="gtit">제2장 안</p><span class="bl"><label>제2조</label></span>b</div></div>
<div class="pgroup"><span class="bl"><i>x</i></span><span class="bl"><label>제3조</label></span>c</div></div><div class="pgroup"><span class="bl"><label>제4조</label></span></div>"""
    df = spark.createDataFrame([("https://h/x?lsiSeq=1&efYd=2", page)], "url string, html string")
    got = [(r.title, r.metadata.chapter) for r in html.statute_chunks(html.document_header(df, urls.STATUTE)).collect()]
    assert got == [("제1조", "제2장 안"), ("제2조", "제2장 안"), ("제3조", "제2장 안")]
    nodes = spark.createDataFrame([("<div><p>a<b>x</b></p><p>b</p></div><p>c</p><p>d</p>",)], "h string").select(html.parse(F.col("h")).alias("n"))
    at = lambda i: F.get("n", i)
    told = lambda c: F.transform(c, lambda x: x["ord"])
    row = nodes.select(told(html.below(F.col("n"), at(0))), told(html.children(F.col("n"), at(0))), told(html.following(F.col("n"), at(0))), told(html.following(F.col("n"), at(1))), told(html.below(F.col("n"), at(5)))).first()
    assert list(map(list, row)) == [[1, 2, 3], [1, 3], [4, 5], [3], []]


def test_entities_are_those_of_the_standard_library(spark):
    import html as library
    from html.entities import html5

    from lexmill.functions.text import unescape

    texts = [f"a&{name} b&{name.rstrip(';')}c" for name in html5] + ["&#8217;&#x2019;&#0;&#128;&#xD800;&#1114112;", "&nosuch; & &; &#; &#x;", "", "plain"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    got = dict(df.select("i", unescape("t").alias("u")).collect())
    assert [got[i] for i in range(len(texts))] == [library.unescape(t) for t in texts] and got[len(texts)] is None


def test_chunks_of_long_texts_take_time_in_proportion(spark):
    import time

    from lexmill.operators import chunking

    def run(n):
        df = spark.createDataFrame([(" ".join(f"sentence number {i} of a long text." for i in range(n)),)], "t string")
        began = time.time()
        for pack in (chunking.greedy_chunks, chunking.overlapping_chunks):
            df.select(F.size(pack(chunking.case_sentences(F.col("t"))))).collect()
        return time.time() - began

    run(100)
    assert run(64_000) < 8 * max(0.5, run(16_000))


def test_rows_are_numbered_in_order(spark):
    rows = [(i * 7 % 1000, "x") for i in range(1000)]
    got = sources.numbered(spark.createDataFrame(rows, "k long, v string").repartition(5), ["k"], after=10).collect()
    assert sorted((r.k, r.id) for r in got) == [(k, k + 11) for k in range(1000)]
    assert sources.numbered(spark.createDataFrame([], "k long"), ["k"]).count() == 0


def test_files(spark, tmp_path):
    rows = [("c1", "d1", '말 "따옴"\n둘', "글, 쉼표", ("장", None), "u"), ("c2", "d1", None, "", ("장", "pdf_ocr"), "u")]
    df = spark.createDataFrame(rows, sources.CHUNK)
    sources.write_jsonl(df, f"{tmp_path}/j")
    assert sorted(sources.read_jsonl(spark, f"{tmp_path}/j", sources.CHUNK).collect()) == sorted(df.collect())
    assert sources.write_csv(df.coalesce(1), f"{tmp_path}/c")
    raw = next((tmp_path / "c").glob("part*.csv")).read_bytes()
    assert raw.startswith(b"\xef\xbb\xbfchunk_id,doc_id,title,text,metadata.chapter,metadata.source_type,source_url") and b'""' in raw
    back = sources.read_csv(spark, f"{tmp_path}/c")
    assert back.columns[0] == "chunk_id" and back.where("chunk_id = 'c1'").first()["title"] == rows[0][2]
    assert not sources.write_csv(df.limit(0), f"{tmp_path}/none") and not (tmp_path / "none").exists()
    (tmp_path / "bad.jsonl").write_text('{"name": "a", "url": "u"}\nㅎ{"name": "b"}\n', encoding="utf-8")
    bad = sources.read_jsonl(spark, f"{tmp_path}/bad.jsonl", sources.URL_ENTRY, strict=False).cache()
    assert [(r.name, r._corrupt_record) for r in bad.collect()] == [("a", None), (None, 'ㅎ{"name": "b"}')]
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        sources.read_jsonl(spark, f"{tmp_path}/bad.jsonl", sources.URL_ENTRY).collect()
    good = sources.quarantine(bad.select("name", "url"), F.col("name").isNull(), f"{tmp_path}/q")
    assert good.count() == 1 and spark.read.parquet(f"{tmp_path}/q").count() == 1
    kinds = spark.createDataFrame([("document", 1), ("chunk", 2)], "kind string, v int")
    sources.routed(kinds, f"{tmp_path}/r")
    assert sorted(p.name for p in (tmp_path / "r").glob("kind=*")) == ["kind=chunk", "kind=document"]
    names = spark.createDataFrame([("b",), ("가",), ("a_1",), ("a",)], "name string")
    assert [r.name for r in sources.merged(names).collect()] == sorted(["b", "가", "a_1", "a"], key=lambda n: (n + "_document.jsonl").encode())
    response = spark.createDataFrame([('{"images":[{"fields":[{"inferText":"가"},{"inferText":"나"}]}]}',)], "r string")
    assert response.select(sources.field_text(F.col("r")).alias("t")).first().t == "가 나"


def test_top_similar_in_blocks(spark):
    """More queries than one block holds are all answered, as in one block."""
    rng = random.Random(4)
    df = spark.createDataFrame([(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(60)] + [(60, None)], "id long, v array<double>")
    asked = df.select((F.col("id") * 7 - 100).alias("query_id"), F.col("v").alias("q"))
    rows = lambda n: sorted(tuple(r)[:3] for r in vectors.top_similar(asked, df, 3, n).collect())
    assert len(rows(1_000)) == 180 and rows(1_000) == rows(60) == rows(13)
    assert vectors.top_similar(asked.limit(0), df, 3, 13).count() == 0


def test_vectors(spark):
    embed = vectors.stub_backend(5)
    import hashlib

    draw = random.Random(int(hashlib.sha256(b"abc").hexdigest()[:16], 16))
    raw = [draw.uniform(-1, 1) for _ in range(5)]
    length = sum(x * x for x in raw) ** 0.5
    assert embed(["abc"])[0] == [x / length for x in raw]
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    assert [r.u for r in df.select(vectors.unit(F.col("v")).alias("u")).collect()] == [[0.6, 0.8], [0.0, 0.0]]
    with pytest.raises(Exception, match="dimensions"):
        df.select(vectors.checked(F.col("v"), 3)).collect()
    one = spark.createDataFrame([([0.123456785, -1.0],)], "v array<double>")
    assert one.select(vectors.literal(F.col("v")).alias("l")).first().l == "[" + ",".join(f"{x:.8f}" for x in (0.123456785, -1.0)) + "]"
    tries, waits = [], []

    def flaky(texts):
        tries.append(texts)
        if len(tries) < 4:
            raise OSError("later")
        return [[1.0]]

    assert vectors.with_retry(flaky, vectors.EmbedConfig(), waits.append)(["t"]) == [[1.0]]
    assert len(waits) == 3 and 1.5 <= waits[0] < 2.5 and 6 <= waits[2] < 7
    with pytest.raises(OSError):
        vectors.with_retry(lambda t: (_ for _ in ()).throw(OSError("never")), vectors.EmbedConfig(attempts=3), waits.append)(["t"])
    assert len(waits) == 5 and max(vectors.waits(vectors.EmbedConfig())) < 31
    assert vectors.probed_dim(lambda: embed, 5) == 5 == vectors.probed_dim(lambda: embed, 0)
    with pytest.raises(ValueError, match="dimensions"):
        vectors.probed_dim(lambda: embed, 6)


def test_worker_is_idempotent(spark, tmp_path):
    rows = [(i, "u", "t", "s", 1, f"text {i}", "pending" if i % 3 else "done", None, None, None) for i in range(12)]
    spark.createDataFrame(rows, sources.QUEUE).repartition(3).write.parquet(f"{tmp_path}/queue")
    config = vectors.EmbedConfig(dim=4)
    run = lambda: start_worker(spark, f"{tmp_path}/queue", f"{tmp_path}/store", f"{tmp_path}/ck", lambda: vectors.stub_backend(4), config, files=1)
    run().awaitTermination()
    store = VectorStore(spark, f"{tmp_path}/store")
    first = sorted((r.queue_id, tuple(r.vector)) for r in store.read().collect())
    assert [k for k, _ in first] == [i for i in range(12) if i % 3]
    spark.createDataFrame([(1, "u", "t", "s", 9, "new text", "pending", None, None, None)], sources.QUEUE).write.mode("append").parquet(f"{tmp_path}/queue")
    run().awaitTermination()
    second = {r.queue_id: (r.chunk_no, tuple(r.vector)) for r in store.read().collect()}
    assert len(second) == len(first) and second[1][0] == 1 and second[1][1] != dict(first)[1] and second[2][1] == dict(first)[2]


def test_two_workers_share_a_queue_and_mark_it(spark, tmp_path):
    """Each of two workers takes its share of the ids, and failures end as errors with their message."""
    rows = [(i, "u", "t", "s", 1, "bad" if i % 5 == 0 else f"text {i}", "pending", None, None, None) for i in range(40)]
    queue_rows = spark.createDataFrame(rows, sources.QUEUE)
    queue_rows.repartition(3).write.parquet(f"{tmp_path}/queue")

    def backend():
        embed = vectors.stub_backend(4)

        def checked(texts):
            if "bad" in texts:
                raise ValueError("bad text")
            return embed(texts)

        return checked

    config = vectors.EmbedConfig(dim=4, batch=1, attempts=1)
    for k in range(2):
        start_worker(spark, f"{tmp_path}/queue", f"{tmp_path}/store{k}", f"{tmp_path}/ck{k}", backend, config, files=1, worker=k, workers=2).awaitTermination()
    stores = [VectorStore(spark, f"{tmp_path}/store{k}") for k in range(2)]
    ids = [{r.queue_id for r in s.read().collect()} for s in stores]
    assert not ids[0] & ids[1] and ids[0] | ids[1] == {i for i in range(40) if i % 5} and all(ids)
    after = stores[1].marked(stores[0].marked(queue_rows)).collect()
    assert {r.id: (r.status, r.error) for r in after} == {i: ("done", None) if i % 5 else ("error", "bad text") for i in range(40)}
    assert all(r.updated_at is not None for r in after) and VectorStore(spark, f"{tmp_path}/none").read().count() == 0


def test_queue_states(spark):
    q = spark.createDataFrame([(1, "pending"), (2, "done"), (3, "pending")], "id long, status string")
    taken, after = queue.claim(q, 1)
    shares = [{r.id for r in queue.claimable(q, 10, k, 2).collect()} for k in range(2)]
    assert shares[0] | shares[1] == {1, 3} and not shares[0] & shares[1]
    assert [r.id for r in taken.collect()] == [1] and {r.id: r.status for r in after.collect()} == {1: "working", 2: "done", 3: "pending"}


def test_a_worker_holds_the_nodes_of_few_pages(monkeypatch):
    found = []
    monkeypatch.setattr(html, "arrow_udf", lambda kind: lambda f: found.append(f) or (lambda c: c))
    html.parse(F.lit(""), "text", "flat")
    body = "".join(f'<div class="pgroup"><p class="gtit">part {i}</p><div class="lawcon"><p>a</p><p>{i}</p></div></div>' for i in range(30))
    pages = [None, "", *[f"<h2>{k}</h2>{body}" for k in range(1500)], f"<h2>long</h2>{body * 40}", None, "<p>x</p>"]
    got, most = [], 0
    tracemalloc.start()
    for nodes in found[0](iter([pa.array(pages[:700]), pa.array([], pa.string()), pa.array(pages, pa.large_string())[700:]])):
        most = max(most, tracemalloc.get_traced_memory()[1])
        got += [len(x) for x in nodes]
    tracemalloc.stop()
    assert got == [len(html.nodes_of(p)) for p in pages]
    assert most < 25_000_000  # 1,500 pages of 151 nodes take 200 MB as rows in Python


def test_pages_of_any_length_keep_their_places(spark):
    pages = [(i, None if i % 97 == 0 else f"<p>{i}</p>" * (1 + 20_000 * (i % 301 == 0))) for i in range(3000)]
    df = spark.createDataFrame(pages, "i int, h string").repartition(2)
    rows = df.select("i", html.parse(F.col("h"), "text").alias("n")).select("i", F.size("n").alias("n"), F.get("n", 0)["text"].alias("first"), F.get("n", F.size("n") - 1)["text"].alias("last")).collect()
    assert sorted((r.i, r.n, r.first, r.last) for r in rows) == [(i, 0 if h is None else h.count("<p>"), *[None if h is None else str(i)] * 2) for i, h in pages]


def test_plain_tags_are_read_as_the_tokenizer_reads_them(monkeypatch):
    pieces = [
        "<p>", "</p>", "<br>", "<br/>", '<div class="a b">', '<DIV Class="X">', "</div>", "</ div>", "<script>", "</script>", "<title>", "</title>", "<li>", "<ul>", "</ul>", "<td>", "<tr>", "<table>", "</table>", '<a href="x&amp;y">', '<a b="x>y" c="<z">', "<a b=c>", "<a b>", '<a b="">',
        '<a  b="c">', '<a b="c" b="d">', '<a b="c"d="e">', '<img src="q" />', "</a>", "</>", "<!-- c -->", "<!-- c", "<!DOCTYPE html>", "&amp;", "&", "&lt", "<", ">", '"', "text ", " ", "\n", "가", '<a\nb="c">', "<o:p>", '<x-y a-b="1">', "<p", '<a b="c', "\0",
    ]
    rng = random.Random(8)
    pages = ["".join(rng.choices(pieces, k=rng.randrange(30))) for _ in range(3000)]
    fast = [html.nodes_of(p) for p in pages]
    for name in ("goahead", "parse_starttag", "parse_endtag", "updatepos"):
        monkeypatch.setattr(html._Nodes, name, getattr(HTMLParser, name))
    assert fast == [html.nodes_of(p) for p in pages]


def test_statute_pages_are_parsed_once(spark):
    group = '<div class="pgroup"><span class="bl"><label>제1조(가)</label></span><p>x</p></div>'
    bodies = [f"<h2>none</h2>{group}", None, '<div id="conScroll"></div>', f'<div id="conScroll">{group}</div><div class="law-view-content">{group}</div>']
    pages = spark.createDataFrame([(f"https://h/x?lsiSeq={i}", b) for i, b in enumerate(bodies)], "url string, html string")
    chunks = html.statute_chunks(html.document_header(pages, urls.STATUTE))
    assert [(r.chunk_id, r.text, r.metadata.chapter) for r in chunks.collect()] == [("doc:3:article_1", "제1조(가)x", "")]
    assert chunks._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
