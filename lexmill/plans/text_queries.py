"""Queries over ``documents`` and ``conversations``: cleaning, segmentation, sentences, chunks, ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill import sources
from lexmill.catalog import Catalog, table
from lexmill.functions import ids, text
from lexmill.functions.numbering import mark_number
from lexmill.operators import chunking, segment
from lexmill.operators.queue import first_of_signature

CATALOG = Catalog()

SENTENCES = r"""
s AS (
  SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?])[ \t\n\r]+', '\1' || chr(10), 'g'), chr(10)),
    lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '') AS sents
  FROM documents
)"""


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


GREEDY = f"""
WITH {SENTENCES}, f AS (
  SELECT doc_id, list_reduce(sents, lambda a, x: CASE
    WHEN a.cur = '' THEN {{'out': a.out, 'cur': x}}
    WHEN length(a.cur) + 1 + length(x) <= 900 THEN {{'out': a.out, 'cur': a.cur || ' ' || x}}
    ELSE {{'out': list_append(a.out, left(a.cur, 1400)), 'cur': x}} END, {{'out': []::VARCHAR[], 'cur': ''}}) AS st
  FROM s
), c AS (SELECT doc_id, CASE WHEN st.cur = '' THEN st.out ELSE list_append(st.out, st.cur) END AS chunks FROM f)
SELECT doc_id, CAST(unnest(range(1, len(chunks) + 1)) AS INTEGER) AS chunk_no, unnest(chunks) AS chunk FROM c
"""


@CATALOG.add("flagship_sentence_chunks", GREEDY)
def flagship_sentence_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences packed greedily and numbered: one narrow stage."""
    chunks = chunking.numbered(chunking.greedy_chunks(chunking.ascii_sentences(F.col("text"))))
    return _documents(spark, sf_dir).select("doc_id", F.inline(chunks))


@CATALOG.add(
    "greedy_rechunk",
    f"""
WITH chunks AS ({GREEDY})
SELECT doc_id, count(*) AS n_chunks, CAST(sum(length(chunk)) AS BIGINT) AS n_chars, CAST(max(length(chunk)) AS BIGINT) AS longest FROM chunks GROUP BY doc_id
""",
)
def greedy_rechunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("chunk").cast("long")
    return flagship_sentence_chunks(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("n_chunks"), F.sum(n).alias("n_chars"), F.max(n).alias("longest"))


@CATALOG.add("sentence_split", f"WITH {SENTENCES} SELECT doc_id, CAST(len(sents) AS INTEGER) AS n_sentences, md5(array_to_string(sents, chr(10))) AS digest FROM s")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    sents = chunking.ascii_sentences(F.col("text"))
    return _documents(spark, sf_dir).withColumn("sents", sents).select("doc_id", F.size("sents").alias("n_sentences"), F.md5(F.array_join("sents", "\n")).alias("digest"))


LINE_SQL = r"trim(regexp_replace(replace(coalesce(text, ''), chr(160), ' '), '[ \t\n\r\f\v]+', ' ', 'g'), ' ')"
WEIGHT = "coalesce(list_sum(list_transform({}, lambda y: length(y) + 1)), 0)"
OVERLAP = rf"""
WITH s AS (
  SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace({LINE_SQL}, '(다\.)[ ]*', '\1' || chr(10), 'g'), '([.!?])[ ]+', '\1' || chr(10), 'g'), chr(10)),
    lambda x: trim(x)), lambda x: x <> '') AS sents FROM documents
), f AS (
  SELECT doc_id, list_reduce(sents, lambda a, x: CASE
    WHEN {WEIGHT.format('a.cur')} + length(x) + 1 <= 1200 THEN {{'out': a.out, 'cur': list_append(a.cur, x)}}
    WHEN len(a.cur) > 0 THEN {{'out': list_append(a.out, array_to_string(a.cur, ' ')),
      'cur': list_append(list_reduce(list_reverse(a.cur), lambda c, z: CASE WHEN {WEIGHT.format('c')} < 200 THEN list_prepend(z, c) ELSE c END, []::VARCHAR[]), x)}}
    ELSE {{'out': list_append(a.out, left(x, 1200)), 'cur': CASE WHEN length(x) > 1200 THEN [substring(x, 1001)] ELSE []::VARCHAR[] END}} END,
    {{'out': []::VARCHAR[], 'cur': []::VARCHAR[]}}) AS st FROM s
), c AS (SELECT doc_id, CASE WHEN len(st.cur) = 0 THEN st.out ELSE list_append(st.out, array_to_string(st.cur, ' ')) END AS chunks FROM f)
SELECT doc_id, CAST(unnest(range(1, len(chunks) + 1)) AS INTEGER) AS chunk_no, unnest(chunks) AS chunk FROM c
"""


@CATALOG.add("overlap_chunks", OVERLAP)
def overlap_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping chunks of whole texts."""
    body = text.clean_line(F.col("text"), entities=False)
    return _documents(spark, sf_dir).select("doc_id", F.inline(chunking.numbered(chunking.overlapping_chunks(chunking.case_sentences(body)))))


STATUTE_CHUNKS = GREEDY.replace("'([.!?])[ \\t\\n\\r]+'", r"'([.!?]|(?:다|니다|요|함|됨|바)\.)[ \t\n\r\f\v]+'")


@CATALOG.add("statute_rechunk", STATUTE_CHUNKS)
def statute_rechunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", F.inline(chunking.numbered(chunking.greedy_chunks(chunking.statute_sentences(F.col("text"))))))


@CATALOG.add(
    "text_variants",
    r"""SELECT doc_id, regexp_replace(coalesce(text, ''), '\n[ \t\n\r\f\v]*\n', chr(10), 'g') AS without_blank_lines, trim(replace(coalesce(text, ''), chr(160), ' '), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS embed_text,
  CASE WHEN doc_id % 2 = 0 THEN source END AS short_title, CASE WHEN doc_id % 3 = 0 THEN '고용노동부' END AS ministry FROM documents""",
)
def text_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    page = F.when(d % 2 == 0, F.concat(F.lit("<h2>x (약칭: "), "source", F.lit(")</h2>"))).otherwise("<h2>x</h2>")
    subtitle = F.when(d % 3 == 0, F.lit("고용노동부 고시")).otherwise("none")
    return _documents(spark, sf_dir).select("doc_id", text.blank_lines_gone(F.col("text")).alias("without_blank_lines"), text.embed_text(F.col("text")).alias("embed_text"), text.short_title(page).alias("short_title"), text.ministry(subtitle).alias("ministry"))


@CATALOG.add("clean_inline", r"SELECT doc_id, trim(regexp_replace(regexp_replace(replace(coalesce(text, ''), chr(160), ' '), '(?i)&nbsp;', ' ', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'), ' ') AS clean FROM documents")
def clean_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", text.clean_line(F.col("text")).alias("clean"))


BLOCK_SQL = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(coalesce(text, ''), chr(160), ' '), '(?i)&nbsp;', ' ', 'g'), '[ \t]+', ' ', 'g'), '[ \t]*\n[ \t]*', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g')"
WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@CATALOG.add("clean_block", f"SELECT doc_id, trim({BLOCK_SQL}, {WHITE}) AS clean FROM documents")
def clean_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", text.clean_block(F.col("text")).alias("clean"))


@CATALOG.add("clean_statute_block", f"SELECT doc_id, trim(translate({BLOCK_SQL}, '［］（）', '[]()'), {WHITE}) AS clean FROM documents")
def clean_statute_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", text.clean_statute(F.col("text")).alias("clean"))


@CATALOG.add("clean_spaces_rule", rf"SELECT doc_id, trim(regexp_replace(regexp_replace(replace(replace(coalesce(text, ''), chr(160), ' '), '\"', ''), '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), {WHITE}) AS clean FROM documents".replace('\\"', '"'))
def clean_spaces_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", text.clean_spaces(F.col("text"), quotes=False).alias("clean"))


@CATALOG.add(
    "strip_brackets",
    """SELECT doc_id, v AS variant, CASE WHEN v = 'outer' THEN source ELSE source END AS inner_text FROM documents, (VALUES ('outer'), ('single')) t(v)""",
)
def strip_brackets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``[source]`` loses its outer brackets, ``so[urce]`` its only pair."""
    source = F.col("source")
    outer = text.unwrap_brackets(F.concat(F.lit(" ["), source, F.lit("] ")))
    single = text.drop_brackets(F.concat(F.left(source, F.lit(2)), F.lit("["), F.substring(source, F.lit(3), F.length(source)), F.lit("]")))
    rows = F.array(F.struct(F.lit("outer").alias("variant"), outer.alias("inner_text")), F.struct(F.lit("single").alias("variant"), single.alias("inner_text")))
    return _documents(spark, sf_dir).select("doc_id", F.inline(rows))


@CATALOG.add(
    "line_normalize",
    f"SELECT doc_id, coalesce(array_to_string(list_filter(list_transform(string_split(replace(coalesce(text, ''), chr(13), chr(10)), chr(10)), lambda x: trim(x, {WHITE})), lambda x: x <> ''), chr(10)), '') AS clean FROM documents",
)
def line_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", text.normal_lines(F.col("text")).alias("clean"))


@CATALOG.add(
    "noise_filter",
    f"""
WITH l AS (SELECT doc_id, trim(unnest(string_split(coalesce(text, ''), chr(10))), {WHITE}) AS line FROM documents)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE line = '' OR line IN ('판례', '연혁', '위임행정규칙', '규제', '생활법령', '한눈보기')
  OR (length(line) <= 2 AND NOT regexp_matches(line, '[0-9]')) OR regexp_matches(line, '[0-9]{{2,3}}-[0-9]{{3,4}}-[0-9]{{4}}')
  OR regexp_full_match(line, '[▷▶◀◁■□●○–—•·*-]+')) AS BIGINT) AS n_noise
FROM l GROUP BY doc_id
""",
)
def noise_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _documents(spark, sf_dir).select("doc_id", F.explode(F.split(text.text_of(F.col("text")), "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(text.is_noise(F.col("line")).cast("long")).alias("n_noise"))


@CATALOG.add("token_estimate", "SELECT doc_id, CAST(greatest(1, floor(length(coalesce(text, '')) / 2.5)) AS INTEGER) AS tokens FROM documents")
def token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", text.token_estimate(F.col("text")).alias("tokens"))


@CATALOG.add(
    "crossref_extract",
    r"""
WITH t AS (SELECT doc_id, '「 ' || source || ' 」 제' || CAST(n_chars % 90 + 1 AS VARCHAR) || ' 조 ' || lang || ' 「' || lang || '」제7조' AS t FROM documents),
r AS (SELECT doc_id, regexp_extract_all(t, '「[ ]*([^」]+?)[ ]*」[ ]*제[ ]*([0-9]+)[ ]*조', 1) AS laws, regexp_extract_all(t, '「[ ]*([^」]+?)[ ]*」[ ]*제[ ]*([0-9]+)[ ]*조', 2) AS articles FROM t)
SELECT doc_id, unnest(laws) AS law, CAST(unnest(articles) AS INTEGER) AS article FROM r
""",
)
def crossref_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges of a citation graph: statutes and articles a text cites."""
    cited = F.concat(F.lit("「 "), "source", F.lit(" 」 제"), (F.col("n_chars") % 90 + 1).cast("string"), F.lit(" 조 "), "lang", F.lit(" 「"), "lang", F.lit("」제7조"))
    return _documents(spark, sf_dir).select("doc_id", F.inline(text.references(cited)))


@CATALOG.add("text_md5", "SELECT doc_id, md5(coalesce(text, '')) AS digest FROM documents")
def text_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"))


@CATALOG.add("content_hash", "SELECT doc_id, sha256(coalesce(text, '')) AS content_hash FROM documents")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", ids.content_hash(F.col("text")).alias("content_hash"))


@CATALOG.add("blake2s_ids")
def blake2s_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests no SQL dialect has; tested against the standard library."""
    return _documents(spark, sf_dir).select("doc_id", ids.blake2s(8)(F.coalesce("text", F.lit(""))).alias("digest"), ids.blake2s(4)(F.coalesce("text", F.lit(""))).alias("revision"))


@CATALOG.add(
    "chunk_ids_sha",
    f"""
WITH chunks AS ({GREEDY})
SELECT doc_id, chunk_no, 'law:' || doc_id || ':None:ch0:art' || chunk_no || ':para0:item0:' || left(sha256(chunk), 8) AS chunk_id FROM chunks
""",
)
def chunk_ids_sha(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("int")
    key = ids.logical_key(F.col("doc_id"), F.lit(None), none, F.col("chunk_no"), none, none)
    return flagship_sentence_chunks(spark, sf_dir).select("doc_id", "chunk_no", F.concat(key, F.lit(":"), F.left(F.sha2("chunk", 256), F.lit(8))).alias("chunk_id"))


@CATALOG.add(
    "dedup_signature",
    f"""
WITH chunks AS ({GREEDY}), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, sha256(chunk) ORDER BY chunk_no) AS rn FROM chunks)
SELECT doc_id, chunk_no, chunk FROM r WHERE rn = 1
""",
)
def dedup_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed = flagship_sentence_chunks(spark, sf_dir).withColumn("signature", F.sha2("chunk", 256))
    return first_of_signature(signed, ["doc_id", "signature"], "chunk_no").drop("signature")


@CATALOG.add("stub_seed", "SELECT doc_id, CAST(('0x' || left(sha256(coalesce(text, '')), 15)) AS BIGINT) AS seed FROM documents")
def stub_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """60 bits of the seed, which fit both engines' integers (the full seed has 64)."""
    return _documents(spark, sf_dir).select("doc_id", F.floor(ids.seed_of(F.coalesce("text", F.lit(""))) / 16).cast("long").alias("seed"))


LINES_SQL = "l AS (SELECT doc_id, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS ord, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", F.posexplode(F.split(text.text_of(F.col("text")), "\n")).alias("ord", "line"))


@CATALOG.add(
    "line_spans_lead",
    f"""
WITH {LINES_SQL}, m AS (SELECT *, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM l),
h AS (SELECT m.doc_id, start, coalesce(lead(start) OVER (PARTITION BY m.doc_id ORDER BY start), length(coalesce(text, ''))) AS "end" FROM m JOIN documents d ON d.doc_id = m.doc_id WHERE length(line) < 12)
SELECT doc_id, start, CAST("end" AS BIGINT) AS "end" FROM h
""",
)
def line_spans_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short lines as marks: each span goes to the next mark or the end of the text."""
    value = F.col("text")
    lines = F.split(text.text_of(value), "\n")
    marks = _documents(spark, sf_dir).select("doc_id", F.length(text.text_of(value)).cast("long").alias("size"), F.posexplode(lines).alias("ord", "line"))
    w = segment.Window.partitionBy("doc_id").orderBy("ord").rowsBetween(segment.Window.unboundedPreceding, -1)
    placed = marks.withColumn("start", F.coalesce(F.sum(F.length("line") + 1).over(w), F.lit(0)).cast("long")).where(F.length("line") < 12)
    return segment.spans(placed, ["doc_id"], "start", F.col("size")).select("doc_id", "start", "end")


@CATALOG.add(
    "carry_forward",
    f"""
WITH {LINES_SQL}
SELECT doc_id, CAST(ord AS INTEGER) AS ord, last_value(CASE WHEN length(line) < 12 THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading FROM l
""",
)
def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    heading = F.when(F.length("line") < 12, F.col("line"))
    return segment.carry_forward(_lines(spark, sf_dir), ["doc_id"], ["ord"], heading, "heading").select("doc_id", "ord", "heading")


@CATALOG.add(
    "heading_asof",
    f"""
WITH {LINES_SQL}, h AS (SELECT doc_id, ord AS at, line AS heading FROM l WHERE length(line) < 12), b AS (SELECT doc_id, ord AS at, length(line) AS n FROM l WHERE length(line) >= 12)
SELECT b.doc_id, CAST(b.at AS INTEGER) AS at, CAST(b.n AS INTEGER) AS n, h.heading FROM b ASOF LEFT JOIN h ON b.doc_id = h.doc_id AND b.at >= h.at
""",
)
def heading_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backward as-of join of long lines to the short line before them."""
    lines = _lines(spark, sf_dir)
    heads = lines.where(F.length("line") < 12).select("doc_id", F.col("ord").alias("at"), F.col("line").alias("heading"))
    rows = lines.where(F.length("line") >= 12).select("doc_id", F.col("ord").alias("at"), F.length("line").alias("n"))
    return segment.as_of(rows, heads, ["doc_id"], "at", ["heading"])


@CATALOG.add(
    "sessionize_sections",
    f"""
WITH {LINES_SQL}, g AS (SELECT *, CAST(sum(CASE WHEN length(line) < 12 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ord) AS INTEGER) AS section FROM l)
SELECT doc_id, section, string_agg(line, chr(10) ORDER BY ord) AS body FROM g GROUP BY doc_id, section
""",
)
def sessionize_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = segment.sessions(_lines(spark, sf_dir), ["doc_id"], ["ord"], F.length("line") < 12)
    return segment.joined_text(marked, ["doc_id", "section"], "ord", "line", "\n", "body")


SECTIONS_SQL = r"""
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, trim(array_to_string(list_transform(range(1, len(ls) + 1), lambda i: ' ' || ((i - 1) % 7 + 1) || '. ' || ls[i]), chr(10)), {white}) AS t FROM t),
p AS (SELECT doc_id, string_split(regexp_replace(t, '[ \t\n\r\f\v]([0-9]+)\.[ \t\n\r\f\v]', chr(1) || '\0', 'g'), chr(1)) AS ps FROM l),
f AS (
  SELECT doc_id, list_reduce(ps, lambda s, x: CASE
    WHEN NOT s.over AND coalesce(TRY_CAST(nullif(regexp_extract(x, '^[ \t\n\r\f\v]([0-9]+)\.[ \t\n\r\f\v]', 1), '') AS BIGINT), -1) = s.next THEN {{'next': s.next + 1, 'over': false, 'out': list_append(s.out, x)}}
    ELSE {{'next': s.next, 'over': s.over OR (s.next > 1 AND coalesce(TRY_CAST(nullif(regexp_extract(x, '^[ \t\n\r\f\v]([0-9]+)\.[ \t\n\r\f\v]', 1), '') AS BIGINT), -1) > s.next),
      'out': list_append(s.out[:-2], s.out[-1] || x)}} END, {{'next': CAST(1 AS BIGINT), 'over': false, 'out': ['']}}) AS st FROM p
), o AS (SELECT doc_id, unnest(range(len(st.out))) AS no, trim(unnest(st.out), {white}) AS x FROM f),
c AS (SELECT doc_id, CAST(no AS INTEGER) AS no, CASE WHEN no = 0 THEN '서문' ELSE {clean} END AS title, CASE WHEN no = 0 THEN {clean} ELSE '' END AS text FROM o)
SELECT * FROM c WHERE no > 0 OR text <> ''
""".format(white=WHITE, clean=f"trim(regexp_replace(regexp_replace(replace(replace(x, chr(160), ' '), chr(34), ''), '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), {WHITE})")


@CATALOG.add("sequence_sections", SECTIONS_SQL)
def sequence_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections ``1. 2. 3.`` in exact order; the lines of each text are numbered first."""
    listed = F.array_join(F.transform(F.split(text.text_of(F.col("text")), "\n"), lambda x, i: F.concat(F.lit(" "), ((i % 7) + 1).cast("string"), F.lit(". "), x)), "\n")
    return _documents(spark, sf_dir).select("doc_id", F.inline(segment.ordered_sections(listed)))


@CATALOG.add(
    "numeral_decode",
    """
SELECT doc_id, k, CASE k WHEN 'circle' THEN CAST(doc_id % 20 + 1 AS INTEGER) WHEN 'paragraph' THEN CAST(doc_id % 300 AS INTEGER) WHEN 'syllable' THEN CAST(doc_id % 14 + 1 AS INTEGER)
  WHEN 'digit' THEN CAST(doc_id % 1000 AS INTEGER) END AS no FROM documents, (VALUES ('circle'), ('paragraph'), ('syllable'), ('digit'), ('other')) t(k)
""",
)
def numeral_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    marks = {
        "circle": F.get(F.lit([chr(0x2460 + i) for i in range(20)]), (d % 20).cast("int")),
        "paragraph": F.concat(F.lit("제"), (d % 300).cast("string"), F.lit("항")),
        "syllable": F.concat(F.get(F.lit(list("가나다라마바사아자차카타파하")), (d % 14).cast("int")), F.lit(".")),
        "digit": F.concat((d % 1000).cast("string"), F.lit(".")),
        "other": F.lit("각."),
    }
    rows = F.array(*(F.struct(F.lit(k).alias("k"), mark_number(v).alias("no")) for k, v in marks.items()))
    return _documents(spark, sf_dir).select("doc_id", F.inline(rows))


@CATALOG.add(
    "paragraph_items",
    """
WITH t AS (SELECT doc_id, source, unnest(range(1, 4)) AS p FROM documents), i AS (SELECT *, unnest(range(1, 3)) AS i FROM t)
SELECT doc_id, CAST(p AS INTEGER) AS paragraph_no, CAST(i AS INTEGER) AS item_no, source || ' ' || p || ' ' || i AS text FROM i
""",
)
def paragraph_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A statute article with three paragraphs of two items each, built from a column and cut again; leads before the
    first item are dropped."""
    pieces = []
    for p, mark in enumerate("①②③", 1):
        pieces.append(F.concat(F.lit(f"{mark} lead {p}\n 1. "), "source", F.lit(f" {p} 1\n 나. "), "source", F.lit(f" {p} 2\n")))
    article = F.concat(F.lit("before the first mark\n"), *pieces)
    df = _documents(spark, sf_dir).select("doc_id", F.inline(segment.paragraphs(article))).withColumnRenamed("no", "paragraph_no")
    return df.select("doc_id", "paragraph_no", F.inline(segment.items(F.col("text")))).select("doc_id", "paragraph_no", F.col("no").alias("item_no"), "text")


@CATALOG.add(
    "breadcrumbs",
    """
SELECT doc_id, array_to_string(list_filter([CASE WHEN doc_id % 3 > 0 THEN rtrim('제' || doc_id % 3 || '장 ' || lang) END, '제' || doc_id || '조(' || source || ')',
  CASE WHEN doc_id % 5 > 0 THEN doc_id % 5 || '항' END, CASE WHEN doc_id % 7 > 0 THEN doc_id % 7 || '호' END], lambda x: x IS NOT NULL), ' > ') AS path FROM documents
""",
)
def breadcrumbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    crumbs = ids.breadcrumbs(F.when(d % 3 > 0, d % 3), F.col("lang"), d, F.col("source"), d % 5, d % 7)
    return _documents(spark, sf_dir).select("doc_id", F.concat_ws(" > ", crumbs).alias("path"))


@CATALOG.add(
    "alias_set",
    "SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter([CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END, CASE WHEN doc_id % 4 = 0 THEN lang ELSE source END], lambda x: x <> ''))), ',') AS names FROM documents",
)
def alias_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    names = text.aliases(F.when(d % 2 == 0, F.col("lang")).otherwise(""), F.when(d % 4 == 0, F.col("lang")).otherwise(F.col("source")))
    return _documents(spark, sf_dir).select("doc_id", F.array_join(names, ",").alias("names"))


@CATALOG.add("first_of", f"SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang ELSE source END AS value FROM documents")
def first_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    return _documents(spark, sf_dir).select("doc_id", text.first_of(F.lit("  "), F.when(d % 3 == 0, F.col("lang")), F.concat(F.lit(" "), "source", F.lit("\n"))).alias("value"))


@CATALOG.add(
    "section_body_assemble",
    f"""
WITH c AS (SELECT conv_id, turn, trim(regexp_replace(replace(coalesce(text, ''), chr(160), ' '), '[ \\t\\n\\r\\f\\v]+', ' ', 'g'), ' ') AS t FROM conversations),
t AS (SELECT conv_id, nullif(string_agg(t, ' ' ORDER BY t) FILTER (WHERE turn % 3 = 0 AND t <> ''), '') AS holding, nullif(string_agg(t, ' ' ORDER BY t) FILTER (WHERE turn % 3 = 1 AND t <> ''), '') AS main, nullif(string_agg(t, ' ' ORDER BY t) FILTER (WHERE turn % 3 = 2 AND t <> ''), '') AS reasons FROM c GROUP BY conv_id),
b AS (SELECT conv_id, array_to_string(list_filter(['case ' || conv_id, CASE WHEN conv_id % 2 = 0 THEN '(even)' END, '[판시사항] ' || holding, CASE WHEN main IS NOT NULL OR reasons IS NOT NULL THEN '[전문]' END, '[주문] ' || main, '[이유] ' || reasons], lambda x: x IS NOT NULL), ' ') AS body FROM t)
SELECT conv_id, body, CAST(length(body) AS BIGINT) AS n_chars FROM b
""",
)
def section_body_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation as a case: its turns are the labelled sections, in one line, empty ones left out."""
    line = text.clean_line(F.col("text"), entities=False)
    part = lambda k: F.array_join(F.array_sort(F.collect_list(F.when((F.col("turn") % 3 == k) & (line != ""), line))), "\n")
    sections = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(part(0).alias("holding"), part(1).alias("main"), part(2).alias("reasons"))
    title, subtitle = F.concat(F.lit("case  "), F.col("conv_id").cast("string")), F.when(F.col("conv_id") % 2 == 0, "even")
    body = chunking.case_body(title, subtitle, {"holding": F.col("holding"), "summary": F.lit(" "), "provisions": F.lit(None).cast("string")}, F.col("main"), F.col("reasons"))
    return sections.select("conv_id", body.alias("body"), F.length(body).cast("long").alias("n_chars"))


@CATALOG.add(
    "merge_sorted_union",
    """
WITH u AS (SELECT 'a' || source AS name, doc_id FROM documents WHERE lang = 'en' UNION ALL SELECT 'b' || source AS name, doc_id FROM documents WHERE lang <> 'en')
SELECT CAST(row_number() OVER (ORDER BY encode(name || '_document.jsonl'), doc_id) AS INTEGER) AS pos, name, doc_id FROM u
""",
)
def merge_sorted_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two outputs merged in the byte order of their files, with the place of each row in the merged output."""
    docs = _documents(spark, sf_dir)
    rows = docs.where("lang = 'en'").select(F.concat(F.lit("a"), "source").alias("name"), "doc_id").unionByName(docs.where("lang <> 'en'").select(F.concat(F.lit("b"), "source").alias("name"), "doc_id"))
    return sources.merged(rows, within=["doc_id"], place="pos").select(F.col("pos").cast("int").alias("pos"), "name", "doc_id")
