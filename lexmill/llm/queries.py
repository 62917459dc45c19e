"""Queries over the operators of this subpackage, with production parameters, on whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.catalog import Catalog, table
from lexmill.llm import bpe, decontaminate, fingerprints, language_model, lines, merkle, minhash, neighbours, pii, spelling, substrings, token_files, toxicity
from lexmill.sources import scratch_path

CATALOG = Catalog()


#: Links of documents whose 4-word shingle sets share 80 % of their union; components by repeated minima.
OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS s
  FROM words
), one AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM one a JOIN one b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (SELECT a, b FROM pairs WHERE 100 * shared >= 80 * (na + nb - shared)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS node, b AS seen FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.seen = e.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m.least_id, s.doc_id)) AS component_id,
  s.doc_id = least(s.doc_id, coalesce(m.least_id, s.doc_id)) AS kept
FROM sets s LEFT JOIN (SELECT node, min(seen) AS least_id FROM reach GROUP BY node) m ON m.node = s.doc_id
"""


@CATALOG.add("op1_minhash", OP1_SQL)
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Settings(words=4))


@CATALOG.add("op2_language_model")
def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_model.score(docs, language_model.fit(docs))


#: All lines of repeated runs with 60 characters or more that also start earlier are deleted. Those are the lines of the
#: shortest such runs from some line on (``ahead``) and up to some line (``back``).
OP3_SQL = r"""
WITH l AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos
  FROM documents
), c AS (SELECT *, sum(length(line)) OVER (PARTITION BY doc_id ORDER BY pos) AS upto, upto - length(line) AS before FROM l),
ends AS (SELECT doc_id, upto, min(pos) AS pos FROM c GROUP BY 1, 2),
begins AS (SELECT doc_id, before, max(pos) AS pos FROM c GROUP BY 1, 2),
ahead AS (
  SELECT c.doc_id, c.pos AS start, e.pos AS last, c.ls FROM c ASOF JOIN ends e ON c.doc_id = e.doc_id AND c.before + 60 <= e.upto
), back AS (
  SELECT c.doc_id, b.pos AS start, c.pos AS last, c.ls FROM c ASOF JOIN begins b ON c.doc_id = b.doc_id AND c.upto - 60 >= b.before
), runs AS (
  SELECT DISTINCT doc_id, start, last - start + 1 AS n, array_to_string(ls[start:last], chr(10)) AS lines
  FROM (SELECT * FROM ahead UNION ALL SELECT * FROM back)
), later AS (SELECT doc_id, start, n, row_number() OVER (PARTITION BY n, lines ORDER BY doc_id, start) > 1 AS again FROM runs),
gone AS (SELECT DISTINCT doc_id, unnest(range(start, start + n)) AS pos FROM later WHERE again),
marked AS (SELECT l.*, g.pos IS NOT NULL AS removed FROM l LEFT JOIN gone g USING (doc_id, pos)),
told AS (SELECT *, removed AND NOT coalesce(lag(removed) OVER (PARTITION BY doc_id ORDER BY pos), false) AS begins FROM marked)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE removed) AS BIGINT) AS n_removed, CAST(count(*) FILTER (WHERE begins) AS BIGINT) AS n_runs,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT removed), '')) AS kept_sha256
FROM told GROUP BY doc_id
"""


@CATALOG.add("op3_line_dedup", OP3_SQL)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


@CATALOG.add("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "op4")
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        tokenizer = f.read()
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer)
    return token_files.checksums(token_files.read_tokens(spark, path))


@CATALOG.add("op5_pii")
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@CATALOG.add("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@CATALOG.add("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_documents(docs, table(spark, sf_dir, "labels"), learn_from=~held_out)
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@CATALOG.add("op8_fingerprints")
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


@CATALOG.add("op9_substring_dedup")
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents")).drop("kept")


@CATALOG.add("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


#: The table of the 32-bit cyclic redundancy check by its rule, and the check of a list of bytes.
CRC_TABLE = """crc AS (SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i))"""
CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, {0}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
CODES = "list_transform(string_split({0}, ''), lambda x: CAST(unicode(x) AS BIGINT))"

OP11_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, translate(run, '{spelling.UPPER}', '{spelling.LOWER}') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
), counted AS (SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= 7 GROUP BY 1, 2),
bytes AS (
  SELECT run, c, flatten(list_transform({CODES.format("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")}, lambda x: CASE WHEN x < 128 THEN [x] ELSE [192 + (x >> 6), 128 + (x & 63)] END)) AS b
  FROM counted
), hashed AS (SELECT run, c, {CRC.format("b")} AS h FROM bytes, crc),
garbled AS (
  SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed
), words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM garbled WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
keys AS (
  SELECT word, n, unnest(list_distinct(list_prepend(word, list_transform(range(1, length(word) + 1), lambda i: substring(word, 1, i - 1) || substring(word, i + 1))))) AS key FROM words
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM keys a JOIN keys b ON a.key = b.key AND a.word <> b.word
  WHERE length(a.word) <> length(b.word) OR len(list_filter(range(1, length(a.word) + 1), lambda i: substring(a.word, i, 1) <> substring(b.word, i, 1))) = 1
), best AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS r FROM near),
told AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 10 * w.n THEN b.other END AS form, CASE WHEN b.m >= 10 * w.n THEN b.m END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word AND b.r = 1
), chain AS (
  SELECT word, word AS here, 0 AS steps FROM told
  UNION ALL SELECT c.word, t.form, c.steps + 1 FROM chain c JOIN told t ON c.here = t.word WHERE t.form IS NOT NULL
)
SELECT t.word, t.form, r.root, t.n, CAST(t.n_near AS BIGINT) AS n_near, t.form_n
FROM told t JOIN (SELECT word, arg_max(here, steps) AS root FROM chain GROUP BY word) r USING (word)
"""


@CATALOG.add("op11_spelling_variants", OP11_SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@CATALOG.add("op12_nearest_neighbours")
def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def _told(*columns: str) -> str:
    return " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns)


_FOLD = "list_reduce(list_prepend({0}, steps), lambda d, s: CASE WHEN s[1] = '<' THEN sha256(s[2:] || d) ELSE sha256(d || s[2:]) END)"
OP13_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
leaves AS (
  SELECT coalesce('=' || lang, '-') AS tree, doc_id, sha256({_told(*merkle.FIELDS)}) AS digest,
    CASE WHEN {CRC.format(CODES.format("CAST(doc_id AS VARCHAR)"))} % 7 = 0 THEN sha256({_told("doc_id", "source", "lang", "n_chars + 1", "text")}) END AS forged
  FROM documents, crc
), placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
up AS (
  SELECT tree, 0 AS level, place, n, digest FROM placed
  UNION ALL SELECT tree, level + 1, place // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY place)) FROM up WHERE n > 1 GROUP BY tree, level, place // 2, n
), subroots AS (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM up WHERE n = 1),
above AS (
  SELECT 100 AS level, place, n, digest FROM subroots
  UNION ALL SELECT level + 1, place // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY place)) FROM above WHERE n > 1 GROUP BY level, place // 2, n
), steps AS (
  SELECT p.tree, p.place, l.level, CASE WHEN (p.place >> l.level) % 2 = 1 THEN '<' ELSE '>' END || coalesce(s.digest, '') AS step
  FROM placed p JOIN (SELECT DISTINCT tree, level FROM up WHERE n > 1) l USING (tree)
  LEFT JOIN up s ON s.tree = p.tree AND s.level = l.level AND s.place = xor(p.place >> l.level, 1)
  UNION ALL
  SELECT p.tree, p.place, l.level, CASE WHEN (r.place >> (l.level - 100)) % 2 = 1 THEN '<' ELSE '>' END || coalesce(s.digest, '')
  FROM placed p JOIN subroots r USING (tree), (SELECT DISTINCT level FROM above WHERE n > 1) l
  LEFT JOIN above s ON s.level = l.level AND s.place = xor(r.place >> (l.level - 100), 1)
), paths AS (SELECT tree, place, list(step ORDER BY level) AS steps FROM steps GROUP BY 1, 2),
proven AS (
  SELECT p.doc_id, p.digest AS leaf, s.digest AS subroot, (SELECT digest FROM above WHERE n = 1) AS root, coalesce(p.forged, p.digest) AS given, coalesce(x.steps, []::VARCHAR[]) AS steps
  FROM placed p JOIN subroots s USING (tree) LEFT JOIN paths x ON x.tree = p.tree AND x.place = p.place
)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(steps, lambda s: s[2:]), ''), '')) AS proof_sha256, {_FOLD.format("given")} AS folded_root, {_FOLD.format("given")} = root AS verified
FROM proven
"""


@CATALOG.add("op13_merkle_manifest", OP13_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))
