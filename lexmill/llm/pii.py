"""Personal data: base patterns, and bootstrapped contextual extraction over them. DataFrame functions only.

Base matches (emails, IPv4 addresses, card numbers, phone numbers) are seeds, and so are tokens in the fixed formats of
credentials; these last are reported only if a context bears them out. Candidates are whatever looks like an
identifier: a name at a host in any form, seven or more digits with spaces, brackets and separators between them, long
tokens of letters and digits.

Every occurrence of a seed or candidate votes in a graph between *patterns* (one to three words before it, one or two
after it, or the words on both sides, with the coarse class mail, number or code of what stands there) and *instances*
(the values). Each round scores a pattern by the share of its instances that are known to be of one kind, keeps the
patterns of high confidence and enough support, and scores the unknown instances they hold by noisy-or; accepted ones
are known in the next round, so contexts spread from seeds to identifiers that no base pattern describes: phone numbers
without a plus sign, addresses at bare host names, keys of unknown formats.

The texts are read in one narrow pass that keeps only spans and contexts; votes are pre-aggregated by pattern and
instance before anything is joined.

Defined results: a null or empty text has no spans; spans are code points, end exclusive; rows that repeat a
``doc_id`` each get their own result; discovered spans never overlap base spans of the same text; a context ends at the
match before or after it, and context words of more than 64 characters count by their hash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import Tables

KINDS = ("email", "ip", "card", "phone")
#: Leftmost matches, with starts inside a run of the first class ruled out (save right after a match), so that a long
#: run is scanned once; possessive repeats keep Java's matcher from recursing.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap tests that a text without a match mostly fails.
HINTS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
#: What may be an identifier beside the base matches, and a cheap test for it.
CANDIDATE = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|[\x20]?[\[(]at[\])][\x20]?)[A-Za-z0-9.-]++"
    r"|(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])[A-Za-z0-9_+/=-]{16,}+"
    r"|(?<![A-Za-z0-9])[(]?[0-9](?:[\x20().\-/]{0,2}[0-9])++"
)
CANDIDATE_HINT = r"@|[\[(]at[\])]|[A-Za-z0-9_+/=-]{16}|(?:[0-9][^0-9A-Za-z]{0,2}){7}"
#: Formats in which services issue credentials.
CREDENTIAL = r"^(?:(?=.*[a-f])(?=.*[0-9])(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36})$"
FOUND = (*KINDS, "secret")
SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string,value:string,before:array<string>,after:array<string>>>"
BLOCK = 256


@dataclass(frozen=True)
class Settings:
    """``confidence``: of patterns and of instances that are accepted; ``support``: known instances that a pattern has
    at least; ``digits``: of a number that is a candidate, at least."""

    rounds: int = 3
    confidence: float = 0.8
    support: int = 5
    digits: int = 7


def located(text: Column, pattern: str, hint: str) -> tuple[Column, Column]:
    """All matches of ``pattern`` and the pieces between them; nothing where ``hint`` does not occur."""
    here = text.rlike(hint)
    return F.when(here, F.regexp_extract_all(text, F.lit(pattern), 0)), F.when(here, F.split(text, pattern, -1))


def spans(matches: Column, pieces: Column, kind: str) -> Column:
    """Array of ``start, kind_no, end, kind, value, before, after``. Starts are running sums of lengths, worked out
    in blocks, so a text with very many matches costs no square of them."""
    n = F.size(matches)
    lengths = F.zip_with(F.slice(pieces, 1, n), matches, lambda p, m: F.length(p) + F.length(m))

    def block(b: Column) -> Column:
        size = F.least(F.lit(BLOCK), n - b)
        begin = F.aggregate(F.slice(lengths, 1, b), F.lit(0), lambda a, x: a + x)
        empty = F.array().cast(SPAN)
        parts = F.transform(F.sequence(b, b + size - 1), lambda i: F.struct(F.get(matches, i).alias("m"), F.get(pieces, i).alias("p"), F.get(pieces, i + 1).alias("q")))

        def step(state: Column, x: Column) -> Column:
            start = state["at"] + F.length(x["p"])
            one = F.struct(start.alias("start"), F.lit(KINDS.index(kind) if kind in KINDS else 9).alias("kind_no"), (start + F.length(x["m"])).alias("end"), F.lit(kind).alias("kind"), x["m"].alias("value"), words(F.reverse(x["p"]), 3, True).alias("before"), words(x["q"], 2, False).alias("after"))
            return F.struct((start + F.length(x["m"])).alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

        return F.aggregate(parts, F.struct(begin.alias("at"), empty.alias("out")), step, lambda s: s["out"])

    found = F.flatten(F.transform(F.sequence(F.lit(0), n - 1, F.lit(BLOCK)), block))
    empty = F.array().cast(SPAN)
    return F.when(n > 0, found).otherwise(empty)


def words(piece: Column, most: int, backwards: bool) -> Column:
    """The first words of ``piece``, nearest first, at most ``most``; ``backwards``: the piece is turned round."""
    first = F.regexp_extract(piece, rf"^(?:\s*+\S++){{0,{most}}}+", 0)
    found = F.filter(F.split(F.lower(F.reverse(first) if backwards else first), r"\s+"), lambda w: w != "")
    found = F.reverse(found) if backwards else found
    return F.transform(found, lambda w: F.when(F.length(w) > 64, F.hex(F.xxhash64(w))).otherwise(w))


def coarse(value: Column) -> Column:
    return F.when(value.rlike(r"@|[\[(]at[\])]"), "mail").when(value.rlike("[A-Za-z]"), "code").otherwise("number")


def patterns(value: Column, before: Column, after: Column) -> Column:
    """The patterns that an occurrence votes for."""
    left = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda n: F.when(F.size(before) >= n, F.concat(F.array_join(F.reverse(F.slice(before, 1, n)), " "), F.lit(" _"))))
    right = F.transform(F.sequence(F.lit(1), F.lit(2)), lambda n: F.when(F.size(after) >= n, F.concat(F.lit("_ "), F.array_join(F.slice(after, 1, n), " "))))
    both = F.array(F.when((F.size(before) > 0) & (F.size(after) > 0), F.concat(F.get(before, F.lit(0)), F.lit(" _ "), F.get(after, F.lit(0)))))
    return F.transform(F.array_compact(F.concat(left, right, both)), lambda p: F.concat(coarse(value), F.lit(": "), p))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    d = digits_of(value)
    n = F.length(d)

    def add(total: Column, i: Column) -> Column:
        x = F.substring(d, n - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + x - F.when(x > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})$"))
    if kind == "card":
        n = F.length(digits_of(value))
        return F.when(n.between(12, 19), luhn(value)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits_of(value)).between(9, 15)
    return F.lit(True)


def valid(array: Column, kind: str) -> Column:
    return F.filter(array, lambda x: passes(kind, x["value"]))


def count_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def scan(docs: DataFrame, s: Settings) -> DataFrame:
    """``doc_id, text_key, base, others``: base spans, and the other identifier-like tokens of each text."""
    text = F.col("text")
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    df = df.withColumn("text_key", F.xxhash64("text"))
    columns = ["doc_id", "text_key"]
    for kind in (*KINDS, "other"):
        matches, pieces = located(text, PATTERNS.get(kind, CANDIDATE), HINTS.get(kind, CANDIDATE_HINT))
        df = df.withColumn(f"{kind}_m", matches).withColumn(f"{kind}_p", pieces)
        columns += [f"{kind}_m", f"{kind}_p"]
    df = df.select(*columns)
    for kind in KINDS:
        df = df.withColumn(kind, valid(spans(F.col(f"{kind}_m"), F.col(f"{kind}_p"), kind), kind))
    base = F.array_sort(F.concat(*KINDS))
    trimmed = F.transform(spans(F.col("other_m"), F.col("other_p"), "other"), lambda x: F.struct(x["start"], F.regexp_replace(x["value"], r"[.:=/-]+$", "").alias("value"), x["before"], x["after"]))
    others = F.transform(trimmed, lambda x: F.struct(x["start"].alias("start"), (x["start"] + F.length(x["value"])).alias("end"), x["value"].alias("value"), x["before"].alias("before"), x["after"].alias("after")))
    others = F.filter(others, lambda x: (coarse(x["value"]) != "number") | (F.length(digits_of(x["value"])) >= s.digits))
    df = df.select("doc_id", "text_key", base.alias("base"), others.alias("others"))
    return df.withColumn("others", F.filter("others", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))))


def bootstrap(found: DataFrame, s: Settings, t: Tables) -> DataFrame:
    """``value, kind``: instances outside the base patterns that contexts of high confidence give away."""
    seeds = found.select(F.explode("base").alias("x")).select("x.value", "x.before", "x.after", "x.kind", F.lit(True).alias("sure"))
    format_ = F.when(F.col("x.value").rlike(CREDENTIAL), F.lit("secret"))
    rest = found.select(F.explode("others").alias("x")).select("x.value", "x.before", "x.after", format_.alias("kind"), F.lit(False).alias("sure"))
    seen = seeds.unionByName(rest).select("value", "kind", "sure", F.explode(patterns(F.col("value"), F.col("before"), F.col("after"))).alias("pattern"))
    votes = t.write(seen.groupBy("pattern", "value").agg(F.max("kind").alias("seed"), F.max("sure").alias("sure")), "votes")
    known = None
    for _ in range(s.rounds):
        held = votes.withColumn("kind", F.col("seed"))
        if known is not None:
            held = votes.join(known, "value", "left").withColumn("kind", F.coalesce("seed", "found")).drop("found")
        total = held.groupBy("pattern").agg(F.count("*").alias("n"), *(F.sum((F.col("kind") == k).cast("int")).alias(k) for k in FOUND))
        best = F.greatest(*(F.coalesce(F.col(k), F.lit(0)) for k in FOUND))
        kind = F.coalesce(*(F.when(F.col(k) == best, F.lit(k)) for k in FOUND))
        good = total.select("pattern", kind.alias("means"), best.alias("hits"), (best / (F.col("n") + 1)).alias("confidence")).where((F.col("hits") >= s.support) & (F.col("confidence") >= s.confidence))
        good = t.write(good, "patterns")
        score = 1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))
        told = votes.where("NOT sure").join(good, "pattern").groupBy("value", "means").agg(score.alias("score"))
        told = told.where(F.col("score") >= s.confidence).groupBy("value").agg(F.max_by("means", F.struct("score", "means")).alias("found"))
        known = t.write(told, "known")
    return known.select("value", F.col("found").alias("kind"))


def find(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """``doc_id, text_key, base, spans``: arrays of ``start, kind_no, end, kind`` of each text."""
    s = s or Settings()
    t = Tables(docs.sparkSession, "personal")
    found = t.write(scan(docs, s), "found")
    known = t.write(bootstrap(found, s, t), "instances")
    place = found.select("doc_id", "text_key", F.explode("others").alias("x")).select("doc_id", "text_key", "x.start", "x.end", "x.value")
    number = F.array_position(F.lit(list(FOUND)), F.col("kind")).cast("int") - 1
    added = place.distinct().join(known, "value").groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", number.alias("kind_no"), "end", "kind")).alias("added"))
    base = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["kind_no"].alias("kind_no"), x["end"].alias("end"), x["kind"].alias("kind")))
    joined = found.withColumn("base", base).alias("f").join(added.alias("a"), F.col("f.doc_id").eqNullSafe(F.col("a.doc_id")) & (F.col("f.text_key") == F.col("a.text_key")), "left")
    every = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added")))
    return joined.select("f.doc_id", "f.text_key", "base", every.alias("spans"))


def joined(array: Column) -> Column:
    return F.array_join(F.transform(array, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """Counts of base spans, their digest, all spans of every document, and the counts of all and of discovered spans."""
    every = F.size("spans").cast("long")
    return find(docs, s).select("doc_id", *map(count_of, KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), every.alias("n_spans"), (every - F.size("base")).alias("n_found"))
