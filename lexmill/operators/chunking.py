"""Sentences and size-bounded chunks. Sentences are cut by Column expressions; packing them is a fold whose state is a
run of sentences, in Arrow batches, so that its time grows with the text and not with the square of its chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, StringType

from lexmill.functions.text import clean_line, strip, text_of

# Sentence ends, labels and sizes.
STATUTE_END = r"(?U)([.!?]|(?:다|니다|요|함|됨|바)\.)\s+"
SYLLABLE_END = r"(다\.)(?U:\s*)"
MARK_END = r"([.!?])(?U:\s+)"
CASE_LABELS = (("holding", "[판시사항]"), ("summary", "[판결요지]"), ("provisions", "[참조조문]"))
FULL_TEXT, ORDER_LABEL, REASON_LABEL = "[전문]", "[주문]", "[이유]"
TARGET, MOST = 900, 1400
CHUNK, OVERLAP = 1200, 200
# End of fixed values.


def _lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"\R"), strip), lambda x: x != "")


def statute_sentences(text: Column) -> Column:
    """Sentences of statute text: an end mark and white space after it."""
    return _lines(F.regexp_replace(text_of(text), STATUTE_END, "$1\n"))


def case_sentences(text: Column) -> Column:
    """Sentences of case text: ``다.`` ends one even without white space after it."""
    return _lines(F.regexp_replace(F.regexp_replace(text_of(text), SYLLABLE_END, "$1\n"), MARK_END, "$1\n"))


def ascii_sentences(text: Column) -> Column:
    """Sentences by ASCII rules only, the same in every regex dialect."""
    parts = F.split(F.regexp_replace(text_of(text), "([.!?])[ \t\n\r]+", "$1\n"), "\n")
    return F.filter(F.transform(parts, lambda x: F.btrim(x, F.lit(" \t\r"))), lambda x: x != "")


def _packed(pack: Callable[[list[str]], Iterator[str]]) -> Callable[[Column], Column]:
    """A function of lists of sentences as a function of array columns; null stays null."""

    @arrow_udf(ArrayType(StringType()))
    def chunks(lists: pa.Array) -> pa.Array:
        return pa.array([None if x is None else list(pack(x)) for x in (x.as_py() for x in lists)], pa.list_(pa.string()))

    return chunks


def greedy_chunks(sentences: Column, target: int = TARGET, most: int = MOST, strict: bool = False) -> Column:
    """Packs sentences while they fit in ``target`` characters.

    A chunk that is closed by a further sentence is cut at ``most`` and its tail dropped; the last chunk is never cut.
    ``strict`` cuts none and drops nothing.
    """

    def pack(found: list[str]) -> Iterator[str]:
        held: list[str] = []
        size = -1  # of the held sentences joined
        for x in found:
            if held and size + 1 + len(x) > target:
                yield " ".join(held)[: None if strict else most]
                held, size = [], -1
            held.append(x)
            size += 1 + len(x)
        if held:
            yield " ".join(held)

    return _packed(pack)(sentences)


def overlapping_chunks(sentences: Column, size: int = CHUNK, overlap: int = OVERLAP) -> Column:
    """Packs sentences up to ``size`` characters; each chunk starts with the last sentences of the one before.

    A sentence that finds no room closes the chunk and joins what is carried over, without a second test, so chunks may
    grow beyond ``size``. A first sentence that is too long gives a chunk of ``size`` and goes on ``overlap`` before its end.
    """

    def carried(held: list[str]) -> tuple[list[str], int]:
        """The shortest run of last sentences that weighs ``overlap`` or more, all if none does; and its weight."""
        at, weight = len(held), 0
        while at and weight < overlap:
            at -= 1
            weight += len(held[at]) + 1
        return held[at:], weight

    def pack(found: list[str]) -> Iterator[str]:
        held: list[str] = []
        weight = 0  # a sentence weighs a character more than it has
        for x in found:
            if weight + len(x) + 1 > size:
                if not held:
                    yield x[:size]
                    held = [x[size - overlap :]] if len(x) > size else []
                    weight = sum(len(h) + 1 for h in held)
                    continue
                yield " ".join(held)
                held, weight = carried(held)
            held.append(x)
            weight += len(x) + 1
        if held:
            yield " ".join(held)

    return _packed(pack)(sentences)


def numbered(chunks: Column) -> Column:
    """Array of ``chunk_no, chunk``, from 1."""
    return F.transform(chunks, lambda c, i: F.struct((i + 1).cast("int").alias("chunk_no"), c.alias("chunk")))


def case_body(title: Column, subtitle: Column, sections: dict[str, Column], order: Column, reasons: Column) -> Column:
    """A case as one line: title, bracketed subtitle, labelled sections, those that are not empty."""
    line = lambda c: F.nullif(clean_line(c, entities=False), F.lit(""))
    labelled = lambda label, c: F.when(line(c).isNotNull(), F.concat(F.lit(label + "\n"), line(c)))
    parts = [line(title), F.when(line(subtitle).isNotNull(), F.concat(F.lit("("), line(subtitle), F.lit(")")))]
    parts += [labelled(label, sections[name]) for name, label in CASE_LABELS if name in sections]
    parts.append(F.when(line(order).isNotNull() | line(reasons).isNotNull(), F.lit(FULL_TEXT)))
    parts += [labelled(ORDER_LABEL, order), labelled(REASON_LABEL, reasons)]
    return clean_line(F.concat_ws("\n", *parts), entities=False)
