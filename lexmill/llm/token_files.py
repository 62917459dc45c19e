"""Token-ID output: Parquet files of ids in ascending ``doc_id`` order.

``<path>/tokens`` holds ``part, doc_id, n_tokens, local_start, ids``: ids as a list column, dictionary-encoded (or
delta-encoded with ``encoding="delta"``), in row groups of a set size whose pages carry column and offset indexes, so
that a reader who filters on ``doc_id`` or takes only the metadata columns touches few pages. ``<path>/parts`` holds
for each file its first global token position. A document's global start is the sum of both: no pass over ids is
needed to find it. Files are Spark's own, so commits, retries and remote stores are Spark's.

Defined results: a null or empty text has only the end id; an empty table gives empty files; documents with equal ids
stand next to each other in order of their text; null ids come first.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.llm.common import shuffle_partitions, slices, texts_of

if TYPE_CHECKING:
    from tokenizers import Tokenizer

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
ENCODINGS = {
    "dictionary": {"parquet.enable.dictionary": "true"},
    "delta": {"parquet.enable.dictionary": "false", "parquet.writer.version": "PARQUET_2_0"},
}


#: A single blank between two characters that are no white space: no token of a byte-level tokenizer reaches over its left.
SEAM = re.compile(r" (?<=\S )(?=\S)")
#: Characters of a text that the library gets at once.
LONG = 1 << 20


class LibraryEncoder:
    """Ids of whole texts by the ``tokenizers`` library, in one thread: its own threads would take the cores of other tasks.

    A byte-level tokenizer writes every piece of a text anew, a stand-in character for each byte. Texts of ``KNOWN`` characters go to a
    tokenizer with the same vocabulary and merges whose stand-ins are the bytes themselves (``by_bytes``), as a whole and as their bytes, so
    that this is left out; other texts, and all texts of other tokenizers, go as they are to the tokenizer that was given.

    Only texts beyond ``LONG`` characters are cut, so that the library's records of all their tokens are not held together, and
    only for a byte-level tokenizer, which splits before single blanks whatever stands beside them; others get any
    text as a whole."""

    def __init__(self, tokenizer_json: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        told = json.loads(tokenizer_json)
        split = told.get("pre_tokenizer") or {}
        self.cuts = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True) and not told.get("normalizer")
        self.json, self.bytewise = tokenizer_json, by_bytes(told) if self.cuts else None

    @cached_property
    def tokenizer(self) -> Tokenizer:
        from tokenizers import Tokenizer

        return remembering(Tokenizer.from_str(self.json))

    def parts(self, text: str) -> Iterator[str]:
        at = 0
        while self.cuts and len(text) - at > LONG and (seam := SEAM.search(text, at + LONG)):
            yield text[at : seam.start()]
            at = seam.start()
        yield text[at:]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        return [self._whole(t) if len(t) <= LONG else b"".join(map(self._whole, self.parts(t))) for t in texts]

    def _whole(self, text: str) -> bytes:
        if self.bytewise and (text.isascii() or not UNKNOWN.search(text)):
            found = self.bytewise.encode_batch_fast([text.encode().decode("latin-1")], add_special_tokens=False)
        else:
            found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return array("I", found[0].ids).tobytes()


#: What ``by_bytes`` has classes for: characters of one or two bytes (Latin, Greek, Cyrillic, Hebrew, Arabic), general punctuation.
KNOWN = [*map(chr, range(0x800)), *map(chr, range(0x2000, 0x2070))]
UNKNOWN = re.compile("[^\0-\u07ff\u2000-\u206f]")
#: Words whose tokens the library keeps; from then on it adds none.
CACHED_WORDS = 200_000


def remembering(tokenizer: Tokenizer) -> Tokenizer:
    if hasattr(tokenizer.model, "_resize_cache"):
        tokenizer.model._resize_cache(CACHED_WORDS)
    return tokenizer


def by_bytes(told: dict) -> Tokenizer | None:
    """The tokenizer of this JSON for texts of ``KNOWN`` characters given as their bytes, a character for each; None where its
    parts are not those of a plain byte-level BPE."""
    from tokenizers import Regex, Tokenizer, pre_tokenizers

    model, stands_for = told["model"], {ord(c): b for b, c in stand_ins().items()}
    odd = [model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")]
    plain = all(x["content"].isascii() and not any(x[k] for k in ("single_word", "lstrip", "rstrip", "normalized")) for x in told.get("added_tokens") or [])
    if model["type"] != "BPE" or any(odd) or not plain or told.get("truncation") or told.get("padding") or not all(ord(c) in stands_for for token in model["vocab"] for c in token):
        return None
    merges = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
    own = {"vocab": {k.translate(stands_for): v for k, v in model["vocab"].items()}, "merges": [[x.translate(stands_for) for x in pair] for pair in merges]}
    tokenizer = Tokenizer.from_str(json.dumps(told | {"model": model | own, "pre_tokenizer": None, "post_processor": None, "decoder": None}))
    tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(split_of_bytes()), "isolated")
    return remembering(tokenizer)


def stand_ins() -> dict[int, str]:
    """The character that a byte-level tokenizer writes for each byte: itself if it is printable, else the next one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def split_of_bytes() -> str:
    """The pattern of byte-level tokenizers over the bytes of ``KNOWN`` characters. The library itself tells which are letters, numbers
    and blanks. Contractions stand behind letters and numbers, with which they share no first character."""
    from tokenizers import Regex, pre_tokenizers

    def those(pattern: str) -> set[str]:
        return {x for x, _ in pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str("".join(KNOWN))}

    def one_of(chars: Iterable[str]) -> str:
        return "[" + "".join("\\" + c if c.isascii() and not c.isalnum() and c.isprintable() else c for c in sorted(chars)) + "]"

    def any_of(chars: set[str], many: str = "") -> str:
        lasts = defaultdict(set)  # last bytes by those before them
        for c in chars:
            code = c.encode().decode("latin-1")
            lasts[code[:-1]].add(code[-1])
        firsts = defaultdict(set)  # first bytes by what may follow
        for before, last in lasts.items():
            if before:
                firsts[before[1:] + one_of(last)].add(before[0])
        wide = "|".join(one_of(first) + rest for rest, first in firsts.items())
        return f"(?:{one_of(lasts[''])}{many}|(?={one_of(set().union(*firsts.values()))})(?:{wide}))"

    letters, numbers, blanks = those(r"\p{L}"), those(r"\p{N}"), those(r"\s")
    blank = any_of(blanks)
    words = [f" ?{any_of(x, '++')}++" for x in (letters, numbers, {*KNOWN} - letters - numbers - blanks)]
    return "|".join([*words[:2], "'(?:[stmd]|ll|ve|re)", words[2], f"{blank}+(?={blank}|\\z)", f"{blank}++"])


@lru_cache(maxsize=2)
def encoder(tokenizer_json: str) -> LibraryEncoder:
    return LibraryEncoder(tokenizer_json)


def write_tokens(docs: DataFrame, path: str, tokenizer_json: str, end_id: int = 0, encoding: str = "dictionary") -> None:
    """Encodes every document, appends ``end_id`` and writes the files."""
    spark = docs.sparkSession
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, at = encoder(tokenizer_json), TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            ids = [x + end for x in enc.encode(batch.column("text").to_pylist())]
            n = np.array([len(x) // 4 for x in ids], np.int64)
            offsets = np.concatenate([[0], np.cumsum(n)])
            flat = pa.py_buffer(b"".join(ids))
            values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, flat])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part), pa.int32()), batch.column("doc_id"), pa.array(n), pa.array(at + offsets[:-1]), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)],
                ["part", "doc_id", "n_tokens", "local_start", "ids"],
            )
            at += int(offsets[-1])

    ordered = texts_of(docs).repartitionByRange(shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    out = ordered.mapInArrow(run, "part int, doc_id long, n_tokens long, local_start long, ids array<int>")
    options = {"parquet.block.size": ROW_GROUP_BYTES, "parquet.page.size": PAGE_BYTES, "parquet.page.row.count.limit": 2_000} | ENCODINGS[encoding]
    out.write.options(**options).parquet(f"{path}/tokens")
    sizes = spark.read.parquet(f"{path}/tokens").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    sizes.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{path}/parts")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens`` without reading any ids."""
    return _with_start(spark, path).select("doc_id", "start", "n_tokens")


def read_tokens(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids``; with ``ids``, of these documents only, found through the page indexes."""
    found = _with_start(spark, path)
    if ids is not None:
        found = found.where(F.col("doc_id").isin(ids))
    return found.select("doc_id", "start", "n_tokens", "ids")


def _with_start(spark: SparkSession, path: str) -> DataFrame:
    parts = spark.read.parquet(f"{path}/parts").select("part", F.col("start").alias("part_start"))
    # A row for each file of tokens, and files are as many as shuffle partitions at most: fit to be sent to all tasks.
    return spark.read.parquet(f"{path}/tokens").join(F.broadcast(parts), "part").withColumn("start", F.col("part_start") + F.col("local_start"))


def checksums(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of what :func:`read_tokens` returns; the counts are of the ids read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy().astype("<u4", copy=False)
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(np.diff(offsets), pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
