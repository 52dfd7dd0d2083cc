"""Token counts behind a digest cache.

The cache is a Parquet table of (digest, n_tokens), one folder per tokenizer version; the digest is
the SHA-256 of the normalised content (null as empty, UTF-8), the version the SHA-256 of the
tokenizer's file. Documents are joined to the cache by digest; only the distinct contents it lacks
are encoded, each once, and appended; the counts are then read back from the cache. Copies are
reduced map-side before any text moves, so a text that a third of all documents share moves once
per task. An encoding run that fails appends nothing: Parquet commits whole.

A piece tokenizer whose pieces never hold a word mark behind another character can join nothing
across a single space. The words of a text between single spaces are then encoded on their own and
remembered in the Python worker (``WORD_CACHE`` of them, and as many of the generation before, from which words still in
use move on); their counts add up to the text's.
The property is read from the model; texts with leading, trailing or repeated spaces or a literal
word mark, and models without the property, are encoded whole.

Defined results: a null or empty text has 0 tokens; equal ids are counted row by row; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import uuid

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import tables_dir
from .common import ready, remembered

#: Most words whose counts a Python worker remembers.
WORD_CACHE = 300_000
MARK = "▁"


def tokenizer_version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class PieceCounter:
    """Token counts by a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        how = proto.normalizer_spec
        plain = how.add_dummy_prefix and how.escape_whitespaces and not how.remove_extra_whitespaces \
            and not how.precompiled_charsmap and not proto.trainer_spec.treat_whitespace_as_suffix
        pieces = [p.piece for p in proto.pieces]
        self.additive = plain and proto.trainer_spec.byte_fallback and all(
            MARK not in p[1:] or not p.strip(MARK) for p in pieces)
        self.words: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        return [self.count_one(t) for t in texts]

    def count_one(self, text: str) -> int:
        if not text:
            return 0
        if not self.additive or "  " in text or text[0] == " " or text[-1] == " " or MARK in text:
            return len(self.model.encode(text))
        units = text.split(" ")
        if len(self.words) > WORD_CACHE:
            self.words, self.old = {}, self.words
        counts = list(map(self.words.get, units))
        if None in counts:
            lost = {u for u, n in zip(units, counts, strict=True) if n is None}
            older = lost & self.old.keys()
            self.words.update((u, self.old[u]) for u in older)
            new = list(lost - older)
            self.words.update(zip(new, map(len, self.model.encode(new)), strict=True))
            counts = map(self.words.__getitem__, units)
        return sum(counts)


class JsonCounter:
    """Token counts by a tokenizers file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()

    def count(self, texts: list[str]) -> list[int]:
        return [len(self.model.encode(t, add_special_tokens=False).ids) for t in texts]


def counter(path: str) -> PieceCounter | JsonCounter:
    """One per Python worker and file."""
    return remembered(("counter", path), lambda: JsonCounter(path) if path.endswith(".json") else PieceCounter(path))


def encode_counts(contents: DataFrame, path: str) -> DataFrame:
    """(digest, content) to (digest, n_tokens)."""
    ready(contents.sparkSession)

    def count(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        c = counter(path)
        for b in batches:
            n = [x for i in range(0, b.num_rows, 256) for x in c.count(b.column(1).slice(i, 256).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], names=["digest", "n_tokens"])

    return contents.select("digest", "content").mapInArrow(count, "digest binary, n_tokens long")


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 4096,
                 id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    ``cache``: folder of the cache, kept between runs; by default a new one among the application's intermediate tables,
    which goes with them."""
    spark = docs.sparkSession
    folder = os.path.join(cache or os.path.join(tables_dir(spark), f"token-cache-{uuid.uuid4().hex}"),
                          f"tokenizer={tokenizer_version(tokenizer)}")
    body = F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(body.cast("binary"), 256))
    keyed = docs.select(digest.alias("digest"), body.alias("content"))
    try:
        known = spark.read.schema("digest binary, n_tokens long").parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        known = None
    if known is not None:
        keyed = keyed.join(known.select("digest"), "digest", "left_anti")
    misses = keyed.groupBy("digest").agg(F.first("content").alias("content"))
    encode_counts(misses, tokenizer).write.mode("append").parquet(folder)
    rows = docs.select(F.col(id_col).alias("doc_id"), digest.alias("digest"),
                       F.octet_length(body.cast("binary")).cast("long").alias("n_bytes"))
    # of a filled cache only what is asked for is grouped; runs that overlap may both append a content: its counts are equal
    counts = spark.read.schema("digest binary, n_tokens long").parquet(folder)
    if known is not None:
        counts = counts.join(rows.select("digest").distinct(), "digest", "left_semi")
    counts = counts.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
