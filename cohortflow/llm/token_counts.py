"""Token counts through a digest cache: only texts whose normalised content is new to the cache are encoded."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from cohortflow.llm.text import SPACE_CLASS, as_bytes, slices

CACHE_SCHEMA = "tokenizer string, digest string, n_tokens long"
#: Distinct chunks a worker remembers before it starts anew.
CHUNKS = 300_000


def tokenizer_digest(path: str) -> str:
    """The version of a tokenizer: SHA-256 of its file, the library's release and how content is normalised."""
    import sentencepiece
    import tokenizers

    library = sentencepiece if path.endswith(".model") else tokenizers
    with open(path, "rb") as file:
        spaces = "folded" if drops_spaces(path) else "kept"
        return hashlib.sha256(file.read() + f"{library.__name__} {library.__version__} spaces {spaces}".encode()).hexdigest()


def content_digest(text: Column, path: str) -> Column:
    """SHA-256 of the normalised content.

    For tokenizers that drop white space (``drops_spaces``) runs of ASCII white space become one space, so texts with the
    same digest have the same count. Other tokenizers get the text as it is.
    """
    whole = F.coalesce(text, F.lit(""))
    return F.sha2(F.regexp_replace(whole, SPACE_CLASS + "+", " ") if drops_spaces(path) else whole, 256)


@lru_cache(maxsize=2)
def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class ChunkCounts(dict):
    """White-space-free chunk -> its number of tokens.

    The tokenizer drops white space and no token crosses it, so a text's count is the sum over its chunks; each distinct
    chunk is encoded once.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def count(self, text: bytes) -> int:
        chunks = text.split()
        new = [c for c in {*chunks} if c not in self]
        if new:
            if len(self) > CHUNKS:
                self.clear()
                new = list({*chunks})
            found = self.tokenizer.encode_batch_fast([c.decode() for c in new], add_special_tokens=False)
            self.update(zip(new, map(len, found), strict=True))
        return sum(map(self.__getitem__, chunks))


def drops_spaces(path: str) -> bool:
    """Whether the tokenizer's own rules remove white space between chunks, read from its file."""
    import json

    if path.endswith(".model"):
        return False
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    splits = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or []
    first = splits[0] if splits else {}
    return first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert")) and r"[^\s" in str(first.get("pattern"))


def _encode(path: str, by_chunk: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _load(path)
        chunks = ChunkCounts(tokenizer) if by_chunk else None
        for batch in slices(batches, "text"):
            texts = as_bytes(batch, "text")
            if chunks is not None:
                counts = [chunks.count(t) for t in texts]
            elif path.endswith(".model"):
                counts = [len(x) for x in tokenizer.encode([t.decode() for t in texts], num_threads=1)]
            else:
                counts = [len(x) for x in tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pc.cast(pa.array(counts), pa.int64())], ["digest", "n_tokens"])

    return run


def fill_cache(docs: DataFrame, path: str, cache: str, text: str = "text") -> DataFrame:
    """Encode every distinct content that ``cache`` lacks, append it, and return (digest, n_tokens) of this tokenizer.

    Copies meet on the map side first, so a content that a third of all rows share is one row per task in the shuffle. A
    second run over the same texts encodes nothing. Appends by two jobs at once may store a content twice; the counts are equal
    and reading takes one.
    """
    spark, version = docs.sparkSession, tokenizer_digest(path)
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)

    def known() -> DataFrame:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer") == version)
        return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    contents = docs.select(content_digest(F.col(text), path).alias("digest"), F.coalesce(text, F.lit("")).alias("text"))
    distinct = contents.groupBy("digest").agg(F.first("text").alias("text"))
    misses = distinct.join(known().select("digest"), "digest", "left_anti")
    counted = misses.mapInArrow(_encode(path, drops_spaces(path)), "digest string, n_tokens long")
    counted.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)
    return known()


def token_counts(docs: DataFrame, path: str, cache: str, limit: int = 2048, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with n_bytes, n_tokens and over_limit in place of its text.

    Null and empty texts count nothing; repeated rows are counted in each row; a null id stays. ``cache`` is a folder all
    executors share. Columns of ``docs`` that are named like a result are replaced by it.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    added = ("n_bytes", "n_tokens", "over_limit", "_digest")
    rest = [c for c in docs.columns if c != text and c not in added]
    rows = docs.select(*rest, F.octet_length(whole).cast("long").alias("n_bytes"), content_digest(F.col(text), path).alias("_digest"))
    counts = fill_cache(docs, path, cache, text).select(F.col("digest").alias("_digest"), "n_tokens")
    return rows.join(counts, "_digest", "left").select(*rest, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
