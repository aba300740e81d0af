"""Sizes of documents in tokens of a public tokenizer, and their quality weight.

The tokenizer's file is read from its path where the driver is, and sent to the tasks, so it has to be there only.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blattwerk.llm.quality import common_words, prose_weights
from blattwerk.llm.textkernel import slices
from blattwerk.plans import spread

#: A file of byte-pair ranks (its vocabulary is used, nothing is trained).
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern by which that tokenizer parts a text before it joins bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts longer than this are encoded in parts, cut before a blank between two words,
#: where a byte-level tokenizer cuts anyway.
PART = 200_000
#: Least quality weight.
LEAST_WEIGHT = 0.05


def parts(text: str, size: int = PART) -> list[str]:
    out, at = [], 0
    while len(text) - at > size:
        cut = at + size
        while cut > at + 1 and not (text[cut] == " " and not text[cut - 1].isspace() and not text[cut + 1 : cut + 2].isspace()):
            cut -= 1
        if cut <= at + 1:  # no such blank
            break
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def _counter(name: str, lists: tuple | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(SparkFiles.get(name), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for batch in batches:
            texts = [x or "" for x in batch.column(2).to_pylist()]
            for a, b in slices(texts):
                n = [sum(len(encode(p)) for p in parts(x)) for x in texts[a:b]]
                w = [1.0] * (b - a) if lists is None else [max(LEAST_WEIGHT, x) for x in prose_weights(texts[a:b], *lists).tolist()]
                ids = (batch.column(i).slice(a, b - a) for i in range(2))
                yield pa.RecordBatch.from_arrays([*ids, pa.array(n, pa.int64()), pa.array(w, pa.float64())], ["doc_id", "source", "tokens", "weight"])

    return run


def token_sizes(documents: DataFrame, tokenizer: str = TOKENIZER, vocab: DataFrame | None = None) -> DataFrame:
    """``doc_id, source, tokens, weight`` of each document with an id; ``source`` trimmed and in
    lower case, '' for null; a null or empty text has 0 tokens. With ``vocab`` (see ``quality.common_words``)
    the weight is that of ``quality.prose_weights``, at least ``LEAST_WEIGHT``, else 1."""
    documents.sparkSession.sparkContext.addFile(tokenizer)
    rows = documents.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint"), F.coalesce(F.lower(F.trim("source")), F.lit("")).alias("source"), F.col("text").cast("string")
    )
    lists = None if vocab is None else common_words(vocab)
    return spread(rows).mapInArrow(_counter(os.path.basename(tokenizer), lists), "doc_id bigint, source string, tokens bigint, weight double")
