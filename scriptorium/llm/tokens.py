"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import functools
import os

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise
from ..tables import load

#: Rank file of a byte-level BPE; any other file of that kind may be named instead.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern by which that vocabulary's texts were cut before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(2)
def encoder(path: str = RANKS):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _here(path: str) -> str:
    """The file as it lies on this machine: at its path, else where the job's files were sent."""
    return path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))


def count_tokens(docs: DataFrame, keep: list[str], path: str = RANKS) -> DataFrame:
    """The ``keep`` columns and ``tokens``; a NULL text has no tokens (NULL), an empty one 0.

    The tokenizer's file is sent to the executors with the job."""
    docs.sparkSession.sparkContext.addFile(path)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(batches):
        enc = encoder(_here(path))
        for pdf in batches:
            n = [None if t is None else len(enc.encode_ordinary(t)) for t in pdf["text"]]
            yield pdf[keep].assign(tokens=pd.array(n, dtype="Int64"))

    return docs.select(*keep, "text").mapInPandas(run, kinds + ", tokens long")


def document_sizes(spark: SparkSession, sf_dir: str, path: str = RANKS) -> DataFrame:
    """doc_id, source, tokens of all documents, counted once and kept."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", "text")
    parts = max(docs.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    return materialise(count_tokens(docs.repartition(parts) if parts > docs.rdd.getNumPartitions() else docs, ["doc_id", "source"], path).where(F.col("tokens").isNotNull()))
