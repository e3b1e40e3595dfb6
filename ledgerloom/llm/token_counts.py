"""Token counts from flat token files by separator scan.

Texts are tokenized into flat streams, one for each input partition: only tokens, each
text followed by the end-of-document identifier, cut into blocks of equal size wherever
the cut falls. The scan searches each block for separators at once; a prefix scan over
the blocks of a stream carries the tokens left open at a block's end to the block where
the next separator stands. A stream is as long as an input partition, never the table.

Defined results: NULL and empty texts have no tokens and count 0; strings that look like
the separator are ordinary text; repeated rows and NULL ids are counted each; an empty
table gives an empty one.
"""

from __future__ import annotations

import base64
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.words import slices
from ledgerloom.session import ensure_checkpoint_dir

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_OF_DOCUMENT = 50256
BLOCK_TOKENS = 1 << 18
# Fixed value: how the tokenizer of this vocabulary splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def write_token_files(df: DataFrame, folder: str, id_column: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
                      end: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS) -> None:
    """Write streams as rows ``(stream, block, tokens, ids)``; ``ids`` names the texts that end in the block, in order."""
    kind = np.uint16 if end < 1 << 16 else np.uint32

    def work(batches):
        encode, stream, block = load_tokenizer(tokenizer).encode_ordinary, TaskContext.get().partitionId(), 0
        open_, size, ids, ended = [], 0, [], []
        stop = np.array([end], kind)

        def cut(final=False):
            nonlocal open_, size, ids, ended, block
            flat = np.concatenate(open_) if open_ else np.zeros(0, kind)
            whole = len(flat) if final else len(flat) // block_tokens * block_tokens
            rows, done = [], 0
            for a in range(0, whole, block_tokens):
                b = min(a + block_tokens, whole)
                upto = int(np.searchsorted(ended, b, "right"))
                rows.append((stream, block, flat[a:b].tobytes(), ids[done:upto]))
                done, block = upto, block + 1
            open_, size, ids, ended = [flat[whole:]], len(flat) - whole, ids[done:], [e - whole for e in ended[done:]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names) if rows else None

        for batch in batches:
            for part in slices(batch, "text"):
                for i, t in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                    tokens = np.array(encode(t), kind) if t else stop[:0]
                    open_ += [tokens, stop]
                    size += len(tokens) + 1
                    ids.append(i)
                    ended.append(size)
                    if size >= 4 * block_tokens:
                        yield cut()
        if (rest := cut(True)) is not None:
            yield rest

    kinds, names = [pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())], ["stream", "block", "tokens", "ids"]
    narrow = df.select(df[f"`{id_column}`"].cast("long").alias("id"), df[f"`{text}`"].alias("text"))
    narrow.mapInArrow(work, "stream int, block int, tokens binary, ids array<long>").write.option("compression", "zstd").parquet(folder)


def scan_blocks(files: DataFrame, end: int = END_OF_DOCUMENT) -> DataFrame:
    """Of each block: separators, tokens before the first (``head``), after the last (``tail``), and between (``inner``)."""
    kind = np.uint16 if end < 1 << 16 else np.uint32

    def work(batches):
        for batch in batches:
            rows = []
            for blob in batch.column(2):
                tokens = np.frombuffer(blob.as_buffer(), kind)
                at = np.flatnonzero(tokens == end)
                head, tail = (int(at[0]), len(tokens) - int(at[-1]) - 1) if len(at) else (0, len(tokens))
                rows.append((len(at), head, tail, np.diff(at) - 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, t) for c, t in zip(zip(*rows), kinds)], batch.column(3)], names=names)

    kinds, names = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())], ["stream", "block", "ends", "head", "tail", "inner", "ids"]
    return files.select("stream", "block", "tokens", "ids").mapInArrow(work, "stream int, block int, ends long, head long, tail long, inner array<long>, ids array<long>")


def stitch(blocks: DataFrame) -> DataFrame:
    """``(id, n_tokens)`` of every text, joining what lies across blocks by a prefix scan over each stream."""
    order = Window.partitionBy("stream").orderBy("block")
    run = F.sum((F.col("ends") > 0).cast("int")).over(order)
    left = F.sum("tail").over(Window.partitionBy("stream", "run").orderBy("block"))
    carried = blocks.withColumn("run", run).withColumn("open", left).withColumn("carry", F.coalesce(F.lag("open").over(order), F.lit(0)))
    counts = F.concat(F.array(F.col("carry") + F.col("head")), F.col("inner"))
    return carried.filter("ends > 0").select(F.inline(F.arrays_zip(F.col("ids").alias("id"), counts.alias("n_tokens"))))


def token_counts(df: DataFrame, id_column: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, end: int = END_OF_DOCUMENT,
                 block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``(id, n_tokens)`` of every row, by way of token files beside the checkpoints."""
    spark: SparkSession = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_token_files(df, folder, id_column, text, tokenizer, end, block_tokens)
    return stitch(scan_blocks(spark.read.parquet(folder), end)).withColumnRenamed("id", id_column)
