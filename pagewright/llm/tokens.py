"""Sizes of texts in tokens of a public tokenizer; the vocabulary file is a parameter and never part of the repository."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOLDER = os.environ.get("PAGEWRIGHT_TOKENIZERS", "/opt/tokenizers")
DEFAULT = f"{FOLDER}/piece_bpe_32k.model"
#: How a .tiktoken vocabulary splits texts before merging; the file doesn't tell, so other vocabularies give their own.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def counter(path: str, split: str = SPLIT) -> Callable[[list[str]], list[int]]:
    """Counts tokens of texts with the tokenizer in the file: .model (sentencepiece), .tiktoken or .json (tokenizers)."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    if path.endswith(".tiktoken"):
        import base64

        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("own", pat_str=split, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [len(encoding.encode_ordinary(x)) for x in texts]
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    return lambda texts: [len(x.ids) for x in own.encode_batch(texts, add_special_tokens=False)]


def sizes(df: DataFrame, key: str, text: str, *keep: str, path: str = DEFAULT, split: str = SPLIT) -> DataFrame:
    """key, the kept columns and n_tokens (bigint) of every row with text; a row delivered twice counts once.

    Null and empty texts have no tokens and give no row. Whole texts are encoded; only the sizes are shuffled.
    """
    columns = [F.col(key).alias("k"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.col(text).alias("t")]
    source = df.filter(F.length(text) > 0).select(*columns)
    schema = ", ".join([f"k {df.schema[key].dataType.simpleString()}", *[f"c{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)], "n_tokens bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        count = counter(path, split)
        for batch in batches:
            n = pa.array(count(batch.column(batch.num_columns - 1).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], n], names=[*[f.name for f in batch.schema][:-1], "n_tokens"])

    out = source.mapInArrow(run, schema).filter("n_tokens > 0").dropDuplicates(["k"])
    return out.withColumnsRenamed({"k": key, **{f"c{i}": c for i, c in enumerate(keep)}})
