"""Token counts of whole texts with a public byte-pair vocabulary."""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame

#: Place of the vocabulary; every executor must see it. It is read, never copied or trained.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published split pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_loaded: dict = {}


def encoding(vocabulary: str = VOCABULARY):
    """The tokenizer, built once a worker process."""
    if vocabulary not in _loaded:
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[vocabulary] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[vocabulary]


def counter(text: str, vocabulary: str):
    """mapInArrow function: every column but `text`, and n_tokens (0 for null and empty texts)."""

    def run(batches):
        encode = encoding(vocabulary).encode_ordinary
        for batch in batches:
            at = batch.schema.get_field_index(text)
            n = pa.array([len(encode(x)) if x else 0 for x in batch.column(at).to_pylist()], pa.int64())
            keep = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], n], [*[batch.schema.names[i] for i in keep], "n_tokens"])

    return run


def with_token_counts(df: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """`df` without `text`, with n_tokens of the whole text."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != text]
    return df.mapInArrow(counter(text, vocabulary), ", ".join([*fields, "n_tokens bigint"]))
