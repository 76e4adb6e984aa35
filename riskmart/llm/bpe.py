"""op6: byte-level BPE encoding and decoding by a local rank file (tiktoken library).

Long texts are encoded in parts.  A part may only end where the split pattern ends a match
whatever stands around it: between a word character and a single space that another word
character follows.  No alternative of the pattern crosses that place, and the next match
starts with the space, so the ids of the parts, joined, are the ids of the whole text.  A
text without such a place is one part.  Decoding joins the raw bytes of the ids, which may
cut characters, and only the whole is ever read as text.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm.common import fresh, ship, slices, table, texts

RANKS = "byte_bpe_multi_50k.tiktoken"
PART_CHARS = 32_768
SAFE_CUT = re.compile(r"\w(?= \w)")
#: White space as the pattern's library knows it, in runs too long for its backtracking.
LONG_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{10000,}")
_ENCODINGS: dict = {}


def load_encoding(path: str, pattern: str):
    """The encoding of a rank file, one for each worker; special tokens do not exist."""
    if (path, pattern) not in _ENCODINGS:
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _ENCODINGS[path, pattern] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path, pattern]


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """The text cut at safe places, each part at least ``size`` characters but the last."""
    start = 0
    while len(text) - start > size:
        cut = SAFE_CUT.search(text, start + size - 1)
        if not cut:
            break
        yield text[start:cut.end()]
        start = cut.end()
    yield text[start:]


def encode(encoding, text: str) -> np.ndarray:
    """Ids of the whole text as little-endian unsigned 32-bit integers.

    A very long white-space run is one match of the pattern, without its last character if
    more text follows, and overflows the library's regular expressions: it is merged directly.
    """
    ids: list[int] = []
    at = 0
    for run in LONG_SPACE.finditer(text):
        for part in parts(text[at:run.start()]):
            ids += encoding.encode_ordinary(part)
        at = run.end() if run.end() == len(text) else run.end() - 1
        ids += encoding._encode_single_piece(text[run.start():at])
    for part in parts(text[at:]):
        ids += encoding.encode_ordinary(part)
    return np.array(ids, dtype="<u4")


def bpe_round_trip(df: DataFrame, rank_path: str, pattern: str, text_col: str = "text",
                   with_ids: bool = False, decoded: bool = False) -> DataFrame:
    """``df`` with n_tokens, ids_sha256 and decoded_sha256 of every whole text.

    A null text counts as empty: no ids, and both digests are those of the empty string.
    ``with_ids`` adds ``ids`` (array of int) and ``decoded`` adds ``decoded_text``.  Other
    columns stay; columns of those names are replaced, and the text column goes.
    """
    ship(df.sparkSession)
    source = df.drop("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded_text")
    text_copy, = fresh(source, "text_to_encode")
    kept = [c for c in source.columns if c != text_col]
    schema = source.select(*kept).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    if decoded:
        schema = schema.add("decoded_text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(rank_path, pattern)
        for batch in slices(batches):
            n, digest, back, all_ids, all_text = [], [], [], [], []
            for t in texts(batch.column(batch.num_columns - 1)):
                ids = encode(encoding, t)
                raw = encoding.decode_bytes(ids.tolist())
                n.append(len(ids))
                digest.append(hashlib.sha256(ids.tobytes()).hexdigest())
                back.append(hashlib.sha256(raw).hexdigest())
                if with_ids:
                    all_ids.append(ids.astype(np.int32))
                if decoded:
                    all_text.append(raw.decode())
            arrays = batch.columns[:-1] + [pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(back, pa.string())]
            if with_ids:
                arrays.append(pa.array(all_ids, pa.list_(pa.int32())))
            if decoded:
                arrays.append(pa.array(all_text, pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return source.select(*kept, F.col(text_col).alias(text_copy)).mapInArrow(run, schema)


def op6_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids and their decoding, as digests, for all ``documents``."""
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
