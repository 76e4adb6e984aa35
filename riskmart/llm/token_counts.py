"""op2: exact token counts by a map-side two-tier lookup.

A SentencePiece BPE model never merges across the start of a white-space run, nor across a
line feed, as no piece holds a space mark after another character or a line feed at all
(checked when the model is loaded).  So a text's count is the sum of its pre-tokens'
counts, and pre-tokens repeat.

* Tier 1: the corpus' frequent pre-tokens and their lengths in tokens, a compact table of at
  most ``max_entries`` short strings, broadcast once.  It comes from a first pass in which
  every task counts all its pre-tokens in a bounded summary; only each task's
  leaders are merged.
* Tier 2: a cache in each Python worker; a pre-token missing from both is encoded by the
  library.

The table and the cache only save work: counts do not depend on them, and no pre-token of
the second pass is shuffled.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import fresh, ship, slices, table, texts

MODEL = "piece_bpe_32k.model"
SPACE_MARK = "▁"
PRETOKEN = re.compile(f"[ {SPACE_MARK}]*[^ {SPACE_MARK}\n]+|[ {SPACE_MARK}]+")
#: Longest pre-token that is kept in the table or in a worker's cache, and entries of a cache.
MAX_KEY_CHARS, MAX_CACHE = 64, 500_000

_MODELS: dict = {}
_CACHES: dict = {}


def load_model(path: str):
    """The processor of a model file, one for each worker; checks that splitting is safe."""
    if path not in _MODELS:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if SPACE_MARK in piece.lstrip(SPACE_MARK) or "\n" in piece:
                raise ValueError(f"pieces of {path} cross pre-token boundaries: {piece!r}")
        _MODELS[path] = sp
    return _MODELS[path]


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text but its line feeds, which are a token each.

    The text gets one space in front, as the library does.  A pre-token after one space is
    given without it, one at a line's start with a line feed before it, others as they are.
    """
    found: list[str] = []
    if not text:
        return found
    marked = SPACE_MARK in text
    for i, line in enumerate(text.split("\n")):
        first, *rest = words = line.split(" ")
        if marked or "" in words:  # runs of spaces
            for w in PRETOKEN.findall(" " + line if i == 0 else line):
                if w[0] not in (" ", SPACE_MARK):
                    found.append("\n" + w)
                else:
                    found.append(w[1:] if len(w) > 1 and w[1] not in (" ", SPACE_MARK) else w)
        else:
            found.append(first if i == 0 else "\n" + first)
            found += rest
    return found


def pretoken_lengths(sp, found: list[str]) -> list[int]:
    """Tokens of each pre-token; the library puts one space mark before every text.

    After a line feed it is on the line feed's side, so these two tokens are taken off.
    """
    spaced = [t[0] in (" ", SPACE_MARK) for t in found]
    ids = sp.encode([t[1:] if s else t for t, s in zip(found, spaced)], num_threads=1)
    return [(max(len(i), 1) if s else len(i) - 2 if t[0] == "\n" else len(i)) for i, t, s in zip(ids, found, spaced)]


class Lengths:
    """Pre-token -> tokens: the broadcast table, then two generations of a worker's cache.

    When the young generation is full it becomes the old one, so memory is bounded and
    pre-tokens in use stay.
    """

    def __init__(self, sp, known: dict[str, int]):
        self.sp, self.known, self.old = sp, known, {}
        self.young = dict(known)

    def __call__(self, found: list[str]) -> int:
        lengths = list(map(self.young.get, found))
        if None in lengths:
            missing = list({t for t, n in zip(found, lengths) if n is None})
            new = {t: n for t in missing if (n := self.old.get(t)) is not None}
            rest = [t for t in missing if t not in new]
            new |= zip(rest, pretoken_lengths(self.sp, rest))
            total = sum(new[t] if n is None else n for t, n in zip(found, lengths))
            if len(self.young) > MAX_CACHE + len(self.known):
                self.old, self.young = self.young, dict(self.known)
            self.young.update((t, n) for t, n in new.items() if len(t) <= MAX_KEY_CHARS)
            return total
        return sum(lengths)


def count_tokens(lengths: Lengths, text: str) -> int:
    return lengths(pretokens(text)) + text.count("\n")


def frequent_pretokens(df: DataFrame, text_col: str, max_entries: int, per_task: int) -> DataFrame:
    """(token, n): the leaders of every task's bounded pre-token summary, merged."""
    def leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in slices(batches):
            for t in texts(batch.column(0)):
                seen.update(pretokens(t))
                if len(seen) > 20 * per_task:  # lossy counting: the rare half goes
                    seen = Counter(dict(seen.most_common(10 * per_task)))
        top = [(t, n) for t, n in seen.most_common(per_task) if len(t) <= MAX_KEY_CHARS]
        yield pa.RecordBatch.from_pydict({"token": pa.array([t for t, _ in top], pa.string()),
                                          "n": pa.array([n for _, n in top], pa.int64())})

    found = df.select(text_col).mapInArrow(leaders, "token string, n long")
    return found.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(max_entries)


def token_counts(df: DataFrame, model_path: str, text_col: str = "text", over: int = 4096,
                 max_entries: int = 20_000, per_task: int = 5_000) -> DataFrame:
    """``df`` with n_bytes, n_tokens and over_limit of every whole text.

    A null text counts as empty (0 bytes, 0 tokens).  All columns of ``df`` are kept but
    those of the three names, which are replaced.
    """
    spark = df.sparkSession
    ship(spark)
    sp = load_model(model_path)
    top = frequent_pretokens(df, text_col, max_entries, per_task).collect()  # at most max_entries short strings
    names = [r.token for r in top]
    packed = spark.sparkContext.broadcast(("".join(names), np.array([len(t) for t in names], np.uint8),
                                           np.array(pretoken_lengths(sp, names), np.uint16)))

    table_id = uuid.uuid4().hex

    def lengths() -> Lengths:
        key = (model_path, table_id)
        if key not in _CACHES:
            joined, widths, counts = packed.value
            ends = np.cumsum(widths, dtype=np.int64).tolist()
            known = {joined[a:b]: n for a, b, n in zip([0, *ends], ends, counts.tolist())}
            _CACHES.clear()
            _CACHES[key] = Lengths(load_model(model_path), known)
        return _CACHES[key]

    source = df.drop("n_bytes", "n_tokens", "over_limit")
    text_copy, = fresh(source, "text_of_count")
    kept = [c for c in source.columns if c != text_col]
    schema = source.select(*kept).schema.add("n_bytes", "long").add("n_tokens", "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lengths()
        for batch in slices(batches):
            ts = texts(batch.column(batch.num_columns - 1))
            arrays = batch.columns[:-1] + [pa.array([len(t.encode()) for t in ts], pa.int64()),
                                           pa.array([count_tokens(known, t) for t in ts], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    out = source.select(*kept, F.col(text_col).alias(text_copy)).mapInArrow(count, schema)
    return out.withColumn("over_limit", F.col("n_tokens") > over)


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    """Exact SentencePiece token counts of all ``documents`` (two-tier lookup)."""
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path(MODEL))
