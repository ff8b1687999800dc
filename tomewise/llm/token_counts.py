"""Token counts of whole texts: batch encoding in Arrow functions that return lengths only.

A task cuts its texts into units: a text of up to ``UNIT`` code points is one, longer ones are split
where the tokenizer's pattern must end a match, so that the lengths of the units add up to that of
the text. Units are gathered into calls of about the same number of bytes, so neither one very long
text nor many short ones make a call large, and equal units of a call are encoded once.

The file's ending names the library: ``.json`` tokenizers, ``.model`` sentencepiece. Special strings
inside a text are handled as the library does by default; nothing is added, cut off or padded.

Null and empty texts have no bytes and no tokens. Repeated rows are counted alike, rows without
an id too. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, texts, worker_state

UNIT = 16 << 10  # code points from which a text is split
CALL = 256 << 10  # code points encoded by one call, but for a unit that cannot be split
LIMIT = 1024
RESULT = "doc_id long, n_bytes long, n_tokens long"

#: A blank or line end between a visible character and a letter or digit: byte-level patterns end
#: a match before it, whatever surrounds it, and no special string holds one.
BOUNDARY = re.compile(r"(?<=\S)[ \n](?=\w)")


def units(text: str, size: int = UNIT) -> list[str]:
    """The text in pieces of at least ``size`` code points (but the last), cut at safe boundaries."""
    if len(text) <= size:
        return [text]
    out, start = [], 0
    while len(text) - start > size:
        found = BOUNDARY.search(text, start + size)
        if found is None:
            break
        out.append(text[start : found.start()])
        start = found.start()
    return [*out, text[start:]]


def calls(pieces: list[str], size: int = CALL) -> Iterator[list[str]]:
    """The pieces in lists of about ``size`` code points."""
    held, total = [], 0
    for p in pieces:
        if held and total + len(p) > size:
            yield held
            held, total = [], 0
        held.append(p)
        total += len(p)
    if held:
        yield held


def splittable(spec: dict) -> bool:
    """Whether a tokenizer file splits by the byte-level pattern and leaves texts as they are."""
    before = spec.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    added = [t["content"] for t in spec.get("added_tokens") or () if t.get("lstrip") or t.get("rstrip") or re.search(r"\s", t["content"])]
    return bool(plain) and not spec.get("normalizer") and not added


def counter(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """The lengths of a list of texts, and whether long texts may be split."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda some: [len(x) for x in model.encode(some, num_threads=1)], False
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        splits = splittable(json.load(file))
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda some: [len(x) for x in tokenizer.encode_batch_fast(some, add_special_tokens=False)], splits


def lengths(docs: list[str], count: Callable[[list[str]], list[int]], splits: bool) -> np.ndarray:
    """Tokens of each text."""
    cut = [units(t) if splits else [t] for t in docs]
    known = {"": 0}
    for call in calls([u for u in dict.fromkeys(u for us in cut for u in us) if u]):
        known.update(zip(call, count(call), strict=True))
    return np.array([sum(known[u] for u in us) for us in cut], np.int64)


def count(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more tokens than ``limit``) of every row of doc_id, text."""

    def run(batches):
        loaded = worker_state()
        if ("counter", path) not in loaded:
            loaded["counter", path] = counter(path)
        for batch in chunks(batches):
            n_bytes = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            n_tokens = pa.array(lengths(texts(batch), *loaded["counter", path]))
            arrays = [batch.column("doc_id").cast(pa.int64()), n_bytes, n_tokens]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_tokens"])

    counted = docs.select("doc_id", "text").mapInArrow(run, RESULT)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
