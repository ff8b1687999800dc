"""TF-IDF over words and word pairs, truncated SVD, and a text embedder built on them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import NGram, StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions.text import book_text, text
from ..sources.workspace import cut


def terms(df: DataFrame, source: Column, stop_words: Sequence[str]) -> DataFrame:
    """Adds ``terms``: lower-case words of two or more characters without stop words, and
    pairs of words that then stand next to each other."""
    tokens = df.withColumn(
        "tokens", F.regexp_extract_all(F.lower(source), F.lit(lx.TOKEN), 0)
    )
    kept = StopWordsRemover(
        inputCol="tokens", outputCol="kept", stopWords=list(stop_words), caseSensitive=True
    ).transform(tokens)
    pairs = NGram(n=2, inputCol="kept", outputCol="pairs").transform(kept)
    return pairs.withColumn("terms", F.concat("kept", "pairs")).drop("tokens", "kept", "pairs")


#: Texts of these code points only are split in the tasks: libraries agree on their classes.
OTHER_THAN_LATIN = r"[^\x00-\xFF]"
LATIN_WORDS = bytes(c if chr(c).isalnum() or chr(c) == "_" else 32 for c in range(256))
LETTERS = frozenset(map(chr, range(256)))  # words have two characters or more
HELD_TERMS = 200_000  # counts that a task holds before it hands them on
SECOND_WORDS = 16  # times the wanted terms: words that may end a pair, sent to the tasks


def split_source(source: Column) -> Column:
    """What ``words_of`` reads: the lower-case text, or, where it has other than Latin-1 characters, its
    words with a blank after each one."""
    low = F.lower(source)
    other = F.coalesce(F.rlike(low, F.lit(OTHER_THAN_LATIN)), F.lit(False))
    words = F.concat_ws(" ", F.regexp_extract_all(low, F.lit(lx.TOKEN), F.lit(0)))
    return F.struct(F.when(other, words).otherwise(low).alias("text"), other.alias("split"))


def words_of(texts: Iterable[str | None], split: Iterable[bool], stop: frozenset[str]) -> Iterator[list[str]]:
    """The words of each text as ``terms`` finds them, without pairs."""
    left_out = stop | LETTERS
    for text_, done in zip(texts, split, strict=True):
        if text_ and not done:
            text_ = text_.encode("latin-1").translate(LATIN_WORDS).decode("latin-1")
        yield [w for w in (text_ or "").split() if w not in left_out]


def _counted(df: DataFrame, sources: Mapping[str, Column], stop_words: Sequence[str], pick) -> DataFrame:
    """(source, term, tf, df) of the terms that ``pick(source, words of a row)`` gives, added up. A task
    hands on sums, and holds a bounded number of them."""
    names, stop = list(sources), frozenset(stop_words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {n: (Counter(), Counter()) for n in names}

        def handed(name: str) -> pa.RecordBatch:
            tf, rows = held[name]
            arrays = [pa.array([name] * len(tf)), pa.array(list(tf), pa.string()),
                      pa.array(list(tf.values()), pa.int64()), pa.array([rows[t] for t in tf], pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, ["source", "term", "tf", "df"])

        for batch in batches:
            for name in names:
                tf, rows = held[name]
                text_, done = (batch.column(name).field(f).to_pylist() for f in ("text", "split"))
                for words in words_of(text_, done, stop):
                    found = pick(name, words)
                    tf.update(found)
                    rows.update(set(found))
                    if len(tf) > HELD_TERMS:
                        yield handed(name)
                        tf.clear()
                        rows.clear()
        for name in names:
            if held[name][0]:
                yield handed(name)

    texts = df.select(*[split_source(c).alias(n) for n, c in sources.items()])
    parts = texts.mapInArrow(count, "source string, term string, tf long, df long")
    return parts.groupBy("source", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def top_terms(
    df: DataFrame, sources: Mapping[str, tuple[Column, int]], stop_words: Sequence[str], min_df: int
) -> dict[str, list[tuple[str, int, int]]]:
    """Per source (text, size) the ``size`` most frequent words and pairs that ``min_df`` rows have, as
    (term, tf, df) by falling tf, then by term.

    Words are counted first. A pair is never more frequent than its words, and its first word comes before
    it in the order, so a pair can be among the ``size`` first terms only if its first word is among the
    ``size`` first words and its second word is as frequent as the last of those. Only such pairs are
    counted, in a second pass; nothing is left out.
    """
    columns = {n: c for n, (c, _) in sources.items()}
    words = cut(_counted(df, columns, stop_words, lambda _, found: found).where(F.col("df") >= min_df), "words")
    tops = _first(words, sources)
    first = {n: frozenset(t for t, _, _ in rows) for n, rows in tops.items()}
    # where more words than asked for exist, the last one bounds what a second word must have
    least = {n: rows[-1][1] if len(rows) == sources[n][1] else 0 for n, rows in tops.items()}
    bound = F.create_map(*[F.lit(x) for n in sources for x in (n, least.get(n, 0))])
    able = words.where(F.col("tf") >= bound[F.col("source")]).select("source", "term")
    # words level with the last one may be any number: beyond a bound all second words stay in
    limit = SECOND_WORDS * sum(size for _, size in sources.values())
    found = able.limit(limit + 1).collect()
    second = None if len(found) > limit else {n: frozenset(r.term for r in found if r.source == n) for n in sources}

    def pairs(name: str, found: list[str]) -> list[str]:
        begins, ends = first.get(name, frozenset()), second and second[name]
        return [f"{a} {b}" for a, b in zip(found, found[1:]) if a in begins and (ends is None or b in ends)]

    counted = _counted(df, columns, stop_words, pairs).where(F.col("df") >= min_df)
    more = _first(counted, sources)
    order = lambda row: (-row[1], row[0])
    return {n: sorted(tops.get(n, []) + more.get(n, []), key=order)[:size] for n, (_, size) in sources.items()}


def _first(counted: DataFrame, sources: Mapping[str, tuple[Column, int]]) -> dict[str, list[tuple[str, int, int]]]:
    rank = Window.partitionBy("source").orderBy(F.desc("tf"), "term")
    size = F.create_map(*[F.lit(x) for n, (_, k) in sources.items() for x in (n, k)])[F.col("source")]
    largest = max(k for _, k in sources.values())
    # the rank limit is applied before the shuffle; what is collected is a vocabulary
    top = counted.withColumn("rn", F.row_number().over(rank)).where(F.col("rn") <= largest).where(F.col("rn") <= size)
    out: dict[str, list[tuple[str, int, int]]] = {}
    for r in sorted(top.collect(), key=lambda r: r.rn):
        out.setdefault(r.source, []).append((r.term, r.tf, r.df))
    return out


@dataclass(frozen=True)
class TfIdf:
    """Vocabulary in alphabetical order, with its smoothed inverse document frequencies."""

    vocabulary: list[str]
    doc_freq: list[int]
    n_rows: int
    stop_words: tuple[str, ...] = lx.ENGLISH_STOP_WORDS

    @property
    def idf(self) -> list[float]:
        return [float(np.log((1 + self.n_rows) / (1 + d)) + 1) for d in self.doc_freq]

    def transform(self, df: DataFrame, source: Column, output: str = "tfidf") -> DataFrame:
        """Adds the weights as array<double> with Euclidean length 1 (or all 0)."""
        place = {t: i for i, t in enumerate(self.vocabulary)}
        idf, stop = np.array(self.idf), frozenset(self.stop_words)

        @F.pandas_udf("array<double>")
        def weights(rows: pd.DataFrame) -> pd.Series:
            out = np.zeros((len(rows), len(idf)))
            for row, words in zip(out, words_of(rows["text"], rows["split"], stop), strict=True):
                for term, n in Counter(chain(words, map(" ".join, zip(words, words[1:])))).items():
                    if (at := place.get(term)) is not None:
                        row[at] = n
            out *= idf
            length = np.sqrt((out * out).sum(1))[:, None]
            return pd.Series(list(out / np.where(length > 0, length, 1.0)), dtype=object)

        return df.withColumn(output, weights(split_source(source)))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, t, d, self.n_rows) for i, (t, d) in enumerate(zip(self.vocabulary, self.doc_freq))]
        # stop words travel in the same table, at positions below 0
        rows += [(-1 - i, t, 0, self.n_rows) for i, t in enumerate(self.stop_words)]
        return spark.createDataFrame(rows, "position int, term string, df long, n_rows long")

    @classmethod
    def from_frame(cls, frame: DataFrame) -> TfIdf:
        every = sorted(frame.collect(), key=lambda r: r.position)
        rows = [r for r in every if r.position >= 0]
        if not rows:
            raise ValueError("empty vocabulary")
        stop_words = tuple(r.term for r in reversed(every) if r.position < 0)
        return cls([r.term for r in rows], [r.df for r in rows], rows[0].n_rows, stop_words)


def fit_tfidf(
    df: DataFrame,
    sources: Mapping[str, tuple[Column, int]],
    min_df: int = lx.MIN_DOC_FREQ,
    stop_words: Sequence[str] = lx.ENGLISH_STOP_WORDS,
) -> dict[str, TfIdf]:
    """Per source (text, size) the ``size`` most frequent terms that ``min_df`` rows have."""
    top = top_terms(df, sources, stop_words, min_df)
    n_rows, out = df.count(), {}
    for name in sources:
        rows = sorted((term, n) for term, _, n in top[name])
        if not rows:
            raise ValueError(f"no term of {name} occurs in {min_df} rows")
        out[name] = TfIdf([t for t, _ in rows], [d for _, d in rows], n_rows, tuple(stop_words))
    return out


# -------------------------------------------------------------------- factorising
def matrix_of(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """Rows of a list column of equally long lists as a matrix."""
    values = batch.column(column)
    if len(values) == 0:
        return np.zeros((0, 0))
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(values), -1)


@dataclass(frozen=True)
class TruncatedSvd:
    """Projection on the leading right singular vectors (columns of ``components``)."""

    components: list[list[float]]
    singular_values: list[float]

    def transform(self, df: DataFrame, column: str, output: str) -> DataFrame:
        """Adds the projected vector; runs per Arrow batch, without a shuffle."""
        basis = np.array(self.components).T

        @F.pandas_udf("array<double>")
        def project(rows: pd.Series) -> pd.Series:
            if len(rows) == 0:
                return pd.Series([], dtype=object)
            return pd.Series(list(np.stack(rows.to_numpy()) @ basis))

        return df.withColumn(output, project(column))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = list(zip(range(len(self.components)), self.singular_values, self.components))
        return spark.createDataFrame(rows, "position int, s double, loading array<double>")

    @classmethod
    def from_frame(cls, frame: DataFrame) -> TruncatedSvd:
        rows = frame.orderBy("position").collect()
        return cls([list(r.loading) for r in rows], [r.s for r in rows])


OVERSAMPLING = 10
FEW_PLACES = 512  # so many places are their own directions: one pass over the rows, no power step
BLOCK_ROWS = 256
FAN_IN = 64


def fit_svd(
    df: DataFrame,
    columns: Mapping[str, int],
    tolerance: float = 1e-9,
    max_steps: int = 30,
    seed: int = 42,
) -> dict[str, TruncatedSvd]:
    """Per vector column its k leading components, by a randomised range finder.

    The rows are written once as their non-zero entries. A power step multiplies k + 10 directions by
    the rows and their transpose: tasks sum (place, direction) products, which are added up by place.
    Steps go on until no leading squared singular value changes by more than ``tolerance`` of the
    largest. The rows projected on the directions are then factored block by block, and the triangular
    factors in a tree, so the components are orthogonal over the rows to working precision. The
    driver holds places x (k + 10) numbers of a column, never places x places.
    """
    names = list(columns)
    rows = cut(df.select(*[_entries(F.col(n)).alias(n) for n in names]), "entries")
    sizes = rows.agg(*[F.max(f"{n}.size").alias(n) for n in names]).first()
    random, found = np.random.default_rng(seed), {}
    for name in names:
        size, k = sizes[name] or 0, columns[name]
        if size < 1 or k > size:
            raise ValueError(f"cannot take {k} components out of {size} columns")
        width = size if size <= FEW_PLACES else min(k + OVERSAMPLING, size)
        # directions that span everything need no power step
        found[name] = np.eye(size) if width == size else random.normal(size=(size, width))
    found = {n: np.linalg.qr(q)[0] for n, q in found.items()}
    moving = [n for n in names if found[n].shape[0] > found[n].shape[1]]
    before: dict[str, np.ndarray] = {}
    for _ in range(max_steps):
        if not moving:
            break
        products = _power_step(rows, {n: found[n] for n in moving})
        for name in list(moving):
            z, k = products[name], columns[name]
            squares = np.linalg.eigvalsh(found[name].T @ z)[::-1][:k]
            found[name] = np.linalg.qr(z)[0]
            last, before[name] = before.get(name), squares
            if last is not None and np.abs(squares - last).max() <= tolerance * max(squares[0], 1e-300):
                moving.remove(name)
    factors = _triangles(rows, found)
    return {n: _leading(found[n], factors.get(n), columns[n]) for n in names}


def _entries(vector: Column) -> Column:
    """Width, places and values of the entries that are not zero."""
    pairs = F.filter(
        F.transform(vector, lambda x, i: F.struct(i.cast("int").alias("i"), x.cast("double").alias("x"))),
        lambda e: e["x"] != 0,
    )
    return F.struct(F.size(vector).alias("size"), pairs["i"].alias("i"), pairs["x"].alias("x"))


def _blocks(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in use, dense block over those places), a bounded number of rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            row = batch.slice(start, BLOCK_ROWS).column(name)
            i, x = row.field("i"), row.field("x")
            lengths = np.diff(i.offsets.to_numpy())
            places = i.flatten().to_numpy(zero_copy_only=False)
            used, at = np.unique(places, return_inverse=True)
            block = np.zeros((len(lengths), len(used)))
            block[np.repeat(np.arange(len(lengths)), lengths), at] = x.flatten().to_numpy(zero_copy_only=False)
            yield used, block


def sum_arrays(parts: DataFrame, keys: Sequence[str], value: str = "v") -> DataFrame:
    """Equally long arrays added up by integer keys; every task holds the sums of its own keys."""
    names, schema = [*keys, value], parts.select(*keys, value).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                at = zip(*[batch.column(k).to_pylist() for k in keys])
                for key, row in zip(at, batch.column(value)):
                    x = row.values.to_numpy(zero_copy_only=False)
                    sums[key] = sums[key] + x if key in sums else x.copy()
        if sums:
            columns = [pa.array(c, pa.int32()) for c in zip(*sums)]
            yield pa.RecordBatch.from_arrays([*columns, list_arrays(list(sums.values()))], names=names)

    return parts.select(*names).repartition(*keys).mapInArrow(add, schema)


def list_arrays(rows: Sequence[np.ndarray]) -> pa.Array:
    """A list column with one array a row."""
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows)))


def _power_step(rows: DataFrame, bases: Mapping[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Per column the transposed rows times the rows times its directions."""
    names, spark = list(bases), rows.sparkSession
    shared = spark.sparkContext.broadcast([bases[n] for n in names])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros_like(q) for q in shared.value]
        for batch in batches:
            for c, name in enumerate(names):
                for used, block in _blocks(iter([batch]), name):
                    sums[c][used] += block.T @ (block @ shared.value[c][used])
        for c, z in enumerate(sums):
            at = np.flatnonzero(z.any(axis=1))
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c] * len(at), pa.int32()), pa.array(at, pa.int32()), list_arrays(z[at])],
                    names=["c", "i", "v"],
                )

    parts = rows.select(*names).mapInArrow(multiply, "c int, i int, v array<double>")
    out = {n: np.zeros_like(q) for n, q in bases.items()}
    for r in sum_arrays(parts, ["c", "i"]).toLocalIterator():
        out[names[r.c]][r.i] = r.v
    shared.unpersist()
    return out


def _triangles(rows: DataFrame, bases: Mapping[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Per column the triangular factor of the rows projected on its directions. Factors of tasks
    are stacked and factored again, at most 64 at a time, until few enough are left for the driver."""
    names, spark = list(bases), rows.sparkSession
    shared = spark.sparkContext.broadcast([bases[n] for n in names])

    def written(factors: Mapping[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for c, r in factors.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], pa.int32()), list_arrays([r.ravel()])], names=["c", "r"]
            )

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, name in enumerate(names):
                for used, block in _blocks(iter([batch]), name):
                    _stack(factors, c, block @ shared.value[c][used])
        yield from written(factors)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, r in zip(batch.column("c").to_pylist(), batch.column("r")):
                _stack(factors, c, r.values.to_numpy(zero_copy_only=False).reshape(-1, shared.value[c].shape[1]))
        yield from written(factors)

    schema = "c int, r array<double>"
    level = cut(rows.mapInArrow(project, schema), "triangles")
    while (n := level.count()) > FAN_IN * len(names):
        level = cut(level.repartition(-(-n // FAN_IN)).mapInArrow(merge, schema), "triangles")
    factors: dict[int, np.ndarray] = {}
    for r in level.collect():
        _stack(factors, r.c, np.array(r.r).reshape(-1, bases[names[r.c]].shape[1]))
    shared.unpersist()
    return {names[c]: r for c, r in factors.items()}


def _stack(factors: dict[int, np.ndarray], c: int, block: np.ndarray) -> None:
    stacked = np.vstack([factors[c], block]) if c in factors else block
    factors[c] = np.linalg.qr(stacked, mode="r")


def _leading(basis: np.ndarray, triangle: np.ndarray | None, k: int) -> TruncatedSvd:
    if triangle is None:
        triangle = np.zeros((1, basis.shape[1]))
    _, values, turned = np.linalg.svd(triangle, full_matrices=True)
    values = np.concatenate([values, np.zeros(max(k - len(values), 0))])
    components = turned[:k] @ basis.T
    # a component's sign is free: make its largest loading positive
    largest = np.abs(components).argmax(axis=1)
    signs = np.sign(components[np.arange(k), largest])
    components = components * np.where(signs == 0, 1.0, signs)[:, None]
    return TruncatedSvd(components.tolist(), values[:k].tolist())


@dataclass(frozen=True)
class TextEmbedder:
    """Dense vectors for texts: TF-IDF projected on its leading components."""

    tfidf: TfIdf
    svd: TruncatedSvd

    def transform(self, df: DataFrame, source: Column, output: str = "embedding") -> DataFrame:
        weighted = self.tfidf.transform(df, source, "weighted")
        return self.svd.transform(weighted, "weighted", output).drop("weighted")

    def save(self, spark: SparkSession, path: str) -> None:
        self.tfidf.to_frame(spark).write.mode("overwrite").parquet(f"{path}/terms")
        self.svd.to_frame(spark).write.mode("overwrite").parquet(f"{path}/svd")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TextEmbedder:
        return cls(
            TfIdf.from_frame(spark.read.parquet(f"{path}/terms")),
            TruncatedSvd.from_frame(spark.read.parquet(f"{path}/svd")),
        )


def fit_text_embedders(
    df: DataFrame, sources: Mapping[str, tuple[Column, int, int]]
) -> dict[str, TextEmbedder]:
    """Per source (text, vocabulary size, width) an embedder; two passes for all of them."""
    tfidf = fit_tfidf(df, {n: (c, size) for n, (c, size, _) in sources.items()})
    weighted = df.select(*[c.alias(f"src_{n}") for n, (c, _, _) in sources.items()])
    for n in sources:
        weighted = tfidf[n].transform(weighted, F.col(f"src_{n}"), f"weighted_{n}")
    widths = {
        f"weighted_{n}": min(k, len(tfidf[n].vocabulary)) for n, (_, _, k) in sources.items()
    }
    svd = fit_svd(weighted, widths)
    return {n: TextEmbedder(tfidf[n], svd[f"weighted_{n}"]) for n in sources}


def title_source() -> Column:
    return text("title")


def description_source() -> Column:
    return text("description")


def book_source() -> Column:
    return book_text()
