"""Language ID: multinomial naive Bayes over hashed character n-grams.

Counting and scoring are numpy work inside Spark tasks. A model has one log-probability for each bucket
and language and is broadcast; it holds at most BLOCK_LANGS languages. More languages make several
models, each scored in a step of its own that carries the best language so far and the sum of all
likelihoods, so any number is learned and told apart. Of each language one short row, its count of
documents, reaches the driver.

Texts are scored in batches: the buckets of a batch's n-grams are the entries of a sparse matrix (texts by
buckets), whose product with the model is summed row by row of the batch.

Defined results: a null text, or one without a letter, is `und` with score 0; so is everything if
nothing can be learned from. Rows with a null text or language are not learned from; a null doc_id is
never held out; repeated rows count and are predicted each; equal scores give the language that comes
first by code point; an empty table gives an empty result. Texts are read whole, in chunks of memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, discard

ORDERS = (1, 2, 3, 4)
BITS = 16
#: Languages of one model; it has 4 << BITS bytes for each.
BLOCK_LANGS = 128
#: Documents learned from, at most about so many of each language; the sample is drawn by hash of id and text.
MAX_TRAIN = 4000
#: Code points hashed at once, and n-grams whose rows of the model are added at once, in the cache.
CHUNK = 1 << 20
ADDED = 1 << 14


def pieces(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, int]]:
    """(number of the text, code points, how many of them belong to the piece before): lower-cased texts, long ones in pieces."""
    over = max(ORDERS) - 1
    for k, t in enumerate(texts):
        codes = np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
        for at in range(0, len(codes), CHUNK):
            skip = min(over, at)
            yield k, codes[at - skip : at + CHUNK], skip


def grams(texts: list[str | None], bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers of texts, hash buckets) of all character n-grams of whole texts, some at a time, texts in order."""
    held: list[tuple[int, np.ndarray, int]] = []
    size = 0
    for piece in pieces(texts):
        held.append(piece)
        size += len(piece[1])
        if size >= CHUNK:
            yield from hashed(held, bits)
            held, size = [], 0
    if held:
        yield from hashed(held, bits)


def hashed(held: list[tuple[int, np.ndarray, int]], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    codes = np.concatenate([x for _, x, _ in held])
    size = np.array([len(x) for _, x, _ in held])
    owner = np.repeat(np.array([k for k, _, _ in held]), size)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size)
    skip = np.repeat(np.array([s for _, _, s in held]), size)
    h = np.zeros(len(codes), np.uint32)
    for n in ORDERS:
        if n > len(codes):
            break
        h = h[: len(codes) - n + 1] * np.uint32(0x01000193) + (codes[n - 1 :] + np.uint32(n)) * np.uint32(0x9E3779B1)
        mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        # an n-gram lies in one piece, and ends in the part that no piece before had
        own = place[n - 1 :] >= np.maximum(skip[n - 1 :], n - 1)
        yield owner[n - 1 :][own], mixed[own] >> np.uint32(32 - bits)


def held_out(key: str) -> Column:
    """crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def languages(rows: DataFrame, lang: str) -> dict[str, int]:
    """Each language, by code point, with its count of rows."""
    return {r[0]: r[1] for r in sorted(rows.groupBy(lang).count().collect())}


def train(rows: DataFrame, text: str, lang: str, key: str, there: dict[str, int], langs: list[str], max_train: int) -> np.ndarray:
    """The model of langs: log-probabilities [bucket, language]; the last row has the priors."""
    # the sample: rows whose hash, of id and text, lies under a share of the language's rows
    share = F.create_map(*[x for name in langs for x in (F.lit(name), F.lit(min(1.0, max_train / there[name])))])
    draw = F.pmod(F.xxhash64(key, text, F.lit("sample")), F.lit(1 << 20)) < share[F.col(lang)] * (1 << 20)
    number = {name: k for k, name in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            own = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            for k, b in grams(batch.column(1).to_pylist()):
                of = own[k]
                for x in np.unique(of).tolist():
                    mine = total.setdefault(x, np.zeros(1 << BITS, np.int64))
                    mine += np.bincount(b[of == x], minlength=1 << BITS)
        for k, own in total.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(own[at])], names=["k", "b", "n"])

    sums = cut(rows.filter(F.col(lang).isin(langs) & draw).select(lang, text).mapInArrow(count, "k int, b int, n long").groupBy("k", "b").agg(F.sum("n").alias("n")), "gram-counts")
    table = np.zeros((1 << BITS, len(langs)))
    got = sums.toPandas()  # buckets times languages at most, as the model
    table[got["b"], got["k"]] = got["n"]
    discard(sums)
    model = np.empty(((1 << BITS) + 1, len(langs)), np.float32)
    model[:-1] = np.log((table + 0.1) / (table.sum(0) + 0.1 * len(table)))
    model[-1] = np.log(np.array([there[x] for x in langs]) / sum(there.values()))
    return model


def score(texts: list[str | None], model: np.ndarray) -> np.ndarray:
    """(texts, languages) log-likelihoods: the sparse matrix of n-grams times the model, and the priors."""
    total = np.repeat(model[-1:].astype(np.float64), len(texts), axis=0)
    for owner, b in grams(texts):
        for at in range(0, len(b), ADDED):
            k, rows = owner[at : at + ADDED], model.take(b[at : at + ADDED], axis=0)
            first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
            total[k[first]] += np.add.reduceat(rows, first, axis=0)  # a text comes once in a run
    return total


def predict(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; learns from rows that are not held out."""
    rows = docs.filter(~held_out(key) & F.col(text).isNotNull() & F.col(lang).isNotNull())
    there = languages(rows, lang)
    given = docs.select(F.col(key).cast("long").alias("doc_id"), held_out(key).alias("held_out"), F.col(text).alias("t"))
    # the best language so far, its log-likelihood, and the logarithm of the sum of all likelihoods
    now = given.withColumns({"lang_pred": F.lit("und"), "best": F.lit(float("-inf")), "sum": F.lit(float("-inf"))})
    names = list(there)
    for at in range(0, len(names), BLOCK_LANGS):
        langs = names[at : at + BLOCK_LANGS]
        shared = docs.sparkSession.sparkContext.broadcast((langs, train(rows, text, lang, key, there, langs, max_train)))
        now = now.mapInArrow(step(shared), "doc_id long, held_out boolean, t string, lang_pred string, best double, sum double")
    return now.select("doc_id", "held_out", "lang_pred", F.when(F.col("sum") > float("-inf"), F.exp(F.col("best") - F.col("sum"))).otherwise(0.0).alias("score"))


def step(shared):
    """Scores one model's languages and keeps the running best."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, model = shared.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            read = np.array([t is not None and any(map(str.isalpha, t)) for t in texts], bool)
            total = score([t if ok else None for t, ok in zip(texts, read, strict=True)], model)
            own = total.argmax(1)
            most = total.max(1)
            pred = batch.column(3).to_numpy(zero_copy_only=False).astype(object)
            best, all_ = (batch.column(c).to_numpy() for c in (4, 5))
            better = read & (most > best)
            pred[better] = np.array(langs, object)[own[better]]
            sums = np.where(read, np.logaddexp(all_, most + np.log(np.exp(total - most[:, None]).sum(1))), all_)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(pred, pa.string()), pa.array(np.where(better, most, best)), pa.array(sums)], names=["doc_id", "held_out", "t", "lang_pred", "best", "sum"])

    return label
