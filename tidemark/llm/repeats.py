"""Repeated byte strings over a whole corpus, by induction from a sample of suffixes.

A byte goes if a string of `length` bytes covers it that also starts anywhere else, in any document. No
suffix array is held whole. Every window of `length` bytes names one sampled suffix that starts in it:
the one whose first GRAM bytes have the smallest hash, the leftmost of equals. Equal windows name their
sample at equal offsets, so all that follows happens among suffixes of one sample class, in Spark's own
sort and shuffle, which spill to disk:

1. samples: each document's windows fall into cells, runs of windows with one sampled suffix; a cell
   carries the hash of its sample's first bytes and of all the bytes its windows cover (its class);
2. samples whose first bytes occur once in the corpus are dropped, and with them most of the text;
3. cells of a class that occurs twice or more are repeated whole;
4. where a sample has several classes, the windows of one cell of each class are induced from it, by
   their offset to the sample. Windows go in blocks of BLOCK offsets: what all of a block's windows have
   in common must occur in two classes, else none of them is repeated; if all that they cover does, each
   of them is; only windows of the other blocks are hashed one by one and compared.

A hash is only ever compared under an equal hash of other bytes, so 128 bits decide. A class that
thousands of documents share counts once in step 4.

Defined results: a null text is empty; a text shorter than `length` loses nothing; repeated rows repeat
each other; a null doc_id is a document like any other; an empty table gives an empty result. Extra
columns are not read. A task holds one document and arrays over at most CHUNK of its windows; a row holds
PER_ROW cells of a document at most, or its spans, at most one for each `length` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

LENGTH = 400
GRAM = 64
CHUNK = 1 << 22
#: Cells of one document in a row.
PER_ROW = 1 << 16
BLOCK = 16
MULTIPLIER = 0x9E3779B97F4A7C15
TABLE = np.random.default_rng(1).integers(0, 1 << 63, 256, dtype=np.uint64)
PLACE = np.uint64((1 << 32) - 1)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the gram (a power of two) bytes from each place, by doubling."""
    h, m = TABLE[data], 1
    while m < gram:
        h = h[:-m] * np.uint64(pow(MULTIPLIER, m, 1 << 64)) + h[m:]
        m *= 2
    return h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` neighbours, from minima over blocks' heads and tails."""
    n = len(x) - width + 1
    full = np.concatenate([x, np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    heads = np.minimum.accumulate(full, axis=1).ravel()
    tails = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tails[:n], heads[width - 1 : width - 1 + n])


def cells(data: bytes, length: int = LENGTH, gram: int = GRAM) -> list[tuple[np.ndarray, ...]]:
    """All of cells_by_chunk()."""
    return list(cells_by_chunk(data, length, gram))


def cells_by_chunk(data: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """(first window, last window, sample's place, sample's hash, class) arrays of a text's cells, a chunk at a time."""
    at = 0
    step = max(CHUNK, length)  # windows at once, more than one cell has
    while at <= len(data) - length:
        part = np.frombuffer(data, np.uint8, min(step + length - 1, len(data) - at), at)
        h = gram_hashes(part, gram)
        order = ((h * np.uint64(0xD6E8FEB86659FD93)) & ~PLACE) | np.arange(len(h), dtype=np.uint64)
        sample = sliding_min(order, length - gram + 1)
        first = np.flatnonzero(np.concatenate(([True], sample[1:] != sample[:-1])))
        last = np.append(first[1:], len(sample)) - 1
        ended = at + len(sample) + length > len(data)
        if not ended:  # the last cell may go on: the next chunk starts with it
            first, last = first[:-1], last[:-1]
        place = (sample[first] & PLACE).astype(np.int64)
        digest = xxhash.xxh3_64_intdigest
        view = memoryview(data)
        kind = np.array([digest(view[a : b + length]) for a, b in zip((first + at).tolist(), (last + at).tolist(), strict=True)], np.uint64)
        yield first + at, last + at, place + at, h[place].view(np.int64), kind.view(np.int64)
        at += len(sample) if ended else int(last[-1]) + 1


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open spans."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > ends[:-1]))
    return starts[new], np.append(ends[:-1][new[1:]], ends[-1])


ARRAYS = ["first", "last", "place", "sample", "kind"]


def rows_of(doc: int | None, mark: int, text: str, length: int) -> Iterator[tuple]:
    """A document's rows: its size and hash in the first, PER_ROW cells at most in each."""
    data = text.encode("utf-8", "surrogatepass")
    facts = (len(data), hashlib.sha256(data).hexdigest())
    for found in cells_by_chunk(data, length):
        for k in range(0, len(found[0]), PER_ROW):
            yield (doc, mark, *facts, *[x[k : k + PER_ROW] for x in found])
            facts = (None, None)
    if facts[1]:  # a text shorter than a window
        yield (doc, mark, *facts, *[np.zeros(0, np.int64)] * len(ARRAYS))


def sampled(docs: DataFrame, text: str, key: str, length: int) -> DataFrame:
    """Rows of a document: id, text hash, n_bytes and sha256 of the text (null in all but the first), arrays of cells."""
    kinds = [pa.int64()] * 3 + [pa.string()] + [pa.list_(pa.int64())] * len(ARRAYS)
    names = ["doc_id", "mark", "n_bytes", "sha", *ARRAYS]

    def batch_of(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, n = [], 0
            for doc in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                for row in rows_of(*doc, length):
                    held.append(row)
                    n += len(row[-1])
                    if n >= PER_ROW:
                        yield batch_of(held)
                        held, n = [], 0
            if held:
                yield batch_of(held)

    return keyed(docs, text, key).mapInArrow(each, "doc_id long, mark long, n_bytes long, sha string, " + ", ".join(f"{c} array<long>" for c in ARRAYS))


def keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(t).alias("mark"), t.alias("text"))


def same_doc(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Join on doc_id and mark, null ids equal."""
    b = b.withColumnsRenamed({"doc_id": "__doc", "mark": "__mark"})
    return a.join(b, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("mark") == F.col("__mark")), how).drop("__doc", "__mark")


def blocks(texts: DataFrame, length: int) -> DataFrame:
    """Rows with text and todo, cells of it: for each cell its blocks from `low` on, by the hash of the
    bytes that a block's windows share (core) and of all they cover (full; null if the text ends before)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            x = batch.to_pydict()
            out: list[tuple] = []
            for doc, mark, t, todo in zip(x["doc_id"], x["mark"], x["text"], x["todo"], strict=True):
                view = memoryview(t.encode("utf-8", "surrogatepass"))
                for c in todo:
                    low, high = (c["place"] - c["last"]) // BLOCK, (c["place"] - c["first"]) // BLOCK
                    core, full = [], []
                    for b in range(low, high + 1):
                        p = c["place"] - b * BLOCK  # the last window; the first is BLOCK - 1 before
                        core.append(signed(digest(view[p : p - BLOCK + 1 + length])))
                        full.append(signed(digest(view[p - BLOCK + 1 : p + length])) if BLOCK - 1 <= p <= len(view) - length else None)
                    out.append((doc, mark, c["first"], c["last"], c["place"], c["sample"], c["single"], low, core, full))
            cols = list(zip(*out, strict=True)) or [[]] * 10
            kinds = [pa.int64()] * 6 + [pa.bool_(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "mark", "first", "last", "place", "sample", "single", "low", "core", "full"])

    return texts.mapInArrow(each, "doc_id long, mark long, first long, last long, place long, sample long, single boolean, low long, core array<long>, full array<long>")


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def windows(texts: DataFrame, length: int) -> DataFrame:
    """Rows with text and todo, ranges of its windows: the hash of each window under its block's key."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            x = batch.to_pydict()
            out: list[tuple] = []
            for doc, mark, t, todo in zip(x["doc_id"], x["mark"], x["text"], x["todo"], strict=True):
                view = memoryview(t.encode("utf-8", "surrogatepass"))
                for c in todo:
                    w = [signed(digest(view[p : p + length], c["place"] - p)) for p in range(c["a"], c["b"] + 1)]
                    out.append((doc, mark, c["a"], c["core"], c["single"], w))
            cols = list(zip(*out, strict=True)) or [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.bool_(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "mark", "a", "core", "single", "w"])

    return texts.mapInArrow(each, "doc_id long, mark long, a long, core long, single boolean, w array<long>")


def repeated(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    base = cut(sampled(docs, text, key, length), "samples")
    rows = base.select("doc_id", "mark", F.explode(F.arrays_zip(*ARRAYS)).alias("c")).select("doc_id", "mark", "c.*")
    # key lists are written before they are joined: a join beside its own aggregate can't be split where a key is hot
    often = cut(rows.groupBy("sample").count().filter("count > 1").select("sample"), "often")
    shared = cut(rows.join(often, "sample", "left_semi").select("doc_id", "mark", *ARRAYS), "shared")
    kinds = cut(shared.groupBy("sample", "kind").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "mark", "first", "last", "place")).alias("one")), "kinds")
    whole = shared.join(kinds.filter("n > 1").select("sample", "kind"), ["sample", "kind"], "left_semi").select("doc_id", "mark", F.col("first").alias("a"), (F.col("last") + length).alias("b"))
    # the text of documents that share a sample is read again; each is needed once
    affected = cut(same_doc(keyed(docs, text, key), shared.select("doc_id", "mark").distinct(), "left_semi").dropDuplicates(["doc_id", "mark"]), "affected")
    several = cut(kinds.groupBy("sample").count().filter("count > 1").select("sample"), "several")
    todo = kinds.join(several, "sample", "left_semi").select("one.doc_id", "one.mark", F.struct("one.first", "one.last", "one.place", "sample", (F.col("n") == 1).alias("single")).alias("c"))
    todo = todo.groupBy("doc_id", "mark").agg(F.collect_list("c").alias("todo"))  # a document's own cells
    found = cut(blocks(same_doc(affected, todo, "inner"), length), "blocks")
    flat = found.select("doc_id", "mark", "first", "last", "place", "sample", "single", "low", F.posexplode(F.arrays_zip("core", "full")).alias("j", "h"))
    p = F.col("place") - (F.col("low") + F.col("j")) * BLOCK
    under = lambda h: F.when(F.col(h).isNotNull(), F.xxhash64("sample", F.col("low") + F.col("j"), h))
    flat = flat.select("doc_id", "mark", F.greatest("first", p - (BLOCK - 1)).alias("a"), F.least("last", p).alias("b"), "place", "single", under("h.core").alias("core"), under("h.full").alias("full"))
    cores = cut(flat.groupBy("core").count().filter("count > 1").select("core"), "cores")
    flat = cut(flat.join(cores, "core", "left_semi"), "flat")
    both = cut(flat.filter("full is not null").groupBy("core", "full").count().filter("count > 1").select("core", "full", F.lit(True).alias("both")), "both")
    flat = cut(flat.join(both, ["core", "full"], "left"), "flat-both")
    filled = flat.filter("single and both").select("doc_id", "mark", "a", (F.col("b") + length).alias("b"))
    open_ = cut(flat.filter("single and both is null").select("core").distinct(), "open")
    more = flat.join(open_, "core", "left_semi").select("doc_id", "mark", F.struct("a", "b", "place", "core", "single").alias("c")).groupBy("doc_id", "mark").agg(F.collect_list("c").alias("todo"))
    each = cut(windows(same_doc(affected, more, "inner"), length), "windows").select("doc_id", "mark", "a", "core", "single", F.posexplode("w").alias("j", "w"))
    twice = cut(each.groupBy("core", "w").count().filter("count > 1").select("core", "w"), "twice")
    parts = each.filter("single").join(twice, ["core", "w"], "left_semi").select("doc_id", "mark", (F.col("a") + F.col("j")).alias("a"), (F.col("a") + F.col("j") + length).alias("b"))
    # spans that start in the same `length` bytes meet, as each is that long: together they are one span
    near = whole.unionByName(filled).unionByName(parts).groupBy("doc_id", "mark", F.expr(f"a div {length}").alias("at")).agg(F.min("a").alias("a"), F.max("b").alias("b"))
    spans = near.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("a", "b")).alias("spans"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for t, s in zip(batch.column("text").to_pylist(), batch.column("spans"), strict=True):
                data = t.encode("utf-8", "surrogatepass")
                a, b = merged(s.values.field("a").to_numpy(), s.values.field("b").to_numpy())
                kept = hashlib.sha256()
                for x, y in zip([0, *b.tolist()], [*a.tolist(), len(data)], strict=True):
                    kept.update(data[x:y])
                got.append((int((b - a).sum()), len(a), kept.hexdigest()))
            cols = list(zip(*got, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=["doc_id", "mark", "n_removed", "n_spans", "kept"])

    removed = same_doc(affected, spans, "inner").mapInArrow(remove, "doc_id long, mark long, n_removed long, n_spans long, kept string")
    out = same_doc(base.filter("n_bytes is not null").select("doc_id", "mark", "n_bytes", "sha"), removed, "left")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept", "sha").alias("kept_sha256"))
