"""Token ids in binary blocks, compressed by Re-Pair grammars.

Documents are dealt to partitions by ranges of their id and first characters, so files follow ascending
doc_id, a frequent id can be split, and the number of partitions grows with the input's bytes. Each task
encodes its documents, gathers the ids into blocks of about BLOCK ids, and compresses each block:
frequent pairs of neighbouring symbols become nonterminals, round after round, until no pair pays for
its rule or symbols run out. A block row stores the rules, the expansion length of every nonterminal and
the symbols, so that any document is decoded alone, from its own symbols. Spark's Parquet writer makes
the files, on any store that Spark reaches.

Symbols take two bytes where the vocabulary leaves room for rules below 2**16, else four.

Defined results: a null or empty text is the end id alone; a null doc_id comes first; repeated doc_ids
are kept as rows of their own, in the order of their texts; an empty table gives no blocks. A block
never splits a document, so a task holds BLOCK ids and its longest document.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import scratch

BLOCK = 1 << 21
#: Nonterminals that two-byte symbols must leave room for.
ROOM = 4096
#: Bytes of input that a task encodes where more tasks than spark.sql.shuffle.partitions are due, and how
#: many times more at most: the estimate of a plan that joins tables can be far too high.
TASK_BYTES = 128 << 20
MORE_TASKS = 16
#: Characters of a text that tell documents of one id apart when they are dealt to tasks.
PREFIX = 64
#: Pieces whose ids a worker remembers.
REMEMBERED = 1_000_000
END = 0
#: A piece may end before a space only after a character that no reading of \s takes for white space.
UNSAFE = re.compile("[\\s\\x00-\\x20\\x7f-\\xa0\\u1680\\u180e\\u2000-\\u200f\\u2028-\\u202f\\u205f-\\u206f\\u3000\\ufeff] ")
#: A word of Latin letters and the ASCII marks after it are a pre-token each; no apostrophe, which may start one inside.
SIMPLE = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\\[-`{-~]*)")
SCHEMA = "part int, seq int, first_id long, n_tokens long, doc_ids binary, doc_nulls binary, doc_symbols binary, doc_tokens binary, rules binary, expansions binary, symbols binary, base int"


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is visible in
    Latin-1, else the next one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in seen else next(rest)) for b in range(256)]


LETTERS = {b: c for b, c in enumerate(byte_letters())}
SPACE = LETTERS[32]


class Pieces(dict):
    """Numbers pieces in the order in which they are first asked for; new ones wait in a list."""

    def __init__(self, pieces: list[str]):
        super().__init__(zip(pieces, range(len(pieces)), strict=True))
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.new.append(piece)
        return n


class Encoder:
    """Ids of whole texts by the tokenizers library, remembering the ids of space-separated pieces.

    No pre-token reaches over the boundary between a visible character and a space, so ids of pieces
    cut there, joined, are those of the whole text. Texts where that can't be seen are encoded whole.
    A piece of plain words, each on a line, goes to the library's model at once, as its pre-tokens are known.
    Of REMEMBERED pieces those that came again stay, and the others are forgotten.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.vocab = self.tok.get_vocab_size(with_added_tokens=True)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.kind = symbol_type(self.vocab)
        self.code = {np.uint16: "H", np.uint32: "I"}[self.kind]
        # ids as bytes: millions of lists would keep the garbage collector busy
        self.marks: dict[str, bytes] = {"": b""}
        self.stems: dict[str, bytes] = {}
        self.newline = self.pre_token("\n")
        self.known = Pieces([])
        self.flat, self.at, self.size, self.again = np.zeros(0, self.kind), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def forget(self) -> None:
        stay = np.flatnonzero(self.again)
        stay = stay if 2 * len(stay) <= REMEMBERED else stay[:0]
        self.flat, size = self.tokens(stay)
        pieces = list(self.known)
        self.known, self.size, self.at = Pieces([pieces[k] for k in stay.tolist()]), size, np.cumsum(size) - size
        self.again = np.zeros(len(stay), bool)
        self.stems = {}

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def pre_token(self, text: str) -> bytes:
        """Ids of one pre-token, as bytes."""
        letters = text.encode().decode("latin-1").translate(LETTERS)
        return array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()

    def stem(self, word: str) -> bytes:
        """Ids of a plain word, with its space if it has one."""
        got = self.stems.get(word)
        if got is None:
            if word.isascii():  # letters stand for themselves in the vocabulary
                tokens = self.model.tokenize(SPACE + word[1:] if word[0] == " " else word)
                got = array(self.code, [t.id for t in tokens]).tobytes()
            else:
                got = self.pre_token(word)
            self.stems[word] = got
        return got

    def mark(self, mark: str) -> bytes:
        got = self.marks.get(mark)
        if got is None:
            got = self.marks[mark] = self.pre_token(mark)
        return got

    def simple(self, piece: str) -> bytes | None:
        """Ids of a piece after a space if it is plain words, each with marks, on lines of their own."""
        m = SIMPLE.fullmatch(piece)
        if m:
            return self.stem(" " + m[1]) + self.mark(m[2])
        lines = [SIMPLE.fullmatch(x) for x in piece.split("\n")]
        if None in lines:
            return None
        return self.newline.join([self.stem(" " * (k == 0) + m[1]) + self.mark(m[2]) for k, m in enumerate(lines)])

    def remember(self, pieces: list[str]) -> None:
        """Learn the ids of each piece after a space."""
        ids = list(map(self.simple, pieces))
        odd = [k for k, got in enumerate(ids) if got is None]
        for k, got in zip(odd, self.plain([" " + pieces[k] for k in odd]), strict=True):
            ids[k] = array(self.code, got).tobytes()
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // np.dtype(self.kind).itemsize
        self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.again = np.concatenate([self.again, np.zeros(len(ids), bool)])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), self.kind)])

    def tokens(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, joined, and how many each has."""
        n = self.size[numbers]
        ends = np.cumsum(n)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.at[numbers] - ends + n, n)], n

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text with the end id."""
        if len(self.known) > REMEMBERED:
            self.forget()
        number, before = self.known.__getitem__, len(self.known)
        heads, tails, none = [], [], np.zeros(0, np.int64)
        for t in texts:
            head, space, tail = t.partition(" ")
            if UNSAFE.search(t) or t.startswith(" ") or any(s in t for s in self.special):
                head, space = t, ""
            # every piece but a text's first follows a space; a first piece is encoded apart
            heads.append(head)
            tails.append(np.fromiter(map(number, tail.split(" ")), np.int64) if space else none)
        if self.known.new:
            self.remember(self.known.new)
            self.known.new = []
        numbers = np.concatenate([none, *tails])
        self.again[numbers[numbers < before]] = True
        ids, n = self.tokens(numbers)
        ends = np.concatenate(([0], np.cumsum(n)))[np.cumsum([0, *map(len, tails)])].tolist()
        end = np.array([END], self.kind)
        return [np.concatenate([np.array(head, self.kind), ids[a:b], end]) for head, a, b in zip(self.plain(heads), ends, ends[1:], strict=False)]


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def symbol_type(base: int) -> type:
    """Two bytes a symbol where the vocabulary leaves room for rules beside it, else four."""
    return np.uint16 if base <= (1 << 16) - ROOM else np.uint32


def re_pair(ids: np.ndarray, last: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, last, rules, expansion lengths): `last` marks the symbol that ends a document.

    Each round counts all pairs and replaces the most frequent ones, with two thirds of the nonterminals
    that are left, until no pair pays for its rule or nonterminals run out. Where occurrences overlap, the
    leftmost goes first. No pair reaches over the end of a document. Rules are (left, right) rows.
    """
    kind = symbol_type(base)
    sym, rules, lens = ids.astype(kind), [], [np.ones(base, np.int64)]
    width = 8 * sym.itemsize
    free = (1 << 16) - base if kind == np.uint16 else 1 << 20
    wide = np.uint32 if kind == np.uint16 else np.uint64
    pays = (2 * sym.itemsize + 4) // sym.itemsize + 1  # a rule's symbols and its length
    while len(sym) > 1 and free:
        key = (sym[:-1].astype(wide) << wide(width)) | sym[1:]
        inner = ~last[:-1]
        seen = np.sort(key[inner])
        edge = np.flatnonzero(np.concatenate((np.ones(min(1, len(seen)), bool), seen[1:] != seen[:-1])))
        times = np.diff(np.append(edge, len(seen)))
        often = np.flatnonzero(times >= pays)
        if not len(often):
            break
        quota = min(free, max(2 * free // 3, ROOM // 4))
        if len(often) > quota:
            often = often[np.argpartition(times[often], len(often) - quota)[len(often) - quota :]]
        pairs = seen[edge[np.sort(often)]]
        # a table finds a pair by its hash; of two pairs with one hash, one waits for the next round
        spread = lambda k: (k * wide(0x9E3779B97F4A7C15 % (1 << 2 * width))) >> wide(2 * width - 20)  # noqa: B023, E731
        table = np.full(1 << 20, -1, np.int32)
        table[spread(pairs)] = np.arange(len(pairs))
        pairs = pairs[np.sort(table[table >= 0])]
        table[:] = -1
        table[spread(pairs)] = np.arange(len(pairs))
        which = table[spread(key)]
        place = np.flatnonzero((which >= 0) & inner)
        which = which[place]
        hit = pairs[which] == key[place]
        place, which = place[hit], which[hit]
        # in a run of places side by side, every second one stays
        start = np.flatnonzero(np.concatenate((np.ones(min(1, len(place)), bool), place[1:] != place[:-1] + 1)))
        odd = (np.arange(len(place), dtype=np.int32) - np.repeat(start.astype(np.int32), np.diff(np.append(start, len(place))))) & 1
        place, which = place[odd == 0], which[odd == 0]
        # a pair that its neighbours took the places of makes no rule
        used = np.bincount(which, minlength=len(pairs)) > 0
        which, pairs = (np.cumsum(used) - 1)[which], pairs[used]
        made = sum(map(len, lens))
        sym[place] = (made + which).astype(kind)
        keep = np.ones(len(sym), bool)
        keep[place + 1] = False
        last[place] = last[place + 1]
        sym, last = sym[keep], last[keep]
        rules.append(np.stack([pairs >> wide(width), pairs & wide((1 << width) - 1)], axis=1).astype(kind))
        size = np.concatenate(lens)
        lens.append(size[rules[-1][:, 0]] + size[rules[-1][:, 1]])
        free -= len(pairs)
    return sym, last, (np.concatenate(rules) if rules else np.zeros((0, 2), kind)), np.concatenate([np.zeros(0, np.int64), *lens[1:]]).astype(np.uint32)


def expansions(rules: np.ndarray, lens: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat ids, start, length) by symbol; nonterminals follow the vocabulary's own ids."""
    flat, size = np.arange(base, dtype=rules.dtype), np.ones(base, np.int64)
    most, done = rules.max(1, initial=0), 0
    while done < len(rules):
        # rules of one round use what rounds before made
        ahead = np.flatnonzero(most[done:] >= len(size))
        n = done + int(ahead[0]) if len(ahead) else len(rules)
        flat = np.concatenate([flat, decode(rules[done:n].ravel(), (flat, np.cumsum(size) - size, size))])
        size = np.concatenate([size, lens[done:n]])
        done = n
    return flat, np.cumsum(size) - size, size


def decode(symbols: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    flat, at, size = table
    n = size[symbols]
    ends = np.cumsum(n)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(at[symbols] - ends + n, n)]


def write_blocks(docs: DataFrame, path: str, tokenizer: str, text: str = "text", key: str = "doc_id", block: int = BLOCK) -> None:
    """Encode every whole text and write block rows under path, in ascending order of key."""
    spark = docs.sparkSession
    dealt = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # the plan's own estimate: the size of the files behind it, without reading them
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    n = max(n, min(-(-size // TASK_BYTES), MORE_TASKS * n))
    dealt = dealt.repartitionByRange(n, "k", F.substring("t", 1, PREFIX)).sortWithinPartitions("k", "t").select(F.spark_partition_id().alias("p"), "k", "t")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        seq, held, keys, part, n_held = 0, [], [], 0, 0

        def block_row() -> pa.RecordBatch:
            n_ids = np.array([len(x) for x in held], np.int64)
            last = np.zeros(int(n_ids.sum()), bool)
            last[np.cumsum(n_ids) - 1] = True
            sym, last, rules, lens = re_pair(np.concatenate(held), last, enc.vocab)
            n_sym = np.diff(np.concatenate(([0], np.flatnonzero(last) + 1)))
            row = [part, seq, keys[0], int(n_ids.sum()), np.array([k or 0 for k in keys], "<i8").tobytes(), np.array([k is None for k in keys], "u1").tobytes(), n_sym.astype("<i8").tobytes(), n_ids.astype("<i8").tobytes(), rules.tobytes(), lens.tobytes(), sym.tobytes(), enc.vocab]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, TYPES, strict=True)], names=NAMES)

        for batch in batches:
            ks, ts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            part = batch.column(0)[0].as_py() if batch.num_rows else part
            for a in range(0, len(ts), 256):
                for k, ids in zip(ks[a : a + 256], enc.encode(ts[a : a + 256]), strict=True):
                    keys.append(k)
                    held.append(ids)
                    n_held += len(ids)
                    if n_held >= block:
                        yield block_row()
                        seq, held, keys, n_held = seq + 1, [], [], 0
        if held:
            yield block_row()

    dealt.mapInArrow(blocks, SCHEMA).write.option("compression", "zstd").parquet(path)


NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
TYPES = [{"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in SCHEMA.split(", ")]


def starts(blocks: DataFrame) -> DataFrame:
    """(part, seq, start): ids before each block. One number a partition meets in a single task."""
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    own = F.sum("n_tokens").over(W.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    return blocks.select("part", "seq", "n_tokens", own.alias("own")).join(before, "part").select("part", "seq", (F.col("own") + F.col("before")).alias("start"))


def read_digest(blocks: DataFrame) -> DataFrame:
    """Decode every document from block rows: doc_id, start, n_tokens, ids_crc32, n_symbols."""
    placed = blocks.join(starts(blocks.select("part", "seq", "n_tokens")), ["part", "seq"]).select("start", *NAMES[4:])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                get = lambda name, kind: np.frombuffer(row[name], kind)  # noqa: B023, E731
                kind = symbol_type(row["base"])
                table = expansions(get("rules", kind).reshape(-1, 2), get("expansions", "<u4"), row["base"])
                n_sym, n_ids, symbols = get("doc_symbols", "<i8"), get("doc_tokens", "<i8"), get("symbols", kind)
                all_ids = memoryview(decode(symbols, table).astype("<u4")).cast("B")
                ends = (4 * np.cumsum(n_ids)).tolist()
                crc = [zlib.crc32(all_ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
                ids = pa.array(get("doc_ids", "<i8"), mask=get("doc_nulls", "u1").astype(bool))
                yield pa.RecordBatch.from_arrays([ids, pa.array(row["start"] + np.cumsum(n_ids) - n_ids), pa.array(n_ids), pa.array(crc, pa.int64()), pa.array(n_sym)], names=["doc_id", "start", "n_tokens", "ids_crc32", "n_symbols"])

    return placed.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long, n_symbols long")


def unfold(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids of some symbols alone: their own rules are followed, level by level, and no others."""
    while (inner := symbols >= base).any():
        n = 1 + inner
        out, at = np.repeat(symbols, n), np.cumsum(n)[inner] - 2
        out[at], out[at + 1] = rules[symbols[inner] - base].T
        symbols = out
    return symbols


class Block:
    """One block row, read without expanding it: lengths of expansions tell which symbols a range of ids needs."""

    def __init__(self, row: dict):
        self.base, kind = row["base"], symbol_type(row["base"])
        self.rules = np.frombuffer(row["rules"], kind).reshape(-1, 2)
        self.symbols = np.frombuffer(row["symbols"], kind)
        size = np.concatenate([np.ones(self.base, np.int64), np.frombuffer(row["expansions"], "<u4")])
        self.ends = np.cumsum(size[self.symbols])

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids begin to end (exclusive) of the block."""
        if begin >= end:
            return np.zeros(0, np.int32)
        first, last = np.searchsorted(self.ends, begin, "right"), np.searchsorted(self.ends, end, "left")
        before = self.ends[first - 1] if first else 0
        return unfold(self.symbols[first : last + 1], self.rules, self.base)[begin - before : end - before].astype(np.int32)


def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ranges (begin, end within the block) that each block row is asked for, a row each."""
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row)
            for w in sorted(row["wanted"], key=lambda w: w["begin"]):
                ids = pa.array(block.ids(w["begin"], w["end"]), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([w["doc_id"]], pa.int64()), pa.array([row["start"] + w["begin"]], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)], names=["doc_id", "start", "ids"])


PIECE = "doc_id long, start long, ids array<int>"
BODY = ["rules", "expansions", "symbols", "base"]


def read_range(blocks: DataFrame, begin: int, end: int) -> DataFrame:
    """Ids begin to end (exclusive) of all ids written, as (start, ids) rows, one a block that has some.

    Grammars and symbols are read of those blocks alone, and only symbols that reach into the range are expanded.
    """
    at = starts(blocks.select("part", "seq", "n_tokens"))
    size = blocks.select("part", "seq", "n_tokens").join(at, ["part", "seq"]).filter((F.col("start") < end) & (F.col("start") + F.col("n_tokens") > begin))
    own = F.struct(F.lit(None).cast("long").alias("doc_id"), F.greatest(F.lit(begin) - F.col("start"), F.lit(0)).cast("long").alias("begin"), F.least(F.lit(end) - F.col("start"), F.col("n_tokens")).cast("long").alias("end"))
    asked = size.select("part", "seq", "start", F.array(own).alias("wanted"))
    return blocks.select("part", "seq", *BODY).join(asked, ["part", "seq"]).select("start", "wanted", *BODY).mapInArrow(pieces_of, PIECE).select("start", "ids")


def read_documents(blocks: DataFrame, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, start, ids with the end id) of the written documents whose id is in wanted; null asks for null.

    A scan of the ids' columns finds blocks and places; only those blocks' grammars are read, and of them
    only the documents' own symbols are expanded. A repeated id gives all its documents; one asked for
    twice gives them once; an unknown one gives none.
    """

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = np.frombuffer(row["doc_tokens"], "<i8")
                ids = pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=np.frombuffer(row["doc_nulls"], "u1").astype(bool))
                end = np.cumsum(n)
                yield pa.RecordBatch.from_arrays([pa.array([row["part"]] * len(n), pa.int32()), pa.array([row["seq"]] * len(n), pa.int32()), ids, pa.array(end - n), pa.array(end)], names=["part", "seq", "doc_id", "begin", "end"])

    asked = wanted.select(F.col(key).cast("long").alias("__id")).distinct()
    found = blocks.select("part", "seq", "doc_ids", "doc_nulls", "doc_tokens").mapInArrow(places, "part int, seq int, doc_id long, begin long, end long")
    found = found.join(asked, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    own = found.groupBy("part", "seq").agg(F.collect_list(F.struct("doc_id", "begin", "end")).alias("wanted"))  # a block's documents at most
    own = own.join(starts(blocks.select("part", "seq", "n_tokens")), ["part", "seq"])
    return blocks.select("part", "seq", *BODY).join(own, ["part", "seq"]).select("start", "wanted", *BODY).mapInArrow(pieces_of, PIECE)


def token_output(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", path: str | None = None) -> DataFrame:
    """Write docs as blocks (under path, else a scratch folder) and digest what the files hold."""
    path = path or scratch(docs.sparkSession, "tokens")
    write_blocks(docs, path, tokenizer, text, key)
    return read_digest(docs.sparkSession.read.parquet(path))
