"""Token ids of documents as binary files with Elias-Fano coded boundaries.

A location holds one Parquet file per shard of ascending ids; each row is a block of some documents. The
block's payload is self-contained:

    magic "TSB1", count of null ids (u4), smallest id (i8), bytes per token id (u1), then two Elias-Fano
    sequences, the ids less the smallest one and the ends of the documents in the block, then the token ids.

An Elias-Fano sequence of n values below u keeps floor(log2(u / n)) low bits of each value in an array and the
rest in unary in a bit vector, about 2 + log2(u / n) bits a value. The position of every 64th set bit is kept as
well, so a single value is read by a short scan from there. Spark writes and reads the files, so any store
it knows will do, and a repeated task writes the same bytes.

Null texts are empty documents and still get the end id. Rows are written in ascending order of id, nulls
first, equal ids by the hash of their text; every row is kept. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillstar.llm.textops import WordTable, latin_pieces, ranges, slices, spell, worker_state
from tillstar.sources.workspace import write_once

MAGIC = b"TSB1"
#: Set bits between two kept positions.
SAMPLE = 64
#: Text of one block; a longer text makes a block of its own.
BLOCK_BYTES = 2 << 20
#: Words that the library encodes in one call.
CALL = 1024


def elias_fano(values: np.ndarray, universe: int) -> bytes:
    """Ascending integers from 0 to universe."""
    n = len(values)
    low = max(0, int(universe // max(1, n)).bit_length() - 1)
    values = values.astype(np.uint64)
    bits = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    high = np.zeros((universe >> low) + n + 1, np.uint8)
    high[ones] = 1
    lows, highs, picks = np.packbits(bits.ravel()).tobytes(), np.packbits(high).tobytes(), ones[::SAMPLE].astype("<u4").tobytes()
    return np.array([n, low, len(lows), len(highs)], "<u4").tobytes() + lows + highs + picks


class EliasFano:
    """Reads a sequence from the start of a buffer; ``size`` is the number of its bytes."""

    def __init__(self, buffer: memoryview) -> None:
        self.n, self.low, lows, highs = (int(x) for x in np.frombuffer(buffer, "<u4", 4))
        self.lows = np.frombuffer(buffer, np.uint8, lows, 16)
        self.highs = np.frombuffer(buffer, np.uint8, highs, 16 + lows)
        kept = -(-self.n // SAMPLE)
        self.picks = np.frombuffer(buffer, "<u4", kept, 16 + lows + highs)
        self.size = 16 + lows + highs + 4 * kept

    def all(self) -> np.ndarray:
        high = np.flatnonzero(np.unpackbits(self.highs))[: self.n] - np.arange(self.n)
        bits = np.unpackbits(self.lows, count=self.n * self.low).reshape(self.n, self.low).astype(np.int64)
        return (high << self.low) + bits @ (1 << np.arange(self.low, dtype=np.int64))

    def select(self, i: int) -> int:
        """Value i, from the nearest kept position before it."""
        at, left = int(self.picks[i // SAMPLE]), i % SAMPLE
        byte, seen = at >> 3, -1
        skip = at & 7
        while True:
            ones = np.flatnonzero(np.unpackbits(self.highs[byte : byte + 1])[skip:]) + skip
            if seen + len(ones) >= left:
                high = 8 * byte + int(ones[left - seen - 1]) - i
                break
            seen, byte, skip = seen + len(ones), byte + 1, 0
        first = i * self.low
        bits = np.unpackbits(self.lows[first >> 3 : (first + self.low + 7) >> 3])[first & 7 :][: self.low].astype(np.int64)
        return (high << self.low) + int(bits @ (1 << np.arange(self.low, dtype=np.int64)))


def pack_block(ids: np.ndarray, nulls: int, sizes: np.ndarray, tokens: np.ndarray, width: int) -> bytes:
    """ids: ascending ids of all documents but the first ``nulls`` ones; sizes: tokens of each document."""
    base = int(ids[0]) if len(ids) else 0
    head = MAGIC + np.array([nulls], "<u4").tobytes() + np.array([base], "<i8").tobytes() + bytes([width])
    span = int(ids[-1]) - base if len(ids) else 0
    ends = np.cumsum(sizes)
    coded = elias_fano((ids - base).astype(np.uint64), span) + elias_fano(ends, int(ends[-1]) if len(ends) else 0)
    return head + coded + tokens.astype(f"<u{width}").tobytes()


class Block:
    """A packed block; ``ends`` gives the end of document i without decoding the others."""

    def __init__(self, packed: bytes) -> None:
        view = memoryview(packed)
        if bytes(view[:4]) != MAGIC:
            raise ValueError("not a token block")
        self.nulls, self.base, width = int.from_bytes(view[4:8], "little"), int.from_bytes(view[8:16], "little", signed=True), view[16]
        self.ids = EliasFano(view[17:])
        self.ends = EliasFano(view[17 + self.ids.size :])
        self.tokens = np.frombuffer(packed, f"<u{width}", offset=17 + self.ids.size + self.ends.size)

    def document(self, i: int) -> np.ndarray:
        return self.tokens[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]


def _encoder(path: str) -> tuple[WordTable, int, Callable | None]:
    """Token ids of distinct words, bytes per id, and how words are cut further. A word's ids don't depend on its neighbours; see encodes_by_words."""
    held = worker_state("token_files")
    if path not in held:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)

        plain = (t for t in tokenizer.get_added_tokens_decoder().values() if t.special and not (t.lstrip or t.rstrip or t.normalized or t.single_word))
        mark = next(plain, None)

        def encode(words: list[bytes]) -> list[list[int]] | tuple[np.ndarray, np.ndarray]:
            # Words in a row with a special token between them, which the library cuts at first: a call for many words.
            parts = [words[a : a + CALL] for a in range(0, len(words), CALL)] if mark else []
            rows = [mark.content.encode().join(part) for part in parts]
            if not rows or any(row.count(mark.content.encode()) >= len(part) for row, part in zip(rows, parts, strict=True)):
                return [e.ids for e in tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
            found = [np.array(e.ids, np.int64) for e in tokenizer.encode_batch_fast([row.decode() for row in rows], add_special_tokens=False)]
            cuts = [np.flatnonzero(ids == tokenizer.token_to_id(mark.content)) for ids in found]
            sizes = [np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1 for ids, cut in zip(found, cuts, strict=True)]
            return np.concatenate(sizes), np.concatenate([np.delete(ids, cut) for ids, cut in zip(found, cuts, strict=True)])

        held[path] = WordTable(encode), 2 if tokenizer.get_vocab_size() <= 1 << 16 else 4, latin_pieces if encodes_by_pieces(path) else None
    return held[path]


def encodes_by_words(path: str) -> bool:
    """True if the tokenizer drops white space and so encodes each word by itself."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    one, two = (tokenizer.encode(x, add_special_tokens=False).ids for x in ("it's", "x,2"))
    return all(tokenizer.encode(f"{a}it's{b}x,2{c}", add_special_tokens=False).ids == one + two for a, b, c in (("", " ", ""), (" ", "\n\n", "\t"), ("\r", " \t ", " ")))


def encodes_by_pieces(path: str) -> bool:
    """True if the tokenizer also lowers case and encodes runs of ASCII and Latin-1 letters, single digits and runs of ASCII signs by themselves."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def ids(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    signs = [chr(c) for c in range(0x21, 0x7F) if c not in (0x27, 0x7C) and not chr(c).isalnum()]
    probes = [p for s in signs for p in (["ab", s, "cd"], [s, "1", s, "x"], ["x", "1", "2", s])]
    probes += [["Ab", "1", "2", "cd", "..-", "3", "X"], signs[:1], ["".join(signs), "q", "0"]]
    letters = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
    probes += [p for x in letters for p in ([f"a{x}b", ",", f"{x}{x}", "1", x], ["1", f"{x}Z", "!", x])]
    bound = all("|" in t.content for t in tokenizer.get_added_tokens_decoder().values())
    return bound and all(ids("".join(p)) == [i for piece in p for i in ids(piece.lower())] for p in probes)


def token_ids(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids of all texts in a row, each with the end id, their numbers, and bytes per id."""
    table, width, refine = _encoder(path)
    words = spell(texts, refine=refine)
    rows = table.rows(words)
    sizes = table.sizes[rows]
    before = np.concatenate([[0], np.cumsum(sizes)])[words.first]
    ends = before[1:] + np.arange(1, len(before))
    out = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.int64)
    inner = np.ones(len(out), bool)
    inner[ends - 1] = False
    out[inner] = table.values[ranges(table.first[rows], sizes)]
    return out, np.diff(np.concatenate([[0], ends])), max(width, 2 if end_id < 1 << 16 else 4)


def _blocks(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    shard, start, number = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        for part in slices(batch, "text", BLOCK_BYTES):
            tokens, sizes, width = token_ids(part.column("text"), path, end_id)
            ids = part.column("id").drop_null().to_numpy()
            packed = pack_block(ids, part.num_rows - len(ids), sizes, tokens, width)
            row = {"shard": shard, "block": number, "start_in_shard": start, "n_docs": part.num_rows, "n_tokens": len(tokens), "payload": packed}
            yield pa.RecordBatch.from_pylist([row], pa.schema([*((c, pa.int64()) for c in list(row)[:-1]), ("payload", pa.binary())]))
            start, number = start + len(tokens), number + 1


def write_token_files(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode whole texts and write them in ascending order of id; returns the location."""
    if not encodes_by_words(path):
        raise ValueError(f"{path} doesn't encode words by themselves")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    sorted_ = texts.repartitionByRange(*order).sortWithinPartitions(*order)
    shape = "shard long, block long, start_in_shard long, n_docs long, n_tokens long, payload binary"
    return write_once(sorted_.mapInArrow(lambda b: _blocks(b, path, end_id), shape), "token_files", shuffle=False)


def _documents(batches: Iterator[pa.RecordBatch], id_col: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed, start in zip(batch.column("payload"), batch.column("start").to_pylist(), strict=True):
            block = Block(packed.as_py())
            ends = block.ends.all()
            begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            ids = pa.concat_arrays([pa.nulls(block.nulls, pa.int64()), pa.array(block.ids.all() + block.base, pa.int64())])
            wide = block.tokens.astype("<u4")
            sums = [zlib.crc32(wide[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
            columns = {id_col: ids, "start": pa.array(begins + start), "n_tokens": pa.array(ends - begins), "ids_crc32": pa.array(sums, pa.int64())}
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(wide.astype(np.int64)))
            yield pa.RecordBatch.from_pydict(columns)


def read_token_files(spark: SparkSession, location: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Per document from the files: id, start among all ids, n_tokens, ids_crc32 and, if asked for, the ids."""
    blocks = spark.read.schema("shard long, block long, start_in_shard long, n_docs long, n_tokens long, payload binary").parquet(location)
    # One row a shard, so one row a task of the writing job.
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    shards = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    placed = blocks.join(shards, "shard").select("payload", (F.col("before") + F.col("start_in_shard")).alias("start"))
    shape = f"`{id_col}` long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return placed.mapInArrow(lambda b: _documents(b, id_col, with_ids), shape)
