"""Byte-level BPE: texts to token ids and back, equal to the tokenizers library on its own files.

A text is split at the strings of special tokens, then into pieces by a fixed pattern. A piece starts as its bytes. A segment
tree over the ranks of adjacent pairs holds the least (rank, place) at its root, so the root is the leftmost
pair of the lowest rank; merging it changes three leaves and their ancestors, until the root holds no pair. So a piece of n
bytes takes n log n steps, whatever it is made of. Trees of many short pieces stand side by side in arrays and step together.

Ids of pieces are kept in each worker while they repeat, up to a bound in bytes. Texts are cut where a space stands between
two other characters, which always begins a piece, so memory beyond the ids doesn't grow with a text.

The pattern's classes are those of the library that splits for other users of the file: characters which it does not know yet as
letters or digits count as signs here too.

Token ids travel as binary, unsigned 32-bit integers, little-endian. Null texts and ids are empty. Ids without a token are
skipped when decoding, as the library does; bytes that are not UTF-8 become replacement characters. Rows are coded one by
one, so repeated rows and ids give repeated results; of other columns only those asked for are carried along.
"""

from __future__ import annotations

import codecs
import json
import sys
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, StringType, StructType
from tokenizers.pre_tokenizers import ByteLevel

from tillstar.llm.textops import slices, worker_state

# Fixed value: how byte-level BPE cuts a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of texts that are cut into pieces at a time, at least.
CHUNK = 1 << 19
#: Bytes of a piece whose tree stands among others; longer ones are merged one by one, in the same steps.
SHORT = 64
#: Text coded between two results.
PART_BYTES = 8 << 20
#: Bytes of pieces and their ids that a worker keeps.
KEPT_BYTES = 64 << 20
#: A character that is neither letter, digit nor blank.
SIGN = "\u00a7"
#: Beyond any rank and place.
NO_PAIR = sys.maxsize


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    code = dict(zip(shown, shown, strict=True)) | {b: 256 + i for i, b in enumerate(hidden)}
    return [chr(code[b]) for b in range(256)]


def newer_characters() -> list[str]:
    """Letters and digits that the library's tables of characters don't hold yet; to it they are signs."""
    every = "".join(map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)]))

    def apart(groups: list[str]) -> list[str]:
        """Groups of letters or of digits that the library doesn't take as one piece after a sign."""
        ends = accumulate((2 + len(g) for g in groups), initial=0)
        spans = {span for _, span in ByteLevel(add_prefix_space=False).pre_tokenize_str("".join("\n." + g for g in groups))}
        return [g for g, a in zip(groups, ends, strict=False) if (a + 2, a + 2 + len(g)) not in spans]

    return apart([c for group in apart(regex.findall(r"\p{L}+|\p{N}+", every)) for c in group])


class ByteBpe:
    """Vocabulary and merges of a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model, splitter = held["model"], held["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter["add_prefix_space"]
        odd = any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        bent = any(t[x] for t in held["added_tokens"] for x in ("single_word", "lstrip", "rstrip", "normalized"))
        if not plain or odd or bent or held["normalizer"]:
            raise ValueError(f"{path} isn't a plain byte-level BPE")
        letters = byte_characters()
        byte_of = {c: i for i, c in enumerate(letters)}
        vocab = model["vocab"]
        self.byte_ids = [vocab[c] for c in letters]
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.merged = [vocab[a + b] for a, b in pairs]
        self.ranks: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(pairs):
            self.ranks[vocab[a], vocab[b]] = rank
        self.byte_array, self.merged_array = np.array(self.byte_ids), np.array(self.merged)
        coded = np.array([a << 32 | b for a, b in self.ranks], np.int64)
        turn = np.argsort(coded)
        self.codes, self.code_ranks = coded[turn], np.fromiter(self.ranks.values(), np.int64, len(coded))[turn]
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items()}
        self.bytes_of |= {i: token.encode() for token, i in self.special.items()}
        by_length = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")") if by_length else None
        self.pieces = regex.compile(PIECES)
        self.signs = {ord(c): SIGN for c in newer_characters()}
        self.newer = np.zeros(0x110000, bool)
        self.newer[list(self.signs)] = True
        self.cut = regex.compile(r"(?<=\S) (?=\S)")
        self.kept: dict[str, bytes] = {}
        self.kept_bytes = 0

    def merge(self, symbols: list[int]) -> list[int]:
        """Ids of a piece, given those of its bytes."""
        n, ranks = len(symbols), self.ranks
        if n < 2:
            return symbols
        width = 1 << (n - 2).bit_length()  # leaves of the tree, one a pair
        tree = [NO_PAIR] * (2 * width)
        for i in range(n - 1):
            rank = ranks.get((symbols[i], symbols[i + 1]))
            if rank is not None:
                tree[width + i] = rank * width + i
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(place: int, value: int) -> None:
            node = width + place
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
                if tree[node] == value:
                    break
                tree[node] = value

        while tree[1] != NO_PAIR:
            rank, i = divmod(tree[1], width)
            j = after[i]
            k = after[j]
            symbols[i], symbols[j], after[i] = self.merged[rank], -1, k
            if j < n - 1:
                put(j, NO_PAIR)
            if k < n:
                before[k] = i
            following = ranks.get((symbols[i], symbols[k])) if k < n else None
            put(i, NO_PAIR if following is None else following * width + i)
            h = before[i]
            if h >= 0:
                leading = ranks.get((symbols[h], symbols[i]))
                put(h, NO_PAIR if leading is None else leading * width + h)
        return [s for s in symbols if s >= 0]

    def _chunks(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > CHUNK:
            found = self.cut.search(text, start + CHUNK)
            if found is None:
                break
            yield text[start : found.start()]
            start = found.start()
        yield text[start:] if start else text

    def split(self, text: str) -> list[str]:
        """Pieces of a text without special tokens."""
        if text.isascii() or not self.newer[np.frombuffer(text.encode("utf-32-le"), "<u4")].any():
            return self.pieces.findall(text)
        shown = text.translate(self.signs)
        return [text[slice(*found.span())] for found in self.pieces.finditer(shown)]

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of short pieces; trees of one width stand side by side and take a step each at a time."""
        out = [b""] * len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        widths = 1 << np.ceil(np.log2(np.maximum(sizes - 1, 1))).astype(np.int64)
        for width in np.unique(widths).tolist():
            chosen = np.flatnonzero(widths == width)
            # A column more than symbols, so that something follows the last one.
            wide, n = width + 2, sizes[chosen]
            raw = np.zeros((len(chosen), wide), np.int64)
            inside = np.arange(wide) < n[:, None]
            raw[inside] = np.frombuffer(b"".join([pieces[i] for i in chosen.tolist()]), np.uint8)
            symbols = np.where(inside, self.byte_array[raw], -1)
            self._merge_rows(symbols, width)
            left = symbols >= 0
            packed, ends = symbols[left].astype("<u4").tobytes(), (4 * np.cumsum(left.sum(axis=1))).tolist()
            for i, a, b in zip(chosen.tolist(), [0, *ends], ends, strict=False):
                out[i] = packed[a:b]
        return out

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs; the number of merges where a pair has none."""
        code = (a << 32) | b
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where((self.codes[at] == code) & (b >= 0), self.code_ranks[at], len(self.merged))

    def _merge_rows(self, symbols: np.ndarray, width: int) -> None:
        """Merge every row of symbols (-1 beyond its end) in place; a symbol that is merged away becomes -1."""
        count, wide = symbols.shape
        none, merged = len(self.merged) * width, self.merged_array
        tree = np.full((count, 2 * width), none, np.int64)
        ranks = self._rank(symbols[:, :width], symbols[:, 1 : width + 1])
        tree[:, width:] = np.where(ranks < len(merged), ranks * width + np.arange(width), none)
        node = width
        while node > 1:
            half = node // 2
            tree[:, half:node] = np.minimum(tree[:, node : 2 * node : 2], tree[:, node + 1 : 2 * node : 2])
            node = half
        after = np.minimum(np.tile(np.arange(1, wide + 1), (count, 1)), wide - 1)
        before = np.tile(np.arange(-1, wide - 1), (count, 1))
        rows = np.flatnonzero(tree[:, 1] < none)
        while len(rows):
            rank, i = np.divmod(tree[rows, 1], width)
            j = after[rows, i]
            k = after[rows, j]
            symbols[rows, i], symbols[rows, j] = merged[rank], -1
            after[rows, i], before[rows, k] = k, i
            h = before[rows, i]
            led = np.flatnonzero(h >= 0)
            r, leaf = np.concatenate([rows, rows, rows[led]]), np.concatenate([j, i, h[led]])
            own = symbols[rows, i]
            found = np.concatenate([self._rank(own, symbols[rows, k]), self._rank(symbols[rows[led], h[led]], own[led])])
            value = np.where(found < len(merged), found * width + leaf[len(rows) :], none)
            inside = leaf < width
            r, leaf, value = r[inside], leaf[inside], np.concatenate([np.full(len(rows), none), value])[inside]
            node = leaf + width
            tree[r, node] = value
            while width > 1 and node[0] > 1:
                node = node >> 1
                tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
            rows = rows[tree[rows, 1] < none]

    def _learn(self, pieces: set[str]) -> None:
        """Keep the ids of pieces."""
        fresh = [p for p in pieces if p not in self.kept]
        raw = [p.encode() for p in fresh]
        short = [i for i, x in enumerate(raw) if len(x) <= SHORT]
        packed = [b"" if len(x) <= SHORT else np.array(self.merge([self.byte_ids[b] for b in x]), "<u4").tobytes() for x in raw]
        for i, ids in zip(short, self.merge_many([raw[i] for i in short]), strict=True):
            packed[i] = ids
        self.kept.update(zip(fresh, packed, strict=True))
        self.kept_bytes += 200 * len(fresh) + sum(map(len, raw)) + sum(map(len, packed))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        held = 0

        def settle() -> None:
            self._learn({piece for _, pieces in waiting for piece in pieces})
            for i, pieces in waiting:
                out[i].append(b"".join(map(self.kept.__getitem__, pieces)))
            waiting.clear()
            if self.kept_bytes > KEPT_BYTES:
                self.kept.clear()
                self.kept_bytes = 0

        for i, text in enumerate(texts):
            for part in self.specials.split(text) if self.specials else [text]:
                if part in self.special:
                    settle()
                    out[i].append(self.special[part].to_bytes(4, "little"))
                    continue
                for chunk in self._chunks(part):
                    waiting.append((i, self.split(chunk)))
                    held += len(chunk)
                    if held > CHUNK:
                        settle()
                        held = 0
        settle()
        return [b"".join(parts) for parts in out]

    def encode(self, text: str) -> bytes:
        """Packed ids of a text."""
        return self.encode_many([text])[0]

    def decode(self, packed: bytes) -> str:
        """Text of packed ids."""
        ids, spelled, reader, out = np.frombuffer(packed, "<u4"), self.bytes_of, codecs.getincrementaldecoder("utf-8")("replace"), []
        for a in range(0, len(ids), CHUNK):
            out.append(reader.decode(b"".join([spelled.get(i, b"") for i in ids[a : a + CHUNK].tolist()])))
        return "".join(out) + reader.decode(b"", True)


def tokenizer(path: str) -> ByteBpe:
    """The tokenizer of a file, read once in each worker."""
    held = worker_state("byte_bpe")
    if path not in held:
        held[path] = ByteBpe(path)
    return held[path]


def _coded(rows: DataFrame, column: str, given: DataType, made: DataType, into: str, carry: Sequence[str], code) -> DataFrame:
    """The carried columns and one that ``code`` makes from another's values, a part of a batch at a time."""
    if into in carry:
        raise ValueError(f"column {into} can't be both carried and made")
    shape = StructType([rows.schema[c] for c in carry]).add(into, made, False)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_given", PART_BYTES):
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], code(part.columns[-1])], [*carry, into])

    return rows.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{column}`").cast(given).alias("_given")).mapInArrow(turn, shape)


def encode(docs: DataFrame, path: str, text_col: str = "text", into: str = "ids", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The carried columns and the packed ids of each text."""

    def ids_of(texts: pa.Array) -> pa.Array:
        bpe = tokenizer(path)
        return pa.array(bpe.encode_many([text or "" for text in texts.to_pylist()]), pa.binary())

    return _coded(docs, text_col, StringType(), BinaryType(), into, carry, ids_of)


def decode(rows: DataFrame, path: str, ids_col: str = "ids", into: str = "decoded", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The carried columns and the text of each row's packed ids."""

    def text_of(ids: pa.Array) -> pa.Array:
        bpe = tokenizer(path)
        return pa.array([bpe.decode(packed or b"") for packed in ids.to_pylist()], pa.string())

    return _coded(rows, ids_col, BinaryType(), StringType(), into, carry, text_of)
