"""Token counts under a unigram vocabulary, without building the tokens.

Text is cut before every space, the space becomes U+2581, and a text that doesn't start with a space gets one in
front, as a Metaspace pre-tokenizer does. Within a piece of text an Aho-Corasick automaton of the
vocabulary enumerates all matches; dynamic programming keeps the best sum of scores up to each position
and the number of pieces on that path. Ties go to the match that starts first; a character that no
single-character piece matches costs ten less than the least score, and falls back to one piece a byte.

Null and empty texts have no tokens. Rows with null or repeated ids are counted like any other; extra columns
are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.textops import WordTable, ranges, slices, spell, text_buffer, worker_state

SPACE = "\u2581"
#: What an unknown character scores below the least score of the vocabulary.
UNKNOWN_PENALTY = 10.0


def vocabulary_of(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]


class CountOnlyViterbi:
    def __init__(self, vocabulary: list[tuple[str, float]]) -> None:
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY

    def count(self, text: str) -> int:
        """Pieces on the best path through the text."""
        n = len(text)
        # Matches by their end, in order of their start: the longest come first.
        ending: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for end, match in self.automaton.iter(text):
            ending[end + 1].append(match)
        best, pieces = [0.0] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            top, path, single = None, 0, False
            for length, score in ending.get(end, ()):
                start = end - length
                single = single or length == 1
                if top is None or best[start] + score > top:
                    top, path = best[start] + score, pieces[start] + 1
            if not single:
                through = best[end - 1] + self.unknown
                if top is None or through > top:
                    top, path = through, pieces[end - 1] + len(text[end - 1].encode())
            best[end], pieces[end] = top, path
        return pieces[n]


def _counter(path: str) -> WordTable:
    held = worker_state("token_counts")
    if path not in held:
        viterbi = CountOnlyViterbi(vocabulary_of(path))
        held[path] = WordTable(lambda words: [[viterbi.count(SPACE + w.decode())] for w in words])
        held[path, "space"] = viterbi.count(SPACE)
    return held[path]


def counts_of(texts: pa.Array, path: str) -> np.ndarray:
    table = _counter(path)
    data, offsets = text_buffer(texts)
    spaces = np.concatenate([[0], np.cumsum(data == 0x20)])[offsets]
    sizes = np.diff(offsets)
    leading = np.zeros(len(sizes), bool)
    leading[sizes > 0] = data[offsets[:-1][sizes > 0]] == 0x20
    parts = np.where(sizes > 0, np.diff(spaces) + ~leading, 0)
    words = spell(texts, breaks=b" ")
    rows = table.rows(words)
    sums = np.concatenate([[0], np.cumsum(table.values[ranges(table.first[rows], table.sizes[rows])])])[words.first]
    return np.diff(sums) + (parts - np.diff(words.first)) * worker_state("token_counts")[path, "space"]


def _counted(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            n_chars = pa.compute.cast(pa.compute.fill_null(pa.compute.utf8_length(part.column("text")), 0), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("id"), n_chars, pa.array(counts_of(part.column("text"), path), pa.int64())], ["id", "n_chars", "n_tokens"])


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id_col, n_chars and n_tokens. One pass, no shuffle."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(lambda b: _counted(b, path), "id long, n_chars long, n_tokens long").withColumnRenamed("id", id_col)
