"""How the sources of a language differ in the words they use.

Arrow kernels lower-case, split and dictionary-encode whole batches and count by hash inside ``mapInArrow``; Spark
adds the partial counts up. Kept terms then sit in columnar shards, a row per term with the counts of its
sources, and each shard gives exact partial sums of all pairs of sources and its own best terms per source.

A term is a run of letters: bytes outside 00-40, 5B-60 and 7B-7F, with A-Z lower-cased and nothing else. A language keeps the
terms of at least ``min_docs`` of its rows. The share of a term among a group's N counted ones, V terms kept, is
p = 1 + floor(10^9 (n + 2) / (N + 2 V)), and two shares differ by floor((p - q)^2 / (p + q)).

Null texts, languages and sources are empty strings. Every row is a document, so repeated rows count again. A group
without terms has even shares; with no kept term in its language its differences are 0. Ties go to the smaller item in
UTF-8. An empty table gives no rows. Other columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillstar.llm.textops import slices
from tillstar.sources.workspace import persisted

#: What lies between terms.
GAPS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Counts in a shard; with many sources the square of their number, so that a shard's pairs are no more than its counts.
SHARD_CELLS = 1 << 18
#: Text whose terms are counted at a time.
PART_BYTES = 8 << 20
#: Cells of a shard in numpy at a time.
BLOCK_CELLS = 1 << 20

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
FINDINGS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def count_terms(rows: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents by (lang, source, term); the empty term counts the group's documents."""
    langs, sources = rows.column("lang").dictionary_encode(), rows.column("source").dictionary_encode()
    width = max(1, len(sources.dictionary))
    group = pc.add(pc.multiply(langs.indices.cast(pa.int64()), width), sources.indices.cast(pa.int64()))
    split = pc.split_pattern_regex(pc.ascii_lower(rows.column("text")), GAPS)
    found = pa.table({"doc": pc.list_parent_indices(split), "term": pc.list_flatten(split)})
    found = found.filter(pc.not_equal(found.column("term"), ""))
    terms = found.column("term").combine_chunks().dictionary_encode()
    by_doc = pa.table({"doc": found.column("doc"), "term": terms.indices}).group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    by_doc = by_doc.append_column("group", group.take(by_doc.column("doc")))
    counted = by_doc.group_by(["group", "term"], use_threads=False).aggregate([("count_all", "sum"), ("count_all", "count")])
    sizes = pa.table({"group": group}).group_by("group", use_threads=False).aggregate([([], "count_all")])
    every = pa.concat_arrays([counted.column("group").combine_chunks(), sizes.column("group").combine_chunks()]).to_numpy()
    names = pa.concat_arrays([terms.dictionary.take(counted.column("term")).combine_chunks(), pa.array([""] * len(sizes), pa.string())])
    zeros = pa.array(np.zeros(len(sizes), np.int64))
    columns = [
        langs.dictionary.take(pa.array(every // width)),
        sources.dictionary.take(pa.array(every % width)),
        names,
        pa.concat_arrays([counted.column("count_all_sum").combine_chunks().cast(pa.int64()), zeros]),
        pa.concat_arrays([counted.column("count_all_count").combine_chunks().cast(pa.int64()), sizes.column("count_all").combine_chunks()]),
    ]
    return pa.table(columns, schema=COUNTS)


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", PART_BYTES):
            yield from count_terms(part).to_batches()


def shares(counts: np.ndarray, total: np.ndarray | int, kept: int) -> np.ndarray:
    """1 + floor(10^9 (n + 2) / (N + 2 V)) by long division to the base 1000, exact while N + 2 V stays below 9 * 10^15."""
    left = np.asarray(counts, np.int64) + 2
    whole = np.asarray(total, np.int64) + 2 * kept
    out = np.zeros(np.broadcast(left, whole).shape, np.int64)
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // whole
        left = left % whole
    return out + 1


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def shard_findings(terms: pa.Table, group: dict, top: int) -> pa.Table:
    """Partial sums of all pairs of a language's sources over a shard's terms, and each source's best terms in it."""
    names = [s["source"] for s in group["sources"]]
    totals = np.array([s["n"] for s in group["sources"]], np.int64)
    width, kept = len(names), group["kept"]
    terms = terms.take(pc.sort_indices(terms.column("term")))
    place = {name: i for i, name in enumerate(names)}
    pairs = np.zeros((width, width), np.int64)
    out: list[tuple[str, str, str, int]] = []
    best: list[list[tuple[int, str]]] = [[] for _ in names]
    step = max(1, BLOCK_CELLS // max(1, width))
    for a in range(0, terms.num_rows, step):
        block = terms.slice(a, step)
        cells = block.column("cells").combine_chunks()
        flat = cells.flatten()
        codes = pc.struct_field(flat, "source").dictionary_encode()
        column = np.array([place[x] for x in codes.dictionary.to_pylist()], np.int64)[codes.indices.to_numpy()]
        counts = np.zeros((width, block.num_rows), np.int64)
        counts[column, pc.list_parent_indices(cells).to_numpy()] = pc.struct_field(flat, "n").to_numpy()
        p = shares(counts, totals[:, None], kept)
        for i in range(width - 1):
            pairs[i, i + 1 :] += difference(p[i], p[i + 1 :]).sum(axis=1)
        q = shares(block.column("total").to_numpy(), group["total"], kept)
        for i in range(width):
            at = np.flatnonzero((counts[i] > 0) & (p[i] > q))
            value = difference(p[i, at], q[at])
            first = np.argsort(-value, kind="stable")[:top]
            words = block.column("term").take(pa.array(at[first])).to_pylist()
            # Blocks follow the order of terms, so a stable sort keeps ties right.
            best[i] = sorted([*best[i], *zip(value[first].tolist(), words, strict=True)], key=lambda x: -x[0])[:top]
    pairs += pairs.T
    for i, name in enumerate(names):
        out += [(name, "pair", other, int(pairs[i, j])) for j, other in enumerate(names) if j != i]
        out += [(name, "term", word, value) for value, word in best[i]]
    columns = [pa.array([x[k] for x in out], FINDINGS.types[k + 1]) for k in range(4)]
    return pa.table([pa.array([group["of"]] * len(out), pa.string()), *columns], schema=FINDINGS)


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Occurrences and documents by (lang, source, term); the empty term stands for all documents of the group."""

    def plain(name: str, alias: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(alias)

    rows = docs.select(plain(text, "text"), plain(lang, "lang"), plain(source, "source"))
    partial = rows.mapInArrow(_partial_counts, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def source_divergence(docs: DataFrame, min_docs: int = 10, top: int = 10, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: differences to each other source, and the terms most above the language's share."""
    cells = F.collect_list(F.struct("source", "n")).alias("cells")
    counted = term_counts(docs, text, lang, source).groupBy("lang", "term").agg(cells, F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    terms = persisted(counted.where((F.col("docs") >= min_docs) | (F.col("term") == "")), "divergence_terms", shuffle=False)

    # Sizes of shards come from counts; a shard is bounded however many terms there are.
    size = terms.agg(F.sum(F.size("cells")).alias("cells"), F.max(F.size("cells")).alias("widest")).first()
    shards = 1 + (size["cells"] or 0) // max(SHARD_CELLS, (size["widest"] or 0) ** 2)
    totals = terms.select("lang", F.inline("cells")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    sources = totals.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("sources"), F.sum("n").alias("total"))
    kept = terms.groupBy("lang").agg(F.count_if(F.col("term") != "").alias("kept"))
    numbers = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("part")
    groups = sources.join(kept, "lang").select(F.col("lang").alias("of"), "sources", "total", "kept", numbers)
    placed = terms.where("term <> ''").withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int"))

    def findings(rows: pa.Table, group: pa.Table) -> pa.Table:
        return shard_findings(rows, group.to_pylist()[0], top)

    sharded = placed.groupBy("lang", "shard").cogroup(groups.groupBy("of", "part"))
    found = sharded.applyInArrow(findings, "lang string, source string, part string, item string, value long")
    # A term lies in one shard, so its sum is its value.
    merged = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = merged.withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), terms AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), counts AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT doc) AS docs FROM terms GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL HAVING sum(docs) >= 10
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), cells AS (
  SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(c.n, 0)::HUGEINT AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), sizes AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(n) OVER (PARTITION BY lang) AS lang_total,
    count(*) OVER (PARTITION BY lang, source) AS v FROM cells
), shares AS (
  SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)) // (total + 2 * v) AS p,
    1 + (1000000000 * (lang_n + 2)) // (lang_total + 2 * v) AS q FROM sizes
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
), tops AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM shares WHERE n > 0 AND p > q
), every AS (
  SELECT * FROM pairs UNION ALL SELECT * FROM tops
)
SELECT lang, source, part, item, value::BIGINT AS value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM every QUALIFY part = 'pair' OR rank <= 10
"""
