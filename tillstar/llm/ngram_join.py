"""Near duplicates: documents whose word shingles overlap, by prefixes of token combinations.

Two sets link when ``den * |x and y| >= num * |x or y|``. With all shingles in one global order, a set x
has to share its smallest common shingle within its first ``|x| - need + 1`` ones, where ``need`` is the
overlap that any partner demands, and its k smallest common ones within ``k - 1`` more. The join goes:

1. Equal sets become one class, represented by the text of their smallest id.
2. Shingles in the order of their hashes: a class stays when enough of its extended prefix also occurs in
   other classes' prefixes. Most documents have no near copy and leave here.
3. Of the classes left, those stay whose shingles occur in others as often as a link demands. They are ordered by shingle frequency. Rare shingles of the prefix are index keys by themselves.
   Where the prefix reaches frequent shingles it is extended, frequent shingles are dealt into fewer groups than
   common ones are certain, and pairs of shingles within a group are the keys.
4. Groups of copies are contracted first: every class is verified against one class for each of its least shingles, that
   with the fewest shingles of its own. What links is one component from then on.
5. A key is open while its classes lie in several components and some of them have been no pivots. Keys are written once, and a
   turn keeps those of open keys only. Each turn verifies classes of open keys against the next pivots of the key, PIVOTS times as
   many as before, and contracts the links. It ends when no key is open, so no pair of different components that meets at a
   key is left out.

Shingles are 64-bit hashes. Overlaps are counted on whole sets, so no pair is accepted by estimate.

Null and empty texts have no shingles and link with nothing. Rows with a null id get a null component.
Rows that repeat an id are kept; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.components import component_labels
from tillstar.llm.textops import Shingles, mix, shingles_of, slices
from tillstar.sources.workspace import persisted

#: Shingles of the filter that one group of step 2 holds on average.
GROUP_TOKENS = 1_500_000
#: A shingle in more classes than this is frequent.
FREQUENT = 64
#: Least shingles by which a class looks for the group of copies that it belongs to.
SKETCH = 4
#: Pivots of a key in the first turn, and by how much their number grows with each turn.
PIVOTS = 8

_TOKEN = np.uint64((1 << 40) - 1)
_MANY = np.uint64(0)  # stands for "several classes of this slice"


def _need(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Smallest overlap that any partner of a set of n demands."""
    return -(-num * n // den)


def _depth(n: np.ndarray) -> np.ndarray:
    """By how much the filter's prefix of a set of n is extended, and so how many shingles partners share in it."""
    return np.maximum(1, n // 8)


def _signatures(shingles: Shingles) -> tuple[np.ndarray, np.ndarray]:
    """Two independent order-free hashes of each set."""
    out = []
    for salt in (0x51, 0xA7):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles.hashes ^ mix(np.array([salt], np.uint64))))])
        out.append(sums[shingles.first[1:]] - sums[shingles.first[:-1]])
    return out[0] | np.uint64(1), out[1]


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            shingles = shingles_of(part.column("text"), k)
            s1, s2 = _signatures(shingles)
            carried = [x for x in part.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(x) for x in carried), np.diff(shingles.first), s1.view(np.int64), s2.view(np.int64)], [*carried, "n", "s1", "s2"]
            )


def _filter_tokens(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int, groups: int) -> Iterator[pa.RecordBatch]:
    """Extended prefixes in hash order, by group of shingles.

    A shingle leaves a slice once: with its class, or as one of several classes that are counted here.
    """
    for batch in batches:
        for part in slices(batch, "text"):
            shingles = shingles_of(part.column("text"), k)
            sizes = np.diff(shingles.first)
            s1, _ = _signatures(shingles)
            filled = np.flatnonzero(sizes)
            _, one = np.unique(s1[filled], return_index=True)
            own = filled[one]
            if not len(own):
                continue
            n = sizes[own]
            length = np.minimum(n, n - _need(n, num, den) + _depth(n))
            of = np.repeat(np.arange(len(own)), length)
            at = np.repeat(shingles.first[own], length) + np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
            tokens = shingles.hashes[at] & _TOKEN
            order = np.argsort(tokens, kind="stable")
            tokens, of = tokens[order], of[order]
            opens = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
            runs = np.diff(np.concatenate([opens, [len(tokens)]]))
            shared = np.repeat(runs > 1, runs)
            counts = np.bincount(of[shared], minlength=len(own))
            hit = np.flatnonzero(counts)
            rows: list[tuple[int, bytes]] = [(-1 - int(s1[own[0]] % np.uint64(groups)), _pack(s1[own[hit]], counts[hit]))] if len(hit) else []
            tokens, classes = tokens[opens], np.where(runs > 1, _MANY, s1[own[of[opens]]])
            group = (tokens % np.uint64(groups)).astype(np.int64)
            by_group = np.argsort(group, kind="stable")
            present, begins = np.unique(group[by_group], return_index=True)
            rows += [(int(g), _pack_tokens(tokens[take], classes[take])) for g, take in zip(present, np.split(by_group, begins[1:]), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["bin", "packed"])


def _pack(classes: np.ndarray, counts: np.ndarray) -> bytes:
    return classes.astype("<u8").tobytes() + counts.astype("<u4").tobytes()


def _pack_tokens(tokens: np.ndarray, classes: np.ndarray) -> bytes:
    """Five bytes a shingle and, by reference, its class."""
    names, of = np.unique(classes, return_inverse=True)
    order = np.argsort(of, kind="stable")
    head = np.array([len(names), len(tokens)], "<u4").tobytes()
    five = tokens[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    return head + names.astype("<u8").tobytes() + np.bincount(of, minlength=len(names)).astype("<u4").tobytes() + five.tobytes()


def _unpack_tokens(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    m, n = (int(x) for x in np.frombuffer(packed, "<u4", 2))
    names = np.frombuffer(packed, "<u8", m, 8)
    counts = np.frombuffer(packed, "<u4", m, 8 + 8 * m)
    tokens = np.zeros((n, 8), np.uint8)
    tokens[:, :5] = np.frombuffer(packed, np.uint8, 5 * n, 8 + 12 * m).reshape(n, 5)
    return tokens.view("<u8").ravel(), np.repeat(names, counts)


def _count_shared(table: pa.Table) -> pa.Table:
    """Per class, the shingles of this group that another class has as well."""
    packed = table.column("packed").to_pylist()
    if table.column("bin")[0].as_py() < 0:
        parts = [(len(p) // 12, p) for p in packed]
        classes = np.concatenate([np.frombuffer(p, "<u8", m) for m, p in parts])
        counts = np.concatenate([np.frombuffer(p, "<u4", m, 8 * m) for m, p in parts]).astype(np.int64)
    else:
        unpacked = [_unpack_tokens(p) for p in packed]
        tokens, classes = (np.concatenate(x) for x in zip(*unpacked, strict=True))
        order = np.lexsort((classes, tokens))
        tokens, classes = tokens[order], classes[order]
        fresh = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (classes[1:] != classes[:-1])])
        tokens, classes = tokens[fresh], classes[fresh]
        opens = np.concatenate([[True], tokens[1:] != tokens[:-1]])
        runs = np.diff(np.concatenate([np.flatnonzero(opens), [len(tokens)]]))
        classes = classes[np.repeat(runs > 1, runs)]
        classes, counts = np.unique(classes[classes != _MANY], return_counts=True)
    return pa.table({"s1": classes.view(np.int64), "shared": counts.astype(np.int64)})


def _class_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            shingles = shingles_of(part.column("text"), k)
            s1, s2 = _signatures(shingles)
            same = (s1.view(np.int64) == part.column("s1").to_numpy()) & (s2.view(np.int64) == part.column("s2").to_numpy())
            lists = pa.ListArray.from_arrays(pa.array(shingles.first, pa.int32()), pa.array(shingles.hashes.view(np.int64)))
            out = pa.RecordBatch.from_arrays([part.column("rep"), part.column("n"), lists], ["rep", "n", "shingles"])
            yield out.filter(pa.array(same))


def _shingle_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values, counts = np.unique(batch.column("shingles").flatten().to_numpy(zero_copy_only=False), return_counts=True)
        yield pa.RecordBatch.from_arrays([values, counts.astype(np.int64)], ["shingle", "c"])


def size_class(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Sizes of two linked sets lie in the same class or in neighbouring ones."""
    return np.floor(np.log(n.astype(float)) / np.log(den / num)).astype(np.int64)


def index_keys(n: int, frequency: np.ndarray, shingles: np.ndarray, num: int, den: int) -> tuple[np.ndarray, ...]:
    """Keys of one set, for each the most shingles that a partner can share which meets it there first, the key before, and if it is for larger sets.

    frequency and shingles: those of its n shingles that more than one set has, in global order. Two sets that share
    a key and the one before have met earlier. The first key has none, that is 0, before it. Two sets that
    meet by a key for larger sets than both meet by one for their own size as well.
    """
    none = np.zeros(0, np.uint64)
    need, alone = int(_need(np.int64(n), num, den)), n - len(shingles)
    reach = n - need + 1 - alone
    if reach < 1 or len(shingles) < need or need < 2:
        return none, none.astype(np.int64), none, none.astype(bool)  # no partner, or only equal sets
    rare = int(np.searchsorted(frequency, FREQUENT, side="right"))
    keys = [mix(shingles[: min(reach, rare)])]
    caps, upper = [len(shingles) - np.arange(len(keys[0]))], [np.zeros(len(keys[0]), bool)]
    if reach > rare:
        own = int(size_class(np.array([n]), num, den)[0])
        for c in (own, own + 1):
            groups = max(1, int((den / num) ** c) // 8)
            common = shingles[rare : reach + groups]  # a pair has groups + 1 of them in common at least
            group = mix(common ^ np.uint64(0xC0)) % np.uint64(groups)
            order = np.lexsort((common, group))
            common, group = common[order], group[order]
            found, at = [none], [none.astype(np.int64)]
            for apart in range(1, len(common)):
                near = group[apart:] == group[:-apart]
                if not near.any():
                    break
                found.append(mix(mix(common[:-apart][near]) + np.uint64(2 * c + 1) * common[apart:][near]))
                at.append(group[apart:][near].astype(np.int64))
            found, at = np.concatenate(found), np.concatenate(at)
            # By group, so that a shingle that differs parts few neighbours.
            keys.append(found[np.lexsort((found, at))])
            caps.append(np.full(len(keys[-1]), len(shingles) - rare))  # every common shingle is frequent
            upper.append(np.full(len(keys[-1]), c > own))
    before = [np.concatenate([none, [np.uint64(0)], k[:-1]])[: len(k)] for k in keys]
    return np.concatenate(keys), np.concatenate(caps), np.concatenate(before), np.concatenate(upper)


def _common_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each set, the shingles that others have as well and in how many sets each is."""
    lists = batch.column("common")
    first, flat = lists.offsets.to_numpy(), lists.values
    shingles, frequency = flat.field("shingle").to_numpy().view(np.uint64), flat.field("df").to_numpy()
    for i in range(len(lists)):
        yield shingles[first[i] : first[i + 1]], frequency[first[i] : first[i + 1]]


def _index(batch: pa.RecordBatch, num: int, den: int) -> tuple[np.ndarray, ...]:
    """Keys of the sets of a batch: the row of its set, and what index_keys says of each."""
    none = np.zeros(0, np.uint64)
    found = [index_keys(1, none, none, num, den)]
    for n, (s, f) in zip(batch.column("n").to_pylist(), _common_of(batch), strict=True):
        order = np.lexsort((s, f))
        found.append(index_keys(n, f[order], s[order], num, den))
    of = np.repeat(np.arange(len(batch)), [len(x[0]) for x in found[1:]])
    return of, *(np.concatenate(x) for x in zip(*found, strict=True))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least of each set's common shingles, and how many shingles it has alone."""
    for batch in batches:
        sizes = batch.column("n").to_numpy()
        least = [np.sort(mix(s))[:SKETCH] for s, _ in _common_of(batch)]
        counts = [len(x) for x in least]
        alone = sizes - np.diff(batch.column("common").offsets.to_numpy())
        keys = np.concatenate([np.zeros(0, np.uint64), *least])
        yield pa.RecordBatch.from_arrays(
            [keys.view(np.int64), np.repeat(batch.column("rep").to_numpy(), counts), np.repeat(sizes, counts), np.repeat(alone, counts).astype(np.int64)],
            ["key", "rep", "n", "alone"],
        )


def _entries(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        of, keys, caps, befores, upper = _index(batch, num, den)
        reps, sizes = (batch.column(c).to_numpy()[of] for c in ("rep", "n"))
        yield pa.RecordBatch.from_arrays(
            [keys.view(np.int64), reps, sizes.astype(np.int32), caps.astype(np.int32), befores.view(np.int64), pa.array(upper)],
            ["key", "rep", "n", "cap", "before", "upper"],
        )


def _linkable(common: DataFrame, num: int, den: int) -> DataFrame:
    """The sets of which others have so many shingles that a partner is possible."""
    return common.where(den * F.size("common") >= num * F.col("n"))


def _verified(pairs: DataFrame, common: DataFrame, num: int, den: int) -> DataFrame:
    """Of pairs (a, b) of classes, those that link; further columns of pairs stay.

    What two sets share is among the common shingles of both. The sets that pairs name move once for both sides.
    """
    reps = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    named = common.select("rep", "n", F.col("common.shingle").alias("shingles")).join(reps, "rep", "left_semi")
    right = pairs.join(named, F.col("b") == F.col("rep")).select(*pairs.columns, F.col("n").alias("n_b"), F.col("shingles").alias("y"))
    both = right.join(named, F.col("a") == F.col("rep"))
    shared = F.size(F.array_intersect("shingles", "y"))
    return both.where(den * shared >= num * (F.col("n") + F.col("n_b") - shared)).select(*pairs.columns)


def _possible(num: int, den: int) -> F.Column:
    """The shingles that both sets have left allow a link."""
    together = F.col("n_a") + F.col("n_b")
    return (num + den) * F.least("cap_a", "cap_b") >= num * together


def _near_pairs(common: DataFrame, num: int, den: int) -> DataFrame:
    """Each class with one other, of those that share a least shingle with it the one that has the fewest shingles alone."""
    sketch = persisted(common.mapInArrow(_sketches, "key long, rep long, n long, alone long"), "sketches", shuffle=False)
    partner = sketch.groupBy("key").agg(F.min(F.struct("alone", F.xxhash64("rep").alias("h"), "rep", "n")).alias("p"))
    fits = den * F.least("n", "p.n") >= num * F.greatest("n", "p.n")
    met = sketch.join(partner, "key").where((F.col("rep") != F.col("p.rep")) & fits)
    met = met.groupBy("rep").agg(F.min("p").alias("p")).select("rep", F.col("p.rep").alias("other"))
    return met.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()


def _pivot_pairs(members: DataFrame, turn: int, num: int, den: int) -> DataFrame:
    """Pairs of a pivot of this turn and a class after it, in different components, that meet at their first common key.

    A class's place u among those of a key is the same at all keys; about PIVOTS ** turn classes of a key come before
    the limit of a turn.
    """
    columns = ("rep", "n", "cap", "before", "upper", "label", "u")
    place, limit = F.col("u") * F.col("m"), float(PIVOTS**turn)
    pivots = members.where(place < limit) if turn == 1 else members.where((place < limit) & (place >= limit / PIVOTS))
    a = pivots.select("key", *(F.col(c).alias(f"{c}_a") for c in columns))
    b = members.select("key", *(F.col(c).alias(f"{c}_b") for c in columns))
    first = ((F.col("before_a") != F.col("before_b")) | (F.col("before_a") == 0)) & ~(F.col("upper_a") & F.col("upper_b"))
    after = F.struct("u_a", "rep_a") < F.struct("u_b", "rep_b")
    met = a.join(b, (a["key"] == b["key"]) & (F.col("label_a") != F.col("label_b")) & after & _possible(num, den) & first)
    of_a = F.col("rep_a") < F.col("rep_b")
    label_a, label_b = (F.when(of_a, F.col(x)).otherwise(F.col(y)) for x, y in (("label_a", "label_b"), ("label_b", "label_a")))
    return met.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b"), label_a.alias("label_a"), label_b.alias("label_b")).distinct()


def _relabelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with label replaced by its component where labels, (node, component), names one."""
    return rows.join(labels, F.col("label") == F.col("node"), "left").withColumn("label", F.coalesce("component", "label")).select(*rows.columns)


def _open_keys(members: DataFrame, turn: int) -> DataFrame:
    """Keys whose classes lie in several components and haven't all been pivots in earlier turns, with the number m of their classes.

    No class of an open key ever leaves it, so m is the same in all turns.
    """
    tally = members.groupBy("key").agg(F.count("*").alias("m"), F.min("label").alias("low"), F.max("label").alias("high"))
    pivots = PIVOTS ** (turn - 1) if turn > 1 else 0
    return tally.where((F.col("low") < F.col("high")) & (F.col("m") > pivots)).select("key", "m")


def _components(common: DataFrame, num: int, den: int) -> DataFrame:
    """(rep, label): the component of each class of common, named by the least rep of it."""
    tested = persisted(_near_pairs(common, num, den), "near_pairs", shuffle=False)
    near = persisted(_verified(tested, common, num, den), "near_links", shuffle=False)
    names = persisted(_relabelled(common.select("rep", F.col("rep").alias("label")), component_labels(near, "a", "b")), "class_labels", shuffle=False)
    shape = "key long, rep long, n int, cap int, before long, upper boolean"
    entries = persisted(common.mapInArrow(lambda b: _entries(b, num, den), shape), "key_entries", shuffle=False)
    place, turn = F.shiftrightunsigned(F.xxhash64("rep"), 11) / float(1 << 53), 0
    while True:
        turn += 1
        mixed = persisted(_open_keys(entries.select("key", "rep").join(names, "rep"), turn), "open_keys", shuffle=False)
        if mixed.first() is None:
            return names
        members = entries.join(mixed, "key").join(names, "rep").withColumn("u", place)
        members = persisted(members, "open_members", shuffle=False)
        pairs = _pivot_pairs(members, turn, num, den).join(tested, ["a", "b"], "left_anti")
        pairs = persisted(pairs, "candidate_pairs", shuffle=False)
        links = persisted(_verified(pairs, common, num, den).select("label_a", "label_b").distinct(), "links", shuffle=False)
        names = persisted(_relabelled(names, component_labels(links, "label_a", "label_b")), "class_labels", shuffle=False)
        entries = members.select(*entries.columns)
        tested = tested.unionByName(pairs.select("a", "b"))


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 75, den: int = 100, words: int = 5, keyed: bool = False
) -> DataFrame:
    """Per row of docs: id_col, n_shingles and component_id, the smallest id reachable by links; keyed adds row, a hash of the text."""
    row = [F.xxhash64(text_col).alias("row")] if keyed else []
    texts = docs.select(F.col(id_col).cast("long").alias("id"), *row, F.col(text_col).cast("string").alias("text"))
    shape = "id long, row long, n long, s1 long, s2 long" if keyed else "id long, n long, s1 long, s2 long"
    rows = persisted(texts.mapInArrow(lambda b: _sets(b, words), shape), "shingle_sets", shuffle=False)
    classes = rows.where("n > 0 and id is not null").groupBy("n", "s1", "s2").agg(F.min("id").alias("least"))
    # Different texts may share the least id, so a class has a name of its own.
    classes = classes.withColumn("rep", F.xxhash64("n", "s1", "s2"))
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    groups = max(8, int(total * 0.4 / GROUP_TOKENS) + 1)

    packed = texts.where("id is not null").mapInArrow(lambda b: _filter_tokens(b, words, num, den, groups), "bin long, packed binary")
    shared = packed.groupBy("bin").applyInArrow(_count_shared, "s1 long, shared long").groupBy("s1").agg(F.sum("shared").alias("shared"))
    # A partner of a set of n has need(n) shingles at least, and so shares the depth of that many with it.
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * num / den) / 8))
    kept = persisted(classes.join(shared, "s1").where(F.col("shared") >= least).select("rep", "least", "n", "s1", "s2"), "shingle_classes", shuffle=False)

    found = texts.join(kept, F.col("id") == F.col("least")).select("text", "rep", "n", "s1", "s2")
    sets = persisted(found.mapInArrow(lambda b: _class_sets(b, words), "rep long, n long, shingles array<long>").dropDuplicates(["rep"]), "class_sets", shuffle=False)

    frequency = sets.mapInArrow(_shingle_counts, "shingle long, c long").groupBy("shingle").agg(F.sum("c").alias("df")).where("df > 1")
    common = (
        sets.select("rep", "n", F.explode("shingles").alias("shingle"))
        .join(frequency, "shingle")
        .groupBy("rep", "n")
        .agg(F.collect_list(F.struct("shingle", "df")).alias("common"))
    )
    names = _components(persisted(_linkable(common, num, den), "common_shingles", shuffle=False), num, den)
    least_of = names.join(kept.select("rep", "least"), "rep").groupBy("label").agg(F.min("least").alias("smallest"))
    named = names.join(least_of, "label").select(F.col("rep").alias("node"), "smallest")
    classes, component_id = classes.join(named, F.col("rep") == F.col("node"), "left"), F.coalesce("smallest", "least")
    merged = classes.select("n", "s1", "s2", component_id.alias("component_id"))
    linked = rows.join(merged, ["n", "s1", "s2"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return linked.select(F.col("id").alias(id_col), *(["row"] if keyed else []), F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_per_group(docs: DataFrame, columns: tuple[str, ...], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The given columns of one document per component, that with the smallest id; of rows that repeat id and text, one.

    Rows without id are linked with nothing and stay, repeats aside. Of repeated rows the least of the other columns stays.
    """
    row = F.xxhash64(text_col)
    groups = similar_documents(docs, id_col, text_col, keyed=True)
    gone = groups.where(F.col(id_col) != F.col("component_id")).select(id_col, "row").distinct()
    left = docs.withColumn("row", row).join(gone, [id_col, "row"], "left_anti")
    many = docs.groupBy(id_col, row.alias("row")).count().where("count > 1").select(F.col(id_col).alias("many_id"), F.col("row").alias("many_row"))
    same = F.col(id_col).eqNullSafe(F.col("many_id")) & (F.col("row") == F.col("many_row"))
    others = [c for c in columns if c not in (id_col, text_col)]
    repeated = left.join(many, same, "left_semi").groupBy(id_col, text_col).agg(F.min(F.struct(*others)).alias("rest"))
    return left.join(many, same, "left_anti").select(*columns).unionByName(repeated.select(id_col, text_col, "rest.*"))
