"""MinHash near-dedup: an inverted join on signature coordinates, then exact confirmation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm import hashing
from tidewire.llm.common import WORD_CLASS, components, settle

#: Coordinates of a signature, and how many two documents must share to be compared. At a
#: similarity of 0.75 the shared ones are binomial (32, 0.75): fewer than 12 in 1.5 of a
#: million pairs.
COORDINATES = 32
MATCHES = 12
#: Link at 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Documents of one list that are compared at once with as many others.
BLOCK = 512
#: Bits of the filter that spares texts without candidates; its size does not depend on data.
FILTER_BITS = 1 << 22

_XOR = hashing.multipliers(COORDINATES, 21)
_TIMES = hashing.multipliers(COORDINATES, 22)
_HIGH = np.uint64(32)
#: What identifies a shingle set.
_SAME = ["n_shingles", "set_sum", "set_cross"]


def _shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    for words in hashing.text_words(texts):
        yield hashing.shingles(words)


def _set_sums(sets: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """Two sums that, with the size, identify each set."""
    sums = np.array([np.add.reduce(x, dtype=np.uint64) for x in sets], np.uint64)
    crosses = np.array(
        [np.add.reduce(hashing.mixed(x ^ _XOR[0]), dtype=np.uint64) for x in sets], np.uint64
    )
    return pa.array(sums.view(np.int64)), pa.array(crosses.view(np.int64))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set size, two sums that identify the set, and the signature of every text."""
    for batch in batches:
        sizes, sums, crosses, signatures = [], [], [], []
        for own in _shingle_sets(batch.column(1)):
            sizes.append(len(own))
            sums.append(np.add.reduce(own) if len(own) else np.uint64(0))
            crosses.append(
                np.add.reduce(hashing.mixed(own ^ _XOR[0])) if len(own) else np.uint64(0)
            )
            if not len(own):
                signatures.append(None)
                continue
            least = np.empty(COORDINATES, dtype="<u4")
            for k in range(COORDINATES):
                least[k] = (((own ^ _XOR[k]) * _TIMES[k]) >> _HIGH).min()
            signatures.append(least.tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(np.array(sizes, np.int64)),
             pa.array(np.array(sums, np.uint64).view(np.int64)),
             pa.array(np.array(crosses, np.uint64).view(np.int64)),
             pa.array(signatures, pa.binary())],
            names=["doc_id", "tag", *_SAME, "signature"],
        )


def _as_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, COORDINATES)


def _explode_coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place = np.arange(COORDINATES, dtype=np.int64) << 32
    for batch in batches:
        keys = _as_matrix(batch.column(1)).astype(np.int64) | place
        ids = np.repeat(batch.column(0).to_numpy(), COORDINATES)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], names=["key", "id"])


def _by_block(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict[str, list]]:
    """Columns of each run of rows with equal ``key, part`` in sorted batches."""
    held: dict[str, list] | None = None
    for batch in batches:
        columns = {n: batch.column(batch.schema.get_field_index(n)) for n in names}
        key, part = columns["key"].to_numpy(), columns["part"].to_numpy()
        edges = np.flatnonzero((np.diff(key) != 0) | (np.diff(part) != 0)) + 1
        for start, end in zip([0, *edges], [*edges, len(key)]):
            run = {n: c.slice(start, end - start).to_pylist() for n, c in columns.items()}
            if held and held["key"][0] == run["key"][0] and held["part"][0] == run["part"][0]:
                held = {n: held[n] + run[n] for n in names}
                continue
            if held:
                yield held
            held = run
    if held:
        yield held


def _candidates(block: dict[str, list]) -> tuple[np.ndarray, np.ndarray]:
    """Places (asking, other) of the pairs of a block that this list has to compare.

    They share MATCHES coordinates, differ in component, can be similar by size, and this
    list is the first of those that both are posted in.
    """
    asks = np.array(block["asks"])
    a, b = np.flatnonzero(asks), np.arange(len(asks))
    bit = np.uint32(1) << np.uint32(block["key"][0] >> 32)
    signature = np.frombuffer(b"".join(block["signature"]), "<u4").reshape(-1, COORDINATES)
    ids, group, size = (np.array(block[n]) for n in ("id", "component", "n_shingles"))
    mask = np.array(block["mask"], np.int64).astype(np.uint32)
    step = max(1, (1 << 22) // max(len(b) * COORDINATES, 1))
    found_a, found_b = [], []
    for at in range(0, len(a), step):
        own = a[at: at + step]
        apart = group[own][:, None] != group[None, :]
        # both ask: once is enough
        apart &= (ids[own][:, None] < ids[None, :]) | ~asks[None, :]
        small = np.minimum(size[own][:, None], size[None, :])
        apart &= 100 * small >= PERCENT * np.maximum(size[own][:, None], size[None, :])
        x, y = np.nonzero(apart)
        for part in range(0, len(x), 1 << 17):
            i, j = own[x[part: part + (1 << 17)]], y[part: part + (1 << 17)]
            same = signature[i] == signature[j]
            shared = np.packbits(same, axis=1, bitorder="little").view("<u4").ravel()
            shared &= mask[i] & mask[j]
            good = (same.sum(axis=1) >= MATCHES) & ((shared & (~shared + np.uint32(1))) == bit)
            found_a.append(i[good])
            found_b.append(j[good])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


_ENTRY = ["key", "part", "id", "asks", "component", "n_shingles", "mask", "signature"]


def _involved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of the blocks that have a pair to compare."""
    for block in _by_block(batches, _ENTRY):
        a, b = _candidates(block)
        at = np.union1d(a, b)
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array([block[n][i] for i in at], t) for n, t in zip(
                    _ENTRY, [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(),
                             pa.int64(), pa.int64(), pa.binary()])],
                names=_ENTRY,
            )


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a block, confirmed on the full sets."""
    for block in _by_block(batches, [*_ENTRY, "shingles"]):
        first, second = _candidates(block)
        left, right = [], []
        sets = [np.frombuffer(s, np.uint64) for s in block["shingles"]]
        for a in np.unique(first):
            others = second[first == a]
            own = sets[a]
            for at in range(0, len(others), 64):
                some = others[at: at + 64]
                sizes = np.array([len(sets[b]) for b in some])
                together = np.concatenate([sets[b] for b in some])
                place = np.minimum(np.searchsorted(own, together), len(own) - 1)
                both = np.add.reduceat(
                    (own[place] == together).astype(np.int64), np.cumsum(sizes) - sizes
                )
                union = len(own) + sizes - both
                for b in some[100 * both >= PERCENT * union]:
                    left.append(block["id"][a])
                    right.append(block["id"][b])
        yield pa.RecordBatch.from_arrays(
            [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
        )


def _posts(classes: DataFrame) -> DataFrame:
    """``key, id, n_shingles, mask, signature``: each document under its rarest coordinates.

    A coordinate value of one document joins nothing. Of the others, a document that shares
    MATCHES with another one shares one of all but its MATCHES - 1 most frequent ones.
    """
    every = classes.select("id", "signature").mapInArrow(_explode_coordinates, "key long, id long")
    shared = every.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    own = (
        every.join(shared, "key").groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("keys"))
        .filter(F.size("keys") >= MATCHES)
    )
    keys = F.transform(
        F.slice("keys", 1, F.size("keys") - (MATCHES - 1)), lambda x: x["key"]
    )
    mask = F.aggregate(
        "keys", F.lit(0).cast("long"),
        lambda all_, k: all_.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"),
                                                       F.shiftright(k, 32).cast("int"))),
    )
    posted = own.select("id", keys.alias("keys")).withColumn("mask", mask)
    return posted.join(classes, "id").select(
        F.explode("keys").alias("key"), "id", "n_shingles", "mask", "signature"
    )


def _id_filter(ids: DataFrame) -> np.ndarray:
    """Bits of hashed ids, or-ed in the executors: FILTER_BITS / 64 rows at most."""
    place = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    words = ids.select(F.shiftright(place, 6).alias("word"), F.call_function(
        "shiftleft", F.lit(1).cast("long"), (place % 64).cast("int")).alias("bit")
    ).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for word, value in words.collect():
        bits[word] = value
    return bits


def _wanted_sets(bits: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(2).to_numpy()
            wanted = ((bits[place >> 6] >> (place & 63)) & 1).astype(bool)
            if not wanted.any():
                continue
            some = batch.filter(pa.array(wanted))
            sets = list(_shingle_sets(some.column(1)))
            sums, crosses = _set_sums(sets)
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array([len(x) for x in sets], pa.int64()), sums, crosses,
                 pa.array([x.tobytes() for x in sets], pa.binary())],
                names=["set_doc", "set_size", "own_sum", "own_cross", "shingles"],
            )

    return run


def _links(entries: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b`` of confirmed links. Only entries with a pair to compare meet their sets."""
    types = ("key long, part long, id long, asks boolean, component long, n_shingles long, "
             "mask long, signature binary")
    involved = (
        entries.repartition("key", "part").sortWithinPartitions("key", "part")
        .mapInArrow(_involved, types)
    )
    full = involved.join(sets, F.col("id") == F.col("set_id")).drop("set_id")
    return (
        full.repartition("key", "part").sortWithinPartitions("key", "part")
        .mapInArrow(_confirmed, "a long, b long")
    )


def _star_entries(posts: DataFrame) -> DataFrame:
    """Every list with its smallest document asking; parts spread a long list over tasks."""
    lists = posts.groupBy("key").agg(F.min("id").alias("center"), F.count(F.lit(1)).alias("n"))
    lists = lists.filter("n > 1")
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / BLOCK))
    rows = posts.join(lists, "key").withColumn("asks", F.col("id") == F.col("center"))
    parts = F.when(
        F.col("asks"), F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / BLOCK) - 1)
    ).otherwise(F.array(part))
    return rows.withColumn("component", F.col("id")).select(
        "key", F.explode(parts).alias("part"), "id", "asks", "component", "n_shingles", "mask",
        "signature",
    )


def _cross_entries(posts: DataFrame, groups: DataFrame) -> DataFrame:
    """Lists that still hold several components: all outside the largest one ask all others.

    That is at most twice the pairs of different components. A long list is cut into blocks
    of asking and of other documents, and every block of one meets every block of the other.
    """
    rows = posts.join(groups, F.col("id") == F.col("node"), "left").select(
        *posts.columns, F.coalesce("root", "id").alias("component")
    )
    by_group = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    lists = by_group.groupBy("key").agg(
        F.max(F.struct("n", F.col("component"))).alias("most"), F.sum("n").alias("total"),
        F.count(F.lit(1)).alias("groups"),
    ).filter("groups > 1").select(
        "key", F.col("most.component").alias("largest"),
        F.ceil(F.col("total") / BLOCK).alias("rows_of"),
        F.ceil((F.col("total") - F.col("most.n")) / BLOCK).alias("asking"),
    )
    rows = rows.join(lists, "key").withColumn("outside", F.col("component") != F.col("largest"))
    spread = F.xxhash64("id")
    other = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("asking") - 1),
        lambda x: F.struct((x * F.col("rows_of") + F.pmod(spread, F.col("rows_of"))).alias("part"),
                           F.lit(False).alias("asks")),
    )
    asking = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("rows_of") - 1),
        lambda y: F.struct((F.pmod(spread, F.col("asking")) * F.col("rows_of") + y).alias("part"),
                           F.lit(True).alias("asks")),
    )
    both = F.when(F.col("outside"), F.concat(other, asking)).otherwise(other)
    return rows.select("*", F.explode(both).alias("at")).select(
        "key", "at.part", "id", "at.asks", "component", "n_shingles", "mask", "signature"
    )


def _grouped(rows: DataFrame) -> DataFrame:
    """``doc_id, tag, n_shingles, component, component_id`` of rows of ``doc_id, text, tag``.

    A class is all rows with one shingle set, whatever their ids; it has a number of its own,
    and everything up to the components is keyed by it. ``component`` is the number of the
    component's class with the least number (null: no words), ``component_id`` its least id.
    """
    signed = settle(rows.select("doc_id", "text", "tag").mapInArrow(
        _signatures,
        "doc_id long, tag binary, n_shingles long, set_sum long, set_cross long, signature binary",
    ))
    classes = settle(
        signed.filter("n_shingles > 0").groupBy(*_SAME)
        .agg(F.min("doc_id").alias("rep"), F.any_value("signature").alias("signature"))
        # numbers in the order of ids: originals come first, and lists agree on their center
        .repartitionByRange("rep").sortWithinPartitions("rep")
        .withColumn("id", F.monotonically_increasing_id())
    )
    posts = settle(_posts(classes))
    posted = classes.drop("signature").join(posts.select("id").distinct(), "id", "left_semi")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    bits = _id_filter(posted.select(F.col("rep").alias("id")))
    sets = settle(
        rows.select("doc_id", "text").withColumn("place", place)
        .mapInArrow(
            _wanted_sets(bits),
            "set_doc long, set_size long, own_sum long, own_cross long, shingles binary",
        )
        .join(posted, F.col("set_doc").eqNullSafe(F.col("rep"))
              & (F.col("set_size") == F.col("n_shingles"))
              & (F.col("own_sum") == F.col("set_sum")) & (F.col("own_cross") == F.col("set_cross")))
        .select(F.col("id").alias("set_id"), "shingles").dropDuplicates(["set_id"])
    )
    near_star = components(_links(_star_entries(posts), sets))
    cross = _links(_cross_entries(posts, near_star), sets)
    # the star's components stand for its links: one pair per document
    joined = near_star.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = components(joined.unionByName(cross))
    placed = classes.join(roots, F.col("id") == F.col("node"), "left").select(
        *_SAME, "rep", F.coalesce("root", "id").alias("component")
    )
    least = placed.groupBy(F.col("component").alias("l_component")).agg(
        F.min("rep").alias("component_id")
    )
    of_class = placed.join(least, F.col("component") == F.col("l_component")).select(
        *[F.col(c).alias(f"c_{c}") for c in _SAME], "component", "component_id"
    )
    same = [F.col(c) == F.col(f"c_{c}") for c in _SAME]
    return signed.join(of_class, same, "left").select(
        "doc_id", "tag", "n_shingles", "component", "component_id"
    )


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Equal shingle sets collapse first: one document stands for all. Each of them is posted
    under the values of its signature coordinates, rarest first and only as many as a pair
    with MATCHES common ones must share; the frequent rest is skipped, and read only to count
    a pair's matches. Every list first compares all its documents with one (a star), which
    joins most of a group in linear work; then only documents of different components meet,
    in blocks. A pair is compared in the first list it shares, on the full sets, so links are
    exact, and none between candidates is left out. No task holds a list or a group.

    Words are split at blanks and controls 9 to 13, A-Z in lower case. Texts under five words
    are one shingle; null or wordless texts have none, are linked with nothing and kept.

    Links are between rows: rows with one id and different texts are documents of their own,
    each with its text's component and linked through nothing but their texts. A row with a
    null id is linked like any other; it is kept only if its component has no id at all
    (``component_id`` null). Repeated rows get equal results; ``keep_one`` picks one of them.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"),
        F.lit(None).cast("binary").alias("tag"),
    )
    component = F.coalesce("component_id", "doc_id")
    return _grouped(rows).select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, one for each component: that with the smallest id.

    Of rows with the same id (or without any id) one is taken by a 128-bit digest of all its
    columns, of rows alike in all columns any. Rows without words are linked with nothing and
    stay. Texts are shuffled once, by that digest.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    # hashes skip nulls: where they are is hashed too
    where = F.concat(*[F.isnull(c).cast("string") for c in names])
    tag = F.concat(*[
        F.unhex(F.lpad(F.hex(F.xxhash64(F.lit(seed), *names, where)), 16, "0")) for seed in (1, 2)
    ])
    has_words = F.coalesce(F.col(text), F.lit("")).rlike(WORD_CLASS)
    tagged = docs.filter(has_words).select(F.struct(*names).alias("row"), tag.alias("tag"))
    grouped = _grouped(tagged.select(
        F.col(f"row.`{key}`").cast("long").alias("doc_id"), F.col(f"row.`{text}`").alias("text"), "tag",
    ))
    first = F.min(F.struct(F.isnull("doc_id"), "doc_id", "tag"))["tag"]
    winners = grouped.groupBy("component").agg(first.alias("tag")).select("tag")
    kept = tagged.join(winners, "tag", "left_semi").dropDuplicates(["tag"]).select("row.*")
    return kept.unionByName(docs.filter(~has_words))
