"""Embedding near-dedup: iterative quantisation, multi-index Hamming tables, exact rerank."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import components, settle

COSINE = 0.9
#: Tables and most bits of each. Two vectors meet if the bits of one table agree. At a cosine
#: of 0.95 a bit of a random rotation differs in one of ten cases, 16 agree in 18 %, and one of
#: 32 tables agrees in 99.8 % of the cases; at 0.9 in 94 %. That holds for vectors around the
#: origin: if they share an offset, centred ones at a cosine of 0.9 are further apart, and
#: ``table_bits`` takes fewer bits.
TABLES = 32
BITS = 16
#: Least share of links at COSINE that the tables must find, in each fifth of the vectors by
#: distance from the centre.
RECALL = 0.9
#: Bits beyond the furthest planted partner by which the whole codes of a pair may differ.
SPARE_BITS = 16
#: Vectors that the rotations are fitted on (chosen by their hash), and rounds of it.
SAMPLE_ROWS = 4000
ROUNDS = 20
#: Vectors of one bucket that are compared at once with as many others.
BLOCK = 1024
#: Blocks up to this size are compared many at a time.
SMALL = 8
#: How the bits of a table are stored in a whole code.
_CODE = np.dtype("<u2")


def learn_rotations(sample: np.ndarray, bits: int, seed: int = 17) -> np.ndarray:
    """Projections for ``bits`` balanced bits: one rotation for every as many bits as dimensions.

    Each starts at random and alternates between the signs of the rotated sample and the
    rotation that brings the sample nearest to them (an orthogonal Procrustes problem). The
    sample is centred and scaled along its principal axes first, so that no bit is idle.
    """
    size = sample.shape[1]
    random = np.random.default_rng(seed)
    values, axes = np.linalg.eigh(np.cov(sample.T) if len(sample) > 1 else np.eye(size))
    spread = np.sqrt(np.maximum(values, 1e-3 * max(values.max(), 1e-12)))
    # half of the scaling: full whitening would blow up the noise of weak axes
    white = axes * (spread.mean() / spread) ** 0.5
    flat = sample @ white
    parts = []
    while sum(p.shape[1] for p in parts) < bits:
        turn, _ = np.linalg.qr(random.standard_normal((size, size)))
        for _ in range(ROUNDS if len(sample) >= size else 0):
            left, _, right = np.linalg.svd(flat.T @ np.sign(flat @ turn))
            turn = left @ right
        parts.append(white @ turn)
    return np.concatenate(parts, axis=1)[:, :bits]


def _codes(x: np.ndarray, center: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """The BITS bits of every table as a number, first bit lowest."""
    bits = ((x - center) @ planes > 0).reshape(len(x), TABLES, BITS)
    return (bits * (np.int64(1) << np.arange(BITS, dtype=np.int64))).sum(axis=2)


def _shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """First bits that pairs of codes have in common, in the table where these are most."""
    apart = (a ^ b) | (np.int64(1) << BITS)
    return np.log2((apart & -apart).max(axis=1)).astype(int)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which the whole codes of pairs differ."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


def table_bits(
    test: np.ndarray, sample: np.ndarray, center: np.ndarray, planes: np.ndarray, seed: int = 23
) -> tuple[int, int]:
    """Most bits a table (up to BITS) that find RECALL of the links at COSINE, and the most
    bits in which the whole codes of a pair may differ to be compared.

    Links are defined on the vectors as they are, bits on centred ones, so the share is
    measured: on partners planted at COSINE from ``test``, in random directions and towards
    other vectors, and on the links between ``test`` and ``sample``. No partner is further
    away than the bits returned, SPARE_BITS less.
    """
    random = np.random.default_rng(seed)
    codes = _codes(test, center, planes)
    by_distance = np.argsort(np.linalg.norm(test - center, axis=1))
    groups, furthest = [], 0
    for planted in (lambda: random.standard_normal(test.shape),
                    lambda: sample[random.integers(0, len(sample), len(test))]):
        met = []
        for _ in range(4):
            aside = planted()
            aside = aside - (aside * test).sum(axis=1)[:, None] * test
            length = np.linalg.norm(aside, axis=1)[:, None]
            partner = COSINE * test + np.sqrt(1 - COSINE**2) * aside / np.maximum(length, 1e-12)
            other, apart = _codes(partner, center, planes), length[:, 0] > 1e-6
            met.append(np.where(apart, _shared_bits(codes, other), BITS)[by_distance])
            furthest = max(furthest, _distance(codes, other)[apart].max(initial=0))
        groups += np.array_split(np.array(met), 5, axis=1)
    linked = np.argwhere((test @ sample.T >= COSINE) & (test @ sample.T < 1 - 1e-9))
    linked = linked[:: len(linked) // 50_000 + 1]
    ends = codes[linked[:, 0]], _codes(sample, center, planes)[linked[:, 1]]
    groups.append(_shared_bits(*ends))
    furthest = max(furthest, _distance(*ends).max(initial=0))
    groups = [g for g in groups if g.size]
    enough = [b for b in range(1, BITS + 1) if all((g >= b).mean() >= RECALL for g in groups)]
    # no bits: one bucket of all vectors, which finds every link
    return (max(enough), int(furthest) + SPARE_BITS) if enough else (0, TABLES * BITS)


@dataclass(frozen=True)
class _Model:
    center: np.ndarray
    planes: np.ndarray
    #: Bits a table, and most bits in which codes of compared pairs differ.
    bits: int
    far: int


def _unit(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors of length one in double precision; None for those that link with nothing."""
    out: list[np.ndarray | None] = []
    for value in column.to_pylist():
        if value is None or not value or any(x is None for x in value):
            out.append(None)
            continue
        x = np.array(value, np.float64)
        top = np.abs(x).max()
        if not np.isfinite(x).all() or top == 0:
            out.append(None)
            continue
        x = x / top
        out.append(x / np.sqrt(x @ x))
    return out


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units = _unit(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([None if u is None else u.tobytes() for u in units],
                                       pa.binary())],
            names=["vec_id", "unit"],
        )


def _coded(models: dict[int, _Model]) -> Callable:
    """``id, copies, unit, code, keys``: the whole code of every vector and its buckets, one of
    each table. The dimension is part of a bucket's key.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[int, list[int]] = {}
            raw = batch.column(1).to_pylist()
            for i, unit in enumerate(raw):
                groups.setdefault(len(unit) // 8, []).append(i)
            for size, at in groups.items():
                model = models[size]
                x = np.frombuffer(b"".join(raw[i] for i in at)).reshape(-1, size)
                code = _codes(x, model.center, model.planes)
                whole = [row.tobytes() for row in code.astype(_CODE)]
                key = code & ((np.int64(1) << model.bits) - 1)
                key |= np.arange(TABLES, dtype=np.int64) << BITS
                key |= np.int64(size) << 32
                some = batch.take(pa.array(at))
                starts = pa.array(np.arange(len(at) + 1, dtype=np.int32) * TABLES)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(2), some.column(1), pa.array(whole, pa.binary()),
                     pa.ListArray.from_arrays(starts, pa.array(key.ravel()))],
                    names=["id", "copies", "unit", "code", "keys"],
                )

    return run


class _Codes:
    """Sorted entries as arrays, compared by their whole codes; vectors have one length."""

    def __init__(self, batch: pa.RecordBatch, bits: int, far: int):
        def column(name: str) -> pa.Array:
            return batch.column(batch.schema.get_field_index(name))

        self.column, self.far = column, far
        self.key, self.part, self.side, self.id = (
            column(n).to_numpy() for n in ("key", "part", "side", "id")
        )
        self.code = np.frombuffer(b"".join(column("code").to_pylist()), _CODE).reshape(-1, TABLES)
        self.used = _CODE.type((1 << bits) - 1)
        change = (np.diff(self.key) != 0) | (np.diff(self.part) != 0)
        self.starts = np.concatenate([[0], np.flatnonzero(change) + 1])
        self.ends = np.concatenate([self.starts[1:], [len(self.id)]])

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the codes of the pairs are near enough."""
        return _distance(self.code[i], self.code[j]) <= self.far

    def near_grid(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``near`` of all of ``a`` with all of ``b``."""
        wide_a, wide_b = self.code[a].view(np.uint64), self.code[b].view(np.uint64)
        apart = np.zeros((len(a), len(b)), np.uint16)
        for x, y in zip(wide_a.T, wide_b.T):
            apart += np.bitwise_count(x[:, None] ^ y[None, :])
        return apart <= self.far

    def first_met(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs for which no table before that of their entry holds both."""
        table = (self.key[i] >> BITS) & 0xFFFF
        alive, done = np.arange(len(i)), []
        for t in range(TABLES):
            at_end = table[alive] == t
            done.append(alive[at_end])
            alive = alive[~at_end]
            if not len(alive):
                break
            alive = alive[((self.code[i[alive], t] ^ self.code[j[alive], t]) & self.used) != 0]
        done = np.concatenate(done)
        return i[done], j[done]

    def small_pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs at each distance within the blocks of up to SMALL entries, all blocks at once."""
        sizes = self.ends - self.starts
        alone = (sizes <= SMALL) & (self.side[self.starts] == 2)
        end = np.repeat(np.where(alone, self.ends, 0), sizes)
        at = np.arange(len(self.id))
        for distance in range(1, SMALL):
            i = at[at + distance < end]
            if not len(i):
                return
            i = i[self.near(i, i + distance)]
            yield i, i + distance

    def large_pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of each larger block: side 0 meets side 1, or side 2 meets itself."""
        for start, end in zip(self.starts, self.ends):
            side = self.side[start:end]
            alone = (side == 2).any()
            if end - start <= SMALL and alone:
                continue
            a = start + np.flatnonzero(side != 1)
            b = a if alone else start + np.flatnonzero(side == 1)
            for at in range(0, len(a), 256):
                own = a[at: at + 256]
                i, j = np.nonzero(self.near_grid(own, b))
                i, j = own[i], b[j]
                yield (i[i < j], j[i < j]) if alone else (i, j)

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All near pairs, each in the first table that it shares."""
        for found in (self.small_pairs(), self.large_pairs()):
            for i, j in found:
                yield self.first_met(i, j)


class _Vectors(_Codes):
    """Entries compared by the cosine of their vectors, and by their codes."""

    def __init__(self, batch: pa.RecordBatch, bits: int, far: int):
        super().__init__(batch, bits, far)
        self.copies = self.column("copies").to_numpy()
        self.unit = np.frombuffer(b"".join(self.column("unit").to_pylist()))
        self.unit = self.unit.reshape(len(self.id), -1)

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        dots = np.einsum("ij,ij->i", self.unit[i], self.unit[j])
        return (dots >= COSINE) & super().near(i, j)

    def near_grid(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.unit[a] @ self.unit[b].T >= COSINE) & super().near_grid(a, b)


def _candidates(limits: dict[int, tuple[int, int]]) -> Callable:
    """The entries with a partner of a near code: ``key, part, side, id``.

    A pair asks for its vectors in the first table that it shares only.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, size in _whole_blocks(batches):
            entries = _Codes(batch, *limits[size])
            wanted = np.zeros(len(entries.id), bool)
            for i, j in entries.pairs():
                wanted[i] = wanted[j] = True
            yield batch.select(["key", "part", "side", "id"]).filter(pa.array(wanted))

    return run


def _compare(limits: dict[int, tuple[int, int]]) -> Callable:
    """Links of sorted entries: partners counted per vector, and edges that connect them.

    A pair is counted in the first table it shares. Every vector passes on the smallest vector
    that it reaches here, which keeps connections but not all pairs: ``id, links, other``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, size in _whole_blocks(batches):
            entries = _Vectors(batch, *limits[size])
            pairs = [np.zeros((0, 2), np.int64)]
            pairs = np.concatenate(pairs + [np.column_stack(p) for p in entries.pairs()])
            ids, place = np.unique(entries.id[pairs], return_inverse=True)
            place = place.reshape(-1, 2)
            links = np.bincount(place[:, 0], entries.copies[pairs[:, 1]], len(ids))
            links += np.bincount(place[:, 1], entries.copies[pairs[:, 0]], len(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(links.astype(np.int64)),
                 pa.array(ids[_forest(place, len(ids))])],
                names=["id", "links", "other"],
            )

    return run


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int]]:
    """The batches cut at ends of blocks and by the length of vectors, with that length."""
    held = None
    for batch in batches:
        batch = batch if held is None else pa.concat_batches([held, batch])
        key, part = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("key", "part"))
        last = np.flatnonzero((key != key[-1]) | (part != part[-1]))
        cut = last[-1] + 1 if len(last) else 0
        held = batch.slice(cut)
        yield from _one_length(batch.slice(0, cut))
    if held is not None:
        yield from _one_length(held)


def _one_length(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, int]]:
    length = batch.column(batch.schema.get_field_index("key")).to_numpy() >> 32
    for start, end in zip(*_runs(length)):
        yield batch.slice(start, end - start), int(length[start])


def _runs(values: np.ndarray) -> tuple[list[int], list[int]]:
    if not len(values):
        return [], []
    edges = (np.flatnonzero(np.diff(values)) + 1).tolist()
    return [0, *edges], [*edges, len(values)]


def _forest(edges: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable number of 0 .. n - 1 along ``edges``, by repeated minima."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, edges[:, 0], label[edges[:, 1]])
        np.minimum.at(label, edges[:, 1], label[edges[:, 0]])
        label = label[label]
        if (label == before).all():
            return label


def near_vectors(
    vectors: DataFrame, *, key: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Equal vectors collapse to the smallest id with a number of copies. TABLES codes of up to
    BITS learned bits, as many as keep RECALL of the links (``table_bits``), index all of them;
    the vectors of a bucket are compared by their whole codes first, and only those with a
    partner of a near code move their vectors, to the first table that they share, where
    cosines in double precision decide. How far codes may differ is measured like the bits
    (``table_bits``). A bucket over BLOCK vectors is cut into blocks, and every two blocks meet
    in a task of their own, so nothing is left out of a large bucket.

    Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing and are kept, as are null ids. Vectors of different length link with nothing
    across lengths. Rows repeated with the same id and vector count as copies of each other;
    every row gets the result of its vector. Rows with one id and different vectors are
    vectors of their own, linked through nothing but their cosines.
    """
    spark = vectors.sparkSession
    rows = settle(
        vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
        .mapInArrow(_units, "vec_id long, unit binary")
        .withColumns({"same": F.xxhash64("unit"), "same_2": F.crc32("unit"),
                      "usable": F.expr("unit is not null and vec_id is not null")})
    )
    usable = rows.filter("usable")
    same = ["same", "same_2"]
    # a class has a number of its own: one id may have several vectors
    classes = settle(usable.groupBy(*same).agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    ).withColumn("id", F.monotonically_increasing_id()))
    distinct = settle(
        # by what the join is dealt by: vectors move once
        usable.join(classes, same).filter("vec_id = rep").dropDuplicates(same)
        .select("id", "copies", "unit")
    )
    models = _models(distinct)
    limits = {size: (model.bits, model.far) for size, model in models.items()}
    coded = settle(
        distinct.select("id", "unit", "copies").mapInArrow(
            _coded(models), "id long, copies long, unit binary, code binary, keys array<long>"
        )
    )
    posts = coded.select("id", F.explode("keys").alias("key"))
    parts = F.ceil(F.col("n") / BLOCK)
    lists = posts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        F.col("key").alias("l_key"), parts.alias("parts")
    )
    own = F.pmod(F.xxhash64("id"), F.col("parts"))
    meeting = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("parts") - 1),
        lambda x: F.struct(
            (F.least(own, x) * F.col("parts") + F.greatest(own, x)).alias("part"),
            F.when(x == own, 2).when(own < x, 0).otherwise(1).cast("int").alias("side"),
        ),
    )
    entries = (
        posts.join(lists, F.col("key") == F.col("l_key"))
        .select("key", "id", F.explode(meeting).alias("at"))
        .join(coded.select("id", "code"), "id")
        .select("key", "at.part", "at.side", "id", "code")
    )
    wanted = (
        entries.repartition("key", "part").sortWithinPartitions("key", "part")
        .mapInArrow(_candidates(limits), "key long, part long, side int, id long")
    )
    found = settle(
        wanted.join(coded.drop("keys"), "id")
        .repartition("key", "part").sortWithinPartitions("key", "part")
        .mapInArrow(_compare(limits), "id long, links long, other long")
    )
    counts = found.groupBy(F.col("id").alias("c_id")).agg(F.sum("links").alias("links"))
    roots = components(found, "id", "other")
    placed = (
        classes.join(counts, F.col("id") == F.col("c_id"), "left")
        .join(roots, F.col("id") == F.col("node"), "left")
        .select(*same, "rep",
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("root", "id").alias("component"))
    )
    least = placed.groupBy(F.col("component").alias("l_component")).agg(F.min("rep").alias("root"))
    of_class = placed.join(least, F.col("component") == F.col("l_component")).select(
        *[F.col(c).alias(f"c_{c}") for c in same], "n_links", "root"
    )
    joined = rows.select("vec_id", "usable", *same).join(
        of_class, F.col("usable")
        & (F.col("same") == F.col("c_same")) & (F.col("same_2") == F.col("c_same_2")), "left",
    )
    component = F.coalesce("root", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _models(distinct: DataFrame) -> dict[int, _Model]:
    """Centre, projections and bits per length, from SAMPLE_ROWS vectors by their hash.

    A fifth of a sample that is large enough is held out to find the bits. Every length that
    occurs is learned, one after the other; its model takes 4 KB a dimension.
    """
    sizes = distinct.groupBy((F.length("unit") / 8).cast("int").alias("size")).agg(
        F.count(F.lit(1)).alias("n")
    ).orderBy("size").collect()
    models = {}
    for size, n in sizes:
        draw = F.pmod(F.xxhash64("unit", F.lit("rotation")), F.lit(1 << 30)) / float(1 << 30)
        sample = distinct.filter((F.length("unit") == 8 * size) & (draw < SAMPLE_ROWS / n)).select(
            "unit").limit(2 * SAMPLE_ROWS).collect()
        units = sorted(bytes(r.unit) for r in sample)
        x = np.frombuffer(b"".join(units)).reshape(-1, size)
        held = np.arange(len(x)) % 5 == 0 if len(x) >= 500 else np.zeros(len(x), bool)
        center = np.median(x[~held], axis=0) if len(x) else np.zeros(size)
        planes = learn_rotations(x[~held] - center, TABLES * BITS)
        test = x[held] if held.any() else x
        bits = table_bits(test, x, center, planes) if len(x) else (BITS, TABLES * BITS)
        models[size] = _Model(center, planes, *bits)
    return models
