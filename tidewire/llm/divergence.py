"""How the vocabularies of sources differ: exact divergences between sources of a language.

Texts become term counts in Arrow compute kernels inside ``mapInArrow``; the partial counts
meet in Spark, and columnar shards of the vocabulary turn counts into divergences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidewire.llm.common import settle

#: Bytes between terms: ASCII but for letters.
NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000

#: Bytes of text counted at once; longer texts are cut between terms.
PIECE = 4 << 20
#: Rows of partial counts a task holds before it merges them, and sends them if still as many.
HELD = 1 << 19
#: Terms of a shard and sources of a block: a group has SHARD_TERMS x 2 BLOCK counts at most.
SHARD_TERMS = 4096
BLOCK = 32
#: Parts into which the counts of one source are dealt for the join with its totals.
SALTS = 64

_COUNTS = "lang string, source string, term string, n long, docs long"
_OUT = "lang string, source string, part string, item string, value long, seen long, base long, vocabulary long"
_ORDER = [("value", "descending"), ("item", "ascending")]


def _between(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to no term."""
    return (data < 0x41) | ((data > 0x5A) & (data < 0x61)) | ((data > 0x7A) & (data < 0x80))


def _slices(text: str) -> list[str]:
    """A long text cut between terms; a term is never cut, however long."""
    raw = text.encode()
    gaps = np.flatnonzero(_between(np.frombuffer(raw, np.uint8)))
    out, start = [], 0
    while len(raw) - start > PIECE:
        at = int(np.searchsorted(gaps, start + PIECE))
        # the last gap inside the piece, or else the first one after it
        if at and gaps[at - 1] > start:
            at -= 1
        elif at == len(gaps):
            break
        cut = int(gaps[at])
        out.append(raw[start:cut].decode())
        start = cut
    return [*out, raw[start:].decode()]


def _term_counts(texts: pa.Array, row: np.ndarray) -> pa.Table:
    """``row, term, n`` of texts of bounded size; ``row`` names the document of each text."""
    pieces = pc.split_pattern_regex(pc.ascii_lower(texts), NO_TERM)
    parent = pa.array(row[pc.list_parent_indices(pieces).to_numpy()])
    terms = pc.list_flatten(pieces)
    full = pc.greater(pc.binary_length(terms), 0)
    coded = terms.filter(full).dictionary_encode()
    # one key of row and code: grouping by a number is faster than by two columns
    size = max(len(coded.dictionary), 1)
    both = np.asarray(parent.filter(full)) * size + coded.indices.to_numpy().astype(np.int64)
    found = pa.table({"both": both}).group_by("both").aggregate([([], "count_all")])
    both = found["both"].to_numpy()
    return pa.table({
        "row": both // size, "term": coded.dictionary.take(pa.array(both % size)),
        "n": found["count_all"],
    })


def _row_counts(texts: pa.Array) -> Iterator[pa.Table]:
    """``row, term, n`` tables; all counts of a document are in one of them."""
    sizes = pc.binary_length(texts).to_numpy()
    begin = 0
    while begin < len(texts):
        if sizes[begin] > PIECE:
            parts = [
                _term_counts(pa.array([x], texts.type), np.array([begin], np.int64))
                for x in _slices(texts[begin].as_py())
            ]
            whole = pa.concat_tables(parts).group_by(["row", "term"]).aggregate([("n", "sum")])
            yield whole.rename_columns({"n_sum": "n"}).select(["row", "term", "n"])
            begin += 1
            continue
        end = begin + 1
        held = int(sizes[begin])
        while end < len(texts) and held + sizes[end] <= PIECE:
            held += int(sizes[end])
            end += 1
        yield _term_counts(texts.slice(begin, end - begin), np.arange(begin, end, dtype=np.int64))
        begin = end


def _merged(tables: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate(
        [("n", "sum"), ("docs", "sum")]
    )
    return found.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(
        ["lang", "source", "term", "n", "docs"]
    )


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language, source and term of a task; the empty term marks a group."""
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        lang, source = batch["lang"].cast(pa.string()), batch["source"].cast(pa.string())
        texts = batch["text"].cast(pa.string())
        held.append(_merged([pa.table({
            "lang": lang, "source": source, "term": pa.nulls(len(lang), pa.string()).fill_null(""),
            "n": pa.repeat(pa.scalar(0, pa.int64()), len(lang)),
            "docs": pa.repeat(pa.scalar(1, pa.int64()), len(lang)),
        })]))
        for counts in _row_counts(texts):
            at = counts["row"]
            held.append(_merged([pa.table({
                "lang": lang.take(at.combine_chunks()), "source": source.take(at.combine_chunks()),
                "term": counts["term"], "n": counts["n"],
                "docs": pa.repeat(pa.scalar(1, pa.int64()), len(counts)),
            })]))
            rows += len(held[-1])
            if rows > HELD:
                held = [_merged(held)]
                rows = len(held[0])
            if rows > HELD:
                yield from held.pop().to_batches(max_chunksize=1 << 16)
                rows = 0
    if held:
        yield from _merged(held).to_batches(max_chunksize=1 << 16)


def term_counts(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source",
) -> DataFrame:
    """``lang, source, term, n, lang_n``: counts of the kept terms, and one row per group.

    A term is kept if ``MIN_DOCS`` documents of its language have it. The row with the empty
    term stands for the group itself, so groups without terms are not lost. Counts are summed
    in the tasks first; then one shuffle by language and term serves the sums per source and
    those per language.
    """
    rows = docs.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
        for c, name in ((text, "text"), (lang, "lang"), (source, "source"))
    ])
    summed = (
        rows.mapInArrow(_partial_counts, _COUNTS).repartition("lang", "term")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    term = Window.partitionBy("lang", "term")
    return (
        summed.withColumns({
            "lang_n": F.sum("n").over(term), "lang_docs": F.sum("docs").over(term),
            # one row of a term counts it for its language
            "one": (F.row_number().over(term.orderBy("source")) == 1).cast("long"),
        })
        .filter((F.col("term") == "") | (F.col("lang_docs") >= MIN_DOCS))
        .select("lang", "source", "term", "n", "lang_n", "one")
    )


def group_totals(counts: DataFrame) -> DataFrame:
    """``lang, source, total, place, sources, lang_total, vocabulary`` of every group."""
    groups = counts.groupBy("lang", "source").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(F.col("term") != "", F.col("one")).otherwise(0)).alias("new_terms"),
    )
    lang = Window.partitionBy("lang")
    return groups.select(
        "lang", "source", "total",
        (F.row_number().over(lang.orderBy("source")) - 1).alias("place"),
        F.count(F.lit(1)).over(lang).alias("sources"),
        F.sum("total").over(lang).alias("lang_total"),
        F.sum("new_terms").over(lang).alias("vocabulary"),
    )


def shares(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """``1 + floor(SCALE * (count + 1) / total)`` by long division, exact up to totals of 9e15.

    SCALE is 1000 ** 3, and every rest is below ``total``, so no product exceeds 64 bits.
    """
    whole, rest = np.divmod(np.asarray(counts, np.int64) + 1, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    return whole + 1


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``floor((p - q) * (p - q) / q)``; shares are at most SCALE + 1, squares below 2 ** 63."""
    return (p - q) * (p - q) // q


def _encoded(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    coded = column.combine_chunks().dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def _shard(table: pa.Table) -> pa.Table:
    """Partial sums of all pairs of sources of two blocks, and the best terms of a source.

    The table has the counts of some terms of one language, and a row with the empty term for
    every source of both blocks. ``seen`` counts the terms of a pair's sum; for every other
    term of the vocabulary both counts are zero, and the pair's ``base`` is what it adds.
    """
    lang = table["lang"][0].as_py()
    vocabulary = table["vocabulary"][0].as_py()
    lang_total = table["lang_total"][0].as_py() + vocabulary
    marks = table.filter(pc.equal(table["term"], "")).sort_by("place")
    sources = marks["source"].combine_chunks()
    place = marks["place"].to_numpy()
    block = place // BLOCK
    totals = marks["total"].to_numpy() + vocabulary
    cells = table.filter(pc.not_equal(table["term"], ""))
    code, terms = _encoded(cells["term"])
    counts = np.zeros((len(sources), len(terms)), np.int64)
    own = np.searchsorted(place, cells["place"].to_numpy())
    counts[own, code] = cells["n"].to_numpy()
    in_lang = np.zeros(len(terms), np.int64)
    in_lang[code] = cells["lang_n"].to_numpy()
    p = np.empty_like(counts)
    none = np.ones(len(sources), np.int64)
    if vocabulary:
        p = shares(counts, totals[:, None])
        none = shares(np.zeros(len(sources), np.int64), totals)
    out: dict[str, list] = {k: [] for k in ("source", "part", "item", "value", "seen", "base")}

    def add(part: str, source: pa.Array, item: pa.Array, value, seen=0, base=0) -> None:
        n = len(item)
        out["source"].append(source)
        out["part"].append(pa.repeat(part, n))
        out["item"].append(item)
        for name, x in (("value", value), ("seen", seen), ("base", base)):
            out[name].append(pa.array(np.broadcast_to(np.asarray(x, np.int64), n)))

    alone = block[0] == block[-1]
    q = shares(in_lang, lang_total) if vocabulary else in_lang
    for i in range(len(sources)):
        # in a group of two blocks, the pairs inside a block are another group's
        others = np.flatnonzero((np.arange(len(sources)) != i) & (alone | (block != block[i])))
        if len(others):
            add("pair", pa.repeat(sources[i], len(others)), sources.take(pa.array(others)),
                _distance(p[i], p[others]).sum(axis=1), len(terms), _distance(none[i], none[others]))
        if alone:
            mine = np.flatnonzero((counts[i] > 0) & (p[i] > q))
            best = pa.table({
                "item": terms.take(pa.array(mine)), "value": _distance(p[i][mine], q[mine]),
            })
            best = best.sort_by(_ORDER).slice(0, TOP_TERMS)
            add("term", pa.repeat(sources[i], len(best)), best["item"].combine_chunks(),
                best["value"].to_numpy())
    columns = {k: pa.chunked_array(v, pa.string() if k in ("source", "part", "item") else pa.int64())
               for k, v in out.items()}
    n = len(columns["item"])
    return pa.table({
        "lang": pa.repeat(lang, n), **columns,
        "vocabulary": pa.repeat(pa.scalar(vocabulary, pa.int64()), n),
    })


def _sharded(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """Counts and group marks, dealt to ``lang, low, high, shard``: two blocks and some terms."""
    blocks = F.ceil(F.col("sources") / BLOCK)
    shards = F.greatest(F.ceil(F.col("vocabulary") / SHARD_TERMS), F.lit(1))
    own = F.floor(F.col("place") / BLOCK)
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    cells = (
        counts.filter(F.col("term") != "")
        .withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int"))
        .join(salted, ["lang", "source", "salt"])
        .withColumn("shard", F.pmod(F.xxhash64("term", F.lit(1)), shards))
    )
    marks = groups.withColumns({
        "term": F.lit(""), "n": F.lit(0).cast("long"), "lang_n": F.lit(0).cast("long"),
        "shard": F.explode(F.sequence(F.lit(0).cast("long"), shards - 1)),
    })

    def dealt(rows: DataFrame) -> DataFrame:
        other = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other")
        return rows.select("*", own.alias("own"), other).select(
            "lang", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            "shard", "source", "term", "n", "lang_n", "total", "place", "lang_total", "vocabulary",
        )

    return dealt(cells).unionByName(dealt(marks))


def _ranked(rows: DataFrame, most: int | None = None) -> DataFrame:
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(group))
    ranked = ranked if most is None else ranked.filter(F.col("rank") <= most)
    return ranked.select("lang", "source", "part", "item", "value", "rank")


def divergences(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: sources of a language against each other.

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z in lower case. A group
    (language and source) gives every kept term the share
    ``p = 1 + floor(10**9 * (count + 1) / (N + V))``, and so does the language (``q``).
    Part ``pair``: for every other source of the language, the sum over all kept terms of
    ``floor((p - q)**2 / q)`` with that source's shares as ``q``. Part ``term``: the
    ``TOP_TERMS`` terms of the group that exceed the language's share most. Ranks are per
    group and part, by value, then by item in UTF-8 order. All arithmetic is on whole numbers.

    Null texts, languages and sources are empty ones. A text without terms adds its group
    only; without kept terms the values of pairs are 0. Repeated rows are documents of their
    own, an empty table gives no row, extra columns are ignored. Long texts are worked on in
    pieces. Memory of a task: ``HELD`` counts when counting, one shard of the vocabulary times
    two blocks of sources afterwards, however many terms and sources there are.
    """
    counts = settle(term_counts(docs, text=text, lang=lang, source=source))
    groups = settle(group_totals(counts))
    parts = _sharded(counts, groups).groupBy("lang", "low", "high", "shard")
    found = settle(parts.applyInArrow(_shard, _OUT))
    unseen: Column = F.max("vocabulary") - F.sum("seen")
    pairs = found.filter(F.col("part") == "pair").groupBy("lang", "source", "part", "item").agg(
        (F.sum("value") + unseen * F.max("base")).alias("value")
    )
    terms = found.filter(F.col("part") == "term")
    return _ranked(pairs).unionByName(_ranked(terms, TOP_TERMS))
