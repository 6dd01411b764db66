"""Document operators against plain versions, and on odd rows."""

import bisect
import hashlib
import itertools
import random
from collections import Counter

import pytest

from tests.llm import helpers as H
from tidewire.llm import (
    license_scan, line_dedup, mixing, near_dedup, packing, quality_rules, substring_dedup,
)

LONG = " ".join(f"w{i * 7919 % 9973}x" for i in range(6000))
ODD = [
    (1, None, "a"), (2, "", None), (3, " \t\n", "b"), (4, "one", None), (5, "one", "a"),
    (5, "one", "a"), (None, "no id but quite some words in it", "a"), (6, LONG, "b"),
    (7, LONG, "c"), (8, "é ü " * 30, "c"), (9, "x" * 5000, "d"),
]


def sample_rows(seed=1, n=60):
    """Texts with copies, edits, shared passages, repeated lines and windows."""
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abcdeé", k=draw.randint(1, 6))) for _ in range(300)]

    def text(k):
        return " ".join(draw.choices(vocabulary, k=k))

    passage, line = text(30), text(6)
    rows = []
    for i in range(n):
        kind = i % 6
        if kind == 1 and rows:
            body = draw.choice(rows)[1]
        elif kind == 2 and rows:
            own = draw.choice(rows)[1].split(" ")
            for _ in range(max(1, len(own) // 60)):
                own[draw.randrange(len(own))] = draw.choice(vocabulary)
            body = " ".join(own)
        elif kind == 3:
            body = text(20) + "\n" + passage + "\n" + text(25)
        elif kind == 4:
            body = line + "\n" + text(15) + "\n" + line + "\n# " + text(15).upper()
        else:
            body = text(draw.choice([3, 5, 12, 80, 200]))
            body = body + " " + body if i % 12 == 0 else body
        rows.append((i, body, f"s{draw.randrange(14)}"))
    return rows


@pytest.fixture(scope="module")
def rows():
    return sample_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return H.documents(spark, rows)


@pytest.fixture(scope="module")
def odd(spark):
    return H.documents(spark, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return H.documents(spark, [])


def by_id(frame):
    return {r["doc_id"]: r.asDict() for r in frame.collect()}


def clashing(docs):
    """Extra columns named like those the operators make."""
    from pyspark.sql import functions as F

    names = ["n_words", "kept", "size", "part", "id", "key", "component_id", "n_removed",
             "n_lines", "host", "place", "tw_words", "runs", "m_id", "rank", "words", "bucket"]
    return docs.withColumns({n: F.lit("clash") for n in names})


# --- Quality rules -----------------------------------------------------------------------


def test_quality_counts(docs, rows):
    found = by_id(quality_rules.judge(docs))
    for i, text, _ in rows:
        expected = H.quality_counts(text)
        assert {k: found[i][k] for k in expected} == expected, i
        n = expected["n_words"]
        base = n < 20 or 100 * expected["n_repeat_words"] > 30 * n
        assert found[i]["base_failed"] == base
        assert not (base and found[i]["kept"])


def test_quality_odd(odd, empty):
    found = quality_rules.judge(clashing(odd)).collect()
    assert len(found) == len(ODD)
    assert all(r.base_failed and not r.kept for r in found if r.doc_id in (1, 2, 3, 4, 5))
    long = next(r for r in found if r.doc_id == 6)
    assert long.n_words == 6000 and long.kept
    assert quality_rules.judge(empty).count() == 0


def test_hosts_with_few_documents_stay_near_the_mean(spark):
    rows = [("big", i < 900) for i in range(1000)] + [("good", False)] * 1000 + [("tiny", True)]
    verdicts = {
        r.host: r for r in quality_rules.host_verdicts(
            spark.createDataFrame(rows, "host string, failed boolean")).collect()
    }
    assert verdicts["big"].host_verdict == "rejected"
    assert verdicts["good"].host_verdict == "trusted"
    assert verdicts["tiny"].host_verdict != "rejected"


def test_a_rejected_host_takes_its_documents_along(spark):
    bad = [(i, "# " * 40, "junk") for i in range(200)]
    fine = [(1000 + i, f"some plain words {i} " + " ".join(f"v{i}x{k}" for k in range(30)), "good")
            for i in range(200)]
    lone = [(5000, " ".join(f"u{k}" for k in range(40)), "junk")]
    found = by_id(quality_rules.judge(H.documents(spark, bad + fine + lone)))
    assert not found[5000]["kept"] and found[1000]["kept"]


# --- Mixing ------------------------------------------------------------------------------


def test_mix_targets(spark):
    rows = [(i, "w " * (1 + i % 50), f"s{i % 7}" if i % 7 else None) for i in range(3000)]
    rows += [(9000 + i, "w " * 30, "s1") for i in range(2000)]
    found = mixing.mix(H.documents(spark, rows)).collect()
    assert len(found) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in found:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    weights = dict(zip(["s1", "s2", "s3", "s4", "s5", "s6", None], [5, 2, 1, 5, 2, 1, 5]))
    expected, level, free = {}, 1.5 * sum(sizes.values()), set(weights)
    while free:
        unit = level / sum(weights[s] for s in free)
        full = {s for s in free if weights[s] * unit > 2 * sizes[s]}
        if not full:
            expected |= {s: weights[s] * unit for s in free}
            break
        for s in full:
            expected[s] = 2.0 * sizes[s]
            level -= expected[s]
        free -= full
    for s in weights:
        assert target[s] == pytest.approx(expected[s])
        assert abs(taken[s] - target[s]) <= 60
    again = mixing.mix(H.documents(spark, rows[::-1])).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def plain_mix(rows, targets):
    """Copies by ``(doc_id, source, size)``, playing the queues entry by entry."""
    queues = {}
    for i, text, source in rows:
        if H.words(text):
            place = hashlib.md5((mixing.SEED + ("" if i is None else str(i))).encode()).hexdigest()
            bucket = int(place[:8], 16) % mixing.QUEUE_BUCKETS
            queues.setdefault(source, []).append((bucket, place, i, len(H.words(text))))
    entries, total = [], 0
    for source, queue in queues.items():
        size, played = sum(q[3] for q in queue), 0
        total += size
        for _, _, i, n in sorted(queue):
            played += n
            entries += [((played + size * p) / targets[source], n, (i, source, n)) for p in (0, 1)]
    entries.sort(key=lambda e: e[0])
    copies, spent = Counter(), 0
    for _, same in itertools.groupby(entries, key=lambda e: e[0]):
        same = list(same)
        spent += sum(e[1] for e in same)
        if spent > 1.5 * total:
            break
        copies.update(e[2] for e in same)
    return copies


def test_mix_takes_what_the_queues_serve(spark):
    draw = random.Random(12)
    rows = [(i, "w " * draw.randint(0, 30), draw.choice(["s1", "s1", "s1", "s2", "s3", None]))
            for i in range(800)]
    found = mixing.mix(H.documents(spark, rows)).collect()
    expected = plain_mix(rows, {r.source: r.target for r in found})
    assert {(r.doc_id, r.source, r.size): r.copies for r in found if r.copies} == dict(expected)


def test_mix_odd(odd, empty):
    found = mixing.mix(clashing(odd)).collect()
    assert len(found) == len(ODD)
    assert all(r.size == 0 and r.taken == 0 for r in found if r.doc_id in (1, 2, 3))
    assert mixing.mix(empty).count() == 0
    mixed = mixing.mixed_documents(clashing(odd))
    assert mixed.columns == clashing(odd).columns
    assert mixing.mixed_documents(empty).count() == 0


# --- Near duplicates ---------------------------------------------------------------------


def test_near_components(docs, rows):
    expected = H.near_components(rows)
    found = by_id(near_dedup.near_duplicates(docs))
    assert {i: r["component_id"] for i, r in found.items()} == expected
    assert {i: r["n_shingles"] for i, r in found.items()} == {
        i: len(H.shingle_set(t)) for i, t, _ in rows
    }


def test_near_groups_larger_than_a_block(spark, monkeypatch):
    """A base, copies near to it and apart from each other, and outsiders in the same lists."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    draw = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(60):
        own = list(base)
        for _ in range(draw.choice([0, 1, 2, 3, 6])):
            own[draw.randrange(len(own))] = f"x{draw.random()}"
        rows.append((i, " ".join(own), "a"))
    found = by_id(near_dedup.near_duplicates(H.documents(spark, rows)))
    assert {i: r["component_id"] for i, r in found.items()} == H.near_components(rows)


def test_near_odd(odd, empty):
    found = near_dedup.near_duplicates(clashing(odd)).collect()
    assert len(found) == len(ODD)
    at = {r.doc_id: r for r in found}
    assert at[1].component_id == 1 and at[2].component_id == 2 and at[1].n_shingles == 0
    assert at[5].component_id == 4 and not at[5].kept and at[4].n_shingles == 1
    assert at[7].component_id == 6 and at[None].component_id is None and at[None].kept
    assert near_dedup.near_duplicates(empty).count() == 0


# --- Licenses ----------------------------------------------------------------------------


def test_license_scan(spark):
    texts = {
        1: "see the GNU-General public License; and the Apache license, apache license",
        2: "cc by cc by mit license",
        3: "Permission is hereby granted, free of charge, to any nice person obtaining a copy of "
           "this software and associated documentation files (the Software), to deal in the "
           "Software without restriction",
        4: "ordinary text about a license of sorts",
        5: "xcc by mit licenses", 6: None,
    }
    found = by_id(license_scan.scan(H.documents(spark, [(i, t, "a") for i, t in texts.items()])))
    assert found[1]["n_base"] == 3 and found[1]["base_labels"] == "apache,gpl"
    assert (found[1]["first_word"], found[1]["last_word"]) == (2, 10)
    assert found[2]["n_base"] == 3 and found[2]["last_word"] == 4
    assert found[3]["labels"] == "mit-notice" and 0.6 <= found[3]["score"] < 1
    assert found[4]["labels"] == "" and found[4]["score"] == 0.0
    assert found[5]["n_base"] == 0 and found[5]["first_word"] is None
    assert found[6]["n_words"] == 0 and found[6]["labels"] == ""


def test_license_wording_of_another(spark):
    """The better template holds where spans overlap; chained or shuffled grams are no span."""
    by_label = {}
    for label, text in license_scan.TEMPLATES:
        by_label.setdefault(label, text)
    gpl = by_label["gpl-notice"].split()
    chained = " ".join(" ".join(gpl[i: i + 3]) for i in range(len(gpl) - 2))
    mit = by_label["mit-body"].split()
    texts = {
        1: " ".join(gpl), 2: by_label["lgpl-notice"], 3: chained, 4: by_label["mit-body"],
        5: " ".join(gpl[::-1]), 6: "released under the under the mit the mit license".replace("mit license", "mit"),
        # ten words put into the middle of a body, and a fifth of it lost
        7: " ".join(mit[:60] + [f"x{i}" for i in range(10)] + mit[60:130]),
        8: " ".join(gpl + [f"w{i}" for i in range(300)] + by_label["lgpl-notice"].split()),
        9: " ".join(gpl) + " and " + " ".join(gpl),
        10: " ".join(mit[100:] + mit[:100]),
    }
    found = by_id(license_scan.scan(H.documents(spark, [(i, t, "a") for i, t in texts.items()])))
    labels = {i: r["labels"] for i, r in found.items()}
    assert labels[1] == "gpl,gpl-notice" and labels[2] == "lgpl-notice"
    assert labels[3] == "" and labels[5] == "" and labels[6] == "" and found[3]["score"] == 0.0
    assert "mit-body" in labels[4] and "isc" not in labels[4] and found[4]["score"] == 1.0
    assert "mit-body" in labels[7] and 0.6 <= found[7]["score"] < 1
    assert labels[8] == "gpl,gpl-notice,lgpl-notice" and labels[9] == "gpl,gpl-notice"


def test_license_odd(odd, empty):
    assert license_scan.scan(clashing(odd)).count() == len(ODD)
    assert license_scan.scan(empty).count() == 0


# --- Lines -------------------------------------------------------------------------------


def plain_lines(rows, least):
    sites, first = {}, {}
    for i, text, site in rows:
        for line in (text or "").split("\n"):
            bare = line.strip(" \t\n\x0b\x0c\r")
            if bare:
                sites.setdefault(bare, set()).add(site)
                first[bare] = min(first.get(bare, i), i)
    wide = {x for x, s in sites.items() if len(s - {None}) >= least}
    return {
        i: "\n".join(
            x for x in text.split("\n")
            if (b := x.strip(" \t\n\x0b\x0c\r")) not in wide or first[b] == i
        ) for i, text, _ in rows
    }


@pytest.mark.parametrize("least", [2, 4, 7])
def test_lines(docs, rows, least):
    found = by_id(line_dedup.dedup_lines(docs, least))
    assert {i: r["text"] for i, r in found.items()} == plain_lines(rows, least)
    before = {i: sum(bool(H.words(x)) for x in t.split("\n")) for i, t, _ in rows}
    assert {i: r["n_lines"] for i, r in found.items()} == before


def test_lines_odd(odd, empty):
    found = line_dedup.dedup_lines(clashing(odd), 2)
    assert set(found.columns) == set(clashing(odd).columns)
    texts = [(r.doc_id, r.text) for r in found.collect()]
    assert len(texts) == len(ODD) and (1, None) in texts and (7, "") in texts and (6, LONG) in texts
    assert line_dedup.dedup_lines(empty).count() == 0


# --- Packing -----------------------------------------------------------------------------


def test_pack_round_trip(docs, rows):
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    found = packing.pack(docs, capacity=256).toPandas()
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t, _ in rows}
    assert found.groupby("doc_id").length.sum().to_dict() == {i: len(x) for i, x in ids.items()}
    for r in found.itertuples():
        part = np.array(ids[r.doc_id][r.start: r.start + r.length], "<u4")
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
    for _, row in found.sort_values("offset").groupby("sequence_id"):
        assert row.offset.tolist() == [0, *row.length.cumsum().tolist()[:-1]]
        assert row.length.sum() <= 256
    for i, own in found.sort_values("piece").groupby("doc_id"):
        assert own.piece.tolist() == list(range(len(own)))
        assert all(n == 256 for n in own.length.tolist()[1:])
    assert found.sequence_id.nunique() <= found.length.sum() / 256 * 1.1 + 1


def test_pack_added_tokens(spark):
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    end = "<|endoftext|>"
    texts = [f"a{end}b", end, f" {end} \n x", f"  {end}'s", end * 2, f"one  {end}  two {end}",
             "<|endoftext|", "plain 'tis", f"é{end}\n\n{end}ü", ""]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = packing.pack(H.documents(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()
    ids = [[*tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert ids[0] == [64, 50256, 65, 0]
    assert {r.doc_id: (r.length, r.ids_crc32) for r in found} == {
        i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in enumerate(ids)
    }


def test_plan_fills_every_rank_once():
    draw = random.Random(5)
    counts = {n: draw.randint(1, 400) for n in draw.sample(range(1, 101), 60)}
    plan = packing.plan_slots(counts, 100)
    used = {}
    for length, rank, number, first, offset in plan.tolist():
        for k in range(number):
            used.setdefault(first + k, []).append((offset, length))
    placed = [n for slots in used.values() for _, n in slots]
    assert sorted(placed) == sorted(n for n, c in counts.items() for _ in range(c))
    for slots in used.values():
        end = 0
        for offset, length in sorted(slots):
            assert offset == end
            end += length
        assert end <= 100
    assert len(used) <= 1.01 * plain_best_fit(counts, 100)


def plain_best_fit(counts, capacity):
    """Sequences that best-fit decreasing opens, document by document."""
    free = []
    for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        at = bisect.bisect_left(free, length)
        space = free.pop(at) if at < len(free) else capacity
        bisect.insort(free, space - length)
    return len(free)


def test_pack_odd(odd, empty):
    found = packing.pack(clashing(odd)).collect()
    assert len({(r.sequence_id, r.offset) for r in found}) == len(found)
    assert [r.length for r in found if r.doc_id == 1] == [1]
    assert packing.pack(empty).count() == 0


# --- Strings -----------------------------------------------------------------------------


def test_strings(docs, rows):
    found = by_id(substring_dedup.remove_earlier(docs))
    got = {i: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
           for i, r in found.items()}
    assert got == H.without_earlier(rows)


def test_strings_of_a_given_table(spark):
    """Whatever is removed from it are strings of an earlier document, and nothing else is."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = by_id(substring_dedup.remove_earlier(docs))
    want = H.without_earlier(rows)
    assert sum(n > 0 for _, n, _, _ in want.values()) > 50
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
            for i, r in found.items()} == want


def test_periodic_and_touching_strings(spark):
    rows = [
        (1, "ab" * 60, "a"), (2, "x" + "ab" * 40 + "y" * 60, "a"), (3, "y" * 55 + "ab" * 30, "a"),
        (4, "z" * 49 + "y" * 49, "a"), (5, "ö" * 40, "a"), (6, "-" + "ö" * 40, "a"),
    ]
    found = by_id(substring_dedup.remove_earlier(H.documents(spark, rows)))
    got = {i: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
           for i, r in found.items()}
    assert got == H.without_earlier(rows)


def lost_bytes(rows, parts=64, tasks=3):
    """Lost bytes per document, contexts moved and number of hot q-grams, by the steps of
    ``earlier_runs`` in this process."""
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute

    tables = [
        pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in own]), pa.array([i % 7 for i, _ in own]),
             pa.array([t for _, t in own])], names=["doc_id", "text_key", "text"])
        for own in (rows[k::tasks] for k in range(tasks))
    ]

    def shuffled(step):
        found = [b for t in tables for b in step(iter([t]))]
        return pa.Table.from_batches(found).sort_by("part").to_batches()

    shared = list(substring_dedup._shared_bits(iter(shuffled(substring_dedup._seen(parts)))))
    shared = [r for b in shared for r in b.to_pylist()]
    stretch = substring_dedup.STRETCH_BITS // 8
    bits = np.zeros((substring_dedup.FILTER_BITS // 8 // stretch, stretch), np.uint8)
    for r in shared:
        bits[r["stretch"]] |= np.frombuffer(r["bits"], np.uint8)
    hot = np.concatenate([np.frombuffer(r["hot"], "<u8") for r in shared])
    contexts = shuffled(substring_dedup._contexts(
        parts, SimpleNamespace(value=bits.tobytes()), SimpleNamespace(value=hot)))
    moved = sum(pa.compute.sum(b.column(1)).as_py() for b in contexts)
    gone = {i: set() for i, _ in rows}
    for r in (r for b in substring_dedup._matched(iter(contexts)) for r in b.to_pylist()):
        gone[r["m_id"]].update(range(r["start"], r["end"]))
    return {i: len(x) for i, x in gone.items()}, moved, len(hot)


def test_passage_of_many_documents():
    draw = random.Random(12)

    def text(k):
        return "".join(draw.choices("abcdefgh ", k=k))

    # its inner contexts are equal, those at its end differ by document
    passage = text(1000)
    rows = [(i, passage + text(80)) for i in range(600)]
    draw.shuffle(rows)
    lost, moved, _ = lost_bytes(rows)
    assert lost == {i: r[1] for i, r in H.without_earlier(rows).items()}
    assert moved < 600 * 12  # before: every anchor of every copy, over 600 * 40


@pytest.mark.parametrize("settings", [
    {"HOT": 4},
    {"HOT": 4, "SLICE": 7, "GATHER": 64, "CHUNK": 128, "TOGETHER": 5},
    {"HOT": 1, "SLICE": 16, "CHUNK": 100},
    {"HOT": 40, "GATHER": 8, "CHUNK": 60, "parts": 1 << 20},
])
def test_hot_grams_and_long_texts(monkeypatch, settings):
    draw = random.Random(3)

    def text(k):
        return "".join(draw.choices("abcdefgh ", k=k))

    short, long = text(60), text(300)
    rows = [(i, text(draw.randint(30, 90)) + [short, long, ""][i % 3] + text(draw.randint(30, 90)))
            for i in range(150)]
    rows += [(900, "-" * 3000 + "q" * 60), (901, "k" * 10 + "-" * 500), (902, "x" + "ab" * 60)]
    rows += [(903, "y" * 55 + "ab" * 30)]
    draw.shuffle(rows)
    settings = dict(settings)
    parts = settings.pop("parts", 64)
    for name, value in settings.items():
        monkeypatch.setattr(substring_dedup, name, value)
    lost, _, hot = lost_bytes(rows, parts)
    assert hot and lost == {i: r[1] for i, r in H.without_earlier(rows).items()}


def test_strings_odd(odd, empty):
    found = substring_dedup.remove_earlier(clashing(odd)).collect()
    assert len(found) == len(ODD)
    at = {r.doc_id: r for r in found}
    assert at[7].n_removed == at[7].n_bytes == len(LONG) and at[7].n_spans == 1
    assert at[6].n_removed == 0 and at[None].n_removed == 0 and at[9].n_removed == 0
    assert substring_dedup.remove_earlier(empty).count() == 0
