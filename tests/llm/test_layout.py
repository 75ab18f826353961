"""Packing and sharding: exact round trips and the best partition by brute force."""

import random
import struct
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from shardstream.llm import packing, sharding
from tables import SCHEMA, documents, prose
from tokenizers import Tokenizer


def test_schedule_places_every_token_once():
    made = random.Random(3)
    for trial in range(40):
        lengths = [made.randint(600, 9000) * (20 if trial % 3 == 0 and q == 0 else 1) for q in range(made.randint(1, 7))]
        total, plan, places = sum(lengths), packing.Schedule(lengths, 64, 8), {}
        for q, length in enumerate(lengths):
            at = 0
            while at < length:
                n = min(length - at, made.randint(0, 300))
                ends = 0
                for sequence, offset, start, size in plan.pieces(q, at, n):
                    assert start == ends
                    ends += size
                    places.update({(sequence, offset + j): q for j in range(size)})
                assert ends == n
                at += n
        assert set(places) == {divmod(i, 64) for i in range(total)}
        windows = defaultdict(Counter)
        for (window, _), q in places.items():
            windows[window][q] += 1
        assert all(abs(c[q] - 64 * n / total) < 2 for w, c in windows.items() if w < total // 64 for q, n in enumerate(lengths))


def word_ids(known, text):
    found = known.encoded(pa.array([b"", text.encode(), text.encode()], pa.binary()))
    assert found[0] == b"" and found[1] == found[2]
    return list(struct.unpack(f"<{len(found[1]) // 2}H", found[1]))


def test_word_ids_are_the_tokenizers(monkeypatch):
    path = packing.vocabulary_path()
    tokenizer, known = Tokenizer.from_file(path), packing.Vocabulary(path)
    odd = "H̱a. Áb, », ab», it's. IT'S, 9. 1,2. Ünder! İx. Kab <|endoftext|>, <|EndOfText|> a, 中文。 한́. é́! ². Ⅷ, 'S 's. x'll. \x1c\x1d \x85a ẞß. ΣΣ. \x00a."
    odd += " BELGESİ. SAHİ, geldi. क़. ড়; ਖ਼! ଡ଼? གྷ: e\u0301. ᾳ, ŉ. ǰ! ﬁ. ª, µ?!"
    for text in (odd, odd.lower(), odd.upper(), odd[::-1], prose(3, 500), "", " \n"):
        assert word_ids(known, text) == tokenizer.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(packing, "MEMO_WORDS", 50)  # generations change all the time
    for i in range(30):
        text = prose(i % 4, 300, 150)
        assert word_ids(known, text) == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(known.ids) + len(known.older) < 800


def test_every_letter_before_every_sign():
    """All letters and digits there are, before each of the closing signs."""
    path = packing.vocabulary_path()
    tokenizer, known = Tokenizer.from_file(path), packing.Vocabulary(path)
    letters = [chr(c) for c in range(0x110000) if chr(c).isalnum()]
    signs = packing.TAIL.decode()
    words = [f"{'aB'[i % 2]}{letter}{signs[i % 6]}" for i, letter in enumerate(letters)] + [f"{x}{s}" for x in letters if ord(x) < 0x2500 for s in signs]
    for at in range(0, len(words), 2000):
        text = " ".join(words[at : at + 2000])
        assert word_ids(known, text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_round_trip(spark):
    docs = documents(spark).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    want = {r["doc_id"]: tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1] for r in docs.collect()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.packed(docs).collect():
        ids = list(struct.unpack(f"<{len(r['ids']) // 2}H", r["ids"]))
        assert r["length"] == len(ids) and r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)) and r["doc_tokens"] == len(want[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], ids))
        sequences[r["sequence_id"]].append((r["offset"], len(ids)))
    assert {d: [i for _, ids in sorted(p) for i in ids] for d, p in pieces.items()} == want
    for parts in sequences.values():
        ends = 0
        for offset, size in sorted(parts):
            assert offset == ends
            ends += size
    sizes = sorted(sum(n for _, n in p) for p in sequences.values())
    assert set(sizes[1:]) <= {2048} and sizes[0] <= 2048


def test_packing_odd_tables(spark):
    assert packing.packed(documents(spark).limit(0)).count() == 0
    assert packing.packed(documents(spark)).agg(F.countDistinct("sequence_id")).first()[0] > 1
    only = packing.packed(documents(spark, [None, ""])).collect()
    assert sorted((r["doc_id"], r["length"], r["sequence_id"]) for r in only) == [(0, 1, 0), (1, 1, 0)]


def many_sources(spark, sources: int, extra: list[tuple] = ()):
    """Documents of many sources of one size, source after source, and extra (source, documents) at the end."""
    names = [name for name, n in [*((f"host{s}", 6) for s in range(sources)), *extra] for _ in range(n)]
    made = [(i, prose(i % 40, 60), None, name, None, None, None, None, None, None, None) for i, name in enumerate(names)]
    return spark.createDataFrame(made, SCHEMA), dict(enumerate(names))


@pytest.mark.parametrize("extra", [[], [("main", 4000), ("tiny", 1)]])
def test_small_sources_share_by_their_sizes(spark, monkeypatch, extra):
    """More sources than have queues of their own: each is served by its share all along, and no token is lost."""
    monkeypatch.setattr(packing, "TURN", 64)
    docs, source_of = many_sources(spark, 300, extra)
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    ids_of = {t: tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in {prose(i, 60) for i in range(40)}}
    pieces, where, served = defaultdict(list), set(), defaultdict(list)
    for r in packing.packed(docs).collect():
        ids = list(struct.unpack(f"<{len(r['ids']) // 2}H", r["ids"]))
        assert r["length"] == len(ids) and r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        pieces[r["doc_id"]].append((r["start"], ids))
        places = range(r["sequence_id"] * 2048 + r["offset"], r["sequence_id"] * 2048 + r["offset"] + len(ids))
        assert where.isdisjoint(places)
        where.update(places)
        served[source_of[r["doc_id"]]] += places
    want = {r["doc_id"]: ids_of[r["text"]] for r in docs.collect()}
    assert {d: [i for _, ids in sorted(p) for i in ids] for d, p in pieces.items()} == want
    total = sum(map(len, want.values()))
    assert where == set(range(total))
    for share in (0.25, 0.5, 0.75):
        got = {s: sum(p < share * total for p in places) for s, places in served.items()}
        # a turn, and what the shared queue's own turns have run ahead or behind
        assert all(abs(got[s] - share * len(served[s])) <= 64 + 0.05 * len(served[s]) + 2 for s in served)
    hosts = [s for s in served if s.startswith("host")]
    first = {s for s in hosts if min(served[s]) < total / 8}
    assert len(first) > len(hosts) / 2


def test_turns_fill_a_queue(spark, monkeypatch):
    """Turns of sources of all sizes lie end to end, also over slices."""
    monkeypatch.setattr(packing, "SLICE", 16)
    sizes = {f"s{i}": n for i, n in enumerate([1, 2, 255, 256, 257, 5000, 100, 9999, *[300] * 50])}
    order = packing.turns(spark.createDataFrame(list(sizes.items()), "source_key string, tokens long")).collect()
    at = 0
    for r in sorted(order, key=lambda r: r["place"]):
        assert r["place"] == at
        at += min(256, sizes[r["source_key"]] - 256 * r["turn"])
    assert at == sum(sizes.values())


def least_capacity(sizes: list[int], shards: int) -> int:
    best = {0: 0}
    for _ in range(shards):
        new = {}
        for start, worst in best.items():
            total = 0
            for end in range(start, len(sizes) + 1):
                new[end] = min(new.get(end, 1 << 60), max(worst, total))
                total += sizes[end] if end < len(sizes) else 0
        best = new
    return best[len(sizes)]


@pytest.mark.parametrize("seed", range(3))
def test_cuts_are_the_best(spark, seed):
    made = random.Random(seed)
    groups = [(made.randrange(-(1 << 63), 1 << 63), made.choice([1, 5, 9, 200 if seed == 1 else 12])) for _ in range(120)]
    groups += [(groups[0][0] + i + 1, 7) for i in range(30)]  # a crowded part of the line
    groups = sorted(dict(groups).items())
    shards = 5
    cuts = sharding.minimax_cuts(spark.createDataFrame(groups, "place long, size long"), shards)
    sizes = Counter()
    for place, size in groups:
        sizes[sum(place >= c for c in cuts)] += size
    assert max(sizes.values()) == least_capacity([s for _, s in groups], shards)


def test_shards_of_odd_rows(spark):
    docs = documents(spark)
    out = sharding.shard_documents(docs, 6).collect()
    assert len(out) == docs.count()
    slots, shard_of = defaultdict(list), {}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    for r in out:
        slots[r["shard"]].append(r["slot"])
        if r["doc_id"] is not None:
            data = (texts[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
            assert shard_of.setdefault(texts[r["doc_id"]], r["shard"]) == r["shard"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(6))
    assert sharding.shard_documents(docs.limit(0)).count() == 0
    one = sharding.shard_documents(documents(spark, ["same"] * 50), 4).collect()
    assert len({r["shard"] for r in one}) == 1 and sorted(r["slot"] for r in one) == list(range(50))
