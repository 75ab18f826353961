"""The archive byte for byte, the repair against all edits of small conversations, the search against all scores."""

import hashlib
import heapq
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from shardstream.llm import lexical, turns, warc
from tables import documents, prose

PAGES = "page_id long, url string, html string, header string, payload binary, digest string, row long, size int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", b"y", "z", 7, 8) for r in rows], PAGES)


def odd_pages():
    same = "<p>" + "same " * 40
    rows = [(i, f"http://a/{i}", same) for i in (9, 3, 5, 3)]
    rows += [(None, "http://none", same), (None, None, "<i>only without an id</i>" * 5), (None, None, "<i>only without an id</i>" * 5)]
    rows += [(20, None, None), (21, "http://b", ""), (22, "http://c\r\nWARC-Type: revisit", "x" * 99), (23, "", "x" * 99), (24, "u", "é" * 50), (25, "u", "é" * 50)]
    return rows + [(30, "http://long", prose(1, 30_000)), (31, "http://lines", "a\r\n\r\nWARC/1.1\r\nWARC-Type: revisit\r\n" * 9), (32, "http://zero", "\x00" * 120)]


def test_archive_keeps_every_record(spark, tmp_path):
    rows = odd_pages()
    warc.write_archive(pages(spark, rows), str(tmp_path / "a"))
    held = spark.read.parquet(str(tmp_path / "a" / "payloads"))
    assert held.count() == held.select("payload").distinct().count() == len({(h or "") for *_, h in rows})
    got = warc.read_archive(spark, str(tmp_path / "a"))
    found = got.withColumns({"stored": warc.record_bytes(), "original": warc.original_bytes()}).collect()
    assert Counter((r["page_id"], bytes(r["payload"])) for r in found) == Counter((p, (h or "").encode()) for p, _, h in rows)
    groups = defaultdict(list)
    for r in found:
        payload = bytes(r["payload"])
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())
        header, block = bytes(r["stored"]).split(b"\r\n\r\n", 1)
        assert header.startswith(b"WARC/1.1\r\nWARC-Type: " + r["record_type"].encode() + b"\r\n")
        length = int(re.search(rb"\r\nContent-Length: (\d+)", header).group(1))
        assert block == (payload if r["record_type"] == "response" else b"") + b"\r\n\r\n" and length == len(block) - 4
        assert bytes(r["original"]) == header + b"\r\n\r\n" + payload + b"\r\n\r\n"
        groups[payload].append(r)
    ids = {r["record_id"] for r in found}
    assert len(ids) == len(rows)
    for payload, members in groups.items():
        first = [r for r in members if r["record_type"] == "response"]
        if len(payload) < 100:
            assert len(first) == len(members)
            continue
        least = min((r["page_id"] for r in members if r["page_id"] is not None), default=None)
        assert [r["page_id"] for r in first] == [least]
        for r in members:
            assert r["refers_to"] == (least if r["record_type"] == "revisit" else None)
            refers = re.search(rb"WARC-Refers-To: (\S+)", bytes(r["header"]))
            assert (refers.group(1).decode() if refers else None) == (first[0]["record_id"] if r["record_type"] == "revisit" else None)
    assert {r["url"] for r in found if r["page_id"] == 22} == {"http://c%0D%0AWARC-Type: revisit"}


def test_archive_of_nothing(spark, tmp_path):
    warc.write_archive(pages(spark, odd_pages()).limit(0), str(tmp_path / "a"))
    assert warc.read_archive(spark, str(tmp_path / "a")).count() == 0


def test_damaged_archives_are_refused(spark, tmp_path):
    warc.write_archive(pages(spark, odd_pages()), str(tmp_path / "a"))
    headers, payloads = (spark.read.parquet(str(tmp_path / "a" / t)) for t in ("headers", "payloads"))
    changed = payloads.withColumn("payload", F.when(F.col("size") == 99, F.lit(b"y" * 99)).otherwise(F.col("payload")))
    for name, stored in (("changed", changed), ("missing", payloads.filter("size <> 99"))):
        headers.write.parquet(str(tmp_path / name / "headers"))
        stored.write.parquet(str(tmp_path / name / "payloads"))
        with pytest.raises(PySparkException, match="no sound payload"):
            warc.read_archive(spark, str(tmp_path / name)).select("payload_digest").collect()


def cheapest(symbols):
    """All edit sequences by cost, then audit: the least that ends in an accepted state."""
    heap, seen = [(0, "", 0, turns.START, ())], set()
    while heap:
        cost, audit, at, state, path = heapq.heappop(heap)
        if at == len(symbols) and state in turns.ACCEPTED:
            return cost, audit, [*path]
        if (at, state, audit) in seen:
            continue
        seen.add((at, state, audit))
        made = turns.NEXT[state]
        if audit[-2:] != "II":
            heapq.heappush(heap, (cost + 5, audit + "I", at, made, (*path, made)))
        if at == len(symbols):
            continue
        symbol = symbols[at]
        heapq.heappush(heap, (cost + 2, audit + "D", at + 1, state, (*path, -1)))
        if symbol == turns.GONE:
            continue
        cut, role = 5 * (symbol >= 4), symbol % 4
        heapq.heappush(heap, (cost + cut + 1, audit + "R", at + 1, made, (*path, made)))
        if (state, role) in ((0, 0), (0, 1), (1, 1), (2, 2), (3, 1)):
            heapq.heappush(heap, (cost + cut, audit + "K", at + 1, (1, 2, 3)[role], (*path, (1, 2, 3)[role])))


def test_repair_is_the_cheapest_and_least():
    made = random.Random(5)
    for trial in range(400):
        symbols = [made.choice(range(9) if trial % 2 else (0, 1, 1, 2, 8)) for _ in range(made.randint(0, 6))]
        runs = turns.runs_of([s for s in symbols], [int(s == turns.GONE) for s in symbols])
        assert [s for s, n in runs for _ in range(n)] == symbols
        cost, audit, path = cheapest(symbols)
        assert turns.unroll(runs, turns.end_costs(), turns.START, True)[:3] == (audit, path, cost)
        cut, after = made.randint(0, len(symbols)), turns.end_costs()
        parts = [turns.runs_of(part, [int(s == turns.GONE) for s in part]) for part in (symbols[:cut], symbols[cut:])]
        for symbol, count in reversed(parts[1]):
            after = turns.run_costs(symbol, count, after)
        first = turns.unroll(parts[0], after, turns.START, False)
        second = turns.unroll(parts[1], turns.end_costs(), first[3], True)
        assert (first[0] + second[0], first[1] + second[1], first[2] + second[2]) == (audit, path, cost)


@pytest.mark.parametrize("count", [1, 2, 7, 1000, 5000])
def test_powers_of_runs(count):
    for symbol in range(9):
        stepped, whole = turns.end_costs(), turns.power(symbol, 0)
        for _ in range(count):
            stepped = turns.product(turns.power(symbol, 0), stepped)
        for _ in range(min(count, 7) - 1):
            whole = turns.product(whole, turns.power(symbol, 0))
        assert (turns.run_costs(symbol, count, turns.end_costs()) == stepped).all()
        assert count > 7 or (turns.run_transition(symbol, count) == whole).all()
        rows = list(turns._row_costs(symbol, count, turns.end_costs()))
        assert len(rows) == count and (rows[-1] == turns.end_costs()).all() and (turns.product(turns.power(symbol, 0), rows[0]) == stepped).all()


CONVERSATIONS = "conv_id long, turn long, role string, text string, piece long, said string, audit string, cost int"


def odd_conversations():
    made = random.Random(8)
    texts = ["Yes.", "Why?", "no end", " \n", "", "Ünder.", "中文", "tail. \t", None]
    rows = [(c, t, made.choice(["user", "assistant", "system", "user", "assistant", "tool", "User", "", None]), made.choice(texts)) for c in range(40) for t in range(made.randint(0, 9))]
    rows += [(None, t % 7 or None, made.choice(["user", "assistant"]), f"turn {t % 50}.") for t in range(60)]
    rows += [(100, t, ("user", "assistant")[t % 2 ^ (t % 11 == 0)], f"{'many words ' * 20}{t % 900}" + "." * (t % 5 > 0)) for t in range(2000)]
    rows += [(101, 1, "user", "same.")] * 40 + [(101, 2, "user", "same.")] * 3 + [(101, None, "user", "same.")]
    rows += [(102, -(2**63), "user", "far."), (102, 2**63 - 1, "assistant", "apart.")]
    rows += [(103, 2**60, "user", "a."), (103, 2**60 + 1, "assistant", "b."), (103, None, "assistant", "c.")]
    rows += [(104, 5, "user", prose(3, 20_000)), (104, 6, "assistant", prose(4, 60))]
    return rows


def brute_repairs(rows):
    conversations, out = defaultdict(list), {}
    for conv, turn, role, text, copies in rows:
        conversations[conv] += [(turn, " " if role is None else role, " " if text is None else text)] * copies
    for conv, lines in conversations.items():
        lines.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        known = [t for t, _, _ in lines if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        seen, symbols, counts = set(), [], Counter()
        for _, role, text in lines:
            words = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None
            seen.add((role, text))
            counts[fault] += 1
            symbols.append(8 if fault in ("blank", "duplicate") else {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + 4 * (fault == "truncated"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(lines, lines[1:]))
        runs = turns.runs_of(symbols, [int(s == 8) for s in symbols])
        audit, path, cost, _ = turns.unroll(runs, turns.end_costs(), turns.START, True)
        if len(symbols) <= 8:
            assert (cost, audit, path) == cheapest(symbols)
        kept, at = [], 0
        for edit, state in zip(audit, path):
            name = {2: "user", 3: "assistant"}.get(state)
            if edit == "I":
                kept.append(f"{name}:")
                continue
            kept += [f"{lines[at][1] if edit == 'K' else name}:{lines[at][2]}"] * (edit != "D")
            at += 1
        out[conv] = (gaps if gaps < 2**63 else None, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, kept)
    return out


@pytest.mark.parametrize("piece_bytes", [turns.PIECE_BYTES, 3000])
def test_repairs_of_odd_conversations(spark, piece_bytes):
    rows = odd_conversations()
    table = spark.createDataFrame([(*r, 4, "x", "y", 5) for r in rows], CONVERSATIONS).repartition(7)
    want = brute_repairs([(*r, 1) for r in rows])
    got = {r["conv_id"]: tuple(r)[1:] for r in turns.repair(table, piece_bytes).collect()}
    assert got == {c: (*w[:-1], hashlib.sha256("\n".join(w[-1]).encode()).hexdigest()) for c, w in want.items()}
    left = defaultdict(list)
    for r in turns.repaired_rows(table, piece_bytes).orderBy("conv_id", "part", "piece", "place").collect():
        left[r["conv_id"]].append((r["edit"], f"{r['role']}:{r['text']}"))
    assert {c: [t for _, t in kept] for c, kept in left.items()} == {c: w[-1] for c, w in want.items() if w[-1]}
    assert {c: "".join(e for e, _ in kept) for c, kept in left.items()} == {c: w[6].replace("D", "") for c, w in want.items() if w[-1]}


def test_repair_after_damage(spark):
    rows = [r for r in odd_conversations() if r[0] != 100] + [(500, 17, "user", "x."), (501, None, "user", "x.")]
    import zlib

    hurt = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        hurt.append((conv, turn, "user" if kind == 4 else role, text, 0 if kind == 0 else 2 if kind == 3 else 1))
    want = {c: (*w[:-1], hashlib.sha256("\n".join(w[-1]).encode()).hexdigest()) for c, w in brute_repairs(hurt).items()}
    table = spark.createDataFrame([(*r, 4, "x", "y", 5) for r in rows], CONVERSATIONS)
    assert {r["conv_id"]: tuple(r)[1:] for r in turns.repair(turns.damaged(table)).collect()} == want
    assert turns.repair(table.limit(0)).count() == turns.repair(turns.damaged(table.limit(0))).count() == turns.repaired_rows(table.limit(0)).count() == 0


def test_a_conversation_that_is_lost(spark):
    lost = spark.createDataFrame([(1, 1, "user", "a.", 0), (2, 1, "user", "a.", 1)], "conv_id long, turn long, role string, text string, copies int")
    got = {r["conv_id"]: tuple(r)[1:] for r in turns.repair(lost).collect()}
    assert got[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and got[2][5:7] == (2, "D")


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute_search(docs, items, k):
    counted = [(doc, Counter(terms(text))) for doc, text in docs]
    counted = [(doc, c, sum(c.values())) for doc, c in counted if c]
    whole = sum(n for *_, n in counted)
    holding = Counter(t for _, c, _ in counted for t in c)
    out = Counter()
    for item, text in set(items):
        scores = []
        for doc, c, n in counted:
            m = 25 + (75 * n * len(counted)) // whole
            score = sum(
                math.floor(1000 * math.log((2 * len(counted) + 2) / (2 * holding[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c
            )
            scores += [(-score, doc is None, doc or 0)] * (score > 0)
        for rank, (score, without, doc) in enumerate(sorted(scores)[:k], 1):
            out[item, rank, None if without else doc, -score] += 1
    return out


def test_search_of_odd_tables(spark, monkeypatch):
    docs = documents(spark).unionByName(documents(spark, [prose(i, 5 + i % 60, 90) for i in range(300)] + ["alpha beta"] * 400).withColumn("doc_id", F.col("doc_id") + 100))
    texts = [prose(i, 12, 90) for i in range(20)] + ["alpha alpha gamma", "beta", None, "", " ,. ", "Ünder 中文 é́ K", prose(3, 40), "unknown"]
    items = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(4, texts[4]), (4, "alpha"), (5, None)]
    asked = spark.createDataFrame([(i, t, 3, 4, 5) for i, t in items], "item_id long, text string, score long, n int, item_no int")
    want = brute_search([(r["doc_id"], r["text"]) for r in docs.collect()], items, 7)

    def got(**how):
        return Counter(tuple(r) for r in lexical.search(docs, asked, 7, **how).collect())

    assert got() == want
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 16)
    monkeypatch.setattr(lexical, "CHUNK_BYTES", 50)
    assert got(slice_bytes=400) == want


def test_search_of_nothing(spark):
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    docs = documents(spark)
    for a, b in ((docs.limit(0), items), (docs, items.limit(0)), (documents(spark, [None, "", " "]), items)):
        out = lexical.search(a, b)
        assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]
