"""Mixture-controlled packing: deficit round-robin over source queues fills every window to target token proportions."""

from __future__ import annotations

import unicodedata
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, small_result
from .words import give_back, pass_over, runs_of_bytes, text_bytes

SEQUENCE = 2048
END = 1
# Windows whose deficits are worked out one after another; blocks of them are independent of each other.
BLOCK_WINDOWS = 256
# Sources with at least 1/QUEUES of all tokens have queues of their own, so there are at most QUEUES of them; the others take turns in one.
QUEUES = 256
# Tokens of a turn, and turns whose places one task adds up.
TURN, SLICE = 256, 1 << 16
# Words whose ids a process remembers, in each of two generations, and runs of closing punctuation.
MEMO_WORDS, MEMO_TAILS = 1 << 18, 1 << 12
# Bytes of texts whose words are told apart at once.
RUN_BYTES = 4 << 20
# Bytes of ids that are cut into pieces at once.
CUT_BYTES = 1 << 20


class Schedule:
    """Which token of which queue goes where, for queues of given lengths; a pure function of these lengths.

    In the long run a queue gets its share of all tokens. At the edges of blocks of BLOCK_WINDOWS windows the
    amounts served are the shares, rounded so that they add up; what rounding owes is carried to the
    next block. Inside a block each queue's deficit grows by its share of a window; whole tokens of it are
    served, and what is left of the window goes to the largest deficits. So every window holds the
    target proportions to within a token or two of each queue, and any task can find any window.
    """

    def __init__(self, lengths: list[int], sequence: int = SEQUENCE, windows: int = BLOCK_WINDOWS):
        self.lengths, self.sequence, self.size, self.total = lengths, sequence, sequence * windows, sum(lengths)
        self.below = [sum(lengths[:q]) for q in range(len(lengths) + 1)]
        self.block = lru_cache(64)(self._block)

    def __reduce__(self):
        return Schedule, (self.lengths, self.sequence, self.size // self.sequence)

    def served(self, queue: int, block: int) -> int:
        """Tokens of the queue that blocks before this one hold."""
        done = min(block * self.size, self.total)
        return self.below[queue + 1] * done // self.total - self.below[queue] * done // self.total

    def _block(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens served in the block before each window, by window and queue; and where a queue's part begins in a window."""
        first = [self.served(q, block) for q in range(len(self.lengths))]
        due = np.array([self.served(q, block + 1) - a for q, a in enumerate(first)], np.int64)
        full = int(due.sum())
        windows = -(-full // self.sequence)
        takes, left, deficit = np.zeros((windows, len(due)), np.int64), due.copy(), np.zeros(len(due))
        for w in range(windows):
            room = min(self.sequence, full - w * self.sequence)
            deficit += due * (room / full)
            take = np.clip(np.floor(deficit + 1e-9).astype(np.int64), 0, left)
            while (over := int(take.sum()) - room) > 0:
                worst = np.argsort(deficit - take, kind="stable")[:over]
                take[worst] -= take[worst] > 0
            while (rest := room - int(take.sum())) > 0:
                able = np.flatnonzero(left > take)
                take[able[np.argsort(take[able] - deficit[able], kind="stable")[:rest]]] += 1
            takes[w], left, deficit = take, left - take, deficit - take
        before = np.vstack([np.zeros(len(due), np.int64), np.cumsum(takes, 0)])
        return before, np.cumsum(takes, 1) - takes

    def pieces(self, queue: int, start: int, length: int) -> list[tuple[int, int, int, int]]:
        """(sequence, offset in it, start in the document, length) of a document that begins at token ``start`` of its queue."""
        out, at, end = [], start, start + length
        block = at * self.total // (self.lengths[queue] * self.size) if length else 0
        while block and self.served(queue, block) > at:
            block -= 1
        while at < end:
            while self.served(queue, block + 1) <= at:
                block += 1
            first = self.served(queue, block)
            before, offsets = self.block(block)
            w = int(np.searchsorted(before[:, queue], at - first, "right")) - 1
            stops, begins = before[:, queue].tolist(), offsets[:, queue].tolist()
            while at < end and w < len(begins):
                stop = min(end, first + stops[w + 1])
                if stop > at:
                    out.append((block * (self.size // self.sequence) + w, begins[w] + at - first - stops[w], at - start, stop - at))
                    at = stop
                w += 1
            block += 1
        return out


class Vocabulary:
    """The tokenizer, and the ids of the words between white space that were met so far; one for each Python process of a worker.

    The vocabulary drops white space and no token crosses it, so a text's ids are those of its words in order. Ids are
    little-endian 16-bit bytes. Words are remembered in two generations: when the younger is full it becomes the older, and words
    that are met again move on to the younger, so that common words stay and memory is bounded.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        # the same vocabulary for words that are already what its normalizer and its pattern would make of them
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.ends_word = np.zeros(self.whole.get_vocab_size(), bool)
        for token, number in self.whole.get_vocab().items():
            self.ends_word[number] = token.endswith(WORD_END)
        self.ids: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.tails: dict[bytes, bytes] = {b"": b""}
        give_back()  # loading frees as much as it keeps

    @staticmethod
    def of_process(path: str) -> "Vocabulary":
        """Kept in a module of its own, which outlives a task: the next task of the process need not learn all words again."""
        import sys
        import types

        kept = sys.modules.setdefault(PROCESS_MODULE, types.ModuleType(PROCESS_MODULE)).__dict__
        if path not in kept:
            kept[path] = Vocabulary(path)
        return kept[path]

    @staticmethod
    def forget() -> None:
        """Drop what the process keeps, once words are no longer looked up."""
        import sys

        sys.modules.pop(PROCESS_MODULE, None)

    def encoded(self, texts: pa.Array) -> list[bytes]:
        """The ids of texts. Words are told apart, and put together again, for all texts at once; only distinct words are looked up."""
        split = pc.ascii_split_whitespace(texts.cast(pa.string()))
        ends, coded = split.offsets.to_numpy(), split.flatten().dictionary_encode()
        laid = self.of_words(coded.dictionary).take(coded.indices)
        if not len(laid):
            return [b""] * len(texts)
        places, whole = np.frombuffer(laid.buffers()[1], np.int32)[: len(laid) + 1], memoryview(laid.buffers()[2] or b"")
        cuts = places[ends - ends[0]].tolist()
        return [bytes(whole[a:b]) for a, b in zip(cuts, cuts[1:])]

    def of_words(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words. Words of ASCII letters and digits are looked up in lower case, without closing punctuation."""
        cores = pc.ascii_rtrim(words, characters=TAIL.decode())
        simple = pc.ascii_is_alnum(cores)
        keys = pc.if_else(simple, pc.ascii_lower(cores), words).cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.learn(set(keys)).__getitem__, keys))
        tail_bytes = pc.if_else(simple, pc.subtract(pc.binary_length(words), pc.binary_length(cores)), 0)
        tails = pc.if_else(pc.equal(tail_bytes, 1), pc.utf8_slice_codeunits(words, -1), "").dictionary_encode()
        tail_ids = list(map(self._tail, tails.dictionary.cast(pa.binary()).to_pylist()))
        ids = [i + tail_ids[t] for i, t in zip(ids, tails.indices.to_numpy().tolist())]
        for at in np.flatnonzero(pc.greater(tail_bytes, 1).to_numpy(zero_copy_only=False)).tolist():
            ids[at] += self._tail(words[at].as_py()[len(keys[at]) :].encode())
        return pa.array(ids, pa.binary())

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The ids of words, of at least these."""
        if len(self.ids) > MEMO_WORDS:
            self.ids, self.older = {}, self.ids
        ids, older = self.ids, self.older
        new = []
        for word in words.difference(ids):
            known = older.get(word)
            if known is None:
                new.append(word)
            else:
                ids[word] = known
        plain, others = [], []
        for word in new:
            if word.isalpha():  # in lower case by now
                plain.append((word, word, b""))
                continue
            core, tail = plain_form(word)
            (plain if is_plain(core) else others).append((word, core, tail))
        for at in range(0, len(plain), GROUP):
            self._learn_plain(plain[at : at + GROUP])
        for at in range(0, len(others), GROUP):
            self._learn_others(others[at : at + GROUP])
        return ids

    def _tail(self, tail: bytes) -> bytes:
        if tail not in self.tails:
            if len(self.tails) > MEMO_TAILS:
                self.tails = {b"": b""}
            self.tails[tail] = np.array(self.whole.encode(tail.decode(), add_special_tokens=False).ids, "<u2").tobytes()
        return self.tails[tail]

    def _learn_plain(self, words: list[tuple[bytes, bytes, bytes]]) -> None:
        """Words that are one piece each: every token that ends a word ends one."""
        text = b" ".join([core for _, core, _ in words]).decode()
        found = np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2")
        self._keep(words, found.tobytes(), np.flatnonzero(self.ends_word[found]) + 1)

    def _learn_others(self, words: list[tuple[bytes, bytes, bytes]]) -> None:
        """Any words: each has the tokens that begin in it."""
        texts = [core.decode() for _, core, _ in words]
        found = self.whole.encode(" ".join(texts), add_special_tokens=False)
        ends = np.cumsum([len(t) + 1 for t in texts])
        starts = np.fromiter((a for a, _ in found.offsets), np.int64, len(found.ids))
        self._keep(words, np.array(found.ids, "<u2").tobytes(), np.searchsorted(starts, ends))

    def _keep(self, words: list[tuple[bytes, bytes, bytes]], found: bytes, cuts: np.ndarray) -> None:
        at = 0
        for (word, _, tail), cut in zip(words, (2 * cuts).tolist()):
            self.ids[word] = found[at:cut] + self._tail(tail) if tail else found[at:cut]
            at = cut


WORD_END = "</w>"
PROCESS_MODULE = "packing_vocabularies_of_this_process"
GROUP = 256
TAIL = b".,;:!?"


def plain_form(word: bytes) -> tuple[bytes, bytes]:
    """(core in lower case, closing punctuation) whose ids, put together, are those of the word.

    The vocabulary composes and lowers letters by itself, and parts letters and digits from other signs. So punctuation is parted only from
    what is a letter or digit still after that: some letters become a letter and a mark, which then joins the signs behind it. Words with
    combining marks are left alone, since marks join some letters in one case only, and so are special strings.
    """
    core = word.rstrip(TAIL)
    if core.isalnum():  # letters and digits of ASCII
        return core.lower(), word[len(core) :]
    if b"\xcc" in word or b"\xcd" in word or b"<|" in word or not core:
        return word, b""
    if len(core) == len(word):
        return word.lower(), b""
    last = core[-1:].decode() if core[-1] < 0x80 else unicodedata.normalize("NFC", core[-4:].decode(errors="ignore")[-1:]).lower()[-1:]
    return (core.lower(), word[len(core) :]) if last.isalnum() else (word.lower(), b"")


def is_plain(word: bytes) -> bool:
    """Whether a word is only lower-case Latin letters in composed form: one piece for the vocabulary, as it stands."""
    if word.isalpha():
        return word.islower()
    text = word.decode()
    return text.isalpha() and max(text) < "\u0250" and text == text.lower() and unicodedata.is_normalized("NFC", text)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenized(docs: DataFrame, path: str | None = None, source: str = "source") -> DataFrame:
    """Documents as token ids in a stored table: doc_id, source_key, n, ids, block, before.

    ids are 16-bit and end with END. ``block`` is the task that wrote the row, ``before`` the tokens of the same
    source earlier in that task: with the sums of blocks they give places in queues without a shuffle of texts.
    """
    vocabulary = path or vocabulary_path()

    def run(parts):
        known, seen, block = Vocabulary.of_process(vocabulary), defaultdict(int), TaskContext.get().partitionId()
        closing = np.array([END], "<u2").tobytes()
        for part in parts:
            for start, stop in runs_of_bytes(part["data"], RUN_BYTES):
                ids, counts, before, keys = [], [], [], part["source_key"][start:stop]
                for found, key in zip(known.encoded(part["data"][start:stop]), keys.to_pylist()):
                    ids.append(found + closing)
                    counts.append(len(ids[-1]) // 2)
                    before.append(seen[key])
                    seen[key] += counts[-1]
                yield {"doc_id": part["doc_id"][start:stop], "source_key": keys, "n": counts, "ids": ids, "block": [block] * len(ids), "before": before}

    key = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("-"))
    columns = {"doc_id": F.col("doc_id"), "data": text_bytes(), "source_key": key}
    return materialize(pass_over(docs, columns, "doc_id void, source_key string, n long, ids binary, block int, before long", run))


def turns(sources: DataFrame) -> DataFrame:
    """The order in which sources (source_key, tokens) share a queue: source_key, turn, place.

    A turn is the next TURN tokens of a source, or what is left of them; ``place`` is where it begins in the queue. A
    source's deficit grows by its share of what the queue serves, and its next turn comes when the deficit reaches
    a part of a turn that is the source's own (by hash, so that sources of one size do not come all at once). So
    deficits are carried over as many windows as it takes, and between the shares of the queue that
    two points mark, each source has its tokens of that share to within a turn. No source or turn is collected.
    """
    sources = sources.withColumn("luck", (F.xxhash64("source_key") % (1 << 30) / float(1 << 31)) + 0.5)
    # in two steps, over tasks: a source just too small for a queue of its own has a great many turns
    stretches = F.expr(f"sequence(0L, (tokens - 1) div {TURN * SLICE})")
    dealt = sources.select("source_key", "tokens", "luck", F.explode(stretches).alias("stretch")).repartition("source_key", "stretch")
    some = F.expr(f"sequence(stretch * {SLICE}, least((stretch + 1) * {SLICE} - 1, (tokens - 1) div {TURN}))")
    dealt = dealt.select("source_key", "tokens", "luck", F.explode(some).alias("turn"))
    size = F.least(F.lit(TURN), F.col("tokens") - F.col("turn") * TURN)
    due = (F.col("turn") * TURN + F.col("luck") * size) / F.col("tokens")
    slices = 1 + (sources.agg(F.sum(F.expr(f"(tokens - 1) div {TURN} + 1"))).first()[0] or 0) // SLICE
    dealt = dealt.select("source_key", "turn", size.alias("size"), due.alias("due"), F.floor(due * slices).alias("slice"))
    so_far = Window.rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("slice").agg(F.sum("size").alias("all"))  # one row a slice
    sums = sums.select("slice", F.coalesce(F.sum("all").over(so_far.orderBy("slice")), F.lit(0)).alias("base"))
    inside = F.sum("size").over(so_far.partitionBy("slice").orderBy("due", "source_key", "turn"))
    dealt = dealt.withColumn("inside", F.coalesce(inside, F.lit(0)))
    return dealt.join(sums, "slice").select("source_key", "turn", (F.col("base") + F.col("inside")).alias("place"))


def packed(docs: DataFrame, path: str | None = None, source: str = "source", sequence: int = SEQUENCE) -> DataFrame:
    """Pieces of documents in sequences of ``sequence`` tokens: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, queue, ids.

    The queues are the sources (a null source is a source of its own), their targets the sources' shares of all
    tokens. Sources too small for a queue (see QUEUES) take turns in one more (see :func:`turns`), each by its share. All sequences are full but the last, and every token lies in exactly one piece. Order in a
    queue is that of the table's parts. A null or empty text is the one token END; repeated rows are packed each; special
    strings in texts become what the vocabulary makes of them; an empty table gives no rows. A text of any length is encoded whole, in one
    task, its words as one Arrow array; other columns are not read. Tokens are written once; those of queues of their own meet the sums of (task,
    source), which are broadcast up to BROADCAST_ROWS rows and joined by a shuffle beyond that; those of small sources are shuffled once more, to
    their turns. The driver sees the sums of sources with queues of their own only.
    """
    spark = docs.sparkSession
    tokens = tokenized(docs, path, source)
    sums = materialize(tokens.groupBy("block", "source_key").agg(F.sum("n").alias("tokens")))
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    per_source = sums.groupBy("source_key").agg(F.sum("tokens").alias("tokens"))
    large = per_source.filter(F.col("tokens") * QUEUES >= total).orderBy("source_key").collect()  # at most QUEUES rows
    rest = total - sum(r["tokens"] for r in large)
    lengths, number = [r["tokens"] for r in large], {r["source_key"]: q for q, r in enumerate(large)}
    named = spark.createDataFrame([(k, q) for k, q in number.items()] or [("", 0)], "source_key string, queue int")
    earlier = Window.partitionBy("source_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("block", "source_key", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("first"))
    first = F.col("first") + F.col("before")
    own = tokens.join(small_result(starts.join(F.broadcast(named), "source_key")), ["block", "source_key"])
    placed = own.select("doc_id", "queue", first.alias("begin"), F.lit(0).cast("long").alias("skip"), F.col("n").alias("size"), "n", "ids")
    if rest:
        small = per_source.join(F.broadcast(named), "source_key", "left_anti")
        order = small_result(turns(small))
        parts = tokens.join(small_result(starts.join(F.broadcast(named), "source_key", "left_anti")), ["block", "source_key"])
        parts = parts.withColumn("first", first).withColumn("turn", F.explode(F.expr(f"sequence(first div {TURN}, (first + n - 1) div {TURN})")))
        parts = parts.withColumn("from", F.greatest("first", F.col("turn") * TURN))
        parts = parts.withColumn("size", F.least(F.col("first") + F.col("n"), (F.col("turn") + 1) * TURN) - F.col("from"))
        parts = parts.withColumn("skip", F.col("from") - F.col("first"))
        parts = parts.withColumn("ids", F.expr("substring(ids, CAST(2 * skip + 1 AS INT), CAST(2 * size AS INT))")).join(order, ["source_key", "turn"])
        begin = F.col("place") + F.col("from") - F.col("turn") * TURN
        placed = placed.unionByName(parts.select("doc_id", F.lit(len(lengths)).alias("queue"), begin.alias("begin"), "skip", "size", "n", "ids"))
        lengths.append(rest)
    plan = spark.sparkContext.broadcast(Schedule(lengths, sequence))

    def cut(part):
        rows, at, made = [], [], []
        columns = (part[c].to_pylist() for c in ("queue", "begin", "skip", "size", "n", "ids"))
        for i, (queue, begin, skip, size, n, ids) in enumerate(zip(*columns)):
            wide = memoryview(np.frombuffer(ids, "<u2").astype("<u4").tobytes())
            for sequence_id, offset, start, length in plan.value.pieces(queue, begin, size):
                at.append(i)
                rows.append((skip + start, length, zlib.crc32(wide[4 * start : 4 * (start + length)]), n, sequence_id, offset, queue))
                made.append(ids[2 * start : 2 * (start + length)])
        names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue")
        for lo in range(0, len(at), 50_000):
            numbers = np.array(rows[lo : lo + 50_000], np.int64).T
            out = dict(zip(names, (pa.array(c) for c in numbers)))
            out |= {"doc_id": part["doc_id"].take(pa.array(at[lo : lo + 50_000])), "ids": made[lo : lo + 50_000]}
            yield out

    def run(parts):
        Vocabulary.forget()
        for part in parts:
            for start, stop in runs_of_bytes(part["ids"], CUT_BYTES):
                yield from cut({name: column[start:stop] for name, column in part.items()})

    columns = {c: F.col(c) for c in ("doc_id", "queue", "begin", "skip", "size", "n", "ids")}
    schema = "doc_id void, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, queue int, ids binary"
    return pass_over(placed, columns, schema, run)
