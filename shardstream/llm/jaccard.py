"""N-gram Jaccard join: exact near copies by prefix filters under several global token orders, intersected before verification.

Large families of near copies are not compared with each other as whole sets: each class is compared once with a reference, the class
that looks most like the middle of its family, and then filtered by what sets it apart from the reference.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, small_result
from .words import WordHashes, map_batches, mixed, pass_over, shingle_set, small_batches, some_at_a_time, spaced_words, text_bytes

# Token orders that a candidate must share a prefix token under; the low bits of a posting's token say which.
ORDERS, ORDER_BITS = 2, 2
# Orders whose first tokens find references, how many a class must share with its own, and the least similarity in percent to be of its family.
FIRSTS, AGREE, FAMILY_PERCENT = 6, 2, 40
JUMPS = 3
# Families of this many classes get a reference nearer to their middle, and their differences an order by what is rare in the family.
LARGE_FAMILY = 8
# With more candidate pairs a class than this, so many of each class are compared before the others.
CROWDED = 3
# The tokens that all orders put last: the most frequent ones, of those that occur LOCAL times in a run of rows and FREQUENT times in all.
LOCAL, FREQUENT, FREQUENT_TOKENS = 2, 8, 1 << 18
# Bytes of text whose tokens a task looks at together.
RUN_BYTES = 4 << 20
# Pairs of a token's classes that a task holds at once.
MEET_PAIRS = 1 << 18
_SIEVE_BITS = 22
ORDER_SEED = 0xA24BAED4963EE407


@dataclass(frozen=True)
class Rule:
    """Two sets of k-word shingles link if 100 * common >= percent * union."""

    k: int = 4
    percent: int = 85

    def least_common(self, size: int) -> int:
        """What a set has in common with any partner at least."""
        return -(-self.percent * size // 100)

    def prefix(self, size: int) -> int:
        return size - self.least_common(size) + 1

    def most_apart(self, size: int, other: int) -> int:
        """The most tokens that linked sets of these sizes may not have in common."""
        return (100 - self.percent) * (size + other) // (100 + self.percent)

    def apart_prefixes(self, apart: int, size: int, reference: int) -> tuple[int, int]:
        """Prefix lengths of a set's difference (``apart`` tokens) from the reference of its family.

        Linked sets a and b differ in at most s tokens, so their differences have at least (apart_a + apart_b - s) / 2 in common. That is more
        than nothing unless both are linked to the reference. The first length finds partners that, like this set, are not
        linked to the reference; the second finds partners on the other side of that line. A partner's size is at
        least ``percent`` of this one's, at most its inverse; those not linked to the reference differ from it in more than most_apart.
        """
        s = (100 - self.percent) * size // self.percent
        far = self.most_apart(-(-self.percent * size // 100), reference) + 1
        linked = apart <= self.most_apart(size, reference)

        def length(least: int) -> int:
            return apart - max(1, -(-(apart + max(least, apart - s, 0) - s) // 2)) + 1

        return (0, length(far)) if linked else (length(far), length(0))


def order_keys(tokens: np.ndarray, order: int) -> np.ndarray:
    """Hashed ranks of tokens under one of the orders."""
    return mixed(tokens ^ np.uint64(ORDER_SEED * (2 * order + 1) % (1 << 64)))


def signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """Stored: a row per document (doc_id, cls, n, firsts) and, without cls, tokens that are frequent in a run of rows (token, seen).

    cls is a hash of the set, null for texts without words; firsts are the first tokens under FIRSTS orders.
    """

    def run(parts):
        memo = WordHashes()
        for part in parts:
            at = 0
            for (datas,) in some_at_a_time(part["data"], most=RUN_BYTES):
                yield from described(part["doc_id"][at : at + len(datas)], [shingle_set(spaced_words(d), rule.k, memo) for d in datas])
                at += len(datas)

    def described(ids, sets):
        classes = [set_hash(s) if len(s) else None for s in sets]
        firsts = [[int(order_keys(s, o).min().view(np.int64)) for o in range(FIRSTS)] if len(s) else None for s in sets]
        none = len(sets)
        yield {"doc_id": ids, "cls": classes, "n": list(map(len, sets)), "firsts": firsts, "token": pa.nulls(none, pa.int64()), "seen": pa.nulls(none, pa.int64())}
        different = {c: s for c, s in zip(classes, sets) if c is not None}
        tokens, seen = np.unique(np.concatenate([np.empty(0, np.uint64), *different.values()]), return_counts=True)
        often = seen >= LOCAL
        tokens, seen = tokens[often].view(np.int64), seen[often]
        empty = {"doc_id": pa.nulls(len(tokens)), "cls": pa.nulls(len(tokens)), "n": pa.nulls(len(tokens)), "firsts": pa.nulls(len(tokens))}
        yield empty | {"token": pa.array(tokens), "seen": pa.array(seen)}

    columns = {"doc_id": F.col("doc_id"), "data": text_bytes()}
    return materialize(pass_over(docs, columns, "doc_id void, cls long, n long, firsts array<long>, token long, seen long", run))


def set_hash(tokens: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


class TokenOrder:
    """Global orders of tokens: rarer levels first, hashed ranks within a level. Any order finds the same links."""

    def __init__(self, tokens: list[int], seen: list[int]):
        array = np.array(tokens, np.int64).view(np.uint64)
        by_token = np.argsort(array)
        self.tokens = array[by_token]
        self.levels = (np.log2(np.array(seen, np.float64)[by_token] / FREQUENT).astype(np.uint64) + np.uint64(1)) if len(tokens) else np.empty(0, np.uint64)

        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[self.tokens >> np.uint64(64 - _SIEVE_BITS)] = True

    def __reduce__(self):
        return _restored, (self.tokens.tobytes(), self.levels.tobytes())

    def ranked(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and leading rank bits of those tokens that are frequent."""
        maybe = np.flatnonzero(self.sieve[tokens >> np.uint64(64 - _SIEVE_BITS)])
        if not len(maybe):
            return maybe, np.empty(0, np.uint64)
        at = np.minimum(np.searchsorted(self.tokens, tokens[maybe]), len(self.tokens) - 1)
        same = self.tokens[at] == tokens[maybe]
        return maybe[same], np.minimum(self.levels[at[same]], np.uint64(63)) << np.uint64(58)

    def prefixes(self, tokens: np.ndarray, length: int) -> list[np.ndarray]:
        """The first ``length`` tokens under each order, in that order."""
        places, levels = self.ranked(tokens)
        out = []
        for order in range(ORDERS):
            keys = order_keys(tokens, order) >> np.uint64(6)
            keys[places] |= levels
            first = np.argpartition(keys, length - 1)[:length] if length < len(tokens) else np.arange(len(tokens))
            out.append(tokens[first[np.argsort(keys[first])]])
        return out

    def ordered(self, *groups: np.ndarray) -> list[np.ndarray]:
        """Tokens in their whole order under each order, one group behind the other."""
        out = []
        for order in range(ORDERS):
            parts = []
            for tokens in groups:
                keys = order_keys(tokens, order) >> np.uint64(6)
                if len(tokens):
                    places, levels = self.ranked(tokens)
                    keys[places] |= levels
                parts.append(tokens[np.argsort(keys)])
            out.append(np.concatenate(parts))
        return out


def _restored(tokens: bytes, levels: bytes) -> TokenOrder:
    """An order from its stored arrays, on another machine."""
    made = TokenOrder([], [])
    made.tokens, made.levels = np.frombuffer(tokens, np.uint64), np.frombuffer(levels, np.uint64)
    made.sieve[made.tokens >> np.uint64(64 - _SIEVE_BITS)] = True
    return made


def texts_of(docs: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """A text of each of some classes (cls, rep): cls, data. Rows that only share an id with the class are told apart by the reader, who makes the set."""
    known = small_result(wanted.filter("rep IS NOT NULL").select("cls", "rep"))
    rows = docs.select("doc_id", text_bytes().alias("data")).join(known, F.col("doc_id") == F.col("rep")).select("cls", "data")
    lost = wanted.filter("rep IS NULL").select("cls")
    return rows.unionByName(texts_without_id(docs, rule).join(small_result(lost), "cls"))


def texts_without_id(docs: DataFrame, rule: Rule) -> DataFrame:
    """A text of each class among the rows without an id."""

    def run(parts):
        memo = WordHashes()
        for part in parts:
            for (datas,) in some_at_a_time(part["data"]):
                sets = [shingle_set(spaced_words(d), rule.k, memo) for d in datas]
                yield {"cls": [set_hash(s) if len(s) else None for s in sets], "data": datas}

    made = pass_over(docs.filter("doc_id IS NULL"), {"data": text_bytes()}, "cls long, data binary", run)
    return made.filter("cls IS NOT NULL").dropDuplicates(["cls"])


def verified(docs: DataFrame, pairs: DataFrame, reps: DataFrame, rule: Rule, of_family: bool = False) -> DataFrame:
    """Pairs (a, b) of classes with the sizes and the common part of their sets: a, b, size_a, size_b, common, diff.

    Only texts of classes in a pair are read again, and travel as texts, which take half the room of their sets. Each goes to its
    pairs by a join, which Spark splits where a class has many partners; a pair may come more than once if rows are the same. With ``of_family``, b is the reference of a's
    family, and ``diff`` are the tokens that only one of both has, or null if a is too unlike b to be of its family.
    """
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    rows = texts_of(docs, reps.join(wanted, "cls"), rule)
    left = rows.select(F.col("cls").alias("a"), F.col("data").alias("data_a"))
    right = rows.select(F.col("cls").alias("b"), F.col("data").alias("data_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")

    def compare(parts):
        memo, last = WordHashes(), (None, None)
        for part in parts:
            for datas, others, a, b in some_at_a_time(part["data_a"], part["data_b"], part["a"], part["b"]):
                out = {c: [] for c in ("a", "b", "size_a", "size_b", "common", "diff")}
                for data, other, cls_a, cls_b in zip(datas, others, a, b):
                    one = shingle_set(spaced_words(data), rule.k, memo)
                    two = last[1] if last[0] == other else shingle_set(spaced_words(other), rule.k, memo)
                    last = (other, two)
                    if len(one) and len(two) and set_hash(one) == cls_a and set_hash(two) == cls_b:  # ids may be those of several texts
                        common = len(np.intersect1d(one, two, assume_unique=True))
                        diff = np.setxor1d(one, two, assume_unique=True).view(np.int64) if of_family and is_family(one, two, common) else None
                        for name, value in zip(out, (cls_a, cls_b, len(one), len(two), common, diff)):
                            out[name].append(value)
                yield out

    schema = "a long, b long, size_a long, size_b long, common long, diff array<long>"
    return pass_over(both, {c: F.col(c) for c in ("a", "b", "data_a", "data_b")}, schema, compare)


# Sides of a token list on which sets stand that are linked to the reference of their family, and that are not.
LINKED_SIDE, OTHER_SIDE = 1, 2


def is_family(one: np.ndarray, reference: np.ndarray, common: int) -> bool:
    return 100 * common >= FAMILY_PERCENT * (len(one) + len(reference) - common)


def marks_of(one: np.ndarray, reference: np.ndarray, common: int, family: int, order: TokenOrder, rule: Rule) -> list[dict] | None:
    """The marks of a set (see :func:`family_marks`), its difference under a global order; None if it is not of the reference's family."""
    if not is_family(one, reference, common):
        return None
    added, lacking = np.setdiff1d(one, reference, assume_unique=True), np.setdiff1d(reference, one, assume_unique=True)
    made = family_marks(order.ordered(added, lacking), len(one), len(reference), family, rule)
    return [dict(zip(made, row)) for row in zip(*made.values())]


def family_marks(ordered: list[np.ndarray], n: int, reference: int, family: int, rule: Rule) -> dict[str, list]:
    """Prefix tokens of the difference between a set of ``n`` tokens and its family's reference: token, side, behind, apart, n.

    The difference comes in each order. Tokens are hashed with the family. Sets that are not linked to the reference meet each other
    by some of them (``side`` is None: all pairs), and those that are linked to it by others (only pairs of different sides).
    """
    apart = len(ordered[0])
    common = (n + reference - apart) // 2
    with_others, across = rule.apart_prefixes(apart, n, reference)
    side = LINKED_SIDE if 100 * common >= rule.percent * (n + reference - common) else OTHER_SIDE
    out = {c: [] for c in ("token", "side", "behind", "apart", "n")}
    for o, tokens in enumerate(ordered):
        for length, salt, on in ((with_others, 1, None), (across, 2, side)):
            hashed = mixed(tokens[:length] ^ mixed(np.array([family, salt], np.int64).view(np.uint64)).sum(dtype=np.uint64))
            made = posting(hashed, o).view(np.int64).tolist()
            for name, values in zip(out, (made, [on] * len(made), range(apart - 1, apart - 1 - len(made), -1), [apart] * len(made), [n] * len(made))):
                out[name].extend(values)
    return out


def of_large(members: DataFrame) -> DataFrame:
    """References of families with at least LARGE_FAMILY other classes: b, members."""
    return small_result(members.groupBy("b").agg(F.count("*").alias("members")).filter(F.col("members") >= LARGE_FAMILY))


def recentred(members: DataFrame) -> DataFrame:
    """Members of families (a, b, size_a, size_b, diff), those of large families with the class as reference b that is nearest to the middle.

    The middle of a family is the set of all tokens that most of its classes have. It differs from the reference in those tokens that
    are in most differences, and from another class in those that are in just one of these and the class's own difference. Differences
    from the new reference follow from those from the old one, no text is read again.
    """
    tokens = members.join(of_large(members), "b").select("a", "b", "members", F.size("diff").alias("apart"), F.explode("diff").alias("token"))
    usual = tokens.groupBy("b", "token").agg(F.count("*").alias("seen"), F.first("members").alias("members")).filter("2 * seen > members")
    usual = small_result(usual.select("b", "token", F.lit(1).alias("usual")))
    off = tokens.join(usual, ["b", "token"], "left").groupBy("a", "b").agg((F.first("apart") - 2 * F.count("usual")).alias("off"))
    nearest = off.groupBy("b").agg(F.min(F.struct("off", "a")).alias("best")).filter("best.off < 0").select("b", F.col("best.a").alias("a"))
    moved = small_result(members.join(F.broadcast(nearest), ["a", "b"]).select("b", F.col("a").alias("to"), F.col("size_a").alias("size_to"), F.col("diff").alias("step")))
    stay = F.col("to").isNull()
    between = F.array_union(F.array_except("diff", "step"), F.array_except("step", "diff"))
    near = members.join(moved, "b", "left").filter(stay | (F.col("a") != F.col("to")))
    near = near.select("a", F.coalesce("to", "b").alias("b"), "size_a", F.coalesce("size_to", "size_b").alias("size_b"), F.when(stay, F.col("diff")).otherwise(between).alias("diff"))
    sizes = members.groupBy("b").agg(F.first("size_b").alias("size_b"))
    before = moved.join(sizes, "b").select(F.col("b").alias("a"), F.col("to").alias("b"), F.col("size_b").alias("size_a"), F.col("size_to").alias("size_b"), F.col("step").alias("diff"))
    return near.unionByName(before)


def marked(members: DataFrame, rule: Rule) -> DataFrame:
    """The marks of members of families (a, b, size_a, size_b, diff): token, side, cls, behind, apart, n.

    Rarer tokens come first: in large families by the number of differences that hold a token, where a shared one sets no class apart.
    """
    tokens = members.join(of_large(members), "b").select("a", "b", F.explode("diff").alias("token"))
    seen = small_result(tokens.groupBy("b", "token").agg(F.count("*").alias("seen")).filter("seen > 1"))
    often = tokens.join(seen, ["b", "token"]).groupBy("a", "b").agg(F.collect_list(F.struct("token", "seen")).alias("often"))
    rows = members.join(often.select(F.col("a").alias("of"), "often"), F.col("a") == F.col("of"), "left")
    rows = rows.select("a", "b", "size_a", "size_b", "diff", F.col("often.token").alias("shared"), F.col("often.seen").alias("seen"))

    def run(parts):
        for part in parts:
            for at in range(len(part["a"])):
                diff = part["diff"][at].values.to_numpy().view(np.uint64)
                rank = np.zeros(len(diff), np.int64)
                if part["shared"][at].is_valid:
                    shared, by = part["shared"][at].values.to_numpy().view(np.uint64), np.argsort(diff)
                    rank[by[np.searchsorted(diff, shared, sorter=by)]] = part["seen"][at].values.to_numpy()
                ordered = [diff[np.lexsort((order_keys(diff, o), rank))] for o in range(ORDERS)]
                cls, family, n, reference = (part[c][at].as_py() for c in ("a", "b", "size_a", "size_b"))
                made = family_marks(ordered, n, reference, family, rule)
                yield made | {"cls": [cls] * len(made["token"])}

    return pass_over(rows, {c: F.col(c) for c in rows.columns}, "token long, side long, cls long, behind long, apart long, n long", run)


def within_reach(rule: Rule, behind_a, behind_b, apart_a, apart_b, n_a, n_b):
    """Whether a shared token may be the first of a link: it and what stands behind it in both lists are as many as these have in common.

    The lists are differences from the reference of a family, or whole sets, which are their differences from nothing.
    """
    least = np.maximum((apart_a + apart_b - rule.most_apart(n_a, n_b) + 1) // 2, 1)
    return 1 + np.minimum(behind_a, behind_b) >= least


def posting(tokens: np.ndarray, order: int) -> np.ndarray:
    return (tokens & ~np.uint64((1 << ORDER_BITS) - 1)) | np.uint64(order)


def linked(rule: Rule):
    return 100 * F.col("common") >= rule.percent * (F.col("size_a") + F.col("size_b") - F.col("common"))


def references(reps: DataFrame) -> DataFrame:
    """For each class that looks like others the reference of its family: a, b.

    Classes that share a first token under an order are a group, and its leader the class whose own groups are the largest taken together. A
    class follows the leader that most of its groups have; followed to its end, a few steps at most, that leads
    a family to one class. The reference is then the class of the family with most of its usual first tokens: it stands near
    the middle. Whoever shares fewer than AGREE first tokens with it has none.
    """
    firsts = reps.select("cls", F.posexplode("firsts").alias("order", "token"))
    sizes = firsts.groupBy("order", "token").agg(F.count("*").alias("n")).filter("n > 1")
    grouped = materialize(firsts.join(sizes, ["order", "token"]))
    popular = grouped.groupBy("cls").agg(F.sum("n").alias("popularity"))
    best = grouped.join(popular, "cls").groupBy("order", "token").agg(F.max(F.struct("popularity", "cls")).alias("best"))
    shared = grouped.join(best, ["order", "token"]).groupBy("cls", F.col("best.cls").alias("to")).agg(F.count("*").alias("groups"), F.max("best.popularity").alias("popularity"))
    follows = shared.groupBy("cls").agg(F.max(F.struct("groups", "popularity", "to")).alias("choice")).select("cls", F.col("choice.to").alias("to"))
    for _ in range(JUMPS):  # popularity grows with every step, so there are no circles
        follows = materialize(follows)
        on = follows.select(F.col("cls").alias("to"), F.col("to").alias("further"))
        follows = follows.join(on, "to", "left").select("cls", F.coalesce("further", "to").alias("to"))
    follows = materialize(follows)
    usual = grouped.join(follows, "cls").groupBy("to", "order", "token").agg(F.count("*").alias("n"))
    usual = usual.groupBy("to", "order").agg(F.max(F.struct("n", "token")).alias("usual"))
    usual = usual.filter("usual.n > 1").select("to", "order", F.col("usual.token").alias("token"))
    middle = grouped.select("cls", "order", "token").join(follows, "cls").join(usual, ["to", "order", "token"]).groupBy("to", "cls").agg(F.count("*").alias("n"))
    middle = middle.groupBy("to").agg(F.max(F.struct("n", "cls")).alias("middle")).select("to", F.col("middle.cls").alias("reference"))
    follows = follows.join(middle, "to").select("cls", F.col("reference").alias("to")).filter("cls != to")
    mine, theirs = reps.select("cls", "firsts"), reps.select(F.col("cls").alias("to"), F.col("firsts").alias("others"))
    agreed = F.aggregate(F.zip_with("firsts", "others", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return follows.join(mine, "cls").join(theirs, "to").filter(agreed >= AGREE).select(F.col("cls").alias("a"), F.col("to").alias("b"))


def candidates(docs: DataFrame, reps: DataFrame, flags: DataFrame, families: DataFrame, marks: DataFrame, order: TokenOrder, rule: Rule) -> DataFrame:
    """Pairs of classes (a < b) that share a prefix token within reach of a link under every one of the ORDERS orders.

    Two linked sets share a prefix token under any order, so nothing is lost; those of one family share one of their difference's prefix
    (``marks``: token, cls, side). ``flags`` has, by doc_id, the classes that are copies (to be left out) or belong to a family.
    """
    rows = docs.filter("doc_id IS NOT NULL").select("doc_id", text_bytes().alias("data"))
    rows = rows.join(flags.withColumnRenamed("doc_id", "flag_id"), F.col("doc_id") == F.col("flag_id"), "left").select("data", "flags")
    lost = texts_without_id(docs, rule).join(reps.filter("rep IS NULL").select("cls"), "cls").join(families, "cls", "left")
    none = F.lit(None).cast("array<struct<cls:long,family:long,copy:boolean>>")
    known = F.when(F.col("family").isNotNull(), F.array(F.struct("cls", "family", F.lit(False).alias("copy")))).otherwise(none)
    rows = rows.unionByName(lost.select("data", known.alias("flags")))

    def emit(parts):
        memo = WordHashes()
        for part in parts:
            for datas, flags in some_at_a_time(part["data"], part["flags"], most=RUN_BYTES):
                tokens, owners, groups, reach = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
                for data, known in zip(datas, flags):
                    found = shingle_set(spaced_words(data), rule.k, memo)
                    if not len(found):
                        continue
                    cls = family = set_hash(found)
                    if flag := next((f for f in known or () if f["cls"] == cls), None):
                        if flag["copy"]:
                            continue  # another row stands for this class
                        family = flag["family"]
                    for o, prefix in enumerate(order.prefixes(found, rule.prefix(len(found)))):
                        tokens.append(posting(prefix, o))
                        owners.append(np.full(len(prefix), cls, np.int64))
                        groups.append(np.full(len(prefix), family, np.int64))
                        reach.append((len(found) << 32) + np.arange(len(found) - 1, len(found) - 1 - len(prefix), -1, dtype=np.int64))
                columns = zip(("token", "cls", "side", "reach"), (tokens, owners, groups, reach))
                yield {name: pa.array(np.concatenate(column).view(np.int64)) for name, column in columns}

    postings = pass_over(rows, {"data": F.col("data"), "flags": F.col("flags")}, "token long, cls long, side long, reach long", emit)
    sets, apart = ("token", "side", "cls", "reach"), ("token", "side", "cls", "behind", "apart", "n")
    marks = marks.withColumn("side", F.coalesce("side", "cls")).select(*apart)

    def met(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
        dealt = rows.select(*names).repartition(F.col("token"))
        return pass_over(dealt, {c: F.col(c) for c in names}, "a long, b long, orders int", lambda parts: _met(parts, names, rule))

    pairs = met(postings, sets).unionByName(met(marks, apart))
    every = (1 << ORDERS) - 1
    return pairs.groupBy("a", "b").agg(F.bit_or("orders").alias("orders")).filter((F.col("orders") == every) & (F.col("a") != F.col("b"))).select("a", "b")


def _met(parts, names: tuple[str, ...], rule: Rule):
    """All rows of a token are in one partition: the pairs of its classes that stand on different sides and are in reach of a link.

    ``reach`` is a set's size and, in the low half, what stands behind the token in it.
    """
    columns = [[np.empty(0, np.int64)] for _ in names]
    for part in parts:
        for column, name in zip(columns, names):
            column.append(part[name].to_numpy())
    columns = [np.concatenate(c) for c in columns]
    by = np.argsort(columns[0])
    same = columns[0][by[1:]] == columns[0][by[:-1]]
    by = by[np.append(same, False) | np.append(False, same)] if len(by) else by  # most tokens meet nothing
    columns = [c[by] for c in columns]
    by = np.lexsort((columns[2], columns[1], columns[0]))
    token, side, cls, *facts = (c[by] for c in columns)
    new = np.append(True, (token[1:] != token[:-1]) | (cls[1:] != cls[:-1]) | (side[1:] != side[:-1])) if len(token) else np.empty(0, bool)
    token, side, cls, *facts = (c[new] for c in (token, side, cls, *facts))
    if not len(token):
        return
    lists = np.append(True, token[1:] != token[:-1])
    sides = lists | np.append(True, side[1:] != side[:-1])
    after_list = np.append(np.flatnonzero(lists)[1:], len(token))[np.cumsum(lists) - 1]
    after_side = np.append(np.flatnonzero(sides)[1:], len(token))[np.cumsum(sides) - 1]
    counts = after_list - after_side  # each meets those of the sides behind its own
    ends, at = np.cumsum(counts), 0
    while at < len(counts):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + MEET_PAIRS)))
        left = np.repeat(np.arange(at, stop), counts[at:stop])
        right = after_side[left] + np.arange(len(left)) - (ends[left] - counts[left] - done)
        behind, apart, n = facts if len(facts) == 3 else (facts[0] & 0xFFFFFFFF, facts[0] >> 32, facts[0] >> 32)
        near = within_reach(rule, *(f[x] for f in (behind, apart, n) for x in (left, right)))
        left, right = left[near], right[near]
        low, high = np.minimum(cls[left], cls[right]), np.maximum(cls[left], cls[right])
        yield _distinct_pairs(np.column_stack([low, high, token[left] & ((1 << ORDER_BITS) - 1)]))
        at = stop


def _distinct_pairs(rows: np.ndarray) -> dict:
    by = np.lexsort((rows[:, 1], rows[:, 0]))
    rows = rows[by]
    first = np.flatnonzero(np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(1))) if len(rows) else np.empty(0, np.int64)
    orders = np.bitwise_or.reduceat(1 << rows[:, 2], first) if len(first) else np.empty(0, np.int64)
    return {"a": pa.array(rows[first, 0]), "b": pa.array(rows[first, 1]), "orders": pa.array(orders).cast(pa.int32())}


def components(edges: DataFrame) -> DataFrame:
    """The least node that each node of the edges (a, b) reaches: node, root. Min-label stars, alternating, until nothing changes."""
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct())
    mark = _digest(edges)
    while True:
        # large star: of each node's neighbours, the greater ones go to its least neighbour (or itself)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        # small star: each node and its lesser neighbours go to the least of these
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).union(small.select("a", F.col("low").alias("b"))).filter("a != b").distinct()
        edges = materialize(small)
        before, mark = mark, _digest(edges)
        if mark == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _digest(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("b", "a").cast("bigint"))).first())


def _grouped(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, cls, n), classes (cls, rep, rows), and for classes with a link the least class of their component (cls, root)."""
    stored = signatures(docs, rule)
    rows = stored.filter("token IS NULL").select("doc_id", "cls", "n", "firsts")
    often = stored.filter("token IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen")).filter(F.col("seen") >= FREQUENT)
    top = often.orderBy(F.desc("seen"), "token").limit(FREQUENT_TOKENS).toArrow()
    order = TokenOrder(top["token"].to_pylist(), top["seen"].to_pylist())
    reps = materialize(rows.filter("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("firsts").alias("firsts"), F.count("*").alias("rows")))

    compared = materialize(verified(docs, materialize(references(reps)), reps, rule, of_family=True))
    members = compared.filter("diff IS NOT NULL").select("a", "b", "size_a", "size_b", "diff")
    used = members.select(F.col("b").alias("used")).distinct()
    members = materialize(members.join(used, F.col("a") == F.col("used"), "left_anti").dropDuplicates(["a", "b"]))  # a reference is of its own family only
    members = materialize(recentred(members))
    families = members.select(F.col("a").alias("cls"), F.col("b").alias("family"))
    families = materialize(families.unionByName(members.select(F.col("b").alias("cls"), F.col("b").alias("family")).distinct()))
    marks = marked(members, rule)

    copies = rows.join(reps.filter("rows > 1 AND rep IS NOT NULL").select("cls", "rep"), "cls").filter("doc_id != rep")
    flags = copies.select("doc_id", "cls", F.lit(None).cast("bigint").alias("family"), F.lit(True).alias("copy")).distinct().unionByName(
        reps.filter("rep IS NOT NULL").join(families, "cls").select(F.col("rep").alias("doc_id"), "cls", "family", F.lit(False).alias("copy")))
    flags = flags.groupBy("doc_id").agg(F.collect_list(F.struct("cls", "family", "copy")).alias("flags"))
    pairs = materialize(candidates(docs, reps, small_result(flags), families, marks, order, rule))

    to_reference = members.withColumn("common", F.expr("(size_a + size_b - size(diff)) div 2"))
    edges = compared.filter(linked(rule)).select("a", "b").unionByName(to_reference.filter(linked(rule)).select("a", "b"))
    partners = pairs.select(F.col("a").alias("cls"), F.col("b").alias("other")).union(pairs.select(F.col("b").alias("cls"), F.col("a").alias("other")))
    if pairs.count() > CROWDED * partners.agg(F.count_distinct("cls")).first()[0]:
        # a few pairs of each class first: of the others only those are compared whose classes are not connected by then
        ranks = [F.min(F.struct(F.xxhash64("cls", "other", F.lit(turn)).alias("rank"), "other")) for turn in range(CROWDED)]
        few = partners.groupBy("cls").agg(F.array(*ranks).alias("few")).select("cls", F.explode("few.other").alias("other"))
        few = materialize(few.select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).distinct())
        edges = materialize(edges.unionByName(verified(docs, few, reps, rule).filter(linked(rule)).select("a", "b")))
        known = components(edges)
        known = known.unionByName(known.select(F.col("root").alias("node"), "root").distinct())
        root_a, root_b = (known.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
        apart = pairs.join(few, ["a", "b"], "left_anti").join(root_a, "a", "left").join(root_b, "b", "left")
        pairs = materialize(apart.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b"))
    edges = edges.unionByName(verified(docs, pairs, reps, rule).filter(linked(rule)).select("a", "b"))
    roots = components(edges)
    roots = roots.select(F.col("node").alias("cls"), "root").unionByName(roots.select(F.col("root").alias("cls"), "root").distinct())
    return rows.select("doc_id", "cls", "n"), reps.select("cls", "rep", "rows"), materialize(roots)


def near_copies(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Groups of documents linked by the Jaccard similarity of their shingle sets: doc_id, n_shingles, component_id.

    Exact: documents link if 100 * common >= percent * union of their sets of distinct k-word shingles (A-Z in lower case,
    words between ASCII white space; fewer words are one shingle), and component_id is the least doc_id that links reach. Null and
    empty texts have no set and link with nothing; equal sets are one class, however often and in whatever rows they occur; rows that repeat
    an id are documents of their own; a null doc_id never names a component unless all of it lack ids; an empty table gives no rows. Texts are
    read whole, one at a time. Sets are known by 64-bit hashes. Other columns are not read.

    1. One pass makes a class hash, first tokens and frequent tokens. 2. Each class that looks like others is compared with the reference
    of its family, which gives links and what sets the class apart. 3. Prefix tokens of every class under each order meet by token: classes of
    different families by tokens of their sets, classes of one family by tokens of what sets them apart. Pairs that meet under
    all orders are candidates. 4. Candidates of fitting sizes are compared, where there are many a few of each class first, and then those whose
    classes are not connected yet. 5. Links become components by alternating stars. No group is
    collected; what links two classes of a family by way of its reference is not looked for again.
    """
    rows, reps, roots = _grouped(docs, rule)
    least = roots.join(reps.select("cls", "rep"), "cls").groupBy("root").agg(F.min("rep").alias("component"))
    of_class = small_result(roots.join(least, "root").select("cls", "component"))
    several = small_result(reps.filter("rows > 1").select("cls", "rep"))
    out = rows.join(of_class, "cls", "left").join(several, "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """All columns of one row of each component: of its class with the least doc_id, the row with that id (the least text, if it repeats).

    Decided by id and set of shingles, so unrelated texts under one id all stay. Texts without words are in no component: rows of one id
    whose such texts are equal become one, those without an id all stay. Components without any id keep the least text of one
    class. An empty table stays empty; texts of any length are taken whole.
    """
    rows, reps, roots = _grouped(docs, rule)
    named = roots.join(reps, "cls").unionByName(reps.filter("rows > 1").join(roots, "cls", "left_anti").withColumn("root", F.col("cls")).select("cls", "root", "rep", "rows"))
    first = named.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("lost"), "rep", "cls")).alias("first"))
    chosen = small_result(named.join(first, "root").select("cls", F.when(F.col("cls") == F.col("first.cls"), F.struct("rep")).alias("kept")))
    repeated = small_result(rows.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("__again")))

    # ids of one row: the class of the id decides
    gone = rows.join(chosen, "cls").filter(F.col("kept").isNull() | ~F.col("doc_id").eqNullSafe(F.col("kept.rep"))).select(F.col("doc_id").alias("__again"))
    single = docs.join(small_result(gone.filter("__again IS NOT NULL").distinct().unionByName(repeated).distinct()), docs["doc_id"].eqNullSafe(F.col("__again")), "left_anti")
    if repeated.isEmpty():
        return single

    # ids of several rows, and rows without an id: the class of each row decides, which a pass over these rows finds
    at, names = docs.columns.index("text"), docs.columns
    several = docs.join(repeated, docs["doc_id"].eqNullSafe(F.col("__again")), "left_semi")
    schema = T.StructType([*docs.schema.fields, T.StructField("__cls", T.LongType())])

    def classed(batches):
        memo = WordHashes()
        for batch in small_batches(batches, at):
            sets = (shingle_set(spaced_words((t or "").encode()), rule.k, memo) for t in batch.column(at).to_pylist())
            classes = pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, classes], names=[*batch.schema.names, "__cls"])

    of_rows = materialize(map_batches(several, classed, schema))
    wordless = of_rows.filter("__cls IS NULL")
    loose = wordless.filter("doc_id IS NULL").unionByName(wordless.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]))
    decided = chosen.select(F.col("cls").alias("__of"), F.col("kept").alias("__kept"))
    kept = of_rows.filter("__cls IS NOT NULL").join(decided, F.col("__cls") == F.col("__of"), "left")
    kept = kept.filter(F.col("__of").isNull() | F.col("__kept").isNotNull() & F.col("doc_id").eqNullSafe(F.col("__kept.rep")))
    kept = kept.groupBy("__cls").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in names]), F.struct("text")).alias("__row")).select("__row.*")
    return single.unionByName(loose.select(*names)).unionByName(kept.select(*names))
