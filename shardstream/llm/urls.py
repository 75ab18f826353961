"""URL filters: rules first, then the ratio of two character language models of variable order."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .words import LOWER, UPPER, hashed_fold, pass_over

ORDER = 5
# Windows of text whose ratios each task holds, the most frequent ones; all others are joined. Scores do not depend on it.
HOT = 1 << 16
# Runs that a task counts before it hands on what it has.
FLUSH = 500_000
ALPHABET = 256
# Scores are calibrated on this part of the ruled urls, which the models don't see.
FOLDS = 5
BINS, WIDEST = 4000, 20.0
# Ratios are added up as whole numbers of 1/UNIT, so that scores do not depend on the order of rows.
UNIT = 1 << 36
START, STOP = "\x02", "\x03"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) between the first '://' and '/', '?', '#' or the end; path up to '?', '#' or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, UPPER.decode(), LOWER.decode()), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def ruled(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """page_id, url, host, path, rule and its action: of the rules (action, host/path) that fit, the longest."""
    host, path = host_and_path(F.col("url"))
    out = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule = action = F.lit(None).cast("string")
    for act, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = text.partition("/")
        fits = ((F.col("host") == name) | F.endswith(F.col("host"), F.lit(f".{name}"))) & F.startswith(F.col("path"), F.lit(slash + start))
        rule, action = F.when(fits, text).otherwise(rule), F.when(fits, act).otherwise(action)
    return out.withColumn("rule", rule).withColumn("action", action)


def runs_of(url: str) -> list[str]:
    """All runs of 1 to ORDER + 1 characters that end inside the url or at its end, digits as 0."""
    text = START + "".join("0" if "0" <= c <= "9" else c for c in url) + STOP
    return [text[max(0, end - size) : end] for end in range(2, len(text) + 1) for size in range(1, min(ORDER + 1, end) + 1)]


def windows_of(url: str) -> list[str]:
    """For each character after the first and the end of the url: the longest of its :func:`runs_of`; the others are ends of it."""
    text = START + "".join("0" if "0" <= c <= "9" else c for c in url) + STOP
    return [text[max(0, end - ORDER - 1) : end] for end in range(2, len(text) + 1)]


def count_runs(rows: DataFrame) -> DataFrame:
    """All runs of all urls: run, accepted, rejected (how often in the urls that train each model), windows (how often it is a window).

    Tasks add up before they shuffle.
    """

    def run(parts):
        counts = {"allow": Counter(), "block": Counter(), None: Counter()}
        for part in parts:
            for action, url in zip(part["taught"].to_pylist(), part["url"].to_pylist()):
                counts[action].update(windows_of(url))
                if sum(map(len, counts.values())) * (ORDER + 1) > FLUSH:
                    yield flushed(counts)
        yield flushed(counts)

    def flushed(counts):
        found = defaultdict(lambda: [0, 0, 0])
        for action, place in (("allow", 0), ("block", 1), (None, 2)):
            for window, n in counts[action].items():
                found[window][2] += n
                if place < 2:
                    for size in range(1, len(window) + 1):
                        found[window[-size:]][place] += n
                else:
                    for size in range(1, len(window)):
                        found[window[-size:]]
            counts[action].clear()
        accepted, rejected, windows = zip(*found.values()) if found else ((), (), ())
        return {"run": list(found), "accepted": accepted, "rejected": rejected, "windows": windows}

    taught = F.when(hashed_fold("page_id", FOLDS) != 0, F.col("action"))
    texts = rows.filter("url <> ''")
    made = pass_over(texts, {"taught": taught, "url": F.col("url")}, "run string, accepted long, rejected long, windows long", run)
    return made.groupBy("run").agg(*[F.sum(c).alias(c) for c in ("accepted", "rejected", "windows")])


def window_ratios(runs: DataFrame) -> DataFrame:
    """What each window adds to a score, in units: window, windows (how often it occurs), ratio. The same as :class:`Ratio`, as tables.

    The probability of a run's last character leans on that of the run without its first character, so runs go by
    length. No key has more rows than there are characters, since runs that share a context or an end differ in one.
    """
    names = ("accepted", "rejected")
    context = Window.partitionBy(F.expr("left(run, length(run) - 1)"))
    seen = [F.sum(c).over(context).alias(f"{c}_seen") for c in names]
    kinds = [F.sum((F.col(c) > 0).cast("long")).over(context).alias(f"{c}_kinds") for c in names]
    runs = materialize(runs.select("*", F.length("run").alias("size"), *seen, *kinds))
    out = shorter = None
    for size in range(1, ORDER + 2):
        level = runs.filter(F.col("size") == size)
        if shorter is None:
            level = level.select("*", *[F.lit(1 / ALPHABET).alias(f"{c}_shorter") for c in names])
        else:
            ends = shorter.select(F.col("run").alias("end"), *[F.col(c).alias(f"{c}_shorter") for c in names])
            level = level.withColumn("end", F.expr("substring(run, 2)")).join(ends, "end")

        def probability(c):
            n, kinds, shorter = F.col(f"{c}_seen"), F.col(f"{c}_kinds"), F.col(f"{c}_shorter")
            return F.when(n > 0, (F.col(c) + kinds * shorter) / (n + kinds)).otherwise(shorter).alias(c)

        shorter = materialize(level.select("run", "windows", *[probability(c) for c in names]))
        out = shorter if out is None else out.unionAll(shorter)
    ratio = F.round((F.log("accepted") - F.log("rejected")) * UNIT).cast("long")
    return out.filter("windows > 0").select(F.col("run").alias("window"), "windows", ratio.alias("ratio"))


class Ratio:
    """The difference of two Witten-Bell smoothed models: log P(char | context, accepted) - log P(char | context, rejected).

    In the memory of one process, for tests; :func:`window_ratios` is the same for any number of runs.
    """

    def __init__(self, counts: list[tuple[str, int, int]]):
        counts.sort(key=lambda r: (len(r[0]), r[0]))
        seen, kinds = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
        for run, *both in counts:
            for m in (0, 1):
                seen[run[:-1]][m] += both[m]
                kinds[run[:-1]][m] += both[m] > 0
        logs: dict[str, tuple[float, float]] = {}
        self.ratio, self.back = {}, {}
        for context in seen:
            shares = [kinds[context][m] / (seen[context][m] + kinds[context][m]) if seen[context][m] else 1.0 for m in (0, 1)]
            self.back[context] = math.log(shares[0]) - math.log(shares[1])
        for run, *both in counts:
            context, shorter = run[:-1], self._shorter(logs, run)
            probabilities = []
            for m in (0, 1):
                n, k = seen[context][m], kinds[context][m]
                probabilities.append((both[m] + k * shorter[m]) / (n + k) if n else shorter[m])
            logs[run] = tuple(probabilities)
            self.ratio[run] = math.log(probabilities[0]) - math.log(probabilities[1])

    @staticmethod
    def _shorter(logs, run):
        """The probabilities by the next shorter context; a dropped run leaves it to a still shorter one."""
        while len(run) > 1:
            run = run[1:]
            if run in logs:
                return logs[run]
        return (1 / ALPHABET, 1 / ALPHABET)

    def score(self, url: str | None) -> float:
        """Mean difference a character; 0 for no characters."""
        if not url:
            return 0.0
        text = START + "".join("0" if "0" <= c <= "9" else c for c in url) + STOP
        total, ratio, back = 0.0, self.ratio, self.back
        for end in range(2, len(text) + 1):
            run = text[max(0, end - ORDER - 1) : end]
            while run and run not in ratio:
                total += back.get(run[:-1], 0.0)
                run = run[1:]
            total += ratio.get(run, 0.0)
        return total / (len(text) - 1)


def scored(pages: DataFrame, ratios: DataFrame) -> DataFrame:
    """The rows of :func:`ruled` with a score, stored: the mean ratio of a url's windows; 0 for no characters.

    Tasks add up the HOT most frequent windows of their rows; the other windows are joined with their ratios, of which
    none is in more than one of HOT places.
    """
    top = ratios.orderBy(F.desc("windows"), "window").limit(HOT)
    shared = pages.sparkSession.sparkContext.broadcast({r["window"]: r["ratio"] for r in top.collect()})
    names = ("page_id", "host", "path", "rule", "action", "row")

    def run(parts):
        for part in parts:
            hot, known, cold, chars = shared.value, [], [], []
            for url in part["url"].to_pylist():
                windows = windows_of(url) if url else []
                found = [hot.get(w) for w in windows]
                known.append(sum(r for r in found if r is not None))
                cold.append([w for w, r in zip(windows, found) if r is None])
                chars.append(len(windows))
            yield {**{c: part[c] for c in names}, "known": known, "cold": cold, "chars": chars}

    columns = {**{c: F.col(c) for c in names[:-1]}, "row": F.monotonically_increasing_id(), "url": F.col("url")}
    kinds = "page_id void, host string, path string, rule string, action string, row long, known long, cold array<string>, chars long"
    rows = materialize(pass_over(pages, columns, kinds, run))
    others = rows.select("row", F.explode("cold").alias("window")).join(ratios.select("window", "ratio"), "window")
    others = others.groupBy("row").agg(F.sum("ratio").alias("others"))
    total = (F.col("known") + F.coalesce("others", F.lit(0))) / F.lit(float(UNIT))
    score = F.when(F.col("chars") > 0, total / F.col("chars")).otherwise(F.lit(0.0))
    return materialize(rows.join(others, "row", "left").select(*names[:-1], score.alias("score")))


def threshold(scores: DataFrame) -> float:
    """The score that parts ruled urls best: the least sum of the shares of accepted ones below and rejected ones above it."""
    at = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("score") + WIDEST) * (BINS / (2 * WIDEST)))))
    found = scores.groupBy(at.cast("int").alias("bin"), "action").count().collect()  # at most BINS rows an action
    if len({r["action"] for r in found}) < 2:
        return 0.0
    sizes = {a: sum(r["count"] for r in found if r["action"] == a) for a in ("allow", "block")}
    shares = defaultdict(lambda: [0.0, 0.0])
    for r in found:
        shares[r["bin"]][r["action"] == "block"] += r["count"] / sizes[r["action"]]
    wrong, least, cuts = 1.0, 1.0, [0]  # everything accepted: all rejected ones are above
    for b in range(BINS):
        wrong += shares[b][0] - shares[b][1]
        if wrong < least - 1e-12:
            least, cuts = wrong, [b + 1]
        elif wrong < least + 1e-12 and cuts and cuts[-1] == b:
            cuts.append(b + 1)
    middle = (cuts[0] + cuts[-1]) / 2
    return middle * 2 * WIDEST / BINS - WIDEST


def judge(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """A verdict on every url: page_id, host, path, rule, verdict, score.

    A rule decides where one fits. All urls that rules decide, but for a calibration fold, train a model of
    accepted and a model of rejected urls (variable order up to ORDER, Witten-Bell smoothing); a url without a rule
    is allowed if the difference of its mean log-likelihoods a character is at least the threshold that
    parts the calibration fold best. Counting covers all urls and all their character runs and is added up before it is
    shuffled; runs, totals of contexts and ratios are tables, and every window of a url is scored with its own. Null urls and urls without '://' have an empty host and path;
    a null or empty url scores 0; without urls of both kinds the threshold is 0 and a url that the models
    know nothing of is allowed. Repeated rows are judged alike, a url of any length is
    read whole, other columns are not read, an empty table gives no rows.
    """
    rows = ruled(pages, rules)
    found = scored(rows, window_ratios(count_runs(rows)))
    held = hashed_fold("page_id", FOLDS) == 0
    cut = threshold(found.filter(F.col("action").isNotNull() & held))
    verdict = F.coalesce("action", F.when(F.col("score") >= cut, "allow").otherwise("block"))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
