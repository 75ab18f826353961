"""Toxicity by a weighted finite-state pattern grammar: transducers for insult, threat, target, negation and reported
speech, composed into one machine that reads clauses and scores matched patterns, not isolated words."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .quality import labelled_texts, training_labels
from .words import LOWERED, MEMO_WORDS, alnum_words, pass_over, text_bytes

FOLDS, HELD_OUT = 4, 2
# Labelled rows that stems and weights are learned from, those with the lowest hash of their id; and stems kept.
SAMPLE, STEMS, CANDIDATES = 20_000, 2_000, 200_000
STEM_CHARS = range(3, 11)
# Stems must be this much likelier in toxic documents, as a log odds ratio less DOUBT standard errors.
LEAST_DOCS, LEAST_ODDS, DOUBT = 4, 2.0, 2.0

# Seed words of the grammar.
LEXICON = {
    "insult": "idiot idiots moron morons stupid loser losers clown clowns scum trash pathetic worthless disgusting dumb fool vermin garbage filth imbecile",
    "threat": "kill hurt destroy beat shoot stab burn hang attack crush smash strangle",
    "target": "you your yours he she they them him her his their this that these those people everyone du ihr sie er tu vous il elle ils tú usted ellos él ella",
    "negation": "not no never nobody none neither nor without hardly isn aren wasn don doesn didn nicht kein keine nie pas jamais sans nunca sin ni",
    "report": "said says say wrote writes quoted quote called calls claimed claims according reported alleged sagte schrieb dit écrit dijo escribió",
}
OTHER = "other"
CLAUSE_END = re.compile(rb"[.!?;:\n]+")


@dataclass(frozen=True)
class Transducer:
    """A deterministic weighted transducer: arcs[state][symbol] = (next state, symbol out, weight); other symbols pass, keeping the state."""

    arcs: dict[int, dict[str, tuple[int, str, float]]]
    fallback: dict[int, int]

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        found = self.arcs.get(state, {}).get(symbol)
        return found or (self.fallback.get(state, state), symbol, 0.0)


def composed(first: Transducer, second: Transducer, symbols: list[str]) -> Transducer:
    """The machine whose output is that of ``second`` reading what ``first`` writes; weights add up."""
    arcs, fallback, number = {}, {}, {(0, 0): 0}
    todo = [(0, 0)]
    while todo:
        pair = todo.pop()
        row = {}
        for symbol in symbols:
            a, between, w1 = first.step(pair[0], symbol)
            b, out, w2 = second.step(pair[1], between)
            if (a, b) not in number:
                number[(a, b)] = len(number)
                todo.append((a, b))
            row[symbol] = (number[(a, b)], out, w1 + w2)
        arcs[number[pair]] = row
    return Transducer(arcs, fallback)


def negation(reach: int = 3) -> Transducer:
    """A negation within ``reach`` words before an insult or threat turns it into a denied one."""
    arcs = {0: {"negation": (reach, "negation", 0.0)}}
    for state in range(1, reach + 1):
        arcs[state] = {
            "negation": (reach, "negation", 0.0), "insult": (state, "denied", 0.0), "threat": (state, "denied", 0.0),
        } | {s: (state - 1, s, 0.0) for s in (OTHER, "target", "report")}
    return Transducer(arcs, {})


def reported() -> Transducer:
    """After a verb of speaking, insults and threats up to the end of the clause are quoted ones."""
    quoted = {"insult": (1, "quoted", 0.0), "threat": (1, "quoted", 0.0)}
    return Transducer({0: {"report": (1, "report", 0.0)}, 1: quoted}, {})


# What patterns weigh, before learned weights of words; the scale of the score is fitted.
INSULT, AIMED, THREAT, AIMED_THREAT, DENIED, QUOTED = 1.0, 0.5, 0.5, 1.5, 0.25, 0.5


def patterns() -> Transducer:
    """Insults and threats, more if a target stands in the clause before or, once only, after them; denied and quoted ones count less."""
    free = {"target": (1, "target", 0.0), "insult": (2, "insult", INSULT), "threat": (3, "threat", THREAT)}
    aimed = {"insult": (1, "insult", INSULT + AIMED), "threat": (1, "threat", AIMED_THREAT)}
    less = {"denied": DENIED, "quoted": QUOTED}
    arcs = {0: dict(free), 1: dict(aimed), 2: dict(free) | {"target": (1, "target", AIMED)}, 3: dict(free) | {"target": (1, "target", AIMED_THREAT - THREAT)}}
    for state, (name, weight) in product(list(arcs), less.items()):
        arcs[state][name] = (state, name, weight)
    return Transducer(arcs, {})


class Grammar:
    """The composed machine over classes of words, with learned stems whose weights multiply those of patterns."""

    def __init__(self, stems: dict[str, float]):
        self.words = {w.encode().translate(LOWERED): kind for kind, text in LEXICON.items() for w in text.split()}
        self.stems = stems
        symbols = [*LEXICON, OTHER]
        self.machine = composed(composed(negation(), reported(), [*symbols, "denied"]), patterns(), symbols)
        self.memo: dict[bytes, tuple[str, float] | None] = {}

    def __reduce__(self):
        return Grammar, (self.stems,)

    def kind(self, word: bytes) -> tuple[str, float] | None:
        """The class of a word and its weight: that of the longest stem, else the lexicon's."""
        if word in self.memo:
            return self.memo[word]
        text, found = word.decode(errors="replace"), None
        for size in (len(text) + 1, *range(min(len(text), STEM_CHARS[-1]), STEM_CHARS[0] - 1, -1)):
            weight = self.stems.get(text[:size] if size <= len(text) else f"{text}$")
            if weight is not None:
                found = ("insult", weight)
                break
        if found is None and (kind := self.words.get(word)):
            found = (kind, 1.0)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        self.memo[word] = found
        return found

    def clauses(self, data: bytes) -> list[float]:
        """The weights of the clauses in which a pattern matches."""
        kind, out = self.kind, []
        if not any(k is not None and k[0] in ("insult", "threat") for k in map(kind, set(alnum_words(data)))):
            return out
        for clause in CLAUSE_END.split(data):
            kinds = [kind(w) for w in alnum_words(clause)]
            if not any(k is not None and k[0] in ("insult", "threat") for k in kinds):
                continue
            state, total = 0, 0.0
            for found in kinds:
                symbol, scale = found or (OTHER, 1.0)
                state, _, weight = self.machine.step(state, symbol)
                total += weight * scale
            out.append(total)
        return out


def stem_candidates(data: bytes) -> set[str]:
    """The distinct words of a text, marked as whole, and their beginnings."""
    out = set()
    for word in set(alnum_words(data)):
        text = word.decode(errors="replace")
        if len(text) >= STEM_CHARS[0]:
            out.add(f"{text}$")
            out.update(text[:n] for n in STEM_CHARS if n <= len(text))
    return out


def _document_counts(rows: DataFrame, only: set[str] | None) -> DataFrame:
    """In how many documents each stem occurs; tasks add up first."""
    shared = rows.sparkSession.sparkContext.broadcast(only)

    def run(parts):
        counts = Counter()
        for part in parts:
            for data in part["data"].to_pylist():
                found = stem_candidates(data)
                counts.update(found if shared.value is None else found & shared.value)
            if len(counts) > MEMO_WORDS:
                yield {"stem": list(counts), "docs": list(counts.values())}
                counts.clear()
        yield {"stem": list(counts), "docs": list(counts.values())}

    return pass_over(rows, {"data": text_bytes()}, "stem string, docs long", run).groupBy("stem").agg(F.sum("docs").alias("docs"))


def learned_stems(labelled: DataFrame) -> dict[str, float]:
    """Words and beginnings that toxic documents have and others hardly have, with weights from their log odds.

    Of stems that say the same the shortest is kept. The driver sees CANDIDATES stems at most.
    """
    sizes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return {}
    toxic = _document_counts(labelled.filter("label = 1"), None).filter(F.col("docs") >= LEAST_DOCS)
    pos = {r["stem"]: r["docs"] for r in toxic.orderBy(F.desc("docs"), "stem").limit(CANDIDATES).collect()}
    clean = _document_counts(labelled.filter("label = 0"), set(pos)).collect() if pos else []
    neg = {r["stem"]: r["docs"] for r in clean}
    odds = {}
    for stem, n in pos.items():
        other = neg.get(stem, 0)
        ratio = np.log((n + 0.5) / (sizes[1] + 1)) - np.log((other + 0.5) / (sizes[0] + 1))
        odds[stem] = ratio - DOUBT * np.sqrt(1 / (n + 0.5) + 1 / (other + 0.5))
    kept: dict[str, float] = {}
    for stem in sorted((s for s, o in odds.items() if o >= LEAST_ODDS), key=lambda s: (len(s), s)):
        shorter = next((kept[stem[:n]] for n in range(STEM_CHARS[0], len(stem)) if stem[:n] in kept), None)
        if shorter is None or odds[stem] > shorter + 1.0:
            kept[stem] = float(odds[stem])
    best = sorted(kept.items(), key=lambda x: -x[1] * np.log1p(pos[x[0]]))[:STEMS]
    return {s: o / LEAST_ODDS for s, o in best}


@dataclass
class Scale:
    """Logistic weights of a document's clause weights: their sum, the largest, and their sum by length."""

    weights: np.ndarray
    shift: float

    @staticmethod
    def measures(clauses: list[float], size: int) -> tuple[float, float, float]:
        total = sum(clauses)
        return float(np.log1p(total)), float(max(clauses, default=0.0)), float(np.log1p(1000 * total / (size + 100)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.shift, -30, 30)))


def fitted_scale(x: np.ndarray, y: np.ndarray) -> Scale:
    """Newton steps on the logistic loss with a little shrinkage; without both labels a plain scale."""
    if len(np.unique(y)) < 2:
        return Scale(np.array([1.0, 0.5, 0.5]), -2.0)
    z = np.column_stack([x, np.ones(len(x))])
    w, keep = np.zeros(z.shape[1]), np.diag([1e-1] * x.shape[1] + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + keep, z.T @ (y - p) - keep @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return Scale(w[:-1], float(w[-1]))


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The probability that each document is toxic: doc_id, score, n_clauses (with a matched pattern).

    The grammar's words are a seed lexicon and stems learned from at most ``sample`` labelled documents outside the
    held-out fold; composed transducers read each clause of each whole text; a logistic scale turns the clauses' weights into a
    probability. Null and empty texts match nothing and get the probability of that; equal texts score alike;
    without labels of both kinds the seed lexicon and a plain scale are used; an empty table gives no rows. A text of any length is
    read whole, in one task; rows that repeat or have no id are scored one by one. Only texts are inputs, whatever other columns are called. All texts are read twice, once to pick the sample, and only the sample's texts are shuffled.
    """
    spark = docs.sparkSession
    chosen = training_labels(labels, "toxic", FOLDS, HELD_OUT, sample)
    labelled = materialize(labelled_texts(docs, chosen))
    grammar = spark.sparkContext.broadcast(Grammar(learned_stems(labelled)))

    def measure(parts):
        for part in parts:
            rows = [(Scale.measures(grammar.value.clauses(d), len(d))) for d in part["data"].to_pylist()]
            yield {"label": part["label"], **{c: list(v) for c, v in zip("abc", zip(*rows))}}

    seen = pass_over(labelled, {"label": F.col("label"), "data": text_bytes()}, "label int, a double, b double, c double", measure).toArrow()
    x = np.column_stack([seen[c].to_numpy() for c in "abc"]) if seen.num_rows else np.zeros((0, 3))
    scale = spark.sparkContext.broadcast(fitted_scale(x, seen["label"].to_numpy().astype(float)))

    def run(parts):
        for part in parts:
            datas = part["data"].to_pylist()
            clauses = [grammar.value.clauses(d) for d in datas]
            x = np.array([Scale.measures(c, len(d)) for c, d in zip(clauses, datas)])
            yield {"doc_id": part["doc_id"], "score": pa.array(scale.value.probability(x)), "n_clauses": list(map(len, clauses))}

    return pass_over(docs, {"doc_id": F.col("doc_id"), "data": text_bytes()}, "doc_id void, score double, n_clauses long", run)
